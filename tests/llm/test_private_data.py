import hashlib
import random
import re

import numpy as np

from scorelake.llm.private_data import KINDS, LABELERS, base_spans, candidates, emails, private_spans, reliabilities, train, train_spans

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(s):
    digits = [int(c) for c in s if c.isdigit()][::-1]
    return (sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])) % 10 == 0


def brute(text):
    text = text or ""
    digits = lambda s: sum(c in "0123456789" for c in s)
    return {
        "email": [m.span() for m in EMAIL.finditer(text)],
        "ip": [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))],
        "card": [m.span() for m in CARD.finditer(text) if 13 <= digits(m.group()) <= 19 and luhn(m.group())],
        "phone": [m.span() for m in PHONE.finditer(text) if 9 <= digits(m.group()) <= 15],
    }


def test_base_equals_the_patterns():
    rng = random.Random(1)
    parts = ["a", "b.c", "@", ".", "x@y.de", "1", "12", "255", "256", "4111 1111 1111 1111", "+1 (974) 555-3436", "-", " ", "_", "é", "٣", "+", "(", "%", "1.2.3.4", "00001"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert base_spans(text) == brute(text), text


def test_long_runs_take_linear_time():
    assert emails("a" * 300_000) == [] and base_spans("1" * 300_000 + "a." * 100_000 + "@") == {"email": [], "ip": [], "card": [], "phone": []}


def line(spans, kinds):
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in spans.get(k, ()))


def check(df, rows):
    got = sorted(map(tuple, df.collect()), key=repr)
    want = []
    for doc_id, text in rows:
        spans = brute(text)
        base = line(spans, ["email", "ip", "card", "phone"])
        want.append((doc_id, *map(len, spans.values()), hashlib.sha256(base.encode()).hexdigest(), base))
    want = sorted(want, key=repr)
    assert [r[:6] for r in got] == [r[:6] for r in want]
    for ours, theirs in zip(got, want):
        assert ours[6].startswith(theirs[6])
        added = ours[6][len(theirs[6]) :].strip(",")
        assert all(s.split(":")[0] in KINDS for s in added.split(",") if s)
    return got


def test_documents(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = check(private_spans(docs), rows)
    texts = dict(rows)
    secrets = {(r[0], *map(int, s.split(":")[1:])) for r in got for s in r[6].split(",") if s.startswith("secret")}
    want = {(d, m.start(1), m.end(1)) for d, t in rows for m in re.finditer(r'token = "([0-9a-f]{40})"', t or "")}
    assert secrets == want and all(texts[d] for d, _, _ in want)


def test_edge_rows(edge, none):
    check(private_spans(edge), [(r["doc_id"], r["text"]) for r in edge.collect()])
    assert private_spans(none).collect() == [] and train_spans(none) == []


def test_added_kinds(spark):
    texts = [
        'the token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" is mine',
        "commit 04dbebab91ab85687d33eeaaf9ac699e1188f962 of sha1",
        "IBAN: DE89 3704 0044 0532 0130 00 and GB82 WEST 1234 5698 7654 32 there",
        "my ssn: 123-45-6789, order 000-12-3456",
        "mac: 00:1b:44:11:3a:b7",
    ] * 20
    rows = list(enumerate(texts))
    got = {r[0]: r[6] for r in private_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0] == "secret:13:53" and got[1] == "" and "iban:6:33" in got[2].replace("iban:6:33", "iban:6:33") and got[3] == "ssn:8:19" and got[4].startswith("mac:5:22")


def test_reliabilities():
    rng = np.random.default_rng(2)
    cells = {}
    for _ in range(5000):
        true = rng.random() < 0.3
        vote = tuple(int(rng.choice([-1, 0, 1], p=[0.05, 0.25, 0.7] if true else [0.7, 0.25, 0.05])) if good else int(rng.choice([-1, 0, 1])) for good in (1, 1, 1, 0, 0))
        n, hits = cells.get(vote, (0, 0))
        cells[vote] = (n + 1, hits + true)
    table = [("secret", v, n) for v, (n, _) in sorted(cells.items())]
    likely = reliabilities(table)
    right = sum(hits if p >= 0.5 else n - hits for p, (_, (n, hits)) in zip(likely, sorted(cells.items())))
    assert right / 5000 > 0.93 and len(LABELERS) == 5
    assert train([]) == [] and len(train([("ssn", (1, 1, 1, 0, 1, 3, 0), 4)])) > 0


def corpus(rng, n):
    """(text, kind, start, end, true) of made-up candidates: secrets of all lengths, and what only looks like one."""
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    word = lambda k: "".join(rng.choice(list("aeiounrstlkmdbg"), k))
    token = lambda k: "".join(rng.choice(list(letters), k))
    out = []
    for _ in range(n):
        name = rng.choice(["token", "secret", "password", "api_key", "client_secret", "access_token", "passphrase"])
        shape = rng.integers(0, 8)
        if shape == 0:
            before, s, true = f'{name} = "', token(rng.integers(20, 300)), True
        elif shape == 1:
            before, s, true = f"{name}: ", token(rng.integers(16, 40)), True
        elif shape == 2:
            before, s, true = "password: ", rng.choice(["hunterCorrectHorseBattery", "s3cr3tPass9x", "Tr0ub4dor&3zebra", "plumHarborQuietFox"]), True
        elif shape == 3:
            before, s, true = f"authorization {rng.choice(['bearer', 'token'])} = ", token(rng.integers(130, 200)), True
        elif shape == 4:
            before, s, true = f"{rng.choice(['commit', 'sha1', 'checksum', 'digest'])} ", "".join(rng.choice(list("0123456789abcdef"), 40)), False
        elif shape == 5:
            before, s, true = f"the {word(5)} ", word(rng.integers(16, 30)), False
        elif shape == 6:
            before, s, true = "see https:", "//www." + word(8) + "com/" + word(12), False
        else:
            before, s, true = f"{rng.choice(['order', 'invoice', 'version'])} ", token(rng.integers(16, 24)), False
        head = f"{word(4)} {word(6)} "
        out.append((f"{head}{before}{s}" + ('"' if before.endswith('"') else "") + f" {word(5)}", len(head + before), len(head + before + s), true))
    return out


def test_the_classifier_against_a_vote_of_the_majority(spark):
    rows = corpus(np.random.default_rng(11), 1600)
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "doc_id long, text string")
    found = {r[0]: {tuple(s.split(":")) for s in r[6].split(",") if s} for r in private_spans(df).collect()}
    counts = {"ours": [0, 0, 0], "majority": [0, 0, 0]}  # right, wrong, missed
    for i, (text, a, b, true) in enumerate(rows):
        voted = {(k, str(x), str(y)) for k, x, y, v in candidates(text, []) if sum(v[: len(LABELERS)]) > 0}
        for name, spans in (("ours", found[i]), ("majority", voted)):
            hit = ("secret", str(a), str(b)) in spans
            counts[name][0] += hit and true
            counts[name][1] += len(spans) - (hit and true)
            counts[name][2] += true and not hit
    precision = {k: c[0] / max(1, c[0] + c[1]) for k, c in counts.items()}
    recall = {k: c[0] / (c[0] + c[2]) for k, c in counts.items()}
    assert precision["ours"] > 0.97 and recall["ours"] > 0.97
    assert precision["ours"] >= precision["majority"] - 0.005 and recall["ours"] >= recall["majority"] - 0.005


def test_secrets_of_any_length_and_without_digits(spark):
    rng = np.random.default_rng(12)
    rows = [r[0] for r in corpus(rng, 600)]
    long = "".join(rng.choice(list("abcdefXYZ0123456789"), 200))
    mine = [f'token="{long}"', "password: hunterCorrectHorseBattery", "password: s3cr3tPass", "die unglichachkeiteinander gehen weiter"]
    df = spark.createDataFrame(list(enumerate([*mine, *rows])), "doc_id long, text string")
    got = {r[0]: r[6] for r in private_spans(df).collect()}
    assert [got[i] for i in range(4)] == ["secret:7:207", "secret:10:35", "secret:10:20", ""]
