"""Personal data by weak supervision.

*Base*: e-mail addresses, IP addresses, card and phone numbers by fixed patterns and checks.

*Candidates* of other kinds (secrets, IBANs, social security numbers, hardware addresses) come from wide
patterns. Labelers vote on each: a regex (does the strict shape with its check sum
hold), a gazetteer (does a name of the kind stand before it), the context (is it
assigned or quoted; do words before it say that it is no such thing) and its look (is it
random enough). Spark counts the candidates by votes and look, which has a bounded
number of values; expectation-maximisation estimates from the counts how reliable each
labeler is and how likely each pattern of votes is personal data, and these
likelihoods train a logistic classifier of spans. Spans it accepts are added to the base.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, text_of

BASE_KINDS = ["email", "ip", "card", "phone"]
KINDS = ["secret", "iban", "ssn", "mac"]
LABELERS = ["regex", "gazetteer", "context", "denial", "look"]
#: Rounds of expectation-maximisation and of the classifier's fit; a span counts from this likelihood on.
ROUNDS, STEPS, LEAST = 50, 300, 0.5

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can't begin inside a run of digits, as one that began at the run's first digit would have matched or failed alike.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

# Words that name a kind, and words that deny it.
NAMES = {
    "secret": [
        "token", "tokens", "secret", "secrets", "password", "passwords", "passwd", "passphrase", "passcode", "pwd", "pass", "pin", "apikey", "api_key",
        "api_token", "api_secret", "key", "access_key", "access_token", "refresh_token", "auth_token", "id_token", "session_token", "secret_key",
        "secret_access_key", "private_key", "client_secret", "client_key", "consumer_secret", "encryption_key", "signing_key", "master_key",
        "bearer", "basic", "credential", "credentials", "auth", "authorization", "jwt", "cookie", "session", "sessionid", "hmac", "webhook_secret",
        "db_password", "database_password", "root_password", "admin_password", "user_password", "login", "passwort", "kennwort", "contraseña", "clave", "motdepasse",
    ],
    "iban": ["iban", "account", "acct", "konto", "kontonummer", "cuenta", "compte", "conto", "rekening", "bank", "bankverbindung", "bic", "swift", "sepa", "transfer", "payee", "beneficiary", "überweisung"],
    "ssn": ["ssn", "ssns", "social", "security", "socialsecurity", "taxpayer", "tin", "itin", "tax", "w2", "dependent", "beneficiary"],
    "mac": ["mac", "macaddr", "macaddress", "hwaddr", "hardware", "ethernet", "ether", "device", "bssid", "wifi", "wlan", "nic", "interface", "lladdr", "bluetooth", "adapter", "eth0", "wlan0"],
}
DENIALS = [
    "sha", "sha1", "sha224", "sha256", "sha384", "sha512", "md5", "crc", "crc32", "checksum", "checksums", "commit", "commits", "revision", "digest", "hash", "integrity",
    "isbn", "issn", "doi", "ean", "version", "release", "build", "example", "sample", "dummy", "placeholder", "order", "invoice", "ticket", "case", "serial", "part",
    "sku", "etag", "uuid", "guid", "http", "https", "ftp", "url", "path", "file", "filename", "class", "package", "import",
]
CANDIDATES = {
    "secret": re.compile(r"(?<![A-Za-z0-9_+/=-])[A-Za-z0-9_+/-]{16,}"),
    "iban": re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    "ssn": re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "mac": re.compile(r"(?<![0-9A-Za-z:-])[0-9A-Fa-f]{2}(?:[:-][0-9A-Fa-f]{2}){5}(?![0-9A-Za-z:-])"),
}
# What a name of a secret is set to may be of any length from six characters on.
ASSIGNED = re.compile(r"(?i)(?:token|secret|password|passwd|pwd|key|credentials?)[\"']?[ ]?[=:][ ]?[\"']?([^\s\"',;<>]{6,})")
WORDS_BEFORE = re.compile(r"[A-Za-z0-9_]+")


# Base


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches in one pass: an address begins at the first character of its run behind the last match."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            done = m.end()
            at = text.find("@", done)
        else:
            at = text.find("@", at + 1)
    return out


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    out = {k: [] for k in BASE_KINDS}
    if "@" in text:
        out["email"] = emails(text)
    if DIGIT.search(text):
        if "." in text:
            out["ip"] = [m.span() for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
        for m in CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out["card"].append(m.span())
        if "+" in text:
            out["phone"] = [m.span() for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m.group()) <= 15]
    return out


# Candidates and their votes


def entropy(s: str) -> float:
    return -sum(c / len(s) * math.log2(c / len(s)) for c in map(s.count, set(s)))


def strict(kind: str, s: str) -> int:
    """The regex labeler: 1 the shape and its check hold, -1 they don't, 0 no opinion."""
    if kind == "secret":
        if re.fullmatch(r"(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64}|AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9-]{20,})", s):
            return 1
        return 0 if any(c.isdigit() for c in s) and any(c.isalpha() for c in s) else -1
    if kind == "iban":
        plain = s.replace(" ", "")
        number = "".join(str(int(c, 36)) for c in plain[4:] + plain[:4])
        return 1 if int(number) % 97 == 1 else -1
    if kind == "ssn":
        return -1 if s[:3] in ("000", "666") or s[0] == "9" or s[4:6] == "00" or s[7:] == "0000" else 1
    return -1 if len({*s[2::3]}) > 1 else 1


def look(s: str) -> int:
    """0 ... 3 by how even its characters are."""
    return min(3, int(entropy(s.lower())))


def votes(kind: str, text: str, start: int, end: int) -> tuple[int, ...]:
    """One vote of each of `LABELERS`: 1 for, -1 against, 0 none."""
    s, before = text[start:end], text[max(0, start - 40) : start]
    words = [w.lower() for w in WORDS_BEFORE.findall(before)[-3:]]
    assigned = before.rstrip().endswith(("=", ":")) or before.rstrip("\"'").rstrip().endswith(("=", ":"))
    quoted = before[-1:] in ("'", '"') and text[end : end + 1] == before[-1:]
    return (
        strict(kind, s),
        1 if any(w in NAMES[kind] for w in words) else 0,
        1 if assigned else (0 if quoted else -1),
        -1 if any(w in DENIALS for w in words) else 0,
        1 if look(s) >= 3 else (-1 if look(s) <= 1 else 0),
    )


def candidates(text: str, taken: list[tuple[int, int]]) -> list[tuple[str, int, int, tuple[int, ...]]]:
    """(kind, start, end, votes, look and length class) of wide matches of any length that meet no span of ``taken``."""
    out: list[tuple[str, int, int, tuple[int, ...]]] = []

    def add(kind: str, a: int, b: int) -> None:
        if any(a < y and x < b for x, y in taken) or any(a < y and x < b for _, x, y, _ in out):
            return
        out.append((kind, a, b, (*votes(kind, text, a, b), look(text[a:b]), min(3, (b - a) // 16))))

    # The narrow kinds first: a secret is what no other kind explains.
    if DIGIT.search(text):
        for kind in ("iban", "ssn", "mac"):
            for m in CANDIDATES[kind].finditer(text):
                add(kind, *m.span())
    if "=" in text or ":" in text:
        for m in ASSIGNED.finditer(text):
            add("secret", *m.span(1))
    for m in CANDIDATES["secret"].finditer(text):
        if not m.group().isdigit():  # a bare number
            add("secret", *m.span())
    return out


# Reliabilities and the classifier


def reliabilities(table: list[tuple[str, tuple[int, ...], int]], rounds: int = ROUNDS) -> np.ndarray:
    """Likelihood of each row (kind, votes, count) to be personal data, by expectation-maximisation.

    Each labeler has, for true and false candidates, a chance of each vote; each kind
    has a share of true ones. It starts from the mean vote, and every chance from a
    labeler that is better than none.
    """
    marks = np.array([v for _, v, _ in table], int).reshape(len(table), -1)
    count = np.array([c for _, _, c in table], float)
    kinds = sorted({k for k, _, _ in table})
    kind = np.array([kinds.index(k) for k, _, _ in table])
    n = marks.shape[1]
    true = np.clip(0.5 + 0.4 * np.sign(marks.sum(axis=1)), 0.05, 0.95)
    for _ in range(rounds):
        share = np.array([((true * count)[kind == k].sum() + 1) / (count[kind == k].sum() + 2) for k in range(len(kinds))])
        log = np.stack([np.log(1 - share[kind]), np.log(share[kind])])
        for j in range(n):
            for side, weight in enumerate((1 - true, true)):
                # The prior counts say that a vote is more often right than wrong.
                prior = np.array([4.0, 2.0, 1.0]) if side == 0 else np.array([1.0, 2.0, 4.0])
                chance = np.array([(weight * count)[marks[:, j] == v].sum() for v in (-1, 0, 1)]) + prior
                log[side] += np.log(chance / chance.sum())[marks[:, j] + 1]
        true = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
    return true


def features(kind: str, cell: tuple[int, ...]) -> np.ndarray:
    """What the classifier sees: the kind, each vote, the look and the length class."""
    out = [1.0] + [float(kind == k) for k in KINDS]
    for v in cell[: len(LABELERS)]:
        out += [float(v == -1), float(v == 1)]
    return np.array(out + [float(cell[-2] == i) for i in range(4)] + [float(cell[-1] == i) for i in range(4)])


def train(table: list[tuple[str, tuple[int, ...], int]], steps: int = STEPS) -> list[float]:
    """Weights of a logistic classifier of the likelihoods that expectation-maximisation gives."""
    if not table:
        return []
    target = reliabilities([(k, c[: len(LABELERS)], n) for k, c, n in table])
    x = np.stack([features(k, c) for k, c, _ in table])
    weight = np.array([n for _, _, n in table], float)
    weight /= weight.sum()
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        gradient = x.T @ (weight * (p - target)) + 1e-4 * w
        second = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + 1e-4 * np.eye(len(w))
        move = np.linalg.solve(second, gradient)
        w -= move
        if np.abs(move).max() < 1e-9:
            break
    return w.tolist()


def likelihood(weights: list[float], kind: str, cell: tuple[int, ...]) -> float:
    if not weights:
        return 0.0
    return 1 / (1 + math.exp(-max(-50.0, min(50.0, float(np.dot(weights, features(kind, cell)))))))


# The job


def cells(text: Column) -> Column:
    """Votes and look of all candidates of a text, as ``kind:cell`` strings."""

    @F.arrow_udf("array<string>")
    def run(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts.to_pylist():
            found = candidates(t, [s for spans in base_spans(t).values() for s in spans]) if t else []
            out.append([f"{k}:{','.join(map(str, c))}" for k, _, _, c in found])
        return pa.array(out, pa.list_(pa.string()))

    return run(text)


def train_spans(docs: DataFrame, rounds: int = ROUNDS) -> list[float]:
    """The classifier's weights from all of ``docs``. The driver gets a count for each cell: fewer than 20 000 are possible."""
    ship(docs.sparkSession)
    found = docs.select(F.explode(cells(text_of(docs))).alias("cell")).groupBy("cell").agg(F.count("*").alias("n"))
    table = []
    for r in found.orderBy("cell").collect():
        kind, _, cell = r["cell"].partition(":")
        table.append((kind, tuple(map(int, cell.split(","))), r["n"]))
    return train(table)


RESULT = "struct<n_email:long,n_ip:long,n_card:long,n_phone:long,base_sha256:string,spans:string>"


def joined(spans: dict[str, list[tuple[int, int]]], kinds: list[str]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in sorted(spans.get(k, ())))


def spans_of(text: str, weights: list[float], least: float = LEAST) -> dict[str, list[tuple[int, int]]]:
    """Base spans, and the candidates that the classifier accepts, by kind."""
    spans = base_spans(text)
    known: dict[tuple, bool] = {}
    for kind, a, b, cell in candidates(text, [s for v in spans.values() for s in v]):
        if (kind, cell) not in known:
            known[kind, cell] = likelihood(weights, kind, cell) >= least
        if known[kind, cell]:
            spans.setdefault(kind, []).append((a, b))
    return spans


def private_spans(docs: DataFrame, weights: list[float] | None = None, least: float = LEAST) -> DataFrame:
    """doc_id, counts and digest of the base, and all spans of every row.

    Spans are ``kind:start:end`` in code points, the end exclusive, base kinds first. A
    null text is empty and has none. Without weights the classifier is trained on ``docs``
    itself; without any candidate nothing is added. An empty table gives no rows.
    """
    ship(docs.sparkSession)
    if weights is None:
        weights = train_spans(docs)

    @F.arrow_udf(RESULT)
    def run(texts: pa.Array) -> pa.Array:
        rows = []
        for t in texts.to_pylist():
            spans = spans_of(t, weights, least) if t else {}
            base = joined(spans, BASE_KINDS)
            rows.append((*(len(spans.get(k, ())) for k in BASE_KINDS), hashlib.sha256(base.encode()).hexdigest(), joined(spans, BASE_KINDS + KINDS)))
        columns = list(zip(*rows)) or [()] * 6
        names = [f"n_{k}" for k in BASE_KINDS] + ["base_sha256", "spans"]
        return pa.StructArray.from_arrays([pa.array(c, pa.int64() if i < 4 else pa.string()) for i, c in enumerate(columns)], names=names)

    return docs.select("doc_id", run(text_of(docs)).alias("found")).select("doc_id", "found.*")
