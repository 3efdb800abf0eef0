import random
import re

from scorelake.llm.license_rules import PHRASES, WORDINGS, rules, scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def base(text):
    words = WORD.findall((text or "").translate(LOWER))
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        parts = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
        places += at
        labels |= {label} if at else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def kept(text):
    """Detections by Python's regexes and the plain rule."""
    padded = " " + " ".join(WORD.findall((text or "").translate(LOWER))) + " "
    found = []
    for r in rules():
        if r["keyword"] in padded:
            for m in re.finditer(r["regex"], padded):
                start = padded[: m.start()].count(" ")
                found.append((start, -(start + m.group().count(" ")), -r["priority"], r["id"], r["label"]))
    out, end, priority = [], -1, 0
    for start, back, after, rule, label in sorted(found):
        if start >= end or (-back > end and after < priority):
            out.append((start, -back, rule, label))
            end, priority = max(end, -back), after
    return out


def texts(seed):
    rng = random.Random(seed)
    names = ["MIT License", "the Apache License, Version 2.0", "GNU General Public License, version 3", "CC BY-NC 4.0", "3-clause BSD", "mit",
             "General Public License", "MPL 2.0", "public domain", "GNU Lesser General Public License v2.1", "Mozilla Public License"]
    verbs = ["licensed under", "Released under the", "distributed under the terms of", "SPDX-License-Identifier:", "the license is", "", "under the terms of the"]
    words = ["a", "licence", "license", "Ünder", "x", "mit", "apache", "general public", "K"]
    out = [None, "", " .,;", "mit license", "mit license mit license mit license", "MIT-LICENSE", "mİt license", "xmit license", "license"]
    for _ in range(80):
        parts = []
        for _ in range(rng.randint(0, 6)):
            parts += [rng.choice(words) for _ in range(rng.randint(0, 5))] + [rng.choice(verbs), rng.choice(names)]
        out.append(rng.choice([" ", "\n", ", "]).join(parts))
    return out


def check(df, rows):
    got = sorted(map(tuple, df.collect()), key=repr)
    want = []
    for doc_id, text in rows:
        n, k, first, last, labels = base(text)
        own = kept(text)
        says = {r["id"]: r["says"] for r in rules()}
        score = max([says[r] / 100 for _, _, r, _ in own] + [0.5 if k else 0.0])
        union = ",".join(sorted({x for _, _, _, x in own} | set(filter(None, labels.split(",")))))
        want.append((doc_id, n, k, first, last, labels, union, score))
    assert got == sorted(want, key=repr)


def test_against_brute_force(spark):
    rows = list(enumerate(texts(1)))
    df = scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    check(df.drop("detections"), rows)
    got = {r["doc_id"]: [(d["start"], d["end"], d["rule"], d["label"]) for d in r["detections"]] for r in df.collect()}
    for i, text in rows:
        assert got[i] == kept(text), text


def test_documents(docs):
    check(scan(docs).drop("detections"), [(r["doc_id"], r["text"]) for r in docs.collect()])


def test_edge_rows(edge, none):
    check(scan(edge).drop("detections"), [(r["doc_id"], r["text"]) for r in edge.collect()])
    assert scan(none).collect() == []


def test_specific_rules_win(spark):
    df = spark.createDataFrame([(1, "Licensed under the Apache License, Version 2.0, and GPLv3 license")], "doc_id long, text string")
    row = scan(df).first()
    assert row["labels"].split(",")[:2] == ["apache", "apache-2.0"] and row["base_labels"] == "apache" and row["score"] == 0.95
    assert len(rules()) >= 200 and len({r["id"] for r in rules()}) == len(rules()) and len(WORDINGS) == 5


def test_no_python_and_no_shuffle(docs):
    plan = scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Exchange|Join", plan)


def test_bodies_headers_and_versions_without_a_gate_word(spark):
    from scorelake.llm.license_rules import SIGNATURES

    cases = [
        ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "mit"),
        ("Redistribution and use in source and binary forms, with or without modification, are permitted provided", "bsd"),
        ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products", "bsd-3-clause"),
        ("Apache License v2.0", "apache-2.0"),
        ("licensed under GPL v3", "gpl-3.0"),
        ("BSD 3-Clause", "bsd-3-clause"),
        ("see Apache 2.0 here", "apache-2.0"),
        ("SPDX-License-Identifier: ISC", "isc"),
    ]
    plain = [(re.sub(r"\(\?:[^()]*\)\?|\?", "", w.replace("(?:[^ ]+ ){1,16}", "x ").replace("(?:only|or later)", "only").replace("[1234] [05]", "4 0")), label) for label, _, w in SIGNATURES]
    rows = [(i, t) for i, (t, _) in enumerate([*cases, *plain])]
    df = scan(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r["doc_id"]: r["labels"].split(",") for r in df.collect()}
    missing = [(t, label, got[i]) for i, (t, label) in enumerate(cases) if label not in got[i]]
    assert not missing
    check(df.drop("detections"), rows)
    # Every signature is found by itself or lies in a longer one.
    assert all(any(got[len(cases) + i]) for i in range(len(plain)))
