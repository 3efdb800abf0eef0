"""License scan by ordered signature rules, with DataFrame functions only.

Rules are a name of a license in a wording, as a regex over the words of a text joined
by single spaces. A rule runs only where its keyword stands in the text, and rules at
all only where a text holds a word of the gate. All detections of a text are ordered by
place; one inside another is suppressed, of equal ones the higher priority
stays, and of two that overlap in part the later goes unless its priority is higher.
Everything is one projection: no join, no shuffle, no Python.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of

# Label, keyword, and how the license is named in lower-case words.
LICENSES = [
    ("mit", "mit", "mit license"),
    ("mit", "mit", "mit"),
    ("apache", "apache", "apache license"),
    ("apache-1.1", "apache", "apache (?:software )?license (?:version |v ?)?1 1"),
    ("apache-2.0", "apache", "apache (?:software )?license (?:version |v ?)?2(?: 0)?"),
    ("apache-2.0", "apache", "apache 2 0(?: license)?"),
    ("gpl", "general", "gnu general public license"),
    ("gpl-1.0", "general", "gnu general public license (?:version |v ?)?1(?: 0)?"),
    ("gpl-2.0", "general", "gnu general public license (?:version |v ?)?2(?: 0)?"),
    ("gpl-3.0", "general", "gnu general public license (?:version |v ?)?3(?: 0)?"),
    ("gpl", "gpl", "gnu gpl"),
    ("gpl-2.0", "gplv2", "(?:gnu )?gplv2"),
    ("gpl-3.0", "gplv3", "(?:gnu )?gplv3"),
    ("gpl-2.0", "gpl", "gpl (?:version |v ?)?2(?: 0)?"),
    ("gpl-3.0", "gpl", "gpl (?:version |v ?)?3(?: 0)?"),
    ("lgpl", "lesser", "gnu lesser general public license"),
    ("lgpl-2.1", "lesser", "gnu lesser general public license (?:version |v ?)?2 1"),
    ("lgpl-3.0", "lesser", "gnu lesser general public license (?:version |v ?)?3(?: 0)?"),
    ("lgpl-2.0", "library", "gnu library general public license(?: (?:version |v ?)?2(?: 0)?)?"),
    ("lgpl", "lgpl", "(?:gnu )?lgpl(?: (?:version |v ?)?[23](?: [01])?)?"),
    ("agpl-3.0", "affero", "gnu affero general public license(?: (?:version |v ?)?3(?: 0)?)?"),
    ("agpl-3.0", "agpl", "(?:gnu )?agpl(?: (?:version |v ?)?3(?: 0)?)?"),
    ("lgpl-2.1", "lgplv2", "(?:gnu )?lgplv2(?: 1)?"),
    ("lgpl-3.0", "lgplv3", "(?:gnu )?lgplv3"),
    ("agpl-3.0", "agplv3", "(?:gnu )?agplv3"),
    ("gfdl", "documentation", "gnu free documentation license(?: (?:version |v ?)?1 [123])?"),
    ("bsd", "bsd", "bsd license"),
    ("bsd-0-clause", "bsd", "(?:zero|0) clause bsd(?: license)?"),
    ("bsd-2-clause", "bsd", "(?:2 clause|two clause|simplified) bsd(?: license)?"),
    ("bsd-2-clause", "bsd", "bsd 2 clause(?: license)?"),
    ("bsd-3-clause", "bsd", "(?:3 clause|three clause|new|modified|revised) bsd(?: license)?"),
    ("bsd-3-clause", "bsd", "bsd 3 clause(?: license)?"),
    ("bsd-4-clause", "bsd", "(?:4 clause|four clause|original) bsd(?: license)?"),
    ("mpl", "mozilla", "mozilla public license"),
    ("mpl-1.1", "mozilla", "mozilla public license (?:version |v ?)?1 1"),
    ("mpl-2.0", "mozilla", "mozilla public license (?:version |v ?)?2 0"),
    ("mpl-2.0", "mpl", "mpl (?:version |v ?)?2 0"),
    ("epl", "eclipse", "eclipse public license"),
    ("epl-1.0", "eclipse", "eclipse public license (?:version |v ?)?1 0"),
    ("epl-2.0", "eclipse", "eclipse public license (?:version |v ?)?2 0"),
    ("cddl-1.0", "cddl", "cddl(?: (?:version |v ?)?1 0)?"),
    ("cddl-1.0", "development", "common development and distribution license(?: (?:version |v ?)?1 0)?"),
    ("cpl-1.0", "common", "common public license(?: (?:version |v ?)?1 0)?"),
    ("artistic-2.0", "artistic", "artistic license(?: (?:version |v ?)?2 0)?"),
    ("boost-1.0", "boost", "boost software license(?: (?:version |v ?)?1 0)?"),
    ("isc", "isc", "isc license"),
    ("zlib", "zlib", "zlib(?: libpng)? license"),
    ("unlicense", "unlicense", "(?:the )?unlicense"),
    ("wtfpl", "wtfpl", "wtfpl(?: (?:version |v ?)?2)?"),
    ("postgresql", "postgresql", "postgresql license"),
    ("psf-2.0", "python", "python software foundation license(?: (?:version |v ?)?2)?"),
    ("php-3.01", "php", "php license(?: (?:version |v ?)?3 01)?"),
    ("openssl", "openssl", "openssl license"),
    ("ofl-1.1", "sil", "sil open font license(?: (?:version |v ?)?1 1)?"),
    ("eupl-1.2", "european", "european union public licen[cs]e(?: (?:version |v ?)?1 [12])?"),
    ("eupl-1.2", "eupl", "eupl(?: (?:version |v ?)?1 [12])?"),
    ("odbl-1.0", "database", "open (?:data commons open )?database license(?: (?:version |v ?)?1 0)?"),
    ("cc0-1.0", "cc0", "cc0(?: 1 0)?(?: universal)?"),
    ("cc-by", "cc", "cc by(?: [1234] [05])?"),
    ("cc-by-sa", "cc", "cc by sa(?: [1234] [05])?"),
    ("cc-by-nc", "cc", "cc by nc(?: [1234] [05])?"),
    ("cc-by-nd", "cc", "cc by nd(?: [1234] [05])?"),
    ("cc-by-nc-sa", "cc", "cc by nc sa(?: [1234] [05])?"),
    ("cc-by-nc-nd", "cc", "cc by nc nd(?: [1234] [05])?"),
    ("cc-by", "attribution", "creative commons attribution(?: [1234] [05])?"),
    ("cc-by-sa", "sharealike", "creative commons attribution sharealike(?: [1234] [05])?"),
    ("cc-by-sa", "alike", "creative commons attribution share alike(?: [1234] [05])?"),
    ("cc-by-nc", "noncommercial", "creative commons attribution noncommercial(?: [1234] [05])?"),
    ("public-domain", "domain", "public domain"),
    ("all-rights-reserved", "reserved", "all rights reserved"),
    ("proprietary", "proprietary", "proprietary(?: and confidential)?"),
]

# Label, keyword, and words of a license's body, header, address or identifier, which count without its name.
SIGNATURES = [
    ("mit", "free of charge", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "copies or substantial portions", "this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "opensource org", "opensource org licenses? mit(?: license)?"),
    ("boost-1.0", "free of charge", "permission is hereby granted free of charge to any person or organization obtaining a copy"),
    ("boost-1.0", "boost org", "boost org license 1 0"),
    ("isc", "without fee", "permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted"),
    ("postgresql", "without fee", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement"),
    ("bsd", "source and binary forms", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "source code must retain", "redistributions of source code must retain the above copyright notice"),
    ("bsd", "binary form must reproduce", "redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3-clause", "endorse or promote", "neither the names? of (?:[^ ]+ ){1,16}may be used to endorse or promote products"),
    ("bsd-3-clause", "opensource org", "opensource org licenses? bsd 3 clause"),
    ("bsd-2-clause", "opensource org", "opensource org licenses? bsd 2 clause"),
    ("bsd-4-clause", "advertising materials", "all advertising materials mentioning features or use of this software must display"),
    ("apache-2.0", "apache org", "apache org licenses? (?:license )?2 0"),
    ("apache-2.0", "agreed to in writing", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("apache-2.0", "contributor hereby grants", "subject to the terms and conditions of this license each contributor hereby grants to you a perpetual worldwide"),
    ("apache", "contributor license agreements", "licensed to the apache software foundation asf under one or more contributor license agreements"),
    ("gpl", "free software", "this program is free software you can redistribute it and or modify it"),
    ("gpl", "verbatim copies", "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed"),
    ("gpl", "share and change", "licenses for most software are designed to take away your freedom to share and change it"),
    ("gpl", "copyleft", "the gnu general public license is a free copyleft license for software and other kinds of works"),
    ("gpl-2.0", "general public license", "gnu general public license as published by the free software foundation (?:either )?version 2"),
    ("gpl-3.0", "general public license", "gnu general public license as published by the free software foundation (?:either )?version 3"),
    ("lgpl", "free software", "this library is free software you can redistribute it and or modify it"),
    ("lgpl-2.1", "general public license", "gnu lesser general public license as published by the free software foundation (?:either )?version 2 1"),
    ("lgpl-3.0", "general public license", "gnu lesser general public license as published by the free software foundation (?:either )?version 3"),
    ("agpl-3.0", "general public license", "gnu affero general public license as published by the free software foundation (?:either )?version 3"),
    ("gpl-2.0", "gpl", "gpl 2 0 (?:only|or later)"),
    ("gpl-3.0", "gpl", "gpl 3 0 (?:only|or later)"),
    ("lgpl-2.1", "lgpl", "lgpl 2 1 (?:only|or later)"),
    ("lgpl-3.0", "lgpl", "lgpl 3 0 (?:only|or later)"),
    ("agpl-3.0", "agpl", "agpl 3 0 (?:only|or later)"),
    ("gfdl", "free documentation license", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("mpl-2.0", "source code form", "this source code form is subject to the terms of the mozilla public license v ?2 0"),
    ("mpl-2.0", "mozilla org", "mozilla org mpl 2 0"),
    ("mpl-1.1", "contents of this file", "the contents of this file are subject to the mozilla public license version 1 1"),
    ("epl", "accompanying materials", "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("cddl-1.0", "contents of this file", "the contents of this file are subject to the terms of the common development and distribution license"),
    ("zlib", "authors be held liable", "this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("zlib", "must not be misrepresented", "the origin of this software must not be misrepresented"),
    ("unlicense", "unencumbered software", "this is free and unencumbered software released into the public domain"),
    ("wtfpl", "you want to", "do what the fuck you want to public license"),
    ("openssl", "openssl toolkit", "this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("cc0-1.0", "related or neighboring rights", "waived all copyright and related or neighboring rights"),
    ("cc0-1.0", "creativecommons org", "creativecommons org publicdomain zero 1 0"),
    *((f"cc-by{k.replace(' ', '-')}", "creativecommons org", f"creativecommons org licenses by{k} [1234] [05]") for k in ("", " sa", " nc", " nd", " nc sa", " nc nd")),
    ("isc", "spdx license identifier", "spdx license identifier isc"),
    ("zlib", "spdx license identifier", "spdx license identifier zlib"),
    ("boost-1.0", "spdx license identifier", "spdx license identifier bsl 1 0"),
    ("epl-1.0", "spdx license identifier", "spdx license identifier epl 1 0"),
    ("epl-2.0", "spdx license identifier", "spdx license identifier epl 2 0"),
    ("bsd-0-clause", "spdx license identifier", "spdx license identifier 0bsd"),
    ("ofl-1.1", "spdx license identifier", "spdx license identifier ofl 1 1"),
    ("artistic-2.0", "spdx license identifier", "spdx license identifier artistic 2 0"),
    ("postgresql", "spdx license identifier", "spdx license identifier postgresql"),
]
SIGNED = ("", "", 100, 5)

# Wording before and after the name, how much it says (of 100), priority.
WORDINGS = [
    ("spdx license identifier ", "", 100, 5),
    ("(?:dual )?licen[cs]ed under (?:the terms of )?(?:the |a |an )?", "(?: licen[cs]e)?", 95, 4),
    ("(?:released|distributed|published|available|covered) under (?:the terms of )?(?:the |a |an )?", "(?: licen[cs]e)?", 90, 4),
    ("under the terms (?:and conditions )?of (?:the |a |an )?", "(?: licen[cs]e)?", 85, 3),
    ("licen[cs]e (?:is |of this work is )?(?:the |a |an )?", "", 70, 2),
]

#: A name by itself counts if it says license or rights, with this much.
BARE = ("", "", 50, 1)

#: What every wording needs one of in a text. A rule that needs none of them is let through by its keyword.
GATE = ["licen", "released under", "distributed under", "published under", "available under", "covered under", "under the terms", "public domain", "all rights reserved"]

# Phrases of the base and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

RULE = "array<struct<id:int,label:string,keyword:string,regex:string,says:int,priority:int>>"


def rules() -> list[dict]:
    """All names in all wordings and all signatures, ordered by priority, then by length: the order decides between equals."""
    out = []

    def add(label: str, keyword: str, name: str, wording: tuple[str, str, int, int]) -> None:
        before, after, says, priority = wording
        out.append({"label": label, "keyword": f" {keyword} ", "regex": f" {before}{name}{after}(?= )", "says": says, "priority": priority})

    for label, keyword, name in LICENSES:
        own = any(g in name.replace("[cs]", "s") for g in ("license", "public domain", "all rights reserved"))
        for wording in [*WORDINGS, *([BARE] if own else [])]:
            add(label, keyword, name, wording)
    for label, keyword, words in SIGNATURES:
        add(label, keyword, words, SIGNED)
    out.sort(key=lambda r: (-r["priority"], -len(r["regex"])))
    return [{"id": i, **r} for i, r in enumerate(out)]


def gate() -> list[str]:
    """Strings of which each text that a rule matches holds one."""
    worded = tuple(f" {before}" for before, *_ in WORDINGS)
    out = list(GATE)
    for r in rules():
        # What a match may leave out does not count.
        sure = re.sub(r"\(\?:[^()]*\)\?", "", r["regex"])
        if not r["regex"].startswith(worded) and not any(g in sure for g in GATE):
            out.append(r["keyword"])
    return sorted(set(out), key=out.index)


def normal(text: Column) -> Column:
    """Words in lower case with one space around each; a single space if there is none."""
    low = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_replace(F.concat(F.lit(" "), low, F.lit(" ")), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")


def spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def places(padded: Column, phrase: str) -> tuple[Column, Column, Column]:
    """How often a phrase stands in a text, and the first word of its first and last place."""
    mark = F.lit(f" {phrase} ")
    has = F.contains(padded, mark)
    count = F.when(has, F.regexp_count(padded, F.lit(f"(?= {phrase} )"))).otherwise(0)
    first = F.when(has, spaces(F.left(padded, F.instr(padded, f" {phrase} ") - 1)))
    from_end = F.instr(F.reverse(padded), f" {phrase} "[::-1])
    last = F.when(has, spaces(F.left(padded, F.length(padded) - from_end + 1 - len(phrase) - 2)))
    return count.cast("long"), first.cast("long"), last.cast("long")


def detections(padded: Column) -> Column:
    """Kept detections: array of (start, end, label, says, rule) in words, end exclusive."""
    table = F.from_json(F.lit(json.dumps(rules())), RULE)
    live = F.filter(table, lambda r: F.contains(padded, r["keyword"]) & F.rlike(padded, r["regex"]))

    def spans(rule: Column) -> Column:
        # The text between the matches and the matches by turns; a match begins at the space before its first word.
        between, found = F.split(padded, rule["regex"], -1), F.regexp_extract_all(padded, rule["regex"], F.lit(0))
        turns = F.arrays_zip(F.slice(between, 1, F.size(found)).alias("b"), found.alias("f"))
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("got"))

        def step(state: Column, turn: Column) -> Column:
            begin = state["at"] + spaces(turn["b"])
            end = begin + spaces(turn["f"])
            return F.struct(end.alias("at"), F.concat(state["got"], F.array(F.struct(begin.cast("int").alias("start"), end.cast("int").alias("end")))).alias("got"))

        def name(span: Column) -> Column:
            return F.struct(span["start"].alias("start"), (-span["end"]).alias("back"), (-rule["priority"]).alias("after"), rule["id"].alias("rule"), rule["label"].alias("label"), rule["says"].alias("says"))

        return F.transform(F.aggregate(turns, start, step)["got"], name)

    # By start, then the longer first, then priority, then the rule's number.
    all_ = F.array_sort(F.flatten(F.transform(live, spans)))
    kind = "array<struct<start:int,end:int,after:int,rule:int,label:string,says:int>>"
    empty = F.array().cast(kind)
    start = F.struct(F.lit(-1).alias("end"), F.lit(0).alias("after"), empty.alias("kept"))

    def keep(state: Column, d: Column) -> Column:
        end = -d["back"]
        good = (d["start"] >= state["end"]) | ((end > state["end"]) & (d["after"] < state["after"]))
        one = F.struct(d["start"].alias("start"), end.alias("end"), d["after"].alias("after"), d["rule"].alias("rule"), d["label"].alias("label"), d["says"].alias("says"))
        taken = F.struct(F.greatest(end, state["end"]).alias("end"), d["after"].alias("after"), F.concat(state["kept"], F.array(one)).alias("kept"))
        return F.when(good, taken).otherwise(state)

    gated = F.lit(False)
    for word in gate():
        gated = gated | F.contains(padded, F.lit(word))
    return F.when(gated, F.aggregate(all_, start, keep)["kept"]).otherwise(empty)


def scan(docs: DataFrame, phrases: dict[str, str] = PHRASES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, and the kept detections of every row.

    A null text has no words. Without a phrase first_word and last_word are null and the
    label columns empty. Score is the most that a kept detection says, 0.5 at least where
    a phrase stands, else 0. Rows that repeat are scanned each; an empty table gives none.
    """
    # The padded text is a column of its own, so that it is made once for each row.
    rows = docs.select("doc_id", normal(text_of(docs)).alias("padded"))
    padded = F.col("padded")
    found = {p: places(padded, p) for p in phrases}
    base = F.array_compact(F.array(*[F.when(F.contains(padded, F.lit(f" {p} ")), F.lit(label)) for p, label in phrases.items()]))
    firsts, lasts = F.array(*[f[1] for f in found.values()]), F.array(*[f[2] for f in found.values()])
    rows = rows.select(
        "doc_id",
        (spaces(padded) - 1).cast("long").alias("n_words"),
        sum((f[0] for f in found.values()), F.lit(0).cast("long")).alias("n_base"),
        F.array_min(firsts).alias("first_word"),
        F.array_max(lasts).alias("last_word"),
        F.array_sort(F.array_distinct(base)).alias("base"),
        detections(padded).alias("detections"),
    )
    labels = F.array_sort(F.array_union("base", F.transform("detections", lambda d: d["label"])))
    says = F.coalesce(F.array_max(F.transform("detections", lambda d: d["says"])), F.lit(0)) / 100.0
    return rows.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        F.greatest(says, F.when(F.size("base") > 0, 0.5).otherwise(0.0)).alias("score"), "detections",
    )
