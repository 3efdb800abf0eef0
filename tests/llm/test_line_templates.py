import random
import re

from scorelake.llm.line_templates import drop_lines, dropped_lines, without_repeats

SPACE = " \t\x0b\x0c\r"


def keys(line):
    line = re.sub(r"(?<!\S)[^\s0-9]*[0-9]\S*", "<*>", line, flags=re.ASCII)
    tokens = [t for t in re.split(r"[ \t\x0b\x0c\r]+", line) if t]
    n = len(tokens)
    if n < 4:
        return []
    leaf, third = (n, *tokens[:3]), n // 3
    parts = [tuple(tokens[:third]), tuple(tokens[third : 2 * third]), tuple(tokens[2 * third :])]
    out = [(leaf, 0, *parts)]
    if n >= 9:
        out += [(leaf, i + 1, *(p for j, p in enumerate(parts) if j != i)) for i in range(3)]
    return out


def brute(rows):
    first, docs = {}, {}
    for doc_id, text in rows:
        at = (doc_id is not None, doc_id or 0)
        for line in (text or "").split("\n"):
            for k in keys(line):
                first[k] = min(first.get(k, at), at)
                docs.setdefault(k, set()).add(at)
    out = []
    for doc_id, text in rows:
        if text is None:
            out.append((doc_id, None, 0, 0))
            continue
        at = (doc_id is not None, doc_id or 0)
        lines = text.split("\n")
        kept = [x for x in lines if not any(len(docs[k]) > 1 and first[k] < at for k in keys(x))]
        out.append((doc_id, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "", *r[2:]))


def check(df):
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    got = [tuple(r) for r in dropped_lines(df).select("doc_id", "text", "n_lines", "n_dropped").collect()]
    assert order(got) == order(brute(rows))
    return got


def test_documents(docs):
    assert sum(r[3] for r in check(docs)) > 0


def test_edge_rows(edge, none):
    check(edge)
    assert dropped_lines(none).collect() == []
    clash = edge.withColumnRenamed("length", "n_lines")
    assert drop_lines(clash).columns == clash.columns
    assert drop_lines(none).columns == none.columns
    assert without_repeats(clash).columns == [*clash.columns, "n_dropped"]


def test_templates(spark):
    rng = random.Random(2)
    words = [f"{a}{b}" for a in "abcdefgh" for b in "xyz"]
    stems = [[rng.choice(words) for _ in range(rng.randint(4, 30))] for _ in range(8)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.randint(0, 8)):
            stem = list(rng.choice(stems))
            for _ in range(rng.choice([0, 0, 1, 2])):
                stem[rng.randrange(len(stem))] = rng.choice([*words, str(rng.randint(0, 99)), "v1.2"])
            lines.append(rng.choice(["", " "]) + rng.choice([" ", "  "]).join(stem))
            lines.append(rng.choice(["", "ab", " \t"]))
        rows.append((i % 50, "\n".join(lines)))
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))


def test_n_chars_follows_the_text(spark):
    line = "this is a line that comes again and again here"
    df = spark.createDataFrame([(1, line, 46), (2, f"own words\n{line} now", 60), (3, f"é\n{line}", 48)], "doc_id long, text string, n_chars long")
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in drop_lines(df).collect()}
    assert got == {1: (line, 46), 2: (f"own words\n{line} now", 60), 3: ("é", 1)}


def test_no_python_on_the_way(docs):
    plan = drop_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
