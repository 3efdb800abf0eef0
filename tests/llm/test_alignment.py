import hashlib
import random
from collections import Counter

import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from scorelake.llm.alignment import DEFAULT_OTHER, AlignedPieces, Vocabularies, align, aligned, aligned_pieces
from scorelake.llm.tokens import tokenizer_path

A = Tokenizer.from_file(tokenizer_path())
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(DEFAULT_OTHER))
KNOWN = Vocabularies(tokenizer_path(), tokenizer_path(DEFAULT_OTHER))


def plain(text):
    """Tokens, groups, digest and links of one text, from whole texts and every pair of neighbours."""
    none = (0, 0, 0, ""), []
    if not text:
        return none
    raw = (" " + text).encode()
    ids = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    spans = []
    for tokens, known in zip(ids, (KNOWN.one_bytes, KNOWN.other_bytes)):
        if b"".join(known[t] for t in tokens) != raw:
            return none
        at, out = 0, []
        for t in tokens:
            out.append((at, at + len(known[t]), t))
            at += len(known[t])
        spans.append(out)
    links, k = [], 0
    for begin, end, a in spans[0]:
        while spans[1][k][1] <= begin:
            k += 1
        j = k
        while j < len(spans[1]) and spans[1][j][0] < end:
            links.append((a, spans[1][j][2]))
            j += 1
    common = {e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]}
    written = []
    for side in spans:
        groups, now = [], []
        for _, end, t in side:
            now.append(str(t))
            if end in common:
                groups.append(",".join(now))
                now = []
        written.append(groups)
    joined = ";".join(f"{a}|{b}" for a, b in zip(*written))
    return (len(ids[0]), len(ids[1]), len(common), hashlib.sha256(joined.encode()).hexdigest()), links


def brute(rows):
    found = [(d, *plain(t)) for d, t in rows]
    counts = Counter(pair for _, _, links in found for pair in set(links))
    best = {}
    for (a, _), n in counts.items():
        best[a] = max(best.get(a, 0), n)
    return [(d, *s[:3], len(links), sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links), s[3]) for d, s, links in found]


def check(df, rows):
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    assert sorted((tuple(r) for r in df.collect()), key=key) == sorted(brute(rows), key=key)


def test_documents(docs):
    check(align(docs), [(r["doc_id"], r["text"]) for r in docs.collect()])


def test_edges(spark, edge, none):
    check(align(edge), [(r["doc_id"], r["text"]) for r in edge.where("doc_id is null or doc_id != 6").collect()] + [(6, "word " * 40_000 + "end")])
    assert align(none).collect() == []
    texts = ["x ▁y", "▁", "<|endoftext|> <s> </s> <unk>", " ", "  ", "ﬁ", "é", "中文。 好", "a\x00b", "\n\n a\tb", None, "", "<0x0A>", "the the the", "aaa aaaa a a"]
    rows = list(enumerate(texts)) * 2
    check(align(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)), rows)


def test_pieces_equal_whole_texts():
    random.seed(4)
    parts = [" ", "  ", "\n", "\t", "a", "word", "It's", ".", "...", ",", "12", "é", "İ", "中文", "\x00", "\x1c",
             " ", "\x85", "<|endoftext|>", "'ll", "é.", "_.", "½.", "x.", "▁", "<0x0A>", "ﬁ", "--", "A"]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 12))) for _ in range(1500)]
    pieces = aligned_pieces(tokenizer_path(), tokenizer_path(DEFAULT_OTHER))
    sums, digests, owner, links = aligned(pa.array(texts, pa.string()), pieces)
    for i, text in enumerate(texts):
        facts, want = plain(text)
        assert (*sums[i, :3].tolist(), digests[i]) == facts, repr(text)
        assert sorted(links[owner == i].tolist()) == sorted(a * KNOWN.others + b for a, b in want)


def test_pieces_forgotten_in_between(monkeypatch, docs):
    pieces = aligned_pieces(tokenizer_path(), tokenizer_path(DEFAULT_OTHER))
    monkeypatch.setattr(pieces, "most", 50)
    for r in docs.limit(30).collect():
        sums, digests, _, _ = aligned(pa.array([r["text"]], pa.string()), pieces)
        assert (*sums[0, :3].tolist(), digests[0]) == plain(r["text"])[0]


@pytest.mark.parametrize("token", [" the", "a", "\n", "ing"])
def test_the_identity_map(token):
    a = A.encode(token, add_special_tokens=False).ids
    if len(a) == 1 and KNOWN.same[a[0]] >= 0:
        assert KNOWN.other_bytes[KNOWN.same[a[0]]] == token.encode() == KNOWN.one_bytes[a[0]]


def test_new_pieces_are_encoded_a_few_at_a_time(monkeypatch):
    """However many different pieces a batch has, only some of them are Python objects at once."""
    pieces = AlignedPieces(KNOWN)
    sizes, encode = [], pieces.encode_new
    monkeypatch.setattr("scorelake.llm.tokens.NEW_PIECES", 7)
    monkeypatch.setattr(pieces, "encode_new", lambda new: sizes.append(len(new)) or encode(new))
    texts = ["one two three four five six seven eight nine ten", "", None, "eleven two twelve", "\ue000 x", "zwölf 13!"]
    sums, digests, owner, links = aligned(pa.array(texts, pa.string()), pieces)
    assert len(sizes) > 1 and max(sizes) <= 7
    for i, text in enumerate(texts):
        facts, want = plain(text)
        assert (*sums[i, :3].tolist(), digests[i]) == facts
        assert sorted(links[owner == i].tolist()) == sorted(a * KNOWN.others + b for a, b in want)
