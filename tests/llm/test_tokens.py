import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from scorelake.llm.packing import best_fit, cut, pack
from scorelake.llm.patched_ids import pack_block, read_ids, token_ids, unpack_block, write_ids
from scorelake.llm.tokens import encode, pieces_of, tokenizer_path

TOKENIZER = Tokenizer.from_file(tokenizer_path())


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [2]


def test_pieces_equal_the_whole_text():
    random.seed(3)
    parts = [" ", "  ", "\n", "\t", "a", "word", "It's", ".", "...", ",", "12", "é", "İ", "中文", "\x00", "\x1c",
             " ", "\x85", "<|endoftext|>", "'ll", "é.", "_.", "½.", "x."]
    known = pieces_of(tokenizer_path())
    assert known.byte_level
    for _ in range(3000):
        text = "".join(random.choice(parts) for _ in range(random.randint(0, 12)))
        assert np.frombuffer(encode(text, known), "<u4").tolist() == ids_of(text), repr(text)


def test_a_tokenizer_of_another_kind_gets_whole_texts():
    other = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    known = pieces_of(tokenizer_path("word_bpe_49k.json"))
    assert not known.byte_level
    for text in ("A few  words, and\nIT'S more.", "x", " y"):
        assert np.frombuffer(encode(text, known, None), "<u4").tolist() == other.encode(text, add_special_tokens=False).ids


def test_letters_of_many_kinds():
    known = pieces_of(tokenizer_path())
    for text in ("Straße naïve", "éÉèç ñandú ŒUVRE", "Ωmega мир", "ǅ ɐ a\u0301", "ªº aª"):
        assert np.frombuffer(encode(text, known), "<u4").tolist() == ids_of(text), text


@pytest.mark.parametrize("top", [1, 2, 300, 50_000, 2**32])
def test_blocks_round_trip(top):
    rng = np.random.default_rng(top)
    for n in (1, 2, 1000, 1024):
        ids = rng.integers(0, top, n, dtype=np.uint64).astype("<u4")
        ids[rng.integers(0, n)] = 2**32 - 1
        assert unpack_block(pack_block(ids)).tolist() == ids.tolist()


def check_ids(df, rows):
    got = [tuple(r) for r in df.select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
    want, start = {}, 0
    for r in rows:
        ids = ids_of(r["text"])
        want.setdefault(r["doc_id"], []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert sorted((r[0] is not None, r[0] or 0, r[2], r[3]) for r in got) == sorted((d is not None, d or 0, *x) for d, v in want.items() for x in v)
    for doc_id, begin, n, _ in sorted(got, key=lambda r: r[1]):
        assert begin == start
        start += n
    order = [r[0] for r in sorted(got, key=lambda r: r[1])]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))


def test_token_ids(spark, docs, edge, none):
    check_ids(token_ids(docs), docs.collect())
    check_ids(token_ids(edge), edge.collect())
    assert token_ids(none).collect() == []


def test_files_are_read_by_themselves(spark, docs, tmp_path):
    files = write_ids(docs, str(tmp_path / "ids"))
    assert {p.name for p in (tmp_path / "ids").iterdir()} == {r["file"] for r in files.collect()}
    check_ids(read_ids(files, f"file://{tmp_path}/ids"), docs.collect())


def check_pack(df, rows, size=1024):
    got = df.collect()
    want = []
    for r in rows:
        ids = np.array(ids_of(r["text"]), "<u4")
        want += [(r["doc_id"], k, s, n, zlib.crc32(ids[s : s + n].tobytes())) for k, (s, n) in enumerate(cut(len(ids), size))]
    key = lambda x: tuple((v is not None, v or 0) for v in x)
    assert sorted((tuple(r[:5]) for r in got), key=key) == sorted(want, key=key)
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n
        assert at <= size
    return len(bins), sum(r["length"] for r in got)


def test_pack(docs, edge, none):
    n, total = check_pack(pack(docs), docs.collect())
    assert n <= -(-total // 1024) * 1.02 + 1
    check_pack(pack(edge), edge.collect())
    assert pack(none).collect() == []
    check_pack(pack(docs, size=100), docs.collect(), 100)


def test_every_capacity_holds():
    random.seed(1)
    counts = {n: random.randint(1, 50) for n in random.sample(range(1, 1000), 200)}
    for score in ("norm", "dot"):
        for capacity in [(1024, 1024, 1024**2), (1024, 3, 1024**2), (1024, 1024, 998001)]:
            bins = best_fit(counts, capacity, score)
            have = {}
            for b in bins:
                assert sum(b.lengths) <= capacity[0] and len(b.lengths) <= capacity[1] and sum(n * n for n in b.lengths) <= capacity[2]
                for n in b.lengths:
                    have[n] = have.get(n, 0) + b.many
            assert have == counts
    with pytest.raises(ValueError):
        best_fit({5: 1}, (4, 9, 99))
    assert best_fit({}, (4, 9, 99)) == []
