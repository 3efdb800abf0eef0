"""Token occurrences of two public tokenizers aligned by byte ranges, with corpus-wide counts of linked ids.

A is a byte-level BPE on a space and the text, B a sentencepiece model, which adds the
space itself. Both are cut where neither lets a token pass, every different piece of a
batch is encoded and aligned once, and a text is its pieces in a row. Two partitions of the same
bytes that share no inner end overlap in as many pairs as there are ends,
so every end of a token is one link.

Most groups are one A token on the B token of the same bytes. An array from A id to
that B id is made from the two vocabularies; links of that kind are counted in vectors as long as the
vocabulary, one for each task. Only other pairs enter the shuffle, and of these each block of documents sends
and looks up a pair once.
"""

from __future__ import annotations

import hashlib
import itertools
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import block_numbers, looked_up, placed
from .common import buffers, kept, ship, stored
from .tokens import DEFAULT_TOKENIZER, KEPT_PIECES, Pieces, Ragged, byte_alphabet, cut_pieces, larger, load_tokenizer, numbered, tokenizer_path

DEFAULT_OTHER = "piece_bpe_32k.model"
SPACE_MARK = "▁"
#: A character that no piece of the other tokenizer joins to another one.
LONE = "\n"


class Vocabularies:
    """Both tokenizers, the bytes of all their tokens, and the B id of the same bytes as each A id (-1: none)."""

    def __init__(self, path: str, other: str):
        import sentencepiece

        self.one = load_tokenizer(path)
        self.one.encode_special_tokens = True
        self.other = sentencepiece.SentencePieceProcessor(model_file=other)
        back = {ord(c): b for b, c in byte_alphabet().items()}
        entries = self.one.get_vocab(with_added_tokens=True)
        self.one_bytes = [b""] * (max(entries.values()) + 1)
        for token, i in entries.items():
            codes = [back.get(ord(c)) for c in token]
            self.one_bytes[i] = token.encode() if None in codes else bytes(codes)
        n = self.other.vocab_size()
        names = self.other.id_to_piece(list(range(n)))
        self.other_bytes = [b""] * n
        same: dict[bytes, int] = {}
        #: Last byte of a character and first byte of the next one, where a piece holds them in a row.
        self.joined = np.zeros((256, 256), bool)
        plain = [i for i in range(n) if not (self.other.is_byte(i) or self.other.is_control(i) or self.other.is_unknown(i))]
        for i in plain:
            letters = [c.encode() for c in names[i].replace(SPACE_MARK, " ")]
            self.other_bytes[i] = b"".join(letters)
            same.setdefault(self.other_bytes[i], i)
            for a, b in itertools.pairwise(letters):
                self.joined[a[-1], b[0]] = True
        for i in range(n):
            if self.other.is_byte(i):
                self.other_bytes[i] = bytes([int(names[i][3:5], 16)])
                same.setdefault(self.other_bytes[i], i)
        if self.joined[ord(LONE)].any():
            raise ValueError("a piece holds a line feed followed by another character")
        self.same = np.array([same.get(b, -1) if b else -1 for b in self.one_bytes], np.int64)
        self.one_sizes = np.array([len(b) for b in self.one_bytes], np.int64)
        self.other_sizes = np.array([len(b) for b in self.other_bytes], np.int64)
        self.others = n
        self.first = len(self.other.encode(LONE))


class AlignedPieces(Pieces):
    """Pieces with their tokens of both kinds, groups and links, encoded and aligned once each."""

    def __init__(self, known: Vocabularies):
        self.known_tokens = known
        super().__init__(known.one)
        self.most = KEPT_PIECES // 2
        if not self.byte_level:
            raise ValueError("the first tokenizer must be a byte-level BPE")

    def clear(self) -> None:
        super().clear()
        #: a * B's size + b of every link, the written groups, and of each piece: A tokens, B tokens, groups (-1: bytes differ).
        self.links, self.groups, self.sizes = Ragged(np.int64), [], [np.zeros((0, 3), np.int64)]

    def encode_new(self, pieces: list[str]) -> list[list[int]]:
        known = self.known_tokens
        ones = super().encode_new(pieces)
        others = [ids[known.first :] for ids in known.other.encode([LONE + p for p in pieces], num_threads=1)]
        good = [
            b"".join(map(known.one_bytes.__getitem__, a)) == raw and b"".join(map(known.other_bytes.__getitem__, b)) == raw
            for a, b, raw in zip(ones, others, map(str.encode, pieces))
        ]
        left = [a if ok else [] for a, ok in zip(ones, good)]
        right = [b if ok else [] for b, ok in zip(others, good)]
        n_a, n_b = (np.fromiter(map(len, rows), np.int64, len(rows)) for rows in (left, right))
        a = np.fromiter(itertools.chain.from_iterable(left), np.int64, n_a.sum())
        b = np.fromiter(itertools.chain.from_iterable(right), np.int64, n_b.sum())
        a_ends, b_ends = np.cumsum(known.one_sizes[a]), np.cumsum(known.other_sizes[b])
        # All pieces in a row: both kinds end at the end of every piece, so no group goes over it.
        ends = np.union1d(a_ends, b_ends)
        at_a, at_b = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
        links = a[at_a] * known.others + b[at_b] if len(ends) else ends
        common = np.intersect1d(a_ends, b_ends, assume_unique=True)
        piece = np.repeat(np.arange(len(pieces)), n_a)
        per_link = np.bincount(piece[at_a], minlength=len(pieces)) if len(ends) else np.zeros(len(pieces), np.int64)
        last_a, last_b = np.searchsorted(a_ends, common) + 1, np.searchsorted(b_ends, common) + 1
        per_group = np.bincount(piece[last_a - 1], minlength=len(pieces)) if len(common) else np.zeros(len(pieces), np.int64)
        written, names_a, names_b, begin_a, begin_b = [], list(map(str, a.tolist())), list(map(str, b.tolist())), 0, 0
        for end_a, end_b in zip(last_a.tolist(), last_b.tolist()):
            written.append(",".join(names_a[begin_a:end_a]) + "|" + ",".join(names_b[begin_b:end_b]))
            begin_a, begin_b = end_a, end_b
        done = np.concatenate([[0], np.cumsum(per_group)]).tolist()
        self.groups += [";".join(written[i:j]) for i, j in itertools.pairwise(done)]
        self.links.append(links, per_link)
        facts = np.stack([n_a, n_b, per_group], axis=1)
        facts[~np.array(good, bool)] = -1
        self.sizes.append(facts)
        return ones

    def facts(self, numbers: np.ndarray) -> np.ndarray:
        if len(self.sizes) > 1:
            self.sizes = [np.concatenate(self.sizes)]
        return self.sizes[0][numbers]


def aligned_pieces(path: str, other: str) -> AlignedPieces:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return kept(f"aligned {path} {other}", lambda: AlignedPieces(Vocabularies(path, other)))


def aligned(texts: pa.Array, pieces: AlignedPieces) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
    """Of each text: A tokens, B tokens, groups and links; the digest of its groups; and of all its links the text and a * B's size + b."""
    n = len(texts)
    filled = pc.fill_null(pc.greater(pc.binary_length(texts), 0), False)
    spaced = pc.if_else(filled, pc.binary_join_element_wise(" ", texts, ""), "")
    data, offsets = buffers(spaced)
    starts = cut_pieces(data, offsets)
    owner = np.searchsorted(offsets, starts, "right") - 1
    inner = starts > offsets[owner]
    keep = ~inner
    keep[inner] = ~pieces.known_tokens.joined[data[starts[inner] - 1], data[starts[inner]]]
    starts, owner = starts[keep], owner[keep]
    numbers = numbered(data, starts, pieces)
    facts = pieces.facts(numbers)
    # A text with a piece whose bytes differ has no tokens.
    bad = np.bincount(owner, facts[:, 0] < 0, n) > 0
    good = ~bad[owner]
    numbers, owner, facts = numbers[good], owner[good], facts[good]
    links, counts = pieces.links.take(numbers)
    text = np.repeat(owner, counts)
    sums = np.stack([*(np.bincount(owner, facts[:, i], n).astype(np.int64) for i in range(3)), np.bincount(text, minlength=n)], axis=1)
    bounds, named = np.searchsorted(owner, np.arange(n + 1)).tolist(), numbers.tolist()
    digests = []
    for i, j in itertools.pairwise(bounds):
        raw = ";".join(map(pieces.groups.__getitem__, named[i:j])).encode()
        digests.append(hashlib.sha256(raw).hexdigest() if raw else "")
    return sums, digests, text, links


BLOCKS = "block long, docs array<long>, sums binary, digests array<string>, plain binary, plain_counts binary, plain_ends binary, pairs array<long>, pair_docs array<long>, other binary, other_counts binary, other_ends binary"


def align_blocks(docs: DataFrame, path: str, other: str) -> DataFrame:
    """A row per batch of documents: sums and digests, and per document its different links with how often each occurs.

    Links of A ids with the B id of the same bytes stand by A id (``plain``), all others by place in ``pairs``, the list
    of the block's different pairs; ``pair_docs`` says how many of its documents hold each.
    """

    def run(batches):
        pieces, numbers = aligned_pieces(path, other), block_numbers()
        vocabulary = pieces.known_tokens
        for batch in larger(batches, 1 << 21):
            if not batch.num_rows:
                continue
            n = batch.num_rows
            sums, digests, text, links = aligned(batch.column(1), pieces)
            keys, counts = np.unique(text * (1 << 40) + links, return_counts=True)
            text, links = keys >> 40, keys & ((1 << 40) - 1)
            a = links // vocabulary.others
            plain = vocabulary.same[a] == links % vocabulary.others
            pairs, place, held = np.unique(links[~plain], return_inverse=True, return_counts=True)
            ends = lambda mask: np.searchsorted(text[mask], np.arange(n), "right")
            row = [
                [next(numbers)], [batch.column(0).to_pylist()], [sums.tobytes()], [digests],
                [a[plain].astype(np.int32).tobytes()], [counts[plain].astype(np.int32).tobytes()], [ends(plain).tobytes()],
                [pairs], [held], [place.astype(np.int32).tobytes()], [counts[~plain].astype(np.int32).tobytes()], [ends(~plain).tobytes()],
            ]
            types = [pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.string()), *[pa.binary()] * 3, *[pa.list_(pa.int64())] * 2, *[pa.binary()] * 3]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, types)], names=[c.split()[0] for c in BLOCKS.split(", ")])
        # The worker waits beside later stages of the executor; what Arrow holds in reserve goes back.
        pa.default_memory_pool().release_unused()

    return docs.select("doc_id", "text").mapInArrow(run, BLOCKS)


def plain_counts(blocks: DataFrame, size: int) -> np.ndarray:
    """How many documents hold each A id linked to the B id of the same bytes; each task counts in a vector of its own."""

    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            for ids in batch.column(0):
                total += np.bincount(np.frombuffer(ids.as_py(), np.int32), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["a", "n"])

    counted = blocks.select("plain").mapInArrow(run, "a long, n long").groupBy("a").agg(F.sum("n").alias("n"))
    out = np.zeros(size, np.int64)
    for r in counted.collect():  # at most as many rows as A has ids
        out[r["a"]] = r["n"]
    return out


RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def align(docs: DataFrame, path: str | None = None, other: str | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_a, n_b (tokens), n_groups, n_links, n_best, count_sum and groups_sha256.

    The count of an id pair is the number of rows that hold it linked; a row whose id
    or text repeats counts like any other. n_best is how many links have the highest count of their A
    id, ties included, and count_sum the sum of the counts of all links. Null and empty texts, and those that a
    tokenizer does not give back byte for byte, have zeros and an empty digest. An
    empty table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    path, other = path or tokenizer_path(DEFAULT_TOKENIZER), other or tokenizer_path(DEFAULT_OTHER)
    vocabulary = Vocabularies(path, other)
    size, others, same = len(vocabulary.one_bytes), vocabulary.others, vocabulary.same
    blocks = stored(align_blocks(docs, path, other), "aligned")
    plain = plain_counts(blocks, size)
    pairs = blocks.select(F.explode(F.arrays_zip("pairs", "pair_docs")).alias("p"))
    counts = pairs.groupBy(F.col("p.pairs").alias("key")).agg(F.sum("p.pair_docs").alias("n"))
    counts = stored(counts, "pairs")
    # The highest count of each A id: its plain link or another one.
    best = plain * (same >= 0)
    highest = counts.groupBy(F.expr(f"key div {others}").alias("a")).agg(F.max("n").alias("n"))
    for r in highest.collect():  # at most as many rows as A has ids
        best[r["a"]] = max(best[r["a"]], r["n"])
    shared = spark.sparkContext.broadcast((plain, best))
    found = looked_up(blocks, "pairs", counts)

    def run(batches):
        plain, best = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                docs = row["docs"].values
                n = len(docs)
                sums = np.frombuffer(row["sums"].as_py(), np.int64).reshape(n, 4)
                pairs = row["pairs"].values.to_numpy(zero_copy_only=False)
                n_pair = placed(row["found"].values, len(pairs))
                best_of, sum_of = np.zeros(n, np.int64), np.zeros(n, np.int64)
                number = lambda name, kind=np.int32: np.frombuffer(row[name].as_py(), kind)  # noqa: B023, E731
                at = number("other")
                for a, count, many, ends in (
                    (ids := number("plain"), plain[ids], number("plain_counts"), number("plain_ends", np.int64)),
                    (pairs[at] // others, n_pair[at], number("other_counts"), number("other_ends", np.int64)),
                ):
                    owner = np.searchsorted(ends, np.arange(len(a)), "right")
                    np.add.at(sum_of, owner, count * many)
                    np.add.at(best_of, owner, many * (count == best[a]))
                columns = [docs, *(pa.array(sums[:, k]) for k in range(4)), pa.array(best_of), pa.array(sum_of), row["digests"].values]
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in RESULT.split(", ")])

    return blocks.drop("pair_docs").join(found, "block", "left").mapInArrow(run, RESULT)
