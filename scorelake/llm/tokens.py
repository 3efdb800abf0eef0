"""Token ids of whole texts by a public byte-level BPE tokenizer.

The tokenizer splits a text before it merges bytes, and none of its splits goes over
the place where white space, of any kind or length, follows a solid character, nor over a change between letters,
digits and other characters. So texts are cut there. The different pieces of a batch
are found by Arrow, each is encoded once by the tokenizers library, and the ids of a
text are those of its pieces in a row. All texts are encoded whole if the tokenizer's
file is of another kind.
"""

from __future__ import annotations

import itertools
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import SPACE, buffers, kept

DEFAULT_TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
#: Pieces that a worker process keeps; beyond that it begins anew.
KEPT_PIECES = 250_000
#: New pieces that are encoded at once: their ids are Python objects until they are stored.
NEW_PIECES = 8192


def tokenizer_path(name: str = DEFAULT_TOKENIZER) -> str:
    """Where the public vocabulary files lie on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_alphabet() -> dict[int, str]:
    """The character that stands for each byte in a byte-level model: its own if it can be seen, else one from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def doubtful(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character that ends before each place may be white space itself: a control, or one of Unicode's spaces."""
    one = data[at - 1]
    out = (one >= 0x1C) & (one <= 0x1F)
    wide = np.flatnonzero(one >= 0x80)
    if len(wide):
        here = at[wide]
        c, b, a = data[here - 1], data[here - 2], data[np.maximum(here - 3, 0)]
        general = (a == 0xE2) & (b == 0x80) & ((c <= 0x8F) | (c >= 0xA8))
        other = (a == 0xE2) & (b == 0x81) | (a == 0xE1) & ((b == 0x9A) | (b == 0xA0)) | (a == 0xE3) & (b == 0x80) | (a == 0xEF) & (b == 0xBB)
        out[wide] = (b == 0xC2) | general | other
    return out


def kinds() -> np.ndarray:
    """By byte: 1 a letter, 2 a digit, 4 another ASCII character that is solid, 8 the lead byte of a two-byte Latin letter, 0 anything else."""
    table = np.zeros(256, np.uint8)
    table[33:127] = 4
    table[48:58] = 2
    table[65:91] = table[97:123] = 1
    table[0xC4:0xC9] = 8  # U+0100 to U+023F
    return table


KINDS = kinds()


def cut_pieces(data: np.ndarray, offsets: np.ndarray, split_solid: bool = True) -> np.ndarray:
    """Where the pieces of all texts begin: at texts that are not empty, and where white space follows a solid character.

    With ``split_solid`` also between letters, digits and other ASCII characters, as the tokenizer
    does, but for the character after an apostrophe, which may be a contraction.
    Without, only spaces count as white space to cut at.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    space = SPACE[data]
    edge = np.zeros(n, bool)
    if split_solid:
        np.greater(space[1:], space[:-1], out=edge[1:])
        kind = KINDS[data]
        # Letters of two bytes: À to ɏ but × and ÷; the second byte is of the same kind.
        lead = np.flatnonzero((data == 0xC3) | (kind == 8))
        lead = lead[lead + 1 < n]
        lead = lead[(data[lead + 1] >= 0x80) & ((data[lead] != 0xC3) | (data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7))]
        kind[kind == 8] = 0
        kind[lead] = kind[lead + 1] = 1
        one, other = kind[:-1], kind[1:]
        edge[1:] |= (one != other) & (one > 0) & (other > 0) & (data[:-1] != 39)
        # The last of several spaces before a solid character goes with that character, other white space never does.
        edge[1:] |= space[:-1] & (data[:-1] != 32) & (other > 0)
        edge[1:-1] |= space[:-2] & space[1:-1] & (kind[2:] > 0)
    else:
        edge[1:] = (data[1:] == 32) & ~space[:-1]
    edge[offsets[:-1][np.diff(offsets) > 0]] = False
    at = np.flatnonzero(edge & space)
    edge[at[doubtful(data, at)]] = False
    edge[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(edge)


def larger(batches, size: int = 1 << 23):
    """Batches put together to about ``size`` bytes: the more text, the fewer different pieces for each."""
    held, total = [], 0
    for batch in batches:
        held.append(batch)
        total += batch.nbytes
        if total >= size:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, total = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def text_slices(data: np.ndarray, starts: np.ndarray) -> pa.LargeStringArray:
    """The slices of ``data`` that begin at ``starts`` and end at the next start, without a copy."""
    edges = np.append(starts, len(data)).astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(data))])


def gathered(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` that begin at ``starts``, one behind the other."""
    ends = np.cumsum(counts)
    return flat[np.repeat(starts - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)]


class Ragged:
    """Rows of numbers of different lengths, one behind the other in an array that grows."""

    def __init__(self, dtype):
        self.flat, self.used = np.zeros(1 << 12, dtype), 0
        self.starts, self.counts = [], []

    def extend(self, rows: list) -> None:
        sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        self.append(np.fromiter(itertools.chain.from_iterable(rows), self.flat.dtype, sizes.sum()), sizes)

    def append(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        """Rows that stand one behind the other in ``flat``."""
        total = len(flat)
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used : self.used + total] = flat
        self.starts.append(self.used + np.cumsum(sizes) - sizes)
        self.counts.append(sizes)
        self.used += total

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows of these numbers in a row, and the length of each."""
        if len(self.starts) > 1:
            self.starts, self.counts = [np.concatenate(self.starts)], [np.concatenate(self.counts)]
        if not len(numbers):
            return self.flat[:0], np.zeros(0, np.int64)
        counts = self.counts[0][numbers]
        return gathered(self.flat, self.starts[0][numbers], counts), counts


class Pieces:
    """The pieces that a worker process has met, by number, with their ids."""

    def __init__(self, tokenizer):
        self.tokenizer, self.model, self.most = tokenizer, tokenizer.model, KEPT_PIECES
        self.alphabet = byte_alphabet()
        self.space = self.alphabet[32]
        before = tokenizer.pre_tokenizer
        self.byte_level = tokenizer.normalizer is None and type(before).__name__ == "ByteLevel" and not before.add_prefix_space
        # Strings that are tokens of their own wherever they stand in a text.
        self.special = [] if tokenizer.encode_special_tokens else [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.clear()

    def clear(self) -> None:
        self.known = pa.array([], pa.large_string())
        self.ids = Ragged(np.uint32)

    def encode_new(self, pieces: list[str]) -> list[list[int]]:
        """Ids of each piece. One of letters and perhaps a space is split no further and goes straight to the library's BPE model."""
        out: list = [None] * len(pieces)
        rest = []
        for i, piece in enumerate(pieces):
            space = piece[0] == " "
            word = piece[1:] if space else piece
            # Letters up to Latin Extended-B are letters for every version of Unicode.
            if self.byte_level and word.isalpha() and (word.isascii() or max(word) < "\u0250"):
                spelled = word if word.isascii() else word.encode().decode("latin-1").translate(self.alphabet)
                out[i] = [t.id for t in self.model.tokenize(self.space + spelled if space else spelled)]
            else:
                rest.append(i)
        for i, e in zip(rest, self.tokenizer.encode_batch_fast([pieces[i] for i in rest], add_special_tokens=False) if rest else ()):
            out[i] = e.ids
        return out

    def numbers(self, pieces: pa.Array) -> np.ndarray:
        """The number of each of these different pieces; new ones are encoded."""
        if len(self.known) > self.most:
            self.clear()
        found = pc.index_in(pieces, value_set=self.known)
        if found.null_count:
            new = pieces.filter(found.is_null())
            for i in range(0, len(new), NEW_PIECES):
                self.ids.extend(self.encode_new(new.slice(i, NEW_PIECES).to_pylist()))
            first = len(self.known)
            self.known = pa.concat_arrays([self.known, new])
            out = found.fill_null(0).to_numpy().astype(np.int64)
            out[found.is_null().to_numpy(zero_copy_only=False)] = np.arange(first, len(self.known))
            return out
        return found.to_numpy().astype(np.int64)


def load_tokenizer(path: str):
    # One thread a task: Spark runs a task on every core.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def pieces_of(path: str) -> Pieces:
    """The pieces this worker process has met; they outlive a task."""
    return kept(f"pieces {path}", lambda: Pieces(load_tokenizer(path)))


def numbered(data: np.ndarray, starts: np.ndarray, pieces) -> np.ndarray:
    """The number that ``pieces`` gives each slice of ``data``."""
    coded = text_slices(data, starts).dictionary_encode()
    return pieces.numbers(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)] if len(starts) else np.zeros(0, np.int64)


def encode_all(texts: pa.Array, pieces: Pieces, end_id: int | None = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts in a row, each with the end id behind it, and where each text's ids begin and end. Null is empty."""
    data, offsets = buffers(texts)
    starts = cut_pieces(data, offsets) if pieces.byte_level else offsets[:-1][np.diff(offsets) > 0]
    for text in pieces.special if pieces.byte_level else ():
        # A text with such a string is one piece.
        found = pc.fill_null(pc.match_substring(texts, text), False).to_numpy(zero_copy_only=False)
        if found.any():
            owner = np.searchsorted(offsets, starts, "right") - 1
            starts = starts[~found[owner] | (starts == offsets[owner])]
    numbers = numbered(data, starts, pieces)
    ids, counts = pieces.ids.take(numbers)
    # Ids before each text, from the pieces before it.
    sums = np.concatenate([[0], np.cumsum(counts)])
    bounds = sums[np.searchsorted(starts, offsets)]
    if end_id is None:
        return ids, bounds
    return np.insert(ids, bounds[1:], np.uint32(end_id)), bounds + np.arange(len(bounds))


def encode(text: str | None, pieces: Pieces, end_id: int | None = END_ID) -> bytes:
    """The ids of a text as little-endian unsigned 32-bit bytes, with the end id."""
    return encode_all(pa.array([text], pa.string()), pieces, end_id)[0].astype("<u4").tobytes()
