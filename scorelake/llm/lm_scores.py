"""Texts scored by an attention model and by the frequency of their words.

One pass turns each batch of documents into a block: the ids of all subwords, the
different words with their counts in training documents, and which words each
document uses. Counts of words and subwords are over all training documents. The
attention weights are fitted by local steps to every window of every training document:
runs of windows are dealt to shards, which train copies of the model, and
after each round every part of the weights is the mean over the shards that moved it,
taken by a grouping by part. Copies, means and what is broadcast are as large as the
vocabulary, whatever the corpus. The counts of a fixed number of frequent words are sent to all
tasks; the counts of all others are looked up by a join on the words of each block.
"""

from __future__ import annotations

import copy
import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .attention import PAD, Model, Trainer
from .blocks import block_numbers, looked_up, placed
from .common import SPACE, buffers, kept, mix, ship, stored, words_of
from .near_copies import LOWER
from .tokens import DEFAULT_TOKENIZER, Pieces, encode_all, larger, load_tokenizer, text_slices, tokenizer_path

#: One run in so many of the training documents is trained on: all of them.
EVERY = 1
ROUNDS = 2
#: Strides of a run: windows that stand in a row in a document and are trained on together.
RUN = 16
#: Windows in one step of training, at first and at most. Steps grow with what a shard has seen.
BATCH, MOST = 128, 1024
#: At most so many of the most frequent words are sent to all tasks with their counts; only others enter the join.
COMMON = 1 << 17
#: Numbers in one part of the weights.
PART = 1 << 14


def subwords(path: str) -> Pieces:
    """Special tokens' strings are plain text."""

    def make():
        tokenizer = load_tokenizer(path)
        tokenizer.encode_special_tokens = True
        return Pieces(tokenizer)

    return kept(f"subwords {path}", make)


def narrow_type(size: int):
    """The narrowest type for numbers below ``size``."""
    return np.uint16 if size <= 1 << 16 else np.uint32


def is_held_out(doc_id: int | None) -> bool:
    """Of doc_id as text; a null id is an empty one, which is in training."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


def word_numbers(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different words of all texts with A-Z lower-cased, the number of each word in a row, and where each text's words begin and end."""
    data = LOWER[data] if len(data) else data
    starts, ends, bounds = words_of(data, offsets)
    if not len(starts):
        return pa.array([], pa.large_string()), np.zeros(0, np.int64), bounds
    # The letters of all words one behind the other.
    sizes = ends - starts
    coded = text_slices(data[~SPACE[data]], np.cumsum(sizes) - sizes).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), bounds


BLOCKS = "block long, docs array<long>, held binary, ids binary, id_ends binary, words array<string>, counts array<long>, uses binary, use_ends binary, n_training long"


def score_blocks(docs: DataFrame, path: str) -> DataFrame:
    def run(batches):
        known, numbers = subwords(path), block_numbers()
        small = narrow_type(known.tokenizer.get_vocab_size())
        for batch in larger(batches, 1 << 22):
            if not batch.num_rows:
                continue
            names = batch.column(0).to_pylist()
            held = np.array([is_held_out(d) for d in names])
            ids, id_bounds = encode_all(batch.column(1), known, None)
            words, uses, bounds = word_numbers(*buffers(batch.column(1)))
            training = np.repeat(~held, np.diff(bounds))
            counts = np.bincount(uses[training], minlength=len(words))
            narrow = narrow_type(len(words))
            row = [
                pa.array([next(numbers)]), pa.array([names], pa.list_(pa.int64())), pa.array([held.tobytes()]),
                pa.array([ids.astype(small).tobytes()]), pa.array([id_bounds[1:].astype(np.int64).tobytes()]),
                pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words.cast(pa.string())),
                pa.array([counts], pa.list_(pa.int64())), pa.array([uses.astype(narrow).tobytes()]), pa.array([bounds[1:].astype(np.int64).tobytes()]),
                pa.array([int((~held).sum())]),
            ]
            yield pa.RecordBatch.from_arrays(row, names=[c.split()[0] for c in BLOCKS.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(run, BLOCKS)


def texts_of(row: dict, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Subword ids of a block and where each document's begin and end."""
    ids = np.frombuffer(row["ids"].as_py(), narrow_type(size))
    return ids, np.concatenate([[0], np.frombuffer(row["id_ends"].as_py(), np.int64)])


def rows_of(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(name)[i] for name in batch.schema.names}


def subword_counts(blocks: DataFrame, size: int, end: int) -> np.ndarray:
    """How often each id occurs in training documents, with an end for each."""

    def run(batches):
        total = np.zeros(size, np.int64)
        for row in rows_of(batches):
            ids, bounds = texts_of(row, size)
            held = np.frombuffer(row["held"].as_py(), bool)
            total += np.bincount(ids[np.repeat(~held, np.diff(bounds))], minlength=size)
            total[end] += int((~held).sum())
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["id", "n"])

    counted = blocks.select("held", "ids", "id_ends").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    out = np.zeros(size, np.int64)
    for r in counted.collect():  # at most as many rows as there are ids
        out[r["id"]] = r["n"]
    return out


def training_windows(blocks: DataFrame, model: Model, every: int) -> DataFrame:
    """order (a digest of document and place) and run (see `windows_of`) of all windows of training documents, or one run in ``every``."""
    size, s, end = model.size, model.stride, model.end

    def run(batches):
        for row in rows_of(batches):
            ids, bounds = texts_of(row, size)
            training = np.flatnonzero(~np.frombuffer(row["held"].as_py(), bool))
            names = row["docs"].values.fill_null(0).to_numpy().astype(np.uint64)
            # Each text between two ends, one of them its own; `first` is where it begins among all.
            first = bounds[:-1] + 2 * np.arange(len(names))
            sizes = np.diff(bounds) + 1
            row_of = np.full(len(ids) + 2 * len(names), end, narrow_type(size))
            row_of[np.repeat(first + 1 - bounds[:-1], sizes - 1) + np.arange(len(ids))] = ids
            many = -(-sizes[training] // (RUN * s))
            text = np.repeat(training, many)
            place = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
            order = mix(names[text] * np.uint64(0x9E3779B97F4A7C15) + mix(place.astype(np.uint64)))
            kept = order % np.uint64(every) == 0
            text, place, order = text[kept], place[kept], order[kept] // np.uint64(every)
            start = place * RUN * s
            stop = np.minimum(start + RUN * s, sizes[text]) + 1
            start = np.maximum(start - s, 0)
            # A run has the stride before it in front, unless it begins a text.
            runs = [row_of[i:j].tobytes() for i, j in zip((first[text] + start).tolist(), (first[text] + stop).tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(order.view(np.int64)), pa.array(place > 0), pa.array(runs, pa.binary())], names=["order", "follows", "run"])

    return blocks.select("docs", "held", "ids", "id_ends").mapInArrow(run, "order long, follows boolean, run binary")


def windows_of(ids: np.ndarray, follows: bool, model: Model) -> np.ndarray:
    """A row (ids before, ids, targets) for each stride of a run: what it ends with is a target only, and if it ``follows`` others its first stride is context only."""
    s, n = model.stride, len(ids) - 1
    before, inputs, targets = both = np.empty((3, -(-n // s), s), np.int64)
    inputs.reshape(-1)[:n], inputs.reshape(-1)[n:] = ids[:-1], model.end
    targets.reshape(-1)[:n], targets.reshape(-1)[n:] = ids[1:], PAD
    before[:1], before[1:] = PAD, inputs[:-1]
    rows = both.transpose(1, 0, 2).reshape(-1, 3 * s)
    return rows[1:] if follows else rows


def train_on(model: Model, windows: np.ndarray, trainer: Trainer) -> None:
    """One step on windows (ids before, ids, targets); one that goes on where the window in front of it ends shares its ids."""
    s = model.stride
    before, inputs, targets = windows[:, :s], windows[:, s : 2 * s], windows[:, 2 * s :]
    follows = before[:, 0] != PAD
    alone = follows.copy()
    alone[1:] &= (before[1:] != inputs[:-1]).any(axis=1)
    # The first stride of all is never predicted.
    at = np.cumsum(1 + alone)
    strides, goals = np.full((at[-1] + 1, s), model.end), np.full((at[-1] + 1, s), PAD)
    strides[at], goals[at] = inputs, targets
    strides[at[alone] - 1] = before[alone]
    going = np.zeros(len(strides), bool)
    going[at] = follows
    trainer.step(strides, goals, going)


def train(model: Model, windows: DataFrame, rounds: int = ROUNDS) -> Model:
    """The model fitted to the runs of ``windows`` (order, follows, run), each used in one round."""
    spark = windows.sparkSession
    shards = spark.sparkContext.defaultParallelism
    for r in range(rounds):
        shared = spark.sparkContext.broadcast(model)

        def learn(batches):
            local = copy.copy(shared.value)  # noqa: B023
            old = local.weights
            local.weights = {k: v.copy() for k, v in old.items()}
            trainer, n, kind = Trainer(local), 0, narrow_type(local.size)
            held, waiting = [], 0
            for batch in batches:
                for follows, run in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    held.append(windows_of(np.frombuffer(run, kind), follows, local))
                    n, waiting = n + len(held[-1]), waiting + len(held[-1])
                    if waiting >= min(max(BATCH, n // 8), MOST):
                        train_on(local, np.concatenate(held), trainer)
                        held, waiting = [], 0
            if held:
                train_on(local, np.concatenate(held), trainer)
            moved = np.concatenate([(local.weights[k] - old[k]).reshape(-1) for k in local.weights]) if n else np.zeros(0, np.float32)
            for i in range(0, len(moved), PART):
                part = moved[i : i + PART]
                if part.any():
                    yield pa.RecordBatch.from_pydict({"part": [i // PART], "moved": [part.tobytes()], "n": [float(n)]})

        def mean(table):
            n = table.column("n").to_numpy()
            moved = np.stack([np.frombuffer(m, np.float32) for m in table.column("moved").to_pylist()])
            # Sorted, so that the sum does not depend on the order of arrival.
            order = np.lexsort((*moved[:, :3].T, n))
            total = (moved[order] * n[order, None]).sum(axis=0) / n.sum()
            return pa.table({"part": table.column("part")[:1], "moved": pa.array([total.astype(np.float32).tobytes()])})

        chosen = windows.where(F.pmod("order", F.lit(rounds)) == r).repartition(shards, "order").sortWithinPartitions("order", "follows", "run")
        moves = chosen.select("follows", "run").mapInArrow(learn, "part long, moved binary, n double")
        merged = moves.groupBy("part").applyInArrow(mean, "part long, moved binary").collect()  # at most the size of the model
        flat = np.concatenate([v.reshape(-1) for v in model.weights.values()])
        for row in merged:
            part = np.frombuffer(row["moved"], np.float32)
            flat[row["part"] * PART : row["part"] * PART + len(part)] += part
        at = 0
        for k, v in model.weights.items():
            model.weights[k] = flat[at : at + v.size].reshape(v.shape).copy()
            at += v.size
        shared.destroy()
    return model


def model_scores(blocks: DataFrame, model: Model) -> DataFrame:
    """block and scores: the model's log10 probability of each of its documents."""
    shared = blocks.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for row in rows_of(batches):
            ids, bounds = texts_of(row, model.size)
            inputs, targets, text = model.strides(ids, bounds)
            found = model.log_probs(inputs, targets, text).sum(axis=1)
            scores = np.bincount(text, found, len(bounds) - 1) / math.log(10)
            yield pa.RecordBatch.from_arrays([pa.array([row["block"].as_py()]), pa.array([scores])], names=["block", "scores"])

    return blocks.select("block", "ids", "id_ends").mapInArrow(run, "block long, scores array<double>")


def most_common(table: DataFrame) -> list:
    """The rows of ``table`` (key, n) above a count that at most `COMMON` of them reach."""
    level = F.floor(8 * F.log2("n"))
    n, least = 0, None
    for r in table.groupBy(level.alias("level")).agg(F.count("*").alias("n")).orderBy(F.desc("level")).collect():  # at most 512 rows
        n += r["n"]
        if n > COMMON:
            break
        least = r["level"]
    return [] if least is None else table.where(level >= least).collect()


def common_apart(blocks: DataFrame, common) -> DataFrame:
    """``blocks`` with ``rest``, the words that are not in a broadcast ``common`` (words, counts), and ``top``, the counts of all words there, else 0."""
    kept_names = [c for c in blocks.columns if c != "words"]

    def run(batches):
        words, counts = common.value
        for row in rows_of(batches):
            mine = row["words"].values
            at = pc.index_in(mine, value_set=words)
            unknown = at.is_null()
            top = np.where(unknown.to_numpy(zero_copy_only=False), 0, counts[at.fill_null(0).to_numpy()] if len(words) else 0).astype(np.int64)
            rest = mine.filter(unknown)
            columns = [pa.array([row[c].as_py()], row[c].type) for c in kept_names]
            columns += [pa.ListArray.from_arrays(pa.array([0, len(rest)], pa.int32()), rest), pa.array([top.tobytes()])]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept_names, "rest", "top"])

    schema = blocks.select(*kept_names).schema.add("rest", T.ArrayType(T.StringType())).add("top", "binary")
    return blocks.mapInArrow(run, schema)


RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def scored_texts(docs: DataFrame, path: str | None = None, every: int = EVERY, rounds: int = ROUNDS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): held_out, n_tokens, n_known, train_tokens, base_score and score.

    Words are lower-cased in A-Z; a text has its words and an end, which is known if any
    row is in training. Null texts are empty. A null id is in training. Rows that repeat
    count, and are returned, as often as they occur. Without training rows N and V are 0,
    and the model knows no frequencies. An empty table gives no rows. The attention weights are
    fitted to all windows of training rows, each in one of ``rounds`` rounds, unless ``every`` asks
    for a trial on one run of windows in so many; counts are of everything.
    """
    spark = docs.sparkSession
    ship(spark)
    path = path or tokenizer_path(DEFAULT_TOKENIZER)
    size = subwords(path).tokenizer.get_vocab_size()
    end = size - 1  # the vocabulary's end of text
    blocks = stored(score_blocks(docs, path), "scored", "zstd")

    words = blocks.select(F.explode(F.arrays_zip("words", "counts")).alias("w")).where("w.counts > 0")
    table = stored(words.groupBy(F.col("w.words").alias("key")).agg(F.sum("w.counts").alias("n")), "words")
    n_words, kinds = table.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    ends = blocks.agg(F.coalesce(F.sum("n_training"), F.lit(0))).first()[0]
    total, kinds = n_words + ends, kinds + (ends > 0)

    model = Model(subword_counts(blocks, size, end), end)
    model = train(model, training_windows(blocks, model, every), rounds)

    first = most_common(table)
    common = spark.sparkContext.broadcast((pa.array([r["key"] for r in first], pa.string()), np.array([r["n"] for r in first], np.int64)))
    found = looked_up(common_apart(blocks.select("block", "words"), common), "rest", table)
    sides = common_apart(blocks.select("block", "docs", "held", "uses", "use_ends", "words"), common).withColumn("n_rest", F.size("rest")).drop("rest")
    both = sides.join(found, "block", "left").join(model_scores(blocks, model), "block")

    def run(batches):
        for row in rows_of(batches):
            docs, held = row["docs"].values, np.frombuffer(row["held"].as_py(), bool)
            ends_at = np.frombuffer(row["use_ends"].as_py(), np.int64)
            sizes = np.diff(ends_at, prepend=0)
            of_word = np.frombuffer(row["top"].as_py(), np.int64).copy()
            of_word[of_word == 0] = placed(row["found"].values, row["n_rest"].as_py())
            counts = of_word[np.frombuffer(row["uses"].as_py(), narrow_type(len(of_word)))]
            owner = np.repeat(np.arange(len(docs)), sizes)
            known = np.bincount(owner, counts > 0, len(docs)).astype(np.int64) + (ends > 0)
            logs = np.bincount(owner, np.log10((counts + 1) / (total + kinds + 1)), len(docs))
            base = logs + math.log10((ends + 1) / (total + kinds + 1))
            columns = [docs, pa.array(held), pa.array(sizes + 1), pa.array(known), pa.array(np.full(len(docs), total)), pa.array(base), row["scores"].values]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in RESULT.split(", ")])

    return both.mapInArrow(run, RESULT)
