"""Language-model scoring by context-tree weighting over bytes.

Each byte is eight binary decisions. A context is the last d bytes, d = 0 .. depth; at each context every decision has a
Krichevsky-Trofimov estimate from its counts. The weight of a context's own estimate against that of its longer
contexts follows bottom-up from the training probabilities (a half each to begin with), and predictions mix the
estimates of all depths on the way down.

Every context that stands in the training texts is a node, up to the depth. Counts, weights and predictions are made on
Spark: grams (a byte with its context) are dealt into chunks by the last ``SPLIT`` bytes of their context, so that a chunk
holds whole subtrees, which are weighed and asked in one task. Only what lies above them, the tree of depth ``SPLIT`` - 1,
is weighed on the driver and broadcast. Texts to be scored are dealt into blocks; a block asks the chunks for its distinct
grams and adds up their answers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lexgraph.llm.common import by_value, column, mixed, runs, shared, texts
from lexgraph.plans.stage import stage

by_value(__name__)

END = b"\n"  # the token that ends a text; no word can hold it


class TreeParams(NamedTuple):
    """``frequent``: words with at least this share of the training tokens have their counts sent to every task, so at
    most so many. ``block``: bytes of text that ask for their grams together. ``asking``: blocks whose asks to one chunk meet in a task.
    ``depth`` is at most 6: a gram is a byte and its context in 64 bits.
    """

    depth: int = 6
    frequent: int = 1 << 19
    block: int = 16 << 20
    asking: int = 256


class Frequent(NamedTuple):
    """Counts of the frequent words."""

    counts: dict[bytes, int]


def tokens_of(text: bytes) -> list[bytes]:
    """Words with A-Z lower-cased; of bytes, ``lower`` changes only those."""
    return text.lower().split()


def laid_out(bodies: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts, each after ``depth`` END bytes; places of the bytes to predict; where each text begins in them.

    A text is its words with one blank between them and END at the end, from which the words can be read back.
    """
    streams = [b" ".join(tokens_of(body)) + END for body in bodies]
    data = np.frombuffer(b"".join(END * depth + s for s in streams), np.uint8)
    sizes = np.array([len(s) for s in streams], np.int64)
    begins = np.cumsum(sizes) - sizes
    places = np.arange(int(sizes.sum()), dtype=np.int64) + np.repeat(depth * np.arange(1, len(sizes) + 1), sizes)
    return data, places, begins


def packed(data: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """Each byte with its context: the byte lowest, then the last byte before it, and so on."""
    out = data.astype(np.uint64)
    width = 1
    while width <= depth:  # twice as many bytes each time
        out[width:] |= out[:-width] << np.uint64(8 * width)
        width *= 2
    return (out[places] & np.uint64((1 << (8 * (depth + 1))) - 1)).astype(np.int64)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """log of the gamma function for x >= 0.5: Stirling's series from x + 8 on."""
    y = x + 8.0
    shift = np.log(x)
    for i in range(1, 8):
        shift = shift + np.log(x + i)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - shift


SPLIT = 3  # last bytes of a context that name its subtree
GRAMS_AT_ONCE = 1_000_000  # held by a task that counts


class Top(NamedTuple):
    """(keys, mixing, carry) of each depth below ``SPLIT``, the deepest first; a key is a context and a decision."""

    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]


class Level(NamedTuple):
    """The decisions seen at the contexts of one depth, by key; ``up`` is the place of the same decision a depth above."""

    keys: np.ndarray
    zeros: np.ndarray
    ones: np.ndarray
    stop: np.ndarray
    up: np.ndarray


def shorter(key: np.ndarray, depth: int) -> np.ndarray:
    """Keys (context << 8 | entry), or grams, with the context cut to its last ``depth`` bytes."""
    return key & ((1 << (8 * (max(depth, 0) + 1))) - 1)


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with their sums."""
    if not len(keys):
        return keys, n
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    begins = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[begins], np.add.reduceat(n, begins)


def distinct_of(keys: np.ndarray) -> np.ndarray:
    """Distinct keys in order, by sorting: of many different keys that is much faster than ``np.unique``, which hashes them."""
    keys = np.sort(keys)
    return keys[np.append(True, keys[1:] != keys[:-1])] if len(keys) else keys


def log_counts(n: np.ndarray, plus: float, known: dict = {}) -> np.ndarray:  # noqa: B006  remembers the small ones
    """log_gamma of n + plus."""
    if plus not in known:
        known[plus] = log_gamma(np.arange(4096) + plus)
    out = known[plus][np.minimum(n, 4095)]
    large = np.flatnonzero(n > 4095)
    out[large] = log_gamma(n[large] + plus)
    return out


def decisions(gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """[8, gram] keys of the decisions that make up the byte of each gram, from its highest bit on, and how they fall."""
    bit = np.arange(8)[:, None]
    byte = gram & 255
    return (gram - byte) | ((256 | byte) >> (8 - bit)), (byte >> (7 - bit)) & 1


def climb(
    keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, split: np.ndarray | None, deepest: int, last: int
) -> tuple[list[Level], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """The levels from ``deepest`` to ``last``, and (keys, zeros, ones, split) of the one above.

    ``split`` is the log probability that the longer contexts give to all decisions seen, None at the full depth.
    """
    levels = []
    for d in range(deepest, last - 1, -1):
        below = log_counts(zeros, 0.5) + log_counts(ones, 0.5) - log_counts(zeros + ones, 1.0) - np.log(np.pi)
        stop = np.ones(len(keys))
        if split is not None:
            gain = split - below
            stop = 1.0 / (1.0 + np.exp(np.clip(gain, -700, 700)))
            below = below + np.log(0.5) + np.logaddexp(0.0, gain)
        above, up = np.unique(shorter(keys, d - 1), return_inverse=True)
        levels.append(Level(keys, zeros, ones, stop, up))
        add = lambda x: np.bincount(up, weights=x, minlength=len(above))  # noqa: B023, E731
        keys, zeros, ones, split = above, add(zeros).astype(np.int64), add(ones).astype(np.int64), add(below)
    return levels, (keys, zeros, ones, split)


def subtrees(gram: np.ndarray, n: np.ndarray, p: TreeParams) -> tuple[list[Level], tuple]:
    """``climb`` of the grams with a context of the full depth, up to the contexts of ``SPLIT`` bytes."""
    keys, falls = decisions(gram)
    keys = keys.ravel()
    # The grams are in order, so equal decisions stand together.
    heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    add = lambda x: np.add.reduceat(x.ravel(), heads) if len(heads) else np.zeros(0, np.int64)
    order = np.argsort(keys[heads], kind="stable")
    return climb(keys[heads][order], add(n * (1 - falls))[order], add(n * falls)[order], None, p.depth, min(SPLIT, p.depth))


def descend(levels: list[Level], mixing: np.ndarray, carry: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(keys, mixing, carry) of the levels, the deepest first, from those of the level above them all."""
    out = []
    for keys, zeros, ones, stop, up in reversed(levels):
        mixing, carry = mixing[up] + carry[up] * stop * (ones + 0.5) / (zeros + ones + 1.0), carry[up] * (1 - stop)
        out.append((keys, mixing, carry))
    return out[::-1]


def gram_logp(gram: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]], depth: int) -> np.ndarray:
    """log10 probability of the byte of each of the sorted grams; ``levels`` from ``depth`` to 0. What no context has seen is even."""
    each, falls = (x.ravel() for x in decisions(gram))
    new = np.append(True, each[1:] != each[:-1])[: len(each)]
    keys, at_key = each[new], np.cumsum(new) - 1
    mixing, carry, open_ = np.zeros(len(keys)), np.ones(len(keys)), np.arange(len(keys))
    for d, (known, mix, left) in zip(range(depth, -1, -1), levels):
        if not len(known):
            continue
        wanted = shorter(keys[open_], d)
        at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
        hit = known[at] == wanted
        mixing[open_[hit]], carry[open_[hit]] = mix[at[hit]], left[at[hit]]
        open_ = open_[~hit]
    one = (mixing + carry * 0.5)[at_key]
    return np.log10(np.where(falls == 1, one, 1 - one)).reshape(8, -1).sum(axis=0)


def dealt(gram: np.ndarray, chunks: int, p: TreeParams) -> Iterator[tuple[int, np.ndarray]]:
    """(chunk, places of its grams in order); grams whose contexts share their last ``SPLIT`` bytes are in one chunk."""
    chunk = (mixed(shorter(gram >> 8, min(SPLIT, p.depth) - 1).astype(np.uint64)) % np.uint64(chunks)).astype(np.int64)
    order = np.argsort(chunk, kind="stable")
    begins = np.flatnonzero(np.append(True, chunk[order][1:] != chunk[order][:-1])) if len(gram) else order
    for places in np.split(order, begins[1:]) if len(gram) else []:
        yield int(chunk[places[0]]), places


def packed_numbers(numbers: np.ndarray) -> bytes:
    """Numbers for the way to another task: their differences, compressed; sorted ones take two or three bytes each."""
    size = np.int64(len(numbers)).tobytes()
    return size + pa.compress(np.diff(numbers, prepend=0).astype(np.int64).tobytes(), codec="zstd", asbytes=True) if len(numbers) else size


def unpacked(data: bytes) -> np.ndarray:
    size = int(np.frombuffer(data, np.int64, 1)[0])
    if not size:
        return np.zeros(0, np.int64)
    return np.cumsum(np.frombuffer(pa.decompress(data[8:], decompressed_size=8 * size, codec="zstd", asbytes=True), np.int64))


def all_unpacked(values: pa.ChunkedArray) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64), *map(unpacked, values.to_pylist())])


def numbers_in(values: pa.ChunkedArray, kind: type = np.int64) -> np.ndarray:
    return np.frombuffer(b"".join(values.to_pylist()), kind)


def train_chunks(train: DataFrame, chunks: int, p: TreeParams) -> DataFrame:
    """[chunk, gram, n, key, zeros, ones, split], one row of packed numbers for each chunk of train [text bytes].

    The last four are what its subtrees add to the level above them.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            rows = [(c, packed_numbers(gram[at]), packed_numbers(n[at])) for c, at in dealt(gram, chunks, p)]
            types = (("chunk", pa.int64()), ("gram", pa.binary()), ("n", pa.binary()))
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(types)], [c for c, _ in types])

        gram, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for run in runs(batch, 3 << 20):
                data, places, _ = laid_out(texts(run), p.depth)
                new, times = np.unique(packed(data, places, p.depth), return_counts=True)
                gram, n = summed(np.concatenate([gram, new]), np.concatenate([n, times]))
                if len(gram) > GRAMS_AT_ONCE:
                    yield flush()
                    gram, n = gram[:0], n[:0]
        yield flush()

    def join(table: pa.Table) -> pa.Table:
        gram, n = summed(all_unpacked(table["gram"]), all_unpacked(table["n"]))
        _, above = subtrees(gram, n, p)
        packs = [pa.array([x], pa.binary()) for x in (packed_numbers(gram), packed_numbers(n), *(a.tobytes() for a in above))]
        return pa.table([table["chunk"].combine_chunks()[:1], *packs], ["chunk", "gram", "n", "key", "zeros", "ones", "split"])

    counted = train.select("text").mapInArrow(count, "chunk long, gram binary, n binary")
    packs = "chunk long, gram binary, n binary, key binary, zeros binary, ones binary, split binary"
    return counted.groupBy("chunk").applyInArrow(join, packs)


def train_top(trained: DataFrame, p: TreeParams) -> Top:
    """The tree above the subtrees, from what they add to it."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = [numbers_in(batch["key"]), numbers_in(batch["zeros"]), numbers_in(batch["ones"]), numbers_in(batch["split"], np.float64)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in numbers], ["key", "zeros", "ones", "split"])

    each = trained.select("key", "zeros", "ones", "split").mapInArrow(add, "key long, zeros long, ones long, split double")
    sums = each.groupBy("key").agg(*(F.sum(c).alias(c) for c in ("zeros", "ones", "split"))).toArrow().sort_by("key")
    # At most 255 decisions for each of the 65,536 contexts of two bytes, however large the corpus is.
    levels, _ = climb(*(sums[c].to_numpy() for c in ("key", "zeros", "ones", "split")), min(SPLIT, p.depth) - 1, 0)
    size = len(levels[-1].keys)
    return Top(descend(levels, np.zeros(size), np.ones(size)))


def grams_of(batches: list[pa.RecordBatch], p: TreeParams) -> np.ndarray:
    """The distinct grams of the texts of a block, in order."""
    gram = waiting = np.zeros(0, np.int64)
    for batch in batches:
        for run in runs(batch, 2 << 20):
            data, places, _ = laid_out(texts(run), p.depth)
            waiting = np.concatenate([waiting, distinct_of(packed(data, places, p.depth))])
            if len(waiting) > GRAMS_AT_ONCE:
                gram, waiting = distinct_of(np.concatenate([gram, waiting])), waiting[:0]
    return distinct_of(np.concatenate([gram, waiting]))


def ask_chunks(rows: DataFrame, chunks: int, p: TreeParams) -> DataFrame:
    """[block, chunk, gram]: the distinct grams of each block of rows [block, text bytes, ...], packed by chunk."""

    def ask(table: pa.Table) -> pa.Table:
        gram = grams_of(table.to_batches(), p)
        asked = [(c, packed_numbers(gram[at])) for c, at in dealt(gram, chunks, p)]
        block = table["block"][0].as_py()
        return pa.table(
            [pa.array([block] * len(asked), pa.int64()), pa.array([c for c, _ in asked], pa.int64()), pa.array([g for _, g in asked], pa.binary())],
            ["block", "chunk", "gram"],
        )

    # All columns, though only two are used: the blocks are dealt as they are for the scores, so one exchange serves both.
    return rows.groupBy("block").applyInArrow(ask, "block long, chunk long, gram binary")


def answer_blocks(trained: DataFrame, asked: DataFrame, blocks: int, p: TreeParams) -> DataFrame:
    """[block, chunk, logp], packed: what each block has asked a chunk for, in the order asked, from the subtrees of ``trained``.

    A common context has asks of all blocks: its chunk is repeated for every ``asking`` of them, so no task gets more.
    """
    top = shared(asked.sparkSession, train_top(trained, p))

    def answer(asked: pa.Table, own: pa.Table) -> pa.Table:
        above = top().levels
        levels, (keys, *_) = subtrees(all_unpacked(own["gram"]), all_unpacked(own["n"]), p)
        at = np.searchsorted(above[0][0], keys)
        levels = descend(levels, above[0][1][at], above[0][2][at])
        packs = [unpacked(pack) for pack in asked["gram"].to_pylist()]
        gram = distinct_of(np.concatenate([np.zeros(0, np.int64), *packs]))
        logp = np.zeros(len(gram), np.float32)
        for begin in range(0, len(gram), GRAMS_AT_ONCE // 8):
            here = slice(begin, begin + GRAMS_AT_ONCE // 8)
            logp[here] = gram_logp(gram[here], [*levels, *above], p.depth)
        found = [logp[np.searchsorted(gram, pack)].tobytes() for pack in packs]
        return pa.table([asked["block"], asked["chunk"], pa.array(found, pa.binary())], ["block", "chunk", "logp"])

    salts = -(-blocks // p.asking)
    salted = asked.withColumn("salt", (F.col("block") % salts).cast("int"))
    repeated = trained.select("chunk", "gram", "n", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    both = salted.groupBy("chunk", "salt").cogroup(repeated.groupBy("chunk", "salt"))
    return both.applyInArrow(answer, "block long, chunk long, logp binary")


def asked_scores(bodies: list[bytes], gram: np.ndarray, logp: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """log10 probability and length in bytes of each text, from the sorted grams of its block.

    A gram leaves 8 of 64 bits free, so 256 texts at a time are sorted together, each gram with the number of its text.
    """
    data, places, begins = laid_out(bodies, depth)
    keys = packed(data, places, depth).astype(np.uint64) << np.uint64(8)
    size = np.diff(np.append(begins, len(places)))
    out = np.zeros(len(bodies))
    for first in range(0, len(bodies), 256):
        some = size[first : first + 256]
        begin = begins[first]
        own = np.sort(keys[begin : begin + some.sum()] | np.repeat(np.arange(len(some), dtype=np.uint64), some))
        seen, number = (own >> np.uint64(8)).astype(np.int64), (own & np.uint64(255)).astype(np.int64)
        heads = np.flatnonzero(np.append(True, seen[1:] != seen[:-1]))
        found = np.repeat(logp[np.searchsorted(gram, seen[heads])], np.diff(np.append(heads, len(seen))))
        out[first : first + 256] = np.bincount(number, weights=found, minlength=len(some))
    return out, size


def count_tokens(docs: DataFrame) -> DataFrame:
    """[word, c] of docs [text bytes], END among the words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in runs(batch, 6 << 20):
                found: Counter = Counter({END: run.num_rows})
                for text in texts(run):
                    found.update(tokens_of(text))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], ["word", "c"]
                )

    return docs.select("text").mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def score_texts(docs: DataFrame, train: DataFrame, p: TreeParams = TreeParams()) -> DataFrame:
    """[doc_id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte] of every row of docs [doc_id, text].

    ``train`` [text] is learned from. ``base_score`` sums log10((c + 1) / (N + V + 1)) over the tokens, ``score`` is the
    log10 probability of the tree. Null texts are empty: their only token is the end. Rows that repeat id and text are
    scored together and returned each.
    """
    spark = docs.sparkSession
    learn = train.select(F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    seen = Observation()
    counts = stage(
        count_tokens(learn).observe(seen, F.count(F.lit(1)).alias("distinct"), F.sum("c").alias("all")), "words"
    )
    distinct, total = seen.get["distinct"], seen.get["all"] or 0
    often = F.col("c") * p.frequent >= max(1, total)
    words = counts.where(often).toArrow()  # at most ``frequent`` rows
    known = dict(zip(words.column("word").to_pylist(), words.column("c").to_pylist()))
    rank = shared(spark, Frequent(known))
    below = float(np.log10(total + distinct + 1.0))
    body = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = docs.select("doc_id", F.xxhash64("doc_id", body).alias("row"), body.alias("text"))
    # Both numbers grow with the texts, so that what a task holds does not.
    size_of = lambda df: df.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    asking = size_of(rows)
    blocks = max(spark.sparkContext.defaultParallelism, -(-asking // p.block))
    chunks = max(512, (asking + size_of(learn)) // p.block)
    rows = rows.withColumn("block", F.pmod(F.col("row"), F.lit(blocks)))  # the same plan for asks and scores
    trained = stage(train_chunks(learn, chunks, p), "subtrees")
    answers = answer_blocks(trained, ask_chunks(rows, chunks, p), blocks, p)

    def score(docs: pa.Table, answers: pa.Table) -> pa.Table:
        gram = grams_of(docs.to_batches(), p)
        logp = np.zeros(len(gram), np.float32)
        told = dict(zip(answers["chunk"].to_pylist(), answers["logp"]))
        for chunk, at in dealt(gram, chunks, p):
            logp[at] = np.frombuffer(told[chunk].as_buffer(), np.float32)
        return pa.Table.from_batches(list(score_runs(docs.to_batches(), gram, logp)))

    def score_runs(batches: list[pa.RecordBatch], gram: np.ndarray, answered: np.ndarray) -> Iterator[pa.RecordBatch]:
        frequent = rank().counts
        for batch in batches:
            for run in runs(batch, 2 << 20):
                bodies, keys = texts(run), column(run, "row").to_pylist()
                logp, size = asked_scores(bodies, gram, answered, p.depth)
                found: list[bytes] = []
                ends = []
                for text in bodies:
                    found += tokens_of(text)
                    found.append(END)
                    ends.append(len(found))
                c = np.fromiter(map(frequent.get, found, repeat(0)), np.int64, len(found))
                ends = np.array(ends, np.int64)
                begins = np.append(0, ends[:-1])
                n_tokens, n_known = ends - begins, np.add.reduceat((c > 0).astype(np.int64), begins)
                base = np.add.reduceat(np.log10(c + 1.0), begins)
                unknown = np.flatnonzero(c == 0)
                last = np.searchsorted(unknown, ends).tolist()
                words = list(map(found.__getitem__, unknown.tolist()))
                rare_word, rare_row, rare_n = [], [], []
                for key, a, b in zip(keys, [0, *last[:-1]], last):
                    rare = Counter(words[a:b])
                    rare_word.extend(rare)
                    rare_row.extend([key] * len(rare))
                    rare_n.extend(rare.values())
                one = run.num_rows
                none = len(rare_word)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([None] * one + rare_word, pa.binary()), pa.array(keys + rare_row, pa.int64()),
                        pa.array([0] * one + rare_n, pa.int64()), pa.array([1] * one + [0] * none, pa.int64()),
                        pa.concat_arrays([column(run, "doc_id"), pa.nulls(none, column(run, "doc_id").type)]),
                        *(pa.array(np.append(x, np.zeros(none, x.dtype))) for x in (n_tokens, n_known, base, logp, size)),
                    ],
                    ["word", "row", "n", "copies", "doc_id", "n_tokens", "n_known", "base", "score", "size"],
                )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    parts = rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        score,
        f"word binary, row long, n long, copies long, doc_id {id_type}, n_tokens long, n_known long, base double, score double, size long",
    )
    # Frequent words are known already, so no word that moves here is frequent; rows of their own move by their own key.
    spread = F.coalesce("word", F.col("row").cast("string").cast("binary"))
    others = counts.where(~often).select(F.col("word").alias("at"), "c")
    joined = parts.withColumn("at", spread).join(others, "at", "left")
    is_word, c = F.col("n") > 0, F.coalesce("c", F.lit(0))  # not the word again: it moves once, as the key
    summed = joined.groupBy("row").agg(
        F.sum("copies").alias("copies"), F.max("doc_id").alias("doc_id"), F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.col("n_known") + F.when(is_word & (c > 0), F.col("n")).otherwise(0)).alias("n_known"),
        F.sum(F.col("base") + F.when(is_word, F.col("n") * F.log10(c + 1.0)).otherwise(0.0)).alias("base"),
        F.max(F.when(F.col("copies") == 1, F.col("score"))).alias("score"), F.max("size").alias("size"),
    )
    each = F.col("copies")
    tokens = (F.col("n_tokens") / each).cast("long")
    return summed.select(
        "doc_id", tokens.alias("n_tokens"), (F.col("n_known") / each).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), (F.col("base") / each - tokens * below).alias("base_score"), "score",
        (-F.col("score") * float(np.log2(10)) / F.col("size")).alias("bits_per_byte"), F.explode(F.sequence(F.lit(1), each.cast("int"))).alias("copy"),
    ).drop("copy")
