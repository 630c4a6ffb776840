"""Benchmark decontamination by latent semantic retrieval.

Passages are overlapping windows of words. Over the words of the benchmark, TF-IDF passages are reduced by a randomised
SVD; what it needs of them, a sum for every two words that share passages, is added up across tasks over all documents. Every passage of every document is projected and compared with the items
by cosine; what is near enough is checked by the longest common subsequence of words, and where that is only partly
there (a paraphrase), by the item's answer. An item longer than a passage is searched by pieces of it and checked as a
whole; one too short for its cosine to a passage to tell is searched by counting its words in windows of its own length.

The benchmark is the query set: it is worked through in blocks of bounded size, each against all documents.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexgraph.llm.common import RUN_BYTES, by_value, column, runs, shared, text_rows
from lexgraph.plans.stage import stage

by_value(__name__)

MARKS = " .,;:!?\"'()[]{}<>*#$%&|-_¿¡«»"


class Decontam(NamedTuple):
    """``step`` words are between passages, ``parts`` steps long. The latent space is fitted on the items, multiplied
    by ``stress``, and on all passages of all documents, which together weigh as much; it has ``extra`` dimensions more than items, as
    passages of chance are close to nothing but themselves. Document frequencies are counted over all documents.

    Passages with a ``cosine`` to a piece of an item are checked; a piece of k words needs ``slack`` of sqrt(k / passage), its
    cosine where it stands among known words, if that is less. An item is found if ``certain`` of its words stand there in
    order, or ``partly`` and the answer as well. Items of fewer than ``short`` words are searched without the latent space.
    ``block``: pieces that are worked on together.
    """

    step: int = 24
    parts: int = 3
    extra: int = 56
    stress: float = 4.0
    iterations: int = 3
    cosine: float = 0.45
    slack: float = 0.75
    short: int = 15
    certain: float = 0.75
    partly: float = 0.6
    block: int = 500


class Items(NamedTuple):
    """A block of the benchmark: ids, word numbers, and those of the answer of each item; the numbers of words."""

    ids: list
    words: list[np.ndarray]
    answers: list[np.ndarray]
    vocabulary: dict[str, int]


class Space(NamedTuple):
    """``word`` [word, rank] projects counts, ``mass`` is the squared weight of a word; ``items`` [piece, rank] are projected."""

    word: np.ndarray
    mass: np.ndarray
    items: np.ndarray


def plain_words(text: str) -> list[str]:
    return [w for w in (raw.strip(MARKS) for raw in text.lower().split()) if w]


def answer_of(text: str) -> str:
    """What follows the last question mark, else the last sentence."""
    if "?" in text.rstrip(" ?\n"):
        return text.rstrip(" ?\n").rpartition("?")[2]
    return re.split(r"[.!?]\s", text.strip())[-1]


def read_block(rows: list[tuple]) -> Items:
    """From (item_id, text); items without words cannot be found and are left out."""
    kept = [(i, plain_words(t), plain_words(answer_of(t))) for i, t in rows if t and plain_words(t)]
    vocabulary: dict[str, int] = {}
    for _, words, _ in kept:
        for w in words:
            vocabulary.setdefault(w, len(vocabulary))
    number = lambda words: np.array([vocabulary.get(w, -1) for w in words], np.int64)
    return Items([i for i, _, _ in kept], [number(w) for _, w, _ in kept], [number(a) for _, _, a in kept], vocabulary)


def pieces_of(items: Items, p: Decontam) -> tuple[list[np.ndarray], np.ndarray]:
    """Cuts of the items of at most a passage, and the item of each."""
    cuts = [np.array_split(w, -(-len(w) // (p.step * p.parts))) for w in items.words]
    return [piece for cut in cuts for piece in cut], np.repeat(np.arange(len(cuts)), [len(cut) for cut in cuts])


def floors(items: Items, p: Decontam) -> np.ndarray:
    """The least cosine of a passage to each piece; none is enough for a piece of a short item."""
    pieces, owner = pieces_of(items, p)
    size = np.array([len(piece) for piece in pieces])
    low = np.minimum(p.cosine, p.slack * np.sqrt(size / (p.step * p.parts)))
    return np.where(np.array([len(w) for w in items.words])[owner] < p.short, np.inf, low).astype(np.float32)


class WordNumbers:
    """Numbers of words in the block's vocabulary, -1 for those it has not. Each distinct word of a run of texts is looked up once."""

    def __init__(self, vocabulary: dict[str, int]) -> None:
        self.vocabulary = pa.array(list(vocabulary), pa.string())

    def all(self, text: bytes) -> np.ndarray:
        return self.of_run(pa.array([text], pa.binary()))[0]

    def of_run(self, run: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the words of all texts, one text after another, and how many words each has."""
        split = pc.ascii_split_whitespace(run.view(pa.string()))
        coded, sizes = split.flatten().dictionary_encode(), split.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        if not len(coded):
            return np.zeros(0, np.int64), sizes
        one = pa.ListArray.from_arrays([0, len(coded.dictionary)], coded.dictionary)
        # Blanks end the words, so all can be lower-cased as one text.
        lines = pc.binary_join(one, "\n")[0].as_buffer().to_pybytes().decode("utf-8", "replace").lower()
        plain = pc.utf8_trim(pc.split_pattern(pa.array([lines], pa.string()), "\n").flatten(), MARKS)
        number = pc.fill_null(pc.index_in(plain, value_set=self.vocabulary), -1).to_numpy().astype(np.int64)
        at = coded.indices.to_numpy()
        # A text that begins or ends with a blank, or has no word, is split into an empty one there.
        real = pc.binary_length(coded.dictionary).to_numpy()[at] > 0
        owner = np.repeat(np.arange(len(sizes)), sizes)
        return number[at[real]], np.bincount(owner[real], minlength=len(sizes))


MATRIX = 16 << 20  # cells of a matrix that a task holds


def number_kind(size: int) -> type:
    return np.uint16 if size < 1 << 16 else np.int32


def numbered_words(docs: DataFrame, items: Items) -> DataFrame:
    """[doc_id, ids, word, n], staged: the words of every document as their numbers in the block's vocabulary plus one, 0 for others; and
    with a null ``ids``, the documents of a task that hold each word (and, behind the last word, all of them).

    One pass over the texts gives both: the search reads numbers, which are a fourth of the text.
    """
    sent, id_type = shared(docs.sparkSession, items), docs.schema["doc_id"].dataType.simpleString()

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = WordNumbers(sent().vocabulary)
        size = len(sent().vocabulary)
        kind, total, id_kind = number_kind(size + 1), np.zeros(size + 1, np.int64), None
        for batch in batches:
            total[size] += batch.num_rows
            for run in runs(batch):
                every, sizes = numbers.of_run(column(run, "text"))
                ids = np.split(every, np.cumsum(sizes)[:-1])
                for begin in range(0, len(ids), at_once := max(1, MATRIX // size)):
                    here = ids[begin : begin + at_once]
                    seen = np.zeros((len(here), size + 1), bool)  # unknown words in the last column
                    seen[np.repeat(np.arange(len(here)), [len(x) for x in here]), np.concatenate(here)] = True
                    total[:size] += seen[:, :size].sum(0)
                packs = pa.array([(x + 1).astype(kind).tobytes() for x in ids], pa.binary())
                id_kind, none = column(run, "doc_id").type, pa.nulls(len(ids), pa.int64())
                yield pa.RecordBatch.from_arrays([column(run, "doc_id"), packs, none, none], ["doc_id", "ids", "word", "n"])
        at = np.flatnonzero(total)
        if len(at):
            none = [pa.nulls(len(at), id_kind), pa.nulls(len(at), pa.binary())]
            yield pa.RecordBatch.from_arrays([*none, pa.array(at), pa.array(total[at])], ["doc_id", "ids", "word", "n"])

    return stage(text_rows(docs, "doc_id").mapInArrow(number, f"doc_id {id_type}, ids binary, word long, n long"), "numbered")


def document_frequencies(numbered: DataFrame, items: Items) -> tuple[np.ndarray, int]:
    """Documents with each word of the block, and all documents; one row of each word for each task moves."""
    rows = numbered.where("word is not null").groupBy("word").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(len(items.vocabulary) + 1, np.int64)
    out[rows.column("word").to_numpy()] = rows.column("n").to_numpy()
    return out[:-1], int(out[-1])


def step_counts(ids: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Known words of a text with the number of their step, and how many steps it has."""
    at = np.flatnonzero(ids >= 0)
    return ids[at], at // step, -(-len(ids) // step)


class PairSums:
    """Sums of weights by pair of words, at ``first * size + second``: a matrix if that fits a task, else sorted cells."""

    def __init__(self, size: int) -> None:
        self.size, self.waiting, self.held = size, [], 0
        self.matrix = np.zeros(size * size) if size * size <= MATRIX else None

    def add(self, cell: np.ndarray, weight: np.ndarray) -> None:
        if self.matrix is not None:
            np.add.at(self.matrix, cell, weight)
            return
        self.waiting.append((cell, weight))
        self.held += len(cell)
        if self.held > MATRIX // 2:
            self.merge()

    def merge(self) -> None:
        cell, weight = map(np.concatenate, zip(*self.waiting))
        order = np.argsort(cell, kind="stable")
        cell = cell[order]
        begins = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
        self.waiting, self.held = [(cell[begins], np.add.reduceat(weight[order], begins))], len(begins)

    def full(self) -> bool:
        return self.matrix is None and self.held > MATRIX // 4

    def take(self) -> Iterator[pa.RecordBatch]:
        """[word, others, sums] of the words that have a pair, both ways round, in batches of bounded size; then all is forgotten."""
        at_once = max(1, MATRIX // 16 // max(1, self.size))
        if self.matrix is None and self.waiting:
            self.merge()
        for begin in range(0, self.size, at_once):
            if self.matrix is not None:
                square = self.matrix.reshape(self.size, self.size)
                yield packed_rows(begin, square[begin : begin + at_once] + square[:, begin : begin + at_once].T)
            elif self.waiting:
                block = np.zeros((min(at_once, self.size - begin), self.size))
                cell, weight = self.waiting[0]
                for row, other in ((cell // self.size, cell % self.size), (cell % self.size, cell // self.size)):
                    here = (row >= begin) & (row < begin + at_once)
                    np.add.at(block, (row[here] - begin, other[here]), weight[here])
                yield packed_rows(begin, block)
        self.__init__(self.size)


def packed_rows(begin: int, block: np.ndarray) -> pa.RecordBatch:
    """[word, others, sums] of the rows of ``block``, the first of which is word ``begin``; zeros are left out."""
    found = [(begin + k, np.flatnonzero(row).astype(np.int32), row) for k, row in enumerate(block)]
    found = [(word, at.tobytes(), row[at].tobytes()) for word, at, row in found if len(at)]
    kinds = {"word": pa.int64(), "others": pa.binary(), "sums": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], t) for k, t in enumerate(kinds.values())], list(kinds))


def unpacked_rows(rows: pa.RecordBatch | pa.Table, at: list[int], count: int, size: int) -> np.ndarray:
    """[count, size] with the sums of each row added at its place ``at``."""
    out = np.zeros((count, size))
    for k, others, sums in zip(at, rows.column("others").to_pylist(), rows.column("sums").to_pylist()):
        out[k, np.frombuffer(others, np.int32)] += np.frombuffer(sums)
    return out


def add_pairs(ids: list[np.ndarray], mass: np.ndarray, sums: PairSums, p: Decontam) -> int:
    """Add for every two known words of each passage of the texts one over its squared length; gives the number of passages.

    A word's pair with itself counts half, as the sums are read both ways round. The texts lie end to end as in ``near_items``.
    """
    size = np.array([len(x) for x in ids])
    steps = -(-size // p.step)
    begin_step = np.r_[0, np.cumsum(np.maximum(steps, p.parts))]
    begin_word = np.r_[0, np.cumsum(size)]
    every = np.concatenate(ids)
    known = np.flatnonzero(every >= 0)
    row = np.searchsorted(begin_word, known, side="right") - 1
    words, step, n = every[known], begin_step[row] + (known - begin_word[row]) // p.step, int(begin_step[-1])
    owner = np.repeat(np.arange(len(ids)), np.diff(begin_step))
    begins_here = np.arange(n) - begin_step[owner] < np.maximum(1, steps[owner] - p.parts + 1)

    # The squared length of a passage: the masses of all pairs of equal places in it, those of a place with itself first.
    alone = np.bincount(step, weights=mass[words], minlength=n + p.parts)
    squared = sum(alone[shift : shift + n] for shift in range(p.parts))
    order = np.argsort(words, kind="stable")
    same, of, left = words[order], step[order], np.arange(len(words))
    for apart in range(1, len(words)):
        left = left[: np.searchsorted(left, len(words) - apart)]
        left = left[(same[left + apart] == same[left]) & (of[left + apart] - of[left] < p.parts)]
        if not len(left):
            break
        for begin in range(p.parts):  # a passage that holds both begins at most so many steps before the first
            here = left[(of[left + apart] - of[left] < p.parts - begin) & (of[left] >= begin)]
            squared += np.bincount(of[here] - begin, weights=2 * mass[same[here]], minlength=n)

    # Two places are both in the passages that begin from the later one's step less ``parts`` - 1 to the earlier one's: the sum of one over
    # their squared lengths is a difference of running sums, and not above 0 if there are none.
    running = np.r_[np.zeros(p.parts), np.cumsum(np.where(begins_here & (squared > 0), 1 / np.where(squared > 0, squared, 1), 0))]
    until, since, base = running[step + p.parts], running[step], words * len(mass)
    sums.add(base + words, (until - since) / 2)
    for apart in range(1, len(words)):
        both = until[:-apart] - since[apart:]
        cell = base[:-apart] + words[apart:]
        near = np.flatnonzero(both > 0)
        if not len(near):
            break
        sums.add(*((cell, np.maximum(both, 0)) if len(near) > 0.8 * len(cell) else (cell[near], both[near])))
    return int(begins_here.sum())


def pair_sums(numbered: DataFrame, idf: np.ndarray, p: Decontam) -> tuple[DataFrame, int]:
    """[word, others, sums], staged: for each word of the block the sums of ``add_pairs`` over all passages of all documents; and their number.

    As many tasks as cores read the documents: the sums of each are words times words, however many documents there are.
    """
    spark, size = numbered.sparkSession, len(idf)
    sent = spark.sparkContext.broadcast(idf * idf)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, sums, passages = number_kind(size + 1), PairSums(size), 0
        for batch in batches:
            for run in runs(batch, RUN_BYTES // 32, "ids"):
                ids = [np.frombuffer(x, kind).astype(np.int64) - 1 for x in column(run, "ids").to_pylist()]
                passages += add_pairs(ids, sent.value, sums, p)
                if sums.full():
                    yield from sums.take()
        yield from sums.take()
        # Beside the words, the number of passages.
        yield packed_rows(size, np.array([[float(passages)]]))

    def join(table: pa.Table) -> pa.Table:
        words = table.column("word").to_pylist()
        first = words[0] // group * group
        block = unpacked_rows(table, [word - first for word in words], min(group, size + 1 - first), size)
        return pa.Table.from_batches([packed_rows(first, block)])

    group = max(1, min(256, MATRIX // 16 // size))
    schema = "word long, others binary, sums binary"
    parts = numbered.where("word is null").select("ids").coalesce(spark.sparkContext.defaultParallelism).mapInArrow(add, schema)
    joined = stage(parts.groupBy((F.col("word") / group).cast("int")).applyInArrow(join, schema), "pairs")
    total = joined.where(F.col("word") == size).select("sums").first()
    return joined.where(F.col("word") < size), int(np.frombuffer(total["sums"])[0]) if total else 0


def fit_space(numbered: DataFrame, items: Items, idf: np.ndarray, p: Decontam) -> Space:
    """Randomised SVD by subspace iteration over the items and all passages of all documents.

    What ``A.T @ A`` is for the passages ``A`` is added up once; each iteration multiplies its rows, where they lie. Only the basis,
    words of the block times rank, passes the driver.
    """
    spark, size = numbered.sparkSession, len(idf)
    pieces, _ = pieces_of(items, p)
    rank = min(len(pieces) + p.extra, size)
    rows, passages = pair_sums(numbered, idf, p)

    mine = np.zeros((len(pieces), size), np.float32)
    np.add.at(mine, (np.repeat(np.arange(len(pieces)), [len(w) for w in pieces]), np.concatenate(pieces)), 1)
    mine *= idf.astype(np.float32)
    length = np.linalg.norm(mine, axis=1, keepdims=True)
    mine /= np.where(length > 0, length, 1)

    def product(basis: np.ndarray) -> np.ndarray:
        given = spark.sparkContext.broadcast(idf[:, None] * basis)

        def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for begin in range(0, batch.num_rows, 64):
                    few = batch.slice(begin, 64)
                    block = unpacked_rows(few, list(range(few.num_rows)), few.num_rows, size)
                    out = [row.tobytes() for row in block @ given.value]
                    yield pa.RecordBatch.from_arrays([column(few, "word"), pa.array(out, pa.binary())], ["word", "row"])

        got = rows.mapInArrow(multiply, "word long, row binary").toArrow()
        given.unpersist()
        total = np.zeros((size, basis.shape[1]))
        for word, row in zip(got.column("word").to_pylist(), got.column("row").to_pylist()):
            total[word] = np.frombuffer(row)
        # All passages together weigh as much as all pieces would unstressed, however many there are.
        return p.stress**2 * (mine.T.astype(np.float64) @ (mine @ basis)) + idf[:, None] * total * (len(pieces) / max(1, passages))

    basis = np.linalg.qr(np.random.default_rng(11).standard_normal((size, min(size, rank + 16))))[0].astype(np.float32)
    for _ in range(p.iterations - 1):
        basis = np.linalg.qr(product(basis))[0].astype(np.float32)
    values, turn = np.linalg.eigh(basis.T.astype(np.float64) @ product(basis))
    best = basis @ turn[:, np.argsort(values)[::-1][:rank]].astype(np.float32)
    return Space((best * idf[:, None]).astype(np.float32), (idf * idf).astype(np.float32), mine @ best)


def common_subsequence(pattern: np.ndarray, text: np.ndarray) -> int:
    """Length of the longest common subsequence; the state of all pattern places is one integer."""
    masks: dict[int, int] = {}
    for i, w in enumerate(pattern.tolist()):
        masks[w] = masks.get(w, 0) | 1 << i
    full = (1 << len(pattern)) - 1
    state = full
    for w in text.tolist():
        hit = state & masks.get(w, 0)
        if hit:
            state = ((state + hit) | (state - hit)) & full
    return len(pattern) - state.bit_count()


def holds(text: np.ndarray, part: np.ndarray) -> bool:
    """Whether ``part`` stands in ``text`` in one piece."""
    if not len(part) or len(part) > len(text):
        return False
    starts = np.flatnonzero(text[: len(text) - len(part) + 1] == part[0])
    return any((text[s : s + len(part)] == part).all() for s in starts.tolist())


def near_items(ids: list[np.ndarray], space: Space, toward: np.ndarray, floor: np.ndarray, p: Decontam) -> Iterator[tuple[int, int, int, float]]:
    """(text, piece, first word, cosine) of the passages of the texts of a run that are near a piece of an item, text by text.

    ``toward`` [word, piece] is the latent product of each word with each piece; that of a passage is the sum over its words. The texts
    lie end to end, each on at least ``parts`` steps, so that no passage that begins in one reaches into the next.
    """
    size = np.array([len(x) for x in ids])
    steps = -(-size // p.step)
    begin_step = np.r_[0, np.cumsum(np.maximum(steps, p.parts))]
    begin_word = np.r_[0, np.cumsum(size)]
    every = np.concatenate(ids)
    known = np.flatnonzero(every >= 0)
    row = np.searchsorted(begin_word, known, side="right") - 1
    words, step = every[known], begin_step[row] + (known - begin_word[row]) // p.step
    owner = np.repeat(np.arange(len(ids)), np.diff(begin_step))
    local = np.arange(begin_step[-1]) - begin_step[owner]
    begins_here = local < np.maximum(1, steps[owner] - p.parts + 1)
    mass = np.bincount(step, weights=space.mass[words], minlength=begin_step[-1] + p.parts)
    length = sum(mass[shift : shift + begin_step[-1]] for shift in range(p.parts))
    # So many steps that the rows of their words stay within bounds.
    at_once = max(p.parts, MATRIX // 4 // (p.step * max(1, toward.shape[1])))
    for first in range(0, int(begin_step[-1]), at_once):
        last = min(first + at_once, int(begin_step[-1]))
        a, b = np.searchsorted(step, [first, last + p.parts - 1])
        if a == b:
            continue
        mine = step[a:b] - first
        begins = np.flatnonzero(np.append(True, mine[1:] != mine[:-1]))
        sums = np.zeros((last - first + p.parts - 1, toward.shape[1]), np.float32)
        sums[mine[begins]] = np.add.reduceat(toward[words[a:b]], begins, axis=0)
        near = sums[: last - first].copy()
        for shift in range(1, p.parts):
            near += sums[shift : shift + last - first]
        # The length of a passage is that of its weights before the reduction: little in common stays little.
        cosine = near / np.sqrt(np.maximum(length[first:last], 1e-9))[:, None].astype(np.float32)
        cosine[~begins_here[first:last]] = -1
        for at, piece in zip(*np.nonzero(cosine >= floor)):
            yield int(owner[first + at]), int(piece), int(local[first + at]) * p.step, float(cosine[at, piece])


class Short(NamedTuple):
    """Short items of about one length: their numbers, [word, item] whether the item has the word, and how many must stand in a window."""

    step: int
    items: np.ndarray
    has: np.ndarray
    least: np.ndarray


WINDOW = 5  # steps of half a short item


def short_items(items: Items, p: Decontam) -> list[Short]:
    groups: dict[int, list[int]] = {}
    for i, words in enumerate(items.words):
        if len(words) < p.short:
            groups.setdefault(-(-len(words) // 2), []).append(i)
    out = []
    for step, members in sorted(groups.items()):
        has = np.zeros((len(items.vocabulary), len(members)), np.int32)
        for at, i in enumerate(members):
            has[items.words[i], at] = 1
        out.append(Short(step, np.array(members), has, np.array([p.partly * len(items.words[i]) for i in members])))
    return out


def near_shorts(ids: np.ndarray, group: Short) -> Iterator[tuple[int, int]]:
    """(item, first word) of all windows with enough words of a short item for the subsequence: none that holds it is left out."""
    run = 4_000 * group.step
    for begin in range(0, max(1, len(ids)), run):
        words, step, steps = step_counts(ids[begin : begin + run + group.step * (WINDOW - 1)], group.step)
        if not len(words):
            continue
        sums = np.zeros((steps + 1, len(group.items)), np.int32)
        begins = np.flatnonzero(np.append(True, step[1:] != step[:-1]))
        sums[step[begins] + 1] = np.add.reduceat(group.has[words], begins, axis=0)
        sums = np.cumsum(sums, axis=0)
        last = np.minimum(np.arange(steps) + WINDOW, steps)
        for row, item in zip(*np.nonzero(sums[last] - sums[:-1] >= group.least - 1e-9)):
            yield int(group.items[item]), begin + int(row) * group.step


def find_items(numbered: DataFrame, items: Items, space: Space, p: Decontam) -> DataFrame:
    """[doc_id, hits array<struct<item_id, cosine, lcs, answer>>] of every document of ``numbered``: the items found in it."""
    item_type, id_type = pa.int64(), numbered.schema["doc_id"].dataType.simpleString()
    sent, placed = shared(numbered.sparkSession, items), shared(numbered.sparkSession, space)
    hit_type = pa.list_(pa.struct([("item_id", item_type), ("cosine", pa.float64()), ("lcs", pa.float64()), ("answer", pa.bool_())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, where = sent(), placed()
        kind, toward = number_kind(len(block.vocabulary) + 1), where.word @ where.items.T
        floor, (_, owner), shorts = floors(block, p), pieces_of(block, p), short_items(block, p)
        times = [Counter(w.tolist()) for w in block.words]
        distinct = [frozenset(t) for t in times]

        def compare(item: int, region: np.ndarray, here: frozenset, cosine: float | None) -> dict | None:
            words = block.words[item]
            # No subsequence is longer than all places of the item's words that stand there.
            if sum(map(times[item].__getitem__, here & distinct[item])) < p.partly * len(words) - 1e-9:
                return None
            share = common_subsequence(words, region) / len(words)
            answer = holds(region, block.answers[item])
            if share < p.certain and not (share >= p.partly and answer):
                return None
            if cosine is None:
                known, mass = region[region >= 0], where.mass
                own = sum(n * n * mass[w] for w, n in times[item].items())
                both = sum(mass[w] * times[item][w] for w in known.tolist() if w in distinct[item])
                cosine = float(min(1.0, both / np.sqrt(max(own * mass[known].sum(), 1e-9))))
            return {"item_id": block.ids[item], "cosine": cosine, "lcs": share, "answer": answer}

        for batch in batches:
            for run in runs(batch, RUN_BYTES // 2, "ids"):
                every, out = [np.frombuffer(x, kind).astype(np.int64) - 1 for x in column(run, "ids").to_pylist()], []
                near = groupby(near_items(every, where, toward, floor, p), key=lambda hit: hit[0])
                of, hits = next(near, (-1, ()))
                for number, ids in enumerate(every):
                    best: dict[int, dict] = {}

                    def keep(item: int, hit: dict | None) -> None:
                        if hit and (item not in best or (hit["lcs"], hit["cosine"]) > (best[item]["lcs"], best[item]["cosine"])):  # noqa: B023
                            best[item] = hit  # noqa: B023

                    last, seen = -1, {}
                    for _, piece, start, cosine in hits if of == number else ():
                        item = int(owner[piece])
                        size = len(block.words[item])
                        # Of an item in pieces any one may be what is near, and all others before it or after it.
                        reach = size if size > p.step * p.parts else max(p.step, size - p.step * p.parts // 2)
                        region = ids[max(0, start - reach) : start + p.step * p.parts + reach]
                        if start != last:
                            last, seen = start, {}
                        if reach not in seen:
                            seen[reach] = frozenset(region.tolist())
                        keep(item, compare(item, region, seen[reach], cosine))
                    if of == number:
                        of, hits = next(near, (-1, ()))
                    for group in shorts:
                        for item, start in near_shorts(ids, group):
                            region = ids[start : start + WINDOW * group.step]
                            keep(item, compare(item, region, frozenset(region.tolist()), None))
                    out.append([best[i] for i in sorted(best)])
                yield pa.RecordBatch.from_arrays([column(run, "doc_id"), pa.array(out, hit_type)], ["doc_id", "hits"])

    hits = "array<struct<item_id:long,cosine:double,lcs:double,answer:boolean>>"
    return numbered.where("word is null").select("doc_id", "ids").mapInArrow(find, f"doc_id {id_type}, hits {hits}")


def find_contamination(docs: DataFrame, benchmark: DataFrame, p: Decontam = Decontam()) -> DataFrame:
    """[doc_id, hits] of every row of docs [doc_id, text] against benchmark [item_id, text].

    Null and empty texts have no hits, as has everything against an empty benchmark. Items are told apart by their rows:
    two with one id both count. With several blocks of items the rows of a document are put together by id, so
    that rows that repeat an id share their hits.
    """
    rows = benchmark.select(F.col("item_id").cast("long"), "text").orderBy("item_id", "text").toLocalIterator()
    found, waiting, pieces = [], [], 0

    def work() -> None:
        items = read_block(waiting)
        if items.ids:
            numbered = numbered_words(docs, items)
            df, total = document_frequencies(numbered, items)
            idf = np.log((1.0 + total) / (1.0 + df))
            found.append(find_items(numbered, items, fit_space(numbered, items, idf, p), p))
        waiting.clear()

    for row in rows:
        waiting.append((row["item_id"], row["text"]))
        pieces += max(1, -(-len(plain_words(row["text"] or "")) // (p.step * p.parts)))
        if pieces >= p.block:
            work()
            pieces = 0
    work()
    if not found:
        empty = "array<struct<item_id:long,cosine:double,lcs:double,answer:boolean>>"
        return docs.select("doc_id", F.from_json(F.lit("[]"), empty).alias("hits"))
    if len(found) == 1:
        return found[0]
    every = found[0].select("doc_id")
    for part in found:
        hits = part.where(F.size("hits") > 0).select("doc_id", F.explode("hits").alias("hit"))
        part_hits = hits if part is found[0] else part_hits.unionByName(hits)
    by_id = part_hits.groupBy("doc_id").agg(F.sort_array(F.collect_set("hit")).alias("hits"))
    none = F.from_json(F.lit("[]"), found[0].schema["hits"].dataType)
    joined = every.join(by_id.withColumnRenamed("doc_id", "__id"), F.col("doc_id").eqNullSafe(F.col("__id")), "left")
    return joined.select("doc_id", F.coalesce("hits", none).alias("hits"))


def contaminated(docs: DataFrame, benchmark: DataFrame, p: Decontam = Decontam()) -> DataFrame:
    """[doc_id, contaminated, item_ids, best_cosine, best_lcs] of every row."""
    return find_contamination(docs, benchmark, p).select(
        "doc_id", (F.size("hits") > 0).alias("contaminated"), F.transform("hits", lambda h: h["item_id"]).alias("item_ids"),
        F.array_max(F.transform("hits", lambda h: h["cosine"])).alias("best_cosine"),
        F.array_max(F.transform("hits", lambda h: h["lcs"])).alias("best_lcs"),
    )
