"""Hard negatives by anchor spanning-tree bounds.

Anchors are packed into blocks, each with the spanning tree of its least distances. Candidates are packed into runs. A run meets a block
in one task: the root's scores are computed, and a child's score lies within the edge's length times the candidate's norm of
its parent's. Only candidates whose bounds overlap a window that still has something to gain are scored again,
exactly; the others hand their bounds on, widened edge by edge.

Two searches: the best of an anchor's own label give the positives, and each positive the window for its negatives.
Scores are integers, so no rounding decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexgraph.llm.common import by_value, column
from lexgraph.plans.stage import MAX_BROADCAST_BYTES, Staged, stage, stage_sized

by_value(__name__)

LAST = np.iinfo(np.int64).max  # stands for a null id, which comes after all others
LEAST = np.iinfo(np.int64).min


class Mining(NamedTuple):
    """``positives`` of each anchor and ``negatives`` of each of them. A negative's score is ``low`` to ``high`` percent of the positive's.

    Components are multiplied by ``scale`` and rounded down. ``anchors`` stand in a block and ``run`` candidates in a run; ``pilot`` is the
    share of the runs that are searched first, so that the others start with windows already narrowed.
    """

    positives: int = 5
    negatives: int = 5
    low: int = 80
    high: int = 100
    scale: int = 256
    anchors: int = 1024
    run: int = 1024
    pilot: int = 16


def scaled(batch: pa.RecordBatch, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the rows that take part, and their vectors as integers [row, component], padded with zeros.

    A null label or vector, or any null or non-finite component, leaves a row out.
    """
    vectors = column(batch, "vector")
    sizes = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.list_flatten(vectors)
    missing = flat.is_null().to_numpy(zero_copy_only=False)
    values = pc.fill_null(flat, 0).to_numpy(zero_copy_only=False).astype(np.float64)
    values = np.where(missing, np.nan, values)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    bad = np.zeros(len(sizes), bool)
    bad[owner[~np.isfinite(values)]] = True
    bad |= vectors.is_null().to_numpy(zero_copy_only=False) | column(batch, "label").is_null().to_numpy(zero_copy_only=False)
    good = np.flatnonzero(~bad)
    width = int(sizes[good].max(initial=0))
    out = np.zeros((len(sizes), width), np.float64)
    mine = ~bad[owner]
    begin = np.r_[0, np.cumsum(sizes)[:-1]] if len(sizes) else np.zeros(0, np.int64)
    out[owner[mine], (np.arange(len(owner)) - begin[owner])[mine]] = np.floor(values[mine] * scale)
    if width and np.abs(out[good]).max(initial=0) * np.sqrt(width) >= 1 << 26:
        raise ValueError("components times the scale must stay below 2**26 / sqrt(length), so that scores are exact")
    return good, out[good].astype(np.int32)


def small_int(vectors: np.ndarray) -> bytes:
    """The vectors in 16 bits if they fit, else in 32."""
    wide = len(vectors) and vectors.size and np.abs(vectors).max() >= 1 << 15
    return vectors.astype(np.int32 if wide else np.int16).tobytes()


def vectors_of(data: bytes, rows: int, width: int) -> np.ndarray:
    if not rows * width:
        return np.zeros((rows, width))
    return np.frombuffer(data, np.int32 if len(data) == 4 * rows * width else np.int16).reshape(rows, width).astype(np.float64)


def ids_of(batch: pa.RecordBatch) -> np.ndarray:
    return pc.fill_null(column(batch, "vec_id").cast(pa.int64()), LAST).to_numpy(zero_copy_only=False)


def pack_runs(rows: DataFrame, p: Mining) -> Staged:
    """[rows, width, ids, labels, vectors]: the candidates, up to ``run`` in a row, ascending by id."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, vectors = scaled(batch, p.scale)
            ids, labels = ids_of(batch)[good], column(batch, "label").take(pa.array(good)).to_numpy(zero_copy_only=False).astype(np.int64)
            for at in range(0, len(good), p.run):
                order = at + np.argsort(ids[at : at + p.run], kind="stable")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([len(order)], pa.int64()), pa.array([vectors.shape[1]], pa.int64()), pa.array([ids[order].tobytes()], pa.binary()),
                        pa.array([labels[order].tobytes()], pa.binary()), pa.array([small_int(vectors[order])], pa.binary()),
                    ],
                    ["rows", "width", "ids", "labels", "vectors"],
                )

    return stage_sized(rows.select("vec_id", "label", "vector").mapInArrow(pack, "rows long, width long, ids binary, labels binary, vectors binary"), "runs")


def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(order, parent, length, level) of the tree of least distances over the rows, from its most central one.

    ``order`` lists the rows level by level; ``parent`` (place in that order, -1 for the root), ``length`` and ``level`` follow it.
    """
    n = len(vectors)
    norms = (vectors**2).sum(1)
    apart = np.sqrt(np.maximum(0, norms[:, None] + norms[None, :] - 2 * vectors @ vectors.T))
    root = int(apart.sum(1).argmin())
    parent, length, depth = np.full(n, -1), np.zeros(n), np.zeros(n, np.int64)
    near, closest, inside = apart[root].copy(), np.full(n, root), np.zeros(n, bool)
    inside[root] = True
    for _ in range(n - 1):
        at = int(np.where(inside, np.inf, near).argmin())
        inside[at] = True
        parent[at], length[at], depth[at] = closest[at], near[at], depth[closest[at]] + 1
        closer = apart[at] < near
        near[closer], closest[closer] = apart[at][closer], at
    order = np.argsort(depth, kind="stable")
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    return order, np.where(parent[order] < 0, -1, place[parent[order]]), length[order], depth[order]


BLOCK = "block long, rows long, width long, ids binary, labels binary, vectors binary, parents binary, lengths binary, levels binary"


def pack_blocks(anchors: DataFrame, p: Mining) -> Staged:
    """Blocks of up to ``anchors`` anchors, each with its spanning tree; anchors of like labels stand together."""
    ranges = int(anchors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = anchors.select("vec_id", "label", "vector").repartitionByRange(ranges, "label", F.xxhash64("vec_id", "vector"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            good, vectors = scaled(batch, p.scale)
            ids, labels = ids_of(batch)[good], column(batch, "label").take(pa.array(good)).to_numpy(zero_copy_only=False).astype(np.int64)
            for at in range(0, len(good), p.anchors):
                part = slice(at, at + p.anchors)
                order, parent, length, level = spanning_tree(vectors[part].astype(np.float64))
                blobs = [ids[part][order], labels[part][order], None, parent.astype(np.int64), length, level]
                data = [small_int(vectors[part][order]) if b is None else b.tobytes() for b in blobs]
                head = [pa.array([x], pa.int64()) for x in (number, len(order), vectors.shape[1])]
                names = [c.split()[0] for c in BLOCK.split(", ")]
                yield pa.RecordBatch.from_arrays([*head, *(pa.array([d], pa.binary()) for d in data)], names)
                number += 1

    return stage_sized(dealt.mapInArrow(pack, BLOCK), "blocks")


class Block:
    """Anchors of a block with their windows and, as runs come by, the best that each window has so far.

    ``low`` and ``high`` [anchor, window] bound the scores that count, ``same`` tells whether candidates have the anchor's label.
    """

    def __init__(self, row: dict, windows: int, keep: int, same: bool):
        self.number, n, width = row["block"], row["rows"], row["width"]
        self.labels, self.vectors = np.frombuffer(row["labels"], np.int64), vectors_of(row["vectors"], n, width)
        self.parents, self.lengths, levels = (np.frombuffer(row[k], t) for k, t in (("parents", np.int64), ("lengths", np.float64), ("levels", np.int64)))
        self.steps = [slice(*np.searchsorted(levels, [k, k + 1])) for k in range(int(levels[-1]) + 1)]
        self.low, self.high = (np.frombuffer(row[k], np.int64).reshape(n, windows) for k in ("low", "high"))
        self.same, self.keep = same, keep
        self.scores = np.full((n, windows, keep), LEAST)
        self.ids = np.full((n, windows, keep), LAST)

    def meet(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, norms: np.ndarray) -> None:
        """Take from a run what belongs to the best of each window."""
        width = min(vectors.shape[1], self.vectors.shape[1])  # beyond its length a vector is zero
        given, own = vectors[:, :width], self.vectors[:, :width]
        middle = np.empty((len(own), len(ids)))
        reach = np.empty((len(own), len(ids)))
        # What a candidate must reach: the window's bound, or the least of the best if they are enough; ties may go to a smaller id.
        floor = np.maximum(self.low, self.scores[:, :, -1])
        for step in self.steps:
            right = (self.labels[step, None] == labels[None, :]) == self.same
            if step.start == 0:
                overlap = np.ones_like(right)
            else:
                up = self.parents[step]
                middle[step] = middle[up]
                # The part of a vector that the other does not have counts for nothing in a score; the bounds stay true.
                reach[step] = reach[up] + (self.lengths[step, None] * norms[None, :]) * (1 + 1e-9) + 1e-3
                above, below = middle[step] + reach[step], middle[step] - reach[step]
                overlap = np.zeros_like(right)
                for w in range(floor.shape[1]):
                    overlap |= (above >= floor[step, w, None]) & (below <= self.high[step, w, None])
                overlap &= right
            columns = np.flatnonzero(overlap.any(0))
            if not len(columns):
                continue
            scores = own[step] @ given[columns].T
            mine = overlap[:, columns]
            middle[step, columns] = np.where(mine, scores, middle[step, columns]) if step.start else scores
            reach[step, columns] = np.where(mine, 0, reach[step, columns]) if step.start else 0
            mine &= right[:, columns]
            for w in range(floor.shape[1]):
                hit = mine & (scores >= floor[step, w, None]) & (scores <= self.high[step, w, None])
                self.take(step, w, hit, scores, ids[columns])

    def take(self, step: slice, w: int, hit: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Merge the hits [anchor of the step, candidate] into the best of window ``w``; candidates ascend by id."""
        if hit.sum() > 8 * self.keep * len(hit) and hit.shape[1] > self.keep:
            # Score, then place: the best of each row without a sort of all hits.
            rank = np.where(hit, scores * hit.shape[1] + np.arange(hit.shape[1] - 1, -1, -1), -np.inf)
            best = np.argpartition(rank, -self.keep, axis=1)[:, -self.keep :]
            kept = np.zeros_like(hit)
            np.put_along_axis(kept, best, True, axis=1)
            hit = hit & kept
        row, col = np.nonzero(hit)
        if not len(row):
            return
        touched = np.unique(row)
        own = np.repeat(touched, self.keep)
        rows = np.concatenate([own, row])
        values = np.concatenate([self.scores[step][touched, w].ravel(), scores[row, col].astype(np.int64)])
        names = np.concatenate([self.ids[step][touched, w].ravel(), ids[col]])
        order = np.lexsort((names, -values.astype(np.float64), rows))
        rows, values, names = rows[order], values[order], names[order]
        begin = np.searchsorted(rows, touched)
        pick = begin[:, None] + np.arange(self.keep)[None, :]
        self.scores[step.start + touched, w] = values[pick]
        self.ids[step.start + touched, w] = names[pick]

    def found(self) -> pa.RecordBatch:
        row, w, k = np.nonzero(self.scores > LEAST)
        ids = self.ids[row, w, k]
        arrays = [np.full(len(row), self.number), row, w, self.scores[row, w, k]]
        return pa.RecordBatch.from_arrays(
            [*(pa.array(x, pa.int64()) for x in arrays), pa.array(ids, pa.int64(), mask=ids == LAST)], ["block", "place", "window", "score", "id"]
        )


def search(runs: DataFrame, blocks: Staged, windows: int, keep: int, same: bool) -> DataFrame:
    """[block, place, window, score, id]: for each anchor and window the best ``keep`` of all candidates, a null id last among ties.

    ``blocks`` has ``low`` and ``high`` besides the anchors. Blocks go to the tasks in slices of a bounded size; each slice meets all
    runs. A task names its best of each window, and those of all tasks are ranked.
    """
    spark = runs.sparkSession
    slices = max(1, -(-blocks.size // MAX_BROADCAST_BYTES))
    parts = []
    for number in range(slices):
        mine = blocks.df.where(F.pmod(F.xxhash64("block"), F.lit(slices)) == number).toArrow()
        sent = spark.sparkContext.broadcast(mine.to_pylist())

        def meet(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            held = [Block(row, windows, keep, same) for row in sent.value]
            for batch in batches:
                for row in batch.to_pylist():
                    n, width = row["rows"], row["width"]
                    vectors = vectors_of(row["vectors"], n, width)
                    norms = np.sqrt((vectors**2).sum(1))
                    for block in held:
                        block.meet(np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64), vectors, norms)
            yield from (block.found() for block in held)

        parts.append(runs.mapInArrow(meet, "block long, place long, window long, score long, id long"))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    best = Window.partitionBy("block", "place", "window").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return every.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= keep)


def with_windows(blocks: DataFrame, given: DataFrame | None, windows: int, low: int, high: int) -> Staged:
    """``blocks`` with ``low`` and ``high``: all scores, or of ``given`` [block, place, window, score] the bounds in percent."""

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lows, highs = [], []
            for row in batch.select(["rows", "given"]).to_pylist():
                lo, hi = np.full((row["rows"], windows), LAST), np.full((row["rows"], windows), LEAST)  # nothing counts
                if all_scores:
                    lo[:], hi[:] = LEAST, LAST
                for x in row["given"] or []:
                    lo[x["place"], x["window"]] = -(-low * x["score"] // 100)
                    hi[x["place"], x["window"]] = high * x["score"] // 100
                lows.append(lo.tobytes())
                highs.append(hi.tobytes())
            kept = [column(batch, c) for c in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(lows, pa.binary()), pa.array(highs, pa.binary())], [*names, "low", "high"])

    names, all_scores = [c.split()[0] for c in BLOCK.split(", ")], given is None
    if all_scores:
        with_given = blocks.select(*names, F.lit(None).cast("array<struct<place:long,window:long,score:long>>").alias("given"))
    else:
        # At most ``windows`` scores for each anchor of a block.
        mine = given.groupBy("block").agg(F.collect_list(F.struct("place", "window", "score")).alias("given"))
        with_given = blocks.select(*names).join(mine, "block", "left").select(*names, "given")
    return stage_sized(with_given.mapInArrow(bound, f"{BLOCK}, low binary, high binary"), "windows")


def narrowed(blocks: Staged, found: DataFrame, windows: int, keep: int) -> Staged:
    """``blocks`` whose lower bounds are raised to the last of the best ``keep`` in ``found``, where it has so many."""
    names = [c.split()[0] for c in BLOCK.split(", ")]
    last = found.where(F.col("rank") == keep).groupBy("block").agg(F.collect_list(F.struct("place", "window", "score")).alias("given"))

    def raise_low(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lows = []
            for row in batch.select(["rows", "low", "given"]).to_pylist():
                lo = np.frombuffer(row["low"], np.int64).reshape(row["rows"], windows).copy()
                for x in row["given"] or []:
                    lo[x["place"], x["window"]] = max(lo[x["place"], x["window"]], x["score"])
                lows.append(lo.tobytes())
            kept = [column(batch, c) for c in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(lows, pa.binary()), column(batch, "high")], [*names, "low", "high"])

    joined = blocks.df.join(last, "block", "left").select(*names, "low", "high", "given")
    return stage_sized(joined.mapInArrow(raise_low, f"{BLOCK}, low binary, high binary"), "narrowed")


def searched(runs: Staged, blocks: Staged, windows: int, keep: int, same: bool, p: Mining) -> DataFrame:
    """``search``, with the windows narrowed by a share of the runs first if there are very many."""
    if runs.rows > p.pilot**2:
        first = stage(search(runs.df.where(F.pmod(F.xxhash64("ids"), F.lit(p.pilot)) == 0), blocks, windows, keep, same), "pilot")
        blocks = narrowed(blocks, first, windows, keep)
    cores = runs.df.sparkSession.sparkContext.defaultParallelism
    pairs = runs.rows * max(1, blocks.rows)
    # Few files can hold very much work: a task for every so many meetings.
    spread = runs.df.repartition(min(runs.rows, pairs // 256)) if pairs > 1024 * cores else runs.df
    return search(spread, blocks, windows, keep, same)


def hard_negatives(rows: DataFrame, is_anchor: Column, p: Mining = Mining()) -> DataFrame:
    """[anchor_id, positive_id, rank, negative_id, positive_score, negative_score] of rows [vec_id, label, vector].

    A score is the integer inner product with the anchor; higher ones come first, ties by smaller id, null ids last. The positives of an anchor are the first ``positives`` other
    rows of its label; for each of them the first ``negatives`` rows of another label in its window are returned, all if fewer.

    Rows with a null label or vector, or a null or non-finite component, take no part. Every row is one of its own: an anchor that
    stands twice is two anchors, each the other's positive, and repeated rows fill several ranks. Vectors of different lengths
    are compared up to the shorter one's; an empty one scores 0. Windows of negative positives are empty.
    """
    given = rows.select("vec_id", "label", "vector")
    runs = pack_runs(given, p)
    blocks = pack_blocks(rows.where(F.coalesce(is_anchor, F.lit(False))), p)
    names = stage(anchors_of(blocks.df), "anchors")
    # One more than asked for: the anchor itself is among them.
    best = searched(runs, with_windows(blocks.df, None, 1, 0, 0), 1, p.positives + 1, True, p)
    own = Window.partitionBy("block", "place")
    itself = F.min(F.when(F.col("id").eqNullSafe(F.col("anchor_id")) & (F.col("score") == F.col("own_score")), F.col("rank"))).over(own)
    others = best.join(names, ["block", "place"]).withColumn("itself", itself).where("itself is null or rank != itself")
    place = F.col("rank") - F.when(F.col("rank") > F.col("itself"), 2).otherwise(1)
    positives = stage(
        others.withColumn("window", place.cast("long")).where(F.col("window") < p.positives)
        .select("block", "place", "window", "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")),
        "positives",
    )
    scores = positives.select("block", "place", "window", F.col("positive_score").alias("score"))
    found = searched(runs, with_windows(blocks.df, scores, p.positives, p.low, p.high), p.positives, p.negatives, False, p)
    return found.join(positives, ["block", "place", "window"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def anchors_of(blocks: DataFrame) -> DataFrame:
    """[block, place, anchor_id, own_score] of the anchors in the blocks."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n = row["rows"]
                ids, vectors = np.frombuffer(row["ids"], np.int64), vectors_of(row["vectors"], n, row["width"])
                own = (vectors**2).sum(1).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, row["block"])), pa.array(np.arange(n)), pa.array(ids, pa.int64(), mask=ids == LAST), pa.array(own)],
                    ["block", "place", "anchor_id", "own_score"],
                )

    return blocks.mapInArrow(unpack, "block long, place long, anchor_id long, own_score long")
