"""Jaccard self-join of word n-gram sets by universe-partition pigeonhole.

The universe of n-grams is cut into cells by hash, for each band of set sizes into as many as its pairs can differ in,
and more. Two sets with at most H differing n-grams, over ``exact`` cells and ``deletion`` cells: if no deletion cell
differs in at most one n-gram, those take up 2 * deletion differences, and at least exact - (H - 2 * deletion)
of the exact cells are equal. So

* a deletion cell is entered as a whole and with each of its n-grams left out (the one-deletion neighbourhood): cells
  that differ in one n-gram share a key;
* of the exact cells a set enters only its H - 2 * deletion + 1 cheapest. The order of cost depends on the content of a cell alone, so
  of the cells that two sets have in common the cheapest is entered by both.

Costs follow from all texts: a cell costs less the more n-grams it holds that are not frequent in the corpus, an empty one
costs most. How many cells of each kind a band has is the cheapest allocation under the same measure. What shares a
key is checked on full sets, through hubs and rings of like distance, so that no group is unrolled into pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import ceil, comb
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexgraph.llm.common import MIX, WordHash, by_value, column, grams, mixed, runs, text_rows, texts
from lexgraph.llm.neardup import NearDup, link_classes, node_of, shingle_set
from lexgraph.plans.lookup import lookup_join
from lexgraph.plans.stage import stage

by_value(__name__)

ONE = np.uint64(1)


class Join(NamedTuple):
    """Links: ``100 * intersection >= percent * union`` of the sets of ``shingle``-word n-grams.

    ``buckets`` (a power of two) bounds the table of frequent n-grams: those whose bucket holds more than ``often`` times the mean, and
    ``least`` at least. ``block`` bounds the n-grams that a task compares at once.
    """

    shingle: int = 5
    percent: int = 80
    buckets: int = 1 << 20
    often: int = 3
    least: int = 32
    block: int = 250_000

    def differing(self, sizes: int) -> int:
        """The most n-grams in which two linked sets differ whose sizes add up to ``sizes``."""
        return sizes * (100 - self.percent) // (100 + self.percent)

    def largest(self, size: int) -> int:
        """The most that a partner of a set of ``size`` can hold."""
        return 100 * size // self.percent


class Band(NamedTuple):
    """Sets of ``low`` to ``high`` - 1 n-grams, and those smaller ones that have partners here."""

    number: int
    low: int
    high: int
    deletion: int
    exact: int

    @property
    def seed(self) -> int:
        return (self.number + 1) * 0x9E3779B97F4A7C15 % (1 << 64) | 1


# What a key costs besides its row: by the n-grams that stand behind it, none of them, one, two, ...
WEAK = (20_000.0, 5.0, 1.25, 0.3, 0.08)


def key_cost(held: int) -> float:
    return 1 + (WEAK[held] if held < len(WEAK) else 0)


@lru_cache(maxsize=4096)
def occupied(balls: int, cells: int) -> list[float]:
    """Chances that so many of the cells hold something."""
    chance = [1.0] + [0.0] * min(balls, cells)
    for _ in range(balls):
        for k in range(len(chance) - 1, -1, -1):
            chance[k] = chance[k] * k / cells + (chance[k - 1] * (cells - k + 1) / cells if k else 0)
    return chance


def allocation_cost(size: int, differ: int, deletion: int, exact: int) -> float:
    """About what the keys of a set of ``size`` cost when two sets may differ in ``differ`` n-grams."""
    cells = deletion + exact
    pmf = [comb(size, j) * (1 / cells) ** j * (1 - 1 / cells) ** (size - j) for j in range(min(size, 40) + 1)]
    cost = deletion * sum(p * (key_cost(j) + j * key_cost(max(0, j - 1))) for j, p in enumerate(pmf))
    need = max(0, differ + 1 - 2 * deletion)
    if not need:
        return cost
    inside = round(size * exact / cells)
    cost += WEAK[0] * sum(p * (need - k) for k, p in enumerate(occupied(inside, exact)) if k < need)
    left = float(need)
    for j in range(len(pmf) - 1, 0, -1):  # the fullest cells first
        take = min(left, exact * pmf[j])
        cost, left = cost + take * key_cost(j), left - take
    return cost + left * key_cost(1)


@lru_cache(maxsize=256)
def band(number: int, p: Join) -> Band:
    """Band ``number``: sizes from 2**number. The allocation is the cheapest for its small and middle sizes.

    From sizes of 64 on deletion cells never pay: an exact cell costs one row for one difference.
    """
    low, high = 1 << number, 2 << number
    differ = p.differing(2 * (high - 1))
    if low >= 64:
        return Band(number, low, high, 0, ceil(1.5 * (differ + 1)))
    options = []
    for deletion in range((differ + 2) // 2 + 1):
        need = max(0, differ + 1 - 2 * deletion)
        for spread in (1, 1.5, 2, 3, 4):
            exact = ceil(need * spread)
            if deletion + exact:
                sizes = (low, low + low // 2)
                cost = sum(allocation_cost(s, min(differ, p.differing(s + min(high - 1, p.largest(s)))), deletion, exact) for s in sizes)
                options.append((cost, deletion, exact))
    _, deletion, exact = min(options)
    return Band(number, low, high, deletion, exact)


def all_bands(p: Join) -> list[Band]:
    """The bands of all sizes, to travel with the tasks."""
    return [band(number, p) for number in range(40)]


def bands_of(size: int, bands: list[Band], p: Join) -> list[tuple[Band, int]]:
    """The bands in which a set of ``size`` has partners, each with the most n-grams in which they differ.

    None if it can only be linked with equal sets.
    """
    out, partner = [], p.largest(size)
    for b in bands[size.bit_length() - 1 :]:
        if partner < b.low:
            break
        differ = p.differing(size + min(b.high - 1, partner))
        if differ > 0:
            out.append((b, differ))
    return out


def band_keys(found: np.ndarray, rare: np.ndarray, b: Band, differ: int) -> np.ndarray:
    """The keys of a set in a band; ``found`` are the hashes of its n-grams, ``rare`` is 1 for those that are not frequent.

    Key: 64-bit hash of band, cell and content; the last bit tells that no rare n-gram stands behind it.
    """
    cells, seed = b.deletion + b.exact, np.uint64(b.seed)
    spread = mixed(found ^ seed)
    cell = (((spread >> np.uint64(32)) * np.uint64(cells)) >> np.uint64(32)).astype(np.uint16 if cells < 65_536 else np.int64)
    order = np.argsort(cell, kind="stable")
    cell, spread, rare = cell[order].astype(np.int64), spread[order], rare[order]
    begin = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    here, sums, rares, counts = cell[begin], np.add.reduceat(spread, begin), np.add.reduceat(rare, begin), np.diff(np.r_[begin, len(cell)])

    def key(total: np.ndarray, at: np.ndarray, weight: np.ndarray) -> np.ndarray:
        return (mixed(total * MIX + at.astype(np.uint64) * np.uint64(0xD1342543DE82EF95) + seed) & ~ONE) | (weight == 0).astype(np.uint64)

    out = []
    whole = key(sums, here, rares)
    if b.deletion:
        of = np.repeat(np.arange(len(here)), counts)
        mine = here[of] < b.deletion
        out.append(whole[here < b.deletion])
        out.append(key((sums[of] - spread)[mine], cell[mine], (rares[of] - rare)[mine]))
        picked = here >= b.deletion
        here, whole, rares, counts = here[picked], whole[picked], rares[picked], counts[picked]
    need = differ + 1 - 2 * b.deletion
    if need > 0:
        out.append(whole[np.lexsort((whole, -(rares << 32) - counts))[:need]] if len(whole) > need else whole)
    # Cells without an n-gram: the last choice of the exact ones.
    more = need - len(whole)
    if b.deletion or more > 0:
        void = np.setdiff1d(np.arange(cells), cell)
        nothing = key(np.zeros(len(void), np.uint64), void, np.zeros(len(void), np.int64))
        out.append(nothing[void < b.deletion])
        out.append(np.sort(nothing[void >= b.deletion])[: max(0, more)])
    keys = np.concatenate(out)
    return np.unique(keys) if b.deletion else keys  # neighbours of a cell may be equal


def set_keys(found: np.ndarray, rare: np.ndarray, bands: list[Band], p: Join) -> np.ndarray:
    """The keys of a set in all bands where it has partners."""
    keys = [band_keys(found, rare, b, differ) for b, differ in bands_of(len(found), bands, p)]
    return np.concatenate(keys) if keys else np.zeros(0, np.uint64)


def all_shingles(text: bytes, size: int, hashes: WordHash) -> np.ndarray:
    """The hashes that ``shingle_set`` has, each as often as it stands there."""
    words = text.lower().split()
    size = min(size, len(words))
    return grams(hashes.all(words), size) + np.uint64(size) if words else np.zeros(0, np.uint64)


def frequent_buckets(docs: DataFrame, p: Join) -> np.ndarray:
    """Of the ``buckets`` buckets of n-grams those that are frequent, as booleans.

    All n-grams of all texts are counted. A task names the buckets that it sees more often than others, so the table that is
    summed up stays small; costs rest on it, results don't.
    """
    shift = np.uint64(64 - (p.buckets.bit_length() - 1))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = WordHash(), np.zeros(p.buckets, np.int32)
        for batch in batches:
            for run in runs(batch):
                found = [all_shingles(text, p.shingle, hashes) for text in texts(run)]
                seen += np.bincount((np.concatenate(found) >> shift).astype(np.int64), minlength=p.buckets).astype(np.int32)
        total = int(seen.sum(dtype=np.int64))
        often = np.flatnonzero(seen > 2 + 2 * total / p.buckets)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[-1, often].astype(np.int32)), pa.array(np.r_[total, seen[often]].astype(np.int64))], ["bucket", "seen"]
        )

    sums = text_rows(docs).mapInArrow(count, "bucket int, seen long").groupBy("bucket").agg(F.sum("seen").alias("seen"))
    summed = stage(sums, "frequent")
    total = summed.where("bucket < 0").agg(F.sum("seen")).first()[0] or 0
    hot = summed.where(F.col("bucket") >= 0).where(F.col("seen") >= max(p.least, p.often * total / p.buckets)).select("bucket")
    out = np.zeros(p.buckets, bool)
    out[hot.toArrow().column("bucket").to_numpy()] = True  # at most one in ``often`` of the buckets
    return out


def index_documents(docs: DataFrame, p: Join) -> DataFrame:
    """[doc_id, n_shingles, node, keys] of every row; of copies in one task only the first has keys."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(np.packbits(frequent_buckets(docs, p)).tobytes())
    shift, bands = np.uint64(64 - (p.buckets.bit_length() - 1)), all_bands(p)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rare_at = 1 - np.unpackbits(np.frombuffer(sent.value, np.uint8)).astype(np.int64)
        hashes, before = WordHash(), set()
        for batch in batches:
            for run in runs(batch):
                n, nodes, keys = [], [], []
                for text in texts(run):
                    found = shingle_set(text, p.shingle, hashes)
                    node = node_of(found)
                    n.append(len(found))
                    nodes.append(node)
                    if node is None or node in before:
                        keys.append(None)
                        continue
                    if len(before) >= WordHash.LIMIT:
                        before.clear()
                    before.add(node)
                    keys.append(set_keys(found, rare_at[(found >> shift).astype(np.int64)], bands, p).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [column(run, "doc_id"), pa.array(n, pa.int64()), pa.array(nodes, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                    ["doc_id", "n_shingles", "node", "keys"],
                )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return text_rows(docs, "doc_id").mapInArrow(index, f"doc_id {id_type}, n_shingles long, node long, keys array<long>")


def hubs_of_keys(indexed: DataFrame) -> DataFrame:
    """[node, hub, shared]: each class with the smallest class of each of its keys, and how many of them it is.

    A key behind which a rare n-gram stands has few rows: one window over its rows. The others may have any number: the smallest is found
    with map-side parts and joined back, spread over salts.
    """
    entries = indexed.where("keys is not null").select("node", F.explode("keys").alias("key"))
    hub = F.min("node").over(Window.partitionBy("key"))
    few = entries.where("(key & 1) = 0").withColumn("hub", hub).select("node", "hub")
    hot = entries.where("(key & 1) = 1")
    shared = hot.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("last")).where("hub < last").select("key", "hub")
    many = lookup_join(hot, shared, "key", "inner").select("node", "hub")
    return few.unionByName(many).where("node != hub").groupBy("node", "hub").agg(F.count(F.lit(1)).alias("shared"))


def jaccard_join(docs: DataFrame, p: Join = Join()) -> DataFrame:
    """[doc_id, n_shingles, component_id] of every row of docs [doc_id, text].

    ``component_id`` is the smallest id that a document can reach over links. Null texts and texts without words have an
    empty set and are linked with nothing; rows that repeat an id are rows of their own; a component of null ids only
    has a null id. Sets and n-grams are told apart by 64-bit hashes.
    """
    indexed = stage(index_documents(docs, p), "indexed")
    pairs = stage(hubs_of_keys(indexed), "pairs")
    return link_classes(docs, indexed, pairs, NearDup(shingle=p.shingle, percent=p.percent, block=p.block))
