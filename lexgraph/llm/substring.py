"""Substring dedup by seed and extend.

Seeds are winnowed anchors: of every ``length - seed + 1`` consecutive seed hashes the smallest is an anchor, so two
copies of ``length`` words always share one at the same place. An anchor is sent to its partition with one hash of its
surroundings, all words that a window around it can reach. Where anchor and surroundings agree the match extends fully
to both sides, and all places but the first are covered. Only where an anchor occurs in different surroundings, at the
edges of repeats, are the windows around the first place of each looked at one by one. The union of what is covered is
the maximal repeats.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lexgraph.llm.common import MIX, WordHash, arrow_pass, by_value, column, grams, mixed, runs, text_rows, texts
from lexgraph.plans.stage import stage, stage_sized

by_value(__name__)


class Repeats(NamedTuple):
    """A repeat has at least ``length`` words; anchors are runs of ``seed`` words (``length - seed`` at most 15)."""

    length: int = 20
    seed: int = 8

    @property
    def reach(self) -> int:
        """Words beside an anchor that a window around it can hold."""
        return self.length - self.seed


def sliding(x: np.ndarray, size: int, op) -> np.ndarray:
    """``op`` over each run of ``size`` values, by doubling."""
    width = 1
    while 2 * width <= size:
        x = op(x[:-width], x[width:])
        width *= 2
    rest = size - width
    return op(x[: len(x) - rest], x[rest:]) if rest else x


def anchor_places(seeds: np.ndarray, window: int) -> np.ndarray:
    """Places of the seeds that are smallest in some window; equal smallest ones all count, so copies agree."""
    if len(seeds) < window:
        return np.zeros(0, np.int64)
    least = sliding(seeds, window, np.minimum)
    edge = np.zeros(window - 1, np.uint64)
    return np.flatnonzero(sliding(np.concatenate([edge, least, edge]), window, np.maximum) == seeds)


def span_hashes(h: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the words from ``begin`` to ``end`` for each pair, spans of at most about 40 words."""
    out = np.zeros(len(begin), np.uint64)
    for i in range(int((end - begin).max(initial=0))):
        at = begin + i
        inside = at < end
        out = np.where(inside, out * MIX + h[np.minimum(at, len(h) - 1)], out)
    return mixed(out ^ mixed((end - begin).astype(np.uint64)))


# The place of a row within its id: 31 bits of the text's hash, so that rows with one id and different
# texts are told apart, then the word's position in 32 bits, more than any text has words.
PLACE_BITS = 32


def text_key():
    return F.crc32("text").bitwiseAND(F.lit(0x7FFFFFFF))


def seeds_of(docs: DataFrame, p: Repeats) -> DataFrame:
    """[anchor, around, doc_id, place, shape] of the anchors of docs [doc_id, key, text].

    ``place`` is key and position; ``shape`` holds how many words of the surroundings lie before and after the anchor,
    and whether the place is known to be covered.
    Of equal anchors with equal surroundings in one run of rows only the first goes on as a seed; the others are
    known to be covered and get an anchor of their own, so copies are spread and never meet in one task.
    """
    id_type = docs.schema["doc_id"].dataType

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHash()
        for batch in batches:
            for run in runs(batch, 6 << 20):
                keys = column(run, "key").to_numpy(zero_copy_only=False)
                parts = []
                for i, text in enumerate(texts(run)):
                    words = text.split()
                    if len(words) < p.length:
                        continue
                    h = hashes.all(words)
                    seeds = grams(h, p.seed)
                    at = anchor_places(seeds, p.reach + 1)
                    begin = np.maximum(at - p.reach, 0)
                    end = np.minimum(at + p.length, len(h))
                    # The anchor's place in its surroundings counts: in periodic text it may stand there twice.
                    around = mixed(span_hashes(h, begin, end) + (at - begin).astype(np.uint64))
                    parts.append((seeds[at], around, np.full(len(at), i), at, at - begin, end - at - p.seed))
                if not parts:
                    continue
                anchor, around, row, at, left, right = (np.concatenate(x) for x in zip(*parts))
                # Rows in the order of ids: of equal ones the smallest (id, key, position) is the seed. Null ids come first.
                ids = column(run, "doc_id")
                order_of = np.empty(run.num_rows, np.int64)
                table = pa.table({"id": ids, "key": column(run, "key"), "null": ids.is_null()})
                order = pc.sort_indices(table, [("null", "descending"), ("id", "ascending"), ("key", "ascending")]).to_numpy()
                order_of[order] = np.arange(len(order))
                by = np.lexsort((at, order_of[row], around, anchor))
                again = np.zeros(len(by), bool)
                again[by[1:]] = (anchor[by[1:]] == anchor[by[:-1]]) & (around[by[1:]] == around[by[:-1]])
                # Rows that repeat id and text stand at the same place: none of them is earlier.
                same = np.zeros(len(by), bool)
                lead = np.maximum.accumulate(np.where(again[by], 0, np.arange(len(by))))
                head = by[lead]
                id_rank = rank_of_rows(table, order)
                same[by] = (id_rank[row[by]] == id_rank[row[head]]) & (at[by] == at[head])
                covered = again & ~same
                place = (keys[row].astype(np.int64) << PLACE_BITS) | at
                own = mixed(place.astype(np.uint64) * MIX + anchor + np.arange(len(by), dtype=np.uint64))
                anchor = np.where(covered, own, anchor)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), pa.array(around.view(np.int64)), ids.take(pa.array(row)), pa.array(place),
                     pa.array((left * 32 + right * 2 + covered).astype(np.int16))],
                    ["anchor", "around", "doc_id", "place", "shape"],
                )

    schema = f"anchor long, around long, doc_id {id_type.simpleString()}, place long, shape short"
    return docs.mapInArrow(find, schema)


def rank_of_rows(table: pa.Table, order: np.ndarray) -> np.ndarray:
    """Number of each row's (id, key), equal rows alike; ``order`` sorts the rows."""
    ids, keys = table.column("id").take(pa.array(order)).to_pylist(), table.column("key").to_numpy()[order]
    step = np.array([True, *(a != b for a, b in zip(ids[1:], ids[:-1]))], bool)
    step[1:] |= keys[1:] != keys[:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(step)
    return out


def seed_spans(seeds: DataFrame, p: Repeats) -> DataFrame:
    """[doc_id, key, pos, begin, end]: spans known to be covered, and with a null ``end`` the places to look at closely.

    Everything about an anchor happens in its partition: the first place of each surroundings, and whether there is
    more than one.
    """
    here = seeds.repartition("anchor")
    first = F.row_number().over(Window.partitionBy("anchor", "around").orderBy("doc_id", "place"))
    lead = F.first(F.struct(F.col("doc_id").alias("d"), F.col("place").alias("p"))).over(
        Window.partitionBy("anchor", "around").orderBy("doc_id", "place").rowsBetween(Window.unboundedPreceding, 0)
    )
    by_anchor = Window.partitionBy("anchor")
    several = F.min("around").over(by_anchor) < F.max("around").over(by_anchor)
    pos = F.col("place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    left = F.shiftright(F.col("shape").cast("int"), 5)
    right = F.shiftright(F.col("shape").cast("int"), 1).bitwiseAND(F.lit(15))
    # A row at the very place of the first one is a repeated row of the same document.
    later = (F.col("shape") % 2 == 1) | ((F.col("first") > 1) & ~(F.col("lead.d").eqNullSafe(F.col("doc_id")) & (F.col("lead.p") == F.col("place"))))
    return (
        here.withColumn("first", first).withColumn("lead", lead).withColumn("several", several)
        .withColumn("later", later)
        .where(F.col("later") | (F.col("several") & (F.col("first") == 1)))
        .select(
            "doc_id", F.shiftright("place", PLACE_BITS).alias("key"), pos.cast("int").alias("pos"),
            (pos - left).cast("int").alias("begin"),
            F.when(F.col("later"), (pos + p.seed + right).cast("int")).alias("end"),
        )
    )


def by_document(docs: DataFrame, found: DataFrame, label: str, how: str) -> DataFrame:
    """docs [doc_id, key, text] joined with one row of ``found`` per (doc_id, key), broadcast only if counted as small."""
    staged = stage_sized(found.withColumnsRenamed({"doc_id": "__id", "key": "__key"}), label)
    side = F.broadcast(staged.df) if staged.small else staged.df
    on = docs["doc_id"].eqNullSafe(side["__id"]) & (docs["key"] == side["__key"])
    return docs.join(side, on, how).drop("__id", "__key")


def edge_spans(docs: DataFrame, places: DataFrame, p: Repeats) -> DataFrame:
    """[doc_id, key, begin, end] of the windows around ``places`` [doc_id, key, pos] that start earlier elsewhere."""
    lists = places.groupBy("doc_id", "key").agg(F.collect_list("pos").alias("pos"))  # places of one text
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHash()
        for batch in batches:
            for run in runs(batch):
                parts = []
                for i, (text, pos) in enumerate(zip(texts(run), column(run, "pos").to_pylist())):
                    h = hashes.all(text.split())
                    starts = (np.array(sorted(pos), np.int64)[:, None] - np.arange(p.reach + 1)[None, :]).ravel()
                    starts = np.unique(starts[(starts >= 0) & (starts + p.length <= len(h))])
                    # Two hashes: windows are told apart by 128 bits.
                    one = span_hashes(h, starts, starts + p.length)
                    two = span_hashes(mixed(h), starts, starts + p.length)
                    parts.append((one, two, np.full(len(starts), i), starts))
                if not parts:
                    continue
                one, two, row, start = (np.concatenate(x) for x in zip(*parts))
                row = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), column(run, "doc_id").take(row),
                     column(run, "key").take(row), pa.array(start.astype(np.int32))],
                    ["one", "two", "doc_id", "key", "begin"],
                )

    near = by_document(docs, lists, "edges", "inner")
    schema = f"one long, two long, doc_id {id_type}, key long, begin int"
    each = stage(near.select("doc_id", "key", "text", "pos").mapInArrow(windows, schema), "windows")
    place = F.struct("doc_id", "key", "begin")
    firsts = each.groupBy("one", "two").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first < last").drop("last")
    return (
        each.join(firsts, ["one", "two"]).where(place > F.col("first"))
        .select("doc_id", "key", "begin", (F.col("begin") + p.length).alias("end"))
    )


def merged_spans(spans: DataFrame) -> DataFrame:
    """[doc_id, key, spans array<int>]: begins and ends of the union of each document's spans, alternating."""
    id_type = spans.schema["doc_id"].dataType.simpleString()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for found in column(batch, "found").to_pylist():
                flat: list[int] = []
                for begin, end in sorted((x["begin"], x["end"]) for x in found):
                    if flat and begin <= flat[-1]:
                        flat[-1] = max(flat[-1], end)
                    else:
                        flat += [begin, end]
                out.append(flat)
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), column(batch, "key"), pa.array(out, pa.list_(pa.int32()))], ["doc_id", "key", "spans"]
            )

    lists = spans.groupBy("doc_id", "key").agg(F.collect_list(F.struct("begin", "end")).alias("found"))  # of one text
    return lists.mapInArrow(merge, f"doc_id {id_type}, key long, spans array<int>")


def repeated_spans(docs: DataFrame, p: Repeats = Repeats()) -> DataFrame:
    """docs [doc_id, key, text] with ``spans``: the words that a repeat covers, null if none."""
    assert 0 < p.reach <= 15, "an anchor's surroundings must fit"
    found = stage(seed_spans(seeds_of(docs, p), p), "seeds")
    covered = found.where("end is not null").select("doc_id", "key", "begin", "end")
    edges = edge_spans(docs, found.where("end is null").select("doc_id", "key", "pos"), p)
    spans = merged_spans(covered.unionByName(edges))
    return by_document(docs, spans, "spans", "left")


def keyed(docs: DataFrame) -> DataFrame:
    """[doc_id, key, text as bytes]."""
    return text_rows(docs, "doc_id").withColumn("key", text_key()).select("doc_id", "key", "text")


def kept_mask(n: int, spans: list[int] | None) -> np.ndarray:
    keep = np.ones(n, bool)
    for begin, end in zip((spans or [])[::2], (spans or [])[1::2]):
        keep[begin:end] = False
    return keep


def dedup_digests(docs: DataFrame, p: Repeats = Repeats()) -> DataFrame:
    """[doc_id, n_words, n_removed, kept_sha256] of every row of docs [doc_id, text].

    A word goes if a window of ``p.length`` words covers it whose words also start earlier: in a document with a smaller
    id, or earlier in the same one. Null texts have no words; rows with a null id come before all others; rows that
    share an id come in the order of their text's hash, and equal ones count as one row.
    """

    def digest(batch: pa.RecordBatch) -> pa.RecordBatch:
        total, removed, sha = [], [], []
        for text, spans in zip(texts(batch), column(batch, "spans").to_pylist()):
            words = text.split()
            keep = kept_mask(len(words), spans)
            kept = b" ".join(words if spans is None else [w for w, k in zip(words, keep.tolist()) if k])
            total.append(len(words))
            removed.append(int(len(words) - keep.sum()))
            sha.append(sha256(kept).hexdigest())
        return pa.RecordBatch.from_arrays(
            [column(batch, "doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha, pa.string())],
            ["doc_id", "n_words", "n_removed", "kept_sha256"],
        )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    found = repeated_spans(keyed(docs), p).select("doc_id", "text", "spans")
    return arrow_pass(found, digest, f"doc_id {id_type}, n_words long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame, p: Repeats = Repeats()) -> DataFrame:
    """``docs`` with the repeated words taken out of ``text``; all other columns stay.

    A text without repeats stays byte for byte; of others the kept words stand with one blank between them,
    or a line end where the original had one between them.
    """
    import re

    word = re.compile(rb"[^\x20\x09-\x0D]+")
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    renamed = [F.col(f"`{c}`").alias(f"__other{i}") for i, c in enumerate(others)]

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for text, spans in zip(texts(batch), column(batch, "spans").to_pylist()):
            if spans is None:
                out.append(text)
                continue
            places = [m.span() for m in word.finditer(text)]
            keep = kept_mask(len(places), spans)
            parts, last = [], 0
            for i, (begin, end) in enumerate(places):
                if keep[i]:
                    if parts:
                        parts.append(b"\n" if b"\n" in text[last:begin] else b" ")
                    parts.append(text[begin:end])
                    last = end
            out.append(b"".join(parts))
        names = [n for n in batch.schema.names if n not in ("text", "spans")]
        return pa.RecordBatch.from_arrays(
            [*(column(batch, n) for n in names), pa.array(out, pa.binary()).cast(pa.string())], [*names, "text"]
        )

    spans = repeated_spans(keyed(docs), p).select("doc_id", "key", "spans").where(F.col("spans").isNotNull()).distinct()
    rows = text_rows(docs, "doc_id", *renamed).withColumn("key", text_key())
    joined = by_document(rows, spans, "cuts", "left").drop("key")
    schema = StructType([f for f in joined.schema.fields if f.name not in ("text", "spans")]).add("text", "string")
    done = arrow_pass(joined, cut, schema)
    back = {"doc_id": F.col("doc_id"), "text": F.col("text")} | {c: F.col(f"__other{i}").alias(c) for i, c in enumerate(others)}
    return done.select([back[c] for c in docs.columns])
