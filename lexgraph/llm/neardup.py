"""MinHash near-duplicates by a multi-index Hamming join.

Texts with the same shingle set are one class. A class has a signature of ``symbols`` b-bit MinHash values; the
signature distance of two classes is the number of values that differ. The signature is split into chunks of ``chunk``
values. Of two signatures that differ in at most ``2 * chunks - 1`` values, some chunk differs in at most one (pigeonhole),
so each chunk is entered under every choice of one left-out value: all pairs under that distance share a key.

Pairs inside a key are not unrolled. The best connected class of each key is its hub, and every class is compared with the
hubs of its keys on full sets. Jaccard distance is a metric, so two classes can only be linked if their distances to a
common hub differ by no more than the threshold: what is not yet connected is compared inside such rings, in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lexgraph.llm.common import MIX, WordHash, by_value, column, grams, mixed, runs, text_rows, texts, without
from lexgraph.plans.stage import stage, stage_sized

by_value(__name__)


class NearDup(NamedTuple):
    """Links: ``100 * intersection >= percent * union`` of the sets of ``shingle``-word shingles.

    With 40 values in chunks of 4 every pair of signatures at distance 19 or less is found; a pair of sets with a
    similarity of 0.85 exceeds that with a chance of 2e-7, one of 0.8 with 1e-5.
    ``block`` bounds the shingles that a task compares at once, ``most`` the classes.
    """

    shingle: int = 5
    percent: int = 80
    symbols: int = 40
    chunk: int = 4
    bits: int = 16
    block: int = 250_000
    most: int = 1_500


def seeds(count: int) -> np.ndarray:
    """Odd multipliers, the same in every process."""
    return mixed(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


def shingle_set(text: bytes, size: int, hashes: WordHash) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; of fewer words the whole sequence; empty without words."""
    words = text.lower().split()  # of bytes: only A-Z change
    if not words:
        return np.zeros(0, np.uint64)
    h = hashes.all(words)
    return np.unique(grams(h, min(size, len(h))) + np.uint64(min(size, len(h))))


def node_of(found: np.ndarray) -> int | None:
    """Number of the class of a set; null for the empty set, which is linked with nothing."""
    return int.from_bytes(blake2b(found.tobytes(), digest_size=8).digest(), "little", signed=True) if len(found) else None


def signature(found: np.ndarray, p: NearDup, mult: np.ndarray) -> np.ndarray:
    """``symbols`` values of ``bits`` bits; permutations are xor and multiplication modulo 2**64."""
    least = np.full(len(mult), np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(found), 4096):
        part = found[at : at + 4096, None]
        least = np.minimum(least, ((part ^ (mult * MIX)[None, :]) * mult[None, :]).min(axis=0))
    return mixed(least) >> np.uint64(64 - p.bits)


def index_keys(signed: np.ndarray, p: NearDup) -> np.ndarray:
    """One key for each value: its chunk without it."""
    out = np.arange(p.symbols)
    begin = out - out % p.chunk
    keys = (out + 1).astype(np.uint64)
    for step in range(p.chunk):
        at = begin + step
        counts = (at != out) & (at < p.symbols)
        keys = np.where(counts, keys * MIX + signed[np.minimum(at, p.symbols - 1)], keys)
    return mixed(keys)


def sign_documents(docs: DataFrame, p: NearDup) -> DataFrame:
    """[doc_id, n_shingles, node, keys] of every row."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, mult = WordHash(), seeds(p.symbols)
        for batch in batches:
            for run in runs(batch):
                n, nodes, keys = [], [], []
                for text in texts(run):
                    found = shingle_set(text, p.shingle, hashes)
                    n.append(len(found))
                    nodes.append(node_of(found))
                    keys.append(index_keys(signature(found, p, mult), p).view(np.int64) if len(found) else None)
                yield pa.RecordBatch.from_arrays(
                    [column(run, "doc_id"), pa.array(n, pa.int64()), pa.array(nodes, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                    ["doc_id", "n_shingles", "node", "keys"],
                )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return text_rows(docs, "doc_id").mapInArrow(sign, f"doc_id {id_type}, n_shingles long, node long, keys array<long>")


def class_sets(docs: DataFrame, wanted: DataFrame, p: NearDup) -> DataFrame:
    """[node, set] of the classes ``wanted`` [doc_id, node], read from the text of one document of each."""
    staged = stage_sized(wanted.select(F.col("doc_id").alias("__id"), F.col("node").alias("__node")), "wanted")
    side = F.broadcast(staged.df) if staged.small else staged.df
    rows = text_rows(docs.select("doc_id", "text").join(side, F.col("doc_id").eqNullSafe(F.col("__id"))), F.col("__node").alias("node"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHash()
        for batch in batches:
            for run in runs(batch):
                found = [shingle_set(text, p.shingle, hashes) for text in texts(run)]
                # Rows may share an id: only those of the wanted class count.
                mine = [i for i, node in enumerate(column(run, "node").to_pylist()) if node_of(found[i]) == node]
                yield pa.RecordBatch.from_arrays(
                    [column(run, "node").take(pa.array(mine, pa.int64())), pa.array([found[i].view(np.int64) for i in mine], pa.list_(pa.int64()))],
                    ["node", "set"],
                )

    return stage(rows.mapInArrow(sets, "node long, set array<long>"), "sets")


def hub_pairs(signed: DataFrame) -> DataFrame:
    """[node, hub, shared]: each class with the hubs of its keys and how many, the hub itself left out; keys of one class have no hub."""
    entries = stage(signed.where("node is not null").groupBy("node").agg(F.any_value("keys").alias("keys")), "classes").select(
        "node", F.explode("keys").alias("key")
    )
    shared = entries.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.min("node").alias("a"), F.max("node").alias("b")).where("a < b")
    members = stage(entries.join(shared.select("key", "members"), "key"), "members")
    degree = members.groupBy("node").agg(F.sum("members").alias("degree"))
    ranked = members.join(degree, "node").select("key", "node", F.struct("degree", "node").alias("rank"))
    hubs = ranked.groupBy("key").agg(F.max("rank")["node"].alias("hub"))
    return members.join(hubs, "key").where("node != hub").groupBy("node", "hub").agg(F.count(F.lit(1)).alias("shared"))


def linked(common, n1, n2, p: NearDup):
    return 100 * common >= p.percent * (n1 + n2 - common)


def hub_distances(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """[node, hub, n, hub_n, common] on full sets."""
    mine = sets.select("node", F.col("set").alias("a"))
    theirs = sets.select(F.col("node").alias("hub"), F.col("set").alias("b"))
    both = pairs.join(mine, "node").join(theirs, "hub")
    return both.select(
        "node", "hub", F.size("a").cast("long").alias("n"), F.size("b").cast("long").alias("hub_n"),
        F.size(F.array_intersect("a", "b")).cast("long").alias("common"),
    )


def components(edges: DataFrame) -> DataFrame:
    """[node, root] of the nodes of ``edges`` [u, v]: the smallest node that each can reach.

    Alternating stars: all neighbours of a node are tied to the smallest of them, first the larger ones, then the smaller
    ones, until nothing changes. A node's neighbours are never gathered; each step is a staged table.
    """
    now = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    before = None
    while True:
        seen = Observation()
        mark = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        now = stage(now.observe(seen, F.count(F.lit(1)).alias("n"), mark.alias("mark")), "stars")
        state = (seen.get["n"], seen.get["mark"])
        if state == before or not state[0]:
            return now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            ).groupBy("node").agg(F.min("root").alias("root"))
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        smallest = down.groupBy("u").agg(F.min("v").alias("m"))
        tied = down.join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = tied.unionByName(smallest.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def ring_edges(measured: DataFrame, roots: DataFrame, sets: DataFrame, p: NearDup) -> DataFrame:
    """[u, v]: the links that the hubs have not shown, from comparing inside rings of like distance to a hub.

    ``measured`` has each class's distance to its hubs. Two linked classes with a common hub stand in the same ring or in
    neighbouring ones, so a class is entered in its ring and the next. Rings whose classes are all connected
    already are left out. Larger rings are cut into blocks of bounded size, and blocks are compared two by two.
    """
    width = 1 - p.percent / 100 + 1e-9
    ring = F.floor((1 - F.col("common") / (F.col("n") + F.col("hub_n") - F.col("common"))) / width).cast("int")
    placed = (
        measured.join(roots, "node", "left").select("hub", "node", "n", F.coalesce("root", "node").alias("root"), ring.alias("ring"))
        .select("hub", "node", "n", "root", F.explode(F.array(F.col("ring"), F.col("ring") + 1)).alias("ring"))
    )
    blocks = F.ceil(F.greatest(F.sum("n") / p.block, F.count(F.lit(1)) / p.most)).cast("int").alias("blocks")
    open_rings = (
        placed.groupBy("hub", "ring")
        .agg(F.min("root").alias("a"), F.max("root").alias("b"), blocks)
        .where("a < b").select("hub", "ring", "blocks")
    )
    # A class of block i takes part in the pairs {i, j} for all j.
    mine = F.pmod(F.xxhash64("node", "hub"), F.col("blocks")).cast("int")
    dealt = (
        placed.join(open_rings, ["hub", "ring"]).withColumn("mine", mine)
        .select("hub", "ring", "node", "root", "mine", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        .select("hub", "ring", "node", "root", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))
    )

    def compare(table: pa.Table) -> pa.Table:
        nodes, root = table.column("node").to_numpy(), table.column("root").to_numpy()
        found = table.column("set").combine_chunks()
        sizes = np.diff(found.offsets.to_numpy())
        owner = np.repeat(np.arange(len(nodes)), sizes)
        _, col, seen = np.unique(found.flatten().to_numpy(), return_inverse=True, return_counts=True)
        often = seen[col] > 1
        rename = np.cumsum(seen > 1) - 1
        col, owner = rename[col[often]], owner[often]
        order = np.argsort(col, kind="stable")
        col, owner = col[order], owner[order]
        common = np.zeros((len(nodes), len(nodes)), np.float32)
        for begin in range(0, int(col[-1]) + 1 if len(col) else 0, 2048):
            a, b = np.searchsorted(col, [begin, begin + 2048])
            part = np.zeros((len(nodes), 2048), np.float32)
            part[owner[a:b], col[a:b] - begin] = 1
            common += part @ part.T
        hit = (100 * common >= p.percent * (sizes[:, None] + sizes[None, :] - common)) & (root[:, None] < root[None, :])
        u, v = np.nonzero(hit)
        # One link for each two components that meet here.
        _, one = np.unique(np.stack([root[u], root[v]]), axis=1, return_index=True)
        return pa.table({"u": nodes[u[one]], "v": nodes[v[one]]})

    with_sets = dealt.join(sets, "node")
    return with_sets.groupBy("hub", "ring", "i", "j").applyInArrow(compare, "u long, v long")


def near_duplicates(docs: DataFrame, p: NearDup = NearDup()) -> DataFrame:
    """[doc_id, n_shingles, component_id, kept] of every row of docs [doc_id, text].

    ``component_id`` is the smallest id that a document can reach over links. Null texts and texts without words have an
    empty set and are linked with nothing; rows that repeat an id are rows of their own; a component of null ids only
    has a null id. Sets, classes and shingles are told apart by 64-bit hashes.
    """
    signed = stage(sign_documents(docs, p), "signed")
    pairs = stage(hub_pairs(signed.select("node", "keys")), "pairs")
    found = link_classes(docs, signed, pairs, p)
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def link_classes(docs: DataFrame, signed: DataFrame, pairs: DataFrame, p: NearDup) -> DataFrame:
    """[doc_id, n_shingles, component_id] of every row of the staged ``signed`` [doc_id, n_shingles, node].

    ``pairs`` [node, hub, shared], staged: every two classes that may be linked are a pair, or have a hub in common. Links are
    confirmed on full sets.
    """
    classes = signed.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    involved = pairs.select("node").unionByName(pairs.select(F.col("hub").alias("node"))).distinct()
    sets = class_sets(docs, classes.join(involved, "node"), p)
    # Every class against the hub with which it shares most keys. That ties most groups together, and sets move once.
    best = pairs.groupBy("node").agg(F.max(F.struct("shared", "hub"))["hub"].alias("hub"))
    near = lambda df: df.where(linked(F.col("common"), F.col("n"), F.col("hub_n"), p)).select(F.col("node").alias("u"), F.col("hub").alias("v"))
    some = stage(hub_distances(best, sets), "measured")
    tied = stage(components(near(some)), "tied")
    # A hub all of whose classes are connected with it has nothing more to tell; of the others all classes count.
    root_of = lambda name: tied.select(F.col("node").alias(name), F.col("root").alias(f"{name}_root"))
    placed = pairs.join(root_of("node"), "node", "left").join(root_of("hub"), "hub", "left")
    differs = F.coalesce("node_root", "node") != F.coalesce("hub_root", "hub")
    open_hubs = placed.groupBy("hub").agg(F.max(differs).alias("open")).where("open").select("hub")
    others = pairs.select("node", "hub").join(open_hubs, "hub").join(some.select("node", "hub"), ["node", "hub"], "left_anti")
    more = stage(hub_distances(others, sets), "measured")
    measured = more.unionByName(some.join(open_hubs, "hub").select(*more.columns))
    first = stage(components(near(more).unionByName(tied.select(F.col("node").alias("u"), F.col("root").alias("v")))), "roots")
    rest = stage(ring_edges(measured, first, sets, p), "rest")
    links = first.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(rest)
    roots = components(links)
    named = classes.join(roots, "node", "left").select("node", "doc_id", F.coalesce("root", "node").alias("root"))
    ids = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    by_node = named.join(ids, "root").select("node", "component_id")
    found = signed.select("doc_id", "n_shingles", "node").join(by_node, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"))


def keep_one(docs: DataFrame, p: NearDup = NearDup()) -> DataFrame:
    """The rows of ``docs`` whose id is that of their component: one document of each, with all its columns.

    Of rows that repeat an id all stay if it is the component's; documents without words stay.
    """
    found = near_duplicates(docs.select("doc_id", "text"), p)
    return without(docs, found.where(~F.col("kept")))
