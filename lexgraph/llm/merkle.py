"""Merkle manifest of a table: every row a leaf, a tree for each part, and the parts' roots in a tree of their own.

Leaves get their place by a range partitioning and counts of its partitions. Chunks of ``2 ** CHUNK`` neighbouring places hold whole
subtrees, so one shuffle brings all that a round needs: in the window over a chunk, level by level, ``lead`` and ``lag``
by the width of a subtree, masked by its slot and by the length of the run, give each first row its subtree's
sibling, and those of slot 0 hash the parent. What is left of a chunk is one row for the next round. Siblings travel back down by the
chunk's number, and inside a chunk from the first row of a subtree to all its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexgraph.plans.lookup import lookup_join
from lexgraph.plans.stage import stage, stage_sized

# Most levels of a round. A chunk of so many places stays in the memory of a window.
CHUNK = 8
PATH = "array<struct<left:boolean,sibling:string>>"


def digest(value: Column) -> Column:
    """Lowercase hexadecimal SHA-256 of the UTF-8 bytes."""
    return F.sha2(value.cast("binary"), 256)


def leaf(*fields: Column) -> Column:
    """Digest of the fields, each as its length in bytes, a colon and its value; a null is a dash."""
    parts = []
    for field in fields:
        text = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return digest(F.concat(*parts))


def joined_fairly(rows: DataFrame, side: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` with the one row of ``side`` for each key; no key has more rows than a range or a chunk holds."""
    staged = stage_sized(side, "side")
    return rows.join(F.broadcast(staged.df) if staged.small else staged.df, on, "left")


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``place``, from 0 in each ``part``, and ``total``, the rows of the part.

    ``order`` ranks the rows of a part; of equal rows any comes first. No part is gathered: the rows are dealt by range, parts and the ranks in them alike,
    and the counts of each range give the place of its first row.
    """
    # Rows that are equal in all else are told apart by where they are read, so that many of them are dealt over ranges too.
    told = stage(rows, "unplaced").withColumn("__row", F.monotonically_increasing_id())
    keys = [F.asc_nulls_first(c) for c in ("part", *order, "__row")]
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = told.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys).drop("__row")
    dealt = stage(ordered.withColumn("__at", F.monotonically_increasing_id()), "ranges")
    ranged = dealt.withColumn("__range", F.shiftright("__at", 33))
    counts = ranged.groupBy("part", "__range").agg(F.min("__at").alias("first"), F.count(F.lit(1)).alias("n"))
    part = Window.partitionBy("part")
    before = F.sum("n").over(part.orderBy("__range")) - F.col("n")
    starts = counts.select("part", "__range", (before - F.col("first")).alias("shift"), F.sum("n").over(part).alias("total"))
    joined = joined_fairly(ranged, starts, ["part", "__range"])
    return joined.withColumn("place", F.col("__at") + F.col("shift")).drop("__range", "__at", "shift")


def levels(nodes: Column) -> Column:
    """Levels above so many nodes until one is left: the binary digits of the last place."""
    return F.when(nodes > 1, F.length(F.bin(nodes - 1))).otherwise(0)


def climbed(nodes: DataFrame, up: int) -> DataFrame:
    """``nodes`` [part, place, height, node, ...] with ``chunk``, ``path`` inside the chunk and ``top``, the chunk's last parent.

    ``height`` is the number of levels still to go, ``up`` that of the levels of this round; ``top`` stands in the first row of a chunk only.
    """
    window = "(PARTITION BY part, chunk ORDER BY place)"
    out = nodes.selectExpr("*", f"shiftright(place, {CHUNK}) AS chunk", "node AS n0")
    for k in range(up):
        width, left, is_open = 1 << k, f"shiftright(place, {k}) % 2 = 1", f"height > {k}"
        # The sibling's first row is ``width`` rows away; beyond the end of the run there is none.
        sibling = f"coalesce(if({left}, lag(n{k}, {width}) OVER {window}, lead(n{k}, {width}) OVER {window}), '')"
        out = out.selectExpr("*", f"if(place % {width} = 0 AND {is_open}, {sibling}, NULL) AS s{k}")
        parent = f"CASE WHEN place % {2 * width} = 0 AND {is_open} THEN sha2(concat(n{k}, s{k}), 256) WHEN NOT {is_open} THEN n{k} END"
        out = out.selectExpr("*", f"{parent} AS n{k + 1}")
    # From the first row of each subtree to the others.
    down = "(PARTITION BY part, chunk ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    steps = [f"struct(shiftright(place, {k}) % 2 = 1 AS left, last(s{k}, true) OVER {down} AS sibling)" for k in range(up)]
    path = f"slice(cast(array({', '.join(steps)}) AS {PATH}), 1, least({up}, greatest(0, height))) AS path"
    return out.selectExpr(*nodes.columns, "chunk", path, f"if(place % {1 << CHUNK} = 0, n{up}, NULL) AS top")


def tops(nodes: DataFrame, up: int) -> DataFrame:
    """[part, place, height, node]: the chunks as nodes of the next round."""
    found = climbed(nodes.select("part", "place", "height", "node"), up).where("top is not null")
    return found.select("part", F.col("chunk").alias("place"), (F.col("height") - CHUNK).alias("height"), F.col("top").alias("node"))


def trees(rows: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """``rows`` [part, node, ...] with ``path``, and [part, node] of the roots of all parts.

    Two consecutive nodes become the digest of both, a last single one that of itself, until one is left.
    ``path`` [left, sibling] leads from a node to its part's root; ``sibling`` is '' where there is none.
    """
    base = stage(placed(rows, order).withColumn("height", levels(F.col("total"))).drop("total"), "placed")
    height = base.agg(F.max("height")).first()[0] or 0
    ups = [min(CHUNK, height - begin) for begin in range(0, max(1, height), CHUNK)]
    rounds = [base]
    for up in ups:
        rounds.append(stage(tops(rounds[-1], up), "tops"))
    roots = rounds.pop().select("part", "node")  # one node of each part
    above = None
    for nodes, up in zip(reversed(rounds), reversed(ups)):
        found = climbed(nodes, up)
        if above is not None:
            found = joined_fairly(found, above, ["part", "chunk"]).withColumn("path", F.concat("path", "upper")).drop("upper")
        found = found.drop("chunk", "top")
        above = found.select("part", F.col("place").alias("chunk"), F.col("path").alias("upper"))
    return found.drop("place", "height"), roots


def manifest(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` [part, leaf, ``key``, ...] with ``subroot``, ``root`` and ``path`` from the leaf to the root.

    The leaves of a part ascend by ``key``, a null first, then by leaf, so rows that repeat a key have one order and
    equal rows are interchangeable. The parts' roots ascend by part (null first, then by bytes). Each row is a leaf of its own; a table
    without rows has no root. Columns named like the new ones are replaced, all others stay.
    """
    kept = F.struct(*[f"`{c}`" for c in rows.columns if c not in ("leaf", "subroot", "root", "path")])
    # A part's name that is never null and keeps the order.
    name = F.coalesce(F.concat(F.lit("="), F.col("part").cast("string")), F.lit(""))
    leaves, subroots = trees(rows.select(name.alias("part"), F.col(f"`{key}`").alias("key"), F.col("leaf").alias("node"), kept.alias("kept")), ["key", "node"])
    upper, roots = trees(subroots.select(F.lit("").alias("part"), F.col("part").alias("name"), "node"), ["name"])
    top = roots.first()  # the one digest that the manifest ends in
    root = F.lit(top["node"] if top else None).cast("string")
    parts = upper.select(F.col("name").alias("part"), F.col("node").alias("subroot"), F.col("path").alias("upper"), root.alias("root"))
    known = stage_sized(parts, "subroots")
    joined = lookup_join(leaves, known.df, "part", small=known.small)
    return joined.select("kept.*", F.col("node").alias("leaf"), "subroot", "root", F.concat("path", "upper").alias("path"))


def proof(path: Column) -> Column:
    """Digest of the siblings of a path, from the leaf to the root."""
    return digest(F.array_join(F.transform(path, lambda step: step["sibling"]), ""))


def folded(path: Column, leaf: Column) -> Column:
    """The root that a leaf gives with the siblings of ``path``."""
    step = lambda node, s: digest(F.when(s["left"], F.concat(s["sibling"], node)).otherwise(F.concat(node, s["sibling"])))
    return F.aggregate(path, leaf, step)
