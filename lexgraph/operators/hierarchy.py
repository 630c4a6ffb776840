"""Tag hierarchy: edges from co-occurrence, layers, root-to-tag paths, paths of terms.

Edges run child -> parent and form a DAG. The loops below run one step per layer (layers, while many edges are left) or
per doubling of the path length (paths); every step is staged, so neither lineage nor the
driver grows with the graph.
"""

from __future__ import annotations

import sys
from typing import NamedTuple

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lexgraph.functions.strings import jsplit
from lexgraph.plans.lookup import lookup_join
from lexgraph.plans.stage import MAX_BROADCAST_ROWS, Staged, lookup_side, new_path, stage, stage_sized

# Ship the functions of this module with the task, so executors need no installation of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def tag_edges(cooccur: DataFrame, thres: float, min_co: int = 10) -> DataFrame:
    """[child, parent] of strongly paired tags; the rarer tag is the child.

    A pair is strong if it occurs more than ``min_co`` times and more often than the whole
    part of ``thres`` times the rarer tag's count. With equal counts ``tag1`` is the child.
    """
    rarer = F.least("tag1num", "tag2num")
    strong = (F.col("twotagnum") > min_co) & ((rarer * F.lit(float(thres))).cast("long") < F.col("twotagnum"))
    swap = F.col("tag1num") > F.col("tag2num")
    return cooccur.where(strong).select(
        F.when(swap, F.col("tag2")).otherwise(F.col("tag1")).alias("child"),
        F.when(swap, F.col("tag1")).otherwise(F.col("tag2")).alias("parent"),
    )


class TagLayers(NamedTuple):
    kept: DataFrame  # [child, parent, round]
    layers: DataFrame  # [tag, layer]


def _rounds(edges: Staged) -> tuple[DataFrame, int]:
    """[child, parent, round], the round in which the parent is nobody's child any more; and their number.

    Each round takes the edges of the current top tags. Equal to one plus the longest path
    from a root to the parent. A round that takes nothing has met a cycle.

    Rounds are deltas: every tag has the number of its parents, which is lowered by what a round took of them, and the tags that come to none
    are the next tops. A round reads the edges left and writes what it took; the edges are written anew only when half of
    them are gone. As soon as those left are few enough to be broadcast, one task does the other rounds, so a deep graph's long tail is read once.
    """
    spark = edges.df.sparkSession
    root = new_path(spark, "rounds")
    kind = "child string, parent string"
    rest, held, left, rnd = edges, edges.rows, edges.rows, 0
    taken_by = []
    if not rest.small:
        # A tag's open parents; each round's tops are those that came to none.
        is_child = edges.df.groupBy(F.col("child").alias("tag")).agg(F.count(F.lit(1)).alias("open"))
        state = stage_sized(is_child, "open")
        tops = stage_sized(edges.df.select(F.col("parent").alias("tag")).distinct().join(state.df, "tag", "left_anti"), "tops")
        while left and not rest.small:
            rnd += 1
            seen = Observation()
            place = f"{root}/round={rnd}"
            lookup_join(rest.df, tops.df.select(F.col("tag").alias("parent")), "parent", "left_semi", tops.small).observe(
                seen, F.count(F.lit(1)).alias("n")
            ).write.parquet(place)
            if not seen.get["n"]:
                raise ValueError("cycle in tag edges")
            left -= seen.get["n"]
            taken = spark.read.schema(kind).parquet(place)
            taken_by.append(place)
            lowered = stage_sized(taken.groupBy(F.col("child").alias("tag")).agg(F.count(F.lit(1)).alias("gone")), "lowered")
            after = lookup_join(state.df, lowered.df, "tag", small=lowered.small)
            state = stage_sized(after.select("tag", (F.col("open") - F.coalesce("gone", F.lit(0))).alias("open")).where("open >= 0"), "open")
            tops = stage_sized(state.df.where("open = 0").select("tag"), "tops")
            # Tops leave the table of open tags; their edges go in the next round.
            state = state._replace(df=state.df.where("open > 0"))
            if 2 * left <= held:
                gone = spark.read.schema(f"{kind}, round int").option("basePath", root).parquet(*taken_by).select(F.col("parent").alias("__p")).distinct()
                rest = stage_sized(rest.df.join(gone, rest.df["parent"] == gone["__p"], "left_anti"), "edges_left")
                held = left
    if not left:
        if not rnd:
            return edges.df.withColumn("round", F.lit(0)), 0
        read = spark.read.schema(f"{kind}, round int").parquet(root)
        return read.select("child", "parent", "round"), rnd
    done = rnd
    whole = rest.df.withColumn("all", F.lit(0)).groupBy("all")
    late = stage(whole.applyInArrow(lambda table: last_rounds(table, done), f"{kind}, round int"), "last_rounds")
    most = late.agg(F.max("round"), F.min("round")).first()
    if most[1] < 0:
        raise ValueError("cycle in tag edges")
    if not done:
        return late, most[0]
    early = spark.read.schema(f"{kind}, round int").parquet(root).select("child", "parent", "round")
    return early.unionByName(late), most[0]


def last_rounds(table: pa.Table, done: int) -> pa.Table:
    """The rounds of a few edges [child, parent], the first one after ``done``; -1 for edges under a cycle."""
    child, parent = table["child"].to_pylist(), table["parent"].to_pylist()
    under, open_ = {}, {}
    for at, (c, p) in enumerate(zip(child, parent)):
        under.setdefault(p, []).append(at)
        open_[c] = open_.get(c, 0) + 1
    rounds, tops, now = [-1] * len(child), [p for p in under if p not in open_], done
    while tops:
        now, after = now + 1, []
        for p in tops:
            for at in under.get(p, ()):
                rounds[at] = now
                open_[child[at]] -= 1
                if not open_[child[at]]:
                    after.append(child[at])
        tops = after
    return pa.table({"child": table["child"], "parent": table["parent"], "round": pa.array(rounds, pa.int32())})


def tag_layers(edges: DataFrame) -> TagLayers:
    """Remove edges that skip a level and number the layers.

    In the round of parent T the edge X -> T is dropped if X is also the child of a child of any
    top tag of that round. A child may keep several parents, also from different rounds; its layer
    is its longest distance from a root. A root whose edges are all dropped disappears.
    """
    start = stage_sized(edges.select("child", "parent").distinct(), "edges")
    rounds, n_rounds = _rounds(start)
    # Rounds in which a tag is the child of a top: at most one entry per layer and tag.
    child_in, small = lookup_side(
        rounds.groupBy(F.col("child").alias("parent")).agg(F.collect_set("round").alias("rs")),
        "child_rounds",
        start.small,
    )
    skips, skips_small = lookup_side(
        lookup_join(rounds.select("child", "parent"), child_in, "parent", "inner", small)
        .select("child", F.explode("rs").alias("r"))
        .distinct()
        .groupBy("child")
        .agg(F.collect_set("r").alias("skip")),
        "skips",
        start.small and start.rows * n_rounds <= MAX_BROADCAST_ROWS,
    )
    no_skip = F.col("skip").isNull() | ~F.array_contains("skip", F.col("round"))
    marked = lookup_join(rounds, skips, "child", small=skips_small)
    kept = stage(marked.where(no_skip).select("child", "parent", "round"), "kept")
    roots = kept.where("round = 1").select(F.col("parent").alias("tag")).distinct()
    layers = (
        kept.groupBy(F.col("child").alias("tag"))
        .agg(F.max("round").alias("layer"))
        .unionByName(roots.withColumn("layer", F.lit(0)))
    )
    return TagLayers(kept, layers)


def tag_paths(kept: DataFrame, layers: DataFrame) -> DataFrame:
    """[tag, path, depth]: path from the root down to the tag over each tag's first parent.

    The first parent is the smallest (round, parent). Partial paths are doubled: a step joins
    each open path with the path of the tag it hangs on, so a tree of depth d takes log2(d) steps.
    """
    first = kept.groupBy(F.col("child").alias("tag")).agg(F.min(F.struct("round", "parent"))["parent"].alias("up"))
    roots = layers.where("layer = 0").select("tag", F.lit(None).cast("string").alias("up"))
    state = stage_sized(first.unionByName(roots).withColumn("path", F.array("tag")), "paths")
    while not state.df.where("up is not null").isEmpty():
        above = state.df.select(F.col("tag").alias("up"), F.col("up").alias("up2"), F.col("path").alias("head"))
        joined = lookup_join(state.df.where("up is not null"), above, "up", "inner", state.small).select(
            "tag", F.col("up2").alias("up"), F.concat("head", "path").alias("path")
        )
        state = stage_sized(state.df.where("up is null").unionByName(joined), "paths")
    return state.df.select("tag", "path", (F.size("path") - 1).alias("depth"))


def tag_paths_for_terms(terms: DataFrame, paths: DataFrame) -> DataFrame:
    """[word, tags, endtag, taglayer, unmatchtag, tagidx] as strings, one row per input row.

    Each tag of a term gets its path; the best tag is the one whose path holds most of the
    term's tags, the earliest such tag if several do. Tags without a path count as a path of
    one empty element; of repeated tags in ``paths`` the largest path counts. Work lists are as long as one term's tag list.
    """
    distinct = terms.groupBy("word", "tags").agg(F.count(F.lit(1)).alias("copies"))
    unrolled = distinct.select("word", "tags", "copies", F.posexplode("tags").alias("pos", "tag"))
    found = lookup_join(unrolled, paths.groupBy("tag").agg(F.max("path").alias("path")), "tag")
    path = F.coalesce(F.col("path"), F.array(F.lit("")))
    item = F.struct(
        (-F.size(F.filter("tags", lambda t: F.array_contains(path, t)))).alias("k"),
        "pos",
        "tag",
        path.alias("path"),
    )
    ranked = found.groupBy("word", "tags", "copies").agg(F.sort_array(F.collect_list(item)).alias("r"))

    def listed(c: Column) -> Column:
        return F.array_join(c, ",")

    return ranked.withColumn("best", F.element_at("r", 1)).select(
        "word",
        listed(F.col("tags")).alias("tags"),
        F.col("best.tag").alias("endtag"),
        F.array_join("best.path", "-").alias("taglayer"),
        listed(F.filter("tags", lambda t: ~F.array_contains(F.col("best.path"), t))).alias("unmatchtag"),
        listed(F.transform("r", lambda s: F.concat_ws("/", s["tag"], F.size(s["path"]).cast("string")))).alias("tagidx"),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
    ).drop("copy")


def csv_tags(df: DataFrame, word: str = "bk_word", tags: str = "bk_tags") -> DataFrame:
    """[word, tags] with the comma-joined tag column as an array."""
    return df.select(F.col(word).alias("word"), jsplit(F.col(tags)).alias("tags"))
