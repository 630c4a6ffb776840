"""Tag frequency and tag co-occurrence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexgraph.functions.strings import run_counts, run_ends
from lexgraph.plans.lookup import lookup_join
from lexgraph.plans.stage import lookup_side, stage_sized


def tag_count(terms: DataFrame, drop_empty_tags: bool = False) -> DataFrame:
    """[tag, n]: how often each tag is listed; repeats inside one term count."""
    tags = terms.select(F.explode("tags").alias("tag"))
    if drop_empty_tags:
        tags = tags.where(F.col("tag") != "")
    return tags.groupBy("tag").agg(F.count(F.lit(1)).alias("n"))


# A term with more tags is dealt over tasks in blocks of so many.
BLOCK = 512


def dealt_blocks(listed: DataFrame) -> DataFrame:
    """[low, high] of terms with very many ``tags`` (in order): a block of tags, and all tags from its first one on.

    The blocks of a term go to tasks of their own, each of which unrolls its share of the pairs.
    """
    blocks = F.sequence(F.lit(0), F.ceil(F.size("tags") / BLOCK).cast("int") - 1)
    begin = F.col("block") * BLOCK + 1
    cut = listed.select("tags", F.explode(blocks).alias("block")).select(
        F.slice("tags", begin, F.lit(BLOCK)).alias("low"), F.slice("tags", begin, F.size("tags")).alias("high")
    )
    partitions = int(listed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # A given number of partitions, as few bytes hold very many pairs.
    return cut.repartition(partitions, F.xxhash64("low"))


def tag_cooccur(terms: DataFrame, drop_empty_tags: bool = False) -> DataFrame:
    """[tag1, tag2, tag1num, tag2num, twotagnum] for tag1 > tag2 listed by the same term.

    Tags listed m and n times by a term add m * n. Each term is reduced to its distinct tags with
    multiplicities, then unrolled tag by tag, so no list of pairs is ever held; a term of more than ``BLOCK`` tags is
    unrolled by several tasks. The tag itself is
    unrolled as the pair (tag, tag): one pass and one exchange give both the pair counts and
    the tag counts, and only that small result is joined.
    """
    tags = F.filter("tags", lambda t: t != "") if drop_empty_tags else F.col("tags")

    def listed(some: DataFrame) -> DataFrame:
        ordered = some.select(F.sort_array(tags).alias("ordered")).withColumn("ends", run_ends(F.col("ordered")))
        counted_tags = F.transform(
            run_counts(F.col("ordered"), F.col("ends")), lambda r: F.struct(r["item"].alias("tag"), r["n"].alias("m"))
        )
        return ordered.select(counted_tags.alias("tags"))

    short = listed(terms.where(F.size("tags") <= BLOCK)).select(F.col("tags").alias("low"), F.col("tags").alias("high"))
    blocks = short.unionByName(dealt_blocks(listed(terms.where(F.size("tags") > BLOCK))))
    pairs = (
        blocks.select(F.explode("low").alias("low"), F.col("high").alias("tags"))
        .select("low", F.explode(F.filter("tags", lambda t: t["tag"] >= F.col("low.tag"))).alias("high"))
        .select(
            F.col("high.tag").alias("tag1"),
            F.col("low.tag").alias("tag2"),
            F.when(F.col("high.tag") == F.col("low.tag"), F.col("low.m"))
            .otherwise(F.col("high.m") * F.col("low.m"))
            .alias("m"),
        )
    )
    counted = stage_sized(pairs.groupBy("tag1", "tag2").agg(F.sum("m").alias("n")), "cooccur")
    double = counted.df.where(F.col("tag1") > F.col("tag2")).withColumnRenamed("n", "twotagnum")
    single, small = lookup_side(
        counted.df.where(F.col("tag1") == F.col("tag2")).select("tag1", "n"), "tag_counts", counted.small
    )
    first = single.select("tag1", F.col("n").alias("tag1num"))
    second = single.select(F.col("tag1").alias("tag2"), F.col("n").alias("tag2num"))
    joined = lookup_join(lookup_join(double, first, "tag1", "inner", small), second, "tag2", "inner", small)
    return joined.select("tag1", "tag2", "tag1num", "tag2num", "twotagnum")
