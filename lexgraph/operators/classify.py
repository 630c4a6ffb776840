"""Classes of terms by vote of their tags, and related terms grouped by class."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexgraph.functions.strings import run_counts, run_ends
from lexgraph.plans.lookup import hot_keys, lookup_join, salted_join


def classify_terms(terms: DataFrame, tag_class: DataFrame) -> DataFrame:
    """[word, relwords, cls] of the terms with at least one tag in ``tag_class`` [tag, cls].

    The class with most tags wins, the smallest class number if several do. A tag that is repeated in
    ``tag_class`` has its largest class only. ``terms`` must have
    one row per word. The related lists stay out of the vote and are joined back on the word, on
    which both sides are already partitioned.
    """
    tags = terms.select("word", F.explode("tags").alias("tag"))
    one_class = tag_class.groupBy("tag").agg(F.max("cls").alias("cls"))
    votes = lookup_join(tags, one_class, "tag", "inner").groupBy("word", "cls").count()
    voted = votes.groupBy("word").agg(
        F.max(F.struct("count", (-F.col("cls")).alias("low"), F.col("cls").alias("cls")))["cls"].alias("cls")
    )
    return terms.select("word", "relwords").join(voted, "word")


def related_by_class(classified: DataFrame, no_class: int = -1) -> DataFrame:
    """[word, cls, relcls, relwords]: related terms of each term by their own class, as "w/n,w/n".

    Most frequent first, equal counts by falling term. Repeats are counted inside each term's
    list before anything moves. The join of related terms with their class is between two sides
    as large as the data, so it is a shuffle join, and terms that very many others list are
    salted. The lists collected at the end are parts of one term's own list. ``classified`` is
    read several times and should be a staged table.
    """
    listed = (
        classified.select("word", "cls", F.sort_array("relwords").alias("ordered"))
        .withColumn("ends", run_ends(F.col("ordered")))
        .select("word", "cls", F.inline(run_counts(F.col("ordered"), F.col("ends"))))
        .withColumnRenamed("item", "rel")
    )
    hot = hot_keys(classified.select(F.explode("relwords").alias("rel")), "rel")
    classes = classified.select(F.col("word").alias("rel"), F.col("cls").alias("relcls"))
    joined = salted_join(listed, classes, "rel", "left", hot).withColumn(
        "relcls", F.coalesce(F.col("relcls"), F.lit(no_class))
    )
    # Moved as rows: lists begun before the exchange would combine almost nothing.
    moved = joined.repartition("word", "cls", "relcls")
    grouped = moved.groupBy("word", "cls", "relcls").agg(
        F.sort_array(F.collect_list(F.struct("n", "rel")), asc=False).alias("items")
    )
    shown = F.transform("items", lambda s: F.concat_ws("/", s["rel"], s["n"].cast("string")))
    return grouped.select("word", "cls", "relcls", F.array_join(shown, ",").alias("relwords"))
