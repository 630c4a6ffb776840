"""Synonyms from page keywords."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexgraph.functions.strings import base_term, jsplit, jtrim, longest_first, replace_each


def synonyms(
    df: DataFrame,
    word: str = "bk_word",
    entered: str = "bk_input",
    dir_words: str = "dir_words",
    meta_keywords: str = "meta_keywords",
    drop_empty: bool = False,
    min_len: int | None = None,
) -> DataFrame:
    """[word, input, syno, dir_words, meta_keywords]: keywords that are other names of the word.

    Lower-cased words with inner blanks are left out. From the keyword string every
    word + section and input + section is removed, then every section, longer ones first; what
    is left is split at blanks, and the word and the input themselves are taken out.
    A narrow projection: no exchange, no Python.
    """

    def lowered(name: str):
        return F.lower(jtrim(F.coalesce(F.col(name), F.lit(""))))

    rows = (
        df.where(F.col(word).isNotNull())
        .select(
            lowered(word).alias("w"),
            lowered(entered).alias("input"),
            lowered(dir_words).alias("dirs"),
            lowered(meta_keywords).alias("meta_keywords"),
        )
        .where(~F.col("w").rlike("[ \t]"))
        .select(
            base_term(F.col("w")).alias("word"),
            "input",
            F.when(F.col("dirs") == "", F.array().cast("array<string>")).otherwise(jsplit(F.col("dirs"))).alias("dirs"),
            "meta_keywords",
        )
    )
    with_word = F.transform("dirs", lambda d: F.concat(F.col("word"), d))
    with_both = F.flatten(
        F.transform("dirs", lambda d: F.array(F.concat(F.col("word"), d), F.concat(F.col("input"), d)))
    )
    combined = F.when(F.col("word") == F.col("input"), with_word).otherwise(with_both)
    removed = F.concat(longest_first(combined), longest_first(F.col("dirs")))
    # The stripped string is a column of its own: the split looks at it several times.
    rows = rows.withColumn("left", replace_each(F.col("meta_keywords"), removed))
    left = jsplit(F.col("left"), " \t", run=True)
    found = F.array_remove(F.array_remove(F.array_distinct(left), F.col("word")), F.col("input"))
    if drop_empty:
        found = F.array_remove(found, "")
    if min_len is not None:
        found = F.filter(found, lambda k: F.length(k) >= min_len)
    return rows.select(
        "word",
        "input",
        F.array_join(found, ",").alias("syno"),
        F.array_join("dirs", ",").alias("dir_words"),
        "meta_keywords",
    )
