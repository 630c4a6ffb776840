"""Term cleaning: filter crawled terms and keep one sense per base term."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexgraph.functions.strings import at_least, base_term, clean_csv, csv_items, csv_size, jsplit, jtrim


def clean_terms(
    df: DataFrame,
    word: str = "bk_word",
    relwords: str = "bk_relwords",
    tags: str = "bk_tags",
    min_len: int = 2,
    max_len: int = 23,
    min_rel: int = 3,
    strict_tags: bool = True,
    as_csv: bool = False,
) -> DataFrame:
    """[word, relwords, tags], one row per base term.

    Of several senses ("x/a", "x/b") the one with the most related terms is kept; equal counts
    are settled by the tags, then by the related terms. ``strict_tags=False`` lets an empty tag
    string pass as one empty tag (a string of commas never passes). ``as_csv`` keeps the lists as
    comma-joined strings, tags as they were found.

    Lists stay strings up to the end: one exchange on the word with a map-side partial
    aggregate, so a word with very many senses is reduced before it is moved.
    """
    kept = term_senses(df, word, relwords, tags, min_len, max_len, min_rel, strict_tags)
    best = kept.groupBy("word").agg(F.max(F.struct(csv_size(F.col("rel")).alias("n"), "tags", "rel")).alias("best"))
    if as_csv:
        return best.select("word", F.col("best.rel").alias("relwords"), F.col("best.tags").alias("tags"))
    return best.select(
        "word", csv_items(F.col("best.rel")).alias("relwords"), jsplit(F.col("best.tags")).alias("tags")
    )


def term_senses(
    df: DataFrame, word: str, relwords: str, tags: str, min_len: int, max_len: int, min_rel: int, strict_tags: bool
) -> DataFrame:
    """[word, rel, tags] of the rows that pass, under their base term; lists are still strings."""
    w = jtrim(F.col(word))
    tag = jtrim(F.coalesce(F.col(tags), F.lit("")))
    has_tag = F.rtrim(tag, F.lit(",")) != ""
    if not strict_tags:
        has_tag = has_tag | (tag == "")
    # The cheap conditions first: the long list is only trimmed where they hold.
    short = df.where(F.length(w).between(min_len, max_len) & ~w.startswith("/") & has_tag)
    rel = jtrim(F.coalesce(F.col(relwords), F.lit("")))
    return short.where(at_least(rel, min_rel)).select(
        base_term(w).alias("word"), clean_csv(rel).alias("rel"), tag.alias("tags")
    )


def clean_tags_loose(df: DataFrame, word: str = "bk_word", relwords: str = "bk_relwords", tags: str = "bk_tags") -> DataFrame:
    """[word, tags] of ``clean_terms_loose`` for counting tags: the related lists are counted where they are read, not moved.

    The tags of the best sense are those of the largest (count, tags), as ties go by the tags first.
    """
    kept = term_senses(df, word, relwords, tags, 1, 23, 3, strict_tags=False)
    slim = kept.select("word", F.struct(csv_size(F.col("rel")).alias("n"), "tags").alias("sense"))
    return slim.groupBy("word").agg(F.max("sense")["tags"].alias("tags")).select("word", jsplit(F.col("tags")).alias("tags"))


def clean_terms_loose(df: DataFrame, **kwargs) -> DataFrame:
    """The variant used for tag counts and classes: words of one character, empty tag strings."""
    return clean_terms(df, min_len=1, strict_tags=False, **kwargs)
