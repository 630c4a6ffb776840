"""The batch jobs: tables and files in, tables and files out.

Each job reads one table or file, applies the operators and writes its result. ``stat_date``
limits a reader to one snapshot; ``None`` reads all of them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexgraph.operators.classify import classify_terms, related_by_class
from lexgraph.operators.cooccur import tag_cooccur
from lexgraph.operators.hierarchy import csv_tags, tag_edges, tag_layers, tag_paths, tag_paths_for_terms
from lexgraph.operators.html import page_keywords, page_terms
from lexgraph.operators.nature import default_natures, nature_label
from lexgraph.operators.synonyms import synonyms
from lexgraph.operators.terms import clean_tags_loose, clean_terms, clean_terms_loose
from lexgraph.plans.stage import stage, staging
from lexgraph.sources.tables import snapshot_scan, write_lines, write_snapshot, write_table
from lexgraph.sources.text import path_scan, scan_kv_text, tag_class_scan

TERM_COLUMNS = ("bk_word", "bk_relwords", "bk_tags")


def ingest_pages(spark: SparkSession, src: str, table: str, dt: str) -> None:
    """Raw dump to page table [bk_word, bk_html]."""
    write_snapshot(scan_kv_text(spark, src).toDF("bk_word", "bk_html"), table, dt)


def parse_terms(spark: SparkSession, src: str, table: str, dt: str) -> None:
    """Raw dump to term table [bk_word, bk_relwords, bk_tags]."""
    write_snapshot(page_terms(scan_kv_text(spark, src, missing=None)), table, dt)


def filter_terms(spark: SparkSession, src: str, table: str, stat_date: str | None = None) -> None:
    """Term table to clean term table, one row per base term."""
    terms = clean_terms(snapshot_scan(spark, src, stat_date, TERM_COLUMNS), as_csv=True)
    write_table(terms.toDF(*TERM_COLUMNS), table)


def count_tag_pairs(spark: SparkSession, src: str, table: str, dt: str, stat_date: str | None = None) -> None:
    """Term table to pair table [tag1, tag2, tag1num, tag2num, twotagnum]; counts are bigint."""
    terms = clean_tags_loose(snapshot_scan(spark, src, stat_date, TERM_COLUMNS))
    write_snapshot(tag_cooccur(terms), table, dt)


def layer_tags(
    spark: SparkSession, src: str, out: str, thres: float, stat_date: str | None = None, min_co: int = 10
) -> None:
    """Pair table to text files under ``out``: edges, kept edges, layers, paths."""
    pairs = snapshot_scan(spark, src, stat_date, ("tag1", "tag2", "tag1num", "tag2num", "twotagnum"))
    edges = stage(tag_edges(pairs, float(thres), int(min_co)), "edges")
    write_lines(edges, ("child", "parent"), ">", f"{out}/ori")
    kept, layers = tag_layers(edges)
    write_lines(kept, ("child", "parent"), ">", f"{out}/res")
    write_lines(layers, ("tag", "layer"), " ", f"{out}/layer")
    write_lines(tag_paths(kept, layers), ("path",), ">", f"{out}/multilayer")


def layer_terms(spark: SparkSession, paths: str, src: str, table: str, dt: str) -> None:
    """Path file and clean term table to [word, tags, endtag, taglayer, unmatchtag, tagidx]."""
    terms = csv_tags(snapshot_scan(spark, src, None, ("bk_word", "bk_tags")))
    write_snapshot(tag_paths_for_terms(terms, path_scan(spark, paths)), table, dt)


def classify_related(
    spark: SparkSession,
    classes: str,
    src: str,
    table: str,
    dt: str,
    stat_date: str | None = None,
    debug_table: str | None = None,
) -> None:
    """Class file and term table to [bk_word, bk_tag, bk_reltag, bk_relwords].

    ``debug_table`` also gets the classified terms.
    """
    terms = clean_terms_loose(snapshot_scan(spark, src, stat_date, TERM_COLUMNS))
    classified = stage(classify_terms(terms, tag_class_scan(spark, classes)), "classified")
    if debug_table:
        shown = classified.select("word", F.array_join("relwords", ","), F.col("cls").cast("string"))
        write_snapshot(shown.toDF("bk_word", "bk_relwords", "bk_tag"), debug_table, dt)
    related = related_by_class(classified).toDF("bk_word", "bk_tag", "bk_reltag", "bk_relwords")
    write_snapshot(related, table, dt)


def label_natures(
    spark: SparkSession, src: str, table: str, stat_date: str | None = None, natures: DataFrame | None = None
) -> None:
    """Term table to [bk_word, bk_tags, bk_nature, bk_word_len], with the fixed natures or given ones."""
    terms = snapshot_scan(spark, src, stat_date, ("bk_word", "bk_tags"))
    labelled = nature_label(terms, default_natures(spark) if natures is None else natures)
    write_table(labelled.toDF("bk_word", "bk_tags", "bk_nature", "bk_word_len"), table)


def parse_keywords(spark: SparkSession, src: str, table: str, outdt: str, stat_date: str | None = None) -> None:
    """Page table to keyword table [bk_word, bk_input, meta_keywords, dir_words]."""
    write_snapshot(page_keywords(snapshot_scan(spark, src, stat_date, ("bk_word", "bk_html"))), table, outdt)


def mine_synonyms(spark: SparkSession, src: str, table: str, dt: str, outdt: str) -> None:
    """Keyword table of one date to [bk_word, bk_input, syno, dir_words, meta_keywords]."""
    found = synonyms(snapshot_scan(spark, src, dt))
    write_snapshot(found.toDF("bk_word", "bk_input", "syno", "dir_words", "meta_keywords"), table, outdt)


def scoped(job: Callable) -> Callable:
    """The job, with its staged tables deleted when its result is written."""

    @wraps(job)
    def run(spark: SparkSession, *args, **kwargs) -> None:
        with staging(spark):
            job(spark, *args, **kwargs)

    return run


JOBS = {
    job.__name__: scoped(job)
    for job in (
        ingest_pages, parse_terms, filter_terms, count_tag_pairs, layer_tags, layer_terms, classify_related,
        label_natures, parse_keywords, mine_synonyms,
    )
}
