"""One query per operator. Lists are comma-joined in the results, as in the flat output tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexgraph.functions.strings import base_term, jsplit, jtrim
from lexgraph.operators.classify import classify_terms, related_by_class
from lexgraph.operators.cooccur import tag_cooccur, tag_count
from lexgraph.operators.hierarchy import csv_tags, tag_edges, tag_layers, tag_paths, tag_paths_for_terms
from lexgraph.operators.html import extract_html, extract_with_failures, page_keywords, page_terms
from lexgraph.operators.nature import default_natures, nature_label, nature_scan
from lexgraph.operators.synonyms import synonyms
from lexgraph.operators.terms import clean_tags_loose, clean_terms, clean_terms_loose
from lexgraph.operators.tokens import drop_stopwords, lexicon_matches, segment_tokens, tokenize, tokens_with_nature
from lexgraph.plans.stage import new_path, stage
from lexgraph.sources.tables import snapshot_scan, write_lines, write_snapshot, write_table
from lexgraph.sources.text import (
    first_lines,
    path_scan,
    read_lenient,
    scan_kv_text,
    tag_class_scan,
    tag_classes,
)
from lexgraph.workload.fixtures import (
    BLANKS,
    class_lines,
    coded_terms,
    customer_terms,
    document_terms,
    keyword_rows,
    layered_terms,
    load,
    marked_pages,
    nature_lookup,
)

THRES = 0.9


def joined(df: DataFrame, *lists: str, sep: str = ",") -> DataFrame:
    return df.withColumns({c: F.array_join(c, sep) for c in lists})


# Terms and tags


def q_string_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.concat(F.lit("\t \x01"), F.col("source"), F.lit("/"), F.col("lang"), F.lit(" \r\n"))
    items = jsplit(F.regexp_replace("text", BLANKS, ","))
    return load(spark, sf_dir, "documents").select(
        "doc_id",
        jtrim(padded).alias("trimmed"),
        base_term(jtrim(padded)).alias("base"),
        F.size(items).alias("n_items"),
        F.element_at(items, -1).alias("last_item"),
        F.size(jsplit(F.col("text"), " \t\n\r", run=True)).alias("n_parts"),
        F.array_join(F.array_distinct(F.filter(items, lambda w: F.length(w) > 12)), ",").alias("long_items"),
    )


def q_clean_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_terms(document_terms(spark, sf_dir), as_csv=True)


def q_clean_terms_loose(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined(clean_terms_loose(document_terms(spark, sf_dir)), "relwords", "tags")


def q_tag_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag_count(clean_tags_loose(document_terms(spark, sf_dir)))


def q_tag_cooccur(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag_cooccur(clean_tags_loose(document_terms(spark, sf_dir)))


def customer_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag_edges(tag_cooccur(clean_tags_loose(customer_terms(spark, sf_dir))), THRES)


def q_tag_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_edges(spark, sf_dir)


def q_tag_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag_layers(customer_edges(spark, sf_dir)).kept


def q_tag_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag_layers(customer_edges(spark, sf_dir)).layers


def customer_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag_paths(*tag_layers(customer_edges(spark, sf_dir)))


def q_tag_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined(customer_paths(spark, sf_dir), "path", sep=">")


def q_tag_paths_for_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = clean_terms(customer_terms(spark, sf_dir), as_csv=True)
    paths = customer_paths(spark, sf_dir).select("tag", "path")
    # Every tag once more with a smaller path, which does not count.
    again = paths.select("tag", F.array(F.lit("")).alias("path"))
    return tag_paths_for_terms(csv_tags(terms, "word", "tags"), paths.unionByName(again))


def deep_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag_edges(tag_cooccur(clean_tags_loose(layered_terms(spark, sf_dir))), THRES)


def q_deep_kept_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "kept_text")
    write_lines(tag_layers(deep_edges(spark, sf_dir)).kept, ("child", "parent"), ">", path)
    return spark.read.text(path)


def q_deep_layer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "layers_text")
    write_lines(tag_layers(deep_edges(spark, sf_dir)).layers, ("tag", "layer"), " ", path)
    return spark.read.text(path)


def q_deep_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined(tag_paths(*tag_layers(deep_edges(spark, sf_dir))), "path", sep=">")


def q_path_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "multilayer")
    write_lines(customer_paths(spark, sf_dir), ("path",), ">", path)
    return joined(path_scan(spark, path), "path", sep=">")


# Classes and natures


def q_tag_class_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "tag_class")
    write_lines(class_lines(spark, sf_dir), ("value",), " ", path)
    return tag_class_scan(spark, path)


def classified_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    lookup = tag_classes(class_lines(spark, sf_dir))
    # Every tag once more with a smaller class, which does not count.
    lookup = lookup.unionByName(lookup.withColumn("cls", F.lit(-9)))
    return classify_terms(clean_terms_loose(document_terms(spark, sf_dir)), lookup)


def q_classify_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined(classified_documents(spark, sf_dir), "relwords")


def q_related_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return related_by_class(stage(classified_documents(spark, sf_dir), "classified"))


def q_classified_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The classified terms through a snapshot table with a string partition, as a job keeps them for inspection."""
    path = new_path(spark, "classified_table")
    shown = joined(classified_documents(spark, sf_dir), "relwords").toDF("bk_word", "bk_relwords", "bk_tag")
    with own_table(spark) as table:
        write_snapshot(shown, table, "2017-06-12", part_type="string", location=path)
    return spark.read.parquet(path).withColumn("stat_date", F.col("stat_date").cast("string"))


def q_nature_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nature_label(coded_terms(spark, sf_dir), default_natures(spark))


def q_nature_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nature_scan(document_terms(spark, sf_dir))


def q_nature_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nature_label(document_terms(spark, sf_dir), nature_lookup(spark, sf_dir))


# Pages


def q_html_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = load(spark, sf_dir, "pages").select("page_id", "html")
    found = extract_html(
        pages, "html", ("links",), link_prefix="/", drop_suffixes=("ing", "fr=navbar", "force=1"), strip="tion"
    )
    return joined(found, "links")


def q_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = load(spark, sf_dir, "pages").select("page_id", "html")
    return extract_html(
        pages, "html", ("body_text", "first_href", "first_text", "first_outer", "first_inner")
    )


def q_html_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract_html(marked_pages(spark, sf_dir).select("page_id", "html"), "html", ("tags",))
    return found.select("page_id", F.posexplode("tags").alias("pos", "tag"))


def q_html_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_html(marked_pages(spark, sf_dir).select("page_id", "html"), "html", ("input",))


def q_html_toc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined(extract_html(marked_pages(spark, sf_dir).select("page_id", "html"), "html", ("toc",)), "toc")


def q_html_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined(extract_html(marked_pages(spark, sf_dir).select("page_id", "html"), "html", ("meta",)), "meta")


def q_page_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, and customers as records that have none."""
    pages = marked_pages(spark, sf_dir).select("url", "html")
    alone = load(spark, sf_dir, "customer").select(F.col("c_name").alias("url"), F.lit(None).cast("string").alias("html"))
    return page_terms(pages.unionByName(alone), "url", "html", link_prefix="/")


def q_page_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_keywords(marked_pages(spark, sf_dir), "url", "html")


def q_failed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with and without an input box: what was found of each, and the fields that could not be read."""
    pages = marked_pages(spark, sf_dir).select("page_id", "html")
    plain = load(spark, sf_dir, "pages").select((-F.col("page_id") - 1).alias("page_id"), "html")
    found, failed = extract_with_failures(pages.unionByName(plain), "html", ("input", "toc"))
    sections = found.select("page_id", F.col("input").alias("value"), F.size("toc").alias("sections"), F.lit("").alias("reason"))
    return sections.unionByName(failed.select("page_id", F.col("field").alias("value"), F.lit(-1).alias("sections"), "reason"))


def q_page_synonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return synonyms(page_keywords(marked_pages(spark, sf_dir), "url", "html"))


def q_synonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return synonyms(keyword_rows(spark, sf_dir))


# Tokens


def document_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenize(load(spark, sf_dir, "documents"))


def benchmark_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """[word, nature]: tokens of the benchmark passages, coded by their length."""
    words = tokenize(load(spark, sf_dir, "benchmark"), keep=("item_id",)).select(F.col("token").alias("word"))
    return words.distinct().withColumn("nature", F.concat(F.lit("n"), F.length("word")))


def user_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """[word, nature]: tokens of all turns, coded by their role."""
    words = tokenize(load(spark, sf_dir, "conversations"), keep=("role",))
    return words.select(F.col("token").alias("word"), F.col("role").alias("nature")).distinct()


def q_tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_tokens(spark, sf_dir)


def q_tokens_with_nature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens_with_nature(
        document_tokens(spark, sf_dir), benchmark_words(spark, sf_dir), user_words(spark, sf_dir)
    )


def q_lexicon_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    matches = lexicon_matches(document_tokens(spark, sf_dir), benchmark_words(spark, sf_dir))
    return matches.groupBy("word", "nature").agg(
        F.count(F.lit(1)).alias("n"), F.sum("start").alias("starts"), F.sum("pos").alias("places")
    )


def q_segment_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the best paths, by how often the benchmark has them; a few turns' words are user words."""
    words = tokenize(load(spark, sf_dir, "benchmark"), keep=("item_id",)).groupBy(F.col("token").alias("word"))
    lexicon = words.agg(F.count(F.lit(1)).alias("frequency")).withColumn("nature", F.concat(F.lit("n"), F.length("word")))
    user = user_words(spark, sf_dir).where(F.length("word") <= 3)
    parts = segment_tokens(document_tokens(spark, sf_dir), lexicon, user)
    return parts.groupBy("word", "nature").agg(
        F.count(F.lit(1)).alias("n"), F.sum("part").alias("parts"), F.sum("start").alias("starts"), F.sum("pos").alias("places")
    )


def q_drop_stopwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_stopwords(document_tokens(spark, sf_dir), benchmark_words(spark, sf_dir))


# Sources and sinks


def q_scan_kv_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = load(spark, sf_dir, "pages")
    line = F.regexp_replace("html", r"[\r\n]", " ")
    records = pages.select(F.concat_ws("\x01", "url", line, F.col("page_id").cast("string")).alias("value"))
    alone = load(spark, sf_dir, "customer").select(F.concat("c_name", F.lit("\x01")).alias("value"))
    blank = load(spark, sf_dir, "nation").select(F.lit("\x01").alias("value"))
    path = new_path(spark, "dump")
    write_lines(records.unionByName(alone).unionByName(blank), ("value",), "", path)
    return scan_kv_text(spark, path)


def q_read_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English documents in cp936 with a Chinese heading, the others in UTF-8."""

    @F.arrow_udf("binary")
    def cp936(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([t and t.encode("cp936") for t in texts.to_pylist()], type=pa.binary())

    english = F.col("lang") == "en"
    ascii_text = F.concat(F.lit("百科 "), F.regexp_replace("text", r"[^\x00-\x7f]", "?"))
    encoded = cp936(F.when(english, ascii_text)).cast("string")
    path = new_path(spark, "mixed")
    (
        load(spark, sf_dir, "documents")
        .select("lang", F.coalesce(encoded, F.col("text")).alias("value"))
        .write.partitionBy("lang")
        .text(path)
    )
    return read_lenient(spark, path).groupBy("line").agg(F.count(F.lit(1)).alias("n"))


def q_snapshot_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two dates of one table, the first one written twice; the scan reads one date, then all."""
    path = new_path(spark, "snapshot")
    docs = load(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    with own_table(spark) as table:
        write_snapshot(docs.where("lang = 'en'"), table, 20170612, location=path)
        write_snapshot(docs, table, 20170613, location=path)
        write_snapshot(docs.where("lang <> 'en'"), table, 20170612, location=path)
        scan = snapshot_scan(spark, table, 20170612, ("doc_id", "n_chars"))
        both = snapshot_scan(spark, table, None, ("doc_id", "n_chars"))
        return stage(scan.withColumn("dates", F.lit("one")).unionByName(both.withColumn("dates", F.lit("all"))), "scanned")


def q_write_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "table")
    with own_table(spark) as table:
        write_table(document_terms(spark, sf_dir), table, location=path)
        write_table(clean_terms(document_terms(spark, sf_dir), as_csv=True), table, location=path)
    return spark.read.parquet(path)


def q_clean_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table cleaned into itself, and a date of a table written from its other date."""
    path, dated = new_path(spark, "table"), new_path(spark, "snapshot")
    with own_table(spark) as table, own_table(spark) as snapshot:
        write_table(document_terms(spark, sf_dir), table, location=path)
        write_table(clean_terms(spark.table(table), as_csv=True), table, location=path)
        write_snapshot(load(spark, sf_dir, "documents").select("doc_id", "lang"), snapshot, 20170612, location=dated)
        write_snapshot(snapshot_scan(spark, snapshot, 20170612).where("lang = 'en'"), snapshot, 20170613, location=dated)
        write_snapshot(snapshot_scan(spark, snapshot, 20170612).where("lang <> 'en'"), snapshot, 20170612, location=dated)
        kept = stage(snapshot_scan(spark, snapshot, None, ("stat_date", "doc_id")), "kept")
    cleaned = spark.read.parquet(path)
    dates = kept.groupBy("stat_date").agg(F.count(F.lit(1)).alias("rows"), F.sum("doc_id").alias("ids"))
    shown = dates.select(F.col("stat_date").cast("string"), F.col("rows").cast("string"), F.col("ids").cast("string"))
    return cleaned.unionByName(shown.toDF(*cleaned.columns))


@contextmanager
def own_table(spark: SparkSession) -> Iterator[str]:
    """Name of a table that is dropped afterwards; its files have a place of their own and stay."""
    table = f"lexgraph_{uuid.uuid4().hex}"
    try:
        yield table
    finally:
        spark.sql(f"DROP TABLE IF EXISTS `{table}`")


def q_edge_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "edges_text")
    write_lines(customer_edges(spark, sf_dir), ("child", "parent"), ">", path)
    return spark.read.text(path)


def q_first_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_lines(load(spark, sf_dir, "documents").select("doc_id")).agg(F.count(F.lit(1)).alias("n"))


QUERIES = {name[2:]: fn for name, fn in list(globals().items()) if name.startswith("q_")}
