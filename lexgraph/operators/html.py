"""Links, tags, query box, table of contents and keywords of crawled pages.

Pages cross to Python once, in one Arrow UDF that returns only the asked raw fields; which links
count and how they are written is decided by native array functions afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lexgraph.functions.html import Selectors, parse_html
from lexgraph.plans.stage import stage

# Pages of an Arrow batch.
BATCH_ROWS = 1_000

ALL_FIELDS = (
    "links", "tags", "input", "toc", "meta", "body_text", "first_href", "first_text", "first_outer", "first_inner",
)


def related_links(links: Column, prefix: str, drop_suffixes: tuple[str, ...], strip: str) -> Column:
    """Texts of the links into the lexicon, in page order, repeats kept."""

    def wanted(link: Column) -> Column:
        keep = link["href"].startswith(prefix)
        for suffix in drop_suffixes:
            keep = keep & ~link["href"].endswith(suffix)
        return keep

    return F.transform(F.filter(links, wanted), lambda link: F.replace(link["text"], F.lit(strip), F.lit("")))


def toc_entries(toc: Column) -> Column:
    """Texts of the top-level sections: links to ``#n`` without a ``_``."""
    top = F.filter(toc, lambda link: link["href"].startswith("#") & ~link["href"].contains("_"))
    return F.transform(top, lambda link: link["text"])


def spread_pages(df: DataFrame) -> DataFrame:
    """``df`` over all cores if it comes in fewer than half as many splits, else as it is: moving every page is dear.

    ``df`` should be a scan; of files that cannot be split each is one split.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 2 * df.rdd.getNumPartitions() <= cores else df


def hold_batches(spark: SparkSession) -> None:
    """Pages are long: the session's Arrow batches are held to ``BATCH_ROWS`` rows, so that a worker's memory does not grow with its task."""
    if not 0 < int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def extract_html(
    df: DataFrame,
    html: str = "bk_html",
    fields: tuple[str, ...] = ALL_FIELDS,
    link_prefix: str = "/item",
    drop_suffixes: tuple[str, ...] = ("fr=navbar", "force=1"),
    strip: str = "#viewPageContent",
    selectors: Selectors = Selectors(),
    partitions: int | str | None = "auto",
    failures: Observation | None = None,
    keep_failures: bool = False,
) -> DataFrame:
    """The columns of ``df`` without ``html``, plus one column per asked field.

    links, tags, toc, meta are arrays of strings; input, body_text and the first_* fields (href, text,
    outer and inner source of the first link) are strings. Missing pages give empty fields.
    ``partitions`` spreads the pages first: over so many, if they come in few splits (``auto``), or not at all (``None``).
    ``failures`` gets ``failed``, the number of pages with a field that could not be read and is empty. With ``keep_failures`` the last column
    is ``failures``, [field, reason] of these fields.
    """
    hold_batches(df.sparkSession)
    if partitions:
        df = spread_pages(df) if partitions == "auto" else df.repartition(partitions)
    others = [c for c in df.columns if c != html]
    parsed = df.select(*others, parse_html(F.col(html), fields, selectors).alias("__page"))
    if failures is not None:
        parsed = parsed.observe(failures, F.count_if(F.size("__page.failures") > 0).alias("failed"))
    shaped = {
        "links": related_links(F.col("__page.links"), link_prefix, drop_suffixes, strip),
        "toc": toc_entries(F.col("__page.toc")),
    }
    shown = (*fields, "failures") if keep_failures else fields
    return parsed.select(*others, *[shaped.get(f, F.col(f"__page.{f}")).alias(f) for f in shown])


def extract_with_failures(df: DataFrame, html: str = "bk_html", fields: tuple[str, ...] = ALL_FIELDS, **options) -> tuple[DataFrame, DataFrame]:
    """``extract_html``, and [other columns of df, field, reason] of every field that could not be read.

    Both come from one scan of the pages: what it finds is staged once, with the failures beside the fields.
    """
    found = stage(extract_html(df, html, fields, keep_failures=True, **options), "parsed_pages")
    others = [c for c in df.columns if c != html]
    return found.drop("failures"), found.select(*others, F.inline("failures"))


def page_terms(records: DataFrame, key: str = "key", body: str = "body", **options) -> DataFrame:
    """[bk_word, bk_relwords, bk_tags] with comma-joined lists; "none" for records without a page."""
    found = extract_html(
        records.select(F.col(key).alias("bk_word"), F.col(body).isNull().alias("missing"), F.col(body).alias("bk_html")),
        fields=("links", "tags"),
        **options,
    )

    def listed(name: str) -> Column:
        return F.when(F.col("missing"), F.lit("none")).otherwise(F.array_join(name, ","))

    return found.select("bk_word", listed("links").alias("bk_relwords"), listed("tags").alias("bk_tags"))


def page_keywords(pages: DataFrame, word: str = "bk_word", html: str = "bk_html", **options) -> DataFrame:
    """[bk_word, bk_input, meta_keywords, dir_words] with comma-joined lists."""
    found = extract_html(
        pages.select(F.col(word).alias("bk_word"), F.col(html).alias("bk_html")),
        fields=("input", "meta", "toc"),
        **options,
    )
    return found.select(
        "bk_word",
        F.col("input").alias("bk_input"),
        F.array_join("meta", ",").alias("meta_keywords"),
        F.array_join("toc", ",").alias("dir_words"),
    )
