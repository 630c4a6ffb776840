"""Relations in the shape of the crawled tables, derived row by row from whole driver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexgraph.operators.nature import TAG_NATURE

BLANKS = r"[ \t\r\n]+"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def first_token(text: str = "text"):
    return F.regexp_extract(text, r"[^ \t\r\n]+", 0)


def document_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """[bk_word, bk_relwords, bk_tags]: first token and source; every token; language and source tags.

    Table cells ("a | b") become "a/b" items, commas of the prose become empty items, and the
    language is listed twice, so the list rules have work to do. Parts and suppliers add the odd rows.
    """
    pair = F.concat_ws("|", "lang", "source")
    padding = F.when(F.col("doc_id") % 2 == 0, F.lit(",,")).otherwise(F.lit(""))
    listed = F.replace(F.replace("text", F.lit(" | "), F.lit("/")), F.lit(" "), F.lit(","))
    terms = load(spark, sf_dir, "documents").select(
        F.concat_ws("/", first_token(), "source").alias("bk_word"),
        F.replace(listed, F.lit("\n"), F.lit(",")).alias("bk_relwords"),
        F.concat(F.concat_ws(",", "lang", "source", pair, "lang"), padding).alias("bk_tags"),
    )
    return terms.unionByName(odd_terms(spark, sf_dir))


def by_key(key: str, *cases) -> Column:
    """One of the cases by the key, in turn."""
    out = F.lit(None).cast("string")
    for i, case in enumerate(cases):
        out = F.when(F.col(key) % len(cases) == i, case).otherwise(out)
    return out


def odd_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """[bk_word, bk_relwords, bk_tags] of parts and suppliers, in the ways a crawl goes wrong, by their keys.

    Words: one character, a leading slash, padding of blanks and control characters, null, too long, slashes only. Related
    terms: slashes only, padded, too few, null. Tags: empty, null, commas only, padded.
    """
    pad, tail = F.lit("\t \x01"), F.lit(" \r\n")
    suppliers = load(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.lit("Supplier").alias("kind"))
    parts = load(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), F.concat_ws(" ", "p_name", "p_partkey").alias("name"), F.col("p_type").alias("kind"))
    name, kind = F.col("name"), F.col("kind")
    word = by_key(
        "k", name, F.substring("name", 1, 1), F.concat(F.lit("/"), name), F.concat(pad, name, tail), F.lit(None),
        F.concat(name, F.lit(" too long a word")), F.concat(name, F.lit("/x/y")), F.lit("//"), name,
    )
    rel = by_key(
        "k", F.concat_ws(",", name, F.lit("//"), kind, F.lit("/,a/b,/c")), F.concat(pad, F.concat_ws(",", kind, name, kind), tail),
        F.concat_ws(",", F.lit(""), kind, F.lit(""), name, F.lit(",z")), F.concat_ws(",", kind, name), F.lit(None), F.lit("/,//,///"),
        F.concat_ws(",", kind, name, F.lit("c,d,e")),
    )
    tags = by_key("k", kind, F.lit(""), F.lit(None), F.lit(",,,"), F.concat(pad, kind, F.lit(",odd"), tail))
    return suppliers.unionByName(parts).select(word.alias("bk_word"), rel.alias("bk_relwords"), tags.alias("bk_tags"))


def customer_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """[bk_word, bk_relwords, bk_tags]: customer; nation, region, segment; three levels of tags."""
    customers = load(spark, sf_dir, "customer").select("c_name", "c_nationkey", "c_mktsegment")
    nation = load(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
    region = load(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    return customers.join(nation, "c_nationkey").join(region, "n_regionkey").select(
        F.col("c_name").alias("bk_word"),
        F.concat_ws(",", "n_name", "r_name", "c_mktsegment").alias("bk_relwords"),
        F.concat_ws(",", "r_name", "n_name", F.concat_ws("|", "n_name", "c_mktsegment")).alias("bk_tags"),
    )


def class_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """[value] of "tag class" lines: sources by their number, language-source pairs by their language.

    Tags are repeated with a smaller class and with -1; lines of one and of three parts say nothing.
    """
    number = F.floor(F.regexp_extract("source", r"\d+", 0).cast("int") / 7)
    by_pair = F.concat(F.concat_ws("|", "lang", "source"), F.lit(" "), F.ascii("lang") - 100)
    by_source = F.concat("source", F.lit(" "), number)
    seen = load(spark, sf_dir, "documents").select("lang", "source").distinct()
    again = F.concat("source", F.lit(" -7"))
    nothing = F.concat("source", F.lit(" -1"))
    odd = F.concat(F.lit(" "), "source", F.lit(" 1 2 "))
    return seen.select(F.explode(F.array(by_pair, by_source, again, nothing, odd, F.col("lang"))).alias("value"))


def nature_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """[tag, nature]: pairs by language, and sources; each also with a smaller code that does not count."""
    by_pair = F.struct(F.concat_ws("|", "lang", "source").alias("tag"), F.concat(F.lit("mz"), "lang").alias("nature"))
    by_source = F.struct(F.col("source").alias("tag"), F.concat(F.lit("mzs"), F.substring("source", -1, 1)).alias("nature"))
    seen = load(spark, sf_dir, "documents").select("lang", "source").distinct()
    found = seen.select(F.inline(F.array(by_pair, by_source)))
    return found.unionByName(found.withColumn("nature", F.lit("a"))).distinct()


def keyword_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """[bk_word, bk_input, dir_words, meta_keywords]: tokens of a document, its whole text as keywords."""
    tokens = F.split("text", BLANKS, 5)

    def token(n: int):
        return F.coalesce(F.get(tokens, F.lit(n)), F.lit(""))

    joined = F.concat(token(0), token(2))
    return load(spark, sf_dir, "documents").select(
        F.concat_ws("/", token(0), "source").alias("bk_word"),
        token(1).alias("bk_input"),
        F.concat_ws(",", token(2), token(3)).alias("dir_words"),
        F.concat_ws(" ", joined, "text").alias("meta_keywords"),
        "doc_id",
    )


def marked_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """[page_id, url, html]: whole pages with a keyword meta, query box, tags and contents put in.

    The inserted values come from the page's own address.
    """
    host = F.regexp_extract("url", "//([^/]*)", 1)
    lang = F.regexp_extract("url", "/([a-z][a-z])/", 1)
    meta = F.concat(
        F.lit('<head><meta name=" KeyWords " content=" '), host, F.lit(' "><meta name="robots" content="x">'),
        F.lit("<meta name=keywords content='"), lang, F.lit("'>"),
    )
    body = F.concat(
        F.lit('<body><input id="other" value="no"><input value="'), F.col("url"), F.lit('" id="query">'),
        F.lit('<span class="big taglist">'), host, F.lit(' </span><p><span class="taglists">no</span>'),
        F.lit('<span class=taglist><b>'), lang, F.lit("</b>\n &amp; more</span></p>"),
        F.lit('<div class="side lemmaWgt-lemmaCatalog"><ol><li><a href="#1">'), host,
        F.lit('</a><li><a href="#1_1">sub</a><li><a href="/item/x">no</a><li><a href="#2"><i>'), lang,
        F.lit("</i> part</a></ol></div>"),
    )
    html = F.replace(F.replace(F.col("html"), F.lit("<head>"), meta), F.lit("<body>"), body)
    return load(spark, sf_dir, "pages").select("page_id", "url", html.alias("html"))


def layered_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """[bk_word, bk_relwords, bk_tags] of parts, whose tags form six levels.

    World, half, quarter, eighth, sixteenth, brand; every third part skips a level, so some tags are kept under parents of
    several rounds. ``lone`` occurs with its brand too seldom to be tied to it and vanishes.
    """
    key = F.col("p_partkey")
    level = lambda n: F.concat(F.lit(f"L{n}-"), (key % n).cast("string"))
    deepest = F.concat(F.lit("B-"), (key % 48).cast("string"))
    chain = F.concat_ws(
        ",", F.lit("world"), level(2), level(4), F.when(key % 3 != 0, level(8)), level(16), deepest, F.when(key < 5, F.lit("lone"))
    )
    return load(spark, sf_dir, "part").select(
        F.concat_ws("-", F.lit("part"), "p_partkey").alias("bk_word"), F.concat_ws(",", "p_name", "p_brand", "p_type").alias("bk_relwords"),
        chain.alias("bk_tags"),
    )


def coded_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """[bk_word, bk_tags] of customers with tags that have a fixed code, by nation, and others that have none."""
    tags = sorted(TAG_NATURE)
    picked = [F.when(F.col("c_nationkey") == i, F.concat_ws(",", "c_mktsegment", F.lit(tags[i % len(tags)]), F.lit(tags[(7 * i + 3) % len(tags)]))) for i in range(25)]
    return load(spark, sf_dir, "customer").select(F.col("c_name").alias("bk_word"), F.coalesce(*picked, F.lit("none")).alias("bk_tags"))
