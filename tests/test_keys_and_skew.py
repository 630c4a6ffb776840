"""One value per lookup key, salting, staging, and plans that must not carry what they do not need."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from lexgraph.functions import html as html_module
from lexgraph.operators.classify import classify_terms
from lexgraph.operators.cooccur import tag_cooccur, tag_count
from lexgraph.operators.hierarchy import tag_paths_for_terms
from lexgraph.operators.html import extract_html
from lexgraph.operators.nature import nature_label
from lexgraph.operators.terms import clean_tags_loose, clean_terms_loose
from lexgraph.operators.tokens import lexicon_matches
from lexgraph.plans import stage as stage_module
from lexgraph.plans.lookup import hot_keys, salted_join
from lexgraph.plans.stage import new_path, release, stage, stage_sized
from lexgraph.sources.tables import write_snapshot


def test_repeated_nature_counts_once(spark):
    terms = spark.createDataFrame([("apple/x", "food,b")], "bk_word string, bk_tags string")
    natures = spark.createDataFrame([("food", "na"), ("food", "nz")], "tag string, nature string")
    assert nature_label(terms, natures).first()["nature"] == "nz"


def test_repeated_class_votes_once(spark):
    terms = spark.createDataFrame([("w", ["r"], ["a"])], "word string, relwords array<string>, tags array<string>")
    classes = spark.createDataFrame([("a", 1), ("a", 2)], "tag string, cls int")
    assert classify_terms(terms, classes).first()["cls"] == 2


def test_repeated_path_counts_once(spark):
    terms = spark.createDataFrame([("w", ["a"])], "word string, tags array<string>")
    paths = spark.createDataFrame([("a", ["a"]), ("a", ["b", "a"])], "tag string, path array<string>")
    row = tag_paths_for_terms(terms, paths).first()
    assert (row["tagidx"], row["taglayer"]) == ("a/2", "b-a")


def test_tags_only_sense_carries_no_related_terms(spark):
    rows = [("a/1", "x,y,z", "t1"), ("a/2", "x,y,w", "t2"), ("b", "x,y,z,q", "t1,t3"), ("c", "x", "t9")]
    df = spark.createDataFrame(rows, "bk_word string, bk_relwords string, bk_tags string")
    slim = clean_tags_loose(df)
    assert sorted(map(tuple, slim.collect())) == sorted(
        (r["word"], r["tags"]) for r in clean_terms_loose(df).collect()
    )
    plan = slim._jdf.queryExecution().executedPlan().toString()
    moved = plan[: plan.index("Exchange")]
    assert "rel" not in moved and tag_count(slim).count() == 3


def test_multiplicities_of_long_tag_lists(spark):
    tags = [f"t{i % 500}" for i in range(1500)]
    terms = spark.createDataFrame([("w", tags)], "word string, tags array<string>")
    got = tag_cooccur(terms)
    assert got.count() == 500 * 499 // 2 and got.select("tag1num", "twotagnum").distinct().collect() == [(3, 9)]


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_salted_join_of_moderate_keys_and_nulls(spark, reuse):
    """A key with 1/300 of the rows is salted at 1,000 partitions; null keys are spread; results are those of a plain join."""
    keep = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.exchange.reuse")}
    try:
        spark.conf.set("spark.sql.exchange.reuse", reuse)
        warm = F.when(F.col("id") % 300 == 0, "warm").when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("k"), F.col("id") % 9000))
        facts = stage(spark.range(60_000).select(warm.alias("key"), "id"), "facts")
        lookup = stage(facts.where("key is not null").groupBy("key").agg(F.max("id").alias("v")), "values")
        spark.conf.set("spark.sql.shuffle.partitions", "1000")
        hot = hot_keys(facts, "key")
        salts = {r["key"]: r["salts"] for r in hot.collect()}
        assert 2 <= salts["warm"] <= 5
        spark.conf.set("spark.sql.shuffle.partitions", "12")
        want = facts.join(lookup, "key", "left")
        got = salted_join(facts, lookup, "key", "left", hot)
        assert got.count() == 60_000 and got.exceptAll(want).isEmpty()
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_long_word_in_lexicon(spark):
    tokens = spark.createDataFrame([(1, 0, "abcabd"), (2, 0, "zab😀c")], "doc_id long, pos int, token string")
    lexicon = spark.createDataFrame([("a" * 5000, "long"), ("ab", "n2"), ("abc", "n3"), ("😀c", "e")], "word string, nature string")
    got = sorted((r["doc_id"], r["start"], r["word"], r["nature"]) for r in lexicon_matches(tokens, lexicon).collect())
    assert got == [(1, 0, "abc", "n3"), (1, 3, "ab", "n2"), (2, 1, "ab", "n2"), (2, 3, "😀c", "e")]


def test_page_failing_in_one_field_keeps_the_others(spark, monkeypatch):
    good = html_module.scan_page

    def scan_page(page, fields, selectors):
        if "broken" in page and "body_text" in fields:
            raise ValueError("this field only")
        return good(page, fields, selectors)

    monkeypatch.setattr(html_module, "scan_page", scan_page)
    pages = spark.createDataFrame([(1, '<a href="/item/x">t</a>broken'), (2, "<body>fine</body>")], "id int, bk_html string")
    seen = Observation()
    rows = {r["id"]: r for r in extract_html(pages, fields=("links", "body_text"), failures=seen).collect()}
    assert (rows[1]["links"], rows[1]["body_text"]) == (["t"], "") and rows[2]["body_text"] == "fine"
    assert seen.get["failed"] == 1


def test_sizes_come_from_the_files_and_are_released(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(stage_module, "stage_root", lambda _: str(tmp_path))
    small = stage_sized(spark.range(1000), "sized")
    assert small.rows == 1000 and 0 < small.size < 100_000 and small.small
    assert new_path(spark, "x").startswith(str(tmp_path)) and any(tmp_path.rglob("*.parquet"))
    release(spark)
    assert not any(tmp_path.rglob("*.parquet"))


def test_no_table_is_left(spark):
    from lexgraph.workload.queries import QUERIES

    before = {t.name for t in spark.catalog.listTables()}
    for key in ("snapshot_scan", "write_table", "classified_snapshot"):
        QUERIES[key](spark, "/root/testdata/sf0.001").count()
    assert {t.name for t in spark.catalog.listTables()} == before


def test_partition_type_is_checked(spark):
    with pytest.raises(TypeError):
        write_snapshot(spark.range(1), "never_made", 1, part_type="bigint) --")
