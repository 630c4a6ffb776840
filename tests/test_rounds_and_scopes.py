"""Work that is split or done by deltas, tables that are cleaned into themselves, failures as rows, staging scopes."""

import random
from itertools import product
from math import log

import pytest
from pyspark.sql import functions as F

from lexgraph.operators import cooccur, hierarchy
from lexgraph.operators.cooccur import tag_cooccur
from lexgraph.operators.hierarchy import tag_layers
from lexgraph.operators.html import extract_html, extract_with_failures, spread_pages
from lexgraph.operators.tokens import merge_lexicon, segment_tokens
from lexgraph.plans import jobs, lookup
from lexgraph.plans import stage as stage_module
from lexgraph.plans.lookup import salted_join
from lexgraph.plans.stage import stage, stage_root, staging
from lexgraph.sources.tables import write_snapshot, write_table

# Best paths


def every_path(token, words, total):
    """(cost, words, starts) of the best of all ways to cut a token."""
    unknown = round(log(total / 0.5) * 1_000_000)
    best = None
    for cuts in product([False, True], repeat=len(token) - 1):
        starts = [0, *(i + 1 for i, c in enumerate(cuts) if c)]
        parts = [token[a:b] for a, b in zip(starts, [*starts[1:], len(token)])]
        if all(p in words or len(p) == 1 for p in parts):
            cost = sum(round(log(total / words[p][1]) * 1_000_000) if p in words else unknown for p in parts)
            way = (cost, len(parts), starts, [(p, words[p][0] if p in words else "x") for p in parts])
            best = min(best or way, way)
    return best[3]


@pytest.mark.parametrize("joins", ["broadcast", "salted"])
def test_best_path_is_that_of_all_paths(spark, monkeypatch, joins):
    if joins == "salted":
        monkeypatch.setattr(stage_module, "MAX_BROADCAST_ROWS", -1)
    rng = random.Random(4)
    lexicon = {"".join(rng.choice("ab中") for _ in range(rng.randrange(1, 5))): rng.choice([1, 2, 2, 50, 400]) for _ in range(40)}
    words = {w: (f"n{len(w)}", f) for w, f in lexicon.items()}
    user = {"ab中": "u", "bb": "u"}
    words |= {w: (n, 1024) for w, n in user.items()}
    total = sum(f for _, f in words.values())
    tokens = ["".join(rng.choice("ab中z") for _ in range(rng.randrange(1, 12))) for _ in range(150)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*tokens, "", None])], "id int, token string")
    lex = spark.createDataFrame([(w, f"n{len(w)}", f) for w, f in lexicon.items()], "word string, nature string, frequency int")
    got = {}
    for r in segment_tokens(df, lex, spark.createDataFrame(list(user.items()), "word string, nature string")).collect():
        got.setdefault(r["id"], {})[r["part"]] = (r["word"], r["nature"])
    assert got.keys() == set(range(len(tokens)))
    for i, token in enumerate(tokens):
        assert [got[i][k] for k in range(len(got[i]))] == every_path(token, words, total), token


def test_long_tokens_and_pieces(spark, monkeypatch):
    from lexgraph.operators import tokens as tokens_module

    monkeypatch.setattr(tokens_module, "PIECE", 7)
    text = "abcab" * 200
    df = spark.createDataFrame([(1, text)], "id int, token string")
    lexicon = spark.createDataFrame([("abc", "n"), ("ab", "m"), ("cabab", "o")], "word string, nature string")
    rows = sorted((r["part"], r["start"], r["word"]) for r in segment_tokens(df, lexicon).collect())
    assert "".join(w for _, _, w in rows) == text and [w for _, _, w in rows][:4] == ["ab", "cabab", "cabab", "cabab"]
    found = {(r["start"], r["word"]) for r in tokens_module.lexicon_matches(df, lexicon).collect()}
    wanted = set()
    for i in range(len(text)):
        hit = max((w for w in ("abc", "ab", "cabab") if text.startswith(w, i)), key=len, default=None)
        if hit:
            wanted.add((i, hit))
    assert found == wanted


def test_user_words_have_their_frequency(spark):
    lexicon = spark.createDataFrame([("a", "n", 7), ("a", "m", 5), ("b", "n", 1)], "word string, nature string, frequency long")
    user = spark.createDataFrame([("b", "u"), ("c", "u")], "word string, nature string")
    got = {r["word"]: (r["nature"], r["frequency"]) for r in merge_lexicon(lexicon, user).collect()}
    assert got == {"a": ("n", 12), "b": ("u", 1024), "c": ("u", 1024)}


# Split work


def test_one_term_is_counted_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(cooccur, "BLOCK", 16)
    tags = [f"t{i:04}" for i in range(300)]
    listed = spark.createDataFrame([(tags,)], "raw array<string>").select(
        F.transform("raw", lambda t: F.struct(t.alias("tag"), F.lit(1).alias("m"))).alias("tags")
    )
    blocks = cooccur.dealt_blocks(listed)
    assert blocks.count() == 19 and blocks.select(F.spark_partition_id()).distinct().count() > 1
    terms = spark.createDataFrame([("w", tags + tags[:3]), ("v", ["t0001", "t0000", "t0001"])], "word string, tags array<string>")
    got = {(r["tag1"], r["tag2"]): tuple(r)[2:] for r in tag_cooccur(terms).collect()}
    assert len(got) == 300 * 299 // 2
    assert got[("t0001", "t0000")] == (4, 3, 6) and got[("t0299", "t0002")] == (1, 2, 2)


def test_term_of_twenty_thousand_tags_is_dealt(spark):
    listed = spark.range(1).select(
        F.transform(F.sequence(F.lit(1), F.lit(20_000)), lambda i: F.struct(F.lpad(i.cast("string"), 5, "0").alias("tag"), F.lit(1).alias("m"))).alias("tags")
    )
    shares = cooccur.dealt_blocks(listed).select(F.spark_partition_id().alias("p"), (F.size("low").cast("long") * F.size("high")).alias("n"))
    per_task = [r["n"] for r in shares.groupBy("p").agg(F.sum("n").alias("n")).collect()]
    assert len(per_task) > 4 and max(per_task) < 0.6 * sum(per_task)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_equal_rows_of_a_hot_key_are_spread(spark, how):
    """One key and one row value in 90 % of the rows; null keys too."""
    key = F.when(F.col("id") % 10 > 0, "hot").when(F.col("id") % 20 == 0, None).otherwise(F.concat(F.lit("k"), F.col("id") % 50))
    facts = stage(spark.range(20_000).select(key.alias("key"), F.lit("same").alias("v")), "facts")
    side = stage(spark.createDataFrame([("hot", 1), ("k10", 2), ("other", 3)], "key string, w int"), "side")
    got, want = salted_join(facts, side, "key", how), facts.join(side, "key", how)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    if how == "inner":
        salts = lookup.spread_rows(facts, "key", lookup.hot_keys(facts, "key")).where("key = 'hot'").collect()
        assert len({r["__salt"] for r in salts}) == len(salts) >= 7 and sum(r["__copies"] for r in salts) == 18_000
        assert max(r["__copies"] for r in salts) < 2_800


# Delta rounds


def plain_rounds(edges):
    rounds, left, now = {}, set(edges), 0
    while left:
        now += 1
        children = {c for c, _ in left}
        taken = {e for e in left if e[1] not in children}
        if not taken:
            raise ValueError
        rounds |= dict.fromkeys(taken, now)
        left -= taken
    return rounds


@pytest.mark.parametrize("bound", [None, -1, 40])
def test_rounds_by_deltas(spark, monkeypatch, bound):
    if bound is not None:
        monkeypatch.setattr(stage_module, "MAX_BROADCAST_ROWS", bound)
    rng = random.Random(8)
    edges = {(f"t{a}", f"t{b}") for _ in range(120) for a, b in [sorted((rng.randrange(60), rng.randrange(60)), reverse=True)] if a - b in range(1, 25)}
    df = stage_module.stage_sized(spark.createDataFrame(sorted(edges), "child string, parent string"), "edges")
    rounds, n = hierarchy._rounds(df)
    got = {(r["child"], r["parent"]): r["round"] for r in rounds.collect()}
    wanted = plain_rounds(edges)
    assert got == wanted and n == max(wanted.values()) and rounds.count() == len(edges)


@pytest.mark.parametrize("bound", [None, -1])
def test_cycles_are_found(spark, monkeypatch, bound):
    if bound is not None:
        monkeypatch.setattr(stage_module, "MAX_BROADCAST_ROWS", bound)
    for edges in ([("b", "a"), ("d", "c"), ("c", "d"), ("c", "b")], [("a", "b"), ("b", "a")]):
        with pytest.raises(ValueError, match="cycle"):
            tag_layers(spark.createDataFrame(edges, "child string, parent string"))


def test_deep_chain_is_read_a_bounded_number_of_times(spark, monkeypatch):
    """200 layers take a few staged tables, not some for each layer."""
    written = []
    monkeypatch.setattr(hierarchy, "stage_sized", lambda df, label: written.append(label) or stage_module.stage_sized(df, label))
    edges = [(f"c{i + 1:03}", f"c{i:03}") for i in range(200)]
    kept, layers = tag_layers(spark.createDataFrame(edges, "child string, parent string"))
    assert {(r["tag"], r["layer"]) for r in layers.collect()} == {(f"c{i:03}", i) for i in range(201)}
    assert len(written) < 10


# Tables that read themselves


def test_table_is_cleaned_into_itself(spark):
    spark.sql("DROP TABLE IF EXISTS self_made")
    write_table(spark.range(100).select("id", (F.col("id") % 3).alias("k")), "self_made")
    write_table(spark.table("self_made").where("k = 1").select("id", (F.col("id") * 10).alias("k")), "self_made")
    assert sorted(map(tuple, spark.table("self_made").collect())) == [(i, 10 * i) for i in range(1, 100, 3)]
    spark.sql("DROP TABLE self_made")


def test_snapshot_from_its_own_date(spark):
    spark.sql("DROP TABLE IF EXISTS self_dated")
    write_snapshot(spark.range(10), "self_dated", 1)
    write_snapshot(spark.table("self_dated").where("stat_date = 1").select(F.col("id") + 100), "self_dated", 2)
    write_snapshot(spark.table("self_dated").where("stat_date = 1 and id < 3").select("id"), "self_dated", 1)
    got = sorted(map(tuple, spark.table("self_dated").collect()))
    assert got == [(i, 1) for i in range(3)] + [(100 + i, 2) for i in range(10)]
    spark.sql("DROP TABLE self_dated")


def test_other_refusals_are_raised(spark):
    spark.sql("DROP TABLE IF EXISTS self_other")
    write_table(spark.range(3), "self_other")
    with pytest.raises(Exception):
        write_table(spark.range(3).select("id", F.lit("x").alias("more")), "self_other")
    assert spark.table("self_other").count() == 3
    spark.sql("DROP TABLE self_other")


# Failures and scopes


def test_failures_are_rows(spark, monkeypatch):
    from lexgraph.functions import html as html_module

    good = html_module.scan_page

    def scan_page(page, fields, selectors):
        if "broken" in page and "body_text" in fields:
            raise ValueError("this field only")
        return good(page, fields, selectors)

    monkeypatch.setattr(html_module, "scan_page", scan_page)
    rows = [(1, '<input id="query" value="v">broken'), (2, "<p>no box"), (3, '<input id="query">'), (4, None), (5, "")]
    pages = spark.createDataFrame(rows, "id int, bk_html string")
    found, failed = extract_with_failures(pages, fields=("input", "body_text"))
    assert {r["id"]: (r["input"], r["body_text"]) for r in found.collect()}[1] == ("v", "") and found.columns == ["id", "input", "body_text"]
    assert sorted(map(tuple, failed.collect())) == [(1, "body_text", "ValueError"), (2, "input", "missing")]


def test_few_splits_are_spread(spark, tmp_path):
    spark.range(100).select("id", F.lit("<p>x").alias("bk_html")).coalesce(1).write.parquet(f"{tmp_path}/one")
    one, cores = spark.read.parquet(f"{tmp_path}/one"), spark.sparkContext.defaultParallelism
    many = spark.range(0, 1000, 1, 4 * cores).select("id", F.lit("<p>x").alias("bk_html"))
    assert spread_pages(one).rdd.getNumPartitions() == (cores if cores > 1 else 1)
    assert "Exchange" not in spread_pages(many)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in extract_html(many, fields=("body_text",))._jdf.queryExecution().executedPlan().toString()


def test_scopes_delete_what_they_staged(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(stage_module, "stage_root", lambda _: str(tmp_path))
    parts = lambda: len(list(tmp_path.rglob("*.parquet")))
    kept = stage(spark.range(10), "kept")
    before = parts()
    with pytest.raises(KeyError), staging(spark):
        with staging(spark):
            assert stage(spark.range(5), "inner").count() == 5
        assert parts() == before
        stage(spark.range(5), "outer")
        raise KeyError
    assert parts() == before and kept.count() == 10


def test_jobs_leave_only_their_outputs(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(stage_module, "stage_root", lambda _: str(tmp_path / "staged"))
    spark.sql("DROP TABLE IF EXISTS scoped_pairs")
    pairs = spark.createDataFrame([("b", "a", 20, 30, 20), ("c", "b", 15, 20, 15)], "tag1 string, tag2 string, tag1num long, tag2num long, twotagnum long")
    write_snapshot(pairs, "scoped_pairs", 1)
    jobs.JOBS["layer_tags"](spark, src="scoped_pairs", out=str(tmp_path / "out"), thres="0.9")
    assert sorted(r["value"] for r in spark.read.text(f"{tmp_path}/out/multilayer").collect()) == ["a", "a>b", "a>b>c"]
    assert not list((tmp_path / "staged").rglob("*.parquet"))
    spark.sql("DROP TABLE scoped_pairs")


def test_hot_keys_from_counts(spark):
    counted = spark.createDataFrame([("a", 900), (None, 50), *[(f"k{i}", 1) for i in range(50)]], "key string, n long")
    found = {r["key"]: r["salts"] for r in lookup.counted_hot(counted, "key", "n").collect()}
    assert found == {"a": round(0.9 * int(spark.conf.get("spark.sql.shuffle.partitions")) + 0.49)} and stage_root(spark)
