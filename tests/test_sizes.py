"""Joins, searches and batches whose cost must not grow faster than their tables."""

import random

import pytest
from pyspark.sql import functions as F

from lexgraph.operators import tokens as tokens_module
from lexgraph.operators.html import extract_html
from lexgraph.operators.tokens import count_tokens, lexicon_matches, segment_tokens, tokens_with_nature
from lexgraph.plans import lookup
from lexgraph.plans import stage as stage_module


def token_rows(spark):
    rng = random.Random(2)
    pick = lambda: None if rng.random() < 0.1 else "the" if rng.random() < 0.5 else f"w{rng.randrange(400)}"
    return spark.createDataFrame([(i % 50, i // 50, pick()) for i in range(4_000)] + [(1, 1, "the")] * 3, "doc_id long, pos int, token string")


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("rows", [10**6, -1])
def test_frequent_tokens_are_joined_where_they_are(spark, monkeypatch, how, rows):
    monkeypatch.setattr(stage_module, "MAX_BROADCAST_ROWS", rows)
    monkeypatch.setattr(lookup, "MOST_HOT_KEYS", 100)
    facts = token_rows(spark)
    words = spark.createDataFrame([("the", 1, "d"), *((f"w{i}", i, "n") for i in range(0, 400, 3))], "token string, k int, nature string")
    got = lookup.frequent_join(facts, words, "token", how, count_tokens(facts))
    want = facts.join(words, "token", how).select(got.columns)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()
    if rows > 0 and how == "left":
        # Only rows with rarer tokens come to an exchange.
        moved = facts.join(F.broadcast(count_tokens(facts).where("seen * 100 > 4003 * 0.91")), "token", "left_anti").where("token is not null")
        assert moved.count() < 2_100 and "Exchange hashpartitioning" in got._jdf.queryExecution().executedPlan().toString()


def test_large_lexicon_is_cut_to_the_words_that_occur(spark, monkeypatch):
    facts = token_rows(spark)
    large = spark.range(3_000).select(F.concat(F.lit("w"), "id").alias("word"), F.lit("n").alias("nature"))
    want = sorted(map(tuple, tokens_with_nature(facts, large).collect()), key=str)
    monkeypatch.setattr(stage_module, "MAX_BROADCAST_ROWS", 1_000)  # not the lexicon, but what occurs of it
    got = tokens_with_nature(facts, large)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_short_and_long_tokens_are_searched_alike(spark, monkeypatch):
    """As one row each and by stretches: the same hits and paths; ties, whole tokens, characters beyond the first plane."""
    rng = random.Random(7)
    letters = "abc😀"
    words = sorted({"".join(rng.choices(letters, k=rng.randint(1, 4))) for _ in range(40)})
    lexicon = spark.createDataFrame([(w, f"n{i % 5}", rng.choice([0, 1, 3, 40])) for i, w in enumerate(words)], "word string, nature string, frequency int")
    user = spark.createDataFrame([("ab", "u"), ("c", "u")], "word string, nature string")
    rows = [(i, "".join(rng.choices(letters + "z", k=rng.randint(1, 30)))) for i in range(150)] + [(900, ""), (901, None), (902, "zzz"), (903, "ab" * 300)]
    facts = spark.createDataFrame(rows, "id long, token string")

    def found():
        return [sorted(map(str, f(facts, lexicon, user).collect())) for f in (lexicon_matches, segment_tokens)]

    monkeypatch.setattr(tokens_module, "SHORT", 0)
    want = found()
    for short in (6, 64):
        monkeypatch.setattr(tokens_module, "SHORT", short)
        assert found() == want
    assert any("'u'" in x for x in want[1])


def test_short_tokens_do_not_move_by_their_hits(spark):
    lexicon = spark.createDataFrame([("ab", "n", 2), ("b", "n", 1)], "word string, nature string, frequency int")
    tokens = spark.createDataFrame([(f"ab{i}",) for i in range(300)], "token string")
    hits = tokens_module.hits_of(tokens, lexicon.select("word", "nature"), True, "nature")
    assert hits.count() == 300
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(token") == 1


def test_pages_come_in_small_batches(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "10000")
        pages = spark.range(2_500, numPartitions=1).select("id", F.concat(F.lit('<body><span class="taglist">t'), "id", F.lit("</span>")).alias("html"))
        rows = extract_html(pages, "html", ("tags",)).collect()
        assert int(spark.conf.get(key)) <= 1_000
        assert {r["id"]: r["tags"] for r in rows} == {i: [f"t{i}"] for i in range(2_500)}
    finally:
        spark.conf.set(key, before)
