import random

import numpy as np
import pytest
from brute import repeats

from lexgraph.llm import substring
from lexgraph.llm.substring import Repeats


def dedup(df, p=Repeats()):
    return [tuple(r) for r in substring.dedup_digests(df, p).collect()]


def test_anchors_of_equal_windows_agree():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 6, 400).astype(np.uint64)  # many ties
    places = set(substring.anchor_places(x, 7).tolist())
    for s in range(len(x) - 6):
        least = x[s : s + 7].min()
        assert {s + i for i in range(7) if x[s + i] == least} <= places


@pytest.mark.parametrize("seed", range(4))
def test_against_windows(spark, seed):
    rng = random.Random(seed)
    alphabet = [f"w{i}" for i in range(3 if seed % 2 else 40)]
    pool = [" ".join(rng.choices(alphabet, k=rng.randint(5, 60))) for _ in range(6)]
    docs = {i: " ".join(rng.choices(pool, k=rng.randint(0, 5)) + rng.choices(alphabet, k=rng.randint(0, 30))) for i in range(60)}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(5)
    assert {r[0]: r[1:] for r in dedup(df)} == repeats(docs, 20)


def test_hot_copies(spark):
    body = " ".join(f"x{i}" for i in range(90))
    docs = {i: (f"own{i} " if i % 3 else "") + body + (f" tail{i}" if i % 2 else "") for i in range(300)}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(7)
    assert {r[0]: r[1:] for r in dedup(df)} == repeats(docs, 20)


def test_odd_rows(spark, odd, odd_texts):
    got = dedup(odd)
    assert len(got) == len(odd_texts)
    by_id = {}
    for i, n, removed, sha in got:
        by_id.setdefault(i, set()).add((n, removed, sha))
    assert by_id[1] == by_id[2] == by_id[3] and [x[:2] for x in by_id[1]] == [(0, 0)]
    # A null id comes first, so its passage stays and that of 5, a repeated row, goes from both rows.
    assert sorted(x[:2] for x in by_id[None]) == [(0, 0), (80, 0)]
    assert [x[:2] for x in by_id[5]] == [(80, 80)] and [x[:2] for x in by_id[6]] == [(80, 80)]
    assert [x[:2] for x in by_id[7]] == [(84, 80)]
    assert [x[:2] for x in by_id[9]] == [(60_001, 60_000)]
    assert len(by_id[14]) == 2


def test_empty(empty):
    assert dedup(empty) == []
    assert substring.remove_repeats(empty).collect() == []


def test_remove_keeps_columns(odd):
    out = substring.remove_repeats(odd)
    assert out.columns == odd.columns and out.schema["doc_id"] == odd.schema["doc_id"]
    rows = {(r["doc_id"], r["text"]) for r in out.collect()}
    assert (7, "Before it and after") in rows and (4, "one") in rows and (6, "") in rows
    assert all(r["key"] == "x" for r in out.collect()) and out.count() == odd.count()
