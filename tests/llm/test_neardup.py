import random

import numpy as np
import pytest
from brute import near

from lexgraph.llm import neardup
from lexgraph.llm.neardup import NearDup


def test_pigeonhole_keys():
    p = NearDup()
    rng = np.random.default_rng(0)
    for _ in range(50):
        a = rng.integers(0, 1 << 16, p.symbols).astype(np.uint64)
        b = a.copy()
        b[rng.choice(p.symbols, 19, replace=False)] += np.uint64(1)
        assert set(neardup.index_keys(a, p).tolist()) & set(neardup.index_keys(b, p).tolist())


def edited(rng, base, edits):
    out = list(base)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**6)}"
    return " ".join(out)


@pytest.mark.parametrize("params", [NearDup(shingle=3, percent=85), NearDup(), NearDup(shingle=3, percent=85, block=900)])
def test_against_all_pairs(spark, params):
    rng = random.Random(5)
    docs, i = {}, 0
    for _ in range(4):
        base = [f"b{rng.randrange(10**6)}" for _ in range(80)]
        for edits in [0, 0, 1, 1, 2, 2, 3, 3, 4, 5, 6, 8, 10, 14] * 3:
            docs[i] = edited(rng, base, edits)
            i += 1
    chain = [f"c{j}" for j in range(60)]
    for _ in range(25):  # each linked to the next only
        chain[rng.randrange(60)] = f"n{i}"
        docs[i] = " ".join(chain)
        i += 1
    ids = list(docs)
    rng.shuffle(ids)
    df = spark.createDataFrame([(k, docs[k]) for k in ids], "doc_id long, text string").repartition(4)
    got = {r[0]: (r[1], r[2]) for r in neardup.near_duplicates(df, params).collect()}
    assert got == near(docs, params.shingle, params.percent)


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 300)] + [(1000, 1001), (5, 5)], "u long, v long")
    got = {r["node"]: r["root"] for r in neardup.components(edges).collect()}
    assert got == {i: 0 for i in range(301)} | {1000: 1000, 1001: 1000}


def test_odd_rows(odd, odd_texts):
    rows = neardup.near_duplicates(odd).collect()
    assert len(rows) == len(odd_texts)
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], set()).add((r["n_shingles"], r["component_id"], r["kept"]))
    assert by_id[1] == {(0, 1, True)} and by_id[2] == {(0, 2, True)} and by_id[3] == {(0, 3, True)}
    assert by_id[4] == {(1, 4, True)}
    assert by_id[5] == {(76, 5, True)} and by_id[6] == {(76, 5, False)} and by_id[12] == {(76, 5, False)}
    assert by_id[None] == {(76, 5, False), (0, None, True)}
    assert {x[1:] for x in by_id[9]} == {(8, False)} and {x[1:] for x in by_id[14]} == {(14, True)}


def test_keep_one(odd):
    out = neardup.keep_one(odd)
    assert out.columns == odd.columns
    ids = [r["doc_id"] for r in out.collect()]
    assert 6 not in ids and 12 not in ids and ids.count(5) == 2 and 1 in ids


def test_empty(empty):
    assert neardup.near_duplicates(empty).collect() == []
