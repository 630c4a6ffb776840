import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexgraph.llm import negatives
from lexgraph.llm.negatives import Mining

ROW = "vec_id long, label int, vector array<float>, score string, rank string, id string"
NAMES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def plain(rows, every, p=Mining()):
    """All inner products, anchor by anchor."""
    rows = [(i, label, [int(np.floor(p.scale * float(np.float32(x)))) for x in v]) for i, label, v in rows if label is not None and v is not None and all(
        x is not None and np.isfinite(x) for x in v)]
    last = lambda i: (i is None, i or 0)
    out = Counter()
    for at, (i, label, v) in enumerate(rows):
        if i is None or i % every:
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), j, other) for k, (j, other, w) in enumerate(rows) if k != at]
        scored.sort(key=lambda x: (-x[0], last(x[1])))
        for score, j, _ in [x for x in scored if x[2] == label][: p.positives]:
            hard = [x for x in scored if x[2] != label and p.low * score <= 100 * x[0] <= p.high * score]
            for rank, (s, k, _) in enumerate(hard[: p.negatives], 1):
                out[(i, j, rank, k, score, s)] += 1
    return out


def mined(spark, rows, every, p=Mining(), parts=4):
    df = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], ROW).repartition(parts)
    found = negatives.hard_negatives(df, F.col("vec_id") % every == 0, p)
    assert found.columns == NAMES
    return Counter(tuple(r) for r in found.collect())


def clustered(rng, n, width=12):
    centres = rng.normal(size=(4, width))
    labels = rng.integers(0, 4, n)
    vectors = centres[labels] + 0.4 * rng.normal(size=(n, width))
    return [(i, int(labels[i] if rng.random() < 0.8 else rng.integers(0, 4)), vectors[i].astype(np.float32).tolist()) for i in range(n)]


@pytest.mark.parametrize("p", [Mining(), Mining(anchors=3, run=16, pilot=2), Mining(positives=2, negatives=7, low=30, high=110, run=50)])
def test_against_all_products(spark, p):
    rows = clustered(np.random.default_rng(3), 400)
    random.Random(1).shuffle(rows)
    got = mined(spark, rows, 20, p)
    assert got == plain(rows, 20, p) and got


def test_far_candidates_are_not_scored():
    """Candidates whose bounds miss the window keep bounds that hold."""
    rng = np.random.default_rng(0)
    vectors = np.round(rng.normal(size=(40, 8)) * 3 + 200)
    order, parent, length, level = negatives.spanning_tree(vectors)
    own = vectors[order]
    row = {
        "block": 1, "rows": 40, "width": 8, "labels": np.zeros(40, np.int64).tobytes(), "vectors": negatives.small_int(own),
        "parents": parent.tobytes(), "lengths": length.tobytes(), "levels": level.tobytes(),
        "low": np.full((40, 1), 10**7, np.int64).tobytes(), "high": np.full((40, 1), 10**8, np.int64).tobytes(),
    }
    block = negatives.Block(row, 1, 5, False)
    given = np.round(rng.normal(size=(100, 8)) * 50)
    block.meet(np.arange(100), np.ones(100, np.int64), given, np.sqrt((given**2).sum(1)))
    assert not (block.scores > negatives.LEAST).any() and not block.found().num_rows


def test_tree_spans():
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(60, 5))
    order, parent, length, level = negatives.spanning_tree(vectors)
    assert sorted(order) == list(range(60)) and (parent >= 0).sum() == 59 and parent[0] == -1
    own = vectors[order]
    assert np.allclose(length[1:], np.linalg.norm(own[1:] - own[parent[1:]], axis=1))
    assert (level[1:] == level[parent[1:]] + 1).all()
    # No spanning tree is shorter: Kruskal.
    apart = sorted((float(np.linalg.norm(vectors[i] - vectors[j])), i, j) for i in range(60) for j in range(i))
    root = list(range(60))

    def find(x):
        return x if root[x] == x else find(root[x])

    total = 0.0
    for d, i, j in apart:
        if find(i) != find(j):
            root[find(i)], total = find(j), total + d
    assert np.isclose(total, length.sum())


def test_odd_rows(spark):
    one = [0.5, 0.25]
    rows = [
        (0, 1, one), (0, 1, one), (20, 1, one), (1, 1, one), (2, 2, one), (2, 2, one), (3, 2, one), (4, None, one), (5, 2, None), (6, 2, [None, 0.1]),
        (7, 2, [float("nan"), 0.1]), (8, 2, [float("inf"), 0.1]), (None, 2, one), (None, 1, [0.5, 0.25]), (9, 2, [0.5, 0.2]), (10, 1, [-0.5, 0.0]),
        (40, 5, [0.1, 0.1]), (60, 1, None), (80, None, one), (11, 1, [0.0, 0.0]), (12, 3, [0.0, 0.0]), (100, 3, [0.0, 0.0]),
    ]
    got = mined(spark, rows, 20)
    assert got == plain(rows, 20)
    # The anchor that stands twice has its twin as a positive, and each of the two has its rows.
    assert got[(0, 0, 1, 2, 20480, 20480)] == 2
    assert not any(r[0] in (40, 60, 80) for r in got)


def test_lengths_and_empty(spark):
    rows = [(0, 1, [0.5, 0.5]), (1, 1, [0.5]), (2, 2, [0.25, 0.25, 9.0]), (3, 2, []), (20, 2, [])]
    assert mined(spark, rows, 20) == plain(rows, 20)
    assert mined(spark, [], 20) == Counter()
    assert mined(spark, [(1, 1, [0.5])], 20) == Counter()


def test_too_large(spark):
    with pytest.raises(Exception, match="2\\*\\*26"):
        mined(spark, [(0, 1, [1e9]), (1, 1, [1.0])], 20)
