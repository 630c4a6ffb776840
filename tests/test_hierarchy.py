import random

import pytest

from lexgraph.operators import hierarchy as h
from lexgraph.plans import stage

PATHS = [("root", ["root"]), ("food", ["root", "food"]), ("fruit", ["root", "food", "fruit"])]


@pytest.fixture(params=["broadcast", "salted"])
def joins(request, monkeypatch):
    """Both ways of the lookup joins."""
    if request.param == "salted":
        monkeypatch.setattr(stage, "MAX_BROADCAST_ROWS", -1)
    return request.param


def edges_df(spark, edges):
    return spark.createDataFrame(edges, "child string, parent string")


def run(spark, edges):
    kept, layers = h.tag_layers(edges_df(spark, edges))
    paths = h.tag_paths(kept, layers)
    return (
        {tuple(r) for r in kept.collect()},
        dict(map(tuple, layers.collect())),
        {r.tag: (r.path, r.depth) for r in paths.collect()},
    )


def by_rounds(edges):
    """Restatement: take the tops, keep their children that hang on no child of a top, go on."""
    rest, kept, rnd = set(edges), set(), 0
    while rest:
        rnd += 1
        tops = {p for _, p in rest} - {c for c, _ in rest}
        assert tops
        below = {c for c, p in rest if p in tops}
        skipping = {c for c, p in rest if p in below}
        kept |= {(c, p, rnd) for c, p in rest if p in tops and c not in skipping}
        rest = {(c, p) for c, p in rest if p not in tops}
    layers = {p: 0 for _, p, r in kept if r == 1}
    for c, _, r in sorted(kept, key=lambda k: k[2]):
        layers[c] = r
    up = {}
    for c, p, r in sorted(kept, key=lambda k: (k[2], k[1]), reverse=True):
        up[c] = p

    def path(tag):
        return (path(up[tag]) if tag in up else []) + [tag]

    return kept, layers, {t: (path(t), len(path(t)) - 1) for t in layers}


def test_tag_edges(spark):
    rows = [
        ("b", "a", 20, 50, 19), ("d", "c", 20, 50, 18), ("f", "e", 50, 20, 20), ("h", "g", 20, 20, 20),
        ("j", "i", 11, 11, 10),
    ]
    df = spark.createDataFrame(rows, "tag1 string, tag2 string, tag1num long, tag2num long, twotagnum long")
    assert {tuple(r) for r in h.tag_edges(df, 0.9).collect()} == {("b", "a"), ("e", "f"), ("h", "g")}


def test_worked_example(spark, joins):
    edges = [("B", "A"), ("C", "A"), ("D", "A"), ("E", "A"), ("C", "B"), ("F", "B")]
    kept, layers, paths = run(spark, edges)
    assert kept == {("B", "A", 1), ("D", "A", 1), ("E", "A", 1), ("C", "B", 2), ("F", "B", 2)}
    assert layers == {"A": 0, "B": 1, "D": 1, "E": 1, "C": 2, "F": 2}
    assert {">".join(p) for p, _ in paths.values()} == {"A", "A>B", "A>D", "A>E", "A>B>C", "A>B>F"}


def test_vanished_root(spark):
    kept, layers, _ = run(spark, [("X", "T"), ("X", "C"), ("C", "R")])
    assert kept == {("C", "R", 1), ("X", "C", 2)}
    assert layers == {"R": 0, "C": 1, "X": 2}


def test_several_rounds(spark):
    kept, layers, paths = run(spark, [("X", "T1"), ("X", "P2"), ("P2", "Q"), ("Q", "T")])
    assert {k for k in kept if k[0] == "X"} == {("X", "T1", 1), ("X", "P2", 3)}
    assert layers["X"] == 3
    assert paths["X"] == (["T1", "X"], 1)


def test_cycles(spark):
    for edges in ([("a", "b"), ("b", "a")], [("x", "r"), ("a", "x"), ("a", "b"), ("b", "a")], [("a", "a")]):
        with pytest.raises(ValueError, match="cycle"):
            h.tag_layers(edges_df(spark, edges))


def test_no_edges(spark):
    kept, layers, paths = run(spark, [])
    assert (kept, layers, paths) == (set(), {}, {})


@pytest.mark.parametrize("seed", range(3))
def test_random_graphs(spark, joins, seed):
    rnd = random.Random(seed)
    n = 14
    edges = {(f"n{j:02}", f"n{i:02}") for i in range(n) for j in range(i + 1, n) if rnd.random() < 0.25}
    assert run(spark, sorted(edges)) == by_rounds(edges)


def test_long_chain_and_wide_root(spark):
    chain = [(f"c{i + 1:02}", f"c{i:02}") for i in range(9)]
    fan = [(f"f{i:03}", "c00") for i in range(300)]
    _, layers, paths = run(spark, chain + fan)
    assert layers["c09"] == 9
    assert paths["c09"][0] == [f"c{i:02}" for i in range(10)]
    assert paths["f299"] == (["c00", "f299"], 1)


def test_paths_for_terms(spark, joins):
    terms = spark.createDataFrame(
        [
            ("a", ["fruit", "food", "odd"]), ("b", ["odd", "strange"]), ("c", ["food", "root"]),
            ("d", ["fruit", "fruit"]), ("d", ["fruit", "fruit"]),
        ],
        "word string, tags array<string>",
    )
    paths = spark.createDataFrame(PATHS, "tag string, path array<string>")
    got = sorted(tuple(r) for r in h.tag_paths_for_terms(terms, paths).collect())
    assert got == [
        ("a", "fruit,food,odd", "fruit", "root-food-fruit", "odd", "fruit/3,food/2,odd/1"),
        ("b", "odd,strange", "odd", "", "odd,strange", "odd/1,strange/1"),
        ("c", "food,root", "food", "root-food", "", "food/2,root/1"),
        ("d", "fruit,fruit", "fruit", "root-food-fruit", "", "fruit/3,fruit/3"),
        ("d", "fruit,fruit", "fruit", "root-food-fruit", "", "fruit/3,fruit/3"),
    ]
