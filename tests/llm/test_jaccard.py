import random

import numpy as np
import pytest
from brute import near

from lexgraph.llm import jaccard, neardup
from lexgraph.llm.jaccard import Band, Join


def keys_of(found, b, p, rng_rare):
    bands = {x.number: x for x in jaccard.all_bands(p)} | {b.number: b}
    out = set()
    for mine, differ in jaccard.bands_of(len(found), list(bands.values()), p):
        out |= set(jaccard.band_keys(found, rng_rare(found), mine, differ).tolist())
    return out


def edited(rng, size, p):
    """Two sets of hashes that are just linked."""
    a = np.uint64(rng.integers(1 << 50)) + np.arange(size, dtype=np.uint64)
    gone = added = 0
    while True:
        more = (gone, added + 1) if rng.random() < 0.5 else (gone + 1, added)
        common = size - more[0]
        if common < 1 or 100 * common < p.percent * (size + more[1]):
            break
        gone, added = more
    b = np.concatenate([a[gone:], np.uint64(1 << 60) + a[0] + np.arange(added, dtype=np.uint64)])
    return np.sort(neardup.mixed(a)), np.sort(neardup.mixed(b))


@pytest.mark.parametrize("size", [4, 5, 6, 7, 8, 9, 12, 15, 16, 30, 31, 63, 64, 100, 127, 128, 500, 3000])
def test_pigeonhole(size):
    """Every two linked sets share a key, whatever n-grams are frequent."""
    p, rng = Join(), np.random.default_rng(size)
    frequent = lambda found: ((found >> np.uint64(40)) % np.uint64(3) == 0).astype(np.int64)
    b = jaccard.band(size.bit_length() - 1, p)
    for _ in range(40 if size < 200 else 4):
        left, right = edited(rng, size, p)
        assert keys_of(left, b, p, frequent) & keys_of(right, b, p, frequent)


@pytest.mark.parametrize("deletion, spread", [(0, 1), (1, 0), (1, 2), (2, 0), (2, 1), (3, 4)])
def test_every_allocation_finds_all(deletion, spread):
    """Deletion cells, exact cells and both, also where cells are empty."""
    p, rng = Join(percent=70), np.random.default_rng(deletion * 10 + spread)
    size = 20
    differ = p.differing(2 * 31)
    b = Band(4, 16, 32, deletion, max(0, differ + 1 - 2 * deletion) + spread)
    for _ in range(60):
        left, right = edited(rng, size, p)
        if not 16 <= len(right) < 32:
            continue
        plain = lambda found: np.ones(len(found), np.int64)
        mine, theirs = (set(jaccard.band_keys(x, plain(x), b, p.differing(len(x) + min(31, p.largest(len(x))))).tolist()) for x in (left, right))
        assert mine & theirs


def test_allocation_uses_both_kinds():
    p = Join()
    assert jaccard.band(2, p).deletion and not jaccard.band(2, p).exact
    assert not jaccard.band(8, p).deletion and jaccard.band(8, p).exact > p.differing(2 * 511)


def texts_for(rng):
    docs, i = {}, 0
    for length in (9, 14, 40, 90):
        base = [f"b{rng.randrange(10**6)}" for _ in range(length)]
        for edits in [0, 0, 1, 1, 1, 2, 2, 3, 4, 6, 10] * 2:
            out = list(base)
            for _ in range(edits):
                out[rng.choice([0, len(out) - 1, rng.randrange(len(out))])] = f"e{rng.randrange(10**6)}"
            docs[i] = " ".join(out[rng.randrange(2) :])
            i += 1
    shared = [f"s{j}" for j in range(30)]
    for _ in range(60):  # one passage before texts of their own
        docs[i] = " ".join(shared + [f"o{rng.randrange(10**6)}" for _ in range(rng.randrange(3, 60))])
        i += 1
    chain = [f"c{j}" for j in range(60)]
    for _ in range(25):  # each linked to the next only
        chain[rng.randrange(60)] = f"n{i}"
        docs[i] = " ".join(chain)
        i += 1
    return docs


@pytest.mark.parametrize("params", [Join(), Join(buckets=64, least=2), Join(shingle=2, percent=60, block=900)])
def test_against_all_pairs(spark, params):
    rng = random.Random(11)
    docs = texts_for(rng)
    ids = list(docs)
    rng.shuffle(ids)
    df = spark.createDataFrame([(k, docs[k]) for k in ids], "doc_id long, text string").repartition(3)
    got = {r[0]: (r[1], r[2]) for r in jaccard.jaccard_join(df, params).collect()}
    assert got == near(docs, params.shingle, params.percent)


def test_ring_of_many_short_classes(spark):
    """Blocks are bounded by classes as well as by n-grams."""
    rows = [(i, " ".join(f"w{j}" for j in range(12)) + f" x{i} y{i % 7}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    p = neardup.NearDup(shingle=1, percent=80, most=30)
    got = {r[0]: (r[1], r[2]) for r in neardup.near_duplicates(df, p).select("doc_id", "n_shingles", "component_id").collect()}
    assert got == near(dict(rows), 1, 80)


def test_odd_rows(odd, odd_texts):
    rows = jaccard.jaccard_join(odd).collect()
    assert len(rows) == len(odd_texts)
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], set()).add((r["n_shingles"], r["component_id"]))
    assert by_id[1] == {(0, 1)} and by_id[2] == {(0, 2)} and by_id[3] == {(0, 3)} and by_id[4] == {(1, 4)}
    assert by_id[5] == by_id[6] == by_id[12] == {(76, 5)}
    assert by_id[None] == {(76, 5), (0, None)}
    assert {c for _, c in by_id[9]} == {8} and {c for _, c in by_id[14]} == {14}


def test_empty(empty):
    assert jaccard.jaccard_join(empty).collect() == []
