from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from lexgraph.llm import merkle
from lexgraph.llm.queries import op13_merkle


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def tree(leaves):
    """Root, and for each leaf its siblings with their side."""
    paths = [[] for _ in leaves]
    groups, nodes = [[i] for i in range(len(leaves))], list(leaves)
    while len(nodes) > 1:
        above, joined = [], []
        for i in range(0, len(nodes), 2):
            run = nodes[i : i + 2]
            for side, members in enumerate(groups[i : i + 2]):
                for m in members:
                    paths[m].append((side == 1, run[1 - side] if len(run) > 1 else ""))
            above.append(H(*run))
            joined.append(sum(groups[i : i + 2], []))
        nodes, groups = above, joined
    return nodes[0], paths


def plain(rows):
    """[(id, part, leaf)] to sorted rows (id, leaf, subroot, root, proof)."""
    parts = sorted({p for _, p, _ in rows}, key=lambda p: (p is not None, (p or "").encode()))
    subs, out = [], []
    for part in parts:
        mine = sorted((r for r in rows if r[1] == part), key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
        subs.append((mine, *tree([r[2] for r in mine])))
    root, upper = tree([s[1] for s in subs])
    for (mine, sub, paths), above in zip(subs, upper):
        for r, path in zip(mine, paths):
            out.append((r[0], r[2], sub, root, H(*[s for _, s in path + above])))
    return sorted(out, key=str), root


def found(spark, rows, parts=5):
    df = spark.createDataFrame(rows, "doc_id long, part string, leaf string").repartition(parts)
    df = df.withColumns({c: F.lit("x") for c in ("node", "place", "height", "chunk", "root", "path", "total", "key", "kept", "upper")})
    made = merkle.manifest(df, "doc_id")
    made = made.select("doc_id", "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("proof"), merkle.folded(F.col("path"), F.col("leaf")).alias("folded"))
    got = made.collect()
    assert all(r["folded"] == r["root"] for r in got)
    return sorted((tuple(r)[:5] for r in got), key=str)


@pytest.mark.parametrize("sizes", [[1], [2], [3], [5, 1, 2], [7, 8, 9, 16, 17], [255, 256, 257], [600, 1, 3, 40, 2, 5, 9]])
def test_against_plain_trees(spark, sizes):
    rows = [(i * 3, None if p == 1 else f"p{p}" if p % 2 else f"ü{p}", H(str(p), str(i))) for p, n in enumerate(sizes) for i in range(n)]
    assert found(spark, rows) == plain(rows)[0]


def test_rounds(spark, monkeypatch):
    """Small chunks, so that a tree takes several rounds."""
    monkeypatch.setattr(merkle, "CHUNK", 2)
    rows = [(i, "a" if i % 3 else "b", H(str(i))) for i in range(200)]
    assert found(spark, rows) == plain(rows)[0]


def test_hot_key_and_repeats(spark):
    """One id and one leaf hold most rows; null ids come first."""
    rows = [(5, "a", H("same"))] * 700 + [(i, "a", H(str(i))) for i in range(20)] + [(None, "a", H("n")), (None, "b", H("n")), (5, "a", H("other"))]
    assert found(spark, rows) == plain(rows)[0]


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, part string, leaf string")
    assert merkle.manifest(df, "doc_id").collect() == []


def test_leaf(spark):
    df = spark.createDataFrame([(1, None, "é\n", -5, ""), (None, "a", None, None, "x:1")], "a long, b string, c string, d long, e string")
    got = [r[0] for r in df.select(merkle.leaf(*[F.col(c) for c in "abcde"])).collect()]
    assert got == [H("1:1-3:é\n2:-50:"), H("-1:a--3:x:1")]


def test_tampering_shows(spark, odd_texts, tmp_path):
    import zlib

    rows = [(i, t, "en" if i and i % 2 else None, "s", len(t or "") if i != 5 else None, "x") for i, t in odd_texts]
    rows.append((9_000, "t", "en", "s", 2**63 - 1, "x"))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, path string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = op13_merkle(spark, str(tmp_path)).collect()
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, n: H(*[field(v) for v in (r[0], r[3], r[2], n, r[1])])
    wanted, root = plain([(r[0], r[2], leaf(r, r[4])) for r in rows])
    assert sorted(((r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"]) for r in got), key=str) == wanted
    changed = {r[0] for r in rows if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0}
    assert changed
    for r in got:
        assert r["verified"] == (r["doc_id"] not in changed) == (r["folded_root"] == root)
