"""The pipeline over planted documents, and the registered queries."""

import random
from hashlib import sha256

import pytest
from brute import near, repeats
from oracle import compare, connect

import __spark_entry__ as entry
import corpus_pipeline
from lexgraph.llm.queries import ORACLES, QUERIES, tokenizer_path

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(12)
    words = [f"v{i}" for i in range(5000)]
    text = lambda n: " ".join(rng.choices(words, k=n))
    docs, labels, item = {}, {}, text(40)
    passage = text(70)
    for i in range(150):
        body = text(rng.randint(60, 200))
        if i % 10 == 1:
            body += " vile " + text(5) + " nasty"
            labels[i] = 1
        else:
            labels[i] = 0
        if i % 10 == 4:
            body = docs[i - 4] if i % 20 == 4 else docs[i - 4] + " one more"
        if i % 10 == 5:
            body += "\n" + passage
        if i % 10 == 6 and i < 40:
            body += " " + item + " " + text(3)
        docs[i] = body
    docs[150], docs[151] = None, ""
    root = str(tmp_path_factory.mktemp("corpus"))
    rows = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in docs.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(i, 1, t) for i, t in labels.items()], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root, docs, item


def test_against_brute_force(spark, corpus):
    from tokenizers import Tokenizer

    root, docs, item = corpus
    left = {i: t or "" for i, t in docs.items() if not t or "vile" not in t}
    left = {i: t for i, t in left.items() if near(left, 5, 80)[i][1] == i}
    cut = {}
    gone = repeats(left, 50)
    for i, t in left.items():
        w = t.split()
        cut[i] = t if not gone[i][1] else None
    seen = set()
    for i in sorted(left):  # what is kept, as text
        w = left[i].split()
        drop = [False] * len(w)
        for s in range(len(w) - 49):
            k = tuple(w[s : s + 50])
            if k in seen:
                drop[s : s + 50] = [True] * 50
            seen.add(k)
        if any(drop):
            cut[i] = " ".join(x for x, d in zip(w, drop) if not d)
    want = {i: t for i, t in cut.items() if item not in t}
    tokenizer = Tokenizer.from_file(tokenizer_path())
    ids = {i: tokenizer.encode(t, add_special_tokens=False).ids for i, t in want.items()}
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"]) for r in corpus_pipeline.run(spark, root).collect()}
    assert set(got) == set(want) and len(want) < len(docs) - 30
    assert got == {i: (len(x), sha256(",".join(map(str, x)).encode()).hexdigest()) for i, x in ids.items()}


def test_stages_keep_the_columns(spark, corpus):
    root, docs, _ = corpus
    df = spark.read.parquet(f"{root}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "substring_dedup", "decontamination", "bpe"]
    for _, apply in corpus_pipeline.STAGES[:-1]:
        out = apply(spark, df, root)
        assert out.schema.simpleString() == df.schema.simpleString()
        assert apply(spark, df.limit(0), root).count() == 0


@pytest.mark.parametrize("key", list(ORACLES))
def test_query_against_sql(spark, key):
    assert compare(QUERIES[key](spark, SF_DIR), connect(SF_DIR), ORACLES[key]) == ""


def test_all_are_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert "pipeline" not in entry.oracle_sql()


@pytest.mark.parametrize("key", [k for k in QUERIES if k not in ORACLES])
def test_query_returns_every_document(spark, key):
    ids = [r["doc_id"] for r in QUERIES[key](spark, SF_DIR).select("doc_id").collect()]
    assert sorted(ids) == sorted(r["doc_id"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id").collect())
