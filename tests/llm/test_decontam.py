import random

import numpy as np

from lexgraph.llm import decontam
from lexgraph.llm.decontam import Decontam


def plain_lcs(a, b):
    rows = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, rows[j] = rows[j], before + 1 if x == y else max(rows[j], rows[j - 1])
    return rows[-1]


def test_common_subsequence():
    rng = np.random.default_rng(4)
    for _ in range(100):
        a, b = rng.integers(0, 5, rng.integers(1, 90)), rng.integers(-1, 5, rng.integers(0, 120))
        assert decontam.common_subsequence(a, b) == plain_lcs(a.tolist(), b.tolist())


def test_answers():
    assert decontam.answer_of("What is it? An old clock") == " An old clock"
    assert decontam.answer_of("It came. It went away.") == "It went away."
    assert decontam.holds(np.array([3, 1, 2, 9]), np.array([1, 2])) and not decontam.holds(np.array([1, 9, 2]), np.array([1, 2]))
    assert not decontam.holds(np.array([1]), np.array([], np.int64))


def corpus(rng):
    """Documents with whole items, with paraphrases of them (some words changed), and without."""
    words = [f"t{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(20, 55))) + ". " + " ".join(rng.choices(words, k=4))) for i in range(30)]
    docs, want = [], {}
    for d in range(240):
        body, kind = rng.choices(words, k=rng.randint(30, 400)), d % 4
        if kind in (0, 1):
            i, text = rng.choice(items)
            piece = text.replace(".", "").split()
            if kind == 1:  # three in ten words changed, the answer kept
                for at in rng.sample(range(len(piece) - 4), int(0.3 * len(piece))):
                    piece[at] = "changed"
            at = rng.randrange(len(body))
            body[at:at] = piece
            want[d] = i
        docs.append((d, " ".join(body)))
    return items, docs, want


def test_whole_items_and_paraphrases(spark):
    items, docs, want = corpus(random.Random(8))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: r["item_ids"] for r in decontam.contaminated(df, bench).collect()}
    assert set(got) == {d for d, _ in docs}
    assert {d: i for d, i in got.items() if i} == {d: [i] for d, i in want.items()}
    # In blocks of items the same.
    blocks = {r["doc_id"]: r["item_ids"] for r in decontam.contaminated(df, bench, Decontam(block=7)).collect()}
    assert blocks == got


def test_retrieval_finds_what_brute_force_finds(spark):
    """Recall of the latent search against subsequences over all passages of all documents."""
    items, docs, _ = corpus(random.Random(9))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    block = decontam.read_block(items)
    numbers = decontam.WordNumbers(block.vocabulary)
    brute = set()
    for d, text in docs:
        ids = numbers.all(text.encode())
        for k, words in enumerate(block.words):
            if max(decontam.common_subsequence(words, ids[s : s + 120]) for s in range(0, len(ids), 24)) >= 0.75 * len(words):
                brute.add((d, block.ids[k]))
    got = decontam.contaminated(df, spark.createDataFrame(items, "item_id long, text string"))
    found = {(r["doc_id"], i) for r in got.collect() for i in r["item_ids"]}
    assert len(brute) > 50 and len(brute & found) >= 0.98 * len(brute)


def test_odd_rows(spark, odd, empty, odd_texts):
    bench = spark.createDataFrame([(1, "some words that stand nowhere at all, not one of them"), (2, None), (3, " "), (None, "x y z")], "item_id long, text string")
    rows = decontam.contaminated(odd, bench).collect()
    assert len(rows) == len(odd_texts) and not any(r["contaminated"] for r in rows)
    passage = next(t for i, t in odd_texts if i == 5)
    hits = decontam.contaminated(odd, spark.createDataFrame([(7, passage)], "item_id long, text string")).collect()
    assert sorted(str(r["doc_id"]) for r in hits if r["contaminated"]) == sorted(["5", "5", "6", "7", "12", "None"])
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r["contaminated"] for r in decontam.contaminated(odd, none).collect())
    assert decontam.contaminated(empty, bench).collect() == []


def test_items_of_any_length(spark):
    """Verbatim items of 5 to 1,000 words, among words of the benchmark."""
    rng = random.Random(12)
    words = [f"t{i}" for i in range(3_000)]
    items = [(i, " ".join(rng.sample(words, size))) for i, size in enumerate((5, 9, 14, 400, 1_000) * 3)]
    docs, want = [], {}
    for d in range(60):
        body = rng.choices(words, k=rng.randint(200, 600))
        if d % 2:
            i, text = items[d // 2 % len(items)]
            at = rng.randrange(len(body))
            body[at:at] = text.split()
            want[d] = [i]
        docs.append((d, " ".join(body)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    rows = decontam.contaminated(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {r["doc_id"]: r["item_ids"] for r in rows if r["contaminated"]} == want
    assert all(r["best_lcs"] == 1.0 for r in rows if r["contaminated"])


def test_prefilter_counts_repeated_words(spark):
    """Three quarters of an item may be one word."""
    rng = random.Random(13)
    words = [f"t{i}" for i in range(60)]
    item = " ".join("same" if i % 4 else words[i] for i in range(40))
    text = " ".join("same" if i % 4 else f"other{i}" for i in range(40))
    docs = spark.createDataFrame([(1, text), (2, " ".join(rng.choices(words, k=80)))], "doc_id long, text string")
    rows = decontam.contaminated(docs, spark.createDataFrame([(7, item)], "item_id long, text string"), Decontam(cosine=0.1)).collect()
    assert {r["doc_id"]: r["item_ids"] for r in rows} == {1: [7], 2: []}


def passages(texts, size, p):
    """[passage, word] counts, one row for each passage of each text of word numbers."""
    rows = []
    for ids in texts:
        for begin in range(0, max(1, -(-len(ids) // p.step) - p.parts + 1) * p.step, p.step):
            here = ids[begin : begin + p.step * p.parts]
            rows.append(np.bincount(here[here >= 0], minlength=size))
    return np.array(rows, float)


def test_pairs_of_words_in_passages(monkeypatch):
    """Against passages written out, as a matrix and as sorted cells."""
    rng, p, size = np.random.default_rng(5), Decontam(step=4), 30
    texts = [rng.integers(-1, size, n) for n in (0, 1, 4, 5, 11, 12, 13, 60, 0, 200)] + [np.full(20, 3), np.full(30, -1)]
    mass = np.r_[0.0, rng.random(size - 1)]
    rows = passages(texts, size, p)
    squared = (rows * rows) @ mass
    want = rows.T @ (rows * np.divide(1, squared, out=np.zeros_like(squared), where=squared > 0)[:, None])
    for cells in (decontam.MATRIX, 64):
        monkeypatch.setattr(decontam, "MATRIX", cells)
        sums = decontam.PairSums(size)
        assert decontam.add_pairs(texts, mass, sums, p) == len(rows)
        got = np.zeros((size, size))
        for batch in sums.take():
            got += decontam.unpacked_rows(batch, batch.column("word").to_pylist(), size, size)
        np.testing.assert_allclose(got, want, atol=1e-9)
        assert not np.any([batch.num_rows for batch in sums.take()])


def test_space_is_fitted_on_all_documents(spark):
    """2,400 documents: the sums hold the passages of each of them, not those of some."""
    rng, p = random.Random(3), Decontam()
    words = [f"t{i}" for i in range(300)]
    docs = [(d if d % 7 else None, " ".join(rng.choices(words, k=rng.randint(0, 90))) if d % 11 else None) for d in range(2_400)]
    block = decontam.read_block([(1, " ".join(words[:40])), (2, " ".join(words[30:70]))])
    numbered = decontam.numbered_words(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), block)
    idf = np.random.default_rng(6).random(len(block.vocabulary))
    found, count = decontam.pair_sums(numbered, idf, p)
    table, size = found.toArrow(), len(idf)
    got = decontam.unpacked_rows(table, table.column("word").to_pylist(), size, size)
    numbers = decontam.WordNumbers(block.vocabulary)
    rows = passages([numbers.all((text or "").encode()) for _, text in docs], size, p)
    squared = (rows * rows) @ (idf * idf)
    assert count == len(rows) == sum(max(1, -(-len((t or "").split()) // p.step) - p.parts + 1) for _, t in docs)
    np.testing.assert_allclose(got, rows.T @ (rows * np.divide(1, squared, out=np.zeros_like(squared), where=squared > 0)[:, None]), atol=1e-9)
