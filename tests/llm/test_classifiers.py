"""Quality, toxicity and language: learned models on small planted data, and odd rows."""

import random

import numpy as np
import pytest

from lexgraph.llm import langid, quality, toxicity


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(400):
        body = rng.choices(words, k=rng.randint(5, 60))
        bad = i % 4 == 0
        if bad:
            for _ in range(3):
                body.insert(rng.randrange(len(body)), rng.choice(["Vile,", "vile", "nasty!", "NASTY"]))
        rows.append((i, " ".join(body), int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string, label int").repartition(3)


def test_ftrl_separates():
    p = quality.Ftrl()
    texts = [(b"good words here " * 3, 1), (b"spam### spam### now", 0)] * 30
    w = quality.ftrl([(*quality.features(t, p), y) for t, y in texts], p)
    score = lambda t: float(quality.sigmoid(w[quality.features(t, p)[0]] @ quality.features(t, p)[1]))
    assert score(b"good words here") > 0.9 and score(b"spam### now") < 0.1


def test_quality_held_out(planted):
    train, test = planted.where("doc_id % 5 <> 1"), planted.where("doc_id % 5 = 1")
    w = quality.train_quality(train, train.select("doc_id", "label"))
    scored = {r["doc_id"]: r["score"] for r in quality.score_quality(test, w).collect()}
    right = [(scored[r["doc_id"]] >= 0.5) == bool(r["label"]) for r in test.collect()]
    assert np.mean(right) > 0.9


def test_training_does_not_depend_on_partitions(planted):
    labels = planted.select("doc_id", "label")
    a = quality.train_quality(planted, labels)
    b = quality.train_quality(planted.repartition(7), labels)
    assert np.allclose(a, b)


@pytest.mark.parametrize("seed", range(3))
def test_marginals_against_all_taggings(seed):
    rng = np.random.default_rng(seed)
    sizes = np.array([3, 1, 0, 5])
    rows = rng.integers(0, 3, int(sizes.sum()))
    crf = toxicity.Crf({}, rng.normal(size=3), rng.normal(size=4), float(rng.normal()), np.zeros(4))
    got, at, want = toxicity.marginals(rows, sizes, crf), 0, []
    for size in sizes:
        mass = np.zeros((size, 2))
        for code in range(1 << size):
            tags = [(code >> t) & 1 for t in range(size)]
            energy = sum(crf.emit[rows[at + t]] for t in range(size) if tags[t])
            energy += sum(crf.moves[2 * a + b] for a, b in zip(tags, tags[1:])) + (crf.start if size and tags[0] else 0)
            for t in range(size):
                mass[t, tags[t]] += np.exp(energy)
        want += (mass[:, 1] / mass.sum(axis=1)).tolist() if size else []
        at += size
    assert np.allclose(got, want)


def test_scan_in_blocks_is_the_plain_recursion():
    rng = np.random.default_rng(1)
    n0, n1, d0, d1 = rng.uniform(0.1, 2, (4, 5000))
    r, want = 1.0, []
    for i in range(5000):
        r = (n0[i] + n1[i] * r) / (d0[i] + d1[i] * r)
        want.append(r)
    assert np.allclose(toxicity.scan(n0, n1, d0, d1), want)


def test_toxic_spans(planted):
    train, test = planted.where("doc_id % 5 <> 0"), planted.where("doc_id % 5 = 0")
    crf = toxicity.train_crf(train, train.select("doc_id", "label"))
    assert set(crf.words) == {"vile", "nasty"}
    rows = {r["doc_id"]: r for r in toxicity.score_toxicity(test, crf).collect()}
    for r in test.collect():
        got = rows[r["doc_id"]]
        assert (got["score"] >= 0.5) == bool(r["label"])
        cut = [r["text"][s["start"] : s["end"]] for s in got["spans"]]
        assert bool(cut) == bool(r["label"]) and all(w.strip("!,").lower() in ("vile", "nasty") for c in cut for w in c.split())


def test_offsets_are_code_points():
    text = "é日本 bad worse 😀 bad".encode()
    flags = np.array([False, True, True, False, True])
    assert toxicity.token_offsets(text, flags) == [{"start": 4, "end": 13}, {"start": 16, "end": 19}]


def test_language_backoff(spark):
    de = ["der Hund schläft und die Katze wartet", "das Haus steht auf dem Hügel"] * 5
    en = ["the dog sleeps and the cat waits", "the house stands on the hill"] * 5
    rows = [(i, t, "de") for i, t in enumerate(de)] + [(100 + i, t, "en") for i, t in enumerate(en)]
    model = langid.train_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    seen, words = langid.WordRows(model), ["hund", "schlafende", "sleeping", "qqq", "xüx"]
    seen.learn([" ".join(words).encode()])
    assert np.allclose(model.word_logp[model.words["hund"]], seen.rows[seen.ids[b"hund"]][:-1])
    for w in words[1:]:  # the longest length with a known gram, and no other
        for n in range(model.longest, 0, -1):
            found = [model.grams[g] for g in langid.word_grams(w, n) if g in model.grams]
            if found:
                break
        want = model.gram_logp[found].mean(axis=0) if found else np.zeros(2)
        assert np.allclose(seen.rows[seen.ids[w.encode()]][:-1], want, atol=1e-5)
    test = spark.createDataFrame([(1, "die schlafenden Hunde"), (2, "sleeping dogs wait"), (3, "123 !!"), (4, None), (5, "")], "doc_id long, text string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify_languages(test, model).collect()}
    assert got[1][0] == "de" and got[2][0] == "en" and got[3] == got[4] == got[5] == ("und", 0.0)
    assert 0.5 <= got[1][1] <= 1.0


def test_odd_rows(odd, empty, odd_texts):
    labels = odd.where("doc_id in (5, 7, 8, 16)").selectExpr("doc_id", "cast(doc_id % 2 as int) as label")
    for out in (quality.classify_quality(odd, labels), toxicity.score_toxicity(odd, toxicity.train_crf(odd, labels))):
        rows = out.collect()
        assert len(rows) == len(odd_texts) and all(0 <= r["score"] <= 1 for r in rows)
        assert len({r["score"] for r in rows if r["doc_id"] in (1, 2, 3)}) == 1
    assert len(langid.identify_languages(odd, langid.train_languages(odd)).collect()) == len(odd_texts)
    # Nothing to learn from, nothing to score.
    none = empty.selectExpr("doc_id", "cast(n as int) as label")
    assert {r["score"] for r in quality.classify_quality(odd, none).collect()} == {0.5}
    assert {r["score"] for r in toxicity.score_toxicity(odd, toxicity.train_crf(odd, none)).collect()} == {0.5}
    assert {r["lang_pred"] for r in langid.identify_languages(odd, langid.train_languages(empty)).collect()} == {"und"}
    assert quality.classify_quality(empty, labels).collect() == []
