import math
from collections import Counter

import numpy as np

from lexgraph.llm import lm
from lexgraph.llm.lm import TreeParams


def kt(a, b):
    return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)


class PlainTree:
    """Context-tree weighting written out node by node, for a few short texts."""

    def __init__(self, train: list[bytes], depth: int, share: int) -> None:
        self.depth, self.counts = depth, {}
        for body in train:
            stream = b"\n" * depth + b" ".join(lm.tokens_of(body)) + b"\n"
            for at in range(depth, len(stream)):
                for d in range(depth + 1):
                    self.counts.setdefault(stream[at - d : at], Counter())[stream[at]] += 1
        total = sum(self.counts.get(b"", Counter()).values())
        self.nodes = {c for c, n in self.counts.items() if sum(n.values()) * share >= total} | {b""}

    def bits(self, counts, prefix, size):
        """Decisions 0 and 1 after the first ``size`` bits of a byte."""
        here = [(x, n) for x, n in counts.items() if x >> (8 - size) == prefix]
        ones = sum(n for x, n in here if x >> (7 - size) & 1)
        return sum(n for _, n in here) - ones, ones

    def children(self, context):
        return [c for c in self.nodes if len(c) == len(context) + 1 and c[1:] == context] if len(context) < self.depth else []

    def weighted(self, context, prefix, size):
        """(log own, log split or None, rest decisions)."""
        a, b = self.bits(self.counts.get(context, {}), prefix, size)
        kids = self.children(context)
        if not kids:
            return kt(a, b), None, (a, b)
        below, rest = 0.0, [a, b]
        for k in kids:
            own, split, _ = self.weighted(k, prefix, size)
            below += own if split is None else np.logaddexp(own, split) + math.log(0.5)
            x, y = self.bits(self.counts[k], prefix, size)
            rest = [rest[0] - x, rest[1] - y]
        return kt(a, b), below + kt(*rest), tuple(rest)

    def one(self, history, prefix, size):
        """Probability that the next decision is 1."""
        context, carry, out = b"", 1.0, 0.0
        while True:
            own, split, rest = self.weighted(context, prefix, size)
            a, b = self.bits(self.counts.get(context, {}), prefix, size)
            stop = 1.0 if split is None else 1 / (1 + math.exp(split - own))
            out += carry * stop * (b + 0.5) / (a + b + 1)
            carry *= 1 - stop
            longer = history[len(history) - len(context) - 1 :]
            if split is None or longer not in self.nodes:
                return out + carry * (rest[1] + 0.5) / (rest[0] + rest[1] + 1)
            context = longer

    def score(self, body):
        stream, total = b"\n" * self.depth + b" ".join(lm.tokens_of(body)) + b"\n", 0.0
        for at in range(self.depth, len(stream)):
            for size in range(8):
                p = self.one(stream[at - self.depth : at], stream[at] >> (8 - size), size)
                total += math.log10(p if stream[at] >> (7 - size) & 1 else 1 - p)
        return total


TRAIN = ["abra cadabra", "abracad abra", "", None, "Cab é"]


def test_probabilities_of_a_byte_sum_to_one(spark):
    """Of all texts of one byte after the same history."""
    learn = spark.createDataFrame([(t or "",) for t in TRAIN], "text string")
    docs = spark.createDataFrame([(i, bytes([i])) for i in range(1, 128) if i not in b" \t\n\v\f\r"], "doc_id long, text binary").selectExpr("doc_id", "cast(text as string) text")
    one = {r["doc_id"]: r for r in lm.score_texts(docs, learn, TreeParams(depth=1)).collect()}
    plain = PlainTree([(t or "").encode() for t in TRAIN], 1, 10**9)
    assert np.allclose([one[i]["score"] for i in one], [plain.score(bytes([i])) for i in one], atol=1e-4)


def test_packed_numbers():
    rng = np.random.default_rng(0)
    for numbers in (np.zeros(0, np.int64), np.array([5]), np.sort(rng.integers(0, 1 << 56, 1000)), rng.integers(1, 9, 50)):
        assert (lm.unpacked(lm.packed_numbers(numbers)) == numbers).all()


def test_one_context_with_half_of_all_grams(spark):
    """Asks to a common context are dealt by blocks; the scores stay those of the plain tree."""
    train = ["ab" * 40 + f" x{i}" for i in range(12)]
    learn = spark.createDataFrame([(t,) for t in train], "text string")
    texts = ["ab" * (5 + i) + f"c{i}" for i in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    plain = PlainTree([t.encode() for t in train], 3, 10**9)
    rows = lm.score_texts(docs, learn, TreeParams(depth=3, block=16, asking=3)).collect()
    assert np.allclose([r["score"] for r in sorted(rows)], [plain.score(texts[r["doc_id"]].encode()) for r in sorted(rows)], atol=1e-4)


def test_tree_beats_the_words_on_held_out_texts(spark):
    """Held-out texts of known phrases: the tree sees what came before a byte, the base only single words."""
    import random

    rng = random.Random(2)
    word = lambda: "".join(rng.choice("aeioukrstmnlpd") for _ in range(rng.randrange(3, 8)))
    phrases = [" ".join(word() for _ in range(4)) for _ in range(12)]
    rows = [(i, " ".join(rng.choice(phrases) for _ in range(15))) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = lm.score_texts(docs, docs.where("doc_id % 4 <> 0")).where("doc_id % 4 = 0").collect()
    assert sum(r["score"] for r in got) > 0.8 * sum(r["base_score"] for r in got)


def test_base_scores_and_odd_rows(spark, odd, odd_texts):
    learn = odd.where("doc_id is null or doc_id <> 8")
    for frequent in (1 << 19, 3):  # nearly all counts sent to the tasks, and nearly all joined
        rows = lm.score_texts(odd, learn, TreeParams(frequent=frequent)).collect()
        counts = Counter()
        for i, t in odd_texts:
            if i != 8:
                counts.update([*lm.tokens_of((t or "").encode()), lm.END])
        n, v = sum(counts.values()), len(counts)
        want = []
        for i, t in odd_texts:
            tokens = [*lm.tokens_of((t or "").encode()), lm.END]
            base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens)
            want.append((str(i), len(tokens), sum(counts[w] > 0 for w in tokens), n, round(base, 3)))
        got = [(str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 3)) for r in rows]
        assert sorted(got) == sorted(want)
        assert len({r["score"] for r in rows if r["doc_id"] in (1, 2, 3)}) == 1


def test_nothing_to_learn_from(odd, empty):
    rows = lm.score_texts(odd.where("doc_id = 4"), empty).collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in rows] == [(2, 0, 0, 0.0)]
    assert abs(rows[0]["score"] - 4 * math.log10(1 / 256)) < 1e-4 and abs(rows[0]["bits_per_byte"] - 8) < 1e-4
    assert lm.score_texts(empty, odd).collect() == []


def test_whole_tree_is_scored(spark):
    """No context is left out for being rare: the scores are those of the plain tree with every context as a node."""
    train = [(t or "",) for t in TRAIN]
    learn = spark.createDataFrame(train, "text string")
    texts = ["abra cab", "", "zé", "A  b", "cadabra abra", "quite new"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for depth in (1, 2, 3, 5):
        plain = PlainTree([t.encode() for t, in train], depth, 10**9)
        for block in (32 << 20, 4):
            rows = lm.score_texts(docs, learn, TreeParams(depth=depth, block=block)).collect()
            got = {r["doc_id"]: r["score"] for r in rows}
            assert np.allclose([got[i] for i in range(len(texts))], [plain.score(t.encode()) for t in texts], atol=1e-4)


def test_rare_contexts_keep_their_counts(spark):
    """Unrelated text must not take the contexts of a small source out of the tree."""
    docs = spark.createDataFrame([(1, "qzj xvk wqz")], "doc_id long, text string")
    score = lambda rows: lm.score_texts(docs, spark.createDataFrame(rows, "text string"), TreeParams()).first()["score"]
    rare = [("qzj xvk wqz",)] * 20
    assert abs(score(rare + [("0123456789" * 40,)] * 200) - score(rare)) < 4


def test_scores_of_more_texts_than_are_sorted_together():
    """Texts are sorted 256 at a time; each gets the sum over its own bytes, repeated and empty texts too."""
    rng = np.random.default_rng(3)
    bodies = [bytes(rng.integers(0, 256, int(n), dtype=np.uint8)) for n in rng.integers(0, 40, 600)] + [b"", b"a b"] * 50
    data, places, begins = lm.laid_out(bodies, 6)
    grams = lm.packed(data, places, 6)
    known = lm.distinct_of(grams)
    logp = rng.random(len(known)).astype(np.float32)
    each = np.split(logp[np.searchsorted(known, grams)].astype(float), begins[1:])
    score, size = lm.asked_scores(bodies, known, logp, 6)
    assert np.allclose(score, [x.sum() for x in each]) and size.tolist() == [len(x) for x in each]


def test_packed_holds_a_byte_and_its_context():
    data = np.array([255, 254, 253, 252, 251, 250, 249, 248], np.uint8)
    for depth in range(7):
        want = sum(int(data[7 - d]) << (8 * d) for d in range(depth + 1))
        assert lm.packed(data, np.array([7]), depth).tolist() == [want]
