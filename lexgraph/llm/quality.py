"""Quality classifier: logistic regression over hashed word n-grams, trained with FTRL-proximal updates."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexgraph.llm.common import arrow_pass, bounded_sample, by_value, column, text_rows, texts

by_value(__name__)


class Ftrl(NamedTuple):
    """Parameters of the training. ``sample`` bounds the labelled rows that are used.

    A task trains on about ``shard`` of them: the number of tasks comes from the rows, not from the
    cluster, so that the model does not depend on its size.
    """

    bits: int = 20
    orders: tuple[int, ...] = (1, 2)
    alpha: float = 6.0
    beta: float = 1.0
    l1: float = 0.0005
    l2: float = 0.0
    epochs: int = 3
    shard: int = 6_000
    sample: int = 24_000


def features(text: bytes, p: Ftrl) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the text's word n-grams (bucket 0: bias) and their weights, of length 1 without the bias.

    A word that repeats the one before it also counts as a gram of its own, whatever the word is.
    """
    words = text.split()
    h = np.fromiter(map(crc32, words), np.uint64, len(words))
    parts = [np.ones(int((h[1:] == h[:-1]).sum()), np.uint64)]
    for n in p.orders:
        size = len(h) - n + 1
        if size <= 0:
            continue
        g = h[:size].copy()
        for i in range(1, n):
            g = g * np.uint64(0x100000001B3) + h[i : i + size]
        parts.append((g + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - p.bits))
    if not words:
        return np.zeros(1, np.int64), np.ones(1)
    idx, count = np.unique(np.concatenate(parts), return_counts=True)
    x = count / np.sqrt(np.square(count).sum())
    return np.concatenate([[0], idx.astype(np.int64)]), np.concatenate([[1.0], x])


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], p: Ftrl) -> np.ndarray:
    """Weights after ``epochs`` passes over the rows, in their order."""
    z, n = np.zeros(1 << p.bits), np.zeros(1 << p.bits)

    def weights(zi, ni):
        return np.where(np.abs(zi) <= p.l1, 0.0, (np.sign(zi) * p.l1 - zi) / ((p.beta + np.sqrt(ni)) / p.alpha + p.l2))

    for _ in range(p.epochs):
        for idx, x, label in rows:
            zi, ni = z[idx], n[idx]
            w = weights(zi, ni)
            g = (sigmoid(w @ x) - label) * x
            grown = ni + g * g
            z[idx] = zi + g - (np.sqrt(grown) - np.sqrt(ni)) / p.alpha * w
            n[idx] = grown
    return weights(z, n)


def train_quality(docs: DataFrame, labels: DataFrame, p: Ftrl = Ftrl()) -> np.ndarray:
    """Weights of the 2**bits buckets from docs [doc_id, text] and labels [doc_id, label].

    Rows without a label are left out; of several labels of a document the largest counts. At most
    about ``p.sample`` labelled documents are used, dealt to tasks by their id; the weights of the
    tasks are averaged, those that a task has not seen as 0. Without any label the
    weights are 0 and every score 0.5.
    """
    known = labels.where(F.col("label").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = bounded_sample(known, "doc_id", p.sample)
    shards = max(1, -(-min(chosen.count(), p.sample) // p.shard))
    rows = text_rows(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "doc_id", "label")
    sharded = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int"))

    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending")])
        # A fixed shuffle of the order of ids, so that neighbours are not alike.
        order = np.random.default_rng(7).permutation(table.num_rows)
        body, label = table.column("text").to_pylist(), table.column("label").to_pylist()
        w = ftrl([(*features(body[i], p), label[i]) for i in order], p)
        idx = np.flatnonzero(w)
        return pa.table({"bucket": idx, "w": w[idx]})

    mean = (
        sharded.groupBy("shard").applyInArrow(fit, "bucket long, w double").groupBy("bucket")
        .agg((F.sum("w") / shards).alias("w"))
    )
    weights = np.zeros(1 << p.bits, np.float32)
    got = mean.toArrow()  # at most 2**bits rows
    weights[got.column("bucket").to_numpy()] = got.column("w").to_numpy()
    return weights


def score_quality(docs: DataFrame, weights: np.ndarray, p: Ftrl = Ftrl()) -> DataFrame:
    """[doc_id, score] for every row: the sigmoid of the sparse dot product. Empty texts have the bias only."""
    model = docs.sparkSession.sparkContext.broadcast(weights)

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        w = model.value
        out = np.empty(batch.num_rows)
        for i, text in enumerate(texts(batch)):
            idx, x = features(text, p)
            out[i] = w[idx] @ x
        return pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(sigmoid(out))], ["doc_id", "score"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return arrow_pass(text_rows(docs, "doc_id"), score, f"doc_id {id_type}, score double")


def classify_quality(docs: DataFrame, labels: DataFrame, p: Ftrl = Ftrl()) -> DataFrame:
    """[doc_id, score, predicted]: trained on the labelled rows, applied to every row of ``docs``."""
    scored = score_quality(docs, train_quality(docs, labels, p), p)
    return scored.select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
