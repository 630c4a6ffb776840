"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Two states, O and T. Labelled tokens come from labelled documents: a token is T if its document is
toxic and its word is far more frequent in toxic documents than in others. The field has one weight
for each such word, one for all other words, and the transitions. Forward-backward marginals give the
spans; their sum and maximum give the document's score through a logistic calibration.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexgraph.llm.common import arrow_pass, bounded_sample, by_value, column, runs, shared, text_rows, texts

by_value(__name__)


class CrfParams(NamedTuple):
    """``sample`` bounds the labelled documents; a toxic word needs ``min_docs`` toxic contexts and a ``z`` of excess."""

    sample: int = 12_000
    shards: int = 8
    min_docs: int = 4
    z: float = 6.0
    steps: int = 25
    rate: float = 0.4
    l2: float = 0.02


class Crf(NamedTuple):
    """Weights relative to state O. ``words``: weight row of each toxic word; row 0 is every other word.

    ``moves`` are the log potentials OO, OT, TO, TT; ``start`` that of T at the first token;
    ``doc`` the calibration over ``doc_features``.
    """

    words: dict[str, int]
    emit: np.ndarray
    moves: np.ndarray
    start: float
    doc: np.ndarray


def plain(word: bytes) -> str:
    """A word in lower case without the marks around it."""
    return word.decode("utf-8", "replace").lower().strip(" .,;:!?\"'()[]{}<>*#$%&|-_")


class PlainRows(dict):
    """Raw word -> weight row, remembered up to a limit."""

    LIMIT = 120_000

    def __init__(self, words: dict[str, int]) -> None:
        super().__init__()
        self.words = words

    def __missing__(self, raw: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        row = self[raw] = self.words.get(plain(raw), 0)
        return row


def scan(n0: np.ndarray, n1: np.ndarray, d0: np.ndarray, d1: np.ndarray) -> np.ndarray:
    """r[t] = (n0[t] + n1[t] * r[t-1]) / (d0[t] + d1[t] * r[t-1]), from r[-1] = 1.

    Blocks are walked side by side: first the product of each block's 2x2 matrices, then the values
    at the block borders one after the other, then all blocks from their own first value. The walk
    is as long as a block, however long a text is.
    """
    size = len(n0)
    length = max(1, int(np.sqrt(size / 8)))
    count = -(-size // length)
    lanes = []
    for x, rest in ((n0, 0.0), (n1, 1.0), (d0, 1.0), (d1, 0.0)):
        lane = np.full(count * length, rest)
        lane[:size] = x
        lanes.append(np.ascontiguousarray(lane.reshape(count, length).T))
    n0, n1, d0, d1 = lanes
    a, b, c, d = (np.full(count, x) for x in (1.0, 0.0, 0.0, 1.0))  # r -> (b + a r) / (d + c r)
    for t in range(length):
        a, b, c, d = n1[t] * a + n0[t] * c, n1[t] * b + n0[t] * d, d1[t] * a + d0[t] * c, d1[t] * b + d0[t] * d
        scale = 1.0 / (c + d)
        a, b, c, d = a * scale, b * scale, c * scale, d * scale
    first = np.empty(count)
    r = 1.0
    for i, (ai, bi, ci, di) in enumerate(zip(a.tolist(), b.tolist(), c.tolist(), d.tolist())):
        first[i] = r
        r = (bi + ai * r) / (di + ci * r)
    out = np.empty((length, count))
    r = first
    for t in range(length):
        r = out[t] = (n0[t] + n1[t] * r) / (d0[t] + d1[t] * r)
    return out.T.reshape(-1)[:size]


def forward_backward(emit: np.ndarray, first: np.ndarray, moves: np.ndarray, start: float):
    """Ratios T:O of the forward and the backward messages. ``emit`` >= 0 are potentials of T; ``first`` marks first tokens."""
    oo, ot, to, tt = np.exp(moves)
    s = np.exp(start)
    forth = scan(
        emit * np.where(first, s, ot), emit * np.where(first, s, tt), np.where(first, 1.0, oo), np.where(first, 1.0, to)
    )
    # Backward: what the next token says; the last token of a document hears nothing.
    last, ahead = np.append(first[1:], True), np.append(emit[1:], 1.0)
    back = scan(
        *(x[::-1] for x in (
            np.where(last, 1.0, to), np.where(last, 1.0, tt * ahead), np.where(last, 1.0, oo), np.where(last, 1.0, ot * ahead)
        ))
    )[::-1]
    return forth, back


def first_tokens(sizes: np.ndarray) -> np.ndarray:
    """Marks of the first token of each document, for documents of these sizes laid end to end."""
    first = np.zeros(int(sizes.sum()), bool)
    begins = np.cumsum(sizes) - sizes
    first[begins[sizes > 0]] = True
    return first


def marginals(rows: np.ndarray, sizes: np.ndarray, crf: Crf) -> np.ndarray:
    """Probability of T for each token."""
    if not len(rows):
        return np.zeros(0)
    forth, back = forward_backward(np.exp(crf.emit)[rows], first_tokens(sizes), crf.moves, crf.start)
    odds = forth * back
    return odds / (1.0 + odds)


def doc_features(p: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """[bias, expected toxic tokens (log), largest marginal, expected share] of each document; no tokens: the bias only."""
    out = np.zeros((len(sizes), 4))
    out[:, 0] = 1.0
    full = sizes > 0
    if full.any():
        begins = (np.cumsum(sizes) - sizes)[full]
        total = np.add.reduceat(p, begins)
        out[full, 1] = np.log1p(total)
        out[full, 2] = np.maximum.reduceat(p, begins)
        out[full, 3] = total / sizes[full]
    return out


def fit_crf(rows: np.ndarray, tags: np.ndarray, sizes: np.ndarray, width: int, p: CrfParams):
    """(emit, moves, start) by gradient steps (Adam) on the mean log-likelihood of the tagged documents."""
    first = first_tokens(sizes)
    theta = np.zeros(width + 5)
    theta[0] = -2.0
    inner = ~first
    tag_before = np.append(0, tags[:-1])
    seen = np.concatenate([
        np.bincount(rows, weights=tags, minlength=width),
        np.bincount(2 * tag_before[inner] + tags[inner], minlength=4), [tags[first].sum()],
    ])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    scale = np.maximum(1.0, np.concatenate([np.bincount(rows, minlength=width), [inner.sum()] * 4, [first.sum()]]))
    for step in range(1, p.steps + 1):
        emit, moves, start = np.exp(theta[:width])[rows], theta[width : width + 4], theta[width + 4]
        forth, back = forward_backward(emit, first, moves, start)
        odds = forth * back
        prob = odds / (1.0 + odds)
        oo, ot, to, tt = np.exp(moves)
        r = np.append(1.0, forth[:-1])[inner]
        ahead = (emit * back)[inner]
        pairs = np.stack([np.full_like(r, oo), ot * ahead, to * r, tt * r * ahead])
        pairs = (pairs / pairs.sum(axis=0)).sum(axis=1)
        expected = np.concatenate([np.bincount(rows, weights=prob, minlength=width), pairs, [prob[first].sum()]])
        g = (seen - expected) / scale - p.l2 * theta / np.sqrt(scale)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta = theta + p.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return theta[:width], theta[width : width + 4], theta[width + 4]


def fit_calibration(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression with a small ridge, by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(12):
        q = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (q * (1 - q))[:, None]).T @ x + 0.1 * np.eye(len(w))
        w = w + np.linalg.solve(h, x.T @ (y - q) - 0.1 * w)
    return w


def toxic_words(rows: DataFrame, p: CrfParams) -> list[str]:
    """Words far more frequent in toxic documents; rows [text bytes, label]. Bounded by the sample of rows.

    A word counts once for each document; of toxic documents, those where it first stands between the same neighbours
    count as one, so that the own words of one toxic text do not become toxic words by being copied.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in runs(batch):
                clean: Counter = Counter()
                toxic: set[tuple[str, int]] = set()
                for label, text in zip(column(run, "label").to_pylist(), texts(run)):
                    words = [plain(w) for w in text.split()]
                    if label:
                        # Backwards, so that a word's first place in the document stays.
                        around = zip(reversed(words), reversed(["", *words[:-1]]), reversed([*words[1:], ""]))
                        first = {w: crc32(f"{before} {after}".encode()) for w, before, after in around if w}
                        toxic.update(first.items())
                    else:
                        clean.update({w for w in words if w})
                found = sorted(toxic)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([*clean, *(w for w, _ in found)], pa.string()), pa.array([*clean.values(), *(0 for _ in found)], pa.int64()),
                     pa.array([*(None for _ in clean), *(c for _, c in found)], pa.int64())], ["word", "clean", "context"],
                )

    share = rows.agg(F.avg("label")).first()[0] or 0.0
    counted = rows.select("label", "text").mapInArrow(count, "word string, clean long, context long")
    n_toxic, n = F.col("toxic"), F.col("toxic") + F.col("clean")
    found = (
        counted.groupBy("word", "context").agg(F.sum("clean").alias("clean"))
        .groupBy("word").agg(F.count("context").alias("toxic"), F.sum("clean").alias("clean"))
        .where((n_toxic >= p.min_docs) & (n_toxic - n * share >= p.z * F.sqrt(n * share)))
    )
    return sorted(r[0] for r in found.select("word").collect())


def train_crf(docs: DataFrame, labels: DataFrame, p: CrfParams = CrfParams()) -> Crf:
    """The field and its calibration from docs [doc_id, text] and labels [doc_id, label 0 or 1].

    At most about ``p.sample`` labelled documents are used; they are dealt by id to a fixed number of
    tasks whose fits are averaged. Without labels every weight is 0 and every score 0.5; without
    toxic words or toxic documents the score is the share of toxic labels.
    """
    known = labels.where(F.col("label").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    chosen = bounded_sample(known, "doc_id", p.sample)
    rows = text_rows(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "doc_id", "label")
    names = toxic_words(rows, p)
    words = {w: i + 1 for i, w in enumerate(names)}
    width = len(words) + 1

    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        row_of = PlainRows(words)
        label = np.array(table.column("label").to_pylist(), np.int64)
        found = [np.fromiter(map(row_of.__getitem__, t.split()), np.int64) for t in table.column("text").to_pylist()]
        sizes = np.array([len(x) for x in found], np.int64)
        tokens = np.concatenate(found)
        tags = ((tokens > 0) & (np.repeat(label, sizes) > 0)).astype(np.int64)
        if len(tokens):
            emit, moves, start = fit_crf(tokens, tags, sizes, width, p)
        else:
            emit, moves, start = np.zeros(width), np.zeros(4), 0.0
        prob = marginals(tokens, sizes, Crf(words, emit, moves, start, np.zeros(4)))
        doc = fit_calibration(doc_features(prob, sizes), label)
        return pa.table({"theta": [np.concatenate([emit, moves, [start], doc]).tolist()], "docs": [len(sizes)]})

    sharded = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(p.shards)).cast("int"))
    fits = sharded.groupBy("shard").applyInArrow(fit, "theta array<double>, docs long").collect()  # one row of each shard
    if not fits:
        return Crf(words, np.zeros(width), np.zeros(4), 0.0, np.zeros(4))
    fits = sorted(fits, key=lambda r: (r["docs"], r["theta"]))
    theta = np.average([r["theta"] for r in fits], axis=0, weights=[r["docs"] for r in fits])
    return Crf(words, theta[:width], theta[width : width + 4], float(theta[width + 4]), theta[width + 5 :])


def token_offsets(text: bytes, flags: np.ndarray) -> list[dict]:
    """Runs of flagged words as code point offsets {start, end} of the text."""
    import re

    out: list[dict] = []
    for i, found in enumerate(re.finditer(rb"[^\x20\x09-\x0D]+", text)):
        if not flags[i]:
            continue
        if out and out[-1]["word"] == i - 1:
            out[-1] |= {"end": found.end(), "word": i}
        else:
            out.append({"start": found.start(), "end": found.end(), "word": i})
    places = sorted({x[k] for x in out for k in ("start", "end")})
    chars, done, at = {}, 0, 0
    for place in places:  # one pass over the text
        at += len(text[done:place].decode("utf-8", "replace"))
        chars[place] = at
        done = place
    return [{"start": chars[x["start"]], "end": chars[x["end"]]} for x in out]


def score_toxicity(docs: DataFrame, crf: Crf) -> DataFrame:
    """[doc_id, score, spans array<struct<start, end>>] for every row.

    Spans are the runs of words with a marginal of at least 0.5. Texts without words have no span and
    the score of the calibration's bias.
    """
    sent = shared(docs.sparkSession, crf)
    state: dict[str, PlainRows] = {}

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        m = sent()
        if not state:
            state["rows"] = PlainRows(m.words)
        body = texts(batch)
        row_of = state["rows"].__getitem__
        found = [np.fromiter(map(row_of, t.split()), np.int32) for t in body]
        sizes = np.array([len(x) for x in found], np.int64)
        prob = marginals(np.concatenate(found) if found else np.zeros(0, np.int32), sizes, m)
        score = 1.0 / (1.0 + np.exp(-np.clip(doc_features(prob, sizes) @ m.doc, -30, 30)))
        ends = np.cumsum(sizes)
        spans = []
        for text, end, size in zip(body, ends, sizes):
            flags = prob[end - size : end] >= 0.5
            spans.append(token_offsets(text, flags) if flags.any() else [])
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        return pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(score), pa.array(spans, kind)], ["doc_id", "score", "spans"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return arrow_pass(text_rows(docs, "doc_id"), work, f"doc_id {id_type}, score double, spans array<struct<start:int,end:int>>")
