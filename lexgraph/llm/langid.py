"""Language identification, words first: known words by their frequency in each language, unseen words by character n-grams.

An unseen word is scored by its longest n-grams that were seen in training; only if it has none of a
length are shorter ones asked.
"""

from __future__ import annotations

import gc
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexgraph.llm.common import arrow_pass, bounded_sample, by_value, column, grams, runs, shared, text_rows, texts

by_value(__name__)

UNKNOWN = "und"


class LangParams(NamedTuple):
    """``sample`` bounds the documents learned from; ``longest`` is the longest n-gram."""

    sample: int = 6_000
    longest: int = 5
    smooth: float = 0.5


class LangModel(NamedTuple):
    """Rows of ``word_logp`` and ``gram_logp`` are vectors over ``langs``; ``prior`` too."""

    langs: list[str]
    prior: np.ndarray
    words: dict[str, int]
    word_logp: np.ndarray
    grams: dict[str, int]
    gram_logp: np.ndarray
    longest: int


def letter_runs():
    """A function from a raw word to its runs of letters, lower-cased."""
    import re

    found = re.compile(r"[^\W\d_]+").findall

    def split(raw: bytes) -> list[str]:
        word = raw.decode("utf-8", "replace").lower()
        return [word] if word.isalpha() else found(word)

    return split


def word_grams(word: str, n: int) -> list[str]:
    """n-grams of the word between its marks; single letters come without the marks."""
    marked = word if n == 1 else f"<{word}>"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


def count_words(docs: DataFrame) -> DataFrame:
    """[lang, word, n] of the letter runs; counted in each task before anything moves."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = letter_runs()
        for batch in batches:
            for run in runs(batch):
                raw: Counter = Counter()
                for lang, text in zip(column(run, "lang").to_pylist(), texts(run)):
                    raw.update((lang, w) for w in text.split())
                total: Counter = Counter()
                for (lang, w), n in raw.items():
                    for word in split(w):
                        total[lang, word] += n
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[0] for k in total], pa.string()), pa.array([k[1] for k in total], pa.string()),
                     pa.array(list(total.values()), pa.int64())], ["lang", "word", "n"],
                )

    counted = text_rows(docs, "lang").mapInArrow(count, "lang string, word string, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def train_languages(docs: DataFrame, p: LangParams = LangParams()) -> LangModel:
    """Model from docs [doc_id, text, lang]; rows with a null lang or id are left out.

    At most about ``p.sample`` documents are used, so the tables that come to the driver are bounded.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "text", "lang")
    rows = count_words(bounded_sample(known, "doc_id", p.sample)).toArrow().sort_by([("lang", "ascending"), ("word", "ascending")])
    langs = sorted(set(rows.column("lang").to_pylist()))
    at = {lang: i for i, lang in enumerate(langs)}
    lang = [at[x] for x in rows.column("lang").to_pylist()]
    word, n = rows.column("word").to_pylist(), rows.column("n").to_numpy()

    def table(keys: list[str], which: list[int], counts: np.ndarray) -> tuple[dict[str, int], np.ndarray]:
        ids: dict[str, int] = {}
        rows_of = np.fromiter((ids.setdefault(k, len(ids)) for k in keys), np.int64, len(keys))
        c = np.zeros((len(ids), len(langs)))
        np.add.at(c, (rows_of, np.array(which, np.int64)), counts)
        return ids, np.log((c + p.smooth) / (c.sum(axis=0) + p.smooth * max(1, len(ids)))).astype(np.float32)

    words, word_logp = table(word, lang, n)
    grams: dict[str, int] = {}
    parts = [np.zeros((0, len(langs)), np.float32)]
    for size in range(1, p.longest + 1):
        each: Counter = Counter()
        for w, which, count in zip(word, lang, n):
            for g in word_grams(w, size):
                each[g, which] += count
        ids, logp = table([k[0] for k in each], [k[1] for k in each], np.array(list(each.values())))
        # Single letters stand without marks and longer grams have another length: no key occurs twice.
        grams.update({g: len(grams) + i for g, i in zip(ids, range(len(ids)))})
        parts.append(logp)
    mass = np.bincount(np.array(lang, np.int64), weights=n, minlength=len(langs)) if langs else np.zeros(0)
    prior = np.log((mass + 1) / (mass.sum() + len(langs))) if langs else np.zeros(0)
    return LangModel(langs, prior, words, word_logp, grams, np.concatenate(parts), p.longest)


class GramTable(NamedTuple):
    """n-grams of one length as sorted hashes, with their rows."""

    key: np.ndarray
    row: np.ndarray


def code_points(words: list[str]) -> np.ndarray:
    """The words laid end to end."""
    return np.frombuffer("".join(words).encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)


def gram_tables(model: LangModel) -> dict[int, GramTable]:
    tables = {}
    for n in range(1, model.longest + 1):
        mine = [(g, i) for g, i in model.grams.items() if len(g) == n]
        if mine:
            key = grams(code_points([g for g, _ in mine]), n)[::n]
            order = np.argsort(key)
            tables[n] = GramTable(key[order], np.array([i for _, i in mine])[order])
    return tables


class WordRows:
    """Raw word -> row of a matrix: its log frequencies by language and, last, its letter runs."""

    LIMIT = 200_000

    def __init__(self, model: LangModel) -> None:
        self.m, self.split, self.tables = model, letter_runs(), gram_tables(model)
        self.clear()

    def clear(self) -> None:
        self.ids: dict[bytes, int] = {}
        self.rows = np.zeros((0, len(self.m.langs) + 1), np.float32)

    def backoff(self, words: list[str]) -> np.ndarray:
        """Of each word the mean over its longest known n-grams; 0 if it has none."""
        out = np.zeros((len(words), len(self.m.langs)), np.float32)
        open_words = np.arange(len(words))
        for n in range(self.m.longest, 0, -1):
            if n not in self.tables or not len(open_words):
                continue
            marked = [words[i] if n == 1 else f"<{words[i]}>" for i in open_words.tolist()]
            sizes = np.fromiter(map(len, marked), np.int64, len(marked))
            owner = np.repeat(np.arange(len(marked)), sizes)
            key = grams(code_points(marked), n)
            # A gram must not reach into the next word.
            inside = owner[: len(key)] == owner[n - 1 :][: len(key)]
            key, owner = key[inside], owner[: len(key)][inside]
            table = self.tables[n]
            at = np.minimum(np.searchsorted(table.key, key), len(table.key) - 1)
            hit = table.key[at] == key
            owner, row = owner[hit], table.row[at[hit]]
            if not len(owner):
                continue
            begins = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            total = np.add.reduceat(self.m.gram_logp[row], begins, axis=0)
            count = np.diff(np.append(begins, len(owner)))
            out[open_words[owner[begins]]] = total / count[:, None]
            left = np.ones(len(open_words), bool)
            left[owner[begins]] = False
            open_words = open_words[left]
        return out

    def learn(self, bodies: list[bytes]) -> None:
        """Rows for the words of the texts that have none yet."""
        wanted: set[bytes] = set()
        for body in bodies:
            wanted.update(body.split())
        if len(self.ids) + len(wanted) > self.LIMIT:
            self.clear()
        new = [w for w in wanted if w not in self.ids]
        gc.disable()  # many small objects, no cycles
        try:
            self.enter(new)
        finally:
            gc.enable()

    def enter(self, new: list[bytes]) -> None:
        parts = [self.split(w) for w in new]
        distinct = list({p for found in parts for p in found})
        vectors = np.zeros((len(distinct), len(self.m.langs)), np.float32)
        known = np.fromiter((self.m.words.get(p, -1) for p in distinct), np.int64, len(distinct))
        vectors[known >= 0] = self.m.word_logp[known[known >= 0]]
        unseen = np.flatnonzero(known < 0)
        vectors[unseen] = self.backoff([distinct[i] for i in unseen.tolist()])
        at = {p: i for i, p in enumerate(distinct)}
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        rows = np.zeros((len(new), self.rows.shape[1]), np.float32)
        rows[:, -1] = sizes
        if sizes.any():
            flat = np.fromiter((at[p] for found in parts for p in found), np.int64, int(sizes.sum()))
            begins = (np.cumsum(sizes) - sizes)[sizes > 0]
            rows[sizes > 0, :-1] = np.add.reduceat(vectors[flat], begins, axis=0)
        base = len(self.ids)
        self.ids.update((w, base + i) for i, w in enumerate(new))
        self.rows = np.concatenate([self.rows, rows])

    def sum(self, words: list[bytes]) -> np.ndarray:
        return self.rows[list(map(self.ids.__getitem__, words))].sum(axis=0, dtype=np.float64)


def identify_languages(docs: DataFrame, model: LangModel) -> DataFrame:
    """[doc_id, lang_pred, score] for every row.

    ``score`` is the posterior of the predicted language. Texts without a letter, null texts, and all
    texts if nothing was learned, are ``und`` with score 0. Ties go to the smaller language name.
    """
    sent = shared(docs.sparkSession, model)
    state: dict[str, WordRows] = {}

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        m = sent()
        if not state:
            state["rows"] = WordRows(m)
        preds, scores, bodies = [], [], texts(batch)
        state["rows"].learn(bodies)
        for text in bodies:
            words = text.split()
            total = state["rows"].sum(words) if words else np.zeros(len(m.langs) + 1)
            if not m.langs or not total[-1]:
                preds.append(UNKNOWN)
                scores.append(0.0)
                continue
            logit = total[:-1] + m.prior
            best = int(logit.argmax())
            preds.append(m.langs[best])
            scores.append(1.0 / np.exp(logit - logit[best]).sum())
        return pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(preds, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return arrow_pass(text_rows(docs, "doc_id"), work, f"doc_id {id_type}, lang_pred string, score double", 6 << 20)
