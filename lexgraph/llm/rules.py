"""Quality rules by distribution divergence, in DataFrame functions only.

A text's histogram of character classes and its histogram of common words are compared with those of each language by
Jensen-Shannon distance; the nearest language counts. The references are summed from the documents of each language: both
histograms where its common words are given, that of the character classes for any other language in the data.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexgraph.plans.lookup import lookup_join
from lexgraph.plans.stage import stage

# The most common function words of each language.
COMMON_WORDS = {
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als",
    "en": "the of and to in is that it was for on are as with by this be at or from",
    "es": "de la que el en y a los del se las por un para con no una su al lo",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au",
}

# Character classes, taken out of a text one after the other; what is left is the last class.
CLASSES = (r"\p{Ll}", r"\p{Lu}", r"[\x20\x09-\x0D]", r"[.,;:!?'\-]", r"\p{L}", r"\p{N}")

WORD_GAP = r"[\x20\x09-\x0D]+"


class RuleParams(NamedTuple):
    """A text of fewer than ``min_words`` words has too small a sample to be judged by its histograms."""

    window: int = 8
    min_words: int = 50
    max_class: float = 0.28
    max_words: float = 0.45


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, wherever the body uses it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, WORD_GAP), "")


def window_hashes(words: Column, n: int) -> Column:
    """A 64-bit hash of each window of ``n`` words; empty if there are fewer words."""
    starts = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - (n - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, n)))


def covered_words(hashes: Column, n: int) -> Column:
    """Words in windows whose hash occurs twice or more.

    Sorted with their places, equal windows stand side by side; the places are then walked in order.
    """
    placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def twice(pairs: Column) -> Column:
        size = F.size(pairs)
        same = F.filter(
            pairs,
            lambda e, k: ((k > 0) & (F.get(pairs, k - 1)["h"] == e["h"])) | ((k < size - 1) & (F.get(pairs, k + 1)["h"] == e["h"])),
        )
        return F.array_sort(F.transform(same, lambda e: e["i"]))

    start = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).alias("end"))
    step = lambda acc, i: F.struct(
        (acc["total"] + (i + n - F.greatest(i, acc["end"]))).cast("long").alias("total"), (i + n).alias("end")
    )
    return let(placed, lambda pairs: F.aggregate(twice(pairs), start, step, lambda acc: acc["total"]))


def vocabulary() -> list[str]:
    return sorted({w for words in COMMON_WORDS.values() for w in words.split()})


def class_counts(text: Column) -> Column:
    """Code points of each class, array<long>."""
    lengths, rest = [F.length(text)], text
    for kind in CLASSES:
        rest = F.regexp_replace(rest, f"{kind}+", "")
        lengths.append(F.length(rest))
    return F.array(*[(a - b).cast("long") for a, b in zip(lengths, [*lengths[1:], F.lit(0)])])


def common_counts(words: Column) -> Column:
    """How often each word of ``vocabulary()`` occurs in lower-cased words, array<long>."""
    known = F.filter(words, lambda w: w.isin(vocabulary()))
    return let(known, lambda k: F.array(*[(F.size(k) - F.size(F.array_remove(k, w))).cast("long") for w in vocabulary()]))


def base_counts(docs: DataFrame, p: RuleParams = RuleParams()) -> DataFrame:
    """The columns of docs [doc_id, text, lang] without the text, plus the counts of the rules. Null texts count as empty."""
    text = F.coalesce("text", F.lit(""))
    split = docs.select("doc_id", "lang", text.alias("text"), words_of(text).alias("words"))
    joined = F.array_join("words", "")
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    hashed = split.select(
        "doc_id", "lang", "words", window_hashes(F.col("words"), p.window).alias("windows"),
        F.length(joined).cast("long").alias("word_chars"),
        (F.length(joined) - F.length(F.regexp_replace(joined, "[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        let(lines, lambda found: (F.size(found) - F.size(F.array_distinct(found))).cast("long")).alias("n_dup_lines"),
        class_counts(F.col("text")).alias("classes"),
        common_counts(F.transform("words", F.lower)).alias("common"),
    )
    # Few texts repeat a window: only those are sorted.
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    return hashed.select(
        "doc_id", "lang", F.size("words").cast("long").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
        F.when(repeats, covered_words(F.col("windows"), p.window)).otherwise(F.lit(0).cast("long")).alias("n_repeat_words"),
        "classes", "common",
    )


def language_references(counted: DataFrame) -> dict[str, tuple[list[int], list[int]]]:
    """(classes, common words with all other words last) of each language of COMMON_WORDS, summed over its documents."""
    n_class, words = len(CLASSES) + 1, vocabulary()
    sums = [F.sum(F.col("classes")[i]).alias(f"c{i}") for i in range(n_class)]
    sums += [F.sum(F.col("common")[i]).alias(f"w{i}") for i in range(len(words))]
    rows = counted.where(F.col("lang").isin(list(COMMON_WORDS))).groupBy("lang").agg(*sums, F.sum("n_words").alias("n")).collect()
    out = {}
    for row in sorted(rows):
        mine = [row[f"w{words.index(w)}"] for w in COMMON_WORDS[row["lang"]].split()]
        out[row["lang"]] = [row[f"c{i}"] for i in range(n_class)], [*mine, row["n"] - sum(mine)]
    return out


def js_distance(counts: Column, reference: Column) -> Column:
    """Square root of the Jensen-Shannon divergence in bits of two arrays of counts; 1 if one of the two is empty or null."""

    def part(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    def distance(totals: Column) -> Column:
        shares = F.zip_with(
            F.transform(counts, lambda c: c / totals["a"]), F.transform(reference, lambda c: c / totals["b"]),
            lambda p, q: (part(p, (p + q) / 2) + part(q, (p + q) / 2)) / 2,
        )
        return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(shares, F.lit(0.0), lambda acc, x: acc + x)))

    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda acc, x: acc + x)
    totals = F.struct(total(counts).alias("a"), total(reference).alias("b"))
    return let(totals, lambda t: F.when((t["a"] > 0) & (t["b"] > 0), distance(t)).otherwise(1.0))


def fixed(counts: list[int]) -> Column:
    return F.array(*[F.lit(c).cast("long") for c in counts])


def judge(docs: DataFrame, p: RuleParams = RuleParams()) -> DataFrame:
    """[doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, class_distance, word_distance].

    ``kept``: not failed by the base rule, and either too short to be judged or near enough to a language in both
    histograms. A text of a language whose common words are not given is also kept if its character classes are near those of all texts of that
    language. Without any reference every distance is 1 and texts long enough to be judged are not kept.
    """
    counted = stage(base_counts(docs, p), "rules")
    references = language_references(counted)
    words = vocabulary()
    class_distances, word_distances = [F.lit(1.0)], [F.lit(1.0)]
    for lang, (class_ref, word_ref) in references.items():
        mine = [F.col("common")[words.index(w)] for w in COMMON_WORDS[lang].split()]
        class_distances.append(js_distance(F.col("classes"), fixed(class_ref)))
        others = F.col("n_words") - reduce(lambda a, b: a + b, mine)
        word_distances.append(js_distance(F.array(*mine, others), fixed(word_ref)))
    # Any number of other languages: a grouped sum, joined back by its counted size.
    sums = F.array(*[F.sum(F.col("classes")[i]) for i in range(len(CLASSES) + 1)])
    other_languages = counted.where(~F.col("lang").isin(list(COMMON_WORDS))).groupBy("lang").agg(sums.alias("own_classes"))
    counted = lookup_join(counted, other_languages, "lang")
    own_distance = js_distance(F.col("classes"), F.col("own_classes"))
    nearest = lambda found: F.least(*found, F.lit(1.0))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    near = (F.col("class_distance") <= p.max_class) & (F.col("word_distance") <= p.max_words)
    return (
        counted.withColumn("class_distance", nearest(class_distances)).withColumn("word_distance", nearest(word_distances))
        .withColumn("own_distance", own_distance).withColumn("base_failed", failed)
        .withColumn("kept", ~failed & ((F.col("n_words") < p.min_words) | near | (F.col("own_distance") <= p.max_class)))
        .withColumn("class_distance", F.least("class_distance", "own_distance"))
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "class_distance", "word_distance")
    )
