"""The queries of the corpus operators over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexgraph.llm import bpe, decontam, jaccard, langid, licenses, lm, merkle, neardup, negatives, quality, rules, substring, toxicity
from lexgraph.llm.common import documents, in_fold
from lexgraph.llm.oracles import ORACLES as ORACLES  # for the driver's entry


def labels(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """[doc_id, label] of the rows of ``labels`` that have it."""
    return spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col(name).alias("label")).where(F.col("label").isNotNull())


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    learned = labels(spark, sf_dir, "quality").where(~in_fold(F.col("doc_id"), 3, 1))
    scored = quality.classify_quality(docs.select("doc_id", "text"), learned)
    return scored.select("doc_id", in_fold(F.col("doc_id"), 3, 1).alias("held_out"), "score", "predicted")


def op2_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.dedup_digests(documents(spark, sf_dir).select("doc_id", "text"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest_documents(documents(spark, sf_dir), bpe.read_vocabulary(tokenizer_path()))


def op4_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(documents(spark, sf_dir).select("doc_id", "text", "lang")).drop("class_distance", "word_distance")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the public vocabulary file is: in the folder LEXGRAPH_TOKENIZERS, else where the package of public tokenizers has it."""
    import os

    folder = os.environ.get("LEXGRAPH_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    crf = toxicity.train_crf(docs.select("doc_id", "text"), labels(spark, sf_dir, "toxic").where(~in_fold(F.col("doc_id"), 5, 0)))
    scored = toxicity.score_toxicity(docs, crf)
    return scored.select(
        "doc_id", in_fold(F.col("doc_id"), 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans"
    )


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a file of a tree: its source, then directories of 5,000 and of 100 ids; each of the smaller ones
    begins with a licence file, so that texts without a notice of their own have something to inherit."""
    docs = documents(spark, sf_dir)
    name = F.when(F.col("doc_id") % 100 == 0, "LICENSE").otherwise(F.concat(F.lit("doc"), F.col("doc_id").cast("string"), F.lit(".txt")))
    folder = lambda size: F.floor(F.col("doc_id") / size).cast("string")
    files = docs.select(F.col("doc_id").alias("file_id"), F.concat_ws("/", "source", folder(5_000), folder(100), name).alias("path"), "text")
    return licenses.scan_licenses(files).withColumnRenamed("file_id", "doc_id")


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    model = langid.train_languages(docs.where(~in_fold(F.col("doc_id"), 4, 2)))
    found = langid.identify_languages(docs.select("doc_id", "text"), model)
    return found.select("doc_id", in_fold(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")


def op8_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(documents(spark, sf_dir).select("doc_id", "text"), neardup.NearDup(shingle=3, percent=85))


def op9_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontam.contaminated(documents(spark, sf_dir).select("doc_id", "text"), benchmark)


def op10_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    held_out = in_fold(F.col("doc_id"), 7, 2)
    scored = lm.score_texts(docs, docs.where(~held_out))
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


def op11_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_join(documents(spark, sf_dir).select("doc_id", "text"))


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows with an id divisible by 100 ask; every seventh id has the label of another class."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    wrong = F.coalesce(F.col("vec_id") % 7 == 0, F.lit(False))
    label = F.when(wrong, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    given = rows.select("vec_id", label.alias("label"), F.col("embedding").alias("vector"))
    return negatives.hard_negatives(given, F.col("vec_id") % 100 == 0)


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of ``documents`` in parts by language, held against a copy with a changed ``n_chars`` in every seventh document."""
    docs = documents(spark, sf_dir)
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False)) & F.col("n_chars").isNotNull()
    n_chars = F.col("n_chars").cast("decimal(20,0)")
    claim = lambda n: merkle.leaf(F.col("doc_id"), F.col("source"), F.col("lang"), n, F.col("text"))
    rows = docs.select(
        "doc_id", F.col("lang").alias("part"), claim(n_chars).alias("leaf"), F.when(tampered, claim(n_chars + 1)).alias("claimed")
    )
    found = merkle.manifest(rows, "doc_id").withColumn("folded_root", merkle.folded(F.col("path"), F.coalesce("claimed", "leaf")))
    return found.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_substring": op2_substring,
    "op3_bpe": op3_bpe,
    "op4_rules": op4_rules,
    "op5_toxicity": op5_toxicity,
    "op6_licenses": op6_licenses,
    "op7_langid": op7_langid,
    "op8_neardup": op8_neardup,
    "op9_decontam": op9_decontam,
    "op10_ctw": op10_ctw,
    "op11_jaccard": op11_jaccard,
    "op12_negatives": op12_negatives,
    "op13_merkle": op13_merkle,
}
