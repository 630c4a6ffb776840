"""The corpus pipeline: toxic documents go, one of each near-duplicate group stays, repeated passages are cut, documents with
benchmark items go, and what is left is encoded.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept; between stages the rows are
written as Parquet and read again, so a lost executor costs at most its tasks of one stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexgraph.llm import bpe, decontam, neardup, substring, toxicity
from lexgraph.llm.common import without
from lexgraph.llm.queries import labels, tokenizer_path
from lexgraph.plans.stage import stage

# Pass stage by stage: near duplicates take five words and a similarity of 0.8, repeats 50 words.
NEAR = neardup.NearDup(shingle=5, percent=80)
REPEATS = substring.Repeats(length=50, seed=36)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose toxicity score is 0.5 or more; the field is trained on the labels of these documents."""
    crf = toxicity.train_crf(docs.select("doc_id", "text"), labels(spark, sf_dir, "toxic"))
    scored = toxicity.score_toxicity(docs.select("doc_id", "text"), crf)
    return without(docs, scored.where("score >= 0.5"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return neardup.keep_one(docs, NEAR)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand earlier, here or in a document before, taken out of the texts; ``n_chars`` follows."""
    cut = substring.remove_repeats(docs, REPEATS)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark item."""
    found = decontam.contaminated(docs.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return without(docs, found.where("contaminated"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """[doc_id, n_tokens, ids_sha256, decoded_sha256] of what is left."""
    return bpe.digest_documents(docs, bpe.read_vocabulary(tokenizer_path()))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name)
    return docs


# Trained weights and latent retrieval have no SQL; the tests hold the result against a brute-force version.
ORACLE_SQL = None
