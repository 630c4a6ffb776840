"""Staged tables: cut lineage by writing to the cluster's shared checkpoint folder.

A staged table is ordinary Parquet, so it survives the loss of executors, is read back with
column pruning, and carries real file sizes for the next plan.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 500_000
# Of the written files, which are compressed.
MAX_BROADCAST_BYTES = 8 * 1024 * 1024
# Folders of the scopes that are open.
_scopes: ContextVar[tuple[str, ...]] = ContextVar("scopes", default=())


def stage_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one only in local mode without it."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="lexgraph-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def new_path(spark: SparkSession, label: str) -> str:
    """A new place in this application's own folder, which can be removed when the application is over."""
    app = spark.sparkContext.applicationId
    return "/".join([stage_root(spark), "lexgraph", app, *_scopes.get(), f"{label}-{uuid.uuid4().hex}"])


def written_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files below ``path``; only their listing is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.agg(F.sum("length")).first()[0] or 0


def release(spark: SparkSession) -> None:
    """Delete what this application has staged. Results that were returned lazily and not yet read are lost with it."""
    delete(spark, f"{stage_root(spark)}/lexgraph/{spark.sparkContext.applicationId}")


def delete(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """What is staged inside is deleted at the end, also after an error: write results elsewhere before that.

    Scopes may be nested; each deletes its own tables and those of the scopes inside it. Other threads are not affected.
    """
    name = f"scope-{uuid.uuid4().hex}"
    inside = _scopes.set((*_scopes.get(), name))
    path = "/".join([stage_root(spark), "lexgraph", spark.sparkContext.applicationId, *_scopes.get()])
    try:
        yield
    finally:
        _scopes.reset(inside)
        delete(spark, path)


class Staged(NamedTuple):
    """A staged table and what was counted while it was written."""

    df: DataFrame
    rows: int
    size: int

    @property
    def small(self) -> bool:
        """True if the table, and so every part of it, may be broadcast."""
        return self.rows <= MAX_BROADCAST_ROWS and self.size <= MAX_BROADCAST_BYTES


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return a DataFrame over the written table."""
    return _write(df, label)[0]


def _write(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def stage_sized(df: DataFrame, label: str) -> Staged:
    """``stage`` that also counts rows, in the same job, and the bytes written."""
    seen = Observation()
    staged, path = _write(df.observe(seen, F.count(F.lit(1)).alias("rows")), label)
    return Staged(staged, seen.get["rows"], written_bytes(df.sparkSession, path))


def lookup_side(df: DataFrame, label: str, small: bool) -> tuple[DataFrame, bool]:
    """``df`` and whether it may be broadcast: as it is if known to be small, else staged and counted."""
    if small:
        return df, True
    staged = stage_sized(df, label)
    return staged.df, staged.small
