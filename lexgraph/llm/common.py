"""Shared parts of the corpus operators: the shape of their input, samples of labelled rows, Arrow passes.

Rules that hold for all of them: a null text is an empty text; words are runs of bytes outside
``\\x20\\x09-\\x0D`` (what ``bytes.split`` cuts at), so no regex is needed for them; columns that an
operator does not name are never read, so extra columns cannot clash with its own.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lexgraph.plans.stage import stage_sized

# Texts are worked on in runs of about so many bytes, which bounds what a Python worker holds.
RUN_BYTES = 4 << 20
# Rows of an Arrow batch of texts.
BATCH_ROWS = 1_000


def by_value(module: str) -> None:
    """Ship the functions of a module with the task, so executors need no installation of it."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


by_value(__name__)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``: the folds of the labelled operators."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(divisor))


def in_fold(doc_id: Column, divisor: int, fold: int) -> Column:
    """False, not null, for a null id."""
    return F.coalesce(remainder(doc_id, divisor) == fold, F.lit(False))


def bounded_sample(rows: DataFrame, key: str, size: int) -> DataFrame:
    """About ``size`` of the rows, the same ones each time: those whose hashed key falls under the share.

    All rows if there are no more than ``size``.
    """
    total = rows.count()
    if total <= size:
        return rows
    return rows.where(F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(total)) < size)


def arrow_pass(
    df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | StructType, run_bytes: int = RUN_BYTES
) -> DataFrame:
    """``work`` over runs of rows of about ``run_bytes``, in place: no row moves."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in runs(batch, run_bytes):
                yield work(run)

    return df.mapInArrow(over, schema)


def runs(batch: pa.RecordBatch, run_bytes: int = RUN_BYTES, name: str = "text") -> Iterator[pa.RecordBatch]:
    """Cuts of a batch of about ``run_bytes`` of the texts in column ``name``; a longer text is a run of its own. Without that column: of 256 rows."""
    if batch.schema.get_field_index(name) < 0:
        yield from (batch.slice(at, 256) for at in range(0, batch.num_rows, 256))
        return
    begin, size = 0, 0
    for i, length in enumerate(pc.binary_length(column(batch, name)).to_pylist()):
        if size and size + length > run_bytes:
            yield batch.slice(begin, i - begin)
            begin, size = i, 0
        size += length
    if batch.num_rows > begin:
        yield batch.slice(begin)


def shared(spark: SparkSession, model: tuple) -> Callable[[], tuple]:
    """A model of bounded size for the tasks; its class travels with the function, not as an import."""
    kind, sent = type(model), spark.sparkContext.broadcast(tuple(model))
    return lambda: kind(*sent.value)


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all columns, whose id is not in ``gone`` [doc_id]; rows with a null id stay."""
    staged = stage_sized(gone.select(F.col("doc_id").alias("__gone")).distinct(), "gone")
    side = F.broadcast(staged.df) if staged.small else staged.df
    return docs.join(side, docs["doc_id"] == side["__gone"], "left_anti")


def text_rows(df: DataFrame, *columns: str | Column) -> DataFrame:
    """[*columns, text] with the text as bytes; null texts are empty.

    Texts are long: the session's Arrow batches are held to ``BATCH_ROWS`` rows, which bounds what a task and its Python worker hold.
    """
    if int(df.sparkSession.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.select(*columns, F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))


def texts(batch: pa.RecordBatch) -> list[bytes]:
    return batch.column(batch.schema.get_field_index("text")).to_pylist()


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


class WordHash(dict):
    """word -> 64-bit hash, computed once for each word; emptied when it holds too many words."""

    LIMIT = 120_000

    def __missing__(self, word: bytes) -> int:
        from hashlib import blake2b

        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")
        return value

    def all(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (multiply and fold, twice)."""
    x = (x ^ (x >> np.uint64(32))) * MIX
    x = (x ^ (x >> np.uint64(29))) * MIX
    return x ^ (x >> np.uint64(32))


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of ``n`` consecutive hashes; empty if there are fewer."""
    size = len(h) - n + 1
    if size <= 0:
        return h[:0]
    out = h[:size].copy()
    for i in range(1, n):
        out = out * MIX + h[i : i + size]
    return mixed(out)
