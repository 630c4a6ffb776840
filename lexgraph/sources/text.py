"""Text readers. All of them read lines, so large files are split over tasks."""

from __future__ import annotations

import codecs
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexgraph.functions.strings import jsplit, jtrim
from lexgraph.plans.lookup import lookup_join
from lexgraph.plans.stage import lookup_side


def scan_kv_text(
    spark: SparkSession, path: str, sep: str = "\x01", missing: str | None = "none", drop_blank: bool = True
) -> DataFrame:
    """[key, body] of records "key sep body"; a record without a body gets ``missing``.

    Further fields are ignored, as are separators at the end of a line. Lines that hold nothing
    else are dropped unless ``drop_blank=False``, which gives them an empty key.
    """
    line = F.rtrim(F.col("value"), F.lit(sep))
    lines = spark.read.text(path, lineSep="\n").select(line.alias("line"))
    if drop_blank:
        lines = lines.where(F.col("line") != "")
    parts = F.split(F.col("line"), f"\\x{ord(sep):02x}", 3)
    return lines.select(parts.alias("p")).select(
        F.col("p")[0].alias("key"),
        F.when(F.size("p") == 1, F.lit(missing)).otherwise(F.get("p", F.lit(1))).alias("body"),
    )


def read_lenient(spark: SparkSession, path: str, fallback: str = "cp936") -> DataFrame:
    """[path, line] of text files that are UTF-8, or in ``fallback`` as a whole if any byte is not.

    The raw bytes of each line are checked natively; a file with a bad line is decoded again as a
    whole, line by line. No line break byte is part of a longer cp936 character, so splitting
    before decoding is safe. Only lines of such files are sent to Python.
    """
    codec = codecs.lookup(fallback).name

    @F.arrow_udf("string")
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for raw in batches:
            yield pa.array([None if b is None else b.decode(codec) for b in raw.to_pylist()], type=pa.string())

    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), "value")
    bad = (
        lines.where(~F.is_valid_utf8("value")).select("path").distinct()
    )
    bad, small = lookup_side(bad, "bad_files", small=False)
    good = lookup_join(lines, bad, "path", "left_anti", small).select("path", F.col("value").alias("line"))
    again = lookup_join(lines, bad, "path", "left_semi", small)
    return good.unionByName(again.select("path", decoded(F.col("value").cast("binary")).alias("line")))


def tag_class_scan(spark: SparkSession, path: str) -> DataFrame:
    """[tag, cls] of lines "tag number"; other lines and class -1 are dropped.

    A class that is no number fails the job. Of repeated tags the largest class is kept.
    """
    return tag_classes(spark.read.text(path, lineSep="\n"))


def tag_classes(lines: DataFrame, value: str = "value") -> DataFrame:
    """[tag, cls] of "tag number" strings in a column."""
    parts = jsplit(jtrim(F.col(value)), " ")
    number = F.col("p")[1]
    cls = F.coalesce(
        number.try_cast("int"),
        F.raise_error(F.concat(F.lit("class is not a number: "), number)).cast("int"),
    )
    return (
        lines.select(parts.alias("p"))
        .where(F.size("p") == 2)
        .select(F.col("p")[0].alias("tag"), cls.alias("cls"))
        .where(F.col("cls") != -1)
        .groupBy("tag")
        .agg(F.max("cls").alias("cls"))
    )


def path_scan(spark: SparkSession, path: str, sep: str = ">") -> DataFrame:
    """[tag, path, depth] of lines "root>...>tag"; of repeated tags the largest path is kept."""
    return path_lines(spark.read.text(path, lineSep="\n"), sep=sep)


def path_lines(lines: DataFrame, value: str = "value", sep: str = ">") -> DataFrame:
    """[tag, path, depth] of "root>...>tag" strings in a column; separators only give nothing."""
    return (
        lines.select(jsplit(jtrim(F.col(value)), sep).alias("path"))
        .where(F.size("path") > 0)
        .groupBy(F.element_at("path", -1).alias("tag"))
        .agg(F.max("path").alias("path"))
        .select("tag", "path", (F.size("path") - 1).alias("depth"))
    )


def first_lines(df: DataFrame, n: int = 10) -> DataFrame:
    """Preview: any ``n`` rows."""
    return df.limit(n)
