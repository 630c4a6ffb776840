"""Tables by snapshot date, text output, and the flat schemas they accept."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexgraph.plans.stage import stage

FLAT_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "bool": T.BooleanType(),
    "double": T.DoubleType(),
}


def make_schema(fields: list[tuple[str, str]]) -> T.StructType:
    """Nullable flat schema from (name, type name) pairs; type names in any case."""
    unknown = [kind for _, kind in fields if kind.lower() not in FLAT_TYPES]
    if unknown:
        raise ValueError(f"not a flat type: {unknown}")
    return T.StructType([T.StructField(name, FLAT_TYPES[kind.lower()], True) for name, kind in fields])


def string_schema(names: list[str]) -> T.StructType:
    return make_schema([(name, "string") for name in names])


def check_flat(df: DataFrame) -> str:
    """Column list for CREATE TABLE; raises if a column is not of one of the five flat types."""
    bad = [f.name for f in df.schema if f.dataType not in FLAT_TYPES.values()]
    if bad:
        raise TypeError(f"columns are not flat: {bad}")
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def quoted(table: str) -> str:
    return ".".join(f"`{part}`" for part in table.replace("`", "").split("."))


def literal(value: str | int) -> str:
    """A SQL string literal."""
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_table(df: DataFrame, table: str, tail: str, more: str = "", location: str | None = None) -> None:
    place = f" LOCATION {literal(location)}" if location else ""
    df.sparkSession.sql(
        f"CREATE TABLE IF NOT EXISTS {quoted(table)} ({check_flat(df)}{more}) USING parquet {tail}{place}"
    )


def overwrite(df: DataFrame, insert: str) -> None:
    """Run ``insert`` with the rows of ``df``, which may be read from the table itself.

    A plan that reads what it overwrites is refused by Spark before anything is written. Its result is then written beside the table first
    and goes in from there, so the table keeps its old rows until all new ones exist.
    """
    try:
        df.sparkSession.sql(f"{insert} SELECT * FROM {{df}}", df=df)
    except AnalysisException as refused:
        if not (refused.getCondition() or "").startswith("UNSUPPORTED_OVERWRITE"):
            raise
        df.sparkSession.sql(f"{insert} SELECT * FROM {{df}}", df=stage(df, "beside"))


def write_snapshot(
    df: DataFrame, table: str, dt: str | int, part_type: str = "bigint", location: str | None = None
) -> None:
    """Overwrite the partition ``stat_date = dt``, creating the table if needed.

    Other dates stay; an empty ``df`` empties the partition. Columns go in by position. ``df`` may read the table itself.
    """
    if part_type not in {t.simpleString() for t in FLAT_TYPES.values()}:
        raise TypeError(f"not a flat type: {part_type}")
    create_table(df, table, "PARTITIONED BY (stat_date)", f", stat_date {part_type}", location)
    overwrite(df, f"INSERT OVERWRITE TABLE {quoted(table)} PARTITION (stat_date = {literal(dt)})")


def write_table(df: DataFrame, table: str, location: str | None = None) -> None:
    """Overwrite the whole table, creating it if needed; ``df`` may read that table."""
    create_table(df, table, "", location=location)
    overwrite(df, f"INSERT OVERWRITE TABLE {quoted(table)}")


def snapshot_scan(
    spark: SparkSession,
    table: str,
    stat_date: str | int | None = None,
    columns: tuple[str, ...] | None = None,
) -> DataFrame:
    """Rows of a table, of one date (partition pruning) or of all, with the asked columns.

    Without ``columns`` everything but the date is returned.
    """
    df = spark.table(table)
    names = columns or tuple(c for c in df.columns if c != "stat_date")
    if stat_date is not None:
        df = df.where(F.col("stat_date") == F.lit(stat_date).cast(df.schema["stat_date"].dataType))
    return df.select(*names)


def write_lines(df: DataFrame, columns: tuple[str, ...], sep: str, path: str) -> None:
    """Text lines of the columns joined by ``sep``; an array column is joined by it too."""
    df.select(F.concat_ws(sep, *[part_text(df, c) for c in columns]).alias("value")).write.mode("overwrite").text(path)


def part_text(df: DataFrame, name: str):
    return F.col(name) if isinstance(df.schema[name].dataType, T.ArrayType) else F.col(name).cast("string")
