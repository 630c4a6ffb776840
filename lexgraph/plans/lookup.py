"""Joins of a large side with a lookup side that has one row per key.

The lookup is broadcast only after its rows and bytes were counted. Beyond the limit the join
is a shuffle join in which frequent keys of the large side are salted: a key with share ``s``
of the rows, if that is more than a fair partition, is spread over about ``s`` times the shuffle
partitions, equal rows as shares of their number, and only the lookup rows of those keys are repeated. Salting changes where
rows go, never which rows match.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexgraph.plans.stage import lookup_side, stage, stage_sized

# A key is salted if it has more rows than a fair partition, and in any case above 1/HOT_KEYS of the rows.
HOT_KEYS = 256
# What the sketch can tell apart; it bounds the table of frequent keys.
MOST_HOT_KEYS = 20_000


def hot_keys(df: DataFrame, key: str) -> DataFrame:
    """[key, salts] of the frequent keys, staged: at most MOST_HOT_KEYS rows from one sketch aggregate.

    The sketch only decides which keys get salted; a miss costs time, not correctness, as both sides of a join
    read the one staged table.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    limit = min(max(partitions, HOT_KEYS), MOST_HOT_KEYS)
    seen = df.agg(
        F.expr(f"approx_top_k(`{key}`, {limit}, {min(8 * MOST_HOT_KEYS, 32 * limit)})").alias("top"),
        F.count(F.lit(1)).alias("total"),
    ).select(F.explode("top").alias("t"), "total")
    share = F.col("t.count") / F.col("total")
    found = seen.where((F.col("t.count") * limit > F.col("total")) & F.col("t.item").isNotNull()).select(
        F.col("t.item").alias(key), F.greatest(F.lit(2), F.ceil(share * partitions)).cast("int").alias("salts")
    )
    return stage(found, "hot_keys")


def counted_hot(counted: DataFrame, key: str, n: str) -> DataFrame:
    """``hot_keys`` of a side whose rows are counted already: ``counted`` [key, n] has one row per key."""
    partitions = int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    limit = min(max(partitions, HOT_KEYS), MOST_HOT_KEYS)
    total = counted.agg(F.sum(n)).first()[0] or 0
    salts = F.greatest(F.lit(2), F.ceil(F.col(n) / F.lit(max(1, total)) * partitions)).cast("int")
    frequent = counted.where((F.col(n) * limit > total) & F.col(key).isNotNull())
    return stage(frequent.select(key, salts.alias("salts")), "hot_keys")


def spread_rows(facts: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """``facts`` with ``__salt`` and ``__copies``, the number of equal rows that a row stands for.

    Rows of frequent keys are counted first, equal ones with map-side parts, and move once with their number, cut into as many
    shares as the key has salts: one row that stands for most of a table is spread like different ones. Counts are the same when a
    task is computed again, so every row stays where it was. ``facts`` is read for the frequent and for the other keys.
    """
    partitions = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = [f"`{c}`" for c in facts.columns]
    salts = F.when(F.col(f"`{key}`").isNull(), F.lit(partitions)).otherwise(F.col("__salts"))
    marked = facts.join(hot.withColumnRenamed("salts", "__salts"), key, "left").withColumn("__salts", salts.cast("long"))
    others = marked.where("__salts is null").select(*columns, F.lit(0).alias("__salt"), F.lit(1).cast("long").alias("__copies"))
    counted = marked.where("__salts is not null").groupBy(*columns, "__salts").agg(F.count(F.lit(1)).alias("__n"))
    counted = counted.withColumn("__most", F.least("__n", "__salts"))
    shares = counted.select("*", F.explode(F.sequence(F.lit(0), F.col("__most").cast("int") - 1)).alias("__share"))
    spread = F.pmod(F.xxhash64(*columns) + F.col("__share"), F.col("__salts")).cast("int")
    # Of n copies in s shares the first n % s have one more.
    copies = F.floor(F.col("__n") / F.col("__most")) + F.when(F.col("__share") < F.col("__n") % F.col("__most"), 1).otherwise(0)
    return others.unionByName(shares.select(*columns, spread.alias("__salt"), copies.alias("__copies")))


def salted_join(
    facts: DataFrame, lookup: DataFrame, key: str, how: str = "left", hot: DataFrame | None = None
) -> DataFrame:
    """Shuffle join on ``key`` with the frequent keys of ``facts``, and its null keys, spread over salts; equal rows move once.

    ``hot`` gives the frequent keys where they are cheaper to find than from ``facts``; it must be a staged table.
    """
    hot = F.broadcast(hot_keys(facts.select(key), key) if hot is None else hot)
    repeated = lookup.join(hot, key, "left").withColumn(
        "__salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("salts"), F.lit(1)) - 1))
    )
    joined = spread_rows(facts, key, hot).join(repeated.drop("salts"), [key, "__salt"], how).drop("__salt")
    again = F.explode(F.array_repeat(F.lit(0), F.col("__copies").cast("int")))
    return joined.withColumn("__copy", again).drop("__copies", "__copy")


def frequent_join(facts: DataFrame, lookup: DataFrame, key: str, how: str, counted: DataFrame, n: str = "seen") -> DataFrame:
    """Join (left or inner) of ``facts`` whose keys are counted already, ``counted`` [key, n] a staged table with one row per key but null.

    The lookup rows of frequent keys, those with more than 1/MOST_HOT_KEYS of the rows, are broadcast, and the rows with these keys, or none,
    stay where they are; only those with rarer keys move, and none of these fills a partition. If the rows of the frequent keys
    are too large to broadcast, the keys are salted.
    """
    total = counted.agg(F.sum(n)).first()[0] or 0
    hot = counted.where((F.col(n) * MOST_HOT_KEYS > total) & F.col(key).isNotNull()).select(key)
    side = stage_sized(hot.join(lookup, key, how), "frequent")
    if not side.small:
        return salted_join(facts, lookup, key, how, counted_hot(counted, key, n))
    rare = facts.where(F.col(key).isNotNull()).join(F.broadcast(stage(hot, "frequent_keys")), key, "left_anti").join(lookup, key, how)
    if how == "inner":
        return facts.join(F.broadcast(side.df), key).unionByName(rare)
    known = facts.join(F.broadcast(side.df.withColumn("__frequent", F.lit(True))), key, "left")
    return known.where(F.col("__frequent") | F.col(key).isNull()).drop("__frequent").unionByName(rare)


def lookup_join(
    facts: DataFrame, lookup: DataFrame, key: str, how: str = "left", small: bool | None = None
) -> DataFrame:
    """Join ``facts`` with a lookup on ``key`` (left, inner, left_semi or left_anti).

    ``small`` tells whether the lookup was found to fit; without it the lookup is staged, which
    computes it once and counts it.
    """
    if small is None:
        lookup, small = lookup_side(lookup, "lookup", small=False)
    if small:
        return facts.join(F.broadcast(lookup), key, how)
    return salted_join(facts, lookup, key, how)
