import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexgraph.functions import strings as s

CONTROL = "".join(map(chr, range(33)))


def trim(x):
    return x.strip(CONTROL)


def split(x, pattern):
    """Split that drops trailing empty items, keeps leading ones, and leaves "" as one item."""
    if x == "":
        return [""]
    parts = re.split(pattern, x)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def base(x):
    parts = split(x, "/")
    return parts[0] if parts else x


def clean(items):
    return [base(x) for x in items if x and not x.startswith("/")]


def rows(spark, values, *columns):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [tuple(r) for r in df.select(*columns).collect()]


def test_goldens(spark):
    v = F.col("v")
    assert rows(spark, ["\t a \n\r", "", "  ", "\x00a b\x1f"], s.jtrim(v)) == [("a",), ("",), ("",), ("a b",)]
    assert rows(spark, ["", ",", "a,,b,,", ",a"], s.jsplit(v)) == [([""],), ([],), (["a", "", "b"],), (["", "a"],)]
    assert rows(spark, [" a  b "], s.jsplit(v, " \t", run=True)) == [(["", "a", "b"],)]
    assert rows(spark, ["a/b", "/a", "//", "/", ""], s.base_term(v)) == [("a",), ("",), ("//",), ("/",), ("",)]
    assert rows(spark, [None], s.jsplit(v), s.base_term(v), s.jtrim(v)) == [(None, None, None)]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.text(alphabet="ab/, \t\n\x01é中", max_size=12), min_size=20, max_size=60))
def test_rules_against_restatement(spark, values):
    v = F.col("v")
    got = rows(
        spark,
        values,
        v,
        s.jtrim(v),
        s.jsplit(v),
        s.jsplit(v, " \t", run=True),
        s.base_term(v),
        s.csv_items(s.clean_csv(v)),
        s.csv_size(s.clean_csv(v)),
        s.at_least(v, 3),
        s.longest_first(s.jsplit(v)),
    )
    for x, trimmed, items, parts, b, cleaned, n, three, ordered in got:
        assert trimmed == trim(x)
        assert items == split(x, ",")
        assert parts == split(x, "[ \t]+")
        assert b == base(x)
        assert cleaned == clean(split(x, ","))
        assert n == len(cleaned)
        assert three == (len([w for w in x.split(",") if w]) >= 3)
        assert ordered == sorted(split(x, ","), key=lambda w: -len(w))


def test_run_counts(spark):
    df = spark.createDataFrame([(["b", "a", "b", "a", "b"],), ([],), (["x"],)], "v array<string>")
    ended = df.select(F.array_sort("v").alias("v")).withColumn("e", s.run_ends(F.col("v")))
    got = ended.select(s.run_counts(F.col("v"), F.col("e")).alias("r")).collect()
    assert [[tuple(x) for x in r.r] for r in got] == [[("a", 2), ("b", 3)], [], [("x", 1)]]
