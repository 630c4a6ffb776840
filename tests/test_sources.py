import pytest
from pyspark.sql import functions as F

from lexgraph.plans import stage as stage_module
from lexgraph.plans.lookup import hot_keys, lookup_join, salted_join
from lexgraph.plans.stage import stage, stage_sized
from lexgraph.sources import tables
from lexgraph.sources.text import first_lines, path_scan, read_lenient, scan_kv_text, tag_class_scan


def test_scan_kv_text(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"w1\x01<html>a</html>\nw2\n\nw3\x01h\x01extra\n\x01\x01\nw4\x01\x01\nw5\x01\x01x\r\n")
    got = {tuple(r) for r in scan_kv_text(spark, str(tmp_path)).collect()}
    assert got == {("w1", "<html>a</html>"), ("w2", "none"), ("w3", "h"), ("w4", "none"), ("w5", "")}
    kept = [tuple(r) for r in scan_kv_text(spark, str(tmp_path), missing=None, drop_blank=False).collect()]
    assert kept.count(("", None)) == 2


@pytest.mark.parametrize("small", [True, False])
def test_read_lenient(spark, tmp_path, monkeypatch, small):
    if not small:
        monkeypatch.setattr(stage_module, "MAX_BROADCAST_ROWS", -1)
    (tmp_path / "utf8").write_bytes("中国 é\nplain\n".encode())
    (tmp_path / "gbk").write_bytes("plain\n中国\r\n学\n".encode("cp936"))
    got = {(r.path.rsplit("/", 1)[1], r.line) for r in read_lenient(spark, str(tmp_path)).collect()}
    assert got == {("utf8", "中国 é"), ("utf8", "plain"), ("gbk", "plain"), ("gbk", "中国"), ("gbk", "学")}


def test_tag_class_scan(spark, tmp_path):
    (tmp_path / "a").write_text(" food 1 \nplant 2\nfood 3\nodd -1\nthree 4 5\nalone\n\n")
    assert {tuple(r) for r in tag_class_scan(spark, str(tmp_path)).collect()} == {("food", 3), ("plant", 2)}
    (tmp_path / "b").write_text("bad x\n")
    with pytest.raises(Exception, match="not a number"):
        tag_class_scan(spark, str(tmp_path)).collect()


def test_path_scan(spark, tmp_path):
    (tmp_path / "a").write_text("root\nroot>food\nroot>food>fruit\nalt>food\n>\n\n")
    got = {r.tag: (r.path, r.depth) for r in path_scan(spark, str(tmp_path)).collect()}
    assert got == {
        "root": (["root"], 0), "food": (["root", "food"], 1), "fruit": (["root", "food", "fruit"], 2), "": ([""], 0),
    }


def test_first_lines(spark):
    assert first_lines(spark.range(50), 7).count() == 7


def test_schemas(spark):
    schema = tables.make_schema([("a", "String"), ("b", "INT"), ("c", "bigint"), ("d", "bool"), ("e", "double"), ("f", "long")])
    assert [f.dataType.simpleString() for f in schema] == ["string", "int", "bigint", "boolean", "double", "bigint"]
    assert all(f.nullable for f in schema)
    assert tables.string_schema(["x", "y"]).simpleString() == "struct<x:string,y:string>"
    with pytest.raises(ValueError):
        tables.make_schema([("a", "decimal")])
    with pytest.raises(TypeError):
        tables.check_flat(spark.createDataFrame([([1],)], "a array<int>"))


@pytest.mark.parametrize("kind, dates", [("bigint", (20170101, 20170102)), ("string", ("it's", "b"))])
def test_snapshots(spark, tmp_path, kind, dates):
    table = f"snap_{kind}"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    df = spark.createDataFrame([(1, "x"), (2, "y")], "n int, s string")

    def write(part, dt):
        tables.write_snapshot(part, table, dt, kind, location=str(tmp_path / kind))

    def rows(dt=None):
        return sorted(tuple(r) for r in tables.snapshot_scan(spark, table, dt).collect())

    write(df, dates[0])
    write(df.where("n = 1"), dates[1])
    assert (rows(dates[0]), rows(dates[1])) == ([(1, "x"), (2, "y")], [(1, "x")])
    write(df.where("n = 2"), dates[0])
    assert (rows(dates[0]), rows()) == ([(2, "y")], [(1, "x"), (2, "y")])
    write(df.where("n = 9"), dates[0])
    assert (rows(dates[0]), rows()) == ([], [(1, "x")])
    plan = tables.snapshot_scan(spark, table, dates[1], ("s",))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(stat_date" in plan
    spark.sql(f"DROP TABLE {table}")


def test_write_table_and_lines(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS whole")
    df = spark.createDataFrame([(1, "x"), (2, "y")], "n int, s string")
    tables.write_table(df, "whole", location=str(tmp_path / "t"))
    tables.write_table(df.where("n = 2"), "whole", location=str(tmp_path / "t"))
    assert [tuple(r) for r in tables.snapshot_scan(spark, "whole").collect()] == [(2, "y")]
    spark.sql("DROP TABLE whole")
    tables.write_lines(df, ("s", "n"), ">", str(tmp_path / "l"))
    assert {r.value for r in spark.read.text(str(tmp_path / "l")).collect()} == {"x>1", "y>2"}


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    facts = spark.range(9000).select(
        F.when(F.col("id") < 3000, F.lit("hot")).when(F.col("id") < 3100, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id") / 7)).alias("k"),
        "id",
    )
    side = facts.select("k").distinct().where("k is not null and (k = 'hot' or k like '%5%')").withColumn("v", F.length("k"))
    want = sorted(map(str, facts.join(side, "k", how).collect()))
    assert sorted(map(str, salted_join(facts, side, "k", how).collect())) == want
    assert sorted(map(str, lookup_join(facts, side, "k", how).collect())) == want


def test_hot_keys_are_few_and_found(spark):
    facts = spark.range(9000).select(F.when(F.col("id") < 3000, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"))
    found = {r.k: r.salts for r in hot_keys(facts, "k").collect()}
    assert found == {"hot": 3}


def test_size_checks(spark):
    df = spark.range(100).toDF("a")
    staged = stage_sized(df, "t")
    assert (staged.rows, staged.small, staged.df.count()) == (100, True, 100) and 0 < staged.size < 50_000
    assert not staged._replace(rows=10**6).small
    assert not staged._replace(size=10**9).small
    assert stage_sized(df.where("a > 1000"), "t").rows == 0
    assert "Scan parquet" in stage(df, "t")._jdf.queryExecution().executedPlan().toString().replace("FileScan", "Scan")
