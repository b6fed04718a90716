"""Values, keys and layouts that a load must not change silently."""

import math

import pytest
from pyspark.sql import functions as F

from tidemill.errors import DuplicateKeyError, InputError, SchemaError, SourceError
from tidemill.functions import dates
from tidemill.functions.text import decode_entities
from tidemill.operators import columns as C
from tidemill.operators import quality as Q
from tidemill.operators import relational as R
from tidemill.session import fresh_path, is_local
from tidemill.sinks import tables as TB
from tidemill.sinks import upsert as UP
from tidemill.sources.csv import extract_csv
from tidemill.sources.html import holiday_rows
from tidemill.streaming import upsert_stream


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def text_file(spark, lines):
    path = fresh_path(spark, "txt")
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    return path


# upsert

def test_a_key_that_moves_partition_stays_one_row(spark, db):
    name, schema = f"{db}.moved", "k long, v string, p string"
    UP.upsert(spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], schema), name, "k", partition_by=["p"])
    rep = UP.upsert(spark.createDataFrame([(1, "z", "y")], schema), name, "k")
    assert (rep.inserted, rep.updated, rep.ignored) == (0, 1, 0)
    assert rows(spark.table(name)) == [(1, "z", "y"), (2, "b", "y")]


def test_null_partitions_and_null_keys(spark, db):
    name, schema = f"{db}.nulls", "k long, v string, p string"
    UP.upsert(spark.createDataFrame([(None, "a", None), (2, "b", "y")], schema), name, "k", partition_by=["p"])
    rep = UP.upsert(spark.createDataFrame([(None, "z", "y"), (3, "c", None)], schema), name, "k")
    assert (rep.inserted, rep.updated) == (1, 1)
    assert rows(spark.table(name)) == sorted([(None, "z", "y"), (2, "b", "y"), (3, "c", None)], key=repr)


def test_a_duplicate_key_in_the_table_is_an_error(spark, db):
    name = f"{db}.twice"
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k long, v string")
    TB.create_table(df, name)
    with pytest.raises(DuplicateKeyError):
        UP.upsert(spark.createDataFrame([(1, "x")], "k long, v string"), name, "k")
    assert spark.table(name).count() == 3


def test_types_only_widen(spark, db):
    name = f"{db}.types"
    UP.upsert(spark.createDataFrame([(1, 2)], "k long, v long"), name, "k")
    with pytest.raises(SchemaError):
        UP.upsert(spark.createDataFrame([(1, 2.7)], "k long, v double"), name, "k")
    with pytest.raises(SchemaError):
        TB.replace_table(spark.createDataFrame([(1, "2")], "k long, v string"), name)
    assert UP.upsert(spark.createDataFrame([(1, 3)], "k int, v int"), name, "k").updated == 1


def test_bucketed_tables_survive_a_replace(spark, db):
    name = f"{db}.buckets"
    df = spark.range(100).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    UP.upsert(df.repartition(8), name, "k", buckets=4)
    files = {r[0] for r in spark.table(name).select(F.input_file_name()).distinct().collect()}
    assert len(files) == 4
    TB.replace_table(df.withColumn("v", F.lit("b")), name)
    assert UP.upsert(df, name, "k").updated == 100
    assert len(TB.drop_old_versions(spark, name)) >= 1
    assert spark.table(name).count() == 100


def test_create_table_keeps_the_old_one_when_the_write_fails(spark, db):
    name = f"{db}.kept"
    TB.create_table(spark.range(3).toDF("k"), name)
    broken = spark.range(5).select(F.when(F.col("id") > 3, F.raise_error(F.lit("no")).cast("long")).otherwise(
        F.col("id")).alias("k"))
    with pytest.raises(Exception):
        TB.create_table(broken, name)
    assert spark.table(name).count() == 3
    TB.create_table(spark.range(4).toDF("k"), name)
    assert spark.table(name).count() == 4


def test_stream_into_a_partitioned_table_keeps_one_row(spark, db):
    src, ckpt, schema = fresh_path(spark, "src"), fresh_path(spark, "ckpt"), "k long, v string, t int, p string"
    for i, row in enumerate([(1, "a", 1, "x"), (1, "b", 2, "y")]):
        spark.createDataFrame([row], schema).write.parquet(f"{src}/d{i}")
        q = upsert_stream(spark.readStream.schema(schema).parquet(f"{src}/*"), f"{db}.s", "k", ["t"], ckpt,
                          partition_by=["p"], available_now=True)
        q.awaitTermination(120)
    assert rows(spark.table(f"{db}.s")) == [(1, "b", 2, "y")]


def test_tables_live_in_their_database(spark, db):
    name = f"{db}.place"
    UP.upsert(spark.range(3).toDF("k"), name, "k")
    info = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    assert spark.catalog.getDatabase(db).locationUri.replace("file:", "") in info["Location"].replace("file:", "")


def test_only_one_process_is_local():
    assert is_local("local") and is_local("local[4]")
    assert not is_local("local-cluster[2,1,1024]") and not is_local("yarn") and not is_local(None)


# csv

def test_csv_quotes_tokens_and_long_codes(spark):
    path = text_file(spark, ["a;b;c;d", '1;"say ""hi""; now";12345678901234567890; NA ', "2;x;5;NA"])
    assert rows(extract_csv(spark, path)) == [(1, 'say "hi"; now', "12345678901234567890", " NA "), (2, "x", "5", None)]


def test_csv_line_end_in_quotes(spark):
    path = text_file(spark, ["a;b", '1;"x', 'y"'])
    assert rows(extract_csv(spark, path, multi_line=True)) == [(1, "x\ny")]


def test_csv_declared_numbers(spark):
    path = text_file(spark, ["a;b;c", "1;NA;x", "NA;2.5;NA"])
    assert rows(extract_csv(spark, path, schema="a int, b double, c string")) == sorted(
        [(1, None, "x"), (None, 2.5, None)], key=repr)
    with pytest.raises(SourceError):
        extract_csv(spark, path, schema="a int, b int, c int")


# values

def test_fill_nulls_lists(spark):
    df = spark.createDataFrame([(5, "NA", True, 1.5), (7, "x", None, math.nan), (None, None, False, None)],
                               "i int, s string, b boolean, f double")
    assert [r[0] for r in C.fill_nulls(df, "i", [None, 5, "NA"]).select("i").collect()] == [0, 7, 0]
    assert [r[0] for r in C.fill_nulls(df, "s", ["NA", 5]).select("s").collect()] == ["", "x", ""]
    assert [r[0] for r in C.fill_nulls(df, "b").select("b").collect()] == [True, False, False]
    assert [r[0] for r in C.fill_nulls(df, "f", [1.5]).select("f").collect()] == [0.0, 0.0, 0.0]
    assert C.fill_count(df, "i", [None, 5]).first()[0] == 2


def test_conform_numbers(spark):
    df = spark.createDataFrame([("9007199254740993", "nan", math.nan), ("3.0", "2.5", 4.0), ("x", None, None)],
                               "a string, b string, c double")
    out = Q.conform_types(df, {"a": "int", "b": "float", "c": "int"})
    assert out.collect() == [(9007199254740993, None, None), (3, 2.5, 4), (None, None, None)]
    for bad in ("2.5", "12345678901234567890"):
        with pytest.raises(SchemaError):
            Q.conform_types(spark.createDataFrame([(bad,)], "a string"), {"a": "int"})


def test_nan_is_missing_in_reports_and_groups(spark):
    df = spark.createDataFrame([(1, math.nan), (1, 2.0), (2, math.nan)], "k int, v double")
    assert rows(Q.null_report(df)) == [("v", 2)]
    out = R.group_by(df, "k", {"v": "MAX"})
    assert rows(out) == [(1, 2.0), (2, None)]
    assert rows(R.group_by(df, "k", {"v": "SUM"})) == [(1, 2.0), (2, 0.0)]


# dates, pages, joins

def test_date_patterns():
    assert dates.spark_pattern("DD-MM-YYYY") == "dd'-'MM'-'yyyy"
    assert dates.spark_pattern("YY'MM") == "yy''MM"
    for bad in ("YYYYMMMM", "YYYYY", "YYYYMMD", "YYYYYY"):
        with pytest.raises(InputError):
            dates.spark_pattern(bad)


def test_entities(spark):
    df = spark.createDataFrame([("San Jos&eacute; &#243; D&iacute;a &#x1F600; &amp;lt; &nope; & &#0; a&b;c",), (None,), ("",)],
                               "t string")
    assert [r[0] for r in df.select(decode_entities(F.col("t"))).collect()] == [
        "San José ó Día 😀 &lt; &nope; & &#0; a&b;c", None, ""]


def test_a_holiday_without_a_date_stops(spark):
    page = ("<table class='country-table'><tr><td>Mon</td><td>Mar 40</td><td>N</td><td>Public Holiday</td></tr></table>")
    with pytest.raises(Exception, match="not a date"):
        holiday_rows(spark.createDataFrame([("R", 2020, page)], "region string, year int, html string")).collect()


def test_full_join_reads_each_side_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left, right = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("orders", "customer"))
        out = R.join_tables("k", "FULL", left.withColumnRenamed("o_custkey", "k"), right.withColumnRenamed("c_custkey", "k"))
        plan = out._jdf.queryExecution().sparkPlan().toString()
        full = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("FileScan") == 2 and full.count("Exchange hashpartitioning") == 2
