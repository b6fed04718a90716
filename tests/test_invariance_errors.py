"""Order-dependent operators ignore physical partitioning; every documented
error code is raised where it should be."""

import pytest
from pyspark.sql import functions as F

from tidemill.errors import (AggregationError, InputError, JoinError, MissingColumnError, SourceError)
from tidemill.operators import columns as C
from tidemill.operators import relational as R
from tidemill.operators.holidays import merge_holidays
from tidemill.session import fresh_path
from tidemill.sources.calendar import create_calendar
from tidemill.sources.csv import extract_csv
from tidemill.sources.json import extract_json

SF = "/root/testdata/sf0.001"


def _variants(df):
    return [df, df.repartition(1), df.repartition(7), df.orderBy(F.rand(11))]


def _as_set(df):
    return {tuple(r) for r in df.collect()}


@pytest.mark.parametrize("op", ["unique_suffix", "category_auto", "first_last", "holiday_merge", "surrogate"])
def test_order_dependent_operators_are_partitioning_invariant(spark, op):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    if op == "unique_suffix":
        run = lambda d: C.unique_suffix(d.select("o_orderkey", "o_orderpriority"), "o_orderpriority", ["o_orderkey"])
    elif op == "category_auto":
        run = lambda d: C.category_codes(d.select("o_orderkey", "o_orderpriority"), "o_orderpriority",
                                         order_by=["o_orderkey"])
    elif op == "first_last":
        run = lambda d: R.group_by(d, "o_custkey", {"o_orderstatus": "FIRST", "o_orderpriority": "LAST"},
                                   order_by=["o_orderkey"])
    elif op == "surrogate":
        run = lambda d: C.surrogate_key(d.select("o_orderkey", F.date_format("o_orderdate", "yyyyMMdd")
                                                 .alias("d")), "d", ["o_orderkey"])
    else:
        def run(d):
            e = d.select(F.date_format("o_orderdate", "dd-MM-yyyy").alias("Day"),
                         F.col("o_orderpriority").alias("Name"),
                         F.when(F.col("o_orderstatus") == "F", "Nacional").otherwise("Regional").alias("Type"),
                         F.col("o_custkey").cast("string").alias("Region"),
                         F.col("o_orderstatus").alias("Comments"), "o_orderkey")
            return merge_holidays(e, ["o_orderkey"]).withColumn("Region", F.array_join("Region", ","))
    results = [_as_set(run(v)) for v in _variants(o)]
    assert all(r == results[0] for r in results[1:])


def test_group_by_and_join_codes(spark):
    df = spark.createDataFrame([(1, 2)], "k int, v int")
    with pytest.raises(InputError) as e:
        R.group_by(df, "k", {})
    assert e.value.code == 1
    with pytest.raises(MissingColumnError) as e:
        R.group_by(df, "k", {"zz": "SUM"})
    assert e.value.code == 2
    with pytest.raises(InputError):
        R.group_by(df, "k", {"v": "FIRST"})  # row order is required
    with pytest.raises(JoinError) as e:
        R.join_tables("k", "LEFT", df, "not a frame")
    assert e.value.code == 3
    with pytest.raises(AggregationError):
        R.group_by(spark.createDataFrame([(1, "x")], "k int, s string"), "k", {"s": "AVG"})


def test_missing_column_codes(spark):
    df = spark.createDataFrame([(1,)], "k int")
    for call in (lambda: C.parse_date(df, "nope"), lambda: C.surrogate_key(df, "nope", ["k"]),
                 lambda: C.category_codes(df, "nope", order_by=["k"]), lambda: C.fill_nulls(df, "nope")):
        with pytest.raises(MissingColumnError) as e:
            call()
        assert e.value.code == 2


def test_calendar_codes(spark):
    for a, b in (("2015-01-01", "31-12-2015"), ("31-12-2015", "01-01-2015")):
        with pytest.raises(InputError) as e:
            create_calendar(spark, a, b)
        assert e.value.code == 1


def test_source_codes(spark):
    bad = fresh_path(spark, "badjson")
    spark.createDataFrame([("[{\"a\": 1}, {oops",)], "value string").coalesce(1).write.text(bad)
    with pytest.raises(SourceError) as e:
        extract_json(spark, bad, {"a": "int"}).collect()
    assert e.value.code == 2
    with pytest.raises(SourceError) as e:
        extract_json(spark, "/nonexistent/x.json", {"a": "int"})
    assert e.value.code == 1
    empty = fresh_path(spark, "empty")
    spark.createDataFrame([], "value string").write.text(empty)
    with pytest.raises(SourceError) as e:
        extract_csv(spark, empty)
    assert e.value.code in (1, 2)


def test_dimension_join_is_broadcast(spark):
    import __spark_entry__ as E
    plan = E.entry(spark)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
