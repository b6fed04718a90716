import datetime as dt

import pytest

from tidemill.errors import AggregationError, JoinError, SortError
from tidemill.operators import relational as R
from tidemill.operators import sort as S


def test_group_by_rules(spark):
    df = spark.createDataFrame(
        [(0, "k", None, 1.0, None), (1, "k", "a", 2.0, None), (2, "k", "b", None, None), (3, None, "z", 9.0, None)],
        "ord int, k string, s string, x double, y double")
    out = R.group_by(df, "k", {"s": "FIRST", "x": "sum", "y": "SUM"}, order_by=["ord"]).collect()
    assert len(out) == 1  # the null key is dropped
    assert out[0]["s"] == "a" and out[0]["x"] == 3.0 and out[0]["y"] == 0
    last = R.group_by(df, "k", {"s": "LAST"}, order_by=["ord"]).first()
    assert last["s"] == "b"
    with pytest.raises(AggregationError) as e:
        R.group_by(df, "k", {"x": "MEDIAN"})
    assert e.value.code == 3
    with pytest.raises(AggregationError) as e:
        R.group_by(df, "k", {"s": "SUM"})
    assert e.value.code == 4


def test_full_join_null_safe_golden(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    right = spark.createDataFrame([(None, 8), ("b", 9)], "k string, v int")
    out = R.join_tables("k", "FULL", left, right)
    assert out.columns == ["k", "v_x", "v_y"]
    assert {tuple(r) for r in out.collect()} == {(None, 1, 8), ("a", 2, None), ("b", None, 9)}


def test_join_errors(spark):
    a = spark.createDataFrame([(1,)], "k int")
    b = spark.createDataFrame([("1",)], "k string")
    with pytest.raises(JoinError) as e:
        R.join_tables("k", "INNER", a, b)
    assert e.value.code == 4
    with pytest.raises(JoinError) as e:
        R.join_tables("k", "CROSS", a, a)
    assert e.value.code == 2
    with pytest.raises(JoinError) as e:
        R.join_tables("z", "LEFT", a, a)
    assert e.value.code == 1


def test_sort_desc_nulls_last(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 1),), (None,), (dt.date(2021, 1, 1),)], "d date")
    assert [r["d"] for r in S.sort_dates(df, "d", "DES").collect()] == [dt.date(2021, 1, 1), dt.date(2020, 1, 1), None]
    assert [r["d"] for r in S.sort_dates(df, "d", "ASC").collect()] == [dt.date(2020, 1, 1), dt.date(2021, 1, 1), None]
    with pytest.raises(SortError) as e:
        S.sort_dates(df, "d", "UP")
    assert e.value.code == 3
    with pytest.raises(SortError) as e:
        S.sort_dates(spark.createDataFrame([("x",)], "d string"), "d")
    assert e.value.code == 4


def test_occurrence_number_hot_path_matches_window(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    from tidemill.functions.ordinal import occurrence_number
    df = spark.range(3000).select("id", F.when(F.col("id") < 2000, F.lit("hot")).otherwise(
        (F.col("id") % 50).cast("string")).alias("k"))
    ref = df.withColumn("m", F.row_number().over(Window.partitionBy("k").orderBy("id")))
    got = occurrence_number(df, ["k"], ["id"], "n", partitions=7)
    assert got.join(ref, ["id", "k"]).where("n != m").count() == 0
    assert got.count() == 3000


def test_hot_key_is_spread_over_several_tasks(spark):
    """A key holding a third of the rows: range bounds sampled on (key, order)
    place its rows in several partitions, which the hot path relies on."""
    from pyspark.sql import functions as F
    df = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, F.lit("hot"))
                                  .otherwise(F.col("id").cast("string")).alias("k"))
    ranged = df.repartitionByRange(8, F.struct("k"), "id").withColumn("pid", F.spark_partition_id())
    spread = ranged.where(F.col("k") == "hot").select("pid").distinct().count()
    assert spread >= 3


def test_dotted_column_names(spark):
    from tidemill.operators import columns as C
    df = spark.createDataFrame([(0, 1, "x"), (1, 1, None), (2, 2, "y")], "`o.id` int, `k.v` int, `s.t` string")
    g = R.group_by(df, "k.v", {"s.t": "FIRST"}, order_by=["o.id"])
    assert {tuple(r) for r in g.collect()} == {(1, "x"), (2, "y")}
    j = R.join_tables("k.v", "FULL", df, g)
    assert j.columns == ["k.v", "o.id", "s.t_x", "s.t_y"]
    assert C.unique_suffix(df, "k.v", ["o.id"]).where("`k.v` = '1 - 2'").count() == 1


def test_hot_join_key_is_split_by_aqe(spark):
    """A key holding a third of the left rows: AQE splits its partition for INNER and
    LEFT joins (a FULL join is one join that reads each side once, and isn't split)."""
    from pyspark.sql import functions as F
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1000",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2000",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        left = spark.range(30000).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500).alias("k"), "id")
        right = spark.range(1000).select((F.col("id") % 1000).alias("k"), F.col("id").alias("v"))
        for how in ("LEFT", "INNER"):
            out = R.join_tables("k", how, left, right)
            rows = out.collect()  # runs this Dataset's own adaptive plan to its final form
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert "isSkewJoin=true" in plan or "skew=true" in plan.lower(), (how, plan[:3000])
            assert len(rows) == 30000
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_position_and_write_layout(spark):
    import datetime as dt
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(i, dt.date(2020, 1, 1 + i % 5) if i % 7 else None) for i in range(40)],
                               "id int, d date")
    pos = S.with_position(df, "d", "ASC", then_by=["id"])
    got = [r["id"] for r in pos.orderBy("position").collect()]
    exp = [r["id"] for r in df.orderBy(F.col("d").asc_nulls_last(), "id").collect()]
    assert got == exp and pos.agg(F.max("position")).first()[0] == 40
    laid = S.sort_dates_within(df, "d", "ASC", then_by=["id"])
    parts = laid.withColumn("p", F.spark_partition_id()).groupBy("p").agg(
        F.min("d").alias("lo"), F.max("d").alias("hi")).orderBy("p").collect()
    bounds = [(r["lo"], r["hi"]) for r in parts if r["lo"] is not None]
    assert all(a[1] <= b[0] for a, b in zip(bounds, bounds[1:]))  # partitions hold ordered day ranges
