"""FULL joins with hot keys: the rows of the plain join, and no task that gathers a key."""

import logging
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemill.operators.hot_keys import hot_keys
from tidemill.operators.relational import join_tables


def side(spark, rows, name):
    return spark.createDataFrame(rows, f"k string, {name} long, both string")


def rows(df):
    return Counter(tuple(r) for r in df.collect())


LEFT = [("hot", i, "l") for i in range(60)] + [(None, i, "n") for i in range(25)] + [("lone", i, None) for i in range(30)] \
    + [("a", 1, "x"), ("b", 2, "y"), ("b", 2, "y")]
RIGHT = [("hot", 1, "r"), ("hot", 2, "r"), ("hot", 2, "r"), (None, 7, "q"), ("b", 3, "z"), ("c", 4, "w")] \
    + [("far", i, "f") for i in range(40)]


@pytest.mark.parametrize("null_safe", [True, False])
@pytest.mark.parametrize("swap", [False, True])
@pytest.mark.parametrize("hot_rows", [0, 10, 35, 1000])
def test_same_rows_as_the_plain_join(spark, null_safe, swap, hot_rows):
    left, right = side(spark, LEFT, "v"), side(spark, RIGHT, "w")
    left, right = (right, left) if swap else (left, right)
    plain = join_tables("k", "FULL", left, right, null_safe)
    dealt = join_tables("k", "FULL", left, right, null_safe, hot_rows=hot_rows)
    assert dealt.columns == plain.columns == ["k"] + plain.columns[1:]
    assert rows(dealt) == rows(plain)


def test_empty_sides_and_the_same_frame_twice(spark):
    left, none = side(spark, LEFT, "v"), side(spark, [], "w")
    assert rows(join_tables("k", "FULL", left, none, hot_rows=5)) == rows(join_tables("k", "FULL", left, none))
    assert rows(join_tables("k", "FULL", none, none.withColumnRenamed("w", "v"), hot_rows=5)) == Counter()
    assert rows(join_tables("k", "FULL", left, left, hot_rows=50)) == rows(join_tables("k", "FULL", left, left))


def test_columns_that_have_no_hash(spark):
    left = side(spark, LEFT, "v").withColumn("m", F.create_map(F.lit("a"), "v"))
    out = join_tables("k", "FULL", left, side(spark, RIGHT, "w"), hot_rows=10)
    assert out.count() == join_tables("k", "FULL", left, side(spark, RIGHT, "w")).count()


def test_hot_keys_and_their_pairs(spark, caplog):
    left, right = side(spark, LEFT, "v"), side(spark, RIGHT, "w")
    found = {r["key"]: tuple(r)[1:] for r in hot_keys("k", left, right, 25).collect()}
    assert found == {"hot": (60, 3, 180, 3), None: (25, 1, 25, 1), "lone": (30, 0, 0, 2), "far": (0, 40, 0, 2)}
    with caplog.at_level(logging.WARNING):
        join_tables("k", "FULL", left, right, hot_rows=25)
    assert "25 x 1 rows with a null key make 25 pairs" in caplog.text


def test_a_hot_key_spans_many_tasks(spark):
    """One key on half of the rows: no partition of the join holds it whole."""
    left = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    right = spark.range(100).select(F.col("id").alias("k"), F.col("id").alias("w"))
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        out = join_tables("k", "FULL", left, right, hot_rows=500)
        sizes = [r[1] for r in out.where("k = 0").groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 10_000 and max(sizes) < 4_000 and len(sizes) > 5
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
