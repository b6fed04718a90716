from pyspark.sql import functions as F

from tidemill.session import fresh_path
from tidemill.streaming import latest_per_key, upsert_stream

SF = "/root/testdata/sf0.001"


def test_latest_per_key(spark):
    df = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (2, 0, "c")], "k long, o int, v string")
    assert sorted(tuple(r) for r in latest_per_key(df, "k", ["o"]).collect()) == [(1, 1, "b"), (2, 0, "c")]


def test_upsert_stream_matches_batch(spark, db):
    src = fresh_path(spark, "stream-src")
    c = spark.read.parquet(f"{SF}/customer.parquet")
    c.where(F.col("c_mktsegment") != "AUTOMOBILE").write.parquet(f"{src}/part1")
    reports = []
    stream = spark.readStream.schema(c.schema).parquet(f"{src}/*")
    q = upsert_stream(stream, f"{db}.cust", "c_custkey", ["c_acctbal"], fresh_path(spark, "stream-ckpt0"),
                      on_report=lambda e, r: reports.append(r), available_now=True)
    q.awaitTermination(120)
    assert spark.table(f"{db}.cust").count() == c.where(F.col("c_mktsegment") != "AUTOMOBILE").count()
    assert reports and reports[0].inserted == spark.table(f"{db}.cust").count()


def test_upsert_stream_applies_later_batches(spark, db):
    src = fresh_path(spark, "stream-src2")
    ckpt = fresh_path(spark, "stream-ckpt")
    schema = "k long, v string, t int"
    spark.createDataFrame([(1, "a", 0), (2, "b", 0)], schema).write.parquet(f"{src}/b1")
    stream = lambda: spark.readStream.schema(schema).parquet(f"{src}/*")
    reports = []
    q = upsert_stream(stream(), f"{db}.s", "k", ["t"], checkpoint_location=ckpt,
                      on_report=lambda e, r: reports.append(r), available_now=True)
    q.awaitTermination(120)
    # a later file: a change to key 1 (two versions, the latest wins) and a new key 3
    spark.createDataFrame([(1, "x", 1), (1, "y", 2), (3, "c", 1)], schema).write.parquet(f"{src}/b2")
    q = upsert_stream(stream(), f"{db}.s", "k", ["t"], checkpoint_location=ckpt,
                      on_report=lambda e, r: reports.append(r), available_now=True)
    q.awaitTermination(120)
    assert {tuple(r) for r in spark.table(f"{db}.s").collect()} == {(1, "y", 2), (2, "b", 0), (3, "c", 1)}
    assert (reports[-1].inserted, reports[-1].updated) == (1, 1)


def test_upsert_stream_keeps_the_latest_across_batches(spark, db):
    src = fresh_path(spark, "stream-src3")
    ckpt = fresh_path(spark, "stream-ckpt3")
    schema = "k long, v string, t int"
    spark.createDataFrame([(1, "new", 5)], schema).write.parquet(f"{src}/b1")
    stream = lambda: spark.readStream.schema(schema).parquet(f"{src}/*")
    upsert_stream(stream(), f"{db}.o", "k", ["t"], checkpoint_location=ckpt, available_now=True).awaitTermination(120)
    # a late file carrying an older version of key 1: it must not win
    spark.createDataFrame([(1, "old", 2), (2, "b", 1)], schema).write.parquet(f"{src}/b2")
    upsert_stream(stream(), f"{db}.o", "k", ["t"], checkpoint_location=ckpt, available_now=True).awaitTermination(120)
    assert {tuple(r) for r in spark.table(f"{db}.o").collect()} == {(1, "new", 5), (2, "b", 1)}
