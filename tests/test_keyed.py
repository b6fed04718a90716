"""Keyed tables: loads compare digests and rewrite only the buckets they change."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemill.errors import DuplicateKeyError, InputError, SchemaError
from tidemill.session import work_dir
from tidemill.sinks import keyed
from tidemill.sinks import upsert as UP

SCHEMA = "id long, name string, v double, at timestamp"


def frame(spark, rows):
    return spark.createDataFrame([(i, n, v, dt.datetime(2020, 1, 1, 0, 0, 0, 5)) for i, n, v in rows], SCHEMA)


def files(spark, table):
    rows = spark.table(table).select(keyed.BUCKET, F.col("_metadata.file_path").alias("f")).distinct().collect()
    return {(r[0], r[1]) for r in rows}


def test_only_changed_buckets_are_rewritten(spark, db, tmp_path):
    t = f"{db}.dim"
    first = [(i, f"n{i}", float(i)) for i in range(200)] + [(None, "none", -0.0)]
    assert UP.upsert(frame(spark, first), t, "id", key_buckets=16).as_row()[1:] == (201, 0, 0, 0)
    assert keyed.layout(spark, t) == ("id", 16)
    before = files(spark, t)
    # equal rows (a zero of the other sign among them), read in another time zone: nothing is written
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    same = spark.table(t).drop(keyed.BUCKET, keyed.DIGEST).withColumn("v", F.when(F.col("id").isNull(), 0.0).otherwise(F.col("v")))
    report = UP.upsert(same.where("id is null or id < 100"), t, "id").as_row()[1:]
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert report == (0, 0, 101, 100) and files(spark, t) == before

    report = UP.upsert(frame(spark, [(5, "new", 5.0), (6, "n6", 6.0), (7, None, 7.0), (None, "other", 0.0)]), t, "id")
    assert report.as_row()[1:] == (0, 3, 1, 197)
    after = files(spark, t)
    changed = {b for b, _ in after - before}
    keys = spark.createDataFrame([(5,), (7,), (None,)], "id long")
    assert changed == {r[0] for r in keys.select(F.pmod(F.xxhash64("id"), F.lit(16))).collect()} and len(changed) < 16
    assert {f for f in before if f[0] not in changed} == {f for f in after if f[0] not in changed}
    report = UP.upsert(frame(spark, [(1000, "x", 1.0), (5, "new", 5.0)]), t, "id")
    assert report.as_row()[1:] == (1, 0, 1, 200)
    got = {r["id"]: (r["name"], r["v"]) for r in keyed.read(spark, t).collect()}
    want = {i: (n, v) for i, n, v in first} | {5: ("new", 5.0), 7: (None, 7.0), None: ("other", 0.0), 1000: ("x", 1.0)}
    assert got == want and keyed.read(spark, t).count() == 202


def test_loads_leave_nothing_in_the_work_folder(spark, db):
    from pathlib import Path
    place = Path(work_dir(spark).removeprefix("file:"))
    before = {p.name for p in place.iterdir()}
    for kw in ({"key_buckets": 4}, {"partition_by": ["name"]}):
        t = f"{db}.t{len(kw)}_{next(iter(kw))}"
        UP.upsert(frame(spark, [(1, "a", 1.0), (2, "b", 2.0)]), t, "id", **kw)
        UP.upsert(frame(spark, [(1, "b", 1.0), (3, "b", 2.0)]), t, "id")
    assert {p.name for p in place.iterdir()} == before


def test_the_target_gives_key_and_digest_alone(spark, db):
    t = f"{db}.wide"
    UP.upsert(frame(spark, [(i, "a" * i, 0.5) for i in range(20)]), t, "id", key_buckets=4)
    source = keyed.prepared(frame(spark, [(1, "b", 0.5)]), "id", 4)
    plan = keyed.changes(spark.table(t), source, "id")._jdf.queryExecution().executedPlan().toString()
    read = [line for line in plan.split("\n") if "FileScan" in line and "_tm_digest" in line][0]
    assert "ReadSchema: struct<id:bigint,_tm_digest:binary>" in read


def test_digests_are_made_after_the_shuffles(spark, db):
    """A digest doesn't compress: no shuffle of a load carries whole rows with it, and a merge deals its rows once."""
    t = f"{db}.lean"
    UP.upsert(frame(spark, [(i, f"n{i}", 0.5) for i in range(50)] + [(None, "z", -0.0)]), t, "id", key_buckets=4)
    assert {r[0] for r in spark.table(t).select(F.length(keyed.DIGEST)).collect()} == {keyed.KEPT_BYTES}
    load = keyed.prepared(frame(spark, [(1, "new", 0.5), (None, "z", 0.0), (99, "in", 1.0)]), "id", 4).drop(keyed.DIGEST)
    merged = keyed._merged(spark.table(t), load, "id", 3)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    dealt = plan[plan.index("Exchange"):]
    assert plan.count("Exchange") == 1 and "to_json" not in dealt and keyed.DIGEST not in dealt
    got = {r["id"]: (r["name"], str(r["v"])) for r in merged.collect()}
    assert len(got) == 52 and got[1] == ("new", "0.5") and got[99] == ("in", "1.0") and got[None] == ("z", "-0.0")
    digests = merged.select("id", F.col(keyed.DIGEST).alias("d")).join(
        keyed.prepared(merged.drop(keyed.DIGEST, keyed.BUCKET), "id", 4), "id").where(F.col("d") != F.col(keyed.DIGEST))
    assert digests.count() == 0


def test_tables_with_whole_digests_are_understood(spark, db):
    rows = [(i, "a", 1.0) for i in range(5)]
    target = keyed.prepared(frame(spark, rows), "id", 2)
    whole = target.withColumn(keyed.DIGEST, keyed.row_digest(target.drop(keyed.DIGEST, keyed.BUCKET)))
    found = keyed.changes(whole, keyed.prepared(frame(spark, rows[:3] + [(4, "b", 1.0), (9, "a", 1.0)]), "id", 2), "id")
    assert {r["id"]: r["change"] for r in found.collect()} == {0: "ignored", 1: "ignored", 2: "ignored", 4: "updated", 9: "inserted"}


def test_digests_tell_rows_apart(spark):
    rows = [(None, "a", 1.0), (1, None, 1.0), (1, "a", None), (1, "a", 1.0), (1, "a", float("nan")), (1, "", 1.0), (11, "", 1.0), (1, "1", 1.0)]
    digests = [r[0] for r in frame(spark, rows).select(keyed.row_digest(frame(spark, rows))).collect()]
    assert len(set(digests)) == len(rows) and all(len(d) == 32 for d in digests)


def test_keyed_guards(spark, db):
    t, one = f"{db}.g", [(1, "a", 1.0)]
    for kw in ({"key_buckets": 0}, {"key_buckets": keyed.MOST + 1}, {"key_buckets": 4, "buckets": 4}):
        with pytest.raises(InputError):
            UP.upsert(frame(spark, one), t, "id", **kw)
    with pytest.raises(SchemaError):
        UP.upsert(frame(spark, one).withColumn(keyed.DIGEST, F.lit(1)), t, "id", key_buckets=4)
    UP.upsert(frame(spark, one), t, "id", key_buckets=4)
    with pytest.raises(SchemaError):
        UP.upsert(frame(spark, one), t, "name")
    with pytest.raises(DuplicateKeyError):
        UP.upsert(frame(spark, one * 2), t, "id")
    with pytest.raises(SchemaError):
        UP.upsert(frame(spark, one).drop("v"), t, "id")
