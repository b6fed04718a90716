"""Keyed upsert with a change report.

``merge_plan`` is the whole decision as one lazy plan: a full outer join of
target and source on the key, a null-safe comparison of all non-key columns
as one struct, and a class per key — ``inserted`` (only in the source),
``updated`` (in both, different), ``ignored`` (in both, equal) and ``retained``
(only in the target). Keys are unique on both sides (checked), so the join has
no hot key; AQE picks broadcast or sort-merge from the runtime sizes.

``upsert`` writes that plan once. The counts come out of the same write through
``observe`` — the join is not run a second time for the report.

* unpartitioned table: all rows go to a new version folder, then the table is
  switched to it;
* partitioned table: the partitions that the source's rows belong to and those that
  hold its keys now are merged and stored, then written back with dynamic partition
  overwrite; a partition that a moved key leaves empty is dropped, every other one is
  left untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemill.errors import DuplicateKeyError, InputError, SchemaError
from tidemill.operators._checks import ref, require_columns
from tidemill.session import discard, staged
from tidemill.sinks import keyed
from tidemill.sinks.tables import (align, bucket_spec, check_name, overwrite_partitions, partition_columns, save_as,
                                   switch_location, table_exists, write_version)

CHANGE = "change"
MAX_LITERAL_PARTITIONS = 10_000   # up to this many touched values are inlined as a literal filter
CLASSES = ("inserted", "updated", "ignored", "retained")


@dataclass(frozen=True)
class UpsertReport:
    table: str
    inserted: int
    updated: int
    ignored: int
    retained: int

    def as_row(self) -> tuple:
        return (self.table, self.inserted, self.updated, self.ignored, self.retained)


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """``(key, copies)`` for keys present more than once; null keys count as equal."""
    require_columns(df, [key], "duplicate_keys")
    return df.groupBy(ref(key).alias(key)).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def check_source(df: DataFrame, key: str, sample: int = 20) -> tuple[int, bool]:
    """Non-empty and unique by key — one aggregate job (per-key counts, partially
    aggregated, then summed); a bounded sample of duplicates only on failure. Returns the number of rows, and whether one has a null key."""
    per_key = df.groupBy(ref(key).alias("key")).agg(F.count(F.lit(1)).alias("copies"))
    stats = per_key.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("rows"),
                        F.count_if(F.col("copies") > 1).alias("dup_keys"),
                        F.count_if(F.col("key").isNull()).alias("null_keys")).first()
    if not stats["rows"]:
        raise InputError(1, "upsert: source frame is empty")
    if stats["dup_keys"]:
        dups = [r[0] for r in per_key.where(F.col("copies") > 1).limit(sample).collect()]
        raise DuplicateKeyError(2, f"upsert: {stats['dup_keys']} duplicate keys in source, e.g. {dups}")
    return stats["rows"], stats["null_keys"] > 0


def merge_plan(target: DataFrame, source: DataFrame, key: str, null_key: bool = True) -> DataFrame:
    """Rows of the merged table plus a ``change`` column (one of ``CLASSES``).

    One equi-join. ``null_key`` tells whether the source may hold a null key: only then does the
    join also match nulls. Without, a target bucketed (or already partitioned) by the key is not
    shuffled; its own null key has no partner and is retained.
    """
    source = align(source, target)
    cols = target.columns
    ki = cols.index(key)
    rest = [i for i, c in enumerate(cols) if c != key]
    t = target.select(*[ref(c).alias(f"t_{i}") for i, c in enumerate(cols)], F.lit(True).alias("t_hit"))
    s = source.select(*[ref(c).alias(f"s_{i}") for i, c in enumerate(cols)], F.lit(True).alias("s_hit"))
    tk, sk = F.col(f"t_{ki}"), F.col(f"s_{ki}")
    j = t.join(s, tk.eqNullSafe(sk) if null_key else tk == sk, "full")
    t_vals = F.struct(*[F.col(f"t_{i}") for i in rest]) if rest else F.lit(0)
    s_vals = F.struct(*[F.col(f"s_{i}") for i in rest]) if rest else F.lit(0)
    in_t, in_s = F.col("t_hit").isNotNull(), F.col("s_hit").isNotNull()
    change = (F.when(in_s & ~in_t, F.lit("inserted"))
              .when(in_s & in_t & ~t_vals.eqNullSafe(s_vals), F.lit("updated"))
              .when(in_s & in_t, F.lit("ignored"))
              .otherwise(F.lit("retained")))
    out = [F.when(in_s, F.col(f"s_{i}")).otherwise(F.col(f"t_{i}")).alias(c) for i, c in enumerate(cols)]
    return j.select(*out, change.alias(CHANGE))


def change_counts(plan: DataFrame) -> DataFrame:
    """One row: inserted, updated, ignored, retained (all classes, zero included)."""
    return plan.agg(*[F.count_if(F.col(CHANGE) == c).alias(c) for c in CLASSES])


def _observed(plan: DataFrame, name: str):
    obs = Observation(name)
    return plan.observe(obs, *[F.count_if(F.col(CHANGE) == c).alias(c) for c in CLASSES]), obs


def upsert(df: DataFrame, table: str, key: str | None = None,
           partition_by: list[str] | None = None, buckets: int | None = None, key_buckets: int | None = None) -> UpsertReport:
    """Insert new keys, replace changed rows, keep the rest; report the counts.

    ``key`` defaults to the first column. Creates the table on first load;
    ``buckets`` (first load only) buckets it by the key, so later loads shuffle
    only the incoming rows. ``partition_by`` rewrites only the partitions the
    source touches. ``key_buckets`` (first load only) makes it a keyed table (:mod:`tidemill.sinks.keyed`): later loads
    read the key and the digest of rows in their own buckets, and rewrite only buckets that change.
    """
    spark = df.sparkSession
    check_name(table)
    key = key or df.columns[0]
    require_columns(df, [key], "upsert")
    if sum(x is not None for x in (buckets, partition_by, key_buckets)) > 1:
        raise InputError(1, "upsert: choose one of buckets, partition_by and key_buckets")
    rows, null_key = check_source(df, key)
    if key_buckets is not None and not table_exists(spark, table):
        keyed.create(df, table, key, key_buckets)
        return UpsertReport(table, rows, 0, 0, 0)
    if not table_exists(spark, table):
        obs = Observation(f"first_{table}")
        save_as(df.observe(obs, F.count(F.lit(1)).alias("n")), table, partition_by, (buckets, [key]) if buckets else None)
        return UpsertReport(table, int(obs.get["n"]), 0, 0, 0)
    if keyed.layout(spark, table):
        counts = keyed.merge(df, table, key, rows)
        return UpsertReport(table, *[counts[c] for c in CLASSES])
    target = spark.table(table)
    # an existing table's own layout decides how it is rewritten
    parts = partition_columns(spark, table)
    if partition_by and sorted(partition_by) != sorted(parts):
        raise SchemaError(3, f"upsert: {table} is partitioned by {parts}, not {partition_by}")
    if parts:
        return _upsert_partitions(spark, align(df, target), target, table, key, parts, rows, null_key)
    plan, obs = _observed(merge_plan(target, df, key, null_key), f"upsert_{table}")
    path = write_version(plan.drop(CHANGE), table, bucket_spec(spark, table))
    report = _report(table, obs.get, rows)
    switch_location(spark, table, path)
    return report


def _report(table: str, counts: dict, rows: int) -> UpsertReport:
    """The report of a merge; a source row that met several rows shows a key that the table has twice."""
    if counts["inserted"] + counts["updated"] + counts["ignored"] != rows:
        raise DuplicateKeyError(2, f"upsert: {table} holds keys of the source more than once")
    return UpsertReport(table, *[counts[c] for c in CLASSES])


def _same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    cond = F.lit(True)
    for n in names:
        cond = cond & left[f"`{n}`"].eqNullSafe(right[f"`{n}`"])
    return cond


def _touched_partitions(target: DataFrame, touched: DataFrame, parts: list[str]) -> DataFrame:
    """Target rows in the partitions that ``touched`` lists.

    A short list over one column becomes a literal filter, which prunes the scan when the query
    is planned; a longer one a semi join, in which Spark can prune at run time.
    """
    values = touched.select(*[ref(p) for p in parts]).distinct()
    if len(parts) == 1:
        found = [r[0] for r in values.limit(MAX_LITERAL_PARTITIONS + 1).collect()]
        if len(found) <= MAX_LITERAL_PARTITIONS:
            p = ref(parts[0])
            cond = p.isin([v for v in found if v is not None])
            return target.where(cond | p.isNull() if None in found else cond)
    return target.join(values, _same(target, values, parts), "left_semi")


def _upsert_partitions(spark: SparkSession, source: DataFrame, target: DataFrame, table: str,
                       key: str, parts: list[str], rows: int, null_key: bool) -> UpsertReport:
    """Merge the partitions that the source's rows belong to, or that hold its keys, and overwrite just those.

    Where the keys are now is found from the target's key column alone. The list of these
    partitions joins the target on its partition columns, so the scan of the rest is pruned.
    The merged rows are stored before any partition is replaced.
    """
    keys = source.select(ref(key))
    now = target.select(*[ref(p) for p in parts], ref(key))
    now = now.join(keys, _same(now, keys, [key]), "left_semi").select(*[ref(p) for p in parts]).distinct()
    touched, touched_at = staged(source.select(*[ref(p) for p in parts]).union(now).distinct(), "touched")
    old = _touched_partitions(target, touched, parts)
    plan, obs = _observed(merge_plan(old, source, key, null_key), f"upsert_{table}")
    merged, merged_at = staged(plan.drop(CHANGE), "merged")
    report = _report(table, obs.get, rows)
    overwrite_partitions(lambda own: own.read.schema(merged.schema).parquet(merged_at), spark, table, "dynamic")
    kept = merged.select(*[ref(p) for p in parts]).distinct()
    for gone in touched.join(kept, _same(touched, kept, parts), "left_anti").collect():
        spec = ", ".join(f"`{p}` = {_literal(gone[p])}" for p in parts)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
    for place in (touched_at, merged_at):
        discard(spark, place)
    return report


def _literal(value) -> str:
    if value is None:
        return "null"
    return str(value) if isinstance(value, (int, float)) and not isinstance(value, bool) else "'{}'".format(
        str(value).replace("\\", "\\\\").replace("'", "\\'"))
