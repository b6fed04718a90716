"""Keyed tables: dimensions whose loads rewrite only the key buckets they change.

A keyed table is partitioned by a hash bucket of its key and holds a digest of every row. Both are kept in two
columns after the table's own (:func:`read` leaves them out). A load

1. is checked and stored once, with its buckets;
2. meets the target's rows in its own buckets by key and digest, and no other column: that counts new, changed and equal
   rows by bucket, and stores nothing;
3. writes the buckets that have new or changed rows, once, by dynamic partition overwrite: their rows and the load's are
   dealt in ranges of bucket and key, and of two rows of a key one is left. The files of all other buckets stay as
   they are, and a load that changes nothing writes nothing.

The digest is the first 16 bytes of SHA-256 over the row's values as JSON with null fields, in UTC with microseconds, and
with zeros of one sign: equal for rows that ``<=>`` finds equal. It doesn't compress, so rows go through shuffles and the
load's store without it, and it is made where they are written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.errors import DuplicateKeyError, InputError, SchemaError
from tidemill.operators._checks import ref, require_columns
from tidemill.session import discard, staged
from tidemill.sinks.tables import align, check_name, overwrite_partitions, save_as

BUCKET, DIGEST = "_tm_bucket", "_tm_digest"
_KEY, _BUCKETS = "tidemill.key", "tidemill.key_buckets"
#: Buckets of a table: a list of them is collected and inlined as a filter.
MOST = 10_000
#: Bytes of a digest that a table holds; about how many rows one task merges.
KEPT_BYTES, PART_ROWS = 16, 1_000_000
CHANGE = "change"
_NEW, _LEFT = "_tm_new", "_tm_left"


def layout(spark: SparkSession, table: str) -> tuple[str, int] | None:
    """``(key, buckets)`` of a keyed table, else None."""
    found = {r[0]: r[1] for r in spark.sql(f"SHOW TBLPROPERTIES {check_name(table)}").collect()}
    return (found[_KEY], int(found[_BUCKETS])) if _BUCKETS in found else None


def read(spark: SparkSession, table: str) -> DataFrame:
    """The table's own columns."""
    return spark.table(table).drop(BUCKET, DIGEST)


def row_digest(df: DataFrame, size: int = 32) -> Column:
    """32 bytes (or the first ``size``) that are equal for equal rows of ``df``."""
    values = []
    for f in df.schema:
        c = ref(f.name)
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            c = F.when(c == 0, F.lit(0).cast(f.dataType)).otherwise(c)
        values.append(c.alias(f.name))
    options = {"ignoreNullFields": "false", "timeZone": "UTC", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
               "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    digits = F.sha2(F.to_json(F.struct(*values), options), 256)
    return F.unhex(digits if size == 32 else F.substring(digits, 1, 2 * size))


def _bucketed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """``df`` with its bucket; null keys have one too."""
    return df.select(*[ref(c) for c in df.columns], F.pmod(F.xxhash64(ref(key)), F.lit(buckets)).cast("int").alias(BUCKET))


def _digested(bucketed: DataFrame) -> DataFrame:
    """Bucketed rows with their digest before the bucket; other columns of the layout's are left out."""
    own = bucketed.drop(BUCKET)
    return bucketed.select(*[ref(c) for c in own.columns], row_digest(own, KEPT_BYTES).alias(DIGEST), BUCKET)


def prepared(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """``df`` with digest and bucket; null keys have a bucket too."""
    return _digested(_bucketed(df, key, buckets))


def changes(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """``source`` with ``change`` (inserted, updated, ignored). Both sides prepared; of the target, key and digest are read alone."""
    # tables of earlier versions hold the whole digest
    known = target.select(ref(key).alias("_tm_key"), F.substring(F.col(DIGEST), 1, KEPT_BYTES).alias("_tm_known"))
    kind = (F.when(F.col("_tm_known").isNull(), "inserted").when(F.col("_tm_known") == F.col(DIGEST), "ignored")
            .otherwise("updated"))
    return source.join(known, ref(key).eqNullSafe(F.col("_tm_key")), "left").withColumn(CHANGE, kind).drop("_tm_key", "_tm_known")


def create(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """A new keyed table of the rows of ``df``, whose keys are unique."""
    if not 1 <= buckets <= MOST:
        raise InputError(1, f"keyed tables have 1 to {MOST} buckets, not {buckets}")
    if {BUCKET, DIGEST} & set(df.columns):
        raise SchemaError(2, f"columns {BUCKET} and {DIGEST} are the table's own")
    require_columns(df, [key], "keyed.create")
    save_as(_bucketed(df, key, buckets), table, [BUCKET], last=_digested)
    # two statements of the catalog, after the rows: a table without the properties is an ordinary partitioned one
    df.sparkSession.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{_KEY}' = '{key}', '{_BUCKETS}' = '{buckets}')")


def _merged(stored: DataFrame, load: DataFrame, key: str, parts: int) -> DataFrame:
    """The rows of ``stored`` and of the bucketed ``load``, one of each key: the stored one where both are equal.

    Keys are unique on both sides. Ranges of bucket and key hold whole keys and few buckets, so one shuffle both
    merges the rows and leaves about one file for each bucket or range.
    """
    both = stored.drop(DIGEST).withColumn(_NEW, F.lit(False)).unionByName(load.withColumn(_NEW, F.lit(True)))
    both = both.repartitionByRange(parts, BUCKET, ref(key))
    rows = both.withColumn(DIGEST, row_digest(both.drop(BUCKET, _NEW), KEPT_BYTES))
    of_key = Window.partitionBy(BUCKET, ref(key))
    equal = F.min(DIGEST).over(of_key) == F.max(DIGEST).over(of_key)
    left = (F.count(F.lit(1)).over(of_key) == 1) | (F.col(_NEW) != equal)
    return rows.withColumn(_LEFT, left).where(_LEFT).drop(_LEFT, _NEW)


def merge(df: DataFrame, table: str, key: str, rows: int) -> dict[str, int]:
    """Load ``df`` (``rows`` rows, unique by ``key``) into a keyed table; the counts of inserted, updated, ignored and retained rows."""
    spark = df.sparkSession
    own_key, buckets = layout(spark, table)
    if key != own_key:
        raise SchemaError(3, f"upsert: {table} is keyed by {own_key}, not {key}")
    stored = spark.table(table)
    source, place = staged(_bucketed(align(df, read(spark, table)), key, buckets), "load")
    try:
        touched = [r[0] for r in source.select(BUCKET).distinct().collect()]
        marked = changes(stored.where(F.col(BUCKET).isin(touched)), _digested(source).select(ref(key), DIGEST, BUCKET), key)
        found = marked.groupBy(CHANGE, BUCKET).agg(F.count(F.lit(1)).alias("n")).collect()
        counts = {c: sum(r["n"] for r in found if r[CHANGE] == c) for c in ("inserted", "updated", "ignored")}
        if sum(counts.values()) != rows:
            raise DuplicateKeyError(2, f"upsert: {table} holds keys of the source more than once")
        total = stored.count()
        counts["retained"] = total - counts["updated"] - counts["ignored"]
        dirty = sorted({r[BUCKET] for r in found if r[CHANGE] != "ignored"})
        if dirty:
            parts = -(-(total + rows) * len(dirty) // (buckets * PART_ROWS))

            def merged(own: SparkSession) -> DataFrame:
                changed = F.col(BUCKET).isin(dirty)
                load = own.read.schema(source.schema).parquet(place).where(changed)
                return _merged(own.table(table).where(changed), load, key, max(1, parts))

            overwrite_partitions(merged, spark, table, "dynamic", dealt=True)
        return counts
    finally:
        discard(spark, place)
