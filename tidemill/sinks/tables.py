"""Catalog tables stored as Parquet in version folders under their database's location.

A full rewrite writes a new version ``<database>/<name>.versions/v-<id>`` and then points the
table at it (``ALTER TABLE … SET LOCATION``), so a failed or lost job leaves the previous
version intact and a reader never sees a half-written table. Old versions stay for readers
that still use them; :func:`drop_old_versions` removes them.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.errors import InputError, SchemaError, TableError
from tidemill.session import discard, staged

_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?$")

# For each type, the types that hold all of its values.
_WIDER = {
    "tinyint": {"smallint", "int", "bigint", "float", "double"},
    "smallint": {"int", "bigint", "float", "double"},
    "int": {"bigint", "double"},
    "float": {"double"},
    "date": {"timestamp", "timestamp_ntz"},
}
_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


def check_name(table: str) -> str:
    if not isinstance(table, str) or not _NAME.match(table):
        raise InputError(1, f"invalid table name {table!r}")
    return table


def _versions(spark: SparkSession, table: str) -> str:
    database, _, name = check_name(table).rpartition(".")
    place = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    return f"{place.rstrip('/')}/{name}.versions"


def versions_of(spark: SparkSession, table: str) -> str:
    """The folder of a table's versions."""
    return _versions(spark, table)


def location(spark: SparkSession, table: str) -> str:
    """The folder that the table points at now."""
    return {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {check_name(table)}").collect()}["Location"]


def version_path(spark: SparkSession, table: str) -> str:
    return f"{_versions(spark, table)}/v-{uuid.uuid4().hex[:12]}"


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(check_name(table))


def switch_location(spark: SparkSession, table: str, path: str) -> None:
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    spark.sql(f"REFRESH TABLE {table}")


def _widens(given: T.DataType, stored: T.DataType) -> bool:
    a, b = given.simpleString(), stored.simpleString()
    if a == b or isinstance(given, T.NullType) or b in _WIDER.get(a, ()):
        return True
    if isinstance(stored, T.DecimalType):
        whole = given.precision - given.scale if isinstance(given, T.DecimalType) else _DIGITS.get(a)
        scale = given.scale if isinstance(given, T.DecimalType) else 0
        return whole is not None and whole <= stored.precision - stored.scale and scale <= stored.scale
    return False


def align(source: DataFrame, target: DataFrame, op: str = "upsert") -> DataFrame:
    """Source columns in target order and types; other columns, or types that would lose values, are errors."""
    if set(source.columns) != set(target.columns):
        raise SchemaError(2, f"{op}: source columns {source.columns} differ from target {target.columns}")
    given = {f.name: f.dataType for f in source.schema}
    lossy = [f"{f.name}: {given[f.name].simpleString()} to {f.dataType.simpleString()}"
             for f in target.schema if not _widens(given[f.name], f.dataType)]
    if lossy:
        raise SchemaError(3, f"{op}: the table's types can't hold the source's: {lossy}")
    return source.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in target.schema.fields])


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def bucket_spec(spark: SparkSession, table: str) -> tuple[int, list[str]] | None:
    """``(buckets, columns)`` of a bucketed table, else None."""
    cols = [c.name for c in spark.catalog.listColumns(table) if c.isBucket]
    if not cols:
        return None
    info = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    return int(info["Num Buckets"]), cols


def save_as(df: DataFrame, table: str, partition_by: list[str] | None = None,
            buckets: tuple[int, list[str]] | None = None, last: Callable[[DataFrame], DataFrame] | None = None) -> str:
    """Write ``df`` as a new table in a version folder; return the folder. ``last`` adds columns to rows that are dealt out.

    About one file for each partition or bucket: the ``rebalance`` hint lets AQE split a hot
    partition over several tasks; buckets are dealt out by their own hash.
    """
    path = version_path(df.sparkSession, table)
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    elif buckets:
        df = df.repartition(buckets[0], *[F.col(f"`{c}`") for c in buckets[1]])
    if last:
        df = last(df)
    writer = df.write.format("parquet").option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if buckets:
        writer = writer.bucketBy(buckets[0], *buckets[1]).sortBy(*buckets[1])
    writer.saveAsTable(table)
    return path


def write_version(df: DataFrame, table: str, buckets: tuple[int, list[str]] | None = None) -> str:
    """Write ``df`` to a new version folder of ``table`` (bucketed when asked); return its path."""
    if not buckets:
        path = version_path(df.sparkSession, table)
        df.write.mode("error").parquet(path)
        return path
    # bucketed files can only be written through the catalog: write them as a
    # scratch external table, then forget the table and keep the files
    scratch = f"{table}__v{uuid.uuid4().hex[:8]}"
    path = save_as(df, scratch, buckets=buckets)
    df.sparkSession.sql(f"DROP TABLE {scratch}")
    return path


def drop_old_versions(spark: SparkSession, table: str) -> list[str]:
    """Delete the version folders that ``table`` doesn't point at; return them. No reader may use them any more."""
    current = location(spark, table)
    folder = spark._jvm.org.apache.hadoop.fs.Path(_versions(spark, table))
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    old = []
    for status in fs.listStatus(folder) if fs.exists(folder) else []:
        if status.getPath().getName() != current.rstrip("/").rsplit("/", 1)[-1]:
            old.append(status.getPath().toString())
            fs.delete(status.getPath(), True)
    return old


def overwrite_partitions(rows: Callable[[SparkSession], DataFrame], spark: SparkSession, table: str, mode: str,
                         dealt: bool = False) -> None:
    """Overwrite partitions of ``table`` (``static``: all, ``dynamic``: those in the rows) with ``rows(session)``.

    ``dealt``: the rows already lie in ranges of the partition columns. The mode is set in a session of this write alone, so loads in one session don't disturb each
    other. Only a dynamic overwrite may read the table itself: new files lie apart until all tasks are done, then the
    partitions are swapped.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    df = rows(own) if dealt else rows(own).hint("rebalance", *partition_columns(own, table))
    df.select(*[F.col(f"`{c}`") for c in own.table(table).columns]).write.insertInto(table, overwrite=True)
    spark.sql(f"REFRESH TABLE {table}")


def create_table(df: DataFrame, table: str, partition_by: list[str] | None = None,
                 preview: int = 5) -> DataFrame:
    """Create ``table`` from ``df`` in place of any table of that name; return the first rows as a preview.

    The new table is written under a scratch name first: a failed write leaves the old one.
    """
    spark = df.sparkSession
    check_name(table)
    if df.isEmpty():
        raise InputError(1, f"create_table: nothing to load into {table}")
    scratch = f"{table}__v{uuid.uuid4().hex[:8]}"
    save_as(df, scratch, partition_by)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"ALTER TABLE {scratch} RENAME TO {table}")
    return spark.table(table).limit(preview)


def replace_table(df: DataFrame, table: str) -> DataFrame:
    """Replace every row of an existing table (code 1 if it does not exist).

    The new rows are stored first, in the table's own layout, so ``df`` may itself read the
    table being replaced.
    """
    spark = df.sparkSession
    if not table_exists(spark, table):
        raise TableError(1, f"replace_table: table {table} does not exist")
    target = spark.table(table)
    if target.columns != df.columns:
        raise TableError(2, f"replace_table: columns {df.columns} differ from {target.columns}")
    typed = align(df, target, "replace_table")
    if partition_columns(spark, table):
        stored, path = staged(typed, "replace")
        overwrite_partitions(lambda own: own.read.schema(stored.schema).parquet(path), spark, table, "static")
        discard(spark, path)
    else:
        switch_location(spark, table, write_version(typed, table, bucket_spec(spark, table)))
    return spark.table(table)
