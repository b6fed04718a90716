"""Load metadata: per-table summaries and a per-load log.

Each control table is small (one row per table, one per load). Several loads may record themselves
at once (:mod:`tidemill.sinks.claims`): none loses another's row, and no two get one load id.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.errors import InputError
from tidemill.sinks import claims, keyed
from tidemill.sinks.tables import check_name, table_exists, version_path
from tidemill.sinks.upsert import UpsertReport

SUMMARY_TABLES = ("table_id int, table_name string, rows long, columns int, last_updated date")
SUMMARY_LOADS = ("load_id string, table_id int, rows_inserted long, rows_updated long, "
                 "rows_ignored long, updated_at date")
TABLES_SUMMARY = ("table_id int, table_name string, rows long, flow_name string, last_update timestamp_ntz")


def _ensure(spark: SparkSession, table: str, schema: str) -> DataFrame:
    if not table_exists(spark, table):
        try:
            spark.createDataFrame([], schema).write.format("parquet") \
                .option("path", version_path(spark, table)).saveAsTable(table)
        except AnalysisException:
            if not table_exists(spark, table):  # else another load was faster
                raise
    spark.sql(f"REFRESH TABLE {table}")
    return spark.table(table)


def _replace_by(spark: SparkSession, table: str, schema: str, key: str, new_rows: DataFrame) -> DataFrame:
    """Delete rows whose ``key`` is in ``new_rows``, then add ``new_rows``."""
    _ensure(spark, table, schema)

    def replaced(current: DataFrame) -> DataFrame:
        kept = current.join(new_rows.select(key), current[key].eqNullSafe(new_rows[key]), "left_anti")
        return kept.unionByName(new_rows.select(*current.columns))

    return claims.replace_rows(spark, table, replaced)


def table_stats(spark: SparkSession, table: str) -> tuple[int, int]:
    """(rows, columns) of a table; (0, 0) when it does not exist."""
    if not table_exists(spark, table):
        return 0, 0
    t = keyed.read(spark, table)  # without the columns of a keyed table's layout
    return t.count(), len(t.columns)


def record_table_summary(spark: SparkSession, control: str, table_id: int, table_name: str,
                         as_of: dt.date) -> DataFrame:
    """Upsert one ``summary_tables`` row for ``table_name``: rows, columns, date."""
    if not isinstance(table_id, int) or isinstance(table_id, bool):
        raise InputError(1, "record_table_summary: table_id must be an integer")
    rows, ncols = table_stats(spark, check_name(table_name))
    label = table_name.rsplit(".", 1)[-1]
    new = spark.createDataFrame([(table_id, label, rows, ncols, as_of)], SUMMARY_TABLES)
    return _replace_by(spark, control, SUMMARY_TABLES, "table_id", new)


def next_load_id(loads: DataFrame, as_of: dt.date) -> DataFrame:
    """One-row frame: ``YYYYMMDD-N`` with N = 1 + the largest N used on that day.

    N is compared as a number, so after ``-9`` and ``-10`` comes ``-11``.
    """
    day = as_of.strftime("%Y%m%d")
    today = loads.where(F.col("load_id").like(f"{day}-%"))
    n = F.coalesce(F.max(F.split_part(F.col("load_id"), F.lit("-"), F.lit(2)).cast("int")), F.lit(0)) + 1
    return today.agg(F.concat(F.lit(day + "-"), n.cast("string")).alias("load_id"))


def record_load(spark: SparkSession, control: str, table_id: int, report: UpsertReport,
                as_of: dt.date) -> DataFrame:
    """Append one ``summary_loads`` row for an upsert report, under a load id that no other load has."""
    if not isinstance(table_id, int) or isinstance(table_id, bool):
        raise InputError(1, "record_load: table_id must be an integer")
    current = _ensure(spark, control, SUMMARY_LOADS)
    day, n = next_load_id(current, as_of).first()["load_id"].split("-")
    load_id = claims.claimed_id(spark, control, f"{day}-", int(n))
    new = spark.createDataFrame([(load_id, table_id, report.inserted, report.updated,
                                  report.ignored, as_of)], SUMMARY_LOADS)
    claims.append_rows(new, control)
    return spark.table(control)


def record_flow(spark: SparkSession, control: str, table_id: int, table_name: str,
                flow_name: str, as_of: dt.datetime) -> DataFrame:
    """Replace the ``tables_summary`` row of ``table_id``: rows, flow, time."""
    rows, _ = table_stats(spark, check_name(table_name))
    label = table_name.rsplit(".", 1)[-1]
    new = spark.createDataFrame([(table_id, label, rows, flow_name, as_of)], TABLES_SUMMARY)
    return _replace_by(spark, control, TABLES_SUMMARY, "table_id", new)
