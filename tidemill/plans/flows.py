"""The four ready flows. Each returns the frame to load; ``load_*`` also loads it.

Every step is lazy except the few checks that need data (category set, date
and key validity, duplicate branch), each one aggregate job.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.errors import DuplicateKeyError, KeyFormatError
from tidemill.operators.columns import (KEY_PATTERN, category_codes, category_codes_many, date_flags, parse_date,
                                        raise_date_violations, rename_columns, surrogate_key,
                                        unique_suffix)
from tidemill.operators.quality import conform_types, duplicate_report, null_report
from tidemill.operators.relational import group_by, join_tables
from tidemill.sinks.summary import record_load, record_table_summary
from tidemill.sinks.upsert import UpsertReport, upsert
from tidemill.sources.calendar import create_calendar

log = logging.getLogger(__name__)


def _warn_nulls(df: DataFrame, checks: bool) -> None:
    """Warn of every column with nulls: one aggregate, one line for each column."""
    if checks:
        for r in null_report(df).collect():
            log.warning("nulls: %s", r.asDict())


def _require_unique(df: DataFrame, key: str, checks: bool, sample: int = 20) -> None:
    """Duplicate keys stop the flow: exact counts from one aggregate, some keys in the message."""
    if checks:
        copies = duplicate_report(df, key)
        found = copies.agg(F.count(F.lit(1)).alias("keys"), F.sum("copies").alias("rows")).first()
        if found["keys"]:
            some = [r["value"] for r in copies.limit(sample).collect()]
            raise DuplicateKeyError(2, f"{found['keys']} values of '{key}' are on {found['rows']} rows, e.g. {some}")


def outlets_dimension(outlets: DataFrame, postcodes: DataFrame, *, rename: Mapping[str, str],
                      postcode_key: str, postcode_aggs: Mapping[str, str],
                      outlet_order: Sequence[str | Column], postcode_order: Sequence[str | Column],
                      location_col: str, size_col: str, size_codes: Mapping[str, int],
                      key: str, expected_types: Mapping[str, str] | None = None,
                      checks: bool = True, location_codes: DataFrame | None = None) -> DataFrame:
    """rename → auto codes → fixed codes → postcodes FIRST per key → LEFT join
    → null report, unique keys → conform types.

    The postcodes are aggregated to one row per key, so the LEFT join keeps
    the outlet rows one to one; the category codes are therefore computed on
    the outlets alone, and their data checks scan only the outlet source.
    ``location_codes`` (``value, code``; see ``category_mapping``) keeps the codes of an
    earlier load, whatever the row order of this one.
    """
    df = rename_columns(outlets, rename)
    if location_codes is None:
        # both category columns from one aggregate job over the outlets
        df = category_codes_many(df, {location_col: None, size_col: size_codes}, order_by=outlet_order)
    else:
        df = category_codes(df, location_col, mapping=location_codes)
        df = category_codes(df, size_col, cat_map=size_codes)
    pc = group_by(postcodes, postcode_key, postcode_aggs, order_by=postcode_order)
    df = join_tables(postcode_key, "LEFT", df, pc)
    _warn_nulls(df, checks)
    _require_unique(df, key, checks)
    return conform_types(df, expected_types) if expected_types else df


def products_dimension(products: DataFrame, *, key: str, order_by: Sequence[str | Column],
                       expected_types: Mapping[str, str] | None = None,
                       checks: bool = True) -> DataFrame:
    """(null report) → de-duplicate the key by suffix only if it has duplicates → conform."""
    _warn_nulls(products, checks)
    df = products
    if duplicate_report(products, key).limit(1).count():
        df = unique_suffix(df, key, order_by)
    return conform_types(df, expected_types) if expected_types else df


def daily_facts(facts: DataFrame, *, day_col: str, key: str, order_by: Sequence[str | Column],
                date_format: str = "YYYYMMDD", checks: bool = True) -> DataFrame:
    """null report → surrogate key from the day + occurrence → parse the day.
    The key is unique as dates have one length; the load checks it. Output: range partitions in day order, rows sorted by
    (day, order) inside each — the layout a date-pruned fact table wants.

    The day column is both the key source and the date, so one aggregate over
    its distinct values checks key validity (code 3) and date validity (3, 4, 9,
    in that order), with exact counts. The numbering leaves the rows in day order,
    however many rows a day has.
    """
    _warn_nulls(facts, checks)
    day_txt = F.col(day_col).cast("string")
    per_day = facts.groupBy(day_txt.alias("v")).agg(F.count(F.lit(1)).alias("rows"))
    v = F.col("v")
    kinds = {"bad_key": v.isNull() | ~v.rlike(KEY_PATTERN),
             **dict(zip(("bad_length", "non_digit", "unparseable"), date_flags(F.trim(v), date_format)))}
    found = per_day.agg(
        *[F.coalesce(F.sum(F.when(f, F.col("rows"))), F.lit(0)).alias(n) for n, f in kinds.items()],
        *[F.min(F.when(f, F.coalesce(v, F.lit("<null>")))).alias(f"{n}_sample") for n, f in kinds.items()]).first()
    if found["bad_key"]:
        raise KeyFormatError(3, f"surrogate_key: {found['bad_key']} invalid values in '{day_col}', "
                                f"e.g. '{found['bad_key_sample']}'")
    raise_date_violations(found, day_col, date_format)
    df = surrogate_key(facts, day_col, order_by, name=key, validate=False)
    # the numbering window already sorted each partition by (day text, order),
    # and fixed-width day text sorts like the date: no second sort is needed
    df = parse_date(df, day_col, date_format, on_error="null")
    return df


def calendar_dimension(holidays: DataFrame, *, start: str, end: str, day_col: str = "Day",
                       day_format: str = "DDMMYYYY",
                       expected_types: Mapping[str, str] | None = None) -> DataFrame:
    """holidays (Day as DDMMYYYY digits) → parse → calendar → FULL join on Day → conform."""
    spark = holidays.sparkSession
    hol = parse_date(holidays, day_col, day_format)
    cal = create_calendar(spark, start, end)
    df = join_tables(day_col, "FULL", cal, hol)
    return conform_types(df, expected_types) if expected_types else df


def load(df: DataFrame, table: str, table_id: int, key: str, *, summary_table: str,
         loads_table: str, as_of: dt.date, partition_by: list[str] | None = None,
         buckets: int | None = None, key_buckets: int | None = None) -> UpsertReport:
    """Upsert into ``table`` and record the load in both control tables.

    Facts: ``partition_by`` the day, so a load rewrites only its days.
    Dimensions: ``buckets`` on the first load buckets the table by key, so
    later loads shuffle only the incoming rows; ``key_buckets`` makes a keyed table, whose later
    loads rewrite only the buckets that change.
    """
    report = upsert(df, table, key, partition_by=partition_by, buckets=buckets, key_buckets=key_buckets)
    spark = df.sparkSession
    record_table_summary(spark, summary_table, table_id, table, as_of)
    record_load(spark, loads_table, table_id, report, as_of)
    return report
