"""tidemill — Spark-native batch data preparation and warehouse loading.

Every operator is ``DataFrame -> DataFrame`` (usable with ``df.transform``) and is
expressed with built-in Spark SQL functions, so Catalyst can push filters and
prune columns into the scans and whole-stage codegen can fuse the expressions.
Failures raise :class:`tidemill.errors.StepError` subclasses carrying the
numeric code of the original step.
"""

from tidemill.errors import StepError  # noqa: F401
from tidemill.operators.columns import (category_codes, category_codes_many, category_mapping,  # noqa: F401
                                        fill_nulls, parse_date, rename_columns, surrogate_key,
                                        unique_suffix)
from tidemill.operators.holidays import merge_holidays  # noqa: F401
from tidemill.operators.quality import conform_types, duplicate_report, null_report  # noqa: F401
from tidemill.operators.relational import group_by, join_tables  # noqa: F401
from tidemill.operators.sort import sort_dates  # noqa: F401
from tidemill.session import get_spark, stage, work_dir  # noqa: F401
from tidemill.sinks.tables import create_table, replace_table  # noqa: F401
from tidemill.sinks.upsert import merge_plan, upsert  # noqa: F401
from tidemill.sources.calendar import create_calendar  # noqa: F401
from tidemill.sources.csv import extract_csv, with_row_order  # noqa: F401
from tidemill.sources.json import extract_json  # noqa: F401

__all__ = ["StepError", "category_codes", "category_codes_many", "category_mapping", "fill_nulls",
           "parse_date", "rename_columns", "surrogate_key", "unique_suffix", "merge_holidays",
           "conform_types", "duplicate_report", "null_report", "group_by", "join_tables", "sort_dates",
           "get_spark", "stage", "work_dir", "create_table", "replace_table", "merge_plan", "upsert",
           "create_calendar", "extract_csv", "with_row_order", "extract_json"]
