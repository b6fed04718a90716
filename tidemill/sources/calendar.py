"""Generated calendar dimension."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.errors import InputError
from tidemill.functions.dates import day_name, month_name


def _parse(text: str):
    try:
        return datetime.strptime(text, "%d-%m-%Y").date()
    except (TypeError, ValueError) as e:
        raise InputError(1, f"create_calendar: '{text}' is not DD-MM-YYYY") from e


def create_calendar(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day from ``start`` to ``end`` inclusive (``DD-MM-YYYY``).

    Columns: Day (date), Week_day (1 = Monday … 7), Week_day_name, Month,
    Month_name (Spanish), Year. Generated by ``spark.range``, which splits across
    tasks, rather than exploding one array in one task.
    """
    d0, d1 = _parse(start), _parse(end)
    if d1 < d0:
        raise InputError(1, "create_calendar: end date is before start date")
    n = (d1 - d0).days + 1
    day = F.date_add(F.lit(d0), F.col("id").cast("int"))
    return (spark.range(n).select(day.alias("Day"))
            .select("Day",
                    (F.weekday("Day") + 1).cast("long").alias("Week_day"),
                    day_name(F.col("Day")).alias("Week_day_name"),
                    F.month("Day").cast("long").alias("Month"),
                    month_name(F.col("Day")).alias("Month_name"),
                    F.year("Day").cast("long").alias("Year")))
