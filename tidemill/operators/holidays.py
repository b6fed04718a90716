"""Holiday entries → one row per day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators._checks import require_columns

# Type labels, the national region label and the separators.
NATIONAL, REGIONAL, ALL_REGIONS = "Nacional", "Regional", "Todas"
COMMENT_SEPARATOR = "; "


def merge_holidays(entries: DataFrame, order_by: Sequence[str | Column],
                   day: str = "Day", name: str = "Name", htype: str = "Type",
                   region: str = "Region", comments: str = "Comments") -> DataFrame:
    """Merge ``(Day, Name, Type, Region, Comments)`` entries to one row per day.

    Type is Nacional if any entry is. Names and comments are distinct non-empty
    values in first-seen ``order_by`` order. Nacional → Name = first name, Region
    ``[Todas]``, Comments = comments. Regional → Name = first name, Region = sorted
    distinct regions, Comments = the other names then the comments. Joined with
    ``"; "``. ``Region`` is ``array<string>``.

    Values are de-duplicated per (day, value) with a partial aggregate before
    anything is gathered per day, so a day's row holds only distinct values.
    """
    require_columns(entries, [day, name, htype, region, comments], "merge_holidays")
    ordc = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order_by])
    items = entries.select(
        F.col(day).alias("d"), ordc.alias("o"),
        F.explode(F.array(
            F.struct(F.lit("n").alias("k"), F.col(name).cast("string").alias("v")),
            F.struct(F.lit("c").alias("k"), F.col(comments).cast("string").alias("v")),
            F.struct(F.lit("r").alias("k"), F.col(region).cast("string").alias("v")),
            F.struct(F.lit("t").alias("k"), F.col(htype).cast("string").alias("v")),
        )).alias("it"))
    items = items.where(F.col("it.v").isNotNull() & ((F.col("it.v") != "") | (F.col("it.k") == "r")))
    firsts = items.groupBy("d", F.col("it.k").alias("k"), F.col("it.v").alias("v")).agg(F.min("o").alias("o"))

    def seen(kind: str) -> Column:
        lst = F.array_sort(F.collect_list(F.when(F.col("k") == kind, F.struct("o", "v"))))
        return F.transform(lst, lambda s: s["v"])

    per_day = firsts.groupBy("d").agg(
        seen("n").alias("names"), seen("c").alias("comments"),
        F.array_sort(F.collect_set(F.when(F.col("k") == "r", F.col("v")))).alias("regions"),
        F.bool_or((F.col("k") == "t") & (F.col("v") == NATIONAL)).alias("national"))
    first_name = F.coalesce(F.element_at("names", 1), F.lit(""))
    others = F.slice("names", 2, F.greatest(F.size("names") - 1, F.lit(0)))
    return per_day.select(
        F.col("d").alias(day),
        first_name.alias(name),
        F.when(F.col("national"), F.lit(NATIONAL)).otherwise(F.lit(REGIONAL)).alias(htype),
        F.when(F.col("national"), F.array(F.lit(ALL_REGIONS))).otherwise(F.col("regions")).alias(region),
        F.when(F.col("national"), F.array_join("comments", COMMENT_SEPARATOR))
        .otherwise(F.array_join(F.concat(others, F.col("comments")), COMMENT_SEPARATOR)).alias(comments),
    )


def in_day_order(merged: DataFrame, day: str = "Day") -> DataFrame:
    """Sort merged holidays by their ``DD-MM-YYYY`` day as a date (for the JSON file)."""
    return merged.orderBy(F.to_date(F.col(day), "dd-MM-yyyy"))
