"""Sorting by a date column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from tidemill.errors import InputError, SortError
from tidemill.functions.ordinal import occurrence_number
from tidemill.operators._checks import ref, refs, is_datelike, require_columns, require_frame


def _order(col: str, order: str, then_by: Sequence[str | Column]) -> list[Column]:
    if not isinstance(order, str) or order.upper() not in ("ASC", "DES"):
        raise SortError(3, "sort_dates: order must be 'ASC' or 'DES'")
    first = ref(col).asc_nulls_last() if order.upper() == "ASC" else ref(col).desc_nulls_last()
    return [first, *refs(then_by)]


def _check(df: DataFrame, col: str) -> None:
    require_frame(df, "sort_dates")
    require_columns(df, [col], "sort_dates")
    if not is_datelike(df, col):
        raise SortError(4, f"sort_dates: '{col}' is not a date/timestamp column")


def sort_dates(df: DataFrame, col: str, order: str = "ASC",
               then_by: Sequence[str | Column] = ()) -> DataFrame:
    """Globally sort by a date column; nulls last in both directions.

    Spark range-partitions on the sort key (sampled bounds, so hot dates are
    split when ``then_by`` adds a tie-break) and sorts each partition.
    """
    _check(df, col)
    return df.orderBy(*_order(col, order, then_by))


def sort_dates_within(df: DataFrame, col: str, order: str = "ASC",
                      then_by: Sequence[str | Column] = ()) -> DataFrame:
    """Write-side variant: range partitions in date order, sorted inside."""
    _check(df, col)
    o = _order(col, order, then_by)
    return df.repartitionByRange(*o).sortWithinPartitions(*o)


def with_position(df: DataFrame, col: str, order: str = "ASC",
                  then_by: Sequence[str | Column] = (), name: str = "position") -> DataFrame:
    """The sort as data: ``name`` = 1-based rank in the sorted order.

    ``then_by`` must make the order total.
    """
    _check(df, col)
    if not then_by:
        raise InputError(1, "with_position: then_by must make the order total")
    return occurrence_number(df, [], _order(col, order, then_by), name)
