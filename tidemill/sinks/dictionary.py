"""Category codes that grow: a stored dictionary gives new values the next codes and never renumbers old ones.

A dictionary is a small table ``(value, code)``. Each load counts the values it brings, and only those that the table
lacks get codes, in the order of their first appearance, after the largest code so far. The table is then switched to a
version with them. So a code means one value for ever, whatever the order of later loads; 0 stays the code of null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.errors import CategoryError, SchemaError
from tidemill.operators._checks import ref, refs, require_columns
from tidemill.operators.columns import MAX_CATEGORIES, category_codes
from tidemill.sinks.tables import check_name, save_as, switch_location, table_exists, write_version


def new_values(df: DataFrame, col: str, known: DataFrame | None, order_by: Sequence[str | Column]) -> DataFrame:
    """``value, first`` of the values that ``known`` (``value, code``) lacks; one partial aggregate over ``df``. Nulls have no code."""
    require_columns(df, [col], "new_values")
    firsts = df.where(ref(col).isNotNull()).groupBy(ref(col).alias("value")).agg(F.min(F.struct(*refs(order_by))).alias("first"))
    return firsts if known is None else firsts.join(known.select("value"), "value", "left_anti")


def grow(df: DataFrame, col: str, table: str, order_by: Sequence[str | Column]) -> DataFrame:
    """Add the values of ``df`` that the dictionary ``table`` lacks, and return the whole dictionary.

    Creates the table on the first load. More than 99 values, old and new together, are an error (code 5), and so is a
    dictionary that holds a value or a code twice (code 4); the table stays as it was. A load without new values writes
    nothing. One writer at a time.
    """
    spark = df.sparkSession
    check_name(table)
    exists = table_exists(spark, table)
    kind = df.schema[col].dataType if col in df.columns else None
    known = spark.table(table) if exists else None
    if exists and kind is not None and known.schema["value"].dataType != kind:
        raise SchemaError(3, f"grow: {table} holds {known.schema['value'].dataType.simpleString()} values, "
                             f"'{col}' is {kind.simpleString()}")
    old = [(r["value"], r["code"]) for r in known.limit(MAX_CATEGORIES + 1).collect()] if exists else []
    if len({v for v, _ in old}) < len(old) or len({c for _, c in old}) < len(old):
        raise CategoryError(4, f"grow: {table} holds a value or a code twice")
    # at most 99 rows are kept, so more than that of them need not be known
    found = new_values(df, col, known, order_by).limit(MAX_CATEGORIES + 1).collect()
    if len(old) + len(found) > MAX_CATEGORIES:
        raise CategoryError(5, f"grow: '{col}' and {table} have more than {MAX_CATEGORIES} values")
    if not found and exists:
        return known
    found.sort(key=lambda r: tuple((v is not None, v) for v in r["first"]))
    last = max((c for _, c in old), default=0)
    rows = old + [(r["value"], last + i + 1) for i, r in enumerate(found)]
    whole = spark.createDataFrame(rows, f"value {kind.simpleString()}, code long").coalesce(1)
    if exists:
        switch_location(spark, table, write_version(whole, table, None))
    else:
        save_as(whole, table)
    return spark.table(table)


def coded(df: DataFrame, col: str, table: str, order_by: Sequence[str | Column]) -> DataFrame:
    """Add ``<col>_num`` by the dictionary ``table``, which first takes up the values that it lacks; null gets 0."""
    return category_codes(df, col, mapping=grow(df, col, table, order_by))


def unknown_values(df: DataFrame, col: str, known: DataFrame) -> DataFrame:
    """``value, rows`` of values without a code: what a lookup in ``known`` would give 0, as if they were null."""
    require_columns(df, [col], "unknown_values")
    return (df.where(ref(col).isNotNull()).groupBy(ref(col).alias("value")).agg(F.count(F.lit(1)).alias("rows"))
            .join(known.select("value"), "value", "left_anti"))
