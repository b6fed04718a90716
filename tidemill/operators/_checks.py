"""Driver-side argument checks (schema only, no Spark job)."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.errors import InputError, MissingColumnError

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
           T.DoubleType, T.DecimalType, T.BooleanType)
INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def require_frame(df, op: str) -> None:
    if not isinstance(df, DataFrame):
        raise InputError(1, f"{op}: input is not a DataFrame")


def require_columns(df: DataFrame, cols: Iterable[str], op: str, code: int = 2) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise MissingColumnError(code, f"{op}: columns not found: {missing}")


def dtype(df: DataFrame, col: str) -> T.DataType:
    return df.schema[col].dataType


def is_numeric(df: DataFrame, col: str) -> bool:
    return isinstance(dtype(df, col), NUMERIC)


def is_datelike(df: DataFrame, col: str) -> bool:
    return isinstance(dtype(df, col), (T.DateType, T.TimestampType, T.TimestampNTZType))


def is_missing(df: DataFrame, col: str) -> Column:
    """Null, or NaN in a floating-point column."""
    if isinstance(dtype(df, col), (T.FloatType, T.DoubleType)):
        return ref(col).isNull() | F.isnan(ref(col))
    return ref(col).isNull()


def first_broken(op: str, rules: Iterable[tuple[Callable[[], bool], type[Exception], int, str]]) -> None:
    """Raise for the first rule that doesn't hold; later rules may rely on earlier ones."""
    for holds, error, code, text in rules:
        if not holds():
            raise error(code, f"{op}: {text}")


def ref(name: str) -> Column:
    """Column by exact name: a dot in the name is part of it, not a field access."""
    return F.col(f"`{name}`")


def refs(cols) -> list[Column]:
    return [ref(c) if isinstance(c, str) else c for c in cols]
