"""Data-quality reports (DataFrames) and type conformance."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.errors import InputError, SchemaError
from tidemill.functions.text import bound
from tidemill.operators._checks import INTEGRAL, NUMERIC, is_missing, require_columns, require_frame

# Accepted type names and the Spark type each one means.
TYPE_NAMES = {
    "str": T.StringType(), "string": T.StringType(),
    "int": T.LongType(), "integer": T.LongType(),
    "float": T.DoubleType(), "number": T.DoubleType(),
    "bool": T.BooleanType(), "boolean": T.BooleanType(),
    "datetime": T.TimestampNTZType(),  # naive, like pandas datetime64: no session time zone involved
}


def _col(name: str):
    """A column by exact name (names from flattened JSON contain dots)."""
    return F.col(f"`{name}`")


def null_report(df: DataFrame) -> DataFrame:
    """``(column, nulls)`` for every column holding nulls or NaN — one aggregate pass."""
    require_frame(df, "null_report")
    counts = df.agg(*[F.count_if(is_missing(df, c)).alias(c) for c in df.columns])
    pairs = [F.struct(F.lit(c).alias("column"), _col(c).alias("nulls")) for c in df.columns]
    long_form = counts.select(F.explode(F.array(*pairs)).alias("r")).select("r.*")
    return long_form.where(F.col("nulls") > 0)


def duplicate_report(df: DataFrame, col: str) -> DataFrame:
    """``(value, copies)`` for non-null values present more than once."""
    require_columns(df, [col], "duplicate_report")
    return (df.where(_col(col).isNotNull()).groupBy(_col(col).alias("value"))
            .agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1))


def _target(name: str) -> T.DataType:
    t = TYPE_NAMES.get(str(name).lower())
    if t is None:
        raise SchemaError(9, f"conform_types: unknown type name {name!r}")
    return t


def _no_nan(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


#: Text that is read as a whole number, as any number; a cast of other text is an exception inside Spark, and slow.
_WHOLE = r"^\s*[+-]?[0-9]+\s*$"
_NUMBER = r"(?i)^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?\s*$|^\s*[+-]?inf(inity)?\s*$"


def _number(text: Column) -> Column:
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def _no_nan_once(c: Column) -> Column:
    return bound(c, _no_nan)


def _convert(df: DataFrame, col: str, target: T.DataType):
    """How to convert ``col``: ``(pre, final, bad)``.

    ``pre`` is an expression computed once into a helper column (or None);
    ``final(h)`` and ``bad(h)`` build the converted value and the "cannot
    convert" flag from that helper (``h`` is the column itself when there is
    no helper). Parsing text once matters: an expression repeated inside
    conditional branches is evaluated again for every reference, so values are bound as lambda arguments.
    """
    src = df.schema[col].dataType
    c = _col(col)
    keep = (None, lambda h: h, None)
    if src == target:
        return (None, _no_nan, None) if isinstance(src, T.DoubleType) else keep
    if isinstance(target, T.StringType):
        return None, lambda h: h.cast("string"), None
    if isinstance(target, T.LongType):
        if isinstance(src, INTEGRAL) or isinstance(src, T.BooleanType):
            return None, lambda h: h.cast("long"), None
        if isinstance(src, NUMERIC) or isinstance(src, T.StringType):
            # whole numbers are read as such, so that 64 bits survive; only values with a point or an
            # exponent go through double, and NaN is missing, as in pandas
            def rounded(number: Column) -> Column:
                fits = (number == F.floor(number)) & (F.abs(number) < 2.0 ** 63)
                return F.struct(F.when(fits, number.try_cast("long")).alias("value"), number.isNotNull().alias("given"))

            def read(whole: Column) -> Column:
                given = F.struct(whole.alias("value"), F.lit(True).alias("given"))
                if isinstance(src, T.DecimalType):
                    return F.when(whole.isNotNull(), given).otherwise(
                        F.struct(whole.alias("value"), c.isNotNull().alias("given")))
                return F.when(whole.isNotNull(), given).otherwise(bound(_number(c), rounded))

            if isinstance(src, T.StringType):
                pre = bound(F.when(c.rlike(_WHOLE), c.try_cast("long")), read)
            elif isinstance(src, T.DecimalType):
                pre = bound(F.when(c == F.floor(c), c.try_cast("long")), read)
            else:
                pre = bound(_no_nan_once(c.cast("double")), rounded)
            # a fractional number doesn't turn into an integer, nor does one beyond 64 bits
            return pre, lambda h: h["value"], lambda h: h["given"] & h["value"].isNull()
    if isinstance(target, T.DoubleType):
        if isinstance(src, NUMERIC):
            return None, lambda h: _no_nan(h.cast("double")), None
        if isinstance(src, T.StringType):
            return None, _number, None
    if isinstance(target, T.BooleanType):
        if isinstance(src, NUMERIC):
            return None, lambda h: F.when(h.isNotNull(), h != 0), lambda h: h.isNotNull() & ~h.isin(0, 1)
        # only real booleans convert; any text value is an error
        return None, lambda h: F.lit(None).cast("boolean"), lambda h: h.isNotNull()
    if isinstance(target, T.TimestampNTZType):
        if isinstance(src, (T.DateType, T.TimestampType)):
            return None, lambda h: h.cast("timestamp_ntz"), None
        if isinstance(src, T.StringType):
            return None, lambda h: h.try_cast("timestamp_ntz"), None
    raise SchemaError(9, f"conform_types: cannot convert '{col}' from {src.simpleString()} "
                         f"to {target.simpleString()}")


def _plan(df: DataFrame, expected: Mapping[str, str]):
    """``(staged frame, {column: (target, value, bad)})`` with helpers computed once."""
    require_frame(df, "conform_types")
    if not isinstance(expected, Mapping) or not expected:
        raise InputError(1, "conform_types: expected must be a non-empty mapping")
    missing = [c for c in expected if c not in df.columns]
    extra = [c for c in df.columns if c not in expected]
    if missing or extra:
        raise SchemaError(2, f"conform_types: missing columns {missing}, unexpected columns {extra}")
    helpers, out = [], {}
    for i, (c, t) in enumerate(expected.items()):
        target = _target(t)
        pre, final, bad = _convert(df, c, target)
        h = _col(c)
        if pre is not None:
            helpers.append(pre.alias(f"_tm_h{i}"))
            h = F.col(f"_tm_h{i}")
        out[c] = (target, final(h), bad(h) if bad else None)
    staged = df.select(*[_col(c) for c in df.columns], *helpers) if helpers else df
    return staged, out


def conform_types(df: DataFrame, expected: Mapping[str, str], strict: bool = True) -> DataFrame:
    """Exact column set (else :class:`SchemaError`), declared order, declared types.

    int: numbers and numeric text, unparseable text → null, a fractional value is
    an error; float: unparseable → null; bool: booleans and 0/1 only; datetime:
    unparseable → null; str: text, null stays null. ``strict`` runs one
    aggregate to find values that cannot convert and raises code 9.
    """
    staged, plan = _plan(df, expected)
    checks = {c: err for c, (_, _, err) in plan.items() if err is not None}
    if strict and checks:
        row = staged.agg(*[F.count_if(e).alias(c) for c, e in checks.items()]).first()
        bad = {c: row[c] for c in checks if row[c]}
        if bad:
            raise SchemaError(9, f"conform_types: values that cannot convert: {bad}")
    return staged.select(*[expr.alias(c) for c, (_, expr, _) in plan.items()])


def conform_report(df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """``(column, from_type, to_type, nulled)`` for each column that changes type.

    ``nulled`` counts values that were present and become null.
    """
    staged, plan = _plan(df, expected)
    changed = [(c, t, e) for c, (t, e, _) in plan.items() if df.schema[c].dataType != t]
    schema = "column string, from_type string, to_type string, nulled long"
    if not changed:
        return df.sparkSession.createDataFrame([], schema)
    counts = staged.agg(*[F.count_if(_col(c).isNotNull() & e.isNull()).alias(c) for c, _, e in changed])
    rows = [F.struct(F.lit(c).alias("column"), F.lit(df.schema[c].dataType.simpleString()).alias("from_type"),
                     F.lit(t.simpleString()).alias("to_type"), _col(c).cast("long").alias("nulled"))
            for c, t, _ in changed]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
