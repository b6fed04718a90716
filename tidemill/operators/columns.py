"""Column operators: rename, category codes, null fill, date parsing,
surrogate keys and de-duplicating suffixes."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.errors import (CategoryError, DateFormatError, InputError, KeyFormatError,
                             MissingColumnError)
from tidemill.functions import dates
from tidemill.functions.ordinal import occurrence_number
from tidemill.operators._checks import (INTEGRAL, is_missing, is_numeric, ref, refs, require_columns,
                                        require_frame)

MAX_CATEGORIES = 99  # fixed value: more distinct values than this is an error (code 5)
KEY_PATTERN = r"^[0-9-]*[0-9][0-9-]*$"  # digits, optionally with hyphens, at least one digit


# ---------------------------------------------------------------- P1 rename
def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename ``{old: new}``. Missing old name → code 2, blank new name → 3."""
    require_frame(df, "rename_columns")
    if not isinstance(names, Mapping) or not names:
        raise InputError(1, "rename_columns: names must be a non-empty mapping")
    require_columns(df, names.keys(), "rename_columns")
    bad = [n for n in names.values() if not isinstance(n, str) or not n.strip()]
    if bad:
        raise InputError(3, f"rename_columns: invalid new names {bad}")
    return df.withColumnsRenamed(dict(names))


# ---------------------------------------------------------------- P3 key first
def key_first(df: DataFrame, key: str) -> DataFrame:
    return df.select(ref(key), *[ref(c) for c in df.columns if c != key])


# ---------------------------------------------------------------- P4 categories
def _distinct_values(df: DataFrame, col: str) -> list[Any]:
    """Distinct non-null values, at most ``MAX_CATEGORIES + 1`` collected."""
    rows = (df.where(ref(col).isNotNull()).select(col).distinct()
            .limit(MAX_CATEGORIES + 1).collect())
    vals = [r[0] for r in rows]
    if len(vals) > MAX_CATEGORIES:
        raise CategoryError(5, f"category_codes: more than {MAX_CATEGORIES} distinct values in '{col}'")
    return vals


def category_mapping(df: DataFrame, col: str, order_by: Sequence[str | Column]) -> DataFrame:
    """Automatic codes as a DataFrame ``(value, code)``: 1, 2, 3… by first appearance.

    First appearance = smallest ``order_by`` among the value's rows. A partial
    aggregate per value, then a rank over at most ``MAX_CATEGORIES`` rows.
    """
    require_columns(df, [col], "category_mapping")
    order = F.struct(*refs(order_by))
    firsts = (df.where(ref(col).isNotNull())
              .groupBy(ref(col).alias("value")).agg(F.min(order).alias("_first")))
    rows = firsts.limit(MAX_CATEGORIES + 1).collect()
    if len(rows) > MAX_CATEGORIES:
        raise CategoryError(5, f"category_codes: more than {MAX_CATEGORIES} distinct values in '{col}'")
    # nulls first, as Spark orders them (at most 99 rows, sorted on the driver)
    rows.sort(key=lambda r: tuple((v is not None, v) for v in r["_first"]))
    schema = T.StructType([T.StructField("value", df.schema[col].dataType),
                           T.StructField("code", T.LongType(), False)])
    return df.sparkSession.createDataFrame([(r["value"], i + 1) for i, r in enumerate(rows)], schema)


def _fixed_codes(col: str, cat_map: Mapping[Any, int], present: Callable[[], Iterable[Any]]) -> list[tuple[Any, int]]:
    """The pairs of a fixed map: whole numbers (else code 3) for exactly the values present (else code 4)."""
    if not isinstance(cat_map, Mapping) or not cat_map:
        raise CategoryError(3, "category_codes: cat_map must be a non-empty mapping")
    wrong = [v for v in cat_map.values() if isinstance(v, bool) or not isinstance(v, int)]
    if wrong:
        raise CategoryError(3, f"category_codes: cat_map values must be int: {wrong}")
    found = set(present())
    if found != set(cat_map):
        raise CategoryError(4, f"category_codes: '{col}' has the values {sorted(map(str, found))}, "
                               f"cat_map has {sorted(map(str, cat_map))}")
    return list(cat_map.items())


def _with_codes(df: DataFrame, col: str, pairs: Sequence[tuple[Any, int]]) -> DataFrame:
    """Add ``<col>_num`` by a literal map; null and unmapped values get 0."""
    zero = F.lit(0).cast("long")
    if not pairs:
        return df.withColumn(f"{col}_num", zero)
    kind = df.schema[col].dataType
    lookup = F.create_map(*[x for k, v in pairs for x in (F.lit(k).cast(kind), F.lit(int(v)).cast("long"))])
    return df.withColumn(f"{col}_num", F.coalesce(lookup[ref(col)], zero))


def category_codes(df: DataFrame, col: str, cat_map: Mapping[Any, int] | None = None,
                   order_by: Sequence[str | Column] | None = None,
                   mapping: DataFrame | None = None) -> DataFrame:
    """Add ``<col>_num``: category code, null (and unmapped) → 0.

    * ``cat_map`` — fixed ``{value: int}``; its keys must equal the distinct
      non-null values (else code 4).
    * otherwise ``mapping`` — a stored ``(value, code)`` frame, e.g. from
      :func:`category_mapping` of an earlier load, so codes stay stable.
    * otherwise automatic codes by first appearance in ``order_by``.

    The mapping has at most 99 entries, so it is inlined as a literal map: no
    join, no shuffle, the lookup stays inside whole-stage codegen.
    """
    require_frame(df, "category_codes")
    if not isinstance(col, str) or not col.strip():
        raise InputError(1, "category_codes: col must be a non-empty string")
    require_columns(df, [col], "category_codes")
    if cat_map is not None:
        pairs = _fixed_codes(col, cat_map, lambda: _distinct_values(df, col))
    else:
        if mapping is None:
            if order_by is None:
                raise InputError(1, "category_codes: automatic codes need order_by (row order)")
            mapping = category_mapping(df, col, order_by)
        pairs = [(r[0], r[1]) for r in mapping.limit(MAX_CATEGORIES + 1).collect()]
        if len(pairs) > MAX_CATEGORIES:
            raise CategoryError(5, f"category_codes: stored mapping has more than {MAX_CATEGORIES} entries")
    return _with_codes(df, col, pairs)


# ---------------------------------------------------------------- P5 nulls
def _missing(df: DataFrame, col: str, null_values: Sequence[Any] | None) -> Column:
    """Null, NaN, or one of ``null_values``; of these only values that the column's type can hold count."""
    kind = df.schema[col].dataType
    listed = [v for v in null_values or () if v is not None and v == v]
    if isinstance(kind, T.BooleanType):
        listed = [v for v in listed if isinstance(v, bool)]
    elif is_numeric(df, col):
        listed = [v for v in listed if isinstance(v, (int, float)) and not isinstance(v, bool)]
    elif isinstance(kind, T.StringType):
        listed = [v for v in listed if isinstance(v, str)]
    missing = is_missing(df, col)
    return missing | ref(col).isin(listed) if listed else missing


def fill_nulls(df: DataFrame, col: str, null_values: Sequence[Any] | None = None) -> DataFrame:
    """Treat ``null_values`` and NaN as null, then fill: 0 for numeric columns, false for booleans, ``""`` otherwise."""
    require_columns(df, [col], "fill_nulls")
    kept = F.when(~_missing(df, col, null_values), ref(col))
    if isinstance(df.schema[col].dataType, T.BooleanType):
        filled = F.coalesce(kept, F.lit(False))
    elif is_numeric(df, col):
        filled = F.coalesce(kept, F.lit(0)).cast(df.schema[col].dataType)
    else:
        filled = F.coalesce(kept.cast("string"), F.lit(""))
    return df.withColumn(col, filled)


def fill_count(df: DataFrame, col: str, null_values: Sequence[Any] | None = None) -> DataFrame:
    """One-row report: how many values :func:`fill_nulls` replaces."""
    require_columns(df, [col], "fill_count")
    return df.agg(F.count_if(F.coalesce(_missing(df, col, null_values), F.lit(True))).alias("replaced"))


# ---------------------------------------------------------------- P6 dates
def _raw_text(col: str) -> Column:
    return F.trim(ref(col).cast("string"))


def date_flags(raw: Column, fmt: str) -> tuple[Column, Column, Column]:
    """Exclusive violation flags in check order: bad length (code 3), non-digit
    (code 4, only for patterns without literal separators), not a date (9)."""
    bad_len = raw.isNull() | (F.length(raw) != len(fmt))
    non_digit = F.lit(False) if dates.has_literals(fmt) else raw.rlike(r"\D")
    bad_parse = dates.parse_with_pattern(raw, fmt).isNull()
    return bad_len, ~bad_len & non_digit, ~bad_len & ~non_digit & bad_parse


def date_violation_counts(df: DataFrame, col: str, fmt: str = "YYYYMMDD") -> DataFrame:
    """One row: counts and one sample of each violation, in the order checked.

    ``bad_length`` (code 3), ``non_digit`` (code 4, only for patterns without
    literal separators), ``unparseable`` (code 9). Nulls count as bad length.
    """
    require_columns(df, [col], "date_violations")
    raw = _raw_text(col)
    n_len, n_dig, n_parse = date_flags(raw, fmt)
    return df.agg(
        F.count_if(n_len).alias("bad_length"),
        F.min(F.when(n_len, F.coalesce(raw, F.lit("<null>")))).alias("bad_length_sample"),
        F.count_if(n_dig).alias("non_digit"),
        F.min(F.when(n_dig, raw)).alias("non_digit_sample"),
        F.count_if(n_parse).alias("unparseable"),
        F.min(F.when(n_parse, raw)).alias("unparseable_sample"),
    )


def raise_date_violations(counts, col: str, fmt: str) -> None:
    """Raise for the first violation kind present in a :func:`date_violation_counts` row."""
    for code, name in ((3, "bad_length"), (4, "non_digit"), (9, "unparseable")):
        if counts[name]:
            raise DateFormatError(code, f"parse_date: {counts[name]} values of '{col}' fail "
                                        f"{name} for {fmt}, e.g. '{counts[name + '_sample']}'")


def parse_date(df: DataFrame, col: str, fmt: str = "YYYYMMDD", on_error: str = "raise",
               as_timestamp: bool = False) -> DataFrame:
    """Replace text ``col`` by the date it spells in ``fmt`` (``YYYY YY MM DD`` + literals).

    ``on_error="raise"``: one aggregate job checks every value first and raises
    :class:`DateFormatError` with code 3 (length), 4 (non-digit) or 9 (not a
    real date). ``on_error="null"``: no check, bad values become null.
    """
    require_frame(df, "parse_date")
    require_columns(df, [col], "parse_date")
    if on_error not in ("raise", "null"):
        raise InputError(1, "parse_date: on_error must be 'raise' or 'null'")
    if on_error == "raise":
        raise_date_violations(date_violation_counts(df, col, fmt).first(), col, fmt)
    parsed = dates.parse_with_pattern(_raw_text(col), fmt)
    return df.withColumn(col, parsed if as_timestamp else parsed.cast("date"))


# ---------------------------------------------------------------- P8 surrogate key
def key_violations(df: DataFrame, col: str) -> DataFrame:
    """Values that cannot form a surrogate key, with their counts (null included)."""
    require_columns(df, [col], "key_violations")
    s = ref(col).cast("string")
    return (df.where(s.isNull() | ~s.rlike(KEY_PATTERN))
            .groupBy(s.alias("value")).agg(F.count(F.lit(1)).alias("rows")))


def surrogate_key(df: DataFrame, col: str, order_by: Sequence[str | Column], name: str = "Index",
                  separator: str = "", validate: bool = True) -> DataFrame:
    """New first column ``name`` = value + 0-based occurrence counter in row order.

    ``123, 123, 124, 123 → 1230, 1231, 1240, 1232``. Values must be digits or
    digits with hyphens (code 3). ``order_by`` is the row order (total).
    Rows come out in ranges of ``(col, order_by)`` (see :func:`occurrence_number`).
    """
    require_frame(df, "surrogate_key")
    require_columns(df, [col], "surrogate_key")
    if validate:
        bad = key_violations(df, col).limit(1).collect()
        if bad:
            raise KeyFormatError(3, f"surrogate_key: invalid value in '{col}': '{bad[0]['value']}'")
    s = ref(col).cast("string")
    out = occurrence_number(df, [s], order_by, "_tm_occ")
    out = out.withColumn(name, F.concat(s, F.lit(separator), (F.col("_tm_occ") - 1).cast("string")))
    return key_first(out.drop("_tm_occ"), name)


# ---------------------------------------------------------------- P9 unique suffix
def unique_suffix(df: DataFrame, col: str, order_by: Sequence[str | Column]) -> DataFrame:
    """Make ``col`` unique: null → ``""``; 2nd, 3rd… copy → ``A - 2``, ``A - 3``."""
    require_columns(df, [col], "unique_suffix")
    v = F.coalesce(ref(col).cast("string"), F.lit(""))
    out = occurrence_number(df, [v], order_by, "_tm_occ")
    return out.withColumn(
        col, F.when(F.col("_tm_occ") == 1, v)
        .otherwise(F.concat(v, F.lit(" - "), F.col("_tm_occ").cast("string")))).drop("_tm_occ")


__all__ = ["rename_columns", "key_first", "category_mapping", "category_codes", "category_codes_many", "fill_nulls",
           "fill_count", "date_violation_counts", "parse_date", "key_violations", "surrogate_key",
           "unique_suffix", "MissingColumnError"]


def category_codes_many(df: DataFrame, specs: Mapping[str, Mapping[Any, int] | None],
                        order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """:func:`category_codes` for several columns from one aggregate job.

    ``specs`` maps each column to a fixed ``cat_map`` or to None (automatic
    codes by first appearance in ``order_by``). One pass collects each
    column's distinct values with their first appearance — at most
    ``MAX_CATEGORIES + 1`` per column are needed, so at most that many per
    column are gathered — then the same rules as :func:`category_codes`
    apply column by column. Columns that are not text or integers (whose
    values do not round-trip through text) go through :func:`category_codes`.
    """
    require_frame(df, "category_codes")
    require_columns(df, specs.keys(), "category_codes")
    simple = [c for c in specs if isinstance(df.schema[c].dataType, (T.StringType, *INTEGRAL))]
    out = df
    for c in specs:
        if c not in simple:
            out = category_codes(out, c, cat_map=specs[c], order_by=order_by)
    if not simple:
        return out
    if any(specs[c] is None for c in simple) and order_by is None:
        raise InputError(1, "category_codes: automatic codes need order_by (row order)")
    order = F.struct(*refs(order_by)) if order_by is not None else F.lit(0)
    items = df.select(order.alias("_o"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("c"), ref(c).cast("string").alias("v")) for c in simple])).alias("it"))
    firsts = (items.where(F.col("it.v").isNotNull())
              .groupBy(F.col("it.c").alias("c"), F.col("it.v").alias("v")).agg(F.min("_o").alias("_first")))
    # a bounded collect: if all (MAX + 1) × columns slots fill up, some column
    # has more than MAX_CATEGORIES values (pigeonhole), which is an error anyway
    cap = (MAX_CATEGORIES + 1) * len(simple)
    per: dict[str, list] = {c: [] for c in simple}
    collected = firsts.limit(cap).collect()
    for r in collected:
        per[r["c"]].append(r)
    if len(collected) == cap:
        worst = max(simple, key=lambda c: len(per[c]))
        raise CategoryError(5, f"category_codes: more than {MAX_CATEGORIES} distinct values in '{worst}'")
    for c in simple:
        rows = per[c]
        if len(rows) > MAX_CATEGORIES:
            raise CategoryError(5, f"category_codes: more than {MAX_CATEGORIES} distinct values in '{c}'")
        spec = specs[c]
        if spec is not None:
            named = {str(k): v for k, v in spec.items()} if isinstance(spec, Mapping) else spec
            pairs = _fixed_codes(c, named, lambda rows=rows: (r["v"] for r in rows))
        else:
            rows.sort(key=lambda r: tuple((x is not None, x) for x in r["_first"]))
            pairs = [(r["v"], i + 1) for i, r in enumerate(rows)]
        out = _with_codes(out, c, pairs)
    return out
