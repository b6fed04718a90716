"""Delimited text with a header row."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from tidemill.errors import SourceError
from tidemill.functions.text import MISSING_TOKENS

_INT = r"^[+-]?[0-9]+$"
_FLOAT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$|^[+-]?(inf|Infinity|nan)$"
_BOOL = ["True", "False", "TRUE", "FALSE", "true", "false"]


def _null_tokens(c: str) -> Column:
    return F.when(~_col(c).isin(MISSING_TOKENS), _col(c))


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


def extract_csv(spark: SparkSession, path: str, delimiter: str = ";",
                schema: T.StructType | str | None = None, multi_line: bool = False) -> DataFrame:
    """Read a header CSV; the usual missing-value tokens become null.

    Quoted values may hold the delimiter and doubled quotes; with ``multi_line`` also
    line ends (a file is then read by one task). All text is read as such, then tokens
    are blanked, then types are given in one aggregate pass. With ``schema`` that pass
    checks the declared types (a value that doesn't fit is an error, code 2). Without it
    a column whose non-null values are all integers becomes ``bigint``, all numbers
    ``double``, all ``True``/``False`` ``boolean``; anything else, and integers beyond 64
    bits, stays text. Missing path → code 1; no columns → code 2.

    A row with too few fields gets nulls for the rest. Rows with too many fields, or with a quote
    that isn't closed, are counted in the same pass: an error (code 2) with their number and the first of them.
    """
    reader = (spark.read.option("header", True).option("sep", delimiter).option("mode", "PERMISSIVE")
              .option("escape", '"').option("multiLine", multi_line).option("inferSchema", False))
    declared = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    try:
        names = [f.name for f in declared] if declared is not None else reader.csv(path).columns
        # one field more than there are columns, so that every row of the right width counts as malformed
        # and Spark hands over its text; the text is parsed out only where it is used
        more, text = _free(names, "_tm_more"), _free(names, "_tm_text")
        raw = (reader.option("columnNameOfCorruptRecord", text)
               .schema(T.StructType([T.StructField(c, T.StringType()) for c in [*names, more, text]])).csv(path))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            raise SourceError(1, f"extract_csv: path not found: {path}") from e
        raise SourceError(2, f"extract_csv: cannot read {path}: {e}") from e
    if not names:
        raise SourceError(2, f"extract_csv: {path} has no columns")
    whole = F.coalesce(_col(text), F.concat_ws(delimiter, *[F.coalesce(_col(c), F.lit("")) for c in [*names, more]]))
    wide, unclosed = _malformed(_col(text), delimiter, len(names))
    checks = [F.count_if(wide).alias("_tm_wide"), F.count_if(unclosed).alias("_tm_unclosed"),
              F.min(F.when(wide | unclosed, whole)).alias("_tm_sample")]
    blanked = raw.select(*[_null_tokens(c).alias(c) for c in names], *[_col(c) for c in (more, text)])
    return _declared(blanked, declared, checks) if declared is not None else _inferred(blanked, names, checks)


def _free(taken: list[str], name: str) -> str:
    while name in taken:
        name += "_"
    return name


def _malformed(record: Column, delimiter: str, width: int) -> tuple[Column, Column]:
    """Whether a record has over ``width`` fields, and whether a quoted field has no end.

    ``record`` is null for records of ``width + 1`` fields, the only ones that Spark took for well-formed.
    """
    d = re.escape(delimiter)
    quoted = rf'(?s)(^|{d})"(?:[^"]|"")*+"(?:(?!{d}).)*'  # with what follows the closing quote
    bare = F.when(F.contains(record, F.lit('"')), F.regexp_replace(record, quoted, "$1")).otherwise(record)
    fields = (F.length(bare) - F.length(F.replace(bare, F.lit(delimiter), F.lit("")))) / len(delimiter) + 1
    unclosed = F.contains(record, F.lit('"')) & bare.rlike(rf'(^|{d})"')
    return record.isNull() | (~unclosed & (fields > width)), F.coalesce(unclosed, F.lit(False))


def _raise_malformed(found) -> None:
    if found["_tm_wide"] or found["_tm_unclosed"]:
        raise SourceError(2, f"extract_csv: {found['_tm_wide']} rows have too many fields and {found['_tm_unclosed']} an"
                             f" open quote, e.g. {found['_tm_sample'][:200]!r}")


def _declared(text: DataFrame, schema: T.StructType, checks: list[Column]) -> DataFrame:
    typed = {f.name: _col(f.name).try_cast(f.dataType) for f in schema}
    checked = [f.name for f in schema if not isinstance(f.dataType, T.StringType)]
    wrong = text.agg(*[F.count_if(_col(c).isNotNull() & typed[c].isNull()).alias(c) for c in checked], *checks).first()
    _raise_malformed(wrong)
    bad = {c: wrong[c] for c in checked if wrong[c]}
    if bad:
        raise SourceError(2, f"extract_csv: values that don't fit the declared type: {bad}")
    return text.select(*[v.alias(c) for c, v in typed.items()])


def _inferred(text: DataFrame, names: list[str], checks: list[Column]) -> DataFrame:
    probes = list(checks)
    for i, c in enumerate(names):
        v = F.trim(_col(c))
        whole, long = v.rlike(_INT), v.rlike(_INT) & v.try_cast("long").isNull()
        probes += [F.bool_and(F.coalesce(whole, F.lit(True))).alias(f"int_{i}"),
                   F.bool_or(F.coalesce(long, F.lit(False))).alias(f"long_{i}"),
                   F.bool_and(F.coalesce(v.rlike(_FLOAT), F.lit(True))).alias(f"float_{i}"),
                   F.bool_and(F.coalesce(v.isin(_BOOL), F.lit(True))).alias(f"bool_{i}"),
                   F.count(v).alias(f"n_{i}")]
    kinds = text.agg(*probes).first()
    _raise_malformed(kinds)
    cols = []
    for i, c in enumerate(names):
        v = F.trim(_col(c))
        if not kinds[f"n_{i}"]:
            typed = _col(c).cast("double")  # an all-missing column is float in pandas
        elif kinds[f"long_{i}"]:
            typed = _col(c)
        elif kinds[f"int_{i}"]:
            typed = v.cast("long")
        elif kinds[f"float_{i}"]:
            typed = v.cast("double")
        elif kinds[f"bool_{i}"]:
            typed = F.lower(v).cast("boolean")
        else:
            typed = _col(c)
        cols.append(typed.alias(c))
    return text.select(*cols)


def write_csv(df: DataFrame, path: str, delimiter: str = ";") -> None:
    df.write.mode("overwrite").option("header", True).option("sep", delimiter).option("escape", '"').csv(path)


def with_row_order(df: DataFrame, name: str = "_row") -> DataFrame:
    """Add ``name``, a total order equal to the order rows appear in the files.

    Apply directly after a file scan, before anything shuffles: the value is
    (file path, start of the file split, position inside the split), so it
    follows the text order of every file. Operators that depend on row order
    (FIRST/LAST, automatic category codes, surrogate counters, duplicate
    suffixes) take it as ``order_by=[name]``.
    """
    return df.withColumn(name, F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos")))
