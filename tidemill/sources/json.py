"""JSON: whole-file arrays or JSON lines, flattened and typed."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from tidemill.errors import SourceError
from tidemill.functions.text import digits_only, json_text

log = logging.getLogger(__name__)


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested struct fields → top-level columns named ``a.b.c`` (all depths)."""
    cols: list[Column] = []

    def walk(prefix: list[str], dtype: T.DataType, expr: Column):
        if isinstance(dtype, T.StructType):
            for f in dtype.fields:
                walk(prefix + [f.name], f.dataType, expr[f.name])
        else:
            cols.append(expr.alias(sep.join(prefix)))

    for f in df.schema.fields:
        walk([f.name], f.dataType, F.col(f"`{f.name}`"))
    return df.select(*cols)


def convert(df: DataFrame, types: Mapping[str, str], strict: bool = True) -> DataFrame:
    """Select ``types`` keys in order and convert each column.

    str/string/object: text, lists joined by ``" , "``; date: digits only,
    empty → null (a warning: use ``parse_date`` for real dates); int/integer,
    float/double: numbers; bool/boolean: JSON booleans, 0/1; anything else
    kept as is. ``strict`` checks every value can convert with one aggregate
    and raises code 9 naming the columns that cannot.
    """
    missing = [c for c in types if c not in df.columns]
    if missing:
        raise SourceError(3, f"extract_json: columns not found: {missing}")
    out, bad = [], {}
    for c, t in types.items():
        col, dt, tl = F.col(f"`{c}`"), df.schema[c].dataType, str(t).lower()
        if tl in ("str", "string", "object"):
            e = json_text(col, isinstance(dt, T.ArrayType))
        elif tl == "date":
            log.warning("extract_json: '%s' kept as digits only; parse it with parse_date", c)
            e = digits_only(json_text(col, isinstance(dt, T.ArrayType)))
        elif tl in ("int", "integer", "float", "double"):
            target = "long" if tl in ("int", "integer") else "double"
            e = col.try_cast(target)
            bad[c] = col.isNotNull() & e.isNull()
            if target == "long" and isinstance(dt, (T.DoubleType, T.FloatType)):
                e = F.when(col == F.floor(col), col.cast("long"))
                bad[c] = col.isNotNull() & e.isNull()
        elif tl in ("bool", "boolean"):
            if isinstance(dt, T.BooleanType):
                e = col
            elif isinstance(dt, (T.LongType, T.IntegerType, T.DoubleType)):
                e = F.when(col.isin(0, 1), col != 0)
                bad[c] = col.isNotNull() & e.isNull()
            else:
                e = F.lit(None).cast("boolean")
                bad[c] = col.isNotNull()
        else:
            log.warning("extract_json: unknown type %r for '%s'; kept as is", t, c)
            e = col
        out.append(e.alias(c))
    if strict and bad:
        row = df.agg(*[F.count_if(b).alias(c) for c, b in bad.items()]).first()
        failed = {c: row[c] for c in bad if row[c]}
        if failed:
            raise SourceError(9, f"extract_json: values that cannot convert: {failed}")
    return df.select(*out)


def extract_json(spark: SparkSession, path: str, types: Mapping[str, str],
                 multi_line: bool = True, schema: T.StructType | str | None = None,
                 strict: bool = True) -> DataFrame:
    """Read JSON, flatten nested objects to dotted names, select and convert.

    ``multi_line=True`` reads whole-file JSON (an array of objects; one task per
    file). Use ``multi_line=False`` for JSON lines, which splits.
    """
    reader = spark.read.option("multiLine", multi_line).option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema)
    try:
        raw = reader.json(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            raise SourceError(1, f"extract_json: path not found: {path}") from e
        raise SourceError(2, f"extract_json: invalid JSON in {path}: {e}") from e
    except Exception as e:  # noqa: BLE001 - malformed input surfaces as a job failure during inference
        raise SourceError(2, f"extract_json: invalid JSON in {path}: {str(e)[:300]}") from e
    if "_corrupt_record" in raw.columns:
        raise SourceError(2, f"extract_json: invalid JSON in {path}")
    return convert(flatten(raw), types, strict=strict)
