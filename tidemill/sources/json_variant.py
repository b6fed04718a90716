"""JSON records of differing shapes, read in one scan as VARIANT.

``extract_json`` infers a schema first, which reads the whole input, and one field of two shapes makes the column text. Here
each record is one VARIANT value, and each wanted field a path into it. Checks come from ``observe`` on the write that
stores the typed rows, so the text is parsed once.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemill.errors import SourceError
from tidemill.functions.text import LIST_SEPARATOR, digits_only
from tidemill.session import discard, fresh_path

_RECORD = "_tm_record"


def variant_path(name: str) -> str:
    """``a.b.c`` as a path: each part between dots is one field."""
    quotes = [next((q for q in "'\"" if q not in part), None) for part in name.split(".")]
    if None in quotes:
        raise SourceError(3, f"extract_json_variant: a field's name holds both kinds of quotes: {name!r}")
    return "$" + "".join(f"[{q}{part}{q}]" for q, part in zip(quotes, name.split(".")))


def _text(path: str) -> Column:
    """A value's text; lists joined by ``" , "`` without their nulls, objects as JSON."""
    items = F.try_variant_get(_RECORD, path, "array<variant>")
    joined = F.array_join(F.transform(items, lambda v: F.try_variant_get(v, "$", "string")), LIST_SEPARATOR)
    return F.when(items.isNotNull(), joined).otherwise(F.try_variant_get(_RECORD, path, "string"))


def typed(name: str, kind: str) -> tuple[Column, Column]:
    """The field ``name`` as ``kind``, null where it doesn't convert; and whether the record holds it (also as null)."""
    path = variant_path(name)
    value = F.try_variant_get(_RECORD, path, "variant")
    shape = F.schema_of_variant(value)
    text, number = F.try_variant_get(_RECORD, path, "string"), F.try_variant_get(_RECORD, path, "double")
    flag = F.when(shape == "BOOLEAN", F.try_variant_get(_RECORD, path, "boolean"))
    numeric = shape.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
    kind = str(kind).lower()
    if kind in ("str", "string", "object"):
        out = _text(path)
    elif kind == "date":
        out = digits_only(_text(path))
    elif kind in ("int", "integer"):
        whole = F.when(numeric & (number == F.floor(number)), number.try_cast("long"))
        out = F.coalesce(text.try_cast("long"), whole, flag.cast("long"))
    elif kind in ("float", "double"):
        out = F.coalesce(text.try_cast("double"), flag.cast("double"))
    elif kind in ("bool", "boolean"):
        out = F.coalesce(flag, F.when(numeric & number.isin(0.0, 1.0), number != 0))
    else:
        out = value
    return out, value.isNotNull()


def extract_json_variant(spark: SparkSession, path: str, types: Mapping[str, str], strict: bool = True,
                         multi_line: bool = False) -> DataFrame:
    """Read JSON lines (or whole files with ``multi_line``), and take the fields that ``types`` names, as columns of that name.

    str/string/object: text, lists joined by ``" , "``; date: its digits, none → null; int/integer and float/double: numbers,
    also from text; bool/boolean: booleans, 0 and 1; any other type: the VARIANT. A field that a record lacks, or has as
    null, is null. A name's dots lead into nested objects.

    ``strict`` stores the rows under the work folder in the one job that reads the text, and raises: code 2 for text that
    isn't JSON, 3 for fields that no record has (also for empty input), 9 for values that don't convert, with their counts.
    Without, the frame is lazy, such values are null and such fields too. A path that doesn't exist is code 1. With
    ``multi_line`` a file (an array of records, or one record) is one value in one task; use lines for large inputs.
    """
    reader = spark.read.option("singleVariantColumn", _RECORD).option("multiLine", multi_line).option("mode", "FAILFAST")
    try:
        raw = reader.json(path)
    except AnalysisException as e:
        raise SourceError(1 if "PATH_NOT_FOUND" in str(e) else 2, f"extract_json_variant: can't read {path}: {str(e)[:300]}") from e
    if multi_line:  # a file is one value: an array of records, or a record
        raw = raw.select(F.explode(F.coalesce(F.try_variant_get(_RECORD, "$", "array<variant>"), F.array(_RECORD))).alias(_RECORD))
    fields = {c: typed(c, kind) for c, kind in types.items()}
    out = raw.select(*[e.alias(c) for c, (e, _) in fields.items()])
    if not strict:
        return out
    seen = Observation()
    marks = raw.select(*[e.alias(c) for c, (e, _) in fields.items()],
                       *[(has & ~F.is_variant_null(F.try_variant_get(_RECORD, variant_path(c), "variant"))).alias(f"_tm_some{i}")
                         for i, (c, (_, has)) in enumerate(fields.items())],
                       *[has.alias(f"_tm_has{i}") for i, (_, has) in enumerate(fields.values())])
    # text that is a list of no values is '', digits of a text without any are null: neither is a failed conversion
    checked = [i for i, kind in enumerate(types.values()) if str(kind).lower() not in ("str", "string", "object", "date")]
    counted = marks.observe(
        seen, *[F.count_if(F.col(f"_tm_has{i}")).alias(f"has{i}") for i in range(len(fields))],
        *[F.count_if(F.col(f"_tm_some{i}") & F.col(f"`{list(fields)[i]}`").isNull()).alias(f"bad{i}") for i in checked])
    place = fresh_path(spark, "json-variant")
    try:
        counted.select(*[F.col(f"`{c}`") for c in fields]).write.parquet(place)
    except Exception as e:  # a job's failure comes as one of several classes
        discard(spark, place)
        if "MALFORMED" in str(e):
            raise SourceError(2, f"extract_json_variant: invalid JSON in {path}: {str(e)[:300]}") from e
        raise
    found = seen.get
    missing = [c for i, c in enumerate(fields) if not found[f"has{i}"]]
    bad = {list(fields)[i]: found[f"bad{i}"] for i in checked if found[f"bad{i}"]}
    if missing or bad:
        discard(spark, place)
        raise (SourceError(3, f"extract_json_variant: fields not found: {missing}") if missing else
               SourceError(9, f"extract_json_variant: values that cannot convert: {bad}"))
    return spark.read.schema(out.schema).parquet(place)
