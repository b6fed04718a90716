"""JSON file sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.ordinal import occurrence_number
from tidemill.session import stage


def write_json(df: DataFrame, path: str) -> None:
    """Write one JSON object per line (splittable); arrays stay arrays."""
    df.write.mode("error").option("encoding", "UTF-8").json(path)


def write_json_array(df: DataFrame, path: str, order_by: list | None = None) -> None:
    """Write ``df`` as one JSON document: an array of objects, UTF-8, in ``order_by`` order.

    Rows are sorted and numbered in parallel; only the writing of the one file, which can't
    be split, is a single task, and that streams. Prefer :func:`write_json` for large frames.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in (order_by or [])] or [F.lit(0)]
    objects = df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("obj"), F.struct(*order).alias("o"))
    rows = stage(occurrence_number(objects, [], ["o", "obj"], "i"), "json-array")
    last = rows.agg(F.max("i")).first()[0]
    text = F.concat(F.when(F.col("i") == 1, "[").otherwise(","), "obj", F.when(F.col("i") == last, "]").otherwise(""))
    rows.sort("i").select(text.alias("value")).coalesce(1).write.mode("error").text(path)
