"""Column naming and the vectorised word splitting that several operators share."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that one vectorised step works on; a longer text is a step of its own.
STEP_BYTES = 4 << 20


def ship(spark: SparkSession) -> None:
    """Give this package to the executors' Python workers, once for each Spark application."""
    context, root = spark.sparkContext, Path(__file__).resolve().parent.parent
    if getattr(context, "tidemill_shipped", False) or not root.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="tidemill-package-"), "tidemill_package.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, file.relative_to(root.parent))
    context.addPyFile(str(archive))
    context.tidemill_shipped = True


def given_back(batches: Iterator) -> Iterator:
    """The same batches; when the last is done, memory that the worker no longer uses goes back to the system.

    Workers wait idle for the next stage's tasks, which start on top of what they hold.
    """
    try:
        yield from batches
    finally:
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # another C library than glibc
            ctypes.CDLL(None).malloc_trim(0)


def col(name: str) -> Column:
    """The column of exactly this name (dots and spaces included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def slices(texts: pa.Array, step_bytes: int = STEP_BYTES) -> Iterator[pa.Array]:
    """Consecutive slices of about ``step_bytes`` each, nulls replaced by empty texts."""
    texts = pc.fill_null(texts, "")
    if not len(texts):
        return
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + step_bytes, "right")))
        yield texts.slice(start, stop - start)
        start = stop


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words between ASCII white space: codes of all words, ``len + 1`` offsets by text, the distinct words.

    Word ``i`` of text ``t`` is ``distinct[codes[offsets[t] + i]]``.
    """
    parts = pc.ascii_split_whitespace(texts)
    at, values = parts.offsets.to_numpy(), parts.values
    at, values = at - at[0], values.slice(at[0], at[-1] - at[0])
    full = pc.greater(pc.binary_length(values), 0)
    kept = np.concatenate(([0], np.cumsum(full.to_numpy(zero_copy_only=False), dtype=np.int64)))
    coded = values.filter(full).dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), kept[at], coded.dictionary


def per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` by text."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]
