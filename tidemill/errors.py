"""Typed exceptions. ``code`` keeps the numeric code each step documents."""

from __future__ import annotations


class StepError(Exception):
    """Base error: ``code`` is the step's documented failure code."""

    def __init__(self, code: int, message: str):
        super().__init__(f"[{code}] {message}")
        self.code = code
        self.message = message


class InputError(StepError):
    """Bad arguments or empty input (code 1)."""


class MissingColumnError(StepError):
    """Referenced columns do not exist (code 2 unless stated)."""


class SchemaError(StepError):
    """Column set or type does not match what was declared."""


class DateFormatError(StepError):
    """Text that does not parse as a date with the given pattern (3, 4, 9)."""


class KeyFormatError(StepError):
    """Values that cannot form a surrogate key (code 3)."""


class CategoryError(StepError):
    """Category map mismatch (4) or too many categories (5)."""


class DuplicateKeyError(StepError):
    """Duplicate keys in a frame that must be unique by key."""


class ViewError(StepError):
    """View creation failed: bad name (5), syntax (3), other (4)."""


class AggregationError(StepError):
    """Unknown aggregate (3) or numeric aggregate on a non-numeric column (4)."""


class JoinError(StepError):
    """Missing key (1), bad join type (2), key types differ (4)."""


class SortError(StepError):
    """Bad order (3) or non-date column (4)."""


class SourceError(StepError):
    """Missing path (1), unreadable/empty (2), missing columns (3), other (9)."""


class TableError(StepError):
    """Target table missing or in an unexpected state."""


def failure_context(df, rows: int = 5) -> str:
    """What to log next to a failure: the schema and the first ``rows`` rows.

    Only ``rows`` rows reach the driver (a ``limit``), whatever the frame's size.
    """
    head = [r.asDict() for r in df.limit(rows).collect()]
    return f"schema: {df.schema.simpleString()}\nfirst {rows} rows: {head}"
