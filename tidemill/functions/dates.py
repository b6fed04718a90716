"""Date helpers: pattern translation, strict parsing, calendar names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemill.errors import InputError

# Spanish weekday names, Monday first (weekday index 1..7).
DAY_NAMES = ["Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo"]
# Spanish month names, January first (month 1..12).
MONTH_NAMES = ["Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio",
               "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre"]

# The pattern's tokens and Spark's letters for them.
_TOKENS = {"YYYY": "yyyy", "YY": "yy", "MM": "MM", "DD": "dd"}
_TOKEN = re.compile("(YYYY|YY|MM|DD)")


def spark_pattern(fmt: str) -> str:
    """Translate a ``YYYY/YY/MM/DD`` pattern to a Spark datetime pattern.

    Any other character is a literal and is quoted, so ``DD-MM-YYYY`` becomes
    ``dd'-'MM'-'yyyy``. A part given twice, and a ``Y``, ``M`` or ``D`` that is in no
    token, are errors (code 1).
    """
    literals = _TOKEN.sub("", fmt)
    parts = [t[0] for t in _TOKEN.findall(fmt)]
    if len(parts) != len(set(parts)) or re.search("[YMD]", literals):
        raise InputError(1, f"date pattern {fmt!r}: parts are YYYY or YY, MM and DD, each once")
    quoted = re.sub("[^YMD]", lambda m: "\'\'" if m[0] == "\'" else f"\'{m[0]}\'", fmt)
    return _TOKEN.sub(lambda m: _TOKENS[m[0]], quoted)


def has_two_digit_year(fmt: str) -> bool:
    return "YY" in fmt.replace("YYYY", "")


def has_literals(fmt: str) -> bool:
    return bool(_TOKEN.sub("", fmt))


def parse_with_pattern(text: Column, fmt: str) -> Column:
    """Parse text with a ``YYYYMMDD``-style pattern; null where it does not parse.

    Two-digit years follow the C ``strptime`` pivot: 69-99 are 19xx and 00-68
    are 20xx (Spark alone would read every ``yy`` as 20xx).
    """
    ts = F.try_to_timestamp(text, F.lit(spark_pattern(fmt)))
    if has_two_digit_year(fmt):
        # ts only in always-evaluated positions, so it is parsed once per row
        back = F.when(F.year(ts) >= 2069, F.lit(-1200)).otherwise(F.lit(0))
        ts = F.add_months(ts, back).cast("timestamp")
    return ts


def day_name(d: Column) -> Column:
    """Spanish weekday name of a date (Monday = Lunes)."""
    return F.element_at(F.array(*[F.lit(n) for n in DAY_NAMES]), F.weekday(d) + 1)


def month_name(d: Column) -> Column:
    """Spanish month name of a date."""
    return F.element_at(F.array(*[F.lit(n) for n in MONTH_NAMES]), F.month(d))
