"""Text helpers."""

from __future__ import annotations

from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text tokens pandas' CSV reader treats as missing by default.
MISSING_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                  "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
                  "n/a", "nan", "null"]

LIST_SEPARATOR = " , "


def digits_only(c: Column) -> Column:
    """Remove every non-digit; empty result becomes null."""
    return F.nullif(F.regexp_replace(c.cast("string"), r"\D", ""), F.lit(""))


def strip_tags(c: Column) -> Column:
    """Drop markup, decode all entities, trim (like ``get_text(strip=True)``)."""
    plain = F.when(F.contains(c, F.lit("<")), F.regexp_replace(c, r"<[^>]*>", "")).otherwise(c)
    return bound(plain, lambda t: squeezed(decode_entities(t)))


def squeezed(c: Column) -> Column:
    """White space as single spaces, none at the ends."""
    return F.trim(F.regexp_replace(c, r"[\s\u00a0]{2,}|[^\S ]|\u00a0", " "))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, however often ``use`` refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _entity_names() -> Column:
    """Texts by name, by the name's first letter: the values of a literal map are searched one by one."""
    by_letter: dict[str, list[str]] = {}
    for name, text in sorted(html5.items()):
        if name.endswith(";"):
            by_letter.setdefault(name[0], []).extend((name[:-1], text))
    return F.create_map(*[x for letter, pairs in by_letter.items()
                          for x in (F.lit(letter), F.create_map(*[F.lit(p) for p in pairs]))])


def decode_entities(c: Column) -> Column:
    """Replace named (``&eacute;``) and numeric (``&#243;``, ``&#xF3;``) entities; unknown ones stay.

    Text without ``&`` is left as it is; names are looked up only where one stands.
    """
    def text_of(name: Column) -> Column:
        number = F.when(name.rlike("^#[xX]"), F.conv(F.substr(name, F.lit(3)), 16, 10)).otherwise(
            F.substr(name, F.lit(2))).cast("int")
        numeric = bound(number, lambda n: F.when(
            n.between(1, 0xD7FF) | n.between(0xE000, 0x10FFFF),
            F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")))
        named = F.element_at(F.element_at(_entity_names(), F.left(name, F.lit(1))), name)
        return F.when(name.startswith("#"), numeric).otherwise(named)

    def decoded(part: Column) -> Column:
        name = F.regexp_extract(part, r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);", 1)
        found = bound(name, lambda n: F.when(n != "", F.concat(text_of(n), F.substr(part, F.length(n) + 2))))
        return F.coalesce(found, F.concat(F.lit("&"), part))

    parts = F.transform(F.split(c, "&"), lambda part, i: F.when(i == 0, part).otherwise(decoded(part)))
    return F.when(F.contains(c, F.lit("&")), F.array_join(parts, "")).otherwise(c)


def json_text(c: Column, is_array: bool) -> Column:
    """Text form of a JSON value: arrays joined by ``" , "``, else the value.

    A column that is text in some records and a list in others arrives as text
    holding the raw list; those values are decoded and joined as well.
    """
    if is_array:
        return F.array_join(c.cast("array<string>"), LIST_SEPARATOR)
    s = c.cast("string")
    decoded = F.from_json(s, "array<string>")
    return F.when(F.ltrim(s).startswith("[") & decoded.isNotNull(),
                  F.array_join(decoded, LIST_SEPARATOR)).otherwise(s)
