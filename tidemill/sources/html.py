"""Holiday rows from stored HTML pages.

The pages arrive as data — a DataFrame ``(region, year, html)`` — so parsing is
a distributed scan: a page is split at its table, row and cell tags, with a fold that keeps the
depth where tables stand inside tables; no page is fetched and nothing runs per row in Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.text import bound, decode_entities, squeezed
from tidemill.operators._checks import require_columns
from tidemill.operators.holidays import NATIONAL, REGIONAL

# Source type labels kept, and what each becomes.
HOLIDAY_TYPES = {"Public Holiday": NATIONAL, "Regional Holiday": REGIONAL}
TABLE_CLASS = "country-table"

_COMMENT = r"(?s)<!--.*?(?:-->|$)"
_OPEN, _CLOSE = "\u0001", "\u0002"  # stand before a table's start and end tags
_STRUCTURE = r"(?i)</?(?:tr|t[dh]|thead|tbody|tfoot|caption|col|colgroup)\b[^>]*>"


def _own_markup(text: Column) -> Column:
    """What follows a table's start tag up to the tag that ends it, without the structure of tables inside.

    The text is split at the tags that start and end tables, and a fold over these pieces keeps the depth: pieces
    inside keep their text alone. A table that nothing ends goes on to the end of the page.
    """
    marked = F.regexp_replace(F.translate(text, _OPEN + _CLOSE, "  "), r"(?i)<(?=table\b)", _OPEN + "<")
    marked = F.regexp_replace(marked, r"(?i)<(?=/table\b)", _CLOSE + "<")
    pieces = F.split(marked, f"(?=[{_OPEN}{_CLOSE}])")

    def step(state: Column, piece: Column) -> Column:
        change = F.when(piece.startswith(_OPEN), 1).when(piece.startswith(_CLOSE), -1).otherwise(0)
        depth = F.when(state["depth"] > 0, state["depth"] + change).otherwise(0)
        own = F.regexp_replace(piece, f"^[{_OPEN}{_CLOSE}]<[^>]*>", "")
        added = F.when(depth == 1, own).when(depth > 1, F.regexp_replace(own, _STRUCTURE, "")).otherwise("")
        return F.struct(depth.alias("depth"), F.concat(state["text"], added).alias("text"))

    nested = F.aggregate(pieces, F.struct(F.lit(1).alias("depth"), F.lit("").alias("text")), step, lambda s: s["text"])
    simple = F.get(F.split(text, r"(?i)</table\b", 2), F.lit(0))
    return bound(simple, lambda t: F.when(t.rlike(r"(?i)<table\b"), nested).otherwise(t))


def _before(c: Column, tag: str) -> Column:
    """The text up to the first such tag, or all of it."""
    return F.get(F.split(c, tag, 2), F.lit(0))


def table_cells(html: Column, table_class: str = TABLE_CLASS) -> Column:
    """The body rows of a page's first table of that class: an array of rows, each an array of its cells' texts.

    End tags may be left out, as HTML allows: a cell ends where the next cell or row starts, a row where
    the next one starts, a table's body where its foot or the next body starts. A table inside a cell adds its text to that cell, and no rows. The body
    is the table's first ``tbody``, or the whole table if it has none. Comments are skipped; a page without the table
    has no rows.
    """
    page = F.when(F.contains(html, F.lit("<!--")), F.regexp_replace(html, _COMMENT, "")).otherwise(html)
    after = F.get(F.split(page, rf"(?is)<table\b[^>]*\b{table_class}\b[^>]*>", 2), F.lit(1))
    body = bound(bound(after, _own_markup), lambda t: F.coalesce(
        _before(F.get(F.split(t, r"(?i)<tbody\b[^>]*>", 2), F.lit(1)), r"(?i)</?t(?:body|foot)\b"), t))
    rows = F.filter(F.split(body, r"(?i)<tr\b[^>]*>"), lambda x, i: i > 0)

    def cells(row: Column) -> Column:
        # an own mark instead of a tag, so that no pattern is compiled for every row
        pieces = F.split(F.regexp_replace(row, r"(?is)<t(?=[dh]\b)|</tr\b.*$", _OPEN), _OPEN)
        data = F.filter(pieces, lambda x, i: (i > 0) & x.rlike("^[dD]"))
        text = lambda x: F.regexp_replace(x, r"(?is)^[^>]*>|</t[dh]\b.*$|<[^>]*>", "")
        return F.transform(data, lambda x: bound(text(x), lambda t: squeezed(decode_entities(t))))

    return F.transform(rows, cells)


def holiday_rows(pages: DataFrame, region: str = "region", year: str = "year",
                 html: str = "html") -> DataFrame:
    """One row per kept holiday: ``Day`` (``DD-MM-YYYY``), ``Name``, ``Type``,
    ``Region``, ``Comments`` and ``row_pos`` (position on the page, for order).

    Rows with fewer than four cells are skipped; only public and regional
    holidays are kept; cell 2 is the date (``Mar 19``), 3 the name, 4 the type,
    5 an optional comment. A kept row whose date can't be read stops the job.
    """
    require_columns(pages, [region, year, html], "holiday_rows")
    # every cell is read once, below the generator; from a plain posexplode Spark infers a filter that reads them again
    rows = pages.select(F.col(region).alias("Region"), F.col(year).alias("_year"),
                        F.posexplode_outer(table_cells(F.col(html))).alias("row_pos", "_td"))
    cell = lambda i: F.get("_td", F.lit(i))
    kept = rows.where((F.size("_td") >= 4) & cell(3).isin(list(HOLIDAY_TYPES)))
    mapping = F.create_map(*[x for k, v in HOLIDAY_TYPES.items() for x in (F.lit(k), F.lit(v))])
    day = F.try_to_timestamp(F.concat_ws(" ", cell(1), F.col("_year").cast("string")),
                             F.lit("MMM d yyyy"))
    return kept.select(
        F.date_format(F.coalesce(day, F.raise_error(F.concat(
            F.lit("holiday_rows: not a date: "), cell(1), F.lit(" "), F.col("_year").cast("string"))).cast("timestamp")),
            "dd-MM-yyyy").alias("Day"),
        cell(2).alias("Name"),
        mapping[cell(3)].alias("Type"),
        F.col("Region"),
        F.coalesce(cell(4), F.lit("")).alias("Comments"),
        F.col("row_pos"),
    )
