"""Flows from settings: sources → stored sources → frame → load → summary, resumable after a failure.

Each step of a run is stored under the shared work folder, with the counts of rows and nulls that ``observe`` takes from
the very write: a source is read once, and every later check and step reads the stored rows. A run that failed, begun
again under its id, takes up finished steps and repeats the rest; a finished run returns its report again.

A failed step raises its own typed error, with the schema and first rows of what it worked on as notes
(:func:`tidemill.errors.failure_context`); the target table is switched last, after all checks.
"""

from __future__ import annotations

import datetime as dt
import logging
import re
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemill.errors import InputError, SourceError, failure_context
from tidemill.operators._checks import is_missing
from tidemill.operators.quality import conform_types
from tidemill.plans import flows
from tidemill.plans.settings import CalendarSettings, FactSettings, OutletSettings, ProductSettings
from tidemill.session import discard, finished, run_root
from tidemill.sinks.summary import record_load, record_table_summary
from tidemill.sinks.upsert import UpsertReport, upsert
from tidemill.sources.csv import extract_csv, with_row_order

log = logging.getLogger(__name__)

ROW = "_tm_row"   # the row order of a source that came from files
Settings = OutletSettings | ProductSettings | FactSettings | CalendarSettings
Source = DataFrame | Callable[[], DataFrame]
REPORT = "table string, inserted long, updated long, ignored long, retained long"


@dataclass(frozen=True)
class Stored:
    """A step's rows as stored, and what its write counted."""
    frame: DataFrame
    rows: int
    nulls: dict[str, int]   # of the columns that have any


def _counts(df: DataFrame) -> list:
    return [F.count(F.lit(1)).alias("rows"), *[F.count_if(is_missing(df, c)).alias(f"n{i}") for i, c in enumerate(df.columns)]]


def store_checked(df: DataFrame, path: str) -> Stored:
    """Write ``df`` to ``path`` and count its rows and nulls (NaN too) in the same job; a folder that a lost run left is replaced."""
    seen = Observation()
    df.observe(seen, *_counts(df)).write.mode("overwrite").parquet(path)
    return _stored(df.sparkSession.read.schema(df.schema).parquet(path), seen.get)


def _stored(frame: DataFrame, counts: Mapping[str, int]) -> Stored:
    nulls = {c: counts[f"n{i}"] for i, c in enumerate(frame.columns)}
    return Stored(frame, counts["rows"], {c: n for c, n in nulls.items() if n})


class Run:
    """The stored steps of one run of one flow."""

    def __init__(self, spark: SparkSession, run_id: str, flow: str):
        for part in (run_id, flow):
            if not isinstance(part, str) or not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_-]*", part):
                raise InputError(1, f"a run's id and flow are letters, digits, - and _: {part!r}")
        self.spark, self.flow = spark, flow
        self.folder = f"{run_root(spark)}/runs/{run_id}/{flow}"

    def step(self, name: str, make: Callable[[], DataFrame], of: Mapping[str, DataFrame] | None = None) -> Stored:
        """The rows of a finished step, else those of ``make``, stored. ``of``: what to show if it fails."""
        path = f"{self.folder}/{name}"
        with self.explained(name, of or {}):
            if finished(self.spark, path):
                frame = self.spark.read.parquet(path)
                return _stored(frame, frame.agg(*_counts(frame)).first().asDict())
            return store_checked(make(), path)

    @contextmanager
    def explained(self, name: str, of: Mapping[str, DataFrame]) -> Iterator[None]:
        """Errors of a step carry the context of its inputs, and are logged."""
        try:
            yield
        except Exception as error:
            if getattr(error, "__notes__", None):  # told by the step within
                raise
            error.add_note(f"flow '{self.flow}', step '{name}'")
            for label, df in of.items():
                error.add_note(f"{label}: {failure_context(df)}")
            log.error("flow '%s', step '%s' failed: %s\n%s", self.flow, name, error, "\n".join(error.__notes__))
            raise

    def done(self, *names: str) -> None:
        """Delete the rows of steps that nothing reads any more."""
        for name in names:
            discard(self.spark, f"{self.folder}/{name}")


def _from_files(spark: SparkSession, path: str, delimiter: str) -> DataFrame:
    return with_row_order(extract_csv(spark, path, delimiter), ROW)


def _inputs(spark: SparkSession, settings: Settings, given: Mapping[str, Source]) -> dict[str, Callable[[], DataFrame]]:
    """A maker for each source of a flow: a given frame or function, else the CSV file that the settings name."""
    paths = {OutletSettings: {"outlets": "source_path", "postcodes": "postcode_path"}, ProductSettings: {"products": "source_path"},
             FactSettings: {"facts": "source_path"}, CalendarSettings: {"holidays": ""}}[type(settings)]
    out = {}
    for name, setting in paths.items():
        source, path = given.get(name), getattr(settings, setting, "")
        if source is None and not path:
            raise SourceError(1, f"{settings.table_name}: no source '{name}' is given, and no path in the settings")
        if source is None:
            out[name] = lambda path=path: _from_files(spark, path, settings.delimiter)
        else:
            out[name] = source if callable(source) else (lambda source=source: source)
    return out


def _frame(settings: Settings, stored: Mapping[str, DataFrame]) -> DataFrame:
    """The flow's frame from its stored sources."""
    def order(names: list[str], df: DataFrame) -> list[str]:
        if not names and ROW not in df.columns:
            raise InputError(1, f"{settings.table_name}: rows that come from no file need their order in the settings")
        return names or [ROW]

    s = settings
    if isinstance(s, OutletSettings):
        outlets, postcodes = stored["outlets"], stored["postcodes"]
        df = flows.outlets_dimension(
            outlets, postcodes, rename=s.rename, postcode_key=s.postcode_key, postcode_aggs=s.postcode_aggs,
            outlet_order=order(s.order_by, outlets), postcode_order=order(s.postcode_order, postcodes),
            location_col=s.location_col, size_col=s.size_col, size_codes=s.size_codes, key=s.key, checks=False)
    elif isinstance(s, ProductSettings):
        df = flows.products_dimension(stored["products"], key=s.key, order_by=order(s.order_by, stored["products"]), checks=False)
    elif isinstance(s, FactSettings):
        facts = stored["facts"]
        df = flows.daily_facts(facts, day_col=s.day_col, key=s.key, order_by=order(s.order_by, facts),
                               date_format=s.date_format, checks=False)
    else:
        df = flows.calendar_dimension(stored["holidays"], start=s.start, end=s.end, day_col=s.key)
    df = df.drop(ROW)
    types = getattr(s, "expected_types", None)
    return conform_types(df, types) if types else df


def run_flow(spark: SparkSession, name: str, settings: Settings, sources: Mapping[str, Source], *, database: str,
             as_of: dt.date, run_id: str, summary_table: str = "summary_tables", loads_table: str = "summary_loads",
             **layout) -> UpsertReport:
    """Run one flow into ``database`` and record it in both control tables.

    ``sources``: the frames (or functions that make them) of the flow's inputs (outlets and postcodes, products, facts,
    holidays); those left out are read from the settings' CSV paths. ``layout`` goes to the upsert (``buckets``,
    ``partition_by``, ``key_buckets``). Columns with nulls are logged, bad days and keys, empty frames, duplicate keys and
    types that don't conform raise before the table changes. Lost between its load and the store of its report, a run
    repeats its load, which then counts all rows as ignored; lost between the record of its load and its end, it records
    the load twice.
    """
    run = Run(spark, run_id, name)
    table = f"{database}.{settings.table_name}"

    def loaded() -> DataFrame:
        stored = {}
        for source, make in _inputs(spark, settings, sources).items():
            stored[source] = run.step(f"source-{source}", make)
            for column, n in stored[source].nulls.items():
                log.warning("%s, %s: %d of %d rows of '%s' are null", name, source, n, stored[source].rows, column)
        inputs = {label: s.frame for label, s in stored.items()}
        frame = run.step("frame", lambda: _frame(settings, inputs), inputs).frame
        with run.explained("load", {"frame": frame}):
            report = upsert(frame, table, settings.key, **layout)
        return spark.createDataFrame([report.as_row()], REPORT)

    report = UpsertReport(*run.step("report", loaded).frame.first())
    if not finished(spark, f"{run.folder}/recorded"):
        with run.explained("summary", {}):
            record_table_summary(spark, f"{database}.{summary_table}", settings.table_id, table, as_of)
            record_load(spark, f"{database}.{loads_table}", settings.table_id, report, as_of)
            run.step("recorded", lambda: spark.createDataFrame([(name,)], "flow string"))
    run.done("frame", *[f"source-{s}" for s in ("outlets", "postcodes", "products", "facts", "holidays")])
    return report


def run_all(spark: SparkSession, settings: Mapping[str, Settings], sources: Mapping[str, Mapping[str, Source]], *,
            database: str, as_of: dt.date, run_id: str, layouts: Mapping[str, Mapping] | None = None, **names) -> DataFrame:
    """All flows of ``settings`` in their order, up to the first that fails; ``flow`` and its report for each.

    ``sources`` and ``layouts`` are by flow. Begun again under the same ``run_id``, finished flows are not run again.
    """
    rows = [(flow, *run_flow(spark, flow, own, sources.get(flow, {}), database=database, as_of=as_of, run_id=run_id,
                             **names, **(layouts or {}).get(flow, {})).as_row())
            for flow, own in settings.items()]
    return spark.createDataFrame(rows, f"flow string, {REPORT}")
