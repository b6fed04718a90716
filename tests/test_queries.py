"""Every registered query against its DuckDB oracle at sf0.001, plus plan checks."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from tidemill.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_quoted_csv_is_written_in_parallel(spark, con, tmp_path, monkeypatch):
    """A part file for each partition, each with its own header; all are read."""
    whole = catalogue.table
    monkeypatch.setattr(catalogue, "table", lambda *a: whole(*a).repartition(3))
    monkeypatch.setattr(catalogue, "fresh_path", lambda *a: str(tmp_path / "csv"))
    df = catalogue.QUERIES["csv_quoted"](spark, SF)
    parts = list((tmp_path / "csv").glob("part-*"))
    assert len(parts) == 3
    assert all(p.read_text().startswith("c_custkey;note;spaced;code\n") for p in parts)
    found = con.execute(catalogue.ORACLE["csv_quoted"])
    assert _rows(df.columns, df.collect()) == _rows([d[0] for d in found.description], found.fetchall())


def test_every_query_has_an_oracle():
    from tidemill.plans.catalogue import ORACLE, QUERIES
    assert set(QUERIES) == set(ORACLE)
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(E.oracle_sql()[name])
    exp = _rows([d[0] for d in res.description], res.fetchall())
    assert sorted(df.columns) == sorted(d[0] for d in res.description)
    assert got == exp


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0


@pytest.mark.parametrize("name", ["flow_outlets", "flow_sales", "holiday_merge", "upsert_report", "join_full"])
def test_no_python_in_plans(spark, name):
    df = E.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    df = E.queries()["null_report"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderpriority), IsNotNull(o_orderstatus), EqualTo(o_orderpriority,1-URGENT)" in plan \
        or "EqualTo(o_orderpriority,1-URGENT)" in plan
