"""Flows from settings: one scan of a source, resumed runs, context of failures."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemill.errors import DuplicateKeyError, InputError, KeyFormatError, SourceError
from tidemill.plans.runner import Run, run_all, run_flow, store_checked
from tidemill.plans.settings import FactSettings, OutletSettings, ProductSettings, load_settings
from tidemill.session import finished, fresh_path
from tidemill.sinks.tables import table_exists

DAY = dt.date(2025, 1, 1)
SALES = FactSettings("sales_day", 3, "sales_ID", "Sales_DAY", order_by=["n"])
PRODUCTS = ProductSettings(order_by=["n"], expected_types={"Product_Code": "str", "n": "int"})


def facts(spark, days):
    return spark.createDataFrame([(d, i, None if i % 2 else i) for i, d in enumerate(days)], "Sales_DAY long, n long, v long")


def products(spark, names):
    return spark.createDataFrame([(c, i) for i, c in enumerate(names)], "Product_Code string, n long")


def test_a_source_is_read_once(spark, db):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(n):
        seen.add(1)
        return n

    days = [20240101 + i % 28 for i in range(300)]
    source = facts(spark, days).withColumn("n", counted.asNondeterministic()("n"))
    report = run_flow(spark, "sales", SALES, {"facts": source}, database=db, as_of=DAY, run_id=db)
    assert report.inserted == 300 and seen.value == 300
    again = run_flow(spark, "sales", SALES, {"facts": source}, database=db, as_of=DAY, run_id=db)
    assert again == report and seen.value == 300  # a finished run is not run again
    assert spark.table(f"{db}.summary_loads").count() == 1
    run = Run(spark, db, "sales")
    assert finished(spark, f"{run.folder}/report") and not finished(spark, f"{run.folder}/source-facts")
    later = run_flow(spark, "sales", SALES, {"facts": source}, database=db, as_of=DAY, run_id=f"{db}-2")
    assert (later.inserted, later.ignored) == (0, 300)


def test_nulls_are_counted_by_the_write(spark):
    df = spark.createDataFrame([(1, None, float("nan")), (2, "a", 1.0), (3, None, None)], "a long, b string, c double")
    stored = store_checked(df, fresh_path(spark, "checked"))
    assert (stored.rows, stored.nulls, stored.frame.count()) == (3, {"b": 2, "c": 2}, 3)
    empty = store_checked(df.where("a > 5"), fresh_path(spark, "checked"))
    assert (empty.rows, empty.nulls, empty.frame.columns) == (0, {}, df.columns)


def test_a_failed_run_is_resumed(spark, db):
    made = []

    def source(name, df):
        return lambda: made.append(name) or df

    settings = {"products": PRODUCTS, "sales": SALES}
    given = {"products": {"products": source("products", products(spark, ["a", "b", "a"]))},
             "sales": {"facts": source("bad", facts(spark, [20240101, 1, None]))}}
    with pytest.raises(KeyFormatError) as e:
        run_all(spark, settings, given, database=db, as_of=DAY, run_id=db)
    notes = "\n".join(e.value.__notes__)
    assert e.value.code == 3 and "flow 'sales', step 'frame'" in notes and "'Sales_DAY': 20240101" in notes
    assert notes.count("flow 'sales'") == 1
    assert table_exists(spark, f"{db}.product") and not table_exists(spark, f"{db}.sales_day")
    # the stored source is taken up again: a corrected one needs a new run
    with pytest.raises(KeyFormatError):
        run_all(spark, settings, given, database=db, as_of=DAY, run_id=db)
    assert made == ["products", "bad"]
    given["sales"] = {"facts": source("good", facts(spark, [20240101, 20240101]))}
    out = run_all(spark, settings, given, database=db, as_of=DAY, run_id=f"{db}-2")
    got = {r["flow"]: (r["inserted"], r["updated"], r["ignored"]) for r in out.collect()}
    assert got == {"products": (0, 0, 3), "sales": (2, 0, 0)}
    assert {r[0] for r in spark.table(f"{db}.product").select("Product_Code").collect()} == {"a", "b", "a - 2"}


def test_errors_come_before_the_table_changes(spark, db):
    plain = {"outlets": spark.createDataFrame([("1", 1, "x", "s"), ("1", 2, "y", "s")], "Code string, cp long, Location string, Tam_m2 string"),
             "postcodes": spark.createDataFrame([(1, "p")], "cp long, town string")}
    outlets = OutletSettings(key="Code", postcode_aggs={"town": "FIRST"}, rename={"Code": "Code"}, size_codes={"s": 1}, order_by=["cp"],
                             postcode_order=["town"])
    with pytest.raises(DuplicateKeyError) as e:
        run_flow(spark, "outlets", outlets, plain, database=db, as_of=DAY, run_id=db)
    assert e.value.code == 2 and "step 'load'" in e.value.__notes__[0]
    with pytest.raises(InputError) as e:
        run_flow(spark, "sales", SALES, {"facts": facts(spark, [])}, database=db, as_of=DAY, run_id=db)
    assert e.value.code == 1
    with pytest.raises(SourceError) as e:
        run_flow(spark, "products", PRODUCTS, {}, database=db, as_of=DAY, run_id=db)
    assert e.value.code == 1
    with pytest.raises(InputError):
        run_flow(spark, "../sales", SALES, {}, database=db, as_of=DAY, run_id=db)
    assert not any(table_exists(spark, f"{db}.{t}") for t in ("affiliated_outlets", "sales_day", "product", "summary_loads"))


def test_csv_paths_from_a_settings_file(spark, db, tmp_path):
    (tmp_path / "sales.csv").write_text("Sales_DAY;v\n20240102;b\n20240101;a\n20240102;c\n")
    (tmp_path / "product.csv").write_text("Product_Code;SIZE\nx;1\ny;2\nx;3\n")
    (tmp_path / "settings.json").write_text(json.dumps({"flows": {
        "products": {"source_path": str(tmp_path / "product.csv"), "expected_types": {"Product_Code": "str", "SIZE": "int"}},
        "sales": {"table_name": "sales_day", "table_id": 3, "key": "sales_ID", "day_col": "Sales_DAY",
                  "source_path": str(tmp_path / "sales.csv")}}}))
    out = run_all(spark, load_settings(str(tmp_path / "settings.json")), {}, database=db, as_of=DAY, run_id=db)
    assert [(r["flow"], r["inserted"]) for r in out.collect()] == [("products", 3), ("sales", 3)]
    assert {tuple(r) for r in spark.table(f"{db}.product").collect()} == {("x", 1), ("y", 2), ("x - 2", 3)}
    assert {(r["sales_ID"], r["v"]) for r in spark.table(f"{db}.sales_day").collect()} == {
        ("202401010", "a"), ("202401020", "b"), ("202401021", "c")}
