import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemill.errors import DateFormatError, KeyFormatError
from tidemill.plans import flows


def _facts(spark, days):
    return spark.createDataFrame([(i, d) for i, d in enumerate(days)], "id long, day long")


def test_daily_facts_golden_and_order(spark):
    out = flows.daily_facts(_facts(spark, [20150102, 20150102, 20150101]), day_col="day", key="sales_ID",
                            order_by=["id"])
    assert out.columns[0] == "sales_ID"
    rows = sorted((r["id"], r["sales_ID"], r["day"]) for r in out.collect())
    assert rows == [(0, "201501020", dt.date(2015, 1, 2)), (1, "201501021", dt.date(2015, 1, 2)),
                    (2, "201501010", dt.date(2015, 1, 1))]


def test_daily_facts_checks_in_original_order(spark):
    with pytest.raises(KeyFormatError):
        flows.daily_facts(spark.createDataFrame([(0, "2015x102")], "id long, day string"),
                          day_col="day", key="k", order_by=["id"])
    with pytest.raises(DateFormatError) as e:
        flows.daily_facts(_facts(spark, [20150102, 2015010]), day_col="day", key="k", order_by=["id"])
    assert e.value.code == 3
    with pytest.raises(DateFormatError) as e:
        flows.daily_facts(_facts(spark, [20150230]), day_col="day", key="k", order_by=["id"])
    assert e.value.code == 9


def test_daily_facts_hot_days_are_numbered_and_in_day_order(spark):
    days = [20150101] * 300 + [20150102 + (i % 5) for i in range(50)] + [20150103] * 400
    df = _facts(spark, days).repartition(5)
    out = flows.daily_facts(df, day_col="day", key="k", order_by=["id"])
    rows = out.withColumn("p", F.spark_partition_id()).select("p", "k", "day", "id").collect()
    from pyspark.sql import Window
    ref = df.withColumn("n", F.row_number().over(Window.partitionBy("day").orderBy("id")) - 1)
    assert {(r["id"], r["k"]) for r in rows} == {(r["id"], f"{r['day']}{r['n']}") for r in ref.collect()}
    by_part = {}
    for r in rows:
        by_part.setdefault(r["p"], []).append((r["day"], r["id"]))
    in_order = [x for _, part in sorted(by_part.items()) for x in part]
    assert in_order == sorted(in_order)


def test_daily_facts_counts_every_violation(spark):
    days = [20150101 + i % 28 for i in range(400)] * 2 + [20150230] * 3
    with pytest.raises(DateFormatError) as e:
        flows.daily_facts(_facts(spark, days), day_col="day", key="k", order_by=["id"])
    assert e.value.code == 9 and "3 values" in str(e.value)


def test_load_records_metadata(spark, db):
    import datetime as dt2
    df = flows.daily_facts(_facts(spark, [20150102, 20150102, 20150101]), day_col="day", key="sales_ID",
                           order_by=["id"])
    rep = flows.load(df.select("sales_ID", "day", "id"), f"{db}.sales_day", 3, "sales_ID",
                     summary_table=f"{db}.summary_tables", loads_table=f"{db}.summary_loads",
                     as_of=dt2.date(2025, 1, 1))
    assert rep.inserted == 3
    s = spark.table(f"{db}.summary_tables").first()
    assert (s["table_id"], s["table_name"], s["rows"], s["columns"]) == (3, "sales_day", 3, 3)
    rep2 = flows.load(df.select("sales_ID", "day", "id"), f"{db}.sales_day", 3, "sales_ID",
                      summary_table=f"{db}.summary_tables", loads_table=f"{db}.summary_loads",
                      as_of=dt2.date(2025, 1, 1))
    assert rep2.ignored == 3
    ids = sorted(r["load_id"] for r in spark.table(f"{db}.summary_loads").collect())
    assert ids == ["20250101-1", "20250101-2"]
    assert spark.table(f"{db}.summary_tables").count() == 1


def test_settings_file(tmp_path):
    import json
    from tidemill.plans.settings import CalendarSettings, FactSettings, load_settings
    p = tmp_path / "settings.json"
    p.write_text(json.dumps({"flows": {
        "sales": {"table_name": "sales_day", "table_id": 3, "key": "sales_ID", "day_col": "Sales_DAY"},
        "calendar": {"start": "01-01-2015", "end": "31-12-2015"}}}))
    got = load_settings(str(p))
    assert got["sales"] == FactSettings("sales_day", 3, "sales_ID", "Sales_DAY")
    assert isinstance(got["calendar"], CalendarSettings) and got["calendar"].end == "31-12-2015"


def test_failure_context(spark):
    from tidemill.errors import failure_context
    text = failure_context(spark.range(100))
    assert "id:bigint" in text and text.count("'id'") == 5


def test_stage_writes_once_and_reads_back(spark):
    from tidemill.session import stage
    df = spark.range(10).selectExpr("id", "id * 2 AS twice")
    staged = stage(df, "unit")
    assert sorted(tuple(r) for r in staged.collect()) == [(i, 2 * i) for i in range(10)]
    assert "FileScan parquet" in staged._jdf.queryExecution().executedPlan().toString()


def test_daily_facts_layout_is_day_ordered(spark):
    days = [20150101 + (i * 7) % 28 for i in range(400)]
    out = flows.daily_facts(_facts(spark, days), day_col="day", key="k", order_by=["id"])
    rows = out.withColumn("p", F.spark_partition_id()).select("p", "k", "day", "id").collect()
    by_part = {}
    for r in rows:  # collect keeps each partition's row order
        by_part.setdefault(r["p"], []).append((r["day"], r["id"]))
    for seq in by_part.values():
        assert seq == sorted(seq)
    ranges = [(min(v)[0], max(v)[0]) for _, v in sorted(by_part.items())]
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))


# The eight outlet size categories and their codes.
SIZES = {"<2m2": 1, "2-5m2": 2, "5-10m2": 3, "10-20m2": 4, "20-30m2": 5, ">20m2": 6, ">30m2": 7, "N.D.": 8}


def test_outlets_flow_fixture_cases(spark):
    from tidemill.errors import CategoryError
    sizes = list(SIZES)
    outlets = spark.createDataFrame(
        [(i, f"A{i}", f"Name {i}", [28001, 28002, 99999][i % 3], ["Urbana", None, "Rural"][i % 3], sizes[i % 8])
         for i in range(8)],
        "ord int, Affiliated_Code string, Affiliated_NAME string, POSTALCODE long, Location string, Tam_m2 string")
    postcodes = spark.createDataFrame(
        [(0, 28001, None, 1, "Madrid"), (1, 28001, "Madrid", 1, "Madrid"),   # FIRST skips the null first row
         (2, 28002, None, None, None),                                        # an all-null group
         (3, None, "Lost", 9, "Nowhere")],                                    # a null key is dropped
        "ord int, cp long, poblacion string, provinciaid long, provincia string")
    types = {"Affiliated_Code": "str", "Affiliated_Name": "str", "Location": "str", "Location_num": "int",
             "Tam_m2": "str", "Tam_m2_num": "int", "cp": "str", "poblacion": "str", "provinciaid": "int",
             "provincia": "str", "ord": "int"}
    kwargs = dict(rename={"Affiliated_NAME": "Affiliated_Name", "POSTALCODE": "cp"}, postcode_key="cp",
                  postcode_aggs={"poblacion": "FIRST", "provinciaid": "FIRST", "provincia": "FIRST"},
                  outlet_order=["ord"], postcode_order=["ord"], location_col="Location", size_col="Tam_m2",
                  size_codes=SIZES, key="Affiliated_Code", expected_types=types)
    rows = {r["Affiliated_Code"]: r for r in flows.outlets_dimension(outlets, postcodes, **kwargs).collect()}
    assert (rows["A0"]["Location_num"], rows["A1"]["Location_num"], rows["A2"]["Location_num"]) == (1, 0, 2)
    assert (rows["A0"]["poblacion"], rows["A0"]["provinciaid"], rows["A0"]["cp"]) == ("Madrid", 1, "28001")
    assert rows["A1"]["poblacion"] is None and rows["A1"]["provincia"] is None      # all-null group
    assert rows["A2"]["poblacion"] is None and rows["A2"]["cp"] == "99999"           # no postcode row
    assert rows["A7"]["Tam_m2_num"] == 8
    with pytest.raises(CategoryError) as e:                                           # eighth size missing
        flows.outlets_dimension(outlets.where("Tam_m2 <> 'N.D.'"), postcodes, **kwargs)
    assert e.value.code == 4


def test_outlets_flow_stops_on_duplicates_and_keeps_stored_codes(spark):
    from tidemill.errors import DuplicateKeyError
    from tidemill.operators.columns import category_mapping
    outlets = spark.createDataFrame([(i, f"A{i}", 1, "xyz"[i % 3], "s") for i in range(6)],
                                    "ord int, code string, cp long, loc string, size string")
    postcodes = spark.createDataFrame([(0, 1, "p")], "ord int, cp long, name string")
    kwargs = dict(rename={"code": "Code"}, postcode_key="cp", postcode_aggs={"name": "FIRST"}, outlet_order=["ord"],
                  postcode_order=["ord"], location_col="loc", size_col="size", size_codes={"s": 1}, key="Code")
    with pytest.raises(DuplicateKeyError):
        flows.outlets_dimension(outlets.union(outlets), postcodes, **kwargs)
    codes = category_mapping(outlets, "loc", ["ord"])
    turned = outlets.withColumn("ord", -F.col("ord"))
    got = flows.outlets_dimension(turned, postcodes, location_codes=codes, **kwargs).collect()
    assert {(r["loc"], r["loc_num"]) for r in got} == {("x", 1), ("y", 2), ("z", 3)}
