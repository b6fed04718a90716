import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemill.errors import DuplicateKeyError, SchemaError, SourceError, TableError, ViewError
from tidemill.operators import quality as Q
from tidemill.operators.holidays import merge_holidays
from tidemill.session import fresh_path
from tidemill.sinks import summary as SM
from tidemill.sinks import tables as TB
from tidemill.sinks import upsert as UP
from tidemill.sinks.views import create_views
from tidemill.sources.calendar import create_calendar
from tidemill.sources.csv import extract_csv
from tidemill.sources.html import holiday_rows
from tidemill.sources.json import extract_json


def _write_text(spark, text: str) -> str:
    path = fresh_path(spark, "txt")
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    return path


def test_csv_inference_and_missing_tokens(spark):
    path = _write_text(spark, "a;b;c;d;e\n1;1.5;True;x;N.D.\nNA;2;False;;null")
    df = extract_csv(spark, path)
    types = dict(df.dtypes)
    assert types == {"a": "bigint", "b": "double", "c": "boolean", "d": "string", "e": "string"}
    rows = sorted(df.collect(), key=lambda r: r["b"])
    assert rows[0]["a"] == 1 and rows[0]["e"] == "N.D."
    assert rows[1]["a"] is None and rows[1]["d"] is None and rows[1]["e"] is None
    with pytest.raises(SourceError) as e:
        extract_csv(spark, "/nonexistent/file.csv")
    assert e.value.code == 1


def test_json_mixed_list_column_and_types(spark):
    text = ('[{"Day": "01-02-2015", "Region": ["B", "A"], "n": 1, "f": true, "o": {"k": 3}},'
            ' {"Day": "x", "Region": "Todas", "n": 2, "f": false, "o": {"k": 4}}]')
    path = _write_text(spark, text)
    df = extract_json(spark, path, {"Day": "date", "Region": "str", "n": "int", "f": "bool", "o.k": "int"})
    rows = sorted(df.collect(), key=lambda r: r["n"])
    assert rows[0]["Day"] == "01022015" and rows[0]["Region"] == "B , A" and rows[0]["o.k"] == 3
    assert rows[1]["Day"] is None and rows[1]["Region"] == "Todas" and rows[1]["f"] is False
    with pytest.raises(SourceError) as e:
        extract_json(spark, path, {"missing": "str"})
    assert e.value.code == 3


def test_calendar_golden(spark):
    rows = create_calendar(spark, "01-01-2015", "02-01-2015").orderBy("Day").collect()
    assert [tuple(r) for r in rows] == [(dt.date(2015, 1, 1), 4, "Jueves", 1, "Enero", 2015),
                                        (dt.date(2015, 1, 2), 5, "Viernes", 1, "Enero", 2015)]
    assert create_calendar(spark, "01-01-2015", "31-12-2015").count() == 365


def test_html_rows(spark):
    page = ('<table class="country-table"><tbody>'
            "<tr><td>Thu</td><td>Mar 19</td><td>San Jos&amp;eacute;</td></tr>"
            "<tr><td>Thu</td><td>Mar 19</td><td>St &amp; Joseph</td><td>Regional Holiday</td></tr>"
            "<tr><td>Fri</td><td>Mar 20</td><td>Skip</td><td>Observance</td><td>c</td></tr>"
            "<tr><td>Wed</td><td>Jan 01</td><td>New Year</td><td><b>Public Holiday</b></td><td>note</td></tr>"
            "</tbody></table>")
    pages = spark.createDataFrame([("Murcia", 2015, page)], "region string, year int, html string")
    rows = sorted((tuple(r) for r in holiday_rows(pages).drop("row_pos").collect()), key=repr)
    assert rows == sorted([("19-03-2015", "St & Joseph", "Regional", "Murcia", ""),
                           ("01-01-2015", "New Year", "Nacional", "Murcia", "note")], key=repr)


def test_holiday_merge_golden(spark):
    e = spark.createDataFrame(
        [(0, "01-03-2015", "X", "Regional", "R2", ""), (1, "01-03-2015", "Y", "Regional", "R1", ""),
         (2, "01-03-2015", "X", "Regional", "R1", ""), (3, "01-01-2015", "X", "Regional", "R1", ""),
         (4, "01-01-2015", "Z", "Nacional", "R2", "c1")],
        "o int, Day string, Name string, Type string, Region string, Comments string")
    got = {r["Day"]: r for r in merge_holidays(e, ["o"]).collect()}
    assert (got["01-03-2015"]["Name"], got["01-03-2015"]["Region"], got["01-03-2015"]["Comments"],
            got["01-03-2015"]["Type"]) == ("X", ["R1", "R2"], "Y", "Regional")
    assert (got["01-01-2015"]["Name"], got["01-01-2015"]["Region"], got["01-01-2015"]["Type"],
            got["01-01-2015"]["Comments"]) == ("X", ["Todas"], "Nacional", "c1")


def test_upsert_golden_and_idempotent(spark, db):
    name = f"{db}.t"
    target = spark.createDataFrame([(1, "a"), (2, "b"), (4, "d")], "k long, v string")
    source = spark.createDataFrame([(1, "a"), (2, "x"), (3, "c")], "k long, v string")
    first = UP.upsert(target, name)
    assert (first.inserted, first.updated) == (3, 0)
    rep = UP.upsert(source, name)
    assert (rep.inserted, rep.updated, rep.ignored, rep.retained) == (1, 1, 1, 1)
    assert sorted(tuple(r) for r in spark.table(name).collect()) == [(1, "a"), (2, "x"), (3, "c"), (4, "d")]
    again = UP.upsert(source, name)
    assert (again.inserted, again.updated, again.ignored) == (0, 0, 3)


def test_upsert_guards(spark, db):
    dup = spark.createDataFrame([(1, "a"), (1, "b")], "k long, v string")
    with pytest.raises(DuplicateKeyError):
        UP.upsert(dup, f"{db}.d")
    UP.upsert(spark.createDataFrame([(1, "a")], "k long, v string"), f"{db}.e")
    with pytest.raises(SchemaError):
        UP.upsert(spark.createDataFrame([(1, "a")], "k long, w string"), f"{db}.e")
    only_key = spark.createDataFrame([(1,)], "k long")
    UP.upsert(only_key, f"{db}.f")
    assert UP.upsert(only_key, f"{db}.f").ignored == 1


def test_partitioned_upsert_touches_only_source_partitions(spark, db):
    name = f"{db}.p"
    base = spark.createDataFrame([(1, "a", "m1"), (2, "b", "m2")], "k long, v string, m string")
    UP.upsert(base, name, "k", partition_by=["m"])
    rep = UP.upsert(spark.createDataFrame([(1, "z", "m1"), (3, "c", "m1")], "k long, v string, m string"),
                    name, "k", partition_by=["m"])
    assert (rep.inserted, rep.updated, rep.retained) == (1, 1, 0)
    assert sorted(tuple(r) for r in spark.table(name).collect()) == [(1, "z", "m1"), (2, "b", "m2"), (3, "c", "m1")]


def test_replace_table_requires_existing(spark, db):
    df = spark.createDataFrame([(1,)], "k long")
    with pytest.raises(TableError):
        TB.replace_table(df, f"{db}.nope")


def test_load_ids_numeric_max(spark):
    loads = spark.createDataFrame([("20250101-9",), ("20250101-10",), ("20241231-50",)], "load_id string")
    assert SM.next_load_id(loads, dt.date(2025, 1, 1)).first()["load_id"] == "20250101-11"
    assert SM.next_load_id(loads, dt.date(2025, 1, 2)).first()["load_id"] == "20250102-1"


def test_views(spark):
    assert create_views(spark, {"v_t1": "SELECT 1 AS a"}, temporary=True) == ["v_t1"]
    for views, code in (({"1bad": "SELECT 1"}, 5), ({"v_t2": "SELEC 1"}, 3), ({"v_t3": "SELECT * FROM nope_x"}, 4)):
        with pytest.raises(ViewError) as e:
            create_views(spark, views, temporary=True)
        assert e.value.code == code


def test_conform_types(spark):
    df = spark.createDataFrame([("2.0", "x", 1, None), ("3", "1.5", 0, "2015-01-01")],
                               "a string, b string, c int, d string")
    out = Q.conform_types(df, {"b": "float", "a": "int", "c": "bool", "d": "datetime"})
    assert out.columns == ["b", "a", "c", "d"]
    assert sorted((r["a"], r["b"], r["c"]) for r in out.collect()) == [(2, None, True), (3, 1.5, False)]
    with pytest.raises(SchemaError) as e:
        Q.conform_types(spark.createDataFrame([("2.5",)], "a string"), {"a": "int"})
    assert e.value.code == 9
    with pytest.raises(SchemaError) as e:
        Q.conform_types(df, {"a": "int"})
    assert e.value.code == 2
    with pytest.raises(SchemaError):
        Q.conform_types(spark.createDataFrame([("True",)], "a string"), {"a": "bool"})
    rep = {r["column"]: r["nulled"] for r in Q.conform_report(df, {"b": "float", "a": "int", "c": "bool",
                                                                   "d": "datetime"}).collect()}
    assert rep == {"b": 1, "a": 0, "c": 0, "d": 0}


def test_reports(spark):
    df = spark.createDataFrame([(1, None), (1, "a"), (None, "a")], "k int, s string")
    assert {tuple(r) for r in Q.null_report(df).collect()} == {("k", 1), ("s", 1)}
    assert [tuple(r) for r in Q.duplicate_report(df, "k").collect()] == [(1, 2)]


def test_bucketed_upsert_shuffles_only_the_source(spark, db):
    name = f"{db}.b"
    c = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    UP.upsert(c.where("c_mktsegment <> 'AUTOMOBILE'"), name, "c_custkey", buckets=4)
    assert UP.bucket_spec(spark, name) == (4, ["c_custkey"])
    src = c.where("c_mktsegment IN ('AUTOMOBILE', 'BUILDING')")
    plan = UP.merge_plan(spark.table(name), src, "c_custkey", null_key=False)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1  # the source side only
    rep = UP.upsert(src, name, "c_custkey")
    assert rep.inserted == c.where("c_mktsegment = 'AUTOMOBILE'").count()
    assert UP.bucket_spec(spark, name) == (4, ["c_custkey"])
    assert spark.table(name).count() == c.count()


def test_null_key_row_is_matched(spark, db):
    name = f"{db}.n"
    UP.upsert(spark.createDataFrame([(None, "a"), (1, "b")], "k long, v string"), name)
    rep = UP.upsert(spark.createDataFrame([(None, "z")], "k long, v string"), name)
    assert (rep.updated, rep.retained) == (1, 1)
    assert {tuple(r) for r in spark.table(name).collect()} == {(None, "z"), (1, "b")}


def test_json_conversion_failure_is_code_9(spark):
    path = _write_text(spark, '[{"n": "12"}, {"n": "x"}]')
    with pytest.raises(SourceError) as e:
        extract_json(spark, path, {"n": "int"})
    assert e.value.code == 9
    assert [r["n"] for r in extract_json(spark, path, {"n": "int"}, strict=False).collect()] == [12, None]


def test_create_table_rejects_empty(spark, db):
    from tidemill.errors import InputError
    with pytest.raises(InputError):
        TB.create_table(spark.createDataFrame([], "k long"), f"{db}.empty")


def test_file_row_order_drives_order_dependent_operators(spark):
    from tidemill.operators import columns as C
    from tidemill.sources.csv import with_row_order
    base = fresh_path(spark, "csvorder")
    for part, text in (("a", "v;n\nb;1\nnull;2\na;3"), ("b", "v;n\nb;4\nc;5")):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{base}/{part}")
    df = with_row_order(extract_csv(spark, f"{base}/*"))
    codes = {r["n"]: r["v_num"] for r in C.category_codes(df, "v", order_by=["_row"]).collect()}
    assert codes == {1: 1, 2: 0, 3: 2, 4: 1, 5: 3}  # b, a, c by first appearance; null → 0


def test_reports_on_dotted_names(spark):
    path = _write_text(spark, '[{"o": {"k": 1}}, {"o": {"k": null}}, {"o": {"k": 1}}]')
    df = extract_json(spark, path, {"o.k": "int"})
    assert [tuple(r) for r in Q.null_report(df).collect()] == [("o.k", 1)]
    assert [tuple(r) for r in Q.duplicate_report(df, "o.k").collect()] == [(1, 2)]
    assert Q.conform_types(df, {"o.k": "float"}).columns == ["o.k"]


def test_touched_partitions_prune_the_target_scan(spark, db):
    name = f"{db}.pp"
    base = spark.createDataFrame([(1, "a", "m1"), (2, "b", "m2"), (3, "c", None)], "k long, v string, m string")
    UP.upsert(base, name, "k", partition_by=["m"])
    src = spark.createDataFrame([(1, "z", "m1"), (4, "d", None)], "k long, v string, m string")
    scoped = UP._touched_partitions(spark.table(name), src, ["m"])
    plan = scoped._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert {r["k"] for r in scoped.collect()} == {1, 3}
    rep = UP.upsert(src, name, "k", partition_by=["m"])
    assert (rep.inserted, rep.updated, rep.retained) == (1, 1, 1)
    assert {tuple(r) for r in spark.table(name).collect()} == {(1, "z", "m1"), (2, "b", "m2"), (3, "c", None),
                                                               (4, "d", None)}


def test_json_array_sink_roundtrip(spark):
    from tidemill.sinks.json import write_json_array
    df = spark.createDataFrame([(2, "b", ["y", "x"]), (1, "a", [])], "n int, s string, l array<string>")
    path = fresh_path(spark, "arr")
    write_json_array(df, path, order_by=["n"])
    back = extract_json(spark, path, {"n": "int", "s": "str", "l": "str"}, multi_line=True)
    assert sorted(tuple(r) for r in back.collect()) == [(1, "a", ""), (2, "b", "y , x")]


def test_upsert_follows_the_tables_own_partitioning(spark, db):
    name = f"{db}.own"
    UP.upsert(spark.createDataFrame([(1, "a", "m1"), (2, "b", "m2")], "k long, v string, m string"), name, "k",
              partition_by=["m"])
    # no partition_by given: the table's partitioning is used, other partitions survive
    rep = UP.upsert(spark.createDataFrame([(1, "z", "m1")], "k long, v string, m string"), name, "k")
    assert rep.updated == 1
    assert {tuple(r) for r in spark.table(name).collect()} == {(1, "z", "m1"), (2, "b", "m2")}
    with pytest.raises(SchemaError):
        UP.upsert(spark.createDataFrame([(1, "z", "m1")], "k long, v string, m string"), name, "k",
                  partition_by=["v"])


def test_replace_partitioned_table(spark, db):
    name = f"{db}.rp"
    TB.create_table(spark.createDataFrame([(1, "m1"), (2, "m2")], "k long, m string"), name, partition_by=["m"])
    out = TB.replace_table(spark.table(name).where("m = 'm2'").selectExpr("k + 10 AS k", "m"), name)
    assert {tuple(r) for r in out.collect()} == {(12, "m2")}


@pytest.mark.parametrize("multi_line", [False, True])
def test_ragged_csv_rows(spark, tmp_path, multi_line):
    def read(text, **kw):
        path = tmp_path / f"{abs(hash((text, multi_line)))}.csv"
        path.write_text(text)
        return [tuple(r) for r in extract_csv(spark, str(path), multi_line=multi_line, **kw).collect()]

    assert read("a;b;c\n1;2;3\n4;5\n") == [(1, 2, 3), (4, 5, None)]
    assert read('a;b;c\n1;x\n3;"4;;;""5";5\n') == [(1, "x", None), (3, '4;;;"5', 5)]
    assert read("a;b\n1;2\n3\n", schema="a int, b string") == [(1, "2"), (3, None)]
    for text, wide, unclosed in [("a;b\n4;5;6\n", 1, 0), ("a;b\n1;2\n3;4;\n", 1, 0), ("a;b\n1;2;3;4\n5;6;;7\n", 2, 0),
                                 ('a;b\n1;2\n3;"x\n', 0, 1), ('a;b\n1;"x;2\n3;4\n', 0, 1)]:
        for kw in ({}, {"schema": "a string, b string"}):
            with pytest.raises(SourceError) as e:
                read(text, **kw)
            assert e.value.code == 2
            assert f"{wide} rows have too many fields and {unclosed} an open quote" in e.value.message


def test_loose_html_tables(spark):
    from tidemill.sources.html import table_cells
    pages = {
        '<table class=country-table><tbody><tr><td>1<td>2<td>3<td>4<tr><td>5<td>6</table><tr><td>no': [list("1234"), list("56")],
        '<TABLE CLASS="x country-table"><TR><TD>1<TD>a<table><tr><td>in<td>ner</table>b<td>3</tr><tr><td>4</table>':
            [["1", "ainnerb", "3"], ["4"]],
        '<table class="country-table"><tr><td>&eacute;&amp;&#243;&bogus; &#xF3;&lt;x<!-- <td>no --></td><th>h</th><td>2</td>':
            [["é&ó&bogus; ó<x", "2"]],
        '<table class="country-table"><tbody><tr><td>1</tbody><tbody><tr><td>2</tbody></table>': [["1"]],
        '<table class="country-table"><thead><tr><td>0</thead><tbody><tr><td>1</td><td><table><tbody><tr><td>q</td></tr></tbody>'
        '</table></td><td>3</td></tr></tbody></table>': [["1", "q", "3"]],
        '<table class="other"><tr><td>1</table>': None, "": None, '<table class="country-table">': [],
    }
    df = spark.createDataFrame([(p,) for p in pages] + [(None,)], "html string")
    got = {r["html"]: r["c"] for r in df.select("html", table_cells(F.col("html")).alias("c")).collect()}
    assert got == {**pages, None: None}


def test_pages_are_parsed_once_and_numbers_cast_once(spark):
    from tidemill.operators.quality import conform_types
    from tidemill.sources.html import holiday_rows
    pages = spark.createDataFrame([("r", 2015, "")], "region string, year int, html string")
    plan = holiday_rows(pages)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("country-table") == 1
    text = spark.createDataFrame([("1", "2")], "a string, b string")
    plan = conform_types(text, {"a": "int", "b": "float"}, strict=False)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_cast(a") == 2 and plan.count("try_cast(b") == 1
