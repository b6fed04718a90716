import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemill.errors import CategoryError, DateFormatError, InputError, KeyFormatError, MissingColumnError
from tidemill.operators import columns as C


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_surrogate_key_golden(spark):
    df = frame(spark, [(0, 123), (1, 123), (2, 124), (3, 123)], "ord int, v long")
    out = C.surrogate_key(df, "v", ["ord"]).orderBy("ord")
    assert out.columns[0] == "Index"
    assert [r["Index"] for r in out.collect()] == ["1230", "1231", "1240", "1232"]


def test_surrogate_key_invariant_to_partitioning(spark):
    df = frame(spark, [(i, 100 + i % 3) for i in range(40)], "ord int, v long")
    base = {tuple(r) for r in C.surrogate_key(df, "v", ["ord"]).collect()}
    for n in (1, 7):
        assert {tuple(r) for r in C.surrogate_key(df.repartition(n), "v", ["ord"]).collect()} == base
    shuffled = df.orderBy(F.rand(3))
    assert {tuple(r) for r in C.surrogate_key(shuffled, "v", ["ord"]).collect()} == base


def test_surrogate_key_rejects_bad_values(spark):
    for bad in ("12a", None, "--"):
        df = frame(spark, [(0, "123"), (1, bad)], "ord int, v string")
        with pytest.raises(KeyFormatError) as e:
            C.surrogate_key(df, "v", ["ord"])
        assert e.value.code == 3
    ok = frame(spark, [(0, "2015-01-02")], "ord int, v string")
    assert C.surrogate_key(ok, "v", ["ord"]).first()["Index"] == "2015-01-020"


def test_surrogate_key_separator(spark):
    df = frame(spark, [(0, 1), (1, 1)], "ord int, v long")
    assert sorted(r[0] for r in C.surrogate_key(df, "v", ["ord"], separator="-").collect()) == ["1-0", "1-1"]


def test_unique_suffix_golden(spark):
    df = frame(spark, [(0, "A"), (1, "A"), (2, "B"), (3, "A")], "ord int, v string")
    assert [r["v"] for r in C.unique_suffix(df, "v", ["ord"]).orderBy("ord").collect()] == ["A", "A - 2", "B", "A - 3"]
    nulls = frame(spark, [(0, None), (1, None)], "ord int, v string")
    assert [r["v"] for r in C.unique_suffix(nulls, "v", ["ord"]).orderBy("ord").collect()] == ["", " - 2"]


def test_category_auto_golden_and_mapping(spark):
    df = frame(spark, [(0, "b"), (1, None), (2, "a"), (3, "b")], "ord int, v string")
    out = C.category_codes(df, "v", order_by=["ord"]).orderBy("ord")
    assert [r["v_num"] for r in out.collect()] == [1, 0, 2, 1]
    mapping = C.category_mapping(df, "v", ["ord"])
    assert sorted(tuple(r) for r in mapping.collect()) == [("a", 2), ("b", 1)]
    # a stored mapping keeps codes stable on a reload whose row order differs
    reload = frame(spark, [(0, "a"), (1, "b")], "ord int, v string")
    again = C.category_codes(reload, "v", mapping=mapping).orderBy("ord")
    assert [r["v_num"] for r in again.collect()] == [2, 1]


def test_category_map_rules(spark):
    df = frame(spark, [("x",), ("y",), (None,)], "v string")
    out = C.category_codes(df, "v", cat_map={"x": 10, "y": 20})
    assert sorted((r["v"] or "", r["v_num"]) for r in out.collect()) == [("", 0), ("x", 10), ("y", 20)]
    with pytest.raises(CategoryError) as e:
        C.category_codes(df, "v", cat_map={"x": 1})
    assert e.value.code == 4
    with pytest.raises(CategoryError) as e:
        C.category_codes(df, "v", cat_map={"x": 1, "y": 2, "z": 3})
    assert e.value.code == 4
    with pytest.raises(CategoryError) as e:
        C.category_codes(df, "v", cat_map={"x": "1", "y": 2})
    assert e.value.code == 3


def test_category_limit(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("v"), "id")
    with pytest.raises(CategoryError) as e:
        C.category_codes(df, "v", order_by=["id"])
    assert e.value.code == 5
    ok = spark.range(99).select(F.col("id").cast("string").alias("v"), "id")
    assert C.category_codes(ok, "v", order_by=["id"]).agg(F.max("v_num")).first()[0] == 99


def test_fill_nulls_golden(spark):
    df = frame(spark, [(0, 5), (1, None), (2, -1)], "ord int, v long")
    assert [r["v"] for r in C.fill_nulls(df, "v", [-1]).orderBy("ord").collect()] == [5, 0, 0]
    assert C.fill_count(df, "v", [-1]).first()["replaced"] == 2
    s = frame(spark, [(0, "a"), (1, None)], "ord int, v string")
    assert [r["v"] for r in C.fill_nulls(s, "v").orderBy("ord").collect()] == ["a", ""]


def test_parse_date_golden(spark):
    df = frame(spark, [(" 20150102 ",)], "d string")
    assert C.parse_date(df, "d").first()["d"] == dt.date(2015, 1, 2)
    for bad, code in (("2015012", 3), ("2015-1-2", 4), ("20150230", 9), (None, 3)):
        with pytest.raises(DateFormatError) as e:
            C.parse_date(frame(spark, [("20150101",), (bad,)], "d string"), "d")
        assert e.value.code == code
    lenient = C.parse_date(frame(spark, [("20150230",)], "d string"), "d", on_error="null")
    assert lenient.first()["d"] is None


def test_parse_date_patterns(spark):
    df = frame(spark, [("02-01-2015",)], "d string")
    assert C.parse_date(df, "d", "DD-MM-YYYY").first()["d"] == dt.date(2015, 1, 2)
    two = frame(spark, [("950102",), ("680102",), ("690102",)], "d string")
    got = sorted(r["d"] for r in C.parse_date(two, "d", "YYMMDD").collect())
    assert got == [dt.date(1969, 1, 2), dt.date(1995, 1, 2), dt.date(2068, 1, 2)]


def test_rename(spark):
    df = frame(spark, [(1, 2)], "a int, b int")
    assert C.rename_columns(df, {"a": "x"}).columns == ["x", "b"]
    with pytest.raises(MissingColumnError) as e:
        C.rename_columns(df, {"zz": "x"})
    assert e.value.code == 2
    with pytest.raises(InputError) as e:
        C.rename_columns(df, {"a": " "})
    assert e.value.code == 3


def test_category_codes_on_long_column(spark):
    df = spark.createDataFrame([(0, 5_000_000_000), (1, 7), (2, None)], "ord int, v long")
    out = C.category_codes(df, "v", order_by=["ord"]).orderBy("ord")
    assert [r["v_num"] for r in out.collect()] == [1, 2, 0]
    fixed = C.category_codes(df, "v", cat_map={5_000_000_000: 9, 7: 3}).orderBy("ord")
    assert [r["v_num"] for r in fixed.collect()] == [9, 3, 0]


def test_category_codes_many_matches_one_by_one(spark):
    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select(
        "o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("p"), "o_orderstatus",
        F.col("o_custkey").cast("int").alias("ck"))
    fixed = {"F": 1, "O": 2, "P": 3}
    many = C.category_codes_many(o, {"p": None, "o_orderstatus": fixed}, order_by=["o_orderkey"])
    one = C.category_codes(C.category_codes(o, "p", order_by=["o_orderkey"]), "o_orderstatus", cat_map=fixed)
    assert {tuple(r) for r in many.collect()} == {tuple(r) for r in one.select(*many.columns).collect()}
    with pytest.raises(CategoryError) as e:
        C.category_codes_many(o, {"p": None, "ck": None}, order_by=["o_orderkey"])  # ck has > 99 values
    assert e.value.code == 5
    with pytest.raises(CategoryError) as e:
        C.category_codes_many(o, {"o_orderstatus": {"F": 1, "O": 2}}, order_by=["o_orderkey"])
    assert e.value.code == 4


def test_numbering_stores_each_column_once(spark, monkeypatch):
    """Rows are ranged and stored by their own columns: the struct that groups them is made again from these."""
    from tidemill.functions.ordinal import occurrence_number

    stored, kind = [], type(spark.range(1))
    whole = kind.checkpoint
    monkeypatch.setattr(kind, "checkpoint", lambda df, *a, **k: stored.append(df.columns) or whole(df, *a, **k))
    df = spark.createDataFrame([("a", 2), (None, 1), ("a", 1), (None, 3)], "k string, n long")
    assert {tuple(r) for r in occurrence_number(df, ["k"], ["n"], "at").collect()} == {("a", 1, 1), ("a", 2, 2), (None, 1, 1), (None, 3, 2)}
    assert [c for c in stored[0] if c != "_tm_place"] == ["k", "n"]
    assert {tuple(r) for r in occurrence_number(df, [], ["n", "k"], "at").select("n", "at").collect()} == {(1, 1), (1, 2), (2, 3), (3, 4)}
