"""Category dictionaries that grow over loads."""

import pytest
from pyspark.sql import functions as F

from tidemill.errors import CategoryError, MissingColumnError, SchemaError
from tidemill.sinks.dictionary import coded, grow, unknown_values


def frame(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"n long, c {kind}")


def codes(df):
    return {r["value"]: r["code"] for r in df.collect()}


def test_new_values_get_the_next_codes(spark, db):
    t = f"{db}.codes"
    assert codes(grow(frame(spark, ["b", None, "a", "b"]), "c", t, ["n"])) == {"b": 1, "a": 2}
    second = frame(spark, ["z", "a", None, "y", "z"])
    assert {r["value"]: r["rows"] for r in unknown_values(second, "c", spark.table(t)).collect()} == {"z": 2, "y": 1}
    got = {(r["c"], r["c_num"]) for r in coded(second, "c", t, ["n"]).collect()}
    assert got == {("z", 3), ("a", 2), (None, 0), ("y", 4)}
    # another order and fewer values: nothing moves, nothing is written
    before = spark.table(t).inputFiles()
    assert codes(grow(frame(spark, ["y", "b"]), "c", t, [F.col("n").desc()])) == {"b": 1, "a": 2, "z": 3, "y": 4}
    assert spark.table(t).inputFiles() == before


def test_numbers_empty_loads_and_the_limit(spark, db):
    t = f"{db}.numbers"
    assert codes(grow(frame(spark, [], "int"), "c", t, ["n"])) == {}
    assert codes(grow(frame(spark, [7, 5], "int"), "c", t, ["n"])) == {7: 1, 5: 2}
    with pytest.raises(SchemaError):
        grow(frame(spark, ["7"]), "c", t, ["n"])
    with pytest.raises(MissingColumnError):
        grow(frame(spark, [1], "int"), "missing", t, ["n"])
    with pytest.raises(CategoryError) as e:
        grow(frame(spark, list(range(100, 198)), "int"), "c", t, ["n"])
    assert e.value.code == 5 and codes(spark.table(t)) == {7: 1, 5: 2}
    assert len(codes(grow(frame(spark, list(range(100, 197)), "int"), "c", t, ["n"]))) == 99


def test_a_damaged_dictionary_is_refused(spark, db):
    t = f"{db}.damaged"
    spark.createDataFrame([("a", 1), ("b", 1)], "value string, code long").write.saveAsTable(t)
    with pytest.raises(CategoryError) as e:
        grow(frame(spark, ["c"]), "c", t, ["n"])
    assert e.value.code == 4
