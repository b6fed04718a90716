"""JSON records of differing shapes through VARIANT."""

import pytest

from tidemill.errors import SourceError
from tidemill.sources.json_variant import extract_json_variant, variant_path


def written(tmp_path, *lines):
    (tmp_path / "a.json").write_text("\n".join(lines) + "\n")
    return str(tmp_path / "a.json")


def test_shapes_differ_by_record(spark, tmp_path):
    path = written(
        tmp_path, '{"id": 1, "info": {"s": "a", "p": {"t": 1.5}}, "day": "2020-01-02", "ok": true}',
        '{"id": "2", "info": {"s": ["x", null, 3, [4, 5]], "p": {"t": "2.25"}}, "day": "", "ok": 0}',
        '{"id": 3.0, "info": {"s": {"k": 1}}, "extra": 9}', '{"info": null, "id": null, "it\'s": "q"}',
        '{"id": 9223372036854775807, "info": "plain", "ok": null}')
    types = {"id": "int", "info.s": "str", "info.p.t": "float", "day": "date", "ok": "bool", "it's": "str"}
    want = {(1, "a", 1.5, "20200102", True, None), (2, "x , 3 , [4,5]", 2.25, None, False, None), (3, '{"k":1}', None, None, None, None),
            (None, None, None, None, None, "q"), (9223372036854775807, None, None, None, None, None)}
    for strict in (True, False):
        out = extract_json_variant(spark, path, types, strict=strict)
        assert out.columns == list(types) and {tuple(r) for r in out.collect()} == want


def test_errors_have_their_codes(spark, tmp_path):
    path = written(tmp_path, '{"id": 1, "v": "x", "b": 2}', '{"id": 2.5, "v": [1], "b": "true"}', '{"id": 3, "v": 7, "b": 1}')

    def code(types, p=path):
        with pytest.raises(SourceError) as e:
            extract_json_variant(spark, p, types)
        return e.value.code, e.value.message

    assert code({"id": "int"})[0] == 9 and "{'id': 1}" in code({"id": "int"})[1]
    assert "{'v': 2}" in code({"v": "float"})[1] and "{'b': 2}" in code({"b": "bool"})[1]
    assert code({"id": "float", "none.here": "str"}) == (3, "extract_json_variant: fields not found: ['none.here']")
    assert [tuple(r) for r in extract_json_variant(spark, path, {"id": "int", "none": "str"}, strict=False).collect()] == [
        (1, None), (None, None), (3, None)]
    assert code({"id": "int"}, str(tmp_path / "nowhere"))[0] == 1
    (tmp_path / "bad.json").write_text('{"id": 1}\n{"id": \n')
    assert code({"id": "int"}, str(tmp_path / "bad.json"))[0] == 2
    (tmp_path / "empty.json").write_text("")
    assert code({"id": "int"}, str(tmp_path / "empty.json"))[0] == 3
    with pytest.raises(SourceError):
        variant_path("""a'b"c""")


def test_whole_files(spark, tmp_path):
    (tmp_path / "whole.json").write_text('[{"id": 1,\n "a": [1, 2]},\n {"id": 2, "a": "z"}]')
    out = extract_json_variant(spark, str(tmp_path / "whole.json"), {"id": "int", "a": "str"}, multi_line=True)
    assert {tuple(r) for r in out.collect()} == {(1, "1 , 2"), (2, "z")}
