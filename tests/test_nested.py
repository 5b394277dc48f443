import json

import pytest

from distriq.operators.nested import Shredder, child_table, element_graph, own_tables, owned_rows, read_json, shred_json, typed_graph


def frame(spark, *payloads):
    return spark.createDataFrame([(f"r{i}", p if p is None or isinstance(p, str) else json.dumps(p)) for i, p in enumerate(payloads)], "id string, p string")


def attempts(spark, *payloads):
    rows = shred_json(frame(spark, *payloads), "id", "p", key="fund_id", opened=("source_attempts",), maps=("funds",), own=("funds", "source_attempts"))
    return sorted(tuple(r) for r in owned_rows(rows, "source_attempts", "funds", "source_id", "retrieval_status").distinct().collect())


A = {"source_id": "s", "retrieval_status": "OK"}


def test_layouts(spark):
    assert attempts(spark, {"funds": [{"fund_id": "F", "source_attempts": [None, A]}]}) == [("r0", "F", 1, "s", "OK")]
    assert attempts(spark, {"report": {"funds": {"us_f": {"source_attempts": A}}}}) == [("r0", "us_f", 0, "s", "OK")]
    assert attempts(spark, {"batches": [{"funds": [{"fund_id": "F", "fallback": {"trail": {"source_attempts": [A]}}}]}]}) == [("r0", "F", 0, "s", "OK")]
    assert attempts(spark, {"funds": [{"fund_id": "F", "source_attempts": json.dumps([A])}]}) == [("r0", "F", 0, "s", "OK")]


def test_missing_and_nested_values(spark):
    inner = {"source_id": None, "retrieval_status": {"code": "TIMEOUT", "http": 5}, "redirect_chain": [{"retrieval_status": "X"}], "source_attempts": [A]}
    assert attempts(spark, {"funds": [{"fund_id": "F", "source_attempts": [inner]}]}) == [("r0", "F", 0, "", "TIMEOUT")]


def test_a_fund_without_an_id(spark):
    assert attempts(spark, {"funds": [{"fund_name": "N", "source_attempts": [A]}]}) == [("r0", "", 0, "s", "OK")]
    assert attempts(spark, {"funds": [{"fund_id": None, "source_attempts": [{}]}]}) == [("r0", "", 0, "", "")]


def test_what_yields_nothing(spark):
    assert attempts(spark, None, "", "HTTP 502", '{"funds": [', {"funds": [{"fund_id": "F", "source_attempts": None}]}, [], {"source_attempts": [A]}, "NaN", '{"a": NaN}') == []
    assert attempts(spark) == []


def test_two_texts_of_one_run_do_not_mix(spark):
    df = spark.createDataFrame([("r", json.dumps({"funds": [{"fund_id": f, "source_attempts": [A]}]})) for f in ("F", "G", "F")], "id string, p string")
    rows = shred_json(df, "id", "p", key="fund_id", own=("source_attempts",))
    assert rows.filter("tab = 'source_attempts'").select("owner").distinct().count() == 2
    assert rows.count() == 9
    assert rows.select("row_id").distinct().count() == 6


def test_foreign_keys_lead_to_rows(spark):
    rows = shred_json(frame(spark, {"a": [{"b": [{"x": 1}, {"x": 2}], "c": {"y": 3, "d": {"z": None}}}]}), "id", "p")
    ids = {r["row_id"] for r in rows.collect()}
    assert {r["parent_row"] for r in rows.collect() if r["parent_row"]} <= ids
    assert rows.filter("tab = 'a'").first()["cols"] == {"c.y": "3", "c.d.z": None}
    assert [r["cols"]["x"] for r in rows.filter("tab = 'b'").orderBy("pos").collect()] == ["1", "2"]


def test_graph(spark):
    edges = {tuple(e) for e in element_graph(frame(spark, {"a": {"b": 1, "c": {"d": 2}}}, {"a": {"c": {"d": 3}}, "k": [{"c": {}}]}), "p", Shredder()).collect()}
    assert edges == {("$", "a", False), ("a", "c", False), ("$", "k", True), ("k", "c", False)}
    assert own_tables(sorted(edges)) == {"$", "k", "c"}
    assert own_tables([("$", "n", False), ("n", "n", False)]) == {"$", "n"}


def test_deep_text_is_no_json():
    with pytest.raises(ValueError):
        read_json("[" * 200_000)


def test_typed_children(spark):
    df = spark.createDataFrame([(1, 9, [{"n": "a", "pos": 5}, None]), (2, 9, []), (3, 9, None)], "id long, pos int, c array<struct<n:string,pos:int>>")
    assert [tuple(r) for r in child_table(df, "id", "c").collect()] == [(1, 0, "a", 5)]
    assert child_table(df, "id", "c").columns == ["id", "pos", "n", "c_pos"]
    assert typed_graph(df.schema["c"].dataType, "c") == []
    with pytest.raises(TypeError):
        child_table(df, "id", "pos")


def test_nothing_is_lost_however_deep(spark):
    deep = '{"a":' * 30_000 + '[1,{"x":"y"}]' + "}" * 30_000
    lists = "[" * 30_000 + '"s"' + "]" * 30_000
    assert read_json('{"k":' + lists + "}")["k"][0][0] is not None
    rows = shred_json(spark.createDataFrame([("r", deep), ("s", '{"k":[' + lists + "]}"), ("t", deep[:-1])], "id string, p string"), "id", "p")
    got = rows.filter("root_id = 'r'").selectExpr("count(*)", "count(DISTINCT row_id)", "max(length(row_id))", "count_if(cols['x'] = 'y')", "count_if(cols['$value'] = '1')").first()
    assert tuple(got)[:2] == (30_002, 30_002) and got[2] < 1200 and tuple(got)[3:] == (1, 1)
    assert rows.filter("root_id = 's' AND tab = 'k'").first()["cols"]["$value"] == lists
    assert rows.filter("root_id = 't'").count() == 0


@pytest.mark.parametrize("text", ['{"a":1,}', "[1,]", "[1 2]", '{"a" 1}', '{1:2}', "[", "]", "[}", "1 2", "", "[nul]", "[NaN]", '["\t"]', ",", '{"a":}', "[,1]", "{,}"])
def test_the_deep_reader_is_as_strict(text):
    from distriq.operators.nested import _read_deep

    with pytest.raises(ValueError):
        read_json(text)
    with pytest.raises(ValueError):
        _read_deep(text)


@pytest.mark.parametrize("value", [{"a": [1, 2.5, None, True, {"b": "é\\n\"", "c": {}}], "d": []}, [], "s", 7, None, [[[]], {}]])
def test_the_deep_reader_and_writer_agree_with_the_library(value):
    from distriq.operators.nested import _read_deep, _write_deep

    text = json.dumps(value, ensure_ascii=False, separators=(",", ":"))
    assert _read_deep(f" {text}\n") == value
    assert _write_deep(value) == text


def test_inlined_lists_keep_all_entries(spark):
    rows = shred_json(frame(spark, {"st": [{"c": 1}, {"c": 2}, 3]}), "id", "p", inline=("st",))
    assert rows.first()["cols"] == {"st.c": "1", "st[1].c": "2", "st[2]": "3"}
