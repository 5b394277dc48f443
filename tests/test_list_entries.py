"""Entries of lists that aren't objects."""

import json

from pyspark.sql import functions as F

from distriq.operators.nested import owned_rows, shred_json
from distriq.sources.documents import feed_rows


def shred(spark, *payloads, **options):
    df = spark.createDataFrame([(f"r{i}", json.dumps(p)) for i, p in enumerate(payloads)], "id string, p string")
    return shred_json(df, "id", "p", **options)


def values(rows, tab):
    return [(r["pos"], r["cols"].get("$value")) for r in rows.filter(F.col("tab") == tab).orderBy("root_id", "pos").collect()]


def test_scalars_are_rows_of_a_table(spark):
    rows = shred(spark, {"id": 7, "tags": ["a", "b"], "n": [1, None, 2.5, True]})
    assert values(rows, "tags") == [(0, "a"), (1, "b")]
    assert values(rows, "n") == [(0, "1"), (1, None), (2, "2.5"), (3, "true")]
    root = rows.filter("tab = '$'").first()
    assert root["cols"] == {"id": "7"}
    assert {r["parent_row"] for r in rows.filter("tab = 'tags'").collect()} == {root["row_id"]}
    assert rows.select("row_id").distinct().count() == rows.count() == 7


def test_parallel_arrays_in_a_list(spark):
    rows = shred(spark, {"f": [{"d": ["x", "y"], "a": [1, 2]}, {"d": ["z"], "a": [3]}]})
    parents = {r["row_id"]: r["pos"] for r in rows.filter("tab = 'f'").collect()}
    got = {(parents[r["parent_row"]], r["tab"], r["pos"], r["cols"]["$value"]) for r in rows.filter("tab IN ('d', 'a')").collect()}
    assert got == {(0, "d", 0, "x"), (0, "d", 1, "y"), (0, "a", 0, "1"), (0, "a", 1, "2"), (1, "d", 0, "z"), (1, "a", 0, "3")}


def test_lists_of_lists_and_mixed_lists(spark):
    rows = shred(spark, {"m": [[1, 2], [{"k": "v"}]], "x": [{"k": 1}, "s"]}, ["t", {"q": 1}])
    assert values(rows, "m") == [(0, "[1,2]"), (1, '[{"k":"v"}]')]
    assert values(rows, "x") == [(0, None), (1, "s")]
    assert [(r["pos"], r["cols"]) for r in rows.filter("root_id = 'r1'").orderBy("pos").collect()] == [(0, {"$value": "t"}), (1, {"q": "1"})]


def test_opened_texts(spark):
    rows = shred(spark, {"o": '["a", {"k": 1}]'}, {"o": "[]"}, {"o": "[no"}, opened=("o",))
    assert values(rows, "o") == [(0, "a"), (1, None)]
    assert {r["root_id"]: r["cols"] for r in rows.filter("tab = '$'").collect()} == {"r0": {}, "r1": {"o": "[]"}, "r2": {"o": "[no"}}


def test_readers_of_objects_are_not_given_them(spark):
    rows = shred(spark, {"funds": [{"fund_id": "F", "source_attempts": ["s", None, {"source_id": "t"}]}]}, key="fund_id")
    assert [(r["pos"], r["code"]) for r in owned_rows(rows, "source_attempts", "funds", "source_id", "status").collect()] == [(2, "t")]
    assert sorted(str(r["headers"]) for r in feed_rows(rows).collect()) == ["['fund id']", "['source id']"]
