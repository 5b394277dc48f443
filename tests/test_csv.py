"""A table through CSV and back: whatever its cells hold."""

from distriq.plans import parsing
from distriq.sources.files import export_csv, read_labelled
from tests.helpers import rows_of, sql_rows

ODD = ["\tF1", "F2\t", " F3 ", " F4　", "\n", "\nF5", "a\r\nb", "a\rb", "c\r", "\t", " ", " ", "", None, 'say "x"', '"', '""', "a,b", "back\\", '\\"', "#x", "​F6", "\x00", "\x00F7", "\u0085x", " y", "x \n"]


def test_csv_roundtrip_of_odd_cells(spark, tmp_path):
    rows = [(None, None, None, None), ("", "", "", ""), (None, " ", None, None)]
    rows += [(f"K{i}", v, v, "USD") for i, v in enumerate(ODD)] + [(v, "F", None, v) for v in ODD]
    spark.createDataFrame(rows, "class_id string, fund_id string, ticker string, currency string").write.parquet(f"{tmp_path}/share_class.parquet")
    got, expected = rows_of(parsing.csv_roundtrip(spark, str(tmp_path))), sql_rows(parsing.ORACLE_SQL["csv_roundtrip"], str(tmp_path))
    assert (got - expected, expected - got) == ({}, {})


def test_csv_roundtrip_equals_sql_on_sf001(spark):
    directory = "/root/testdata/sf0.01"
    assert rows_of(parsing.csv_roundtrip(spark, directory)) == sql_rows(parsing.ORACLE_SQL["csv_roundtrip"], directory)


def test_csv_roundtrip_without_rows(spark, tmp_path):
    spark.createDataFrame([], "class_id string, fund_id string, ticker string, currency string").write.parquet(f"{tmp_path}/share_class.parquet")
    assert parsing.csv_roundtrip(spark, str(tmp_path)).collect() == []


def test_one_blank_column(spark, tmp_path):
    export_csv({"t": spark.createDataFrame([("",), (None,), (" ",), ("x",)], "a string")}, str(tmp_path))
    assert [r["a"] for r in read_labelled(spark, f"{tmp_path}/t", ["a"]).collect()] == ["x"]
