from datetime import date

import pytest
from pyspark.sql import functions as F

from distriq.functions.dates import cadence_days, in_season, month_end_within, month_windows, trailing_months
from distriq.functions.text import amount_in, bare_id, find_dates, first_date, header_kinds, host, host_suffixes, json_after, labelled_dates, plain_amount, sentences, unescape, without_tags


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v"))).collect()[0][0]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("ex 2024-3-05, then Mar 7th, 2024 and 9 April 2024 or 5/6/2024", [date(2024, 3, 5), date(2024, 3, 7), date(2024, 4, 9), date(2024, 5, 6)]),
        ("February 30, 2024; 2024/02/29", [date(2024, 2, 29)]),
        ("1st Sept. 2024", [date(2024, 9, 1)]),
        ("1999-01-01 and 12024-01-01", []),
        ("", []),
        (None, None),
    ],
)
def test_find_dates(spark, text, expected):
    assert one(spark, text, find_dates) == expected


@pytest.mark.parametrize(("text", "expected"), [("1234", None), ("1234.5", 1234.5), ("-0.5", None), ("(0.25)", 0.25), ("$1,234.50", 1234.5), ("12.5%", 12.5), ("2024-01-02 0.5", None), ("none", None), (None, None)])
def test_amounts(spark, text, expected):
    assert one(spark, text, amount_in) == expected


def test_small_text_functions(spark):
    assert one(spark, "$1,234.5", plain_amount) == 1234.5
    assert one(spark, "n/a", plain_amount) == 0.0
    assert one(spark, "<p>a b</p>\n c", without_tags) == "a b c"
    assert one(spark, "https://WWW.A.example/x", host) == "a.example"
    assert one(spark, "no url", host) is None
    assert one(spark, "b.a.example", host_suffixes) == ["b.a.example", "a.example", "example"]
    assert one(spark, "000", bare_id) == "0"
    assert one(spark, "One. Two! Three", sentences) == ["One.", "Two!", "Three"]
    assert one(spark, "Amount  Payable date   Record Date  Ex-dividend date", header_kinds) == ["payable", "record", "ex"]
    assert one(spark, "a &amp; &eacute;", unescape) == "a & é"
    assert one(spark, None, unescape) is None
    page = 'x = {}; const d = {"a": "}", "b": {"c": 1}}; y = {}'
    assert one(spark, page, json_after("const d = ")) == '{"a": "}", "b": {"c": 1}}'
    assert one(spark, "const d = {broken", json_after("const d = ")) is None


def test_labelled_dates_keep_to_their_labels(spark):
    text = "Ex-dividend date: March 22, 2024; record date 2024-03-25. Payable on 27 March 2024."
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(*(c.alias(k) for k, c in labelled_dates(F.col("t")).items())).first().asDict() == {"declaration": None, "ex": date(2024, 3, 22), "record": date(2024, 3, 25), "payable": date(2024, 3, 27)}


def test_dates(spark):
    d = date(2026, 3, 31)
    assert one(spark, d, lambda c: trailing_months(c, 1), "date") == date(2026, 2, 28)
    assert one(spark, d, lambda c: month_end_within(c, 1), "date")
    assert one(spark, date(2025, 1, 10), lambda c: in_season(c, (12, 1), (1, 15)), "date")
    assert not one(spark, date(2025, 2, 10), lambda c: in_season(c, (12, 1), (1, 15)), "date")
    assert one(spark, "weekly", cadence_days) == 91
    assert one(spark, None, cadence_days) == 91
    df = spark.createDataFrame([(date(2024, 1, 15), date(2024, 3, 10)), (date(2024, 2, 2), date(2024, 2, 1)), (None, d)], "a date, b date")
    assert [tuple(r) for r in month_windows(df, "a", "b").select("window_start", "window_end").orderBy("window_start").collect()] == [(date(2024, 1, 15), date(2024, 1, 31)), (date(2024, 2, 1), date(2024, 2, 29)), (date(2024, 3, 1), date(2024, 3, 10))]


def test_first_date_in_the_middle(spark):
    assert one(spark, "on 3 May 2024 or 2023-01-01", first_date) == date(2024, 5, 3)
