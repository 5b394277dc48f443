import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from distriq.operators.packed import month_number, payout_months, split_packed
from pyspark.sql import functions as F


def values(spark, text, **more):
    df = spark.createDataFrame([(1, text)], "id long, t string")
    return [tuple(r) for r in split_packed(df, "t", **more).orderBy("pos").select("pos", "value").collect()]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ('a, "b, c"; d', ["a", "b, c", "d"]),
        ('"say ""so""", x', ['say "so"', "x"]),
        ("a (b, c), d", ["a (b, c)", "d"]),
        ('["Jan", "Feb"]', ["Jan", "Feb"]),
        ("x - y and z", ["x", "y", "z"]),
        ("mid-month", ["mid-month"]),
        ('"open, x', ['"open', "x"]),
        (",,; ;", []),
        ("", []),
        (None, []),
        ("" + "0" + ", \"p,q\"", ["" + "0" + "", "p,q"]),
    ],
)
def test_split(spark, text, expected):
    assert values(spark, text) == list(enumerate(expected, 1))


def test_keep_empty_clashing_names_and_repeats(spark):
    df = spark.createDataFrame([(1, "a,b", 7), (1, "a,b", 7), (2, None, 8)], "id long, t string, pos int")
    out = split_packed(df, "t", keep_empty=True)
    assert out.columns == ["id", "t", "value", "pos"]
    assert out.filter("id = 1").count() == 4
    assert out.filter("id = 2").collect()[0].asDict() == {"id": 2, "t": None, "value": None, "pos": None}
    assert split_packed(df.limit(0), "t").count() == 0


def test_long_text(spark):
    assert len(values(spark, ",".join(["ab"] * 20_000))) == 20_000


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet='ab,;"é ', max_size=8), min_size=1, max_size=6))
def test_quoted_round_trip(spark, parts):
    packed = ";".join('"' + p.replace('"', '""') + '"' for p in parts)
    expected = [t for p in parts if (t := p.strip())]
    assert [v.strip() for _, v in values(spark, packed, delimiters=r"[;,]")] == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("Every Month (Jan, Feb)", [1, 2]),
        ("Feb;Apr (no payout in the January of launch)", [2, 4]),
        ("No.1: January, No.2: May", [1, 5]),
        ("10 May; 28 November", [5, 11]),
        ("mars, juin et décembre (trimestriel)", [3, 6, 12]),
        ("03/06/09/12/06", [3, 6, 9, 12, 6]),
        ("Payout months - Mar. - Sept.", [3, 9]),
        ('"January ""est.""","February ""late"""', [1, 2]),
        ("Jan 2026, Jul 2026", [1, 7]),
        ("Quarterly (may vary)", []),
        ("13, 0", []),
        ("Monthly", []),
        (None, []),
    ],
)
def test_months(spark, text, expected):
    df = spark.createDataFrame([(1, text)], "id long, t string")
    assert [tuple(r) for r in payout_months(df, "t", "id").orderBy("pos").collect()] == [(1, i, m) for i, m in enumerate(expected, 1)]


def test_month_number_of_words(spark):
    df = spark.createDataFrame([("août",), ("Mayor",), ("MAY.",), ("juillet",), ("Sept. 2024",)], "t string")
    assert [r[0] for r in df.select(month_number(F.col("t"))).collect()] == [8, None, 5, 7, 9]
