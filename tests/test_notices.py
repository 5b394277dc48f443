"""What prose tells of a payout besides labelled dates."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from distriq.functions.text import dateline, labelled_amount, labelled_dates, payout_sentence
from distriq.plans.parsing import AMOUNT_LABEL

D = date(2026, 6, 18)


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "v string").select(column(F.col("v"))).collect()[0][0]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("The fund announced its June payout of 0.5 on June 18, 2026.", D),
        ("The board declares a dividend on 2026-06-18", D),
        ("It declared a dividend payable on June 18, 2026", None),
        ("It announced a change. Units trade on June 18, 2026", None),
        ("Declaration date: June 18, 2026. It was announced on June 19, 2026.", D),
        ("went ex on June 18, 2026", None),
        (None, None),
    ],
)
def test_declared_in_prose(spark, text, expected):
    assert one(spark, text, lambda t: labelled_dates(t)["declaration"]) == expected


@pytest.mark.parametrize(("text", "expected"), [("TORONTO, June 18, 2026 - The fund", D), ("NEW YORK, N.Y., 2026-06-18", D), ("Toronto, June 18, 2026", None), ("June 18, 2026", None), (None, None)])
def test_datelines(spark, text, expected):
    assert one(spark, text, dateline) == expected


@pytest.mark.parametrize(("text", "expected"), [("Total distribution per unit: $0.125", 0.125), ("Distribution rate is 1.5", 1.5), ("Distribution amount 12", None), ("the amount is $0.1", None), (None, None)])
def test_labelled_amounts(spark, text, expected):
    assert one(spark, text, lambda t: labelled_amount(t, AMOUNT_LABEL)) == expected


def test_the_sentence_of_a_payout(spark):
    text = "Founded 2020-01-01. The distribution plan changed on 2026-01-02. Dividend news follow. A dividend of $0.25 goes ex on June 18, 2026. The distribution is $1 on 2026-07-01."
    assert tuple(one(spark, text, payout_sentence)) == (D, 0.25, "A dividend of $0.25 goes ex on June 18, 2026.")
    assert tuple(one(spark, text, lambda t: payout_sentence(t, F.lit(date(2026, 6, 19)), F.lit(date(2026, 7, 1))))) == (date(2026, 7, 1), None, "The distribution is $1 on 2026-07-01.")
    assert one(spark, text, lambda t: payout_sentence(t, until=F.lit(date(2026, 6, 1)))) is None
    assert one(spark, None, payout_sentence) is None
