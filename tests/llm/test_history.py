import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from distriq.llm import forest, history
from distriq.llm.forest import CERTAIN, Forest, SortedRun, cells, holding_tree, interleaved, searches, whole_keys
from distriq.llm.history import HistoryIndex, restated, with_signature
from distriq.llm.queries import any_date, fund_key

KINDS = "batch int, id long, key string, day int, amount double, first string"


def brute(rows):
    """Entries one by one in the order of their ids."""
    accepted, out = [], set()
    for _, i, key, day, amount, _ in sorted(rows, key=lambda r: r[1]):
        if key is None or day is None or amount is None or amount != amount or abs(amount) == float("inf"):
            continue
        hits = [j for j, k, d, a in accepted if k == key and abs(d - day) <= 1 and abs(a - amount) <= 0.005 * max(abs(a), abs(amount))]
        if hits:
            out.add((min(hits), i))
        else:
            accepted.append((i, key, day, amount))
    return out


def entries(seed, n=300, batches=4):
    """Few keys and days and near amounts, so that chains, copies and ties are many; a third of all under one key."""
    rng = random.Random(seed)
    amounts = [1.0, 1.0, 1.004, 1.005, 1.0051, 1.009, 1.013, 0.5, 0.0, -0.0, -1.0, -1.003, None, float("nan"), float("inf")]
    return [(i * batches // n, i, "hot" if rng.random() < 0.34 else rng.choice(["a", "b", "b\0", "é", "", None]), rng.choice([None, *range(738000, 738012)]), rng.choice(amounts) if rng.random() < 0.8 else rng.uniform(0.9, 1.1), "x") for i in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    rows = entries(seed)
    assert {tuple(r) for r in restated(spark.createDataFrame(rows, KINDS), "batch").collect()} == brute(rows)


@pytest.mark.parametrize("seed", range(2))
def test_hot_keys_are_decided_by_joins(spark, monkeypatch, seed):
    monkeypatch.setattr(history, "KEY_ROWS", 20)
    rows = entries(seed + 20, 240, 3)
    assert {tuple(r) for r in restated(spark.createDataFrame(rows, KINDS), "batch").collect()} == brute(rows)


def test_batch_by_batch_with_merged_runs(spark, monkeypatch):
    monkeypatch.setattr(history, "FAN_IN", 2)
    monkeypatch.setattr(history, "GROUP_ROWS", 3)
    rows = entries(9, 160)
    df = spark.createDataFrame(rows, KINDS)
    index = HistoryIndex(spark)
    got = set()
    for b in range(4):
        got |= {tuple(r) for r in index.add(df.filter(F.col("batch") == b)).collect()}
    assert got == brute(rows)
    assert [level for level, _ in index.runs] == [2]
    assert index.add(df.limit(0)).count() == 0
    index.close()


def test_a_long_chain(spark):
    rows = [(0, i, "k", 738000 + i, 1.0, "") for i in range(200)]
    assert {tuple(r) for r in restated(spark.createDataFrame(rows, KINDS), "batch").collect()} == brute(rows)


def test_runs_are_sorted(spark):
    index = HistoryIndex(spark)
    rng = random.Random(3)
    rows = [(0, i, rng.choice("abc"), rng.randint(700000, 740000), rng.uniform(0.01, 50), "") for i in range(3000)]
    dropped = index.add(spark.createDataFrame(rows, KINDS).repartition(4)).count()
    for t in range(4):
        run = SortedRun(f"{index.runs[0][1]}/tree={t}")
        stored = run.read([("", -1)], [("z", 1 << 62)])
        assert len(stored) == 3000 - dropped
        places = list(zip(stored["key"], stored["code"]))
        assert places == sorted(places)
    index.close()


def test_a_batch_over_all_dates_reads_little_of_a_long_history(spark):
    """The same batch after ten times the history reads as many rows, and under a twentieth of the history."""
    rng = random.Random(5)
    keys = [f"F{k:03d}" for k in range(200)]
    read = {}
    for n in (60_000, 600_000):
        step = spark.range(n).selectExpr("CAST(0 AS INT) AS batch", "id", "concat('F', lpad(CAST(id % 200 AS STRING), 3, '0')) AS key", "CAST(700000 + (id DIV 200) * 2 % 40000 AS INT) AS day", "1.0D + (id DIV 200) % 977 AS amount", "'' AS first")
        index = HistoryIndex(spark)
        index.add(step)
        before = index.rows_read.value
        batch = [(1, 10_000_000 + i, rng.choice(keys), 700000 + rng.randint(0, 40000), rng.uniform(1, 900), "") for i in range(10)]
        index.add(spark.createDataFrame(batch, KINDS))
        read[n] = index.rows_read.value - before
        index.close()
    assert 0 < read[600_000] <= 20 * history.GROUP_ROWS
    assert read[600_000] < 600_000 / 20


def test_row_groups_bound_what_a_probe_reads(spark):
    index = HistoryIndex(spark)
    index.add(spark.range(400_000).selectExpr("0 AS batch", "id", "concat('F', lpad(CAST(id % 200 AS STRING), 3, '0')) AS key", "CAST(700000 + (id DIV 200) * 3 AS INT) AS day", "1.0D AS amount"))
    index.add(spark.createDataFrame([(1, 900_000, "F007", 700001, 1.0, "")], KINDS))
    assert 0 < index.rows_read.value <= 2 * history.GROUP_ROWS
    index.close()


def test_one_square_holds_all_matches():
    rng = np.random.default_rng(2)
    x, y = rng.integers(0, 1000, 5000), rng.integers(0, 1000, 5000)
    tree = holding_tree(x, y)
    places = {t: (at, low, high) for t, at, low, high in searches(x, y, CERTAIN)}
    assert sum(len(at) for at, _, _ in places.values()) == 5000
    for t, (at, low, high) in places.items():
        dx, dy = forest.shifts(t)
        assert (tree[at] == t).all()
        for i in (-1, 0, 1):
            for j in (-1, 0, 1):
                code = interleaved(x[at] + i + dx, y[at] + j + dy)
                assert ((low <= code) & (code <= high)).all()


def test_signatures_are_the_same_in_spark(spark):
    rng = random.Random(6)
    rows = [(rng.randint(-1000, 800000), rng.choice([0.0, rng.uniform(1e-9, 1e9), -rng.uniform(0.1, 9)]), rng.randint(0, 3)) for _ in range(500)]
    got = with_signature(spark.createDataFrame(rows, "day int, amount double, tree int"), 1, 0.005).toPandas()
    x, y = cells(got["day"].to_numpy(), got["amount"].to_numpy(), 1, 0.005)
    s = [forest.shifts(t) for t in got["tree"]]
    assert (interleaved(x + np.array([a for a, _ in s]), y + np.array([b for _, b in s])) == got["code"].to_numpy()).mean() > 0.99


def test_prefixes_are_widened_until_the_target(spark):
    rng = random.Random(4)
    pairs = [(0, i, f"k{i % 7}", 730000 + 10 * i, rng.uniform(0.01, 90), "") for i in range(400)]
    close = pd.DataFrame([(1000 + i, f"1|{k}", d + rng.choice([-1, 0, 0, 0, 1]), a * (1 + rng.choice([0, 1]) * rng.uniform(-0.00498, 0.00498))) for _, i, k, d, a, _ in pairs], columns=["id", "key", "day", "amount"])
    index = HistoryIndex(spark)
    index.add(spark.createDataFrame(pairs, KINDS))
    found, level = {}, {}
    for recall in (0.0, 0.8, 1.0):
        search = Forest([index.runs[0][1]], 1, 0.005, recall)
        found[recall] = int((search.first(close.sort_values("key", ignore_index=True)) >= 0).sum())
        level[recall] = search.level
    assert found[1.0] == 400 and level[1.0] == CERTAIN
    assert 320 <= found[0.8] and level[0.0] == 0 < level[0.8] <= CERTAIN
    assert found[0.0] < found[0.8]
    index.close()
    for bad in (-1, 2):
        with pytest.raises(ValueError):
            HistoryIndex(spark, recall=bad)
    with pytest.raises(ValueError):
        HistoryIndex(spark, rate=0.0)


def test_whole_keys():
    frames = [pd.DataFrame({"key": list(k)}) for k in ("aab", "bb", "", "bbc", "d", "dd", "e")]
    assert ["".join(f["key"]) for f in whole_keys(iter(frames))] == ["aa", "bbbbb", "c", "ddd", "e"]


def test_no_batches(spark):
    assert restated(spark.createDataFrame([], KINDS), "batch").count() == 0
    assert restated(spark.createDataFrame([(None, 1, "k", 1, 1.0, ""), (None, 2, "k", 1, 1.0, "")], KINDS), "batch").count() == 0
    assert restated(spark.createDataFrame([(1, 1, None, 1, 1.0, ""), (2, 2, "k", None, 1.0, "")], KINDS), "batch").count() == 0


@pytest.mark.parametrize(
    ("text", "expected"),
    [("2024-03-05", "2024-03-05"), ("03/05/2024", "2024-03-05"), ("Mar 5, 2024", "2024-03-05"), ("September 30, 2025", "2025-09-30"), ("05-Mar-2024", "2024-03-05"), ("20240305", "2024-03-05"), ("2024-03-05T00:00:00Z", "2024-03-05"), (" 2024-3-5 ", "2024-03-05"), ("2024-02-30", None), ("TBA", None), ("", None), (None, None)],
)
def test_dates(spark, text, expected):
    got = spark.createDataFrame([(text,)], "t string").select(any_date(F.col("t")).cast("string")).first()[0]
    assert got == expected


def test_fund_key(spark):
    df = spark.createDataFrame([(" US_a-b c ",), ("_-",), (None,)], "f string")
    assert [r[0] for r in df.select(fund_key(F.col("f"))).collect()] == ["USABC", None, None]
