"""Batches with more entries than the stored runs have row groups."""

import random

import numpy as np
import pytest

from distriq.llm import history
from distriq.llm.forest import Forest, SortedRun, cells, interleaved, searches_in_one
from distriq.llm.history import HistoryIndex

KINDS = "id long, key string, day int, amount double"


def test_a_dense_batch_reads_the_history_once(spark, monkeypatch):
    monkeypatch.setattr(history, "GROUP_ROWS", 100)
    index = HistoryIndex(spark)
    rng = random.Random(11)
    places = [(rng.randrange(300), 700000 + 3 * rng.randrange(10_000)) for _ in range(20_000)]
    index.add(spark.createDataFrame([(i, f"F{k:03d}", d, 1.0) for i, (k, d) in enumerate(places)], KINDS))
    stored = len(set(places))
    index.add(spark.createDataFrame([(100_000 + i, f"F{rng.randrange(300):03d}", 700000 + rng.randrange(30_000), 1.0) for i in range(6_000)], KINDS))
    # once, and the row groups at the edges of tasks again
    assert 0 < index.rows_read.value <= 1.2 * stored
    index.close()


@pytest.mark.parametrize("group_rows", [5, 1000])
def test_one_tree_finds_what_four_find(spark, monkeypatch, group_rows):
    monkeypatch.setattr(history, "GROUP_ROWS", group_rows)
    rng = random.Random(12)
    index = HistoryIndex(spark)
    rows = [(i, rng.choice("kl"), 730000 + rng.randint(0, 60), rng.uniform(0.9, 1.1)) for i in range(800)]
    index.add(spark.createDataFrame(rows, KINDS).repartition(4))
    entries = spark.createDataFrame([(1000 + i, f"1|{rng.choice('klm')}", 730000 + rng.randint(-1, 61), rng.uniform(0.89, 1.11)) for i in range(500)], KINDS).toPandas().sort_values("key", ignore_index=True)
    stored = SortedRun(f"{index.runs[0][1]}/tree=0").read([("", -1)], [("z", 1 << 62)])
    expected = []
    for e in entries.itertuples():
        same = (stored["key"] == e.key) & ((stored["day"] - e.day).abs() <= 1) & ((stored["amount"] - e.amount).abs() <= 0.005 * np.maximum(stored["amount"], e.amount))
        expected.append(stored["id"][same].min() if same.any() else -1)
    for dense in (True, False):
        monkeypatch.setattr(SortedRun, "has_fewer_groups", lambda *_: dense)
        assert Forest([index.runs[0][1]], 1, 0.005, 1.0).first(entries).tolist() == expected
    assert len(set(expected)) > 100
    index.close()


def test_squares_of_one_tree_hold_all_cells_around():
    rng = np.random.default_rng(3)
    x, y = rng.integers(1, 1000, 3000), rng.integers(1, 1000, 3000)
    at, low, high = searches_in_one(x, y)
    for i in (-1, 0, 1):
        for j in (-1, 0, 1):
            code = interleaved(x + i, y + j)
            held = np.zeros(len(x), bool)
            np.logical_or.at(held, at, (low <= code[at]) & (code[at] <= high))
            assert held.all()
