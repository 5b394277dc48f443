"""Batches added one by one, more of them than runs are merged at a time."""

import random

from distriq.llm.history import FAN_IN, HistoryIndex, restated


def test_each_batch_meets_the_stored_index(spark, monkeypatch):
    rng = random.Random(8)
    n = FAN_IN + 2
    rows = [(i * n // 120, i, rng.choice("kl"), 730000 + rng.randint(0, 40), rng.choice([1.0, 1.004, 1.01, 2.0])) for i in range(120)]
    df = spark.createDataFrame(rows, "batch int, id long, key string, day int, amount double")
    added, levels = [], []
    add, write = HistoryIndex.decide, HistoryIndex._write_run
    monkeypatch.setattr(HistoryIndex, "decide", lambda self, batch: (added.append(len(self.runs)), add(self, batch))[1])
    monkeypatch.setattr(HistoryIndex, "_write_run", lambda self, signed, level: (levels.append(level), write(self, signed, level))[1])
    got = {tuple(r) for r in restated(df, "batch").collect()}
    accepted, expected = [], set()
    for _, i, key, day, amount in rows:
        first = next((a for a in accepted if a[1] == key and abs(a[2] - day) <= 1 and abs(a[3] - amount) <= 0.005 * max(a[3], amount)), None)
        if first is None:
            accepted.append((i, key, day, amount))
        else:
            expected.add((first[0], i))
    assert got == expected
    assert added == [0, 1, 2, 3, 1, 2]
    assert levels.count(1) == 1
