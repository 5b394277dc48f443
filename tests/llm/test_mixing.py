from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from distriq.llm.mixing import draw_slots, mix, permuted, tokenizer_path

TARGETS = "source string, target_weight double, max_repeats int"


def test_permutation():
    for n in (1, 2, 3, 5, 64, 1000):
        for seed in (1, 2):
            out = permuted(np.arange(n), np.full(n, n), np.full(n, seed))
            assert sorted(out.tolist()) == list(range(n))
    assert permuted(np.arange(1000), np.full(1000, 1000), np.full(1000, 1)).tolist() != permuted(np.arange(1000), np.full(1000, 1000), np.full(1000, 2)).tolist()
    assert permuted(np.array([5]), np.array([1 << 40]), np.array([3]))[0] < 1 << 40


def test_slots_meet_weights_and_caps():
    plan = draw_slots({"a": 100_000, "b": 10_000, "c": 0}, 100, {"a": 0.5, "b": 0.3, "c": 0.2}, {"a": 1, "b": 3, "c": 9}, 8, 1)
    # 500 and 300 slots but for the chance of the last shard, and never above b's cap
    assert plan.names == ["a", "b"]
    assert 270 <= plan.slots["b"] <= 300 and sum(plan.slots.values()) == 800
    assert plan.counts.sum(1).tolist() == [100] * 8
    assert len(set(plan.counts[:, 0].tolist())) > 2
    assert (draw_slots({"a": 100_000, "b": 10_000}, 100, {"a": 0.5, "b": 0.3}, {"a": 1, "b": 3}, 8, 2).counts != plan.counts).any()
    assert draw_slots({}, 100, {"a": 1.0}, {"a": 1}, 4, 1).slots == {}
    assert draw_slots({"a": 5}, 100, {"a": 1.0}, {"a": 2}, None, 1).slots == {"a": 2}


def test_shards_do_not_grow_with_the_data():
    plan = draw_slots({"a": 10**15, "b": 10**14}, 256, {"a": 0.9, "b": 0.1}, {"a": 1, "b": 1}, None, 1)
    assert plan.counts.shape == (4096, 2)
    assert abs(plan.slots["b"] / sum(plan.slots.values()) - 0.1) < 1e-4
    assert plan.slots["b"] <= -(-(10**14) // 256)


@pytest.fixture(scope="module")
def corpus(spark):
    sizes = {"big": 600, " SMALL-one ": 40, "Mid size": 200, "other": 30}
    rows, i = [], 0
    for source, n in sizes.items():
        for k in range(n):
            rows.append((i, f"Document {k} says that the fund paid {k}.{k} per unit. " * (1 + k % 5), source, 1))
            i += 1
    rows += [(i, None, "big", 1), (i + 1, "", "big", 1), (i + 2, "no source", None, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_tokens int")


def test_mixture(spark, corpus):
    targets = spark.createDataFrame([("big", 0.5, 1), ("small_one", 0.2, 4), ("mid_size", 0.3, 2), ("absent", 0.1, 2)], TARGETS)
    out = mix(corpus, targets, tokenizer_path(), block_tokens=64)
    shares = {r["source"]: r for r in out.shares.collect()}
    assert set(shares) == {"big", "small_one", "mid_size", "absent", "other", ""}
    for s, w in (("big", 0.5), ("small_one", 0.2), ("mid_size", 0.3)):
        assert abs(shares[s]["actual_share"] - w) < 0.02
        assert shares[s]["most_repeats"] <= shares[s]["max_repeats"]
        assert shares[s]["used_tokens"] <= shares[s]["supply_tokens"] * shares[s]["max_repeats"]
    assert 3.6 * shares["small_one"]["supply_tokens"] <= shares["small_one"]["used_tokens"]
    assert shares["other"]["used_tokens"] == shares["absent"]["used_tokens"] == 0
    docs = out.documents
    assert docs.count() == docs.select("doc_id").distinct().count()
    assert docs.filter("used_tokens < 1 OR repeats < 1 OR used_tokens > n_tokens * repeats").count() == 0
    assert {r["source"] for r in docs.select("source").distinct().collect()} == {"big", "small_one", "mid_size"}
    again = mix(corpus.orderBy(F.desc("doc_id")), targets, tokenizer_path(), block_tokens=64).documents
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, docs.collect()))


def test_the_draw_decides_what_a_shard_holds(spark, corpus):
    targets = spark.createDataFrame([("big", 0.6, 1), ("mid_size", 0.4, 2)], TARGETS)
    a, b = (mix(corpus, targets, tokenizer_path(), block_tokens=64, shards=6, seed=seed) for seed in (1, 2))
    slots = {}
    for name, out in (("a", a), ("b", b)):
        rows = out.blocks.collect()
        slots[name] = {(r["shard"], r["slot"], r["source"], r["block"]) for r in rows}
        # each slot has one block, whose pieces fill it, and slots follow one another in shards
        assert len(slots[name]) == len({r["slot"] for r in rows}) == max(r["slot"] for r in rows) + 1
        assert [s for s, _ in sorted({(r["shard"], r["slot"]) for r in rows}, key=lambda x: x[1])] == sorted(s for s, *_ in slots[name])
        filled = {}
        for r in rows:
            filled[r["slot"]] = filled.get(r["slot"], 0) + r["tokens"]
        assert max(filled.values()) == 64
        used = {}
        for r in rows:
            used[r["doc_id"]] = used.get(r["doc_id"], 0) + r["tokens"]
        assert used == {r["doc_id"]: r["used_tokens"] for r in out.documents.collect()}
    assert slots["a"] != slots["b"]
    by_shard = [sorted(Counter((s, source) for s, _, source, _ in x).items()) for x in slots.values()]
    assert by_shard[0] != by_shard[1]


def test_nothing_to_mix(spark, corpus):
    targets = spark.createDataFrame([("big", 1.0, 1)], TARGETS)
    assert mix(corpus.limit(0), targets, tokenizer_path()).documents.count() == 0
    assert mix(corpus, targets.limit(0), tokenizer_path()).documents.count() == 0
