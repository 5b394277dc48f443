import random
from datetime import date

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from distriq.operators.dedup import by_content, not_yet_stored, snapshot_diff
from distriq.operators.fallback import first_yielding, with_fallback
from distriq.operators.joins import as_of, within_intervals
from distriq.operators.merge import merge_versions, overwrite_by_key
from distriq.operators.ordered import first_of, latest, missing_months, numbered, previous_value, recent_within, running_max, trailing_run


def test_within_intervals_against_all_pairs(spark):
    rng = random.Random(1)
    points = [(i, rng.choice("ab"), date.fromordinal(738000 + rng.randint(0, 200))) for i in range(60)] + [(99, None, date(2024, 1, 1)), (98, "a", None)]
    spans = [(i, rng.choice("ab"), date.fromordinal(s := 738000 + rng.randint(-20, 200)), date.fromordinal(s + rng.randint(-5, 90))) for i in range(40)] + [(97, "a", None, date(2024, 1, 1))]
    p, s = spark.createDataFrame(points, "id int, k string, at date"), spark.createDataFrame(spans, "sid int, k string, lo date, hi date")
    expected = sorted((i, j) for i, k, a in points for j, m, lo, hi in spans if a and lo and k == m and lo <= a <= hi)
    assert sorted(tuple(r) for r in within_intervals(p, s, ["k"], "at", "lo", "hi").select("id", "sid").collect()) == expected
    assert {r[0] for r in within_intervals(p, s, ["k"], "at", "lo", "hi", "left_semi").select("id").collect()} == {i for i, _ in expected}
    assert within_intervals(p, s.limit(0), ["k"], "at", "lo", "hi", "left_anti").count() == len(points)


def test_as_of(spark):
    left = spark.createDataFrame([(1, "a", 5), (2, "a", 1), (3, "b", 9), (4, None, 9)], "id int, k string, t int")
    right = spark.createDataFrame([("a", 2, "x", 1), ("a", 5, "y", 1), ("a", 5, "z", 2), ("a", 6, "w", 1), ("c", 1, "q", 1), ("b", None, "n", 1)], "k string, u int, v string, tie int")
    assert sorted(tuple(r) for r in as_of(left, right, ["k"], "t", "u", ["v"], "tie").select("id", "v").collect()) == [(1, "z"), (2, None), (3, None), (4, None)]


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_as_of_against_brute_force(spark, width):
    rng = random.Random(6)
    left = [(i, rng.choice("ab"), rng.randint(0, 60)) for i in range(80)]
    right = [(rng.choice("ab"), rng.randint(0, 60), f"v{i}", i) for i in range(50)]
    got = {r["id"]: r["v"] for r in as_of(spark.createDataFrame(left, "id int, k string, t int"), spark.createDataFrame(right, "k string, u int, v string, tie int"), ["k"], "t", "u", ["v"], "tie", width).collect()}
    assert got == {i: max(((u, n, v) for m, u, v, n in right if m == k and u <= t), default=(0, 0, None))[2] for i, k, t in left}


def test_recent_against_brute_force(spark):
    rng = random.Random(7)
    rows = [(i, rng.choice("ab"), rng.randint(-50, 300)) for i in range(100)]
    got = {r["id"]: r["recent"] for r in recent_within(spark.createDataFrame(rows, "id int, k string, s long"), ["k"], "s", 20).collect()}
    assert got == {i: sum(m == k and s - 20 <= t <= s for _, m, t in rows) for i, k, s in rows}


def test_runs_gaps_and_previous(spark):
    runs = spark.createDataFrame([("a", 1, True), ("a", 2, False), ("a", 3, True), ("a", 4, True), ("b", 1, True), ("c", 1, False), ("d", 1, None)], "k string, t int, f boolean")
    assert sorted(tuple(r) for r in trailing_run(runs, ["k"], "t", F.col("f")).collect()) == [("a", 2), ("b", 1), ("c", 0), ("d", 0)]
    days = spark.createDataFrame([("a", date(2024, 1, 5)), ("a", date(2024, 1, 9)), ("a", date(2024, 4, 2)), ("b", date(2024, 1, 1)), ("b", None)], "k string, d date")
    assert sorted(tuple(r) for r in missing_months(days, ["k"], "d").collect()) == [("a", date(2024, 2, 1)), ("a", date(2024, 3, 1))]
    seen = spark.createDataFrame([("u", 1, "x"), ("u", 2, None), ("u", 3, "x"), ("u", 4, "y")], "k string, t int, v string")
    assert [tuple(r) for r in previous_value(seen, ["k"], ["t"], "v", F.floor(F.col("t") / 2)).orderBy("t").select("previous", "changed").collect()] == [(None, None), ("x", None), ("x", False), ("x", True)]


def test_latest_and_first(spark):
    df = spark.createDataFrame([("a", 1, "p"), ("a", 2, "q"), ("a", 2, "o"), ("b", None, "r")], "k string, t int, v string")
    assert sorted(tuple(r) for r in latest(df, ["k"], [F.col("t").desc(), F.col("v")]).select("k", "v").collect()) == [("a", "o"), ("b", "r")]
    assert sorted(tuple(r) for r in first_of(df, ["k"], ["t", "v"], ["v"]).collect()) == [("a", "p"), ("b", "r")]


def test_dedup(spark):
    df = spark.createDataFrame([(2, "x"), (1, "x"), (3, None), (4, "")], "id int, c string")
    assert sorted(tuple(r)[1:] for r in by_content(df, "c", ["id"], ["id"]).collect()) == [(1, 4), (2, 1)]
    a, b = spark.createDataFrame([(1, None), (2, "x"), (2, "x")], "a int, b string"), spark.createDataFrame([(1, None)], "a int, b string")
    assert [tuple(r) for r in not_yet_stored(a, b, ["a", "b"]).collect()] == [(2, "x"), (2, "x")]
    x, y = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string"), spark.createDataFrame([(2, "c"), (3, None), (4, "d")], "k int, v string")
    assert sorted(tuple(r) for r in snapshot_diff(x, y, ["k"], ["v"]).collect()) == [(1, "REMOVED"), (2, "CHANGED"), (4, "ADDED")]


def fold(rows):
    """The merge by brute force: one key, rows in order."""
    figure, split, sources, version, out = None, None, set(), 0, []
    for i, amount, source, parts in rows:
        if amount is None or amount <= 0 or source is None:
            out.append((i, "REJECTED", None))
            continue
        same = figure is not None and abs(figure - amount) < 1e-6
        if figure is None:
            what = "INSERTED"
        elif same and parts == split:
            what = "UNCHANGED"
        elif source in sources:
            what = "AMENDED"
        else:
            what = "CONFLICT"
        if what in ("INSERTED", "AMENDED"):
            figure, split, sources, version = amount, parts, {source}, version + 1
        elif same:
            sources.add(source)
        out.append((i, what, version))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_versioned_merge_against_a_fold(spark, seed):
    rng = random.Random(seed)
    rows = [(f"{k}{i}", k, i, rng.choice([1.0, 1.0000001, 1.25, 0.0, None]), rng.choice(["u", "v", "w", None]), rng.choice([(("x", 1.0),), (("x", 0.5), ("y", 0.5))])) for k in "abc" for i in range(12)]
    df = spark.createDataFrame([(*r[:5], [tuple(p) for p in rng.sample(r[5], len(r[5]))]) for r in rows], "id string, k string, at int, amount double, source string, parts array<struct<kind:string,amount:double>>")
    got = sorted((r["id"], r["outcome"], r["version"]) for r in merge_versions(df, ["k"], ["at"], "id", "amount", "source", "parts").collect())
    expected = sorted(x for k in "abc" for x in fold([(r[0], r[3], r[4], r[5]) for r in rows if r[1] == k]))
    assert got == expected


def test_merge_cases(spark):
    rows = [("1", "k", 1, 1.25, "u", False), ("2", "k", 2, 1.25, "u", False), ("3", "k", 3, 1.3, "w", True), ("4", None, 1, 1.0, "u", False)]
    df = spark.createDataFrame(rows, "id string, k string, at int, amount double, source string, am boolean")
    out = {r["id"]: (r["outcome"], r["version"]) for r in merge_versions(df, ["k"], ["at"], "id", "amount", "source", amendment="am").collect()}
    assert out == {"1": ("INSERTED", 1), "2": ("UNCHANGED", 1), "3": ("AMENDED", 2), "4": ("REJECTED", None)}
    assert merge_versions(df.limit(0), ["k"], ["at"], "id", "amount", "source").count() == 0


def test_overwrite(spark):
    kinds = "k int, name string, since date, seen int"
    old, new = spark.createDataFrame([(1, "a", date(2020, 1, 1), 5), (2, "b", None, 1)], kinds), spark.createDataFrame([(1, None, None, 3), (3, "c", None, None)], kinds)
    got = sorted(tuple(r) for r in overwrite_by_key(old, new, ["k"], ("since",), ("seen",)).collect())
    assert got == [(1, None, date(2020, 1, 1), 5), (2, "b", None, 1), (3, "c", None, None)]


def test_first_yielding_and_fallback(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "a")], "k int, t string")
    readers = {"one": lambda d: d.filter("t = 'a'"), "two": lambda d: d.filter("t IN ('a', 'b')").union(d.filter("t = 'b'"))}
    assert sorted(tuple(r) for r in first_yielding(df, ["k"], readers).select("k", "route").collect()) == [(1, "one"), (2, "two"), (2, "two")]
    status = spark.createDataFrame([(1, "YES"), (2, "UNKNOWN"), (3, "UNKNOWN"), (4, None)], "k int, s string")
    out = with_fallback(status, "s = 'UNKNOWN'", ["k"], lambda keys: keys.filter("k = 2").withColumn("s", F.lit("NO")))
    assert sorted(map(str, out.collect())) == sorted(["Row(k=1, s='YES')", "Row(k=2, s='NO')", "Row(k=3, s='UNKNOWN')", "Row(k=4, s=None)"])


def test_long_intervals_go_by_larger_buckets(spark):
    days = [date(2020, 1, 1), date(2024, 6, 1), date(9999, 12, 31), date(1900, 1, 1)]
    points = spark.createDataFrame([(k, d) for k in "ab" for d in days], "k string, d date")
    ends = [("a", date(2024, 1, 1), date(9999, 12, 31), 1), ("a", date(2024, 5, 1), date(2024, 7, 1), 2), ("b", date(1, 1, 1), date(9999, 12, 31), 3), ("b", date(2021, 1, 1), date(2020, 1, 1), 4), ("b", None, date(2020, 1, 1), 5)]
    intervals = spark.createDataFrame(ends, "k string, s date, e date, n int")
    pairs = {(k, d, n) for k, d in ((k, d) for k in "ab" for d in days) for q, s, e, n in ends if q == k and s and s <= d <= e}
    got = within_intervals(points, intervals, ["k"], "d", "s", "e")
    assert {(r["k"], r["d"], r["n"]) for r in got.collect()} == pairs and got.count() == len(pairs)
    semi = [tuple(r) for r in within_intervals(points, intervals, ["k"], "d", "s", "e", "left_semi").collect()]
    assert sorted(semi) == sorted({(k, d) for k, d, _ in pairs})
    anti = [tuple(r) for r in within_intervals(points, intervals, ["k"], "d", "s", "e", "left_anti").collect()]
    assert sorted(semi + anti) == sorted((k, d) for k in "ab" for d in days)


def test_bucketed_windows_equal_whole_ones(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(["a", "b", None]), rng.choice([None, *range(30)]), rng.choice([None, "x", "y"])) for i in range(200)]
    df = spark.createDataFrame(rows, "i int, k string, t int, v string")
    w = Window.partitionBy("k").orderBy(F.col("t").asc_nulls_first(), "i")
    plain = df.select("i", F.last("v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("p"), F.max("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("m"), F.row_number().over(w).alias("n"))
    bucket = F.floor(F.col("t") / 7)
    a = previous_value(df, ["k"], ["t", "i"], "v", bucket, "p").select("i", "p")
    b = running_max(df, ["k"], ["t", "i"], "v", bucket, "m").select("i", "m")
    c = numbered(df, ["k"], [F.col("t").asc_nulls_first(), F.col("i")], bucket, "n").select("i", "n")
    assert sorted(map(tuple, a.join(b, "i").join(c, "i").collect())) == sorted(map(tuple, plain.collect()))
