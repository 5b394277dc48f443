from datetime import datetime

from distriq.operators import skew
from distriq.operators.orphans import orphan_counts, orphan_references
from distriq.operators.skew import salted_join

PARENT = "k string, created timestamp, gone timestamp"
CHILD = "id string, ref string, at timestamp, child_id string"


def day(n, month=1):
    return datetime(2024, month, n)


def run(spark, child, parent, deleted="gone"):
    c, p = spark.createDataFrame(child, CHILD), spark.createDataFrame(parent, PARENT)
    return {tuple(r) for r in orphan_references(c, "id", "ref", "at", p, "k", "created", deleted, "t").collect()}


def test_kinds(spark):
    parent = [("A ", day(5), None), ("a", day(9), day(10)), ("B", day(1), day(2)), (None, day(1), None)]
    child = [("1", " a", day(4), "x"), ("2", "A", day(5), "x"), ("3", "b\t", day(1), "x"), ("4", "zz", day(3, 2), "x"), ("5", " ", day(1), "x"), ("6", None, day(1), "x"), ("4", "zz", day(3, 2), "x"), ("7", "a", None, "x"), ("8", "q", None, "x")]
    assert run(spark, child, parent) == {("t", "1", "LATE", "2024-01"), ("t", "3", "DELETED", "2024-01"), ("t", "4", "MISSING", "2024-02"), ("t", "8", "MISSING", "")}


def test_no_deletions_known(spark):
    assert run(spark, [("1", "b", day(9), "")], [("B", day(1), day(2))], None) == set()


def test_empty_tables(spark):
    assert run(spark, [], [("B", day(1), None)]) == set()
    assert run(spark, [("1", "b", day(1), "")], []) == {("t", "1", "MISSING", "2024-01")}


def test_period_is_utc(spark):
    child = spark.sql("SELECT '1' AS id, 'x' AS ref, TIMESTAMP'2024-02-01 00:30:00' AS at, '' AS child_id")
    parent = spark.createDataFrame([], PARENT)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert orphan_references(child, "id", "ref", "at", parent, "k", "created", "gone", "t").collect()[0]["period"] == "2024-02"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_hot_keys_give_the_same_rows(spark, monkeypatch):
    child = [(str(i), "gone" if i % 3 else "other", day(1 + i % 9), "") for i in range(300)]
    plain = run(spark, child, [])
    monkeypatch.setattr(skew, "TASK_ROWS", 50)
    assert run(spark, child, []) == plain
    assert len(plain) == 300


def test_counts(spark):
    df = spark.createDataFrame([("t", "1", "LATE", "2024-01"), ("t", "2", "LATE", "2024-01")], "child_table string, child_id string, kind string, period string")
    assert [r.asDict() for r in orphan_counts(df).collect()] == [{"child_table": "t", "period": "2024-01", "kind": "LATE", "n_orphans": 2}]


def test_salted_join(spark, monkeypatch):
    many = spark.createDataFrame([(1, i) for i in range(40)] + [(2, 0), (3, 0), (None, 0)], "k int, x int")
    one = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    counts = many.groupBy("k").count()
    for rows, keys in ((100, 5), (7, 5), (7, 0)):  # no hot key, a broadcast one, too many to broadcast
        monkeypatch.setattr(skew, "TASK_ROWS", rows)
        monkeypatch.setattr(skew, "HOT_KEYS", keys)
        for how in ("inner", "left"):
            got = salted_join(many, one, ["k"], ["x"], counts, "count", how).select("k", "x", "v").collect()
            assert sorted(map(str, got)) == sorted(map(str, many.join(one, ["k"], how).select("k", "x", "v").collect()))
