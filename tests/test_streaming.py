from datetime import datetime, timedelta

from pyspark.sql import functions as F

from distriq.sources import files
from distriq.sources.files import append_snapshot, read_snapshot, snapshot_parts, write_snapshot
from distriq.streaming.ingest import arriving, into_snapshot, new_content, sessions, windowed_counts

SCHEMA = "id long, text string, kind string, at timestamp"
START = datetime(2024, 1, 1)


def arrive(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def drained(stream, name, mode):
    query = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.table(name)


def test_stream_equals_batch(spark, tmp_path):
    rows = [(i, f"t{i % 5}", "ab"[i % 2], START + timedelta(hours=7 * i)) for i in range(20)]
    arrive(spark, str(tmp_path / "in"), rows)
    stream = arriving(spark, str(tmp_path / "in"), SCHEMA)
    got = {tuple(r) for r in drained(windowed_counts(stream, "at", "kind"), "counts", "complete").collect()}
    batch = spark.createDataFrame(rows, SCHEMA).groupBy(F.window("at", "1 day").alias("w"), "kind").agg(F.count(F.lit(1)).alias("n"))
    assert got == {tuple(r) for r in batch.select("w.start", "kind", "n").collect()}
    assert drained(new_content(stream, "text", "at", "30 days"), "fresh", "append").count() == 5


def test_sessions(spark, tmp_path):
    arrive(spark, str(tmp_path / "in"), [(i, "", "a", START + timedelta(minutes=m)) for i, m in enumerate((0, 10, 35, 120))])
    got = drained(sessions(arriving(spark, str(tmp_path / "in"), SCHEMA), "at", "kind"), "sessions", "complete").orderBy("session_start").collect()
    assert [r["n"] for r in got] == [3, 1]


def test_replay_changes_nothing(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "table")
    arrive(spark, folder, [(1, "a", "x", START), (2, "b", "x", START)])
    into_snapshot(arriving(spark, folder, SCHEMA), root, ["id"], str(tmp_path / "c1")).awaitTermination()
    arrive(spark, folder, [(2, "b", "x", START), (3, "c", "x", START)])
    into_snapshot(arriving(spark, folder, SCHEMA), root, ["id"], str(tmp_path / "c1")).awaitTermination()
    assert sorted(r["id"] for r in read_snapshot(spark, root).collect()) == [1, 2, 3]
    into_snapshot(arriving(spark, folder, SCHEMA), root, ["id"], str(tmp_path / "c2")).awaitTermination()
    assert read_snapshot(spark, root).count() == 3


def test_a_crash_before_the_pointer_leaves_the_old_state(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "table")
    write_snapshot(spark.range(5), root)

    def crash(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(files, "_point", crash)
    for write in (write_snapshot, append_snapshot):
        try:
            write(spark.range(9), root)
        except KeyboardInterrupt:
            pass
        assert read_snapshot(spark, root).count() == 5
    monkeypatch.undo()
    append_snapshot(spark.range(5, 7), root)
    assert read_snapshot(spark, root).count() == 7
    try:
        read_snapshot(spark, str(tmp_path / "nothing"))
        raise AssertionError
    except FileNotFoundError:
        pass


def test_a_batch_writes_what_it_brings(spark, tmp_path, monkeypatch):
    folder, root = str(tmp_path / "in"), str(tmp_path / "table")
    arrive(spark, folder, [(i, f"text {i}", "x", START) for i in range(20_000)])

    def ingest():
        into_snapshot(arriving(spark, folder, SCHEMA), root, ["id"], str(tmp_path / "c1")).awaitTermination()
        return [sum(f.stat().st_size for f in __import__("pathlib").Path(p).rglob("*.parquet")) for p in snapshot_parts(spark, root)]

    first = ingest()
    arrive(spark, folder, [(5, "again", "x", START), (50_000, "new", "x", START)])
    second = ingest()
    assert second[:1] == first and len(second) == 2 and second[1] < first[0] / 10
    assert read_snapshot(spark, root).count() == 20_001
    monkeypatch.setattr("distriq.streaming.ingest.PARTS", 2)
    arrive(spark, folder, [(60_000, "new", "x", START)])
    assert len(ingest()) == 1 and read_snapshot(spark, root).count() == 20_002
