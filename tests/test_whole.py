"""Queries over whole tables: what a filter on their input once left out."""

from datetime import date

from pyspark.sql import functions as F

from distriq.plans import parsing
from distriq.sources.documents import zipped

D = date(2026, 9, 1)


def events(spark, path, rows):
    kind = "event_id string, class_id string, ex_date date, record_date date, payable_date date, declaration_date date, gross_amount decimal(18,6)"
    spark.createDataFrame([(*r, *[None] * (7 - len(r))) for r in rows], kind).write.parquet(f"{path}/distribution_event.parquet")
    return str(path)


def test_zipped_arrays_of_several_entries(spark):
    df = spark.createDataFrame([(1, [1, 2, 3], ["a", "b"]), (2, [1, None], ["a", "b", "c"]), (3, [], ["a"]), (4, None, ["a"])], "id int, n array<int>, t array<string>")
    got = df.select("id", F.explode(zipped({"n": F.col("n"), "t": F.col("t")})).alias("z")).select("id", "z.n", "z.t").collect()
    assert sorted(map(tuple, got), key=str) == [(1, 1, "a"), (1, 2, "b"), (2, 1, "a"), (2, None, "b")]


def test_parallel_arrays_of_all_days(spark, tmp_path):
    rows = [("e1", "a", date(2019, 11, 2)), ("e2", "a", D), ("e3", "a", D), ("e4", "a", None), ("e5", None, D), ("e1", "a", date(2019, 11, 2))]
    got = parsing.QUERIES["parallel_arrays"](spark, events(spark, tmp_path, rows)).collect()
    assert sorted(((r["event_id"], r["class_id"], r["ex_date"]) for r in got)) == sorted(set(rows))


def test_written_dates_of_every_row(spark, tmp_path):
    rows = [(1, "2024-03-05"), (2, "05-Mar-2024"), (3, "20240305"), (4, "2024-03-05T00:00:00Z"), (5, ""), (6, None), (7, "TBA"), (8, "March 5, 2024")]
    spark.createDataFrame(rows, "extract_id long, ex_date string").write.parquet(f"{tmp_path}/layer_b_extracted_events.parquet")
    got = {r["extract_id"]: r["ex_day"] for r in parsing.QUERIES["written_dates"](spark, str(tmp_path)).collect()}
    assert got == dict.fromkeys(range(1, 9)) | {1: date(2024, 3, 5), 8: date(2024, 3, 5)}


def test_schedules_of_rows_that_lack_dates(spark, tmp_path):
    day = [date(2026, 9, n) for n in range(1, 5)]
    rows = [("e1", "a", day[1], day[2], day[3], day[0], 1), ("e2", "a", day[1], None, day[3], None, 2), ("e2", "a", day[1], day[2], None, None, 2), ("e3", "a", day[1], None, None, day[0], 3), ("e4", "a", day[1], None, None, None, 4)]
    kind = "event_id string, class_id string, ex_date date, record_date date, payable_date date, declaration_date date, gross_amount long"
    spark.createDataFrame(rows, kind).write.parquet(f"{tmp_path}/distribution_event.parquet")
    got = parsing.QUERIES["text_schedule_roundtrip"](spark, str(tmp_path)).collect()
    assert {tuple(r) for r in got} == {(e, ex, r, p, d, float(a)) for e, _, ex, r, p, d, a in rows if e != "e4"}
