"""Queries of the document readers.

The tables hold few documents in the formats the readers are for, so most queries write rows of a table as such
documents, read them back, and are compared with the rows. Schedules, dates and links are read from the texts there are.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from distriq.functions.text import dateline, first_date, find_dates, json_after, labelled_amount, labelled_dates, payout_sentence, sentences, unescape
from distriq.operators.fallback import first_yielding
from distriq.operators.nested import shred_json
from distriq.plans.relational import query as _register
from distriq.plans import relational
from distriq.durable import fresh_path
from distriq.sources.documents import feed_rows, html_rows, index_rows, rows_to_payouts, text_rows, workbook_rows, zipped
from distriq.sources.files import export_csv, export_xlsx, read_labelled, read_universe_text, report_json
from distriq.sources.tables import load

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(sql: str | None = None):
    def register(function):
        _register(sql)(function)
        QUERIES[function.__name__] = relational.QUERIES.pop(function.__name__)
        if sql is not None:
            ORACLE_SQL[function.__name__] = relational.ORACLE_SQL.pop(function.__name__)
        return function

    return register


def _schedules(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "distribution_event").select("event_id", "class_id", "ex_date", "record_date", "payable_date", F.col("gross_amount").cast("double").alias("amount")).distinct()


# the readers take dates of this century only
_ROWS_SQL = "SELECT DISTINCT event_id, ex_date, record_date, payable_date, gross_amount::DOUBLE AS amount FROM distribution_event WHERE ex_date >= DATE '2000-01-01'"


@query(_ROWS_SQL)
def html_table_roundtrip(spark, d):
    cell = lambda c: F.concat(F.lit("<td>"), F.coalesce(c, F.lit("")), F.lit("</td>"))
    page = F.concat(
        F.lit("<html><TABLE class='x'><tr><th scope='col'>Ex-Date</th><th>Record Date</th><th>Payable&nbsp;Date</th><th>Amount per unit</th></tr>\n<tr>"),
        cell(F.date_format("ex_date", "MMMM d, yyyy")), cell(F.date_format("record_date", "M/d/yyyy")), cell(F.date_format("payable_date", "d MMM yyyy")), cell(F.concat(F.lit(" $<b>"), F.col("amount").cast("decimal(12,6)").cast("string"), F.lit("</b> "))),
        F.lit("</tr></TABLE></html>"),
    )
    pages = _schedules(spark, d).select("event_id", page.alias("page"))
    rows = html_rows(pages, "event_id", "page")
    return rows_to_payouts(rows, ["event_id"]).select("event_id", "ex_date", "record_date", "payable_date", "amount").distinct()


@query(_ROWS_SQL)
def json_feed_roundtrip(spark, d):
    record = F.struct(F.col("ex_date").cast("string").alias("exDate"), F.col("record_date").cast("string").alias("recordDate"), F.date_format("payable_date", "yyyy/M/d").alias("payable_date"), F.col("amount").cast("decimal(12,6)").cast("string").alias("grossAmount"))
    feeds = _schedules(spark, d).select("event_id", F.to_json(F.struct(F.struct(F.array(record).alias("items")).alias("data"))).alias("feed"))
    rows = feed_rows(shred_json(feeds, "event_id", "feed"))
    return rows_to_payouts(rows.withColumnRenamed("root_id", "event_id"), ["event_id"]).select("event_id", "ex_date", "record_date", "payable_date", "amount").distinct()


@query("SELECT DISTINCT event_id, ex_date, record_date, payable_date, declaration_date, gross_amount::DOUBLE AS amount FROM distribution_event WHERE ex_date >= DATE '2000-01-01' AND (record_date IS NOT NULL OR payable_date IS NOT NULL OR declaration_date IS NOT NULL)")
def text_schedule_roundtrip(spark, d):
    """Each row of the table as a schedule in plain text, under a header of just the dates it has, and read back.

    A row whose only date is the ex-date isn't read back, as a header names two kinds of dates at least, nor are years
    before 2000.
    """
    e = load(spark, d, "distribution_event")
    s = e.select("event_id", "ex_date", "record_date", "payable_date", "declaration_date", F.col("gross_amount").cast("double").alias("amount")).distinct()
    forms = {"ex": "yyyy-MM-dd", "record": "MMM d, yyyy", "payable": "MM/dd/yyyy", "declaration": "d MMMM yyyy"}
    names = {"ex": "Ex-Date", "record": "Record Date", "payable": "Payable Date", "declaration": "Declaration Date"}
    header = F.concat_ws("  ", *(F.when(F.col(f"{k}_date").isNotNull(), F.lit(n)) for k, n in names.items()), F.lit("Amount"))
    line = F.concat_ws("   ", *(F.date_format(f"{k}_date", form) for k, form in forms.items()), F.concat(F.lit("$"), F.col("amount").cast("decimal(12,6)").cast("string")))
    # an event comes in several versions, which are pages of their own
    texts = s.select(F.struct("event_id", F.xxhash64(*s.columns).alias("version")).alias("page"), F.concat(F.lit("Fund schedule\n"), header, F.lit("\n\n"), line, F.lit("\nTotal 12\n")).alias("text"))
    rows = rows_to_payouts(text_rows(texts, "page", "text"), ["page"])
    return rows.select("page.event_id", "ex_date", "record_date", "payable_date", "declaration_date", "amount").distinct()


@query("SELECT DISTINCT cik AS filer, regexp_replace(trim(fund_name), '\\s{2,}', '  ', 'g') AS company, CAST(updated_at AT TIME ZONE 'UTC' AS DATE) AS filed, 'funds/' || cik || '.txt' AS path FROM fund_master WHERE cik IS NOT NULL AND trim(fund_name) <> ''")
def index_file_roundtrip(spark, d):
    """Each fund with a filer's number as a line of a day's filing indexes, and read back; a fund without a name isn't."""
    f = load(spark, d, "fund_master").filter(F.col("cik").isNotNull()).select("fund_id", "cik", "fund_name", F.to_date("updated_at").alias("filed")).distinct()
    line = F.concat_ws("   ", F.lit("497K"), F.nullif(F.trim("fund_name"), F.lit("")), F.col("cik"), F.date_format("filed", "yyyyMMdd"), F.concat(F.lit("funds/"), "cik", F.lit(".txt")))
    # a day's lines in a thousand files, so that none grows with the table
    index = f.groupBy("filed", F.pmod(F.xxhash64("fund_id"), F.lit(1000)).alias("file")).agg(F.concat(F.lit("Form Type   Company\n--------------------\n"), F.array_join(F.array_sort(F.collect_list(line)), "\n")).alias("text"))
    return index_rows(index.withColumn("page", F.struct("filed", "file")).select("page", "text"), "page", "text").select("filer", "company", "filed", "path").distinct()


@query("SELECT DISTINCT class_id, ex_date, event_id FROM distribution_event")
def parallel_arrays(spark, d):
    """A feed per class and year, its arrays as long as the year has events, the days one longer than the ids."""
    e = load(spark, d, "distribution_event").select("class_id", "ex_date", "event_id").distinct()
    # of structs, as a list of days alone would lack the NULL ones
    years = e.groupBy("class_id", F.year("ex_date").alias("year")).agg(F.collect_list(F.struct("ex_date", "event_id")).alias("of"))
    column = F.struct(F.concat(F.col("of.ex_date"), F.array(F.lit(None).cast("date"))).alias("days"), F.col("of.event_id").alias("ids"))
    read = years.select("class_id", F.from_json(F.to_json(column), "days array<date>, ids array<string>").alias("a"))
    return read.select("class_id", F.explode(zipped({"day": F.col("a.days"), "event": F.col("a.ids")})).alias("z")).select("class_id", F.col("z.day").alias("ex_date"), F.col("z.event").alias("event_id"))


@query("SELECT DISTINCT class_id, ticker FROM share_class WHERE ticker IS NOT NULL")
def script_json_roundtrip(spark, d):
    s = load(spark, d, "share_class").filter(F.col("ticker").isNotNull()).select("class_id", "ticker").distinct()
    data = F.to_json(F.struct("ticker", F.lit('a "}" in a string').alias("note"), F.struct(F.lit(1).alias("a")).alias("inner")))
    pages = s.select("class_id", F.concat(F.lit("<script>var x = {}; const fundData = "), data, F.lit("; init({});</script>")).alias("page"))
    return pages.select("class_id", F.from_json(json_after("const fundData = ")(F.col("page")), "ticker string, note string").alias("j")).select("class_id", F.col("j.ticker").alias("ticker"))


@query("SELECT DISTINCT fund_id, fund_name FROM fund_master")
def attribute_json_roundtrip(spark, d):
    f = load(spark, d, "fund_master").select("fund_id", "fund_name").distinct()
    escaped = F.replace(F.replace(F.to_json(F.struct("fund_name")), F.lit("&"), F.lit("&amp;")), F.lit('"'), F.lit("&quot;"))
    pages = f.select("fund_id", F.concat(F.lit('<app-root data-profile="'), escaped, F.lit('"></app-root>')).alias("page"))
    attribute = unescape(F.regexp_extract("page", 'data-profile="([^"]*)"', 1))
    return pages.select("fund_id", F.from_json(attribute, "fund_name string").alias("j")).select("fund_id", F.col("j.fund_name").alias("fund_name"))


@query("""SELECT extract_id, CASE WHEN regexp_matches(ex_date, '^(\\d{4}-\\d\\d-\\d\\d|\\d\\d/\\d\\d/\\d{4}|[A-Za-z]+ \\d+, \\d{4})$') THEN coalesce(try_strptime(ex_date, '%Y-%m-%d'), try_strptime(ex_date, '%m/%d/%Y'), try_strptime(ex_date, '%b %d, %Y'), try_strptime(ex_date, '%B %d, %Y'))::DATE END AS ex_day FROM layer_b_extracted_events""")
def written_dates(spark, d):
    """The first date each row's text has: NULL where first_date reads nothing, as in blank ones and notations it doesn't know (dd-Mon-yyyy, yyyymmdd, a time right after the day)."""
    return load(spark, d, "layer_b_extracted_events").select("extract_id", first_date(F.col("ex_date")).alias("ex_day"))


# Labels of the whole amount in notices.
AMOUNT_LABEL = r"total\s+distribution(?:\s+per\s+(?:share|unit))?|distribution\s+per\s+(?:share|unit)|distribution\s+(?:amount|rate)|per\s+(?:share|unit)\s+distribution"


@query()
def document_dates(spark, d):
    """How many dates each text has, those that follow their labels, the dateline's, and the labelled amount."""
    docs = load(spark, d, "documents").select("doc_id", "text")
    text = F.col("text")
    dates = labelled_dates(text) | {"published": dateline(text)}
    return docs.select("doc_id", F.size(find_dates(text)).alias("n_dates"), *(c.alias(f"{k}_date") for k, c in dates.items()), labelled_amount(text, AMOUNT_LABEL).alias("amount"))


@query()
def document_evidence(spark, d):
    """Of each text the first sentence that tells a payout and its date, with the amount it names."""
    docs = load(spark, d, "documents").select("doc_id", payout_sentence(F.col("text")).alias("s"))
    return docs.filter(F.col("s").isNotNull()).select("doc_id", "s.event_date", "s.amount", "s.snippet")


@query("SELECT doc_id, count(*) AS schedule_rows FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '\\r?\\n')) AS l, instr(lower(text), 'ex-date | record date | payable date | amount') > 0 AS has FROM documents) WHERE has AND regexp_full_match(l, '[^|]*\\d{4}[^|]*\\|[^|]*\\d{4}[^|]*\\|[^|]*\\d{4}[^|]*\\| ?\\d*\\.\\d+ *') GROUP BY doc_id")
def document_schedules(spark, d):
    docs = load(spark, d, "documents").select("doc_id", "text").filter(F.contains(F.lower("text"), F.lit("ex-date | record date | payable date | amount")))
    rows = text_rows(docs, "doc_id", "text")
    return rows.filter(F.size("headers") == 4).groupBy("doc_id").agg(F.count(F.lit(1)).alias("schedule_rows"))


@query("SELECT doc_id, sentence FROM (SELECT doc_id, [s FOR s IN string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)) IF contains(s, 'declared')][1] AS sentence FROM documents) WHERE sentence IS NOT NULL")
def first_declaring_sentence(spark, d):
    docs = load(spark, d, "documents").select("doc_id", F.get(F.filter(sentences(F.col("text")), lambda s: F.contains(s, F.lit("declared"))), F.lit(0)).alias("sentence"))
    return docs.filter(F.col("sentence").isNotNull())


@query("""SELECT doc_id, CASE WHEN regexp_matches(text, '(^|\\n)[^|\\n]*\\d{4}[^|\\n]*\\|[^|\\n]*\\d{4}[^|\\n]*\\|[^|\\n]*\\d{4}[^|\\n]*\\| ?\\d*\\.\\d+') AND instr(lower(text), 'ex-date | record date | payable date | amount') > 0 THEN 'SCHEDULE' WHEN instr(text, 'declared') > 0 THEN 'SENTENCE' ELSE 'TEXT' END AS route FROM documents WHERE length(text) > 0""")
def document_routes(spark, d):
    """Each document by the first way it can be read: as a schedule, by a declaring sentence, as plain text."""
    docs = load(spark, d, "documents").select("doc_id", "text").filter(F.length("text") > 0)
    readers = {
        "SCHEDULE": lambda df: text_rows(df.filter(F.contains(F.lower("text"), F.lit("ex-date | record date | payable date | amount"))), "doc_id", "text").filter(F.size("headers") == 4).select("doc_id").distinct(),
        "SENTENCE": lambda df: df.filter(F.contains("text", F.lit("declared"))).select("doc_id"),
        "TEXT": lambda df: df.select("doc_id"),
    }
    return first_yielding(docs, ["doc_id"], readers)


# files written and read back


@query("SELECT DISTINCT class_id, nullif(trim(fund_id), '') AS fund_id, nullif(trim(ticker), '') AS ticker, nullif(trim(currency), '') AS currency FROM share_class")
def csv_roundtrip(spark, d):
    """A table exported as CSV and read by the reader of labelled rows: cells but the key trimmed, blank ones NULL."""
    out = fresh_path(spark, "csv")
    export_csv({"share_class": load(spark, d, "share_class").select("class_id", "fund_id", "ticker", "currency")}, out)
    return read_labelled(spark, f"{out}/share_class", ["class_id", "fund_id"], unchanged=["class_id"], blank_rows=True).distinct()


@query("SELECT DISTINCT fund_id, country, fund_name, fund_type, fund_family, cik, FALSE AS is_etf, FALSE AS is_verified FROM fund_master")
def universe_roundtrip(spark, d):
    """Funds written as JSON arrays and read by the reader of universes: flags that are missing are false."""
    out = fresh_path(spark, "universe")
    funds = load(spark, d, "fund_master").select(F.to_json(F.struct("fund_id", "country", "fund_name", "fund_type", "fund_family", "cik")).alias("fund"), F.pmod(F.xxhash64("fund_id"), F.lit(100)).alias("file"))
    # some funds to a file, as a file is read by one task
    files = funds.groupBy("file").agg(F.concat(F.lit("["), F.array_join(F.collect_list("fund"), ","), F.lit("]")).alias("value"))
    files.select("value").write.option("lineSep", "\n").text(out, compression="none")
    arrays = spark.read.text(out).select("value")
    return read_universe_text(arrays, "value").select("fund_id", "country", "fund_name", "fund_type", "fund_family", "cik", "is_etf", "is_verified").distinct()


@query("SELECT DISTINCT fund_id, nullif(fund_name, '') AS fund_name, strftime(created_at AT TIME ZONE 'UTC', '%Y-%m-%d') AS record_date FROM fund_master")
def workbook_roundtrip(spark, d):
    """A table exported as a workbook and read back by its headers."""
    f = load(spark, d, "fund_master").select("fund_id", "fund_name", F.date_format("created_at", "yyyy-MM-dd").alias("record_date")).distinct()
    out = fresh_path(spark, "book").removeprefix("file://")
    os.makedirs(out)
    export_xlsx({"funds": f}, f"{out}/funds.xlsx")
    rows = workbook_rows(spark.read.format("binaryFile").load(out), "path", "content")
    cell = lambda name: F.nullif(F.get("cells", F.array_position("headers", name).cast("int") - 1), F.lit(""))
    return rows.select(*(cell(n).alias(n) for n in ("fund_id", "fund_name", "record_date")))


@query("SELECT metric, key, value FROM (SELECT 'events' AS metric, NULL AS key, count(*)::VARCHAR AS value FROM distribution_event UNION ALL SELECT 'by_type', coalesce(distribution_type, ''), count(*)::VARCHAR FROM distribution_event GROUP BY ALL)")
def report_roundtrip(spark, d):
    """A report of counts written as JSON and read back as rows."""
    e = load(spark, d, "distribution_event")
    one = e.agg(F.lit("events").alias("metric"), F.lit(None).cast("string").alias("key"), F.count(F.lit(1)).cast("string").alias("value"))
    kinds = e.groupBy(F.coalesce("distribution_type", F.lit("")).alias("key")).agg(F.count(F.lit(1)).cast("string").alias("value")).select(F.lit("by_type").alias("metric"), "key", "value")
    report = json.loads(report_json(one.unionByName(kinds)))
    rows = [(metric, k, v) for metric, held in sorted(report.items()) for k, v in (held.items() if isinstance(held, dict) else [(None, held)])]
    return spark.createDataFrame(rows, "metric string, key string, value string")
