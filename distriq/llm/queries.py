"""Queries of the training-data operators (problems 3, 5, 6, 7 and 8) and the SQL they are compared with."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from distriq.llm.history import restated
from distriq.llm.leakage import leaks, without_leaks
from distriq.llm.mixing import mix, tokenizer_path
from distriq.llm.pii import find_mentions, redact
from distriq.llm.survivor import Learned, Stated, Survivors, precedence, survivors, transitions
from distriq.sources.tables import load


def fund_key(fund_id: Column) -> Column:
    """The fund, whatever the case, blanks and separators of its id; NULL if nothing is left."""
    return F.nullif(F.upper(F.regexp_replace(fund_id, r"(?U)[\s_\-]+", "")), F.lit(""))


def any_date(text: Column) -> Column:
    """The date a text holds in one of the notations of the extractions (with slashes the month is first), else NULL."""
    plain = F.trim(text)
    word = F.initcap(F.lower(plain))
    notations = [
        (plain, r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
        (F.substring(plain, 1, 10), r"^\d{4}-\d{2}-\d{2}[T ].*$", "yyyy-MM-dd"),
        (plain, r"^\d{8}$", "yyyyMMdd"),
        (plain, r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
        (plain, r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
        (word, r"^\p{L}{3}\.? \d{1,2},? \d{4}$", "MMM d yyyy"),
        (word, r"^\p{L}{4,} \d{1,2},? \d{4}$", "MMMM d yyyy"),
        (word, r"^\d{1,2}[- ]\p{L}{3}[- ]\d{4}$", "d MMM yyyy"),
        (word, r"^\d{1,2}[- ]\p{L}{4,}[- ]\d{4}$", "d MMMM yyyy"),
    ]
    out = F.lit(None).cast("date")
    for value, shape, form in reversed(notations):
        tidy = F.regexp_replace(F.regexp_replace(value, r"[,.]", ""), r"(?<=\p{L})-|-(?=\p{L})", " ") if "MMM" in form else value
        # the words are capitalised again, as a dash doesn't begin a word there
        tidy = F.initcap(tidy) if "MMM" in form else tidy
        out = F.when(plain.rlike(shape), F.to_date(F.try_to_timestamp(tidy, F.lit(form)))).otherwise(out)
    return out


def p3_found(spark: SparkSession, directory: str) -> DataFrame:
    rows = load(spark, directory, "layer_b_extracted_events")
    entries = rows.select("batch_no", F.col("extract_id").alias("id"), fund_key(F.col("fund_id")).alias("key"), F.unix_date(any_date(F.col("ex_date"))).alias("day"), F.col("gross_amount").alias("amount"))
    return restated(entries, "batch_no")


DATES = ["record_date", "payable_date", "declaration_date"]


def _folded(name: str) -> Column:
    return F.upper(F.regexp_replace(name, r"(?U)^\s+|\s+$", ""))


def _distribution(orders: list[Stated | Learned]) -> Survivors:
    return Survivors({"class_key": _folded("class_id"), "category_key": _folded("distribution_category"), "ex_day": F.col("ex_date")}, orders, "event_id", DATES)


def _mark(otherwise: Column) -> Column:
    first = F.substring(_folded("estimated_or_final"), 1, 1)
    return F.when(first == "F", "final").when(first == "E", "estimated").otherwise(otherwise)


def _fixed_orders() -> list[Learned]:
    """The attributes p5_found goes by, each with the number by which its definition fixes which of two values is better."""
    superseded = F.coalesce("is_superseded", F.lit(False))
    mark = _mark(F.lit("unknown"))
    return [
        Learned("is_superseded", superseded, "updated_at", stated=superseded.cast("int")),
        Learned("estimated_or_final", mark, "updated_at", stated=F.when(mark == "final", 0).when(mark == "estimated", 1).otherwise(2)),
        Learned("source_tier", F.col("source_tier"), "updated_at", stated=F.col("source_tier")),
        Learned("version", F.col("version"), "updated_at", stated=-F.col("version")),
    ]


def p5_found(spark: SparkSession, directory: str) -> DataFrame:
    events = load(spark, directory, "distribution_event").filter(F.col("deleted_at").isNull())
    # all values' order is fixed, so nothing is learned here; p5_currency goes by what is learned
    orders = [*(Stated(o.stated) for o in _fixed_orders()), Stated(-F.unix_micros(F.col("updated_at").cast("timestamp")))]
    return survivors(events, _distribution(orders), least=2).select("event_id", *(f"{d}_from" for d in DATES)).distinct()


def p5_precedence(spark: SparkSession, directory: str) -> DataFrame:
    """The ranks of p5_found's orders in one graph with the steps the rows' times tell, and how many groups' steps the stated order overrules."""
    events = load(spark, directory, "distribution_event").filter(F.col("deleted_at").isNull())
    orders = _fixed_orders()
    return precedence(transitions(events, _distribution(orders).keys, orders))


def p5_currency(spark: SparkSession, directory: str) -> DataFrame:
    """The same groups with orders of mark, flag and version learned only, timestamps used only to learn: as if the survivors' were missing."""
    events = load(spark, directory, "distribution_event").filter(F.col("deleted_at").isNull())
    orders = [
        Learned("is_superseded", F.col("is_superseded"), "updated_at"),
        Learned("estimated_or_final", _mark(F.nullif(F.substring(_folded("estimated_or_final"), 1, 1), F.lit(""))), "updated_at"),
        Learned("version", F.col("version"), "updated_at"),
        Stated(F.col("source_tier")),
    ]
    return survivors(events, _distribution(orders), least=2).drop("records")


def p6_found(spark: SparkSession, directory: str) -> DataFrame:
    return leaks(load(spark, directory, "documents"), load(spark, directory, "eval_item")).select("doc_id", "item_id").distinct()


def p6_matches(spark: SparkSession, directory: str) -> DataFrame:
    return leaks(load(spark, directory, "documents"), load(spark, directory, "eval_item"))


def p6_clean(spark: SparkSession, directory: str) -> DataFrame:
    """The documents that hold nothing of the test items."""
    documents = load(spark, directory, "documents")
    return without_leaks(documents, leaks(documents, load(spark, directory, "eval_item"))).select("doc_id", "source", "n_chars").distinct()


def p7_mix(spark: SparkSession, directory: str) -> DataFrame:
    return mix(load(spark, directory, "documents"), load(spark, directory, "mix_target"), tokenizer_path()).documents


def p7_shares(spark: SparkSession, directory: str) -> DataFrame:
    return mix(load(spark, directory, "documents"), load(spark, directory, "mix_target"), tokenizer_path()).shares


def p7_blocks(spark: SparkSession, directory: str) -> DataFrame:
    """The mixture itself: what each slot of each shard holds."""
    return mix(load(spark, directory, "documents"), load(spark, directory, "mix_target"), tokenizer_path()).blocks


def p8_found(spark: SparkSession, directory: str) -> DataFrame:
    return find_mentions(load(spark, directory, "documents")).select("doc_id", "kind", "start_pos").distinct()


def p8_redacted(spark: SparkSession, directory: str) -> DataFrame:
    return redact(load(spark, directory, "documents").select("doc_id", "text")).select("doc_id", "redacted")


QUERIES = {"p8_found": p8_found, "p8_redacted": p8_redacted, "p7_mix": p7_mix, "p7_shares": p7_shares, "p7_blocks": p7_blocks, "p6_found": p6_found, "p6_matches": p6_matches, "p6_clean": p6_clean, "p3_found": p3_found, "p5_found": p5_found, "p5_currency": p5_currency, "p5_precedence": p5_precedence}

_P5_SQL = """
WITH t AS (SELECT *, upper(regexp_replace(class_id, '^\\s+|\\s+$', '', 'g')) AS c, upper(regexp_replace(distribution_category, '^\\s+|\\s+$', '', 'g')) AS k,
    CASE upper(left(regexp_replace(estimated_or_final, '^\\s+', ''), 1)) WHEN 'F' THEN 0 WHEN 'E' THEN 1 ELSE 2 END AS e
  FROM distribution_event WHERE deleted_at IS NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY c, k, ex_date ORDER BY coalesce(is_superseded, FALSE), e, source_tier NULLS LAST, version DESC NULLS LAST, updated_at DESC, event_id) AS n FROM t)
SELECT DISTINCT arg_min(event_id, n) AS event_id, coalesce(arg_min(event_id, n) FILTER (record_date IS NOT NULL), '') AS record_date_from,
  coalesce(arg_min(event_id, n) FILTER (payable_date IS NOT NULL), '') AS payable_date_from, coalesce(arg_min(event_id, n) FILTER (declaration_date IS NOT NULL), '') AS declaration_date_from
FROM r GROUP BY c, k, ex_date HAVING count(DISTINCT event_id) > 1
"""

# row by row in the order of ids: each fund's list of accepted entries is what the next row of the fund meets
_P3_SQL = """
WITH RECURSIVE e AS (SELECT extract_id AS id, nullif(upper(regexp_replace(fund_id, '[\\s\\x{00A0}_\\-]+', '', 'g')), '') AS k, gross_amount AS a, date_diff('day', DATE '1970-01-01',
    coalesce(try_strptime(t, ['%Y-%m-%d', '%Y%m%d', '%Y/%m/%d', '%m/%d/%Y', '%b %d, %Y', '%B %d, %Y', '%d-%b-%Y', '%d %b %Y', '%d %B %Y', '%Y-%m-%dT%H:%M:%SZ', '%Y-%m-%d %H:%M:%S']))::DATE) AS d
  FROM (SELECT *, trim(ex_date) AS t FROM layer_b_extracted_events WHERE batch_no IS NOT NULL)),
s AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY id) AS n FROM e WHERE k IS NOT NULL AND d IS NOT NULL AND a IS NOT NULL AND isfinite(a)),
r AS (SELECT k, n, [struct_pack(i := id, d := d, a := a)] AS acc, id, NULL::BIGINT AS first_id FROM s WHERE n = 1
  UNION ALL SELECT k, n, CASE WHEN m IS NULL THEN list_append(acc, struct_pack(i := id, d := d, a := a)) ELSE acc END, id, m
  FROM (SELECT s.k, s.n, r.acc, s.id, s.d, s.a, list_min([x.i FOR x IN r.acc IF abs(x.d - s.d) <= 1 AND abs(x.a - s.a) <= 0.005 * greatest(abs(x.a), abs(s.a))]) AS m FROM r JOIN s ON s.k = r.k AND s.n = r.n + 1))
SELECT first_id, id AS dup_id FROM r WHERE first_id IS NOT NULL
"""

ORACLE_SQL = {"p3_found": _P3_SQL, "p5_found": _P5_SQL}
