"""Queries of the relational operators over the fund tables, each beside the SQL it is compared with."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from distriq.functions.dates import cadence_days, cadence_of, in_season, leap_year, month_end_within, month_windows, trailing_months
from distriq.functions.text import bare_id, date_kind, host, host_suffixes, padded_id, payout_category, spaced_key, truncated
from distriq.operators.dedup import by_content, not_yet_stored, snapshot_diff
from distriq.operators.joins import as_of, lookup, within_intervals
from distriq.operators.merge import merge_versions, overwrite_by_key
from distriq.operators.ordered import first_of, latest, missing_months, month_gaps, numbered, previous_value, recent_within, running_max, trailing_run, with_versions
from distriq.sources.tables import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

TABLES = ("fund_master", "share_class", "fund_detection_state", "distribution_event", "distribution_component", "universe_100_distribution_schedule", "layer_b_extracted_events", "multi_tier_6fund_live_validation", "documents", "eval_item", "mix_target", "events", "orders", "lineitem", "customer", "supplier", "part", "nation", "region")


def query(sql: str | None = None):
    """Register the function below under its name, with the SQL it is compared with."""

    def register(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE_SQL[function.__name__] = sql
        return function

    return register


def _funds(spark: SparkSession, d: str) -> DataFrame:
    """One row per fund: the one changed last."""
    return latest(load(spark, d, "fund_master"), ["fund_id"], [F.col("updated_at").desc(), F.col("created_at").desc(), F.col("fund_name"), F.col("status"), F.col("deleted_at").desc_nulls_last()])


_FUNDS = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY fund_id ORDER BY updated_at DESC, created_at DESC, fund_name, status, deleted_at DESC NULLS LAST) AS rn FROM fund_master) WHERE rn = 1)"
_DISTINCT_EVENTS = "(SELECT DISTINCT * FROM distribution_event)"


# scans, counts, groups


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TABLES))
def table_counts(spark, d):
    parts = [load(spark, d, t).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(t).alias("table_name"), "n_rows") for t in TABLES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("SELECT currency, count(*) AS classes, count(*) FILTER (is_monthly_payer) AS monthly, count(*) FILTER (is_etf) AS etfs, count(DISTINCT class_id) AS class_ids FROM share_class GROUP BY currency")
def universe_counts(spark, d):
    return load(spark, d, "share_class").groupBy("currency").agg(F.count(F.lit(1)).alias("classes"), F.count_if("is_monthly_payer").alias("monthly"), F.count_if("is_etf").alias("etfs"), F.count_distinct("class_id").alias("class_ids"))


@query(f"SELECT fund_family, status, count(*) AS funds FROM {_FUNDS} GROUP BY ALL")
def status_by_family(spark, d):
    return _funds(spark, d).groupBy("fund_family", "status").agg(F.count(F.lit(1)).alias("funds"))


@query("SELECT * EXCLUDE (rn) FROM (SELECT event_id, user_id, CAST(ts AS DATE) AS day, event_type, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id) AS rn FROM events) WHERE rn = 1")
def latest_run_per_window(spark, d):
    runs = load(spark, d, "events").withColumn("day", F.to_date("ts"))
    return latest(runs, ["user_id", "day"], [F.col("ts").desc(), F.col("event_id")]).select("event_id", "user_id", "day", "event_type")


@query("""WITH l AS (SELECT event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id) AS rn FROM events) WHERE rn = 1)
SELECT event_type AS status, count(*) AS checks, round(count(*) * 100.0 / (SELECT count(*) FROM l), 2)::DOUBLE AS rate_pct FROM l GROUP BY event_type""")
def status_rates(spark, d):
    counts = latest_run_per_window(spark, d).groupBy(F.col("event_type").alias("status")).agg(F.count(F.lit(1)).alias("checks"))
    total = F.sum("checks").over(Window.partitionBy())
    # as many rows as there are kinds, so the window over all of them is small
    return counts.withColumn("rate_pct", F.round(F.try_divide(F.col("checks") * 100.0, total), 2))


@query(f"""SELECT coalesce(f.country, '?') AS country, count(*) FILTER (upper(trim(s.last_status)) = 'DECLARED') AS declared, count(*) FILTER (upper(trim(s.last_status)) = 'NOT_DECLARED') AS not_declared,
  count(*) FILTER (upper(trim(s.last_status)) = 'UNKNOWN') AS unknown FROM fund_detection_state s LEFT JOIN {_FUNDS} f ON f.fund_id = s.fund_id GROUP BY 1""")
def status_pivot_by_country(spark, d):
    state = load(spark, d, "fund_detection_state").select("fund_id", F.upper(F.trim("last_status")).alias("st"))
    joined = lookup(state, _funds(spark, d), ["fund_id"], {"country": F.lit("?")})
    wide = joined.groupBy("country").pivot("st", ["DECLARED", "NOT_DECLARED", "UNKNOWN"]).agg(F.count(F.lit(1)))
    return wide.select("country", *(F.coalesce(F.col(c), F.lit(0)).alias(c.lower()) for c in ("DECLARED", "NOT_DECLARED", "UNKNOWN")))


@query("""SELECT count(*) AS executions, count(DISTINCT (user_id, CAST(ts AS DATE))) AS windows, round(sum(value) / count(*), 2) AS avg_value, round(sum(value) / count(*) / 3600 * 0.1, 6) AS avg_cost FROM events""")
def cost_per_check(spark, d):
    e = load(spark, d, "events")
    return e.agg(F.count(F.lit(1)).alias("executions"), F.count_distinct("user_id", F.to_date("ts")).alias("windows"), F.round(F.try_divide(F.sum("value"), F.count(F.lit(1))), 2).alias("avg_value"), F.round(F.try_divide(F.sum("value"), F.count(F.lit(1))) / 3600 * 0.1, 6).alias("avg_cost"))


@query(f"""SELECT coalesce(f.fund_family, CASE WHEN grouping(f.fund_family) = 1 THEN 'TOTAL' ELSE '?' END) AS family, count(*) AS n_events, round(sum(e.gross_amount)::DOUBLE, 4) AS gross, grouping(f.fund_family) AS is_total
FROM distribution_event e LEFT JOIN {_FUNDS} f ON f.fund_id = e.fund_id GROUP BY ROLLUP (f.fund_family)""")
def family_rollup_totals(spark, d):
    joined = load(spark, d, "distribution_event").select("fund_id", "gross_amount").join(_funds(spark, d).select("fund_id", "fund_family"), "fund_id", "left")
    rolled = joined.rollup("fund_family").agg(F.count(F.lit(1)).alias("n_events"), F.round(F.sum("gross_amount").cast("double"), 4).alias("gross"), F.grouping("fund_family").cast("long").alias("is_total"))
    return rolled.select(F.coalesce("fund_family", F.when(F.col("is_total") == 1, "TOTAL").otherwise("?")).alias("family"), "n_events", "gross", "is_total")


@query("SELECT extraction_route, source_tier, count(*) AS n_events, round(avg(components_reported::INT) * 100, 2) AS with_components_pct FROM distribution_event WHERE is_superseded IS NOT TRUE GROUP BY ALL")
def event_mix(spark, d):
    current = load(spark, d, "distribution_event").filter(~F.coalesce("is_superseded", F.lit(False)))
    return current.groupBy("extraction_route", "source_tier").agg(F.count(F.lit(1)).alias("n_events"), F.round(F.avg(F.col("components_reported").cast("int")) * 100, 2).alias("with_components_pct"))


@query("SELECT fund_id, count(*) AS n, count(DISTINCT gross_amount) AS amounts, (year(max(ex_date)) * 12 + month(max(ex_date)) - year(min(ex_date)) * 12 - month(min(ex_date)))::INT AS span_months FROM distribution_event GROUP BY fund_id HAVING count(*) >= 6 AND count(DISTINCT gross_amount) <= 3")
def few_distinct_amounts(spark, d):
    span = lambda c: F.year(c) * 12 + F.month(c)
    return (
        load(spark, d, "distribution_event")
        .groupBy("fund_id")
        .agg(F.count(F.lit(1)).alias("n"), F.count_distinct("gross_amount").alias("amounts"), (span(F.max("ex_date")) - span(F.min("ex_date"))).alias("span_months"))
        .filter((F.col("n") >= 6) & (F.col("amounts") <= 3))
    )


@query("SELECT fund_id, string_agg(DISTINCT distribution_type, '; ' ORDER BY distribution_type) AS types, bool_or(components_reported) AS any_components, bool_and(source_tier = 3) AS only_tier_3, max(source_tier) FILTER (components_reported) AS worst_tier FROM distribution_event GROUP BY fund_id")
def fund_summary(spark, d):
    return load(spark, d, "distribution_event").groupBy("fund_id").agg(F.array_join(F.array_sort(F.collect_set("distribution_type")), "; ").alias("types"), F.bool_or("components_reported").alias("any_components"), F.bool_and(F.col("source_tier") == 3).alias("only_tier_3"), F.max(F.when(F.col("components_reported"), F.col("source_tier"))).alias("worst_tier"))


_PRIORITY = ("error", "signup", "view", "click", "purchase")


@query("SELECT user_id, arg_min(event_type, list_position(['error','signup','view','click','purchase'], event_type)) AS worst FROM events WHERE event_type IN ('error','signup','view','click','purchase') GROUP BY user_id")
def reason_priority(spark, d):
    order = F.array(*(F.lit(p) for p in _PRIORITY))
    ranked = load(spark, d, "events").filter(F.col("event_type").isin(*_PRIORITY)).groupBy("user_id").agg(F.min(F.array_position(order, F.col("event_type"))).alias("r"))
    return ranked.select("user_id", F.element_at(order, F.col("r").cast("int")).alias("worst"))


@query("SELECT fund_id, count(*) AS n_rows FROM fund_master GROUP BY fund_id HAVING count(*) > 1")
def repeated_keys(spark, d):
    return load(spark, d, "fund_master").groupBy("fund_id").agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


# joins


@query(f"""SELECT e.event_id, e.ex_date, e.gross_amount::DOUBLE AS gross_amount, round(coalesce(c.total, 0)::DOUBLE, 6) AS component_total, coalesce(c.n, 0) AS n_components, abs(e.gross_amount::DOUBLE - coalesce(c.total, 0)::DOUBLE) > 0.0005 AS differs
FROM (SELECT DISTINCT event_id, ex_date, gross_amount FROM distribution_event) e JOIN (SELECT event_id, sum(amount) AS total, count(*) AS n FROM (SELECT DISTINCT * FROM distribution_component) GROUP BY 1) c USING (event_id)""")
def component_sums(spark, d):
    sums = load(spark, d, "distribution_component").distinct().groupBy("event_id").agg(F.sum("amount").alias("total"), F.count(F.lit(1)).alias("n_components"))
    events = load(spark, d, "distribution_event").select("event_id", "ex_date", "gross_amount").distinct()
    total, gross = F.col("total").cast("double"), F.col("gross_amount").cast("double")
    return events.join(sums, "event_id").select("event_id", "ex_date", gross.alias("gross_amount"), F.round(total, 6).alias("component_total"), "n_components", (F.abs(gross - total) > 0.0005).alias("differs"))


@query("SELECT (declaration_date > ex_date) IS TRUE AS declared_after, (payable_date < ex_date) IS TRUE AS paid_before_ex, (payable_date < record_date) IS TRUE AS paid_before_record, (record_date < ex_date) IS TRUE AS record_before_ex, count(*) AS n FROM distribution_event GROUP BY ALL")
def date_order(spark, d):
    true = lambda c: F.coalesce(c, F.lit(False))
    c = F.col
    return load(spark, d, "distribution_event").groupBy(true(c("declaration_date") > c("ex_date")).alias("declared_after"), true(c("payable_date") < c("ex_date")).alias("paid_before_ex"), true(c("payable_date") < c("record_date")).alias("paid_before_record"), true(c("record_date") < c("ex_date")).alias("record_before_ex")).agg(F.count(F.lit(1)).alias("n"))


def _gap_sql(body: str) -> str:
    return f"WITH m AS (SELECT DISTINCT e.class_id, date_trunc('month', e.ex_date)::DATE AS mon FROM distribution_event e WHERE e.class_id IN (SELECT class_id FROM share_class WHERE is_monthly_payer)), r AS (SELECT class_id, unnest(generate_series(min(mon), max(mon), INTERVAL 1 MONTH))::DATE AS mon FROM m GROUP BY class_id) {body}"


@query(_gap_sql("SELECT class_id, mon AS month FROM r ANTI JOIN m USING (class_id, mon)"))
def missing_payout_months(spark, d):
    monthly = load(spark, d, "share_class").filter("is_monthly_payer").select("class_id").distinct()
    return missing_months(load(spark, d, "distribution_event").select("class_id", "ex_date").join(monthly, "class_id", "left_semi"), ["class_id"], "ex_date")


_CADENCE = "WITH f AS (SELECT class_id, min(ex_date) AS ex_date FROM distribution_event GROUP BY class_id, date_trunc('month', ex_date)), g AS (SELECT class_id, ex_date - lag(ex_date) OVER (PARTITION BY class_id ORDER BY ex_date) AS gap FROM f)"


@query(_CADENCE + " SELECT class_id, count(*) AS months, median(gap)::DOUBLE AS median_gap, CASE WHEN count(*) >= 4 THEN CASE WHEN median(gap) <= 45 THEN 'MONTHLY' WHEN median(gap) <= 120 THEN 'QUARTERLY' WHEN median(gap) <= 240 THEN 'SEMI_ANNUAL' ELSE 'ANNUAL' END END AS cadence FROM g GROUP BY class_id")
def learned_cadence(spark, d):
    gaps = month_gaps(load(spark, d, "distribution_event"), ["class_id"], "ex_date").groupBy("class_id").agg(F.count(F.lit(1)).alias("months"), F.median("gap").alias("median_gap"))
    return gaps.withColumn("cadence", F.when(F.col("months") >= 4, cadence_of(F.col("median_gap"))))


@query("""WITH v AS (SELECT DISTINCT class_id, ex_date, gross_amount, extraction_route, event_id FROM distribution_event), f AS (SELECT class_id, ex_date, arg_min(gross_amount, event_id) AS first_amount FROM v GROUP BY ALL),
s AS (SELECT v.class_id, v.ex_date, any_value(f.first_amount) AS first_amount, arg_min(v.gross_amount, v.event_id) AS second_amount FROM v JOIN f USING (class_id, ex_date) WHERE abs(v.gross_amount::DOUBLE - f.first_amount::DOUBLE) > 1e-9 GROUP BY ALL)
SELECT class_id, ex_date, first_amount::DOUBLE AS first_amount, second_amount::DOUBLE AS second_amount, abs(first_amount::DOUBLE - second_amount::DOUBLE) > 0.001 AS varies FROM s""")
def second_amounts(spark, d):
    v = load(spark, d, "distribution_event").select("class_id", "ex_date", "event_id", F.col("gross_amount").cast("double").alias("amount")).distinct()
    firsts = first_of(v, ["class_id", "ex_date"], ["event_id"], ["amount"]).withColumnRenamed("amount", "first_amount")
    differing = v.join(firsts, ["class_id", "ex_date"]).filter(F.abs(F.col("amount") - F.col("first_amount")) > 1e-9)
    seconds = first_of(differing, ["class_id", "ex_date", "first_amount"], ["event_id"], ["amount"]).withColumnRenamed("amount", "second_amount")
    return seconds.withColumn("varies", F.abs(F.col("first_amount") - F.col("second_amount")) > 0.001)


@query("SELECT d.doc_id FROM documents d WHERE EXISTS (SELECT 1 FROM distribution_event e WHERE e.fund_id = d.fund_id AND CAST(d.published_at AS DATE) BETWEEN e.declaration_date AND e.ex_date)")
def documents_in_declared_windows(spark, d):
    windows = load(spark, d, "distribution_event").select("fund_id", "declaration_date", "ex_date").distinct()
    docs = load(spark, d, "documents").select("doc_id", "fund_id", F.to_date("published_at").alias("day"))
    return within_intervals(docs, windows, ["fund_id"], "day", "declaration_date", "ex_date", "left_semi").select("doc_id")


@query("SELECT state_id, fund_id, count(*) AS n_events, max(ex_date) AS last_ex FROM (SELECT DISTINCT state_id, fund_id, last_confirmed_event_date AS day FROM fund_detection_state) s JOIN (SELECT DISTINCT event_id, fund_id, ex_date, payable_date FROM distribution_event) e USING (fund_id) WHERE s.day BETWEEN e.ex_date AND e.payable_date GROUP BY ALL")
def states_in_payout_windows(spark, d):
    windows = load(spark, d, "distribution_event").select("event_id", "fund_id", "ex_date", "payable_date").distinct()
    states = load(spark, d, "fund_detection_state").select("state_id", "fund_id", F.col("last_confirmed_event_date").alias("day")).distinct()
    return within_intervals(states, windows, ["fund_id"], "day", "ex_date", "payable_date").groupBy("state_id", "fund_id").agg(F.count(F.lit(1)).alias("n_events"), F.max("ex_date").alias("last_ex"))


@query("""WITH e AS (SELECT DISTINCT event_id, fund_id, created_at FROM distribution_event), m AS (SELECT DISTINCT fund_id, updated_at, status || '|' || fund_name AS known FROM fund_master),
j AS (SELECT e.*, m.known, row_number() OVER (PARTITION BY e.event_id, e.fund_id, e.created_at ORDER BY m.updated_at DESC NULLS LAST, m.known DESC) AS rn FROM e LEFT JOIN m ON m.fund_id = e.fund_id AND m.updated_at <= e.created_at)
SELECT event_id, fund_id, epoch_us(created_at) AS created_us, known FROM j WHERE rn = 1""")
def fund_known_at_event(spark, d):
    e = load(spark, d, "distribution_event").select("event_id", "fund_id", "created_at").distinct()
    m = load(spark, d, "fund_master").select("fund_id", "updated_at", F.concat_ws("|", "status", "fund_name").alias("known"))
    return as_of(e, m, ["fund_id"], "created_at", "updated_at", ["known"], "known").select("event_id", "fund_id", F.unix_micros("created_at").alias("created_us"), "known")


@query("SELECT x.extract_id FROM layer_b_extracted_events x WHERE regexp_extract(x.source_url, '^https?://(?:www\\.)?([^/]+)', 1) IN (SELECT lower(replace(fund_family, ' ', '')) || '.example' FROM fund_master)")
def official_domains(spark, d):
    domains = load(spark, d, "fund_master").select(F.concat(F.lower(F.replace("fund_family", F.lit(" "))), F.lit(".example")).alias("domain")).distinct()
    urls = load(spark, d, "layer_b_extracted_events").select("extract_id", F.explode(host_suffixes(host(F.col("source_url")))).alias("domain"))
    return urls.join(domains, "domain", "left_semi").select("extract_id").distinct()


@query(f"SELECT s.class_id, s.fund_id FROM (SELECT DISTINCT class_id, fund_id FROM share_class WHERE fund_id IS NOT NULL) s ANTI JOIN {_FUNDS} f ON f.fund_id = s.fund_id")
def classes_without_fund(spark, d):
    classes = load(spark, d, "share_class").filter(F.col("fund_id").isNotNull()).select("class_id", "fund_id").distinct()
    return classes.join(_funds(spark, d).select("fund_id"), "fund_id", "left_anti").select("class_id", "fund_id")


_GOLD = f"""WITH e AS (SELECT DISTINCT class_id, ex_date, upper(left(trim(estimated_or_final), 1)) AS mark, gross_amount FROM distribution_event),
k AS (SELECT class_id, ex_date, min(gross_amount) FILTER (mark = 'F') AS truth, min(gross_amount) FILTER (mark = 'E') AS said FROM e GROUP BY ALL)
SELECT left(trim(class_id), 2) AS country, count(*) FILTER (truth IS NOT NULL AND said IS NOT NULL) AS tp, count(*) FILTER (truth IS NULL AND said IS NOT NULL) AS fp, count(*) FILTER (truth IS NOT NULL AND said IS NULL) AS fn,
 count(*) FILTER (abs(truth::DOUBLE - said::DOUBLE) < 1e-6) AS exact FROM k GROUP BY 1"""


@query(f"SELECT *, round(100.0 * tp / nullif(tp + fp, 0), 2)::DOUBLE AS precision_pct, round(100.0 * tp / nullif(tp + fn, 0), 2)::DOUBLE AS recall_pct FROM ({_GOLD})")
def estimate_confusion(spark, d):
    """Estimates against finals: a final is the truth, an estimate of the same class and day what was said before."""
    mark = F.upper(F.substring(F.trim("estimated_or_final"), 1, 1))
    k = load(spark, d, "distribution_event").groupBy("class_id", "ex_date").agg(F.min(F.when(mark == "F", F.col("gross_amount"))).alias("truth"), F.min(F.when(mark == "E", F.col("gross_amount"))).alias("said"))
    t, s = F.col("truth"), F.col("said")
    counts = k.groupBy(F.substring(F.trim("class_id"), 1, 2).alias("country")).agg(F.count_if(t.isNotNull() & s.isNotNull()).alias("tp"), F.count_if(t.isNull() & s.isNotNull()).alias("fp"), F.count_if(t.isNotNull() & s.isNull()).alias("fn"), F.count_if(F.abs(t.cast("double") - s.cast("double")) < 1e-6).alias("exact"))
    return counts.withColumns({"precision_pct": F.round(F.try_divide(100.0 * F.col("tp"), F.col("tp") + F.col("fp")), 2), "recall_pct": F.round(F.try_divide(100.0 * F.col("tp"), F.col("tp") + F.col("fn")), 2)})


# rows in order


@query("SELECT user_id, count(*) FILTER (event_type IN ('signup', 'error') AND (ts > e.last_other OR e.last_other IS NULL)) AS run FROM events JOIN (SELECT user_id, max(ts) FILTER (event_type NOT IN ('signup', 'error')) AS last_other FROM events GROUP BY 1) e USING (user_id) GROUP BY user_id")
def consecutive_unknowns(spark, d):
    return trailing_run(load(spark, d, "events"), ["user_id"], "ts", F.col("event_type").isin("signup", "error"))


@query(f"SELECT event_id, class_id, epoch_us(updated_at) AS updated_us, max(ex_date) OVER (PARTITION BY class_id ORDER BY updated_at, event_id ROWS UNBOUNDED PRECEDING) AS confirmed_to FROM (SELECT DISTINCT event_id, class_id, updated_at, ex_date FROM distribution_event)")
def confirmed_to(spark, d):
    e = load(spark, d, "distribution_event").select("event_id", "class_id", "updated_at", "ex_date").distinct()
    return running_max(e, ["class_id"], ["updated_at", "event_id"], "ex_date", F.trunc(F.to_date("updated_at"), "month"), "confirmed_to").select("event_id", "class_id", F.unix_micros("updated_at").alias("updated_us"), "confirmed_to")


@query("""SELECT doc_id, fund_id, sha, previous, sha <> previous AS changed FROM (SELECT doc_id, fund_id, sha256(text) AS sha, last_value(sha256(text) IGNORE NULLS) OVER (PARTITION BY fund_id ORDER BY published_at NULLS FIRST, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous FROM documents WHERE fund_id IS NOT NULL)""")
def content_changes(spark, d):
    docs = load(spark, d, "documents").filter(F.col("fund_id").isNotNull()).select("doc_id", "fund_id", "published_at", F.sha2("text", 256).alias("sha"))
    return previous_value(docs, ["fund_id"], ["published_at", "doc_id"], "sha", F.trunc(F.to_date("published_at"), "month")).drop("published_at")


@query("SELECT sha256(text) AS sha256, count(*) AS copies, min(doc_id) AS doc_id FROM documents WHERE text IS NOT NULL GROUP BY 1")
def content_dedup(spark, d):
    return by_content(load(spark, d, "documents").select("doc_id", "text"), "text", ["doc_id"], ["doc_id"])


@query(f"""SELECT event_id, class_id, ex_date, version_no, next_id, next_id IS NOT NULL AS superseded FROM (SELECT *, row_number() OVER w AS version_no, lead(event_id) OVER w AS next_id FROM (SELECT DISTINCT event_id, class_id, ex_date, distribution_category, updated_at FROM distribution_event)
WINDOW w AS (PARTITION BY class_id, ex_date, distribution_category ORDER BY updated_at, event_id))""")
def superseded_chain(spark, d):
    e = load(spark, d, "distribution_event").select("event_id", "class_id", "ex_date", "distribution_category", "updated_at").distinct()
    return with_versions(e, ["class_id", "ex_date", "distribution_category"], [F.col("updated_at"), F.col("event_id")], "event_id").select("event_id", "class_id", "ex_date", "version_no", "next_id", "superseded")


@query("SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id ORDER BY s RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW) AS recent FROM (SELECT *, epoch(ts)::BIGINT AS s FROM events)")
def requests_last_day(spark, d):
    e = load(spark, d, "events").withColumn("s", F.unix_timestamp(F.col("ts").cast("timestamp")))
    return recent_within(e, ["user_id"], "s", 86400).select("event_id", "user_id", "recent")


@query("SELECT DISTINCT event_id, fund_id, ex_date FROM distribution_event ORDER BY ex_date DESC, fund_id, event_id LIMIT 15")
def top15_latest(spark, d):
    return load(spark, d, "distribution_event").select("event_id", "fund_id", "ex_date").distinct().orderBy(F.desc("ex_date"), "fund_id", "event_id").limit(15)


@query("SELECT fund_id, ex_date, event_id, row_number() OVER (PARTITION BY fund_id ORDER BY ex_date DESC, event_id) AS line FROM (SELECT DISTINCT fund_id, ex_date, event_id FROM distribution_event)")
def event_listing(spark, d):
    e = load(spark, d, "distribution_event").select("fund_id", "ex_date", "event_id").distinct()
    return numbered(e, ["fund_id"], [F.desc("ex_date"), F.col("event_id")], -F.unix_date(F.trunc("ex_date", "month")), "line")


@query("SELECT class_id, window_start, window_end FROM (SELECT class_id, greatest(m, lo) AS window_start, least(last_day(m), hi) AS window_end FROM (SELECT class_id, lo, hi, unnest(generate_series(date_trunc('month', lo), hi, INTERVAL 1 MONTH))::DATE AS m FROM (SELECT class_id, min(ex_date) AS lo, max(ex_date) AS hi FROM distribution_event GROUP BY 1)))")
def month_window_plan(spark, d):
    spans = load(spark, d, "distribution_event").groupBy("class_id").agg(F.min("ex_date").alias("lo"), F.max("ex_date").alias("hi"))
    return month_windows(spans, "lo", "hi").select("class_id", "window_start", "window_end")


# merges


@query()
def versioned_merge(spark, d):
    """Rows of each class, day and category in the order they were loaded; the route stands for the source."""
    rows = load(spark, d, "distribution_event").distinct()
    keys = {"k_class": F.upper(F.trim("class_id")), "k_category": F.upper(F.trim("distribution_category"))}
    return merge_versions(rows.withColumns(keys), ["k_class", "ex_date", "k_category"], ["created_at", "updated_at"], "event_id", "gross_amount", "extraction_route")


@query(f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY fund_id, updated_at < TIMESTAMPTZ '2026-01-01 00:00:00+00' ORDER BY updated_at DESC, created_at DESC, fund_name, status, deleted_at DESC NULLS LAST) AS rn FROM fund_master),
o AS (SELECT * FROM r WHERE rn = 1 AND updated_at < TIMESTAMPTZ '2026-01-01 00:00:00+00'), n AS (SELECT * FROM r WHERE rn = 1 AND updated_at >= TIMESTAMPTZ '2026-01-01 00:00:00+00')
SELECT coalesce(n.fund_id, o.fund_id) AS fund_id, coalesce(n.fund_name, o.fund_name) AS fund_name, coalesce(n.inception_date, o.inception_date) AS inception_date, epoch_us(greatest(n.updated_at, o.updated_at)) AS updated_us FROM o FULL JOIN n ON o.fund_id = n.fund_id""")
def dimension_overwrite(spark, d):
    cut = F.lit("2026-01-01 00:00:00").cast("timestamp")
    rows = load(spark, d, "fund_master")
    order = [F.col("updated_at").desc(), F.col("created_at").desc(), F.col("fund_name"), F.col("status"), F.col("deleted_at").desc_nulls_last()]
    old, new = (latest(rows.filter(c), ["fund_id"], order).select("fund_id", "fund_name", "inception_date", "updated_at") for c in (F.col("updated_at") < cut, F.col("updated_at") >= cut))
    return overwrite_by_key(old, new, ["fund_id"], keep_old=("inception_date",), keep_largest=("updated_at",)).select("fund_id", "fund_name", "inception_date", F.unix_micros("updated_at").alias("updated_us"))


@query("SELECT count(*) AS n FROM (SELECT DISTINCT fund_id, country, symbol FROM layer_b_extracted_events WHERE batch_no >= 10) b WHERE NOT EXISTS (SELECT 1 FROM layer_b_extracted_events a WHERE a.batch_no < 10 AND a.fund_id IS NOT DISTINCT FROM b.fund_id AND a.country = b.country AND a.symbol = b.symbol)")
def new_symbols(spark, d):
    x = load(spark, d, "layer_b_extracted_events").select("batch_no", "fund_id", "country", "symbol")
    fresh, stored = (x.filter(c).drop("batch_no").distinct() for c in (F.col("batch_no") >= 10, F.col("batch_no") < 10))
    return not_yet_stored(fresh, stored, ["fund_id", "country", "symbol"]).agg(F.count(F.lit(1)).alias("n"))


_SNAP = "(SELECT fund_id AS k, min(gross_amount) AS low, count(*) AS n FROM layer_b_extracted_events WHERE batch_no {} AND fund_id IS NOT NULL GROUP BY 1)"


@query(f"SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NULL THEN 'ADDED' WHEN b.k IS NULL THEN 'REMOVED' ELSE 'CHANGED' END AS change FROM {_SNAP.format('< 10')} a FULL JOIN {_SNAP.format('>= 10')} b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL OR a.low IS DISTINCT FROM b.low OR a.n <> b.n")
def snapshot_changes(spark, d):
    x = load(spark, d, "layer_b_extracted_events").filter(F.col("fund_id").isNotNull())
    a, b = (x.filter(c).groupBy(F.col("fund_id").alias("k")).agg(F.min("gross_amount").alias("low"), F.count(F.lit(1)).alias("n")) for c in (F.col("batch_no") < 10, F.col("batch_no") >= 10))
    return snapshot_diff(a, b, ["k"], ["low", "n"])


# scalar functions


@query("""SELECT DISTINCT ex_date, date_diff('day', ex_date, last_day(ex_date)) < 3 AS month_end, (month(ex_date) * 100 + day(ex_date) >= 1201 OR month(ex_date) * 100 + day(ex_date) <= 115) AS year_end, (ex_date - INTERVAL 24 MONTH)::DATE AS two_years_before,
 quarter(ex_date) AS quarter, isodow(ex_date) >= 6 AS weekend, day(last_day(make_date(year(ex_date), 2, 1))) = 29 AS leap, date_trunc('month', ex_date)::DATE AS month_start FROM distribution_event""")
def date_functions(spark, d):
    e = load(spark, d, "distribution_event").select("ex_date").distinct()
    x = F.col("ex_date")
    return e.select(x, month_end_within(x, 3).alias("month_end"), in_season(x, (12, 1), (1, 15)).alias("year_end"), trailing_months(x, 24).alias("two_years_before"), F.quarter(x).cast("long").alias("quarter"), (F.weekday(x) >= 5).alias("weekend"), leap_year(F.year(x)).alias("leap"), F.trunc(x, "month").alias("month_start"))


@query("SELECT DISTINCT expected_frequency, CASE upper(expected_frequency) WHEN 'DAILY' THEN 30 WHEN 'MONTHLY' THEN 30 WHEN 'QUARTERLY' THEN 91 WHEN 'SEMI_ANNUAL' THEN 182 WHEN 'ANNUAL' THEN 365 ELSE 91 END AS days FROM share_class")
def cadence_days_of(spark, d):
    return load(spark, d, "share_class").select("expected_frequency").distinct().withColumn("days", cadence_days(F.col("expected_frequency")))


@query("""SELECT DISTINCT distribution_type, CASE WHEN lower(distribution_type) LIKE '%return of capital%' OR regexp_matches(lower(distribution_type), '\\broc\\b') THEN 'RETURN_OF_CAPITAL'
 WHEN (lower(distribution_type) LIKE '%capital gain%' OR lower(distribution_type) LIKE '%cap gain%') THEN CASE WHEN lower(distribution_type) LIKE '%long%' THEN 'LONG_TERM_CAPITAL_GAIN' WHEN lower(distribution_type) LIKE '%short%' THEN 'SHORT_TERM_CAPITAL_GAIN' WHEN lower(distribution_type) LIKE '%income%' OR lower(distribution_type) LIKE '%dividend%' THEN 'COMBINED' ELSE 'CAPITAL_GAIN' END
 WHEN lower(distribution_type) LIKE '%special%' OR lower(distribution_type) LIKE '%extra%' THEN 'SPECIAL' WHEN regexp_matches(lower(distribution_type), 'interest|income|dividend|distribution') OR distribution_type = '' OR distribution_type IS NULL THEN 'INCOME' ELSE 'OTHER' END AS category FROM distribution_event""")
def payout_categories(spark, d):
    return load(spark, d, "distribution_event").select("distribution_type").distinct().withColumn("category", payout_category(F.col("distribution_type")))


@query("""SELECT DISTINCT source_url, regexp_replace(lower(regexp_extract(source_url, '^[a-z]+://([^/]+)', 1)), '^www\\.', '') AS host, left(source_url, 24) AS snippet, sha256(source_url) AS digest FROM layer_b_extracted_events""")
def url_functions(spark, d):
    u = F.col("source_url")
    return load(spark, d, "layer_b_extracted_events").select("source_url").distinct().select(u, host(u).alias("host"), truncated(u, 24).alias("snippet"), F.sha2(u, 256).alias("digest"))


@query("SELECT DISTINCT cik, lpad(cik, 12, '0') AS padded, coalesce(nullif(ltrim(lpad(cik, 12, '0'), '0'), ''), '0') AS bare, 'https://filings.example/' || coalesce(nullif(ltrim(cik, '0'), ''), '0') || '/index' AS url FROM fund_master WHERE cik IS NOT NULL")
def filer_ids(spark, d):
    c = F.col("cik")
    return load(spark, d, "fund_master").filter(c.isNotNull()).select("cik").distinct().select(c, padded_id(c, 12).alias("padded"), bare_id(padded_id(c, 12)).alias("bare"), F.format_string("https://filings.example/%s/index", bare_id(c)).alias("url"))


@query("SELECT DISTINCT source AS key, trim(lower(replace(replace(regexp_replace(source, '([a-z])([A-Z])', '\\1 \\2', 'g'), '_', ' '), '-', ' '))) AS words FROM documents WHERE source IS NOT NULL")
def key_words(spark, d):
    keys = load(spark, d, "documents").filter(F.col("source").isNotNull()).select(F.col("source").alias("key")).distinct()
    return keys.select("key", spaced_key(F.col("key")).alias("words"))


@query("""SELECT header, CASE WHEN regexp_matches(header, 'decl|announced') THEN 'declaration' WHEN regexp_matches(header, 'ex-div|ex div|ex-date|ex date|exdate') THEN 'ex' WHEN contains(header, 'record') THEN 'record' WHEN regexp_matches(header, 'payable|pay date|payment|paid') THEN 'payable' END AS kind
 FROM (SELECT DISTINCT lower(trim(h)) AS header FROM (SELECT unnest(string_split(l, '|')) AS h FROM (SELECT unnest(regexp_split_to_array(text, '\r?\n')) AS l FROM documents) WHERE contains(l, '|')))""")
def header_date_kinds(spark, d):
    """What each cell of the lines with bars in the texts would announce as a header."""
    lines = load(spark, d, "documents").select(F.explode(F.split("text", r"\r?\n")).alias("l")).filter(F.contains("l", F.lit("|")))
    h = lines.select(F.explode(F.split("l", r"\|")).alias("h"))
    return h.select(F.lower(F.trim("h")).alias("header")).distinct().withColumn("kind", date_kind(F.col("header")))


# the star schema


@query("""SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, round(avg(l_discount), 6) AS avg_disc, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL""")
def pricing_summary(spark, d):
    li = load(spark, d, "lineitem").filter(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz"))
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count(F.lit(1)).alias("n"))


@query("""SELECT r_name, n_name, count(DISTINCT o_orderkey) AS orders, round(sum(l_extendedprice), 2) AS price FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""")
def revenue_by_nation(spark, d):
    o = load(spark, d, "orders").select("o_orderkey", "o_custkey")
    c = load(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    n = load(spark, d, "nation").join(load(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name")
    li = load(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_extendedprice")
    return li.join(o, "o_orderkey").join(c, "o_custkey").join(n, "c_nationkey").groupBy("r_name", "n_name").agg(F.count_distinct("o_orderkey").alias("orders"), F.round(F.sum("l_extendedprice"), 2).alias("price"))


# checks, lists, filters


_SCORE = """SELECT rule, count(*) AS checked, count(*) FILTER (failed) AS failures, round(100.0 * count(*) FILTER (NOT failed) / count(*), 2)::DOUBLE AS pass_pct FROM (
SELECT 'dates_in_order' AS rule, coalesce(declaration_date > ex_date, FALSE) OR coalesce(payable_date < record_date, FALSE) AS failed FROM distribution_event
UNION ALL SELECT 'amount_positive', gross_amount <= 0 FROM distribution_event
UNION ALL SELECT 'superseded_has_successor', superseded_by IS NULL FROM distribution_event WHERE is_superseded
UNION ALL SELECT 'currency_of_country', upper(trim(currency)) <> CASE WHEN trim(fund_id) ILIKE 'CA%' THEN 'CAD' ELSE 'USD' END FROM distribution_event WHERE currency IS NOT NULL) GROUP BY rule"""


@query(_SCORE)
def check_scorecard(spark, d):
    """Row checks in one scan: each row becomes one line per check that applies to it."""
    c = F.col
    true = lambda x: F.coalesce(x, F.lit(False))
    expected = F.when(F.upper(F.trim("fund_id")).startswith("CA"), "CAD").otherwise("USD")
    checks = {
        "dates_in_order": (F.lit(True), true(c("declaration_date") > c("ex_date")) | true(c("payable_date") < c("record_date"))),
        "amount_positive": (F.lit(True), c("gross_amount") <= 0),
        "superseded_has_successor": (true(c("is_superseded")), c("superseded_by").isNull()),
        "currency_of_country": (c("currency").isNotNull(), F.upper(F.trim("currency")) != expected),
    }
    lines = F.array_compact(F.array(*(F.when(applies, F.struct(F.lit(name).alias("rule"), failed.alias("failed"))) for name, (applies, failed) in checks.items())))
    long = load(spark, d, "distribution_event").select(F.explode(lines).alias("x")).select("x.rule", "x.failed")
    tally = long.groupBy("rule").agg(F.count(F.lit(1)).alias("checked"), F.count_if("failed").alias("failures"))
    return tally.withColumn("pass_pct", F.round(F.try_divide(100.0 * (c("checked") - c("failures")), c("checked")), 2))


@query("SELECT fund_id, event_id, ex_date, line FROM (SELECT *, row_number() OVER (PARTITION BY fund_id ORDER BY ex_date DESC, event_id) AS line FROM (SELECT DISTINCT fund_id, event_id, ex_date FROM distribution_event)) WHERE line <= 3")
def last_three_events(spark, d):
    e = load(spark, d, "distribution_event").select("fund_id", "event_id", "ex_date").distinct()
    w = Window.partitionBy("fund_id").orderBy(F.desc("ex_date"), "event_id")
    return e.withColumn("line", F.row_number().over(w)).filter("line <= 3")


@query("""SELECT extract_id, source_url, ex_date FROM (SELECT *, row_number() OVER (PARTITION BY source_url, ex_date, distribution_type, round(gross_amount, 6) ORDER BY extract_id) AS rn FROM layer_b_extracted_events) WHERE rn = 1""")
def ordered_distinct(spark, d):
    x = load(spark, d, "layer_b_extracted_events").withColumn("__amount", F.round("gross_amount", 6))
    return latest(x, ["source_url", "ex_date", "distribution_type", "__amount"], [F.col("extract_id")]).select("extract_id", "source_url", "ex_date")


@query("""SELECT extract_id, len(list_filter(components, lambda x: x.amount > 0.1)) AS above, list_aggregate(list_transform(list_filter(components, lambda x: x.amount IS NOT NULL), lambda x: x.amount), 'sum') AS total,
 array_to_string(list_sort(list_distinct(list_filter(list_transform(components, lambda x: x.type), lambda x: x IS NOT NULL))), ',') AS types, list_has_any(list_transform(components, lambda x: coalesce(x.type, '')), ['RETURN_OF_CAPITAL', 'FOREIGN_INCOME']) AS overlaps
 FROM layer_b_extracted_events WHERE components IS NOT NULL AND len(components) > 0 AND len(list_filter(components, lambda x: x.amount IS NOT NULL)) > 0""")
def component_lists(spark, d):
    x = load(spark, d, "layer_b_extracted_events").select("extract_id", "components").filter(F.exists("components", lambda c: c["amount"].isNotNull()))
    types = F.transform("components", lambda c: c["type"])
    amounts = F.transform(F.filter("components", lambda c: c["amount"].isNotNull()), lambda c: c["amount"])
    return x.select(
        "extract_id",
        F.size(F.filter("components", lambda c: c["amount"] > 0.1)).cast("long").alias("above"),
        F.aggregate(amounts, F.lit(0.0), lambda a, b: a + b).alias("total"),
        F.array_join(F.array_sort(F.array_distinct(F.array_compact(types))), ",").alias("types"),
        F.coalesce(F.arrays_overlap(F.array_compact(types), F.array(F.lit("RETURN_OF_CAPITAL"), F.lit("FOREIGN_INCOME"))), F.lit(False)).alias("overlaps"),
    )


@query("SELECT event_id, try_cast(props AS JSON) IS NOT NULL AS valid, (props->>'$.k')::BIGINT AS k FROM events")
def json_fields(spark, d):
    parsed = F.from_json("props", "k long")
    return load(spark, d, "events").select("event_id", F.try_parse_json("props").isNotNull().alias("valid"), parsed["k"].alias("k"))


@query("SELECT DISTINCT x.event_id FROM distribution_event x JOIN distribution_event e ON x.class_id = e.class_id AND x.ex_date = e.ex_date AND abs(x.gross_amount::DOUBLE - e.gross_amount::DOUBLE) < 1e-6 WHERE upper(left(trim(x.estimated_or_final), 1)) = 'E' AND upper(left(trim(e.estimated_or_final), 1)) = 'F'")
def estimates_confirmed(spark, d):
    """Equality on class and day brings together, a tolerance on the amount decides."""
    rows = load(spark, d, "distribution_event").select("event_id", "class_id", "ex_date", F.col("gross_amount").cast("double").alias("amount"), F.upper(F.substring(F.trim("estimated_or_final"), 1, 1)).alias("mark"))
    x = rows.filter("mark = 'E'").select("event_id", "class_id", "ex_date", F.col("amount").alias("said"))
    e = rows.filter("mark = 'F'").select("class_id", "ex_date", "amount").distinct()
    on = (x.class_id == e.class_id) & (x.ex_date == e.ex_date) & (F.abs(x.said - e.amount) < 1e-6)
    return x.join(e, on, "left_semi").select("event_id").distinct()


@query("SELECT DISTINCT event_id, (declaration_date BETWEEN DATE '2026-08-01' AND DATE '2026-09-30') IS TRUE OR ex_date BETWEEN DATE '2026-08-01' AND DATE '2026-09-30' AS in_window, abs(date_diff('day', DATE '2026-08-01', ex_date)) <= 60 AS near FROM distribution_event")
def window_filters(spark, d):
    lo, hi = (F.lit(x).cast("date") for x in ("2026-08-01", "2026-09-30"))
    c = F.col
    inside = F.coalesce(c("declaration_date").between(lo, hi), F.lit(False)) | c("ex_date").between(lo, hi)
    return load(spark, d, "distribution_event").select("event_id", inside.alias("in_window"), (F.abs(F.datediff("ex_date", lo)) <= 60).alias("near")).distinct()


@query("""SELECT c.event_id, min(c.component_id) AS first_component, arg_min(c.component_type, c.component_id) AS first_type, count(*) AS n FROM (SELECT DISTINCT * FROM distribution_component WHERE event_id IS NOT NULL) c SEMI JOIN (SELECT event_id FROM (SELECT event_id, row_number() OVER (PARTITION BY class_id ORDER BY ex_date DESC NULLS LAST, event_id) AS rn FROM (SELECT DISTINCT event_id, class_id, ex_date FROM distribution_event)) WHERE rn <= 3) e ON e.event_id = c.event_id GROUP BY 1""")
def provenance_of_latest(spark, d):
    """Where the amounts of each class's three latest events come from."""
    e = load(spark, d, "distribution_event").select("event_id", "class_id", "ex_date").distinct()
    wanted = latest(e, ["class_id"], [F.col("ex_date").desc_nulls_last(), F.col("event_id")], 3).select("event_id").distinct()
    rows = load(spark, d, "distribution_component").distinct().join(wanted, "event_id", "left_semi")
    head = F.min(F.struct("component_id", "component_type")).alias("h")
    return rows.groupBy("event_id").agg(head, F.count(F.lit(1)).alias("n")).select("event_id", F.col("h.component_id").alias("first_component"), F.col("h.component_type").alias("first_type"), "n")


# columns as predicates


@query("""SELECT DISTINCT event_id, source_tier IN (1, 2) AS trusted, gross_amount > 0 AS positive, coalesce(upper(extraction_route) IN ('API', 'PDF', 'HTML_TABLE'), FALSE) AS known_route, coalesce(contains(upper(extraction_route), 'HTML'), FALSE) AS html, currency IS NOT NULL AS applicable FROM distribution_event""")
def row_predicates(spark, d):
    """Filters by tier, sign, list, substring and applicability, as columns of one pass."""
    route = F.upper("extraction_route")
    no = F.lit(False)
    flags = [F.col("source_tier").isin(1, 2).alias("trusted"), (F.col("gross_amount") > 0).alias("positive"), F.coalesce(route.isin("API", "PDF", "HTML_TABLE"), no).alias("known_route"), F.coalesce(F.contains(route, F.lit("HTML")), no).alias("html"), F.col("currency").isNotNull().alias("applicable")]
    return load(spark, d, "distribution_event").select("event_id", *flags).distinct()


@query("""SELECT run_id, CASE WHEN regexp_matches(payload, '^[ \t\r\n]*[{\\[]') THEN 'JSON' WHEN starts_with(payload, '%PDF') THEN 'PDF' WHEN starts_with(payload, 'PK') THEN 'WORKBOOK' WHEN contains(lower(payload), '<html') THEN 'HTML' ELSE 'OTHER' END AS kind FROM multi_tier_6fund_live_validation WHERE payload IS NOT NULL""")
def payload_kinds(spark, d):
    """What a payload is, by its first characters."""
    p = F.col("payload")
    kind = F.when(p.rlike(r"^[ \t\r\n]*[{\[]"), "JSON").when(p.startswith("%PDF"), "PDF").when(p.startswith("PK"), "WORKBOOK").when(F.contains(F.lower(p), F.lit("<html")), "HTML").otherwise("OTHER")
    return load(spark, d, "multi_tier_6fund_live_validation").filter(p.isNotNull()).select("run_id", kind.alias("kind"))


@query("""SELECT kind, day, count(*) AS n FROM (SELECT 'ex' AS kind, ex_date AS day FROM distribution_event UNION ALL SELECT 'record', record_date FROM distribution_event UNION ALL SELECT 'payable', payable_date FROM distribution_event UNION ALL SELECT 'declaration', declaration_date FROM distribution_event) WHERE day IS NOT NULL GROUP BY ALL""")
def observed_days(spark, d):
    """All kinds of dates in one list, repeats kept, counted."""
    e = load(spark, d, "distribution_event")
    kinds = [e.select(F.lit(k).alias("kind"), F.col(f"{k}_date").alias("day")) for k in ("ex", "record", "payable", "declaration")]
    return reduce(DataFrame.unionByName, kinds).filter(F.col("day").isNotNull()).groupBy("kind", "day").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT year, m AS month, make_date(year, m, 1) AS window_start, last_day(make_date(year, m, 1)) AS window_end FROM (SELECT DISTINCT year(ex_date) AS year FROM distribution_event), (SELECT unnest([3, 6, 9, 11, 12]) AS m)")
def cycle_windows(spark, d):
    years = load(spark, d, "distribution_event").select(F.year("ex_date").alias("year")).distinct()
    months = years.withColumn("month", F.explode(F.array(*(F.lit(m) for m in (3, 6, 9, 11, 12)))))
    first = F.make_date("year", "month", F.lit(1))
    return months.select("year", "month", first.alias("window_start"), F.last_day(first).alias("window_end"))


@query("SELECT day, kind, n, sum(n) OVER (PARTITION BY kind ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)::BIGINT AS week FROM (SELECT CAST(ts AS DATE) AS day, event_type AS kind, count(*) AS n FROM events GROUP BY ALL)")
def moving_week(spark, d):
    daily = load(spark, d, "events").groupBy(F.to_date("ts").alias("day"), F.col("event_type").alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    return daily.withColumn("week", F.sum("n").over(Window.partitionBy("kind").orderBy("day").rowsBetween(-6, 0)))


@query("SELECT class_id, distribution_category FROM distribution_event WHERE extraction_route = 'API' INTERSECT SELECT class_id, distribution_category FROM distribution_event WHERE extraction_route = 'PDF'")
def routes_in_common(spark, d):
    e = load(spark, d, "distribution_event")
    a, b = (e.filter(F.col("extraction_route") == r).select("class_id", "distribution_category") for r in ("API", "PDF"))
    return a.intersect(b)


@query("SELECT class_id FROM distribution_event EXCEPT SELECT class_id FROM share_class")
def classes_never_registered(spark, d):
    return load(spark, d, "distribution_event").select("class_id").subtract(load(spark, d, "share_class").select("class_id"))
