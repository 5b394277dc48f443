"""Queries of the general data-preparation operators (problems 1, 2 and 4) and the SQL they are compared with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from distriq.operators.nested import child_table, element_graph, owned_rows, shred_json, Shredder
from distriq.operators.orphans import orphan_counts, orphan_references
from distriq.operators.packed import payout_months, split_packed
from distriq.sources.tables import load


def p1_found(spark: SparkSession, directory: str) -> DataFrame:
    schedule = load(spark, directory, "universe_100_distribution_schedule")
    return payout_months(schedule, "authenticated_distribution_months", "sr_no")


def p1_values(spark: SparkSession, directory: str) -> DataFrame:
    schedule = load(spark, directory, "universe_100_distribution_schedule").select("sr_no", "authenticated_distribution_months")
    return split_packed(schedule, "authenticated_distribution_months").select("sr_no", "pos", "value")


def _orphans(spark: SparkSession, directory: str) -> DataFrame:
    event, fund = load(spark, directory, "distribution_event"), load(spark, directory, "fund_master")
    component = orphan_references(load(spark, directory, "distribution_component"), "component_id", "event_id", "created_at", event, "event_id", "created_at", "deleted_at", "distribution_component")
    share = orphan_references(load(spark, directory, "share_class"), "class_id", "fund_id", "created_at", fund, "fund_id", "created_at", "deleted_at", "share_class")
    state = orphan_references(load(spark, directory, "fund_detection_state"), "state_id", "fund_id", "updated_at", fund, "fund_id", "created_at", "deleted_at", "fund_detection_state")
    return component.unionByName(share).unionByName(state)


def p2_found(spark: SparkSession, directory: str) -> DataFrame:
    return _orphans(spark, directory)


def p2_counts(spark: SparkSession, directory: str) -> DataFrame:
    return orphan_counts(_orphans(spark, directory))


ATTEMPTS = {"key": "fund_id", "opened": ("source_attempts",), "maps": ("funds",), "own": ("funds", "source_attempts"), "inline": ("retrieval_status",)}


def _components(spark: SparkSession, directory: str) -> DataFrame:
    entries = child_table(load(spark, directory, "layer_b_extracted_events").select("extract_id", "components"), "extract_id", "components")
    return entries.select(
        F.lit("component").alias("kind"),
        F.col("extract_id").cast("string").alias("root_id"),
        F.lit("").alias("parent_id"),
        "pos",
        F.coalesce("type", F.lit("")).alias("code"),
        F.when(F.col("amount").isNull(), "").otherwise(F.format_string("%.6f", "amount")).alias("detail"),
    )


def p4_found(spark: SparkSession, directory: str) -> DataFrame:
    runs = load(spark, directory, "multi_tier_6fund_live_validation")
    attempts = owned_rows(shred_json(runs, "run_id", "payload", **ATTEMPTS), "source_attempts", "funds", "source_id", "retrieval_status")
    return attempts.select(F.lit("source_attempt").alias("kind"), "root_id", "parent_id", "pos", "code", "detail").unionByName(_components(spark, directory)).distinct()


def p4_components(spark: SparkSession, directory: str) -> DataFrame:
    return _components(spark, directory).distinct()


def p4_graph(spark: SparkSession, directory: str) -> DataFrame:
    runs = load(spark, directory, "multi_tier_6fund_live_validation")
    return element_graph(runs, "payload", Shredder(frozenset(ATTEMPTS["opened"]), frozenset(ATTEMPTS["maps"])))


QUERIES = {"p1_found": p1_found, "p1_values": p1_values, "p2_found": p2_found, "p2_counts": p2_counts, "p4_found": p4_found, "p4_components": p4_components, "p4_graph": p4_graph}

_MONTH = "|".join(("janvier|january|janv|jan|february|f[ée]vrier|f[ée]vr|f[ée]v|feb|march|mars|mar|april|avril|apr|avr|may|mai|june|juin|jun|july|juillet|juil|jul|august|ao[ûu]t|aug", "september|septembre|sept|sep|october|octobre|oct|november|novembre|nov|december|d[ée]cembre|d[ée]c|dec"))

# A list in brackets holds months only and loses the brackets; what is in brackets then is a remark and goes; what is left are month words in order.
_P1_SQL = f"""
WITH t AS (SELECT DISTINCT sr_no, lower(authenticated_distribution_months) AS m FROM universe_100_distribution_schedule WHERE authenticated_distribution_months IS NOT NULL),
u AS (SELECT sr_no, regexp_replace(regexp_replace(m, '\\(((?:{_MONTH})\\.?(?:, *(?:{_MONTH})\\.?)*)\\)', ' \\1 ', 'g'), '\\([^)]*\\)', '', 'g') AS m FROM t),
v AS (SELECT sr_no, CASE WHEN regexp_full_match(m, '[\\s0-9,;/|]+') THEN regexp_extract_all(m, '[0-9]+') ELSE regexp_extract_all(m, '\\b({_MONTH})\\b', 1) END AS w FROM u),
x AS (SELECT sr_no, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM v)
SELECT DISTINCT sr_no, pos, CASE WHEN regexp_full_match(word, '[0-9]+') THEN word::INT
  ELSE CASE replace(replace(left(word, 3), 'é', 'e'), 'û', 'u') WHEN 'jan' THEN 1 WHEN 'feb' THEN 2 WHEN 'fev' THEN 2 WHEN 'mar' THEN 3 WHEN 'apr' THEN 4 WHEN 'avr' THEN 4
  WHEN 'may' THEN 5 WHEN 'mai' THEN 5 WHEN 'jun' THEN 6 WHEN 'jui' THEN CASE WHEN starts_with(word, 'juin') THEN 6 ELSE 7 END WHEN 'jul' THEN 7 WHEN 'aug' THEN 8 WHEN 'aou' THEN 8
  WHEN 'sep' THEN 9 WHEN 'oct' THEN 10 WHEN 'nov' THEN 11 ELSE 12 END END AS month_no FROM x
"""


def _p2_part(child: str, child_id: str, key: str, at: str, parent: str, parent_key: str) -> str:
    return f"""
SELECT DISTINCT '{child}' AS child_table, CAST(c.{child_id} AS VARCHAR) AS child_id,
  CASE WHEN p.k IS NULL THEN 'MISSING' WHEN p.gone THEN 'DELETED' ELSE 'LATE' END AS kind, strftime(c.{at} AT TIME ZONE 'UTC', '%Y-%m') AS period
FROM {child} c LEFT JOIN (SELECT upper(regexp_replace({parent_key}, '^\\s+|\\s+$', '', 'g')) AS k, bool_and(deleted_at IS NOT NULL) AS gone, min(created_at) AS since FROM {parent} GROUP BY 1) p ON upper(regexp_replace(c.{key}, '^\\s+|\\s+$', '', 'g')) = p.k
WHERE regexp_full_match(c.{key}, '.*\\S.*', 's') AND (p.k IS NULL OR p.gone OR c.{at} < p.since)"""


_P2_SQL = " UNION ALL ".join((
    _p2_part("distribution_component", "component_id", "event_id", "created_at", "distribution_event", "event_id"),
    _p2_part("share_class", "class_id", "fund_id", "created_at", "fund_master", "fund_id"),
    _p2_part("fund_detection_state", "state_id", "fund_id", "updated_at", "fund_master", "fund_id"),
))

_P4_COMPONENTS_SQL = """
SELECT DISTINCT 'component' AS kind, CAST(extract_id AS VARCHAR) AS root_id, '' AS parent_id, CAST(i AS INT) AS pos, coalesce(c.type, '') AS code, coalesce(printf('%.6f', c.amount), '') AS detail
FROM (SELECT extract_id, unnest(components) AS c, generate_subscripts(components, 1) - 1 AS i FROM layer_b_extracted_events) WHERE c IS NOT NULL
"""

ORACLE_SQL = {"p1_found": _P1_SQL, "p2_found": _P2_SQL, "p2_counts": f"SELECT child_table, period, kind, count(*) AS n_orphans FROM ({_P2_SQL}) GROUP BY ALL", "p4_components": _P4_COMPONENTS_SQL}
