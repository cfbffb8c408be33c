"""Queries of the tools that answer questions from counts and incidents.

Questions are turns of conversations behind a stock question; mentions those of documents with a remark, their brand by id;
incidents weekly anomalies of a product brand, which stands for an aspect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import agent, anomaly, tools
from tidemark.operators import lexicon as lx
from tidemark.plans.queries_flows import _FLOW, _held, _statuses
from tidemark.plans.queries_reviews import _SCORED, _weeks
from tidemark.plans.registry import Registry, table

REGISTRY = Registry()
add = REGISTRY.add

HEADS = ("How many negative reviews about the battery? ", "What is the severity distribution of JBL issues? ", "Sentiment distribution for charging? ", "How many reviews in total? ", "Show the status counts. ", "How many mentions of Anker battery are there? ", "Severity counts of overheating? ")
NAMES = list(lx.BRANDS)
_BRAND = f"list_extract({NAMES}, 1 + doc_id % {len(NAMES)})"
_HEAD = f"list_extract({list(HEADS)}, 1 + turn % {len(HEADS)})"
_any = lambda words: "(" + " OR ".join(f"contains(q, '{w}')" for w in words) + ")"
_ASKED = f"""{_FLOW}, f AS (SELECT doc_id, code AS aspect, sentiment, severity, {_BRAND} AS brand FROM mentions),
  qs AS (SELECT conv_id * 1000 + turn AS question_id, lower({_HEAD} || text) AS q FROM conversations),
  r AS (SELECT question_id, CASE WHEN contains(q, 'severity') THEN 'severity' WHEN contains(q, 'sentiment') THEN 'sentiment' WHEN contains(q, 'status') THEN 'status' ELSE 'aspect' END AS kind,
    CASE {' '.join(f"WHEN contains(q, '{a}') THEN '{c}'" for a, c in lx.ASPECT_ALIASES.items())} END AS aspect, CASE WHEN {_any(lx.NEGATIVE_HINTS)} AND NOT {_any(lx.POSITIVE_HINTS)} THEN 'negative' WHEN {_any(lx.POSITIVE_HINTS)} AND NOT {_any(lx.NEGATIVE_HINTS)} THEN 'positive' END AS sentiment,
    CASE {' '.join(f"WHEN regexp_matches(q, '\\b{b.lower()}\\b') THEN '{b}'" for b in lx.BRANDS)} END AS brand FROM qs),
  w AS (SELECT question_id, kind, CASE WHEN kind NOT IN ('aspect', 'status') THEN aspect END AS aspect, CASE kind WHEN 'severity' THEN 'negative' WHEN 'aspect' THEN sentiment END AS sentiment, CASE WHEN kind <> 'status' THEN brand END AS brand FROM r),
  d AS (SELECT DISTINCT kind, aspect, sentiment, brand FROM w),
  n AS (SELECT d.*, CASE kind WHEN 'severity' THEN f.severity WHEN 'sentiment' THEN f.sentiment ELSE f.aspect END AS label, count(*) AS n FROM d JOIN f ON (d.aspect IS NULL OR d.aspect = f.aspect) AND (d.sentiment IS NULL OR d.sentiment = f.sentiment) AND (d.brand IS NULL OR d.brand = f.brand)
    WHERE kind <> 'status' GROUP BY ALL UNION ALL SELECT d.*, s.status, count(*) FROM d, st s WHERE kind = 'status' GROUP BY ALL),
  neg AS (SELECT brand, label, n, row_number() OVER (PARTITION BY brand ORDER BY n DESC, label) AS i FROM (SELECT DISTINCT d.brand, f.aspect AS label, count(DISTINCT f.doc_id) AS n FROM d JOIN f ON (d.brand IS NULL OR d.brand = f.brand) WHERE kind = 'aspect' AND f.sentiment = 'negative' GROUP BY d.brand, f.aspect) t),
  lists AS (SELECT kind, aspect, sentiment, brand, CAST(sum(n) AS BIGINT) AS total, string_agg(label || '=' || n, ', ' ORDER BY n DESC, label) AS told, first(label ORDER BY n DESC, label) AS top, max(n) AS most FROM n WHERE label IS NOT NULL GROUP BY ALL)"""


def _asked(spark: SparkSession, d: str) -> DataFrame:
    head = F.get(F.array(*map(F.lit, HEADS)), (F.col("turn") % len(HEADS)).cast("int"))
    rows = table(spark, d, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("question_id"), F.concat(head, "text").alias("question"))
    return agent.routed(rows)


@add("analytics_answers", f"""WITH {_ASKED} SELECT question_id, w.kind, coalesce(total, 0) AS total, CASE w.kind WHEN 'severity' THEN 'Severity distribution of negative mentions: ' || coalesce(told, '(none)') || '.' WHEN 'sentiment' THEN 'Sentiment distribution of aspect mentions: ' || coalesce(told, '(none)') || '.'
  WHEN 'status' THEN 'ABSA processing-status distribution: ' || coalesce(told, '(none)') || '.' ELSE CASE WHEN told IS NULL THEN 'No aspect mentions are present in the database yet.' ELSE 'Aspect distribution across ' || total || ' mentions: ' || told || '. Largest aspect: ' || top || ' (' || most || ' mentions).' || coalesce(' Most negative aspect: ' || neg.label || ' (' || neg.n || ' negative mentions).', '') END END AS answer
  FROM w LEFT JOIN lists l ON w.kind = l.kind AND w.aspect IS NOT DISTINCT FROM l.aspect AND w.sentiment IS NOT DISTINCT FROM l.sentiment AND w.brand IS NOT DISTINCT FROM l.brand LEFT JOIN neg ON neg.i = 1 AND w.brand IS NOT DISTINCT FROM neg.brand""")
def analytics_answers(spark: SparkSession, d: str) -> DataFrame:
    brand = F.get(F.array(*map(F.lit, NAMES)), (F.col("doc_id") % len(NAMES)).cast("int"))
    held = _held(spark, d)
    mentions = held.select(brand.alias("brand"), F.inline("mentions")).withColumnRenamed("code", "aspect")
    counts = tools.counts_cube(mentions).unionByName(tools.status_counts(_statuses(spark, d, held)))
    return tools.analytics(_asked(spark, d), counts)


_FOUND = f"""{_SCORED}, inc AS (SELECT brand AS aspect, 'aspect' AS granularity, week_start, volume, severity_score, baseline, z, upper(brand[1]) || lower(brand[2:]) || ' complaints overall spiked to ' || volume || ' mentions during week ' || strftime(week_start, '%Y-%m-%d') || ', above EWMA baseline ' || printf('%.1f', baseline) || ' (z=' || printf('%.1f', z) || ', severity score ' || printf('%.0f', severity_score) || ').' AS summary
  FROM scored WHERE i > 3 AND z >= 2 AND volume >= 3 AND severity_score >= 5)"""


def _incidents(spark: SparkSession, d: str) -> DataFrame:
    out = anomaly.detect(_weeks(spark, d), ["brand"])
    text = anomaly.summary(F.col("brand"), F.lit(""), F.col("week_start"), F.col("volume"), F.col("baseline"), F.col("z"), F.col("severity_score"), F.array().cast("array<string>"))
    return out.select(F.col("brand").alias("aspect"), F.lit("aspect").alias("granularity"), F.lit("").alias("cluster_label"), "week_start", "volume", "baseline", "z", "severity_score", text.alias("summary"))


# each product asks about its brand, each fifth about all
@add("incident_answers", f"""{_FOUND}, e AS (SELECT aspect AS of, * FROM inc UNION ALL SELECT NULL, * FROM inc), k AS (SELECT *, row_number() OVER (PARTITION BY of ORDER BY severity_score DESC, z DESC, week_start DESC, aspect) AS rank FROM e),
  t AS (SELECT of, count(*) AS n, string_agg(rank || '. [' || granularity || '] ' || aspect || ' (aspect-level) — week ' || strftime(week_start, '%Y-%m-%d') || ': observed ' || volume || ' vs baseline ' || CAST(round(baseline, 2) AS VARCHAR) || ' (z=' || CAST(round(z, 2) AS VARCHAR) || ', severity ' || CAST(round(severity_score, 2) AS VARCHAR) || ').' || chr(10) || '   ' || summary, chr(10) ORDER BY rank) AS lines FROM k WHERE rank <= 5 GROUP BY of)
  SELECT p_partkey AS question_id, coalesce(n, 0) AS n_incidents, coalesce('Top ' || n || ' emerging-issue incident(s) by severity score:' || chr(10) || lines, 'No emerging-issue incidents have been detected.') AS answer FROM part LEFT JOIN t ON t.of IS NOT DISTINCT FROM CASE WHEN p_partkey % 5 <> 0 THEN p_brand END""")
def incident_answers(spark: SparkSession, d: str) -> DataFrame:
    asked = table(spark, d, "part").select(F.col("p_partkey").alias("question_id"), F.when(F.col("p_partkey") % 5 != 0, F.col("p_brand")).alias("aspect"))
    return tools.incident_answers(asked, _incidents(spark, d))


@add("incident_aspects", f"{_FOUND} SELECT DISTINCT aspect FROM inc")
def incident_aspects(spark: SparkSession, d: str) -> DataFrame:
    return tools.incident_aspects(_incidents(spark, d))


@add("incident_granularities", f"{_FOUND} SELECT DISTINCT granularity FROM inc")
def incident_granularities(spark: SparkSession, d: str) -> DataFrame:
    return tools.incident_granularities(_incidents(spark, d))
