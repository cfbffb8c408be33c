"""Queries on the main flows and on evaluation sets.

A review is a document with a remark on a product at its end, by its id: its mentions are extracted from
its whole text, its status follows from them (each 13th failed), each 5th was processed by another
provider, its date and rating come from its id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import absa, brand, dq, evaluation, flows, sampling
from tidemark.operators import lexicon as lx
from tidemark.plans.queries_text import _MENTIONS, _TAGGED, _tagged
from tidemark.plans.registry import REVIEWS_SQL, Registry, reviews, table
from tidemark.sources import lines
from tidemark.sources.shared import kept

REGISTRY = Registry()
add = REGISTRY.add

SCOPE = {"version": "v2", "provider": "mock"}
REMARKS = ("The battery died after a week!", "Charging is slow and the cable is defective.", "I love the sound quality of it.", "Bluetooth stopped working again.", "Not worth the price.", "The delivery was fast and the battery is great.", "It is overheating, very dangerous.", "A gift.")
_REMARK = "CASE doc_id % 8 " + " ".join(f"WHEN {i} THEN '{r}'" for i, r in enumerate(REMARKS)) + " END"
_MENTIONS = f"said AS (SELECT * REPLACE (text || chr(10) || {_REMARK} AS text) FROM documents), " + _MENTIONS.replace("FROM documents", "FROM said").replace("JOIN documents", "JOIN said")


def _documents(spark: SparkSession, d: str) -> DataFrame:
    remark = F.get(F.array(*map(F.lit, REMARKS)), (F.col("doc_id") % 8).cast("int"))
    return table(spark, d, "documents").withColumn("text", F.concat("text", F.lit("\n"), remark))


def _extracted(spark: SparkSession, d: str) -> DataFrame:
    return absa.extract(_documents(spark, d).select("doc_id", "text"), reliability=False)


def _held(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, mentions), written: for queries that read what was extracted more than once."""
    return kept(_extracted(spark, d).select("doc_id", "mentions"), "mentions")


_FLOW = f"""{_MENTIONS}, st AS (SELECT doc_id, CASE WHEN doc_id % 13 = 0 THEN 'failed' WHEN doc_id IN (SELECT doc_id FROM mentions) THEN 'success' ELSE 'no_mentions' END AS status, CASE WHEN doc_id % 5 = 0 THEN 'other' ELSE 'mock' END AS provider FROM documents),
  ok AS (SELECT * FROM st WHERE provider = 'mock'), ci AS (SELECT m.* FROM mentions m JOIN ok USING (doc_id) WHERE status = 'success' AND sentiment = 'negative'),
  mem AS (SELECT *, code || '-' || doc_id % 3 AS cluster_id FROM ci), cl AS (SELECT cluster_id, code, count(*) AS size, upper(cluster_id) AS label, CASE WHEN cluster_id LIKE '%-2' THEN 'other' ELSE 'mock' END AS provider FROM mem GROUP BY cluster_id, code)"""


def _provider() -> Column:
    return F.when(F.col("doc_id") % 5 == 0, "other").otherwise("mock")


def _statuses(spark: SparkSession, d: str, held: DataFrame | None = None) -> DataFrame:
    status = F.when(F.col("doc_id") % 13 == 0, "failed").when(F.size("mentions") > 0, "success").otherwise("no_mentions")
    return (held or _extracted(spark, d)).select("doc_id", status.alias("status"), F.lit("v2").alias("version"), _provider().alias("provider"))


def _mentions(spark: SparkSession, d: str, held: DataFrame | None = None) -> DataFrame:
    return (held or _extracted(spark, d)).select("doc_id", F.lit("v2").alias("version"), F.inline("mentions"))


def _reviews(spark: SparkSession, d: str) -> DataFrame:
    posted = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 365).cast("int"))
    return table(spark, d, "documents").select("doc_id", "source", "lang", posted.alias("posted_at"), (F.col("doc_id") % 5 + 1).alias("rating"))


def _members(spark: SparkSession, d: str, held: DataFrame | None = None) -> DataFrame:
    held = held or _held(spark, d)
    rows = flows.clustering_input(_reviews(spark, d), _mentions(spark, d, held), _statuses(spark, d, held), SCOPE, id_col="doc_id")
    return rows.select("doc_id", "code", "severity", F.concat_ws("-", "code", F.col("doc_id") % 3).alias("cluster_id"))


def _clusters(spark: SparkSession, d: str, held: DataFrame | None = None) -> DataFrame:
    out = _members(spark, d, held).groupBy("cluster_id", "code").agg(F.count(F.lit(1)).alias("size"))
    return out.select("*", F.upper("cluster_id").alias("label"), F.when(F.col("cluster_id").endswith("-2"), "other").otherwise("mock").alias("provider"))


@add("indexing_input", f"WITH {_FLOW}, a AS (SELECT doc_id, string_agg(code || ':' || sentiment, ',' ORDER BY code) AS aspects, count(*) AS n FROM mentions GROUP BY 1) SELECT doc_id, source, status AS absa_status, coalesce(n, 0)::INT AS n_mentions, coalesce(aspects, '') AS aspects FROM ok JOIN documents USING (doc_id) LEFT JOIN a USING (doc_id) WHERE status <> 'failed'")
def indexing_input(spark: SparkSession, d: str) -> DataFrame:
    held = _held(spark, d)
    out = flows.indexing_input(_reviews(spark, d), _statuses(spark, d, held), _mentions(spark, d, held), SCOPE, id_col="doc_id")
    aspects = F.array_join(F.transform("mentions", lambda m: F.concat_ws(":", m["code"], m["sentiment"])), ",")
    return out.select("doc_id", "source", "absa_status", F.size("mentions").alias("n_mentions"), aspects.alias("aspects"))


@add("indexing_counts", f"WITH {_FLOW} SELECT count(*) FILTER (status <> 'failed') AS eligible, count(*) FILTER (status = 'failed') AS skipped FROM ok")
def indexing_counts(spark: SparkSession, d: str) -> DataFrame:
    return flows.indexing_counts(_statuses(spark, d), SCOPE)


@add("clustering_input", f"WITH {_FLOW} SELECT doc_id, code, severity, quote, source, doc_id % 5 + 1 AS rating FROM ci JOIN documents USING (doc_id)")
def clustering_input(spark: SparkSession, d: str) -> DataFrame:
    held = _held(spark, d)
    rows = flows.clustering_input(_reviews(spark, d), _mentions(spark, d, held), _statuses(spark, d, held), SCOPE, id_col="doc_id")
    return rows.select("doc_id", "code", "severity", "quote", "source", "rating")


@add("mention_events", f"WITH {_FLOW} SELECT doc_id, cluster_id, label, mem.code, severity, CAST(DATE '2024-01-01' + CAST(doc_id % 365 AS INT) AS DATE) AS posted_at, doc_id % 5 + 1 AS rating, quote FROM mem JOIN cl USING (cluster_id) WHERE cl.provider = 'mock'")
def mention_events(spark: SparkSession, d: str) -> DataFrame:
    held = _held(spark, d)
    out = flows.mention_events(_members(spark, d, held), _clusters(spark, d, held), _reviews(spark, d), _mentions(spark, d, held), SCOPE, id_col="doc_id")
    return out.select("doc_id", "cluster_id", "label", "code", "severity", "posted_at", "rating", "quote")


@add("cluster_order", f"WITH {_FLOW} SELECT code, label, size, row_number() OVER (PARTITION BY code ORDER BY size DESC, label) AS position FROM cl")
def cluster_order(spark: SparkSession, d: str) -> DataFrame:
    return flows.ordered_clusters(_clusters(spark, d)).select("code", "label", "size", F.col("position").cast("long").alias("position"))


@add("cluster_run_summary", f"WITH {_FLOW}, gm AS (SELECT code, count(*) AS mentions FROM mentions GROUP BY 1), cc AS (SELECT code, count(*) AS clusters, sum(size)::BIGINT AS clustered FROM cl WHERE size >= 5 GROUP BY 1) SELECT code, mentions, coalesce(clusters, 0) AS clusters, coalesce(clustered, 0) AS clustered, clusters IS NULL AS skipped FROM gm LEFT JOIN cc USING (code)")
def cluster_run_summary(spark: SparkSession, d: str) -> DataFrame:
    held = _held(spark, d)
    return flows.cluster_summary(_mentions(spark, d, held), _clusters(spark, d, held).where("size >= 5"))


@add("skipped_aspects", f"WITH {_FLOW} SELECT DISTINCT code FROM mentions WHERE code NOT IN (SELECT code FROM cl WHERE size >= 5)")
def skipped_aspects(spark: SparkSession, d: str) -> DataFrame:
    held = _held(spark, d)
    return flows.skipped(_mentions(spark, d, held), _clusters(spark, d, held).where("size >= 5"), "code")


@add("ingest_ledger", f"WITH {_TAGGED} SELECT lang AS run_id, min(doc_id) AS started_at, max(doc_id) AS finished_at, count(*) AS rows_in, count(*) FILTER (dq_reason IS NULL) AS rows_loaded, count(dq_reason) AS rows_failed, CASE WHEN count(dq_reason) = count(*) THEN 'failed' ELSE 'success' END AS status FROM t GROUP BY lang")
def ingest_ledger(spark: SparkSession, d: str) -> DataFrame:
    """Each language is a batch; ids stand for times."""
    return flows.closed_run(_tagged(spark, d), F.col("lang"), F.col("doc_id"))


@add("ingest_ledger_opened", f"WITH {_TAGGED}, b AS (SELECT s_nationkey AS k, 'src' || s_nationkey AS run_id, min(s_suppkey) AS started_at FROM supplier GROUP BY ALL) SELECT b.run_id, started_at, coalesce(max(doc_id), started_at) AS finished_at, count(doc_id) AS rows_in, count(*) FILTER (doc_id IS NOT NULL AND dq_reason IS NULL) AS rows_loaded, count(dq_reason) AS rows_failed, CASE WHEN count(doc_id) = 0 THEN 'empty' WHEN count(dq_reason) = count(doc_id) THEN 'failed' ELSE 'success' END AS status FROM b LEFT JOIN t ON t.source = b.run_id GROUP BY b.run_id, started_at")
def ingest_ledger_opened(spark: SparkSession, d: str) -> DataFrame:
    """A batch is opened for each nation that has a supplier; its rows are the documents of the source with its number, if any."""
    runs = table(spark, d, "supplier").groupBy(F.concat(F.lit("src"), F.col("s_nationkey").cast("string")).alias("run_id")).agg(F.min("s_suppkey").alias("started_at"))
    return flows.closed_run(_tagged(spark, d), F.col("source"), F.col("doc_id"), opened=flows.opened_run(runs))


@add("seeded_holdout")
def seeded_holdout(spark: SparkSession, d: str) -> DataFrame:
    """Of each language the twenty documents with the smallest seeded score; there is no such hash in SQL."""
    docs = table(spark, d, "documents").select("doc_id", "source", "lang")
    quotas = docs.select("lang").distinct().withColumn("quota", F.lit(20))
    scored = docs.withColumn("score", lines.seeded_score(42, F.col("source"), F.col("doc_id")))
    return sampling.stratified(scored, quotas, ["lang"], F.col("score"), ["doc_id"]).select("doc_id", "lang", F.hex("score").alias("score"))


@add("delete_in_scope", f"WITH {_FLOW} SELECT doc_id, provider, status FROM st WHERE NOT (provider = 'mock' AND doc_id IN (SELECT doc_id FROM documents WHERE lang = 'en'))")
def delete_in_scope(spark: SparkSession, d: str) -> DataFrame:
    gone = table(spark, d, "documents").where("lang = 'en'").select("doc_id")
    return flows.without_ids(_statuses(spark, d), gone, SCOPE, "doc_id").select("doc_id", "provider", "status")


@add("ingest_first_matching", "SELECT doc_id, source FROM documents WHERE source = 'src1' ORDER BY doc_id LIMIT 50")
def ingest_first_matching(spark: SparkSession, d: str) -> DataFrame:
    return flows.first_matching(table(spark, d, "documents").select("doc_id", "source"), F.col("source") == "src1", "doc_id", 50)


@add("list_aspects", f"WITH {_MENTIONS} SELECT DISTINCT code FROM mentions")
def list_aspects(spark: SparkSession, d: str) -> DataFrame:
    return _mentions(spark, d).select("code").distinct().orderBy("code")


@add("dq_failures_by_check", f"WITH {_TAGGED} SELECT dq_reason AS check_name, count(*) AS n_failed FROM t WHERE dq_reason IS NOT NULL GROUP BY 1")
def dq_failures_by_check(spark: SparkSession, d: str) -> DataFrame:
    return dq.metrics(_tagged(spark, d)).where("n_failed > 0").select("check_name", "n_failed").orderBy(F.col("n_failed").desc(), "check_name")


# what a model said instead of the extracted mentions: an aspect left out, another feeling, a quote that
# isn't verbatim, another severity, an aspect too many
_SAID = f"""{_FLOW}, p AS (SELECT doc_id, code, CASE WHEN doc_id % 4 = 1 AND sentiment = 'negative' THEN 'neutral' ELSE sentiment END AS sentiment, CASE WHEN doc_id % 4 = 1 THEN NULL WHEN doc_id % 7 = 3 AND severity = 'medium' THEN 'low' ELSE severity END AS severity,
    CASE WHEN doc_id % 5 = 2 THEN quote || '?!' ELSE quote END AS quote FROM mentions WHERE NOT (doc_id % 3 = 0 AND code = 'price')
    UNION ALL SELECT doc_id, 'colour', 'neutral', NULL, '' FROM documents WHERE doc_id % 6 = 0),
  er AS (SELECT coalesce(m.doc_id, p.doc_id) AS doc_id, coalesce(m.code, p.code) AS code, CASE WHEN p.doc_id IS NULL THEN 'missed_aspect' WHEN m.doc_id IS NULL THEN 'extra_aspect' WHEN p.quote <> '' AND NOT contains(text, p.quote) THEN 'non_verbatim_evidence'
    WHEN m.sentiment <> p.sentiment THEN 'wrong_sentiment' WHEN m.sentiment = 'negative' AND m.severity IS DISTINCT FROM p.severity THEN 'wrong_severity' END AS error
    FROM mentions m FULL JOIN p ON m.doc_id = p.doc_id AND m.code = p.code JOIN said d ON d.doc_id = coalesce(m.doc_id, p.doc_id)),
  errors AS (SELECT * FROM er WHERE error IS NOT NULL AND doc_id % 9 <> 0 UNION ALL SELECT doc_id, NULL, 'correct' FROM documents WHERE doc_id % 9 <> 0 AND doc_id NOT IN (SELECT doc_id FROM er WHERE error IS NOT NULL))"""


def _said(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("doc_id")

    def other(m: Column) -> Column:
        sentiment = F.when((i % 4 == 1) & (m["sentiment"] == "negative"), "neutral").otherwise(m["sentiment"])
        severity = F.when(i % 4 == 1, None).when((i % 7 == 3) & (m["severity"] == "medium"), "low").otherwise(m["severity"])
        quote = F.when(i % 5 == 2, F.concat(m["quote"], F.lit("?!"))).otherwise(m["quote"])
        return F.struct(m["code"].alias("code"), sentiment.alias("sentiment"), severity.alias("severity"), quote.alias("quote"))

    kept = F.transform(F.filter("mentions", lambda m: ~((i % 3 == 0) & (m["code"] == "price"))), other)
    extra = F.array(F.struct(F.lit("colour").alias("code"), F.lit("neutral").alias("sentiment"), F.lit(None).cast("string").alias("severity"), F.lit("").alias("quote")))
    return _extracted(spark, d).select("doc_id", F.when(i % 6 == 0, F.concat(kept, extra)).otherwise(kept).alias("predicted"))


def _holdout(spark: SparkSession, d: str) -> DataFrame:
    """Reviews with gold aspects; each 9th wasn't reviewed and has none."""
    gold = F.when(F.col("doc_id") % 9 != 0, F.col("mentions")).otherwise(F.array().cast(evaluation.MENTION))
    x = _extracted(spark, d).select("doc_id", gold.alias("gold"), (F.col("doc_id") % 9 != 0).alias("reviewed"))
    return _documents(spark, d).select("doc_id", "text").join(x, "doc_id")


def _errors(spark: SparkSession, d: str) -> DataFrame:
    rows = evaluation.labeled(_holdout(spark, d), "reviewed")
    return evaluation.error_rows(evaluation.with_predictions(rows, _said(spark, d), "doc_id"), "doc_id")


@add("absa_error_rows", f"WITH {_SAID} SELECT doc_id, code, error FROM errors")
def absa_error_rows(spark: SparkSession, d: str) -> DataFrame:
    return _errors(spark, d)


@add("absa_error_counts", f"WITH {_SAID} SELECT e AS error, count(errors.error) AS n FROM (VALUES {', '.join(f'({chr(39)}{e}{chr(39)})' for e in evaluation.ERRORS)}) v(e) LEFT JOIN errors ON error = e GROUP BY e")
def absa_error_counts(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.counted(_errors(spark, d), "error")


# predictions taken for gold: what a validation finds in them; an unlabelled row is one without aspects
_CHECKED = f"""{_SAID}, bad AS (SELECT doc_id, count(*) FILTER (code NOT IN ({', '.join(f"'{c}'" for c in lx.ONTOLOGY_V2)})) AS n_code, count(*) FILTER (sentiment = 'negative' AND severity IS NULL) AS n_missing, count(*) FILTER (sentiment <> 'negative' AND severity IS NOT NULL) AS n_unexpected,
    count(*) FILTER (trim(quote) = '') AS n_empty, count(*) FILTER (trim(quote) <> '' AND NOT contains(text, quote)) AS n_unsaid FROM p JOIN said USING (doc_id) GROUP BY doc_id),
  chk AS (SELECT doc_id, coalesce(n_code + n_missing + n_unexpected + n_empty + n_unsaid, 0) AS n_errors, bad.doc_id IS NOT NULL AS own FROM documents LEFT JOIN bad USING (doc_id))"""


def _checked(spark: SparkSession, d: str) -> DataFrame:
    rows = _documents(spark, d).select("doc_id", "text").join(_said(spark, d).withColumnRenamed("predicted", "gold"), "doc_id")
    return evaluation.label_errors(rows, "doc_id")


@add("label_errors", f"WITH {_CHECKED} SELECT doc_id, CAST(n_errors AS INT) AS n_errors FROM chk")
def label_errors(spark: SparkSession, d: str) -> DataFrame:
    return _checked(spark, d).select("doc_id", F.size("errors").alias("n_errors"))


@add("label_report", f"WITH {_CHECKED} SELECT count(*) AS total_rows, count(*) FILTER (n_errors = 0 AND own) AS labeled_rows, count(*) FILTER (n_errors = 0 AND NOT own) AS unlabeled_rows, count(*) FILTER (n_errors > 0) AS invalid_rows FROM chk")
def label_report(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.label_report(_checked(spark, d))


@add("label_distribution", f"""WITH {_CHECKED}, good AS (SELECT p.* FROM p JOIN said USING (doc_id) WHERE code <> 'colour' AND (sentiment = 'negative') = (severity IS NOT NULL) AND trim(quote) <> '' AND contains(text, quote))
  SELECT 'code' AS field, code AS value, count(*) AS n FROM good GROUP BY 2 UNION ALL SELECT 'sentiment', sentiment, count(*) FROM good GROUP BY 2 UNION ALL SELECT 'severity', severity, count(*) FROM good WHERE severity IS NOT NULL GROUP BY 2""")
def label_distribution(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.label_distribution(_checked(spark, d))


@add("holdout_predictions", f"WITH {_FLOW}, a AS (SELECT doc_id, string_agg(code || ':' || sentiment, ',' ORDER BY code) AS aspects FROM mentions GROUP BY 1) SELECT doc_id, CASE WHEN provider = 'mock' THEN status ELSE 'pending' END AS status, coalesce(aspects, '') AS predicted FROM documents JOIN st USING (doc_id) LEFT JOIN a USING (doc_id) WHERE lang = 'en'")
def holdout_predictions(spark: SparkSession, d: str) -> DataFrame:
    holdout = table(spark, d, "documents").where("lang = 'en'").select("doc_id")
    held = _held(spark, d)
    out = evaluation.predictions_of(holdout, flows.in_scope(_statuses(spark, d, held), SCOPE), _mentions(spark, d, held), "doc_id")
    return out.select("doc_id", "status", F.array_join(F.transform("predicted", lambda m: F.concat_ws(":", m["code"], m["sentiment"])), ",").alias("predicted"))


def templates() -> list[dict]:
    """A golden query for each aspect and feeling; its phrases are the aspect's keywords."""
    return [{"query_id": f"{code}-{s}", "query": f"{s} reviews about {code}", "aspect": code, "sentiment": s, "brand": "src1" if code == "price" else None, "phrases": list(words)} for code, words in lx.ASPECTS.items() for s in ("negative", "positive")]


_GOLD = " UNION ALL ".join(
    f"SELECT '{t['query_id']}' AS query_id, doc_id FROM mentions JOIN documents USING (doc_id) WHERE code = '{t['aspect']}' AND sentiment = '{t['sentiment']}'" + (f" AND source = '{t['brand']}'" if t["brand"] else "") + " AND (" + " OR ".join(f"quote ILIKE '%{p}%'" for p in t["phrases"]) + ")" for t in templates()
)
_GOLDENS = f"""{_MENTIONS}, hits AS (SELECT DISTINCT * FROM ({_GOLD})), few AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY doc_id) AS n FROM hits),
  ids AS (SELECT query_id, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) AS ids, count(*) AS n_gold FROM few WHERE n <= 10 GROUP BY 1), all_q AS (SELECT * FROM (VALUES {', '.join(f"('{t['query_id']}')" for t in templates())}) v(query_id))"""


def _goldens(spark: SparkSession, d: str) -> DataFrame:
    mentions = _mentions(spark, d).join(table(spark, d, "documents").select("doc_id", F.col("source").alias("brand")), "doc_id")
    return evaluation.goldens(templates(), mentions, key="doc_id")


@add("golden_builder", f"WITH {_GOLDENS} SELECT query_id, coalesce(n_gold, 0)::INT AS n_gold, coalesce(ids, '') AS gold_ids FROM all_q LEFT JOIN ids USING (query_id)")
def golden_builder(spark: SparkSession, d: str) -> DataFrame:
    return _goldens(spark, d).select("query_id", F.size("gold_ids").alias("n_gold"), F.array_join("gold_ids", ",").alias("gold_ids"))


# goldens with faults: every document a row, by its id
_ODD = """g AS (SELECT doc_id, CASE WHEN doc_id % 50 = 0 THEN ' ' ELSE 'q' || doc_id // 2 END AS query_id, CASE WHEN doc_id % 7 = 0 THEN '' ELSE lang END AS query, CASE WHEN doc_id % 11 = 0 THEN [doc_id, doc_id] WHEN doc_id % 13 = 0 THEN [] WHEN doc_id % 17 = 0 THEN [-doc_id - 1] ELSE [doc_id + 1] END AS ids,
  CASE WHEN doc_id % 3 = 0 THEN 'price' WHEN doc_id % 3 = 1 THEN source END AS aspect FROM documents)"""


@add("golden_validation", f"""WITH {_ODD}, n AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY doc_id) AS n FROM g)
  SELECT doc_id, concat_ws(',', CASE WHEN trim(query_id) = '' THEN 'query_id' END, CASE WHEN n > 1 AND trim(query_id) <> '' THEN 'duplicate_query_id' END, CASE WHEN query = '' THEN 'query' END, CASE WHEN len(list_filter(ids, lambda i: i <= 0)) > 0 THEN 'gold_not_positive' WHEN len(ids) <> len(list_distinct(ids)) THEN 'gold_duplicates' END,
    CASE WHEN aspect IS NOT NULL AND aspect <> 'price' THEN 'aspect' END) AS errors, CASE WHEN len(ids) = 0 THEN 'gold_empty' ELSE '' END AS warnings FROM n""")
def golden_validation(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("doc_id")
    ids = F.when(i % 11 == 0, F.array(i, i)).when(i % 13 == 0, F.array().cast("array<bigint>")).when(i % 17 == 0, F.array(-i - 1)).otherwise(F.array(i + 1))
    rows = table(spark, d, "documents").select(
        "doc_id", F.when(i % 50 == 0, " ").otherwise(F.concat(F.lit("q"), F.floor(i / 2).cast("string"))).alias("query_id"), F.when(i % 7 == 0, "").otherwise(F.col("lang")).alias("query"), ids.alias("gold_ids"),
        F.when(i % 3 == 0, "price").when(i % 3 == 1, F.col("source")).alias("aspect"), F.lit(None).cast("string").alias("sentiment"), F.lit(None).cast("string").alias("brand"),
    )
    out = evaluation.golden_errors(rows, "doc_id")
    return out.select("doc_id", F.array_join("errors", ",").alias("errors"), F.array_join("warnings", ",").alias("warnings"))


_GATED = f"""{REVIEWS_SQL}, i AS (SELECT p_brand AS brand, count(*) AS items FROM part GROUP BY 1), v AS (SELECT brand, count(*) AS reviews FROM reviews GROUP BY 1),
  c AS (SELECT DISTINCT p_brand AS brand FROM part UNION SELECT 'Brand#none'), gated AS (SELECT c.brand, coalesce(items, 0) AS items, coalesce(reviews, 0) AS reviews FROM c LEFT JOIN i USING (brand) LEFT JOIN v USING (brand)),
  prof AS (SELECT *, items >= 80 AND reviews >= 2300 AS included, CASE WHEN items >= 80 AND reviews >= 2300 THEN 'ok' WHEN items <= 0 THEN 'not found in metadata' WHEN reviews <= 0 THEN 'no matched reviews after metadata join'
    WHEN items < 80 AND reviews < 2300 THEN 'below thresholds: ' || items || ' items < 80 and ' || reviews || ' reviews < 2300' WHEN items < 80 THEN 'too few matched metadata items: ' || items || ' < 80' ELSE 'too few matched reviews: ' || reviews || ' < 2300' END AS reason FROM gated)"""


def _profile(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    part, r = table(spark, d, "part"), reviews(spark, d)
    items = part.groupBy(F.col("p_brand").alias("brand")).agg(F.count(F.lit(1)).alias("items"))
    gate = brand.gate(items, r.groupBy("brand").agg(F.count(F.lit(1)).alias("reviews")), least_items=80, least_reviews=2300)
    candidates = part.select(F.col("p_brand").alias("brand")).union(spark.range(1).select(F.lit("Brand#none")))
    return flows.profile(candidates, part.select(F.col("p_partkey").alias("sku"), F.col("p_brand").alias("brand")), r, gate)


@add("dataset_profile", f"WITH {_GATED} SELECT *, NOT included AND reason <> 'no matched reviews after metadata join' AS warning FROM prof")
def dataset_profile(spark: SparkSession, d: str) -> DataFrame:
    return _profile(spark, d)[0].select("brand", "items", "reviews", "included", "reason", "warning")


@add("dataset_profile_top", f"WITH {_GATED} SELECT sku, count(*) AS review_count FROM reviews JOIN prof USING (brand) WHERE included GROUP BY sku ORDER BY review_count DESC, sku LIMIT 20")
def dataset_profile_top(spark: SparkSession, d: str) -> DataFrame:
    return _profile(spark, d)[1]
