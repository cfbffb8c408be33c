"""Queries on events, labels and rankings: series, evaluation, fusion, questions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import payload_filter
from tidemark.operators import agent, anomaly, metrics, retrieval, scans
from tidemark.operators import lexicon as lx
from tidemark.operators.rankings import recall
from tidemark.operators.vector_index import VectorIndex
from tidemark.plans.queries_text import _BM25
from tidemark.plans.registry import Registry, table
from tidemark.sources.shared import kept

REGISTRY = Registry()
add = REGISTRY.add

_DAILY = "WITH d AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS volume FROM events GROUP BY ALL), n AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY day) AS i FROM d)"


def _daily(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("volume"))


@add("daily_event_ewma", f"""{_DAILY} SELECT a.event_type, a.day, a.volume, round(sum(b.volume * CASE WHEN b.i = 1 THEN power(0.6, a.i - 2) ELSE 0.4 * power(0.6, a.i - 1 - b.i) END), 6) AS baseline
  FROM n a LEFT JOIN n b ON a.event_type = b.event_type AND b.i < a.i GROUP BY ALL""")
def daily_event_ewma(spark: SparkSession, d: str) -> DataFrame:
    return scans.ewma(_daily(spark, d), "volume", ["event_type"], ["day"], anomaly.SPAN).withColumn("baseline", F.round("baseline", 6))


@add("daily_event_expanding_std", f"{_DAILY} SELECT event_type, day, round(stddev_samp(volume) OVER (PARTITION BY event_type ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 6) AS std FROM n")
def daily_event_expanding_std(spark: SparkSession, d: str) -> DataFrame:
    return _daily(spark, d).select("event_type", "day", F.round(anomaly.rolling_std("volume", ["event_type"], "day", None), 6).alias("std"))


@add("event_value_ewma", """WITH h AS (SELECT event_id, list(value) OVER (ORDER BY ts, event_id ROWS BETWEEN 120 PRECEDING AND 1 PRECEDING) AS h FROM events)
  SELECT event_id, round(list_reduce(h, lambda s, x: 0.6 * s + 0.4 * x), 6) AS baseline FROM h""")
def event_value_ewma(spark: SparkSession, d: str) -> DataFrame:
    """All events as one series. (In SQL of the last 120 values: older ones weigh less than 1e-26.)"""
    return scans.ewma(table(spark, d, "events"), "value", [], ["ts", "event_id"], anomaly.SPAN).select("event_id", F.round("baseline", 6).alias("baseline"))


@add("event_payload_values", "SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS total FROM events GROUP BY event_type")
def event_payload_values(spark: SparkSession, d: str) -> DataFrame:
    k = F.try_element_at(F.from_json("props", "map<string,bigint>"), F.lit("k"))
    return table(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(k).alias("total"))


@add("latency_p95", "SELECT event_type, round(avg(value), 4) AS mean, list_sort(list(value))[CAST(floor((count(*) - 1) * 0.95) AS BIGINT) + 1] AS p95 FROM events GROUP BY event_type")
def latency_p95(spark: SparkSession, d: str) -> DataFrame:
    """Exact nearest-rank percentile by rank, without gathering a group."""
    e = table(spark, d, "events").where("value IS NOT NULL")
    mean = e.groupBy("event_type").agg(F.round(F.avg("value"), 4).alias("mean"))
    return mean.join(metrics.nearest_rank(e, "event_type", "value"), "event_type").select("event_type", "mean", F.col("at_rank").alias("p95"))


# gold: the label; predicted: a rule on the document's length; code: its language
_PAIRS = """WITH p AS (SELECT doc_id, lang AS code, CAST(quality AS VARCHAR) AS gold, CASE WHEN n_chars >= 300 THEN '1' ELSE '0' END AS predicted FROM documents JOIN labels USING (doc_id))"""


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    j = table(spark, d, "documents").select("doc_id", "lang", "n_chars").join(table(spark, d, "labels"), "doc_id")
    return j.select("doc_id", F.col("lang").alias("code"), F.col("quality").cast("string").alias("gold"), F.when(F.col("n_chars") >= 300, "1").otherwise("0").alias("predicted"))


@add("cohens_kappa", f"""{_PAIRS}, n AS (SELECT count(*) AS n, count(*) FILTER (gold = predicted) AS same FROM p), c AS (SELECT sum(a.x * 1.0 * b.x) AS c FROM (SELECT gold AS k, count(*) AS x FROM p GROUP BY 1) a JOIN (SELECT predicted AS k, count(*) AS x FROM p GROUP BY 1) b USING (k))
  SELECT n, round((same / n - c / (n * n)) / (1 - c / (n * n)), 6) AS kappa FROM n, c""")
def cohens_kappa(spark: SparkSession, d: str) -> DataFrame:
    return metrics.kappa(_pairs(spark, d))


@add("confusion", f"{_PAIRS} SELECT code, gold || '->' || predicted AS pair, count(*) AS n FROM p GROUP BY ALL")
def confusion(spark: SparkSession, d: str) -> DataFrame:
    return metrics.confusion(_pairs(spark, d)).select("code", F.explode("confusion").alias("pair", "n"))


_SETS = """WITH g AS (SELECT doc_id, lang AS code FROM documents JOIN labels USING (doc_id) WHERE quality = 0), r AS (SELECT doc_id, lang AS code FROM documents WHERE n_chars < 300),
  o AS (SELECT coalesce(g.doc_id, r.doc_id) AS doc_id, coalesce(g.code, r.code) AS code, CASE WHEN g.doc_id IS NULL THEN 'fp' WHEN r.doc_id IS NULL THEN 'fn' ELSE 'tp' END AS outcome FROM g FULL JOIN r ON g.doc_id = r.doc_id AND g.code = r.code),
  c AS (SELECT l.code, count(*) FILTER (outcome = 'tp') AS tp, count(*) FILTER (outcome = 'fp') AS fp, count(*) FILTER (outcome = 'fn') AS fn FROM (SELECT DISTINCT lang AS code FROM documents UNION SELECT 'xx') l LEFT JOIN o USING (code) GROUP BY l.code),
  f AS (SELECT code, tp, fp, fn, coalesce(tp / nullif(tp + fp, 0), 0) AS p, coalesce(tp / nullif(tp + fn, 0), 0) AS r FROM c), s AS (SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f1 FROM f)"""


def _outcomes(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", F.col("lang").alias("code"), "n_chars")
    gold = docs.join(table(spark, d, "labels").where("quality = 0"), "doc_id", "left_semi").withColumn("label", F.lit("bad"))
    return metrics.matched(gold, docs.where("n_chars < 300").withColumn("label", F.lit("bad")), ["doc_id", "code"])


def _codes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(F.col("lang").alias("code")).union(spark.range(1).select(F.lit("xx"))).distinct()


@add("gold_pred_full_outer", f"{_SETS} SELECT doc_id, code, outcome FROM o")
def gold_pred_full_outer(spark: SparkSession, d: str) -> DataFrame:
    return _outcomes(spark, d).select("doc_id", "code", "outcome")


@add("prf_by_code", f"{_SETS} SELECT code, tp, fp, fn, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f1 FROM s")
def prf_by_code(spark: SparkSession, d: str) -> DataFrame:
    out = metrics.by_code(_outcomes(spark, d), _codes(spark, d))
    return out.select("code", "tp", "fp", "fn", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


@add("prf_macro_micro", f"""{_SETS}, t AS (SELECT sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn, avg(f1) AS macro FROM s) SELECT round(2 * tp / (2 * tp + fp + fn), 6) AS micro_f1, round(macro, 6) AS macro_f1 FROM t""")
def prf_macro_micro(spark: SparkSession, d: str) -> DataFrame:
    s = metrics.by_code(_outcomes(spark, d), _codes(spark, d))
    tp, fp, fn = (F.sum(c) for c in ("tp", "fp", "fn"))
    return s.agg(F.round(metrics.precision_recall(tp, fp, fn)[2], 6).alias("micro_f1"), F.round(F.avg("f1"), 6).alias("macro_f1"))


# queries: vectors whose id is divisible by 100, against all vectors; gold: the same label
_RANKS = """WITH q AS (SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings WHERE vec_id % 100 = 0),
  e AS (SELECT vec_id AS doc_id, CAST(embedding AS DOUBLE[]) AS e, label FROM embeddings),
  sa AS (SELECT query_id, doc_id, round(list_cosine_similarity(v, e), 9) AS score FROM q, e),
  ra AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM sa),
  a AS (SELECT * FROM ra WHERE rank <= 50),
  gold AS (SELECT query_id, doc_id FROM q JOIN e USING (label) WHERE query_id <> doc_id)"""


# a text and a vector for each query: benchmark items and the vectors of the same ids; documents and vectors share ids
_HYBRID = _RANKS.replace("SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings WHERE vec_id % 100 = 0", "SELECT item_id AS query_id, CAST(embedding AS DOUBLE[]) AS v, label FROM benchmark JOIN embeddings ON vec_id = item_id") + f""",
  b AS (SELECT query_id, doc_id, rank FROM ({_BM25} SELECT query_id, doc_id, rank FROM r WHERE rank <= 50) x JOIN q USING (query_id))"""


def _queries(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"), "label")


def _dense(spark: SparkSession, d: str, limit: int = 50) -> DataFrame:
    return retrieval.dense(table(spark, d, "embeddings"), _queries(spark, d), limit=limit)


def _items(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    vectors = table(spark, d, "embeddings").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"), "label")
    return items.join(vectors, "query_id")


def _both(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The first 50 by vector and by text, each computed once."""
    items = _items(spark, d)
    dense = retrieval.dense(table(spark, d, "embeddings"), items, limit=50).select("query_id", "doc_id", "rank", "score")
    lexical = retrieval.bm25(table(spark, d, "documents"), items, limit=50).select("query_id", "doc_id", "rank", "score")
    return kept(dense, "dense"), kept(lexical, "lexical")


def _labels(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), "label")


def _gold_sizes(spark: SparkSession, d: str, queries: DataFrame | None = None) -> DataFrame:
    """How many other vectors have a query's label. Counted by label: the pairs themselves grow with the square."""
    n = table(spark, d, "embeddings").groupBy("label").agg((F.count(F.lit(1)) - 1).alias("n_gold")).where("n_gold > 0")
    return (queries or _queries(spark, d)).select("query_id", "label").join(n, "label").select("query_id", "n_gold")


def _judged(spark: SparkSession, d: str, ranking: DataFrame, queries: DataFrame | None = None) -> DataFrame:
    """The ranking, with whether a row is gold: another vector of the query's label."""
    wanted = (queries or _queries(spark, d)).select("query_id", F.col("label").alias("wanted"))
    gold = F.coalesce((F.col("label") == F.col("wanted")) & (F.col("query_id") != F.col("doc_id")), F.lit(False))
    return ranking.join(_labels(spark, d), "doc_id").join(wanted, "query_id").withColumn("gold", gold)


def _judged_by(rows: DataFrame, queries: DataFrame) -> DataFrame:
    """Ranked rows that have labels, with whether they are gold."""
    wanted = queries.select("query_id", F.col("label").alias("wanted"))
    gold = F.coalesce((F.col("label") == F.col("wanted")) & (F.col("query_id") != F.col("doc_id")), F.lit(False))
    return rows.join(wanted, "query_id").withColumn("gold", gold).drop("wanted")


def _measured(spark: SparkSession, d: str, ranking: DataFrame, ks: tuple[int, ...] = (5, 10)) -> DataFrame:
    return metrics.metrics_of_hits(_gold_sizes(spark, d), _judged(spark, d, ranking).where("gold").select("query_id", "rank"), ks)


@add("dense_topk_cosine", f"{_RANKS} SELECT query_id, doc_id, rank, round(score, 6) AS score FROM a WHERE rank <= 10")
def dense_topk_cosine(spark: SparkSession, d: str) -> DataFrame:
    return _dense(spark, d, limit=10).select("query_id", "doc_id", F.col("rank").cast("long").alias("rank"), F.round("score", 6).alias("score"))


@add("dense_filtered_topk", f"{_RANKS}, f AS (SELECT sa.*, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM sa JOIN e USING (doc_id) WHERE label BETWEEN 2 AND 5) SELECT query_id, doc_id, rank FROM f WHERE rank <= 10")
def dense_filtered_topk(spark: SparkSession, d: str) -> DataFrame:
    out = retrieval.dense(table(spark, d, "embeddings").withColumnRenamed("label", "rating"), _queries(spark, d), where=payload_filter(rating_min=2, rating_max=5))
    return out.select("query_id", "doc_id", F.col("rank").cast("long").alias("rank"))


# the index answers with everything that its bound can't rule out, so that it equals a scan
@add("ivf_topk", f"{_RANKS} SELECT query_id, doc_id, rank, round(score, 6) AS score FROM a WHERE rank <= 10")
def ivf_topk(spark: SparkSession, d: str) -> DataFrame:
    out = VectorIndex.build(table(spark, d, "embeddings")).search(_queries(spark, d), probes=4, exact=True)
    return out.select("query_id", "doc_id", F.col("rank").cast("long").alias("rank"), F.round("score", 6).alias("score"))


@add("ivf_filtered_topk", f"{_RANKS}, f AS (SELECT sa.*, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM sa JOIN e USING (doc_id) WHERE label BETWEEN 2 AND 5) SELECT query_id, doc_id, rank FROM f WHERE rank <= 10")
def ivf_filtered_topk(spark: SparkSession, d: str) -> DataFrame:
    index = VectorIndex.build(table(spark, d, "embeddings").withColumnRenamed("label", "rating"), payload=("rating",))
    out = index.search(_queries(spark, d), probes=4, where=payload_filter(rating_min=2, rating_max=5), exact=True)
    return out.select("query_id", "doc_id", F.col("rank").cast("long").alias("rank"))


@add("ivf_recall")
def ivf_recall(spark: SparkSession, d: str) -> DataFrame:
    """Recall of the first ten against a scan of all vectors, by the share of cells that are probed, and the share of pairs
    that are compared then."""
    index, queries = VectorIndex.build(table(spark, d, "embeddings")), _queries(spark, d)
    truth, n, out = kept(retrieval.dense(table(spark, d, "embeddings"), queries), "truth"), index.cells.count(), None
    for share in (0.1, 0.25, 0.5, 0.75):
        probes = max(1, round(share * n))
        found = recall(index.search(queries, probes=probes), truth)
        row = found.select(F.lit(probes).alias("probes"), F.lit(n).alias("cells"), F.round(F.lit(index.read_share(queries, probes)), 6).alias("compared"), F.round("recall_at_10", 6).alias("recall_at_10"))
        out = row if out is None else out.unionByName(row)
    return out


def _fused_sql(dense: float, lexical: float) -> str:
    return f"""{_HYBRID}, u AS (SELECT query_id, doc_id, rank, CAST({dense} AS DOUBLE) / (60 + rank) AS s FROM a UNION ALL SELECT query_id, doc_id, rank, CAST({lexical} AS DOUBLE) / (60 + rank) FROM b), f AS (SELECT query_id, doc_id, sum(s) AS score, min(rank) AS best FROM u GROUP BY ALL),
  r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, best, doc_id) AS rank FROM f)"""


@add("rrf_fusion", f"{_fused_sql(1, 1)} SELECT query_id, doc_id, rank, round(score, 6) AS score FROM r WHERE rank <= 20")
def rrf_fusion(spark: SparkSession, d: str) -> DataFrame:
    out = retrieval.rrf([*_both(spark, d)]).where("rank <= 20")
    return out.select("query_id", "doc_id", F.col("rank").cast("long").alias("rank"), F.round("score", 6).alias("score"))


@add("weighted_rrf", f"{_fused_sql(0.75, 0.25)} SELECT query_id, doc_id, rank, round(score, 6) AS score FROM r WHERE rank <= 20")
def weighted_rrf(spark: SparkSession, d: str) -> DataFrame:
    out = retrieval.rrf([*_both(spark, d)], [0.75, 0.25]).where("rank <= 20")
    return out.select("query_id", "doc_id", F.col("rank").cast("long").alias("rank"), F.round("score", 6).alias("score"))


@add("priority_fill", f"{_HYBRID}, u AS (SELECT query_id, doc_id, 0 AS src, rank FROM b UNION ALL SELECT query_id, doc_id, 1, rank FROM a), m AS (SELECT query_id, doc_id, min(src * 1000 + rank) AS o FROM u GROUP BY ALL) SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY o, doc_id) AS rank FROM m")
def priority_fill(spark: SparkSession, d: str) -> DataFrame:
    dense, lexical = _both(spark, d)
    return retrieval.first_then(lexical, dense).select("query_id", "doc_id", F.col("rank").cast("long").alias("rank"))


@add("hybrid_search", f"{_fused_sql(0.5, 0.5)} SELECT query_id, doc_id, rank, round(1.0 / rank, 6) AS score FROM r WHERE rank <= 20")
def hybrid_search(spark: SparkSession, d: str) -> DataFrame:
    """Documents by BM25 and vectors of the same ids by cosine, fused with equal weights."""
    out = retrieval.search("weighted", table(spark, d, "documents"), table(spark, d, "embeddings"), _items(spark, d), limit=20)
    return out.select("query_id", "doc_id", F.col("rank").cast("long").alias("rank"), F.round("score", 6).alias("score"))


_METRICS = f"""{_RANKS}, n AS (SELECT query_id, count(*) AS n_gold FROM gold GROUP BY 1), h AS (SELECT a.query_id, a.rank FROM a JOIN gold USING (query_id, doc_id)),
  ideal AS (SELECT query_id, n_gold, list_sum([1.0 / log2(i + 1) FOR i IN range(1, least(n_gold, 5) + 1)]) AS i5, list_sum([1.0 / log2(i + 1) FOR i IN range(1, least(n_gold, 10) + 1)]) AS i10 FROM n),
  m AS (SELECT i.query_id, n_gold, count(*) FILTER (rank <= 5) AS h5, count(*) FILTER (rank <= 10) AS h10, coalesce(sum(1.0 / log2(rank + 1)) FILTER (rank <= 5), 0) / any_value(i5) AS ndcg5, coalesce(sum(1.0 / log2(rank + 1)) FILTER (rank <= 10), 0) / any_value(i10) AS ndcg10,
    coalesce(1.0 / min(rank) FILTER (rank <= 10), 0) AS rr, count(*) FILTER (rank <= n_gold) AS hr FROM ideal i LEFT JOIN h USING (query_id) GROUP BY i.query_id, n_gold)"""


@add("retrieval_metrics", f"""{_METRICS} SELECT query_id, n_gold, CAST(h5 > 0 AS DOUBLE) AS hit_at_5, round(h5 / n_gold, 6) AS recall_at_5, round(h5 / least(n_gold, 5), 6) AS capped_recall_at_5, round(ndcg5, 6) AS ndcg_at_5,
  CAST(h10 > 0 AS DOUBLE) AS hit_at_10, round(h10 / n_gold, 6) AS recall_at_10, round(h10 / least(n_gold, 10), 6) AS capped_recall_at_10, round(ndcg10, 6) AS ndcg_at_10, round(rr, 6) AS rr_at_10, round(hr / n_gold, 6) AS r_precision FROM m""")
def retrieval_metrics(spark: SparkSession, d: str) -> DataFrame:
    m = _measured(spark, d, _dense(spark, d))
    return m.select("query_id", "n_gold", *[F.round(c, 6).alias(c) for c in m.columns[2:]])


@add("retrieval_summary", f"{_METRICS} SELECT count(*) AS n_queries, round(avg(CAST(h10 > 0 AS DOUBLE)), 6) AS hit_at_10, round(avg(h10 / n_gold), 6) AS recall_at_10, round(avg(rr), 6) AS rr_at_10 FROM m")
def retrieval_summary(spark: SparkSession, d: str) -> DataFrame:
    return metrics.averages(_measured(spark, d, _dense(spark, d))).select("n_queries", "hit_at_10", "recall_at_10", "rr_at_10")


@add("filter_precision", f"{_RANKS} SELECT query_id, round(avg(CAST(e.label = q.label AS DOUBLE)), 6) AS filter_precision_at_10 FROM a JOIN e USING (doc_id) JOIN q USING (query_id) WHERE rank <= 10 GROUP BY query_id")
def filter_precision(spark: SparkSession, d: str) -> DataFrame:
    ranking = _dense(spark, d).join(_queries(spark, d).select("query_id", F.col("label").alias("wanted")), "query_id")
    out = metrics.filter_precision(ranking, _labels(spark, d), F.col("label") == F.col("wanted"))
    return out.select("query_id", F.round("filter_precision_at_10", 6).alias("filter_precision_at_10"))


@add("retrieval_error_class", f"""{_HYBRID}, runs AS (SELECT 'dense' AS mode, query_id, doc_id, rank FROM a UNION ALL SELECT 'lexical', query_id, doc_id, rank FROM b),
  j AS (SELECT runs.*, l.label, d.lang, d.source, g.doc_id IS NOT NULL AS gold FROM runs LEFT JOIN e l USING (doc_id) LEFT JOIN documents d USING (doc_id) LEFT JOIN gold g USING (query_id, doc_id)),
  f AS (SELECT *, row_number() OVER (PARTITION BY mode, query_id ORDER BY rank) AS kept FROM j WHERE lang = 'en'),
  good AS (SELECT mode, query_id, bool_or(kept <= 10 AND gold) AS good, any_value(label) FILTER (kept = 1) AS top_label, any_value(source) FILTER (kept = 1) AS top_source FROM f GROUP BY ALL),
  wide AS (SELECT mode, query_id, bool_or(rank <= 10 AND gold) AS hit, bool_or(gold) AS wide FROM j GROUP BY ALL)
  SELECT w.mode, w.query_id, CASE WHEN good THEN 'good' WHEN hit THEN 'filter_too_strict' WHEN top_label IS DISTINCT FROM q.label THEN 'wrong_aspect' WHEN top_source IS DISTINCT FROM d.source THEN 'wrong_sentiment' WHEN w.mode = 'dense' AND NOT wide THEN 'lexical_miss' ELSE 'no_gold_hit' END AS error
  FROM wide w JOIN q USING (query_id) LEFT JOIN good USING (mode, query_id) LEFT JOIN documents d ON d.doc_id = w.query_id""")
def retrieval_error_class(spark: SparkSession, d: str) -> DataFrame:
    """Dense and lexical runs with the English documents alone and with all. A label stands for an aspect, a
    document's source for its sentiment."""
    items, (dense, lexical) = _items(spark, d), _both(spark, d)
    runs = dense.withColumn("mode", F.lit("dense")).unionByName(lexical.withColumn("mode", F.lit("lexical")))
    docs = table(spark, d, "documents").select("doc_id", "lang", "source")
    facts = docs.join(_labels(spark, d), "doc_id", "full_outer")
    j = _judged_by(runs.join(facts, "doc_id", "left"), items)
    return metrics.run_errors(j, F.col("lang") == "en", items.select("query_id", "label").join(docs.select(F.col("doc_id").alias("query_id"), "source"), "query_id", "left"), aspect="label", sentiment="source").select("mode", "query_id", "error")


_RUNS = f"""{_HYBRID}, cand AS (SELECT query_id, doc_id, a.rank AS rd, b.rank AS rl FROM a FULL JOIN b USING (query_id, doc_id)),
  m AS (SELECT *, unnest(['dense', 'lexical', 'rrf', 'weighted', 'lexical_first']) AS mode FROM cand),
  s AS (SELECT mode, query_id, doc_id, least(rd, rl) AS best, CAST(CASE mode WHEN 'dense' THEN -rd WHEN 'lexical' THEN -rl WHEN 'rrf' THEN coalesce(CAST(1 AS DOUBLE) / (60 + rd), 0) + coalesce(CAST(1 AS DOUBLE) / (60 + rl), 0) WHEN 'weighted' THEN coalesce(CAST(0.25 AS DOUBLE) / (60 + rd), 0) + coalesce(CAST(0.75 AS DOUBLE) / (60 + rl), 0) ELSE coalesce(1000000 - rl, -rd) END AS DOUBLE) AS score FROM m),
  k AS (SELECT *, row_number() OVER (PARTITION BY mode, query_id ORDER BY round(score, 9) DESC, best, doc_id) AS rank FROM s WHERE score IS NOT NULL),
  j AS (SELECT k.mode, k.query_id, k.doc_id, rank, d.lang, d.source, l.label, g.doc_id IS NOT NULL AS gold FROM k LEFT JOIN documents d USING (doc_id) LEFT JOIN e l USING (doc_id) LEFT JOIN gold g USING (query_id, doc_id)),
  w AS (SELECT *, CASE WHEN lang = 'en' THEN sum(CAST(coalesce(lang = 'en', false) AS INT)) OVER (PARTITION BY mode, query_id ORDER BY rank) END AS kept FROM (SELECT * FROM j) t)"""


def _runs(spark: SparkSession, d: str, items: DataFrame) -> DataFrame:
    """Runs of all modes over one table of candidates, with what is known of a document."""
    docs = table(spark, d, "documents").select("doc_id", "lang", "source").join(_labels(spark, d), "doc_id", "full_outer")
    return _judged_by(metrics.fused_runs(*_both(spark, d)).join(docs, "doc_id", "left"), items)


@add("retrieval_evaluation", f"""{_RUNS}, n AS (SELECT query_id, count(*) AS n_gold FROM gold GROUP BY 1),
  h AS (SELECT mode, query_id, count(*) FILTER (rank <= 10) AS h, min(rank) FILTER (rank <= 10) AS f, count(*) FILTER (kept <= 10) AS fh, min(kept) FILTER (kept <= 10) AS ff FROM w WHERE gold GROUP BY ALL),
  p AS (SELECT mode, query_id, n_gold, coalesce(h, 0) AS h, coalesce(1.0 / f, 0) AS rr, coalesce(fh, 0) AS fh, coalesce(1.0 / ff, 0) AS frr FROM n CROSS JOIN (SELECT DISTINCT mode FROM k) LEFT JOIN h USING (mode, query_id)),
  t AS (SELECT mode, query_id, bool_or(rank <= 10 AND gold) AS hit, bool_or(gold) AS wide, coalesce(bool_or(kept <= 10 AND gold), false) AS good, any_value(label) FILTER (kept = 1) AS top_label, any_value(source) FILTER (kept = 1) AS top_source FROM w GROUP BY ALL),
  er AS (SELECT t.mode, t.query_id, CASE WHEN good THEN 'good' WHEN hit THEN 'filter_too_strict' WHEN top_label IS DISTINCT FROM q.label THEN 'wrong_aspect' WHEN top_source IS DISTINCT FROM d.source THEN 'wrong_sentiment' WHEN t.mode = 'dense' AND NOT wide THEN 'lexical_miss' ELSE 'no_gold_hit' END AS error FROM t JOIN q USING (query_id) LEFT JOIN documents d ON d.doc_id = t.query_id)
  SELECT mode, count(*) AS n_queries, round(avg(CAST(h > 0 AS DOUBLE)), 6) AS hit_at_10, round(avg(h / n_gold), 6) AS recall_at_10, round(avg(rr), 6) AS rr_at_10, round(avg(CAST(fh > 0 AS DOUBLE)), 6) AS filtered_hit_at_10, round(avg(fh / n_gold), 6) AS filtered_recall_at_10, round(avg(frr), 6) AS filtered_rr_at_10,
    count(*) FILTER (error = 'good') AS n_good, count(*) FILTER (error = 'filter_too_strict') AS n_filter_too_strict, count(*) FILTER (error = 'wrong_aspect') AS n_wrong_aspect, count(*) FILTER (error = 'wrong_sentiment') AS n_wrong_sentiment, count(*) FILTER (error IN ('lexical_miss', 'no_gold_hit')) AS n_missed
  FROM p LEFT JOIN er USING (mode, query_id) GROUP BY mode""")
def retrieval_evaluation(spark: SparkSession, d: str) -> DataFrame:
    """All modes with and without the filter on English documents, and why queries fail with it."""
    items = _items(spark, d)
    runs = kept(_runs(spark, d, items), "runs")
    english = F.col("lang") == "en"
    wanted = items.select("query_id", "label").join(table(spark, d, "documents").select(F.col("doc_id").alias("query_id"), "source"), "query_id", "left")
    errors = metrics.run_errors(runs, english, wanted, aspect="label", sentiment="source").select("mode", "query_id", "error")
    per = metrics.evaluate(runs, english, _gold_sizes(spark, d, items)).join(errors, ["mode", "query_id"], "left")
    is_ = lambda *e: F.count_if(F.col("error").isin(*e))
    named = [is_(e).alias(f"n_{e}") for e in ("good", "filter_too_strict", "wrong_aspect", "wrong_sentiment")]
    means = [F.round(F.avg(c), 6).alias(c) for c in per.columns if c.endswith("_at_10")]
    return per.groupBy("mode").agg(F.count(F.lit(1)).alias("n_queries"), *means, *named, is_("lexical_miss", "no_gold_hit").alias("n_missed"))


@add("retrieval_candidates", f"{_RUNS} SELECT query_id, mode, kept AS rank, doc_id, gold FROM w WHERE kept <= 10")
def retrieval_candidates(spark: SparkSession, d: str) -> DataFrame:
    """What each mode finds with the filter: its first ten rows a query, for review."""
    runs = _runs(spark, d, _items(spark, d)).where("lang = 'en'")
    nth = F.row_number().over(Window.partitionBy("mode", "query_id").orderBy("rank"))
    return runs.withColumn("rank", nth.cast("long")).where("rank <= 10").select("query_id", "mode", "rank", "doc_id", "gold")


@add("golden_diagnostics", f"""{_RANKS}, held AS (SELECT DISTINCT doc_id FROM documents WHERE lang = 'en'), g AS (SELECT query_id, count(*) AS n_gold, count(held.doc_id) AS present FROM gold LEFT JOIN held USING (doc_id) GROUP BY 1)
  SELECT query_id, n_gold, present, n_gold - present AS missing, round(least(present, 5) / n_gold, 6) AS max_recall_at_5, round(least(present, 10) / n_gold, 6) AS max_recall_at_10 FROM g""")
def golden_diagnostics(spark: SparkSession, d: str) -> DataFrame:
    """Gold rows against an index that holds the English documents: how many are present, and what recall is
    possible. Counted by label; a query's own vector is no gold of it."""
    held = table(spark, d, "documents").where("lang = 'en'").select("doc_id").distinct().withColumn("held", F.lit(1))
    e = _labels(spark, d).join(held, "doc_id", "left").withColumn("held", F.coalesce("held", F.lit(0)))
    n = e.groupBy("label").agg((F.count(F.lit(1)) - 1).alias("n_gold"), F.sum("held").alias("all")).where("n_gold > 0")
    g = e.where("doc_id % 100 = 0").withColumnRenamed("doc_id", "query_id").join(n, "label").withColumn("present", F.col("all") - F.col("held"))
    most = lambda k: F.round(F.least("present", F.lit(k)) / F.col("n_gold"), 6).alias(f"max_recall_at_{k}")
    return g.select("query_id", "n_gold", "present", (F.col("n_gold") - F.col("present")).alias("missing"), most(5), most(10))


#: The weights that the lexical ranking has in the grid of fusions.
GRID = (0.6, 0.7, 0.8, 0.9)
_CONFIGS = ["dense", "lexical", "rrf_equal", "lexical_first", *[f"rrf_weighted_{w}" for w in GRID]]
_FUSIONS = "(VALUES ('rrf_equal', 0.5, 0.5), " + ", ".join(f"('rrf_weighted_{w}', {w}, {round(1 - w, 2)})" for w in GRID) + ") t(mode, wb, wa)"


@add("fusion_grid", f"""{_HYBRID}, c AS (SELECT mode, CAST(wb AS DOUBLE) AS wb, CAST(wa AS DOUBLE) AS wa FROM {_FUSIONS}),
  u AS (SELECT mode, query_id, doc_id, rank, wa / (60 + rank) AS s FROM a, c UNION ALL SELECT mode, query_id, doc_id, rank, wb / (60 + rank) FROM b, c),
  f AS (SELECT mode, query_id, doc_id, sum(s) AS score, min(rank) AS best FROM u GROUP BY ALL),
  p AS (SELECT query_id, doc_id, min(o) AS o FROM (SELECT query_id, doc_id, rank AS o FROM b UNION ALL SELECT query_id, doc_id, 1000 + rank FROM a) GROUP BY ALL),
  r AS (SELECT mode, query_id, doc_id, row_number() OVER (PARTITION BY mode, query_id ORDER BY round(score, 9) DESC, best, doc_id) AS rank FROM f
    UNION ALL SELECT 'lexical_first', query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY o, doc_id) FROM p UNION ALL SELECT 'dense', query_id, doc_id, rank FROM a UNION ALL SELECT 'lexical', query_id, doc_id, rank FROM b),
  n AS (SELECT query_id, count(*) AS n_gold FROM gold GROUP BY 1), h AS (SELECT mode, query_id, count(*) AS hits, min(rank) AS first FROM r JOIN gold USING (query_id, doc_id) WHERE rank <= 20 GROUP BY ALL),
  m AS (SELECT mode, round(avg(coalesce(hits, 0) / n_gold), 6) AS recall_at_20, round(avg(CASE WHEN first <= 10 THEN 1.0 / first ELSE 0 END), 6) AS mrr_at_10 FROM (SELECT DISTINCT mode FROM r) CROSS JOIN n LEFT JOIN h USING (mode, query_id) GROUP BY 1)
  SELECT *, row_number() OVER (ORDER BY recall_at_20 DESC, mrr_at_10 DESC, list_position({_CONFIGS}, mode)) = 1 AS best FROM m""")
def fusion_grid(spark: SparkSession, d: str) -> DataFrame:
    """Recall and mrr of all configurations and the best of them, the first of equals. The lists of both
    rankings are scored for all weights at once."""
    items, (a, b) = _items(spark, d), _both(spark, d)
    weights = [("rrf_equal", 0.5), *[(f"rrf_weighted_{w}", w) for w in GRID]]
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("mode"), F.lit(w).alias("wb"), F.lit(round(1 - w, 2)).alias("wa")) for m, w in weights]))
    both = a.select("query_id", "doc_id", "rank", F.lit("wa").alias("of")).unionByName(b.select("query_id", "doc_id", "rank", F.lit("wb").alias("of")))
    each = both.withColumn("c", pairs).select("query_id", "doc_id", "rank", "c.mode", (F.when(F.col("of") == "wa", F.col("c.wa")).otherwise(F.col("c.wb")) / (retrieval.RRF_K + F.col("rank"))).alias("s"))
    scores = each.groupBy("mode", "query_id", "doc_id").agg(F.sum("s").alias("score"), F.min("rank").alias("best"))
    nth = F.row_number().over(Window.partitionBy("mode", "query_id").orderBy(F.round("score", 9).desc(), "best", "doc_id"))
    ranks = scores.withColumn("rank", nth).select("mode", "query_id", "doc_id", "rank")
    for mode, ranking in (("lexical_first", retrieval.first_then(b, a)), ("dense", a), ("lexical", b)):
        ranks = ranks.unionByName(ranking.select(F.lit(mode).alias("mode"), "query_id", "doc_id", "rank"))
    hits = _judged(spark, d, ranks.where("rank <= 20"), items).where("gold").groupBy("mode", "query_id").agg(F.count(F.lit(1)).alias("hits"), F.min("rank").alias("first"))
    modes = F.explode(F.array(*[F.lit(m) for m in _CONFIGS])).alias("mode")
    j = _gold_sizes(spark, d, items).select("query_id", "n_gold", modes).join(hits, ["mode", "query_id"], "left")
    rr = F.when(F.col("first") <= 10, 1.0 / F.col("first")).otherwise(0.0)
    m = j.groupBy("mode").agg(F.round(F.avg(F.coalesce("hits", F.lit(0)) / F.col("n_gold")), 6).alias("recall_at_20"), F.round(F.avg(rr), 6).alias("mrr_at_10"))
    order = Window.orderBy(F.col("recall_at_20").desc(), F.col("mrr_at_10").desc(), F.array_position(F.array(*[F.lit(c) for c in _CONFIGS]), F.col("mode")))
    return m.withColumn("best", F.row_number().over(order) == 1)  # eight rows


_any = lambda col, words: "(" + " OR ".join(f"contains({col}, '{w}')" for w in words) + ")"
_SAID = """q AS (SELECT conv_id, turn, lower(trim(CASE turn % 5 WHEN 0 THEN 'How many reviews? ' WHEN 1 THEN 'Is there a spike in battery issues? ' WHEN 2 THEN 'What do customers say about the price? ' WHEN 3 THEN 'JBL charging, ' ELSE '' END || text)) AS q FROM conversations)"""
_ROUTE = f"""CASE WHEN q = '' THEN 'insufficient_scope' WHEN {_any('q', lx.INCIDENT_WORDS)} THEN 'incident_summary' WHEN {_any('q', lx.ANALYTICS_WORDS)} THEN 'analytics_summary' WHEN {_any('q', lx.RETRIEVAL_WORDS)} THEN 'retrieval_answer' WHEN {_any('q', lx.ASPECT_ALIASES)} THEN 'retrieval_answer' ELSE 'insufficient_scope' END"""
_ASPECT = "CASE " + " ".join(f"WHEN contains(q, '{a}') THEN '{c}'" for a, c in lx.ASPECT_ALIASES.items()) + " END"


def _questions(spark: SparkSession, d: str) -> DataFrame:
    head = F.when(F.col("turn") % 5 == 0, "How many reviews? ").when(F.col("turn") % 5 == 1, "Is there a spike in battery issues? ").when(F.col("turn") % 5 == 2, "What do customers say about the price? ").when(F.col("turn") % 5 == 3, "JBL charging, ").otherwise("")
    return table(spark, d, "conversations").select("conv_id", "turn", F.concat(head, F.col("text")).alias("question"))


@add("route_questions", f"""WITH {_SAID} SELECT conv_id, turn, {_ROUTE} AS route, {_ASPECT} AS aspect, CASE WHEN {_any('q', lx.NEGATIVE_HINTS)} AND NOT {_any('q', lx.POSITIVE_HINTS)} THEN 'negative' WHEN {_any('q', lx.POSITIVE_HINTS)} AND NOT {_any('q', lx.NEGATIVE_HINTS)} THEN 'positive' END AS sentiment,
  CASE {' '.join(f"WHEN regexp_matches(q, '\\b{b.lower()}\\b') THEN '{b}'" for b in lx.BRANDS)} END AS brand FROM q""")
def route_questions(spark: SparkSession, d: str) -> DataFrame:
    return agent.routed(_questions(spark, d)).drop("question")


@add("agent_metrics", f"""WITH {_SAID}, r AS (SELECT *, {_ROUTE} AS actual, CASE turn % 4 WHEN 0 THEN 'analytics_summary' WHEN 1 THEN 'incident_summary' WHEN 2 THEN 'retrieval_answer' ELSE 'insufficient_scope' END AS expected, turn % 3 AS n FROM q),
  s AS (SELECT *, actual = expected AS m, expected <> 'retrieval_answer' OR n >= 1 AS c FROM r)
  SELECT count(*) AS n_questions,
  count(*) FILTER (expected = 'retrieval_answer') AS n_retrieval,
  count(*) FILTER (expected = 'analytics_summary') AS n_analytics,
  count(*) FILTER (expected = 'incident_summary') AS n_incident,
  count(*) FILTER (expected = 'insufficient_scope') AS n_insufficient,
  coalesce(round(count(*) FILTER (m) / nullif(count(*), 0), 4), 0) AS route_accuracy,
  coalesce(round(count(*) FILTER (expected = 'retrieval_answer' AND n > 0) / nullif(count(*) FILTER (expected = 'retrieval_answer'), 0), 4), 0) AS retrieval_citation_rate,
  coalesce(round(count(*) FILTER (expected = 'insufficient_scope' AND actual = 'insufficient_scope') / nullif(count(*) FILTER (expected = 'insufficient_scope'), 0), 4), 0) AS refusal_rate,
  coalesce(round(count(*) FILTER (expected = 'analytics_summary' AND q <> '') / nullif(count(*) FILTER (expected = 'analytics_summary'), 0), 4), 0) AS analytics_answer_rate,
  coalesce(round(count(*) FILTER (expected = 'incident_summary' AND q <> '') / nullif(count(*) FILTER (expected = 'incident_summary'), 0), 4), 0) AS incident_answer_rate,
  coalesce(round(sum(n) FILTER (expected = 'retrieval_answer') / nullif(count(*) FILTER (expected = 'retrieval_answer'), 0), 4), 0) AS average_citations,
  coalesce(round(count(*) FILTER (turn % 6 = 5) / nullif(count(*), 0), 4), 0) AS warning_rate,
  coalesce(round(count(*) FILTER (m AND c AND q <> '') / nullif(count(*), 0), 4), 0) AS pass_rate FROM s""")
def agent_metrics(spark: SparkSession, d: str) -> DataFrame:
    turn = F.col("turn")
    expected = F.when(turn % 4 == 0, "analytics_summary").when(turn % 4 == 1, "incident_summary").when(turn % 4 == 2, "retrieval_answer").otherwise("insufficient_scope")
    runs = _questions(spark, d).select(
        expected.alias("expected_route"),
        agent.route(F.col("question")).alias("actual_route"),
        F.col("question").alias("answer"),
        (turn % 3).alias("n_citations"),
        (expected == "retrieval_answer").alias("expected_citation_required"),
        F.lit(1).alias("expected_min_citations"),
        F.array().cast("array<string>").alias("expected_contains"),
        (turn % 6 == 5).cast("int").alias("n_warnings"),
    )
    return metrics.agent_metrics(metrics.score_agent(runs))
