"""Queries on reviews: anomalies, reports, joins, samples, writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import ANOMALY_WEIGHTS, CLUSTER_WEIGHTS, severity_weight, where_optional
from tidemark.operators import absa, anomaly, brand, reports, sampling
from tidemark.plans.registry import REVIEW_KEY, REVIEWS_SQL, Registry, reviews, table
from tidemark.sources import sinks

REGISTRY = Registry()
add = REGISTRY.add
KEY = ", ".join(REVIEW_KEY)

_WEEKS = f"""WITH {REVIEWS_SQL}, neg AS (SELECT *, CAST(date_trunc('week', posted_at) AS DATE) AS week_start,
    CASE severity WHEN 'high' THEN 4.0 WHEN 'medium' THEN 2.0 ELSE 1.0 END AS w FROM reviews WHERE sentiment = 'negative'),
  weeks AS (SELECT brand, week_start, count(*) AS volume, CAST(round(sum(w), 4) AS DOUBLE) AS severity_score, count(DISTINCT order_id) AS reviews,
    round(avg(rating), 4) AS avg_rating FROM neg GROUP BY brand, week_start)"""
# EWMA in closed form: the first of k earlier weeks weighs 0.6^(k-1), the j-th after it 0.4 * 0.6^(k-1-j)
_SCORED = f"""{_WEEKS}, n AS (SELECT *, row_number() OVER (PARTITION BY brand ORDER BY week_start) AS i FROM weeks),
  base AS (SELECT a.brand, a.i, sum(b.volume * CASE WHEN b.i = 1 THEN power(0.6, a.i - 2) ELSE 0.4 * power(0.6, a.i - 1 - b.i) END) AS baseline
    FROM n a JOIN n b ON a.brand = b.brand AND b.i < a.i GROUP BY a.brand, a.i),
  dev AS (SELECT *, stddev_samp(volume) OVER (PARTITION BY brand ORDER BY week_start ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING) AS std FROM n),
  scored AS (SELECT dev.*, base.baseline, (volume - base.baseline) / greatest(coalesce(std, 0.0), 1.0) AS z FROM dev LEFT JOIN base USING (brand, i))"""


def _weeks(spark: SparkSession, d: str) -> DataFrame:
    return anomaly.weekly(reviews(spark, d).where("sentiment = 'negative'"), ["brand"], review="order_id")


@add("weekly_anomaly_brand", f"""{_SCORED} SELECT brand, week_start, volume, severity_score, reviews, avg_rating, round(baseline, 4) AS baseline, round(std, 4) AS std, round(z, 4) AS z
  FROM scored WHERE i > 3 AND z >= 2 AND volume >= 3 AND severity_score >= 5""")
def weekly_anomaly_brand(spark: SparkSession, d: str) -> DataFrame:
    out = anomaly.detect(_weeks(spark, d), ["brand"])
    return out.select("brand", "week_start", "volume", "severity_score", "reviews", "avg_rating", *[F.round(c, 4).alias(c) for c in ("baseline", "std", "z")])


@add("weekly_bucket_stats", f"{_WEEKS} SELECT * FROM weeks")
def weekly_bucket_stats(spark: SparkSession, d: str) -> DataFrame:
    return _weeks(spark, d)


@add("weekly_bucket_quotes", f"""WITH {REVIEWS_SQL}, q AS (SELECT aspect, CAST(date_trunc('week', posted_at) AS DATE) AS week_start, lower(brand) AS l, min(sku) AS sku, arg_min(brand, sku) AS brand FROM reviews WHERE sentiment = 'negative' GROUP BY 1, 2, 3),
  r AS (SELECT *, row_number() OVER (PARTITION BY aspect, week_start ORDER BY sku, brand) AS n FROM q)
  SELECT aspect, week_start, string_agg(brand, '|' ORDER BY n) AS quotes FROM r WHERE n <= 3 GROUP BY 1, 2""")
def weekly_bucket_quotes(spark: SparkSession, d: str) -> DataFrame:
    out = anomaly.weekly(reviews(spark, d).where("sentiment = 'negative'"), ["aspect"], review="order_id", quote="brand", order="sku")
    return out.select("aspect", "week_start", F.array_join("quotes", "|").alias("quotes"))


@add("ewma_baseline", f"{_SCORED} SELECT brand, week_start, round(baseline, 6) AS baseline FROM scored")
def ewma_baseline(spark: SparkSession, d: str) -> DataFrame:
    return anomaly.with_baseline(_weeks(spark, d), ["brand"]).select("brand", "week_start", F.round("baseline", 6).alias("baseline"))


@add("rolling_std", f"{_SCORED} SELECT brand, week_start, round(std, 6) AS std FROM scored")
def rolling_std(spark: SparkSession, d: str) -> DataFrame:
    return anomaly.with_baseline(_weeks(spark, d), ["brand"]).select("brand", "week_start", F.round("std", 6).alias("std"))


@add("zscore", f"{_SCORED} SELECT brand, week_start, i - 1 AS history, round(z, 6) AS z FROM scored")
def zscore(spark: SparkSession, d: str) -> DataFrame:
    return anomaly.with_baseline(_weeks(spark, d), ["brand"]).select("brand", "week_start", F.col("history").cast("long").alias("history"), F.round("z", 6).alias("z"))


@add("incident_summaries", f"""{_SCORED} SELECT brand, week_start, upper(brand[1]) || lower(brand[2:]) || ' complaints overall spiked to ' || volume || ' mentions during week ' || strftime(week_start, '%Y-%m-%d') || ', above EWMA baseline ' || printf('%.1f', baseline) || ' (z=' || printf('%.1f', z) || ', severity score ' || printf('%.0f', severity_score) || ').' || CASE WHEN reviews % 2 = 0 THEN ' Representative quote: ''' || reviews || ' reviews''' ELSE '' END AS summary
  FROM scored WHERE i > 3 AND z >= 2 AND volume >= 3 AND severity_score >= 5""")
def incident_summaries(spark: SparkSession, d: str) -> DataFrame:
    out = anomaly.detect(_weeks(spark, d), ["brand"])
    text = anomaly.summary(F.col("brand"), F.lit(""), F.col("week_start"), F.col("volume"), F.col("baseline"), F.col("z"), F.col("severity_score"), F.when(F.col("reviews") % 2 == 0, F.array(F.concat(F.col("reviews").cast("string"), F.lit(" reviews")))))
    return out.select("brand", "week_start", text.alias("summary"))


@add("overview_counts", """SELECT (SELECT count(*) FROM lineitem) AS reviews, (SELECT count(*) FROM part) AS skus, (SELECT count(DISTINCT p_brand) FROM part) AS brands, (SELECT count(*) FROM orders) AS statuses,
  (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS distinct_reviews, (SELECT count(*) FROM documents) AS documents, (SELECT count(*) FROM events) AS events, (SELECT count(*) FROM supplier) AS sellers""")
def overview_counts(spark: SparkSession, d: str) -> DataFrame:
    one = lambda t, a: table(spark, d, t).agg(a)
    n = F.count(F.lit(1))
    frames = [one("lineitem", n.alias("reviews")), one("part", n.alias("skus")), one("part", F.count_distinct("p_brand").alias("brands")), one("orders", n.alias("statuses")), one("lineitem", F.count_distinct("l_orderkey").alias("distinct_reviews")), one("documents", n.alias("documents")), one("events", n.alias("events")), one("supplier", n.alias("sellers"))]
    out = frames[0]
    for f in frames[1:]:
        out = out.join(F.broadcast(f))  # rows of one
    return out


@add("reviews_by_brand", f"WITH {REVIEWS_SQL} SELECT brand, count(*) AS n FROM reviews GROUP BY brand")
def reviews_by_brand(spark: SparkSession, d: str) -> DataFrame:
    return reports.counts(reviews(spark, d), "brand")


@add("rating_distribution", f"WITH {REVIEWS_SQL} SELECT rating, count(*) AS n FROM reviews GROUP BY rating")
def rating_distribution(spark: SparkSession, d: str) -> DataFrame:
    return reports.counts(reviews(spark, d), "rating")


@add("sentiment_distribution", f"WITH {REVIEWS_SQL} SELECT sentiment, count(*) AS n FROM reviews GROUP BY sentiment")
def sentiment_distribution(spark: SparkSession, d: str) -> DataFrame:
    return reports.counts(reviews(spark, d), "sentiment")


@add("aspect_distribution", f"WITH {REVIEWS_SQL} SELECT aspect, count(*) AS n FROM reviews GROUP BY aspect")
def aspect_distribution(spark: SparkSession, d: str) -> DataFrame:
    return reports.counts(reviews(spark, d), "aspect")


@add("list_brands", f"WITH {REVIEWS_SQL} SELECT DISTINCT brand FROM reviews")
def list_brands(spark: SparkSession, d: str) -> DataFrame:
    return reviews(spark, d).select("brand").distinct().orderBy("brand")


@add("status_dist_zero_filled", """SELECT s AS status, count(o_orderstatus) AS n FROM (VALUES ('F'), ('O'), ('P'), ('X')) t(s) LEFT JOIN orders ON o_orderstatus = s GROUP BY s""")
def status_dist_zero_filled(spark: SparkSession, d: str) -> DataFrame:
    return reports.zero_filled(table(spark, d, "orders").withColumnRenamed("o_orderstatus", "status"), "status", ["F", "O", "P", "X"])


@add("severity_dist_filtered", f"""WITH {REVIEWS_SQL}, f AS (SELECT coalesce(severity, '(none)') AS severity FROM reviews WHERE sentiment = 'negative' AND brand = 'Brand#7')
  SELECT s AS severity, count(f.severity) AS n FROM (VALUES ('low'), ('medium'), ('high'), ('(none)')) t(s) LEFT JOIN f ON f.severity = s GROUP BY s""")
def severity_dist_filtered(spark: SparkSession, d: str) -> DataFrame:
    return reports.zero_filled(reviews(spark, d).where(where_optional(sentiment="negative", brand="Brand#7")), "severity", ["low", "medium", "high", "(none)"], null_as="(none)")


@add("aspect_sentiment_counts", f"WITH {REVIEWS_SQL} SELECT aspect, sentiment, count(*) AS n FROM reviews GROUP BY ALL")
def aspect_sentiment_counts(spark: SparkSession, d: str) -> DataFrame:
    return reports.counts(reviews(spark, d), "aspect", "sentiment")


@add("aspect_sentiment_pivot", f"""WITH {REVIEWS_SQL} SELECT aspect, count(*) FILTER (sentiment = 'positive') AS positive, count(*) FILTER (sentiment = 'neutral') AS neutral, count(*) FILTER (sentiment = 'negative') AS negative,
  count(*) AS total, round(count(*) FILTER (sentiment = 'negative') / count(*), 4) AS negative_share FROM reviews GROUP BY aspect""")
def aspect_sentiment_pivot(spark: SparkSession, d: str) -> DataFrame:
    return reports.matrix(reviews(spark, d), "aspect", "sentiment", ["positive", "neutral", "negative"])


@add("optional_filter_combo", f"WITH {REVIEWS_SQL} SELECT brand, aspect, count(*) AS n FROM reviews WHERE sentiment = 'negative' AND severity = 'high' AND rating >= 2 AND rating <= 4 GROUP BY ALL")
def optional_filter_combo(spark: SparkSession, d: str) -> DataFrame:
    where = where_optional(brand=None, sentiment="negative", severity="high", rating_min=2, rating_max=4)
    return reports.counts(reviews(spark, d).where(where), "brand", "aspect")


@add("negative_examples_topk", f"WITH {REVIEWS_SQL} SELECT {KEY}, brand, aspect, severity FROM reviews WHERE sentiment = 'negative' ORDER BY posted_at DESC, order_id, sku, seller, line LIMIT 50")
def negative_examples_topk(spark: SparkSession, d: str) -> DataFrame:
    return reports.examples(reviews(spark, d), F.col("sentiment") == "negative", at="posted_at", tiebreak=["order_id", "sku", "seller", "line"]).select(*REVIEW_KEY, "brand", "aspect", "severity")


@add("top_brands_negative", f"WITH {REVIEWS_SQL} SELECT brand, count(*) AS n FROM reviews WHERE sentiment = 'negative' GROUP BY brand ORDER BY n DESC, brand LIMIT 10")
def top_brands_negative(spark: SparkSession, d: str) -> DataFrame:
    return reports.top(reports.counts(reviews(spark, d).where("sentiment = 'negative'"), "brand"), 10, F.col("n").desc(), "brand")


@add("star_join_5way", """SELECT r_name AS region, n_name AS nation, p_brand AS brand, count(*) AS n, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""")
def star_join_5way(spark: SparkSession, d: str) -> DataFrame:
    t = lambda n: table(spark, d, n)
    j = reports.star(t("lineitem"), (t("part"), "l_partkey", "p_partkey"), (t("supplier"), "l_suppkey", "s_suppkey"), (t("nation"), "s_nationkey", "n_nationkey"), (t("region"), "n_regionkey", "r_regionkey"))
    return j.groupBy(F.col("r_name").alias("region"), F.col("n_name").alias("nation"), F.col("p_brand").alias("brand")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


@add("latest_runs", "SELECT event_id, ts, event_type FROM events ORDER BY ts DESC, event_id LIMIT 50")
def latest_runs(spark: SparkSession, d: str) -> DataFrame:
    return reports.latest(table(spark, d, "events").select("event_id", "ts", "event_type"), "ts", "event_id", 50)


@add("clusters_rank", f"""WITH {REVIEWS_SQL} SELECT aspect, brand, count(*) AS size, CAST(sum(CASE severity WHEN 'high' THEN 3.0 WHEN 'medium' THEN 2.0 ELSE 1.0 END) AS DOUBLE) AS weighted_size FROM reviews WHERE sentiment = 'negative'
  GROUP BY ALL ORDER BY weighted_size DESC, size DESC, aspect, brand LIMIT 20""")
def clusters_rank(spark: SparkSession, d: str) -> DataFrame:
    g = reviews(spark, d).where("sentiment = 'negative'").groupBy("aspect", "brand").agg(F.count(F.lit(1)).alias("size"), F.sum(severity_weight(F.col("severity"), CLUSTER_WEIGHTS)).alias("weighted_size"))
    return reports.top(g, 20, F.col("weighted_size").desc(), F.col("size").desc(), "aspect", "brand")


@add("incidents_rank", f"""{_SCORED} SELECT brand, week_start, severity_score, round(z, 2) AS z FROM scored WHERE i > 3 AND z >= 2 AND volume >= 3 AND severity_score >= 5 ORDER BY severity_score DESC, round(z, 6) DESC, week_start, brand LIMIT 20""")
def incidents_rank(spark: SparkSession, d: str) -> DataFrame:
    found = anomaly.detect(_weeks(spark, d), ["brand"])
    return reports.top(found, 20, F.col("severity_score").desc(), F.round("z", 6).desc(), "week_start", "brand").select("brand", "week_start", "severity_score", F.round("z", 2).alias("z"))


@add("cluster_representatives", f"""WITH {REVIEWS_SQL}, n AS (SELECT aspect, order_id, max(CASE severity WHEN 'high' THEN 3.0 WHEN 'medium' THEN 2.0 ELSE 1.0 END) AS w FROM reviews WHERE sentiment = 'negative' GROUP BY ALL),
  r AS (SELECT *, row_number() OVER (PARTITION BY aspect ORDER BY w DESC, order_id) AS i FROM n) SELECT aspect, string_agg(CAST(order_id AS VARCHAR), ',' ORDER BY i) AS ids FROM r WHERE i <= 5 GROUP BY aspect""")
def cluster_representatives(spark: SparkSession, d: str) -> DataFrame:
    from tidemark.operators.clustering import representatives

    rows = representatives(reviews(spark, d).where("sentiment = 'negative'"), ["aspect"], review="order_id", severity="severity", quote="brand")
    return rows.select("aspect", F.array_join("representative_ids", ",").alias("ids"))


@add("pending_anti_join", "SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def pending_anti_join(spark: SparkSession, d: str) -> DataFrame:
    return absa.pending(table(spark, d, "orders").select("o_orderkey"), table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey"), ["o_orderkey"])


@add("source_semi_join", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')")
def source_semi_join(spark: SparkSession, d: str) -> DataFrame:
    runs = table(spark, d, "customer").where("c_mktsegment = 'MACHINERY'").select(F.col("c_custkey").alias("o_custkey"))
    return table(spark, d, "orders").join(runs, "o_custkey", "left_semi").select("o_orderkey", "o_totalprice")


@add("resolve_ids_missing", "SELECT DISTINCT l_partkey * 2 AS p_partkey, l_partkey * 2 IN (SELECT p_partkey FROM part) AS found FROM lineitem")
def resolve_ids_missing(spark: SparkSession, d: str) -> DataFrame:
    return absa.resolve(table(spark, d, "lineitem").select((F.col("l_partkey") * 2).alias("p_partkey")), table(spark, d, "part"), "p_partkey")


@add("quote_map_left_join", f"""WITH {REVIEWS_SQL}, q AS (SELECT order_id, aspect, arg_min(brand, sku * 100 + line) AS quote FROM reviews WHERE sentiment <> 'neutral' GROUP BY ALL)
  SELECT r.order_id, r.aspect, count(*) AS n, min(coalesce(q.quote, '')) AS quote FROM reviews r LEFT JOIN q USING (order_id, aspect) GROUP BY ALL""")
def quote_map_left_join(spark: SparkSession, d: str) -> DataFrame:
    r = reviews(spark, d).withColumn("mention_id", F.col("sku") * 100 + F.col("line"))
    quotes = reports.first_per(r.where("sentiment <> 'neutral'"), ["order_id", "aspect"], "mention_id", "brand").withColumnRenamed("brand", "quote")
    return r.join(quotes, ["order_id", "aspect"], "left").groupBy("order_id", "aspect").agg(F.count(F.lit(1)).alias("n"), F.min(F.coalesce("quote", F.lit(""))).alias("quote"))


_MEMBERS = "j AS (SELECT o_orderkey, l_partkey * 10 + l_linenumber AS mention FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey)"


@add("members_outer_join_dedup", f"""WITH {_MEMBERS}, cut AS (SELECT * FROM j ORDER BY o_orderkey, mention NULLS LAST LIMIT 200) SELECT o_orderkey, min(mention) AS mention FROM cut GROUP BY o_orderkey""")
def members_outer_join_dedup(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), (F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("mention"))
    return reports.members(table(spark, d, "orders").select("o_orderkey"), m, ["o_orderkey"], order=["o_orderkey"], prefer="mention", limit=200)


@add("members_dedup_before_limit", f"""WITH {_MEMBERS} SELECT o_orderkey, min(mention) AS mention FROM j GROUP BY o_orderkey ORDER BY o_orderkey LIMIT 200""")
def members_dedup_before_limit(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), (F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("mention"))
    return reports.members(table(spark, d, "orders").select("o_orderkey"), m, ["o_orderkey"], order=["o_orderkey"], prefer="mention", limit=200, dedup_first=True)


@add("brand_review_stats", f"""WITH {REVIEWS_SQL} SELECT brand, count(*) AS reviews, count(DISTINCT sku) AS products, count(*) FILTER (rating = 1) AS rating_1, count(*) FILTER (rating = 2) AS rating_2, count(*) FILTER (rating = 3) AS rating_3,
  count(*) FILTER (rating = 4) AS rating_4, count(*) FILTER (rating = 5) AS rating_5, round(avg(rating), 4) AS avg_rating, CAST(min(posted_at) AS DATE) AS first_date, CAST(max(posted_at) AS DATE) AS last_date FROM reviews GROUP BY brand
  UNION ALL SELECT 'Brand#0', 0, 0, 0, 0, 0, 0, 0, NULL, NULL, NULL""")
def brand_review_stats(spark: SparkSession, d: str) -> DataFrame:
    listed = table(spark, d, "part").select(F.col("p_brand").alias("brand")).unionAll(spark.range(1).select(F.lit("Brand#0").alias("brand")))
    return brand.review_stats(reviews(spark, d), listed)


@add("brand_argmax", f"""WITH {REVIEWS_SQL}, n AS (SELECT seller, brand, count(*) AS n, max(rating) AS top FROM reviews GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY seller ORDER BY n DESC, top DESC, brand DESC) AS i FROM n) SELECT seller, brand FROM r WHERE i = 1""")
def brand_argmax(spark: SparkSession, d: str) -> DataFrame:
    n = reviews(spark, d).groupBy("seller", "brand").agg(F.count(F.lit(1)).alias("n"), F.max("rating").alias("top"))
    return n.groupBy("seller").agg(F.max_by("brand", F.struct("n", "top", "brand")).alias("brand"))


@add("brand_inventory", """WITH r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS i FROM part) SELECT p_brand AS brand, count(*) AS items, count(DISTINCT p_partkey) AS products, string_agg(p_name, ' | ' ORDER BY i) FILTER (i <= 5) AS examples FROM r GROUP BY 1""")
def brand_inventory(spark: SparkSession, d: str) -> DataFrame:
    return brand.inventory(table(spark, d, "part").withColumnRenamed("p_brand", "brand"), brand="brand", sku="p_partkey", name="p_name", order="p_partkey")


@add("brand_gate", f"""WITH {REVIEWS_SQL}, i AS (SELECT p_brand AS brand, count(*) AS items FROM part GROUP BY 1), v AS (SELECT brand, count(*) AS reviews FROM reviews GROUP BY 1)
  SELECT brand, items, coalesce(reviews, 0) AS reviews, items >= 80 AND coalesce(reviews, 0) >= 2300 AS included,
  CASE WHEN items >= 80 AND coalesce(reviews, 0) >= 2300 THEN 'ok' WHEN coalesce(reviews, 0) = 0 THEN 'no matched reviews after metadata join' WHEN items < 80 AND reviews < 2300 THEN 'below thresholds: ' || items || ' items < 80 and ' || reviews || ' reviews < 2300'
    WHEN items < 80 THEN 'too few matched metadata items: ' || items || ' < 80' ELSE 'too few matched reviews: ' || reviews || ' < 2300' END AS reason FROM i LEFT JOIN v USING (brand)""")
def brand_gate(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "part").groupBy(F.col("p_brand").alias("brand")).agg(F.count(F.lit(1)).alias("items"))
    return brand.gate(items, reports.counts(reviews(spark, d), "brand", name="reviews"), least_items=80, least_reviews=2300)


@add("parent_then_own_brand", """WITH m AS (SELECT p_partkey AS asin, p_brand AS brand FROM part WHERE p_partkey % 3 <> 0) SELECT coalesce(a.brand, b.brand) AS brand, count(*) AS n FROM lineitem LEFT JOIN m a ON a.asin = l_partkey - l_partkey % 10 LEFT JOIN m b ON b.asin = l_partkey GROUP BY 1""")
def parent_then_own_brand(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select(F.col("l_partkey").alias("asin"), (F.col("l_partkey") - F.col("l_partkey") % 10).alias("parent_asin"))
    known = brand.last_write(table(spark, d, "part").where("p_partkey % 3 <> 0").select(F.col("p_partkey").alias("asin"), F.col("p_brand").alias("brand"), F.col("p_partkey").alias("pos")), "asin", "brand", "pos")
    return reports.counts(brand.of_reviews(li, known), "brand")


_QUOTA = f"""WITH {REVIEWS_SQL}, n AS (SELECT brand, rating, count(*) AS n FROM reviews GROUP BY ALL), t AS (SELECT *, 100 AS target, sum(n) OVER (PARTITION BY brand) AS total FROM n),
  f AS (SELECT *, CASE WHEN target >= total THEN n ELSE floor(target * n / total) END AS fl, target * n / total - floor(target * n / total) AS rem FROM t),
  q AS (SELECT *, greatest(least(target, total) - sum(fl) OVER (PARTITION BY brand), 0) AS rest, row_number() OVER (PARTITION BY brand ORDER BY rem DESC, n DESC, rating) AS i FROM f),
  quotas AS (SELECT brand, rating, n, CAST(fl + CASE WHEN target < total AND i <= rest THEN 1 ELSE 0 END AS BIGINT) AS quota FROM q)"""


def _quotas(spark: SparkSession, d: str) -> DataFrame:
    r = reviews(spark, d)
    return sampling.largest_remainder(reports.counts(r, "brand", "rating"), r.select("brand").distinct().withColumn("target", F.lit(100)), "brand", ["rating"])


@add("largest_remainder_quota", f"{_QUOTA} SELECT brand, rating, n, quota FROM quotas")
def largest_remainder_quota(spark: SparkSession, d: str) -> DataFrame:
    return _quotas(spark, d).select("brand", "rating", "n", "quota")


@add("stratified_quota_sample", f"""{_QUOTA}, r AS (SELECT *, row_number() OVER (PARTITION BY brand, rating ORDER BY (order_id * 7919 + sku * 31 + line) % 10007, order_id, sku, seller, line, posted_at) AS i FROM reviews)
  SELECT {KEY}, r.brand, r.rating FROM r JOIN quotas USING (brand, rating) WHERE i <= quota""")
def stratified_quota_sample(spark: SparkSession, d: str) -> DataFrame:
    score = (F.col("order_id") * 7919 + F.col("sku") * 31 + F.col("line")) % 10007
    return sampling.stratified(reviews(spark, d), _quotas(spark, d), ["brand", "rating"], score, REVIEW_KEY).select(*REVIEW_KEY, "brand", "rating")


@add("balanced_holdout", f"""WITH {REVIEWS_SQL}, s AS (SELECT brand, row_number() OVER (ORDER BY count(*) DESC, brand) AS g FROM reviews GROUP BY brand),
  r AS (SELECT *, row_number() OVER (PARTITION BY brand, rating ORDER BY {KEY}) AS round FROM reviews) SELECT {KEY}, brand, rating, round FROM r JOIN s USING (brand) ORDER BY round, g, rating LIMIT 200""")
def balanced_holdout(spark: SparkSession, d: str) -> DataFrame:
    return sampling.holdout(reviews(spark, d), group="brand", level="rating", order=REVIEW_KEY, limit=200).select(*REVIEW_KEY, "brand", "rating", F.col("round").cast("long").alias("round"))


@add("guardrail_running_stop", """WITH w AS (SELECT event_id, user_id, ts, count(*) OVER k AS n_seen, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER k AS n_bad FROM events WINDOW k AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)),
  s AS (SELECT *, n_seen >= 50 AND n_bad / n_seen > 0.2 AS stop FROM w), b AS (SELECT *, coalesce(sum(CAST(stop AS INT)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM s)
  SELECT event_id, user_id, n_seen, CAST(n_bad AS BIGINT) AS n_bad, stop AS stopped FROM b WHERE before = 0""")
def guardrail_running_stop(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").withColumn("at", F.struct("ts", "event_id"))
    return absa.up_to_breach(e, F.col("event_type") == "error", "at", most=0.2, scope=["user_id"]).select("event_id", "user_id", "n_seen", "n_bad", "stopped")


# the whole log is one sequence: errors count from the fiftieth row on, values up to a cap
@add("guardrail_whole_log", """WITH w AS (SELECT event_id, count(*) OVER k AS n_seen, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER k AS n_bad, sum(CAST(round(value * 100) AS BIGINT)) OVER k AS cost FROM events WINDOW k AS (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)),
  cap AS (SELECT CAST(0.7 * sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cap FROM events), s AS (SELECT w.*, (n_seen >= 50 AND n_bad / n_seen > 0.5) OR cost > cap AS stop FROM w, cap), b AS (SELECT *, coalesce(sum(CAST(stop AS INT)) OVER (ORDER BY n_seen ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM s)
  SELECT event_id, n_seen, CAST(n_bad AS BIGINT) AS n_bad, stop AS stopped FROM b WHERE before = 0""")
def guardrail_whole_log(spark: SparkSession, d: str) -> DataFrame:
    """Stopped by its cost, in whole hundredths, at 70 % of the log's."""
    e = table(spark, d, "events").withColumn("at", F.struct("ts", "event_id")).withColumn("cost", F.round(F.col("value") * 100).cast("long"))
    total = e.agg(F.sum("cost")).first()[0] or 0
    out = absa.up_to_breach(e, F.col("event_type") == "error", "at", most=0.5, cost=F.col("cost"), cost_cap=round(0.7 * total))
    return out.select("event_id", "n_seen", "n_bad", "stopped")


@add("load_if_absent", """SELECT o_orderkey, o_custkey, 0 AS batch FROM orders WHERE o_orderkey % 3 <> 0 UNION ALL
  SELECT o_orderkey, min(o_custkey), 1 FROM (SELECT o_orderkey, o_custkey + 1 AS o_custkey FROM orders) t WHERE o_orderkey % 3 = 0 GROUP BY o_orderkey""")
def load_if_absent(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    held = orders.where("o_orderkey % 3 <> 0").withColumn("batch", F.lit(0))
    return held.unionByName(sinks.absent(orders.withColumn("o_custkey", F.col("o_custkey") + 1).withColumn("batch", F.lit(1)), held, ["o_orderkey"], order="o_custkey"))


@add("incident_upsert_nullsafe", f"""{_WEEKS}, a AS (SELECT brand, CASE WHEN volume > 3 THEN brand END AS cluster, week_start, volume FROM weeks), b AS (SELECT brand, cluster, week_start, volume + 100 AS volume FROM a WHERE brand < 'Brand#2')
  SELECT * FROM a WHERE NOT brand < 'Brand#2' UNION ALL SELECT * FROM b""")
def incident_upsert_nullsafe(spark: SparkSession, d: str) -> DataFrame:
    a = _weeks(spark, d).select("brand", F.when(F.col("volume") > 3, F.col("brand")).alias("cluster"), "week_start", "volume")
    return sinks.upsert(a, a.where("brand < 'Brand#2'").withColumn("volume", F.col("volume") + 100), ["brand", "cluster", "week_start"])


@add("ontology_upsert", """SELECT p_type AS code, CASE WHEN p_type = 'PROMO' THEN 'Promotion' ELSE p_type END AS label, CASE WHEN p_type = 'PROMO' THEN 'updated' WHEN p_type IN ('SMALL', 'LARGE') THEN 'inserted' ELSE 'kept' END AS action FROM (SELECT DISTINCT p_type FROM part) t""")
def ontology_upsert(spark: SparkSession, d: str) -> DataFrame:
    codes = table(spark, d, "part").select(F.col("p_type").alias("code")).distinct()
    held = codes.where("code NOT IN ('SMALL', 'LARGE')").withColumn("label", F.col("code"))
    seed = codes.withColumn("label", F.when(F.col("code") == "PROMO", "Promotion").otherwise(F.col("code")))
    return sinks.seed(held, seed, ["code"], ["label"])


@add("replace_scope", "SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 1 END AS generation FROM orders")
def replace_scope(spark: SparkSession, d: str) -> DataFrame:
    held = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.lit(1).alias("generation"))
    return sinks.replace_scope(held, held.where("o_orderstatus = 'P'").withColumn("generation", F.lit(2)), ["o_orderstatus"])


@add("membership_dedup", "SELECT l_orderkey, l_suppkey, min(l_partkey) AS l_partkey FROM lineitem GROUP BY ALL")
def membership_dedup(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_partkey")
    w = Window.partitionBy("l_orderkey", "l_suppkey").orderBy("l_partkey")
    return li.withColumn("n", F.row_number().over(w)).where("n = 1").drop("n")


@add("pipeline_coverage", """WITH s AS (SELECT count(*) AS processed, count(*) FILTER (o_orderstatus = 'F') AS successes FROM orders), m AS (SELECT count(DISTINCT l_orderkey) AS with_mentions FROM lineitem), t AS (SELECT count(*) AS reviews FROM lineitem)
  SELECT reviews, processed, successes, with_mentions, round(successes / reviews, 4) AS success_coverage, round(with_mentions / processed, 4) AS mention_coverage FROM s, m, t""")
def pipeline_coverage(spark: SparkSession, d: str) -> DataFrame:
    statuses = table(spark, d, "orders").select(F.when(F.col("o_orderstatus") == "F", "success").otherwise("no_mentions").alias("status"))
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("review_id"))
    return reports.coverage(statuses, li, li)


@add("health_check", "SELECT 'lineitem' AS \"table\", count(*) AS n, count(*) > 0 AS ok FROM lineitem UNION ALL SELECT 'part', count(*), count(*) > 0 FROM part UNION ALL SELECT 'documents', count(*), count(*) > 0 FROM documents")
def health_check(spark: SparkSession, d: str) -> DataFrame:
    return reports.non_empty({n: table(spark, d, n) for n in ("lineitem", "part", "documents")})


@add("severity_weights", f"WITH {REVIEWS_SQL} SELECT brand, CAST(sum(CASE severity WHEN 'high' THEN 3.0 WHEN 'medium' THEN 2.0 ELSE 1.0 END) AS DOUBLE) AS cluster_weight, CAST(sum(CASE severity WHEN 'high' THEN 4.0 WHEN 'medium' THEN 2.0 ELSE 1.0 END) AS DOUBLE) AS anomaly_weight FROM reviews GROUP BY brand")
def severity_weights(spark: SparkSession, d: str) -> DataFrame:
    w = lambda t: F.sum(severity_weight(F.col("severity"), t))
    return reviews(spark, d).groupBy("brand").agg(w(CLUSTER_WEIGHTS).alias("cluster_weight"), w(ANOMALY_WEIGHTS).alias("anomaly_weight"))
