"""Evaluation: rankings against gold sets, predicted against gold labels, agent runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The routes of questions.
ROUTES = ("retrieval_answer", "analytics_summary", "incident_summary", "insufficient_scope")


def ranking_metrics(ranking: DataFrame, gold: DataFrame, ks: tuple[int, ...] = (5, 10), mrr_k: int = 10) -> DataFrame:
    """One row for each query of gold: hit, recall, capped recall and ndcg at each k, rr and r_precision.
    `ranking` has (query_id, doc_id, rank), `gold` has (query_id, doc_id). One join, one aggregation."""
    sizes = gold.groupBy("query_id").agg(F.count_distinct("doc_id").alias("n_gold"))
    hits = ranking.join(gold.distinct(), ["query_id", "doc_id"], "left_semi").select("query_id", "rank")
    return metrics_of_hits(sizes, hits, ks, mrr_k)


def metrics_of_hits(sizes: DataFrame, hits: DataFrame, ks: tuple[int, ...] = (5, 10), mrr_k: int = 10) -> DataFrame:
    """ranking_metrics from (query_id, n_gold) and the ranks (query_id, rank) of gold documents: for gold that
    a rule on the documents defines, whose pairs needn't be listed."""
    j = sizes.join(hits, "query_id", "left")
    aggs = [F.count_if(F.col("rank") <= k).alias(f"h{k}") for k in ks]
    aggs += [F.sum(F.when(F.col("rank") <= k, 1.0 / F.log2(F.col("rank") + 1))).alias(f"d{k}") for k in ks]
    aggs += [F.min(F.when(F.col("rank") <= mrr_k, F.col("rank"))).alias("first"), F.count_if(F.col("rank") <= F.col("n_gold")).alias("hr")]
    g = j.groupBy("query_id", "n_gold").agg(*aggs)
    ideal = lambda k: F.aggregate(F.sequence(F.lit(1), F.least(F.col("n_gold"), F.lit(k)).cast("int")), F.lit(0.0), lambda a, i: a + 1.0 / F.log2(i + 1))
    out = [F.col("query_id"), F.col("n_gold")]
    for k in ks:
        out += [(F.col(f"h{k}") > 0).cast("double").alias(f"hit_at_{k}"), (F.col(f"h{k}") / F.col("n_gold")).alias(f"recall_at_{k}")]
        out += [(F.col(f"h{k}") / F.least(F.col("n_gold"), F.lit(k))).alias(f"capped_recall_at_{k}"), (F.coalesce(f"d{k}", F.lit(0.0)) / ideal(k)).alias(f"ndcg_at_{k}")]
    out += [F.coalesce(1.0 / F.col("first"), F.lit(0.0)).alias(f"rr_at_{mrr_k}"), (F.col("hr") / F.col("n_gold")).alias("r_precision")]
    return g.select(*out)


def filter_precision(ranking: DataFrame, payload: DataFrame, match: Column, k: int = 10) -> DataFrame:
    """The share of a query's first k rows whose payload matches what the query expects."""
    j = ranking.where(F.col("rank") <= k).join(payload, "doc_id", "left")
    return j.groupBy("query_id").agg(F.avg(F.coalesce(match, F.lit(False)).cast("double")).alias(f"filter_precision_at_{k}"))


def averages(per_query: DataFrame) -> DataFrame:
    """Means over queries; nulls don't count."""
    names = [c for c in per_query.columns if "_at_" in c or c == "r_precision"]
    return per_query.agg(F.count(F.lit(1)).alias("n_queries"), *[F.round(F.avg(c), 6).alias(c) for c in names])


def retrieval_error(good: Column, unfiltered_hit: Column, aspect_ok: Column, sentiment_ok: Column, dense_mode: Column, wide_hit: Column) -> Column:
    """The first cause that applies to a query without a gold document in its first ten."""
    return F.when(good, "good").when(unfiltered_hit, "filter_too_strict").when(~aspect_ok, "wrong_aspect").when(~sentiment_ok, "wrong_sentiment").when(dense_mode & ~wide_hit, "lexical_miss").otherwise("no_gold_hit")


def fused_runs(dense: DataFrame, lexical: DataFrame, lexical_weight: float = 0.75, k: int = 60) -> DataFrame:
    """(mode, query_id, doc_id, rank) of all modes from one table of candidates: each document once with its rank in either list,
    scored for every mode at once."""
    d, x = dense.select("query_id", "doc_id", F.col("rank").alias("rd")), lexical.select("query_id", "doc_id", F.col("rank").alias("rl"))
    part = lambda w, r: F.coalesce(F.lit(float(w)) / (k + F.col(r)), F.lit(0.0))
    scores = {"dense": -F.col("rd"), "lexical": -F.col("rl"), "rrf": part(1, "rd") + part(1, "rl"), "weighted": part(1 - lexical_weight, "rd") + part(lexical_weight, "rl"), "lexical_first": F.coalesce(1_000_000 - F.col("rl"), -F.col("rd"))}
    modes = F.explode(F.array(*[F.struct(F.lit(m).alias("mode"), c.cast("double").alias("score")) for m, c in scores.items()])).alias("m")
    rows = d.join(x, ["query_id", "doc_id"], "full_outer").select("query_id", "doc_id", F.least("rd", "rl").alias("best"), modes).where("m.score IS NOT NULL")
    nth = F.row_number().over(Window.partitionBy("m.mode", "query_id").orderBy(F.round("m.score", 9).desc(), "best", "doc_id"))
    return rows.select("m.mode", "query_id", "doc_id", nth.alias("rank"))


def evaluate(runs: DataFrame, fits: Column, sizes: DataFrame, k: int = 10) -> DataFrame:
    """One row for each mode and query of sizes (query_id, n_gold): hit, recall and reciprocal rank at k of the run (rows with rank and
    gold), and of the same run with only the rows that fit the query's filter. A query without rows scores 0."""
    nth = F.sum(F.coalesce(fits, F.lit(False)).cast("int")).over(Window.partitionBy("mode", "query_id").orderBy("rank"))
    rows = runs.withColumn("__fits", F.coalesce(fits, F.lit(False))).withColumn("__kept", F.when(F.col("__fits"), nth)).where("gold")
    near = lambda r: F.count_if(F.col(r) <= k)
    first = lambda r: F.min(F.when(F.col(r) <= k, F.col(r)))
    found = rows.groupBy("mode", "query_id").agg(near("rank").alias("h"), first("rank").alias("f"), near("__kept").alias("fh"), first("__kept").alias("ff"))
    j = sizes.join(runs.select("mode").distinct(), F.lit(True)).join(found, ["mode", "query_id"], "left")
    own = lambda h, f, name: [(F.coalesce(h, F.lit(0)) > 0).cast("double").alias(f"{name}hit_at_{k}"), (F.coalesce(h, F.lit(0)) / F.col("n_gold")).alias(f"{name}recall_at_{k}"), F.coalesce(1.0 / F.col(f), F.lit(0.0)).alias(f"{name}rr_at_{k}")]
    return j.select("mode", "query_id", "n_gold", *own("h", "f", ""), *own("fh", "ff", "filtered_"))


def run_errors(rows: DataFrame, fits: Column, wanted: DataFrame, *, aspect: str, sentiment: str, k: int = 10) -> DataFrame:
    """(mode, query_id, error) for runs (mode, query_id, doc_id, rank, gold and payload) that are judged with a filter and
    without it, from the same rows. wanted: the payload that a query (query_id) expects."""
    nth = F.row_number().over(Window.partitionBy("mode", "query_id").orderBy("rank"))
    held = rows.where(fits).withColumn("__n", nth)
    top = lambda c: F.max(F.when(F.col("__n") == 1, F.col(c))).alias(f"__top_{c}")
    good = held.groupBy("mode", "query_id").agg(F.bool_or((F.col("__n") <= k) & F.col("gold")).alias("__good"), top(aspect), top(sentiment))
    wide = rows.groupBy("mode", "query_id").agg(F.bool_or((F.col("rank") <= k) & F.col("gold")).alias("__hit"), F.bool_or("gold").alias("__wide"))
    j = wide.join(good, ["mode", "query_id"], "left").join(wanted, "query_id")
    same = lambda c: F.col(f"__top_{c}").eqNullSafe(F.col(c))
    return j.withColumn("error", retrieval_error(F.coalesce("__good", F.lit(False)), F.col("__hit"), same(aspect), same(sentiment), F.col("mode") == "dense", F.col("__wide")))


def matched(gold: DataFrame, predicted: DataFrame, keys: list[str], label: str = "label") -> DataFrame:
    """Full outer match of the smallest label for each key (rows have no order that would name a first): tp, fp, fn and the label pair."""
    one = lambda df, name: df.groupBy(*keys).agg(F.min(label).alias(name))
    j = one(gold, "gold").join(one(predicted, "predicted"), keys, "full_outer")
    both = F.col("gold").isNotNull() & F.col("predicted").isNotNull()
    return j.withColumn("outcome", F.when(both, "tp").when(F.col("gold").isNull(), "fp").otherwise("fn"))


def precision_recall(tp: Column, fp: Column, fn: Column) -> list[Column]:
    p, r = F.coalesce(tp / F.nullif(tp + fp, F.lit(0)), F.lit(0.0)), F.coalesce(tp / F.nullif(tp + fn, F.lit(0)), F.lit(0.0))
    return [p.alias("precision"), r.alias("recall"), F.coalesce(2 * p * r / F.nullif(p + r, F.lit(0.0)), F.lit(0.0)).alias("f1")]


def by_code(outcomes: DataFrame, codes: DataFrame, code: str = "code") -> DataFrame:
    """Precision, recall and F1 for each code; codes that never occur count as 0."""
    n = outcomes.groupBy(code).agg(*[F.count_if(F.col("outcome") == o).alias(o) for o in ("tp", "fp", "fn")])
    j = codes.join(n, code, "left").na.fill(0, ["tp", "fp", "fn"])
    return j.select(code, "tp", "fp", "fn", *precision_recall(F.col("tp"), F.col("fp"), F.col("fn")))


def kappa(pairs: DataFrame, a: str = "gold", b: str = "predicted") -> DataFrame:
    """Cohen's kappa; null without pairs, and 1 or 0 where chance agreement is 1."""
    n = pairs.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(a) == F.col(b)).alias("same"))
    ma, mb = pairs.groupBy(F.col(a).alias("k")).agg(F.count(F.lit(1)).alias("na")), pairs.groupBy(F.col(b).alias("k")).agg(F.count(F.lit(1)).alias("nb"))
    chance = ma.join(mb, "k").agg(F.sum(F.col("na").cast("double") * F.col("nb")).alias("c"))
    po, pe = F.col("same") / F.col("n"), F.coalesce("c", F.lit(0.0)) / (F.col("n").cast("double") * F.col("n"))
    value = F.when(F.col("n") == 0, None).when(pe == 1, (po == 1).cast("double")).otherwise((po - pe) / (1 - pe))
    return n.join(F.broadcast(chance)).select("n", F.round(value, 6).alias("kappa"))


def confusion(pairs: DataFrame, code: str = "code") -> DataFrame:
    counts = pairs.groupBy(code, F.concat_ws("->", "gold", "predicted").alias("pair")).count()
    return counts.groupBy(code).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("pair", "count")))).alias("confusion"))


def score_agent(runs: DataFrame) -> DataFrame:
    """Adds what each run got right. Columns: expected_route, actual_route, answer, n_citations,
    expected_citation_required, expected_min_citations, expected_contains (array), n_warnings."""
    answer = F.lower(F.coalesce("answer", F.lit("")))
    df = runs.withColumn("route_match", F.col("actual_route") == F.col("expected_route")).withColumn("answer_nonempty", F.trim(F.coalesce("answer", F.lit(""))) != "")
    df = df.withColumn("citation_ok", ~F.col("expected_citation_required") | (F.col("n_citations") >= F.col("expected_min_citations")))
    df = df.withColumn("contains_ok", F.forall("expected_contains", lambda t: answer.contains(F.lower(t)))).withColumn("has_warning", F.col("n_warnings") > 0)
    return df.withColumn("passed", F.col("route_match") & F.col("citation_ok") & F.col("contains_ok") & F.col("answer_nonempty"))


def agent_metrics(scored: DataFrame) -> DataFrame:
    rate = lambda a, b: F.coalesce(F.round(a / F.nullif(b, F.lit(0)), 4), F.lit(0.0))
    is_ = lambda r: F.col("expected_route") == r
    n, n_of = F.count(F.lit(1)), lambda r: F.count_if(is_(r))
    return scored.agg(
        n.alias("n_questions"),
        *[n_of(r).alias(f"n_{r.split('_')[0]}") for r in ROUTES],
        rate(F.count_if("route_match"), n).alias("route_accuracy"),
        rate(F.count_if(is_("retrieval_answer") & (F.col("n_citations") > 0)), n_of("retrieval_answer")).alias("retrieval_citation_rate"),
        rate(F.count_if(is_("insufficient_scope") & (F.col("actual_route") == "insufficient_scope")), n_of("insufficient_scope")).alias("refusal_rate"),
        rate(F.count_if(is_("analytics_summary") & F.col("answer_nonempty")), n_of("analytics_summary")).alias("analytics_answer_rate"),
        rate(F.count_if(is_("incident_summary") & F.col("answer_nonempty")), n_of("incident_summary")).alias("incident_answer_rate"),
        rate(F.sum(F.when(is_("retrieval_answer"), F.col("n_citations"))), n_of("retrieval_answer")).alias("average_citations"),
        rate(F.count_if("has_warning"), n).alias("warning_rate"),
        rate(F.count_if("passed"), n).alias("pass_rate"),
    )


def nearest_rank(rows: DataFrame, group: str, value: str, share: float = 0.95, buckets: int = 1024) -> DataFrame:
    """(group, at_rank): the value at position floor((n - 1) * share) of each group's sorted values, exact.
    Groups may be large and few: values are counted in buckets of equal width (partial aggregation),
    the bucket that holds the position is found from the counts, and only its values are ranked."""
    span = rows.groupBy(group).agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"), F.count(F.lit(1)).alias("__n"))
    step = F.when(F.col("__hi") > F.col("__lo"), F.floor((F.col(value) - F.col("__lo")) / (F.col("__hi") - F.col("__lo")) * buckets)).otherwise(0)
    placed = rows.select(group, value).join(span, group).withColumn("__b", step.cast("int"))
    counts = placed.groupBy(group, "__b", "__n").agg(F.count(F.lit(1)).alias("__c"))
    upto = F.sum("__c").over(Window.partitionBy(group).orderBy("__b"))  # at most buckets + 1 rows a group
    at = F.floor((F.col("__n") - 1) * share)
    mine = counts.withColumn("__upto", upto).where((F.col("__upto") > at) & (F.col("__upto") - F.col("__c") <= at)).select(group, "__b", (at - (F.col("__upto") - F.col("__c"))).alias("__at"))
    few = placed.join(mine, [group, "__b"]).groupBy(group, value, "__at").agg(F.count(F.lit(1)).alias("__c"))
    ranked = few.withColumn("__upto", F.sum("__c").over(Window.partitionBy(group).orderBy(value)))
    return ranked.where(F.col("__upto") > F.col("__at")).groupBy(group).agg(F.min(value).alias("at_rank"))
