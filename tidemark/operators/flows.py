"""Inputs and outputs of the main flows: indexing, clustering, anomaly events, ingestion and its ledger.

A scope is (version, provider, model): the columns in SCOPE of statuses, mentions and clusters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCOPE = ("version", "provider", "model")
INDEXED = ("success", "no_mentions")


def in_scope(rows: DataFrame, scope: dict[str, str]) -> DataFrame:
    """The rows of a scope; columns that the table lacks don't restrict it."""
    for name in SCOPE:
        if name in scope and name in rows.columns:
            rows = rows.where(F.col(name) == scope[name])
    return rows


def indexing_input(reviews: DataFrame, statuses: DataFrame, mentions: DataFrame, scope: dict[str, str], *, id_col: str = "review_id", include: tuple[str, ...] = INDEXED, limit: int | None = None) -> DataFrame:
    """Reviews whose status in the scope is included, with absa_status and their mentions as an array in
    the order of their codes (empty where there are none). With a limit, the smallest ids."""
    eligible = in_scope(statuses, scope).where(F.col("status").isin(*include)).select(id_col, F.col("status").alias("absa_status"))
    rows = reviews.join(eligible, id_col)
    if limit:
        rows = rows.orderBy(id_col).limit(limit)
    one = F.struct("code", "sentiment", "severity", "quote")
    # mentions are gathered by review: at most one for each aspect
    held = in_scope(mentions, scope).groupBy(id_col).agg(F.array_sort(F.collect_list(one)).alias("mentions"))
    none = F.array().cast(held.schema["mentions"].dataType)
    return rows.join(held, id_col, "left").withColumn("mentions", F.coalesce("mentions", none))


def indexing_counts(statuses: DataFrame, scope: dict[str, str], include: tuple[str, ...] = INDEXED) -> DataFrame:
    """How many statuses of the scope are eligible for the index and how many are skipped."""
    eligible = F.count_if(F.col("status").isin(*include))
    return in_scope(statuses, scope).agg(eligible.alias("eligible"), (F.count(F.lit(1)) - eligible).alias("skipped"))


def clustering_input(reviews: DataFrame, mentions: DataFrame, statuses: DataFrame, scope: dict[str, str], *, id_col: str = "review_id") -> DataFrame:
    """Negative mentions of reviews that were processed with success in the scope."""
    done = in_scope(statuses, scope).where("status = 'success'").select(id_col)
    negative = in_scope(mentions, scope).where("sentiment = 'negative'").select(id_col, "code", "severity", "quote")
    return negative.join(done, id_col, "left_semi").join(reviews, id_col)


def quote_of(mentions: DataFrame, *, id_col: str = "review_id") -> DataFrame:
    """The first quote that isn't empty for each review and aspect."""
    return mentions.where(F.coalesce("quote", F.lit("")) != "").groupBy(id_col, "code").agg(F.min("quote").alias("quote"))


def mention_events(members: DataFrame, clusters: DataFrame, reviews: DataFrame, mentions: DataFrame, scope: dict[str, str], *, id_col: str = "review_id") -> DataFrame:
    """One event for each clustered mention of the scope, with the cluster's label, the review's date and
    rating, and the mention's quote ('' without one)."""
    own = in_scope(clusters, scope).select("cluster_id", "label")
    rows = members.join(own, "cluster_id").join(reviews.select(id_col, "posted_at", "rating"), id_col)
    return rows.join(quote_of(mentions, id_col=id_col), [id_col, "code"], "left").withColumn("quote", F.coalesce("quote", F.lit("")))


def ordered_clusters(clusters: DataFrame, aspect: str = "code") -> DataFrame:
    """Adds position: clusters of an aspect by falling size, then label."""
    return clusters.withColumn("position", F.row_number().over(Window.partitionBy(aspect).orderBy(F.col("size").desc(), "label")))


def skipped(given: DataFrame, made: DataFrame, key: str) -> DataFrame:
    """Keys of the input that the output lacks."""
    return given.select(key).distinct().join(made.select(key).distinct(), key, "left_anti")


def cluster_summary(given: DataFrame, clusters: DataFrame, key: str = "code") -> DataFrame:
    """By aspect: mentions that came in, clusters, clustered mentions, and whether it was skipped."""
    came = given.groupBy(key).agg(F.count(F.lit(1)).alias("mentions"))
    made = clusters.groupBy(key).agg(F.count(F.lit(1)).alias("clusters"), F.sum("size").alias("clustered"))
    return came.join(made, key, "left").na.fill(0, ["clusters", "clustered"]).withColumn("skipped", F.col("clusters") == 0)


def opened_run(runs: DataFrame) -> DataFrame:
    """Ledger rows of batches (run_id, started_at) that begin: nothing counted yet."""
    none = F.lit(None).cast("long")
    finished = F.lit(None).cast(runs.schema["started_at"].dataType)
    return runs.select("run_id", "started_at", finished.alias("finished_at"), none.alias("rows_in"), none.alias("rows_loaded"), none.alias("rows_failed"), F.lit("running").alias("status"))


def closed_run(tagged: DataFrame, run: Column, started_at: Column, reason: str = "dq_reason", opened: DataFrame | None = None) -> DataFrame:
    """The ledger row of a batch: what came in, what was loaded, what failed, and how it ended. With the rows that were opened,
    a batch of which nothing came in is closed as well, as empty."""
    n, failed = F.count(F.lit(1)), F.count(reason)
    counts = tagged.groupBy(run.alias("run_id")).agg(F.min(started_at).alias("started_at"), F.max(started_at).alias("finished_at"), n.alias("rows_in"), (n - failed).alias("rows_loaded"), failed.alias("rows_failed"))
    if opened is not None:
        counts = opened.select("run_id", F.col("started_at").alias("__began")).join(counts, "run_id", "left").na.fill(0, ["rows_in", "rows_loaded", "rows_failed"])
        counts = counts.withColumns({"finished_at": F.coalesce("finished_at", "__began"), "started_at": F.col("__began")}).drop("__began")
    status = F.when(F.col("rows_in") == 0, "empty").when(F.col("rows_failed") == F.col("rows_in"), "failed").otherwise("success")
    return counts.select("run_id", "started_at", "finished_at", "rows_in", "rows_loaded", "rows_failed", status.alias("status"))


def without_ids(rows: DataFrame, ids: DataFrame, scope: dict[str, str], key: str) -> DataFrame:
    """The table without the listed ids in the scope; the same ids in other scopes stay."""
    here = [F.coalesce(F.col(name) == scope[name], F.lit(False)) for name in SCOPE if name in scope and name in rows.columns]
    inside = here[0] if here else F.lit(True)
    for c in here[1:]:
        inside = inside & c
    gone = ids.select(F.col(key).alias("__id")).distinct()
    return rows.join(gone, (F.col(key) == F.col("__id")) & inside, "left_anti")


def first_matching(rows: DataFrame, where: Column, position: str, limit: int | None = None) -> DataFrame:
    """Matching rows in file order; a limit counts matching rows only."""
    out = rows.where(where)
    return out.orderBy(position).limit(limit) if limit else out


def profile(candidates: DataFrame, items: DataFrame, reviews: DataFrame, gate: DataFrame, *, brand: str = "brand", sku: str = "sku", most: int = 20) -> tuple[DataFrame, DataFrame]:
    """A dataset's profile: candidates with items, reviews, whether recommended, why not and whether that is
    a warning; and the products with most reviews among recommended brands."""
    listed = candidates.select(brand).distinct().join(gate, brand, "left").na.fill(0, ["items", "reviews"])
    listed = listed.withColumn("included", F.coalesce("included", F.lit(False))).withColumn("reason", F.coalesce("reason", F.lit("not found in metadata")))
    warning = ~F.col("included") & F.col("reason").rlike("not found|too few|below thresholds")
    wanted = listed.where("included").select(brand)
    top = items.select(sku, brand).distinct().join(wanted, brand).join(reviews.select(sku), sku).groupBy(sku).agg(F.count(F.lit(1)).alias("review_count"))
    return listed.withColumn("warning", warning), top.orderBy(F.col("review_count").desc(), sku).limit(most)
