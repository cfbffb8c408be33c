"""Rankings as long tables (query_id, doc_id, rank, score). Ties go to the smaller doc_id."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ranked(scores: DataFrame, limit: int | None) -> DataFrame:
    # rounded, so that equal documents tie whatever the order in which their parts were added
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.round("score", 9).desc(), "doc_id"))
    out = scores.withColumn("rank", rank)
    return out.where(F.col("rank") <= limit) if limit else out


def recall(found: DataFrame, truth: DataFrame, k: int = 10) -> DataFrame:
    """One row: of the first k rows of each true ranking, the share that the first k found hold."""
    want = truth.where(F.col("rank") <= k).select("query_id", "doc_id")
    have = found.where(F.col("rank") <= k).select("query_id", "doc_id", F.lit(1).alias("__hit"))
    j = want.join(have, ["query_id", "doc_id"], "left")
    return j.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("__hit"), F.lit(0)).alias("hits"), F.coalesce(F.avg(F.coalesce("__hit", F.lit(0))), F.lit(1.0)).alias(f"recall_at_{k}"))
