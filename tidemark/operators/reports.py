"""Reporting aggregates: counts, zero-filled categories, matrices, rankings, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import snippet


def counts(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def zero_filled(df: DataFrame, key: str, values: list[str], null_as: str | None = None) -> DataFrame:
    """Counts by category; listed values show 0 without rows, others that occur are added."""
    k = F.coalesce(F.col(key), F.lit(null_as)) if null_as else F.col(key)
    found = df.select(k.alias(key)).where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    dims = df.sparkSession.createDataFrame([(v,) for v in values], f"{key} string")
    return dims.join(found, key, "full_outer").select(key, F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def matrix(df: DataFrame, row: str, column: str, values: list[str]) -> DataFrame:
    """Counts by row and column, zero where nothing is, with totals and the share of the last column."""
    wide = df.groupBy(row).agg(*[F.count_if(F.col(column) == v).alias(v) for v in values])
    total = sum((F.col(v) for v in values), F.lit(0))
    return wide.withColumn("total", total).withColumn("negative_share", F.coalesce(F.round(F.col(values[-1]) / F.nullif(F.col("total"), F.lit(0)), 4), F.lit(0.0)))


def star(fact: DataFrame, *dims: tuple[DataFrame, str, str]) -> DataFrame:
    """Inner joins of a fact to dimensions (table, fact key, own key); which side is sent is left to the
    planner, which knows the sizes."""
    out = fact
    for dim, left, right in dims:
        out = out.join(dim, out[left] == dim[right])
    return out


def top(df: DataFrame, limit: int, *order: Column | str) -> DataFrame:
    return df.orderBy(*order).limit(limit)


def latest(df: DataFrame, at: str, key: str, limit: int = 1) -> DataFrame:
    return df.orderBy(F.col(at).desc(), key).limit(limit)


def examples(df: DataFrame, where: Column, *, at: str, tiebreak: list[str], text: str | None = None, limit: int = 50) -> DataFrame:
    """The newest rows that match."""
    out = df.where(where).orderBy(F.col(at).desc(), *tiebreak).limit(limit)
    return out.withColumn(text, snippet(F.col(text))) if text else out


def members(cluster_rows: DataFrame, mentions: DataFrame, keys: list[str], *, order: list[str], prefer: str, limit: int, dedup_first: bool = False) -> DataFrame:
    """Members of a cluster with a mention each. The limit is applied to the joined rows before they are
    deduplicated, as the dashboard does it; dedup_first gives the corrected order."""
    j = cluster_rows.join(mentions, keys, "left")
    w = Window.partitionBy(*keys).orderBy(F.col(prefer).asc_nulls_last())
    one = lambda d: d.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")
    return one(j).orderBy(*order).limit(limit) if dedup_first else one(j.orderBy(*order, F.col(prefer).asc_nulls_last()).limit(limit))


def first_per(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """The first value of each key that isn't blank, by order."""
    return df.where(F.trim(value) != "").groupBy(*keys).agg(F.min_by(value, order).alias(value))


def coverage(statuses: DataFrame, mentions: DataFrame, total: DataFrame) -> DataFrame:
    """Two rates that are called coverage: successes by all reviews, and reviews with a mention by those
    processed."""
    s = statuses.agg(F.count(F.lit(1)).alias("processed"), F.count_if(F.col("status") == "success").alias("successes"))
    m = mentions.agg(F.count_distinct("review_id").alias("with_mentions"))
    t = total.agg(F.count(F.lit(1)).alias("reviews"))
    rate = lambda a, b: F.coalesce(F.round(F.col(a) / F.nullif(F.col(b), F.lit(0)), 4), F.lit(0.0))
    one = s.join(F.broadcast(m)).join(F.broadcast(t))  # three rows in all
    return one.select("reviews", "processed", "successes", "with_mentions", rate("successes", "reviews").alias("success_coverage"), rate("with_mentions", "processed").alias("mention_coverage"))


def non_empty(tables: dict[str, DataFrame]) -> DataFrame:
    """Health check: rows of each table, and whether there are any."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table"), "n", (F.col("n") > 0).alias("ok"))
        out = one if out is None else out.unionByName(one)
    return out
