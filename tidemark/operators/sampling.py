"""Deterministic samples: quotas by largest remainder, bottom-k by hash, round-robin holdouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.shared import kept


def largest_remainder(counts: DataFrame, targets: DataFrame, group: str, strata: list[str]) -> DataFrame:
    """Adds quota to (group, strata, n): the group's target shared by size; a group with no more rows than
    its target is taken whole."""
    g = Window.partitionBy(group)
    df = counts.join(targets.select(group, "target"), group).withColumn("__total", F.sum("n").over(g))
    exact = F.col("target") * F.col("n") / F.col("__total")
    df = df.withColumn("__floor", F.when(F.col("target") >= F.col("__total"), F.col("n")).otherwise(F.floor(exact)).cast("long"))
    df = df.withColumn("__rest", F.greatest(F.least("target", "__total") - F.sum("__floor").over(g), F.lit(0)))
    nth = F.row_number().over(g.orderBy((exact - F.floor(exact)).desc(), F.col("n").desc(), *strata))
    df = df.withColumn("quota", F.col("__floor") + F.when((F.col("target") < F.col("__total")) & (nth <= F.col("__rest")), 1).otherwise(0))
    return df.drop("__total", "__floor", "__rest")


def stratified(rows: DataFrame, quotas: DataFrame, keys: list[str], score: Column, tiebreak: list[str]) -> DataFrame:
    """The rows of each stratum with the smallest scores, as many as its quota."""
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(score, *tiebreak))
    # the largest quota is known first, so that tasks cut strata before they meet; quotas are computed once
    quotas = kept(quotas.select(*keys, "quota"), "quotas")
    most = quotas.agg(F.max("quota")).first()[0] or 0
    return rows.withColumn("__n", nth).where(F.col("__n") <= int(most)).join(quotas, keys).where(F.col("__n") <= F.col("quota")).drop("__n", "quota")


def seeded(seed: int, *columns: str) -> Column:
    """A score that depends on the seed and the columns alone."""
    return F.xxhash64(F.lit(seed), *columns)


def holdout(rows: DataFrame, *, group: str, level: str, order: list[str], limit: int) -> DataFrame:
    """Round-robin over (group by size, level): first the first row of every cell, then the second, ...
    Cells are cut to what the limit could reach before the rounds are put in one order."""
    size = rows.groupBy(group).agg(F.count(F.lit(1)).alias("__size"))
    ranked = size.withColumn("__g", F.row_number().over(Window.orderBy(F.col("__size").desc(), group))).drop("__size")
    nth = F.row_number().over(Window.partitionBy(group, level).orderBy(*order))
    df = rows.withColumn("round", nth).where(F.col("round") <= limit).join(F.broadcast(ranked), group)
    return df.orderBy("round", "__g", level).limit(limit).drop("__g")
