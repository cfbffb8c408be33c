"""A register of queries and the SQL they are compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

#: The reviews view in SQL, with the same columns as reviews().
REVIEWS_SQL = """reviews AS (
  SELECT l_orderkey AS order_id, l_partkey AS sku, l_suppkey AS seller, l_linenumber AS line, l_shipdate AS posted_at, l_quantity AS helpful,
    p_brand AS brand, p_type AS aspect, 1 + l_linenumber % 5 AS rating,
    CASE l_returnflag WHEN 'R' THEN 'negative' WHEN 'A' THEN 'positive' ELSE 'neutral' END AS sentiment,
    CASE WHEN l_returnflag = 'R' THEN CASE WHEN l_discount >= 0.075 THEN 'high' WHEN l_discount >= 0.035 THEN 'medium' WHEN l_discount >= 0.015 THEN 'low' END END AS severity
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""
REVIEW_KEY = ["order_id", "sku", "seller", "line", "posted_at"]


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def keep(f: Query) -> Query:
            self.queries[name] = f
            if sql:
                self.sql[name] = sql
            return f

        return keep


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def severity() -> Column:
    x = F.col("l_discount")
    return F.when(F.col("l_returnflag") == "R", F.when(x >= 0.075, "high").when(x >= 0.035, "medium").when(x >= 0.015, "low"))


def reviews(spark: SparkSession, d: str) -> DataFrame:
    li, part = table(spark, d, "lineitem"), table(spark, d, "part")
    flag = F.col("l_returnflag")
    return li.join(part, li["l_partkey"] == part["p_partkey"]).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku"),
        F.col("l_suppkey").alias("seller"),
        F.col("l_linenumber").alias("line"),
        F.col("l_shipdate").alias("posted_at"),
        F.col("l_quantity").alias("helpful"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("aspect"),
        (1 + F.col("l_linenumber") % 5).alias("rating"),
        F.when(flag == "R", "negative").when(flag == "A", "positive").otherwise("neutral").alias("sentiment"),
        severity().alias("severity"),
    )
