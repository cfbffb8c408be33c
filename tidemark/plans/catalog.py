"""The registered queries and their SQL.

Roles of the tables: a review is a lineitem (posted_at = l_shipdate, rating from the line number, its
sentiment from the return flag, its severity from the discount), a product is a part, its brand
p_brand and its aspect p_type; documents are review texts, embeddings their vectors.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import queries_analytics, queries_flows, queries_reviews, queries_text, queries_tools

MODULES = (queries_reviews, queries_analytics, queries_text, queries_flows, queries_tools)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for m in MODULES for k, v in m.REGISTRY.queries.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in MODULES for k, v in m.REGISTRY.sql.items()}
