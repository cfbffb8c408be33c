"""Text and vector retrieval for batches of queries, and fusion of rankings.

Rankings are long tables (query_id, doc_id, rank, score). Ties go to the smaller doc_id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import unit
from tidemark.operators import blocks, text_scan
from tidemark.operators.rankings import ranked
from tidemark.operators.text_index import TextIndex

RRF_K = 60


def bm25(docs: DataFrame, queries: DataFrame, *, limit: int | None = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """BM25Okapi with floored idf, for every query; query terms that repeat count again. Documents without
    a query term score 0: they fill up queries that have fewer than `limit` documents above 0. The documents are scanned for
    this call, or indexed if the queries are too many for that; keep a TextIndex where more calls follow."""
    found = text_scan.scan(docs, queries, limit=limit, id_col=id_col, text_col=text_col) if limit else None
    if found is not None:
        return found
    return TextIndex.build(docs, id_col=id_col, text_col=text_col).search(queries, limit=limit)


def dense(vectors: DataFrame, queries: DataFrame, *, limit: int = 10, where: Column | None = None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Exact cosine for a stated set of queries against all vectors; the filter goes below the scan. Blocks of queries
    and of vectors meet in a task each (`blocks`): the number of pairs is the product, but memory is bounded and what is shuffled
    is `limit` rows a query and block of vectors."""
    base = vectors if where is None else vectors.where(where)
    sound = lambda rows: rows.where(unit(F.col("v")).isNotNull())
    q, v = queries.select("query_id", F.col("vector").alias("v")), base.select(F.col(id_col).alias("doc_id"), F.col(vector_col).alias("v"))
    of_vectors, of_queries = blocks.counts(v, q)
    deal = lambda key, own, n, other, m: [F.pmod(F.xxhash64(key), F.lit(n)).cast("int").alias(own), F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias(other)]
    v = sound(v).select("doc_id", "v", *deal("doc_id", "vb", of_vectors, "qb", of_queries))
    q = sound(q).select("query_id", "v", *deal("query_id", "qb", of_queries, "vb", of_vectors))
    return ranked(blocks.nearest(v, q, limit, ("vb", "qb")), limit)


def rrf(rankings: list[DataFrame], weights: list[float] | None = None, k: int = RRF_K) -> DataFrame:
    """Reciprocal rank fusion: sum of w / (k + rank); ties by best rank, then id."""
    weights = weights or [1.0] * len(rankings)
    if len(weights) != len(rankings):
        raise ValueError("one weight for each ranking")
    parts = [r.select("query_id", "doc_id", "rank", (F.lit(float(w)) / (k + F.col("rank"))).alias("s")) for r, w in zip(rankings, weights, strict=True)]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    fused = union.groupBy("query_id", "doc_id").agg(F.sum("s").alias("score"), F.min("rank").alias("best_rank"))
    w = Window.partitionBy("query_id").orderBy(F.round("score", 9).desc(), "best_rank", "doc_id")
    return fused.withColumn("rank", F.row_number().over(w))


def first_then(first: DataFrame, second: DataFrame) -> DataFrame:
    """All of the first ranking in order, then what only the second has."""
    union = first.select("query_id", "doc_id", F.lit(0).alias("src"), "rank").unionByName(second.select("query_id", "doc_id", F.lit(1).alias("src"), "rank"))
    best = union.groupBy("query_id", "doc_id").agg(F.min(F.struct("src", "rank")).alias("o"))
    return best.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("o", "doc_id"))).drop("o")


def hybrid(lexical: DataFrame, vector: DataFrame, *, mode: str = "weighted", limit: int = 20, weights: tuple[float, float] = (0.5, 0.5)) -> DataFrame:
    """Fusion of a lexical and a dense ranking: rrf, weighted or lexical_first; score is 1 / fused rank."""
    if mode == "lexical_first":
        fused = first_then(lexical, vector)
    elif mode in ("rrf", "weighted"):
        fused = rrf([lexical, vector], list(weights) if mode == "weighted" else None)
    else:
        raise ValueError(f"no such mode: {mode}")
    return fused.where(F.col("rank") <= limit).select("query_id", "doc_id", "rank", (1.0 / F.col("rank")).alias("score"))


def search(mode: str, docs: DataFrame, vectors: DataFrame, queries: DataFrame, *, limit: int = 10, oversample: int = 50, **options: object) -> DataFrame:
    """One entry for all modes: dense, lexical, or one of hybrid's; queries have text and vector."""
    if mode == "dense":
        return dense(vectors, queries, limit=limit)
    if mode == "lexical":
        return bm25(docs, queries, limit=limit)
    return hybrid(bm25(docs, queries, limit=oversample), dense(vectors, queries, limit=oversample), mode=mode, limit=limit, **options)


def filter_after(ranking: DataFrame, payload: DataFrame, where: Column, *, limit: int) -> DataFrame:
    """Filter a ranking that is already cut, then cut again: rows that the first cut lost stay lost."""
    kept = ranking.join(payload, "doc_id").where(where)
    return kept.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("rank"))).where(F.col("rank") <= limit)
