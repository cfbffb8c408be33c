"""An inverted-file index of vectors for cosine search.

Vectors are assigned to the cells of a spherical k-means, which is fitted on a bounded sample, and written as a table
partitioned by cell, as unit vectors with their payload. Beside it stands one row a cell: its centroid, its size and
its radius (the largest angle of a vector to the centroid). A query probes its nearest cells: only their folders are
read, filters go below, and what is found is ranked by its exact cosine.

The radius bounds the cosine of anything in a cell. With exact=True the cells that this bound can't rule out,
given the k-th score of the probed ones, are read in a second step; the result then equals a scan of all vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.scalar import dot, unit
from tidemark.operators import blocks
from tidemark.operators.rankings import ranked
from tidemark.sources.shared import kept, shared_path

#: Sampled vectors a cell that the centroids are fitted on; bytes of centroids that a task may hold.
SAMPLE_PER_CELL, MOST_CENTROID_BYTES = 64, 256 << 20
SEED = 42


class VectorIndex:
    """The index at a path: vectors (cell, doc_id, unit, payload...) and cells (cell, centroid, n, radius)."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    @property
    def vectors(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/vectors")

    @property
    def cells(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/cells")

    @classmethod
    def build(cls, vectors: DataFrame, path: str | None = None, *, cells: int | None = None, id_col: str = "vec_id", vector_col: str = "embedding", payload: tuple[str, ...] = ()) -> VectorIndex:
        """Null, zero and non-finite vectors have no cosine and aren't indexed. cells: about the square root of the
        number of vectors unless given."""
        spark = vectors.sparkSession
        path = path or shared_path(spark, "vector-index")
        rows = vectors.select(F.col(id_col).alias("doc_id"), unit(F.col(vector_col)).alias("unit"), *payload).where("unit IS NOT NULL")
        rows = kept(rows, "units")
        n = rows.count()
        cells = max(1, cells or math.ceil(math.sqrt(n)))
        x = array_to_vector("unit")
        if n and cells > 1:
            share = min(1.0, 1.2 * SAMPLE_PER_CELL * cells / n)
            sample = rows.select(x.alias("features")) if share == 1.0 else rows.sample(share, SEED).select(x.alias("features"))
            model = KMeans(k=cells, seed=SEED, maxIter=8, initSteps=2, distanceMeasure="cosine").fit(sample)
            placed = model.transform(rows.withColumn("features", x)).withColumnRenamed("prediction", "cell").drop("features")
        else:
            placed = rows.withColumn("cell", F.lit(0))
        # a frequent cell is cut by id, so that no task writes it alone
        placed.repartitionByRange("cell", "doc_id").write.partitionBy("cell").parquet(f"{path}/vectors")
        index = cls(spark, path)
        if n == 0:
            spark.createDataFrame([], StructType([*placed.schema.fields])).write.mode("overwrite").parquet(f"{path}/vectors")
        index._describe()
        return index

    def _describe(self) -> None:
        """Centroids as means of what a cell holds, summed by place before the shuffle, and radii."""
        v = self.vectors.select("cell", "unit")
        sums = v.select("cell", F.posexplode("unit").alias("i", "x")).groupBy("cell", "i").agg(F.sum("x").alias("x"))
        mean = sums.groupBy("cell").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("sum"))
        mean = mean.select("cell", F.coalesce(unit(F.col("sum")), F.transform("sum", lambda _: F.lit(0.0))).alias("centroid"))
        angle = F.acos(F.least(F.greatest(dot(F.col("unit"), F.col("centroid")), F.lit(-1.0)), F.lit(1.0)))
        cells = v.join(mean, "cell").groupBy("cell").agg(F.first("centroid").alias("centroid"), F.count(F.lit(1)).alias("n"), F.max(angle).alias("radius"))
        cells.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/cells")

    def order(self, queries: DataFrame) -> DataFrame:
        """(query_id, cell, nth, bound): all cells for each query, nearest first, with the largest cosine that a vector
        of the cell can have. The centroids are sent to tasks; their size is checked."""
        held = self.cells.select("cell", "centroid", "radius")
        n, dim = held.count(), held.agg(F.coalesce(F.max(F.size("centroid")), F.lit(0))).first()[0]
        if n * dim * 8 > MOST_CENTROID_BYTES:
            raise ValueError(f"{n} centroids of {dim} components are more than a task may hold; build the index with fewer cells")
        got = held.orderBy("cell").collect()
        sent = self.spark.sparkContext.broadcast((np.array([r["cell"] for r in got], np.int32), np.array([r["centroid"] for r in got], np.float64).reshape(n, dim), np.array([r["radius"] for r in got])))

        def near(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            cells, centroids, radius = sent.value
            for pdf in frames:
                for lo in range(0, len(pdf), 64):
                    part = pdf.iloc[lo : lo + 64]
                    cos = np.clip(np.array(part["q"].to_list(), np.float64).reshape(len(part), -1) @ centroids.T, -1, 1)
                    bound = np.cos(np.maximum(np.arccos(cos) - radius, 0))
                    at = np.argsort(-cos, axis=1, kind="stable")
                    for i, query in enumerate(part["query_id"]):
                        yield pd.DataFrame({"query_id": query, "cell": cells[at[i]], "nth": np.arange(1, n + 1), "bound": bound[i, at[i]]})

        q = self._units(queries)
        kind = dict(q.dtypes)["query_id"]
        return q.where(F.size("q") == dim).mapInPandas(near, f"query_id {kind}, cell int, nth int, bound double")

    @staticmethod
    def _units(queries: DataFrame) -> DataFrame:
        return queries.select("query_id", unit(F.col("vector")).alias("q")).where("q IS NOT NULL")

    def scores(self, queries: DataFrame, probed: DataFrame, where: Column | None) -> DataFrame:
        """(query_id, doc_id, score) of everything in the probed cells; cells that nobody probes aren't read."""
        v = self.vectors if where is None else self.vectors.where(where)
        asked = probed.select("query_id", "cell").join(self._units(queries), "query_id")
        return v.select("cell", "doc_id", "unit").join(asked, "cell").select("query_id", "doc_id", dot(F.col("q"), F.col("unit")).alias("score"))

    def nearest(self, queries: DataFrame, probed: DataFrame, where: Column | None, limit: int) -> DataFrame:
        """(query_id, doc_id, score): for each query at least the first `limit` of the cells (query_id, cell) that it probes. Cells are
        dealt into blocks, large ones by parts; a query meets a block once, with all cells that it asks there."""
        held = self.cells.select("cell", "n")
        q = queries.select("query_id", F.col("vector").alias("v")).where(unit(F.col("v")).isNotNull())
        v = (self.vectors if where is None else self.vectors.where(where)).select("cell", "doc_id", F.col("unit").alias("v"))
        of_vectors, of_queries = blocks.counts(v, q)
        each = max(1, (held.agg(F.sum("n")).first()[0] or 0) // of_vectors)
        held = held.join(probed.select("cell").distinct(), "cell", "left_semi").select("cell", F.ceil(F.col("n") / each).cast("int").alias("parts"))
        at = lambda part: F.pmod(F.xxhash64("cell", part), F.lit(of_vectors)).cast("int").alias("vb")
        v = v.join(held, "cell").withColumn("part", F.pmod(F.xxhash64("doc_id"), "parts").cast("int"))
        v = v.select("cell", "doc_id", "v", at(F.col("part")), F.explode(F.sequence(F.lit(0), F.lit(of_queries - 1))).alias("qb"))
        asked = probed.join(held, "cell").select("query_id", "cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        asked = asked.select("query_id", "cell", at(F.col("part"))).groupBy("query_id", "vb").agg(F.collect_set("cell").alias("cells"))
        asked = asked.join(q, "query_id").withColumn("qb", F.pmod(F.xxhash64("query_id"), F.lit(of_queries)).cast("int"))
        return blocks.nearest(v, asked.select("query_id", "v", "cells", "vb", "qb"), limit, ("vb", "qb"), celled=True)

    def search(self, queries: DataFrame, *, limit: int = 10, probes: int = 8, where: Column | None = None, exact: bool = False) -> DataFrame:
        """The first `limit` vectors by cosine for each query (query_id, vector): of its `probes` nearest cells, or of all."""
        if not self.cells.take(1):
            return self.spark.createDataFrame([], StructType([queries.schema["query_id"], self.vectors.schema["doc_id"]]).add("score", "double").add("rank", "integer"))
        cells = kept(self.order(queries), "probes")
        first = ranked(self.nearest(queries, cells.where(F.col("nth") <= probes), where, limit), limit)
        if not exact:
            return first
        first = kept(first, "probed")
        floor = first.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("floor")).where(F.col("n") == limit).select("query_id", "floor")
        open_ = cells.where(F.col("nth") > probes).join(floor, "query_id", "left").where("floor IS NULL OR bound >= floor - 1e-7")
        return ranked(first.select("query_id", "doc_id", "score").unionByName(self.nearest(queries, open_, where, limit)), limit)

    def read_share(self, queries: DataFrame, probes: int) -> float:
        """Of all pairs of a query and a vector, the share that a search with so many probes compares."""
        cells = self.order(queries).where(F.col("nth") <= probes).join(self.cells.select("cell", "n"), "cell").agg(F.sum("n")).first()[0] or 0
        total = (self.cells.agg(F.sum("n")).first()[0] or 0) * queries.count()
        return cells / total if total else 0.0
