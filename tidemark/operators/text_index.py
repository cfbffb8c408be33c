"""A persisted BM25 index: postings in blocks with their largest impact, and a search that reads only blocks that matter.

Documents are tokenized once, and their terms counted where they are read. A posting holds a document, how often it has the
term, and its length; its impact, the part of BM25 that depends on both, is tf (k1 + 1) / (tf + k1 (1 - b + b length / mean length)).
Documents are dealt by a hash of their id into ranges of about RANGE; the postings of a term in a range are a block, so
a term which a third of all documents hold is only more blocks. The one shuffle of a build is of postings to their blocks.
Blocks stand in folders by term; a small table names each block's largest impact. Rows that share an id are postings of their own.

Search in two steps. The sum of the largest impacts of a query's terms in a range bounds what a document of the range can score. The
ranges with the largest bounds are read first; the k-th best score there is a floor. Then the ranges whose bound reaches
it are read, and no others. In a range all terms of the query are read, so its scores are whole: the result equals
the scores of all documents.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.functions.scalar import tokens
from tidemark.operators.rankings import ranked
from tidemark.sources.shared import kept, shared_path

#: The parameters of BM25Okapi.
K1, B, EPSILON = 1.5, 0.75, 0.25
#: Documents of a range, about; folders of a table; ranges that the floor is taken from.
RANGE, FOLDERS, HEAD = 256, 16, 8
#: What scalar.tokens finds in a lower-cased text.
TOKEN = re.compile("[a-z0-9]+")


def postings(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, term, tf, dl): term counts by document; aggregated before it is shuffled."""
    t = docs.select(F.col(id_col).alias("doc_id"), tokens(F.col(text_col)).alias("t")).select("doc_id", F.size("t").alias("dl"), F.explode("t").alias("term"))
    return t.groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("tf"), F.first("dl").alias("dl"))


def counted(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, dl, term, tf), each document counted in the task that reads it."""
    t = docs.select(F.col(id_col).alias("doc_id"), F.lower(F.coalesce(F.col(text_col), F.lit(""))).alias("t"))
    cores = docs.sparkSession.sparkContext.defaultParallelism
    if t.rdd.getNumPartitions() < cores:  # a few small files
        t = t.repartition(cores)
    kinds = to_arrow_schema(StructType([t.schema["doc_id"]]).add("dl", "integer").add("term", "string").add("tf", "integer"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for lo in range(0, batch.num_rows, 256):
                at, dl, term, tf = [], [], [], []
                for i, text in enumerate(batch.column("t").slice(lo, 256).to_pylist(), lo):
                    words = TOKEN.findall(text)
                    n = Counter(words)
                    at += [i] * len(n)
                    dl += [len(words)] * len(n)
                    term += n.keys()
                    tf += n.values()
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(at, pa.int64())), pa.array(dl, pa.int32()), pa.array(term, pa.string()), pa.array(tf, pa.int32())], schema=kinds)

    return t.mapInArrow(count, f"doc_id {dict(t.dtypes)['doc_id']}, dl int, term string, tf int")


class TextIndex:
    """The index at a path: blocks (folder, term, range, n, docs, tfs, dls), tops (folder, term, range, top, n), terms (term,
    df, idf), documents (doc_id) and size (n, mean: documents and their mean length)."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self._mean: float | None = None

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    @classmethod
    def build(cls, docs: DataFrame, path: str | None = None, *, id_col: str = "doc_id", text_col: str = "text", size: int = RANGE, folders: int = FOLDERS) -> TextIndex:
        spark = docs.sparkSession
        path = path or shared_path(spark, "text-index")
        ids = docs.select(F.col(id_col).alias("doc_id"))
        ids.write.parquet(f"{path}/documents")
        index = cls(spark, path)
        n = index._table("documents").count()
        ranges = max(1, -(-n // size))
        placed = counted(docs, id_col, text_col).select("term", F.pmod(F.xxhash64("doc_id"), F.lit(ranges)).cast("int").alias("range"), F.struct((-F.col("tf")).alias("m"), "dl", "doc_id").alias("p"))
        blocks = placed.groupBy("term", "range").agg(F.array_sort(F.collect_list("p")).alias("p"))
        blocks = blocks.select(F.pmod(F.xxhash64("term"), F.lit(folders)).cast("int").alias("folder"), "term", "range", F.size("p").alias("n"), F.col("p.doc_id").alias("docs"), F.transform("p", lambda x: -x["m"]).alias("tfs"), F.col("p.dl").alias("dls"))
        # a task writes a file a folder of what it has: no second shuffle
        blocks.sortWithinPartitions("folder", "term", "range").write.partitionBy("folder").parquet(f"{path}/blocks")
        if not n:
            spark.createDataFrame([], blocks.schema).write.mode("overwrite").parquet(f"{path}/blocks")
        held = index._table("blocks")
        total = held.agg(F.sum(F.aggregate("tfs", F.lit(0).cast("long"), lambda s, x: s + x)).alias("t")).first()["t"] or 0
        spark.range(1).select(F.lit(n).alias("n"), F.lit(total / n if n else 0.0).alias("mean")).write.parquet(f"{path}/size")
        top = F.array_max(F.transform(F.arrays_zip("tfs", "dls"), lambda x: index._impact(x["tfs"], x["dls"])))
        held.select("folder", "term", "range", top.alias("top"), "n").write.parquet(f"{path}/tops")
        df = index._table("tops").groupBy("term").agg(F.sum("n").alias("df"))
        idf = df.select("term", "df", (F.log(F.lit(float(n)) - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)).alias("raw"))
        floor = idf.agg(F.avg("raw").alias("mean"))  # one row
        idf = idf.join(F.broadcast(floor)).select("term", "df", F.when(F.col("raw") < 0, EPSILON * F.col("mean")).otherwise(F.col("raw")).alias("idf"))
        idf.write.parquet(f"{path}/terms")
        return index

    def _impact(self, tf: Column, dl: Column) -> Column:
        if self._mean is None:
            self._mean = self._table("size").first()["mean"] or 1.0
        return tf * (K1 + 1) / (tf + K1 * (1 - B + B * dl / F.lit(self._mean)))

    def asked(self, queries: DataFrame) -> DataFrame:
        """(query_id, term, w, folder, range, top): the blocks of a query's terms with the term's weight; a repeated term counts
        again."""
        q = queries.select("query_id", F.explode(tokens(F.col("text"))).alias("term")).groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("qtf"))
        weighed = q.join(self._table("terms"), "term").select("query_id", "term", (F.col("qtf") * F.col("idf")).alias("w"))
        return weighed.join(self._table("tops").select("folder", "term", "range", "top"), "term")

    def bounds(self, asked: DataFrame) -> DataFrame:
        """(query_id, range, bound): the most that a document of a range can score."""
        return asked.groupBy("query_id", "range").agg(F.sum(F.greatest(F.col("w") * F.col("top"), F.lit(0.0))).alias("bound"))

    def scores(self, asked: DataFrame, ranges: DataFrame | None) -> DataFrame:
        """(query_id, doc_id, score) of the ranges (query_id, range), or of all, from the blocks of the query's terms alone."""
        need = asked.drop("top")
        if ranges is not None:
            need = need.join(ranges.select("query_id", "range"), ["query_id", "range"], "left_semi")
        # written: its size is known, so that Spark sends it to the blocks if it is small
        need = kept(need, "need")
        read = self._table("blocks").select("folder", "term", "range", "docs", "tfs", "dls").join(need, ["folder", "term", "range"])
        one = read.select("query_id", "w", F.explode(F.arrays_zip("docs", "tfs", "dls")).alias("p"))
        return one.groupBy("query_id", F.col("p.docs").alias("doc_id")).agg(F.sum(F.col("w") * self._impact(F.col("p.tfs"), F.col("p.dls"))).alias("score"))

    def needed(self, asked: DataFrame, limit: int) -> DataFrame:
        """The ranges (query_id, range) that documents among the first `limit` may stand in."""
        bounds = kept(self.bounds(asked), "bounds")
        nth = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("bound"), "range"))
        head = self.scores(asked, bounds.withColumn("nth", nth).where(F.col("nth") <= HEAD))
        at = ranked(head, limit).where(F.col("rank") == limit).select("query_id", F.col("score").alias("floor"))
        # less a little: scores that differ by less than 1e-9 are ties
        return bounds.join(at, "query_id", "left").where("floor IS NULL OR bound >= floor - 1e-8")

    def search(self, queries: DataFrame, *, limit: int | None = 10) -> DataFrame:
        """The first `limit` documents for each query (query_id, text) by BM25, or all with a term of it. Documents without a
        term of the query score 0: they fill up queries that have fewer than `limit` documents above 0."""
        asked = kept(self.asked(queries), "asked")
        if limit is None:
            return ranked(self.scores(asked, None), None)
        top = kept(ranked(self.scores(asked, self.needed(asked, limit)), limit).drop("rank"), "top")
        above = top.where(F.round("score", 9) > 0).groupBy("query_id").agg(F.count(F.lit(1)).alias("n"))
        needy = kept(queries.select("query_id").distinct().join(above.where(F.col("n") >= limit), "query_id", "left_anti"), "needy")
        # without a negative weight every document with a term is in `top` already; with one all scores are looked at
        odd = asked.where("w <= 0").select("query_id").distinct().join(needy, "query_id", "left_semi")
        scored = top.select("query_id", "doc_id").unionByName(self.scores(asked.join(odd, "query_id", "left_semi"), None).select("query_id", "doc_id"))
        scored = kept(scored.join(needy, "query_id", "left_semi").distinct(), "scored")
        most = scored.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
        # so many of the smallest ids hold `limit` that have no score
        few = self._table("documents").distinct().orderBy("doc_id").limit(limit + most)
        zero = needy.crossJoin(few).join(scored, ["query_id", "doc_id"], "left_anti").withColumn("score", F.lit(0.0))
        return ranked(top.unionByName(ranked(zero, limit).drop("rank")), limit)
