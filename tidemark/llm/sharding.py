"""Sharding by extendible hashing.

A directory is indexed by the first bits of a document's hash. It begins with one bucket of depth 0;
a bucket whose documents exceed the byte limit is split on its next bit, and only such a bucket, until
every shard fits.

Bytes are first summed by cells of D bits, which is enough for about sixteen cells a shard, so the
splits above that depth are decided from the cells alone: a cell's bucket is the shallowest of
its prefixes that fits. Documents in cells that are too large themselves are split bit by bit. The
hash is of id and text; rows that are the same in both are told apart by bits of their own after
it, so no group of copies, however large, stays in one shard.

A document larger than the limit is a shard of its own, marked oversized, after which it can't be split.
A null or empty text has 0 bytes. An empty table has no shards. Columns other than id and text don't
matter; shard_documents writes them all. It numbers the rows and joins by these numbers, so each row
goes to its own shard, and rows that share an id, or have none, may go to different ones.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, own_name

#: Cells up to which their buckets are broadcast (32 bytes each).
BROADCAST_CELLS = 200_000
BITS = 128


def _bits(x: Column) -> Column:
    return F.lpad(F.bin(x), 64, "0")


def assign(docs: DataFrame, *, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, shard (the bucket's bits), depth, shard_bytes, oversized."""
    return _assign(docs, limit, id_col, text_col, [])


def _assign(docs: DataFrame, limit: int, id_col: str, text_col: str, kept: list[str]) -> DataFrame:
    """assign, with the columns `kept` of the documents."""
    text = F.col(text_col)
    rows = docs.select(*kept, F.col(id_col).alias("doc_id"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), F.concat(_bits(F.xxhash64(F.col(id_col), text)), _bits(F.xxhash64(F.monotonically_increasing_id()))).alias("bits"))
    rows = materialize(rows, "sizes")  # from here on each row keeps its bits
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    d = min(60, max(8, ceil(log2(max(1.0, total / limit))) + 4))
    cell = F.substring("bits", 1, d)
    cells = materialize(rows.groupBy(cell.alias("cell")).agg(F.sum("n_bytes").alias("bytes")), "cells")
    levels = cells.select("cell", "bytes", F.explode(F.sequence(F.lit(0), F.lit(d))).alias("depth")).withColumn("shard", F.substring("cell", F.lit(1), F.col("depth")))
    buckets = levels.groupBy("depth", "shard").agg(F.sum("bytes").alias("shard_bytes"))
    fits = levels.drop("bytes").join(buckets.where(F.col("shard_bytes") <= limit), ["depth", "shard"])
    homes = fits.groupBy("cell").agg(F.min_by(F.struct("shard", "depth", "shard_bytes"), "depth").alias("home"))
    homes = materialize(cells.join(homes, "cell", "left").select("cell", "home.*"), "homes")
    sent = F.broadcast(homes) if homes.count() <= BROADCAST_CELLS else homes
    placed = rows.withColumn("cell", cell).join(sent, "cell")
    names = [*kept, "doc_id", "n_bytes", "shard", "depth", "shard_bytes"]
    out = placed.where("shard IS NOT NULL").select(*names, F.lit(False).alias("oversized"))
    left = placed.where("shard IS NULL").select(*kept, "doc_id", "n_bytes", "bits")
    while d < BITS and left.head(1):
        d += 1
        left = materialize(left.withColumn("shard", F.substring("bits", 1, d)), "left")
        sums = left.groupBy("shard").agg(F.sum("n_bytes").alias("shard_bytes"), F.count(F.lit(1)).alias("n"))
        # one document can't be split further
        done = sums.where((F.col("shard_bytes") <= limit) | (F.col("n") == 1))
        found = left.join(done, "shard").select(*kept, "doc_id", "n_bytes", "shard", F.lit(d).alias("depth"), "shard_bytes", (F.col("shard_bytes") > limit).alias("oversized"))
        out = out.unionByName(materialize(found, "split"))
        left = left.join(done.select("shard"), "shard", "left_anti").select(*kept, "doc_id", "n_bytes", "bits")
    return out


def directory(assigned: DataFrame) -> DataFrame:
    """The shards: bits, depth, bytes, documents."""
    return assigned.groupBy("shard", "depth").agg(F.sum("n_bytes").alias("shard_bytes"), F.count(F.lit(1)).alias("documents"))


def shard_documents(docs: DataFrame, path: str, *, limit: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the documents with one folder for each shard, each row to the shard that assign gives it.
    The folders are named by `shard`, with underscores after it if the table has such a column."""
    # the numbers are written, so that both sides of the join have the same; rows are kept whole
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")
    rows = materialize(docs.select(whole, F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("row")), "numbered")
    homes = _assign(rows, limit, "id", "text", ["row"]).select("row", "shard")
    name = own_name(docs, "shard")
    placed = rows.select("row", "whole").join(homes, "row").repartition("shard")
    placed.select("whole.*", F.col("shard").alias(name)).write.partitionBy(name).parquet(path)
