"""Embedding near-dedup with a pivot-permutation index.

A bounded, documented sample of the vectors serves as reference points (pivots). Every vector is
described by its `depth` nearest pivots in order of nearness. Inverted lists hold, for each label
and pivot, the vectors that describe themselves by it. Two vectors of a list are candidates if they
share at least `shared` pivots; candidates, and no others, are verified by cosine in double precision.
A pair is verified in the list of its first shared pivot only.

The number of pivots follows the number of vectors up to MOST_PIVOTS, so that lists stay about as long
up to 131,072 vectors; beyond, they grow with the table, and the comparisons with its square over the
number of pivots (raise `most_pivots` there: it is what each task holds). A
list is cut into blocks, and pairs of blocks are compared by matrix products, so no task holds a
whole list; a list that a third of all vectors falls in is only more block pairs. Blocks send back
counts of links and a spanning forest of them, not the pairs.

Equal vectors of a label are one vector with a count, so thousands of copies cost as much as one.

Vectors that are null, empty or zero, or that hold null or non-finite components, link with nothing,
as do those with a null label or id; of a null id component_id is null and kept true. Vectors of different lengths never link. Rows that share an id
are one node; its n_links counts those of its rows. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize
from tidemark.llm.components import components

#: Pivots: one for each 64 vectors, within these bounds; 2048 pivots of 1024 components take 16 MB.
LEAST_PIVOTS, MOST_PIVOTS = 64, 2048
BLOCK = 1024
FOUND = "a long, b long, n long"


def _unit(vectors: list[np.ndarray]) -> np.ndarray:
    x = np.array(vectors, np.float64)
    # scaled first, so that very large and very small components neither overflow nor vanish
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[list[int], list[int]]:
    """A spanning forest of the links a-b."""
    parent: dict[int, int] = {}

    def root(v: int) -> int:
        while (p := parent.setdefault(v, v)) != v:
            parent[v] = v = parent[p]
        return v

    x, y = [], []
    for i, j in zip(a.tolist(), b.tolist(), strict=True):
        ri, rj = root(i), root(j)
        if ri != rj:
            parent[max(ri, rj)] = min(ri, rj)
            x.append(i)
            y.append(j)
    return x, y


def _bits(pivots: np.ndarray) -> np.ndarray:
    """A bitmap of the pivots of each row, in words of 64."""
    out = np.zeros((len(pivots), (max(int(pivots.max(initial=0)), 0) >> 6) + 1), np.uint64)
    for column in pivots.T:
        at = np.flatnonzero(column >= 0)
        out[at, column[at] >> 6] |= np.uint64(1) << (column[at] & 63).astype(np.uint64)
    return out


def _block_pair(x: pd.DataFrame, y: pd.DataFrame, pivot: int, same: bool, least: float, shared: int) -> pd.DataFrame:
    px, py = np.stack(list(x["pivots"])), np.stack(list(y["pivots"]))
    # shared pivots are counted on bitmaps of each row's pivots (-1 pads rows that have fewer: no bit)
    bx, by = _bits(px), _bits(py)
    common, lower = np.zeros((len(px), len(py)), np.uint8), np.zeros((len(px), len(py)), bool)
    for word in range(max(bx.shape[1], by.shape[1])):
        if word < min(bx.shape[1], by.shape[1]) and bx[:, word].any() and by[:, word].any():
            both = bx[:, word, None] & by[None, :, word]
            common += np.bitwise_count(both)
            if word <= pivot >> 6:
                lower |= (both if word < pivot >> 6 else both & np.uint64((1 << (pivot & 63)) - 1)) > 0
    have = lambda p: np.minimum((p >= 0).sum(axis=1), shared)  # noqa: E731  of vectors with fewer pivots all have to be shared
    near = (common >= np.minimum(have(px)[:, None], have(py)[None, :])) & ~lower
    if same:
        near = np.triu(near, 1)
    # candidates alone are verified
    rows, cols = near.any(axis=1), near.any(axis=0)
    dots = np.zeros(near.shape)
    if rows.any():
        dots[np.ix_(rows, cols)] = _unit([v for v, r in zip(x["v"], rows, strict=True) if r]) @ _unit([v for v, c in zip(y["v"], cols, strict=True) if c]).T
    i, j = np.nonzero(near & (dots >= least))
    xi, yi, wx, wy = x["vec_id"].to_numpy(), y["vec_id"].to_numpy(), x["copies"].to_numpy(), y["copies"].to_numpy()
    n = pd.concat([pd.Series(wy[j]).groupby(xi[i]).sum(), pd.Series(wx[i]).groupby(yi[j]).sum()])
    n = n.groupby(level=0).sum()
    a, b = spanning(xi[i], yi[j])
    return pd.DataFrame({"a": [*n.index, *a], "b": [*([None] * len(n)), *b], "n": [*n.to_list(), *([0] * len(a))]}).astype({"a": "int64", "b": "Int64", "n": "int64"})


def link_vectors(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", least: float = 0.93, depth: int = 8, shared: int = 2, most_pivots: int = MOST_PIVOTS, seed: int = 5) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    v = F.col(vector_col)
    base = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), v.cast("array<double>").alias("v"))
    sound = F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0), F.lit(False))
    usable = base.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & sound)
    # equal vectors are one; -0.0 and 0.0 are the same component
    usable = usable.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))
    rows = usable.select("vec_id", "label", "v", F.sha2(F.concat_ws("\0", "label", F.transform("v", lambda x: x.cast("string"))), 256).alias("key"))
    rows = materialize(rows, "vectors")
    kinds = rows.groupBy("key").agg(F.min("vec_id").alias("head"), F.count_distinct("vec_id").alias("copies"))
    kinds = materialize(kinds, "kinds")
    heads = rows.join(kinds, "key").where("vec_id = head").groupBy("key", "label", "copies", "vec_id").agg(F.first("v").alias("v"))
    heads = materialize(heads, "heads")
    total = heads.count()
    wanted = min(most_pivots, max(LEAST_PIVOTS, total // 64))
    sample = heads.orderBy(F.xxhash64("vec_id", F.lit(seed))).select("v").limit(wanted).collect()
    by_size: dict[int, np.ndarray] = {}
    for size in {len(r["v"]) for r in sample}:
        by_size[size] = _unit([np.array(r["v"]) for r in sample if len(r["v"]) == size])
    pivots = spark.sparkContext.broadcast(by_size)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                found = []
                raw = [np.array(x) for x in part.column("v").to_pylist()]
                for x in raw:
                    p = pivots.value.get(len(x))
                    # vectors of a length that the sample lacks all share one stand-in pivot
                    near = np.argsort(-(p @ _unit([x])[0]), kind="stable")[:depth] if p is not None else np.array([0])
                    found.append(np.r_[near, np.full(depth - len(near), -1)].astype(np.int32))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("vec_id", "label", "copies", "v")), pa.array(found, pa.list_(pa.int32()))], ["vec_id", "label", "copies", "v", "pivots"])

    index = materialize(heads.select("vec_id", "label", "copies", "v").mapInArrow(describe, "vec_id long, label string, copies long, v array<double>, pivots array<int>"), "index")
    keyed = index.select("*", F.explode(F.filter("pivots", lambda p: p >= 0)).alias("pivot"), F.size("v").alias("dim"))
    lists = keyed.groupBy("label", "dim", "pivot").agg(F.count(F.lit(1)).alias("n"))
    keyed = keyed.join(lists, ["label", "dim", "pivot"]).withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")).withColumn("block", F.pmod(F.xxhash64("vec_id"), "blocks").cast("int"))
    # every block meets itself and every other once: rows go to each pair of blocks that theirs is in
    pair = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(o, F.col("block")).alias("lo"), F.greatest(o, F.col("block")).alias("hi")))
    keyed = keyed.withColumn("pair", F.explode(pair)).select("vec_id", "copies", "v", "pivots", "label", "dim", "pivot", "block", F.col("pair.lo").alias("lo"), F.col("pair.hi").alias("hi"))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        lo, hi, pivot = int(pdf["lo"].iloc[0]), int(pdf["hi"].iloc[0]), int(pdf["pivot"].iloc[0])
        x, y = pdf[pdf["block"] == lo], pdf[pdf["block"] == hi]
        if not len(x) or not len(y):
            return pd.DataFrame({"a": [], "b": [], "n": []}).astype({"a": "int64", "b": "Int64", "n": "int64"})
        parts = [_block_pair(x.iloc[i : i + 256], y.iloc[j : j + BLOCK], pivot, lo == hi and i == j, least, shared) for i in range(0, len(x), 256) for j in (range(0, len(y), BLOCK) if lo != hi else ())]
        if lo == hi:
            parts = [_block_pair(x.iloc[i : i + 256], y.iloc[j : j + 256], pivot, i == j, least, shared) for i in range(0, len(x), 256) for j in range(i, len(y), 256)]
        return pd.concat(parts)

    found = materialize(keyed.groupBy("label", "dim", "pivot", "lo", "hi").applyInPandas(compare, FOUND), "found")
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("head")).agg(F.sum("n").alias("n"))
    near = components(found.where("b IS NOT NULL").select("a", "b")).withColumnRenamed("node", "head")
    # each row to its head, then to the head's component
    own = rows.select("vec_id", "key").join(kinds, "key").join(counts, "head", "left").join(near, "head", "left")
    own = own.select("vec_id", "head", "key", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("label", "head").alias("label"))
    own = own.dropDuplicates(["vec_id", "key"]).groupBy("vec_id").agg(F.sum("n_links").alias("n_links"), F.min("label").alias("component_id"))
    out = base.select("vec_id").join(own, "vec_id", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
