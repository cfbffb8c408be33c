"""Hard negatives by exact inner-product search with lists that the anchors of a cluster share.

Anchors are clustered by direction (spherical k-means, fitted on a bounded sample). For each cluster all rows are
put in one list, sorted once by an upper bound of their inner product with any anchor of the cluster: their length
times the cosine of (their angle to the centroid less the largest angle of an anchor to it). Every anchor walks
its cluster's list from the top and stops where the bound, times its own length, is below what it has found: all
that is left is then certified not to matter.

On Spark the lists are one range-sorted table, cut into slices of at most 2**SLICE_BITS rows. Anchors of a cluster are
dealt into chunks of about CHUNK by hash of their id. A chunk meets the first slice of its list, which sets each
anchor's floor; then, all at once, the slices whose bound some of its anchors can't rule out, and inside them blocks
of BLOCK rows in the order of the bound. A task holds one chunk and one slice, whatever a label, a cluster or a
frequent vector amounts to; a list is walked to its end by anchors that can't stop earlier, so nothing is missed.

Scores are inner products of integers: components become floor(256 x), x as double. Products are exact in doubles
below 2**53 and taken with Python's integers above; scores saturate at 2**62.

Defined results: rows with a null id or label, a null vector, or a component that is null or not finite (or isn't
after multiplication) take no part; rows that share an id are one, the least by label and vector; vectors of
different lengths have no score together; ties go to the smaller id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialize

#: Anchors that centroids are fitted on, at most; clusters of a vector length; rows of a slice (bits) and of a block; anchors of a chunk.
SAMPLE, CLUSTERS, SLICE_BITS, BLOCK, CHUNK = 4096, 16, 13, 2048, 4096
POSITIVES, NEGATIVES = 5, 3
LEAST = -(1 << 62)
FOUND = "anchor_id long, positive_id long, positive_score long, vec_id long, score long"
LIST = "cluster int, bound double, vec_id long, label string, q binary"
ANCHOR = "cluster int, angle double, norm double, vec_id long, label string, q binary"


def usable(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, label, v): the rows that take part, with integer components as doubles."""
    v = F.transform(F.col(vector_col), lambda x: F.lit(256.0) * x.cast("double"))
    base = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), v.alias("v"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    base = base.where("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL").where(F.coalesce(sound, F.lit(False)))
    # as doubles: a floor to long would overflow
    whole = F.transform("v", lambda x: F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x))
    one = base.select("vec_id", "label", whole.alias("v")).groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r"))
    return one.select("vec_id", "r.label", "r.v")


def centroids(sample: list[np.ndarray], clusters: int = CLUSTERS, rounds: int = 12, seed: int = 3) -> np.ndarray:
    """Directions of a spherical k-means, fitted on all of the sample."""
    x = np.array(sample, np.float64)
    x = x / np.maximum(np.abs(x).max(axis=1, keepdims=True, initial=0), 1e-300)
    x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    c = x[np.random.default_rng(seed).permutation(len(x))[:clusters]]
    for _ in range(rounds):
        at = (x @ c.T).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, at, x)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(size > 1e-12, sums / np.maximum(size, 1e-300), c)
    return c


def angles(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of rows, and their angles to directions (0 for a row of length 0)."""
    most = np.abs(x).max(axis=1, initial=0)
    scaled = x / np.where(most > 0, most, 1)[:, None]
    length = np.linalg.norm(scaled, axis=1)
    cos = (scaled @ c.T) / np.where(length > 0, length, 1)[:, None]
    with np.errstate(over="ignore"):
        return length * most, np.where(length[:, None] > 0, np.arccos(np.clip(cos, -1, 1)), 0.0)


def bounds(norm: np.ndarray, angle: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """What the inner product of a row with an anchor of length 1 can be at most; a little more, for rounding."""
    with np.errstate(invalid="ignore"):
        return np.nan_to_num(norm[:, None] * np.minimum(1.0, np.cos(np.clip(angle - spread, 0, np.pi)) + 1e-7), nan=np.inf, posinf=np.inf)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 2.0**53:
        return (a @ b.T).astype(np.int64)
    whole = lambda x: np.array([[int(v) for v in r] for r in x], dtype=object).reshape(x.shape)
    return np.array([[max(LEAST, min(-LEAST, int(v))) for v in r] for r in whole(a) @ whole(b).T], np.int64).reshape(len(a), len(b))


def best(member: np.ndarray, score: np.ndarray, ident: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k of each member: higher scores first, then smaller ids."""
    order = np.lexsort((ident, -score, member))
    m = member[order]
    begin = np.r_[True, m[1:] != m[:-1]] if len(m) else np.zeros(0, bool)
    nth = np.arange(len(m)) - np.maximum.accumulate(np.where(begin, np.arange(len(m)), 0)) if len(m) else np.arange(0)
    return order[nth < k]


def _vectors(column: pd.Series) -> np.ndarray:
    x = np.frombuffer(b"".join(column), np.float64)
    return x.reshape(len(column), len(x) // max(1, len(column)))


Found = Callable[[tuple, pd.DataFrame, pd.DataFrame], pd.DataFrame]


class Wanted:
    """What members look for in a slice: the first k rows of their own label, or, with windows, of other labels
    with a score in each of their windows. floors are scores below which nothing more is wanted."""

    def __init__(self, members: pd.DataFrame, k: int, slots: list[tuple[np.ndarray, np.ndarray]] | None) -> None:
        self.k, self.windows = k, slots is not None
        self.ids, self.labels = members["vec_id"].to_numpy(), members["label"].to_numpy()
        n = len(members)
        self.slots = slots or [(np.full(n, LEAST), np.full(n, -LEAST))]
        held = members["floors"].to_list()
        self.floors = [np.maximum(lo, np.array([f[j] if j < len(f) else LEAST for f in held], np.int64)) for j, (lo, _) in enumerate(self.slots)]
        self.found = [(np.zeros(0, np.int64),) * 3 for _ in self.slots]

    def floor(self) -> np.ndarray:
        """The least floor of each member's slots; a slot whose window is empty wants nothing."""
        return np.minimum.reduce([np.where(hi < lo, -LEAST, f) for f, (lo, hi) in zip(self.floors, self.slots, strict=True)])

    def take(self, who: np.ndarray, scores: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        same = self.labels[who][:, None] == labels[None, :]
        fit = ~same if self.windows else same & (self.ids[who][:, None] != ids[None, :])
        for j, (_, hi) in enumerate(self.slots):
            row, col = np.nonzero(fit & (scores >= self.floors[j][who][:, None]) & (scores <= hi[who][:, None]))
            if not len(row):
                continue
            m, s, i = (np.concatenate(x) for x in zip(self.found[j], (who[row], scores[row, col], ids[col]), strict=True))
            at = best(m, s, i, self.k)
            m, s, i = m[at], s[at], i[at]
            self.found[j] = (m, s, i)
            last = np.flatnonzero(np.bincount(m, minlength=len(self.ids))[m] == self.k)
            np.maximum.at(self.floors[j], m[last][self.k - 1 :: self.k], s[last][self.k - 1 :: self.k])


def walk(members: pd.DataFrame, rows: pd.DataFrame, wanted: Wanted) -> None:
    """Members walk a slice in the order of the bound, each until the bound rules out what is left."""
    rows = rows.sort_values(["bound", "vec_id"], ascending=[False, True])
    a, norm = _vectors(members["q"]), members["norm"].to_numpy()
    b, bound, ids, labels = _vectors(rows["q"]), rows["bound"].to_numpy(), rows["vec_id"].to_numpy(), rows["label"].to_numpy()
    for lo in range(0, len(rows), BLOCK):
        with np.errstate(over="ignore", invalid="ignore"):
            who = np.flatnonzero(~(norm * bound[lo] < wanted.floor()))
        if not len(who):
            return
        for part in np.array_split(who, -(-len(who) // 512)):
            wanted.take(part, products(a[part], b[lo : lo + BLOCK]), ids[lo : lo + BLOCK], labels[lo : lo + BLOCK])


def same_label(_: tuple, members: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    out = pd.DataFrame({"anchor_id": [], "positive_id": [], "positive_score": [], "vec_id": [], "score": []}, dtype="int64")
    if len(members) and len(rows):
        w = Wanted(members, POSITIVES, None)
        walk(members, rows, w)
        m, s, i = w.found[0]
        out = pd.DataFrame({"anchor_id": w.ids[m], "positive_id": i, "positive_score": s, "vec_id": i, "score": s})
    return out


def other_label(_: tuple, members: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    """Rows of other labels with 50 p <= 100 s <= 95 p, for each positive's score p."""
    out = [pd.DataFrame({"anchor_id": [], "positive_id": [], "positive_score": [], "vec_id": [], "score": []}, dtype="int64")]
    if len(members) and len(rows):
        scores = [list(x) for x in members["scores"]]
        slots = []
        for j in range(POSITIVES):
            p = np.array([x[j] if j < len(x) else -1 for x in scores], np.int64)
            # a negative score's window is empty; so is that of a positive that isn't there
            slots.append((np.where(p < 0, 0, p - p // 2), np.where(p < 0, -1, p - -(-p // 20))))
        w = Wanted(members, NEGATIVES, slots)
        walk(members, rows, w)
        ids = [list(x) for x in members["positives"]]
        for j, (m, s, i) in enumerate(w.found):
            out.append(pd.DataFrame({"anchor_id": w.ids[m], "positive_id": np.array([ids[x][j] for x in m], np.int64), "positive_score": np.array([scores[x][j] for x in m], np.int64), "vec_id": i, "score": s}))
    return pd.concat(out)


class SharedLists:
    """Anchors in clusters and chunks, and a list of all rows for each cluster, in slices."""

    def __init__(self, rows: DataFrame, anchor: Column, *, clusters: int = CLUSTERS, slice_bits: int = SLICE_BITS, chunk: int = CHUNK) -> None:
        """rows: of usable(); anchor: which of them are anchors."""
        spark = rows.sparkSession
        rows = materialize(rows, "vectors")
        own = rows.where(anchor)
        by_size: dict[int, list[np.ndarray]] = {}
        for r in own.orderBy(F.xxhash64("vec_id")).limit(SAMPLE).collect():
            by_size.setdefault(len(r["v"]), []).append(np.array(r["v"]))
        sent, base = {}, 0
        for n, sample in sorted(by_size.items()):
            c = centroids(sample, clusters)
            sent[n], base = (base, c), base + len(c)
        cast = spark.sparkContext.broadcast(sent)

        def cells(batch: pa.RecordBatch) -> Iterator[tuple]:
            """By vector length: places, vectors, and number of the first centroid with the centroids. A length that the sample
            lacks has one cluster of its own, with no direction."""
            raw = batch.column("v").to_pylist()
            for n in {len(x) for x in raw}:
                at = np.array([i for i, x in enumerate(raw) if len(x) == n])
                x = np.array([raw[i] for i in at], np.float64).reshape(len(at), n)
                first, c = cast.value.get(n, (-1 - n, np.zeros((1, n))))
                yield at, x, first, c

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at, x, first, c in cells(batch):
                    norm, angle = angles(x, c)
                    k = angle.argmin(axis=1)
                    yield pa.RecordBatch.from_arrays([pa.array((first + k).astype(np.int32)), pa.array(angle[np.arange(len(at)), k]), pa.array(norm), batch.column("vec_id").take(pa.array(at)), batch.column("label").take(pa.array(at)), pa.array([r.tobytes() for r in x], pa.binary())], ["cluster", "angle", "norm", "vec_id", "label", "q"])

        placed = materialize(own.mapInArrow(assign, ANCHOR), "assigned")
        # one row a cluster: no more than there are centroids, and vector lengths
        sizes = placed.groupBy("cluster").agg(F.max("angle").alias("spread"), F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("chunks"))
        spreads = {r["cluster"]: r["spread"] for r in sizes.collect()}
        shared = spark.sparkContext.broadcast(spreads)
        chunked = placed.join(sizes.select("cluster", "chunks"), "cluster").withColumn("chunk", F.pmod(F.xxhash64("vec_id"), "chunks").cast("int"))
        self.anchors = materialize(chunked.drop("chunks", "angle"), "anchors")

        def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for begin in range(0, whole.num_rows, 1024):
                    batch = whole.slice(begin, 1024)
                    for at, x, first, c in cells(batch):
                        norm, angle = angles(x, c)
                        q, ids, labels = pa.array([r.tobytes() for r in x], pa.binary()), batch.column("vec_id").take(pa.array(at)), batch.column("label").take(pa.array(at))
                        for k in range(len(c)):
                            if (spread := shared.value.get(first + k)) is not None:
                                bound = bounds(norm, angle[:, k : k + 1], np.array([spread]))[:, 0]
                                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), first + k, np.int32)), pa.array(bound), ids, labels, q], ["cluster", "bound", "vec_id", "label", "q"])

        lists = rows.mapInArrow(listed, LIST).repartitionByRange("cluster", F.desc("bound"), "vec_id").sortWithinPartitions("cluster", F.desc("bound"), "vec_id")
        self.lists = materialize(lists.withColumn("slice", F.shiftright(F.monotonically_increasing_id(), slice_bits)), "lists")
        tops = self.lists.groupBy("cluster", "slice").agg(F.max("bound").alias("top"))
        self.slices = materialize(tops.withColumn("first", F.min("slice").over(Window.partitionBy("cluster"))), "slices")

    def meet(self, members: DataFrame, slices: DataFrame, found: Found) -> DataFrame:
        """Chunks of members (with floors) at slices of their list that some of them can't rule out."""
        chunks = self.anchors.select("cluster", "chunk").distinct()
        there = members.join(slices.join(chunks, "cluster"), ["cluster", "chunk"])
        # the least of a member's floors; without a full set of rows it has none
        low = F.array_min("floors")
        there = there.where(~(F.col("norm") * F.col("top") < low)).drop("top", "first")
        key = ["cluster", "chunk", "slice"]
        # under names of its own: the two sides come from the same tables
        asked = there.select(*[F.col(x).alias(f"at_{x}") for x in key]).distinct()
        rows = self.lists.join(asked, (F.col("cluster") == F.col("at_cluster")) & (F.col("slice") == F.col("at_slice"))).drop("cluster", "slice")
        return there.groupBy(*key).cogroup(rows.groupBy(*[f"at_{x}" for x in key])).applyInPandas(found, FOUND)

    def search(self, members: DataFrame, keys: list[str], k: int, found: Found) -> DataFrame:
        """The first k rows for each of the keys: the first slice of each list, then what it leaves open."""
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
        first_k = lambda df: df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        head = materialize(first_k(self.meet(members, self.slices.where("slice = first"), found)).drop("rank"), "head")
        slots = F.size("scores") if "scores" in members.columns else F.lit(1)
        full = head.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("floor")).where(F.col("n") == k)
        if "scores" in members.columns:
            floors = full.groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("positive_id", "floor"))).alias("f"))
            one = lambda p, lo: F.greatest(F.coalesce(F.try_element_at("f", p), lo), lo)
            lows = F.transform(F.arrays_zip("positives", "floors"), lambda x: one(x["positives"], x["floors"]))
        else:
            floors = full.select("anchor_id", "floor")
            lows = F.array(F.coalesce("floor", F.lit(LEAST)))
        more = members.join(floors.withColumnRenamed("anchor_id", "vec_id"), "vec_id", "left").where(slots > 0)
        more = more.withColumn("floors", lows).drop("f", "floor")
        rest = self.meet(more, self.slices.where("slice <> first"), found)
        return first_k(head.unionByName(rest))

    def positives(self) -> DataFrame:
        """(anchor_id, vec_id, score, rank): the first rows of an anchor's own label, itself not counted."""
        members = self.anchors.withColumn("floors", F.array(F.lit(LEAST).cast("long")))
        return self.search(members, ["anchor_id"], POSITIVES, same_label).select("anchor_id", "vec_id", "score", "rank")

    def negatives(self, positives: DataFrame) -> DataFrame:
        """(anchor_id, positive_id, positive_score, vec_id, score, rank)."""
        # a score below 0 has an empty window
        p = positives.where("score >= 0").groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("p"))
        p = p.select(F.col("anchor_id").alias("vec_id"), F.col("p.vec_id").alias("positives"), F.col("p.score").alias("scores"), F.transform("p", lambda x: x["score"] - F.shiftright(x["score"], 1)).alias("floors"))
        return self.search(self.anchors.join(p, "vec_id"), ["anchor_id", "positive_id"], NEGATIVES, other_label)


def mine(rows: DataFrame, anchor: Column, **options: int) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    lists = SharedLists(rows, anchor, **options)
    found = lists.negatives(materialize(lists.positives(), "positives"))
    return found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def relabelled(vectors: DataFrame) -> DataFrame:
    """Every seventh vector with the next label."""
    return vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
