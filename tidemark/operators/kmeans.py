"""K-means on sparse rows for all groups and starts at once.

Terms of a group are dealt into slices by hash, slices into bands, and rows into parts. A band holds all entries of its terms and
stays where it is, on the disk of an executor. It adds up the sums of its terms from the clusters that all rows are in, slice by
slice, and gives each row its share of the products with these sums; what it meets is a byte a row and start. Terms themselves don't
travel. Terms of a single row meet no other: those of a row are one entry, or one square in its part. A part adds the shares of its rows and
finds the nearest clusters and costs by start, or, while seeding, its candidates for the next seeds. So an iteration is a job
of two shuffles, however many groups there are; the driver sees nothing but whether a cost still fell. A slice has a bounded number of
entries but for those of one term, a part a bounded number of rows; of starts so many go together that the products of a group's rows
fit in a task (one start takes 64 bytes a row of eight clusters). The shares are a number a row, band, start and cluster: what is
shuffled in an iteration grows with the rows times the bands of a group.

Seeds are drawn as in k-means++, with a probability in proportion to the squared distance to the nearest so far, by the
smallest of -ln(u) / distance, where u is a hash of row, start and round; one, one, then two, four and so on in a
round. A start takes as many seeds as the group has different rows, at most. A cluster that loses all rows is given up. Ties go to the smaller cluster.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.term_blocks import joined, mix64, numbers, table
from tidemark.sources.shared import kept

#: Entries of a slice and rows of a part, about; slices of a band; bytes that a group's products may take in a task.
PART_ENTRIES, PART_ROWS, BAND_SLICES, ROOM = 1 << 21, 4096, 12, 1 << 27
#: Numbers of one product of rows and sums.
CELLS = 1 << 17
MOST_ITERATIONS, SEED = 20, 42
#: Entries of a part in a slice: numbers of rows in the part, numbers of terms in the slice, weights, in the order of rows.
SLICE = "g string, slice int, part long, terms int, row binary, code binary, w binary"
#: A part: hashes and squares of its rows, squares of terms that are theirs alone, and their clusters by start (a byte each, -1: none).
STATE = "g string, part long, h binary, square binary, own binary, at binary"
#: What a band gives a part: products of its rows; squares of the sums and counts of rows by start and cluster.
SHARE = "g string, part long, band int, dots binary, squares binary, n binary"
STEP = STATE + ", cost array<double>"
RACE = "g string, part long, i int, start int, race double"


def uniform(h: np.ndarray, start: int, turn: int, seed: int) -> np.ndarray:
    """Numbers in (0, 1) that depend on a row's hash, the start, the round and the seed."""
    salt = np.uint64((seed * 1_000_003 + start * 1009 + turn) & (2**64 - 1))
    return ((mix64(mix64(h.astype(np.int64).view(np.uint64)) ^ mix64(np.array([salt]))) >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53


def _slice(key: tuple, rows: pa.Table) -> pa.Table:
    """The entries of a slice, a row for each part."""
    code = rows.column("term").combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int64)
    at = (rows.column("part").to_numpy().astype(np.int64) << 32) | rows.column("i").to_numpy()
    w = rows.column("w").to_numpy()
    # terms of one row are one entry of the same square
    alone = np.bincount(code)[code] == 1
    own, place = np.unique(at[alone], return_inverse=True)
    at, w, code = np.r_[at[~alone], own], np.r_[w[~alone], np.sqrt(np.bincount(place, w[alone] ** 2, len(own)))], np.r_[code[~alone], code.max() + 1 + np.arange(len(own))]
    used, code = np.unique(code, return_inverse=True)
    order = np.lexsort((code, at))
    at, code, w = at[order], code[order].astype(np.int32), w[order]
    part, row = at >> 32, (at & 0xFFFFFFFF).astype(np.uint16)
    first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
    return table([(key[0].as_py(), key[1].as_py(), int(part[lo]), len(used), row[lo:hi].tobytes(), code[lo:hi].tobytes(), w[lo:hi].tobytes()) for lo, hi in zip(first, [*first[1:], len(part)], strict=True)], SLICE)


def _products(sums: np.ndarray, row: np.ndarray, code: np.ndarray, w: np.ndarray, to: np.ndarray) -> None:
    """Adds to each row the weighted sums of its terms; rows of one number of entries at a time."""
    first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    n = np.diff(np.r_[first, len(row)])
    order = np.argsort(n, kind="stable")
    for c, lo, hi in zip(*(x.tolist() for x in np.unique(n[order], return_index=True)), [*np.flatnonzero(np.diff(n[order])) + 1, len(n)], strict=True):
        step = max(1, CELLS // (c * sums.shape[1]))
        for at in range(lo, hi, step):
            begin = first[order[at : min(at + step, hi)]]
            cells = begin[:, None] + np.arange(c)
            to[row[begin]] += np.matmul(w[cells][:, None, :], sums.take(code[cells], axis=0))[:, 0]


def _shares(starts: int, k: int) -> Callable:
    def run(_: tuple, bands: pa.Table, states: pa.Table) -> pa.Table:
        if not bands.num_rows or not states.num_rows:
            return table([], SHARE)
        states = states.sort_by("of")
        parts = states.column("of").to_pylist()
        at = joined(states.column("at"), np.int8).reshape(-1, starts)
        end = np.cumsum([len(x.as_buffer()) // starts for x in states.column("at")])
        begin = dict(zip(parts, [0, *end[:-1].tolist()], strict=True))
        counts = np.stack([np.bincount(at[:, s].astype(np.int64) + 1, minlength=k + 1)[1:] for s in range(starts)]).astype(np.float64)
        # clusters from the first on; while seeding there are few
        used = int(np.flatnonzero(counts.any(axis=0)).max(initial=-1)) + 1
        dots, squares = np.zeros((len(at), starts, used)), np.zeros((starts, k))
        slices, of = bands.column("slice").to_numpy(), bands.column("part").to_numpy()
        for s in np.unique(slices) if used else []:
            cells = np.flatnonzero(slices == s)
            cells = cells[np.argsort(of[cells])].tolist()
            terms = bands.column("terms")[cells[0]].as_py()
            row = np.concatenate([numbers(bands.column("row")[x], np.uint16).astype(np.int64) + begin[of[x]] for x in cells])
            code = np.concatenate([numbers(bands.column("code")[x], np.int32) for x in cells]).astype(np.int64)
            w = np.concatenate([numbers(bands.column("w")[x], np.float64) for x in cells])
            sums = np.empty((terms, starts, used))
            for start in range(starts):
                j = at[:, start].astype(np.int64)[row]
                cell, x = code * used + j, w
                if counts[start].sum() < len(at):
                    cell, x = cell[j >= 0], w[j >= 0]
                sums[:, start] = np.bincount(cell, x, used * terms).reshape(terms, used)
            squares[:, :used] += np.einsum("tsk,tsk->sk", sums, sums)
            _products(sums.reshape(terms, -1), row, code, w, dots.reshape(len(at), -1))
        if states.column("own")[0].is_valid:
            # terms of one row, in one band of the group
            own = joined(states.column("own"), np.float64)
            for start in range(starts):
                j = at[:, start].astype(np.int64)
                i = np.flatnonzero(j >= 0)
                dots[i, start, j[i]] += own[i]
                squares[start] += np.bincount(j[i], own[i], k)
        g, band = bands.column("g")[0].as_py(), bands.column("band")[0].as_py()
        shares = table([(g, p, band, None, squares.tobytes(), counts.tobytes()) for p in parts], SHARE)
        ends = pa.py_buffer((np.r_[0, end] * starts * used * 8).astype(np.int32))
        return shares.set_column(3, "dots", pa.chunked_array([pa.Array.from_buffers(pa.binary(), len(parts), [None, ends, pa.py_buffer(dots)])]))

    return run


def _distances(state: pa.Table, shares: pa.Table, starts: int, k: int) -> np.ndarray:
    """Squared distances of a part's rows to the clusters by start; infinite where there is none."""
    square = numbers(state.column("square")[0], np.float64)
    dots, squares, n = np.zeros((len(square), starts, k)), np.zeros((starts, k)), np.zeros((starts, k))
    for row in np.argsort(shares.column("band").to_numpy()):
        at = {c: numbers(shares.column(c)[int(row)], np.float64) for c in ("dots", "squares", "n")}
        if len(at["dots"]):
            some = at["dots"].reshape(len(square), starts, -1)
            dots[:, :, : some.shape[2]] += some
        squares, n = squares + at["squares"].reshape(starts, k), at["n"].reshape(starts, k)
    with np.errstate(divide="ignore", invalid="ignore"):
        found = square[:, None, None] + squares / (n * n) - 2 * dots / n
    # rounded, so that equal distances tie whatever the order in which their shares were added
    return np.where(n > 0, np.round(np.maximum(found, 0), 12), np.inf)


def _raced(state: pa.Table, key: tuple, near: np.ndarray | None, first: int, starts: int, turn: int, seed: int, wanted: int) -> pa.Table:
    h = numbers(state.column("h")[0], np.int64)
    out = []
    for s in range(starts):
        d = np.ones(len(h)) if near is None else near[:, s]
        with np.errstate(divide="ignore"):
            race = np.where(d > 1e-12, -np.log(uniform(h, first + s, turn, seed)) / d, np.inf)
        out += [(key[0].as_py(), key[1].as_py(), int(i), s, race[i]) for i in np.argsort(race, kind="stable")[:wanted] if np.isfinite(race[i])]
    return table(out, RACE)


def _seeding(first: int, starts: int, k: int, turn: int, seed: int, wanted: int) -> Callable:
    def run(key: tuple, state: pa.Table, shares: pa.Table) -> pa.Table:
        return _raced(state, key, _distances(state, shares, starts, k).min(axis=2), first, starts, turn, seed, wanted)

    return run


def _first(first: int, starts: int, seed: int) -> Callable:
    return lambda key, state: _raced(state, key, None, first, starts, 0, seed, 1)


def _seeded(starts: int) -> Callable:
    def run(_: tuple, state: pa.Table, seeds: pa.Table) -> pa.Table:
        """The state with the rows that are seeds in their clusters."""
        at = numbers(state.column("at")[0], np.int8).reshape(-1, starts).copy()
        i, start, nth = (seeds.column(c).to_numpy() for c in ("i", "start", "nth"))
        at[i, start] = nth
        return state.set_column(state.column_names.index("at"), "at", pa.chunked_array([pa.array([at.tobytes()], pa.binary())]))

    return run


def _step(starts: int, k: int) -> Callable:
    def run(key: tuple, state: pa.Table, shares: pa.Table) -> pa.Table:
        d = _distances(state, shares, starts, k)
        cells = [state.column(c)[0].as_py() for c in ("h", "square", "own")]
        return table([(key[0].as_py(), key[1].as_py(), *cells, d.argmin(axis=2).astype(np.int8).tobytes(), d.min(axis=2).sum(axis=0).tolist())], STEP)

    return run


def _part(key: tuple, rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("i")
    cells = [rows.column(c).to_numpy().astype(t).tobytes() for c, t in (("h", np.int64), ("square", np.float64))]
    return table([(key[0].as_py(), key[1].as_py(), *cells, np.zeros(rows.num_rows).tobytes(), None)], STATE)


def _unfolded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(g, part, i, cluster) of (g, part, at)."""
    for batch in batches:
        for g, part, at in zip(batch.column("g").to_pylist(), batch.column("part").to_pylist(), batch.column("at"), strict=True):
            c = numbers(at, np.int32)
            rows = [pa.array([x] * len(c), t) for x, t in ((g, pa.string()), (part, pa.int64()))]
            yield pa.RecordBatch.from_arrays([*rows, pa.array(np.arange(len(c), dtype=np.int32)), pa.array(c)], ["g", "part", "i", "cluster"])


def unfolded(parts: DataFrame) -> DataFrame:
    return parts.select("g", "part", "at").mapInArrow(_unfolded, "g string, part long, i int, cluster int")


def _of_start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(g, part, at) of the start of a row: clusters as ints."""
    for batch in batches:
        rows = zip(*[batch.column(c).to_pylist() for c in ("g", "part", "at", "start", "starts")], strict=True)
        yield from table([(g, p, np.frombuffer(at, np.int8).reshape(-1, starts)[:, start].astype(np.int32).tobytes()) for g, p, at, start, starts in rows], "g string, part long, at binary").to_batches()


class KMeans:
    """rows: (g, id, term, w), a row without terms once with a null term; clusters: (g, k), at most `most`."""

    def __init__(self, rows: DataFrame, clusters: DataFrame, *, most: int, starts: int, seed: int = SEED, iterations: int = MOST_ITERATIONS) -> None:
        rows = rows.select("g", "id", F.coalesce("term", F.lit("")).alias("term"), F.coalesce("w", F.lit(0.0)).alias("w"))
        size = rows.groupBy("g").agg(F.count(F.lit(1)).alias("e"), F.approx_count_distinct("id").alias("n"))
        sizes = kept(size.select("g", F.ceil(F.col("e") / PART_ENTRIES).cast("int").alias("slices"), F.ceil(F.col("n") / PART_ROWS).cast("int").alias("parts")), "sizes")
        h = F.xxhash64("id")
        of = rows.groupBy("g", "id").agg(F.sum(F.col("w") * F.col("w")).alias("square")).join(F.broadcast(sizes), "g")
        of = of.select("g", "id", h.alias("h"), "square", F.pmod(h, "parts").alias("part"))
        nth = F.row_number().over(Window.partitionBy("g", "part").orderBy("id"))
        ids = kept(of.withColumn("i", (nth - 1).cast("int")), "ids")
        state = kept(ids.select("g", "part", "i", "h", "square").groupBy("g", "part").applyInArrow(_part, STATE), "parts")
        dealt = rows.join(F.broadcast(sizes.select("g", "slices")), "g").join(ids.select("g", "id", "part", "i"), ["g", "id"])
        dealt = dealt.select("g", F.pmod(F.xxhash64("term"), "slices").cast("int").alias("slice"), "part", "i", "term", "w")
        self._begin(ids.select("g", "part", "i", "id"), state, dealt.groupBy("g", "slice").applyInArrow(_slice, SLICE), sizes.select("g", "slices"), clusters, most, starts, seed, iterations)

    @classmethod
    def of_parts(cls, ids: DataFrame, state: DataFrame, entries: DataFrame, slices: DataFrame, clusters: DataFrame, *, most: int, starts: int, seed: int = SEED, iterations: int = MOST_ITERATIONS) -> KMeans:
        """ids: (g, part, i, id); state: parts as in STATE, without clusters; entries as in SLICE; slices: (g, slices)."""
        made = cls.__new__(cls)
        made._begin(ids, state, entries, slices, clusters, most, starts, seed, iterations)
        return made

    def _begin(self, ids: DataFrame, state: DataFrame, entries: DataFrame, slices: DataFrame, clusters: DataFrame, most: int, starts: int, seed: int, iterations: int) -> None:
        if most > 127:
            raise ValueError("at most 127 clusters: a row's cluster is a byte")
        self.ids, self.state, self.clusters = ids, state, clusters
        self.starts, self.k, self.seed, self.iterations = starts, most, seed, iterations
        # few slices are dealt over all cores
        cores, total = ids.sparkSession.sparkContext.defaultParallelism, slices.agg(F.sum("slices")).first()[0] or 1
        bands = F.greatest(F.ceil(F.col("slices") / BAND_SLICES), F.least("slices", F.round(F.col("slices") * cores / total)), F.lit(1))
        self.sizes = kept(slices.select("g", bands.cast("int").alias("bands")), "bands")
        bands = self.sizes.agg(F.sum("bands")).first()[0] or 1
        # bands stay where they are: an iteration sends clusters to them and takes shares from them
        placed = entries.join(F.broadcast(self.sizes), "g").select(F.pmod("slice", "bands").cast("int").alias("band"), *[x.split()[0] for x in SLICE.split(", ")])
        self.bands = placed.repartition(4 * bands, "g", "band").sortWithinPartitions("g", "band", "slice", "part").persist(StorageLevel.DISK_ONLY)
        self.bands.count()
        rows = state.groupBy("g").agg((F.sum(F.length("square")) / 8).alias("n")).agg(F.max("n")).first()[0] or 1
        together = max(1, math.ceil(starts / math.ceil(rows * starts * most * 8 / ROOM)))
        #: The first and the number of starts whose products are in a task together.
        self.together = [(s, min(together, starts - s)) for s in range(0, starts, together)]
        self.cost: DataFrame | None = None

    def _meet(self, state: DataFrame, starts: int, found: Callable, kind: str) -> DataFrame:
        """The parts at what the bands give their rows, by the clusters of a state."""
        at = state.join(F.broadcast(self.sizes), "g").select(F.col("g").alias("to"), F.explode(F.sequence(F.lit(0), F.col("bands") - 1)).alias("with"), F.col("part").alias("of"), "at", "own")
        at = at.withColumn("own", F.when(F.col("with") == 0, F.col("own")))
        shares = self.bands.groupBy("g", "band").cogroup(at.groupBy("to", "with")).applyInArrow(_shares(starts, self.k), SHARE)
        return state.select([x.split()[0] for x in STATE.split(", ")]).groupBy("g", "part").cogroup(shares.groupBy("g", "part")).applyInArrow(found, kind)

    def seeds(self) -> DataFrame:
        """(g, start, nth, id): rows that the starts begin with."""
        found = [self._seeds(*x)[0].withColumn("start", F.col("start") + x[0]) for x in self.together]
        return reduce(DataFrame.unionByName, found).join(self.ids, ["g", "part", "i"]).select("g", "start", "nth", "id")

    def _seeds(self, first: int, starts: int) -> tuple[DataFrame, DataFrame]:
        """(g, start, nth, part, i), and the state with these rows in their clusters."""
        none = F.unhex(F.repeat(F.lit("FF"), (F.length("square") / 8 * starts).cast("int")))
        chosen, state, have = None, kept(self.state.withColumn("at", none), "unseeded"), 0
        while have < self.k:
            wanted = max(1, have)
            if have:
                race = self._meet(state, starts, _seeding(first, starts, self.k, have, self.seed, wanted), RACE)
            else:
                race = state.groupBy("g", "part").applyInArrow(_first(first, starts, self.seed), RACE)
            nth = F.row_number().over(Window.partitionBy("g", "start").orderBy("race", "id"))
            more = self.ids.join(F.broadcast(kept(race, "race")), ["g", "part", "i"]).withColumn("n", nth).where(F.col("n") <= wanted).join(self.clusters, "g").where(have + F.col("n") <= F.col("k"))
            more = kept(more.select("g", "start", (have + F.col("n") - 1).cast("int").alias("nth"), "part", "i"), "seeds")
            if chosen is not None and not more.take(1):
                break
            chosen, have = more if chosen is None else chosen.unionByName(more), have + wanted
            state = kept(state.groupBy("g", "part").cogroup(more.groupBy("g", "part")).applyInArrow(_seeded(starts), STATE), "seeded")
        return chosen, state

    def parts(self) -> DataFrame:
        """(g, part, at): the clusters, an int each, of the start with the least cost, the first of equals. `cost` keeps (g, start, cost) of all starts."""
        steps, before = [self._seeds(*x)[1] for x in self.together], None
        for _ in range(self.iterations):
            steps = [kept(self._meet(step, n, _step(n, self.k), STEP), "step") for step, (_, n) in zip(steps, self.together, strict=True)]
            cost = [step.select("g", F.posexplode("cost").alias("start", "cost")).withColumn("start", F.col("start") + first) for step, (first, _) in zip(steps, self.together, strict=True)]
            cost = kept(reduce(DataFrame.unionByName, cost).groupBy("g", "start").agg(F.sum("cost").alias("cost")), "cost")
            if before is not None and not cost.join(before.withColumnRenamed("cost", "was"), ["g", "start"]).where("was - cost > 1e-9 * was").take(1):
                break
            before = cost
        self.cost = cost
        nth = F.row_number().over(Window.partitionBy("g").orderBy(F.round("cost", 9), "start"))
        best = cost.withColumn("n", nth).where("n = 1").select("g", "start")
        found = [step.join(F.broadcast(best), "g").where(F.col("start").between(first, first + n - 1)).select("g", "part", "at", (F.col("start") - first).alias("start"), F.lit(n).alias("starts")) for step, (first, n) in zip(steps, self.together, strict=True)]
        found = kept(reduce(DataFrame.unionByName, found).mapInArrow(_of_start, "g string, part long, at binary"), "clusters")
        self.bands.unpersist()
        return found

    def fit(self) -> DataFrame:
        """(g, id, cluster) of the start with the least cost."""
        return unfolded(self.parts()).join(self.ids, ["g", "part", "i"]).select("g", "id", "cluster")
