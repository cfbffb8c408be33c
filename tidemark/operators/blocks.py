"""The best cosines of many queries among many vectors, by blocks that meet in a task.

Vectors and queries are dealt into blocks of a bounded number of values; each pair of blocks is one matrix product, of which
only the first `limit` vectors of a query leave the task. What is shuffled is the vectors once for each block of queries, the
queries once for each block of vectors, and `limit` rows a query and block of vectors.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Values of a block of vectors and of queries; rows of a block that is still worth a task of its own.
VECTOR_VALUES, QUERY_VALUES, LEAST_ROWS = 1 << 22, 1 << 20, 4096
#: Queries and vectors of one product.
QUERIES_AT_ONCE, VECTORS_AT_ONCE = 256, 8192


def counts(vectors: DataFrame, queries: DataFrame, column: str = "v") -> tuple[int, int]:
    """How many blocks of vectors and of queries to deal."""
    n, dim = vectors.agg(F.count(F.lit(1)), F.max(F.size(column))).first()
    asked = queries.count()
    dim = max(1, dim or 1)
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    return max(1, math.ceil(n * dim / VECTOR_VALUES), min(cores, math.ceil(n / LEAST_ROWS))), max(1, math.ceil(asked * dim / QUERY_VALUES))


def _units(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    x = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


class Best:
    """The first `limit` places of each query by rounded score, then place; none below a floor that is given."""

    def __init__(self, n: int, limit: int, floor: np.ndarray | None = None) -> None:
        self.limit, self.floor = limit, np.full(n, -np.inf) if floor is None else floor.copy()
        self.row, self.place, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)

    def add(self, rows: np.ndarray, places: np.ndarray, s: np.ndarray) -> None:
        """Scores of rows (queries) by places."""
        floor = self.floor[rows]
        if s.shape[1] > self.limit:
            open_ = np.isinf(floor)
            if open_.any():  # of a first product, what reaches its own last place
                floor[open_] = np.partition(s[open_], s.shape[1] - self.limit, axis=1)[:, -self.limit] - 2e-9
        i, j = np.nonzero(s >= floor[:, None] - 1e-9)
        if not len(i):
            return
        row, place, score = np.r_[self.row, rows[i]], np.r_[self.place, places[j]], np.r_[self.score, s[i, j]]
        order = np.lexsort((place, -np.round(score, 9), row))
        row, place, score = row[order], place[order], score[order]
        begin = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        nth = np.arange(len(row)) - np.repeat(begin, np.diff(np.r_[begin, len(row)]))
        last = nth == self.limit - 1
        self.floor[row[last]] = np.round(score[last], 9)
        keep = nth < self.limit
        self.row, self.place, self.score = row[keep], place[keep], score[keep]


def _nearest(limit: int, schema: pa.Schema, celled: bool) -> Callable:
    def of_cells(v: np.ndarray, q: np.ndarray, left: pa.Table, right: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows of queries and places of vectors that are to be compared."""
        if not celled:
            yield np.arange(len(q)), np.arange(len(v))
            return
        cell = left.column("cell").to_numpy()
        listed = right.column("cells").combine_chunks()
        asked, row = listed.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(q)), listed.value_lengths().to_numpy(zero_copy_only=False))
        order = np.argsort(asked, kind="stable")
        asked, row = asked[order], row[order]
        by_cell = np.argsort(cell, kind="stable")
        for c in np.unique(cell):
            rows = row[np.searchsorted(asked, c) : np.searchsorted(asked, c, side="right")]
            if len(rows):
                yield rows, by_cell[np.searchsorted(cell, c, sorter=by_cell) : np.searchsorted(cell, c, side="right", sorter=by_cell)]

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        dim = key[-1].as_py()
        left = left.sort_by("doc_id")  # so that a smaller place is a smaller id
        v, q = _units(left.column("v"), dim), _units(right.column("v"), dim)
        best = Best(len(q), limit)
        out = []
        for rows, places in of_cells(v, q, left, right):
            for lo in range(0, len(rows), QUERIES_AT_ONCE):
                part = rows[lo : lo + QUERIES_AT_ONCE]
                own = best if celled else Best(len(q), limit)
                for at in range(0, len(places), VECTORS_AT_ONCE):
                    some = places[at : at + VECTORS_AT_ONCE]
                    own.add(part, some, q[part] @ v[some].T)
                if not celled:
                    out.append((own.row, own.place, own.score))
        if celled:
            out.append((best.row, best.place, best.score))
        row, place, score = (np.concatenate(x) for x in zip(*out, strict=True))
        return pa.Table.from_arrays([right.column("query_id").take(pa.array(row)), left.column("doc_id").take(pa.array(place)), pa.array(score)], schema=schema)

    return run


def nearest(vectors: DataFrame, queries: DataFrame, limit: int, keys: tuple[str, ...], celled: bool = False) -> DataFrame:
    """(query_id, doc_id, score): of vectors (keys, doc_id, v) the first `limit` by cosine for each query (keys, query_id, v) that
    meets them by the keys; these hold at least the first `limit` of all. Vectors of different lengths don't meet; none may be null
    or zero or hold null or non-finite components. Celled: vectors have a cell, and queries the cells that they ask."""
    kind = StructType([queries.schema["query_id"], vectors.schema["doc_id"]]).add("score", "double")
    dim = F.size("v").alias("dim")
    left, right = vectors.select("*", dim).groupBy(*keys, "dim"), queries.select("*", dim).groupBy(*keys, "dim")
    return left.cogroup(right).applyInArrow(_nearest(limit, to_arrow_schema(kind), celled), kind)
