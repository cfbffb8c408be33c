"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than ASCII white space.
SPACE = r"[\x20\x09-\x0D]+"
#: Spark's setting by which the shuffle files of a query go when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: The paths that materialize wrote within the innermost scratch().
_written: ContextVar[list[str] | None] = ContextVar("_written", default=None)


def words(text: Column) -> Column:
    """The words of a text, unchanged, as an array (null text: no words)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def own_name(docs: DataFrame, name: str) -> str:
    """A column name that the table doesn't have."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that the cluster names in spark.checkpoint.dir."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="checkpoints-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: the lineage is cut, and a lost
    executor costs a re-read instead of a recomputation. Its shuffle files go at once."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    if (paths := _written.get()) is not None:
        paths.append(path)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Deletes at its end what materialize wrote within. What is used later has to be written by the
    function it yields, a materialize whose tables stay (until the end of a scratch around this one)."""
    outer, paths = _written.get(), []
    token = _written.set(paths)

    def keep(df: DataFrame, name: str) -> DataFrame:
        inner = _written.set(outer)
        try:
            return materialize(df, name)
        finally:
            _written.reset(inner)

    try:
        yield keep
    finally:
        _written.reset(token)
        for path in paths:
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def word_hashes(tokens: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, tokens), dtype=np.uint64, count=len(tokens))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolling(h: np.ndarray, k: int, base: int) -> np.ndarray:
    """Hashes of all runs of k consecutive values: polynomials mod 2**64 by doubling, then mixed."""
    if len(h) < k:
        return h[:0]
    out, have, span, power = None, 0, 1, base & (2**64 - 1) | 1
    cur, rest = h, k
    while rest:
        if rest & 1:
            if out is None:
                out, have, lift = cur, span, power
            else:
                m = min(len(out), len(cur) - have)
                out = out[:m] * np.uint64(power) + cur[have : have + m]
                lift = lift * power % 2**64
                have += span
        rest >>= 1
        if rest:
            cur = cur[: len(cur) - span] * np.uint64(power) + cur[span:]
            span, power = span * 2, power * power % 2**64
    return mix64(out[: len(h) - k + 1])


def sliding_min(h: np.ndarray, m: int) -> np.ndarray:
    """Minimum of every m consecutive values."""
    cur, span = h, 1
    while span * 2 <= m:
        cur, span = np.minimum(cur[:-span], cur[span:]), span * 2
    return np.minimum(cur[: len(h) - m + 1], cur[m - span : m - span + len(h) - m + 1])
