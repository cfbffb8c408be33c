"""Count-min sketches built per partition, merged by Spark, and sent out as a bitmap of bounded size.

Cells are dealt into chunks of 2**16. A task sends, for each chunk, the cells that it met once and
those that it met more often; merging adds them up. What later passes need is only whether a cell
counts two or more, so one bit a cell is all that reaches the driver: rows * width / 8 bytes, at most
2 * 2**28 / 8 = 64 MB however large the corpus is. With more keys the cells fill, estimates grow,
and more keys pass on to the exact step; none is lost.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

CHUNK = 1 << 16
#: Keys that a task holds before it adds them up; texts that it takes from a batch at once.
HELD = 500_000
TEXTS = 500
ROWS = 2
SCHEMA = "chunk int, once binary, more binary"


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices, so that what is made of a batch of texts isn't held as a whole."""
    for batch in batches:
        for lo in range(0, batch.num_rows, TEXTS):
            yield batch.slice(lo, TEXTS)


def width_for(n_keys: float) -> int:
    """Cells a row: eight for each expected key, from 2**16 to 2**28."""
    return 1 << min(28, max(16, int(np.ceil(np.log2(max(1.0, n_keys) * 8)))))


def cells(keys: np.ndarray, width: int, rows: int = ROWS) -> list[np.ndarray]:
    """The cell of each 64-bit key in each of one or two rows."""
    mask = np.uint64(width - 1)
    return [keys & mask, (keys >> np.uint64(32)) & mask][:rows]


def partition_sketch(keys: np.ndarray, width: int, rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """The sketch of one partition's keys; a key that counts twice is given twice."""
    for row, c in enumerate(cells(keys, width, rows)):
        u, n = np.unique(c, return_counts=True)
        chunk = (u // CHUNK).astype(np.int64)
        local = (u % CHUNK).astype("<u2")
        starts = np.flatnonzero(np.r_[True, chunk[1:] != chunk[:-1]]) if len(u) else np.array([], int)
        ends = np.r_[starts[1:], len(u)] if len(u) else starts
        ids, once, more = [], [], []
        for a, b in zip(starts, ends, strict=True):
            part, many = local[a:b], n[a:b] > 1
            ids.append(int(chunk[a]) + row * (width // CHUNK))
            once.append(part[~many].tobytes())
            more.append(part[many].tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(once, pa.binary()), pa.array(more, pa.binary())], ["chunk", "once", "more"])


def _merge(pdf: pd.DataFrame) -> pd.DataFrame:
    n = np.zeros(CHUNK, np.uint8)
    for once, more in zip(pdf["once"], pdf["more"], strict=True):
        i = np.frombuffer(once, "<u2")
        n[i] = np.minimum(n[i] + 1, 2)
        n[np.frombuffer(more, "<u2")] = 2
    return pd.DataFrame({"chunk": pdf["chunk"].iloc[:1], "bits": [np.packbits(n >= 2, bitorder="little").tobytes()]})


def repeated(parts: DataFrame, width: int, rows: int = ROWS) -> np.ndarray:
    """Merge partition sketches to the bitmap of cells that count two or more."""
    bits = np.zeros(rows * width // 8, np.uint8)
    merged = parts.groupBy("chunk").applyInPandas(_merge, "chunk int, bits binary")
    for r in merged.toLocalIterator():
        bits[r["chunk"] * (CHUNK // 8) : (r["chunk"] + 1) * (CHUNK // 8)] = np.frombuffer(r["bits"], np.uint8)
    return bits


def maybe_repeated(bits: np.ndarray, keys: np.ndarray, width: int, rows: int = ROWS) -> np.ndarray:
    """For each key, whether the sketch estimates it at two or more."""
    ok = np.ones(len(keys), bool)
    for row, c in enumerate(cells(keys, width, rows)):
        at = c.astype(np.int64) + row * width
        ok &= (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
    return ok


def sketch_pass(keys_of: Callable[[pa.RecordBatch], np.ndarray], width: int, rows: int = ROWS) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A mapInArrow function that sketches what keys_of gives for each batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(keys_of(batch))
            n += len(held[-1])
            if n > HELD:  # bounds a task's memory; a cell may then be sent twice, which merging adds
                yield from partition_sketch(np.concatenate(held), width, rows)
                held, n = [], 0
        if n:
            yield from partition_sketch(np.concatenate(held), width, rows)

    return run


# Levels: how common a key is, on a log scale, for ordering. A fixed size whatever the corpus: LEVEL_ROWS
# * LEVEL_WIDTH bytes reach the driver and the executors (4 MB).

LEVEL_WIDTH = 1 << 21
LEVEL_ROWS = 2
LEVEL_SCHEMA = "chunk int, counts binary"


def level_pass(keys_of: Callable[[pa.RecordBatch], np.ndarray]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A mapInArrow function that counts each partition's keys in a count-min sketch."""

    def send(counts: np.ndarray) -> pa.RecordBatch:
        parts = [zlib.compress(c.tobytes(), 1) for c in counts.reshape(-1, CHUNK)]
        return pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())], ["chunk", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, held, n = None, [], 0

        def add() -> None:
            keys = np.concatenate(held)
            for row, c in enumerate(cells(keys, LEVEL_WIDTH)):
                counts[row] += np.bincount(c.astype(np.int64), minlength=LEVEL_WIDTH).astype(np.uint32)

        for batch in sliced(batches):
            if counts is None:
                counts = np.zeros((LEVEL_ROWS, LEVEL_WIDTH), np.uint32)
            held.append(keys_of(batch))
            n += len(held[-1])
            if n > HELD:
                add()
                held, n = [], 0
        if counts is not None:
            if held:
                add()
            yield send(counts)

    return run


def _level(pdf: pd.DataFrame) -> pd.DataFrame:
    n = np.zeros(CHUNK, np.float64)
    for counts in pdf["counts"]:
        n += np.frombuffer(zlib.decompress(counts), np.uint32)
    return pd.DataFrame({"chunk": pdf["chunk"].iloc[:1], "level": [np.floor(np.log2(n + 1)).astype(np.uint8).tobytes()], "total": [n.sum()]})


def levels(parts: DataFrame) -> np.ndarray:
    """Merge partition counts to log2 levels, less what an average cell holds (and two more)."""
    out, total = np.zeros(LEVEL_ROWS * LEVEL_WIDTH, np.uint8), 0.0
    for r in parts.groupBy("chunk").applyInPandas(_level, "chunk int, level binary, total double").toLocalIterator():
        out[r["chunk"] * CHUNK : (r["chunk"] + 1) * CHUNK] = np.frombuffer(r["level"], np.uint8)
        total += r["total"]
    noise = int(np.log2(total / len(out) + 1)) + 2
    return np.where(out > noise, out - noise, 0).astype(np.uint8)


def level_of(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = [c.astype(np.int64) + row * LEVEL_WIDTH for row, c in enumerate(cells(keys, LEVEL_WIDTH))]
    return np.minimum(table[at[0]], table[at[1]])
