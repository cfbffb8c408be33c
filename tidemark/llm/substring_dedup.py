"""Substring dedup: a count-min prefilter, then exact grouping of the windows that may be repeated.

1. Every partition sketches one key for each window. Equal windows have equal keys: the key is the
   smallest hash among the window's inner runs of `gram` words, so that neighbouring windows mostly
   share it and the sketch holds far fewer keys than there are windows. The partitions' sketches are
   merged; they only overestimate.
2. Windows whose key is estimated in two documents or more are grouped exactly. Neighbouring windows
   with the same key form a run; runs of the same words are of one kind, and the smallest document
   of each kind is found by partial aggregation, so a passage found everywhere stays a small group.
   A run whose kind stands in an earlier document is repeated as a whole. What is left, one run of
   each kind, is compared window by window with the other kinds of the same key, by 128 bits: the
   64 of the key, which is a part of the window, and 64 of the window's words.
3. Each document drops the words covered by a window that starts in a document with a smaller id.

Rows with null ids keep all words, since no id is smaller or larger than null. A null or empty text
has no words. Rows that share an id aren't earlier than each other; identical rows get identical
results. Only the id and text columns are read; others, of any name, don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import sketch
from tidemark.llm.common import materialize, rolling, sliding_min, word_hashes

BASE1, BASE3 = 0x9E3779B97F4A7C15, 0xA0761D6478BD642F
RUNS = "anchor long, s1 long, s2 long, doc_id long, version long, start int, size int, hashes binary"


def _window_keys(h: np.ndarray, window: int, gram: int) -> np.ndarray:
    return sliding_min(rolling(h, gram, BASE3), window - gram + 1)


def _runs(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    return np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])


def covered(starts: np.ndarray, sizes: np.ndarray, n: int, window: int) -> np.ndarray:
    """Which of n words lie in a window that starts in one of the ranges of `sizes` places at `starts`."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + sizes + window - 1, n), -1)
    return np.cumsum(edge[:n]) > 0


def dedup_substrings(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = 50, gram: int = 20) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_text."""
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    base = base.withColumn("version", F.xxhash64("text"))
    named = base.where(F.col("doc_id").isNotNull())

    def keys_of(batch: pa.RecordBatch) -> np.ndarray:
        found = []
        for text in batch.column("text").to_pylist():
            tokens = text.encode().split()
            if len(tokens) >= window:
                keys = _window_keys(word_hashes(tokens), window, gram)
                found.append(np.unique(keys[_runs(keys)]))
        return np.concatenate(found) if found else np.array([], np.uint64)

    n_chars = base.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
    width = sketch.width_for(n_chars / 100)
    parts = named.select("text").mapInArrow(sketch.sketch_pass(keys_of, width), sketch.SCHEMA)
    bits = spark.sparkContext.broadcast(sketch.repeated(parts, width))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[] for _ in range(8)]
            for doc, version, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "version", "text")), strict=True):
                tokens = text.encode().split()
                if len(tokens) < window:
                    continue
                h = word_hashes(tokens)
                keys = _window_keys(h, window, gram)
                at = _runs(keys)
                hit = np.flatnonzero(sketch.maybe_repeated(bits.value, keys[at], width))
                if not len(hit):
                    continue
                ends, hashes, anchors = np.r_[at[1:], len(keys)], rolling(h, window, BASE1), keys[at].view(np.int64)
                for i in hit.tolist():
                    lo, hi = int(at[i]), int(ends[i])
                    same = xxhash.xxh3_128_intdigest(h[lo : hi + window - 1].tobytes())
                    for c, v in zip(cols, (int(anchors[i]), (same >> 64) - 2**63, (same & (2**64 - 1)) - 2**63, doc, version, lo, hi - lo, hashes[lo:hi].tobytes()), strict=True):
                        c.append(v)
            types = [pa.int64()] * 5 + [pa.int32()] * 2 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], [x.split()[0] for x in RUNS.split(", ")])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array(batch.column("size").to_pylist(), np.int64)
            each = np.repeat(np.arange(len(sizes)), sizes)
            inner = np.arange(len(each)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            starts = np.array(batch.column("start").to_pylist(), np.int64)[each] + inner if len(each) else each
            hashes = np.frombuffer(b"".join(batch.column("hashes").to_pylist()), np.int64)
            take = lambda c: batch.column(c).take(pa.array(each))
            yield pa.RecordBatch.from_arrays([take("anchor"), pa.array(hashes), take("doc_id"), take("version"), pa.array(starts.astype(np.int32))], ["anchor", "hash", "doc_id", "version", "start"])

    runs = materialize(named.select("doc_id", "version", "text").mapInArrow(emit, RUNS), "runs")
    same = ["anchor", "s1", "s2"]
    kinds = materialize(runs.groupBy(*same).agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc")), "kinds")
    # a run that stands in an earlier document too: all of its windows are repeated
    late = runs.drop("hashes").join(kinds.where("first_doc < last_doc").drop("last_doc"), same).where("doc_id > first_doc")
    # the first run of each kind may share some windows with runs of other kinds around the same key
    mixed = kinds.groupBy("anchor").agg(F.min("first_doc").alias("lo"), F.max("first_doc").alias("hi")).where("lo < hi").select("anchor")
    heads = runs.join(kinds.join(mixed, "anchor", "left_semi").select(*same, F.col("first_doc").alias("doc_id")), [*same, "doc_id"])
    single = materialize(heads.select("anchor", "doc_id", "version", "start", "size", "hashes").mapInArrow(spread, "anchor long, hash long, doc_id long, version long, start int"), "windows")
    first = single.groupBy("anchor", "hash").agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc")).where("first_doc < last_doc").drop("last_doc")
    partly = single.join(first, ["anchor", "hash"]).where("doc_id > first_doc")
    gone = late.select("doc_id", "version", "start", "size").unionAll(partly.select("doc_id", "version", "start", F.lit(1).alias("size")))
    # by the document's own id and version: repeated rows get the same spans
    spans = gone.groupBy("doc_id", "version").agg(F.collect_list(F.struct("start", "size")).alias("spans"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for text, found in zip(batch.column("text").to_pylist(), batch.column("spans"), strict=True):
                tokens = text.encode().split()
                n_words.append(len(tokens))
                if found.is_valid:
                    starts, sizes = (found.values.field(i).to_numpy() for i in (0, 1))
                    gone = covered(starts, sizes, len(tokens), window)
                    n_removed.append(int(gone.sum()))
                    tokens = [w for w, g in zip(tokens, gone.tolist(), strict=True) if not g]
                else:
                    n_removed.append(0)
                kept.append(b" ".join(tokens).decode())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "kept_text"])

    joined = base.join(spans, ["doc_id", "version"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(remove, "doc_id long, n_words long, n_removed long, kept_text string")


def kept_digest(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


__all__ = ["covered", "dedup_substrings", "kept_digest"]
