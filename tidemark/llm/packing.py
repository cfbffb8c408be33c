"""Mixture-controlled packing: deficit round-robin over source queues.

Each source is a queue of tokens: its documents one after another. A window of `length` tokens gets
from every source its target share; what rounding leaves a source short of is its deficit, and is
carried on to the next window. By default the target shares are the sources' shares of all tokens,
under which every queue runs dry in the last window and nothing is padded before it. With weights
given, a queue that runs dry passes its quota on to the others: the windows fall into phases in
which the same queues last, and each phase is dealt as if its tokens were all there are.

Carried deficits have a closed form: after k windows a source has been given floor(k * length *
share) tokens, and the largest source takes what keeps the windows full. So the state of the queues
at any window is known without the windows before it, and partitions cut their documents into pieces
independently. Where sources are so many that a window's rounding could exceed the largest source's
share, windows are taken in blocks of K: the block's quotas come from the closed form and deficit
round-robin deals them out within the block.

Two passes: one tokenizes each partition, writes the ids with running offsets by source, so queues
need no sort; the second adds each partition's base offset and cuts. Texts are never shuffled.

A null or empty text is a document of only the end id. A null source is a queue of its own. Repeated
rows are documents of their own. An empty table gives no pieces. The last sequence alone is short:
it counts as padded to `length`, or to a power of two that holds it.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialize

#: Words whose ids a worker remembers, twice at most: once they are so many they are the older half, which a word leaves when it
#: comes up again. Bytes of text, and words, tokenized together.
CACHE = 300_000
SLICE = 4 << 20
TOGETHER = 2000
#: Bytes of dealt blocks that a task keeps.
BLOCK_BYTES = 64 << 20
#: Windows times sources that are looked at in one go (a few arrays of 8 bytes each).
CELLS = 1 << 19
#: Rows of (partition, source) up to which base offsets are broadcast: 24 bytes each, 12 MB.
BROADCAST_ROWS = 500_000
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


#: Stands between words that are tokenized in one go.
MARK = "\x01"


class WordIds:
    """Ids of texts by a public tokenizer that never joins across ASCII white space: each distinct word
    of a slice is tokenized once, and the words' ids are put together by their numbers. Words are remembered
    for the next slices, also those that a slice has once: half of the new words of a slice stood in one before."""

    def __init__(self, path: str, end_id: int) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end = end_id
        mark = self._encode([MARK])[0]
        self.mark = mark[0] if len(mark) == 1 else None
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str]) -> list[bytes]:
        """The ids of each word, as unsigned 32-bit ones: many words in one go, parted by the mark."""
        out = []
        for i in range(0, len(words), TOGETHER):
            part = words[i : i + TOGETHER]
            if self.mark is not None and not any(MARK in w for w in part):
                ids = np.array(self._encode([f" {MARK} ".join(part)])[0], np.uint32)
                at = np.flatnonzero(ids == self.mark)
                if len(at) == len(part) - 1:
                    out += [ids[x:y].tobytes() for x, y in zip([0, *(at + 1).tolist()], [*at.tolist(), len(ids)], strict=True)]
                    continue
            out += [np.array(ids, np.uint32).tobytes() for ids in self._encode(part)]
        return out

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, each with the end id; and how many each has."""
        if len(self.known) > CACHE:
            self.known, self.older = {}, self.known
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
        bounds = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
        which = coded.indices.to_numpy()
        words = coded.dictionary.to_pylist()
        found = list(map(self.known.get, words))
        missed = [i for i, x in enumerate(found) if x is None]
        new = []
        for i in missed:
            found[i] = x = self.older.pop(words[i], None)
            if x is None:
                new.append(i)
            else:
                self.known[words[i]] = x
        for i, x in zip(new, self._words([words[i] for i in new]), strict=True):
            found[i] = self.known[words[i]] = x
        flat = np.frombuffer(b"".join(found), np.uint32)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts = np.cumsum(sizes) - sizes
        own = sizes[which]
        before = np.r_[0, np.cumsum(own)]
        tokens = flat[np.repeat(starts[which] - before[:-1], own) + np.arange(before[-1])]
        counts = np.diff(before[bounds - bounds[0]]) + 1
        out = np.full(len(tokens) + len(counts), self.end, np.uint32)
        inner = np.ones(len(out), bool)
        inner[np.cumsum(counts) - 1] = False
        out[inner] = tokens
        return out, counts


@cache
def word_ids(path: str, end_id: int) -> WordIds:
    """One for a worker process, so that tasks which follow each other share what is remembered."""
    return WordIds(path, end_id)


def slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about SLICE bytes of text each."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64))
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(size, (size[lo - 1] if lo else 0) + SLICE, side="right")))
        yield lo, hi
        lo = hi


def _tokenize(path: str, end_id: int):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, unit, at = word_ids(path, end_id), TaskContext.get().partitionId(), {}
        for batch in batches:
            for lo, hi in slices(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                ids, counts = coder.ids(part.column("text"))
                offsets = []
                for skey, n in zip(part.column("skey").to_pylist(), counts.tolist(), strict=True):
                    offsets.append(at.get(skey, 0))
                    at[skey] = offsets[-1] + n
                edges = pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32) * 4, pa.int32())
                binary = pa.Array.from_buffers(pa.binary(), len(counts), [None, edges.buffers()[1], pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("skey"), pa.array([unit] * len(counts), pa.int32()), pa.array(offsets, pa.int64()), pa.array(counts), binary], ["doc_id", "skey", "unit", "inner", "n", "ids"])

    return run


def product_over(x: np.ndarray, y: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Quotient and remainder of x * y by m, for 0 <= y < m < 2**60, without leaving 64 bits: x is taken
    in digits that are short enough, the highest first, as in long division."""
    bits = 61 - m.bit_length()
    quotient = remainder = np.zeros(np.broadcast_shapes(np.shape(x), np.shape(y)), np.int64)
    for i in reversed(range(-(-int(np.max(x, initial=1)).bit_length() // bits))):
        now = (remainder << bits) + ((x >> (bits * i)) & ((1 << bits) - 1)) * y
        quotient = (quotient << bits) + now // m
        remainder = now % m
    return quotient, remainder


class Dealer:
    """How many tokens each source gives to each window."""

    def __init__(self, totals: list[int], length: int) -> None:
        self.totals, self.length, self.all = totals, length, sum(totals)
        self.big = max(range(len(totals)), key=totals.__getitem__) if totals else 0
        self.n_windows = -(-self.all // length)
        k = 1
        while totals and k * length * totals[self.big] < 2 * len(totals) * self.all:
            k *= 2
        self.k = k
        self.n_blocks = max(1, self.all // (k * length))  # the last takes the rest
        self._t = np.array(totals, np.int64)
        # a window's tokens of a source: whole ones, and what is left of all
        self._whole = np.array([t * length // self.all for t in totals] if self.all else [], np.int64)
        self._part = np.array([t * length % self.all for t in totals] if self.all else [], np.int64)
        self.block = lru_cache(max(64, BLOCK_BYTES // (16 * self.k * max(1, len(totals)))))(self._block)

    def given(self, g: int) -> np.ndarray:
        """Tokens that each source has given before block g."""
        if g >= self.n_blocks:
            return self._t.copy()
        return self._given_at(np.array([g * self.k]))[0]

    def _block(self, g: int) -> tuple[np.ndarray, np.ndarray]:
        """For block g: tokens given before each of its windows, by source, and their offsets in it."""
        lo, hi = self.given(g), self.given(g + 1)
        first = g * self.k
        n = (self.k if g < self.n_blocks - 1 else self.n_windows - first)
        quota, given = hi - lo, np.zeros_like(lo)
        rows, left = [lo], int(quota.sum())
        for w in range(n):
            room = min(self.length, left)
            if w == n - 1:
                give = quota - given
            else:
                due = quota * (w + 1) // n  # the round's quanta with the deficits carried so far
                give = np.maximum(due - given, 0)
                short = room - int(give.sum())
                for s in np.argsort((quota * (w + 1)) % n).tolist() if short < 0 else ():
                    less = min(-short, int(give[s]))  # sources ahead of their due leave others above the room
                    give[s], short = give[s] - less, short + less
                for s in sorted(range(len(quota)), key=lambda s: (-((quota[s] * (w + 1)) % n), s)) if short > 0 else ():
                    more = min(short, int(quota[s] - given[s] - give[s]), 1)
                    give[s], short = give[s] + more, short - more
                for s in np.argsort(-(quota - given - give)).tolist() if short > 0 else ():
                    more = min(short, int(quota[s] - given[s] - give[s]))
                    give[s], short = give[s] + more, short - more
            given, left = given + give, left - int(give.sum())
            rows.append(lo + given)
        before = np.array(rows)
        amounts = before[1:] - before[:-1]
        return before, np.cumsum(amounts, axis=1) - amounts

    def table(self, s: int, a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The windows that tokens a..b of source s go to: their numbers, the source's tokens given
        before and after each, and where the source begins in it. Windows that it skips are left out."""
        if self.k > 1:
            return self._table_of_blocks(s, a, b)
        last = self.n_blocks - 1
        slack = 2 + (-(-2 * len(self.totals) * self.all // (self.totals[s] * self.length)) if s == self.big else 0)
        lo = max(0, a * self.all // (self.totals[s] * self.length) - slack)
        hi = min(last, b * self.all // (self.totals[s] * self.length) + slack)
        if s != self.big and hi - lo > b - a + 2 * slack:  # less than a token a window: the windows of the tokens
            # token x lies in window ((x + 1) * all - 1) // (own tokens * length)
            tokens, own = np.arange(a + 1, b + 1), self.totals[s] * self.length
            quotient, remainder = product_over(tokens, np.int64(self.all % own), own)
            windows = np.unique(np.minimum(tokens * (self.all // own) + quotient - (remainder == 0), last))
        else:
            windows = np.arange(lo, hi + 1)
        rest = windows[-1] == last if len(windows) else False
        windows = windows[windows < last]
        out = [windows, *(np.zeros(len(windows), np.int64) for _ in range(3))]
        step = max(1, CELLS // len(self.totals))
        for i in range(0, len(windows), step):  # rows of all sources for a few windows at a time
            now = windows[i : i + step]
            before, after = self._given_at(now), self._given_at(now + 1)
            for column, values in zip(out[1:], (before[:, s], after[:, s], (after[:, :s] - before[:, :s]).sum(axis=1)), strict=True):
                column[i : i + step] = values
        if rest:  # the last block holds the full window and the short one after it
            rows, offsets = self.block(last)
            out = [np.concatenate(x) for x in zip(out, (last + np.arange(len(offsets)), rows[:-1, s].astype(np.int64), rows[1:, s].astype(np.int64), offsets[:, s].astype(np.int64)), strict=True)]
        return tuple(out)

    def _given_at(self, windows: np.ndarray) -> np.ndarray:
        a = windows[:, None] * self._whole + product_over(windows[:, None], self._part, self.all)[0]
        a[:, self.big] += windows * self.length - a.sum(axis=1)
        return a

    def _table_of_blocks(self, s: int, a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        lo, hi = 0, self.n_blocks - 1
        while lo < hi:  # the last block that begins at or before token a
            mid = (lo + hi + 1) // 2
            lo, hi = (mid, hi) if int(self.given(mid)[s]) <= a else (lo, mid - 1)
        parts = []
        while lo < self.n_blocks:
            rows, offsets = self.block(lo)
            parts.append((lo * self.k + np.arange(len(offsets)), rows[:-1, s].astype(np.int64), rows[1:, s].astype(np.int64), offsets[:, s].astype(np.int64)))
            if int(rows[-1][s]) >= b:
                break
            lo += 1
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def phases(totals: list[int], weights: list[float], length: int) -> list[list[int]]:
    """How many tokens each source gives while the same queues last, phase by phase: whole windows in
    proportion to the weights. Where a queue runs dry within a window it gives what it has left and
    the others fill up. Sources without a weight, and what doesn't fill a window, come last."""
    left, out = list(totals), []
    while True:
        live = [s for s, w in enumerate(weights) if w > 0 and left[s] > 0]
        room = sum(left[s] for s in live) // length * length
        if not room:
            break
        # tokens until the first queue runs dry, in whole windows, one at least
        total = sum(weights[s] for s in live)
        size = min(room, max(length, int(min(left[s] / weights[s] for s in live) * total) // length * length))
        give, need, filling = [0] * len(left), size, live
        while filling:  # those that have less than their share give all
            total = sum(weights[s] for s in filling)
            short = [s for s in filling if left[s] <= need * weights[s] / total]
            if not short:
                break
            for s in short:
                give[s] = left[s]
                need -= left[s]
            filling = [s for s in filling if s not in short]
        done, so_far, total = 0, 0.0, sum(weights[s] for s in filling)
        for s in filling:
            so_far += weights[s]
            upto = need if s == filling[-1] else int(need * so_far / total)
            give[s], done = upto - done, upto
        over = 0  # rounding may ask for a token that a source lacks
        for s in live:
            over, give[s] = over + max(0, give[s] - left[s]), min(give[s], left[s])
        for s in live:
            more = min(over, left[s] - give[s])
            give[s], over = give[s] + more, over - more
        out.append(give)
        left = [a - b for a, b in zip(left, give, strict=True)]
    return [*out, left] if any(left) or not out else out


class Mixture:
    """The windows of all phases, each dealt by the shares of its tokens."""

    def __init__(self, totals: list[int], length: int, weights: list[float] | None = None) -> None:
        self.parts, window, start = [], 0, [0] * len(totals)
        for give in [totals] if weights is None else phases(totals, weights, length):
            dealer = Dealer(give, length)
            self.parts.append((dealer, window, start))
            window, start = window + dealer.n_windows, [a + b for a, b in zip(start, give, strict=True)]

    def table(self, s: int, a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """As of a Dealer, over all phases."""
        found = []
        for dealer, window, start in self.parts:
            lo, hi = max(a, start[s]), min(b, start[s] + dealer.totals[s])
            if lo < hi:
                w, before, after, offset = dealer.table(s, lo - start[s], hi - start[s])
                found.append((w + window, before + start[s], after + start[s], offset))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def cut_queue(dealer: Dealer | Mixture, s: int, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Cut documents of source s, in order of their start in its queue: for each piece the document's
    index, its start in the document, its length, the window and the offset there."""
    ends = starts + sizes
    window, before, after, offset = dealer.table(s, int(starts[0]), int(ends[-1]))
    some = after > before
    window, before, after, offset = (x[some] for x in (window, before, after, offset))
    first = np.searchsorted(after, starts, side="right")
    last = np.searchsorted(before, ends, side="left") - 1
    n = last - first + 1
    doc = np.repeat(np.arange(len(starts)), n)
    w = np.repeat(first, n) + np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    a, e = np.maximum(starts[doc], before[w]), np.minimum(ends[doc], after[w])
    return doc, a - starts[doc], e - a, window[w], offset[w] + a - before[w]


def _cut(sources: list[str], totals: list[int], length: int, weights: list[float] | None):  # noqa: ANN202
    index = {k: i for i, k in enumerate(sources)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dealer = Mixture(totals, length, weights)
        for batch in batches:
            doc_ids, start, n = (np.array(batch.column(c).to_pylist(), object if c == "doc_id" else np.int64) for c in ("doc_id", "start", "n"))
            views = [memoryview(x) for x in batch.column("ids").to_pylist()]
            by_source: dict[str, list[int]] = {}
            for i, skey in enumerate(batch.column("skey").to_pylist()):
                by_source.setdefault(skey, []).append(i)
            for skey, rows in by_source.items():
                at = np.array(rows)[np.argsort(start[rows], kind="stable")]
                # documents far apart in the queue, from different partitions, are cut apart
                for part in np.split(at, np.flatnonzero(start[at][1:] != (start[at] + n[at])[:-1]) + 1):
                    doc, inner, size, window, offset = cut_queue(dealer, index[skey], start[part], n[part])
                    own = part[doc]
                    crcs = [zlib.crc32(views[i][4 * a : 4 * b]) for i, a, b in zip(own.tolist(), inner.tolist(), (inner + size).tolist(), strict=True)]
                    cols = [pa.array(doc_ids[own], pa.int64()), *(pa.array(np.asarray(c, np.int64)) for c in (inner, size, crcs, n[own], window, offset))]
                    yield pa.RecordBatch.from_arrays(cols, [x.split()[0] for x in PIECES.split(", ")])

    return run


def source_key(name: str | None) -> str:
    return "-" if name is None else f"+{name}"


def pack(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", end_id: int = 1, length: int = 2048, weights: dict[str | None, float] | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    weights: target token proportions by source (None: those of a null source); sources that it lacks
    come after the others. Without weights the targets are the sources' shares of all tokens. The
    driver and each task hold a name and a count for each source."""
    skey = F.when(F.col(source_col).isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col(source_col).cast("string")))
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), skey.alias("skey"))
    ids = materialize(base.mapInArrow(_tokenize(tokenizer_path, end_id), "doc_id long, skey string, unit int, inner long, n long, ids binary"), "ids")
    units = materialize(ids.groupBy("unit", "skey").agg(F.sum("n").alias("words")), "units")
    queues = units.groupBy("skey").agg(F.sum("words").alias("words")).orderBy("skey").collect()
    bases = units.withColumn("base", F.coalesce(F.sum("words").over(Window.partitionBy("skey").orderBy("unit").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("words")
    if units.count() <= BROADCAST_ROWS:
        bases = F.broadcast(bases)
    placed = ids.join(bases, ["unit", "skey"]).select("doc_id", "skey", (F.col("inner") + F.col("base")).alias("start"), "n", "ids")
    by_key = None if weights is None else {source_key(k): float(w) for k, w in weights.items()}
    shares = None if by_key is None else [by_key.get(q["skey"], 0.0) for q in queues]
    return placed.mapInArrow(_cut([q["skey"] for q in queues], [q["words"] for q in queues], length, shares), PIECES)
