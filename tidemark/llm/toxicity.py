"""Toxicity by a classifier chain of linear models.

Categories are predicted one after another; each later model sees the earlier categories'
probabilities as features. It is trained on out-of-fold predictions: a labelled document's earlier
probabilities come from models that haven't seen it, as they will for unlabelled ones. All that a
model learns (features, hostile words, weights) comes from the folds that it is fitted on.

The chain is (strong, toxic). `toxic` is the given label. `strong` is a toxic document that has at
least two different hostile words, where hostile words are those which the labels of the model's own
folds tie to toxicity.

Features are the different words of the whole text, lower-cased, and their first four and five
letters, hashed to 2**20 places. Each is scaled by its smoothed log-ratio between the classes (as in
Wang and Manning, 2012), and logistic regression is fitted on top.

Models are fitted in Spark tasks, one for each fold, on at most `max_labelled` labelled documents,
picked by a hash of their id over all of them; the models' weights are bounded by the 2**20 places. All
documents are scored.

A document that is null or empty has no features, and is never toxic. Labels that are null are left
out; where an id has several labels, it is toxic if any says so. Without labels of both classes
nothing is called toxic. Repeated rows are scored alike; other columns don't matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.common import materialize, own_name

PLACES = 1 << 20
HALF = PLACES // 2
FOLDS = 3
#: Words whose features a worker remembers; then it starts anew.
REMEMBERED = 50_000
CHAIN = ("strong", "toxic")
_WORD = re.compile(r"[^\W\d_]+")


class Features:
    """Feature numbers of texts: words below HALF, beginnings of words above; remembered by word."""

    def __init__(self) -> None:
        self.known: dict[str, tuple[int, ...]] = {}

    def of_word(self, word: str) -> tuple[int, ...]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        starts = [word[:k] for k in (4, 5) if len(word) > k]
        found = (crc32(word.encode()) % HALF, *(HALF + crc32(s.encode(), k) % HALF for k, s in enumerate(starts)))
        self.known[word] = found
        return found

    def of_text(self, text: str | None) -> list[int]:
        if not text:
            return []
        known, of_word = self.known, self.of_word
        return list({f for w in set(_WORD.findall(text.lower())) for f in (known.get(w) or of_word(w))})


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(feats: list[np.ndarray], extra: np.ndarray, y: np.ndarray, steps: int = 150, penalty: float = 2e-4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logistic regression: places, their weights, and the weights of the extra columns and the bias."""
    n = len(y)
    row = np.repeat(np.arange(n, dtype=np.int32), [len(f) for f in feats])
    place = np.concatenate(feats).astype(np.int32) if n else np.array([], np.int32)
    pos = np.bincount(place, weights=y[row], minlength=PLACES)
    neg = np.bincount(place, minlength=PLACES) - pos
    ratio = np.log((pos + 0.5) / (y.sum() + 1)) - np.log((neg + 0.5) / (n - y.sum() + 1))
    used = np.flatnonzero((pos + neg >= 3) & (np.abs(ratio) >= 1))
    number = np.full(PLACES, -1)
    number[used] = np.arange(len(used))
    keep = number[place] >= 0
    row, col = row[keep], number[place[keep]]
    scale = ratio[used]
    dense = np.c_[extra, np.ones(n)]
    w, d = np.zeros(len(used)), np.zeros(dense.shape[1])
    d[-1] = np.log((y.sum() + 0.5) / (n - y.sum() + 0.5))
    m, v = np.zeros(len(w) + len(d)), np.zeros(len(w) + len(d))
    for t in range(1, steps + 1):
        z = np.bincount(row, weights=(w * scale)[col], minlength=n) + dense @ d
        err = (_sigmoid(z) - y) / max(n, 1)
        g = np.r_[np.bincount(col, weights=err[row], minlength=len(w)) * scale + penalty * w, dense.T @ err]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g  # Adam
        step = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-10)
        w, d = w - step[: len(w)], d - step[len(w) :]
    return used, w * scale, d


def strong(feats: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Which of the documents are toxic with two hostile words or more, by their own labels."""
    n = len(toxic)
    row = np.repeat(np.arange(n), [len(f) for f in feats])
    place = np.concatenate(feats).astype(np.int64) if n else np.array([], np.int64)
    pos = np.bincount(place, weights=toxic[row], minlength=PLACES)
    neg = np.bincount(place, minlength=PLACES) - pos
    ratio = np.log((pos + 0.5) / (toxic.sum() + 1)) - np.log((neg + 0.5) / (n - toxic.sum() + 1))
    hostile = (np.arange(PLACES) < HALF) & (pos >= 5) & (ratio >= 3)
    return ((np.bincount(row, weights=hostile[place], minlength=n) >= 2) & (toxic == 1)).astype(np.float64)


def _fit_group(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    extra = np.array(pdf["extra"].tolist(), np.float64).reshape(len(pdf), -1)
    feats, toxic = [np.asarray(f) for f in pdf["feats"]], pdf["toxic"].to_numpy(np.float64)
    y = strong(feats, toxic) if pdf["category"].iloc[0] == "strong" else toxic
    places, weights, dense = fit(feats, extra, y)
    return pd.DataFrame({"model": [key[0]], "places": [places.tolist()], "weights": [weights.tolist()], "dense": [dense.tolist()]})


MODEL = "model int, places array<long>, weights array<double>, dense array<double>"


class Scorer:
    def __init__(self, row: dict) -> None:
        self.w = np.zeros(PLACES, np.float32)
        self.w[row["places"]] = row["weights"]
        self.dense = np.array(row["dense"])

    def probability(self, feats: list[int], extra: list[float]) -> float:
        return float(_sigmoid(self.w[feats].sum(dtype=np.float64) + np.dot(self.dense[:-1], extra) + self.dense[-1]))


def _fitted(train: DataFrame, category: str) -> dict[int, dict]:
    """Models 0..FOLDS-1 haven't seen the fold of that number; model FOLDS has seen all."""
    models = F.explode(F.array(*[F.lit(i) for i in range(FOLDS + 1)]))
    rows = train.withColumn("model", models).where("model <> fold").select("model", "feats", "extra", "toxic", F.lit(category).alias("category"))
    return {r["model"]: r.asDict() for r in rows.groupBy("model").applyInPandas(_fit_group, MODEL).collect()}


def _with_probability(train: DataFrame, models: dict[int, dict]) -> DataFrame:
    """Appends each row's out-of-fold probability to `extra`."""
    sent = train.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorers = {k: Scorer(m) for k, m in sent.value.items()}
        for b in batches:
            rows = b.to_pylist()
            for r in rows:
                r["extra"] = [*r["extra"], scorers[r["fold"]].probability(r["feats"], r["extra"])]
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([(f.name, pa.list_(pa.float64()) if f.name == "extra" else f.type) for f in b.schema]))

    return train.mapInArrow(run, train.schema)


def telling(rows: DataFrame) -> np.ndarray:
    """Which features any model may use: those that say something of the label in its own folds. The
    others aren't carried into the fits; which of them a model uses it decides from its folds alone."""
    folds = range(FOLDS)
    count = [F.count_if(F.col("fold") == k).alias(f"n{k}") for k in folds] + [F.sum(F.when(F.col("fold") == k, F.col("toxic")).otherwise(0)).alias(f"p{k}") for k in folds]
    whole = rows.agg(*count).first()
    terms = rows.select("fold", "toxic", F.explode("feats").alias("f")).groupBy("f").agg(*count)
    any_of = F.lit(False)
    for model in range(FOLDS + 1):
        own = [k for k in folds if k != model]
        n, pos = (sum((F.col(f"{c}{k}") for k in own), F.lit(0)) for c in "np")
        total, toxic = (sum(whole[f"{c}{k}"] or 0 for k in own) for c in "np")
        ratio = F.log((pos + 0.5) / (toxic + 1)) - F.log((n - pos + 0.5) / (total - toxic + 1))
        any_of = any_of | ((n >= 3) & (F.abs(ratio) >= 0.8))
    out = np.zeros(PLACES, bool)
    out[terms.where(any_of).select("f").toPandas()["f"].to_numpy(np.int64)] = True  # at most PLACES numbers
    return out


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The probability from which calling documents toxic gives the best F1, half-way to the next."""
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    last = np.r_[p[order][1:] != p[order][:-1], True]
    k = int(np.argmax(np.where(last, f1, -1)))
    below = p[order][k + 1] if k + 1 < len(p) else 0.0
    return float((p[order][k] + below) / 2)


def train_chain(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_labelled: int = 24_000, seed: int = 3) -> dict | None:
    """The chain's models and threshold; None where labels of both classes are lacking."""
    given = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.max(F.col(label_col).cast("int")).alias("toxic"))
    given = given.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(max_labelled)

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for b in batches:
            found = [features.of_text(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("toxic"), pa.array(found, pa.list_(pa.int32()))], ["doc_id", "toxic", "feats"])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # at most max_labelled ids and labels are broadcast
    rows = materialize(texts.join(F.broadcast(given), "doc_id").mapInArrow(featured, "doc_id long, toxic int, feats array<int>"), "labelled")
    total, toxic = rows.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    if not total or not toxic or toxic == total:
        return None
    rows = materialize(rows.select("*", F.pmod(F.xxhash64("doc_id", F.lit(seed + 1)), F.lit(FOLDS)).cast("int").alias("fold"), F.array().cast("array<double>").alias("extra")), "chain")
    sent = docs.sparkSession.sparkContext.broadcast(np.packbits(telling(rows)))

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(sent.value).astype(bool)
        for b in batches:
            kept = [(f := x.values.to_numpy())[known[f]] for x in b.column("feats")]
            yield b.set_column(b.schema.get_field_index("feats"), "feats", pa.array(kept, pa.list_(pa.int32())))

    rows = materialize(rows.mapInArrow(told, rows.schema), "chain")
    models = []
    for category in CHAIN:
        fitted = _fitted(rows, category)
        if len(fitted) <= FOLDS:
            return None
        rows = materialize(_with_probability(rows, fitted), "chain")
        models.append(fitted[FOLDS])
    held = rows.select(F.element_at("extra", -1).alias("p"), "toxic").toPandas()  # two numbers for each of max_labelled rows
    p, y = held["p"].to_numpy(), held["toxic"].to_numpy(np.float64)
    cut = best_threshold(p, y)
    called = p >= cut
    hits = float((called & (y == 1)).sum())
    return {"models": models, "threshold": cut, "precision": hits / max(called.sum(), 1), "recall": hits / max(y.sum(), 1)}


def score(docs: DataFrame, chain: dict | None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The table with p_<category> for each category of the chain and is_toxic, after its own columns;
    a name that the table has already gets underscores (the last column is the verdict)."""
    added = [own_name(docs, n) for n in (*(f"p_{c}" for c in CHAIN), "is_toxic")]
    sent = docs.sparkSession.sparkContext.broadcast(chain)
    schema = StructType(list(docs.schema.fields))
    for n in added[:-1]:
        schema = schema.add(n, "double")
    schema = schema.add(added[-1], "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = sent.value
        scorers, features = [Scorer(m) for m in chain["models"]] if chain else [], Features()
        for b in batches:
            out: list[list[float]] = [[] for _ in CHAIN]
            for text in b.column(text_col).to_pylist():
                feats, before = features.of_text(text), []
                for i, s in enumerate(scorers):
                    before.append(s.probability(feats, before))
                    out[i].append(before[-1] if feats else 0.0)
                for o in out[len(scorers) :]:
                    o.append(0.0)
            toxic = [bool(chain) and p > 0 and p >= chain["threshold"] for p in out[-1]]
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(o, pa.float64()) for o in out), pa.array(toxic, pa.bool_())], [*b.schema.names, *added])

    return docs.mapInArrow(run, schema)
