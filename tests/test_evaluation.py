"""Runs of all modes from one table of candidates, against plain rankings."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import metrics, retrieval


@pytest.fixture(scope="module")
def lists(spark):
    r = random.Random(9)
    make = lambda: [(q, d, i + 1) for q in range(6) for i, d in enumerate(r.sample(range(40), 12))]
    dense, lexical = make(), [x for x in make() if x[0] != 5]
    df = lambda rows: spark.createDataFrame(rows, "query_id long, doc_id long, rank int")
    return dense, lexical, df(dense), df(lexical)


def plain_runs(dense, lexical):
    out = {}
    for q in range(6):
        rd, rl = {d: r for x, d, r in dense if x == q}, {d: r for x, d, r in lexical if x == q}
        docs = {*rd, *rl}
        at = lambda r, d: 1 / (60 + r[d]) if d in r else 0.0  # noqa: E731, B023
        best = {d: min(rd.get(d, 99), rl.get(d, 99)) for d in docs}
        out["dense", q], out["lexical", q] = sorted(rd, key=rd.get), sorted(rl, key=rl.get)
        for mode, a, b in (("rrf", 1, 1), ("weighted", 0.25, 0.75)):
            out[mode, q] = sorted(docs, key=lambda d: (-round(a * at(rd, d) + b * at(rl, d), 9), best[d], d))  # noqa: B023
        out["lexical_first", q] = sorted(rl, key=rl.get) + [d for d in sorted(rd, key=rd.get) if d not in rl]
    return out


def test_runs_and_scores(spark, lists):
    dense, lexical, a, b = lists
    runs = metrics.fused_runs(a, b)
    found = collections.defaultdict(dict)
    for r in runs.collect():
        found[r.mode, r.query_id][r["rank"]] = r.doc_id
    want = plain_runs(dense, lexical)
    assert {k: [v[i + 1] for i in range(len(v))] for k, v in found.items()} == {k: v for k, v in want.items() if v}
    # the same as the fusions of whole rankings
    for mode, other in (("rrf", retrieval.rrf([a, b])), ("weighted", retrieval.rrf([a, b], [0.25, 0.75])), ("lexical_first", retrieval.first_then(b, a))):
        key = lambda df: {(r.query_id, r["rank"], r.doc_id) for r in df.collect()}
        assert key(runs.where(F.col("mode") == mode)) == key(other)
    gold = {q: {d for d in range(40) if (d + q) % 5 == 0} for q in range(6)}
    fits = lambda d: d % 3 != 0
    rows = runs.withColumn("gold", (F.col("doc_id") + F.col("query_id")) % 5 == 0).withColumn("third", F.when(F.col("doc_id") % 7 != 6, F.col("doc_id") % 3))
    sizes = spark.createDataFrame([(q, len(g)) for q, g in gold.items()], "query_id long, n_gold long")
    fits = lambda d: d % 7 != 6 and d % 3 != 0
    for r in metrics.evaluate(rows, F.col("third") != 0, sizes, k=5).collect():
        run = want[r.mode, r.query_id]
        for name, ranking in (("", run), ("filtered_", [d for d in run if fits(d)])):
            hits = [i + 1 for i, d in enumerate(ranking[:5]) if d in gold[r.query_id]]
            assert (r[f"{name}hit_at_5"], r[f"{name}recall_at_5"], r[f"{name}rr_at_5"]) == (float(bool(hits)), len(hits) / len(gold[r.query_id]), pytest.approx(1 / hits[0] if hits else 0.0))
