"""The vector index, the text index and k-means against plain versions."""

import collections
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import clustering, retrieval
from tidemark.operators.kmeans import KMeans
from tidemark.operators.rankings import recall
from tidemark.operators.text_index import TextIndex
from tidemark.operators.vector_index import VectorIndex

VEC = "vec_id long, embedding array<float>, rating int"


@pytest.fixture(scope="module")
def clouds(spark):
    """40 clouds of vectors, and some that have no cosine."""
    r = np.random.default_rng(5)
    centre = r.normal(size=(40, 16))
    rows = [(i, [float(x) for x in centre[i % 40] + r.normal(size=16) * 0.35], i % 6) for i in range(4000)]
    rows += [(9000, None, 1), (9001, [0.0] * 16, 1), (9002, [float("nan")] * 16, 1), (9003, [None] * 16, 1)]
    return spark.createDataFrame(rows, VEC)


def test_vector_index(spark, clouds, tmp_path):
    index = VectorIndex.build(clouds, str(tmp_path / "index"), payload=("rating",))
    index = VectorIndex(spark, str(tmp_path / "index"))  # as another session finds it
    assert index.cells.agg(F.sum("n")).first()[0] == 4000 and 1 < index.cells.count() <= 64
    queries = clouds.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    truth = retrieval.dense(clouds, queries)
    few = recall(index.search(queries, probes=8), truth).first()
    assert few.n == 400 and few.recall_at_10 >= 0.9 and index.read_share(queries, 8) < 0.3
    key = lambda df: sorted((r.query_id, r.doc_id, r["rank"], round(r.score, 9)) for r in df.collect())
    assert key(index.search(queries, probes=2, exact=True)) == key(truth)
    some = F.col("rating") == 3
    assert key(index.search(queries, probes=2, where=some, exact=True)) == key(retrieval.dense(clouds, queries, where=some))
    # only the folders of probed cells are read
    plan = index.scores(queries, index.order(queries).where("nth = 1"), None)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(cell" in plan
    odd = spark.createDataFrame([(1, [0.0] * 16), (2, None), (3, [1.0] * 5)], "query_id long, vector array<float>")
    assert index.search(odd).count() == 0
    none = VectorIndex.build(clouds.limit(0), str(tmp_path / "none"))
    assert none.search(queries, exact=True).count() == 0 and none.read_share(queries, 1) == 0.0


def okapi(docs, text):
    toks = {i: re.findall("[a-z0-9]+", (t or "").lower()) for i, t in docs}
    mean = sum(map(len, toks.values())) / len(toks)
    df = collections.Counter(w for t in toks.values() for w in set(t))
    idf = {w: math.log(len(toks) - n + 0.5) - math.log(n + 0.5) for w, n in df.items()}
    floor = 0.25 * sum(idf.values()) / len(idf)
    idf = {w: x if x >= 0 else floor for w, x in idf.items()}
    out = {}
    for i, t in toks.items():
        tf = collections.Counter(t)
        out[i] = sum(idf[w] * tf[w] * 2.5 / (tf[w] + 1.5 * (0.25 + 0.75 * len(t) / mean)) for w in re.findall("[a-z0-9]+", text.lower()) if tf[w])
    return sorted(out.items(), key=lambda x: (-round(x[1], 9), x[0]))


def test_text_index(spark, tmp_path):
    r = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)]
    docs = [(i, " ".join(r.choices(vocabulary, [1 / (j + 1) for j in range(300)], k=r.randint(0, 60)))) for i in range(1500)] + [(1500, None), (1501, ""), (1502, "rare rare rare"), (1503, "rare w1 w2")]
    queries = [(0, "w0 w250 w299"), (1, "rare"), (2, "w1 w1 w280"), (3, "unheard of"), (4, ""), (5, "w5 w200 rare w0")]
    TextIndex.build(spark.createDataFrame(docs, "id long, body string").repartition(4), str(tmp_path / "i"), id_col="id", text_col="body", size=16)
    index = TextIndex(spark, str(tmp_path / "i"))
    q = spark.createDataFrame(queries, "query_id long, text string")
    for limit in (5, 20):
        got = {}
        for x in index.search(q, limit=limit).orderBy("query_id", "rank").collect():
            got.setdefault(x.query_id, []).append((x.doc_id, round(x.score, 6)))
        for i, text in queries:
            assert got[i] == [(d, round(s, 6) + 0.0) for d, s in okapi(docs, text)[:limit]]
    # ranges that can't hold one of the first documents aren't read
    asked = index.asked(q.where("query_id IN (0, 5)"))
    read, held = index.needed(asked, 5).count(), index.bounds(asked).count()
    assert read < 0.5 * held


def test_text_index_with_negative_weights(spark, tmp_path):
    """In tiny collections the mean idf, and so the floor, is below 0."""
    docs = [(i, "all of it" + (" one" if i == 2 else "") + (" two" if i in (3, 4, 5, 6) else "")) for i in range(8)] + [(9, "nothing"), (10, "other")]
    q = [(0, "all"), (1, "one all"), (2, "two of it"), (3, "none")]
    got = collections.defaultdict(list)
    for x in TextIndex.build(spark.createDataFrame(docs, "doc_id long, text string")).search(spark.createDataFrame(q, "query_id long, text string"), limit=4).orderBy("query_id", "rank").collect():
        got[x.query_id].append((x.doc_id, round(x.score, 6)))
    assert got == {i: [(d, round(s, 6) + 0.0) for d, s in okapi(docs, t)[:4]] for i, t in q}
    empty = TextIndex.build(spark.createDataFrame([], "doc_id long, text string"), str(tmp_path / "none"))
    assert empty.search(spark.createDataFrame(q, "query_id long, text string")).count() == 0


def lloyd(x, seeds, k):
    """Plain k-means from given rows; clusters that lose all rows are given up."""
    c, before = [x[i] for i in seeds], None
    for _ in range(20):
        d = np.array([((x - m) ** 2).sum(axis=1) if m is not None else np.full(len(x), np.inf) for m in c])
        at, cost = d.argmin(axis=0), d.min(axis=0).sum()
        if before is not None and before - cost <= 1e-9 * before:
            break
        before = cost
        c = [x[at == j].mean(axis=0) if (at == j).any() else None for j in range(len(c))]
    return cost, at


def test_kmeans_of_all_groups(spark):
    r = np.random.default_rng(8)
    rows, x = [], {}
    for g, n in (("a", 60), ("b", 37), ("c", 3)):
        m = np.maximum(r.normal(size=(n, 12)) - 0.4, 0) + np.eye(12)[r.integers(0, 4, n)] * 2
        m[0] = 0
        x[g] = m
        for i, v in enumerate(m):
            rows += [(g, str(i), f"t{j}", float(w)) for j, w in enumerate(v) if w > 0] or [(g, str(i), None, 0.0)]
    df = spark.createDataFrame(rows, "g string, id string, term string, w double")
    want = {"a": 4, "b": 3, "c": 1}
    import tidemark.operators.kmeans as module

    held, module.PART_ENTRIES = module.PART_ENTRIES, 60  # several parts a group
    try:
        model = KMeans(df, spark.createDataFrame(list(want.items()), "g string, k int"), most=4, starts=3)
        seeds = collections.defaultdict(dict)
        for s in model.seeds().collect():
            seeds[s.g, s.start][s.nth] = int(s.id)
        found = collections.defaultdict(dict)
        for f in model.fit().collect():
            found[f.g][int(f.id)] = f.cluster
    finally:
        module.PART_ENTRIES = held
    costs = {(c.g, c.start): c.cost for c in model.cost.collect()}
    assert set(costs) == {(g, s) for g in want for s in range(3)}
    for g, k in want.items():
        assert all(len(set(seeds[g, s].values())) == k for s in range(3))
        plain = {s: lloyd(x[g], [seeds[g, s][i] for i in range(k)], k) for s in range(3)}
        for s in range(3):
            assert costs[g, s] == pytest.approx(plain[s][0], rel=1e-9)
        best = min(range(3), key=lambda s: (round(plain[s][0], 9), s))
        assert [found[g][i] for i in range(len(x[g]))] == plain[best][1].tolist()


def test_clusters_of_texts(spark):
    talk = {"battery": ["battery dies fast", "the battery is dead", "battery drains overnight", "weak battery life", "battery does not last"], "cable": ["cable broke soon", "the cable is frayed", "short cable", "cable came apart", "bad cable quality"]}
    rows = [(i, "power", t) for i, t in enumerate(talk["battery"] * 2 + talk["cable"] * 2)] + [(100 + i, "few", "only three of them") for i in range(3)] + [(200 + i, "stop", "it is the") for i in range(6)] + [(300 + i, "none", "!!") for i in range(6)]
    docs = spark.createDataFrame(rows, "id long, aspect string, text string")
    got = {r.id: (r.aspect, r.cluster) for r in clustering.assign(docs, group="aspect", id_col="id", text="text").collect()}
    # below five: left out; nothing but stop words: they are kept; no terms: one cluster
    assert not any(i in got for i in range(100, 103)) and {got[200 + i] for i in range(6)} == {("stop", 0)} and {got[300 + i] for i in range(6)} == {("none", 0)}
    left = [i for i in range(20) if i in got]
    assert len(left) >= 10 and all(got[i][1] != got[j][1] for i in left for j in left if i < 10 <= j)
    words = clustering.keywords(clustering.tf_idf(docs, "aspect", "id", "text"), docs.where("aspect = 'power'").select("aspect", "id", (F.col("id") >= 10).cast("int").alias("cluster")), "aspect", "id")
    assert {r.cluster: r.keywords[0] for r in words.collect()} == {0: "battery", 1: "cable"}
