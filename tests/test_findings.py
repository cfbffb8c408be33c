"""Cases of a review: values at bounds, joins by blocks, one scan of texts."""

import collections
import datetime
import math
import random
import re

import duckdb
import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemark.operators import absa, blocks, clustering, kmeans, retrieval, text_scan
from tidemark.operators.vector_index import VectorIndex
from tests.test_indexes import okapi


def same_as_sql(spark, name, folder):
    """The query's rows and those of its SQL on the tables of a folder, sorted."""
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in folder.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}/*.parquet')")
    df = entry.queries()[name](spark, str(folder))
    want = con.execute(f'SELECT {", ".join(chr(34) + c + chr(34) for c in df.columns)} FROM ({entry.oracle_sql()[name]}) t').fetchall()
    got = [tuple(r) for r in df.collect()]
    return sorted(got, key=repr), sorted(want, key=repr)


def test_ratings_at_their_bounds(spark, tmp_path):
    at = datetime.datetime(2024, 1, 1)
    rows = [(i, at, v) for i, v in enumerate([None, -0.0, 0.49, 0.5, 0.51, 1.5, 2.5, 5.49, 5.5, 6.0])]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, value double").write.parquet(str(tmp_path / "events.parquet"))
    got, want = same_as_sql(spark, "coercions", tmp_path)
    assert got == want and (3, 0, 0) in [r[:3] for r in got]


def test_cosines_by_blocks(spark, monkeypatch):
    """Blocks hold few values, copies tie by id, lengths differ, and no pair is scored by an expression a component."""
    r = np.random.default_rng(2)
    rows = [(i, [float(x) for x in r.normal(size=8)]) for i in range(300)]
    rows += [(1000 - i, rows[7][1]) for i in range(60)] + [(2000, [1.0] * 5), (2001, [2.0] * 5), (2002, None), (2003, [0.0] * 8), (2004, [float("nan")] * 8)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    queries = vectors.where("vec_id % 7 = 0 OR vec_id >= 2000").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    x = {i: np.float32(v).astype(float) / np.linalg.norm(np.float32(v).astype(float)) for i, v in rows if v and np.isfinite(v).all() and any(v)}
    want = {}
    for q in (i for i in x if i % 7 == 0 or i >= 2000):
        near = sorted((-round(float(x[q] @ x[i]), 9), i) for i in x if len(x[i]) == len(x[q]))
        want[q] = [i for _, i in near[:20]]
    for name, value in (("VECTOR_VALUES", 400), ("QUERY_VALUES", 200), ("LEAST_ROWS", 16), ("QUERIES_AT_ONCE", 3), ("VECTORS_AT_ONCE", 11)):
        monkeypatch.setattr(blocks, name, value)
    found = retrieval.dense(vectors, queries, limit=20)
    assert "FlatMapCoGroupsInArrow" in found._jdf.queryExecution().toString()
    index = VectorIndex.build(vectors.where("vec_id < 2000"), cells=6).search(queries, limit=20, probes=2, exact=True)
    for df, least in ((found, 0), (index, 2000)):
        got = {}
        for row in df.orderBy("query_id", "rank").collect():
            got.setdefault(row.query_id, []).append(row.doc_id)
        assert got == {q: ids for q, ids in want.items() if not least or q < least}


def test_texts_are_scanned(spark, monkeypatch):
    """As a plain BM25, with floored and with negative weights, copies that tie by id, several batches a task and terms passed on early."""
    r = random.Random(4)
    words = [f"w{i}" for i in range(200)]
    many = [(i, " ".join(r.choices(words, [1 / (j + 1) for j in range(200)], k=r.randint(0, 40)))) for i in range(700)]
    many += [(1700 - i, many[3][1]) for i in range(40)] + [(800, None), (801, ""), (802, "rare rare"), (803, "RARE w1")]
    tiny = [(i, "all of it" + (" one" if i == 2 else "")) for i in range(8)] + [(9, "nothing"), (10, "other")]
    queries = [(0, "w0 w150 w199"), (1, "rare all"), (2, "w1 w1 w180 one"), (3, "unheard"), (4, ""), (5, many[3][1])]
    q = spark.createDataFrame(queries, "query_id long, text string")
    monkeypatch.setattr(text_scan, "TERMS", 50)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "60")
    try:
        for docs in (many, tiny):
            df = spark.createDataFrame(docs, "id long, body string").repartition(3)
            got = {}
            for x in retrieval.bm25(df, q, limit=8, id_col="id", text_col="body").orderBy("query_id", "rank").collect():
                got.setdefault(x.query_id, []).append((x.doc_id, round(x.score, 6) + 0.0))
            assert got == {i: [(d, round(s, 6) + 0.0) for d, s in okapi(docs, text)[:8]] for i, text in queries}
        # more queries than a task may hold go through the index, with the same result
        monkeypatch.setattr(text_scan, "MOST_CELLS", 3)
        again = retrieval.bm25(df, q, limit=8, id_col="id", text_col="body")
        assert [tuple(x) for x in again.orderBy("query_id", "rank").select("query_id", "doc_id").collect()] == [(i, d) for i in sorted(got) for d, _ in got[i]]
        assert text_scan.scan(df, q, limit=8, id_col="id", text_col="body") is None
        none = spark.createDataFrame([], "doc_id long, text string")
        monkeypatch.undo()
        assert retrieval.bm25(none, q).count() == 0
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_texts_are_extracted_once(spark, sf, monkeypatch):
    calls = []
    plain = absa.extract
    monkeypatch.setattr(absa, "extract", lambda *a, **k: calls.append(1) or plain(*a, **k))
    for name in ("mention_events", "analytics_answers", "cluster_run_summary"):
        calls.clear()
        df = entry.queries()[name](spark, sf)
        # what was extracted is written; the query reads that
        assert len(calls) == 1 and "translate(" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_terms_are_counted_where_they_are_read(spark):
    rows = [(1, "a", "red car red house"), (2, "a", "blue car"), (3, "a", None), (4, "b", "it is the"), (5, "b", "the"), (6, "c", "!!"), (7, "a", "blue car red car red")]
    docs = spark.createDataFrame(rows, "id long, g string, text string").repartition(3)
    found = clustering.tf_idf(docs, "g", "id", "text")
    # entries aren't shuffled by document and term to be counted
    assert not re.search(r"hashpartitioning\(g#\d+, id#\d+L?, term#", found._jdf.queryExecution().executedPlan().toString())
    got = {(r.id, r.term): r.weight for r in found.collect()}
    want = {}
    for group in ("a", "b"):
        lists = {i: text.split() if text else [] for i, g, text in rows if g == group}
        count = {i: collections.Counter([*w, *(" ".join(p) for p in zip(w, w[1:], strict=False))]) for i, w in lists.items()}
        df = collections.Counter(t for c in count.values() for t in c)
        for i, c in count.items():
            w = {t: (1 + math.log(n)) * (math.log((1 + len(lists)) / (1 + df[t])) + 1) for t, n in c.items()}
            norm = math.sqrt(sum(x * x for x in w.values()))
            want |= {(i, t): x / norm for t, x in w.items()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_kmeans_meets_in_bands(spark, monkeypatch):
    """Terms don't travel in an iteration, those of one row are one entry, equal distances go to the smaller cluster, and the result is
    the same whatever the bands and parts are."""
    r = random.Random(6)
    kinds = [[f"{c}{i}" for i in range(6)] for c in "abc"]
    rows = [("g", str(i), t, 0.3) for i in range(90) for t in [*r.sample(kinds[i % 3], 4), *(f"own {i} {j}" for j in range(30))]]
    rows += [("g", str(90 + i), t, 0.5) for i in range(6) for t in ("a1", "b1")] + [("g", "96", None, 0.0), ("h", "1", None, 0.0), ("h", "2", None, 0.0)]
    df = spark.createDataFrame(rows, "g string, id string, term string, w double")
    found = []
    for entries, part in ((1 << 21, 4096), (200, 20)):
        monkeypatch.setattr(kmeans, "PART_ENTRIES", entries)
        monkeypatch.setattr(kmeans, "PART_ROWS", part)
        model = kmeans.KMeans(df, spark.createDataFrame([("g", 3), ("h", 1)], "g string, k int"), most=3, starts=2)
        assert "term" not in model.bands.columns and "term" not in model.state.columns
        held = model.bands.where("g = 'g'").agg(F.count(F.lit(1)).alias("bands"), (F.sum(F.length("code")) / 4).alias("entries")).first()
        assert held.bands > 1 or entries > len(rows)
        assert held.entries <= 90 * (4 + held.bands) + 12 + 1
        found.append(sorted(tuple(x) for x in model.fit().collect()))
    assert len(found[0]) == 99 and found[0] == found[1]
    of = {i: c for g, i, c in found[0] if g == "g"}
    assert len({of[str(i)] for i in range(90, 96)}) == 1


def test_words_are_tokenized_once(monkeypatch):
    """Words that every slice has once are remembered; those not seen for long are dropped, and come back right."""
    import pyarrow as pa

    from tidemark.llm import packing, queries

    coder, asked = packing.WordIds(queries.tokenizer_path(), 1), []
    plain = coder._words
    monkeypatch.setattr(coder, "_words", lambda words: asked.extend(words) or plain(words))
    texts = [" ".join(f"Wort{i},x" for i in range(50)), None, "", "été   a\x1cb \x01"]
    first = coder.ids(pa.array(texts))
    again = coder.ids(pa.array(texts))
    assert len(asked) == len(set(asked)) and first[0].tolist() == again[0].tolist() and first[1].tolist() == again[1].tolist()
    monkeypatch.setattr(packing, "CACHE", 20)
    for i in range(5):
        coder.ids(pa.array([" ".join(f"{i}-{j}" for j in range(30)) + " Wort1,x"]))
        assert len(coder.known) + len(coder.older) <= 2 * (20 + 31)
    assert asked.count("Wort1,x") == 1 and asked.count("Wort2,x") == 1
    third = coder.ids(pa.array(texts))
    assert first[0].tolist() == third[0].tolist() and asked.count("Wort2,x") == 2 and asked.count("Wort1,x") == 1
    whole = [plain_ids + [1] for plain_ids in (coder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts[:3])]
    assert first[0].tolist()[: sum(map(len, whole))] == [x for ids in whole for x in ids] and first[1].tolist()[:3] == [len(x) for x in whole]
