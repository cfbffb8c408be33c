"""Readers and writers on real files."""

import gzip
import json
from hashlib import blake2b

import pytest
from pyspark.sql import functions as F

from tidemark.operators import flows, sampling
from tidemark.sources import lines, readers, sinks


@pytest.fixture
def folder(tmp_path):
    raw = [json.dumps({"b": i, "a": "é" * (i % 7), "brand": "Anker"}, ensure_ascii=False).encode() for i in range(900)]
    raw[3], raw[5], raw[7], raw[11], raw[13] = b"", b"not json", b"[1, 2]", b'{"a": "\xff\xfe ok", "b": 1}', b"  {\"a\" : 1 , \"B\": null}\t"
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_bytes(b"\n".join(raw) + b"\n")
    with gzip.open(tmp_path / "in" / "b.jsonl.gz", "wb") as f:
        f.write(b"\n".join(raw[:20]))
    return tmp_path, raw


def plain_lines(raw):
    """What a text file opened with replacement gives."""
    return {i: line.decode("utf-8", errors="replace") for i, line in enumerate(raw, 1)}


def test_line_numbers_for_any_split(spark, folder):
    tmp, raw = folder
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for most in ("512", "3000", "1g"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", most)
            got = lines.lines(spark, str(tmp / "in"))
            assert most == "1g" or got.rdd.getNumPartitions() > 1
            by = {}
            for r in got.collect():
                by.setdefault(r.file.rsplit("/", 1)[1], {})[r.line_no] = r.value
            assert by == {"a.jsonl": plain_lines(raw), "b.jsonl.gz": plain_lines(raw[:20])}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_objects_and_seeded_scores(spark, folder):
    """The selection of the plain reader: canonical objects by line, the smallest scores of a stratum."""
    tmp, raw = folder
    got = lines.objects(lines.lines(spark, str(tmp / "in" / "a.jsonl"))).withColumn("stratum", F.col("line_no") % 3)
    scored = got.withColumn("score", lines.seeded_score(42, F.col("line_no"), F.lit("Anker"), F.col("value")))
    want = []
    for i, line in plain_lines(raw).items():
        try:
            row = json.loads(line.strip())
        except ValueError:
            continue
        if isinstance(row, dict):
            payload = json.dumps(row, sort_keys=True, ensure_ascii=False, separators=(",", ":"))
            want.append((int.from_bytes(blake2b(f"42|{i}|Anker|{payload}".encode(), digest_size=8).digest(), "big"), i, payload))
    assert {(int.from_bytes(r.score, "big"), r.line_no, r.value) for r in scored.collect()} == set(want)
    quotas = spark.createDataFrame([(0, 5), (1, 7), (2, 0)], "stratum long, quota int")
    picked = sampling.stratified(scored, quotas, ["stratum"], F.col("score"), ["line_no"]).collect()
    best = lambda s, n: {i for _, i, _ in sorted(x for x in want if x[1] % 3 == s)[:n]}
    assert {r.line_no for r in picked} == best(0, 5) | best(1, 7)


def test_csv_by_name(spark, tmp_path):
    (tmp_path / "errors_dense.csv").write_text("query_id,error_type\nq1,no_gold_hit\nq2,good\n")
    (tmp_path / "errors_lexical.csv").write_text("query_id,error_type\nq1,no_gold_hit\nq3,no_gold_hit\n")
    (tmp_path / "errors_rrf.csv").write_text("query_id,error_type\n")
    (tmp_path / "other.csv").write_text("query_id,error_type\nq9,no_gold_hit\n")
    pattern, name = str(tmp_path / "errors_*.csv"), r"errors_(.*)\.csv"
    assert {(r.query_id, r.mode) for r in lines.csv_by_name(spark, pattern, name).collect()} == {("q1", "dense"), ("q2", "dense"), ("q1", "lexical"), ("q3", "lexical")}
    assert {tuple(r) for r in lines.missed_in(spark, pattern, name).collect()} == {("q1", 2, 3), ("q3", 1, 3)}


def test_readers(spark, folder, tmp_path):
    tmp, raw = folder
    (tmp_path / "ids.jsonl").write_text('{"review_id": "7"}\n{"source_id": "x"}\n{"review_id": "7", "source_id": "y"}\n{}\n')
    assert [r.id for r in readers.id_list(spark, str(tmp_path / "ids.jsonl")).orderBy("pos").collect()] == ["7", "x"]
    (tmp_path / "m.csv").write_text("brand,count\nAnker,3\nJBL,many\n")
    assert {tuple(r) for r in readers.metric_csv(spark, str(tmp_path / "m.csv"), "brand", "count").collect()} == {("Anker", 3), ("JBL", 0)}
    assert readers.rejected(spark, str(tmp / "in" / "a.jsonl"), "a string").where("_bad = 'not json'").count() == 1
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.jsonl(spark, str(tmp / "in" / "a.jsonl"), "a string, b long", strict=True).collect()
    meta = spark.createDataFrame([("p", "c", "t", "store", '{"Brand": "Anker"}', None), (None, "d", "t", "JBL", None, None), ("q", "q", "t", None, "{}", None)], readers.METADATA)
    assert {tuple(r) for r in readers.brand_of_metadata(meta).collect()} == {("p", "Anker"), ("d", "JBL")}
    review = spark.createDataFrame([("4.5", " A title ", "Body. ", "b1", None, "u", "1700000000000", "3.0", "True", None, None, None)], readers.REVIEW)
    r = readers.normalized(review, F.lit("Anker")).first()
    assert (r.source_id, r.asin, r.rating, r.verified, r.helpful_count, r.text_raw, str(r.posted_at)) == ("u_b1_1700000000000", "b1", 4, True, 3, "A title. Body.", "2023-11-14 22:13:20")


def test_writers(spark, tmp_path):
    rows = spark.createDataFrame([(i, None if i % 2 else "x") for i in range(50)], "i long, v string")
    for n in (1, 7):
        sinks.write_jsonl(rows.repartition(n), str(tmp_path / f"j{n}"), order=["i"])
    read = lambda n: "".join(gzip.open(p, "rt").read() for p in sorted((tmp_path / f"j{n}").glob("part*")))
    assert read(1) == read(7) and read(1).startswith('{"i":0,"v":"x"}\n{"i":1,"v":null}\n')
    sinks.write_csv(rows.limit(2), str(tmp_path / "c"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "c")).columns == ["i", "v"]
    good = spark.createDataFrame([(1, [1.0, 2.0])], "id long, v array<double>")
    assert sinks.check_vectors(good, "v", 2).count() == 1
    with pytest.raises(Exception, match="expected 3 components, found 2"):
        sinks.check_vectors(good, "v", 3).collect()


def test_merge_is_idempotent(spark, tmp_path):
    kind, path = "version string, granularity string, cluster string, week int, n long", str(tmp_path / "incidents")
    first = [("v1", "aspect", None, 1, 5), ("v1", "cluster", "a", 1, 6), ("v1", "cluster", "a", 2, 7), ("v2", "aspect", None, 1, 8)]
    batch = [("v1", "aspect", None, 1, 50), ("v1", "cluster", "a", 2, 70), ("v1", "cluster", "b", 3, 9)]
    df = lambda rows: spark.createDataFrame(rows, kind)
    held = lambda: {(r.version, r.granularity, r.cluster, r.week, r.n) for r in spark.read.parquet(path).collect()}
    keys, scope = ["cluster", "week"], ["version", "granularity"]
    sinks.merge_scope(spark, df(first), path, keys, scope)
    assert held() == set(first)
    others = sorted((tmp_path / "incidents/version=v2").rglob("*.parquet"))
    want = {batch[0], first[1], batch[1], batch[2], first[3]}
    for _ in range(2):
        sinks.merge_scope(spark, df(batch), path, keys, scope)
        assert held() == want
    # other scopes keep their very files
    assert sorted((tmp_path / "incidents/version=v2").rglob("*.parquet")) == others
    # a batch that fails half-way leaves the table as it was, and may be run again
    broken = df(batch).withColumn("n", F.when(F.col("week") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("n") * 2))
    with pytest.raises(Exception, match="lost"):
        sinks.merge_scope(spark, broken, path, keys, scope)
    assert held() == want
    sinks.merge_scope(spark, df(batch), path, keys, scope)
    assert held() == want
    sinks.clear_scope(spark, path, df(batch).where("granularity = 'cluster' AND week = 2").select("version", "granularity", "cluster"), scope, ["cluster"])
    assert held() == {batch[0], batch[2], first[3]}
    sinks.clear_scope(spark, path, df(first).where("version = 'v2'").select("version", "granularity"), scope, [])
    assert held() == {batch[0], batch[2]}


def test_ledger(spark):
    runs = flows.opened_run(spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "run_id string, started_at int"))
    assert {tuple(r) for r in runs.select("run_id", "finished_at", "rows_in", "status").collect()} == {(x, None, None, "running") for x in "abc"}
    rows = spark.createDataFrame([("a", 5, None), ("a", 6, "bad"), ("b", 7, "bad")], "batch string, t int, dq_reason string")
    got = {r.run_id: (r.started_at, r.finished_at, r.rows_in, r.rows_loaded, r.rows_failed, r.status) for r in flows.closed_run(rows, F.col("batch"), F.col("t"), opened=runs).collect()}
    assert got == {"a": (1, 6, 2, 1, 1, "success"), "b": (2, 7, 1, 0, 1, "failed"), "c": (3, 3, 0, 0, 0, "empty")}
