"""Flows and evaluation sets: queries against their SQL, and cases that the tables don't hold."""

import pytest
from pyspark.sql import functions as F

from tests.test_queries import test_equals_sql as equals_sql
from tidemark.operators import agent, brand, dq, evaluation, flows, metrics

NAMES = ["indexing_input", "mention_events", "cluster_run_summary", "absa_error_rows", "label_errors", "label_distribution", "holdout_predictions", "golden_validation", "dataset_profile", "latency_p95", "agent_metrics"]
MENTION = evaluation.MENTION


@pytest.mark.parametrize("name", NAMES)
def test_flow_equals_sql(spark, sf, name):
    equals_sql(spark, sf, name)


def test_error_classes(spark):
    m = lambda code, s, v, q: (code, s, v, q)
    rows = [
        (1, "the battery died", [m("battery", "negative", "high", "battery died")], [m("battery", "negative", "low", "battery died"), m("battery", "neutral", None, "the")]),
        (2, "good sound", [m("sound_quality", "positive", None, "good")], [m("sound_quality", "neutral", None, "great")]),
        (3, None, [], [m("price", "neutral", None, "")]),
        (4, "x", [], []),
        (5, "x", [m("price", "neutral", None, "x")], [m("price", "positive", None, "x")]),
    ]
    got = {(r.id, r.code): r.error for r in evaluation.error_rows(spark.createDataFrame(rows, f"id int, text string, gold {MENTION}, predicted {MENTION}"), "id").collect()}
    assert got == {(1, "battery"): "wrong_severity", (2, "sound_quality"): "non_verbatim_evidence", (3, "price"): "extra_aspect", (4, None): "correct", (5, "price"): "wrong_sentiment"}


def test_labels_with_duplicates_and_nulls(spark):
    rows = [(1, "a b", [("price", "neutral", None, "a"), ("price", "neutral", None, "b")], None), (2, "a", None, True), (3, "a", [], True), (4, "a", [], False)]
    df = spark.createDataFrame(rows, f"id int, text string, gold {MENTION}, reviewed boolean")
    checked = {r.id: (r.errors, len(r.sound)) for r in evaluation.label_errors(df, "id").collect()}
    assert checked == {1: (["2:duplicate_code"], 2), 2: (["missing"], 0), 3: ([], 0), 4: ([], 0)}
    assert tuple(evaluation.label_report(evaluation.label_errors(df, "id"), "reviewed").first()) == (4, 1, 1, 2)
    assert {r.id for r in evaluation.labeled(df, "reviewed", order="id", most=2).collect()} == {1, 2}


def test_gates_notes_and_scopes(spark):
    items = spark.createDataFrame([("Anker", 30), ("Soundcore", 25), ("JBL", 3), ("Bose", 0), ("Aukey", 40)], "brand string, items long")
    seen = spark.createDataFrame([("Anker", 2000), ("Soundcore", 5), ("JBL", 4)], "brand string, reviews long")
    got = {r.brand: r.reason for r in brand.gate(items, seen, merged=("Soundcore", "Anker")).collect()}
    assert got == {
        "Anker": "ok", "Soundcore": "too few matched reviews or merged under Anker", "JBL": "below thresholds: 3 items < 20 and 4 reviews < 1000",
        "Bose": "not found in metadata", "Aukey": "no matched reviews after metadata join",
    }
    notes = spark.createDataFrame([(["title", "store"],), (["details_json"],), (["title"],)], "f array<string>").select(brand.confidence_note(F.col("f")).alias("n")).collect()
    assert [r.n.split(":")[0] for r in notes] == ["high", "medium", "medium"]
    rows = spark.createDataFrame([(1, "v2"), (1, "v1"), (2, "v2"), (None, "v2")], "id int, version string")
    kept = flows.without_ids(rows, spark.createDataFrame([(1,), (None,)], "id int"), {"version": "v2"}, "id")
    assert sorted(map(str, kept.collect())) == sorted(map(str, [*spark.createDataFrame([(1, "v1"), (2, "v2"), (None, "v2")], rows.schema).collect()]))


def test_answers_keep_to_evidence(spark):
    q = spark.createDataFrame([(1, "How is the battery?"), (2, "What of reliability?"), (3, "Any weather?"), (4, "None found?")], "query_id int, question string")
    hits = spark.createDataFrame([(1, 1, 10, "battery is fine", "it lasts", ["price"]), (2, 1, 11, "it went", "", ["reliability"]), (3, 1, 12, "sound", "", [])], "query_id int, rank int, doc_id long, text string, quote string, codes array<string>")
    got = {r.query_id: r for r in agent.answer(q, agent.citations(hits, quote="quote", aspects="codes")).collect()}
    assert 'one review states: "it lasts" [1].' in got[1].answer and 'states: "it went" [1].' in got[2].answer
    assert [got[i].insufficient for i in (1, 2, 3, 4)] == [False, False, True, True] and agent.SENTINEL not in got[3].answer and got[3].uncited


def test_exact_percentile_and_duplicates(spark):
    rows = [("a", float(i % 37)) for i in range(1000)] + [("b", 5.0), ("c", -1.0), ("c", 2.5)]
    got = {r.g: r.at_rank for r in metrics.nearest_rank(spark.createDataFrame(rows, "g string, v double"), "g", "v", buckets=4).collect()}
    want = {g: sorted(v for k, v in rows if k == g) for g in "abc"}
    assert got == {g: v[int((len(v) - 1) * 0.95)] for g, v in want.items()}
    df = spark.createDataFrame([(1, "k"), (2, "k"), (3, None), (4, None)], "id int, k string")
    tagged = dq.tag(df, key="k", position="id", asin=F.lit("x"), rating=F.lit(3), language=F.lit("en"), confidence=F.lit(1.0), text=F.lit("a long enough text of words"))
    assert {r.id: r.dq_reason for r in tagged.collect()} == {1: None, 2: "duplicate_review_id", 3: None, 4: "duplicate_review_id"}
