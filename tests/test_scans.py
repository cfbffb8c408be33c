"""Scans over long sequences and answers from counts, against plain versions."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import absa, scans, tools


@pytest.fixture(autouse=True)
def stretches(spark):
    """Small inputs in several tasks as well."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_ewma_of_long_and_short_series(spark):
    r = random.Random(2)
    rows = [("long", i, r.uniform(0, 9)) for i in range(40_000)] + [(None, i, float(i)) for i in range(700)] + [(f"s{i}", 0, 5.0) for i in range(30)]
    shuffled = rows[:]
    r.shuffle(shuffled)
    df = spark.createDataFrame(shuffled, "s string, t long, x double")
    got = {(x.s, x.t): x.e for x in scans.ewma(df, "x", ["s"], ["t"], 4, "e").collect()}
    state, want = {}, {}
    for s, t, x in rows:
        want[s, t] = state.get(s)
        state[s] = x if s not in state else 0.4 * x + 0.6 * state[s]
    assert set(got) == set(want)
    assert all(got[k] is None if v is None else got[k] == pytest.approx(v, rel=1e-12) for k, v in want.items())


def test_sums_of_stretches(spark):
    df = scans.numbered(spark.range(5000).select((F.col("id") * 7919 % 5000).alias("t"), (F.col("id") % 3).alias("g")), ["g"], ["t"])
    assert df.select(F.shiftright("at", 33)).distinct().count() > 1
    got = scans.running_sums(df, ["g"], "at", {"n": F.lit(1), "total": F.col("t")})
    run = collections.defaultdict(int)
    for x in sorted(got.collect(), key=lambda x: (x.g, x.t)):
        run[x.g, "n"] += 1
        run[x.g, "t"] += x.t
        assert (x.n, x.total) == (run[x.g, "n"], run[x.g, "t"])


@pytest.mark.parametrize(("cap", "most"), [(None, 0.3), (4000, 0.9), (10**9, 0.99)])
def test_whole_log_stops_where_one_scope_does(spark, cap, most):
    r = random.Random(6)
    rows = [(i, r.random() < (0.1 if i < 3000 else 0.8), r.randint(0, 5)) for i in range(6000)]
    df = spark.createDataFrame(rows, "t long, bad boolean, cost long").repartition(7)
    how = {"most": most, "cost": F.col("cost") if cap else None, "cost_cap": cap}
    key = lambda d: sorted((x.t, x.n_seen, x.n_bad, x.stopped) for x in d.collect())
    whole = key(absa.up_to_breach(df, F.col("bad"), "t", **how))
    assert whole == key(absa.up_to_breach(df.withColumn("one", F.lit(1)), F.col("bad"), "t", scope=["one"], **how))
    assert (len(whole) < 6000) == (most < 0.99) and whole[-1][3] == (most < 0.99)


MENTIONS = [("battery", "negative", "high", "Anker"), ("battery", "negative", "low", "JBL"), ("battery", "positive", None, "Anker"), ("price", "negative", "high", None), ("price", "neutral", None, "JBL"), (None, "negative", "high", "JBL")]


def test_counts_for_every_choice_of_facets(spark):
    cube = tools.counts_cube(spark.createDataFrame(MENTIONS, "aspect string, sentiment string, severity string, brand string")).collect()
    got = {tuple(r) for r in cube}
    assert len(got) == len(cube)
    want = collections.Counter()
    for m in MENTIONS:
        facets = dict(zip(tools.FACETS, m, strict=True))
        for kind in ("severity", "sentiment", "aspect"):
            others = [f for f in tools.FACETS if f != kind]
            for bits in range(8):
                held = {f: facets[f] for i, f in enumerate(others) if bits >> i & 1}
                if facets[kind] is not None and None not in held.values():
                    want[kind, facets[kind], *[held.get(f) for f in tools.FACETS]] += 1
    assert got == {(*k, n) for k, n in want.items()}


def test_answers(spark):
    mentions = spark.createDataFrame(MENTIONS, "aspect string, sentiment string, severity string, brand string")
    statuses = spark.createDataFrame([("success",), ("success",), ("failed",)], "status string")
    counts = tools.counts_cube(mentions).unionByName(tools.status_counts(statuses))
    asked = [(1, "severity of it", None, None, None), (2, "sentiment of battery", "battery", None, None), (3, "status?", "battery", "negative", "JBL"), (4, "how many", None, None, None), (5, "how many", None, "positive", "Anker"), (6, "sentiment", None, None, "Bose"), (7, "severity", "price", "positive", None), (8, "how many", None, None, None)]
    got = {r.question_id: (r.total, r.answer) for r in tools.analytics(spark.createDataFrame(asked, "question_id long, question string, aspect string, sentiment string, brand string"), counts).collect()}
    assert got == {
        1: (4, "Severity distribution of negative mentions: high=3, low=1."),
        2: (3, "Sentiment distribution of aspect mentions: negative=2, positive=1."),
        3: (3, "ABSA processing-status distribution: success=2, failed=1."),
        4: (5, "Aspect distribution across 5 mentions: battery=3, price=2. Largest aspect: battery (3 mentions). Most negative aspect: battery (2 negative mentions)."),
        5: (1, "Aspect distribution across 1 mentions: battery=1. Largest aspect: battery (1 mentions). Most negative aspect: battery (1 negative mentions)."),
        6: (0, "Sentiment distribution of aspect mentions: (none)."),
        7: (1, "Severity distribution of negative mentions: high=1."),
        8: (5, "Aspect distribution across 5 mentions: battery=3, price=2. Largest aspect: battery (3 mentions). Most negative aspect: battery (2 negative mentions)."),
    }


def test_incident_answers(spark):
    rows = [("battery", "cluster", "dies fast", i, 10 + i, 2.5, 3.0 + i, 8.0 * i, "It spiked." if i == 7 else None) for i in range(1, 8)] + [("price", "aspect", None, 3, 9, 4.0, 2.126, 12.0, "")]
    df = spark.createDataFrame(rows, "aspect string, granularity string, cluster_label string, d int, volume int, baseline double, z double, severity_score double, summary string").withColumn("week_start", F.date_add(F.lit("2024-01-01").cast("date"), F.col("d") * 7))
    asked = spark.createDataFrame([(1, None), (2, "price"), (3, "delivery")], "question_id long, aspect string")
    got = {r.question_id: (r.n_incidents, r.answer) for r in tools.incident_answers(asked, df).collect()}
    assert got[2] == (1, "Top 1 emerging-issue incident(s) by severity score:\n1. [aspect] price (aspect-level) — week 2024-01-22: observed 9 vs baseline 4.0 (z=2.13, severity 12.0).")
    assert got[3] == (0, "No emerging-issue incidents have been detected.")
    assert got[1][0] == 5 and got[1][1].split("\n")[1:3] == ["1. [cluster] dies fast — week 2024-02-19: observed 17 vs baseline 2.5 (z=10.0, severity 56.0).", "   It spiked."]
    assert [r.aspect for r in tools.incident_aspects(df).collect()] == ["battery", "price"] and [r.granularity for r in tools.incident_granularities(df).collect()] == ["aspect", "cluster"]
