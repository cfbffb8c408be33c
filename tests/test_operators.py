"""Operators on small inputs with known results."""

import datetime as dt
import re
import uuid

from pyspark.sql import functions as F

from tidemark.functions import scalar
from tidemark.operators import absa, agent, anomaly, brand, dq, metrics, retrieval, sampling
from tidemark.operators import lexicon as lx
from tidemark.plans import queries_text
from tidemark.sources import readers, sinks


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_known_spike_gives_one_incident(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [("s", i, start + dt.timedelta(weeks=w), "high", 2) for w, n in enumerate([2, 2, 2, 2, 2, 12]) for i in range(n)]
    df = spark.createDataFrame(rows, "aspect string, review_id long, posted_at timestamp, severity string, rating int")
    weeks = anomaly.weekly(df, ["aspect"])
    found = anomaly.detect(weeks, ["aspect"]).collect()
    assert weeks.count() == 6 and len(found) == 1
    assert found[0].volume == 12 and found[0].baseline < 5 and found[0].z >= 2


def test_first_failing_check_and_duplicates(spark):
    good = "a perfectly good review of a thing"
    rows = [(0, "k0", "a", 5, "en", 0.9, good), (1, "k1", "a", 0, "en", 0.9, good), (2, "k2", "a", 5, "de", 0.9, good), (3, "k3", "a", 5, "en", 0.9, "hi"), (4, "k1", "a", 0, "en", 0.9, good), (5, "k5", None, 5, "en", 0.9, good), (6, "k6", "a", 5, "en", 0.9, "https://example.com/a/long/link"), (7, "k7", "a", 5, "en", 0.9, "THIS IS ALL IN CAPITALS"), (8, "k8", "a", None, "en", 0.9, None)]
    df = spark.createDataFrame(rows, "pos int, key string, asin string, rating int, lang string, conf double, text string")
    t = dq.tag(df, key="key", position="pos", asin=F.col("asin"), rating=F.col("rating"), language=F.col("lang"), confidence=F.col("conf"), text=F.col("text"))
    assert [r.dq_reason for r in t.orderBy("pos").collect()] == [None, "invalid_rating", "non_english_language", "text_too_short", "duplicate_review_id", "missing_asin", "empty_or_spam", "empty_or_spam", "invalid_rating"]
    assert sum(r.n_failed for r in dq.metrics(t).collect()) == 8 and dq.metrics(t).count() == 7


def test_scalars(spark):
    r = one(
        spark,
        scalar.uuid5(F.lit("1|v2|mock|mock")).alias("u"),
        scalar.round_rating(F.lit("2.5")).alias("even"),
        scalar.coerce_bool(F.lit(" Yes ")).alias("b"),
        scalar.coerce_int(F.lit("x"), 7).alias("i"),
        scalar.coerce_posted_at(F.lit("2024-05-01T10:00:00Z")).alias("iso"),
        scalar.coerce_posted_at(F.lit("1714557600000")).alias("ms"),
        scalar.sentence_with(F.lit("One. The Battery died! Two."), F.lit("battery")).alias("s"),
        scalar.strip_unsupported(F.lit("a [1]  b [9]."), F.array(F.lit(1))).alias("c"),
        F.length(scalar.snippet(F.lit("x" * 300))).alias("n"),
    )
    assert r.u == str(uuid.uuid5(uuid.UUID(scalar.POINT_NAMESPACE), "1|v2|mock|mock"))
    assert (r.even, r.b, r.i, r.n) == (2, True, 7, 240)
    assert r.iso == r.ms == dt.datetime(2024, 5, 1, 10)
    assert r.s == "The Battery died!" and r.c == "a [1] b ."


def test_extraction_and_guards(spark):
    texts = ["The battery died. Great bass!", "The package was broken. It failed.", "It stopped working after a fire.", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "review_id int, text string")
    out = {r.review_id: {m["code"]: (m["sentiment"], m["severity"]) for m in r.mentions} for r in absa.extract(df).collect()}
    assert out[0]["battery"] == ("negative", "medium") and out[0]["sound_quality"] == ("positive", None)
    assert out[2]["reliability"] == ("negative", "high") and out[3] == out[4] == {}
    v = absa.validate(absa.extract(df))
    assert v.where("error IS NOT NULL").count() == 0
    assert {r.review_id: r.status for r in absa.review_status(df, v).collect()}[3] == "no_mentions"


def test_reliability_extract_reads_whole_texts(spark, tmp_path):
    texts = ["The charger broke. All fine otherwise", "audio is great!\nit lasted only a day", "shipping was slow and the box was broken", "the package failed", "nothing here", "", "It QUIT working?! The price is bad", "died in a fire. died"]
    tails = (" It stopped working. ", " The package failed us! ", " The battery died. ", " Shipping was bad.")
    rows = [(i, t, x) for i, x in enumerate(texts) for t in range(4)]
    spark.createDataFrame(rows, "conv_id long, turn long, text string").write.parquet(str(tmp_path / "conversations.parquet"))

    def sentence(text, word):
        return re.search(rf"(?i)[^.!?\n]*{re.escape(word)}[^.!?\n]*[.!?\n]?", text)[0].strip()

    def holds(low, words):
        return any(w in low for w in words)

    true = set()
    for i, t, x in rows:
        text, quotes = x + tails[t], {}
        for code, words in lx.ASPECTS.items():
            if first := next((w for w in words if w in text.lower()), None):
                quotes[code] = sentence(text, first)
        specific = [w for code, words in lx.ASPECTS.items() if code != "delivery" for w in words]
        for w in lx.RELIABILITY:
            low = sentence(text, w).lower() if w in text.lower() else ""
            if low and not holds(low, specific) and not (holds(low, lx.SHIPPING) and not holds(low, lx.PRODUCT_FAILURE)):
                quotes["reliability"] = sentence(text, w)
                break
        for code, q in quotes.items():
            neg, pos = holds(q.lower(), lx.NEGATIVE), holds(q.lower(), lx.POSITIVE)
            severity = ("high" if holds(q.lower(), lx.HIGH) else "medium" if holds(q.lower(), lx.MEDIUM) else "low") if neg and not pos else None
            true.add((i, t, code, "negative" if neg and not pos else "positive" if pos and not neg else "neutral", severity, q))
    got = queries_text.reliability_extract(spark, str(tmp_path)).collect()
    assert len(got) == len(true) and {(r.conv_id, r.turn, r.code, r.sentiment, r.severity, r.quote) for r in got} == true


def test_model_answers_are_parsed_strictly(spark):
    raw = ['noise {"aspects":[{"aspect_code":"price","sentiment":"negative","severity":"low","evidence_quote":"dear"}]} end', '{"aspects":[{"aspect_code":"price","sentiment":"negative","severity":null,"evidence_quote":"dear"}]}', "no json"]
    got = [r.mentions for r in absa.parse(spark.createDataFrame(list(enumerate(raw)), "i int, raw string")).orderBy("i").collect()]
    assert got[0][0]["code"] == "price" and got[1] is None and got[2] is None


def test_fusion_and_metrics(spark):
    a = spark.createDataFrame([(1, 10, 1), (1, 11, 2)], "query_id int, doc_id int, rank int")
    b = spark.createDataFrame([(1, 11, 1), (1, 12, 2)], "query_id int, doc_id int, rank int")
    assert [r.doc_id for r in retrieval.rrf([a, b]).orderBy("rank").collect()] == [11, 10, 12]
    assert [r.doc_id for r in retrieval.first_then(a, b).orderBy("rank").collect()] == [10, 11, 12]
    gold = spark.createDataFrame([(1, 11), (1, 99)], "query_id int, doc_id int")
    m = metrics.ranking_metrics(a, gold, ks=(5,)).first()
    assert (m.hit_at_5, m.recall_at_5, m.rr_at_10, m.r_precision) == (1.0, 0.5, 0.5, 0.5)


def test_quota_brand_and_routes(spark):
    n = spark.createDataFrame([("a", 1, 70), ("a", 2, 30), ("b", 1, 5)], "brand string, rating int, n long")
    t = spark.createDataFrame([("a", 11), ("b", 9)], "brand string, target int")
    assert {(r.brand, r.rating): r.quota for r in sampling.largest_remainder(n, t, "brand", ["rating"]).collect()} == {("a", 1): 8, ("a", 2): 3, ("b", 1): 5}
    r = one(spark, brand.resolve({"store": F.lit("Soundcore by Anker"), "title": F.lit("bose")}).alias("a"), brand.canonical(F.lit("ankerx")).alias("b"))
    assert (r.a, r.b) == ("Soundcore", None)
    q = ["any spike in battery?", "how many reviews", "what do customers say", "the charger", "weather"]
    got = agent.routed(spark.createDataFrame([(x,) for x in q], "question string")).collect()
    assert [r.route for r in got] == ["incident_summary", "analytics_summary", "retrieval_answer", "retrieval_answer", "insufficient_scope"]


def test_upserts_and_reads(spark, tmp_path):
    held = spark.createDataFrame([(1, None, "x"), (2, "c", "y")], "a int, b string, v string")
    new = spark.createDataFrame([(1, None, "z")], "a int, b string, v string")
    assert sorted(r.v for r in sinks.upsert(held, new, ["a", "b"]).collect()) == ["y", "z"]
    p = tmp_path / "r.jsonl"
    p.write_text('{"a": 1, "t": "x"}\n\nnot json\n[1]\n{"a": 2}\n')
    df = readers.jsonl(spark, str(p), "a int, t string")
    assert sorted(r.a for r in df.collect()) == [1, 2] and readers.count_lines(spark, str(p)) == 4


def test_streaming_weeks(spark, tmp_path, sf):
    from tidemark.streaming import weekly

    got = weekly.run_once(spark, sf, str(tmp_path / "out"), str(tmp_path / "ck"), files="events.parquet")
    assert got.agg(F.sum("volume")).first()[0] > 0


def test_bm25_fills_up_before_negative_scores(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "a"), (3, "")], "doc_id long, text string")
    q = spark.createDataFrame([(9, "a"), (8, "")], "query_id long, text string")
    for limit in (1, 3):
        got = {(r.query_id, r.rank): r.doc_id for r in retrieval.bm25(docs, q, limit=limit).collect()}
        want = {(9, 1): 3, (9, 2): 1, (9, 3): 2, (8, 1): 1, (8, 2): 2, (8, 3): 3}
        assert got == {k: v for k, v in want.items() if k[1] <= limit}
