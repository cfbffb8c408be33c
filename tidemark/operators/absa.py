"""Aspects in reviews: extraction by lexicon, validation against the text, review status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import contains_any, first_contained, let, readable, sentence_in, strip
from tidemark.operators import lexicon as lx
from tidemark.operators import scans

MENTION = "array<struct<code:string,sentiment:string,severity:string,quote:string>>"


def _judged(low: Column) -> tuple[Column, Column]:
    """Sentiment and severity (of negative ones only) of a lower-cased quote."""
    neg, pos = contains_any(low, lx.NEGATIVE), contains_any(low, lx.POSITIVE)
    feeling = F.when(neg & ~pos, "negative").when(pos & ~neg, "positive").otherwise("neutral")
    return feeling, F.when(neg & ~pos, F.when(contains_any(low, lx.HIGH), "high").when(contains_any(low, lx.MEDIUM), "medium").otherwise("low"))


def _mentions(quotes: Column) -> Column:
    """From (code, quote): the mentions with sentiment and severity; each quote is lower-cased once."""
    some = F.filter(quotes, lambda m: F.coalesce(m["quote"] != "", F.lit(False)))
    lowered = F.transform(some, lambda m: F.struct(m["code"].alias("code"), m["quote"].alias("quote"), F.lower(m["quote"]).alias("low")))

    def one(m: Column) -> Column:
        feeling, weight = _judged(m["low"])
        return F.struct(m["code"].alias("code"), feeling.alias("sentiment"), weight.alias("severity"), m["quote"].alias("quote"))

    return F.transform(lowered, one)


def _reliability(r: Column) -> Column:
    """The sentence of the first keyword that no guard rejects."""
    specific = [k for code, words in lx.ASPECTS.items() if code != "delivery" for k in words]
    held = F.filter(F.array(*[F.lit(k) for k in lx.RELIABILITY]), lambda k: F.contains(r["low"], k))
    found = F.transform(held, lambda k: sentence_in(r, k))
    found = F.transform(found, lambda q: F.struct(q.alias("q"), F.lower(q).alias("low")))
    good = lambda x: (x["q"] != "") & ~contains_any(x["low"], specific) & ~(contains_any(x["low"], lx.SHIPPING) & ~contains_any(x["low"], lx.PRODUCT_FAILURE))
    return F.get(F.filter(found, good), F.lit(0))["q"]


def extract(reviews: DataFrame, text: str = "text", aspects: dict[str, tuple[str, ...]] | None = None, reliability: bool = True, out: str = "mentions") -> DataFrame:
    """Adds the mentions of each review: at most one for each aspect, with the sentence that holds its
    first keyword. Keywords match inside words. Nothing but column expressions; what they share of a
    text is computed once."""

    def quotes(r: Column) -> Column:
        of = lambda words: let(first_contained(r["low"], words), lambda k: sentence_in(r, k))
        found = [F.struct(F.lit(code).alias("code"), of(words).alias("quote")) for code, words in (aspects or lx.ASPECTS).items()]
        if reliability:
            found.append(F.struct(F.lit("reliability").alias("code"), _reliability(r).alias("quote")))
        return F.array(*found)

    return reviews.withColumn(out, _mentions(let(readable(F.coalesce(F.col(text), F.lit(""))), quotes)))


def parse(answers: DataFrame, raw: str = "raw") -> DataFrame:
    """Mentions from a model's JSON text; one malformed mention fails the whole answer (null mentions)."""
    found = F.from_json(F.nullif(F.regexp_extract(raw, r"(?s)\{.*\}", 0), F.lit("")), "aspects array<struct<aspect_code:string,sentiment:string,severity:string,evidence_quote:string>>")["aspects"]
    negative = lambda m: m["sentiment"] == "negative"
    sound = lambda m: F.coalesce(m["sentiment"].isin(*lx.SENTIMENTS) & (strip(m["evidence_quote"]) != "") & (negative(m) == m["severity"].isNotNull()) & (m["severity"].isNull() | m["severity"].isin(*lx.SEVERITIES)), F.lit(False))
    shaped = F.transform(found, lambda m: F.struct(m["aspect_code"].alias("code"), m["sentiment"].alias("sentiment"), m["severity"].alias("severity"), m["evidence_quote"].alias("quote")))
    return answers.withColumn("mentions", F.when(F.forall(found, sound), shaped))


def validate(reviews: DataFrame, *, id_col: str = "review_id", text: str = "text", mentions: str = "mentions", codes: tuple[str, ...] = lx.ONTOLOGY_V2) -> DataFrame:
    """One row for each mention with error: unknown_aspect, not_verbatim, duplicate_aspect or null. The
    first valid mention of an aspect is kept."""
    m = reviews.select(F.col(id_col), F.col(text).alias("__text"), F.posexplode(mentions).alias("pos", "m")).select(id_col, "__text", "pos", "m.*")
    early = F.when(~F.col("code").isin(*codes), "unknown_aspect").when(~F.coalesce(F.contains("__text", "quote"), F.lit(False)), "not_verbatim")
    m = m.withColumn("__early", early)
    nth = F.row_number().over(Window.partitionBy(id_col, "code", F.col("__early").isNull()).orderBy("pos"))
    m = m.withColumn("error", F.coalesce("__early", F.when(nth > 1, "duplicate_aspect")))
    return m.drop("__text", "__early")


def status(n_valid: Column, n_raw: Column, n_errors: Column, failed: Column | None = None) -> Column:
    out = F.when(failed, "failed") if failed is not None else F
    return out.when(n_valid > 0, "success").when((n_raw > 0) | (n_errors > 0), "invalid").otherwise("no_mentions")


def review_status(reviews: DataFrame, validated: DataFrame, id_col: str = "review_id") -> DataFrame:
    """One row for each review: status, n_mentions, n_errors, error_codes (a map of counts)."""
    by_error = validated.groupBy(id_col, "error").count()
    per = by_error.groupBy(id_col).agg(
        F.sum(F.when(F.col("error").isNull(), F.col("count")).otherwise(0)).alias("n_mentions"),
        F.sum(F.when(F.col("error").isNotNull(), F.col("count")).otherwise(0)).alias("n_errors"),
        F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("error").isNotNull(), F.struct("error", F.col("count").cast("string").alias("n")))))).alias("error_codes"),
    )
    j = reviews.select(id_col).join(per, id_col, "left").na.fill(0, ["n_mentions", "n_errors"])
    return j.withColumn("status", status(F.col("n_mentions"), F.col("n_mentions") + F.col("n_errors"), F.col("n_errors")))


def pending(reviews: DataFrame, done: DataFrame, keys: list[str], limit: int | None = None, order: str | None = None) -> DataFrame:
    """Reviews not yet processed in the scope of `done`."""
    out = reviews.join(done.select(*keys).distinct(), keys, "left_anti")
    return out.orderBy(order or keys[0]).limit(limit) if limit else out


def resolve(ids: DataFrame, reviews: DataFrame, key: str) -> DataFrame:
    """Which of the ids exist: (key, found)."""
    return ids.select(key).distinct().join(reviews.select(key).distinct().withColumn("__f", F.lit(True)), key, "left").select(key, F.coalesce("__f", F.lit(False)).alias("found"))


def up_to_breach(rows: DataFrame, bad: Column, order: str, *, most: float, least_seen: int = 50, cost: Column | None = None, cost_cap: float | None = None, scope: list[str] | None = None) -> DataFrame:
    """Rows in order up to the first at which the share of bad ones exceeds `most` (once enough are seen) or
    the cost its cap. Without a scope the order is one sequence: its running counts come from sums of sorted
    stretches, one a task, and what each adds to the next."""
    if not scope:
        return _whole_log(rows, bad, order, most, least_seen, cost, cost_cap)
    w = Window.partitionBy(*scope).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    seen, wrong = F.count(F.lit(1)).over(w), F.sum(bad.cast("int")).over(w)
    stop = (seen >= least_seen) & (wrong / seen > most)
    if cost is not None:
        stop = stop | (F.sum(cost).over(w) > cost_cap)
    df = rows.withColumn("n_seen", seen).withColumn("n_bad", wrong).withColumn("__stop", stop.cast("int"))
    before = F.sum("__stop").over(Window.partitionBy(*scope).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn("__before", F.coalesce(before, F.lit(0))).where("__before = 0").withColumn("stopped", F.col("__stop") == 1).drop("__stop", "__before")


def _whole_log(rows: DataFrame, bad: Column, order: str, most: float, least_seen: int, cost: Column | None, cost_cap: float | None) -> DataFrame:
    sums = {"n_seen": F.lit(1), "n_bad": F.coalesce(bad, F.lit(False)).cast("int")}
    if cost is not None:
        sums["__cost"] = cost
    df = scans.running_sums(scans.numbered(rows, [], [order], "__at"), [], "__at", sums)
    stop = (F.col("n_seen") >= least_seen) & (F.col("n_bad") / F.col("n_seen") > most)
    if cost is not None:
        stop = stop | (F.col("__cost") > cost_cap)
    df = df.withColumn("stopped", stop)
    first = df.where("stopped").agg(F.min("__at").alias("__first"))  # one row
    kept = df.join(F.broadcast(first), F.lit(True)).where("__first IS NULL OR __at <= __first")
    return kept.drop("__at", "__first", "__cost")
