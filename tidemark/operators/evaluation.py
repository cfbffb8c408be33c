"""Evaluation sets: labelled rows, their validation and errors, golden queries, candidates for review.

Aspects are arrays of (code, sentiment, severity, quote).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import like_any, strip
from tidemark.operators import lexicon as lx
from tidemark.operators.absa import MENTION

#: The classes of errors, in the order in which they are looked for.
ERRORS = ("missed_aspect", "extra_aspect", "non_verbatim_evidence", "wrong_sentiment", "wrong_severity", "correct")


def is_labeled(gold: Column, *flags: Column) -> Column:
    """A row is labelled if a flag says so or if it has gold aspects."""
    out = F.coalesce(F.size(gold) > 0, F.lit(False))
    for f in flags:
        out = out | F.coalesce(f, F.lit(False))
    return out


def labeled(rows: DataFrame, *flags: str, gold: str = "gold", order: str | None = None, most: int | None = None) -> DataFrame:
    """The labelled rows; with `most`, the first of them by `order`."""
    out = rows.where(is_labeled(F.col(gold), *[F.col(f) for f in flags]))
    return out.orderBy(order).limit(most) if most else out


def with_predictions(rows: DataFrame, predictions: DataFrame, key: str, name: str = "predicted") -> DataFrame:
    """Adds predictions by key, compared as strings; rows without one get none. A table that has the
    column already keeps it."""
    if name in rows.columns:
        return rows
    p = predictions.select(F.col(key).cast("string").alias("__k"), name)
    none = F.array().cast(predictions.schema[name].dataType)
    return rows.join(p, F.col(key).cast("string") == F.col("__k"), "left").drop("__k").withColumn(name, F.coalesce(name, none))


def error_rows(rows: DataFrame, key: str, *, gold: str = "gold", predicted: str = "predicted", text: str = "text") -> DataFrame:
    """(key, code, error): the first cause for each aspect of either side, of equal codes the first counts;
    a review without errors has one row `correct` with a null code. No shuffle: rows hold their aspects."""
    first_of = lambda side, code: F.get(F.filter(side, lambda m: m["code"] == code), F.lit(0))
    codes = F.array_sort(F.array_union(F.transform(gold, lambda m: m["code"]), F.transform(predicted, lambda m: m["code"])))
    both = F.transform(F.filter(codes, lambda c: c.isNotNull()), lambda c: F.struct(c.alias("code"), first_of(F.col(gold), c).alias("g"), first_of(F.col(predicted), c).alias("p")))

    def error(x: Column) -> Column:
        g, p = x["g"], x["p"]
        unsaid = (F.coalesce(p["quote"], F.lit("")) != "") & ~F.contains(F.coalesce(text, F.lit("")), p["quote"])
        out = F.when(p.isNull(), ERRORS[0]).when(g.isNull(), ERRORS[1]).when(unsaid, ERRORS[2]).when(~g["sentiment"].eqNullSafe(p["sentiment"]), ERRORS[3])
        return out.when((g["sentiment"] == "negative") & ~g["severity"].eqNullSafe(p["severity"]), ERRORS[4])

    found = F.filter(F.transform(both, lambda x: F.struct(x["code"].alias("code"), error(x).alias("error"))), lambda x: x["error"].isNotNull())
    right = F.array(F.struct(F.lit(None).cast("string").alias("code"), F.lit(ERRORS[5]).alias("error")))
    rows = rows.select(key, found.alias("__e"))
    return rows.select(key, F.inline(F.when(F.size("__e") > 0, F.col("__e")).otherwise(right)))


def counted(rows: DataFrame, column: str, values: tuple[str, ...] = ERRORS) -> DataFrame:
    """How many rows have each of the values, also those that none has."""
    one = rows.agg(*[F.count_if(F.col(column) == v).alias(v) for v in values])
    return one.select(F.inline(F.array(*[F.struct(F.lit(v).alias(column), F.col(v).alias("n")) for v in values])))


def label_errors(rows: DataFrame, key: str, *, gold: str = "gold", text: str = "text", codes: tuple[str, ...] = lx.ONTOLOGY_V2) -> DataFrame:
    """Each row with errors (an array of position:what), n_valid and its sound aspects: unknown codes and
    sentiments, severity that negative aspects need and others mustn't have, quotes that are empty or
    not verbatim, codes that repeat. Null gold has the one error `missing`."""
    negative = lambda m: F.coalesce(m["sentiment"] == "negative", F.lit(False))
    known = lambda c, of: F.coalesce(c.isin(*of), F.lit(False))

    def of_aspect(m: Column, i: Column) -> Column:
        at = lambda bad, what: F.when(bad, F.concat((i + 1).cast("string"), F.lit(f":{what}")))
        empty = strip(F.coalesce(m["quote"], F.lit(""))) == ""
        before = F.transform(F.slice(F.col(gold), F.lit(1), i), lambda x: x["code"])
        repeats = F.coalesce(F.array_contains(before, m["code"]), F.lit(False))
        all_of = F.array(
            at(~known(m["code"], codes), "code"), at(~known(m["sentiment"], lx.SENTIMENTS), "sentiment"), at(negative(m) & ~known(m["severity"], lx.SEVERITIES), "severity_missing"),
            at(~negative(m) & (F.coalesce(m["severity"], F.lit("")) != ""), "severity_unexpected"), at(empty, "quote_empty"), at(~empty & ~F.contains(F.coalesce(text, F.lit("")), m["quote"]), "quote_not_verbatim"), at(repeats, "duplicate_code"),
        )
        return F.struct(F.array_compact(all_of).alias("errors"), m.alias("m"))

    checked = F.transform(gold, of_aspect)
    # a repeated code makes the row invalid, but the aspect itself still counts
    sound = F.filter(checked, lambda x: F.size(F.filter(x["errors"], lambda e: ~e.endswith(":duplicate_code"))) == 0)
    errors = F.when(F.col(gold).isNull(), F.array(F.lit("missing"))).otherwise(F.flatten(F.transform(checked, lambda x: x["errors"])))
    return rows.withColumn("errors", errors).withColumn("sound", F.coalesce(F.transform(sound, lambda x: x["m"]), F.array().cast(MENTION)))


def label_report(checked: DataFrame, *flags: str, gold: str = "gold") -> DataFrame:
    """One row: total, labelled, unlabelled and invalid rows."""
    good, own = F.size("errors") == 0, is_labeled(F.col(gold), *[F.col(f) for f in flags])
    return checked.agg(F.count(F.lit(1)).alias("total_rows"), F.count_if(good & own).alias("labeled_rows"), F.count_if(good & ~own).alias("unlabeled_rows"), F.count_if(~good).alias("invalid_rows"))


def label_distribution(checked: DataFrame) -> DataFrame:
    """(field, value, n) over the sound aspects: codes, sentiments and severities."""
    m = checked.select(F.explode("sound").alias("m"))
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"m.{f}").alias("value")) for f in ("code", "sentiment", "severity")])
    return m.select(F.inline(pairs)).where("value IS NOT NULL").groupBy("field", "value").agg(F.count(F.lit(1)).alias("n"))


def predictions_of(holdout: DataFrame, statuses: DataFrame, mentions: DataFrame, key: str) -> DataFrame:
    """The holdout with what was predicted for it: mentions in order of codes, [] without any, and status
    `pending` where a review wasn't processed."""
    held = mentions.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("code", "sentiment", "severity", "quote"))).alias("predicted"))
    j = holdout.join(statuses.select(key, "status"), key, "left").join(held, key, "left")
    return j.withColumn("predicted", F.coalesce("predicted", F.array().cast(held.schema["predicted"].dataType))).withColumn("status", F.coalesce("status", F.lit("pending")))


def goldens(templates: list[dict], mentions: DataFrame, *, key: str, per_query: int = 10, brand: str = "brand") -> DataFrame:
    """Gold ids of each template (query_id, query, aspect, sentiment, brand, phrases): reviews with one mention
    that has the aspect and the sentiment and whose quote holds a phrase, the smallest ids first. One pass over
    the mentions: every mention is tested against all templates, which are few and literal."""
    tests = []
    for t in templates:
        c = like_any(F.col("quote"), t["phrases"]) if t.get("phrases") else F.lit(True)
        for name, column in (("aspect", "code"), ("sentiment", "sentiment"), ("brand", brand)):
            if t.get(name):
                c = c & (F.col(column) == t[name])
        tests.append(F.when(c, F.lit(t["query_id"])))
    hits = mentions.select(key, F.explode(F.array_compact(F.array(*tests))).alias("query_id")).distinct()
    nth = F.row_number().over(Window.partitionBy("query_id").orderBy(key))
    few = hits.withColumn("__n", nth).where(F.col("__n") <= per_query).groupBy("query_id").agg(F.array_sort(F.collect_list(key)).alias("gold_ids"))
    listed = mentions.sparkSession.createDataFrame([(t["query_id"], t["query"], t.get("aspect"), t.get("sentiment"), t.get("brand")) for t in templates], "query_id string, query string, aspect string, sentiment string, brand string")
    return listed.join(few, "query_id", "left").withColumn("gold_ids", F.coalesce("gold_ids", F.array().cast(few.schema["gold_ids"].dataType)))


def golden_errors(rows: DataFrame, position: str, *, codes: tuple[str, ...] = lx.ONTOLOGY_V2) -> DataFrame:
    """Each golden row with errors and warnings: ids, queries, gold lists, aspects, sentiments and brands. Of
    rows with one query_id all but the first by position are duplicates."""
    blank = lambda c: F.coalesce(strip(F.col(c)), F.lit("")) == ""
    gold, size = F.col("gold_ids"), F.size("gold_ids")
    nth = F.row_number().over(Window.partitionBy("query_id").orderBy(position))
    unknown = lambda c, of: F.col(c).isNotNull() & ~F.col(c).isin(*of)
    ids = F.when(gold.isNull(), "gold_missing").when(F.exists(gold, lambda g: g.isNull()), "gold_not_integer").when(F.exists(gold, lambda g: g <= 0), "gold_not_positive").when(size != F.size(F.array_distinct(gold)), "gold_duplicates")
    all_of = F.array(
        F.when(blank("query_id"), "query_id").when(F.col("__n") > 1, "duplicate_query_id"), F.when(blank("query"), "query"), ids, F.when(unknown("aspect", codes), "aspect"),
        F.when(unknown("sentiment", lx.SENTIMENTS), "sentiment"), F.when(F.col("brand").isNotNull() & blank("brand"), "brand"),
    )
    out = rows.withColumn("__n", nth).withColumn("errors", F.array_compact(all_of)).drop("__n")
    return out.withColumn("warnings", F.array_compact(F.array(F.when(size == 0, "gold_empty"))))


def review_candidates(rankings: dict[str, DataFrame], payload: DataFrame, gold: DataFrame, *, most: int = 10) -> DataFrame:
    """Rows for reviewers: the first hits of each mode with the document's payload and whether it is gold."""
    out = None
    for mode, r in rankings.items():
        one = r.where(F.col("rank") <= most).select("query_id", F.lit(mode).alias("mode"), "rank", "doc_id", F.round("score", 6).alias("score"))
        out = one if out is None else out.unionByName(one)
    marked = out.join(gold.select("query_id", "doc_id").distinct().withColumn("__g", F.lit(True)), ["query_id", "doc_id"], "left")
    return marked.join(payload, "doc_id", "left").withColumn("currently_gold", F.coalesce("__g", F.lit(False))).withColumn("suggested_action", F.lit("")).drop("__g")


def best(grid: DataFrame, *by: str, name: str = "config") -> DataFrame:
    """Adds best: true for the configuration that is largest by the columns, in their order; ties to the name."""
    w = Window.orderBy(*[F.col(c).desc() for c in by], name)  # one row for each configuration
    return grid.withColumn("best", F.row_number().over(w) == 1)
