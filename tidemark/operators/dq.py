"""Data quality: each row's first failing check, and what the checks found."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import strip

#: The checks, in the order in which they are reported.
CHECKS = ["duplicate_review_id", "missing_asin", "invalid_rating", "non_english_language", "low_lang_confidence", "text_too_short", "empty_or_spam"]
MIN_LENGTH, MIN_CONFIDENCE, LANGUAGES = 20, 0.7, ("en",)


def spam(text: Column) -> Column:
    """Empty, only links, or all capitals (of ten letters, digits or blanks and more)."""
    s = strip(F.coalesce(text, F.lit("")))
    letters = F.regexp_replace(s, r"(?U)[^a-zA-Z0-9\s]", "")
    shouted = (F.length(letters) >= 10) & letters.rlike("[A-Z]") & ~letters.rlike("[a-z]")
    return (s == "") | (strip(F.regexp_replace(s, r"(?i)https?://\S+", "")) == "") | shouted


def tag(rows: DataFrame, *, key: str | Column, position: str, asin: Column, rating: Column, language: Column, confidence: Column, text: Column, min_length: int = MIN_LENGTH, languages: tuple[str, ...] = LANGUAGES) -> DataFrame:
    """Adds dq_reason: the first check that the row fails, null if it passes. Duplicates are found
    before anything else, among all rows, so a repeat of a bad row is a duplicate; of equal keys the row
    that comes first by `position`, which is to tell rows apart, is kept."""
    key = F.col(key) if isinstance(key, str) else key
    reason = (
        F.when(F.coalesce(strip(asin.cast("string")), F.lit("")) == "", CHECKS[1])
        .when(rating.isNull() | ~rating.between(1, 5), CHECKS[2])
        .when(language.isNull() | ~language.isin(*languages), CHECKS[3])
        .when(confidence.isNull() | (confidence < MIN_CONFIDENCE), CHECKS[4])
        .when(F.length(strip(F.coalesce(text, F.lit("")))) < min_length, CHECKS[5])
        .when(spam(text), CHECKS[6])
    )
    # checked first and joined then, so that a text is shuffled only where the caller asks for it
    checked = rows.withColumn("__key", key).withColumn("__reason", reason)
    first = checked.groupBy(F.col("__key").alias("__k")).agg(F.min(position).alias("__first"))
    out = checked.join(first, F.col("__key").eqNullSafe(F.col("__k")))
    return out.withColumn("dq_reason", F.when(F.col(position) > F.col("__first"), CHECKS[0]).otherwise(F.col("__reason"))).drop("__key", "__reason", "__k", "__first")


def metrics(tagged: DataFrame) -> DataFrame:
    """One row for each check, also those that nothing fails: check_name, n_rows (of the batch), n_failed."""
    counts = [F.count_if(F.col("dq_reason") == c).alias(c) for c in CHECKS]
    one = tagged.agg(F.count(F.lit(1)).alias("n_rows"), *counts)
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("check_name"), F.col(c).alias("n_failed")) for c in CHECKS]))
    return one.select("n_rows", pairs.alias("x")).select("x.check_name", "n_rows", "x.n_failed")


def outcome(tagged: DataFrame) -> DataFrame:
    passed = F.count_if(F.col("dq_reason").isNull())
    n = F.count(F.lit(1))
    return tagged.agg(n.alias("total"), passed.alias("passed"), (n - passed).alias("failed"), F.coalesce(F.round(passed / F.nullif(n, F.lit(0)), 4), F.lit(0.0)).alias("pass_rate"))


def examples(tagged: DataFrame, columns: list[str], order: str, limit: int = 5) -> DataFrame:
    """Up to `limit` failing rows for each check, in order; the rank is cut before they are gathered."""
    w = Window.partitionBy("dq_reason").orderBy(order)
    few = tagged.where("dq_reason IS NOT NULL").select("dq_reason", order, *columns).withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= limit)
    listed = F.array_sort(F.collect_list(F.struct("__n", *columns)))
    return few.groupBy(F.col("dq_reason").alias("check_name")).agg(F.transform(listed, lambda s: F.struct(*[s[c].alias(c) for c in columns])).alias("examples"))


def events_rows(tagged: DataFrame, columns: list[str], order: str) -> DataFrame:
    """The audit rows of a batch: metrics with examples."""
    return metrics(tagged).join(F.broadcast(examples(tagged, columns, order)), "check_name", "left")


def summary(events: DataFrame) -> DataFrame:
    """Totals as the dashboard shows them: rows are counted once for every check of a batch."""
    checked, failed = F.sum("n_rows"), F.sum("n_failed")
    return events.agg(checked.alias("total_rows_checked"), failed.alias("total_failed"), F.greatest(checked - failed, F.lit(0)).alias("total_passed"))
