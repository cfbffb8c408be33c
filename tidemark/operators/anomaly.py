"""Weekly series and anomalies: buckets, EWMA baseline, rolling deviation, z-score, incidents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import ANOMALY_WEIGHTS, severity_weight, week_start

#: The detection settings.
SPAN, WINDOW, MIN_STD = 4, 8, 1.0
MIN_HISTORY, MIN_Z, MIN_VOLUME, MIN_SEVERITY, MAX_QUOTES = 3, 2.0, 3, 5.0, 3


def weekly(events: DataFrame, series: list[str], *, at: str = "posted_at", severity: str = "severity", review: str = "review_id", rating: str = "rating", quote: str | None = None, order: str | None = None) -> DataFrame:
    """One row for each series and ISO week that has events: volume, severity_score, reviews, avg_rating
    and up to MAX_QUOTES quotes that differ by more than case, the earliest of each. Weeks without events
    aren't filled; rows with a null series key are dropped."""
    df = events.where(" AND ".join(f"`{c}` IS NOT NULL" for c in series)).withColumn("week_start", week_start(F.col(at)))
    keys = [*series, "week_start"]
    out = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("volume"),
        F.round(F.sum(severity_weight(F.col(severity), ANOMALY_WEIGHTS)), 4).alias("severity_score"),
        F.count_distinct(review).alias("reviews"),
        F.round(F.avg(rating), 4).alias("avg_rating"),
    )
    if quote:
        # different quotes are found before they are gathered, and only the first few are kept
        first = df.where(F.trim(quote) != "").groupBy(*keys, F.lower(quote).alias("__q")).agg(F.min(F.struct(F.col(order or review).alias("o"), F.col(quote).alias("q"))).alias("__s"))
        nth = F.row_number().over(Window.partitionBy(*keys).orderBy("__s"))
        few = first.withColumn("__n", nth).where(F.col("__n") <= MAX_QUOTES).groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list("__s")), lambda s: s["q"]).alias("quotes"))
        out = out.join(few, keys, "left").withColumn("quotes", F.coalesce("quotes", F.array().cast("array<string>")))
    return out


def ewma_before(value: str, series: list[str], order: str, span: int = SPAN) -> Column:
    """EWMA of the earlier rows of the series, seeded with the first; null without any. For series that the calendar
    bounds: each row looks at its history. scans.ewma is linear in series of any length."""
    alpha = 2.0 / (span + 1)
    h = F.collect_list(F.col(value).cast("double")).over(Window.partitionBy(*series).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    step = lambda acc, x: x * alpha + acc * (1 - alpha)
    return F.when(F.size(h) > 0, F.aggregate(F.slice(h, 2, F.greatest(F.size(h), F.lit(1))), F.get(h, F.lit(0)), step))


def rolling_std(value: str, series: list[str], order: str, window: int | None = WINDOW) -> Column:
    start = -window if window else Window.unboundedPreceding
    return F.stddev_samp(value).over(Window.partitionBy(*series).orderBy(order).rowsBetween(start, -1))


def z_score(value: Column, baseline: Column, std: Column, min_std: float = MIN_STD) -> Column:
    return (value - baseline) / F.greatest(F.coalesce(std, F.lit(0.0)), F.lit(min_std))


def with_baseline(buckets: DataFrame, series: list[str], span: int = SPAN, window: int | None = WINDOW) -> DataFrame:
    """Adds history (earlier weeks), baseline, std and z to weekly buckets; one sort by series."""
    w = Window.partitionBy(*series).orderBy("week_start")
    df = buckets.withColumn("history", F.row_number().over(w) - 1).withColumn("baseline", ewma_before("volume", series, "week_start", span)).withColumn("std", rolling_std("volume", series, "week_start", window))
    return df.withColumn("z", z_score(F.col("volume"), F.col("baseline"), F.col("std")))


def flagged(min_history: int = MIN_HISTORY, min_z: float = MIN_Z, min_volume: int = MIN_VOLUME, min_severity: float = MIN_SEVERITY) -> Column:
    return (F.col("history") >= min_history) & (F.col("z") >= min_z) & (F.col("volume") >= min_volume) & (F.col("severity_score") >= min_severity)


def detect(buckets: DataFrame, series: list[str], **limits: float) -> DataFrame:
    return with_baseline(buckets, series).where(flagged(**limits))


def summary(aspect: Column, cluster_label: Column, week: Column, volume: Column, baseline: Column, z: Column, severity: Column, quotes: Column) -> Column:
    """One sentence for an incident, with its first quote if there is one."""
    spaced = F.lower(F.replace(aspect, F.lit("_"), F.lit(" ")))
    head = F.concat(F.upper(F.substring(spaced, 1, 1)), F.substring(spaced, F.lit(2), F.length(spaced)))
    where = F.when(cluster_label != "", F.concat(F.lit("in cluster '"), cluster_label, F.lit("'"))).otherwise("overall")
    text = F.format_string(
        "%s complaints %s spiked to %d mentions during week %s, above EWMA baseline %.1f (z=%.1f, severity score %.0f).",
        head, where, volume, F.date_format(week, "yyyy-MM-dd"), baseline, z, severity,
    )
    quote = F.get(quotes, F.lit(0))
    return F.when(quote.isNotNull(), F.concat(text, F.lit(" Representative quote: '"), quote, F.lit("'"))).otherwise(text)
