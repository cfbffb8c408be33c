"""Readers of review and metadata files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalar import coerce_bool, coerce_int, coerce_posted_at, details_brand, fallback_id, round_rating, title_and_body


def jsonl(spark: SparkSession, path: str, schema: str, *, strict: bool = False, spread: int | None = None) -> DataFrame:
    """JSON lines, plain or gzipped; blank and malformed lines are left out, or fail the read if strict.
    A gzip file is read by one task; `spread` deals its rows out after that."""
    df = spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)
    if not strict:
        first = df.columns
        df = df.where(" OR ".join(f"`{c}` IS NOT NULL" for c in first))
    return df.repartition(spread) if spread else df


def rejected(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The malformed lines of a file."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    parsed = F.from_json("value", f"{schema}, _bad string", {"columnNameOfCorruptRecord": "_bad"})
    return lines.select(parsed["_bad"].alias("_bad")).where("_bad IS NOT NULL")


def count_lines(spark: SparkSession, path: str) -> int:
    """Lines that aren't blank."""
    return spark.read.text(path).where(F.trim("value") != "").count()


def id_list(spark: SparkSession, path: str) -> DataFrame:
    """Ids from JSON lines: review_id, else source_id; each once, with the place of its first line."""
    df = spark.read.schema("review_id string, source_id string").option("mode", "FAILFAST").json(path)
    df = df.select(F.coalesce("review_id", "source_id").alias("id"), F.monotonically_increasing_id().alias("pos"))
    return df.where("id IS NOT NULL").groupBy("id").agg(F.min("pos").alias("pos"))


def metric_csv(spark: SparkSession, path: str, key: str, value: str) -> DataFrame:
    """Counts from a CSV with a header; what isn't a number counts as 0."""
    return spark.read.option("header", "true").csv(path).select(F.col(key), coerce_int(F.col(value), 0).alias(value))


REVIEW = "rating string, title string, text string, asin string, parent_asin string, user_id string, timestamp string, helpful_vote string, verified_purchase string, brand string, store string, source_id string"
METADATA = "parent_asin string, asin string, title string, store string, details string, categories string"


def normalized(raw: DataFrame, brand: Column, source: str = "amazon") -> DataFrame:
    """Raw review rows as review rows; every field is coerced, none fails."""
    return raw.select(
        F.lit(source).alias("source"),
        F.coalesce("source_id", fallback_id(F.col("user_id"), F.col("asin"), F.col("timestamp"))).alias("source_id"),
        F.coalesce("parent_asin", "asin").alias("asin"),
        brand.alias("brand"),
        round_rating(F.col("rating")).alias("rating"),
        coerce_bool(F.col("verified_purchase")).alias("verified"),
        coerce_posted_at(F.col("timestamp")).alias("posted_at"),
        coerce_int(F.col("helpful_vote"), 0).alias("helpful_count"),
        title_and_body(F.col("title"), F.col("text")).alias("text_raw"),
        F.lit("en").alias("language"),
        F.lit(0.95).alias("lang_confidence"),
    )


def brand_of_metadata(meta: DataFrame) -> DataFrame:
    """(asin, brand): the details' brand, else the store."""
    return meta.select(F.coalesce("parent_asin", "asin").alias("asin"), F.coalesce(details_brand(F.col("details")), "store").alias("brand")).where("asin IS NOT NULL AND brand IS NOT NULL")
