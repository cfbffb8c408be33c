"""Lines of text files with their numbers, objects in them, and CSV files whose names say what they hold."""

from __future__ import annotations

import json
from hashlib import blake2b

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from tidemark.functions.scalar import strip


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, value): all lines, numbered from 1 in each file, however the files are split. Bytes that aren't UTF-8
    become U+FFFD.

    Of each split its lines are counted first (one small row a split); a line's number is what earlier splits of its
    file hold, and its place in its own. Rows of a split run in order in one task."""
    at = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"), "value")
    splits = at.groupBy("file", "start").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    begins = splits.select(F.col("file").alias("f"), F.col("start").alias("s"), "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    j = at.join(begins, (F.col("file") == F.col("f")) & (F.col("start") == F.col("s")))
    return j.select("file", (F.col("before") + F.col("at") - F.col("first") + 1).alias("line_no"), F.make_valid_utf8("value").alias("value"))


@F.pandas_udf(StringType())
def _canonical(value: pd.Series) -> pd.Series:
    def one(text: str) -> str | None:
        try:
            found = json.loads(text)
        except (ValueError, RecursionError):
            return None
        return json.dumps(found, sort_keys=True, ensure_ascii=False, separators=(",", ":")) if isinstance(found, dict) else None

    return value.map(one, na_action="ignore").astype(object).where(lambda s: s.notna(), None)


def objects(numbered: DataFrame) -> DataFrame:
    """The lines that hold a JSON object, as canonical text in `value` (sorted keys, no blanks); others are left out."""
    text = numbered.withColumn("value", strip(F.col("value"))).where("value <> ''")
    return text.withColumn("value", _canonical("value")).where("value IS NOT NULL")


@F.pandas_udf(BinaryType())
def _blake2b64(key: pd.Series) -> pd.Series:
    return key.map(lambda k: blake2b(k.encode("utf-8", errors="replace"), digest_size=8).digest(), na_action="ignore")


def seeded_score(seed: int, *parts: Column) -> Column:
    """The 64-bit BLAKE2b of `seed|part|...`, as eight bytes, which order as the unsigned number does."""
    return _blake2b64(F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def csv_by_name(spark: SparkSession, pattern: str, name: str, column: str = "mode") -> DataFrame:
    """Rows of CSV files with a header, with the group that the regular expression `name` finds in the file's name."""
    rows = spark.read.option("header", "true").csv(pattern)
    return rows.select("*", F.regexp_extract(F.col("_metadata.file_name"), name, 1).alias(column))


def missed_in(spark: SparkSession, pattern: str, name: str, error: str = "no_gold_hit") -> DataFrame:
    """(query_id, n, modes): in how many files a query has the error, and how many files there are, rows or none."""
    files = spark.read.format("binaryFile").load(pattern).agg(F.count("path").alias("modes"))  # one row
    rows = csv_by_name(spark, pattern, name).where(F.col("error_type") == error)
    counts = rows.groupBy(F.coalesce("query_id", F.lit("")).alias("query_id")).agg(F.count(F.lit(1)).alias("n"))
    return counts.join(F.broadcast(files), F.lit(True))
