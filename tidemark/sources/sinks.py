"""Writes as DataFrame operators, and the writers that put them on disk."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.sources.shared import kept


def absent(new: DataFrame, held: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Rows to insert: those whose key isn't held yet, the first of each key by order."""
    fresh = new.join(held.select(*keys), keys, "left_anti")
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    return fresh.withColumn("__n", nth).where("__n = 1").drop("__n").select(new.columns)


def upsert(held: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Held rows but those with a key that is new, and the new rows; null keys are equal."""
    marks = new.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
    on = reduce(lambda x, k: x & F.col(k).eqNullSafe(F.col(f"__{k}")), keys, F.lit(True))
    return held.join(marks, on, "left_anti").unionByName(new)


def seed(held: DataFrame, wanted: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Held rows brought up to the wanted ones; action is inserted, updated or kept."""
    j = held.select(*keys, *[F.col(v).alias(f"__{v}") for v in values], F.lit(True).alias("__held")).join(wanted, keys, "full_outer")
    differs = reduce(lambda x, v: x | ~F.col(v).eqNullSafe(F.col(f"__{v}")), values, F.lit(False))
    unlisted = reduce(lambda x, v: x & F.col(v).isNull(), values, F.lit(True))
    action = F.when(F.col("__held").isNull(), "inserted").when(differs & ~unlisted, "updated").otherwise("kept")
    return j.select(*keys, *[F.coalesce(v, f"__{v}").alias(v) for v in values], action.alias("action"))


def replace_scope(held: DataFrame, new: DataFrame, scope: list[str]) -> DataFrame:
    """Held rows of other scopes, and the new rows."""
    return upsert(held, new, scope)


def write_scope(df: DataFrame, path: str, scope: list[str]) -> None:
    """Overwrite the scopes that df has rows of, and leave the others: idempotent."""
    df.write.mode("overwrite").partitionBy(*scope).option("partitionOverwriteMode", "dynamic").parquet(path)


def merge_scope(spark: SparkSession, new: DataFrame, path: str, keys: list[str], scope: list[str]) -> None:
    """Upsert into a table partitioned by scope: held rows of the scopes that `new` touches, but for its keys (nulls are
    equal), with the new rows. Other scopes aren't read. The result is staged in the shared folder before a scope is
    overwritten, so the same batch may be run again, also after a failure half-way."""
    names = [f"__{c}" for c in scope]
    touched = new.select(*[F.col(c).alias(n) for c, n in zip(scope, names, strict=True)]).distinct()
    try:
        held = spark.read.schema(new.schema).option("basePath", path).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        held = spark.createDataFrame([], new.schema)
    held = held.join(touched, [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(scope, names, strict=True)], "left_semi")
    write_scope(kept(upsert(held, new, [*scope, *keys]), "merged"), path, scope)


def clear_scope(spark: SparkSession, path: str, gone: DataFrame, scope: list[str], within: list[str]) -> None:
    """Rows of the scopes (scope, within) in `gone` go; other rows of a touched scope are written back, staged first. A scope
    that loses all rows keeps an empty partition."""
    held = spark.read.option("basePath", path).parquet(path)
    names = {c: f"__{c}" for c in [*scope, *within]}
    marks = gone.select(*[F.col(c).alias(n) for c, n in names.items()]).distinct()
    same = lambda cs: [F.col(c).eqNullSafe(F.col(names[c])) for c in cs]
    rest = held.join(marks.select(*[names[c] for c in scope]).distinct(), same(scope), "left_semi").join(marks, same([*scope, *within]), "left_anti")
    rest = kept(rest, "rest")
    # scopes that are left without rows: found before anything is overwritten, a few scopes and not rows
    bare = marks.select(*[F.col(names[c]).alias(c) for c in scope]).distinct().join(held.select(*scope).distinct(), scope, "left_semi").join(rest.select(*scope).distinct(), scope, "left_anti").collect()
    write_scope(rest, path, scope)
    for r in bare:
        folder = "/".join(f"{c}={r[c]}" for c in scope)
        spark.createDataFrame([], held.drop(*scope).schema).write.mode("overwrite").parquet(f"{path}/{folder}")


def write_jsonl(df: DataFrame, path: str, order: list[str] | None = None, compression: str = "gzip") -> None:
    """JSON lines, nulls kept; with an order the files are sorted by range, so their content doesn't
    depend on how the input was partitioned."""
    out = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    out.write.mode("overwrite").option("compression", compression).option("ignoreNullFields", "false").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(path)


def check_vectors(df: DataFrame, vector: str, dim: int) -> DataFrame:
    """Fails the job that reads it if a vector has another length."""
    return df.withColumn(vector, F.when(F.size(vector) == dim, F.col(vector)).otherwise(F.raise_error(F.concat(F.lit(f"{vector}: expected {dim} components, found "), F.size(vector).cast("string")))))
