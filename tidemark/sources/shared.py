"""Tables in the folder that the driver and all executors share (spark.checkpoint.dir)."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Spark's setting by which the shuffle files of a query go when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Row groups of a few MB, looked at after each row: a reader holds at most one, however large the cells are.
GROUPS = {"compression": "zstd", "parquet.block.size": str(1 << 23), "parquet.block.size.row.check.min": "1", "parquet.page.size.row.check.min": "1"}


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; a temporary one where a local session names none."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="checkpoints-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read back: computed once, with its lineage cut. Its shuffle files go at once."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.options(**GROUPS).parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
