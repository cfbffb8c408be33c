"""Session set-up."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)


def ship(spark: SparkSession) -> SparkSession:
    """Let Python workers that start on this host import the package whatever the working folder is.
    (On a cluster pass it with --py-files or install it.)"""
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "")
    if ROOT not in have.split(":"):
        env["PYTHONPATH"] = f"{ROOT}:{have}" if have else ROOT
    return spark


def build(app: str = "tidemark", cores: str = "*") -> SparkSession:
    """A local session: UTC, adaptive execution on."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return ship(spark)
