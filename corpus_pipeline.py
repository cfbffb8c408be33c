"""The corpus pipeline: documents in, packed training sequences out.

Every stage works on all rows that the one before kept, takes effect, and is written as a table and
read again, so that a lost executor costs a stage's tasks and not the pipeline. All stages but the
last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import mixing, ngram_join, packing, pii, queries, toxicity
from tidemark.llm.common import shared_path
from tidemark.session import ship

#: Near-duplicate stages on word n-grams: five words, a similarity of 0.8 or more.
SHINGLE, PERCENT = 5, 80


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain rejects go."""
    ship(spark)
    chain = toxicity.train_chain(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score(docs, chain)
    # the verdict is the last column, whatever the table's own are called
    return scored.where(~F.col(f"`{scored.columns[-1]}`")).select(*[F.col(f"`{c}`") for c in docs.columns])


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays."""
    ship(spark)
    return ngram_join.drop_copies(docs, size=SHINGLE, percent=PERCENT)


def with_surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets are replaced."""
    ship(spark)
    return pii.replace_pii(docs, queries.PII_KEY)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, repeated or left out so that sources meet their target weights."""
    ship(spark)
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens."""
    ship(spark)
    return packing.pack(docs, queries.tokenizer_path())


STAGES = [
    ("toxicity", without_toxic),
    ("ngram_jaccard_join", without_near_copies),
    ("pii", with_surrogates),
    ("mixing", mixed),
    ("packing", packed),
]

#: Learned models, tokens and near copies can't be put in SQL; tests compare stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
