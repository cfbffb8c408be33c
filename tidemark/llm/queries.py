"""One query opN_<name> for each training-data operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import embedding_dedup, hard_negatives, html_extract, line_dedup, mixing, ngram_join, packing, pii, quality, sharding, sql, substring_dedup, toxicity, turn_repair


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan_mix(_read(spark, sf_dir, "documents")).drop("part")


#: The key of surrogates; in production a secret, given by the caller.
PII_KEY = "documents-v1"


def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_pii(_read(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY, count_col="n_replaced")


def op3_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    chain = toxicity.train_chain(docs, _read(spark, sf_dir, "labels"))
    return toxicity.score(docs, chain).drop("text")


#: Bytes of text in a shard, at most.
SHARD_BYTES = 8 << 20


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(_read(spark, sf_dir, "documents"), limit=SHARD_BYTES)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.kept_digest(substring_dedup.dedup_substrings(_read(spark, sf_dir, "documents")))


def tokenizer_path() -> str:
    """The public vocabulary that packing counts in."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"), tokenizer_path())


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_read(spark, sf_dir, "pages"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.link_vectors(_read(spark, sf_dir, "embeddings"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_documents(_read(spark, sf_dir, "documents"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.kept_digest(line_dedup.dedup_lines(_read(spark, sf_dir, "documents").select("doc_id", "text")))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hard_negatives.usable(hard_negatives.relabelled(_read(spark, sf_dir, "embeddings")))
    return hard_negatives.mine(rows, F.col("vec_id") % 50 == 0)


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "conversations")
    return turn_repair.audit(rows, turn_repair.damage(rows))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_source_mixing": op1_source_mixing,
        "op2_pii_surrogates": op2_pii_surrogates,
        "op3_toxicity_chain": op3_toxicity_chain,
        "op4_sharding": op4_sharding,
        "op5_substring_dedup": op5_substring_dedup,
        "op6_packing": op6_packing,
        "op7_html_extraction": op7_html_extraction,
        "op8_embedding_dedup": op8_embedding_dedup,
        "op9_quality_rules": op9_quality_rules,
        "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
        "op11_line_dedup": op11_line_dedup,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_turn_repair": op13_turn_repair,
    }


def oracle_sql() -> dict[str, str]:
    return dict(sql.SQL)
