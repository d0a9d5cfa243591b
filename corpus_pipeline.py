"""Training-data pipeline over ``documents``: quality rules, near-duplicates, decontamination, secrets, token ids.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept and is
written as Parquet to the shared folder before the next one reads it. All but
the last return the columns of ``documents``. Null texts fail the quality rules;
null ids pass every stage; repeated rows that pass the rules are copies of one
id and stay together; other columns travel along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ventaria.llm import bpe, decontam, minhash, rules, secrets, text
from ventaria.session import settle


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor the learned decision list rejects."""
    return rules.keep_good(docs, rules.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by similarity of 0.8 or more (0.85 is the contract of ``op9_minhash`` alone)."""
    return minhash.drop_near_duplicates(docs, minhash.Settings(percent=80, pair_margin=0.22))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item has leaked."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with secrets replaced."""
    return secrets.redact(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids and the text they decode to."""
    return bpe.encode_documents(docs)


def ready(stage):
    return lambda spark, docs, sf_dir: stage(text.importable(spark), docs, sf_dir)


STAGES = [(name, ready(stage)) for name, stage in (
    ("quality_rules", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
    ("secret_scan", secret_scan), ("token_ids", token_ids))]

ORACLE_SQL = None  # learned rules, guess costs and BPE have no SQL form; tests hold the stages against plain versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = text.documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir))
    return docs
