"""The training-data pipeline: toxicity, near duplicates, secrets, mixing, token ids.

Each stage takes all that the one before it kept. ``run`` writes every stage's rows as
Parquet in the shared folder and reads them again, so a lost executor never costs an earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarrykit.llm import op1_mixing, op3_secrets, op4_pieces, op6_minhash, op10_toxicity
from quarrykit.sharedfs import cut


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fitted model rejects go."""
    return op10_toxicity.drop_toxic(docs, op10_toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    return op6_minhash.drop_near_duplicates(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in it are replaced."""
    return op3_secrets.redact(docs, op3_secrets.train(docs))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the token budget at the target weights stay."""
    return op1_mixing.mix(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens, round_trip) of each document."""
    return op4_pieces.encode_documents(docs)


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("secrets", secrets), ("mixing", mixing), ("sentencepiece", sentencepiece)]

#: Learned decisions and Viterbi paths are no SQL; tests/llm/test_pipeline.py holds each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
