"""A training-data pipeline over ``documents``: five stages, each a written table for the next.

1. language ID: documents without a recognised language go;
2. near-duplicates: one document of each group stays;
3. benchmark decontamination: benchmark passages are cut out, documents mostly made of them go;
4. secret scans: secrets are replaced by a mark;
5. packing: what is left is cut into windows of token ids, one row a piece.

All stages but the last keep the columns of ``documents``; ``n_chars`` follows a changed text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportlake.llm import decontaminate, language, near_duplicates, secrets, tokens, window_packing
from reportlake.llm.shared import written


def _measured(documents: DataFrame) -> DataFrame:
    return documents.withColumn("n_chars", F.length("text").cast(documents.schema["n_chars"].dataType))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.accepted(docs, language.fit(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_duplicates.deduplicated(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _measured(decontaminate.remove_matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _measured(secrets.redact(docs, secrets.train_from_documents(docs)))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return window_packing.pack(docs, tokens.public_file())


STAGES = [
    ("language ID", language_id),
    ("near-duplicates", near_dedup),
    ("decontamination", benchmark_decontamination),
    ("secret scan", secret_scan),
    ("packing", packing),
]

#: SQL has no learned language model, tokenizer or packing: the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = written(docs, f"pipeline-{number}")
    return docs
