"""From raw documents to token ids: reject what the quality classifier rejects, delete later copies of line runs, keep
one document of each near-duplicate class, drop documents that hold benchmark passages, encode the rest.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each stage's rows to the shared folder and
reads them back as the next stage's documents. All stages but the last return the columns of documents; where a stage
changes text, n_chars is counted anew. A document that line dedup empties stays, as an empty text, for the near-duplicate
stage to fold with the other empty ones. The last stage returns doc_id, n_tokens, ids (array of int), ids_sha256 and
decoded_sha256.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shardloom.llm import bpe, common, decontaminate, mil, minhash, units


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mil.keep_good(docs, common.read(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return units.cleaned(docs, units.dedup_runs(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.dedup(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, common.read(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs.select("doc_id", "text")).select("doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontaminate", decontaminated), ("encode", encoded)]

#: SQL can express neither the classifier nor the signatures; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
