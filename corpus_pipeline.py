"""From raw documents to packed training windows, in five stages.

Every stage is a function of (spark, docs, sf_dir). It works on all that the one before kept, and its decisions take
effect: toxic documents go, of equal texts one stays, of near-duplicates one stays, secrets are masked, and what is left
is packed into windows. All but the last return the columns of the documents they got.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from depthbook.llm import common, lsh_forest, packing, secret_scan, stream_dedup, toxicity_chain


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity_chain.without_toxic(docs, common.table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return stream_dedup.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lsh_forest.one_of_each(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redacted(docs, secret_scan.fit_models(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.digests(packing.pack_documents(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("secrets", mask_secrets),
    ("packing", pack),
]

#: The classifier, the near-duplicate search and the tokenizer are beyond SQL; a brute-force version tests the pipeline.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
