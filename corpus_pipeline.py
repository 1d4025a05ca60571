"""The corpus pipeline: stages of the training-data operators over the documents table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and reread as the
next stage's docs. All but the last return the columns of documents; each works on all rows that its predecessor kept.

Null or empty texts pass the quality stage, are copies of each other to the exact dedup, and are encoded to no ids. Repeated
rows are copies. An empty table passes through all stages. Further columns of documents are carried along to the mixing stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerhound.llm import bpe, exact_dedup, mixing, quality, simhash
from ledgerhound.llm.common import materialize, table


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling towards the texts labelled as good doesn't draw go."""
    return quality.drop_rejected(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows with equal texts (blanks apart) one stays."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by SimHash fingerprints one document stays."""
    return simhash.drop_near_copies(docs)


def mix_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of languages that are short of their target weight are repeated as their rates say; every one stays at least once."""
    labels = mixing.domains_of(docs, table(spark, sf_dir, "labels"))
    return mixing.mixed_docs(docs, labels, least=mixing.LEAST_RATE)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts, and digests of the ids and of the text that they decode to."""
    return bpe.digest(docs, *bpe.vocabulary())


STAGES = [
    ("quality classifier", select_quality),
    ("exact dedup", drop_exact_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing to target weights", mix_languages),
    ("BPE encoding", encode_tokens),
]

#: No SQL: a trained classifier, connected components, an iterative fit and a tokenizer are no SQL expressions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{k}")
    return docs
