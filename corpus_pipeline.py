"""A training-corpus pipeline in five stages over ``documents``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but
the last return the columns of documents. ``run`` applies them in order,
each written as Parquet in the shared folder and read again, so a stage
starts from stored rows and survives lost executors.

1. toxicity: documents that the classifier chain rejects go.
2. near_dedup: of every group of near-duplicates the smallest doc_id
   stays, and one of rows that repeat both doc_id and text.
3. decontaminate: documents that hold a benchmark item go.
4. secrets: secrets are replaced by a mark; no document goes.
5. bpe: token ids of every text, with the text they decode to.

A null doc_id is no name: such rows are no one's duplicate and stay.
Extra columns pass through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.llm import bpe, decontaminate, secrets, superminhash, toxicity
from emporia.llm.common import saved, with_batches
from emporia.sources.tables import table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with_batches(spark)
    return toxicity.reject_toxic(docs, table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with_batches(spark)
    return superminhash.drop_near_duplicates(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with_batches(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of the final texts."""
    import public_tokenizers

    with_batches(spark)
    return bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_50k.json"), outputs=False)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("secrets", secrets_stage),
    ("bpe", bpe_stage),
]

#: SQL cannot state the fitted classifier, the edit-distance search and the tokenizer; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = saved(docs)
    return docs
