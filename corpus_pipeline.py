"""A training corpus from ``documents``: toxic ones go, one of each group of near-duplicates stays,
sources are mixed to their target weights, and the texts are encoded.

Every stage takes all that its predecessor kept, written as Parquet and read again. The models of
the stages are learned from the tables beside the documents, in ``sf_dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortlake.llm import bpe, minhash, mixing, toxicity
from cohortlake.llm.common import staged, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that aren't predicted to be toxic. The labels name rows of the table
    ``documents``, so the machine is trained on its texts and applied to ``docs``."""
    machine = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, machine)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest doc_id."""
    return minhash.representatives(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row."""
    return bpe.encoding_digests(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix),
    ("encoding", encode),
]

#: The learned machine, the sketches and the encoder are beyond SQL; tests hold the pipeline
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
