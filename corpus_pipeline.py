"""A corpus from raw documents: quality, exact and near duplicates, source mix, token ids.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before it kept.

Nulls: a null text is empty; a null source is a source; rows with a null doc_id are rows like others, and near-duplicate
detection leaves them alone. Repeated rows fall to one in the stage for exact copies. Very long texts are read whole. An empty table stays
empty through all stages. Extra columns pass up to the last stage, which returns its own; names that begin with `__` are the stages' own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.llm import bpe, common, exact_dedup, factorisation, mixing, near_dedup


#: Words that a worker remembers while it encodes: fewer than by default, as its memory stays taken in other stages.
MEMO = 100_000


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine accepts. A row is kept or dropped by the score of its own id and text."""
    machine = factorisation.train(docs, common.read(spark, sf_dir, "labels"))
    return factorisation.accepted(docs, machine)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id."""
    return exact_dedup.kept_documents(docs, keep="largest")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates (a similarity of 0.8 links), the document with the smallest doc_id."""
    return near_dedup.kept_documents(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mixed_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids (little-endian unsigned 32-bit integers), and whether decoding gives the text back."""
    vocabulary = bpe.load(spark, bpe.default_path())
    rows = docs.select("doc_id", "source", common.text_of().alias("text"))
    out = bpe.round_trip(rows, vocabulary, memo=MEMO)
    return out.select("doc_id", "source", "n_tokens", "ids", (F.col("decoded") == F.col("text")).alias("round_trip"))


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("mix", mix), ("tokenize", tokenize)]
#: The stages hold trained models and hashes that SQL does not have; a test compares them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents")
    for n, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            docs = common.materialize(docs, name)
    return docs
