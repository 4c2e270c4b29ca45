"""Documents to token ids: toxic texts, copies and test passages go, personal data is masked, the rest is encoded.

Each stage gets what its predecessor kept.  It is written as Parquet in the shared folder and read again, so a
lost executor costs one stage's tasks and no stage is computed twice; what a stage wrote on its way is then dropped.  All stages but the last return the columns
of ``documents``.  Null texts, null ids, repeated rows and extra columns are treated as the operators say.
"""

from __future__ import annotations

import sys
from functools import partial
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

import public_tokenizers  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tidemark.llm import bpe, decontaminate, pii, simhash, toxicity  # noqa: E402
from tidemark.llm.base import table  # noqa: E402
from tidemark.runtime import settled  # noqa: E402

VOCABULARY = "byte_bpe_50k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the labelled examples score below the threshold."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near copies."""
    return simhash.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty stands in a passage of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mask_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, spans of personal data replaced by their kind; ``n_chars`` follows the text."""
    masked = pii.redact(docs)
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        masked = masked.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                                   .otherwise(F.length("text")).cast(kind))
    return masked.select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document in place of its text."""
    return bpe.encode(docs, public_tokenizers.path(VOCABULARY)).drop("text", "n_chars")


STAGES = [
    ("toxicity", drop_toxic),
    ("near copies", drop_copies),
    ("decontamination", drop_contaminated),
    ("personal data", mask_personal),
    ("encoding", encode),
]

#: SQL has neither the examples' index nor the fingerprints nor the encoder.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = settled(spark, partial(stage, spark, docs, sf_dir))
    return docs
