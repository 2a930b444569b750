"""The corpus pipeline: five stages, each calling one operator of
``ledgerloom.llm`` on all that its predecessor kept.

1. toxicity        documents that the fitted grammar rejects go
2. line dedup      boilerplate lines of a source's documents go; near copies
                   count as one document there, and are left to stage 3
3. near duplicates one document of each SimHash group stays
4. mixing          sources are brought to their target weights; documents
                   repeat or go as the plan takes them
5. BPE             what is left is encoded, and decoded again

All stages but the last return the columns of ``documents``; ``n_chars``
follows the text.  Each stage defines its null, empty and repeated rows in
its operator's docstring.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, line_dedup, mixing, simhash, toxicity
from ledgerloom.llm.common import prepare, table
from ledgerloom.session import ensure_checkpoint_dir


def _toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def _line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_dedup.drop_boilerplate(docs, "text", "source", near=True).select(*docs.columns)
    kind = docs.schema["n_chars"].dataType
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(kind))


def _near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def _mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def _bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digests(docs)


STAGES = [
    ("toxicity", _toxicity),
    ("line_dedup", _line_dedup),
    ("near_duplicates", _near_duplicates),
    ("mixing", _mixing),
    ("bpe", _bpe),
]

#: SQL cannot express SimHash, the fitted grammar or BPE; tests hold the
#: pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``.  Each stage's rows are written to the
    shared folder and read again by the next, so a lost executor repeats
    part of one stage at most."""
    prepare(spark)
    folder = os.path.join(ensure_checkpoint_dir(spark), f"pipeline-{uuid.uuid4().hex}")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
