"""Cleaning of a text corpus: five stages, each written as Parquet and read again by the next.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and works on all that its
predecessor kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from editpulse.llm.bpe import digests
from editpulse.llm.decontaminate import without_leaks
from editpulse.llm.line_dedup import without_repeated_lines
from editpulse.llm.minhash import one_of_each
from editpulse.llm.quality import keep_good
from editpulse.session import checkpoint_dir


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every kept document."""
    return digests(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", without_repeated_lines),
    ("MinHash near-dedup", one_of_each),
    ("benchmark decontamination", without_leaks),
    ("byte-level BPE", byte_level_bpe),
]

# The classifier of the first stage is fitted numerically; the tests check each stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder before it is used."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
