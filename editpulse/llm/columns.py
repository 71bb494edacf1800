"""Small helpers that the operators of this folder share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Texts of ASCII alone take the quicker built-in."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator needs, so that no other name can clash."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))


def hash_place(column: str = "doc_id") -> Column:
    return F.xxhash64(F.col(column).cast("string"))


def below_threshold(rows: DataFrame, limit: int) -> DataFrame:
    """About ``limit`` rows (six deviations more) with the lowest ``doc_id`` hashes, by a threshold from
    the number of rows; all rows if there are no more."""
    n = rows.count()
    share = (limit + 6 * limit**0.5 + 64) / max(n, 1)
    return rows if share >= 1 else rows.where(hash_place() <= F.lit(int(share * 2.0**64) - 2**63))


def lowest_by_hash(rows: DataFrame, limit: int) -> DataFrame:
    """The ``limit`` rows whose ``doc_id`` hashes are lowest. Only those below the threshold are
    sorted, so what partitions send is bounded by ``limit``, however many they are. If ids repeat
    so often that fewer rows lie below it, the sample is smaller."""
    return below_threshold(rows, limit).orderBy(hash_place(), "doc_id").limit(limit)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
