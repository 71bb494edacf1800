"""Broadcast only what has been measured."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest measured side that is broadcast; beyond it the same join shuffles and
# AQE splits hot keys.
BROADCAST_BYTES = 128 * 1024 * 1024


def _width(df: DataFrame) -> Column:
    sizes = [F.lit(16 * len(df.columns))]
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            sizes.append(F.coalesce(F.octet_length(F.col(field.name)), F.lit(0)))
        elif isinstance(field.dataType, (T.StructType, T.MapType)):
            text = F.to_json(F.struct(F.col(field.name)))
            sizes.append(F.coalesce(F.octet_length(text), F.lit(0)))
        elif isinstance(field.dataType, T.ArrayType):
            sizes.append(F.coalesce(F.size(F.col(field.name)), F.lit(0)) * F.lit(64))
    return reduce(lambda a, b: a + b, sizes).cast("long")


def measured_bytes(df: DataFrame) -> int:
    """Approximate in-memory size of ``df``: one aggregate, one number to the driver."""
    return df.agg(F.sum(_width(df))).first()[0] or 0


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its measured size allows one, else unchanged."""
    return F.broadcast(df) if measured_bytes(df) <= limit else df
