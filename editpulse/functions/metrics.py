"""Counter structs: building, guarded building, summing, totals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F



def int_struct(**fields: Column) -> Column:
    """Struct of INT fields; a count beyond INT range raises under ANSI."""
    return F.struct(*[value.cast("int").alias(name) for name, value in fields.items()])


def struct_if_any(**fields: Column) -> Column:
    """The INT struct if any counter is positive, else NULL."""
    any_positive = reduce(lambda a, b: a | b, [value > 0 for value in fields.values()])
    return F.when(any_positive, int_struct(**fields))


def summed(group: str, field: str) -> Column:
    """SUM over a nullable struct's field; 0 when no struct is present."""
    return F.coalesce(F.sum(F.col(group)[field]), F.lit(0))


def touched(group: str) -> Column:
    """new + edited of one group."""
    return F.col(group)["new"] + F.col(group)["edited"]


def other_features() -> Column:
    """Features outside the three themes; negative when elements carry several themes."""
    return touched("features") - touched("buildings") - touched("highways") - touched("amenities")
