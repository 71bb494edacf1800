"""Dense positions of rows in a sorted order, without a window over all rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from editpulse.sources.working import working_table


def with_positions(df: DataFrame, order: list[Column], within: tuple[str, ...] = (), name: str = "position") -> DataFrame:
    """``df`` plus its rows' 0-based places in ``order``, counted anew in each group of ``within``.

    Spark sorts by range, so a group may span many partitions and no group is ever held
    by one task. A row's place is its place among the rows of its group in its own
    partition plus the counts of that group in earlier partitions; these counts, one row
    per partition and group, are all that is summed in order. Rows that tie in ``order``
    come in any order, but stay in the one in which they were written.
    """
    keys = [F.col(c).asc_nulls_first() for c in within]
    ranged = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    placed = working_table(ranged.withColumn("_at", F.monotonically_increasing_id()), "sorted")
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    runs = placed.groupBy("_part", *within).agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    before = Window.partitionBy(*within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(
        F.col("_part").alias("_p"),
        *[F.col(c).alias(f"_w{i}") for i, c in enumerate(within)],
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    same = reduce(
        lambda a, b: a & b,
        [F.col(c).eqNullSafe(F.col(f"_w{i}")) for i, c in enumerate(within)],
        F.col("_part") == F.col("_p"),
    )
    return placed.join(starts, same).select(*df.columns, (F.col("_at") + F.col("_shift")).alias(name))
