"""Per-cell aggregates (A2, A6, A10-A15) and the boxes of each cell.

Centroids are the mean of the *distinct* points of a group. Both stages below
combine on the map side, and the first is keyed by the point as well, so a cell,
member or day holding a large share of the rows is pre-summed before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from editpulse.functions.grid import parent_cell
from editpulse.functions.metrics import int_struct, summed, touched
from editpulse.functions.timebins import day, epoch_seconds, week
from editpulse.schemas import METRICS

KEYS = ("h3", "uid", "created_at")
CORNERS = {"xmin": F.min, "ymin": F.min, "xmax": F.max, "ymax": F.max}


def _daily_rows(activity: DataFrame) -> DataFrame:
    return activity.where(F.col("lon").isNotNull() & F.col("lat").isNotNull()).withColumn(
        "created_at", day(F.col("created_at"))
    )


def daily_cells(activity: DataFrame) -> DataFrame:
    """One row per (cell, member, day): summed counters, envelope, centroid.

    ``n_points`` counts distinct points, ``n_boxes`` all boxes.
    """
    rows = _daily_rows(activity)
    fields = [(group, field) for group, names in METRICS.items() for field in names]
    per_point = rows.groupBy(*KEYS, "lon", "lat").agg(
        F.min("chapter_id").alias("chapter_id"),
        *[summed(group, field).alias(f"{group}_{field}") for group, field in fields],
        *[agg(F.col("bbox")[corner]).alias(corner) for corner, agg in CORNERS.items()],
        F.count("*").alias("n_boxes"),
    )

    def total(group: str) -> Column:
        return int_struct(**{f: F.sum(f"{group}_{f}") for f in METRICS[group]}).alias(group)

    per_cell = per_point.groupBy(*KEYS).agg(
        F.min("chapter_id").alias("chapter_id"),
        *[total(group) for group in METRICS],
        F.struct(*[agg(corner).alias(corner) for corner, agg in CORNERS.items()]).alias("envelope"),
        F.avg("lon").alias("lon"),
        F.avg("lat").alias("lat"),
        F.count("*").alias("n_points"),
        F.sum("n_boxes").alias("n_boxes"),
    )
    return per_cell


def coarse_cells(activity: DataFrame, resolution: int) -> DataFrame:
    """Weekly rows per (week, coarse cell, member); the member id is grouped on, not output."""
    rows = activity.where(F.col("country").isNotNull()).select(
        epoch_seconds(week(F.col("created_at"))).alias("timestamp"),
        parent_cell(F.col("h3"), resolution).alias("h3"),
        "uid",
        "chapter_id",
        touched("features").alias("feats"),
        "lon",
        "lat",
    )
    keys = ("timestamp", "h3", "uid")
    per_point = rows.groupBy(*keys, "lon", "lat").agg(
        F.min("chapter_id").alias("chapter_id"), F.sum("feats").alias("feats")
    )
    return (
        per_point.groupBy(*keys)
        .agg(
            F.min("chapter_id").alias("chapter_id"),
            F.sum("feats").cast("int").alias("all_feats"),
            F.avg("lon").alias("lon"),
            F.avg("lat").alias("lat"),
        )
        .drop("uid")
    )


def point_union(activity: DataFrame) -> DataFrame:
    """Distinct points of each daily cell, as rows."""
    return _daily_rows(activity).select(*KEYS, "lon", "lat").distinct()


def row_key(salt: str) -> Column:
    """Opaque name of a daily row; without the salt it cannot be led back to the member."""
    return F.sha2(F.concat(F.lit(salt), F.to_json(F.struct(*KEYS))), 256).alias("row_key")


def with_row_key(daily: DataFrame, salt: str) -> DataFrame:
    """Daily cells plus ``row_key``, which `box_rows` with the same salt gives their boxes."""
    return daily.withColumn("row_key", row_key(salt))


def box_rows(activity: DataFrame, salt: str) -> DataFrame:
    """Every box of every daily cell (A11) as a row: ``row_key, bbox``.

    Rows instead of a list, whatever their number: no row grows with a busy cell, and
    nothing is shuffled. The salt is fixed for a run, so a repeated task gives equal keys.
    """
    return _daily_rows(activity).select(row_key(salt), "bbox")


def daily_points(daily: DataFrame) -> DataFrame:
    """Daily totals at the cell's centroid."""
    return daily.select(
        "h3",
        epoch_seconds(F.col("created_at")).alias("timestamp"),
        "chapter_id",
        touched("features").alias("all_feats"),
        touched("buildings").alias("buildings"),
        touched("highways").alias("highways"),
        touched("amenities").alias("amenities"),
        "lon",
        "lat",
    )


def daily_boxes(daily: DataFrame) -> DataFrame:
    """Daily totals with the envelope of all the cell's boxes."""
    return daily.select(
        "h3",
        epoch_seconds(F.col("created_at")).alias("timestamp"),
        "chapter_id",
        touched("features").alias("all_feats"),
        touched("buildings").alias("buildings"),
        touched("highways").alias("highways"),
        touched("amenities").alias("amenities"),
        *[F.col("envelope")[corner].cast("double").alias(corner) for corner in CORNERS],
    )
