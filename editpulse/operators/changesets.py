"""Changesets of members with their tag, box and point columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from editpulse.functions import tags as T
from editpulse.functions.geo import box_diameter_km, midpoint
from editpulse.operators.sizing import BROADCAST_BYTES, broadcast_if_small
from editpulse.sources.tables import latest_partition

CUTOFF = dt.date(2015, 1, 1)


def bbox_struct() -> Column:
    """Box corners as decimals plus the rounded corner distance in km."""
    x1, y1, x2, y2 = F.col("min_lon"), F.col("min_lat"), F.col("max_lon"), F.col("max_lat")
    return F.struct(
        x1.cast("decimal(10,7)").alias("xmin"),
        y1.cast("decimal(9,7)").alias("ymin"),
        x2.cast("decimal(10,7)").alias("xmax"),
        y2.cast("decimal(9,7)").alias("ymax"),
        box_diameter_km(x1, y1, x2, y2).alias("diameter"),
    )


def member_semi_join(
    changesets: DataFrame,
    members: DataFrame,
    since: dt.date = CUTOFF,
    broadcast_limit: int = BROADCAST_BYTES,
    ds: str | None = None,
) -> DataFrame:
    """Changesets since a date made by members of the newest snapshot, plus its ``members_ds``.

    ``ds`` names that snapshot where it is known, as from a listing; older ones are then not read.

    A member matches at most once, so this is a semi-join: nothing fans out and the
    changesets stay where they are when the member ids are small enough to broadcast.
    The date is compared in the column's own type so that the scan can use it.
    """
    newest = latest_partition(members) if ds is None else members.where(F.col("ds") == ds)
    uids = newest.select("uid")
    start = F.lit(since).cast(changesets.schema["created_at"].dataType)
    kept = changesets.where(F.col("created_at") >= start).join(
        broadcast_if_small(uids, broadcast_limit), "uid", "left_semi"
    )
    return kept.withColumn("members_ds", members.select(F.max("ds")).scalar() if ds is None else F.lit(ds))


def changeset_columns(kept: DataFrame) -> DataFrame:
    """Output columns that need nothing but the changeset itself.

    The residual map is built in a projection of its own: it is used twice, and
    merged into one expression it would be filtered twice.
    """
    tags = F.col("tags")
    return kept.withColumn("_other", T.other_tags(tags)).select(
        "id",
        "uid",
        F.col("user").alias("username"),
        F.col("created_at").cast("timestamp_ntz").alias("created_at"),
        F.col("closed_at").cast("timestamp_ntz").alias("closed_at"),
        T.tag(tags, "comment").alias("comment"),
        T.tag(tags, "created_by").alias("created_by"),
        T.tag(tags, "imagery_used").alias("imagery_used"),
        T.tag(tags, "host").alias("host"),
        T.tag(tags, "source").alias("source"),
        T.hashtags(tags).alias("hashtags"),
        T.null_if_empty(F.col("_other")).alias("tags"),
        "num_changes",
        bbox_struct().alias("bbox"),
        midpoint(F.col("min_lon"), F.col("max_lon")).alias("lon"),
        midpoint(F.col("min_lat"), F.col("max_lat")).alias("lat"),
        "members_ds",
    )
