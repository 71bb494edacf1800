"""Daily cells with chapter and edited country, without the member id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editpulse.operators.members import member_columns
from editpulse.operators.sizing import BROADCAST_BYTES, broadcast_if_small
from editpulse.operators.spatial import Index, identified_shapes, locate


def public_rollup(
    daily: DataFrame,
    members: DataFrame,
    boundaries: DataFrame,
    index: Index,
    cell: float | None = None,
    keep_boxes: bool = True,
    broadcast_limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Public table: the country is that of the cell's centroid, not of single changesets.

    A member of several chapters yields a row per chapter, whose ``chapter_id`` is
    the member's own. ``row_key`` (see `cells.with_row_key`) leads to the boxes of a row; rows
    of one daily cell share it. Without ``keep_boxes`` nothing that tells of boxes or points stays.
    """
    chapters = member_columns(members).select(
        "uid", "chapter_id", "chapter", "chapter_country", "chapter_city", "chapter_location"
    )
    countries = identified_shapes(boundaries).select("shape", "country", F.col("name").alias("country_name"), "region")
    dropped = ["chapter_id"] if keep_boxes else ["chapter_id", "row_key", "envelope", "n_boxes", "n_points"]
    located = locate(daily.drop(*dropped), index, cell, carry=("shape", "a3"))
    return (
        located.join(broadcast_if_small(chapters, broadcast_limit), "uid")
        .join(broadcast_if_small(countries, broadcast_limit), "shape", "left")
        .drop("uid", "shape")
    )
