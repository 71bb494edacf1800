"""One query per operator, each over whole tables, flattened to scalar columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse.functions.grid import cell_of_point, h3_parent, parent_cell
from editpulse.operators import activity as A
from editpulse.operators import cells as C
from editpulse.operators import changesets as CS
from editpulse.operators import documents as D
from editpulse.operators import members as M
from editpulse.operators.features import feature_lines, tile_features
from editpulse.operators.public import public_rollup
from editpulse.operators.rollup import metric_structs, rollup_for
from editpulse.operators.sizing import BROADCAST_BYTES
from editpulse.operators.spatial import locate, prepared_index
from editpulse.plans.enrich import enrich_changesets
from editpulse.schemas import METRICS
from editpulse.sources import standin
from editpulse.sources.tables import latest_partition, members_as_of, with_cell
from editpulse.sources.working import working_table

# Fixed parameters of the stand-in data: cutoff inside the order dates, run dates
# inside a month near the end of each table, index cells that suit 72 x 32 degree shapes.
SINCE = dt.date(1996, 1, 1)
RUN_DATE = dt.date(2001, 7, 17)
EVENT_RUN_DATE = dt.date(2024, 2, 10)
CELL = 2.0

Query = Callable[[SparkSession, str], DataFrame]


def _flat(groups: dict[str, tuple[str, ...]]) -> list[Column]:
    return [F.col(g)[f].alias(f"{g}_{f}") for g, fields in groups.items() for f in fields]


def _kept(spark: SparkSession, sf: str) -> DataFrame:
    return CS.member_semi_join(standin.changesets(spark, sf), standin.members(spark, sf), SINCE)


def _columns(spark: SparkSession, sf: str) -> DataFrame:
    return CS.changeset_columns(standin.changesets(spark, sf).withColumn("members_ds", F.lit(None)))


def _rollup(spark: SparkSession, sf: str) -> DataFrame:
    kept = _kept(spark, sf).select("id")
    return rollup_for(standin.history(spark, sf), kept, kept.count())


def _enriched(spark: SparkSession, sf: str) -> DataFrame:
    return enrich_changesets(
        standin.changesets(spark, sf),
        standin.history(spark, sf),
        standin.members(spark, sf),
        prepared_index(standin.boundaries(spark, sf), CELL),
        SINCE,
        CELL,
    )


def _newest_members(spark: SparkSession, sf: str) -> DataFrame:
    return latest_partition(standin.members(spark, sf))


def _activity(spark: SparkSession, sf: str) -> DataFrame:
    return M.activity_table(
        with_cell(_enriched(spark, sf)), _newest_members(spark, sf), standin.boundaries(spark, sf)
    )


def _events(spark: SparkSession, sf: str) -> DataFrame:
    """Events as changesets are many per place and day, orders are few."""
    return M.activity_table(
        standin.event_changesets(spark, sf), _newest_members(spark, sf), standin.boundaries(spark, sf)
    )


def tag_extract(spark: SparkSession, sf: str) -> DataFrame:
    return _columns(spark, sf).select("id", "comment", "created_by", "host", "imagery_used", "source")


def hashtag_split(spark: SparkSession, sf: str) -> DataFrame:
    return _columns(spark, sf).select(
        "id", F.size("hashtags").alias("n_hashtags"), F.array_join("hashtags", "|").alias("hashtags")
    )


def tags_residual(spark: SparkSession, sf: str) -> DataFrame:
    tags = F.col("tags")
    return _columns(spark, sf).select(
        "id",
        F.size(tags).alias("n_tags"),
        F.element_at(tags, "locale").alias("locale"),
        F.element_at(tags, "review").alias("review"),
    )


def member_semi_join(spark: SparkSession, sf: str) -> DataFrame:
    return _kept(spark, sf).select("id", "uid", "created_at", "members_ds")


def changeset_rollup_shuffled(spark: SparkSession, sf: str) -> DataFrame:
    kept = _kept(spark, sf).select("id")
    return rollup_for(standin.history(spark, sf), kept, kept.count(), broadcast_limit=0)


def changeset_rollup_bitmap(spark: SparkSession, sf: str) -> DataFrame:
    kept = _kept(spark, sf).select("id")
    return rollup_for(standin.history(spark, sf), kept, kept.count(), broadcast_limit=0, bitmap_limit=BROADCAST_BYTES)


def changeset_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return _rollup(spark, sf)


def conditional_struct_flat(spark: SparkSession, sf: str) -> DataFrame:
    kept = _kept(spark, sf).select("id", "num_changes")
    joined = kept.join(_rollup(spark, sf), F.col("id") == F.col("changeset"))
    flags = [F.isnull(g).alias(f"no_{g}") for g in METRICS]
    return joined.select("id", *metric_structs()).select("id", *flags, *_flat(METRICS))


def bbox_diameter(spark: SparkSession, sf: str) -> DataFrame:
    return _columns(spark, sf).select("id", F.col("bbox.diameter").alias("diameter"))


def bbox_midpoint(spark: SparkSession, sf: str) -> DataFrame:
    return _columns(spark, sf).select(
        "id",
        *[F.col(f"bbox.{c}").cast("double").alias(c) for c in ("xmin", "ymin", "xmax", "ymax")],
        "lon",
        "lat",
    )


def cell_assign(spark: SparkSession, sf: str) -> DataFrame:
    points = _columns(spark, sf)
    return points.select(
        "id", *[cell_of_point(F.col("lon"), F.col("lat"), r).alias(f"cell_{r}") for r in (8, 6, 4)]
    )


def cell_parent(spark: SparkSession, sf: str) -> DataFrame:
    cells = _columns(spark, sf).select("id", cell_of_point(F.col("lon"), F.col("lat"), 8).alias("h3"))
    return cells.select("id", *[parent_cell(F.col("h3"), r).alias(f"cell_{r}") for r in (6, 4)])


def h3_cell_parent(spark: SparkSession, sf: str) -> DataFrame:
    """Resolution-8 shaped ids made from line-item keys, and their parents."""
    digits = F.expr(
        "shiftleft((l_orderkey * 7919 + l_partkey * 31 + l_linenumber) % 1073741824, 21)"
    )
    items = standin.given_table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    base = F.lit((1 << 59) | (8 << 52) | (1 << 51) | ((1 << 21) - 1))
    cell = F.lower(F.hex(digits.bitwiseOR(base))).alias("h3")
    return items.select("l_orderkey", "l_partkey", "l_linenumber", cell).select(
        "*", *[h3_parent(F.col("h3"), r).alias(f"parent_{r}") for r in (6, 4)]
    )


def enriched_changesets(spark: SparkSession, sf: str) -> DataFrame:
    enriched = _enriched(spark, sf)
    return enriched.select(
        "id", "uid", "username", "created_at", "closed_at", "comment", "created_by", "imagery_used",
        "host", "source", F.array_join("hashtags", "|").alias("hashtags"), F.size("tags").alias("n_tags"),
        *_flat(METRICS), F.col("bbox.diameter").alias("diameter"), "lon", "lat", "a3", "members_ds", "ds",
    )


def latest_partition_members(spark: SparkSession, sf: str) -> DataFrame:
    newest = _newest_members(spark, sf)
    return newest.select("uid", "chapter_id", "chapter", "city", "country", "ds")


def as_of_members(spark: SparkSession, sf: str) -> DataFrame:
    recorded = standin.event_changesets(spark, sf).withColumn("members_ds", F.lit(standin.OLDER_DS))
    return members_as_of(standin.members(spark, sf), recorded).select("uid", "chapter_id", "ds")


def one_chapter_per_member(spark: SparkSession, sf: str) -> DataFrame:
    return M.one_chapter_per_member(_newest_members(spark, sf)).select("uid", "chapter_id", "chapter")


def activity_table(spark: SparkSession, sf: str) -> DataFrame:
    return _activity(spark, sf).select(
        "id", "uid", "h3", "created_at", "a3", "chapter_id", "chapter", "university",
        "chapter_country", "chapter_city", "chapter_location", "country",
        F.col("region.continent").alias("continent"), F.col("features.new").alias("features_new"),
    )


def _daily_flat(daily: DataFrame) -> DataFrame:
    return daily.select(
        "h3", "uid", "created_at", "chapter_id", *_flat(METRICS),
        *[F.col("envelope")[c].cast("double").alias(c) for c in C.CORNERS],
        "lon", "lat", "n_points", "n_boxes",
    )


def daily_cells(spark: SparkSession, sf: str) -> DataFrame:
    return _daily_flat(C.daily_cells(_activity(spark, sf)))


def daily_cells_events(spark: SparkSession, sf: str) -> DataFrame:
    return _daily_flat(C.daily_cells(_events(spark, sf)))


def daily_point_union(spark: SparkSession, sf: str) -> DataFrame:
    return C.point_union(_events(spark, sf))


def _boxes(*keys: str) -> list[str | Column]:
    return [*keys, *[F.col("bbox")[c].cast("double").alias(c) for c in C.CORNERS]]


def daily_bboxes(spark: SparkSession, sf: str) -> DataFrame:
    """Every box of every daily cell, found by the cell's key."""
    activity = working_table(_events(spark, sf), "activity")
    daily = C.with_row_key(working_table(C.daily_cells(activity), "daily"), SALT)
    boxed = daily.select(*C.KEYS, "n_boxes", "row_key").join(C.box_rows(activity, SALT), "row_key")
    return boxed.select(*_boxes(*C.KEYS, "n_boxes"))


def daily_box_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The boxes as they are published, with nothing but their key."""
    return C.box_rows(_events(spark, sf), SALT).select(*_boxes("row_key"))


# Fixed here so that SQL can compute the keys; a run draws its own.
SALT = "check"


def weekly_chapters(spark: SparkSession, sf: str) -> DataFrame:
    return A.weekly_chapters(C.daily_cells(_activity(spark, sf)))


def weekly_chapters_events(spark: SparkSession, sf: str) -> DataFrame:
    return A.weekly_chapters(C.daily_cells(_events(spark, sf)))


def monthly_activity(spark: SparkSession, sf: str) -> DataFrame:
    return A.monthly_activity(C.daily_cells(_activity(spark, sf)), RUN_DATE)


def monthly_document(spark: SparkSession, sf: str) -> DataFrame:
    return D.monthly_document(working_table(monthly_activity(spark, sf), "months"))


def country_months(spark: SparkSession, sf: str) -> DataFrame:
    return A.most_edited_first(A.country_months(_activity(spark, sf), RUN_DATE))


def country_months_events(spark: SparkSession, sf: str) -> DataFrame:
    return A.most_edited_first(A.country_months(_events(spark, sf), EVENT_RUN_DATE))


def top15_countries(spark: SparkSession, sf: str) -> DataFrame:
    return A.top_countries(A.country_months(_activity(spark, sf), RUN_DATE))


def top_countries_document(spark: SparkSession, sf: str) -> DataFrame:
    return D.top_countries_document(working_table(top15_countries(spark, sf), "top"))


def chapter_index(spark: SparkSession, sf: str) -> DataFrame:
    return A.chapter_index(_events(spark, sf))


def chapters_document(spark: SparkSession, sf: str) -> DataFrame:
    return D.chapters_document(working_table(chapter_index(spark, sf), "chapters"), "2024-01-30")


def coarse_cells_6(spark: SparkSession, sf: str) -> DataFrame:
    return C.coarse_cells(_activity(spark, sf), 6)


def coarse_cells_4(spark: SparkSession, sf: str) -> DataFrame:
    return C.coarse_cells(_activity(spark, sf), 4)


def coarse_cells_6_events(spark: SparkSession, sf: str) -> DataFrame:
    return C.coarse_cells(_events(spark, sf), 6)


def daily_points(spark: SparkSession, sf: str) -> DataFrame:
    return C.daily_points(C.daily_cells(_activity(spark, sf)))


def daily_boxes(spark: SparkSession, sf: str) -> DataFrame:
    return C.daily_boxes(C.daily_cells(_activity(spark, sf)))


def geojson_points(spark: SparkSession, sf: str) -> DataFrame:
    return feature_lines(C.daily_points(C.daily_cells(_events(spark, sf))))


def geojson_boxes(spark: SparkSession, sf: str) -> DataFrame:
    return feature_lines(daily_boxes(spark, sf))


def tile_points(spark: SparkSession, sf: str) -> DataFrame:
    return tile_features(daily_points(spark, sf), "points")


def tile_boxes(spark: SparkSession, sf: str) -> DataFrame:
    return tile_features(daily_boxes(spark, sf), "boxes")


def tile_coarse(spark: SparkSession, sf: str) -> DataFrame:
    return tile_features(coarse_cells_6_events(spark, sf), "coarse_6")


def point_in_polygon_join(spark: SparkSession, sf: str) -> DataFrame:
    index = prepared_index(standin.boundaries(spark, sf), CELL)
    points = _columns(spark, sf).select("id", "lon", "lat")
    return locate(points, index, CELL)


def _public_rollup(spark: SparkSession, sf: str, activity: DataFrame) -> DataFrame:
    daily = C.with_row_key(working_table(C.daily_cells(activity), "daily"), SALT)
    index = prepared_index(standin.boundaries(spark, sf), CELL)
    return public_rollup(daily, _newest_members(spark, sf), standin.boundaries(spark, sf), index, CELL)


def public_rollup_flat(spark: SparkSession, sf: str) -> DataFrame:
    activity = working_table(_events(spark, sf), "activity")
    return _public_rollup(spark, sf, activity).select(
        "h3", "created_at", *_flat(METRICS), F.col("n_boxes").cast("int").alias("n_bboxes"), "chapter_id", "chapter",
        "chapter_country", "chapter_city", "chapter_location", "a3", "country",
        F.col("country_name.primary").alias("country_name"), F.col("region.continent").alias("continent"),
        "lon", "lat",
    )


def public_rollup_boxes(spark: SparkSession, sf: str) -> DataFrame:
    """Every published row with each of its boxes, joined by nothing but the key."""
    activity = working_table(_events(spark, sf), "activity")
    boxes = C.box_rows(activity, SALT)
    return _public_rollup(spark, sf, activity).join(boxes, "row_key").select(
        *_boxes("h3", "created_at", "chapter_id", "a3")
    )


QUERIES: dict[str, Query] = {
    "tag_extract": tag_extract,
    "hashtag_split": hashtag_split,
    "tags_residual": tags_residual,
    "bbox_diameter": bbox_diameter,
    "bbox_midpoint": bbox_midpoint,
    "cell_assign": cell_assign,
    "cell_parent": cell_parent,
    "h3_cell_parent": h3_cell_parent,
    "latest_partition": latest_partition_members,
    "as_of_members": as_of_members,
    "one_chapter_per_member": one_chapter_per_member,
    "member_semi_join": member_semi_join,
    "changeset_rollup": changeset_rollup,
    "changeset_rollup_shuffled": changeset_rollup_shuffled,
    "changeset_rollup_bitmap": changeset_rollup_bitmap,
    "conditional_struct_flat": conditional_struct_flat,
    "point_in_polygon_join": point_in_polygon_join,
    "enriched_changesets": enriched_changesets,
    "activity_table": activity_table,
    "daily_cells": daily_cells,
    "daily_cells_events": daily_cells_events,
    "daily_point_union": daily_point_union,
    "daily_bboxes": daily_bboxes,
    "daily_box_rows": daily_box_rows,
    "weekly_chapters": weekly_chapters,
    "weekly_chapters_events": weekly_chapters_events,
    "monthly_activity": monthly_activity,
    "monthly_document": monthly_document,
    "country_months": country_months,
    "country_months_events": country_months_events,
    "top15_countries": top15_countries,
    "top_countries_document": top_countries_document,
    "chapter_index": chapter_index,
    "chapters_document": chapters_document,
    "coarse_cells_6": coarse_cells_6,
    "coarse_cells_4": coarse_cells_4,
    "coarse_cells_6_events": coarse_cells_6_events,
    "daily_points": daily_points,
    "daily_boxes": daily_boxes,
    "geojson_points": geojson_points,
    "geojson_boxes": geojson_boxes,
    "tile_points": tile_points,
    "tile_boxes": tile_boxes,
    "tile_coarse": tile_coarse,
    "public_rollup": public_rollup_flat,
    "public_rollup_boxes": public_rollup_boxes,
}
