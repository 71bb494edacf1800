"""Enriched changesets -> dashboard tables and files."""

from __future__ import annotations

import datetime as dt
import secrets

from pyspark.sql import SparkSession

from editpulse.operators import activity as A
from editpulse.operators import cells as C
from editpulse.operators import documents as D
from editpulse.operators.features import feature_lines, tile_features
from editpulse.operators.members import activity_table, one_chapter_per_member
from editpulse.operators.public import public_rollup
from editpulse.operators.spatial import prepared_index
from editpulse.sources import sinks, tables
from editpulse.sources.release import Release
from editpulse.sources.working import working_run, working_table


def run(
    spark: SparkSession,
    enriched: str,
    members: str,
    boundaries: str,
    output: str,
    run_date: dt.date,
    single_chapter: bool = False,
    keep_boxes: bool = True,
) -> str:
    """Build every dashboard output from the latest enriched partition; return its ``ds``."""
    ds = tables.newest_partition(spark, enriched)
    if ds is None:
        raise ValueError(f"no ds= partition with rows in {enriched}")
    with working_run(spark), Release(spark, output) as release:
        _write(spark, release, enriched, members, boundaries, ds, run_date, single_chapter, keep_boxes)
        release.publish(sinks.LATEST, ds)
    return ds


def _write(
    spark: SparkSession, release: Release, enriched: str, members: str, boundaries: str, ds: str, run_date: dt.date,
    single_chapter: bool, keep_boxes: bool,
) -> None:
    changesets = tables.read_enriched(spark, enriched, ds)
    people = tables.members_as_of(tables.read_members(spark, members), changesets)
    if single_chapter:
        people = one_chapter_per_member(people)
    countries = tables.read_boundaries(spark, boundaries)

    activity = working_table(activity_table(changesets, people, countries), "activity")
    daily = working_table(C.daily_cells(activity), "daily")
    paths = sinks.release_paths(release.root, ds)

    # Documents read their rows twice, so those few rows are written first.
    chapters = working_table(A.chapter_index(activity), "chapters")
    months = working_table(A.monthly_activity(daily, run_date), "months")
    top = working_table(A.top_countries(A.country_months(activity, run_date)), "top")

    def document(name: str) -> str:
        return release.path(paths[name], single=True)

    sinks.write_csv(A.weekly_chapters(daily), document("weekly"))
    sinks.write_lines(D.chapters_document(chapters, ds), document("chapters"))
    sinks.write_lines(D.monthly_document(months), document("monthly"))
    sinks.write_lines(D.top_countries_document(top), document("top_countries"))

    layers = {
        "coarse_4": C.coarse_cells(activity, 4),
        "coarse_6": C.coarse_cells(activity, 6),
        "points": C.daily_points(daily),
        "boxes": C.daily_boxes(daily),
    }
    for layer, features in layers.items():
        sinks.write_lines(feature_lines(features), release.path(f"features/{layer}"))
        sinks.write_tiles(tile_features(features, layer), release.path(paths[layer]))

    salt = secrets.token_hex(16)
    rollup = public_rollup(
        C.with_row_key(daily, salt), people, countries, prepared_index(countries), keep_boxes=keep_boxes
    )
    sinks.write_parquet(sinks.with_geometry(rollup), release.path(paths["rollup"]))
    if keep_boxes:
        sinks.write_parquet(C.box_rows(activity, salt), release.path(f"{paths['rollup']}.boxes"))
