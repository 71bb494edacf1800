"""Joins of changesets and daily cells with members and countries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editpulse.functions.geo import point_text
from editpulse.functions.wkb import point_xy
from editpulse.operators.sizing import BROADCAST_BYTES, broadcast_if_small


def one_chapter_per_member(members: DataFrame) -> DataFrame:
    """Keep each member's row with the smallest chapter id, so that joins do not fan out."""
    columns = [c for c in members.columns if c != "uid"]
    kept = members.groupBy("uid").agg(
        F.min_by(F.struct(*columns), F.struct("chapter_id", "chapter")).alias("_m")
    )
    return kept.select("uid", "_m.*")


def member_columns(members: DataFrame) -> DataFrame:
    """Member attributes under their output names, with the location as text."""
    dropped = ("team_id", "geometry", "city", "country", "username", "ds")
    attributes = [c for c in members.columns if c not in dropped]
    point = point_xy("geometry")
    return members.withColumn("_p", point).select(
        *attributes,
        F.col("country").alias("chapter_country"),
        F.col("city").alias("chapter_city"),
        point_text(F.col("_p.lon"), F.col("_p.lat")).alias("chapter_location"),
    )


def country_columns(boundaries: DataFrame) -> DataFrame:
    return boundaries.drop("geometry")


def activity_table(
    changesets: DataFrame,
    members: DataFrame,
    boundaries: DataFrame,
    broadcast_limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Changesets with member and country attributes.

    A member listed under several chapters yields a row per chapter. A changeset
    without a country keeps NULL country attributes.
    """
    people = broadcast_if_small(member_columns(members), broadcast_limit)
    countries = broadcast_if_small(country_columns(boundaries), broadcast_limit)
    return changesets.drop("geometry").join(people, "uid").join(countries, "a3", "left")
