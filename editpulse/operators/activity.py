"""Dashboard aggregates: weekly, monthly, countries, chapters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from editpulse.functions.metrics import other_features, touched
from editpulse.functions.timebins import month_label, month_start, trailing_month_start, week


def weekly_chapters(daily: DataFrame) -> DataFrame:
    """Totals and distinct mappers per chapter and ISO week."""
    return daily.groupBy("chapter_id", week(F.col("created_at")).cast("timestamp_ntz").alias("week")).agg(
        F.sum(touched("features")).cast("int").alias("all_feats"),
        F.sum(touched("buildings")).cast("int").alias("buildings"),
        F.sum(touched("highways")).cast("int").alias("highways"),
        F.sum(touched("amenities")).cast("int").alias("amenities"),
        F.sum(other_features()).cast("int").alias("other"),
        F.count_distinct("uid").alias("mappers"),
    )


def monthly_activity(daily: DataFrame, run_date: dt.date) -> DataFrame:
    """Totals, distinct chapters and distinct users of every full month before the run date.

    Sums are first taken per (month, member, chapter): two distinct counts multiply
    their input rows, so that input should be small.
    """
    themes = ("buildings", "highways", "amenities")
    names = [(f"{kind}_{theme}", F.col(theme)[kind]) for kind in ("new", "edited") for theme in themes]
    per_member = (
        daily.where(F.col("created_at") < F.lit(month_start(run_date)))
        .groupBy(month_label(F.col("created_at")).alias("month"), "uid", "chapter_id")
        .agg(*[F.sum(value).alias(name) for name, value in names])
    )
    return (
        per_member.groupBy("month")
        .agg(
            *[F.sum(name).alias(name) for name, _ in names],
            F.count_distinct("chapter_id").alias("chapters"),
            F.count_distinct("uid").alias("users"),
        )
        .orderBy(F.col("month").asc_nulls_last())
    )


def country_months(activity: DataFrame, run_date: dt.date, days: int = 90) -> DataFrame:
    """Features per country and month, strictly after the trailing window's month start."""
    start = F.lit(trailing_month_start(run_date, days)).cast("timestamp_ntz")
    return (
        activity.where((F.col("created_at") > start) & F.col("country").isNotNull())
        .groupBy("country", month_label(F.col("created_at")).alias("month"))
        .agg(F.sum(touched("features")).alias("all_feats"))
    )


def most_edited_first(countries: DataFrame) -> DataFrame:
    return countries.orderBy(F.col("all_feats").desc_nulls_last(), "month", "country")


def top_countries(countries: DataFrame, k: int = 15) -> DataFrame:
    """The ``k`` countries with most features in each month; ties go by country name."""
    order = Window.partitionBy("month").orderBy(F.col("all_feats").desc_nulls_last(), "country")
    ranked = countries.withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k).orderBy("month", "rank")


def chapter_index(activity: DataFrame) -> DataFrame:
    """Distinct chapters with their place."""
    return activity.select(
        "chapter",
        "chapter_id",
        F.col("chapter_city").alias("city"),
        F.col("chapter_country").alias("country"),
        "university",
    ).distinct()
