"""Writers (K1, K2, K6-K11). Every writer is distributed; AQE merges small outputs into one file."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from editpulse.functions.wkb import point_wkb
from editpulse.sources.release import replace_folder
from editpulse.sources.storage import file_system, hadoop_path

# Output names of the dashboard release.
RELEASED = {
    "weekly": "weekly_chapter_activity.csv",
    "top_countries": "top_edited_countries.json",
    "monthly": "monthly_activity_all_time.json",
}
LATEST = "latest_ds.txt"
CHAPTERS = "activity.json"
ROLLUP = "daily_rollup.parquet"


def with_geometry(df: DataFrame) -> DataFrame:
    """Add the WKB point next to ``lon``/``lat``."""
    return df.withColumn("geometry", point_wkb("lon", "lat"))


def write_partitioned(df: DataFrame, path: str, column: str = "ds", keep_others: bool = False) -> None:
    """ZSTD Parquet partitioned by ``ds``; older partitions go unless ``keep_others``.

    A run that fails leaves the table as it was and can be repeated: with ``keep_others`` Spark
    moves finished partitions into place, without it the whole table is written aside and moved.
    """
    writer = df.write.mode("overwrite").partitionBy(column).option("compression", "zstd")
    if keep_others:
        writer.option("partitionOverwriteMode", "dynamic").parquet(path)
        return
    spark, aside = df.sparkSession, f"{path.rstrip('/')}-new-{uuid.uuid4().hex}"
    try:
        writer.parquet(aside)
        replace_folder(spark, aside, path)
    finally:
        file_system(spark, aside).delete(hadoop_path(spark, aside), True)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path)


def write_lines(lines: DataFrame, path: str) -> None:
    """Text lines in their order: documents, GeoJSON sequences."""
    lines.write.mode("overwrite").text(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_tiles(tiles: DataFrame, path: str) -> None:
    """Tile buckets, one folder per zoom and tile column.

    Rebalancing gives each folder few files; AQE cuts up a crowded tile column.
    """
    tiles.hint("rebalance", "x").write.mode("overwrite").partitionBy("z", "x").option("compression", "zstd").parquet(path)


def read_marker(spark: SparkSession, path: str) -> str:
    return spark.read.text(path).first()["value"]


def release_paths(root: str, ds: str) -> dict[str, str]:
    """Where each released output goes: dated ones under ``ds=``, two at fixed paths."""
    base = root.rstrip("/")
    dated = {key: f"{base}/activity-dashboard/ds={ds}/{name}" for key, name in RELEASED.items()}
    tiles = {
        key: f"{base}/activity-dashboard/ds={ds}/{key}_tiles"
        for key in ("coarse_4", "coarse_6", "points", "boxes")
    }
    return {
        **dated,
        **tiles,
        "chapters": f"{base}/activity-dashboard/{CHAPTERS}",
        "rollup": f"{base}/activity/{ROLLUP}",
    }
