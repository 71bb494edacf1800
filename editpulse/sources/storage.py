"""Listing and moving files through Hadoop's file systems, so that any path Spark reads will do."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import SparkSession

_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    return hadoop_path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def visible_files(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, in order, without those that readers skip."""
    listed = file_system(spark, folder).listStatus(hadoop_path(spark, folder))
    return sorted(n for n in (f.getPath().getName() for f in listed) if not n.startswith(("_", ".")))


def partitions(spark: SparkSession, path: str, column: str = "ds") -> dict[str, str]:
    """Value -> folder of every ``column=value`` folder with files in it, from listings alone, in order."""
    prefix = f"{column}="
    listed = file_system(spark, path).listStatus(hadoop_path(spark, path))
    folders = sorted(f.getPath().getName() for f in listed if f.isDirectory())
    found = {unquote(n.removeprefix(prefix)): f"{path.rstrip('/')}/{n}" for n in folders if n.startswith(prefix)}
    found.pop(_NO_VALUE, None)
    return {value: folder for value, folder in found.items() if visible_files(spark, folder)}
