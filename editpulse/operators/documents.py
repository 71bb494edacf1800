"""JSON documents as ordered text lines (K3-K5).

A document is never gathered into one row: its elements are sorted lines that
Spark range-partitions, and the part files read in order form the document.
Small documents end up in one part file by themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editpulse.functions.timebins import epoch_millis

_KEEP_NULLS = {"ignoreNullFields": "false"}


def document_lines(elements: DataFrame, sort: list[str], head: str, tail: str) -> DataFrame:
    """Lines ``head``, one element per line, ``tail``; ``elements`` has ``json`` and sort columns.

    ``sort`` must be unique up to equal ``json``. All but the first element start
    with a comma, the first being the one with the smallest sort key.
    """
    nulls_last = [item for name in sort for item in (F.isnull(name).alias(f"no_{name}"), F.col(name))]
    key = F.struct(*nulls_last, "json")
    first = elements.select(F.min(key)).scalar()
    body = elements.select(
        F.lit(1).alias("part"),
        key.alias("key"),
        F.concat(F.when(key == first, "").otherwise(","), F.col("json")).alias("value"),
    )
    kind = body.schema["key"].dataType.simpleString()
    spark = elements.sparkSession
    frame = spark.range(2).select(
        (F.col("id") * 2).cast("int").alias("part"),
        F.lit(None).cast(kind).alias("key"),
        F.when(F.col("id") == 0, head).otherwise(tail).alias("value"),
    )
    return body.unionByName(frame).orderBy("part", "key").select("value")


def monthly_document(monthly: DataFrame, unit: str = "ms") -> DataFrame:
    """Array of monthly records; ``month`` is an epoch number in ``ms`` or ``s``."""
    epoch = epoch_millis(F.col("month"))
    stamp = epoch if unit == "ms" else F.floor(epoch / 1000).cast("long")
    values = [c for c in monthly.columns if c != "month"]
    record = F.struct(stamp.alias("month"), *values)
    return document_lines(
        monthly.select("month", F.to_json(record, _KEEP_NULLS).alias("json")), ["month"], "[", "]"
    )


def chapters_document(chapters: DataFrame, ds: str) -> DataFrame:
    """``{"chapters": [...], "ds": ...}`` with chapters sorted by name."""
    record = F.to_json(F.struct(*chapters.columns), _KEEP_NULLS)
    return document_lines(
        chapters.select(*chapters.columns, record.alias("json")),
        ["chapter", "chapter_id"],
        '{"chapters":[',
        f'],"ds":"{ds}"}}',
    )


def top_countries_document(top: DataFrame) -> DataFrame:
    """Array of ``{"month", "top_countries": [[country, n], ...]}``; at most k pairs per month."""
    name = F.to_json(F.array("country"))
    pair = F.concat(
        F.substring(name, F.lit(1), F.length(name) - 1),
        F.lit(","),
        F.col("all_feats").cast("string"),
        F.lit("]"),
    )
    months = top.groupBy("month").agg(
        F.array_sort(F.collect_list(F.struct("rank", pair.alias("pair")))).alias("pairs")
    )
    stamp = F.date_format("month", "yyyy-MM-dd'T'HH:mm:ss")
    json = F.concat(
        F.lit('{"month":"'),
        stamp,
        F.lit('","top_countries":['),
        F.array_join(F.transform("pairs", lambda p: p["pair"]), ","),
        F.lit("]}"),
    )
    return document_lines(months.select("month", json.alias("json")), ["month"], "[", "]")
