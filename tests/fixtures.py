"""Hand-made map-editing rows, one reason per row."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse import schemas
from editpulse.functions.wkb import point_wkb, polygon_wkb

NEW_DS, OLD_DS = "2024-03-03", "2024-02-25"
RUN_DATE = dt.date(2024, 3, 5)


def _box(x1, y1, x2, y2):
    return tuple(None if v is None else Decimal(str(v)) for v in (y1, y2, x1, x2))


def changesets(spark: SparkSession) -> DataFrame:
    at = dt.datetime
    six = {k: k[0] for k in ("comment", "created_by", "hashtags", "host", "imagery_used", "source")}
    rows = [
        # id, tags, created_at, box, num_changes, uid
        (1, {"comment": "c1", "hashtags": "#a;#b;", "review": "y"}, at(2024, 1, 15, 8), _box(10, 10, 10, 10), 5, 100),
        (2, None, at(2024, 1, 15, 9), _box(10, 10, 10, 10), 6, 100),  # same point, cell, day as 1
        (3, {}, at(2024, 1, 16), _box(None, None, None, None), 1, 100),  # no box
        (4, six, at(2024, 2, 1), _box(30, 10, 32, 12), 2, 101),  # in two boundaries
        (5, {"a": "b"}, at(2024, 2, 2), _box(10, 10, 11, 11), 3, 101),  # no history: vanishes
        (6, {"a": "b"}, at(2014, 12, 31, 23, 59), _box(10, 10, 11, 11), 3, 101),  # before cutoff
        (7, {"a": "b"}, at(2015, 1, 1), _box(-150, -60, -149, -59), 3, 101),  # at cutoff, in no boundary
        (8, {"a": "b"}, at(2024, 3, 4, 12), _box(10.25, 10.25, 10.75, 10.75), 3, 102),  # two chapters
        (9, {"a": "b"}, at(2024, 3, 9), _box(10, 10, 11, 11), 3, 103),  # only in the old snapshot
        (10, {"a": "b"}, at(2024, 3, 10), _box(10, 10, 11, 11), 3, 104),  # never a member
        (11, {"a": "b"}, at(2023, 12, 1), _box(14.5, 14.5, 15.5, 15.5), 3, 102),  # in the hole; month start
        (12, {"a": "b"}, at(2024, 3, 5), _box(20, 10, 20, 10), 3, 100),  # on a border; no history rows kept
    ]
    full = [
        (i, tags, ts, False, ts + dt.timedelta(hours=1), 0, *box, n, uid, f"user{uid}")
        for i, tags, ts, box, n, uid in rows
    ]
    return spark.createDataFrame(full, schemas.CHANGESETS)


def history(spark: SparkSession) -> DataFrame:
    b, h, a = {"building": "yes"}, {"highway": "path"}, {"amenity": "school"}
    rows = [
        # changeset, type, tags, version, visible
        (1, "way", b, 1, True),
        (1, "way", {**b, **h}, 1, True),  # two themes: "other" goes negative
        (1, "node", {}, 1, True),
        (1, "node", {}, 2, True),
        (1, "node", None, 1, True),  # NULL tags: no tag-based counter
        (2, "node", a, 1, False),  # new feature, not a new element
        (2, "node", a, 3, False),  # edited and deleted node
        (3, "relation", {"type": "route"}, 2, True),
        (4, "way", h, 4, True),
        (6, "way", h, 4, True),
        (7, "way", b, 1, True),
        (8, "way", b, 1, True),
        (8, "way", b, 2, True),
        (9, "way", b, 1, True),
        (10, "way", b, 1, True),
        (11, "node", a, 1, True),
        (999, "way", b, 1, True),  # unknown changeset
    ]
    full = [
        (n, kind, tags, None, None, None, None, cs, dt.datetime(2024, 1, 1), 1, "u", version, visible)
        for n, (cs, kind, tags, version, visible) in enumerate(rows)
    ]
    return spark.createDataFrame(full, schemas.ELEMENTS)


def members(spark: SparkSession) -> DataFrame:
    rows = [
        (100, 1, "Alpha", "U1", "C1", "K1", NEW_DS), (101, 2, "Beta", "U2", None, "K2", NEW_DS),
        (102, 2, "Beta", "U2", None, "K2", NEW_DS), (102, 3, "Gamma", "U3", "C3", "K3", NEW_DS),
        (103, 1, "Alpha", "U1", "C1", "K1", OLD_DS), (100, 1, "Alpha", "U1", "C1", "K1", OLD_DS),
    ]
    short = spark.createDataFrame(
        rows, "uid long, team_id long, chapter string, university string, city string, country string, ds string"
    ).withColumn("geometry", point_wkb(F.col("team_id") + 0.5, F.col("team_id") * -1.0))
    columns = [
        F.col(f.name).cast(f.dataType) if f.name in short.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schemas.MEMBERS.fields
    ]
    return short.select(*columns)


def _ring(*points):
    return [[float(x), float(y)] for x, y in (*points, points[0])]


SHAPES = {
    # 5..20 square with a hole 14..16
    "AAA": [[_ring((5, 5), (20, 5), (20, 20), (5, 20)), _ring((14, 14), (14, 16), (16, 16), (16, 14))]],
    # concave, overlaps CCC
    "BBB": [[_ring((25, 5), (40, 5), (40, 20), (32.5, 9), (25, 20))]],
    # two parts
    "CCC": [[_ring((30, 8), (35, 8), (35, 15), (30, 15))], [_ring((60, 8), (65, 8), (65, 15), (60, 15))]],
}


def boundaries(spark: SparkSession) -> DataFrame:
    rows = [(a3, f"Land {a3}", parts) for a3, parts in SHAPES.items()]
    frame = spark.createDataFrame(rows, "a3 string, country string, parts array<array<array<array<double>>>>")
    text = lambda fields, value: F.struct(
        *[(value if i == 0 else F.lit(None).cast("string")).alias(f) for i, f in enumerate(fields)]
    )
    return frame.select(
        "a3",
        "country",
        text(schemas.BOUNDARY_NAME, F.col("country")).alias("name"),
        text(schemas.BOUNDARY_ENTITY, F.col("country")).alias("entity"),
        text(schemas.BOUNDARY_REGION, F.lit("W")).alias("region"),
        polygon_wkb("parts").alias("geometry"),
    )
