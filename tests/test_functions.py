from __future__ import annotations

import math
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from editpulse.functions import geo, grid, tags, timebins, wkb


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def test_tags(spark):
    frame = spark.createDataFrame(
        [(1, {"comment": "c", "hashtags": "#a;#b;", "x": "1"}), (2, {"comment": "c"}), (3, {}), (4, None)],
        "id int, t map<string,string>",
    ).withColumn("rest", tags.other_tags(F.col("t")))
    rows = frame.select(
        "id",
        tags.tag(F.col("t"), "comment").alias("c"),
        tags.hashtags(F.col("t")).alias("h"),
        tags.null_if_empty(F.col("rest")).alias("rest"),
    ).orderBy("id").collect()
    assert [r["c"] for r in rows] == ["c", "c", None, None]
    assert [r["h"] for r in rows] == [["#a", "#b", ""], None, None, None]
    assert [r["rest"] for r in rows] == [{"x": "1"}, None, None, None]


def test_great_circle(spark):
    lit = lambda *v: [F.lit(x) for x in v]
    row = one(
        spark,
        km=F.round(geo.great_circle_km(*lit(36.12, -86.67, 33.94, -118.40)), 3),
        zero=geo.great_circle_km(*lit(1.0, 2.0, 1.0, 2.0)),
        outside=geo.great_circle_km(*lit(91.0, 2.0, 1.0, 2.0)),
        missing=geo.great_circle_km(F.lit(None).cast("double"), *lit(2.0, 1.0, 2.0)),
    )
    assert row["km"] == pytest.approx(2886.449, abs=0.001)
    assert row["zero"] == 0
    assert row["outside"] is None and row["missing"] is None


def test_point_text(spark):
    texts = [
        one(spark, t=geo.point_text(F.lit(x).cast("double"), F.lit(y).cast("double")))["t"]
        for x, y in ((12.5, -3.0), (100.0, 0.0), (-0.0001, 36.123456), (None, 1.0))
    ]
    assert texts == ["POINT (12.5 -3)", "POINT (100 0)", "POINT (-0.0001 36.123456)", None]


def test_parent_is_direct_cell(spark):
    rng = np.random.default_rng(1)
    points = [(float(x), float(y)) for x, y in zip(rng.uniform(-180, 180, 500), rng.uniform(-90, 90, 500))]
    points += [(-180.0, -90.0), (180.0, 90.0), (0.0, 0.0)]
    frame = spark.createDataFrame(points, "lon double, lat double")
    cell = grid.cell_of_point(F.col("lon"), F.col("lat"), 8)
    for resolution in (6, 4):
        direct = grid.cell_of_point(F.col("lon"), F.col("lat"), resolution)
        assert frame.where(grid.parent_cell(cell, resolution) != direct).count() == 0


def test_cell_of_null_point_is_null(spark):
    none = F.lit(None).cast("double")
    row = one(spark, a=grid.cell_of_point(none, F.lit(1.0)), b=grid.parent_cell(none.cast("string"), 6))
    assert row["a"] is None and row["b"] is None


def test_h3_parent_known_ids(spark):
    row = one(
        spark,
        a=grid.h3_parent(F.lit("8928308280fffff"), 8),
        b=grid.h3_parent(F.lit("8928308280fffff"), 7),
        c=grid.parent_cell(F.lit("8828308281fffff"), 6),
    )
    assert row["a"] == "8828308281fffff" and row["b"] == "872830828ffffff" and row["c"] == "86283082fffffff"


def test_tiles_against_plain_arithmetic(spark):
    rng = np.random.default_rng(2)
    points = [(float(x), float(y)) for x, y in zip(rng.uniform(-180, 180, 400), rng.uniform(-90, 90, 400))]
    points += [(180.0, 90.0), (-180.0, -90.0)]
    frame = spark.createDataFrame(points, "lon double, lat double")
    for zoom in (2, 4, 6):
        n = 2**zoom
        got = frame.select("lon", "lat", grid.tile_x(F.col("lon"), zoom), grid.tile_y(F.col("lat"), zoom)).collect()
        for lon, lat, x, y in got:
            phi = math.radians(max(min(lat, 85.06), -85.06))
            want_y = int((1 - math.asinh(math.tan(phi)) / math.pi) / 2 * n) if abs(lat) < 85.05 else (0 if lat > 0 else n - 1)
            assert (x, y) == (min(int((lon + 180) / 360 * n), n - 1), want_y)


def test_time_bins_ignore_session_zone(spark):
    frame = spark.createDataFrame([("2023-12-31 23:30:00",), ("2024-01-01 00:00:00",)], "t string").select(
        F.to_timestamp_ntz("t").alias("t")
    )
    columns = [
        timebins.week(F.col("t")).cast("string").alias("w"),
        timebins.month_label(F.col("t")).cast("string").alias("m"),
        timebins.epoch_seconds(timebins.day(F.col("t"))).alias("s"),
    ]
    expected = [("2023-12-25", "2023-12-15 00:00:00", 1703980800), ("2024-01-01", "2024-01-15 00:00:00", 1704067200)]
    for zone in ("UTC", "America/Los_Angeles", "Asia/Tokyo"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert [tuple(r) for r in frame.select(*columns).orderBy("s").collect()] == expected
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_wkb_points_round_trip(spark):
    frame = spark.createDataFrame([(1.5, -2.25), (None, 1.0), (180.0, 90.0)], "lon double, lat double")
    back = frame.select(wkb.point_wkb("lon", "lat").alias("g")).select(wkb.point_xy("g").alias("p")).select("p.*")
    assert [tuple(r) for r in back.collect()] == [(1.5, -2.25), (None, None), (180.0, 90.0)]


def test_wkb_byte_orders_and_dimensions():
    square = [(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]
    plain = struct.pack("<BIII", 1, 3, 1, 5) + b"".join(struct.pack("<2d", *p) for p in square)
    big = struct.pack(">BIII", 0, 3, 1, 5) + b"".join(struct.pack(">2d", *p) for p in square)
    with_z = struct.pack("<BIII", 1, 1003, 1, 5) + b"".join(struct.pack("<3d", *p, 9) for p in square)
    extended = struct.pack("<BIIII", 1, 3 | wkb.FLAG_SRID, 4326, 1, 5) + plain[13:]
    multi = struct.pack("<BII", 1, 6, 2) + plain + big
    expected = wkb.edges_of_polygon(plain)
    assert expected.shape == (4, 4)
    for other in (big, with_z, extended):
        assert np.array_equal(wkb.edges_of_polygon(other), expected)
    assert wkb.edges_of_polygon(multi).shape == (8, 4)
    with pytest.raises(ValueError):
        wkb.edges_of_polygon(struct.pack("<BI2d", 1, 2, 0, 0))
