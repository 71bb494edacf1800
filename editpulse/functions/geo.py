"""Planar and great-circle column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.01


def great_circle_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance on a sphere in km (atan2 form); NULL for NULL or out-of-range input."""
    in_range = (
        lat1.between(-90, 90) & lat2.between(-90, 90)
        & lon1.between(-180, 180) & lon2.between(-180, 180)
    )
    a, b = F.radians(lat1), F.radians(lat2)
    d = F.radians(lon2) - F.radians(lon1)
    across = F.cos(b) * F.sin(d)
    along = F.cos(a) * F.sin(b) - F.sin(a) * F.cos(b) * F.cos(d)
    toward = F.sin(a) * F.sin(b) + F.cos(a) * F.cos(b) * F.cos(d)
    angle = F.atan2(F.sqrt(across * across + along * along), toward)
    return F.when(in_range, angle * F.lit(EARTH_RADIUS_KM))


def box_diameter_km(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """Corner-to-corner distance rounded to metres."""
    x1, y1, x2, y2 = (c.cast("double") for c in (xmin, ymin, xmax, ymax))
    return F.round(great_circle_km(y1, x1, y2, x2), 3)


def midpoint(low: Column, high: Column) -> Column:
    """Centre of one axis of a box; equal corners give the corner itself."""
    return (low.cast("double") + high.cast("double")) / 2


def envelope_ring(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """Closed five-point ring of a box as an array of [x, y]."""
    x1, y1, x2, y2 = (c.cast("double") for c in (xmin, ymin, xmax, ymax))
    return F.array(
        F.array(x1, y1), F.array(x1, y2), F.array(x2, y2), F.array(x2, y1), F.array(x1, y1)
    )


def _plain(value: Column) -> Column:
    # Fixed-point digits without trailing zeros: 12.50 -> 12.5, -3.0 -> -3.
    return F.regexp_replace(value.cast("decimal(18,13)").cast("string"), r"\.?0+$", "")


def point_text(lon: Column, lat: Column) -> Column:
    """``POINT (x y)``; NULL when a coordinate is NULL."""
    return F.when(
        lon.isNotNull() & lat.isNotNull(),
        F.concat(F.lit("POINT ("), _plain(lon), F.lit(" "), _plain(lat), F.lit(")")),
    )
