"""WKB at the edges of the system: the only Python functions in the library.

Everything between reading and writing works on plain ``lon``/``lat`` columns
and edge rows, so these run once per member, boundary or output row.
"""

from __future__ import annotations

import struct
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

# These functions travel to the executors by value, so nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_XY = T.StructType([T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType())])

# OGC geometry type codes and extended-WKB flag bits.
POINT, POLYGON, MULTIPOLYGON, COLLECTION = 1, 3, 6, 7
FLAG_Z, FLAG_M, FLAG_SRID = 0x80000000, 0x40000000, 0x20000000


def _header(buf: bytes, at: int) -> tuple[str, int, int, int]:
    """(byte order, base type, coordinate size, next offset) of a geometry."""
    order = "<" if buf[at] == 1 else ">"
    (code,) = struct.unpack_from(order + "I", buf, at + 1)
    at += 5
    size = 2 + bool(code & FLAG_Z) + bool(code & FLAG_M)
    if code & FLAG_SRID:
        at += 4
    code &= 0x0FFFFFFF
    size += {0: 0, 1: 1, 2: 1, 3: 2}[code // 1000]
    return order, code % 1000, size, at


def _rings(buf: bytes, at: int, out: list[np.ndarray]) -> int:
    """Append every ring from offset ``at`` to ``out``; return the next offset."""
    order, kind, size, at = _header(buf, at)
    if kind not in (POLYGON, MULTIPOLYGON, COLLECTION):
        raise ValueError(f"geometry type {kind} has no area")
    (count,) = struct.unpack_from(order + "I", buf, at)
    at += 4
    for _ in range(count):
        if kind in (MULTIPOLYGON, COLLECTION):
            at = _rings(buf, at, out)
        else:
            (points,) = struct.unpack_from(order + "I", buf, at)
            flat = np.frombuffer(buf, order + "f8", points * size, at + 4)
            out.append(flat.reshape(points, size)[:, :2].astype("f8"))
            at += 4 + 8 * size * points
    return at


def edges_of_polygon(buf: bytes) -> np.ndarray:
    """All edges of all rings as rows ``x1, y1, x2, y2``; holes need no marking."""
    rings: list[np.ndarray] = []
    _rings(bytes(buf), 0, rings)
    pairs = [np.hstack([ring[:-1], ring[1:]]) for ring in rings if len(ring) > 1]
    edges = np.vstack(pairs) if pairs else np.empty((0, 4))
    return edges[(edges[:, 0] != edges[:, 2]) | (edges[:, 1] != edges[:, 3])]


def explode_edges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """mapInPandas body: (shape, a3, geometry) rows -> one row per edge."""
    for batch in batches:
        for shape, a3, geometry in zip(batch["shape"], batch["a3"], batch["geometry"]):
            if geometry is not None:
                frame = pd.DataFrame(edges_of_polygon(geometry), columns=["x1", "y1", "x2", "y2"])
                frame.insert(0, "shape", shape)
                frame.insert(1, "a3", a3)
                yield frame


@F.pandas_udf(_XY)
def point_xy(geometry: pd.Series) -> pd.DataFrame:
    """Coordinates of WKB points; NULL for NULL and for POINT EMPTY."""

    def decode(buf: bytes | None) -> tuple[float | None, float | None]:
        if buf is None:
            return None, None
        order, kind, _, at = _header(buf, 0)
        if kind != POINT:
            raise ValueError(f"expected a point, got geometry type {kind}")
        x, y = struct.unpack_from(order + "2d", buf, at)
        return (None, None) if x != x or y != y else (x, y)

    rows = [decode(None if buf is None else bytes(buf)) for buf in geometry]
    return pd.DataFrame(rows, columns=["lon", "lat"], dtype="object").astype("Float64")


@F.pandas_udf(T.BinaryType())
def point_wkb(lon: pd.Series, lat: pd.Series) -> pd.Series:
    """Little-endian WKB point; NULL where a coordinate is NULL."""
    head = struct.pack("<BI", 1, POINT)
    body = np.column_stack([lon.to_numpy("f8", na_value=np.nan), lat.to_numpy("f8", na_value=np.nan)])
    gap = np.isnan(body).any(axis=1)
    body = body.astype("<f8")
    return pd.Series([None if empty else head + row.tobytes() for empty, row in zip(gap, body)])


@F.pandas_udf(T.BinaryType())
def polygon_wkb(parts: pd.Series) -> pd.Series:
    """WKB multipolygon from parts > rings > [x, y] arrays."""

    def encode(value) -> bytes | None:
        if value is None:
            return None
        out = [struct.pack("<BII", 1, MULTIPOLYGON, len(value))]
        for rings in value:
            out.append(struct.pack("<BII", 1, POLYGON, len(rings)))
            for ring in rings:
                points = np.array([np.asarray(p, dtype="<f8") for p in ring])
                out.append(struct.pack("<I", len(points)) + points.astype("<f8").tobytes())
        return b"".join(out)

    return pd.Series([encode(value) for value in parts])
