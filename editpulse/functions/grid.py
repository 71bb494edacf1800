"""Cell ids of points and their parents (G4, G5), slippy tiles.

Cells form a square grid in longitude/latitude: level ``n`` cuts each axis into
``2**n`` parts of 360 degrees (latitudes fill half of them) and a cell is named ``n:x:y``. A parent is a plain right shift.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Grid level standing for each cell resolution in use.
LEVEL_OF_RESOLUTION = {8: 16, 6: 13, 4: 10}


def _bin(share: Column, parts: int) -> Column:
    """Index of a 0..1 share among equal parts; outside values go to the end parts."""
    index = F.floor(share * F.lit(float(parts)))
    return F.when(index < 0, F.lit(0)).when(index >= parts, F.lit(parts - 1)).otherwise(index)


def _cell_id(level: int, x: Column, y: Column) -> Column:
    return F.concat(F.lit(f"{level}:"), x.cast("string"), F.lit(":"), y.cast("string"))


def cell_of_point(lon: Column, lat: Column, resolution: int = 8) -> Column:
    """Cell id of a point; NULL for a NULL point."""
    level = LEVEL_OF_RESOLUTION[resolution]
    x = _bin((lon + F.lit(180.0)) / F.lit(360.0), 1 << level)
    y = _bin((lat + F.lit(90.0)) / F.lit(360.0), 1 << level)
    return _cell_id(level, x, y)


def _grid_parent(cell: Column, resolution: int) -> Column:
    level = LEVEL_OF_RESOLUTION[resolution]
    part = F.split(cell, ":")
    shift = part[0].cast("int") - F.lit(level)
    x = F.call_function("shiftright", part[1].cast("long"), shift)
    y = F.call_function("shiftright", part[2].cast("long"), shift)
    return _cell_id(level, x, y)


def h3_parent(cell: Column, resolution: int) -> Column:
    """Parent of a hexadecimal H3 id: set the resolution bits, blank finer digits.

    The resolution is a 4-bit field at bit 52; digit ``r`` is a 3-bit field at
    bit ``3 * (15 - r)`` and reads 7 where unused.
    """
    bits = F.conv(cell, 16, 10).cast("long")
    cleared = bits.bitwiseAND(F.lit(~(0xF << 52)))
    unused = (1 << (3 * (15 - resolution))) - 1
    parent = cleared.bitwiseOR(F.lit((resolution << 52) | unused))
    return F.lower(F.hex(parent))


def parent_cell(cell: Column, resolution: int) -> Column:
    """Parent at a coarser resolution, for grid ids and for real H3 ids alike."""
    return F.when(F.contains(cell, F.lit(":")), _grid_parent(cell, resolution)).otherwise(
        h3_parent(cell, resolution)
    )


def tile_x(lon: Column, zoom: int) -> Column:
    return _bin((lon + F.lit(180.0)) / F.lit(360.0), 1 << zoom).cast("int")


def tile_y(lat: Column, zoom: int) -> Column:
    """Web-Mercator row, counted from the north; polar latitudes go to the edge rows."""
    # tan() has a pole at 90 degrees, so latitudes stop just beyond the projection's limit.
    phi = F.radians(F.when(lat > 85.06, 85.06).when(lat < -85.06, -85.06).otherwise(lat))
    mercator = F.log(F.tan(phi) + F.lit(1.0) / F.cos(phi)) / F.lit(math.pi)
    return _bin((F.lit(1.0) - mercator) / F.lit(2.0), 1 << zoom).cast("int")
