"""Point-in-polygon left join over a grid index.

A polygon is indexed per grid cell: the cell keeps only the edges that run through
it and whether its reference point is inside. A point is inside when the straight
line to its cell's reference point crosses those edges an even number of times
and the reference is inside, or an odd number and it is outside. Cells no edge
runs through keep an empty edge list. Index size therefore follows the boundary
outlines, never the number of points, and the join is one equi-join on the cell.

Where a shape has more than ``EDGE_BOUND`` edges in a cell, the cell is cut into four, again and again,
for all shapes alike; so a point still lies in exactly one cell, whose level is part of the key.
Edges that meet in one point cannot be parted, which ``MAX_LEVEL`` allows for.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from editpulse.functions.wkb import explode_edges
from editpulse.operators.sizing import BROADCAST_BYTES, broadcast_if_small
from editpulse.sources.working import working_table

CELL_DEGREES = 0.5
# Most edges of a shape in one cell, and how often a cell is cut at most.
EDGE_BOUND, MAX_LEVEL = 64, 30
# Where in a cell its reference point sits; off the centre because outlines with
# round coordinates like to pass through cell centres.
REF_X, REF_Y = 0.4813, 0.5271

# orientation of point (px, py) against the edge e: positive on its left side
_SIDE = "((e.x2 - e.x1) * ({y} - e.y1) - (e.y2 - e.y1) * ({x} - e.x1))"
_POINT_SIDE = _SIDE.format(x="{lon}", y="{lat}")
# orientation of an edge end against the line from the point to the reference
_END_SIDE = "((_rx - {lon}) * (e.y{n} - {lat}) - (_ry - {lat}) * (e.x{n} - {lon}) > 0)"


def identified_shapes(boundaries: DataFrame) -> DataFrame:
    """Boundaries with a key per row; fully equal rows get different keys and stay separate."""
    attributes = [c for c in boundaries.columns if c != "geometry"]
    content = F.md5(F.concat_ws("|", F.to_json(F.struct(*attributes)), F.md5("geometry")))
    keyed = boundaries.withColumn("_content", content)
    copy = F.row_number().over(Window.partitionBy("_content").orderBy("_content"))
    return keyed.withColumn("shape", F.concat_ws("-", "_content", copy.cast("string"))).drop("_content")


@dataclass(frozen=True)
class Index:
    """Cells (``shape, a3, level, gx, gy, edges, inside``), the cut cells of every level but the last, and the cell size."""

    cells: DataFrame
    cuts: tuple[DataFrame, ...]
    cell: float


def _size(cell: float, level: int | Column) -> Column:
    return F.lit(cell) * F.pow(F.lit(2.0), -F.lit(level) if isinstance(level, int) else -level)


def _side_of(x: Column, y: Column) -> Column:
    """Orientation of (x, y) against an edge in columns ``x1, y1, x2, y2``: positive on its left side."""
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    return dx * (y - F.col("y1")) - dy * (x - F.col("x1"))


def _touching(rows: DataFrame, size: Column) -> DataFrame:
    """Rows whose edge runs through their cell: the cell's corners are not all on one side of it."""
    corners = [_side_of((F.col("gx") + dx) * size, (F.col("gy") + dy) * size) for dx in (0, 1) for dy in (0, 1)]
    slack = F.lit(1e-9) * (F.abs(F.col("x2") - F.col("x1")) + F.abs(F.col("y2") - F.col("y1")))
    low, high = [F.lit(d) * size for d in (0, 1)]
    near = [
        (F.least(a, b) <= F.col(g) * size + high + slack) & (F.greatest(a, b) >= F.col(g) * size + low - slack)
        for a, b, g in ((F.col("x1"), F.col("x2"), "gx"), (F.col("y1"), F.col("y2"), "gy"))
    ]
    return rows.where(near[0] & near[1] & (F.least(*corners) <= slack) & (F.greatest(*corners) >= -slack))


def cell_rows(shapes: DataFrame, cell: float = CELL_DEGREES) -> DataFrame:
    """``shape, a3, gx, gy, x1, y1, x2, y2, inside``: a row per cell and edge, and one per cell inside.

    Built with explodes, a group-by and a window only; the one Python step decodes WKB.
    """
    edges = shapes.select("shape", "a3", "geometry").mapInPandas(
        explode_edges, "shape string, a3 string, x1 double, y1 double, x2 double, y2 double"
    )
    size = F.lit(cell)

    def span(a: str, b: str) -> Column:
        return F.sequence(
            F.floor(F.least(a, b) / size).cast("long"), F.floor(F.greatest(a, b) / size).cast("long")
        )

    rows = edges.withColumn("gy", F.explode(span("y1", "y2")))
    touched = _touching(rows.withColumn("gx", F.explode(span("x1", "x2"))), size)

    # Inside flags: crossings of the horizontal line through a row's reference points. A crossing lies
    # right of those of columns up to `k`. A line's crossings in order of `k` are passed in turn, into the
    # shape and out of it again.
    ry = (F.col("gy") + F.lit(REF_Y)) * size
    crossing = rows.where((F.col("y1") > ry) != (F.col("y2") > ry)).withColumn(
        "x", F.col("x1") + (ry - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
    )
    rx = lambda column: (column + F.lit(REF_X)) * size
    guess = F.ceil(F.col("x") / size - F.lit(REF_X)).cast("long") - 1
    exact = F.when(rx(guess + 1) < F.col("x"), guess + 1).when(rx(guess) < F.col("x"), guess).otherwise(guess - 1)
    in_line = Window.partitionBy("shape", "gy").orderBy("k")
    inside = (
        crossing.withColumn("k", exact)
        .withColumns({"n": F.row_number().over(in_line), "out": F.lead("k").over(in_line)})
        .where((F.col("n") % 2 == 1) & (F.col("out") > F.col("k")))
        .withColumn("gx", F.explode(F.sequence(F.col("k") + 1, F.col("out"))))
    )
    return touched.select(*_CELL, *_EDGE, F.lit(0).alias("inside")).unionByName(
        inside.select(*_CELL, *[F.lit(None).cast("double").alias(c) for c in _EDGE], F.lit(1).alias("inside"))
    )


_CELL, _EDGE = ("shape", "a3", "gx", "gy"), ("x1", "y1", "x2", "y2")


def _cut(rows: DataFrame, heavy: DataFrame, cell: float, level: int) -> DataFrame:
    """Rows of the quarters of the ``heavy`` cells of a level.

    A quarter's reference point is inside if its parent's is and the line between the two crosses
    an even number of edges, or the parent's is not and the number is odd.
    """
    parent = rows.join(heavy, ["gx", "gy"], "left_semi")
    quarters = F.explode(F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx in (0, 1) for dy in (0, 1)]))
    size, half = _size(cell, level), _size(cell, level + 1)
    parts = parent.withColumn("q", quarters).select(
        "shape", "a3", (F.col("gx") * 2 + F.col("q.dx")).alias("gx"), (F.col("gy") * 2 + F.col("q.dy")).alias("gy"), *_EDGE,
        "inside", ((F.col("gx") + F.lit(REF_X)) * size).alias("px"), ((F.col("gy") + F.lit(REF_Y)) * size).alias("py"),
    )
    rx, ry = (F.col("gx") + F.lit(REF_X)) * half, (F.col("gy") + F.lit(REF_Y)) * half
    px, py = F.col("px"), F.col("py")

    def end(n: int) -> Column:
        return ((rx - px) * (F.col(f"y{n}") - py) - (ry - py) * (F.col(f"x{n}") - px)) > 0

    crosses = ((_side_of(px, py) > 0) != (_side_of(rx, ry) > 0)) & (end(1) != end(2))
    flags = parts.groupBy(*_CELL).agg((F.count_if(crosses) + F.max("inside")).alias("n"))
    inside = flags.where("n % 2 = 1").select(
        *_CELL, *[F.lit(None).cast("double").alias(c) for c in _EDGE], F.lit(1).alias("inside")
    )
    edges = _touching(parts.where(F.col("x1").isNotNull()), half)
    return edges.select(*_CELL, *_EDGE, F.lit(0).alias("inside")).unionByName(inside)


def _listed(rows: DataFrame, cell: float, level: int) -> DataFrame:
    """One row per shape and cell with the list of its edges."""
    size = _size(cell, level)
    ref_left = _side_of((F.col("gx") + F.lit(REF_X)) * size, (F.col("gy") + F.lit(REF_Y)) * size) > 0
    edge = F.when(F.col("x1").isNotNull(), F.struct(*_EDGE, ref_left.alias("ref_left")))
    return rows.groupBy(*_CELL).agg(F.collect_list(edge).alias("edges"), F.max("inside").alias("inside")).select(
        *_CELL, F.lit(level).alias("level"), "edges", "inside"
    )


def prepared_index(
    boundaries: DataFrame,
    cell: float = CELL_DEGREES,
    broadcast_limit: int = BROADCAST_BYTES,
    edge_bound: int = EDGE_BOUND,
) -> Index:
    """The index, written once and hinted for broadcast if its size allows.

    One job writes the cells' edges and one counts them; each level of cut cells takes two more.
    """
    rows = working_table(cell_rows(identified_shapes(boundaries), cell), "cells")
    levels, cuts, total = [], [], 0
    for level in range(MAX_LEVEL + 1):
        counts = rows.groupBy("shape", "gx", "gy").agg(F.count("x1").alias("n"))
        most, n_cells, n_edges = counts.agg(F.coalesce(F.max("n"), F.lit(0)), F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        total += n_cells * 120 + n_edges * 40
        if most <= edge_bound or level == MAX_LEVEL:
            levels.append(_listed(rows, cell, level))
            break
        heavy = working_table(counts.where(F.col("n") > edge_bound).select("gx", "gy").distinct(), "heavy")
        levels.append(_listed(rows.join(heavy, ["gx", "gy"], "left_anti"), cell, level))
        cuts.append(broadcast_if_small(heavy, broadcast_limit))
        rows = working_table(_cut(rows, heavy, cell, level), "cells")
    cells = reduce(DataFrame.unionByName, levels)
    return Index(F.broadcast(cells) if total <= broadcast_limit else cells, tuple(cuts), cell)


def contains_condition(lon: str, lat: str) -> str:
    """SQL condition: the cell's edges put the point strictly inside the shape.

    A point on an edge is on the border, hence outside, whatever the crossings say.
    """
    side = _POINT_SIDE.format(lon=lon, lat=lat)
    crosses = (
        f"(({side} > 0) != e.ref_left) AND "
        f"({_END_SIDE.format(lon=lon, lat=lat, n=1)} != {_END_SIDE.format(lon=lon, lat=lat, n=2)})"
    )
    on_edge = (
        f"{side} = 0 AND {lon} BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2) "
        f"AND {lat} BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2)"
    )
    return (
        f"aggregate(_edges, 0, (n, e) -> CASE WHEN n < 0 OR ({on_edge}) THEN -1 "
        f"WHEN {crosses} THEN n + 1 ELSE n END, n -> n >= 0 AND (n + _inside) % 2 = 1)"
    )


def locate(
    points: DataFrame,
    index: Index,
    cell: float | None = None,
    lon: str = "lon",
    lat: str = "lat",
    carry: tuple[str, ...] = ("a3",),
) -> DataFrame:
    """Left join of points with the shapes that contain them.

    Points in no shape keep NULLs, points in several get a row each. With a
    broadcast index the points are not shuffled at all; otherwise both sides are
    exchanged on the cell and AQE splits crowded cells. Only where cells are cut, a join per
    level tells which points lie in cut cells and so are one level down.
    """
    if cell is not None and cell != index.cell:
        raise ValueError(f"the index has cells of {index.cell}, not {cell}")

    def place(column: str, level: int | Column) -> Column:
        return F.floor(F.col(column) / _size(index.cell, level)).cast("long")

    keyed = points.withColumn("_level", F.lit(0))
    for level, cut in enumerate(index.cuts):
        there = cut.select(F.col("gx").alias("_gx"), F.col("gy").alias("_gy"), F.lit(level).alias("_at"))
        inside = (F.col("_level") == F.col("_at")) & (place(lon, level) == F.col("_gx")) & (place(lat, level) == F.col("_gy"))
        keyed = keyed.join(there, inside, "left").withColumn(
            "_level", F.when(F.col("_at").isNotNull(), F.lit(level + 1)).otherwise(F.col("_level"))
        ).drop("_gx", "_gy", "_at")
    keyed = keyed.withColumns({"_px": place(lon, F.col("_level")), "_py": place(lat, F.col("_level"))})
    size = _size(index.cell, F.col("level"))
    cells = index.cells.select(
        F.col("level").alias("_depth"),
        F.col("gx").alias("_gx"),
        F.col("gy").alias("_gy"),
        F.col("edges").alias("_edges"),
        F.col("inside").alias("_inside"),
        ((F.col("gx") + F.lit(REF_X)) * size).alias("_rx"),
        ((F.col("gy") + F.lit(REF_Y)) * size).alias("_ry"),
        *carry,
    )
    match = F.expr(f"_level = _depth AND _px = _gx AND _py = _gy AND {contains_condition(lon, lat)}")
    return keyed.join(cells, match, "left").drop(
        "_level", "_depth", "_px", "_py", "_gx", "_gy", "_edges", "_inside", "_rx", "_ry"
    )
