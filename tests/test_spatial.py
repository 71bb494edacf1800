"""The grid join against brute force, on both of its physical paths."""

from __future__ import annotations

import numpy as np
import pytest
from fixtures import SHAPES, boundaries
from pyspark.sql import functions as F

from editpulse import schemas
from editpulse.functions.wkb import polygon_wkb
from editpulse.operators.spatial import identified_shapes, locate, prepared_index


def strictly_inside(rings, x, y):
    """Plain even-odd test with borders excluded."""
    inside = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            side = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
            if side == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                return False
            if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                inside = not inside
    return inside


def expected_pairs(shapes, points):
    out = []
    for key, x, y in points:
        hits = [
            a3 for a3, parts in shapes
            if x is not None and y is not None and strictly_inside([r for p in parts for r in p], x, y)
        ]
        out += [(key, a3) for a3 in hits] or [(key, None)]
    return sorted(out, key=repr)


def shape_frame(spark, shapes):
    rows = [(a3, parts) for a3, parts in shapes]
    return spark.createDataFrame(rows, "a3 string, parts array<array<array<array<double>>>>").select(
        "a3", F.col("a3").alias("country"), polygon_wkb("parts").alias("geometry")
    )


def joined(spark, frame, points, cell, limit=1 << 27, bound=64):
    index = prepared_index(frame, cell, limit, bound)
    located = locate(spark.createDataFrame(points, "id long, lon double, lat double"), index, cell)
    return located, sorted([(r["id"], r["a3"]) for r in located.select("id", "a3").collect()], key=repr)


def star(rng, cx, cy, n, scale):
    """A random, strongly concave ring around a centre."""
    angles = np.sort(rng.uniform(0, 2 * np.pi, n))
    radii = rng.uniform(0.15, 1, n) * scale
    ring = [[float(cx + r * np.cos(a)), float(cy + r * np.sin(a))] for a, r in zip(angles, radii)]
    return [*ring, ring[0]]


@pytest.mark.parametrize(("cell", "bound"), [(0.5, 64), (3.0, 64), (17.0, 64), (40.0, 5)])
def test_random_shapes(spark, cell, bound):
    rng = np.random.default_rng(7)
    shapes = []
    for n in range(20):
        cx, cy = rng.uniform(-50, 50, 2)
        shapes.append((f"S{n}", [[star(rng, cx, cy, 25, 15)], [star(rng, cx + 30, cy, 12, 10), star(rng, cx + 30, cy, 8, 1.4)]]))
    points = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(-70, 70, (3000, 2)))]
    _, got = joined(spark, shape_frame(spark, shapes), points, cell, bound=bound)
    assert got == expected_pairs(shapes, points)
    assert sum(a3 is not None for _, a3 in got) > 500


def test_fixture_shapes_on_lattice_points(spark):
    """Half-degree lattice: many points lie exactly on borders, corners and cell lines."""
    points = [(i * 1000 + j, 4 + i / 2, 4 + j / 2) for i in range(75) for j in range(34)]
    points += [(-1, None, 1.0), (-2, 1.0, None), (-3, -170.0, -80.0), (-4, 61.0, 9.0)]
    shapes = list(SHAPES.items())
    want = expected_pairs(shapes, points)
    assert len(want) > len(points)  # some points are in two shapes
    for cell in (0.5, 2.5):
        _, got = joined(spark, boundaries(spark), points, cell)
        assert got == want


def test_shuffled_path_agrees_and_neither_is_nested_loop(spark):
    rng = np.random.default_rng(3)
    points = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(0, 70, (500, 2)))]
    small, a = joined(spark, boundaries(spark), points, 1.0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        large, b = joined(spark, boundaries(spark), points, 1.0, limit=0)
        big_plan = large._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert a == b == expected_pairs(list(SHAPES.items()), points)
    small_plan = small._jdf.queryExecution().executedPlan().toString()
    # the index gathers its own lists by shape and cell; points stay where they are
    assert "BroadcastHashJoin" in small_plan and small_plan.count("Exchange hashpartitioning") == 1
    assert "Exchange hashpartitioning(shape" in small_plan
    assert "SortMergeJoin" in big_plan or "ShuffledHashJoin" in big_plan
    for plan in (small_plan, big_plan):
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_lattice_points_in_cut_cells(spark):
    """Points on borders, corners and lines of cells of several levels."""
    points = [(i * 1000 + j, 4 + i / 4, 4 + j / 4) for i in range(0, 150, 2) for j in range(0, 68, 2)]
    _, got = joined(spark, boundaries(spark), points, 32.0, bound=3)
    assert got == expected_pairs(list(SHAPES.items()), points)


@pytest.mark.parametrize("limit", [1 << 27, 0])
def test_ring_of_many_edges_in_one_cell(spark, limit):
    n = 200_000
    angles = np.linspace(0, 2 * np.pi, n, endpoint=False)
    radii = 0.2 + 0.02 * np.sin(angles * 40)
    ring = np.stack([10.25 + radii * np.cos(angles), 20.25 + radii * np.sin(angles)], axis=1)
    closed = [[float(x), float(y)] for x, y in ring]
    shapes = [("R", [[[*closed, closed[0]]]]), ("B", [[[[10.1, 20.1], [10.4, 20.1], [10.4, 20.4], [10.1, 20.4], [10.1, 20.1]]]])]
    index = prepared_index(shape_frame(spark, shapes), 0.5, limit)
    assert index.cuts and index.cells.agg(F.max(F.size("edges"))).first()[0] <= 64
    rng = np.random.default_rng(5)
    points = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform((10, 20), (10.5, 20.5), (4000, 2)))]
    points += [(9000 + i, float(10.25 + (0.2 + 0.02 * np.sin(40 * a) + d) * np.cos(a)), float(20.25 + (0.2 + 0.02 * np.sin(40 * a) + d) * np.sin(a)))
               for i, (a, d) in enumerate(zip(rng.uniform(0, 6.28, 500), rng.choice([-1e-6, 1e-6], 500)))]
    frame = spark.createDataFrame(points, "id long, lon double, lat double")
    got = {(r["id"], r["a3"]) for r in locate(frame, index).collect()}
    x1, y1, x2, y2 = ring[:, 0], ring[:, 1], np.roll(ring[:, 0], -1), np.roll(ring[:, 1], -1)
    for key, x, y in points:
        spans = (y1 > y) != (y2 > y)
        in_ring = bool((x < x1[spans] + (y - y1[spans]) * (x2[spans] - x1[spans]) / (y2[spans] - y1[spans])).sum() % 2)
        in_box = 10.1 < x < 10.4 and 20.1 < y < 20.4
        want = {(key, a3) for a3, held in (("R", in_ring), ("B", in_box)) if held} or {(key, None)}
        assert {p for p in ((key, "R"), (key, "B"), (key, None)) if p in got} == want


def test_edges_that_meet_in_one_point_end_the_cutting(spark):
    fan = [[0.0, 0.0]]
    for i in range(12):
        a, b = i * 0.5, i * 0.5 + 0.2
        fan += [[float(np.cos(a)), float(np.sin(a))], [float(np.cos(b)), float(np.sin(b))], [0.0, 0.0]]
    shapes = [("F", [[fan]])]
    points = [(i, float(x), float(y)) for i, (x, y) in enumerate(np.random.default_rng(1).uniform(-1, 1, (300, 2)))]
    _, got = joined(spark, shape_frame(spark, shapes), points, 2.0, bound=30)
    assert got == expected_pairs(shapes, points)


def test_equal_boundaries_stay_separate(spark):
    frame = boundaries(spark).where("a3 = 'AAA'")
    doubled = frame.unionByName(frame)
    assert identified_shapes(doubled).select("shape").distinct().count() == 2
    _, got = joined(spark, doubled, [(1, 7.0, 7.0), (2, 15.0, 15.0)], 1.0)
    assert got == [(1, "AAA"), (1, "AAA"), (2, None)]


def test_schema_of_fixture_boundaries(spark):
    assert boundaries(spark).schema.simpleString() == schemas.BOUNDARIES.simpleString()
