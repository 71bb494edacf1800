"""Both sides of every size decision, hot keys, and totals that must agree."""

from __future__ import annotations

import datetime as dt

import fixtures
import pytest
from pyspark.sql import functions as F

from editpulse.checks import queries as Q
from editpulse.operators import activity as A
from editpulse.operators import cells as C
from editpulse.operators import members as M
from editpulse.operators.changesets import member_semi_join
from editpulse.operators.documents import chapters_document, monthly_document
from editpulse.operators.features import tile_features
from editpulse.operators.rollup import id_bitmap, in_bitmap, rollup_for
from editpulse.operators.sizing import broadcast_if_small, measured_bytes
from editpulse.sources import standin
from editpulse.sources.working import working_table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def activity(spark):
    return working_table(Q._events(spark, SF), "activity")


@pytest.fixture(scope="module")
def daily(activity):
    return working_table(C.daily_cells(activity), "daily")


@pytest.fixture
def no_auto_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in keys:
        spark.conf.set(key, "-1")
    yield
    for key in keys:
        spark.conf.unset(key)


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def total(frame, expression):
    return frame.agg(F.sum(F.expr(expression))).first()[0]


def test_measured_bytes_follow_the_data(spark):
    small = spark.range(10).withColumn("s", F.lit("x" * 100))
    assert 10 * 100 < measured_bytes(small) < 10 * 200
    assert measured_bytes(small.where("id < 0")) == 0
    plan = broadcast_if_small(small, 500)._jdf.queryExecution().analyzed().toString()
    assert "broadcast" not in plan.lower()


def test_history_restriction_agrees_on_both_paths(spark):
    kept = fixtures.changesets(spark).where("id < 9").select("id")
    few = rollup_for(fixtures.history(spark), kept, 8)
    many = rollup_for(fixtures.history(spark), kept, 1 << 40, bitmap_limit=0)
    assert same(few, many)
    assert "BroadcastExchange" not in many._jdf.queryExecution().executedPlan().toString()


def test_shuffled_joins_agree_with_broadcast_ones(spark, no_auto_broadcast):
    args = (fixtures.changesets(spark), fixtures.members(spark))
    a, b = member_semi_join(*args).drop("tags"), member_semi_join(*args, broadcast_limit=-1).drop("tags")
    assert same(a, b)
    assert "SortMergeJoin" in b._jdf.queryExecution().executedPlan().toString()
    people = fixtures.members(spark).where(f"ds = '{fixtures.NEW_DS}'").withColumn("chapter_id", F.col("team_id"))
    rows = spark.createDataFrame([(1, 100, "AAA"), (2, 102, None), (3, 999, "BBB")], "id long, uid long, a3 string")
    a = M.activity_table(rows, people, fixtures.boundaries(spark))
    b = M.activity_table(rows, people, fixtures.boundaries(spark), broadcast_limit=-1)
    assert same(a, b) and a.count() == 3


def test_hot_member_is_split(spark, no_auto_broadcast):
    """One member holds a third of the rows, one country half; AQE cuts both join partitions up."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "16",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        rows = spark.range(0, 60_000, 1, 8).select(
            "id", F.when(F.col("id") % 3 == 0, 100).otherwise(F.col("id") + 1000).alias("uid"),
            F.when(F.col("id") % 2 == 0, "AAA").otherwise(F.concat(F.lit("x"), "id")).alias("a3"),
            F.sha2(F.col("id").cast("string"), 256).alias("pad"),
        )
        people = spark.range(100, 70_000).select(
            F.col("id").alias("uid"), F.lit(1).cast("long").alias("team_id"), F.lit("c").alias("chapter"),
            F.lit("u").alias("university"), F.lit("x").alias("city"), F.lit("k").alias("country"),
            F.lit(None).cast("binary").alias("geometry"), F.lit("d").alias("ds"),
            F.lit(1).cast("long").alias("chapter_id"),
        )
        joined = M.activity_table(rows, people, fixtures.boundaries(spark), broadcast_limit=-1)
        counted = joined.groupBy(F.spark_partition_id()).count()
        assert sum(r["count"] for r in counted.collect()) == 60_000
        plan = counted._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin(skew=true)") == 2
    finally:
        for key in settings:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_hot_changeset_combines_before_the_shuffle(spark):
    rows = spark.range(0, 30_000, 1, 8).selectExpr(
        "if(id % 3 > 0, 7, id) AS changeset", "'node' AS type", "map('building', 'y') AS tags",
        "1L AS version", "true AS visible",
    )
    kept = spark.range(30_000).where("id % 2 = 1")
    rollup = rollup_for(rows, kept, 1 << 40, bitmap_limit=0)
    assert rollup.where("changeset = 7").first()["new_buildings"] == 20_000
    plan = rollup._jdf.queryExecution().executedPlan().toString()
    counted = plan[plan.index("partial_count"):]
    assert "Exchange hashpartitioning(changeset" not in counted[: counted.index("Range")]
    assert plan.count("Exchange hashpartitioning(changeset") == 2  # partial counts, and the kept ids


def test_bitmap_of_kept_ids_filters_before_the_exchange(spark):
    history = spark.range(-1000, 200_000, 1, 8).selectExpr(
        "id * 37 AS changeset", "'node' AS type", "map('building', 'y') AS tags", "1L AS version", "true AS visible",
    )
    kept = spark.sql("SELECT id * 37 AS id FROM range(-500, 190000) WHERE id % 100 < 3 UNION ALL SELECT 5 UNION ALL SELECT 0")
    ways = [rollup_for(history, kept, 1 << 40, **limits) for limits in (
        {"bitmap_limit": 1 << 40}, {"bitmap_limit": 0}, {"broadcast_limit": 1 << 60})]
    found = [sorted(tuple(r) for r in way.collect()) for way in ways]
    assert found[0] == found[1] == found[2] and len(found[0]) == kept.intersect(history.selectExpr("changeset AS id")).count()
    plan = ways[0]._jdf.queryExecution().executedPlan().toString()
    counted = plan[plan.index("partial_count"):]
    counted = counted[: counted.index("Range")]
    assert "BroadcastHashJoin" in counted and "Exchange hashpartitioning" not in counted
    # the rows that are exchanged are those of kept ids
    kept_rows = in_bitmap(history, id_bitmap(kept), "changeset").count()
    assert kept_rows == len(found[0]) < 0.04 * history.count()


def test_hot_cell_daily_aggregate(spark, activity):
    """One place and day holding most rows: sums, centroid and envelope stay whole."""
    first = activity.where("lon IS NOT NULL").limit(1)
    copies = first.crossJoin(spark.range(5000).withColumnRenamed("id", "n"))
    moved = copies.withColumn("lon", F.col("lon") + (F.col("n") % 2) / 65536.0).drop("n")
    hot = C.daily_cells(moved).collect()
    base = first.first()
    assert sum(r["n_boxes"] for r in hot) == 5000
    assert sum(r["features"]["new"] for r in hot) == 5000 * base["features"]["new"]
    assert sum(r["n_points"] for r in hot) == 2
    plan = C.daily_cells(moved)._jdf.queryExecution().executedPlan().toString()
    assert "collect" not in plan and "Window" not in plan


def test_every_box_is_found_by_its_key(activity, daily):
    boxes = C.box_rows(activity, "salt")
    assert boxes.count() == activity.where("lon IS NOT NULL AND lat IS NOT NULL").count()
    counted = boxes.groupBy("row_key").count()
    keyed = C.with_row_key(daily, "salt")
    assert keyed.select("row_key").distinct().count() == daily.count()
    assert keyed.join(counted, "row_key").where("n_boxes = count").count() == daily.count()
    assert C.with_row_key(daily, "other").join(boxes, "row_key").count() == 0
    plan = boxes._jdf.queryExecution().executedPlan().toString()
    assert "collect" not in plan


def test_crowded_cell_keeps_its_boxes_apart(spark, activity):
    """50,000 boxes of one member and a few of another, in the same cell and on the same day."""
    first = activity.where("lon IS NOT NULL").limit(1)
    copies = first.crossJoin(spark.range(50_003).withColumnRenamed("id", "n"))
    crowded = copies.withColumn("uid", F.when(F.col("n") < 50_000, F.lit(1)).otherwise(F.lit(2)).cast("long")).drop("n")
    keyed = C.with_row_key(C.daily_cells(crowded), "salt")
    got = keyed.join(C.box_rows(crowded, "salt"), "row_key").groupBy("uid").count().collect()
    assert {r["uid"]: r["count"] for r in got} == {1: 50_000, 2: 3}


def test_totals_agree(activity, daily):
    feats = total(activity.where("lon IS NOT NULL"), "features.new + features.edited")
    assert total(daily, "features.new + features.edited") == feats
    assert total(A.weekly_chapters(daily), "all_feats") == feats
    assert total(C.daily_points(daily), "all_feats") == feats
    buildings = total(daily, "buildings.new")
    assert total(A.monthly_activity(daily, dt.date(2024, 2, 10)), "new_buildings") == buildings
    placed = total(activity.where("country IS NOT NULL"), "features.new + features.edited")
    for resolution in (6, 4):
        assert total(C.coarse_cells(activity, resolution), "all_feats") == placed
    assert daily.where("lon < envelope.xmin OR lon > envelope.xmax OR lat < envelope.ymin").count() == 0


def test_tiles_lose_no_feature(daily):
    points, boxes = C.daily_points(daily), C.daily_boxes(daily)
    assert tile_features(points, "points").count() == points.count()
    tiles = tile_features(boxes, "boxes")
    assert tiles.drop("x", "y").distinct().count() == boxes.drop("h3").distinct().count()


def test_box_over_several_tiles(spark):
    box = spark.createDataFrame([("c", 1, -10.0, -10.0, 10.0, 10.0)], "h3 string, n int, xmin double, ymin double, xmax double, ymax double")
    tiles = tile_features(box, "boxes").select("x", "y").collect()
    assert len(set(map(tuple, tiles))) == len(tiles) == 16


def test_top_k_with_ties(spark):
    rows = [(f"c{n:02}", dt.datetime(2024, 1, 15), 5 if n < 18 else 9) for n in range(20)]
    frame = spark.createDataFrame(rows, "country string, month timestamp_ntz, all_feats long")
    top = A.top_countries(frame).collect()
    assert [r["country"] for r in top] == ["c18", "c19", *[f"c{n:02}" for n in range(13)]]


def test_documents_of_nothing_and_of_awkward_text(spark):
    import json

    chapters = spark.createDataFrame(
        [('A "q" \\ é', 1, None, "k", "u"), (None, 2, "c", "k", "u")],
        "chapter string, chapter_id long, city string, country string, university string",
    )
    text = "".join(r["value"] for r in chapters_document(chapters, "d").collect())
    assert [c["chapter"] for c in json.loads(text)["chapters"]] == ['A "q" \\ é', None]
    empty = "".join(r["value"] for r in chapters_document(chapters.where("false"), "d").collect())
    assert json.loads(empty) == {"chapters": [], "ds": "d"}
    month = spark.createDataFrame([(dt.datetime(2024, 1, 15), 3)], "month timestamp_ntz, users long")
    assert json.loads("".join(r["value"] for r in monthly_document(month, "s").collect())) == [
        {"month": 1705276800, "users": 3}
    ]


def test_no_registered_query_plans_a_cross_product(spark):
    for name, query in Q.QUERIES.items():
        if name in ("point_in_polygon_join", "enriched_changesets", "public_rollup", "coarse_cells_6", "top15_countries"):
            plan = query(spark, SF)._jdf.queryExecution().executedPlan().toString()
            assert "NestedLoop" not in plan and "Cartesian" not in plan, name


def test_standin_members_differ_between_snapshots(spark):
    counts = dict(map(tuple, standin.members(spark, SF).groupBy("ds").count().collect()))
    assert counts[standin.OLDER_DS] > counts[standin.LATEST_DS] > 0
