"""Hand-made files through both jobs, down to the written outputs."""

from __future__ import annotations

import datetime as dt
import json

import fixtures
import pytest
from pyspark.sql import functions as F

from editpulse.plans import dashboard, enrich
from editpulse.sources import sinks, tables
from editpulse.sources.catalog import register_table


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("inputs")
    paths = {name: str(root / name) for name in ("changesets", "history", "members", "boundaries")}
    fixtures.changesets(spark).write.orc(paths["changesets"])
    fixtures.history(spark).write.orc(paths["history"])
    fixtures.members(spark).write.partitionBy("ds").parquet(paths["members"])
    # Some boundary files carry a garbled first name field; readers go by position.
    odd = "struct<prim_x:string,long:string,abbrev:string,formal:string>"
    fixtures.boundaries(spark).withColumn("name", F.col("name").cast(odd)).write.parquet(paths["boundaries"])
    return paths


@pytest.fixture(scope="module")
def enriched(spark, inputs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("enriched") / "table")
    enrich.run(spark, inputs["changesets"], inputs["history"], inputs["members"], inputs["boundaries"], path)
    return path


@pytest.fixture(scope="module")
def released(spark, inputs, enriched, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("out"))
    ds = dashboard.run(spark, enriched, inputs["members"], inputs["boundaries"], root, fixtures.RUN_DATE)
    return root, ds


def document(spark, path):
    """Part files in name order form one JSON document."""
    files = sorted(f for f in spark.read.text(path).inputFiles())
    return json.loads("".join(open(f.removeprefix("file://")).read() for f in files))


def test_enriched_rows(spark, enriched):
    rows = spark.read.parquet(enriched).collect()
    found = sorted((r["id"], r["a3"]) for r in rows if r["a3"]) , sorted(r["id"] for r in rows)
    assert found == ([(1, "AAA"), (2, "AAA"), (4, "BBB"), (4, "CCC"), (8, "AAA")], [1, 2, 3, 4, 4, 7, 8, 11])
    assert {str(r["ds"]) for r in rows} == {"2024-03-05"}
    assert {r["members_ds"] for r in rows} == {fixtures.NEW_DS}


def test_enriched_counters(spark, enriched):
    rows = {r["id"]: r.asDict(recursive=True) for r in spark.read.parquet(enriched).collect()}
    one, two, three = rows[1], rows[2], rows[3]
    assert one["buildings"] == {"new": 2, "edited": 0} and one["highways"] == {"new": 1, "edited": 0}
    assert one["amenities"] is None and one["relations"] is None
    assert one["nodes"] == {"new": 2, "edited": 1, "deleted": 0}
    assert one["elements"] == {"new": 4, "edited": 1, "deleted": 0, "num_changes": 5}
    assert one["features"] == {"new": 2, "edited": 0, "new_vertices": 1, "edited_vertices": 1}
    assert two["amenities"] == {"new": 1, "edited": 1}
    assert two["nodes"] == {"new": 1, "edited": 1, "deleted": 2}
    assert two["elements"] == {"new": 0, "edited": 0, "deleted": 2, "num_changes": 6}
    assert two["features"] == {"new": 1, "edited": 0, "new_vertices": 0, "edited_vertices": 0}
    assert three["relations"] == {"new": 0, "edited": 1, "deleted": 0}
    assert three["geometry"] is None and three["lon"] is None and three["bbox"]["diameter"] is None


def test_enriched_tags_and_points(spark, enriched):
    rows = {r["id"]: r.asDict(recursive=True) for r in spark.read.parquet(enriched).collect()}
    assert dict(rows[1]["tags"]) == {"review": "y"} and rows[1]["hashtags"] == ["#a", "#b", ""]
    assert rows[2]["tags"] is None and rows[3]["tags"] is None and rows[4]["tags"] is None
    assert rows[4]["comment"] == "c" and rows[4]["hashtags"] == ["h"]
    assert (rows[4]["lon"], rows[4]["lat"]) == (31.0, 11.0) and len(rows[4]["geometry"]) == 21
    assert rows[1]["bbox"]["diameter"] == 0 and rows[4]["bbox"]["diameter"] > 300


def test_read_enriched_adds_cell_and_selects_partition(spark, enriched):
    frame = tables.read_enriched(spark, enriched)
    assert frame.where("lon IS NOT NULL AND h3 IS NULL").count() == 0
    assert tables.read_enriched(spark, enriched, "1999-01-01").count() == 0
    kept = frame.withColumn("h3", F.lit("mine"))
    assert tables.with_cell(kept).select("h3").distinct().first()[0] == "mine"
    bare = spark.read.parquet(enriched).drop("lon", "lat", "ds")
    assert {"geometry"} <= set(bare.columns)


def test_wkb_only_table_gets_coordinates(spark, enriched, tmp_path):
    bare = str(tmp_path / "bare")
    spark.read.parquet(enriched).drop("lon", "lat").write.partitionBy("ds").parquet(bare)
    a = tables.read_enriched(spark, bare).select("id", "lon", "lat", "h3")
    b = tables.read_enriched(spark, enriched).select("id", "lon", "lat", "h3")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_weekly_csv(spark, released):
    root, ds = released
    assert ds == "2024-03-05" and sinks.read_marker(spark, f"{root}/{sinks.LATEST}") == ds
    rows = spark.read.option("header", True).csv(sinks.release_paths(root, ds)["weekly"]).collect()
    got = {(int(r["chapter_id"]), r["week"]): (int(r["all_feats"]), int(r["other"]), int(r["mappers"])) for r in rows}
    assert got[(1, "2024-01-15 00:00:00")] == (3, -2, 1)
    assert got[(2, "2024-01-29 00:00:00")] == (2, 0, 1)  # in two countries: counted per country
    assert got[(2, "2024-03-04 00:00:00")] == (4, 0, 1)  # two chapters: counted twice, under the smaller
    assert (2, "2014-12-29 00:00:00") in got


def test_monthly_document(spark, released):
    root, ds = released
    months = document(spark, sinks.release_paths(root, ds)["monthly"])
    stamps = [dt.datetime.fromtimestamp(m["month"] / 1000, dt.timezone.utc).strftime("%Y-%m-%d") for m in months]
    assert stamps == ["2015-01-15", "2023-12-15", "2024-01-15", "2024-02-15"]  # current month left out
    assert months[2]["new_buildings"] == 2 and months[2]["users"] == 1 and months[2]["chapters"] == 1


def test_chapters_and_top_countries(spark, released):
    root, ds = released
    paths = sinks.release_paths(root, ds)
    index = document(spark, paths["chapters"])
    assert index["ds"] == ds and [c["chapter"] for c in index["chapters"]] == ["Alpha", "Beta", "Gamma"]
    assert index["chapters"][1]["city"] is None
    assert document(spark, paths["top_countries"]) == [
        {"month": "2024-01-15T00:00:00", "top_countries": [["Land AAA", 3]]},
        {"month": "2024-02-15T00:00:00", "top_countries": [["Land BBB", 1], ["Land CCC", 1]]},
        {"month": "2024-03-15T00:00:00", "top_countries": [["Land AAA", 4]]},
    ]


def test_features_and_tiles(spark, released):
    root, ds = released
    points = [json.loads(r["value"]) for r in spark.read.text(f"{root}/features/points").collect()]
    assert len(points) == 5 and all(p["type"] == "Feature" for p in points)
    boxes = [json.loads(r["value"]) for r in spark.read.text(f"{root}/features/boxes").collect()]
    assert all(b["geometry"]["coordinates"][0][0] == b["geometry"]["coordinates"][0][4] for b in boxes)
    coarse = [json.loads(r["value"]) for r in spark.read.text(f"{root}/features/coarse_4").collect()]
    assert len(coarse) == 3 and "uid" not in coarse[0]["properties"]
    tiles = spark.read.parquet(sinks.release_paths(root, ds)["points"])
    assert tiles.count() == 5 and "h3" not in tiles.columns
    assert tiles.select("layer").distinct().first()[0] == "daily"


def test_public_rollup(spark, released):
    root, ds = released
    path = sinks.release_paths(root, ds)["rollup"]
    rows = spark.read.parquet(path)
    assert "uid" not in rows.columns and rows.columns.count("chapter_id") == 1
    got = sorted((str(r["created_at"]), r["chapter"], r["a3"], r["n_boxes"]) for r in rows.collect() if r["a3"])
    assert got == [
        ("2024-01-15", "Alpha", "AAA", 2), ("2024-02-01", "Beta", "BBB", 2), ("2024-02-01", "Beta", "CCC", 2),
        ("2024-03-04", "Beta", "AAA", 2), ("2024-03-04", "Gamma", "AAA", 2),
    ]
    assert rows.count() == 8
    assert rows.where("chapter = 'Gamma'").first()["chapter_location"] == "POINT (3.5 -3)"
    boxes = spark.read.parquet(f"{path}.boxes")
    assert boxes.columns == ["row_key", "bbox"]
    counted = boxes.groupBy("row_key").count()
    assert rows.join(counted, "row_key").where("n_boxes = count").count() == rows.count()


def test_single_chapter_option(spark, inputs, enriched, tmp_path):
    ds = dashboard.run(
        spark, enriched, inputs["members"], inputs["boundaries"], str(tmp_path), fixtures.RUN_DATE,
        single_chapter=True, keep_boxes=False,
    )
    rows = spark.read.option("header", True).csv(sinks.release_paths(str(tmp_path), ds)["weekly"])
    assert rows.where("chapter_id = 2 AND week = '2024-03-04 00:00:00'").first()["all_feats"] == "2"
    rollup = spark.read.parquet(sinks.release_paths(str(tmp_path), ds)["rollup"])
    assert not {"row_key", "envelope", "n_boxes", "n_points"} & set(rollup.columns)


def test_newest_partition_comes_from_the_listing(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("SELECT 1 AS id, '2024-01-09' AS ds UNION ALL SELECT 2, '2024-01-30'").write.partitionBy("ds").parquet(path)
    (tmp_path / "t" / "ds=2024-02-01").mkdir()  # begun, but nothing written
    assert tables.newest_partition(spark, path) == "2024-01-30"
    flat = str(tmp_path / "flat")
    spark.range(1).write.parquet(flat)
    assert tables.newest_partition(spark, flat) is None


def test_empty_enriched_table_is_named(spark, inputs, tmp_path):
    (tmp_path / "none").mkdir()
    with pytest.raises(ValueError, match="no ds= partition"):
        dashboard.run(
            spark, str(tmp_path / "none"), inputs["members"], inputs["boundaries"], str(tmp_path / "out"), fixtures.RUN_DATE
        )


def test_members_as_of_and_partition_pruning(spark, inputs):
    people = tables.read_members(spark, inputs["members"])
    assert dict(people.dtypes)["ds"] == "string" and "chapter_id" in people.columns
    old = spark.createDataFrame([(fixtures.OLD_DS,)], "members_ds string")
    assert {r["uid"] for r in tables.members_as_of(people, old).collect()} == {100, 103}
    newest = tables.latest_partition(people)
    assert newest.count() == 4
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ds" in plan


def test_partition_sink_modes(spark, tmp_path):
    frame = spark.createDataFrame([(1, "a"), (2, "b")], "x int, ds string")
    path = str(tmp_path / "t")
    sinks.write_partitioned(frame, path)
    sinks.write_partitioned(frame.where("ds = 'b'").withColumn("x", F.lit(9)), path, keep_others=True)
    assert sorted(map(tuple, spark.read.parquet(path).select("x", "ds").collect())) == [(1, "a"), (9, "b")]
    sinks.write_partitioned(frame.where("ds = 'a'"), path)
    assert [tuple(r) for r in spark.read.parquet(path).select("x", "ds").collect()] == [(1, "a")]


def test_external_tables(spark, inputs):
    name = register_table(spark, "members", inputs["members"])
    register_table(spark, "members", inputs["members"])  # repeatable
    assert spark.table(name).count() == 6
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 2
    for table, folder in (("changesets", "changesets"), ("planet_history", "history"), ("planet", "history")):
        assert spark.table(register_table(spark, table, inputs[folder])).count() > 0
    assert tables.read_planet(spark, inputs["history"]).count() == 17


def test_reader_fixes_boundary_name_field(spark, inputs):
    row = tables.read_boundaries(spark, inputs["boundaries"]).select("name.primary", "region.wb").first()
    assert row["primary"].startswith("Land") and row["wb"] == "W"


def test_history_scan_is_pruned_and_date_pushed(spark, inputs):
    from editpulse.operators.changesets import changeset_columns, member_semi_join
    from editpulse.operators.rollup import changeset_rollup

    plan = changeset_rollup(tables.read_history(spark, inputs["history"]))._jdf.queryExecution().executedPlan().toString()
    schema = plan[plan.index("ReadSchema:"):]
    assert "nds" not in schema and "members" not in schema and "lat" not in schema
    kept = member_semi_join(tables.read_changesets(spark, inputs["changesets"]), tables.read_members(spark, inputs["members"]))
    plan = changeset_columns(kept)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(created_at" in plan
