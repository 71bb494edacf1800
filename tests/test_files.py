"""Storage: zones of ORC files, catalog tables, overwriting, releases, working tables, literal partitions."""

from __future__ import annotations

import os
import subprocess
import sys

import fixtures
import pytest
from pyspark.sql import functions as F

from editpulse.operators.changesets import member_semi_join
from editpulse.operators.positions import with_positions
from editpulse.session import checkpoint_dir
from editpulse.sources import sinks, tables
from editpulse.sources.catalog import register_table
from editpulse.sources.release import Release
from editpulse.sources.storage import partitions
from editpulse.sources.working import working_run, working_table

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
ELSEWHERE = """
import sys
from editpulse.session import build_session
from editpulse.sources import tables
spark = build_session("zone", "local[1]", **{"spark.ui.enabled": "false", "spark.sql.session.timeZone": sys.argv[2],
    "spark.driver.extraJavaOptions": "-Duser.timezone=America/New_York"})
spark.sparkContext.setLogLevel("OFF")
try:
    row = tables.read_changesets(spark, sys.argv[1]).selectExpr("cast(created_at AS timestamp_ntz) AS t").first()
    print("READ", row.t)
except ValueError as error:
    print("REFUSED", error)
"""


def in_new_york(path: str, session_zone: str) -> str:
    run = subprocess.run(
        [sys.executable, "-c", ELSEWHERE, path, session_zone], capture_output=True, text=True, timeout=120,
        env={**os.environ, "PYTHONPATH": ROOT}, check=True,
    )
    return run.stdout


def test_orc_times_come_out_as_stored_or_are_refused(spark, tmp_path):
    path = str(tmp_path / "orc")
    spark.sql("SELECT 1L AS id, TIMESTAMP '2024-07-04 05:06:07' AS created_at").write.orc(path)
    assert "READ 2024-07-04 05:06:07" in in_new_york(path, "America/New_York")
    assert "REFUSED" in in_new_york(path, "UTC")


def failing(frame):
    return frame.withColumn("x", F.when(F.col("x") > 1, F.raise_error(F.lit("stop")).cast("int")).otherwise(F.col("x")))


@pytest.mark.parametrize("keep_others", [True, False])
def test_failed_overwrite_leaves_the_table(spark, tmp_path, keep_others):
    path = str(tmp_path / "t")
    frame = spark.createDataFrame([(1, "a"), (2, "b")], "x int, ds string")
    sinks.write_partitioned(frame, path)
    with pytest.raises(Exception, match="stop"):
        sinks.write_partitioned(failing(frame), path, keep_others=keep_others)
    read = lambda: sorted(map(tuple, spark.read.parquet(path).select("x", "ds").collect()))
    assert read() == [(1, "a"), (2, "b")]
    sinks.write_partitioned(frame.where("ds = 'b'").withColumn("x", F.lit(7)), path, keep_others=keep_others)
    assert read() == ([(1, "a"), (7, "b")] if keep_others else [(7, "b")])
    assert [name for name in os.listdir(tmp_path) if not name.startswith(".")] == ["t"]


def test_tables_with_odd_places_and_values(spark, tmp_path):
    path = str(tmp_path / "it's here")
    people = fixtures.members(spark).drop("chapter_id").withColumn("ds", F.concat("ds", F.lit(" o'clock: 1")))
    sinks.write_partitioned(people, path)
    (tmp_path / "it's here" / "ds=begun").mkdir()
    spark.sql("DROP TABLE IF EXISTS odd.members")
    name = register_table(spark, "members", path, "odd")
    assert register_table(spark, "members", path, "odd") == name
    assert spark.table(name).count() == people.count() and spark.sql(f"SHOW PARTITIONS {name}").count() == 2
    newest = max(partitions(spark, path))
    assert newest.endswith("o'clock: 1") and spark.table(name).where(F.col("ds") == newest).count() == 4


def test_boundary_view_renames_by_position(spark, tmp_path):
    path = str(tmp_path / "b")
    odd = "struct<prim_x:string,long:string,abbrev:string,formal:string>"
    fixtures.boundaries(spark).withColumn("name", F.col("name").cast(odd)).write.parquet(path)
    name = register_table(spark, "boundaries", path, "odd")
    assert spark.table(name).where("name.primary IS NULL").count() == 0
    direct = tables.read_boundaries(spark, path)
    assert spark.table(name).select("a3", "name.primary").exceptAll(direct.select("a3", "name.primary")).count() == 0


def lines(spark, path):
    return [r["value"] for r in spark.read.text(path).collect()]


def test_release_is_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "out")

    def release(value, fail=None):
        with Release(spark, root) as out:
            for place in ("one.txt", "deep/er/two.txt", "three"):
                rows = spark.createDataFrame([(f"{value} {place}",)], "value string")
                sinks.write_lines(rows.coalesce(1), out.path(place, single=place.endswith("txt")))
            if fail:
                move = out._move
                monkeypatch.setattr(out, "_move", lambda a, b: fail(move, a, b))
            out.publish("latest.txt", value)

    def state():
        return [lines(spark, f"{root}/{p}") for p in ("one.txt", "deep/er/two.txt", "three", "latest.txt")]

    release("first")
    assert state() == [["first one.txt"], ["first deep/er/two.txt"], ["first three"], ["first"]]
    assert os.path.isfile(f"{root}/one.txt") and os.path.isdir(f"{root}/three")

    def stop_at(name):
        def move(real, source, target):
            if target.endswith(name) and "/new/" in source:
                raise OSError("no more")
            real(source, target)
        return move

    for name in ("one.txt", "three", "latest.txt"):
        with pytest.raises(OSError, match="no more"):
            release("second", stop_at(name))
        assert state()[3] == ["first"] and state()[0] == ["first one.txt"] and state()[2] == ["first three"]
    with pytest.raises(ZeroDivisionError), Release(spark, root) as out:
        sinks.write_lines(spark.createDataFrame([("half",)], "value string"), out.path("one.txt", single=True))
        1 / 0
    assert state()[0] == ["first one.txt"]
    release("third")
    assert state()[3] == ["third"] and sinks.read_marker(spark, f"{root}/latest.txt") == "third"
    assert [name for name in os.listdir(root) if name.startswith("_")] == []


def test_several_parts_stay_a_folder(spark, tmp_path):
    with Release(spark, str(tmp_path)) as out:
        sinks.write_lines(spark.range(4).selectExpr("cast(id AS string) AS value").repartition(2), out.path("x", single=True))
        out.publish("m", "1")
    assert os.path.isdir(tmp_path / "x") and len(lines(spark, str(tmp_path / "x"))) == 4


def test_working_tables_go_with_a_run_that_succeeds(spark):
    def kept(folder):
        return os.path.isdir(folder.removeprefix("file://"))

    with working_run(spark) as outer:
        assert working_table(spark.range(3), "a").count() == 3
        with working_run(spark) as inner:
            table = working_table(spark.range(5), "b")
            assert table.count() == 5 and table.inputFiles()[0].startswith(inner if inner.startswith("file:") else f"file://{inner}")
        assert not kept(inner) and kept(outer)
    assert not kept(outer)
    with pytest.raises(ZeroDivisionError) as error, working_run(spark) as failed:
        working_table(spark.range(1), "c")
        1 / 0
    assert kept(failed) and failed in error.value.__notes__[0]
    after = working_table(spark.range(2), "d").inputFiles()[0]
    assert f"{checkpoint_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}" in after


def test_named_snapshot_is_the_only_one_read(spark, tmp_path):
    path = str(tmp_path / "members")
    fixtures.members(spark).drop("chapter_id").write.partitionBy("ds").parquet(path)
    newest = tables.newest_partition(spark, path)
    people = tables.read_members(spark, path, newest)
    assert len({f.split("ds=")[1].split("/")[0] for f in people.inputFiles()} - {newest}) <= 1
    named = member_semi_join(fixtures.changesets(spark), people, ds=newest)
    plan = named._jdf.queryExecution().executedPlan().toString()
    assert "(ds#" in plan and f"= {newest})" in plan and "Subquery" not in plan
    found = member_semi_join(fixtures.changesets(spark), tables.read_members(spark, path))
    assert sorted(map(repr, named.select("id", "members_ds").collect())) == sorted(map(repr, found.select("id", "members_ds").collect()))


def test_positions_are_dense_over_many_partitions(spark):
    rows = spark.range(0, 5000, 1, 16).selectExpr("if(id % 3 = 0, null, id % 7) AS grp", "(id * 7919) % 5000 AS key", "id")
    placed = with_positions(rows, [F.col("key").desc()], ("grp",))
    expected = rows.selectExpr("*", "row_number() OVER (PARTITION BY grp ORDER BY key DESC) - 1 AS position")
    assert placed.exceptAll(expected.selectExpr("grp", "key", "id", "cast(position AS bigint)")).count() == 0
    assert placed.count() == 5000
    everywhere = with_positions(rows, [F.col("key").asc()]).where("position != key")
    assert everywhere.count() == 0
    assert with_positions(rows.where("id < 0"), [F.col("key").asc()]).count() == 0
