"""Queries that go through files and the catalog: what is written is read back and compared."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse.checks.oracle import (
    CHAPTERS, CHAPTERS_JSON, COUNTRIES, EVENTS, EVENTS_ACTIVITY, DAILY, MEMBERS, MONTHLY, ORACLE,
    ORDERS_ACTIVITY, PUBLIC, TOP, WEEKLY, CHANGESETS, _country_months, _with, cell,
)
from editpulse.checks.queries import (
    CELL, RUN_DATE, SINCE, Query, _activity, _events, _newest_members, chapter_index, weekly_chapters_events,
)
from editpulse.operators import activity as A
from editpulse.operators import cells as C
from editpulse.operators import changesets as CS
from editpulse.operators import documents as D
from editpulse.operators.positions import with_positions
from editpulse.operators.public import public_rollup
from editpulse.operators.spatial import prepared_index
from editpulse.sources import sinks, standin, tables
from editpulse.sources.catalog import register_table
from editpulse.sources.release import Release
from editpulse.sources.working import working_folder, working_table

EVENT_DS = "2024-01-30"


def _as_stored(frame: DataFrame, *columns: str) -> DataFrame:
    return frame.withColumns({c: F.col(c).cast("timestamp") for c in columns})


def orc_changesets(spark: SparkSession, sf: str) -> DataFrame:
    """Changesets written as ORC and read with their fixed schema, from a date on."""
    path = working_folder(spark, "changesets")
    _as_stored(standin.changesets(spark, sf), "created_at", "closed_at").write.orc(path)
    read = tables.read_changesets(spark, path).where(F.col("created_at") >= F.lit(SINCE).cast("timestamp"))
    return read.select(
        "id", "uid", "user", "open", "comments_count", "num_changes", F.size("tags").alias("n_tags"),
        *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("created_at", "closed_at")],
        *[F.col(c).cast("double").alias(c) for c in ("min_lon", "min_lat", "max_lon", "max_lat")],
    )


def _orc_elements(spark: SparkSession, sf: str) -> str:
    path = working_folder(spark, "elements")
    _as_stored(standin.elements(spark, sf), "timestamp").write.orc(path)
    return path


def orc_history(spark: SparkSession, sf: str) -> DataFrame:
    """The five columns that the rollup takes from an ORC history."""
    read = tables.read_history(spark, _orc_elements(spark, sf))
    return read.select("changeset", "type", F.size("tags").alias("n_tags"), "version", "visible")


def orc_planet(spark: SparkSession, sf: str) -> DataFrame:
    """Every column of the elements, nested ones too."""
    return tables.read_planet(spark, _orc_elements(spark, sf)).select(
        "id", "type", F.size("tags").alias("n_tags"), F.col("lat").cast("double").alias("lat"),
        F.col("lon").cast("double").alias("lon"), F.size("nds").alias("n_nds"), F.col("nds")[0]["ref"].alias("first_ref"),
        F.col("members")[0]["role"].alias("role"), F.col("members")[0]["ref"].alias("member_ref"), "changeset",
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "uid", "user", "version", "visible",
    )


def boundary_files(spark: SparkSession, sf: str) -> DataFrame:
    """Boundaries whose files name a struct field otherwise, through the catalog."""
    path = working_folder(spark, "bound'aries")
    odd = "struct<prim_x:string,long:string,abbrev:string,formal:string>"
    standin.boundaries(spark, sf).withColumn("name", F.col("name").cast(odd)).write.parquet(path)
    name = _fresh_table(spark, "boundaries", path)
    return spark.table(name).select(
        "a3", "country", F.col("name.primary").alias("name"), F.col("name.formal").alias("formal"),
        F.col("entity.geounit").alias("geounit"), F.col("region.continent").alias("continent"),
        F.octet_length("geometry").alias("geometry_bytes"),
    )


def _fresh_table(spark: SparkSession, table: str, path: str) -> str:
    database = "editpulse_files"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.sql(f"DROP VIEW IF EXISTS {database}.boundaries")
    spark.sql(f"DROP TABLE IF EXISTS {database}.{table}{'_files' if table == 'boundaries' else ''}")
    return register_table(spark, table, path, database)


def _member_files(spark: SparkSession, sf: str) -> str:
    path = working_folder(spark, "members")
    sinks.write_partitioned(standin.members(spark, sf).drop("chapter_id"), path)
    return path


def catalog_members(spark: SparkSession, sf: str) -> DataFrame:
    """Member snapshots as catalog partitions, one of them found by a second registration."""
    path = working_folder(spark, "members")
    people = standin.members(spark, sf).drop("chapter_id")
    sinks.write_partitioned(people.where(F.col("ds") == standin.OLDER_DS), path)
    _fresh_table(spark, "members", path)
    sinks.write_partitioned(people.where(F.col("ds") == standin.LATEST_DS), path, keep_others=True)
    name = register_table(spark, "members", path, "editpulse_files")
    return spark.sql(f"SELECT ds, uid, team_id, chapter, city, country FROM {name}")


def member_files(spark: SparkSession, sf: str) -> DataFrame:
    """Changesets of the newest member snapshot, which a listing names."""
    path = _member_files(spark, sf)
    newest = tables.newest_partition(spark, path)
    people = tables.read_members(spark, path, newest)
    kept = CS.member_semi_join(standin.changesets(spark, sf), people, SINCE, ds=newest)
    return kept.select("id", "uid", "created_at", "members_ds")


def _two_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Enriched rows of two runs; the newer one recorded two member snapshots."""
    newer = F.col("id") % 3 > 0
    recorded = F.when(newer, F.when(F.col("id") % 2 == 0, "2001-07-22").otherwise(standin.OLDER_DS)).otherwise(standin.LATEST_DS)
    return standin.event_changesets(spark, sf).withColumns(
        {"ds": F.when(newer, EVENT_DS).otherwise("2024-01-23"), "members_ds": recorded}
    )


def enriched_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """The newest of two enriched partitions with the members of the newest snapshot it recorded."""
    path = working_folder(spark, "enriched")
    bare = _two_runs(spark, sf).drop("h3")
    sinks.write_partitioned(sinks.with_geometry(bare).drop("lon", "lat"), path)
    rows = tables.read_enriched(spark, path)
    people = tables.members_as_of(tables.read_members(spark, _member_files(spark, sf)), rows)
    return rows.join(people.select("uid", "chapter_id", F.col("ds").alias("snapshot")), "uid").select(
        "id", "uid", "lon", "lat", "h3", "chapter_id", "ds", "snapshot"
    )


def _overwritten(spark: SparkSession, sf: str, keep_others: bool) -> DataFrame:
    path = working_folder(spark, "overwritten")
    rows = _two_runs(spark, sf).select("id", "uid", "ds")
    sinks.write_partitioned(rows, path)
    for _ in range(2):  # repeatable
        sinks.write_partitioned(rows.where(F.col("ds") == EVENT_DS).withColumn("uid", -F.col("uid")), path, "ds", keep_others)
    return spark.read.parquet(path).select("id", "uid", "ds")


def partition_static(spark: SparkSession, sf: str) -> DataFrame:
    """Overwriting one partition with all others going."""
    return _overwritten(spark, sf, False)


def partition_dynamic(spark: SparkSession, sf: str) -> DataFrame:
    """Overwriting one partition with all others staying."""
    return _overwritten(spark, sf, True)


def release_listing(spark: SparkSession, sf: str) -> DataFrame:
    """Path and lines of every released text file, after a second release replaced a first."""
    root = working_folder(spark, "release")
    paths = sinks.release_paths(root, EVENT_DS)
    chapters = working_table(chapter_index(spark, sf), "chapters")
    weekly = working_table(weekly_chapters_events(spark, sf), "weekly")
    for rows in (weekly.limit(3), weekly):
        with Release(spark, root) as release:
            sinks.write_csv(rows.coalesce(1), release.path(paths["weekly"], single=True))
            lines = D.chapters_document(chapters, EVENT_DS).coalesce(1)
            sinks.write_lines(lines, release.path(paths["chapters"], single=True))
            release.publish(sinks.LATEST, EVENT_DS)
    # each is one file: the path of a line is the place it was released at
    read = spark.read.text([paths["weekly"], paths["chapters"], f"{root}/{sinks.LATEST}"])
    place = F.regexp_extract(F.input_file_name(), "/release-[0-9a-f]{32}/(.*)$", 1)
    return read.select(F.replace(place, F.lit("%3D"), F.lit("=")).alias("place"), "value")


def rollup_geometry(spark: SparkSession, sf: str) -> DataFrame:
    """The published Parquet read back: its points as bytes."""
    daily = C.with_row_key(working_table(C.daily_cells(_events(spark, sf)), "daily"), "check")
    countries = standin.boundaries(spark, sf)
    rollup = public_rollup(daily, _newest_members(spark, sf), countries, prepared_index(countries, CELL), CELL)
    path = working_folder(spark, "rollup")
    sinks.write_parquet(sinks.with_geometry(rollup), path)
    return spark.read.parquet(path).select("h3", "created_at", "chapter_id", "a3", F.hex("geometry").alias("geometry"))


def monthly_positions(spark: SparkSession, sf: str) -> DataFrame:
    months = A.monthly_activity(C.daily_cells(_activity(spark, sf)), RUN_DATE)
    return with_positions(months, [F.col("month").asc_nulls_last()]).select("position", "month", "users")


def country_positions(spark: SparkSession, sf: str) -> DataFrame:
    countries = A.country_months(_activity(spark, sf), RUN_DATE)
    order = [F.col("all_feats").desc_nulls_last(), F.col("month").asc(), F.col("country").asc()]
    return with_positions(countries, order)


def chapter_positions(spark: SparkSession, sf: str) -> DataFrame:
    order = [F.col(c).asc_nulls_last() for c in ("chapter", "chapter_id")]
    return with_positions(chapter_index(spark, sf), order).select("position", "chapter", "chapter_id")


def top_positions(spark: SparkSession, sf: str) -> DataFrame:
    """Places within each month, which must be the ranks."""
    top = A.top_countries(A.country_months(_activity(spark, sf), dt.date(2001, 7, 17)))
    return with_positions(top, [F.col("all_feats").desc_nulls_last(), F.col("country").asc()], ("month",))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        orc_changesets, orc_history, orc_planet, boundary_files, catalog_members, member_files, enriched_round_trip,
        partition_static, partition_dynamic, release_listing, rollup_geometry, monthly_positions, country_positions,
        chapter_positions, top_positions,
    )
}

_TAG_COUNT = " + ".join(
    f"({c} IS NOT NULL)::INT"
    for c in ("comment", "created_by", "hashtag_text", "host", "imagery_used", "source", "locale", "review")
)
_ELEMENT_TYPE = "CASE l_returnflag WHEN 'N' THEN 'node' WHEN 'A' THEN 'way' ELSE 'relation' END"
_ELEMENT_TAGS = "CASE l_partkey % 6 WHEN 0 THEN 1 + (l_partkey % 12 = 0)::INT WHEN 4 THEN 0 WHEN 5 THEN NULL ELSE 1 END::INT"
_RUNS = """
runs AS (SELECT *, CASE WHEN id % 3 > 0 THEN '2024-01-30' ELSE '2024-01-23' END AS run FROM ev)"""


def _wkb_hex(value: str) -> str:
    """Little-endian hexadecimal digits of a double."""
    byte = f"list_reduce([0] || list_transform(range(8), lambda j: substring(({value})::DOUBLE::BIT::VARCHAR, (i * 8 + j + 1)::INT, 1)::INT), lambda a, c: a * 2 + c)"
    return f"array_to_string(list_transform(range(7, -1, -1), lambda i: printf('%02X', {byte})), '')"


SQL: dict[str, str] = {
    "orc_changesets": _with(
        [CHANGESETS],
        f"SELECT id, uid, username AS user, FALSE AS open, id % 4 AS comments_count, num_changes, "
        f"CASE id % 11 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE {_TAG_COUNT} END AS n_tags, created_at, closed_at, "
        "xmin AS min_lon, ymin AS min_lat, xmax AS max_lon, ymax AS max_lat FROM cs "
        "WHERE created_at >= TIMESTAMP '1996-01-01'",
    ),
    "orc_history": f"SELECT l_orderkey AS changeset, {_ELEMENT_TYPE} AS type, {_ELEMENT_TAGS} AS n_tags, "
    "l_linenumber::BIGINT AS version, l_linestatus = 'O' AS visible FROM lineitem",
    "orc_planet": f"""SELECT l_orderkey * 8 + l_linenumber AS id, {_ELEMENT_TYPE} AS type, {_ELEMENT_TAGS} AS n_tags,
  CASE WHEN l_returnflag = 'N' THEN (l_partkey % 10000 - 5000) / 128.0::DOUBLE END AS lat,
  CASE WHEN l_returnflag = 'N' THEN (l_suppkey % 20000 - 10000) / 128.0::DOUBLE END AS lon,
  CASE WHEN l_returnflag = 'A' THEN l_linenumber END AS n_nds, CASE WHEN l_returnflag = 'A' THEN l_partkey END AS first_ref,
  CASE WHEN l_returnflag = 'R' THEN 'outer' END AS role, CASE WHEN l_returnflag = 'R' THEN l_suppkey END AS member_ref,
  l_orderkey AS changeset, l_shipdate AS timestamp, l_suppkey AS uid, 'mapper-' || l_suppkey AS user,
  l_linenumber::BIGINT AS version, l_linestatus = 'O' AS visible FROM lineitem""",
    "boundary_files": _with(
        [COUNTRIES],
        "SELECT a3, country, country AS name, NULL AS formal, country AS geounit, continent, "
        # a multi-polygon: 9 bytes, 9 per part, 4 per ring, 16 per point
        "CASE kind WHEN 1 THEN 9 + 9 + 2 * (4 + 5 * 16) WHEN 2 THEN 9 + 9 + 4 + 7 * 16 "
        "WHEN 3 THEN 9 + 2 * (9 + 4 + 5 * 16) ELSE 9 + 9 + 4 + 5 * 16 END AS geometry_bytes FROM shp",
    ),
    "catalog_members": _with([MEMBERS], "SELECT ds, uid, chapter_id AS team_id, chapter, city, country FROM ms"),
    "member_files": ORACLE["member_semi_join"],
    "enriched_round_trip": _with(
        [MEMBERS, EVENTS, _RUNS],
        f"SELECT id, uid, lon, lat, {cell(16)} AS h3, chapter_id, run AS ds, ms.ds AS snapshot "
        "FROM runs JOIN ms USING (uid) WHERE run = '2024-01-30' AND ms.ds = '2001-07-29'",
    ),
    "partition_static": _with([EVENTS, _RUNS], "SELECT id, -uid AS uid, run AS ds FROM runs WHERE run = '2024-01-30'"),
    "partition_dynamic": _with(
        [EVENTS, _RUNS], "SELECT id, CASE WHEN run = '2024-01-30' THEN -uid ELSE uid END AS uid, run AS ds FROM runs"
    ),
    "release_listing": _with(
        [*EVENTS_ACTIVITY, DAILY],
        "SELECT 'latest_ds.txt' AS place, '2024-01-30' AS value "
        "UNION ALL SELECT 'activity-dashboard/ds=2024-01-30/weekly_chapter_activity.csv', "
        "'chapter_id,week,all_feats,buildings,highways,amenities,other,mappers' "
        "UNION ALL SELECT 'activity-dashboard/ds=2024-01-30/weekly_chapter_activity.csv', "
        "chapter_id || ',' || strftime(week, '%Y-%m-%d %H:%M:%S') || ',' || all_feats || ',' || buildings || ',' || "
        f"highways || ',' || amenities || ',' || other || ',' || mappers FROM ({WEEKLY}) "
        f"UNION ALL SELECT 'activity-dashboard/activity.json', value FROM ({CHAPTERS_JSON})",
    ),
    "rollup_geometry": _with(
        [*EVENTS_ACTIVITY, DAILY],
        f"SELECT h3, created_at, chapter_id, a3, '0101000000' || {_wkb_hex('lon')} || {_wkb_hex('lat')} AS geometry "
        f"FROM ({PUBLIC})",
    ),
    "monthly_positions": _with(
        [*ORDERS_ACTIVITY, DAILY],
        f"SELECT row_number() OVER (ORDER BY month) - 1 AS position, month, users FROM ({MONTHLY})",
    ),
    "country_positions": _with(
        ORDERS_ACTIVITY,
        "SELECT row_number() OVER (ORDER BY all_feats DESC, month, country) - 1 AS position, * "
        f"FROM ({_country_months('2001-04-01')})",
    ),
    "chapter_positions": _with(
        EVENTS_ACTIVITY,
        f"SELECT row_number() OVER (ORDER BY chapter, chapter_id) - 1 AS position, chapter, chapter_id FROM ({CHAPTERS})",
    ),
    "top_positions": _with(ORDERS_ACTIVITY, f"SELECT *, rank - 1 AS position FROM ({TOP})"),
}
