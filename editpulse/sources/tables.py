"""Readers with fixed schemas (S1-S6) and partition selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from editpulse import schemas
from editpulse.functions.grid import cell_of_point
from editpulse.functions.wkb import point_xy
from editpulse.sources.storage import partitions


def _read_orc(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """ORC files whose timestamps are wall-clock times without a zone.

    Spark's reader takes them as local times of the JVM. They come out as stored only if the
    session's zone is that of the JVMs, so any other setting is refused. (The driver is looked at;
    executors must be started with the same zone.)
    """
    zones = spark._jvm.java.time.ZoneId
    session, machine = zones.of(spark.conf.get("spark.sql.session.timeZone")), zones.systemDefault()
    if not session.getRules().equals(machine.getRules()):
        raise ValueError(
            f"ORC timestamps would be shifted: spark.sql.session.timeZone is {session}, the JVM's zone {machine}; "
            "set -Duser.timezone for driver and executors to the session's zone"
        )
    return spark.read.schema(schema).orc(path)


def read_changesets(spark: SparkSession, path: str) -> DataFrame:
    return _read_orc(spark, path, schemas.CHANGESETS)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """Element history; consumers select five columns, the ORC reader prunes the rest."""
    return _read_orc(spark, path, schemas.ELEMENTS)


def read_planet(spark: SparkSession, path: str) -> DataFrame:
    """Current elements: same layout as the history."""
    return _read_orc(spark, path, schemas.ELEMENTS)


def read_boundaries(spark: SparkSession, path: str) -> DataFrame:
    """Country boundaries; ``name``'s first field is always called ``primary`` here.

    Some files carry a garbled name for that field, so structs are matched by
    position.
    """
    return by_position(spark.read.parquet(path))


def by_position(raw: DataFrame) -> DataFrame:
    """Boundary columns with the declared names; struct fields are taken by position."""
    wanted = [f for f in schemas.BOUNDARIES.fields if f.name in raw.columns]
    return raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted])


def read_members(spark: SparkSession, path: str, ds: str | None = None) -> DataFrame:
    """Members of one ``ds`` partition or of all, with ``chapter_id`` as an alias of ``team_id``.

    ``ds`` is declared a string in the schema, so it is not inferred as a date; a given value is a
    literal partition filter, which leaves the other folders unread.
    """
    raw = spark.read.schema(schemas.MEMBERS).parquet(path)
    if ds is not None:
        raw = raw.where(F.col("ds") == ds)
    return raw.withColumn("chapter_id", F.col("team_id"))


def read_enriched(spark: SparkSession, path: str, ds: str | None = None) -> DataFrame:
    """One ``ds`` partition of the enriched changesets (the latest by default), with its cell.

    Tables without ``lon``/``lat`` get them from the WKB point; an existing ``h3``
    column is kept as it is.
    """
    raw = spark.read.parquet(path)
    if "ds" in raw.columns:
        raw = raw.withColumn("ds", F.col("ds").cast("string"))
        ds = ds or newest_partition(spark, path)
        raw = raw.where(F.col("ds") == ds) if ds else latest_partition(raw)
    if "lon" not in raw.columns:
        raw = raw.withColumn("_p", point_xy("geometry"))
        raw = raw.withColumns({"lon": F.col("_p.lon"), "lat": F.col("_p.lat")}).drop("_p")
    return with_cell(raw)


def with_cell(changesets: DataFrame) -> DataFrame:
    if "h3" in changesets.columns:
        return changesets
    return changesets.withColumn("h3", cell_of_point(F.col("lon"), F.col("lat"), 8))


def newest_partition(spark: SparkSession, path: str, column: str = "ds") -> str | None:
    """Largest ``column=value`` folder of a table with files in it, from listings; no file is opened.

    None if the table is not laid out in such folders.
    """
    return max(partitions(spark, path, column), default=None)


def latest_partition(df: DataFrame, column: str = "ds") -> DataFrame:
    """Rows of the newest partition; the scalar subquery prunes partitions at run time.

    For a table in a folder, `newest_partition` finds the value without reading anything.
    """
    return df.where(F.col(column) == df.select(F.max(column)).scalar())


def members_as_of(members: DataFrame, changesets: DataFrame) -> DataFrame:
    """Member rows of the snapshot the changesets were enriched with, not the newest one."""
    recorded = changesets.select(F.max("members_ds")).scalar()
    return members.where(F.col("ds") == recorded)
