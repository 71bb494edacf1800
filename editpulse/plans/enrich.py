"""Raw changesets and element history -> enriched changesets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse.operators.changesets import CUTOFF, changeset_columns, member_semi_join
from editpulse.operators.rollup import metric_structs, rollup_for
from editpulse.operators.spatial import Index, locate, prepared_index
from editpulse.sources import sinks, tables
from editpulse.sources.working import working_run, working_table

ENRICHED_COLUMNS = (
    "id", "uid", "username", "created_at", "closed_at", "comment", "created_by",
    "imagery_used", "host", "source", "hashtags", "tags",
)


def enrich_changesets(
    changesets: DataFrame,
    history: DataFrame,
    members: DataFrame,
    index: Index,
    since: dt.date = CUTOFF,
    cell: float | None = None,
    members_ds: str | None = None,
) -> DataFrame:
    """One row per member changeset that has element history, with counters and country.

    ``index`` comes from `prepared_index`. A first pass reads only id, member and date
    of the changesets and writes the kept ids; their number decides how history is
    restricted, and ``ds`` is the newest date among them, with or without history.
    The second pass reads the other columns a caller asks for.
    """
    kept = member_semi_join(changesets, members, since, ds=members_ds)
    ids = working_table(
        kept.select("id", F.col("created_at").cast("timestamp_ntz").cast("date").alias("day")), "kept"
    )
    rows, newest = ids.agg(F.count("*"), F.max("day")).first()
    rollup = rollup_for(history, ids, rows)
    joined = changeset_columns(kept).join(rollup, F.col("id") == F.col("changeset"))
    located = locate(joined, index, cell)
    return located.select(
        *ENRICHED_COLUMNS,
        *metric_structs(),
        "bbox",
        "lon",
        "lat",
        "a3",
        "members_ds",
        F.lit(newest).cast("date").cast("string").alias("ds"),
    )


def run(
    spark: SparkSession,
    changesets: str,
    history: str,
    members: str,
    boundaries: str,
    output: str,
    since: dt.date = CUTOFF,
    keep_others: bool = False,
) -> None:
    """Read the four inputs, enrich, write the partitioned output."""
    with working_run(spark):
        newest = tables.newest_partition(spark, members)
        enriched = enrich_changesets(
            tables.read_changesets(spark, changesets),
            tables.read_history(spark, history),
            tables.read_members(spark, members, newest),
            prepared_index(tables.read_boundaries(spark, boundaries)),
            since,
            members_ds=newest,
        )
        sinks.write_partitioned(sinks.with_geometry(enriched), output, "ds", keep_others)
