"""Working tables in the shared checkpoint folder and how long they live (K9)."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from editpulse.session import checkpoint_dir
from editpulse.sources.storage import file_system, hadoop_path

# Folders of the runs that are open, the innermost last.
_open_runs: list[str] = []


@contextmanager
def working_run(spark: SparkSession) -> Iterator[str]:
    """Working tables made inside live in one folder, which goes when the run succeeds.

    After a failure the folder stays, so that the tables can be looked at; its path is
    added to the error. Nothing read from them may be used after the run.
    """
    folder = f"{checkpoint_dir(spark).rstrip('/')}/run-{uuid.uuid4().hex}"
    _open_runs.append(folder)
    try:
        yield folder
    except BaseException as error:
        error.add_note(f"working tables are kept in {folder}")
        raise
    else:
        file_system(spark, folder).delete(hadoop_path(spark, folder), True)
    finally:
        _open_runs.remove(folder)


def working_folder(spark: SparkSession, name: str) -> str:
    """A new path in the open run's folder, or in one that is removed when the application ends."""
    if _open_runs:
        return f"{_open_runs[-1]}/{name}-{uuid.uuid4().hex}"
    folder = f"{checkpoint_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}"
    files = file_system(spark, folder)
    files.mkdirs(hadoop_path(spark, folder))
    files.deleteOnExit(hadoop_path(spark, folder))
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def working_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Lineage ends there: each use scans only the columns it needs, and a lost
    executor costs a re-read, not a recomputation. Every call writes anew, so no
    run sees a stale table.
    """
    spark = df.sparkSession
    path = working_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files and broadcasts of finished steps. It does so when the
    driver collects garbage, which may come after several steps have left theirs."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
