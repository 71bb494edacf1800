"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# UTC keeps ORC wall-clock timestamps unchanged; partition type inference would
# turn the string `ds` into a DATE; the rest lets AQE size partitions and split
# hot join keys.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.orc.filterPushdown": "true",
    # call-site capture costs a few round trips per Column operation
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "editpulse", master: str | None = None, **extra: str) -> SparkSession:
    """Create (or get) a session with the library's settings; ``extra`` wins."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """Folder shared by all executors for written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only where that is unset
    (local tests) a temporary folder is made and set.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="editpulse-"))
    return context.getCheckpointDir()
