"""External tables over existing folders and their partitions."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from editpulse import schemas
from editpulse.sources.storage import partitions

# table -> (schema, format, partition column)
TABLES: dict[str, tuple[T.StructType, str, str | None]] = {
    "changesets": (schemas.CHANGESETS, "orc", None),
    "planet_history": (schemas.ELEMENTS, "orc", None),
    "planet": (schemas.ELEMENTS, "orc", None),
    "boundaries": (schemas.BOUNDARIES, "parquet", None),
    "members": (schemas.MEMBERS, "parquet", "ds"),
    "enriched_changesets": (schemas.ENRICHED, "parquet", "ds"),
}


# Partitions named in one statement.
PARTITIONS_AT_ONCE = 100


def _text(value: str) -> str:
    """``value`` as a SQL literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def register_table(spark: SparkSession, table: str, location: str, database: str = "default") -> str:
    """Create an external table if missing and pick up its partitions; repeatable.

    Boundary files name some struct fields otherwise than the table does, and Spark matches
    Parquet fields by name. So their table takes its columns from the files, and the name given
    back is a view on it that renames struct fields by position.
    """
    schema, fmt, partition = TABLES[table]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    name = f"`{database}`.`{table}`"
    if table == "boundaries":
        files = f"`{database}`.`{table}_files`"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {files} USING {fmt} LOCATION {_text(location)}")
        known = spark.table(files).columns
        columns = ", ".join(
            f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields if f.name in known
        )
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM {files}")
        return name
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    partitioned = f"PARTITIONED BY (`{partition}`)" if partition else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt} {partitioned} LOCATION {_text(location)}")
    if partition:
        add_partitions(spark, name, location, partition)
    return name


def add_partitions(spark: SparkSession, name: str, location: str, column: str) -> list[str]:
    """Register every ``column=value`` folder with files in it; known ones are left alone.

    The folders come from listings, so nothing is read, and a folder that holds no file yet is
    not registered before it does.
    """
    found = list(partitions(spark, location, column).items())
    for at in range(0, len(found), PARTITIONS_AT_ONCE):
        clauses = " ".join(
            f"PARTITION (`{column}` = {_text(value)}) LOCATION {_text(folder)}"
            for value, folder in found[at : at + PARTITIONS_AT_ONCE]
        )
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {clauses}")
    return [value for value, _ in found]
