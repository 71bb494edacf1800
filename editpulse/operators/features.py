"""GeoJSON features and tile buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from editpulse.functions.geo import envelope_ring
from editpulse.functions.grid import tile_x, tile_y

BOX = ("xmin", "ymin", "xmax", "ymax")
# Layer -> (layer name, zoom).
LAYERS = {
    "coarse_4": ("r4agg", 2),
    "coarse_6": ("r6agg", 4),
    "points": ("daily", 6),
    "boxes": ("daily", 6),
}


def geometry_of(df: DataFrame) -> Column:
    """GeoJSON geometry struct: a polygon for box columns, else a point, null without coordinates."""
    if "xmin" in df.columns:
        ring = envelope_ring(*[F.col(c) for c in BOX])
        return F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates"))
    point = F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates"))
    return F.when(F.col("lon").isNotNull() & F.col("lat").isNotNull(), point)


def feature_lines(df: DataFrame) -> DataFrame:
    """One GeoJSON Feature per row as a text line; NULL properties stay as null."""
    properties = [c for c in df.columns if c not in (*BOX, "lon", "lat")]
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(*properties).alias("properties"),
        geometry_of(df).alias("geometry"),
    )
    return df.select(F.to_json(feature, {"ignoreNullFields": "false"}).alias("value"))


def tile_features(df: DataFrame, layer: str) -> DataFrame:
    """Features bucketed into the slippy tiles they fall in, one row per feature and tile.

    Points lie in one tile; a box is repeated for each tile it covers. Every feature
    with a place is kept; one without coordinates lies in no tile. The cell id is
    not part of a tile's attributes.
    """
    name, zoom = LAYERS[layer]
    if "xmin" in df.columns:
        columns = F.sequence(tile_x(F.col("xmin"), zoom), tile_x(F.col("xmax"), zoom))
        rows = F.sequence(tile_y(F.col("ymax"), zoom), tile_y(F.col("ymin"), zoom))
        placed = df.withColumn("x", F.explode(columns)).withColumn("y", F.explode(rows))
    else:
        placed = df.where(F.col("lon").isNotNull() & F.col("lat").isNotNull()).withColumns(
            {"x": tile_x(F.col("lon"), zoom), "y": tile_y(F.col("lat"), zoom)}
        )
    return placed.drop("h3").select(
        F.lit(zoom).alias("z"), "x", "y", F.lit(name).alias("layer"), *[c for c in df.columns if c != "h3"]
    )
