"""Element history rolled up per changeset (A1) and its conditional structs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from editpulse.functions.metrics import int_struct, struct_if_any
from editpulse.functions.tags import has_tag
from editpulse.operators.sizing import BROADCAST_BYTES
from editpulse.sources.working import working_table

# Theme -> tag key, and group -> element type.
THEME_TAG = {"buildings": "building", "highways": "highway", "amenities": "amenity"}
KIND_TYPE = {"nodes": "node", "ways": "way", "relations": "relation"}


def counters() -> dict[str, Column]:
    """The 22 conditional counts, keyed by output name.

    Themes and element kinds ignore ``visible``, so a deleted element of a later
    version counts as edited too; ``new_features`` ignores it as well. A NULL tag
    map satisfies no tag condition.
    """
    first, later = F.col("version") == 1, F.col("version") > 1
    visible, tags = F.col("visible"), F.col("tags")
    tagged, untagged = F.size(tags) > 0, F.size(tags) == 0
    vertex = visible & (F.col("type") == "node") & untagged
    rules: dict[str, Column] = {}
    for theme, key in THEME_TAG.items():
        rules[f"new_{theme}"] = has_tag(tags, key) & first
        rules[f"edited_{theme}"] = has_tag(tags, key) & later
    for kind, name in KIND_TYPE.items():
        is_kind = F.col("type") == name
        rules[f"new_{kind}"] = is_kind & first
        rules[f"edited_{kind}"] = is_kind & later
        rules[f"deleted_{kind}"] = is_kind & ~visible
    rules["new_elements"] = visible & first
    rules["edited_elements"] = visible & later
    rules["deleted_elements"] = ~visible
    rules["new_vertices"] = vertex & first
    rules["edited_vertices"] = vertex & later
    rules["new_features"] = first & tagged
    rules["edited_features"] = visible & later & tagged
    return rules


def changeset_rollup(history: DataFrame) -> DataFrame:
    """One row per changeset with 22 counts.

    Counts combine on the map side, so a changeset holding much of the history
    reaches its reducer as one partial row per input task.
    """
    return history.groupBy("changeset").agg(
        *[F.count_if(rule).alias(name) for name, rule in counters().items()]
    )


# Ids one row of a bitmap stands for, and the size of such a row.
BITMAP_IDS, BITMAP_BYTES = 32_768, 4_200


def id_bitmap(ids: DataFrame, column: str = "id") -> DataFrame:
    """``bucket, words``: one bit per id, 512 longs for every 32,768 consecutive ids that occur.

    Its size follows the range of the ids, not their number.
    """
    held = ids.groupBy(F.bitmap_bucket_number(column).alias("bucket")).agg(
        F.hex(F.bitmap_construct_agg(F.bitmap_bit_position(column))).alias("bits")
    )
    words = F.expr(f"transform(sequence(0, {BITMAP_IDS // 64 - 1}), i -> cast(conv(substr(bits, 16 * i + 1, 16), 16, -10) AS bigint))")
    return held.select("bucket", words.alias("words"))


def in_bitmap(rows: DataFrame, bitmap: DataFrame, column: str) -> DataFrame:
    """Rows whose id has its bit set; ``bitmap`` is small enough to broadcast."""
    at = F.bitmap_bit_position(column).cast("int")
    # a word's eight bytes stand in order of position, the first one highest
    bit = (7 - F.shiftright(at, 3).bitwiseAND(7)) * 8 + at.bitwiseAND(7)
    isset = F.getbit(F.get(F.col("words"), F.shiftright(at, 6)), bit) == 1
    same = F.bitmap_bucket_number(column) == F.col("bucket")
    return rows.join(F.broadcast(bitmap), same & isset, "left_semi")


def rollup_for(
    history: DataFrame,
    kept: DataFrame,
    kept_rows: int,
    broadcast_limit: int = BROADCAST_BYTES,
    bitmap_limit: int | None = None,
) -> DataFrame:
    """Rollup of the history that belongs to the ``kept`` changeset ids.

    Few ids: they are broadcast and history is filtered in the scan stage, before
    anything is shuffled. More ids: a bitmap of them is written, and if it is small enough
    (a billion consecutive ids fit the limit), it is broadcast and filters as exactly. Beyond that history
    is aggregated first, so what is shuffled are partial counts and no changeset can be hot, and the
    counts, already exchanged on the changeset id, are joined with the ids. (A semi-join
    there would be pushed below the aggregate.) All ways give the same rows.
    """
    ids = kept.select(F.col("id").alias("changeset"))
    if kept_rows * 32 <= broadcast_limit:
        return changeset_rollup(history.join(F.broadcast(ids), "changeset", "left_semi"))
    limit = broadcast_limit if bitmap_limit is None else bitmap_limit
    if limit:
        bitmap = working_table(id_bitmap(ids, "changeset"), "bitmap")
        if bitmap.count() * BITMAP_BYTES <= limit:
            return changeset_rollup(in_bitmap(history, bitmap, "changeset"))
    return changeset_rollup(history).join(ids.distinct().hint("merge"), "changeset")


def _group(name: str) -> dict[str, Column]:
    fields = ("new", "edited", "deleted") if name in KIND_TYPE else ("new", "edited")
    return {field: F.col(f"{field}_{name}") for field in fields}


def metric_structs() -> list[Column]:
    """Counter structs of the enriched row; groups without any count are NULL."""
    conditional = [struct_if_any(**_group(name)).alias(name) for name in (*THEME_TAG, *KIND_TYPE)]
    elements = int_struct(
        new=F.col("new_elements"),
        edited=F.col("edited_elements"),
        deleted=F.col("deleted_elements"),
        num_changes=F.col("num_changes"),
    ).alias("elements")
    features = int_struct(
        new=F.col("new_features"),
        edited=F.col("edited_features"),
        new_vertices=F.col("new_vertices"),
        edited_vertices=F.col("edited_vertices"),
    ).alias("features")
    return [*conditional, elements, features]
