"""Tag-map columns: extraction, splitting, residual map."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tag keys that get a column of their own.
EXTRACTED_KEYS = ("comment", "created_by", "hashtags", "host", "imagery_used", "source")


def tag(tags: Column, key: str) -> Column:
    """Value of one tag; NULL where the key or the map is missing."""
    return F.element_at(tags, F.lit(key))


def has_tag(tags: Column, key: str) -> Column:
    return tag(tags, key).isNotNull()


def hashtags(tags: Column) -> Column:
    """``;``-separated hashtags as an array; empty pieces stay, a missing tag is NULL."""
    return F.split(tag(tags, "hashtags"), ";")


def other_tags(tags: Column, drop: tuple[str, ...] = EXTRACTED_KEYS) -> Column:
    """Map without the extracted keys."""
    return F.map_filter(tags, lambda key, _: ~key.isin(*drop))


def null_if_empty(tags: Column) -> Column:
    return F.when(F.size(tags) > 0, tags)
