"""Identity of a series: its name and its tags in canonical order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_tags(tags: Column) -> Column:
    """JSON text of the tags, sorted by tag name."""
    return F.to_json(F.map_from_entries(F.sort_array(F.map_entries(tags))))


def series_key(name: Column, tags: Column) -> Column:
    return F.concat_ws("|", name, canonical_tags(tags))


def series_hash(key: Column) -> Column:
    """A 64-bit handle for display and control messages; never a join key for points."""
    return F.xxhash64(key)
