"""Lookups of points in smaller tables, safe for keys that hold most of the points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.cells import TARGET_ROWS
from tidewatch.session import cut_lineage

BROADCAST_ROWS = 50_000


def lookup(
    points: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    max_rows: int = BROADCAST_ROWS,
    target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """Left join ``table`` (one row per combination of keys) to the points.

    The table is broadcast only when it was counted and found small.  Otherwise keys with more than
    ``target_rows`` points are cut into parts of about that size, and only their rows of the table are
    copied, once per part.
    """
    keys = list(keys)
    if table.limit(max_rows + 1).count() <= max_rows:
        return points.join(F.broadcast(table), keys, "left")
    sizes = points.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > target_rows)
    # Needed on both sides.  At most one row per ``target_rows`` points, so it can be broadcast.
    hot = F.broadcast(cut_lineage(sizes.select(*keys, F.ceil(F.col("_n") / target_rows).cast("int").alias("_parts"))))
    part = F.coalesce(F.pmod(F.xxhash64("seq"), F.col("_parts")), F.lit(0)).cast("int")
    divided = points.join(hot, keys, "left").withColumn("_part", part).drop("_parts")
    parts = F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)
    copies = table.join(hot, keys, "left").withColumn("_part", F.explode(parts)).drop("_parts")
    return divided.join(copies, [*keys, "_part"], "left").drop("_part")
