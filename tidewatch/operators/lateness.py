"""The engine's own lateness rule: a point is late by the highest event time that had arrived before it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.config import DEFAULTS, HOUR_MS, Settings
from tidewatch.operators.score import with_effective_reaction
from tidewatch.session import cut_lineage


def with_seen(points: DataFrame, order: str = "seq", seen_ms: int | None = None) -> DataFrame:
    """Add ``seen_ms``: the highest event time among all points that arrived before, NULL for the first one.

    Arrival is one order over all series, so no key divides the work.  Points are dealt to ranges of that order; the
    maximum of each range is carried on to the later ones, and each range is then gone through by itself.  ``seen_ms``
    is what had been seen before all of these points.  ``order`` has to be unique.
    """
    # Where a range ends is drawn from a sample: stored, it is the same for both readings.
    dealt = cut_lineage(points.repartitionByRange(order).withColumn("_range", F.spark_partition_id()))
    tops = dealt.groupBy("_range").agg(F.max("ts_ms").alias("_top"))
    # As many rows as there are ranges.
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = tops.select("_range", F.max("_top").over(earlier).alias("_carried"))
    within = Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    own = dealt.withColumn("_own", F.max("ts_ms").over(within)).join(F.broadcast(carried), "_range")
    seen = F.greatest("_own", "_carried", F.lit(seen_ms).cast("bigint"))
    return own.withColumn("seen_ms", seen).drop("_range", "_own", "_carried")


def late_before(allowed_ms: int) -> Column:
    """The event time before which a point with ``seen_ms`` is late."""
    return F.col("seen_ms") - F.lit(allowed_ms)


def with_late_reaction(
    points: DataFrame, allowed_ms: int = HOUR_MS, settings: Settings = DEFAULTS, order: str = "seq", seen_ms: int | None = None
) -> DataFrame:
    """Points of which those later than allowed carry the late reaction; muted ones stay muted."""
    return with_effective_reaction(with_seen(points, order, seen_ms), settings, late_before(allowed_ms)).drop("seen_ms")
