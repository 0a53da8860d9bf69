"""Hourly baseline statistics, and the reference table a point is scored against."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.config import DAY_MS, DEFAULTS, HOUR_MS, Settings
from tidewatch.functions.time import hour_slot, weekday


def hourly_baseline(points: DataFrame) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum per series and UTC hour."""
    return (
        points.groupBy("series_key", hour_slot(F.col("ts_ms")).alias("slot_ms"))
        .agg(
            F.count("value").alias("n"),
            F.avg("value").alias("avg"),
            F.coalesce(F.stddev_samp("value"), F.lit(0.0)).alias("dev"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        )
        .where(F.col("n") > 0)
    )


def slot_moments(points: DataFrame) -> DataFrame:
    """Count, mean, sum of squared deviations, minimum and maximum per series and UTC hour: baselines that can be merged."""
    found = points.groupBy("series_key", hour_slot(F.col("ts_ms")).alias("slot_ms")).agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        (F.var_pop("value") * F.count("value")).alias("m2"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    return found.where(F.col("n") > 0)


def merged_baseline(moments: DataFrame) -> DataFrame:
    """The hourly baseline of the points behind all moments of a series and hour.

    Means are merged by their distance, in order of ``batch``, so nothing cancels and the order of rows does not matter.  A
    series and hour has one row for each micro-batch that saw it.
    """
    parts = F.array_sort(F.collect_list(F.struct("batch", "n", "mean", "m2")))
    held = moments.groupBy("series_key", "slot_ms").agg(parts.alias("_parts"), F.min("min").alias("min"), F.max("max").alias("max"))
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def merge(a, b):
        n, apart = a["n"] + b["n"], b["mean"] - a["mean"]
        return F.struct(
            n.alias("n"),
            (a["mean"] + apart * b["n"] / n).alias("mean"),
            (a["m2"] + b["m2"] + apart * apart * a["n"] * b["n"] / n).alias("m2"),
        )

    all_of = held.withColumn("_all", F.aggregate("_parts", start, merge))
    return all_of.select(
        "series_key",
        "slot_ms",
        F.col("_all.n").alias("n"),
        F.col("_all.mean").alias("avg"),
        F.when(F.col("_all.n") > 1, F.sqrt(F.col("_all.m2") / (F.col("_all.n") - 1))).otherwise(F.lit(0.0)).alias("dev"),
        "min",
        "max",
    )


def points_between(points: DataFrame, start_ms: int, end_ms: int) -> DataFrame:
    """Points in the closed range.

    ``ts_ms`` reaches the scan of tables that store it; where it is computed, give the source the range as well.
    """
    return points.where(F.col("ts_ms").between(start_ms, end_ms))


def wanted_slots(points: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Slots to prepare for these points: one hour ahead of need, on each earlier day."""
    ahead = hour_slot(F.col("ts_ms") + F.lit(HOUR_MS)).alias("ahead_ms")
    seen = points.select("series_key", ahead).distinct()
    days = F.sequence(F.lit(1), F.lit(settings.baseline_days))
    return (
        seen.select("series_key", "ahead_ms", F.explode(days).alias("day"))
        .select("series_key", (F.col("ahead_ms") - F.col("day") * F.lit(DAY_MS)).alias("slot_ms"))
        .distinct()
    )


def missing_slots(wanted: DataFrame, stored: DataFrame) -> DataFrame:
    """Wanted slots with neither a baseline nor a no-data marker."""
    return wanted.join(stored.select("series_key", "slot_ms"), ["series_key", "slot_ms"], "left_anti")


def build_missing(wanted: DataFrame, stored: DataFrame, points: DataFrame) -> DataFrame:
    """Baselines for the missing slots; a slot without points yields a marker row with n = 0.

    A stored slot is never computed again, so points that arrive later do not change it.
    """
    missing = missing_slots(wanted, stored)
    # Aggregate first: the join then meets one row per slot, not one per point.
    return missing.join(hourly_baseline(points), ["series_key", "slot_ms"], "left").withColumn(
        "n", F.coalesce("n", F.lit(0)).cast("bigint")
    )


def referred_slots(points: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """(series_key, slot_ms) of the baselines that these points are scored against."""
    seen = points.select("series_key", hour_slot(F.col("ts_ms")).alias("_slot")).distinct()
    days = F.sequence(F.lit(1), F.lit(settings.baseline_days))
    moved = seen.select("series_key", "_slot", F.explode(days).alias("_day"))
    return moved.select("series_key", (F.col("_slot") - F.col("_day") * F.lit(DAY_MS)).alias("slot_ms")).distinct()


def reference_slots(baseline: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Baselines moved to the later slots they serve, one row per (series, slot, day back)."""
    days = F.sequence(F.lit(1), F.lit(settings.baseline_days))
    moved = baseline.where(F.col("n") > 0).select("*", F.explode(days).alias("day"))
    target = F.col("slot_ms") + F.col("day") * F.lit(DAY_MS)
    return moved.select(
        "series_key",
        target.alias("slot_ms"),
        "day",
        F.when(weekday(F.col("slot_ms")) == weekday(target), F.lit(2)).otherwise(F.lit(1)).alias("vote"),
        "avg",
        "dev",
        "min",
        "max",
    )


def reference_table(baseline: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """One row per (series, slot) with the baselines of the earlier days side by side.

    Built from the hourly table, so a point joins a single row instead of being copied once per day.
    """
    factor = float(settings.deviation_factor)
    sources = {"avg": "avg", "high": f"avg + {factor}D * dev", "low": f"avg - {factor}D * dev", "min": "min", "max": "max"}
    columns = [F.expr("cast(count(1) as int) AS n_refs")]
    for day in range(1, settings.baseline_days + 1):
        columns += [F.expr(f"max(CASE WHEN day = {day} THEN {sql} END) AS {name}_{day}") for name, sql in sources.items()]
    return reference_slots(baseline, settings).groupBy("series_key", "slot_ms").agg(*columns)
