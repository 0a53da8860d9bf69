"""Scoring of points against the same hour of the days before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.config import (
    DEFAULTS,
    FIXED_THRESHOLD_WEIGHT,
    HOUR_MS,
    REACTION_CHECKS_OFF,
    REACTION_DOWN_ONLY,
    REACTION_LATE,
    REACTION_MUTED,
    REACTION_UP_ONLY,
    Settings,
)
from tidewatch.functions.time import hour_slot
from tidewatch.operators.baseline import hourly_baseline, reference_slots, reference_table
from tidewatch.operators.cells import WHOLE_SERIES, Grain


def with_effective_reaction(
    points: DataFrame, settings: Settings = DEFAULTS, late_before_ms: Column | None = None
) -> DataFrame:
    """Apply the engine's own codes: checks switched off, or a point that came too late."""
    reaction = F.col("reaction")
    muted = reaction == REACTION_MUTED
    if late_before_ms is not None:
        reaction = F.when(~muted & (F.col("ts_ms") < late_before_ms), F.lit(REACTION_LATE)).otherwise(reaction)
    if not settings.checks_enabled:
        reaction = F.when(~muted, F.lit(REACTION_CHECKS_OFF)).otherwise(reaction)
    return points.withColumn("reaction", reaction.cast("int"))


def baseline_join(points: DataFrame, baseline: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """One row per point and day back, with a NULL baseline where there is none."""
    days = F.sequence(F.lit(1), F.lit(settings.baseline_days))
    probes = points.select("*", hour_slot(F.col("ts_ms")).alias("slot_ms"), F.explode(days).alias("day"))
    return probes.join(reference_slots(baseline, settings), ["series_key", "slot_ms", "day"], "left")


def _attach_references(points: DataFrame, references: DataFrame, grain: Grain) -> DataFrame:
    """Join each point to its one reference row.

    A series with cells shorter than an hour is dealt over as many parts as an hour has cells, by a hash of the
    point's number, so points of one instant are spread too; its few reference rows are copied to each part.
    """
    probes = points.withColumn("slot_ms", hour_slot(F.col("ts_ms")))
    fine = [(key, -(-HOUR_MS // step)) for key, step in grain.listed if step < HOUR_MS]
    default = -(-HOUR_MS // grain.default_ms) if grain.default_ms is not None and grain.default_ms < HOUR_MS else 1
    if not fine and default == 1:
        return probes.join(references, ["series_key", "slot_ms"], "left").drop("slot_ms")
    parts = F.lit(default)
    if fine:
        # The grain lists a bounded number of series.
        listed = F.broadcast(references.sparkSession.createDataFrame(fine, "series_key string, _parts int"))
        probes, references = (side.join(listed, "series_key", "left") for side in (probes, references))
        parts = F.coalesce("_parts", parts)
    probes = probes.withColumn("_part", F.pmod(F.xxhash64("seq"), parts).cast("int")).drop("_parts")
    references = references.withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    return probes.join(references, ["series_key", "slot_ms", "_part"], "left").drop("_part", "slot_ms")


def score_columns(settings: Settings = DEFAULTS) -> dict[str, Column]:
    """Weight and mean percent deviation of a point that carries its reference columns.

    A missing baseline casts no vote but still counts in the mean.
    """
    up, down = f"reaction <> {REACTION_DOWN_ONLY}", f"reaction <> {REACTION_UP_ONLY}"
    rises, falls, percents = [], [], []
    for day in range(1, settings.baseline_days + 1):
        # The slot lies a whole number of days back, so the weekday repeats every seventh day.
        vote = 2 if day % 7 == 0 else 1
        rises += [f"if(value > high_{day}, {vote}, 0)", f"if(value > max_{day}, {vote}, 0)"]
        falls += [f"if(value < min_{day}, {vote}, 0)", f"if(value < low_{day}, {vote}, 0)"]
        pct = f"coalesce((value - avg_{day}) / nullif(avg_{day}, 0D) * 100D, 0D)"
        percents += [f"if(({up} AND value > high_{day}) OR ({down} AND value < min_{day}), {pct}, 0D)"]
    relative = f"reaction BETWEEN {REACTION_UP_ONLY} AND 0"
    exceeded = "reaction > 0 AND value > reaction"
    weight = f"if({up}, {' + '.join(rises)}, 0) - if({down}, {' + '.join(falls)}, 0)"
    total = f"if(value <> 0, {' + '.join(percents)}, 0D)"
    return {
        "n_refs": F.expr("coalesce(n_refs, 0)"),
        "weight": F.expr(f"CASE WHEN {relative} THEN {weight} WHEN {exceeded} THEN {FIXED_THRESHOLD_WEIGHT} ELSE 0 END"),
        "weight_pct": F.expr(
            f"CASE WHEN {relative} THEN ({total}) / {settings.baseline_days}D WHEN {exceeded} THEN NULL ELSE 0D END"
        ),
    }


def score_points(
    points: DataFrame,
    baseline: DataFrame | None = None,
    settings: Settings = DEFAULTS,
    grain: Grain = WHOLE_SERIES,
) -> DataFrame:
    """Add ``n_refs``, ``weight`` and ``weight_pct`` to every point.

    Without a stored ``baseline`` the hourly statistics of the points themselves are used.
    """
    baseline = hourly_baseline(points) if baseline is None else baseline
    joined = _attach_references(points, reference_table(baseline, settings), grain)
    scratch = [c for c in joined.columns if c.rpartition("_")[0] in ("avg", "high", "low", "min", "max")]
    return joined.withColumns(score_columns(settings)).drop(*scratch)
