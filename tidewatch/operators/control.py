"""Control messages: decoding, and the points each of them takes effect on."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.config import (
    ACTION_DELETE_SERIES,
    ACTION_RESET_REGRESSION,
    ACTION_UPDATE_LEVELS,
    DEFAULTS,
    Settings,
)
from tidewatch.operators.cells import WHOLE_SERIES, Grain, add_cell, neighbours, running
from tidewatch.operators.joins import BROADCAST_ROWS, lookup
from tidewatch.functions.steps import recurrence_text
from tidewatch.operators.levels import attach_rules, decode_levels, names_no_level

_MESSAGE = "action string, hash string, UUID string, changedata string"
FEW_CONTROLS = 64
ACTIONS = (ACTION_DELETE_SERIES, ACTION_RESET_REGRESSION, ACTION_UPDATE_LEVELS)


def decode_control(messages: DataFrame) -> DataFrame:
    """Decode (``ts_ms``, ``seq``, ``value``) messages; unknown actions are ignored.

    ``changedata`` is JSON within JSON.  ``reason`` is set where the message cannot be carried out.
    """
    decoded = messages.select("ts_ms", "seq", "value", F.from_json("value", _MESSAGE).alias("_m")).select(
        "ts_ms",
        "seq",
        "value",
        F.col("_m.action").alias("action"),
        F.col("_m.hash").try_cast("bigint").alias("hash"),
        F.col("_m.UUID").alias("uuid"),
        F.col("_m.changedata").alias("changedata"),
    )
    known = decoded.where(F.col("action").isin(*ACTIONS)).withColumn("rules", decode_levels(F.col("changedata")))
    per_series = F.col("action") != ACTION_UPDATE_LEVELS
    reason = (
        F.when(per_series & F.col("hash").isNull(), F.lit("missing_hash"))
        .when(~per_series & F.col("uuid").isNull(), F.lit("missing_uuid"))
        .when(~per_series & names_no_level(F.col("changedata")), F.lit("bad_level"))
        .when(~per_series & F.col("rules").isNull(), F.lit("bad_changedata"))
    )
    return known.withColumn("reason", reason)


def good_controls(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("reason").isNull()).drop("reason", "value")


def control_dead_letters(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("reason").isNotNull()).select("ts_ms", "seq", "reason", F.col("value").alias("raw"))


def resolve_series(controls: DataFrame, catalog: DataFrame) -> DataFrame:
    """Replace the hash in series-level messages by the series it stands for."""
    names = catalog.select(F.col("series_hash").alias("hash"), "series_key")
    return controls.where(F.col("action") != ACTION_UPDATE_LEVELS).join(names, "hash")


def _few_per_key(controls: DataFrame, keys: Sequence[str]) -> bool:
    """Counted: no key has more than a handful of controls, and the keys fit a broadcast."""
    sizes = controls.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    found = sizes.agg(F.max("n").alias("most"), F.count(F.lit(1)).alias("keys")).first()
    return found["keys"] <= BROADCAST_ROWS and (found["most"] or 0) <= FEW_CONTROLS


def count_before(
    points: DataFrame,
    controls: DataFrame,
    counts: Mapping[str, Column],
    keys: Sequence[str] = ("series_key",),
    grain: Grain = WHOLE_SERIES,
    few: bool | None = None,
) -> DataFrame:
    """Add how many control rows of the same key lie at or before each point.

    ``counts`` maps a new column to the condition of the control rows it counts.  Points between two
    controls share a number, so it marks epochs: group ordered work by it and the work starts afresh
    at every control.

    A few controls per key are sent along as a broadcast list; otherwise points and controls are
    counted through in order.  ``few`` overrides the check.
    """
    keys = list(keys)
    flags = {f"_{out}": condition for out, condition in counts.items()}
    marks = controls.select(*keys, "ts_ms", "seq", *[c.alias(name) for name, c in flags.items()])
    if _few_per_key(controls, keys) if few is None else few:
        # Bounded by the count just taken: FEW_CONTROLS entries in each of BROADCAST_ROWS rows.
        lists = marks.groupBy(*keys).agg(*[F.collect_list(F.when(F.col(n), F.col("ts_ms"))).alias(n) for n in flags])
        joined = points.join(F.broadcast(lists), keys, "left")
        counted = {out: F.expr(f"coalesce(size(filter(_{out}, t -> t <= ts_ms)), 0)") for out in counts}
        return joined.withColumns(counted).drop(*flags)
    rows = points.withColumn("_is_control", F.lit(False)).unionByName(
        marks.withColumn("_is_control", F.lit(True)), allowMissingColumns=True
    )
    # At the same instant the control comes first.
    order = ["ts_ms", F.col("_is_control").desc(), "seq"]
    sums = {out: ("sum", F.coalesce(F.col(f"_{out}").cast("int"), F.lit(0))) for out in counts}
    counted = running(add_cell(rows, grain, by=keys[0]), keys, order, grain, sums).where(~F.col("_is_control"))
    return counted.withColumns({out: F.col(out).cast("int") for out in counts}).drop("_is_control", *flags)


def with_series_epochs(points: DataFrame, series_controls: DataFrame, grain: Grain = WHOLE_SERIES) -> DataFrame:
    """Add ``epoch`` (deletes so far) and ``fit_epoch`` (deletes and resets so far)."""
    counts = {"epoch": F.col("action") == ACTION_DELETE_SERIES, "fit_epoch": F.lit(True)}
    return count_before(points, series_controls, counts, grain=grain)


def level_versions(controls: DataFrame, grain: Grain = WHOLE_SERIES) -> DataFrame:
    """Versions of every tenant's rules: (uuid, version, valid_from_ms, valid_to_ms, rules).

    Version 1 starts with the tenant's first update; before it the stored or default rules hold.
    """
    updates = controls.where(F.col("action") == ACTION_UPDATE_LEVELS).select("uuid", "ts_ms", "seq", "rules")
    placed = add_cell(updates, grain, by="uuid")
    numbered = running(placed, ["uuid"], ["ts_ms", "seq"], grain, {"version": ("sum", F.lit(1))})
    ended = neighbours(numbered, ["uuid"], ["ts_ms", "seq"], grain, after={"valid_to_ms": "ts_ms"})
    return ended.select(
        "uuid", F.col("version").cast("int").alias("version"), F.col("ts_ms").alias("valid_from_ms"), "valid_to_ms", "rules"
    )


def with_rule_versions(points: DataFrame, controls: DataFrame, grain: Grain = WHOLE_SERIES) -> DataFrame:
    """Add ``version``, the number of updates to the tenant's rules up to each point.

    ``grain`` divides tenants, not series: measure it with ``by="uuid"``.
    """
    updates = controls.where(F.col("action") == ACTION_UPDATE_LEVELS)
    # A cell by series, if the points have one, is set aside for later.
    kept = points.withColumnRenamed("cell", "_series_cell")
    numbered = count_before(kept, updates, {"version": F.lit(True)}, ("uuid",), grain).drop("cell")
    return numbered.withColumnRenamed("_series_cell", "cell")


def attach_versioned_rules(
    points: DataFrame,
    controls: DataFrame,
    rules: DataFrame | None = None,
    grain: Grain = WHOLE_SERIES,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """Add the tenant's ``rules`` and their ``recurrences`` as they stood at each point's time.

    Points that carry their ``version`` already are only looked up.
    """
    numbered = points if "version" in points.columns else with_rule_versions(points, controls, grain)
    ruled = attach_rules(numbered, rules, settings)
    versions = level_versions(controls, grain).select(
        "uuid", "version", F.col("rules").alias("_rules"), recurrence_text(F.col("rules")).alias("_recurrences")
    )
    known = lookup(ruled, versions, ["uuid", "version"])
    updated = {c: F.coalesce(f"_{c}", c) for c in ("rules", "recurrences")}
    return known.withColumns(updated).drop("_rules", "_recurrences", "version")
