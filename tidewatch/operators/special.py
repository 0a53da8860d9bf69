"""Points that carry their own status, and the timers that close or raise them.

Time of arrival is the point's own time here, so rows are ordered by (time, sequence).  Timers are
looked at on clock ticks only: a timer that runs out between two ticks fires on the later one, and
does not fire at all when a newer point comes first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.config import ACTION_DELETE_SERIES, DEFAULTS, NO_LEVEL, SEVERE_LEVEL, Settings
from tidewatch.functions.time import explode_ticks, first_tick_after
from tidewatch.operators.cells import WHOLE_SERIES, Grain, add_cell, neighbours, running
from tidewatch.operators.control import count_before
from tidewatch.operators.hysteresis import ORDER, state_code
from tidewatch.operators.joins import lookup
from tidewatch.operators.levels import with_status_level

_EVENT = ("kind", "event_ms", "prev_level", "state_level", "state")


def unknown_status(points: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Special points whose status stands for no level; they belong in the dead letter."""
    return with_status_level(points, settings).where(F.col("status_level").isNull()).drop("status_level")


def _fires_at(ts: Column, reaction: Column, settings: Settings) -> Column:
    return first_tick_after(ts + F.abs(reaction).cast("bigint") * F.lit(60_000), settings.tick_ms)


def with_neighbour_status(
    points: DataFrame,
    grain: Grain = WHOLE_SERIES,
    keys: Sequence[str] = ("series_key",),
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """Known-status points with the previous point's time, reaction and level and the next one's time."""
    known = with_status_level(points, settings).where(F.col("status_level").isNotNull())
    before = {"prev_ts_ms": "ts_ms", "prev_reaction": "reaction", "prev_status_level": "status_level"}
    placed = known if "cell" in known.columns else add_cell(known, grain)
    return neighbours(placed, list(keys), ORDER, grain, before, {"next_ts_ms": "ts_ms"}).drop("cell")


def _as_event(rows: DataFrame, kind: str, at: Column, before: Column, after: Column) -> DataFrame:
    return rows.withColumns(
        {"kind": F.lit(kind), "event_ms": at, "prev_level": before.cast("int"), "state_level": after.cast("int")}
    ).withColumn("state", state_code(F.col("prev_level"), F.col("state_level")))


def status_events(neighbour_status: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """One event per point: its status level, after whatever timers did since the point before."""
    fired = _fires_at(F.col("prev_ts_ms"), F.col("prev_reaction"), settings) < F.col("ts_ms")
    before = (
        F.when(fired & (F.col("prev_reaction") < 0), F.lit(NO_LEVEL))
        .when(fired & (F.col("prev_reaction") > 0), F.lit(SEVERE_LEVEL))
        .otherwise(F.coalesce("prev_status_level", F.lit(NO_LEVEL)))
    )
    return _as_event(neighbour_status, "status", F.col("ts_ms"), before, F.col("status_level"))


def autoclose_events(neighbour_status: DataFrame, as_of_ms: int, settings: Settings = DEFAULTS) -> DataFrame:
    """A negative reaction ends the alert after that many minutes without a newer point, once."""
    at = _fires_at(F.col("ts_ms"), F.col("reaction"), settings)
    due = (F.col("reaction") < 0) & (at <= as_of_ms) & F.coalesce(at < F.col("next_ts_ms"), F.lit(True))
    return _as_event(neighbour_status.where(due), "autoclose", at, F.col("status_level"), F.lit(NO_LEVEL))


def deadman_events(
    neighbour_status: DataFrame, as_of_ms: int, settings: Settings = DEFAULTS, first_only: bool = False
) -> DataFrame:
    """A positive reaction raises the top level after that many minutes of silence.

    The alert repeats on every tick until the next point, or up to ``as_of_ms``.
    """
    first = _fires_at(F.col("ts_ms"), F.col("reaction"), settings)
    last = F.least(F.lit(as_of_ms), F.col("next_ts_ms") - 1)
    due = neighbour_status.where((F.col("reaction") > 0) & (first <= last))
    if first_only:
        return _as_event(due, "deadman", first, F.col("status_level"), F.lit(SEVERE_LEVEL))
    repeated = explode_ticks(due, first, last, settings.tick_ms, "_tick")
    before = F.when(F.col("_tick") == first, F.col("status_level")).otherwise(F.lit(SEVERE_LEVEL))
    return _as_event(repeated, "deadman", F.col("_tick"), before, F.lit(SEVERE_LEVEL)).drop("_tick")


def _until_delete(rows: DataFrame, deletes: DataFrame, grain: Grain) -> DataFrame:
    """End each epoch's last point at the delete that ends the epoch: its timers are forgotten from then on."""
    numbered = running(add_cell(deletes, grain), ["series_key"], ["ts_ms", "seq"], grain, {"epoch": ("sum", F.lit(1))})
    ends = numbered.select("series_key", (F.col("epoch") - 1).cast("int").alias("epoch"), F.col("ts_ms").alias("_deleted_ms"))
    found = lookup(rows, ends, ["series_key", "epoch"])
    return found.withColumn("next_ts_ms", F.coalesce("next_ts_ms", "_deleted_ms")).drop("_deleted_ms")


def special_events(
    points: DataFrame,
    as_of_ms: int,
    grain: Grain = WHOLE_SERIES,
    keys: Sequence[str] = ("series_key",),
    settings: Settings = DEFAULTS,
    series_controls: DataFrame | None = None,
) -> DataFrame:
    """Status, auto-close and dead-man events of all special points.

    A delete among ``series_controls`` makes its series start anew, without a level, and stops its timers.
    """
    if series_controls is None:
        rows = with_neighbour_status(points, grain, keys, settings)
    else:
        deletes = series_controls.where(F.col("action") == ACTION_DELETE_SERIES).select("series_key", "ts_ms", "seq")
        epochs = count_before(points, deletes, {"epoch": F.lit(True)}, grain=grain)
        rows = with_neighbour_status(epochs, grain, [*keys, "epoch"], settings)
        rows = _until_delete(rows, deletes, grain)
    return (
        status_events(rows, settings)
        .unionByName(autoclose_events(rows, as_of_ms, settings))
        .unionByName(deadman_events(rows, as_of_ms, settings))
    )
