"""Hosts that stop sending heartbeats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.config import DEFAULTS, NO_LEVEL, SEVERE_LEVEL, STATE_END, STATE_START, Settings
from tidewatch.functions.time import first_tick_after
from tidewatch.operators.cells import WHOLE_SERIES, Grain, add_cell, neighbours
from tidewatch.operators.hysteresis import ORDER


def absence_events(
    heartbeats: DataFrame,
    as_of_ms: int,
    grain: Grain = WHOLE_SERIES,
    keys: Sequence[str] = ("series_key",),
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """A severe event on the first clock tick past the limit, and its end with the next heartbeat.

    ``last_seen_ms`` is the heartbeat before the silence.  The event of the return carries its heartbeat's ``type``,
    ``reaction`` and ``value`` where there are such columns; a silence event has no point of its own.
    """
    keys = list(keys)
    kinds = {c: t for c, t in heartbeats.dtypes if c in ("type", "reaction", "value")}
    rows = neighbours(
        add_cell(heartbeats, grain), keys, ORDER, grain, {"prev_ts_ms": "ts_ms"}, {"next_ts_ms": "ts_ms"}
    ).drop("cell")
    limit = F.lit(settings.absence_limit_ms).cast("bigint")
    at = first_tick_after(F.col("ts_ms") + limit, settings.tick_ms)
    silent = rows.where((at <= as_of_ms) & F.coalesce(at < F.col("next_ts_ms"), F.lit(True))).select(
        *keys,
        "uuid",
        F.lit("absent").alias("kind"),
        at.alias("event_ms"),
        F.col("ts_ms").alias("last_seen_ms"),
        F.lit(NO_LEVEL).alias("prev_level"),
        F.lit(SEVERE_LEVEL).alias("state_level"),
        F.lit(STATE_START).alias("state"),
        *[F.lit(None).cast(t).alias(c) for c, t in kinds.items()],
    )
    back = rows.where(first_tick_after(F.col("prev_ts_ms") + limit, settings.tick_ms) < F.col("ts_ms")).select(
        *keys,
        "uuid",
        F.lit("back").alias("kind"),
        F.col("ts_ms").alias("event_ms"),
        F.col("prev_ts_ms").alias("last_seen_ms"),
        F.lit(SEVERE_LEVEL).alias("prev_level"),
        F.lit(NO_LEVEL).alias("state_level"),
        F.lit(STATE_END).alias("state"),
        *kinds,
    )
    return silent.unionByName(back)


def overdue(latest: DataFrame, as_of_ms: int, settings: Settings = DEFAULTS) -> DataFrame:
    """Of the latest point per series, those silent for too long at one instant of the clock."""
    silent_ms = F.lit(as_of_ms) - F.col("ts_ms")
    return latest.where(silent_ms > settings.absence_limit_ms).withColumn("silent_ms", silent_ms)
