"""The evaluation clock: instants at which silence is judged."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.config import DEFAULTS, Settings
from tidewatch.functions.time import explode_ticks, first_tick_after
from tidewatch.operators.cells import WHOLE_SERIES, Grain, add_cell, neighbours
from tidewatch.operators.hysteresis import ORDER


def silence_at_ticks(
    points: DataFrame,
    as_of_ms: int,
    grain: Grain = WHOLE_SERIES,
    settings: Settings = DEFAULTS,
    keys: Sequence[str] = ("series_key",),
) -> DataFrame:
    """Every (series, tick) at which the series has been silent for longer than the limit.

    Each point yields the ticks of the gap that follows it, so no tick is compared with all series.
    """
    rows = neighbours(add_cell(points, grain), list(keys), ORDER, grain, after={"next_ts_ms": "ts_ms"})
    first = first_tick_after(F.col("ts_ms") + F.lit(settings.absence_limit_ms), settings.tick_ms)
    last = F.least(F.lit(as_of_ms), F.col("next_ts_ms") - 1)
    due = explode_ticks(rows, first, last, settings.tick_ms, "tick_ms")
    return due.select(*keys, F.col("ts_ms").alias("last_seen_ms"), "tick_ms")
