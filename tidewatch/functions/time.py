"""Clock arithmetic on epoch milliseconds; needs no session time zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.config import DAY_MS, HOUR_MS


def floor_to(ms: Column, step: int | Column) -> Column:
    step = F.lit(step) if isinstance(step, int) else step
    return ms - F.pmod(ms, step)


def hour_slot(ms: Column) -> Column:
    """Start of the half-open UTC hour that holds ``ms``."""
    return floor_to(ms, F.lit(HOUR_MS).cast("bigint"))


def epoch_seconds(ms: Column) -> Column:
    """Whole seconds, rounding down."""
    return F.floor(ms / F.lit(1000)).cast("bigint")


def weekday(ms: Column) -> Column:
    """A day-of-week number (Thursday is 0), good for comparing two instants."""
    return F.pmod(F.floor(ms / F.lit(DAY_MS)).cast("bigint"), F.lit(7).cast("bigint"))


def to_timestamp(ms: Column) -> Column:
    return F.timestamp_millis(ms)


TICKS_AT_ONCE = 1024


def explode_ticks(rows: DataFrame, first: Column, last: Column, tick_ms: int, out: str) -> DataFrame:
    """One row per tick from ``first`` to ``last``, none where they are the wrong way round.

    Exploded by spans and then by ticks, so no row holds a long array: a year of minutes makes 514 spans of 1,024 ticks.
    """
    step = F.lit(tick_ms).cast("bigint")
    span = F.lit(tick_ms * TICKS_AT_ONCE).cast("bigint")
    spans = rows.withColumns({"_first": first, "_last": last}).where(F.col("_first") <= F.col("_last"))
    starts = F.expr(f"CASE WHEN _first <= _last THEN sequence(_first, _last, {tick_ms * TICKS_AT_ONCE}L) END")
    spans = spans.select("*", F.explode(starts).alias("_span"))
    end = F.least(F.col("_last"), F.col("_span") + span - step)
    ticks = F.when(F.col("_span") <= end, F.sequence("_span", end, step))
    return spans.select("*", F.explode(ticks).alias(out)).drop("_first", "_last", "_span")


def first_tick_after(ms: Column, tick_ms: int) -> Column:
    """The first clock tick strictly later than ``ms``."""
    return floor_to(ms, F.lit(tick_ms).cast("bigint")) + F.lit(tick_ms).cast("bigint")
