"""Running linear regression of value on time, and the deviation from its prediction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.numbers import percent_of
from tidewatch.functions.time import epoch_seconds
from tidewatch.operators.cells import WHOLE, WHOLE_SERIES, Grain, add_cell, cell_window
from tidewatch.operators.joins import lookup

_SUMS = ("n", "sx", "sy", "sxx", "sxy")


def _moments(x: str = "_x") -> dict:
    value, at = F.col("value"), F.col(x)
    return {
        "n": F.sum(F.lit(1.0)),
        "sx": F.sum(at),
        "sy": F.sum(value),
        "sxx": F.sum(at * at),
        "sxy": F.sum(at * value),
    }


def _shifted(prefix: str, by: str) -> dict:
    """Moments about an origin that lies ``by`` seconds earlier; every term is added, none cancels."""
    n, sx, sy, sxx, sxy = (F.col(prefix + name) for name in _SUMS)
    d = F.col(by)
    return {"n": n, "sx": sx + n * d, "sy": sy, "sxx": sxx + F.lit(2.0) * d * sx + n * d * d, "sxy": sxy + d * sy}


def regression_totals(points: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Moments of all points per key about the key's first second; enough to go on later."""
    second = epoch_seconds(F.col("ts_ms"))
    first = points.groupBy(*keys).agg(F.min(second).alias("origin_s"))
    # Two passes of map-side sums instead of one pass that holds a series in a task.
    placed = points.withColumn("_hour", F.col("ts_ms") - F.pmod("ts_ms", F.lit(3_600_000)))
    placed = placed.withColumn("_x", (second - epoch_seconds(F.col("_hour"))).cast("double"))
    hourly = placed.groupBy(*keys, "_hour").agg(*[e.alias(f"h_{c}") for c, e in _moments().items()])
    moved = hourly.join(first, [*keys]).withColumn("_d", (epoch_seconds(F.col("_hour")) - F.col("origin_s")).cast("double"))
    shifted = moved.select(*keys, "origin_s", *[e.alias(c) for c, e in _shifted("h_", "_d").items()])
    return shifted.groupBy(*keys, "origin_s").agg(*[F.sum(c).alias(c) for c in _SUMS])


def moved_totals(totals: DataFrame, keys: Sequence[str], by: str = "_gap") -> DataFrame:
    """Totals about origins ``by`` seconds after the first one of their key, summed about that one."""
    shifted = totals.select(*keys, "origin_s", *[e.alias(c) for c, e in _shifted("", by).items()])
    return shifted.groupBy(*keys).agg(F.min("origin_s").alias("origin_s"), *[F.sum(c).alias(c) for c in _SUMS])


def running_regression(
    points: DataFrame,
    grain: Grain = WHOLE_SERIES,
    keys: Sequence[str] = ("series_key",),
    earlier: DataFrame | None = None,
) -> DataFrame:
    """Add ``slope``, ``predicted`` and ``predict_pct`` from the fit of all points so far.

    The current point takes part in the fit.  One point, or points of a single second, give no fit and
    a deviation of 0.  Sums are taken about the first second of the series to keep their digits.
    ``earlier`` holds the stored totals of points that came before, to go on from.
    """
    keys = list(keys)
    order = ["ts_ms", "seq"]
    placed = points if "cell" in points.columns else add_cell(points, grain)
    running = cell_window(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    second = epoch_seconds(F.col("ts_ms"))
    start = F.when(F.col("cell") == F.lit(WHOLE), F.first(second).over(running)).otherwise(epoch_seconds(F.col("cell")))
    placed = placed.withColumn("_start", start).withColumn("_x", (second - F.col("_start")).cast("double"))
    sums = placed.withColumns({f"w_{c}": e.over(running) for c, e in _moments().items()})
    if grain.whole:
        sums = sums.withColumn("_at", F.col("_x")).withColumn("_origin", F.col("_start"))
        total = {c: F.col(f"w_{c}") for c in _SUMS}
    else:
        cells = (
            points_of_cells(points, grain)
            .groupBy(*keys, "cell")
            .agg(F.min(second).alias("_first"), *[e.alias(f"c_{c}") for c, e in _moments().items()])
        )
        whole = Window.partitionBy(*keys)
        cells = cells.withColumn("_origin", F.min("_first").over(whole)).withColumn(
            "_d", (epoch_seconds(F.col("cell")) - F.col("_origin")).cast("double")
        )
        before = whole.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        shifted = _shifted("c_", "_d")
        carried = cells.select(*keys, "cell", "_d", *[F.sum(shifted[c]).over(before).alias(f"p_{c}") for c in _SUMS])
        sums = sums.join(carried, [*keys, "cell"], "left").withColumn("_d", F.coalesce("_d", F.lit(0.0)))
        own = _shifted("w_", "_d")
        total = {c: own[c] + F.coalesce(f"p_{c}", F.lit(0.0)) for c in _SUMS}
        sums = sums.withColumn("_at", F.col("_x") + F.col("_d")).withColumn("_origin", F.col("_start") - F.col("_d"))
    sums = sums.withColumns({f"t_{c}": e for c, e in total.items()})
    if earlier is not None:
        stored = earlier.select(*keys, F.col("origin_s").alias("_from"), *[F.col(c).alias(f"o_{c}") for c in _SUMS])
        sums = lookup(sums, stored, keys).withColumn(
            "_gap", F.coalesce(F.col("_origin") - F.col("_from"), F.lit(0)).cast("double")
        )
        joined = {f"t_{c}": e + F.coalesce(f"o_{c}", F.lit(0.0)) for c, e in _shifted("t_", "_gap").items()}
        sums = sums.withColumns({**joined, "_at": F.col("_at") + F.col("_gap")})
    n, sx, sy, sxx, sxy = (F.col(f"t_{c}") for c in _SUMS)
    spread = sxx - sx * sx / n
    slope = (sxy - sx * sy / n) / F.nullif(spread, F.lit(0.0))
    fitted = sums.withColumn("slope", slope).withColumn("predicted", sy / n + F.col("slope") * (F.col("_at") - sx / n))
    pct = F.coalesce(percent_of(F.col("value"), F.col("predicted")), F.lit(0.0))
    return fitted.withColumn("predict_pct", pct).drop(
        "_start", "_x", "_at", "_d", "_origin", "_from", "_gap", *[p + c for p in ("w_", "p_", "t_", "o_") for c in _SUMS]
    )


def points_of_cells(points: DataFrame, grain: Grain) -> DataFrame:
    """Points of divided series with ``_x``, the seconds since the start of their cell."""
    placed = points if "cell" in points.columns else add_cell(points, grain)
    divided = placed.where(F.col("cell") != F.lit(WHOLE))
    return divided.withColumn("_x", (epoch_seconds(F.col("ts_ms")) - epoch_seconds(F.col("cell"))).cast("double"))
