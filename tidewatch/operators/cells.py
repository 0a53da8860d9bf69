"""Ordered work on series of any length.

A window partitioned by series sends a whole series to one task, which does not
hold when a single series owns a third of all rows.  Long series are therefore
cut into time cells.  Rows are shuffled by (series, cell); what has to cross a
cell border travels in a table with one row per cell, which is as small as the
time range divided by the cell length, however many points there are:

* ``neighbours``  - the row before and after          (one edge row per cell)
* ``running``     - running sums, minima and maxima   (one total per cell)
* ``with_lookback`` - a frame of the last n rows      (n border rows per cell)

Series that fit one task stay whole and skip that exchange.  The cell length
never changes a result, only where the work is done.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidewatch.config import DAY_MS, HOUR_MS

WHOLE = -(2**62)
TARGET_ROWS = 2_000_000
MAX_LISTED = 1_000

# Cell lengths to choose from; those up to an hour divide the hour.
LADDER_MS = (
    30 * DAY_MS,
    7 * DAY_MS,
    DAY_MS,
    6 * HOUR_MS,
    HOUR_MS,
    15 * 60_000,
    5 * 60_000,
    60_000,
    10_000,
    1_000,
    100,
    10,
    1,
)


@dataclass(frozen=True)
class Grain:
    """Cell length for every series: a default and a short list of exceptions.

    ``None`` as default means "one cell per series".
    """

    default_ms: int | None = None
    listed: tuple[tuple[str, int], ...] = ()

    @property
    def whole(self) -> bool:
        return self.default_ms is None and not self.listed


WHOLE_SERIES = Grain()


def measure_grain(
    points: DataFrame, target_rows: int = TARGET_ROWS, max_listed: int = MAX_LISTED, by: str = "series_key"
) -> Grain:
    """Pick cell lengths so that no cell holds much more than ``target_rows`` rows.

    Counts are taken map-side; at most ``max_listed`` + 1 rows reach the driver.  Unless some series is
    longer than the target, a single count per series is all there is to it.
    """
    minute = 60_000
    lengths = points.groupBy(F.col(by).alias("series_key")).agg(F.count(F.lit(1)).alias("n"))
    long_series = lengths.where(F.col("n") > target_rows).select("series_key")
    if long_series.isEmpty():
        return WHOLE_SERIES
    placed = points.select(F.col(by).alias("series_key"), (F.col("ts_ms") - F.pmod("ts_ms", F.lit(minute))).alias("m"))
    per_minute = (
        placed.join(long_series, "series_key", "left_semi").groupBy("series_key", "m").agg(F.count(F.lit(1)).alias("n"))
    )
    per_hour = per_minute.groupBy("series_key", (F.col("m") - F.pmod("m", F.lit(HOUR_MS))).alias("h")).agg(
        F.sum("n").alias("n"), F.max("n").alias("peak")
    )
    per_series = per_hour.groupBy("series_key").agg(
        F.max("n").alias("hour"), F.max("peak").alias("minute")
    )
    choice = None
    for step in reversed(LADDER_MS):
        if step >= HOUR_MS:
            rows = F.col("hour") * F.lit(step / HOUR_MS)
        else:
            rows = F.col("minute") * F.lit(step / minute)
        fits = (rows <= F.lit(target_rows)) | F.lit(step == LADDER_MS[-1])
        choice = F.when(fits, F.lit(step)) if choice is None else F.when(fits, F.lit(step)).otherwise(choice)
    chosen = (
        per_series.select("series_key", choice.alias("grain_ms"))
        .orderBy("grain_ms", "series_key")
        .limit(max_listed + 1)
        .collect()
    )
    listed = tuple((r["series_key"], int(r["grain_ms"])) for r in chosen)
    if len(listed) <= max_listed:
        return Grain(None, listed)
    return Grain(listed[-1][1], listed[:-1])


def add_cell(df: DataFrame, grain: Grain, by: str = "series_key", out: str = "cell") -> DataFrame:
    """Add ``out``, the start of the row's time cell, or ``WHOLE`` for an undivided series."""
    default = F.lit(grain.default_ms).cast("bigint")
    if not grain.listed:
        step = default
    else:
        # At most MAX_LISTED rows by construction, hence always small enough to broadcast.
        listed = df.sparkSession.createDataFrame(list(grain.listed), f"{by} string, grain_ms bigint")
        df = df.join(F.broadcast(listed), by, "left")
        step = F.coalesce("grain_ms", default)
    cell = F.coalesce(F.col("ts_ms") - F.pmod(F.col("ts_ms"), step), F.lit(WHOLE))
    return df.withColumn(out, cell).drop("grain_ms")


def cell_window(keys: Sequence[str], order: Sequence[str | Column]) -> WindowSpec:
    return Window.partitionBy(*keys, "cell").orderBy(*order)


def _divided(df: DataFrame) -> DataFrame:
    return df.where(F.col("cell") != F.lit(WHOLE))


def neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    grain: Grain,
    before: Mapping[str, str] | None = None,
    after: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add columns of the previous and the next row of the same series.

    ``before`` and ``after`` map a new column to the column it is taken from.
    """
    before, after = dict(before or {}), dict(after or {})
    window = cell_window(keys, order)
    if grain.whole:
        return df.withColumns(
            {
                **{out: F.lag(src).over(window) for out, src in before.items()},
                **{out: F.lead(src).over(window) for out, src in after.items()},
            }
        )
    position = F.struct(*order)
    edges = (
        _divided(df)
        .groupBy(*keys, "cell")
        .agg(
            F.max_by(F.struct(*[F.col(s).alias(o) for o, s in before.items()] or [F.lit(0).alias("none")]), position).alias("_last"),
            F.min_by(F.struct(*[F.col(s).alias(o) for o, s in after.items()] or [F.lit(0).alias("none")]), position).alias("_first"),
        )
    )
    across = Window.partitionBy(*keys).orderBy("cell")
    edges = edges.select(
        *keys, "cell", F.lag("_last").over(across).alias("_before"), F.lead("_first").over(across).alias("_after")
    )
    # A NULL neighbour value is a value: fall back to the edge only on the border row itself.
    marked = df.withColumns(
        {
            "_is_first": F.lag(F.lit(False), 1, True).over(window),
            "_is_last": F.lead(F.lit(False), 1, True).over(window),
            **{out: F.lag(src).over(window) for out, src in before.items()},
            **{out: F.lead(src).over(window) for out, src in after.items()},
        }
    )
    joined = marked.join(edges, [*keys, "cell"], "left")
    return joined.withColumns(
        {
            **{o: F.when(F.col("_is_first"), F.col(f"_before.{o}")).otherwise(F.col(o)) for o in before},
            **{o: F.when(F.col("_is_last"), F.col(f"_after.{o}")).otherwise(F.col(o)) for o in after},
        }
    ).drop("_is_first", "_is_last", "_before", "_after")


_FOLDS = {
    "sum": (F.sum, lambda carried, own: F.coalesce(carried, F.lit(0)) + F.coalesce(own, F.lit(0))),
    "max": (F.max, lambda carried, own: F.greatest(carried, own)),
    "min": (F.min, lambda carried, own: F.least(carried, own)),
}


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    grain: Grain,
    folds: Mapping[str, tuple[str, Column]],
) -> DataFrame:
    """Add running aggregates over all rows of the series so far, the current one included.

    ``folds`` maps a new column to ("sum" | "max" | "min", expression).
    """
    window = cell_window(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = df.withColumns({out: _FOLDS[kind][0](expr).over(window) for out, (kind, expr) in folds.items()})
    if grain.whole:
        return own
    totals = (
        _divided(df).groupBy(*keys, "cell").agg(*[_FOLDS[kind][0](expr).alias(out) for out, (kind, expr) in folds.items()])
    )
    earlier = Window.partitionBy(*keys).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *keys, "cell", *[_FOLDS[kind][0](out).over(earlier).alias(f"_c_{out}") for out, (kind, _) in folds.items()]
    )
    joined = own.join(carried, [*keys, "cell"], "left")
    return joined.withColumns(
        {out: _FOLDS[kind][1](F.col(f"_c_{out}"), F.col(out)) for out, (kind, _) in folds.items()}
    ).drop(*[f"_c_{out}" for out in folds])


def with_lookback(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], grain: Grain, rows: int, carried: Sequence[str]
) -> DataFrame:
    """Prepend to every cell the last ``rows`` rows that came before it.

    Added rows have ``is_border`` set and only keys, order and ``carried`` filled.  A frame of up to
    ``rows`` preceding rows inside the cell is then complete; drop the border rows afterwards.
    """
    if grain.whole:
        return df.withColumn("is_border", F.lit(False))
    from_end = cell_window(keys, [F.col(c).desc() for c in order])
    tails = (
        _divided(df)
        .select(*keys, "cell", *order, *carried)
        .withColumn("_back", F.row_number().over(from_end))
        .where(F.col("_back") <= rows)
        .groupBy(*keys, "cell")
        .agg(F.array_sort(F.collect_list(F.struct(*order, *carried))).alias("_tail"))
    )
    # Every cell holds a row, so the last ``rows`` cells hold the last ``rows`` rows.
    earlier = Window.partitionBy(*keys).orderBy("cell").rowsBetween(-rows, -1)
    tails = tails.withColumn("_all", F.flatten(F.collect_list("_tail").over(earlier)))
    border = tails.select(
        *keys,
        "cell",
        F.explode(F.slice("_all", F.greatest(F.size("_all") - rows + 1, F.lit(1)), F.lit(rows))).alias("_row"),
    ).select(*keys, "cell", *[F.col(f"_row.{c}").alias(c) for c in (*order, *carried)], F.lit(True).alias("is_border"))
    return df.withColumn("is_border", F.lit(False)).unionByName(border, allowMissingColumns=True)
