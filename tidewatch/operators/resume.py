"""What a run leaves behind for the next one, so that two runs give what one would have given.

The last samples of each series are kept as rows, with the state and the level times each of them led to.  In the next
run they stand before the new samples: windows look back on them, and in the level machine such a row is a step that
leads to its own level from wherever it starts.  So they need no path of their own, in whole series or in cells.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.config import DEFAULTS, Settings
from tidewatch.functions.steps import fixed_text
from tidewatch.operators.cells import Grain, add_cell
from tidewatch.operators.regression import moved_totals

_KEPT = ("ts_ms", "seq", "level", "weight", "value", "state_level", "starttimes", "endtimes")


def last_samples(
    states: DataFrame,
    keys: Sequence[str] = ("series_key",),
    settings: Settings = DEFAULTS,
    earlier: DataFrame | None = None,
) -> DataFrame:
    """The last samples per series of a run's states with times, and of what the run before had left.

    Series without new samples keep what they had.  At most ``window_samples`` rows a series; the ranking drops others
    before it shuffles, so a hot series costs no more than others.
    """
    rows = states.select(*keys, *_KEPT)
    if earlier is not None:
        rows = rows.unionByName(earlier.select(*keys, *_KEPT))
    newest = Window.partitionBy(*keys).orderBy(F.col("ts_ms").desc(), F.col("seq").desc())
    ranked = rows.withColumn("_back", F.row_number().over(newest))
    return ranked.where(F.col("_back") <= settings.window_samples).drop("_back")


def with_earlier(samples: DataFrame, earlier: DataFrame, keys: Sequence[str], grain: Grain) -> DataFrame:
    """Put the samples that the last run left before the new ones, marked ``is_earlier``."""
    old = earlier.select(
        *keys,
        "ts_ms",
        F.col("seq").cast(samples.schema["seq"].dataType).alias("seq"),
        *[F.col(c).cast(samples.schema[c].dataType).alias(c) for c in ("level", "weight", "value") if c in samples.columns],
        fixed_text(F.col("state_level")).alias("recurrences"),
        F.col("starttimes").alias("earlier_starts"),
        F.col("endtimes").alias("earlier_ends"),
        F.lit(True).alias("is_earlier"),
    )
    placed = add_cell(old, grain) if "cell" in samples.columns else old
    return samples.withColumn("is_earlier", F.lit(False)).unionByName(placed, allowMissingColumns=True)


def without_earlier(states: DataFrame) -> DataFrame:
    return states.where(~F.col("is_earlier")).drop("is_earlier", "earlier_starts", "earlier_ends")


def merged_totals(totals: DataFrame, earlier: DataFrame, keys: Sequence[str] = ("series_key",)) -> DataFrame:
    """Regression totals of all points of two runs, about the earlier of both first seconds."""
    both = totals.unionByName(earlier.select(*totals.columns))
    first = Window.partitionBy(*keys)
    # Two rows a series, one of each run.
    placed = both.withColumn("_gap", (F.col("origin_s") - F.min("origin_s").over(first)).cast("double"))
    return moved_totals(placed, keys)
