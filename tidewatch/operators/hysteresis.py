"""Smoothing of point levels over the last samples into the level state of a series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.config import (
    DEFAULTS,
    NO_LEVEL,
    REACTION_MUTED,
    STATE_CHANGE,
    STATE_END,
    STATE_SAME,
    STATE_START,
    Settings,
)
from tidewatch.functions.steps import FIRST_PLACE, identity_step, level_after, recurrence_text, samples_so_far, steps_so_far
from tidewatch.operators.cells import WHOLE, WHOLE_SERIES, Grain, add_cell, cell_window, running, with_lookback
from tidewatch.operators.levels import levels_in_use
from tidewatch.session import cut_lineage

ORDER = ("ts_ms", "seq")


def state_code(before: Column, after: Column) -> Column:
    """Start, same, change or end of an alert, from the level before and after."""
    return (
        F.when(before == after, F.lit(STATE_SAME))
        .when(before == NO_LEVEL, F.lit(STATE_START))
        .when(after == NO_LEVEL, F.lit(STATE_END))
        .otherwise(F.lit(STATE_CHANGE))
    )


def sampled(points: DataFrame) -> DataFrame:
    """Points that count as samples: all but those of a muted series."""
    return points.where(F.col("reaction") != REACTION_MUTED)


def level_windows(
    levels: DataFrame,
    grain: Grain = WHOLE_SERIES,
    keys: Sequence[str] = ("series_key",),
    settings: Settings = DEFAULTS,
    with_values: bool = False,
) -> DataFrame:
    """Add what the last samples up to this one say.

    ``samples`` lists their levels from the lowest up; ``window_max`` is the highest of them, ``n_samples`` their
    number and ``upstate`` the direction to report if there is an event.
    """
    size = settings.window_samples
    if size < 1:
        raise ValueError("a window holds at least one sample")
    keys = list(keys)
    placed = levels if "cell" in levels.columns else add_cell(levels, grain)
    carried = ["level", "weight", *(["value"] if with_values else [])]
    rows = with_lookback(placed, keys, ORDER, grain, size, carried)
    order = cell_window(keys, ORDER)
    frame = order.rowsBetween(-(size - 1), Window.currentRow)
    columns = {
        "samples": F.sort_array(F.collect_list("level").over(frame)),
        "window_max": F.max("level").over(frame),
        "n_samples": F.count("level").over(frame).cast("int"),
        "_up_before": F.lag(F.col("weight") > 0).over(order),
    }
    if with_values:
        columns["values"] = F.collect_list(F.struct("level", "value")).over(frame)
    quiet = F.col("window_max") == NO_LEVEL
    return (
        rows.withColumns(columns)
        .where(~F.col("is_border"))
        .withColumn("upstate", F.when(quiet, F.coalesce("_up_before", F.lit(False))).otherwise(F.col("weight") > 0))
        .drop("_up_before", "is_border")
    )


def level_counts(windows: DataFrame, levels: Sequence[int]) -> DataFrame:
    """How many samples of the window reach each level, one column per level."""
    return windows.withColumns({f"cnt_{j}": F.expr(f"size(filter(samples, s -> s >= {int(j)}))") for j in levels})


def level_states(
    levels: DataFrame,
    grain: Grain = WHOLE_SERIES,
    keys: Sequence[str] = ("series_key",),
    settings: Settings = DEFAULTS,
    levels_used: Sequence[int] | None = None,
    with_values: bool = False,
) -> DataFrame:
    """Run the level state machine over sampled points that carry ``level``, ``weight`` and ``recurrences`` (or ``rules``).

    Adds ``prev_level``, ``state_level``, ``state`` (the code of the transition) and ``emitted``.  ``levels_used`` are
    all levels that the rules can name, those of the default rules unless given.

    Each sample is a step from every possible level to a next one.  Workers compose the steps within
    a cell; the steps of whole cells are composed per series to find the level each cell starts
    from; the level of a point is then looked up.  So even one endless alert of one series is
    evaluated in parallel.
    """
    keys = list(keys)
    used = levels_in_use(settings) if levels_used is None else tuple(sorted(levels_used))
    windows = level_windows(levels, grain, keys, settings, with_values)
    if "recurrences" not in windows.columns:
        windows = windows.withColumn("recurrences", recurrence_text(F.col("rules")))
    windows = windows.drop("rules")
    # The window clusters and sorts by series and cell; the workers read its output as it is, and of its columns
    # only those that a step depends on.
    text = F.array_join(F.col("samples").cast("array<string>"), ",")
    ready = windows.withColumns({"_first": F.row_number().over(cell_window(keys, ORDER)) == 1, "_text": text})
    steps = samples_so_far(used)("_text", "level", "recurrences", "_first")
    stepped = ready.withColumn("_steps", steps).drop("_text", "samples")
    if grain.whole:
        started = stepped.withColumn("_start", F.lit(0))
    else:
        # Read twice below, so not to be computed twice.
        stepped = cut_lineage(stepped)
        started = stepped.join(_cell_starts(stepped, keys, used), [*keys, "cell"], "left").withColumn(
            "_start", F.coalesce("_start", F.lit(0))
        )
    # The step before the first sample of a cell leaves the level that the cell starts from as it is.
    states = started.withColumns(
        {
            "prev_level": level_after("_steps.before", F.col("_start"), used),
            "state_level": level_after("_steps.after", F.col("_start"), used),
        }
    )
    return states.withColumns(
        {
            "state": state_code(F.col("prev_level"), F.col("state_level")),
            "emitted": (F.col("window_max") > NO_LEVEL) | (F.col("prev_level") != NO_LEVEL),
        }
    ).withColumn("upstate", F.col("emitted") & F.col("upstate")).drop("_first", "_steps", "_start", "recurrences")


def _cell_starts(stepped: DataFrame, keys: list[str], used: Sequence[int]) -> DataFrame:
    """The place each cell of a divided series starts from."""
    steps = (
        stepped.where(F.col("cell") != F.lit(WHOLE))
        .groupBy(*keys, "cell")
        .agg(F.max_by("_steps.after", F.struct(*ORDER)).alias("_cell_step"))
    )
    along = Window.partitionBy(*keys).orderBy("cell")
    steps = steps.withColumns(
        {
            "_entry": F.coalesce(F.lag("_cell_step").over(along), F.lit(identity_step(used))),
            "_first_cell": F.row_number().over(along) == 1,
        }
    ).drop("_cell_step")
    schema = T.StructType([*steps.schema.fields, T.StructField("_so_far", T.StringType())])
    composed = steps.mapInArrow(steps_so_far(used, "_entry", "_first_cell", "_so_far"), schema)
    # Every series starts without a level, at place 0.
    return composed.select(*keys, "cell", (F.ascii("_so_far") - FIRST_PLACE).alias("_start"))


def with_level_times(
    states: DataFrame, grain: Grain = WHOLE_SERIES, keys: Sequence[str] = ("series_key",), levels_used: Sequence[int] | None = None, start_at: str = "ts_ms"
) -> DataFrame:
    """Add ``starttimes`` and ``endtimes``: when each level in use was last entered and last left.

    Both are always there, empty before the first alert.  A level counts as entered at ``start_at``.  Samples that an
    earlier run left (``is_earlier``) bring their own times.
    """
    folds, used = {}, levels_in_use() if levels_used is None else tuple(levels_used)

    def at(level: int, moved: str, when: str, left: str) -> Column:
        own = F.expr(f"CASE WHEN {moved} THEN {when} END")
        return F.when(F.col("is_earlier"), F.try_element_at(left, F.lit(level))).otherwise(own) if "is_earlier" in states.columns else own

    for level in used:
        folds[f"_s{level}"] = ("max", at(level, f"prev_level < {level} AND state_level >= {level}", start_at, "earlier_starts"))
        folds[f"_e{level}"] = ("max", at(level, f"state_level < {level} AND prev_level >= {level}", "ts_ms", "earlier_ends"))
    placed = states if "cell" in states.columns else add_cell(states, grain)
    timed = running(placed, list(keys), ORDER, grain, folds)

    def as_map(prefix: str) -> Column:
        pairs = ", ".join(f"struct({j} AS k, {prefix}{j} AS v)" for j in used)
        return F.expr(f"map_from_entries(filter(array({pairs}), p -> p.v IS NOT NULL))")

    return timed.withColumns({"starttimes": as_map("_s"), "endtimes": as_map("_e")}).drop(*folds)
