"""The whole path of regular points: score, fit, level, state, alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.config import DEFAULTS, Settings
from tidewatch.operators.alerts import level_alerts
from tidewatch.operators.baseline import hourly_baseline
from tidewatch.operators.cells import WHOLE_SERIES, Grain
from tidewatch.operators.control import attach_versioned_rules, with_rule_versions, with_series_epochs
from tidewatch.operators.hysteresis import level_states, sampled, with_level_times
from tidewatch.operators.levels import attach_rules, levels_in_use, point_level
from tidewatch.operators.regression import running_regression
from tidewatch.operators.resume import with_earlier, without_earlier
from tidewatch.operators.score import score_points
from tidewatch.session import cut_lineage


def point_levels(
    points: DataFrame,
    baseline: DataFrame | None = None,
    rules: DataFrame | None = None,
    controls: DataFrame | None = None,
    series_controls: DataFrame | None = None,
    grain: Grain = WHOLE_SERIES,
    tenant_grain: Grain = WHOLE_SERIES,
    settings: Settings = DEFAULTS,
    earlier_totals: DataFrame | None = None,
) -> DataFrame:
    """Points with weight, percent, predicted deviation, level and the recurrences its tenant asks for.

    ``earlier_totals`` are the regression totals that an earlier run left.
    """
    fit_keys = ["series_key"]
    rows = points
    if series_controls is not None:
        rows = with_series_epochs(rows, series_controls, grain)
        fit_keys.append("fit_epoch")
    if controls is not None:
        rows = with_rule_versions(rows, controls, tenant_grain)
    baseline = hourly_baseline(points) if baseline is None else baseline
    fitted = running_regression(score_points(rows, baseline, settings, grain), grain, fit_keys, earlier_totals)
    # Rules are wide: they join last, and only a number of theirs goes on to the next shuffle.
    if controls is not None:
        ruled = attach_versioned_rules(fitted, controls, rules, tenant_grain, settings)
    else:
        ruled = attach_rules(fitted, rules, settings)
    return point_level(ruled).drop("rules")


def monitor(
    points: DataFrame,
    baseline: DataFrame | None = None,
    rules: DataFrame | None = None,
    controls: DataFrame | None = None,
    series_controls: DataFrame | None = None,
    grain: Grain = WHOLE_SERIES,
    tenant_grain: Grain = WHOLE_SERIES,
    settings: Settings = DEFAULTS,
    levels: Sequence[int] | None = None,
    with_values: bool = True,
    with_times: bool = True,
    earlier: DataFrame | None = None,
    earlier_totals: DataFrame | None = None,
) -> DataFrame:
    """Level states of all sampled points, with the times and values an alert reports.

    States range over ``levels``; those that the rules in use name, unless given.  ``earlier`` are the last samples and
    ``earlier_totals`` the regression totals that an earlier run left (``operators/resume``); all points are later than
    those.  A run that goes on is given its baseline, and all control messages from the beginning, as epochs count them.
    """
    if baseline is None and (earlier is not None or earlier_totals is not None):
        raise ValueError("a run that goes on needs a baseline that covers the days before it")
    levels = levels_in_use(settings, rules, controls) if levels is None else levels
    leveled = point_levels(points, baseline, rules, controls, series_controls, grain, tenant_grain, settings, earlier_totals)
    keys = ["series_key"] if series_controls is None else ["series_key", "epoch"]
    # Python workers are handed every column there is, so keep to what an alert needs.
    wanted = [*keys, "cell", "uuid", "ts_ms", "seq", "type", "reaction", "value", "weight", "level", "recurrences", "fit_epoch"]
    samples = sampled(leveled).select(*[c for c in wanted if c in leveled.columns])
    if earlier is not None:
        samples = with_earlier(samples, earlier, keys, grain)
    if not grain.whole:
        # The state machine reads its input once for the cell borders and once for the cells.
        samples = cut_lineage(samples)
    states = level_states(samples, grain, keys, settings, levels, with_values)
    timed = with_level_times(states, grain, keys, levels) if with_times else states
    return timed if earlier is None else without_earlier(timed)


def monitor_alerts(points: DataFrame, **options) -> DataFrame:
    """Alert events of regular points."""
    return level_alerts(monitor(points, **options).withColumn("reaction", F.col("reaction").cast("int")))
