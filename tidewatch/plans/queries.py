"""Every operator as a query over the bundled tables: name -> (session, folder) -> frame."""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.config import HOUR_MS, Settings
from tidewatch.functions.numbers import percent_of
from tidewatch.operators import absence, alerts, baseline, catalog, control, hysteresis, ingest, lateness, levels, regression, resume, score, special
from tidewatch.operators.cells import measure_grain
from tidewatch.operators.joins import lookup
from tidewatch.plans.monitor import monitor, point_levels
from tidewatch.session import cut_lineage
from tidewatch.sources import clock, events

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

# Fixed values of the queries: the evaluation instant, and a cut inside the data.
AS_OF_MS = 1_706_659_200_000
CUT_MS = 1_705_363_200_000
HEARTBEAT = Settings(heartbeat_name="view", absence_limit_ms=600_000)


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _rounded(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    # Adding 0.0 turns a negative zero into a plain one.
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in columns})


# Ingest


@query
def parse_points(spark, folder):
    parsed = ingest.parse_messages(events.raw_messages(spark, folder))
    return ingest.good_points(parsed).select(
        "series_key", "name", "ts_ms", "value", "uuid", F.col("type").cast("int").alias("type"), "reaction", "is_special", "status", "seq"
    )


@query
def parse_dead_letter(spark, folder):
    return ingest.dead_letters(ingest.parse_messages(events.raw_messages(spark, folder))).select("msg_id", "pos", "reason")


@query
def required_field_rejects(spark, folder):
    rejected = ingest.dead_letters(ingest.parse_messages(events.raw_messages(spark, folder)))
    return rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query
def split_special(spark, folder):
    points = ingest.good_points(ingest.parse_messages(events.raw_messages(spark, folder)))
    regular = ingest.regular_points(points).select(F.lit("regular").alias("kind"), "seq", "series_key", "value")
    return regular.unionByName(ingest.special_points(points).select(F.lit("special").alias("kind"), "seq", "series_key", "value"))


@query
def heartbeat_filter(spark, folder):
    return ingest.heartbeats(events.metric_points(spark, folder), HEARTBEAT).select("series_key", "ts_ms", "seq", "value")


@query
def host_absent_synthesis(spark, folder):
    points = ingest.synthesize_absence(events.metric_points(spark, folder), heartbeat_name="view")
    return points.select("series_key", "name", "ts_ms", "seq", "is_special", "status", "message")


# Catalog


@query
def series_identity(spark, folder):
    return events.user_points(spark, folder).select("series_key", "name", "uuid").distinct()


@query
def hash_collisions(spark, folder):
    found = catalog.series_catalog(events.user_points(spark, folder))
    # Two hex digits only, so that there are collisions to find.
    narrow = found.withColumn("short_hash", F.substring(F.md5("series_key"), 1, 2))
    return catalog.hash_collisions(narrow, "short_hash")


_CATALOG = ("series_key", "uuid", "name", "first_ts_ms", "last_ts_ms", "type", "is_special", "n_points")


def _catalog(spark, folder):
    found = catalog.series_catalog(events.user_points(spark, folder))
    return found.withColumn("type", F.col("type").cast("int"))


@query
def series_catalog(spark, folder):
    return _catalog(spark, folder).select(*_CATALOG)


@query
def catalog_special(spark, folder):
    return catalog.special_series(_catalog(spark, folder)).select(*_CATALOG)


@query
def catalog_by_name(spark, folder):
    return catalog.series_named(_catalog(spark, folder), "purchase").select(*_CATALOG)


@query
def catalog_upsert(spark, folder):
    points = events.user_points(spark, folder)
    stored = catalog.series_catalog(points.where(F.col("ts_ms") < CUT_MS))
    merged = catalog.upsert_catalog(stored, points.where(F.col("ts_ms") >= CUT_MS))
    return merged.withColumn("type", F.col("type").cast("int")).select(*_CATALOG)


@query
def catalog_enrichment(spark, folder):
    points = events.user_points(spark, folder)
    stored = catalog.series_catalog(points.where(F.col("ts_ms") < CUT_MS))
    return catalog.enrich(points.where(F.col("ts_ms") >= CUT_MS), stored).select(
        "series_key", "seq", "is_known", "known_since_ms", "known_last_ms", F.col("known_type").cast("int").alias("known_type")
    )


@query
def type_changes(spark, folder):
    points = events.user_points(spark, folder)
    return catalog.type_changes(points, measure_grain(points)).select(
        "series_key", "ts_ms", "seq", F.col("prev_type").cast("int").alias("prev_type"), F.col("type").cast("int").alias("type")
    )


@query
def latest_by_event_time(spark, folder):
    # Coarse timestamps, so that there are ties.
    points = events.user_points(spark, folder).withColumn("ts_ms", F.col("ts_ms") - F.pmod("ts_ms", F.lit(24 * HOUR_MS)))
    return catalog.latest_by_event_time(points, ["ts_ms", "seq", "value"])


@query
def latest_by_arrival(spark, folder):
    return catalog.latest_by_arrival(events.user_points(spark, folder), ["ts_ms", "seq", "value"])


@query
def point_sink_dedup(spark, folder):
    points = events.metric_points(spark, folder).select("series_key", "ts_ms", "seq", "value")
    coarse = points.withColumn("ts_ms", F.col("ts_ms") - F.pmod("ts_ms", F.lit(HOUR_MS)))
    return catalog.deduplicate_points(coarse)


# Baselines


@query
def hourly_baseline(spark, folder):
    return _rounded(baseline.hourly_baseline(events.metric_points(spark, folder)), ["avg", "dev"])


@query
def hourly_baseline_lineitem(spark, folder):
    return _rounded(_rounded(baseline.hourly_baseline(events.lineitem_points(spark, folder)), ["avg"]), ["dev"], 4)


@query
def baseline_range_read(spark, folder):
    last_ms = CUT_MS + 24 * HOUR_MS - 1
    points = baseline.points_between(events.metric_points(spark, folder, CUT_MS, last_ms), CUT_MS, last_ms)
    return points.select("series_key", "ts_ms", "seq", "value")


@query
def missing_baselines(spark, folder):
    points = events.metric_points(spark, folder)
    stored = baseline.hourly_baseline(points.where(F.col("ts_ms") < CUT_MS))
    return baseline.missing_slots(baseline.wanted_slots(points), stored)


@query
def incremental_baseline(spark, folder):
    points = events.metric_points(spark, folder)
    stored = baseline.hourly_baseline(points.where(F.col("ts_ms") < CUT_MS))
    built = baseline.build_missing(baseline.wanted_slots(points), stored, points)
    return _rounded(built, ["avg", "dev"])


@query
def baseline_join(spark, folder):
    points = events.metric_points(spark, folder)
    joined = score.baseline_join(points, baseline.hourly_baseline(points))
    return _rounded(joined.select("series_key", "seq", "day", "vote", "avg", "dev", "min", "max"), ["avg", "dev"])


# Scores


def _points_and_grain(spark, folder):
    points = events.metric_points(spark, folder)
    return points, measure_grain(points)


@query
def score_points(spark, folder):
    points, grain = _points_and_grain(spark, folder)
    scored = score.score_points(points, grain=grain)
    return _rounded(scored.select("series_key", "seq", "reaction", "n_refs", "weight", "weight_pct"), ["weight_pct"])


@query
def score_by_reaction(spark, folder):
    points, grain = _points_and_grain(spark, folder)
    return (
        score.score_points(points, grain=grain)
        .groupBy("reaction")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("weight").alias("min_weight"),
            F.max("weight").alias("max_weight"),
            F.sum(F.abs("weight")).cast("bigint").alias("sum_abs_weight"),
        )
    )


@query
def score_orders(spark, folder):
    points = events.order_points(spark, folder)
    scored = score.score_points(points, grain=measure_grain(points))
    return _rounded(scored.select("series_key", "seq", "n_refs", "weight", "weight_pct"), ["weight_pct"])


@query
def score_lineitem(spark, folder):
    points = events.lineitem_points(spark, folder)
    scored = score.score_points(points, grain=measure_grain(points))
    return _rounded(scored.select("series_key", "seq", "n_refs", "weight", "weight_pct"), ["weight_pct"])


@query
def reaction_gate(spark, folder):
    points = events.metric_points(spark, folder)
    gated = score.with_effective_reaction(points, late_before_ms=F.lit(CUT_MS))
    return score.score_points(gated, baseline.hourly_baseline(points)).select("seq", "reaction", "weight")


@query
def regression_predict(spark, folder):
    points, grain = _points_and_grain(spark, folder)
    fitted = regression.running_regression(points, grain)
    return _rounded(fitted.select("series_key", "seq", "predicted", "predict_pct"), ["predicted", "predict_pct"], 4)


def _controls(spark, folder):
    return control.good_controls(control.decode_control(events.control_messages(spark, folder)))


def _series_controls(spark, folder):
    """Control messages, and those about series by name.

    Both are small next to the points and read once per kind of action, so they are written out first.
    """
    decoded = cut_lineage(_controls(spark, folder))
    series = catalog.series_catalog(events.metric_points(spark, folder))
    return decoded, cut_lineage(control.resolve_series(decoded, series))


@query
def regression_reset(spark, folder):
    points, grain = _points_and_grain(spark, folder)
    _, per_series = _series_controls(spark, folder)
    epochs = control.with_series_epochs(points, per_series, grain)
    fitted = regression.running_regression(epochs, grain, ["series_key", "fit_epoch"])
    return _rounded(fitted.select("series_key", "seq", "fit_epoch", "predict_pct"), ["predict_pct"], 4)


@query
def regression_resume(spark, folder):
    points, grain = _points_and_grain(spark, folder)
    stored = regression.regression_totals(points.where(F.col("ts_ms") < CUT_MS), ["series_key"])
    fitted = regression.running_regression(points.where(F.col("ts_ms") >= CUT_MS), grain, earlier=stored)
    return _rounded(fitted.select("series_key", "seq", "predicted", "predict_pct"), ["predicted", "predict_pct"], 4)


@query
def regression_totals(spark, folder):
    totals = regression.regression_totals(events.metric_points(spark, folder), ["series_key"])
    spread = F.col("sxx") - F.col("sx") * F.col("sx") / F.col("n")
    slope = (F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")) / F.nullif(spread, F.lit(0.0))
    fitted = totals.select(
        "series_key",
        F.col("n").cast("bigint").alias("n"),
        slope.alias("slope"),
        (F.col("sy") / F.col("n") - slope * F.col("sx") / F.col("n")).alias("intercept"),
    )
    return _rounded(_rounded(fitted, ["slope"], 10), ["intercept"], 6)


# Levels


@query
def tenant_levels(spark, folder):
    return levels.rules_to_rows(levels.tenant_rules(events.users(spark, folder)))


@query
def status_levels(spark, folder):
    points = levels.with_status_level(events.special_points(spark, folder))
    known = points.where(F.col("status_level").isNotNull())
    return known.select("seq", "status", "status_level")


@query
def status_dead_letter(spark, folder):
    return special.unknown_status(events.special_points(spark, folder)).select("seq", "status")


def _point_levels(spark, folder):
    points, grain = _points_and_grain(spark, folder)
    return point_levels(points, grain=grain), grain


@query
def point_levels_default(spark, folder):
    leveled, _ = _point_levels(spark, folder)
    return _rounded(leveled.select("series_key", "seq", "weight", "weight_pct", "level"), ["weight_pct"])


@query
def error_log(spark, folder):
    leveled, _ = _point_levels(spark, folder)
    log = alerts.error_log(leveled).select("uuid", "ts_s", "series_key", "weight", "weight_pct", "value", "predict_pct")
    return _rounded(_rounded(log, ["weight_pct"]), ["predict_pct"], 4)


@query
def level_window_counts(spark, folder):
    leveled, grain = _point_levels(spark, folder)
    windows = hysteresis.level_windows(hysteresis.sampled(leveled), grain)
    return hysteresis.level_counts(windows, range(6)).select("series_key", "seq", "level", "n_samples", *[f"cnt_{j}" for j in range(6)])


@query
def window_max_level(spark, folder):
    leveled, grain = _point_levels(spark, folder)
    return hysteresis.level_windows(hysteresis.sampled(leveled), grain).select("series_key", "seq", "window_max")


@query
def level_state(spark, folder):
    points, grain = _points_and_grain(spark, folder)
    states = monitor(points, grain=grain, with_values=False, with_times=False)
    return states.select("series_key", "seq", "prev_level", "state_level", "state", "emitted", "upstate")


def _tenant_rules(spark, folder, own_levels=(0, 1, 2)):
    return events.tenant_points(spark, folder), levels.tenant_rules(events.users(spark, folder, own_levels))


@query
def point_levels_tenant(spark, folder):
    """A third of the tenants with levels of their own, a third with empty ones, a third with none."""
    points, rules = _tenant_rules(spark, folder)
    leveled = point_levels(points, rules=rules, grain=measure_grain(points))
    return leveled.select("series_key", "seq", "weight", "level")


@query
def level_state_tenant(spark, folder):
    points, rules = _tenant_rules(spark, folder)
    states = monitor(points, rules=rules, grain=measure_grain(points), with_values=False, with_times=False)
    return states.select("series_key", "seq", "level", "prev_level", "state_level", "state")


HIGH_LEVELS = (7, 12, 20)


@query
def level_state_high_levels(spark, folder):
    """Some tenants use levels 7, 12 and 20 next to others with the default ones."""
    points, rules = _tenant_rules(spark, folder, HIGH_LEVELS)
    states = monitor(points, rules=rules, grain=measure_grain(points), with_values=False)
    at = lambda m, j, p: F.try_element_at(m, F.lit(j)).alias(f"{p}_{j}")
    times = [at(f"{p}times", j, p) for p in ("start", "end") for j in HIGH_LEVELS]
    return states.select("series_key", "seq", "level", "prev_level", "state_level", "state", *times)


@query
def level_times(spark, folder):
    points, grain = _points_and_grain(spark, folder)
    states = monitor(points, grain=grain, with_values=False)
    at = lambda m, j, p: F.try_element_at(m, F.lit(j)).alias(f"{p}_{j}")
    return states.select(
        "series_key", "seq", *[at("starttimes", j, "start") for j in range(6)], *[at("endtimes", j, "end") for j in range(6)]
    )


def _two_runs(spark, folder):
    """The states of two runs, the second of which goes on from what the first one left, one after the other."""
    points, grain = _points_and_grain(spark, folder)
    hourly = cut_lineage(baseline.hourly_baseline(points))
    before, after = points.where(F.col("ts_ms") < CUT_MS), points.where(F.col("ts_ms") >= CUT_MS)
    first = cut_lineage(monitor(before, hourly, grain=grain))
    left = resume.last_samples(first)
    totals = regression.regression_totals(before, ["series_key"])
    return first.unionByName(monitor(after, hourly, grain=grain, earlier=left, earlier_totals=totals))


@query
def level_state_resumed(spark, folder):
    """Two runs give the states and level times of one run over all."""
    states = _two_runs(spark, folder)
    at = lambda m, j, p: F.try_element_at(m, F.lit(j)).alias(f"{p}_{j}")
    times = [at(f"{p}times", j, p) for p in ("start", "end") for j in range(6)]
    return states.select("series_key", "seq", "level", "prev_level", "state_level", "state", "emitted", "upstate", *times)


@query
def level_state_controlled(spark, folder):
    points, grain = _points_and_grain(spark, folder)
    controls, per_series = _series_controls(spark, folder)
    states = monitor(
        points,
        controls=controls,
        series_controls=per_series,
        grain=grain,
        tenant_grain=measure_grain(points, by="uuid"),
        with_values=False,
        with_times=False,
    )
    return states.select("series_key", "seq", "epoch", "fit_epoch", "level", "prev_level", "state_level", "state")


# Special points and silence


def _special_rows(spark, folder):
    points = events.special_points(spark, folder)
    return special.with_neighbour_status(points, measure_grain(points))


_SPECIAL = ("series_key", "seq", "event_ms", "prev_level", "state_level", "state")


@query
def special_status(spark, folder):
    return special.status_events(_special_rows(spark, folder)).select(*_SPECIAL)


@query
def special_autoclose(spark, folder):
    return special.autoclose_events(_special_rows(spark, folder), AS_OF_MS).select(*_SPECIAL)


@query
def special_deadman(spark, folder):
    return special.deadman_events(_special_rows(spark, folder), AS_OF_MS).select(*_SPECIAL)


@query
def special_deadman_first(spark, folder):
    points = events.special_points(spark, folder, by_user=True)
    rows = special.with_neighbour_status(points, measure_grain(points))
    return special.deadman_events(rows, AS_OF_MS, first_only=True).select(*_SPECIAL)


@query
def special_controlled(spark, folder):
    """Special points whose series are deleted now and then."""
    points = events.special_points(spark, folder)
    decoded = cut_lineage(_controls(spark, folder))
    per_series = cut_lineage(control.resolve_series(decoded, catalog.series_catalog(points)))
    found = special.special_events(points, AS_OF_MS, measure_grain(points), series_controls=per_series)
    return found.select("kind", *_SPECIAL, "epoch")


@query
def host_absence(spark, folder):
    beats = ingest.heartbeats(events.metric_points(spark, folder), HEARTBEAT)
    found = absence.absence_events(beats, AS_OF_MS, measure_grain(beats), settings=HEARTBEAT)
    return found.select("series_key", "kind", "event_ms", "last_seen_ms", "prev_level", "state_level", "state")


@query
def overdue_hosts(spark, folder):
    latest = catalog.latest_by_event_time(events.user_points(spark, folder), ["ts_ms", "seq"])
    return absence.overdue(latest, AS_OF_MS, Settings(absence_limit_ms=5 * 24 * HOUR_MS))


@query
def clock_evaluation(spark, folder):
    """Heartbeats per evaluation tick: how long each tick sees the metric silent."""
    beats = ingest.heartbeats(events.metric_points(spark, folder), HEARTBEAT)
    return clock.silence_at_ticks(beats, AS_OF_MS, measure_grain(beats), HEARTBEAT).select("series_key", "tick_ms", "last_seen_ms")


# Control


@query
def control_decode(spark, folder):
    decoded, per_series = _series_controls(spark, folder)
    updates = decoded.where(F.col("action") == "updatelevels")
    names = per_series.select("ts_ms", "seq", "action", "series_key", F.lit(None).cast("string").alias("uuid"), F.lit(0).alias("n_rules"))
    tenants = updates.select(
        "ts_ms", "seq", "action", F.lit(None).cast("string").alias("series_key"), "uuid", F.size("rules").alias("n_rules")
    )
    return names.unionByName(tenants)


@query
def control_dead_letter(spark, folder):
    decoded = control.decode_control(events.control_messages(spark, folder))
    return control.control_dead_letters(decoded).select("ts_ms", "seq", "reason")


@query
def control_asof_epochs(spark, folder):
    points, grain = _points_and_grain(spark, folder)
    _, per_series = _series_controls(spark, folder)
    return control.with_series_epochs(points, per_series, grain).select("series_key", "seq", "epoch", "fit_epoch")


@query
def levels_versioned(spark, folder):
    decoded = _controls(spark, folder)
    rows = levels.rules_to_rows(control.level_versions(decoded))
    return rows.select("uuid", "version", "valid_from_ms", "valid_to_ms", "level", "min_weight", "min_pct", "rec_count")


@query
def levels_asof(spark, folder):
    points = events.metric_points(spark, folder)
    decoded = cut_lineage(_controls(spark, folder))
    ruled = control.attach_versioned_rules(points, decoded, grain=measure_grain(points, by="uuid"))
    top = F.element_at("rules", -1)
    return ruled.select("series_key", "seq", F.size("rules").alias("n_rules"), top["min_weight"].alias("top_min_weight"))


# Alerts


def _all_alerts(spark, folder):
    regular = events.metric_points(spark, folder).where(F.col("name") != "error")
    errors = events.special_points(spark, folder)
    beats = ingest.heartbeats(events.metric_points(spark, folder), HEARTBEAT)
    states = monitor(regular, grain=measure_grain(regular))
    error_grain, beat_grain = measure_grain(errors), measure_grain(beats)
    return alerts.merge_alerts(
        alerts.level_alerts(states),
        alerts.special_alerts(special.special_events(errors, AS_OF_MS, error_grain), grain=error_grain),
        alerts.absence_alerts(absence.absence_events(beats, AS_OF_MS, beat_grain, settings=HEARTBEAT), grain=beat_grain),
    )


@query
def alert_events(spark, folder):
    points, grain = _points_and_grain(spark, folder)
    found = alerts.level_alerts(monitor(points, grain=grain))
    latest = F.element_at("values", -1)
    return found.select(
        "key",
        F.col("action").alias("action"),
        "time",
        F.col("type").cast("int").alias("type"),
        "reaction",
        "startvalue",
        "source",
        "level",
        "prev_level",
        "upstate",
        "uuid",
        F.size("values").alias("n_values"),
        latest["level"].alias("last_level"),
        latest["value"].alias("last_value"),
        F.size("starttimes").alias("n_starts"),
        F.size("endtimes").alias("n_ends"),
    )


@query
def alert_union(spark, folder):
    return (
        _all_alerts(spark, folder)
        .groupBy("source", "action", "level", "prev_level")
        .agg(F.count(F.lit(1)).alias("n"), F.count("type").alias("n_with_point"), F.sum("time").alias("sum_time"))
    )


@query
def alert_routing(spark, folder):
    return (
        alerts.route_alerts(_all_alerts(spark, folder))
        .groupBy("source", "topic", "role")
        .agg(F.count(F.lit(1)).alias("n"), F.count(F.get_json_object("value", "$.UUID")).alias("n_named"))
    )


@query
def alert_payload(spark, folder):
    """Every record, its fields read back from the text that is sent."""
    records = alerts.route_alerts(_all_alerts(spark, folder)).select("topic", "role", "value", "prev_level")
    kinds = {
        "key": "string", "action": "int", "time": "bigint", "type": "int", "reaction": "int", "startvalue": "double",
        "message": "string", "source": "string", "level": "int", "upstate": "boolean", "UUID": "string",
    }
    fields = [F.get_json_object("value", f"$.{c}").cast(t).alias(c.lower()) for c, t in kinds.items()]
    times = [
        F.get_json_object("value", f"$.{p}times.{j}").cast("bigint").alias(f"{p}_{j}") for p in ("start", "end") for j in range(6)
    ]
    there = [F.get_json_object("value", f"$.{c}").isNotNull().alias(f"has_{c}") for c in ("starttimes", "endtimes")]
    n_values = F.json_array_length(F.get_json_object("value", "$.values")).alias("n_values")
    return records.select("topic", "role", *fields, *times, *there, n_values)


@query
def observed_points(spark, folder):
    """The diagnostic tap leaves the rows as they are."""
    tapped, _ = alerts.observed(events.user_points(spark, folder), "points")
    return tapped.select("series_key", "ts_ms", "seq")


@query
def percent_deviation(spark, folder):
    """Price of each order against the mean of its priority, in percent."""
    points = events.order_points(spark, folder)
    mean = points.groupBy("name").agg(F.avg("value").alias("mean_value"))
    joined = lookup(points, mean, ["name"])
    return _rounded(joined.select("seq", percent_of(F.col("value"), F.col("mean_value")).alias("pct")), ["pct"], 4)


# From messages on, and what streams do in the order of arrival


@query
def messages_to_records(spark, folder):
    """The whole path: texts are parsed, regular points scored, levelled and smoothed, alerts routed to their topics."""
    parsed = ingest.parse_messages(events.raw_messages(spark, folder))
    points = cut_lineage(ingest.regular_points(ingest.good_points(parsed)))
    found = alerts.level_alerts(monitor(points, grain=measure_grain(points)))
    return (
        alerts.route_alerts(found)
        .groupBy("topic", "role", "action", "level", "prev_level")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("time").alias("sum_time"))
    )


@query
def latest_parsed(spark, folder):
    """Of each series in the messages, the latest point by event time, on coarse timestamps so that there are ties."""
    points = ingest.good_points(ingest.parse_messages(events.raw_messages(spark, folder)))
    coarse = points.withColumn("ts_ms", F.col("ts_ms") - F.pmod("ts_ms", F.lit(24 * HOUR_MS)))
    latest = catalog.latest_by_event_time(coarse, ["ts_ms", "seq", "value"])
    return latest.join(catalog.series_catalog(points).select("series_key", "last_seq", "n_points"), "series_key")


@query
def late_reactions(spark, folder):
    """Every thirteenth point arrives two hours after its time; an hour is allowed."""
    points = events.metric_points(spark, folder)
    arrival = F.col("ts_ms") + F.when(F.col("seq") % 13 == 0, F.lit(2 * HOUR_MS)).otherwise(F.lit(0))
    arrived = points.withColumn("arrival", F.struct(arrival.alias("ms"), F.col("seq")))
    late = lateness.with_late_reaction(arrived, HOUR_MS, order="arrival")
    return late.select("seq", "series_key", "reaction")


@query
def merged_baseline(spark, folder):
    """Hourly statistics merged from the moments of five parts of the points, as a stream's batches leave them."""
    points = events.metric_points(spark, folder)
    parts = [baseline.slot_moments(points.where(F.col("seq") % 5 == b)).withColumn("batch", F.lit(b)) for b in range(5)]
    log = functools.reduce(DataFrame.unionByName, parts)
    return _rounded(baseline.merged_baseline(log), ["avg", "dev"])
