"""The error log, alert events, and the topics they go to."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.config import DEFAULTS, REACTION_MUTED, SEVERE_LEVEL, STATE_SAME, Settings
from tidewatch.functions.identity import series_hash
from tidewatch.functions.time import epoch_seconds
from tidewatch.operators.cells import WHOLE_SERIES, Grain
from tidewatch.operators.hysteresis import with_level_times
from tidewatch.operators.levels import levels_in_use

_TIMES = "map<int,bigint>"
_VALUES = "array<struct<level:int,value:double>>"
EVENT_COLUMNS = (
    "hash",
    "key",
    "action",
    "time",
    "type",
    "reaction",
    "startvalue",
    "message",
    "starttimes",
    "endtimes",
    "source",
    "level",
    "upstate",
    "values",
    "uuid",
    "prev_level",
)


def error_log(scored: DataFrame) -> DataFrame:
    """One row per tenant, second and series with a non-zero weight, the last write winning."""
    cells = F.struct("weight", "weight_pct", "value", "predict_pct")
    hits = scored.where((F.col("weight") != 0) & (F.col("reaction") != REACTION_MUTED))
    return (
        hits.groupBy("uuid", epoch_seconds(F.col("ts_ms")).alias("ts_s"), "series_key")
        .agg(F.max_by(cells, "seq").alias("_row"))
        .select("uuid", "ts_s", "series_key", "_row.*")
    )


def _identity() -> list:
    return [series_hash(F.col("series_key")).alias("hash"), F.lower(F.hex("series_key")).alias("key")]


def level_alerts(states: DataFrame, source: str = "level") -> DataFrame:
    """Alert events of the level state machine; a quiet point of a quiet series yields none."""
    return states.where("emitted").select(
        *_identity(),
        F.col("state").alias("action"),
        F.col("ts_ms").alias("time"),
        "type",
        "reaction",
        F.col("value").alias("startvalue"),
        F.lit(None).cast("string").alias("message"),
        F.col("starttimes").cast(_TIMES).alias("starttimes"),
        F.col("endtimes").cast(_TIMES).alias("endtimes"),
        F.lit(source).alias("source"),
        F.col("state_level").alias("level"),
        "upstate",
        F.col("values").cast(_VALUES).alias("values"),
        "uuid",
        "prev_level",
    )


def event_levels(settings: Settings = DEFAULTS) -> list[int]:
    """Levels whose times the events of special points and of silence carry on."""
    return sorted({*levels_in_use(settings), SEVERE_LEVEL, *(j for j in settings.status_levels.values() if j >= 0)})


def from_stream(rows: DataFrame) -> DataFrame:
    """Rows of the streaming machines with their times and values as the batch operators have them."""
    times = {c: F.from_json(c, "map<string,bigint>").cast(_TIMES) for c in ("starttimes", "endtimes")}
    values = {"values": F.from_json("values", _VALUES)} if "values" in rows.columns else {}
    return rows.withColumns(times | values)


def _timed(events: DataFrame, grain: Grain, settings: Settings, start_at: str = "event_ms") -> DataFrame:
    """Events with the times at which their series last entered and left each level, carried on from event to event.

    Those that come from a stream have them already.
    """
    if "starttimes" in events.columns:
        return events
    point = F.col("ts_ms") if "ts_ms" in events.columns else F.lit(None).cast("bigint")
    order = F.col("seq") if "seq" in events.columns else F.lit(0).cast("bigint")
    levels = event_levels(settings)
    rows = events.withColumns({"point_ms": point, "ts_ms": F.col("event_ms"), "seq": order})
    return with_level_times(rows, grain, levels_used=levels, start_at=start_at)


def special_alerts(
    events: DataFrame, source: str = "special", grain: Grain = WHOLE_SERIES, settings: Settings = DEFAULTS
) -> DataFrame:
    """Alert events of special points; they always have a point, so its own time is reported."""
    return _timed(events, grain, settings).select(
        *_identity(),
        F.col("state").alias("action"),
        F.col("point_ms").alias("time"),
        "type",
        "reaction",
        F.col("value").alias("startvalue"),
        "message",
        F.col("starttimes").cast(_TIMES).alias("starttimes"),
        F.col("endtimes").cast(_TIMES).alias("endtimes"),
        F.lit(source).alias("source"),
        F.col("state_level").alias("level"),
        F.lit(False).alias("upstate"),
        F.array().cast(_VALUES).alias("values"),
        "uuid",
        "prev_level",
    )


def absence_alerts(
    events: DataFrame, source: str = "absence", grain: Grain = WHOLE_SERIES, settings: Settings = DEFAULTS
) -> DataFrame:
    """Alert events of silent hosts.

    A silence starts with the last heartbeat and has no point, hence no type, reaction or value; the return has its own.
    """
    point = {"type": "smallint", "reaction": "int", "value": "double"}
    own = {c: (F.col(c) if c in events.columns else F.lit(None)).cast(t) for c, t in point.items()}
    return _timed(events, grain, settings, "last_seen_ms").select(
        *_identity(),
        F.col("state").alias("action"),
        F.col("event_ms").alias("time"),
        own["type"].alias("type"),
        own["reaction"].alias("reaction"),
        own["value"].alias("startvalue"),
        F.lit(None).cast("string").alias("message"),
        F.col("starttimes").cast(_TIMES).alias("starttimes"),
        F.col("endtimes").cast(_TIMES).alias("endtimes"),
        F.lit(source).alias("source"),
        F.col("state_level").alias("level"),
        F.lit(False).alias("upstate"),
        F.array().cast(_VALUES).alias("values"),
        "uuid",
        "prev_level",
    )


def merge_alerts(*streams: DataFrame) -> DataFrame:
    """All alert streams as one; a column that a stream lacks is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), streams)


def route_alerts(events: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """One to three (``topic``, ``value``) records per event.

    Always to the tenant's topic of the level, also to that of the level left, and to the main topic
    unless nothing changed.  NULL fields are left out of the JSON; only the main topic names the tenant.
    """
    body = [c for c in EVENT_COLUMNS if c not in ("uuid", "prev_level")]
    json = F.to_json(F.struct(*body))
    named = F.to_json(F.struct(*body, F.col("uuid").alias("UUID")))
    level, left = F.col("level").cast("string"), F.col("prev_level").cast("string")

    def record(topic, payload, role):
        return F.struct(topic.alias("topic"), payload.alias("value"), F.lit(role).alias("role"))

    records = F.array_compact(
        F.array(
            record(F.concat("uuid", level), json, "level"),
            F.when(F.col("level") != F.col("prev_level"), record(F.concat("uuid", left), json, "left")),
            F.when(F.col("action") != STATE_SAME, record(F.lit(settings.main_topic), named, "main")),
        )
    )
    return events.select("*", F.explode(records).alias("_r")).select("*", "_r.*").drop("_r")


def observed(df: DataFrame, name: str):
    """Count rows, and filled fields per column, while ``df`` is being used: (frame, observation)."""
    from pyspark.sql import Observation

    observation = Observation(name)
    counts = [F.count(c).alias(f"n_{c}") for c in df.columns]
    return df.observe(observation, F.count(F.lit(1)).alias("n_rows"), *counts), observation
