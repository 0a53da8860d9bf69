"""Streaming forms of the level machine, the special timers and the absence detector.

Each keeps one small JSON state per series in Spark's state store.  Rows of a micro-batch are taken in
order of time and sequence; a row older than the last one seen cannot be put back in order.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidewatch.config import (
    ACTION_DELETE_SERIES,
    ACTION_RESET_REGRESSION,
    ACTION_UPDATE_LEVELS,
    DEFAULTS,
    Settings,
)
from tidewatch.functions.time import hour_slot, to_timestamp
from tidewatch.operators.alerts import event_levels
from tidewatch.operators.baseline import reference_table
from tidewatch.operators.levels import rules_literal, with_status_level
from tidewatch.operators.score import score_columns
from tidewatch.shipping import ship_by_value
from tidewatch.streaming.machines import LevelMachine, Timer, state_of

ship_by_value(__name__)

STATE = "state string"
LEVEL_ROWS = (
    "series_key string, seq bigint, ts_ms bigint, uuid string, type smallint, value double, reaction int, weight int, sample_level int, "
    "prev_level int, state_level int, state int, emitted boolean, upstate boolean, starttimes string, endtimes string, values string"
)
# What an alert says of the point behind it, besides its time and number.
POINT_FIELDS = {"uuid": "string", "type": "smallint", "reaction": "int", "value": "double", "message": "string"}
_EVENT_ROWS = (
    "series_key string, seq bigint, kind string, event_ms bigint, prev_level int, state_level int, state int, point_ms bigint, "
    + ", ".join(f"{c} {t}" for c, t in POINT_FIELDS.items())
    + ", starttimes string, endtimes string"
)
TIMER_ROWS = _EVENT_ROWS
ABSENCE_ROWS = _EVENT_ROWS + ", last_seen_ms bigint"


def score_stream(points: DataFrame, baseline: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Stateless scoring of a stream against a stored baseline table."""
    probes = points.withColumn("slot_ms", hour_slot(F.col("ts_ms")))
    joined = probes.join(reference_table(baseline, settings), ["series_key", "slot_ms"], "left")
    return joined.withColumns(score_columns(settings)).select(*points.columns, "n_refs", "weight", "weight_pct")


def control_rows(series_controls: DataFrame, level_controls: DataFrame, catalog: DataFrame) -> DataFrame:
    """Control messages as one row per series concerned; a tenant's update goes to all its series."""
    named = series_controls.select("series_key", "ts_ms", "seq", "action")
    fanned = level_controls.where(F.col("action") == ACTION_UPDATE_LEVELS).join(catalog.select("uuid", "series_key"), "uuid")
    return named.unionByName(fanned.select("series_key", "ts_ms", "seq", "action", "rules"), allowMissingColumns=True)


def _numbered_like(schema: str, rows: DataFrame) -> str:
    """The schema with numbers of the kind that the rows have: whole numbers or texts in the order of arrival."""
    return schema.replace("seq bigint", f"seq {dict(rows.dtypes)['seq']}")


def _given(rows: DataFrame, column: str, kind: str):
    """A column of the rows, or NULL where they have none."""
    return (F.col(column) if column in rows.columns else F.lit(None)).cast(kind).alias(column)


def _or_none(value):
    return None if pd.isna(value) else value


def _plain(number):
    return number if isinstance(number, str) else int(number)


def _sorted_batches(batches: Iterator[pd.DataFrame], order: list[str]) -> Iterator[tuple]:
    rows = pd.concat(list(batches)).sort_values(order, kind="stable")
    return rows.itertuples(index=False)


def level_states_stream(
    scored: DataFrame, controls: DataFrame | None = None, settings: Settings = DEFAULTS
) -> DataFrame:
    """Running regression, levels and level states of a stream of scored points.

    ``scored`` may bring its tenants' ``rules``; control rows travel in the same keyed stream.
    """
    points = scored if "rules" in scored.columns else scored.withColumn("rules", rules_literal(settings.default_levels))
    columns = ["series_key", "seq", "ts_ms", "uuid", "value", "reaction", "weight", "weight_pct"]
    rows = points.select(*columns, _given(points, "type", "smallint"), F.to_json("rules").alias("rules"), F.lit(None).cast("string").alias("action"))
    if controls is not None:
        marks = controls.withColumn("rules", F.to_json("rules"))
        rows = rows.unionByName(marks.select("series_key", "seq", "ts_ms", "action", "rules"), allowMissingColumns=True)
    window = settings.window_samples
    decoded: dict[str, list] = {}

    def rules_of(text: str) -> list:
        if text not in decoded:
            decoded[text] = json.loads(text)
        return decoded[text]

    def work(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        kept = json.loads(state.get[0]) if state.exists else {"machine": None, "rules": None}
        machine = LevelMachine.load(kept["machine"], window)
        updated = kept["rules"]
        out = []
        merged = pd.concat(list(batches))
        merged["_point"] = merged["action"].isna()
        for row in _sorted_batches(iter([merged]), ["ts_ms", "_point", "seq"]):
            if row.action == ACTION_DELETE_SERIES:
                machine.forget()
            elif row.action == ACTION_RESET_REGRESSION:
                machine.reset_fit()
            elif row.action == ACTION_UPDATE_LEVELS:
                updated = json.loads(row.rules)
            else:
                rules = updated if updated is not None else rules_of(row.rules)
                pct = None if pd.isna(row.weight_pct) else float(row.weight_pct)
                done = machine.point(int(row.ts_ms), float(row.value), int(row.reaction), int(row.weight), pct, rules)
                if done is not None:
                    out.append(
                        {
                            **{c: getattr(row, c) for c in ("seq", "ts_ms", "uuid", "value", "reaction", "weight")},
                            "type": _or_none(row.type),
                            **done,
                            "series_key": key[0],
                            "starttimes": json.dumps(machine.starts),
                            "endtimes": json.dumps(machine.ends),
                            "values": json.dumps([{"level": level, "value": value} for level, value in machine.samples]),
                        }
                    )
        state.update((json.dumps({"machine": machine.dump(), "rules": updated}),))
        names = [part.split()[0] for part in LEVEL_ROWS.split(", ")]
        yield pd.DataFrame(out, columns=names, dtype=object)

    return rows.groupBy("series_key").applyInPandasWithState(
        work, _numbered_like(LEVEL_ROWS, rows), STATE, "append", GroupStateTimeout.NoTimeout
    )


def _timed_stream(
    rows: DataFrame,
    schema: str,
    delay: str,
    take: Callable[[Timer, tuple], list[tuple]],
    expire: Callable[[Timer, int], list[tuple]],
    due: Callable[[Timer], int | None],
    settings: Settings,
) -> DataFrame:
    """Events of timers as (kind, time, ..., level before, level after), each with the point it belongs to.

    A timer's events belong to the point that set it, status and return to the point that has come.
    """
    names = [part.split()[0] for part in schema.split(", ")]
    levels = event_levels(settings)
    tick_ms = settings.tick_ms

    def work(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        fresh = {"timer": {"tick_ms": tick_ms}, "point": {}, "starts": {}, "ends": {}}
        kept = json.loads(state.get[0]) if state.exists else fresh
        timer, point, starts, ends = Timer(**kept["timer"]), kept["point"], kept["starts"], kept["ends"]
        out = []

        def tell(event: tuple, of: dict) -> None:
            kind, at, *seen, before, after = event
            for level in levels:
                if before < level <= after:
                    starts[str(level)] = seen[0] if seen else at
                elif after < level <= before:
                    ends[str(level)] = at
            if kind == "absent":
                of = {c: v for c, v in of.items() if c in ("uuid", "seq")}
            out.append(
                {
                    "series_key": key[0],
                    "kind": kind,
                    "event_ms": at,
                    "last_seen_ms": seen[0] if seen else None,
                    "prev_level": before,
                    "state_level": after,
                    "state": state_of(before, after),
                    "starttimes": json.dumps(starts),
                    "endtimes": json.dumps(ends),
                    **of,
                }
            )

        if state.hasTimedOut:
            for event in expire(timer, state.getCurrentWatermarkMs()):
                tell(event, point)
        else:
            # At one instant a control comes before the points.
            for row in _sorted_batches(batches, ["ts_ms", "is_point", "seq"]):
                before, new = point, point
                if row.is_point:
                    new = {c: _or_none(getattr(row, c)) for c in POINT_FIELDS}
                    new = {c: v.item() if hasattr(v, "item") else v for c, v in new.items()}
                    new |= {"seq": _plain(row.seq), "point_ms": int(row.ts_ms)}
                for event in take(timer, row):
                    tell(event, new if event[0] in ("status", "back") else before)
                if row.is_point:
                    point = new
                else:
                    starts.clear()
                    ends.clear()
        at = due(timer)
        state.update((json.dumps({"timer": timer.__dict__, "point": point, "starts": starts, "ends": ends}),))
        if at is not None:
            state.setTimeoutTimestamp(max(at, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(out, columns=names, dtype=object)

    timed = rows.withColumn("ts", to_timestamp(F.col("ts_ms"))).withWatermark("ts", delay)
    return timed.groupBy("series_key").applyInPandasWithState(
        work, _numbered_like(schema, rows), STATE, "append", GroupStateTimeout.EventTimeTimeout
    )


def special_stream(
    points: DataFrame, delay: str = "1 minute", settings: Settings = DEFAULTS, series_controls: DataFrame | None = None
) -> DataFrame:
    """Status, auto-close and dead-man events; silent series fire as the watermark moves on.

    A delete among ``series_controls`` makes its series start anew and stops its timers.
    """
    known = with_status_level(points, settings).where(F.col("status_level").isNotNull())
    fields = [_given(known, c, t) for c, t in POINT_FIELDS.items()]
    rows = known.select("series_key", "seq", "ts_ms", *fields, "status_level", F.lit(True).alias("is_point"))
    if series_controls is not None:
        deletes = series_controls.where(F.col("action") == ACTION_DELETE_SERIES)
        marks = deletes.select("series_key", "seq", "ts_ms", F.lit(False).alias("is_point"))
        rows = rows.unionByName(marks, allowMissingColumns=True)
    return _timed_stream(
        rows,
        TIMER_ROWS,
        delay,
        take=lambda timer, row: (
            timer.special_point(int(row.ts_ms), int(row.reaction), int(row.status_level))
            if row.is_point
            else timer.delete(int(row.ts_ms))
        ),
        expire=lambda timer, now: timer.fire_special(now),
        due=lambda timer: timer.next_special(),
        settings=settings,
    )


def absence_stream(heartbeats: DataFrame, delay: str = "1 minute", settings: Settings = DEFAULTS) -> DataFrame:
    """Silence and return of hosts, from a stream of heartbeats."""
    limit = settings.absence_limit_ms
    fields = [_given(heartbeats, c, t) for c, t in POINT_FIELDS.items()]

    def due(timer: Timer) -> int | None:
        return None if timer.last_ms is None or timer.fired_ms is not None else timer.due_after(limit)

    return _timed_stream(
        heartbeats.select("series_key", "seq", "ts_ms", *fields, F.lit(True).alias("is_point")),
        ABSENCE_ROWS,
        delay,
        take=lambda timer, row: timer.heartbeat(int(row.ts_ms), limit),
        expire=lambda timer, now: timer.fire_absence(now, limit),
        due=due,
        settings=settings,
    )
