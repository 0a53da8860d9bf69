import json

import pytest
from pyspark.sql import functions as F

from helpers import DAY, HOUR, START, points
from tidewatch.config import Settings
from tidewatch.operators import absence, alerts, catalog, control, special
from tidewatch.operators.cells import Grain, WHOLE_SERIES
from tidewatch.operators.joins import lookup
from tidewatch.operators.levels import attach_rules, decode_levels, point_level, rows_to_rules, rules_to_rows, tenant_rules

MIN = 60_000
SPECIAL = "series_key string, ts_ms bigint, seq bigint, status string, reaction int, uuid string, type int, value double, message string"
CELLS = Grain(None, (("s", 2 * HOUR),))


def specials(spark, rows):
    full = [("s", ts, i, status, reaction, "t0", 1, 1.0, "m") for i, (ts, status, reaction) in enumerate(rows)]
    return spark.createDataFrame(full, SPECIAL)


def events(frame, as_of, grain=WHOLE_SERIES):
    found = special.special_events(frame, as_of, grain)
    rows = found.select("kind", "event_ms", "prev_level", "state_level", "state").collect()
    return sorted(tuple(r) for r in rows)


@pytest.mark.parametrize("grain", [WHOLE_SERIES, CELLS])
def test_autoclose_fires_once_on_the_tick_past_its_limit(spark, grain):
    frame = specials(spark, [(START, "ERROR", -2), (START + 10 * MIN + 1, "ERROR", -2)])
    assert events(frame, START + 5 * HOUR, grain) == [
        ("autoclose", START + 3 * MIN, 5, -1, 3),
        ("autoclose", START + 13 * MIN, 5, -1, 3),
        ("status", START, -1, 5, 0),
        ("status", START + 10 * MIN + 1, -1, 5, 0),
    ]


def test_autoclose_is_strict(spark):
    # Two minutes after the point is not more than two minutes.
    frame = specials(spark, [(START, "ERROR", -2)])
    assert len(events(frame, START + 2 * MIN)) == 1
    assert len(events(frame, START + 3 * MIN)) == 2


@pytest.mark.parametrize("grain", [WHOLE_SERIES, CELLS])
def test_deadman_repeats_until_the_next_point(spark, grain):
    frame = specials(spark, [(START, "OK", 1), (START + 5 * MIN, "OK", 1)])
    assert events(frame, START + 5 * MIN, grain) == [
        ("deadman", START + 2 * MIN, -1, 5, 0),
        ("deadman", START + 3 * MIN, 5, 5, 1),
        ("deadman", START + 4 * MIN, 5, 5, 1),
        ("status", START, -1, -1, 1),
        ("status", START + 5 * MIN, 5, -1, 3),
    ]


def test_deadman_first_only(spark):
    rows = special.with_neighbour_status(specials(spark, [(START, "OK", 1)]))
    assert special.deadman_events(rows, START + HOUR, first_only=True).count() == 1
    assert special.deadman_events(rows, START + HOUR).count() == 59


def test_unknown_status_is_set_aside(spark):
    frame = specials(spark, [(START, "OK", 0), (START + 1, "ODD", 0)])
    assert [r.status for r in special.unknown_status(frame).collect()] == ["ODD"]
    assert [e[0] for e in events(frame, START)] == ["status"]


@pytest.mark.parametrize("grain", [WHOLE_SERIES, CELLS])
def test_silence_and_return(spark, grain):
    beats = points(spark, [(START, 1, 0), (START + 3 * MIN, 1, 0), (START + 9 * MIN, 1, 0)])
    found = absence.absence_events(beats, START + 11 * MIN, grain)
    rows = found.select("kind", "event_ms", "last_seen_ms", "state_level", "state").collect()
    assert sorted(tuple(r) for r in rows) == [
        ("absent", START + 7 * MIN, START + 3 * MIN, 5, 0),
        ("back", START + 9 * MIN, START + 3 * MIN, -1, 3),
    ]


def test_latest_and_ties(spark):
    frame = points(spark, [(START + 5, 1, 0), (START + 9, 2, 0), (START + 9, 3, 0), (START, 4, 0)])
    assert catalog.latest_by_event_time(frame, ["value"]).first().value == 2.0
    assert catalog.latest_by_arrival(frame, ["value"]).first().value == 4.0
    assert catalog.deduplicate_points(frame).count() == 3


@pytest.mark.parametrize("max_rows, target_rows", [(100, 1000), (0, 1000), (0, 30)])
def test_lookup_is_the_same_broadcast_or_divided(spark, max_rows, target_rows):
    hot = points(spark, [(START + i, i, 0) for i in range(200)])
    rest = points(spark, [(START, 1, 0)], key="cold").unionByName(points(spark, [(START, 1, 0)], key="unknown"))
    table = spark.createDataFrame([("s", 7), ("cold", 8)], "series_key string, extra int")
    rows = lookup(hot.unionByName(rest), table, ["series_key"], max_rows, target_rows).collect()
    assert sorted((r.series_key, r.extra or 0) for r in rows) == [("cold", 8)] + [("s", 7)] * 200 + [("unknown", 0)]


def test_level_rows_and_rules_are_two_forms(spark):
    rules = tenant_rules(spark.createDataFrame([("a", '{"1":{"min_weight":3,"rec_count":2}}'), ("b", "")], "uuid string, AL string"))
    again = rows_to_rules(rules_to_rows(rules))
    assert sorted(map(str, again.collect())) == sorted(map(str, rules.collect()))


def test_levels_json(spark):
    users = spark.createDataFrame(
        [("a", '{"1":{"min_weight":3,"rec_count":2}}'), ("b", ""), ("c", None), ("d", "{bad"), ("e", "{}")], "uuid string, AL string"
    )
    rules = {r.uuid: r.rules for r in tenant_rules(users).collect()}
    assert [(r.level, r.min_weight, r.min_pct, r.rec_count) for r in rules["a"]] == [(1, 3.0, 0.0, 2)]
    assert all(len(rules[u]) == 6 for u in "bcde")
    assert spark.range(1).select(decode_levels(F.lit("{bad")).alias("r")).first().r is None


def test_point_level(spark):
    rows = [(16, 80.0, 1.0, 0.0), (16, None, 1.0, 0.0), (-8, -25.0, 1.0, 3.0), (2, 4.0, 1.0, 0.0), (0, 99.0, 1.0, 0.0)]
    frame = spark.createDataFrame(rows, "weight int, weight_pct double, value double, predict_pct double")
    assert [r.level for r in point_level(attach_rules(frame)).collect()] == [5, 5, 2, -1, -1]


def test_control_messages(spark):
    texts = [
        '{"action":"deletemetricbyhash","hash":123}',
        '{"action":"resetregresion"}',
        '{"action":"updatelevels","UUID":"t0","changedata":"{\\"0\\":{\\"min_weight\\":1}}"}',
        '{"action":"updatelevels","UUID":"t0","changedata":"{bad"}',
        '{"action":"updatelevels","changedata":"{}"}',
        '{"action":"other"}',
        "no json",
    ]
    frame = spark.createDataFrame([(START + i, i, t) for i, t in enumerate(texts)], "ts_ms bigint, seq bigint, value string")
    decoded = control.decode_control(frame)
    assert [r.seq for r in control.good_controls(decoded).orderBy("seq").collect()] == [0, 2]
    dead = control.control_dead_letters(decoded).orderBy("seq").collect()
    assert [(r.seq, r.reason) for r in dead] == [(1, "missing_hash"), (3, "bad_changedata"), (4, "missing_uuid")]


def test_rules_change_with_time(spark):
    frame = points(spark, [(START + i * 10, 1, 0) for i in range(5)])
    text = lambda w: json.dumps({"action": "updatelevels", "UUID": "t0", "changedata": json.dumps({"0": {"min_weight": w}})})
    messages = spark.createDataFrame([(START + 10, 0, text(1)), (START + 35, 1, text(2))], "ts_ms bigint, seq bigint, value string")
    controls = control.good_controls(control.decode_control(messages))
    for grain in (WHOLE_SERIES, Grain(10)):
        ruled = control.attach_versioned_rules(frame, controls, grain=grain).orderBy("seq").collect()
        assert [r.rules[0].min_weight for r in ruled] == [2.0, 1.0, 1.0, 1.0, 2.0]
        assert [len(r.rules) for r in ruled] == [6, 1, 1, 1, 1]


def test_routing(spark):
    rows = [("t0", 2, -1, 0), ("t0", 2, 2, 1), ("t0", 1, 2, 2)]
    columns = "uuid string, level int, prev_level int, action int"
    frame = spark.createDataFrame(rows, columns)
    rest = [c for c in alerts.EVENT_COLUMNS if c not in ("uuid", "level", "prev_level", "action")]
    full = frame.select("*", *[F.lit(None).cast("string").alias(c) for c in rest])
    routed = alerts.route_alerts(full, Settings(main_topic="all")).collect()
    assert [(r.action, r.topic) for r in routed] == [(0, "t02"), (0, "t0-1"), (0, "all"), (1, "t02"), (2, "t01"), (2, "t02"), (2, "all")]
    assert [("UUID" in json.loads(r.value)) for r in routed] == [r.topic == "all" for r in routed]
    assert "message" not in json.loads(routed[0].value)


def test_error_log_keeps_the_last_write(spark):
    frame = points(spark, [(START, 1, 0), (START + 1, 2, 0), (START + 2, 3, -3), (START + 1000, 4, 0)])
    scored = frame.withColumns({"weight": F.lit(3), "weight_pct": F.lit(1.0), "predict_pct": F.lit(0.0)})
    assert sorted(r.value for r in alerts.error_log(scored).collect()) == [2.0, 4.0]


def test_observation_counts(spark):
    tapped, seen = alerts.observed(points(spark, [(START, 1, 0), (START + DAY, 2, 0)]), "tap")
    assert tapped.count() == 2
    assert seen.get["n_rows"] == 2 and seen.get["n_value"] == 2
