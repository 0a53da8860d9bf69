import pytest
from pyspark.sql import functions as F

from tidewatch.functions.identity import series_key
from tidewatch.operators.ingest import dead_letters, good_points, parse_messages, synthesize_absence
from tidewatch.sources import events

GOOD = '{"metric":"a","timestamp":1704067200000,"value":1.5,"tags":{"UUID":"t0","host":"h"}}'


def parse(spark, *messages):
    frame = spark.createDataFrame(list(enumerate(messages)), "msg_id bigint, value string")
    return parse_messages(frame)


@pytest.mark.parametrize(
    "element, reason",
    [
        ("7", "bad_element"),
        ('"text"', "bad_element"),
        ("null", "bad_element"),
        ("[1]", "bad_element"),
        ('{"timestamp":1,"value":1,"tags":{"UUID":"t"}}', "missing_name"),
        ('{"metric":"a","value":1,"tags":{"UUID":"t"}}', "missing_timestamp"),
        ('{"metric":"a","timestamp":1,"tags":{"UUID":"t"}}', "missing_value"),
        ('{"metric":"a","timestamp":1,"value":"abc","tags":{"UUID":"t"}}', "missing_value"),
        ('{"metric":"a","timestamp":1,"value":1}', "missing_tags"),
        ('{"metric":"a","timestamp":1,"value":1,"tags":5}', "missing_tags"),
        ('{"metric":"a","timestamp":1,"value":1,"tags":{"host":"h"}}', "missing_uuid"),
    ],
)
def test_bad_element_leaves_siblings(spark, element, reason):
    parsed = parse(spark, f"[{GOOD},{element},{GOOD}]").persist()
    assert good_points(parsed).count() == 2
    assert [(r.pos, r.reason) for r in dead_letters(parsed).collect()] == [(1, reason)]


@pytest.mark.parametrize(
    "message, reason",
    [
        ('{"metric":"a"}', "not_array"),
        ("5", "not_array"),
        ('{"UUID":"u","tags":{"timestamp":1,"host":"h"},"data":{"vle_1":10.0}}', "not_array"),
        ("[{bad", "bad_json"),
        ("", "bad_json"),
        ("[1] xyz", "bad_json"),
        ("{'a':1}", "not_array"),
    ],
)
def test_bad_message(spark, message, reason):
    parsed = parse(spark, message)
    assert [(r.pos, r.reason, r.raw) for r in dead_letters(parsed).collect()] == [(None, reason, message)]


def test_empty_array_yields_nothing(spark):
    assert parse(spark, "[]").count() == 0


def test_lenient_spellings(spark):
    text = "[{'metric':'a', timestamp:1.465210293E12, 'value':'2.5', tags:{UUID:'t0'}, type:'SPECIAL', reaction:'-2', status:'ERROR'}]"
    row = good_points(parse(spark, text)).first()
    assert (row.ts_ms, row.value, row.is_special, row.type, row.reaction, row.status) == (1465210293000, 2.5, True, 1, -2, "ERROR")


def test_every_element_ends_up_once(spark, folder):
    messages = events.raw_messages(spark, folder)
    parsed = parse_messages(messages).persist()
    points = good_points(parsed)
    assert points.count() + dead_letters(parsed).count() == parsed.count()
    assert points.select("seq").distinct().count() == points.count()


def test_spelled_out_key_is_canonical(spark, folder):
    for frame in (events.metric_points(spark, folder), events.special_points(spark, folder, by_user=True)):
        assert frame.where(F.col("series_key") != series_key(F.col("name"), F.col("tags"))).count() == 0


def test_key_ignores_tag_order(spark):
    row = spark.sql("SELECT map('b', '2', 'a', '1') AS x, map('a', '1', 'b', '2') AS y")
    one = row.select(series_key(F.lit("n"), F.col("x")).alias("x"), series_key(F.lit("n"), F.col("y")).alias("y")).first()
    assert one.x == one.y == 'n|{"a":"1","b":"2"}'


def test_absence_twins(spark):
    points = good_points(parse(spark, "[" + GOOD.replace('"a"', '"host_alive"') + "," + GOOD + "]"))
    rows = synthesize_absence(points).where("is_special").collect()
    assert [(r.name, r.status, r.message, r.type) for r in rows] == [("host_absent", "ERROR", "Host Absent", 1)]
    assert rows[0].series_key.startswith("host_absent|")


def test_a_range_of_events_is_read_as_such(spark, folder):
    from tidewatch.sources.events import metric_points

    low, high = 1_704_500_000_000, 1_705_000_000_000
    part, whole = metric_points(spark, folder, low, high), metric_points(spark, folder)
    assert part.count() == whole.where(F.col("ts_ms").between(low, high)).count() > 0
    assert "GreaterThanOrEqual(ts" in part._jdf.queryExecution().executedPlan().toString()


def test_numbers_keep_the_order_of_arrival(spark):
    from tidewatch.functions.arrival import element_number
    from tidewatch.sources.messages import control_messages, topic_messages

    rows = [
        (600, 0, "2024-01-01 00:00:00.001", "late"),
        (0, 2**34, "2024-01-01 00:00:00", "c"),
        (1, 0, "2024-01-01 00:00:00", "d"),
        (0, 2**34 - 1, "2024-01-01 00:00:00", "b"),
        (3, 7, "2023-12-31 23:59:59", "a"),
    ]
    raw = spark.createDataFrame(rows, "partition int, offset bigint, at string, value string")
    messages = topic_messages(raw.withColumn("timestamp", F.col("at").cast("timestamp")))
    assert [r.value for r in messages.orderBy("msg_id").collect()] == ["a", "b", "c", "d", "late"]
    assert messages.select("msg_id").distinct().count() == 5
    controls = control_messages(messages)
    assert controls.columns == ["ts_ms", "seq", "value"] and controls.orderBy("seq").first().ts_ms == 1_704_067_199_000
    places = spark.createDataFrame([(1, 2**20 + 1), (2, 0), (1, 9), (1, 10)], "msg_id bigint, pos int")
    ordered = places.orderBy(element_number(F.col("msg_id"), False, F.col("pos"))).collect()
    assert [tuple(r) for r in ordered] == [(1, 9), (1, 10), (1, 2**20 + 1), (2, 0)]


def test_the_last_arrival_wins_over_partitions(spark):
    from tidewatch.operators.catalog import latest_by_arrival
    from tidewatch.sources.messages import topic_messages

    body = '[{"metric":"a","timestamp":1704067200000,"value":%d,"tags":{"UUID":"t0","host":"h"}}]'
    rows = [(0, 5, "2024-01-01 00:00:05", body % 2), (9, 1, "2024-01-01 00:00:01", body % 1)]
    raw = spark.createDataFrame(rows, "partition int, offset bigint, at string, value string")
    points = good_points(parse_messages(topic_messages(raw.withColumn("timestamp", F.col("at").cast("timestamp")))))
    assert [r.value for r in latest_by_arrival(points, ["value"]).collect()] == [2.0]
