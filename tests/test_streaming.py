"""Streams against batches: the same rows, also over many micro-batches and after a restart."""

import json

import pytest
from pyspark.sql import functions as F

from tidewatch.config import Settings
from tidewatch.operators import absence, control, special
from tidewatch.operators.alerts import absence_alerts, from_stream, level_alerts, route_alerts, special_alerts
from tidewatch.operators.baseline import hourly_baseline
from tidewatch.operators.catalog import series_catalog
from tidewatch.operators.ingest import dead_letters, good_points, heartbeats, parse_messages
from tidewatch.plans.monitor import monitor
from tidewatch.sinks.tables import (
    read_catalog,
    read_points,
    update_catalog,
    write_alerts,
    write_baseline,
    write_error_log,
    write_points,
    write_regression,
)
from tidewatch.schemas import BASELINE
from tidewatch.sources import events
from tidewatch.sources.messages import MESSAGES, stored_table, stream_table
from tidewatch.streaming.ingest import start_ingest
from tidewatch.streaming.stateful import absence_stream, control_rows, level_states_stream, score_stream, special_stream


def in_files(df, path, column, parts):
    """Write rows as ``parts`` files, in order of ``column``, oldest file first."""
    bounds = df.approxQuantile(column, [i / parts for i in range(1, parts)], 0.0) if parts > 1 else []
    edges = [None, *bounds, None]
    for low, high in zip(edges, edges[1:]):
        part = df
        if low is not None:
            part = part.where(F.col(column) > low)
        if high is not None:
            part = part.where(F.col(column) <= high)
        part.coalesce(1).write.mode("append").parquet(path)
    return path


def drain(stream, folder, mode="append"):
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/check")
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.parquet(f"{folder}/out")


def test_ingest_stream_equals_batch(spark, folder, tmp_path):
    messages = events.raw_messages(spark, folder)
    source = in_files(messages, f"{tmp_path}/in", "msg_id", 3)
    start_ingest(stream_table(spark, source, MESSAGES, 1), f"{tmp_path}/tables").awaitTermination()
    parsed = parse_messages(messages).persist()
    points = good_points(parsed)
    columns = ["series_key", "ts_ms", "value", "seq", "is_special"]
    stored = read_points(spark, f"{tmp_path}/tables/points").select(*columns)
    assert sorted(stored.collect()) == sorted(points.select(*columns).collect())
    dead = spark.read.parquet(f"{tmp_path}/tables/dead").select("msg_id", "pos", "reason")
    assert sorted(map(str, dead.collect())) == sorted(map(str, dead_letters(parsed).select("msg_id", "pos", "reason").collect()))
    wanted = ["series_key", "first_ts_ms", "last_ts_ms", "last_seq", "n_points"]
    found = read_catalog(spark, f"{tmp_path}/tables/catalog", 2).select(*wanted)
    assert sorted(found.collect()) == sorted(series_catalog(points).select(*wanted).collect())


def test_level_stream_equals_batch_with_controls_and_restart(spark, folder, tmp_path):
    points = events.metric_points(spark, folder)
    base = hourly_baseline(points).persist()
    decoded = control.good_controls(control.decode_control(events.control_messages(spark, folder)))
    catalog = series_catalog(points)
    per_series = control.resolve_series(decoded, catalog)
    batch = monitor(points, baseline=base, controls=decoded, series_controls=per_series, with_values=False, with_times=False)

    marks = control_rows(per_series, decoded, catalog).persist()
    rows = points.select("series_key", "seq", "ts_ms", "uuid", "value", "reaction")
    half = 1_705_363_200_000
    p_path, c_path = f"{tmp_path}/p", f"{tmp_path}/c"
    schema, c_schema = rows.schema, marks.schema

    def start():
        scored = score_stream(stream_table(spark, p_path, schema, 1), base)
        return drain(level_states_stream(scored, stream_table(spark, c_path, c_schema, 1)), str(tmp_path))

    for low, high in ((0, half), (half, 2**62)):
        inside = (F.col("ts_ms") >= low) & (F.col("ts_ms") < high)
        rows.where(inside).coalesce(1).write.mode("append").parquet(p_path)
        marks.where(inside).coalesce(1).write.mode("append").parquet(c_path)
        result = start()
    columns = ["seq", "prev_level", "state_level", "state", "emitted", "upstate"]
    got = {r.seq: tuple(r) for r in result.select(*columns).collect()}
    expected = {r.seq: tuple(r) for r in batch.select(*columns).collect()}
    assert got == expected


def test_level_stream_over_small_files(spark, folder, tmp_path):
    points = events.metric_points(spark, folder)
    base = hourly_baseline(points).persist()
    rows = points.select("series_key", "seq", "ts_ms", "uuid", "value", "reaction")
    # File order is not time order across files of one listing, so only counts are compared per file.
    source = in_files(rows, f"{tmp_path}/in", "ts_ms", 4)
    result = drain(level_states_stream(score_stream(stream_table(spark, source, rows.schema, 1), base)), str(tmp_path))
    batch = monitor(points, baseline=base, with_values=False)
    columns = ["seq", "prev_level", "state_level", "state", "emitted"]
    assert sorted(map(tuple, result.select(*columns).collect())) == sorted(map(tuple, batch.select(*columns).collect()))
    ends = {r.seq: {int(k): v for k, v in json.loads(r.endtimes).items()} for r in result.collect()}
    assert ends == {r.seq: r.endtimes for r in batch.select("seq", "endtimes").collect()}


def records(alert_rows):
    routed = route_alerts(alert_rows).select("topic", "role", "value").collect()
    return sorted((r.topic, r.role, json.dumps(json.loads(r.value), sort_keys=True)) for r in routed)


def test_streamed_records_equal_batch_records(spark, folder, tmp_path):
    points = events.metric_points(spark, folder)
    base = hourly_baseline(points).persist()
    rows = points.select("series_key", "seq", "ts_ms", "uuid", "type", "value", "reaction")
    source = in_files(rows, f"{tmp_path}/in", "ts_ms", 2)
    states = drain(level_states_stream(score_stream(stream_table(spark, source, rows.schema, 1), base)), f"{tmp_path}/a")
    assert records(level_alerts(from_stream(states))) == records(level_alerts(monitor(points, baseline=base)))

    errors = events.special_points(spark, folder).drop("tags")
    as_of = errors.agg(F.max("ts_ms")).first()[0]
    source = in_files(errors, f"{tmp_path}/errors", "ts_ms", 3)
    found = drain(special_stream(stream_table(spark, source, errors.schema, 1)), f"{tmp_path}/b")
    batch = special.special_events(errors, as_of).where(F.col("event_ms") <= as_of)
    assert records(special_alerts(from_stream(found))) == records(special_alerts(batch))

    options = Settings(heartbeat_name="view", absence_limit_ms=600_000)
    beats = heartbeats(points, options).drop("tags")
    as_of = beats.agg(F.max("ts_ms")).first()[0]
    source = in_files(beats, f"{tmp_path}/beats", "ts_ms", 3)
    found = drain(absence_stream(stream_table(spark, source, beats.schema, 1), settings=options), f"{tmp_path}/c")
    batch = absence.absence_events(beats, as_of, settings=options)
    assert records(absence_alerts(from_stream(found))) == records(absence_alerts(batch))


@pytest.mark.parametrize("parts", [1, 4])
def test_special_stream_equals_batch(spark, folder, tmp_path, parts):
    points = events.special_points(spark, folder).select("series_key", "seq", "ts_ms", "status", "reaction")
    as_of = points.agg(F.max("ts_ms")).first()[0]
    source = in_files(points, f"{tmp_path}/in", "ts_ms", parts)
    result = drain(special_stream(stream_table(spark, source, points.schema, 1)), str(tmp_path))
    columns = ["seq", "kind", "event_ms", "prev_level", "state_level", "state"]
    # What the last points will raise lies past the watermark in a stream.
    batch = special.special_events(points, as_of).where(F.col("event_ms") <= as_of)
    assert sorted(map(tuple, result.select(*columns).collect())) == sorted(map(tuple, batch.select(*columns).collect()))


def test_special_stream_with_deletes_equals_batch(spark, tmp_path):
    start, minute = 1_704_067_200_000, 60_000
    rows = [("a", 0, 0, "ERROR", 2), ("a", 1, 10, "WARNING", -3), ("a", 2, 20, "ERROR", 4), ("a", 3, 40, "OK", 0), ("b", 4, 40, "OK", 0)]
    points = spark.createDataFrame([(k, s, start + minute * m, t, r) for k, s, m, t, r in rows], "series_key string, seq bigint, ts_ms bigint, status string, reaction int")
    marks = [("a", 100, start + minute * 5 + 1, "deletemetricbyhash"), ("a", 101, start + minute * 11, "deletemetricbyhash"), ("a", 102, start + minute * 20, "deletemetricbyhash")]
    controls = spark.createDataFrame(marks, "series_key string, seq bigint, ts_ms bigint, action string")
    columns = ["series_key", "seq", "kind", "event_ms", "prev_level", "state_level", "state"]
    batch = special.special_events(points, start + 40 * minute, series_controls=controls).select(*columns).collect()
    both = points.withColumn("action", F.lit(None).cast("string")).unionByName(controls, allowMissingColumns=True)
    both.coalesce(1).write.parquet(f"{tmp_path}/both")
    read = lambda: stream_table(spark, f"{tmp_path}/both", both.schema, 1)
    found = drain(special_stream(read().where("action IS NULL"), series_controls=read().where("action IS NOT NULL")), str(tmp_path))
    assert sorted(map(tuple, found.select(*columns).collect())) == sorted(map(tuple, batch))
    assert {r.kind for r in batch} == {"status", "deadman"}


@pytest.mark.parametrize("parts", [1, 4])
def test_absence_stream_equals_batch(spark, folder, tmp_path, parts):
    options = Settings(heartbeat_name="view", absence_limit_ms=600_000)
    beats = heartbeats(events.metric_points(spark, folder), options).select("series_key", "uuid", "seq", "ts_ms")
    as_of = beats.agg(F.max("ts_ms")).first()[0]
    source = in_files(beats, f"{tmp_path}/in", "ts_ms", parts)
    result = drain(absence_stream(stream_table(spark, source, beats.schema, 1), settings=options), str(tmp_path))
    columns = ["kind", "event_ms", "last_seen_ms", "state_level", "state"]
    batch = absence.absence_events(beats, as_of, settings=options).select(*columns)
    assert sorted(map(tuple, result.select(*columns).collect())) == sorted(map(tuple, batch.collect()))


def test_silence_fires_by_watermark_alone(spark, tmp_path):
    schema = "series_key string, seq bigint, ts_ms bigint"
    start = 1_704_067_200_000
    # The second series keeps the watermark moving while the first is silent.
    rows = [("a", 0, start)] + [("b", i, start + 60_000 * i) for i in range(1, 20)]
    frame = spark.createDataFrame(rows, schema)
    for low, high in ((0, 6), (6, 12), (12, 20)):
        part = frame.where((F.col("ts_ms") >= start + 60_000 * low) & (F.col("ts_ms") < start + 60_000 * high))
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = absence_stream(stream_table(spark, f"{tmp_path}/in", frame.schema, 1), delay="0 seconds")
    found = drain(stream, str(tmp_path)).where("series_key = 'a'").collect()
    assert [(r.kind, r.event_ms, r.last_seen_ms) for r in found] == [("absent", start + 4 * 60_000, start)]


def test_high_levels_in_the_streaming_machine():
    from tidewatch.streaming.machines import LevelMachine

    rule = lambda level: {"level": level, "min_weight": level, "min_pct": 0, "min_value": 0, "min_predict_pct": 0, "rec_count": 1}
    machine = LevelMachine(15)
    found = [machine.point(60_000 * i, 5.0, 0, w, 10.0, [rule(2), rule(9), rule(20)]) for i, w in enumerate([4, 9, 9, 30, 30])]
    assert [f["state_level"] for f in found] == [-1, 2, 9, 9, 20]
    assert set(machine.starts) == {"2", "9", "20"}


def test_sinks_can_be_repeated(spark, folder, tmp_path):
    points = events.metric_points(spark, folder)
    for _ in range(2):
        write_points(points, f"{tmp_path}/points", 1)
        write_baseline(hourly_baseline(points), f"{tmp_path}/baseline", 1)
        update_catalog(points, f"{tmp_path}/catalog", 0)
    assert read_points(spark, f"{tmp_path}/points").count() == points.count()
    assert stored_table(spark, f"{tmp_path}/baseline", BASELINE).count() == hourly_baseline(points).count()
    assert read_catalog(spark, f"{tmp_path}/catalog", 0).agg(F.sum("n_points")).first()[0] == points.count()
    low, high = 1_704_500_000_000, 1_705_000_000_000
    part = read_points(spark, f"{tmp_path}/points", low, high)
    assert part.count() == points.where(F.col("ts_ms").between(low, high)).count() > 0
    assert "date" in part._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    records = spark.createDataFrame([("t0-1", "{}"), ("errors", "{}")], "topic string, value string")
    write_alerts(records, f"{tmp_path}/alerts")
    assert spark.read.parquet(f"{tmp_path}/alerts").where("topic = 'errors'").count() == 1
    log = spark.createDataFrame([("t0", 1_704_067_200, "s", 3)], "uuid string, ts_s bigint, series_key string, weight int")
    write_error_log(log, f"{tmp_path}/log")
    assert spark.read.parquet(f"{tmp_path}/log").count() == 1
    write_regression(spark.createDataFrame([("s", 1.0)], "series_key string, n double"), f"{tmp_path}/fit")
    assert spark.read.parquet(f"{tmp_path}/fit").first().version == 0


def test_a_lost_catalog_version_is_noticed(spark, folder, tmp_path):
    points = events.metric_points(spark, folder)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        update_catalog(points, f"{tmp_path}/catalog", 3)


def test_absent_table_is_empty_but_a_broken_one_raises(spark, tmp_path):
    assert stored_table(spark, f"{tmp_path}/nowhere", BASELINE).count() == 0
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        stored_table(spark, f"{tmp_path}/broken", BASELINE).count()
