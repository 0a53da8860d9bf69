"""Baselines built by a running stream, scores against them, lateness and the catalog's log."""

import pytest
from helpers import DAY, HOUR, START, points as rows_of
from pyspark.sql import functions as F

from tidewatch.config import REACTION_LATE, REACTION_MUTED
from tidewatch.operators.baseline import build_missing, hourly_baseline, merged_baseline, slot_moments, wanted_slots
from tidewatch.operators.catalog import latest_by_arrival, latest_by_event_time, series_catalog
from tidewatch.operators.ingest import good_points, parse_messages
from tidewatch.operators.lateness import with_late_reaction, with_seen
from tidewatch.operators.score import score_points
from tidewatch.sinks.ledger import batch_version, finish, last_version
from tidewatch.sinks.tables import catalog_manifest, read_catalog, update_catalog
from tidewatch.sources import events
from tidewatch.sources.messages import MESSAGES, stream_table
from tidewatch.streaming.ingest import start_ingest
from tidewatch.streaming.live import advance, read_horizon, start_scoring


def close_to(got, wanted):
    assert set(got) == set(wanted)
    for key, values in wanted.items():
        assert got[key] == pytest.approx(values, rel=1e-9, abs=1e-9), key


def by_slot(frame):
    return {(r.series_key, r.slot_ms): (r.n, r.avg, r.dev, r.min, r.max) for r in frame.collect()}


@pytest.fixture(scope="module")
def live(spark, folder, tmp_path_factory):
    """Ten days of events through a stream, a day in each file; the last two days over a new checkpoint."""
    home = tmp_path_factory.mktemp("live")
    points = events.metric_points(spark, folder).where(F.col("ts_ms") < START + 10 * DAY)
    for part, (low, high) in enumerate(((0, 8), (8, 10))):
        for day in range(low, high):
            inside = F.col("ts_ms").between(START + day * DAY, START + (day + 1) * DAY - 1)
            points.where(inside).coalesce(1).write.mode("append").parquet(f"{home}/in{part}")
        source = stream_table(spark, f"{home}/in{part}", points.schema, 1)
        start_scoring(source, f"{home}/tables", checkpoint=f"{home}/check{part}").awaitTermination()
    return points.persist(), str(home)


def test_stream_fills_the_baseline_table(spark, live):
    points, home = live
    _, closed = read_horizon(spark, f"{home}/tables", last_version(spark, f"{home}/tables"))
    assert closed > START + 9 * DAY
    stored = spark.read.parquet(f"{home}/tables/baseline")
    wanted = hourly_baseline(points).where(F.col("slot_ms") < closed)
    close_to(by_slot(stored.where("n > 0")), by_slot(wanted))
    assert stored.groupBy("series_key", "slot_ms").count().where("count > 1").count() == 0


def test_stream_marks_hours_without_points(spark, live):
    points, home = live
    stored = spark.read.parquet(f"{home}/tables/baseline")
    got = {(r.series_key, r.slot_ms) for r in stored.where("n = 0").collect()}
    empty = spark.createDataFrame([], "series_key string, slot_ms bigint")
    every = build_missing(wanted_slots(points), empty, points).where("n = 0")
    _, closed = read_horizon(spark, f"{home}/tables", last_version(spark, f"{home}/tables"))
    wanted = {(r.series_key, r.slot_ms) for r in every.collect() if r.slot_ms < closed}
    assert got == wanted and got


def test_streamed_scores_equal_batch_scores(spark, live):
    points, home = live
    columns = ["seq", "n_refs", "weight", "reaction"]
    got = {r.seq: tuple(r) for r in spark.read.parquet(f"{home}/tables/scored").select(*columns).collect()}
    wanted = {r.seq: tuple(r) for r in score_points(points).select(*columns).collect()}
    assert got == wanted
    assert sum(r[2] != 0 for r in got.values()) > 20


def test_only_the_days_referred_to_are_read(spark, live):
    from tidewatch.operators.baseline import referred_slots
    from tidewatch.sinks.tables import read_baseline

    points, home = live
    last = points.where(F.col("ts_ms") >= START + 9 * DAY)
    read = read_baseline(spark, f"{home}/tables/baseline", referred_slots(last))
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert 0 < read.count() <= 7 * 24 * 5


def test_repeated_version_gives_the_same_tables(spark, tmp_path):
    rows = [(START + k * HOUR // 3, k % 7, 0) for k in range(3 * 24 * 3)]
    points = rows_of(spark, rows)
    first, second = points.where("seq < 100"), points.where("seq >= 100")
    advance(first, str(tmp_path), 0)
    for _ in range(2):
        advance(second, str(tmp_path), 1)
    stored = spark.read.parquet(f"{tmp_path}/baseline").where("n > 0")
    _, closed = read_horizon(spark, str(tmp_path), 1)
    close_to(by_slot(stored), by_slot(hourly_baseline(points).where(F.col("slot_ms") < closed)))
    assert spark.read.parquet(f"{tmp_path}/scored").count() == points.count()


def test_late_points_get_their_reaction_and_spare_closed_hours(spark, tmp_path):
    on_time = [(START + 10 * HOUR, 1, 0), (START + 12 * HOUR, 2, 0)]
    late = [(START + 10 * HOUR + 1, 50, 0), (START + 11 * HOUR + 1, 60, 0), (START + 9 * HOUR, 70, REACTION_MUTED)]
    every = rows_of(spark, [*on_time, *late])
    advance(every.where("seq < 2"), str(tmp_path), 0)
    scored = {r.seq: r.reaction for r in advance(every.where("seq >= 2"), str(tmp_path), 1).collect()}
    assert scored == {2: REACTION_LATE, 3: 0, 4: REACTION_MUTED}
    advance(rows_of(spark, [(START + 20 * HOUR, 1, 0)]), str(tmp_path), 2)
    got = by_slot(spark.read.parquet(f"{tmp_path}/baseline").where("n > 0"))
    assert {k[1]: v[0] for k, v in got.items()} == {START + 10 * HOUR: 1, START + 11 * HOUR: 1, START + 12 * HOUR: 1}


def test_an_empty_batch_changes_nothing(spark, tmp_path):
    points = rows_of(spark, [(START, 1, 0), (START + 5 * HOUR, 2, 0)])
    advance(points.limit(0), str(tmp_path), 0)
    advance(points, str(tmp_path), 1)
    before = read_horizon(spark, str(tmp_path), 1)
    advance(points.limit(0), str(tmp_path), 2)
    assert read_horizon(spark, str(tmp_path), 2) == before


def test_moments_merge_to_the_baseline_of_all_points(spark):
    rows = [(START + k * 60_000, 1e5 + k % 5, 0) for k in range(300)]
    points = rows_of(spark, rows)
    parts = [slot_moments(points.where(F.col("seq") % 7 == b)).withColumn("batch", F.lit(b)) for b in range(7)]
    log = parts[0]
    for part in parts[1:]:
        log = log.unionByName(part)
    close_to(by_slot(merged_baseline(log)), by_slot(hourly_baseline(points)))


@pytest.mark.parametrize("parts", [1, 5])
def test_seen_is_the_maximum_before_in_order_of_arrival(spark, parts):
    times = [5, 3, 9, 9, 1, 20, 4, 30, 29, 30, 2]
    points = rows_of(spark, [(t, 0, 0) for t in times]).repartition(parts)
    for before in (None, 10):
        got = {r.seq: r.seen_ms for r in with_seen(points, seen_ms=before).collect()}
        earlier = [[t for t in [before, *times[:k]] if t is not None] for k in range(len(times))]
        assert got == {k: max(e, default=None) for k, e in enumerate(earlier)}
    late = {r.seq for r in with_late_reaction(points, 5).where(F.col("reaction") == REACTION_LATE).collect()}
    assert late == {k for k, t in enumerate(times) if k and t < max(times[:k]) - 5}


def test_latest_of_parsed_points(spark, folder):
    points = good_points(parse_messages(events.raw_messages(spark, folder)))
    coarse = points.withColumn("ts_ms", F.col("ts_ms") - F.pmod("ts_ms", F.lit(DAY))).persist()
    rows = coarse.select("series_key", "ts_ms", "seq").collect()
    wanted = {}
    for r in sorted(rows, key=lambda r: (r.ts_ms, [-ord(c) for c in r.seq])):
        wanted[r.series_key] = (r.ts_ms, r.seq)
    got = {r.series_key: (r.ts_ms, r.seq) for r in latest_by_event_time(coarse, ["ts_ms", "seq"]).collect()}
    assert got == wanted
    assert {r.seq for r in latest_by_arrival(coarse, ["seq"]).collect()} == {
        max(r.seq for r in rows if r.series_key == key) for key in wanted
    }


def test_catalog_keeps_its_series_over_a_new_checkpoint(spark, folder, tmp_path):
    messages = events.raw_messages(spark, folder).persist()
    half = messages.agg(F.percentile("msg_id", 0.5)).first()[0]
    for part, some in enumerate((messages.where(F.col("msg_id") <= half), messages.where(F.col("msg_id") > half))):
        some.coalesce(1).write.parquet(f"{tmp_path}/in{part}")
        stream = stream_table(spark, f"{tmp_path}/in{part}", MESSAGES)
        start_ingest(stream, f"{tmp_path}/tables", checkpoint=f"{tmp_path}/check{part}").awaitTermination()
    columns = ["series_key", "first_ts_ms", "last_ts_ms", "last_seq", "n_points"]
    whole = series_catalog(good_points(parse_messages(messages))).select(*columns)
    assert sorted(read_catalog(spark, f"{tmp_path}/tables/catalog").select(*columns).collect()) == sorted(whole.collect())
    assert last_version(spark, f"{tmp_path}/tables") == 1


def test_only_touched_buckets_are_written(spark, folder, tmp_path):
    points = events.user_points(spark, folder).persist()
    keys = sorted(r.series_key for r in points.select("series_key").distinct().collect())
    path = f"{tmp_path}/catalog"
    update_catalog(points, path, 0, buckets=64)
    few = points.where(F.col("series_key").isin(keys[:2]))
    for _ in range(2):
        update_catalog(few, path, 1, buckets=64)
    held = catalog_manifest(spark, path, 1)
    assert 1 <= sum(v == 1 for v in held.values()) <= 2 and len(held) > 10
    counts = {r.series_key: r.n_points for r in read_catalog(spark, path).collect()}
    once = {r.series_key: r["count"] for r in points.groupBy("series_key").count().collect()}
    assert counts == {k: n * (2 if k in keys[:2] else 1) for k, n in once.items()}
    assert read_catalog(spark, path, 0).agg(F.sum("n_points")).first()[0] == points.count()
    update_catalog(points.limit(0), path, 2, buckets=64)
    assert read_catalog(spark, path).count() == len(keys)


def test_versions_go_on_over_streams_and_repeat_for_a_batch(spark, tmp_path):
    home = str(tmp_path)
    assert last_version(spark, home) is None and batch_version(spark, home, "a", 0) == 0
    finish(spark, home, "a", 0, 0)
    assert batch_version(spark, home, "a", 0) == 0 and batch_version(spark, home, "a", 1) == 1
    finish(spark, home, "a", 1, 1)
    assert batch_version(spark, home, "b", 0) == 2
