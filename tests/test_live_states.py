"""Level states of a stream, carried from batch to batch, against the batch path over all points."""

import random

import pytest
from helpers import DAY, START, points
from pyspark.sql import functions as F

from tidewatch.config import ACTION_UPDATE_LEVELS, DEFAULT_LEVELS, REACTION_LATE
from tidewatch.operators.baseline import hourly_baseline
from tidewatch.operators.cells import WHOLE_SERIES, Grain
from tidewatch.operators.levels import rules_literal
from tidewatch.plans.monitor import monitor
from tidewatch.sinks.tables import catalog_manifest
from tidewatch.sources.messages import stream_table
from tidewatch.streaming.states import advance_states, start_states

COLUMNS = ["series_key", "seq", "level", "prev_level", "state_level", "state", "emitted", "upstate", "starttimes", "endtimes"]


def plain(frame):
    return sorted(map(str, frame.select(*COLUMNS).collect()))


def _hot_and_rare(spark):
    """A series with nine tenths of the rows and one with few, over eight days of history."""
    rng = random.Random(4)
    past = [(START + 1_800_000 * i, 10 + rng.random(), 0) for i in range(8 * 48)]
    wave = [(START + 8 * DAY + 60_000 * i, rng.choice([5, 10, 40, 60, 90]) * (3 if i // 60 % 2 else 1), rng.choice([0, 0, 0, -3])) for i in range(400)]
    rare = [(ts + 1, v, r) for ts, v, r in (past + wave)[::9]]
    return points(spark, past + wave).unionByName(points(spark, rare, "rare")).persist()


@pytest.mark.parametrize("grain", [None, Grain(None, (("s", 3_600_000),))])
def test_stream_equals_batch_over_checkpoints(spark, tmp_path, grain):
    frame = _hot_and_rare(spark)
    hourly = hourly_baseline(frame).persist()
    cuts = [START, START + 8 * DAY + 3_000_000, START + 8 * DAY + 9_000_000, START + 8 * DAY + 9_060_000, START + 9 * DAY]
    for part, (low, high) in enumerate(zip(cuts, cuts[1:])):
        frame.where((F.col("ts_ms") >= low) & (F.col("ts_ms") < high)).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in{part // 2}")
        if part % 2:
            source = stream_table(spark, f"{tmp_path}/in{part // 2}", frame.schema, 1)
            query = start_states(source, f"{tmp_path}/t", lambda batch: hourly, checkpoint=f"{tmp_path}/check{part}", grain=grain)
            query.awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/t/states")
    assert got.select("batch").distinct().count() == 4
    assert plain(got) == plain(monitor(frame, hourly, grain=grain or WHOLE_SERIES))
    assert got.where("series_key = 's'").select("state_level").distinct().count() > 2


def test_an_update_before_the_first_point_of_a_series_holds(spark, tmp_path):
    frame = _hot_and_rare(spark)
    hourly = hourly_baseline(frame).persist()
    marks = [("t0", ACTION_UPDATE_LEVELS, START - 1, 0), ("t0", ACTION_UPDATE_LEVELS, START + 8 * DAY + 9_000_000, 1)]
    updates = spark.createDataFrame(marks, "uuid string, action string, ts_ms bigint, seq bigint")
    updates = updates.withColumn("rules", F.when(F.col("seq") == 0, rules_literal(DEFAULT_LEVELS[:2])).otherwise(rules_literal(DEFAULT_LEVELS)))
    first = F.col("ts_ms") < START + 8 * DAY + 6_000_000
    for version, batch in enumerate((frame.where(first), frame.where(~first))):
        advance_states(batch, str(tmp_path), version, hourly, controls=updates)
    got = spark.read.parquet(f"{tmp_path}/states")
    assert plain(got) == plain(monitor(frame, hourly, controls=updates))
    assert plain(got) != plain(monitor(frame, hourly))


def test_late_points_repeated_versions_and_empty_batches(spark, tmp_path):
    frame = _hot_and_rare(spark)
    hourly, home = hourly_baseline(frame).persist(), str(tmp_path)
    rare = frame.where("series_key = 'rare'")
    advance_states(frame, home, 0, hourly)
    before = plain(spark.read.parquet(f"{home}/states"))
    for _ in range(2):
        advance_states(rare, home, 1, hourly)
    late = spark.read.parquet(f"{home}/late").where("batch = 1")
    # Muted points leave no sample, so some at the end may count as later; they are no samples either.
    assert late.where(F.col("reaction") != REACTION_LATE).count() == 0 and late.count() >= rare.where("reaction <> -3").count()
    assert plain(spark.read.parquet(f"{home}/states")) == before
    assert sorted(catalog_manifest(spark, f"{home}/samples", 1).values()) == [0, 1]
    advance_states(frame.limit(0), home, 2, hourly)
    assert catalog_manifest(spark, f"{home}/samples", 2) == catalog_manifest(spark, f"{home}/samples", 1)
