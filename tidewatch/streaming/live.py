"""Baselines that grow while points flow, and scoring against them.

Each micro-batch adds the moments of its points per series and hour to a log.  As the highest event time seen moves on, hours
close: the moments of all batches for such an hour are merged once and go through the baseline sink, and hours that points
refer to without having any point of their own leave a marker.  The batch is then scored against what is stored by
then, of which only the days, series and hours that it refers to are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewatch.config import DAY_MS, DEFAULTS, HOUR_MS, Settings
from tidewatch.functions.time import hour_slot
from tidewatch.operators.baseline import merged_baseline, missing_slots, referred_slots, slot_moments, wanted_slots
from tidewatch.operators.cells import measure_grain
from tidewatch.operators.lateness import with_late_reaction
from tidewatch.operators.score import score_points
from tidewatch.session import prepare
from tidewatch.sinks.ledger import batch_version, finish, stream_id
from tidewatch.sinks.tables import read_baseline, write_baseline, write_dated
from tidewatch.sources.messages import stored_table

_HORIZON = "version bigint, seen_ms bigint, closed_ms bigint"
_MOMENTS = "series_key string, slot_ms bigint, n bigint, mean double, m2 double, min double, max double, batch bigint, date date"


def read_horizon(spark: SparkSession, folder: str, version: int) -> tuple[int | None, int]:
    """(highest event time seen, end of the hours closed) as a version left them."""
    found = stored_table(spark, f"{folder}/horizon", _HORIZON).where(F.col("version") == version).first()
    return (found.seen_ms, found.closed_ms) if found else (None, 0)


def _write_horizon(spark: SparkSession, folder: str, version: int, seen_ms: int | None, closed_ms: int) -> None:
    row = spark.createDataFrame([(version, seen_ms, closed_ms)], _HORIZON).coalesce(1)
    row.write.mode("overwrite").parquet(f"{folder}/horizon/made={version}")


def _closing(spark: SparkSession, folder: str, version: int, from_ms: int, to_ms: int) -> DataFrame:
    """Moments of the hours that close now, from all batches so far."""
    day = lambda ms: F.to_date(F.timestamp_millis(F.lit(ms)))
    log = stored_table(spark, f"{folder}/moments", _MOMENTS)
    inside = (F.col("slot_ms") >= from_ms) & (F.col("slot_ms") < to_ms) & (F.col("batch") <= version)
    return log.where(inside & F.col("date").between(day(from_ms), day(to_ms))).drop("date")


def advance(points: DataFrame, folder: str, version: int, allowed_ms: int = HOUR_MS, settings: Settings = DEFAULTS) -> DataFrame:
    """Take in one batch as version ``version`` of the tables under ``folder``; its points, scored.

    A point later than ``allowed_ms`` gets the late reaction.  One whose hour is closed no longer counts in a baseline.
    Repeating a version gives the same tables.
    """
    spark = points.sparkSession
    seen, closed = read_horizon(spark, folder, version - 1)
    points = with_late_reaction(points, allowed_ms, settings, seen_ms=seen).persist()
    try:
        top = points.agg(F.max("ts_ms")).first()[0]
        seen = top if seen is None else seen if top is None else max(seen, top)
        if seen is None:
            _write_horizon(spark, folder, version, None, closed)
            return points.limit(0)
        ends = seen - allowed_ms
        closes = max(closed, ends - ends % HOUR_MS)
        open_points = points.where(hour_slot(F.col("ts_ms")) >= closed)
        write_dated(slot_moments(open_points), f"{folder}/moments", version, "slot_ms")
        built = merged_baseline(_closing(spark, folder, version, closed, closes)).persist()
        # Hours wanted that are closed, neither stored nor built now: nobody sent a point for them.
        wanted = wanted_slots(points, settings).where(F.col("slot_ms") < closes)
        stored = read_baseline(spark, f"{folder}/baseline", wanted, before=version).unionByName(built)
        marks = missing_slots(wanted, stored).withColumn("n", F.lit(0).cast("bigint"))
        write_baseline(built.unionByName(marks, allowMissingColumns=True), f"{folder}/baseline", version)
        built.unpersist()
        referred = referred_slots(points, settings)
        baseline = read_baseline(spark, f"{folder}/baseline", referred, before=version + 1)
        scored = score_points(points, baseline, settings, measure_grain(points))
        write_dated(scored, f"{folder}/scored", version, "ts_ms")
        _write_horizon(spark, folder, version, seen, closes)
        return scored
    finally:
        points.unpersist()


def start_scoring(
    points: DataFrame,
    folder: str,
    allowed_ms: int = HOUR_MS,
    settings: Settings = DEFAULTS,
    trigger: dict | None = None,
    checkpoint: str | None = None,
) -> StreamingQuery:
    """Score a stream of points against baselines that it builds itself, all tables under ``folder``.

    ``allowed_ms`` and an hour must stay within a day, or a point's baseline of the day before would not be closed in time.
    """
    if allowed_ms + HOUR_MS > DAY_MS:
        raise ValueError("a point may be late by 23 hours at most")
    prepare(points.sparkSession)
    checkpoint = checkpoint or f"{folder}/checkpoint"

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        stream = stream_id(spark, checkpoint)
        version = batch_version(spark, folder, stream, number)
        advance(batch, folder, version, allowed_ms, settings)
        finish(spark, folder, stream, number, version)

    return (
        points.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
