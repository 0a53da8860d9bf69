"""Level states of a stream, with the composable steps of the batch path in each micro-batch.

What a batch leaves (last samples with states and level times, regression totals) is stored by buckets of series and goes into
the next batch as rows before its first one.  Inside a batch long series are divided into cells, so a series that sends
nearly all of it takes many tasks, and no series is held in memory.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewatch.config import DEFAULTS, REACTION_LATE, Settings
from tidewatch.operators.cells import Grain, measure_grain
from tidewatch.operators.joins import lookup
from tidewatch.operators.regression import regression_totals
from tidewatch.operators.resume import last_samples, merged_totals
from tidewatch.plans.monitor import monitor
from tidewatch.session import cut_lineage, prepare
from tidewatch.sinks.ledger import batch_version, finish, stream_id
from tidewatch.sinks.tables import CATALOG_BUCKETS, read_buckets, touched_buckets, write_buckets, write_dated


def _in_order(points: DataFrame, left: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Points later than the last sample their series left, and those that are not."""
    if left is None:
        return points, points.limit(0)
    seq = F.col("seq").cast(points.schema["seq"].dataType).alias("seq")
    last = left.groupBy("series_key").agg(F.max(F.struct("ts_ms", seq)).alias("_last"))
    placed = lookup(points, last, ["series_key"])
    later = F.coalesce(F.struct("ts_ms", "seq") > F.col("_last"), F.lit(True))
    return placed.where(later).drop("_last"), placed.where(~later).drop("_last")


def advance_states(
    points: DataFrame,
    folder: str,
    version: int,
    baseline: DataFrame,
    rules: DataFrame | None = None,
    controls: DataFrame | None = None,
    settings: Settings = DEFAULTS,
    grain: Grain | None = None,
    buckets: int = CATALOG_BUCKETS,
) -> None:
    """Take in one batch as version ``version`` of the tables under ``folder``: states, late, samples, totals.

    ``controls`` are all level updates so far: each point gets the rules its tenant had at its time, whether or not its
    series was known by then.  A point that is not later than the last sample its series left changes no state that was
    told already; it goes to ``late`` with the late reaction.  Repeating a version gives the same tables.
    """
    spark = points.sparkSession
    points = points.persist()
    try:
        touched = touched_buckets(points, buckets)
        left = read_buckets(spark, f"{folder}/samples", version - 1, touched)
        totals = read_buckets(spark, f"{folder}/totals", version - 1, touched)
        if touched:
            now, late = _in_order(points, left)
            grain = measure_grain(now) if grain is None else grain
            tenant_grain = {} if controls is None else {"tenant_grain": measure_grain(now, by="uuid")}
            own = now.select("series_key").distinct()
            going_on = {
                name: None if kept is None else kept.join(own, "series_key", "left_semi")
                for name, kept in (("earlier", left), ("earlier_totals", totals))
            }
            states = cut_lineage(
                monitor(now, baseline, rules, controls, grain=grain, settings=settings, **tenant_grain, **going_on)
            )
            write_dated(states, f"{folder}/states", version, "ts_ms")
            write_dated(late.withColumn("reaction", F.lit(REACTION_LATE)), f"{folder}/late", version, "ts_ms")
            left = last_samples(states, settings=settings, earlier=left)
            new = regression_totals(now, ["series_key"])
            totals = new if totals is None else merged_totals(new, totals)
        write_buckets(left, f"{folder}/samples", version, touched, buckets)
        write_buckets(totals, f"{folder}/totals", version, touched, buckets)
    finally:
        points.unpersist()


def start_states(
    points: DataFrame,
    folder: str,
    baseline: Callable[[DataFrame], DataFrame],
    rules: DataFrame | None = None,
    controls: Callable[[SparkSession], DataFrame] | None = None,
    settings: Settings = DEFAULTS,
    trigger: dict | None = None,
    checkpoint: str | None = None,
    grain: Grain | None = None,
) -> StreamingQuery:
    """Follow the level states of a stream of points, all tables under ``folder``.

    ``baseline`` gives the hourly baselines that a batch of points refers to, as ``sinks/tables.read_baseline`` does;
    ``controls`` reads the level updates anew for every batch.
    """
    prepare(points.sparkSession)
    checkpoint = checkpoint or f"{folder}/checkpoint"

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        stream = stream_id(spark, checkpoint)
        version = batch_version(spark, folder, stream, number)
        known = None if controls is None else controls(spark)
        advance_states(batch, folder, version, baseline(batch), rules, known, settings, grain)
        finish(spark, folder, stream, number, version)

    return (
        points.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
