"""Parquet tables the operators leave behind.

Every batch is written under its own ``batch`` partition value, so writing a batch again replaces it
and nothing else; that makes the writers safe to repeat from ``foreachBatch``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.time import to_timestamp
from tidewatch.operators.catalog import deduplicate_points, upsert_catalog, series_catalog
from tidewatch.schemas import BASELINE, CATALOG
from tidewatch.sources.messages import stored_table


def _replace(df: DataFrame, path: str, *partitions: str) -> None:
    # Rebalancing gives files of an even size, also when most rows share one partition.
    even = df.hint("rebalance", *partitions) if partitions else df.hint("rebalance")
    even.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def _dated(df: DataFrame, ms: str) -> DataFrame:
    return df.withColumn("date", F.to_date(to_timestamp(F.col(ms))))


def write_dated(rows: DataFrame, path: str, batch: int, ms: str) -> None:
    """Rows of a batch by the day of their ``ms``."""
    _replace(_dated(rows, ms).withColumn("batch", F.lit(batch)), path, "batch", "date")


def write_points(points: DataFrame, path: str, batch: int = 0) -> None:
    """Points, one per series and timestamp within the batch, by day."""
    unique = _dated(deduplicate_points(points), "ts_ms").withColumn("batch", F.lit(batch))
    _replace(unique, path, "batch", "date")


def read_points(spark: SparkSession, path: str, start_ms: int | None = None, end_ms: int | None = None) -> DataFrame:
    """Stored points; a timestamp that several batches wrote counts once, the last batch winning.

    Of a range, ends included, only the folders of its days are read.
    """
    stored = spark.read.parquet(path)
    for bound, below in ((start_ms, False), (end_ms, True)):
        if bound is not None:
            day, at = F.to_date(to_timestamp(F.lit(bound))), F.lit(bound)
            stored = stored.where((F.col("date") <= day) & (F.col("ts_ms") <= at) if below else (F.col("date") >= day) & (F.col("ts_ms") >= at))
    stored = stored.drop("date")
    columns = [c for c in stored.columns if c not in ("series_key", "ts_ms", "batch")]
    order = F.struct("batch", "seq")
    best = stored.groupBy("series_key", "ts_ms").agg(F.max_by(F.struct(*columns), order).alias("_row"))
    return best.select("series_key", "ts_ms", "_row.*")


def write_baseline(baseline: DataFrame, path: str, batch: int = 0) -> None:
    """Newly built baselines by day of their slot; pass only slots that are not stored yet."""
    write_dated(baseline, path, batch, "slot_ms")


def read_baseline(spark: SparkSession, path: str, slots: DataFrame, before: int | None = None) -> DataFrame:
    """Stored baselines and no-data markers of these (series_key, slot_ms); only the folders of their days are read.

    Of batches ``before`` this number, where it is given.
    """
    folders = [T.StructField("batch", T.LongType()), T.StructField("date", T.DateType())]
    stored = stored_table(spark, path, T.StructType([*BASELINE.fields, *folders]))
    stored = stored if before is None else stored.where(F.col("batch") < before)
    # One value for each day that the slots lie in, however many slots there are.
    days = [r.date for r in _dated(slots, "slot_ms").select("date").distinct().collect()]
    wanted = slots.select("series_key", "slot_ms").distinct()
    return stored.where(F.col("date").isin(days)).drop("date", "batch").join(wanted, ["series_key", "slot_ms"], "left_semi")


def write_error_log(log: DataFrame, path: str, batch: int = 0) -> None:
    timed = log.withColumn("_ms", F.col("ts_s") * 1000)
    _replace(_dated(timed, "_ms").drop("_ms").withColumn("batch", F.lit(batch)), path, "batch", "date")


def write_regression(totals: DataFrame, path: str, version: int = 0) -> None:
    """Regression sums per series, enough to go on after a restart."""
    _replace(totals.withColumn("version", F.lit(version)), path, "version")


def write_alerts(records: DataFrame, path: str, batch: int = 0) -> None:
    """Routed alert records, one folder per topic."""
    rows = records.select("topic", "value").withColumn("batch", F.lit(batch))
    _replace(rows, path, "batch", "topic")


def kafka_alerts(records: DataFrame, servers: str) -> None:
    """Routed alert records to their Kafka topics; needs the Kafka connector."""
    records.select("topic", "value").write.format("kafka").option("kafka.bootstrap.servers", servers).save()


CATALOG_BUCKETS = 256
_HELD = "bucket int, held bigint"


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("series_key"), F.lit(buckets)).cast("int").alias("bucket")


def catalog_manifest(spark: SparkSession, path: str, version: int) -> dict[int, int]:
    """Which version holds each bucket of the catalog; at most one entry for each bucket."""
    return {r.bucket: r.held for r in spark.read.schema(_HELD).parquet(f"{path}/manifest/version={version}").collect()}


def _buckets(spark: SparkSession, path: str, schema, held: dict[int, int]) -> DataFrame:
    if not held:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/data/version={v}/bucket={b}" for b, v in sorted(held.items())])


def update_catalog(points: DataFrame, path: str, version: int, buckets: int = CATALOG_BUCKETS) -> None:
    """Commit version ``version`` of the catalog, from the one before and the new points.

    Series are dealt to ``buckets`` by a hash.  Only buckets with new points are read and written, into the version's own
    folder; its manifest then names the version that holds each bucket.  The manifest is the commit: until it is
    written, readers see the version before.  Repeating a version makes it again from the same earlier one.  Version 0
    starts an empty catalog; an earlier version that is lost fails the batch, so the catalog never begins anew unnoticed.
    Streams number versions by the ledger, which goes on after a new checkpoint.
    """
    spark = points.sparkSession
    held = {} if version == 0 else catalog_manifest(spark, path, version - 1)
    new = series_catalog(points)
    touched = [r.bucket for r in points.select(_bucket(buckets)).distinct().collect()]
    stored = _buckets(spark, path, new.schema, {b: held[b] for b in touched if b in held})
    merged = upsert_catalog(stored, points).select("*", _bucket(buckets))
    if touched:
        # One file for each bucket; a bucket's series are few, whatever their points.
        merged.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/data/version={version}")
    rows = sorted((held | dict.fromkeys(touched, version)).items())
    spark.createDataFrame(rows, _HELD).coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/version={version}")


def read_catalog(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The catalog as of a version; the last one committed, unless given."""
    if version is None:
        version = spark.read.parquet(f"{path}/manifest").agg(F.max("version")).first()[0]
    held = catalog_manifest(spark, path, version)
    if not held:
        return spark.createDataFrame([], CATALOG)
    bucket, at = next(iter(held.items()))
    return _buckets(spark, path, spark.read.parquet(f"{path}/data/version={at}/bucket={bucket}").schema, held)


def touched_buckets(points: DataFrame, buckets: int = CATALOG_BUCKETS) -> list[int]:
    """The buckets of the points' series, at most ``buckets`` numbers."""
    return sorted(r.bucket for r in points.select(_bucket(buckets)).distinct().collect())


def read_buckets(spark: SparkSession, path: str, version: int, wanted: list[int]) -> DataFrame | None:
    """Rows of these buckets as of a version; None if it holds none of them.  Before version 0 there is nothing."""
    held = {} if version < 0 else catalog_manifest(spark, path, version)
    paths = [f"{path}/data/version={held[b]}/bucket={b}" for b in wanted if b in held]
    return spark.read.parquet(*paths) if paths else None


def write_buckets(rows: DataFrame | None, path: str, version: int, touched: list[int], buckets: int = CATALOG_BUCKETS) -> None:
    """Commit a version in which the ``touched`` buckets hold these rows and all others what they held before."""
    spark = SparkSession.getActiveSession() if rows is None else rows.sparkSession
    held = {} if version == 0 else catalog_manifest(spark, path, version - 1)
    if touched:
        placed = rows.select("*", _bucket(buckets)).repartition("bucket")
        placed.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/data/version={version}")
        # A bucket whose series have nothing to keep yet, as muted ones, has no files.
        made = placed.select("bucket").distinct().collect()
        held |= {r.bucket: version for r in made}
    spark.createDataFrame(sorted(held.items()), _HELD).coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/version={version}")
