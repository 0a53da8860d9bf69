"""The series catalog and the operators that keep the latest of a series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.identity import series_hash
from tidewatch.operators.cells import WHOLE_SERIES, Grain, add_cell, neighbours
from tidewatch.operators.joins import lookup

_LATEST = ("last_ts_ms", "type", "is_special")


def series_catalog(points: DataFrame) -> DataFrame:
    """One row per series; time and type are those of the last point to arrive."""
    catalog = points.groupBy("series_key").agg(
        F.any_value("uuid").alias("uuid"),
        F.any_value("name").alias("name"),
        F.any_value("tags").alias("tags"),
        F.min("ts_ms").alias("first_ts_ms"),
        F.max_by("ts_ms", "seq").alias("last_ts_ms"),
        F.max_by("type", "seq").alias("type"),
        F.max_by("is_special", "seq").alias("is_special"),
        F.max("seq").alias("last_seq"),
        F.count(F.lit(1)).alias("n_points"),
    )
    return catalog.withColumn("series_hash", series_hash(F.col("series_key")))


def upsert_catalog(stored: DataFrame, points: DataFrame) -> DataFrame:
    """The stored catalog brought up to date with newly arrived points."""
    merged = stored.unionByName(series_catalog(points))
    return (
        merged.groupBy("series_key")
        .agg(
            *[F.any_value(c).alias(c) for c in ("uuid", "name", "tags", "series_hash")],
            F.min("first_ts_ms").alias("first_ts_ms"),
            *[F.max_by(c, "last_seq").alias(c) for c in _LATEST],
            F.max("last_seq").alias("last_seq"),
            F.sum("n_points").alias("n_points"),
        )
        .select(*stored.columns)
    )


def special_series(catalog: DataFrame) -> DataFrame:
    return catalog.where("is_special")


def series_named(catalog: DataFrame, name: str) -> DataFrame:
    return catalog.where(F.col("name") == F.lit(name))


def hash_collisions(catalog: DataFrame, hash_column: str = "series_hash") -> DataFrame:
    """Hashes that stand for more than one series."""
    return (
        catalog.groupBy(hash_column)
        .agg(F.count_distinct("series_key").alias("n_series"), F.min("series_key").alias("first_key"))
        .where(F.col("n_series") > 1)
    )


def enrich(points: DataFrame, catalog: DataFrame) -> DataFrame:
    """Add what the catalog knew about the series before these points, and whether it knew it."""
    known = catalog.select(
        "series_key",
        F.col("first_ts_ms").alias("known_since_ms"),
        F.col("last_ts_ms").alias("known_last_ms"),
        F.col("type").alias("known_type"),
    )
    return lookup(points, known, ["series_key"]).withColumn("is_known", F.col("known_since_ms").isNotNull())


def latest_by_event_time(points: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("series_key",)) -> DataFrame:
    """The point with the highest timestamp; of equal ones the first to arrive."""
    # Numbers of points are whole numbers or texts, so the first to arrive is a minimum of them, not a negated maximum.
    columns = list(columns)
    first = F.min_by(F.struct(*columns), F.struct((-F.col("ts_ms")).alias("_later"), F.col("seq")))
    return points.groupBy(*keys).agg(first.alias("_row")).select(*keys, "_row.*")


def latest_by_arrival(points: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("series_key",)) -> DataFrame:
    """The last point to arrive, whatever its timestamp."""
    return _latest(points, F.col("seq"), columns, keys)


def _latest(points, order, columns, keys):
    # An aggregate, not a ranking: tasks keep one row per key before anything is shuffled.
    best = points.groupBy(*keys).agg(F.max_by(F.struct(*columns), order).alias("_row"))
    return best.select(*keys, "_row.*")


def deduplicate_points(points: DataFrame) -> DataFrame:
    """One row per series and timestamp, the last write winning."""
    columns = [c for c in points.columns if c not in ("series_key", "ts_ms")]
    return latest_by_arrival(points, columns, ("series_key", "ts_ms"))


def type_changes(points: DataFrame, grain: Grain = WHOLE_SERIES) -> DataFrame:
    """Points whose type differs from that of the previous point of the series."""
    rows = neighbours(add_cell(points, grain), ["series_key"], ["ts_ms", "seq"], grain, before={"prev_type": "type"})
    return rows.where(F.col("prev_type").isNotNull() & (F.col("prev_type") != F.col("type"))).drop("cell")
