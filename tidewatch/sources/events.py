"""Reads the bundled event tables as metric points, control messages and raw text."""

from __future__ import annotations

import datetime
import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.identity import series_hash, series_key
from tidewatch.session import prepare


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(os.path.join(folder, f"{name}.parquet"))


def _millis(ts: str) -> Column:
    return F.unix_millis(F.col(ts).cast("timestamp"))


def _with_k(events: DataFrame) -> DataFrame:
    return events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))


def _tenant(column: str) -> Column:
    return F.when(F.col(column).isin("click", "view"), F.lit("t0")).otherwise(F.lit("t1"))


def _tags(uuid: Column, host: Column) -> Column:
    return F.create_map(F.lit("UUID"), uuid, F.lit("host"), host)


def _key(name: Column, uuid: Column, host: Column) -> Column:
    """The series key of these two tags, spelled out; equals ``series_key`` of their map."""
    return F.concat(name, F.lit('|{"UUID":"'), uuid, F.lit('","host":"'), host, F.lit('"}'))


def _stamp(ms: int) -> Column:
    """An instant as the tables store it, so that a comparison with it reaches the scan."""
    stamp = datetime.datetime(1970, 1, 1) + datetime.timedelta(milliseconds=ms)
    return F.expr(f"TIMESTAMP_NTZ '{stamp.isoformat(sep=' ', timespec='milliseconds')}'")


def metric_points(spark: SparkSession, folder: str, start_ms: int | None = None, end_ms: int | None = None) -> DataFrame:
    """Events as regular points: one series per event type, reaction from ``props.k``.

    Points from ``start_ms`` to ``end_ms``, both included, where these are given.
    """
    rows = table(spark, folder, "events")
    if start_ms is not None:
        rows = rows.where(F.col("ts") >= _stamp(start_ms))
    if end_ms is not None:
        rows = rows.where(F.col("ts") < _stamp(end_ms + 1))
    digit = F.col("k") % 10
    reaction = (
        F.when(digit <= 5, 0).when(digit == 6, -1).when(digit == 7, -2).when(digit == 8, -3).otherwise(100).cast("int")
    )
    name = F.col("event_type")
    tags = _tags(_tenant("event_type"), name)
    return _with_k(rows).select(
        _key(name, _tenant("event_type"), name).alias("series_key"),
        name.alias("name"),
        _millis("ts").alias("ts_ms"),
        "value",
        tags.alias("tags"),
        _tenant("event_type").alias("uuid"),
        F.lit(0).cast("smallint").alias("type"),
        reaction.alias("reaction"),
        F.lit(False).alias("is_special"),
        F.lit(None).cast("string").alias("status"),
        F.lit(None).cast("string").alias("message"),
        F.col("event_id").alias("seq"),
    )


def special_points(spark: SparkSession, folder: str, by_user: bool = False) -> DataFrame:
    """Error events as special points; ``by_user`` gives each user's errors a series of their own."""
    turn = F.col("k") % 4
    status = (
        F.when(F.col("k") == 99, "STALE").when(turn == 1, "WARNING").when(turn == 2, "ERROR").otherwise("OK")
    )
    name = F.col("event_type")
    host = F.concat(F.lit("u"), F.col("user_id").cast("string")) if by_user else name
    tags = _tags(_tenant("event_type"), host)
    return (
        _with_k(table(spark, folder, "events"))
        .where(F.col("event_type") == "error")
        .select(
            _key(name, _tenant("event_type"), host).alias("series_key"),
            name.alias("name"),
            _millis("ts").alias("ts_ms"),
            "value",
            tags.alias("tags"),
            _tenant("event_type").alias("uuid"),
            F.lit(1).cast("smallint").alias("type"),
            F.when(F.col("k") % 2 == 0, 60).otherwise(-60).cast("int").alias("reaction"),
            F.lit(True).alias("is_special"),
            status.alias("status"),
            F.lit("error seen").alias("message"),
            F.col("event_id").alias("seq"),
        )
    )


def all_points(spark: SparkSession, folder: str) -> DataFrame:
    """Regular points, except that error events are special ones."""
    regular = metric_points(spark, folder).where(F.col("name") != "error")
    return regular.unionByName(special_points(spark, folder))


def user_points(spark: SparkSession, folder: str) -> DataFrame:
    """Events with one series per event type and user; ``type`` follows ``props.k``."""
    name = F.col("event_type")
    tags = _tags(_tenant("event_type"), F.concat(F.lit("u"), F.col("user_id").cast("string")))
    return _with_k(table(spark, folder, "events")).select(
        series_key(name, tags).alias("series_key"),
        name.alias("name"),
        _millis("ts").alias("ts_ms"),
        "value",
        tags.alias("tags"),
        _tenant("event_type").alias("uuid"),
        F.when(F.col("k") < 50, 0).otherwise(1).cast("smallint").alias("type"),
        (name == "error").alias("is_special"),
        F.col("event_id").alias("seq"),
    )


def order_points(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as points: a series per priority and status, the price as value."""
    name = F.col("o_orderpriority")
    return table(spark, folder, "orders").select(
        _key(name, F.lit("shop"), F.col("o_orderstatus")).alias("series_key"),
        name.alias("name"),
        _millis("o_orderdate").alias("ts_ms"),
        F.col("o_totalprice").alias("value"),
        F.lit("shop").alias("uuid"),
        F.lit(0).alias("reaction"),
        F.col("o_orderkey").alias("seq"),
    )


def lineitem_points(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as points: a series per return flag and line status, the price as value."""
    name = F.col("l_returnflag")
    return table(spark, folder, "lineitem").select(
        _key(name, F.lit("shop"), F.col("l_linestatus")).alias("series_key"),
        name.alias("name"),
        _millis("l_shipdate").alias("ts_ms"),
        F.col("l_extendedprice").alias("value"),
        F.lit("shop").alias("uuid"),
        F.lit(0).alias("reaction"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seq"),
    )


MESSAGE_POINTS = 8
# Numbers of the faulty messages that are sent besides the real ones.
PLANTED_FROM = 1_000_000_000


def raw_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Events as wire messages of up to eight elements, with faulty elements, and faulty messages besides."""
    k = F.col("k")
    quoted = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    is_error = F.col("event_type") == "error"
    uuid = _tenant("event_type")
    fields = F.concat_ws(
        ",",
        F.when(k != 10, quoted('"metric":"', F.col("event_type"), '"')),
        F.when(k != 11, quoted('"timestamp":', _millis("ts").cast("string"))),
        F.when(k == 12, F.lit('"value":"abc"'))
        .when(k == 16, F.lit('"value":"2.5"'))
        .otherwise(quoted('"value":', F.col("value").cast("string"))),
        F.when(k == 14, quoted('"tags":{"host":"', F.col("event_type"), '"}')).when(
            k != 13, quoted('"tags":{"host":"', F.col("event_type"), '","UUID":"', uuid, '"}')
        ),
        F.when(is_error, F.lit('"type":"Special","status":"ERROR","message":"m"')).otherwise(F.lit('"type":"Regular"')),
        F.when(k % 2 == 0, quoted('"reaction":', (k % 5 - 3).cast("string"))),
    )
    element = F.when(k == 15, F.lit("7")).otherwise(F.concat(F.lit("{"), fields, F.lit("}")))
    grouped = (
        _with_k(table(spark, folder, "events"))
        .select(F.floor(F.col("event_id") / MESSAGE_POINTS).cast("bigint").alias("msg_id"), "event_id", element.alias("e"))
        .groupBy("msg_id")
        .agg(F.array_sort(F.collect_list(F.struct("event_id", "e"))).alias("es"))
    )
    array = F.concat(F.lit("["), F.array_join(F.transform("es", lambda x: x["e"]), ","), F.lit("]"))
    turn = F.col("msg_id") % 25
    planted = F.when(turn == 7, '{"metric":"a"}').when(turn == 13, "[{bad").when(turn == 19, "[]")
    extra = F.when(planted.isNotNull(), F.struct((F.col("msg_id") + PLANTED_FROM).alias("msg_id"), planted.alias("value")))
    both = F.array_compact(F.array(F.struct("msg_id", array.alias("value")), extra))
    return grouped.select(F.explode(both).alias("m")).select("m.*")


def control_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Some events as control messages about their own series or tenant."""
    k, base = F.col("k"), F.lit(1) + F.col("event_id") % 3
    name = F.col("event_type")
    key_hash = series_hash(series_key(name, _tags(_tenant("event_type"), name)))
    rules = [
        F.struct(
            F.lit(str(j)).alias("key"),
            F.struct(
                (base * (j + 1)).cast("double").alias("min_weight"),
                F.lit(5.0 * (j + 1)).alias("min_pct"),
                F.lit(0.0).alias("min_value"),
                F.lit(0.0).alias("min_predict_pct"),
                F.lit(3 - j // 2).alias("rec_count"),
            ).alias("value"),
        )
        for j in range(6)
    ]
    changedata = F.to_json(F.map_from_entries(F.array(*rules)))
    hashed = lambda action: F.to_json(F.struct(F.lit(action).alias("action"), key_hash.alias("hash")))
    update = lambda uuid, data: F.to_json(
        F.struct(F.lit("updatelevels").alias("action"), uuid.alias("UUID"), data.alias("changedata"))
    )
    tenant = _tenant("event_type")
    value = (
        F.when(k == 94, update(F.lit(None).cast("string"), changedata))
        .when(k == 95, update(tenant, changedata))
        .when(k == 96, update(tenant, F.lit("{bad")))
        .when(k == 97, hashed("resetregresion"))
        .when(k == 98, hashed("noop"))
        .when(k == 99, hashed("deletemetricbyhash"))
    )
    return (
        _with_k(table(spark, folder, "events"))
        .where(k >= 94)
        .select(_millis("ts").alias("ts_ms"), F.col("event_id").alias("seq"), value.alias("value"))
    )


TENANTS = 7


def tenant_points(spark: SparkSession, folder: str) -> DataFrame:
    """The metric points dealt out to the first customers as tenants, a series per event type and tenant."""
    uuid = F.concat(F.lit("c"), (F.col("user_id") % TENANTS + 1).cast("string"))
    of_user = table(spark, folder, "events").select(F.col("event_id").alias("seq"), uuid.alias("uuid"))
    points = metric_points(spark, folder).drop("uuid").join(of_user, "seq")
    tags = _tags(F.col("uuid"), F.col("name"))
    return points.withColumns({"tags": tags, "series_key": _key(F.col("name"), F.col("uuid"), F.col("name"))})


def users(spark: SparkSession, folder: str, own_levels: Sequence[int] = (0, 1, 2)) -> DataFrame:
    """Customers as tenants: a third with levels of their own, a third with empty JSON, a third with none."""
    key = F.col("c_custkey")
    rule = lambda j: F.concat(
        F.lit(f'"{own_levels[j]}":{{"min_weight":'),
        ((F.col("c_nationkey") % 3 + 1) * (j + 1)).cast("string"),
        F.lit(f',"min_pct":{5 * (j + 1)},"rec_count":{3 - j}}}'),
    )
    own = F.concat(F.lit("{"), F.concat_ws(",", *[rule(j) for j in range(3)]), F.lit("}"))
    levels = F.when(key % 3 == 0, F.lit("")).when(key % 3 == 1, own)
    return table(spark, folder, "customer").select(
        F.concat(F.lit("c"), key.cast("string")).alias("uuid"), levels.alias("AL")
    )
