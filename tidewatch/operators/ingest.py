"""From raw text to typed points; whatever is refused goes to a dead letter with its reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.config import ABSENCE_NAME, DEFAULTS, HEARTBEAT_NAME, Settings
from tidewatch.functions.arrival import element_number
from tidewatch.functions.identity import series_key
from tidewatch.schemas import METRIC_POINT, WIRE_ELEMENT

LENIENT = {"allowUnquotedFieldNames": "true", "allowSingleQuotes": "true"}

POINT_COLUMNS = METRIC_POINT.fieldNames()


def _whole_number(text: Column) -> Column:
    """BIGINT of plain or scientific notation."""
    return F.coalesce(text.try_cast("bigint"), F.floor(text.try_cast("double")).try_cast("bigint"))


def parse_messages(messages: DataFrame) -> DataFrame:
    """Explode messages (``msg_id``, ``value``) into one decoded row per array element.

    ``reason`` is NULL for a good element and names the first fault otherwise.  A message that is no
    array yields one row with a NULL ``pos``.  Text is decoded twice, first into element texts, then
    each element by itself, so a bad element never costs its siblings.
    """
    texts = F.from_json("value", "array<string>", LENIENT)
    # The decoder stops at the closing bracket; whatever follows it makes the message unreadable.
    elements = messages.select("msg_id", "value", F.when(F.rtrim("value").endswith("]"), texts).alias("_elements"))
    # Only a refused message keeps its whole text; its elements must not carry copies of it.
    exploded = elements.select(
        "msg_id",
        F.when(F.col("_elements").isNull(), F.coalesce("value", F.lit(""))).alias("_refused"),
        F.posexplode_outer("_elements").alias("pos", "_text"),
    )
    decoded = exploded.where(F.col("_refused").isNotNull() | F.col("pos").isNotNull()).withColumn(
        "_e", F.from_json("_text", WIRE_ELEMENT, LENIENT)
    )
    is_array = F.ltrim("_refused").startswith("[")
    is_json = F.try_parse_json("_refused").isNotNull() | F.from_json("_refused", "map<string,string>", LENIENT).isNotNull()
    refusal = F.when(~is_array & is_json, F.lit("not_array")).otherwise(F.lit("bad_json"))
    fields = decoded.select(
        "msg_id",
        "pos",
        F.coalesce("_refused", "_text").alias("raw"),
        F.when(F.col("_refused").isNotNull(), refusal)
        .when(F.col("_text").isNull() | ~F.ltrim("_text").startswith("{"), F.lit("bad_element"))
        .alias("_fault"),
        F.col("_e.metric").alias("name"),
        _whole_number(F.col("_e.timestamp")).alias("ts_ms"),
        F.col("_e.value").try_cast("double").alias("value"),
        F.col("_e.tags").alias("tags"),
        F.col("_e.type").alias("_type"),
        F.coalesce(F.col("_e.reaction").try_cast("int"), F.lit(0)).alias("reaction"),
        F.col("_e.status").alias("status"),
        F.col("_e.message").alias("message"),
    )
    is_special = F.coalesce(F.lower("_type") == "special", F.lit(False))
    uuid = F.try_element_at("tags", F.lit("UUID"))
    return fields.select(
        "msg_id",
        "pos",
        "raw",
        F.coalesce("_fault", required_field_fault(F.col("name"), F.col("ts_ms"), F.col("value"), F.col("tags"), uuid)).alias(
            "reason"
        ),
        F.when(F.col("tags").isNotNull(), series_key(F.col("name"), F.col("tags"))).alias("series_key"),
        "name",
        "ts_ms",
        "value",
        "tags",
        uuid.alias("uuid"),
        is_special.cast("smallint").alias("type"),
        "reaction",
        is_special.alias("is_special"),
        "status",
        "message",
        element_number(F.col("msg_id"), dict(messages.dtypes)["msg_id"] == "string", F.col("pos")).alias("seq"),
    )


def required_field_fault(name: Column, ts_ms: Column, value: Column, tags: Column, uuid: Column) -> Column:
    """The first required field that is missing, in the order the fields are checked."""
    return (
        F.when(name.isNull(), F.lit("missing_name"))
        .when(ts_ms.isNull(), F.lit("missing_timestamp"))
        .when(value.isNull(), F.lit("missing_value"))
        .when(tags.isNull(), F.lit("missing_tags"))
        .when(uuid.isNull(), F.lit("missing_uuid"))
    )


def good_points(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNull()).select(*POINT_COLUMNS)


def dead_letters(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNotNull()).select("msg_id", "pos", "reason", "raw")


def regular_points(points: DataFrame) -> DataFrame:
    return points.where(~F.col("is_special"))


def special_points(points: DataFrame) -> DataFrame:
    return points.where("is_special")


def heartbeats(points: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Points of the heartbeat metric only."""
    return points.where(F.col("name") == F.lit(settings.heartbeat_name))


def synthesize_absence(
    points: DataFrame, heartbeat_name: str = HEARTBEAT_NAME, absence_name: str = ABSENCE_NAME
) -> DataFrame:
    """All points, plus a special error twin for each heartbeat."""
    regular_heartbeat = (F.col("name") == heartbeat_name) & ~F.col("is_special")
    twins = points.where(regular_heartbeat).withColumns(
        {
            "name": F.lit(absence_name),
            "series_key": series_key(F.lit(absence_name), F.col("tags")),
            "type": F.lit(1).cast("smallint"),
            "is_special": F.lit(True),
            "status": F.lit("ERROR"),
            "message": F.lit("Host Absent"),
        }
    )
    return points.unionByName(twins)
