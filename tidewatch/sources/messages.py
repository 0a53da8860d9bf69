"""Text messages and stored tables, as batches and as streams."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.arrival import message_number
from tidewatch.session import prepare

MESSAGES = "msg_id bigint, value string"


def kafka_messages(spark: SparkSession, servers: str, topic: str, max_offsets: int | None = None, stream: bool = True) -> DataFrame:
    """Messages of a Kafka topic; needs the Kafka connector on the class path.

    The message id is a text that sorts by the instant of arrival, then by partition and offset.
    """
    prepare(spark)
    reader = spark.readStream if stream else spark.read
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    if stream and max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    raw = reader.format("kafka").options(**options).load()
    return topic_messages(raw)


def topic_messages(raw: DataFrame) -> DataFrame:
    """(msg_id, value, received) of a topic's rows (partition, offset, timestamp, value)."""
    number = message_number(F.col("timestamp"), F.col("partition"), F.col("offset"))
    return raw.select(number.alias("msg_id"), F.col("value").cast("string").alias("value"), F.col("timestamp").alias("received"))


def control_messages(messages: DataFrame) -> DataFrame:
    """Messages of a control topic as ``decode_control`` takes them: in force from their arrival on."""
    return messages.select(F.unix_millis("received").alias("ts_ms"), F.col("msg_id").alias("seq"), "value")


def stream_table(spark: SparkSession, path: str, schema: T.StructType | str, max_files: int = 100) -> DataFrame:
    """Rows of a parquet folder as they arrive, ``max_files`` files per micro-batch."""
    return prepare(spark).readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def stored_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored table, empty if it was never written; any other failure is raised."""
    try:
        return prepare(spark).read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise
