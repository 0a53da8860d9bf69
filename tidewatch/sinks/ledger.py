"""Which version of the stored tables a micro-batch makes.

Batch numbers begin anew with every checkpoint, table versions must not.  The ledger gives each (stream, batch) a version
of its own, the one after the last that was finished, and the same again when the batch is repeated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.sources.messages import stored_table

_ENTRY = "stream string, number bigint, version bigint"


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The name that Spark gave the stream of this checkpoint; it stays over restarts."""
    return spark.read.json(f"{checkpoint}/metadata").first()["id"]


def _entries(spark: SparkSession, folder: str) -> DataFrame:
    return stored_table(spark, f"{folder}/ledger", _ENTRY)


def last_version(spark: SparkSession, folder: str) -> int | None:
    """The last version that was finished, None before the first one."""
    return _entries(spark, folder).agg(F.max("version")).first()[0]


def batch_version(spark: SparkSession, folder: str, stream: str, number: int) -> int:
    """The version that this batch makes.  A version begun by a stream that was given up is made anew."""
    own = _entries(spark, folder).where((F.col("stream") == stream) & (F.col("number") == number)).agg(F.max("version")).first()[0]
    if own is not None:
        return own
    last = last_version(spark, folder)
    return 0 if last is None else last + 1


def finish(spark: SparkSession, folder: str, stream: str, number: int, version: int) -> None:
    """Enter a version as finished; the tables' files are all written by then."""
    entry = spark.createDataFrame([(stream, number, version)], _ENTRY).coalesce(1)
    entry.write.mode("overwrite").parquet(f"{folder}/ledger/made={version}")
