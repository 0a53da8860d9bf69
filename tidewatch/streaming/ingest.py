"""Stateless part of the stream: parse, split, and write what was parsed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidewatch.operators.ingest import dead_letters, good_points, parse_messages
from tidewatch.session import prepare
from tidewatch.sinks.ledger import batch_version, finish, stream_id
from tidewatch.sinks.tables import update_catalog, write_points


def start_ingest(messages: DataFrame, folder: str, trigger: dict | None = None, checkpoint: str | None = None) -> StreamingQuery:
    """Parse a stream of messages once into points, dead letters and the catalog under ``folder``.

    A new checkpoint over an old folder goes on from the last version that was finished.
    """
    prepare(messages.sparkSession)
    checkpoint = checkpoint or f"{folder}/checkpoint"

    def write(batch: DataFrame, batch_number: int) -> None:
        spark = batch.sparkSession
        stream = stream_id(spark, checkpoint)
        number = batch_version(spark, folder, stream, batch_number)
        parsed = parse_messages(batch).persist()
        try:
            points = good_points(parsed)
            write_points(points, f"{folder}/points", number)
            dead_letters(parsed).write.mode("overwrite").parquet(f"{folder}/dead/batch={number}")
            update_catalog(points, f"{folder}/catalog", number)
            finish(spark, folder, stream, batch_number, number)
        finally:
            parsed.unpersist()

    return (
        messages.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
