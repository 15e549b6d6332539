"""Messages to raw rows and rejects, as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from badgeflow.functions.clock import AsOf
from badgeflow.session import configure
from badgeflow.sources.messages import decode_messages, read_messages, rejected_events, shape_events
from badgeflow.sources.tables import Layout
from badgeflow.streaming.runs import run_of


def write_messages(layout: Layout, decoded: DataFrame, run: str, batch_id: int) -> None:
    """Good rows of a batch to raw, all others to the rejects, from one parse."""
    kept = decoded.persist()
    try:
        layout.write_batch(layout.raw_files(shape_events(kept)), "raw", run, batch_id)
        rejects = rejected_events(kept).withColumn("ingestion_date", F.to_date("ingestion_time"))
        layout.write_batch(rejects, "rejects", run, batch_id)
    finally:
        kept.unpersist()


def ingest(
    spark: SparkSession,
    messages: DataFrame | str,
    layout: Layout,
    ingestion_time: AsOf = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append parsed messages to raw, and those that break a rule to the rejects.

    ``messages`` is a folder of JSON lines or a stream with a ``value`` column, such as a Kafka
    source. A replayed micro-batch has the clock of its first attempt and replaces what that wrote.
    """
    stream = read_messages(spark, messages, stream=True) if isinstance(messages, str) else messages
    checkpoint = layout.checkpoint("ingest")

    def handle(batch: DataFrame, batch_id: int) -> None:
        session = configure(batch.sparkSession)
        write_messages(layout, batch, run_of(session, checkpoint), batch_id)

    return (
        decode_messages(stream, ingestion_time).writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(handle).trigger(**(trigger or {"availableNow": True})).start()
    )
