"""Streams over raw: hourly windows, hourly rollups and first-arrival deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from badgeflow.operators import rollups
from badgeflow.operators.staging import EVENT_COLUMNS, first_per_key, without_known
from badgeflow.session import configure
from badgeflow.sources.tables import Layout
from badgeflow.streaming.runs import run_of


def with_watermark(raw: DataFrame, column: str, delay: str) -> DataFrame:
    """Watermarks need a zoned timestamp; the session zone is UTC."""
    return raw.withColumn("_clock", F.col(column).cast("timestamp")).withWatermark("_clock", delay)


def hourly_metrics(
    raw: DataFrame, delay: str = "10 minutes", width: str = "1 hour", distinct: bool = True
) -> DataFrame:
    """Arrivals per window, for append output: each window once, when the watermark has passed it.

    Rows that come later than ``delay`` are not counted, and distinct counts are approximate; ``hourly_rollups`` counts
    every row, exactly.
    """
    distincts = [
        F.approx_count_distinct("badge_id").alias("approx_badges"),
        F.approx_count_distinct("zone_id").alias("approx_zones"),
    ]
    counts = with_watermark(raw, "ingestion_time", delay).groupBy(F.window("_clock", width)).agg(
        F.count("*").alias("event_count"),
        F.count_if(F.col("signal_quality") == "WEAK").alias("weak_signal_count"),
        F.count_if(F.col("direction") == "ENTRY").alias("entry_count"),
        F.count_if(F.col("direction") == "EXIT").alias("exit_count"),
        *(distincts if distinct else []),
    )
    return counts.select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
        *[c for c in counts.columns if c != "window"],
        (F.col("entry_count") - F.col("exit_count")).alias("net_occupancy_change"),
    )


def keep_rollups(spark: SparkSession, layout: Layout, batch: DataFrame, run: str, batch_id: int) -> None:
    """Add a batch's part of each of its hours, in place of an earlier attempt. A number, once given, never changes."""
    columns = [*rollups.COUNTED, *rollups.ENDS, "signal_strength", "signal_quality", "direction"]
    kept = batch.select(*columns).persist()
    seen = rollups.seen_values(kept).persist()
    try:
        layout.append_value_numbers(rollups.new_numbers(seen, layout.value_numbers(spark)))
        layout.write_batch(rollups.hourly_bits(seen, layout.value_numbers(spark)), "hourly_bits", run, batch_id)
        layout.write_batch(rollups.hourly_parts(kept), "hourly_parts", run, batch_id)
    finally:
        seen.unpersist()
        kept.unpersist()


def hourly_rollups(
    spark: SparkSession, raw: DataFrame, layout: Layout, trigger: dict | None = None
) -> StreamingQuery:
    """Keeps the layout's rollups up to date; see ``operators.rollups``. Run only one such query per layout."""
    checkpoint = layout.checkpoint("rollups")

    def handle(batch: DataFrame, batch_id: int) -> None:
        session = configure(batch.sparkSession)
        keep_rollups(session, layout, batch, run_of(session, checkpoint), batch_id)

    return (
        raw.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(handle).trigger(**(trigger or {"availableNow": True})).start()
    )


def keep_first_arrivals(spark: SparkSession, layout: Layout, batch: DataFrame, run: str, batch_id: int) -> None:
    """Add the first arrival of each key of a batch that no earlier batch has had.

    Copies of one key are reduced to the oldest in each task before they are shuffled. Of the keys
    held, only the days and the keys of the batch take part.
    """
    layout.drop_batch(spark, "first_events", run, batch_id)
    kept = first_per_key(batch.select(*EVENT_COLUMNS)).withColumn("event_date", F.to_date("event_timestamp")).persist()
    try:
        first, last = kept.agg(F.min("event_date"), F.max("event_date")).first()
        held = layout.table(spark, "first_events").where(F.col("event_date").between(F.lit(first), F.lit(last)))
        layout.write_batch(without_known(kept, kept, held), "first_events", run, batch_id)
    finally:
        kept.unpersist()


def first_arrivals(
    spark: SparkSession, raw: DataFrame, layout: Layout, trigger: dict | None = None
) -> StreamingQuery:
    """The first row to arrive for each key, whenever its copies come.

    The first micro-batch that has a key decides; within it, the oldest arrival. No row is lost
    for being late. The result is the layout's table ``first_events``.
    """
    checkpoint = layout.checkpoint("first_events")

    def handle(batch: DataFrame, batch_id: int) -> None:
        session = configure(batch.sparkSession)
        keep_first_arrivals(session, layout, batch, run_of(session, checkpoint), batch_id)

    return (
        raw.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(handle).trigger(**(trigger or {"availableNow": True})).start()
    )
