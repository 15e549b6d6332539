"""Badge messages and log tables derived from the given ``events`` table.

The rules are those of FIXTURES.md: some events are delivered twice, some lack a badge, a zone
or a signal, and users go beyond the seeded ones. Everything is a projection of one scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from badgeflow.constants import FACT_TABLE, RAW_TABLE
from badgeflow.functions.clock import truncated

AS_OF = "2024-01-31 00:00:00"
DATABASE = "BADGE_DB"


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _seconds(column):
    return F.make_dt_interval(secs=column)


def decoded_messages(events: DataFrame) -> DataFrame:
    """Message fields as text, with arrival time, delivery number and the JSON message."""
    n = F.col("event_id")
    delivered = events.withColumn(
        "redelivery", F.explode(F.when(n % 20 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    )
    again = F.col("redelivery")
    user_text = F.col("user_id").cast("string")
    zone = (
        F.when(n % 6 == 0, "ZONE-LOBBY-1").when(n % 6 == 1, "ZONE-OFFICE-2A")
        .when(n % 6 == 2, "ZONE-SERVER-B1").when(n % 6 == 3, "ZONE-CONF-3B")
        .when(n % 6 == 4, "ZONE-PARKING-1").otherwise("ZONE-UNMAPPED")
    )
    # -40 - n % 60 - 5 * again, and half a dBm less for odd n
    signal = F.concat(
        F.lit("-"), (n % 60 + 5 * again + 40).cast("string"), F.when(n % 2 == 1, ".5").otherwise(".0")
    )
    direction = F.when(F.col("event_type") == "click", "entry").when(
        F.col("event_type") == "view", "ENTRY"
    ).when(F.col("event_type") == "purchase", "exit").when(F.col("event_type") == "signup", "Exit")
    fields = delivered.select(
        F.when(n % 97 != 96, F.concat(F.lit("BADGE-"), F.lpad(user_text, 6, "0"))).alias("badge_id"),
        F.concat(
            F.lit("USR-"),
            F.when(F.col("user_id") < 1000, F.lpad(user_text, 3, "0")).otherwise(user_text),
        ).alias("user_id"),
        zone.alias("zone_id"),
        F.concat(F.lit("RDR-"), (n % 6 + 100).cast("string")).alias("reader_id"),
        F.replace(F.col("ts").cast("string"), F.lit(" "), F.lit("T")).alias("event_timestamp"),
        F.when(n % 11 != 0, signal).alias("signal_strength"),
        direction.alias("direction"),
        n,
        "redelivery",
        (F.col("ts") + _seconds(n % 90 + 30 * again)).alias("ingestion_time"),
    )
    message = F.to_json(F.struct(
        "badge_id", "user_id", "zone_id", "reader_id", "event_timestamp",
        F.col("signal_strength").cast("double").alias("signal_strength"), "direction",
        "event_id", "redelivery",
        F.replace(F.col("ingestion_time").cast("string"), F.lit(" "), F.lit("T")).alias("delivered_at"),
    ))
    return fields.withColumn("raw_json", message)


def messages(events: DataFrame) -> DataFrame:
    """The JSON messages with the time of their arrival, as a Kafka source would give them."""
    return decoded_messages(events).select(
        F.col("raw_json").alias("value"), F.col("ingestion_time").alias("timestamp")
    )


def message_lines(events: DataFrame) -> DataFrame:
    """The messages as lines of text; two in one line for every fiftieth event."""
    n, message = F.col("event_id"), F.col("raw_json")
    return decoded_messages(events).select(F.when(n % 50 == 7, F.concat(message, message)).otherwise(message).alias("value"))


def broken_messages(decoded: DataFrame) -> DataFrame:
    """The decoded messages with each rule broken now and then."""
    n = F.col("event_id")

    def now_and_then(column: str, remainder: int, broken) -> Column:
        return F.when(n % 50 == remainder, broken).otherwise(F.col(column))

    long = F.repeat(F.lit("x"), 51)
    kept = decoded.withColumns({
        "user_id": now_and_then("user_id", 1, F.lit(None)), "zone_id": now_and_then("zone_id", 2, F.lit(None)),
        "reader_id": now_and_then("reader_id", 3, F.lit(None)), "event_timestamp": now_and_then("event_timestamp", 4, F.lit(None)),
    })
    kept = kept.withColumns({
        "badge_id": now_and_then("badge_id", 5, long), "user_id": now_and_then("user_id", 6, long),
        "zone_id": now_and_then("zone_id", 7, long), "reader_id": now_and_then("reader_id", 8, long),
        "event_timestamp": now_and_then("event_timestamp", 9, F.lit("2024")),
        "signal_strength": now_and_then("signal_strength", 10, F.lit("weak")),
        "direction": now_and_then("direction", 11, F.lit("ENTRY SOUTH")),
    })
    return kept.withColumns({
        "event_timestamp": now_and_then("event_timestamp", 12, F.lit("1999-12-31T23:59:59")),
        "signal_strength": now_and_then("signal_strength", 13, F.lit("-1000")),
    })


def delivered_at(value: str = "value"):
    """Arrival time out of the message, for sources that hold nothing else."""
    return F.get_json_object(F.col(value), "$.delivered_at").cast("timestamp_ntz")


def ingest_log(raw: DataFrame) -> DataFrame:
    """One log row per minute of arrivals."""
    return (
        raw.groupBy(truncated("minute", F.col("ingestion_time")).alias("end_time"))
        .agg(
            F.count("*").alias("num_rows_migrated"),
            F.sum(F.octet_length("zone_id").cast("bigint")).alias("num_bytes_migrated"),
        )
        .select(
            F.lit(RAW_TABLE).alias("table_name"), "end_time", "num_rows_migrated", "num_bytes_migrated",
            (F.col("num_rows_migrated") / F.lit(1e6)).alias("credits_used"),
        )
    )


def scan_log(events: DataFrame) -> DataFrame:
    n = F.col("event_id")
    return events.select(
        F.element_at(
            F.array(F.lit(RAW_TABLE), F.lit(FACT_TABLE), F.lit("DIM_ZONES")), (n % 3 + 1).cast("int")
        ).alias("table_name"),
        F.col("ts").alias("interval_start_time"),
        (n % 5 + 1).alias("num_queries"),
        (n % 40).alias("partitions_scanned"),
        (n % 70).alias("partitions_pruned"),
        (n % 1000 * 1000000).alias("rows_scanned"),
        (n % 700 * 1500000).alias("rows_pruned"),
    )


def run_log(events: DataFrame) -> DataFrame:
    n = F.col("event_id")
    state = (
        F.when(n % 50 == 0, "FAILED").when(n % 51 == 0, "SKIPPED").when(n % 53 == 0, "EXECUTING")
        .otherwise("SUCCEEDED")
    )
    return events.select(
        F.element_at(
            F.array(F.lit("badge_stage_task"), F.lit("badge_enrich_task"), F.lit("nightly_report")),
            (n % 3 + 1).cast("int"),
        ).alias("name"),
        state.alias("state"),
        F.when(state == "FAILED", "100035").alias("error_code"),
        F.when(state == "FAILED", F.concat(F.lit("run "), n.cast("string"), F.lit(" failed"))).alias("error_message"),
        F.when(F.col("event_type") == "signup", "OTHER_DB").otherwise(DATABASE).alias("database_name"),
        F.col("ts").alias("scheduled_time"),
        F.when(state != "EXECUTING", F.col("ts") + _seconds(n % 7)).alias("completed_time"),
        (n % 10 / F.lit(1000.0)).alias("credits_used"),
    )
