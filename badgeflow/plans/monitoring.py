"""Monitoring views: functions of tables and a clock."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from badgeflow.constants import (
    EXCELLENT_BELOW_PCT, FACT_TABLE, FAIR_BELOW_PCT, GOOD_BELOW_PCT, MISSING_SIGNAL, RAW_TABLE,
    RUN_HISTORY_LIMIT, STALE_AFTER_SECONDS, WARNING_AFTER_SECONDS,
)
from badgeflow.functions.clock import AsOf, ago, instant, seconds_between, since, truncated
from badgeflow.functions.signal import mean_of_decimal, percent
from badgeflow.operators import rollups

GIB = float(1024**3)


def hourly_stats(raw: DataFrame, hour: Column, ignore_sentinel: bool = False) -> DataFrame:
    signal = F.col("signal_strength")
    if ignore_sentinel:
        signal = F.when(signal != MISSING_SIGNAL, signal)
    return raw.groupBy(hour.alias("ingestion_hour")).agg(
        F.count("*").alias("event_count"),
        F.countDistinct("badge_id").alias("unique_badges"),
        F.countDistinct("zone_id").alias("unique_zones"),
        mean_of_decimal(signal).alias("avg_signal_strength"),
        F.count_if(F.col("signal_quality") == "WEAK").alias("weak_signal_count"),
        F.count_if(F.col("direction") == "ENTRY").alias("entry_count"),
        F.count_if(F.col("direction") == "EXIT").alias("exit_count"),
    )


def ingestion_metrics(raw: DataFrame, as_of: AsOf = None, ignore_sentinel: bool = False) -> DataFrame:
    """Hourly arrivals of the last 24 hours. The missing-signal value counts in the average."""
    recent = since(raw, "ingestion_time", ago(as_of, 24))
    return _shown(hourly_stats(recent, truncated("hour", F.col("ingestion_time")), ignore_sentinel))


def rolled_ingestion_metrics(
    parts: DataFrame, bits: DataFrame, raw: DataFrame, as_of: datetime | str | None = None, ignore_sentinel: bool = False
) -> DataFrame:
    """The same from rollups. Only the part of the first hour that the 24 hours cut off is read from raw."""
    now = datetime.now(timezone.utc).replace(tzinfo=None) if as_of is None else datetime.fromisoformat(str(as_of))
    cutoff = now - timedelta(hours=24)
    hour = cutoff.replace(minute=0, second=0, microsecond=0)
    whole = hour if hour == cutoff else hour + timedelta(hours=1)
    stats = rollups.hourly_stats(since(parts, "hour", instant(whole)), since(bits, "hour", instant(whole)), ignore_sentinel)
    if whole > cutoff:
        cut = since(raw, "ingestion_time", instant(cutoff)).where(F.col("ingestion_time") < instant(whole))
        if "ingestion_date" in raw.columns:
            cut = cut.where(F.col("ingestion_date") <= F.to_date(instant(whole)))
        stats = stats.unionByName(hourly_stats(cut, truncated("hour", F.col("ingestion_time")), ignore_sentinel))
    return _shown(stats)


def _shown(stats: DataFrame) -> DataFrame:
    count = F.col("event_count")
    return stats.select(
        "ingestion_hour",
        "event_count",
        (count / 3600.0).alias("events_per_second"),
        "unique_badges",
        "unique_zones",
        F.round("avg_signal_strength", 2).alias("avg_signal_strength"),
        "weak_signal_count",
        percent(F.col("weak_signal_count"), count).alias("weak_signal_pct"),
        "entry_count",
        "exit_count",
        (F.col("entry_count") - F.col("exit_count")).alias("net_occupancy_change"),
    ).orderBy(F.desc("ingestion_hour"))


def health(age: Column, empty_status: str = "HEALTHY") -> Column:
    """An unknown age counts as healthy unless ``empty_status`` says otherwise."""
    return (
        F.when(age.isNull(), empty_status)
        .when(age > STALE_AFTER_SECONDS, "STALE")
        .when(age > WARNING_AFTER_SECONDS, "WARNING")
        .otherwise("HEALTHY")
    )


def layer_latency(
    raw: DataFrame, staging: DataFrame, fact: DataFrame, as_of: AsOf = None,
    empty_status: str = "HEALTHY",
) -> DataFrame:
    def last_hour(df: DataFrame, layer: str, column: str) -> DataFrame:
        return since(df, column, ago(as_of, 1)).agg(
            F.lit(layer).alias("layer"),
            F.max(column).alias("last_update"),
            F.count("*").alias("row_count"),
        )

    layers = (
        last_hour(raw, "RAW", "ingestion_time")
        .unionByName(last_hour(staging, "STAGING", "staging_time"))
        .unionByName(last_hour(fact, "ANALYTICS", "fact_load_time"))
    )
    age = seconds_between(F.col("last_update"), instant(as_of))
    rank = F.when(F.col("layer") == "RAW", 1).when(F.col("layer") == "STAGING", 2).otherwise(3)
    return layers.select(
        "layer", "last_update", age.alias("seconds_since_update"), "row_count",
        health(age, empty_status).alias("health_status"),
    ).orderBy(rank)


def data_freshness(raw: DataFrame, fact: DataFrame, as_of: AsOf = None) -> DataFrame:
    now, hour_ago = instant(as_of), ago(as_of, 1)

    def freshness(df: DataFrame, name: str, arrival: str) -> DataFrame:
        last = df.agg(
            F.max("event_timestamp").alias("last_event_timestamp"),
            F.max(arrival).alias("last_ingestion_timestamp"),
            F.count("*").alias("total_rows"),
            # a sum, not a count: null for an empty table
            F.sum(F.when(F.col(arrival) >= hour_ago, 1).otherwise(0)).alias("rows_last_hour"),
        )
        return last.select(
            F.lit(name).alias("table_name"),
            "last_event_timestamp",
            "last_ingestion_timestamp",
            seconds_between(F.col("last_event_timestamp"), now).alias("event_age_seconds"),
            seconds_between(F.col("last_ingestion_timestamp"), now).alias("ingestion_age_seconds"),
            "total_rows",
            "rows_last_hour",
        )

    return freshness(raw, RAW_TABLE, "ingestion_time").unionByName(
        freshness(fact, FACT_TABLE, "fact_load_time")
    )


def channel_status(ingest_log: DataFrame, as_of: AsOf = None, table: str = RAW_TABLE) -> DataFrame:
    recent = since(ingest_log.where(F.col("table_name") == table), "end_time", ago(as_of, 1))
    return recent.groupBy(F.col("table_name").alias("pipe_name")).agg(
        F.max("end_time").alias("last_ingestion_time"),
        seconds_between(F.max("end_time"), instant(as_of)).alias("seconds_since_last_ingestion"),
        F.sum("num_rows_migrated").alias("total_rows_inserted"),
        (F.sum("num_bytes_migrated") / GIB).alias("total_gb_inserted"),
        F.countDistinct(truncated("minute", F.col("end_time"))).alias("active_minutes_last_hour"),
        F.avg("num_rows_migrated").alias("avg_rows_per_insert"),
        F.max("num_rows_migrated").alias("max_rows_per_insert"),
        F.sum("credits_used").alias("total_credits_used"),
    )


def daily_ingest_cost(
    ingest_log: DataFrame, as_of: AsOf = None, days: int = 30, table: str = RAW_TABLE
) -> DataFrame:
    recent = since(ingest_log.where(F.col("table_name") == table), "end_time", ago(as_of, 24 * days))
    daily = recent.groupBy(F.to_date("end_time").alias("ingestion_date")).agg(
        (F.sum("num_bytes_migrated") / GIB).alias("gb_ingested"),
        F.sum("num_rows_migrated").alias("rows_ingested"),
        F.sum("credits_used").alias("actual_credits_used"),
    )
    rows_per_gb = F.try_divide(F.col("rows_ingested").cast("double"), F.col("gb_ingested"))
    return daily.withColumn("rows_per_gb", F.round(rows_per_gb, 0)).orderBy(F.desc("ingestion_date"))


def cost_total(ingest_log: DataFrame, as_of: AsOf = None) -> DataFrame:
    daily = daily_ingest_cost(ingest_log, as_of)
    return daily.agg(F.sum("actual_credits_used").alias("total_credits_last_30_days"))


def partition_efficiency(scan_log: DataFrame, as_of: AsOf = None) -> DataFrame:
    """How much of the tables was scanned, last 24 hours.

    ``total_gb_scanned_approx`` is rows / 1024**3, under the name it is known by.
    """
    tables = scan_log.where(F.col("table_name").isin(RAW_TABLE, FACT_TABLE))
    sums = since(tables, "interval_start_time", ago(as_of, 24)).groupBy("table_name").agg(
        F.sum("num_queries").alias("query_count"),
        F.sum("partitions_scanned").alias("scanned"),
        F.sum(F.col("partitions_scanned") + F.col("partitions_pruned")).alias("partitions"),
        F.sum("rows_scanned").alias("rows_scanned"),
        F.sum("rows_pruned").alias("rows_pruned"),
        F.sum(F.col("rows_scanned") + F.col("rows_pruned")).alias("rows"),
    )
    ratio = F.try_divide(100.0 * F.col("scanned"), F.col("partitions").cast("double"))
    return sums.select(
        "table_name",
        "query_count",
        F.round(ratio, 2).alias("avg_scan_ratio_pct"),
        F.round(F.col("rows_scanned") / GIB, 2).alias("total_gb_scanned_approx"),
        percent(F.col("rows_pruned"), F.col("rows")).alias("row_prune_ratio_pct"),
        F.when(ratio < EXCELLENT_BELOW_PCT, "EXCELLENT")
        .when(ratio < GOOD_BELOW_PCT, "GOOD")
        .when(ratio < FAIR_BELOW_PCT, "FAIR")
        .otherwise("POOR")
        .alias("pruning_efficiency"),
    )


def newest_runs(run_log: DataFrame, as_of: AsOf, hours: int, limit: int | None, database: str) -> DataFrame:
    """The newest ``limit`` runs of the last hours (None: all); of those, the runs of one database."""
    newest = since(run_log, "scheduled_time", ago(as_of, hours))
    if limit is not None:
        newest = newest.orderBy(F.desc("scheduled_time"), "name", "completed_time").limit(limit)
    return newest.where(F.col("database_name") == database)


def duration() -> Column:
    return seconds_between(F.col("scheduled_time"), F.col("completed_time"))


def run_history(
    run_log: DataFrame, database: str, as_of: AsOf = None, limit: int | None = RUN_HISTORY_LIMIT
) -> DataFrame:
    status = (
        F.when(F.col("state") == "SUCCEEDED", "SUCCESS")
        .when(F.col("state").isin("FAILED", "SKIPPED"), F.col("state"))
        .otherwise("UNKNOWN")
    )
    return newest_runs(run_log, as_of, 24, limit, database).select(
        F.col("name").alias("task_name"), "state", "scheduled_time", "completed_time",
        duration().alias("duration_seconds"), "error_code", "error_message",
        status.alias("execution_status"),
    ).orderBy(F.desc("scheduled_time"))


def run_summary(run_log: DataFrame, database: str, as_of: AsOf = None, limit: int | None = None) -> DataFrame:
    """Over all runs of the last day; ``limit`` would cap them before they are counted."""
    done = run_history(run_log, database, as_of, limit).where(F.col("execution_status") == "SUCCESS")
    return done.groupBy("task_name").agg(
        F.count("*").alias("executions"), F.avg("duration_seconds").alias("avg_duration")
    )
