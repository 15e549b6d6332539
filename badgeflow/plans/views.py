"""The tables, monitoring views and checks of a layout under their usual names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from badgeflow.constants import FACT_TABLE, RAW_TABLE, STAGING_TABLE, USERS_TABLE
from badgeflow.functions.clock import AsOf
from badgeflow.plans import monitoring as m
from badgeflow.plans import quality, validation as v
from badgeflow.sources.tables import Layout, with_file


def tables(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    return {
        RAW_TABLE: layout.raw(spark),
        STAGING_TABLE: layout.staging(spark),
        USERS_TABLE: layout.users(spark),
        "DIM_ZONES": layout.zones(spark),
        "DIM_READERS": layout.readers(spark),
        FACT_TABLE: layout.fact(spark),
    }


def monitoring_views(
    spark: SparkSession, layout: Layout, database: str, scan_log: DataFrame | None = None, as_of: AsOf = None
) -> dict[str, DataFrame]:
    """The scan log comes from outside; without one its view is left out."""
    raw, fact = layout.raw(spark), layout.fact(spark)
    log, runs = layout.ingest_log(spark), layout.run_log(spark)
    views = {
        "V_CHANNEL_STATUS": m.channel_status(log, as_of),
        "V_INGESTION_METRICS": m.ingestion_metrics(raw, as_of),
        "V_END_TO_END_LATENCY": m.layer_latency(raw, layout.staging(spark), fact, as_of),
        "V_DATA_FRESHNESS": m.data_freshness(raw, fact, as_of),
        "V_STREAMING_COSTS": m.daily_ingest_cost(log, as_of),
        "V_TASK_EXECUTION_HISTORY": m.run_history(runs, database, as_of),
    }
    if scan_log is not None:
        views["V_PARTITION_EFFICIENCY"] = m.partition_efficiency(scan_log, as_of)
    return views


def register(
    spark: SparkSession, layout: Layout, database: str, scan_log: DataFrame | None = None, as_of: AsOf = None
) -> list[str]:
    """Make tables and views known to ``spark.sql``.

    Folders are listed here, so call it again to see files written later.
    """
    named = tables(spark, layout) | monitoring_views(spark, layout, database, scan_log, as_of)
    for name, df in named.items():
        df.createOrReplaceTempView(name)
    return list(named)


def run_checks(
    spark: SparkSession, layout: Layout, database: str, task_pattern: str, as_of: AsOf = None
) -> dict[str, DataFrame]:
    """All validation queries, in the order a person would read them."""
    raw, staging, fact = layout.raw(spark), layout.staging(spark), layout.fact(spark)
    users, zones, runs = layout.users(spark), layout.zones(spark), layout.run_log(spark)
    unstaged = layout.unstaged(spark, with_file(raw))
    return {
        "layer_row_counts": v.layer_row_counts(raw, staging, fact),
        "pending_status": v.pending_status(unstaged),
        "recent_runs": v.recent_runs(runs, database, as_of),
        "raw_stats": v.raw_stats(raw),
        "pending_count": v.pending_count(unstaged),
        "staging_stats": v.staging_stats(staging),
        "user_dim_stats": v.user_dim_stats(users),
        "auto_users_sample": v.auto_users_sample(users),
        "fact_stats": v.fact_stats(fact),
        "events_by_date": v.events_by_date(fact),
        "direction_distribution": v.direction_distribution(fact),
        "signal_distribution": v.signal_distribution(fact),
        "flagged_access": v.flagged_access(fact),
        "top_zones": v.top_zones(fact, zones),
        "top_badges": v.top_badges(fact, users),
        "null_check": v.null_check(fact),
        "run_errors": v.run_errors(runs, database, as_of),
        "task_credits": v.task_credits(runs, task_pattern, as_of),
        "ingestion_latency": v.ingestion_latency(fact),
        "layer_row_summary": v.layer_row_summary(raw, staging, fact),
        "pipeline_health": v.pipeline_health(unstaged, staging, fact, runs, as_of),
        "staging_duplicates": quality.staging_duplicates(staging),
        "dimension_duplicates": quality.dimension_duplicates(users, zones, layout.readers(spark)),
        "orphan_keys": quality.orphan_keys(fact, users, zones),
    }
