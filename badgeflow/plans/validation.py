"""Validation queries over raw, staging, dimensions, fact and logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from badgeflow.constants import (
    DRAINED_TEXT, FACT_TABLE, HEALTHY_LATENCY_SECONDS, PENDING_CHECK, PENDING_TEXT, RAW_TABLE,
    RECENT_RUNS_LIMIT, RUN_ERRORS_LIMIT, STAGING_TABLE, UNKNOWN, USERS_TABLE,
)
from badgeflow.functions.clock import AsOf, ago, seconds_between, since
from badgeflow.functions.signal import mean_of_decimal, percent
from badgeflow.operators import rollups
from badgeflow.operators.users import current
from badgeflow.plans.monitoring import duration, newest_runs

MEDIAN_BUCKET_SECONDS = 3600


def _row_counts(labelled: list[tuple[str, DataFrame]]) -> DataFrame:
    counts = [
        df.agg(F.lit(label).alias("layer"), F.count("*").alias("row_count")) for label, df in labelled
    ]
    first, *rest = counts
    for other in rest:
        first = first.unionByName(other)
    return first


def layer_row_counts(raw: DataFrame, staging: DataFrame, fact: DataFrame) -> DataFrame:
    return _row_counts([("RAW Layer", raw), ("STAGING Layer", staging), ("ANALYTICS Layer", fact)])


def layer_row_summary(raw: DataFrame, staging: DataFrame, fact: DataFrame) -> DataFrame:
    tables = [(RAW_TABLE, raw), (STAGING_TABLE, staging), (FACT_TABLE, fact)]
    return _row_counts(tables).orderBy(F.desc("row_count"), "layer")


def _pending_rows() -> Column:
    return F.coalesce(F.sum("n_rows"), F.lit(0))


def pending_status(unstaged: DataFrame) -> DataFrame:
    """``unstaged``: raw files that are not staged yet, with ``n_rows``."""
    any_pending = _pending_rows() > 0
    return unstaged.agg(
        F.lit(PENDING_CHECK).alias("check_type"),
        F.when(any_pending, "true").otherwise("false").alias("status"),
        F.when(any_pending, PENDING_TEXT).otherwise(DRAINED_TEXT).alias("interpretation"),
    )


def pending_count(unstaged: DataFrame) -> DataFrame:
    return unstaged.agg(
        F.lit("Stream Pending Records").alias("check_type"), _pending_rows().alias("pending_count")
    )


def recent_runs(
    run_log: DataFrame, database: str, as_of: AsOf = None, limit: int | None = RECENT_RUNS_LIMIT
) -> DataFrame:
    return newest_runs(run_log, as_of, 1, limit, database).select(
        F.col("name").alias("task_name"), "state", "scheduled_time", "completed_time",
        duration().alias("duration_sec"),
    ).orderBy(F.desc("scheduled_time"))


def run_errors(
    run_log: DataFrame, database: str, as_of: AsOf = None, limit: int | None = RUN_ERRORS_LIMIT
) -> DataFrame:
    return newest_runs(run_log, as_of, 2, limit, database).select(
        F.col("name").alias("task_name"), "state", "scheduled_time", "completed_time",
        duration().alias("duration_sec"), "error_code", "error_message",
    ).orderBy(F.desc("scheduled_time"))


def task_credits(run_log: DataFrame, name_pattern: str, as_of: AsOf = None) -> DataFrame:
    """Credits per task over two hours. In the pattern ``_`` and ``%`` are wildcards."""
    runs = since(run_log.where(F.col("name").like(name_pattern)), "scheduled_time", ago(as_of, 2))
    return runs.groupBy(F.col("name").alias("task_name")).agg(
        F.sum("credits_used").alias("total_credits"),
        F.count("*").alias("execution_count"),
        F.round(F.avg("credits_used"), 4).alias("avg_credits_per_run"),
    ).orderBy(F.desc("total_credits"), "task_name")


def raw_stats(raw: DataFrame) -> DataFrame:
    return raw.agg(
        F.lit(RAW_TABLE).alias("table_name"),
        F.count("*").alias("row_count"),
        F.countDistinct("badge_id").alias("unique_badges"),
        F.countDistinct("zone_id").alias("unique_zones"),
        F.min("event_timestamp").alias("earliest_event"),
        F.max("event_timestamp").alias("latest_event"),
        F.min("ingestion_time").alias("first_ingestion"),
        F.max("ingestion_time").alias("last_ingestion"),
    )


def rolled_raw_stats(parts: DataFrame, bits: DataFrame) -> DataFrame:
    """The same from rollups, without reading raw."""
    return rollups.total_stats(parts, bits).select(
        F.lit(RAW_TABLE).alias("table_name"),
        F.col("event_count").alias("row_count"),
        F.col("distinct_badge_id").alias("unique_badges"),
        F.col("distinct_zone_id").alias("unique_zones"),
        "earliest_event", "latest_event", "first_ingestion", "last_ingestion",
    )


def staging_stats(staging: DataFrame) -> DataFrame:
    return staging.agg(
        F.lit(STAGING_TABLE).alias("table_name"),
        F.count("*").alias("row_count"),
        F.countDistinct("badge_id").alias("unique_badges"),
        F.min("event_timestamp").alias("earliest_event"),
        F.max("event_timestamp").alias("latest_event"),
    )


def user_dim_stats(users: DataFrame) -> DataFrame:
    return current(users).agg(
        F.lit(USERS_TABLE).alias("dimension_name"),
        F.count("*").alias("total_users"),
        F.count_if(F.col("user_name") == UNKNOWN).alias("auto_created_users"),
        F.count_if(F.col("user_name") != UNKNOWN).alias("seed_users"),
    )


def auto_users_sample(users: DataFrame, rows: int = 5) -> DataFrame:
    """A sample of automatically created users; the first by id, so that it repeats."""
    created = current(users).where(F.col("user_name") == UNKNOWN)
    return created.select(
        F.lit("Sample Auto-Created Users").alias("check_type"),
        "user_id", "user_name", "clearance_level", "created_timestamp",
    ).orderBy("user_id").limit(rows)


def fact_stats(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.lit(FACT_TABLE).alias("table_name"),
        F.count("*").alias("total_events"),
        F.countDistinct("badge_id").alias("unique_badges"),
        F.countDistinct("zone_key").alias("unique_zones"),
        F.min("event_date").alias("earliest_date"),
        F.max("event_date").alias("latest_date"),
        F.min("event_timestamp").alias("earliest_timestamp"),
        F.max("event_timestamp").alias("latest_timestamp"),
    )


def events_by_date(fact: DataFrame, dates: int = 10) -> DataFrame:
    """Counts for the latest event dates.

    The earliest of these dates is found from the partition column alone, and then limits the
    scan to their partitions.
    """
    latest = fact.select("event_date").distinct().orderBy(F.desc("event_date")).limit(dates)
    first = latest.agg(F.min("event_date").alias("first")).scalar()
    return fact.where(F.col("event_date") >= first).groupBy("event_date").agg(
        F.count("*").alias("event_count"),
        F.countDistinct("badge_id").alias("unique_badges"),
        F.countDistinct("zone_key").alias("unique_zones"),
    ).orderBy(F.desc("event_date")).limit(dates)


def direction_distribution(fact: DataFrame) -> DataFrame:
    counts = fact.groupBy("direction").agg(F.count("*").alias("event_count"))
    total = counts.agg(F.sum("event_count").alias("total")).scalar()
    return counts.withColumn("percentage", percent(F.col("event_count"), total)).orderBy(
        F.desc("event_count"), "direction"
    )


def signal_distribution(fact: DataFrame) -> DataFrame:
    return fact.groupBy("signal_quality").agg(
        F.count("*").alias("event_count"),
        F.round(mean_of_decimal(F.col("signal_strength")), 2).alias("avg_signal_strength"),
        F.min("signal_strength").alias("min_signal"),
        F.max("signal_strength").alias("max_signal"),
    ).orderBy(F.desc("event_count"), "signal_quality")


def flagged_access(fact: DataFrame) -> DataFrame:
    """After-hours, weekend and restricted events, counted in one pass and turned into rows."""
    counts = fact.agg(
        F.count("*").alias("total"),
        F.count_if("is_after_hours").alias("after_hours"),
        F.count_if("is_weekend").alias("weekend"),
        F.count_if("is_restricted_access").alias("restricted"),
    )
    rows = counts.select("total", F.stack(
        F.lit(3),
        F.lit("After-Hours Events"), F.col("after_hours"),
        F.lit("Weekend Events"), F.col("weekend"),
        F.lit("Restricted Access Events"), F.col("restricted"),
    ).alias("category", "event_count"))
    return rows.select(
        "category", "event_count", percent(F.col("event_count"), F.col("total")).alias("percentage")
    )


def top_zones(fact: DataFrame, zones: DataFrame, rows: int = 5) -> DataFrame:
    """Facts are counted per zone key before the zone's names are joined."""
    names = ["zone_name", "zone_type", "building_name"]
    counts = fact.groupBy("zone_key").agg(F.count("*").alias("n"))
    return (
        counts.join(zones.select("zone_key", *names), "zone_key")
        .groupBy(*names).agg(F.sum("n").alias("access_count"))
        .orderBy(F.desc("access_count"), *names).limit(rows)
    )


def top_badges(fact: DataFrame, users: DataFrame, rows: int = 5) -> DataFrame:
    names = ["user_name", "user_type", "department"]
    counts = fact.groupBy("badge_id", "user_key").agg(F.count("*").alias("n"))
    return (
        counts.join(users.select("user_key", *names), "user_key")
        .groupBy("badge_id", *names).agg(F.sum("n").alias("access_count"))
        .orderBy(F.desc("access_count"), "badge_id", *names).limit(rows)
    )


def null_check(fact: DataFrame) -> DataFrame:
    columns = {
        "null_badge_id": "badge_id", "null_user_key": "user_key", "null_zone_key": "zone_key",
        "null_timestamp": "event_timestamp", "null_direction": "direction",
    }
    return fact.agg(
        F.lit("Completeness Check").alias("check_type"),
        F.count("*").alias("total_records"),
        *[F.count_if(F.col(column).isNull()).alias(name) for name, column in columns.items()],
    )


def fact_latency() -> Column:
    return seconds_between(F.col("ingestion_time"), F.col("fact_load_time"))


def median_of_counts(counts: DataFrame, value: str, weight: str, width: int) -> DataFrame:
    """Exact interpolated median of whole numbers given as (value, weight) rows.

    Values are first counted in buckets ``width`` wide. Only the bucket or two that hold the
    middle ranks are looked at row by row, each of at most ``width`` distinct values.
    """
    # never null: the join below then adds no filter, and all uses of the counts are one shuffle
    bucketed = counts.withColumn("_bucket", F.coalesce(F.floor(F.col(value) / width), F.lit(0)))
    totals = bucketed.groupBy("_bucket").agg(F.sum(weight).alias("_weight"))
    until = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
    total = totals.agg(F.sum("_weight").alias("n")).scalar()
    low, high = F.floor((total + 1) / 2), F.floor((total + 2) / 2)
    middle = totals.select(
        "_bucket", F.sum("_weight").over(until).alias("_until"), "_weight"
    ).withColumn("_before", F.col("_until") - F.col("_weight")).where(
        ((F.col("_before") < low) & (F.col("_until") >= low))
        | ((F.col("_before") < high) & (F.col("_until") >= high))
    ).select("_bucket", "_before")
    inside = W.partitionBy("_bucket").orderBy(value).rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = bucketed.join(F.broadcast(middle), "_bucket").withColumn(
        "_until", F.col("_before") + F.sum(weight).over(inside)
    ).withColumn("_from", F.col("_until") - F.col(weight))
    at_rank = lambda rank: F.max(F.when((F.col("_from") < rank) & (F.col("_until") >= rank), F.col(value)))
    return ranked.agg(((at_rank(low) + at_rank(high)) / 2.0).alias("median"))


def ingestion_latency(fact: DataFrame) -> DataFrame:
    """Latency from arrival to fact load.

    Everything is computed from the number of facts per whole second of latency, which Spark
    adds up before it shuffles.
    """
    known = fact.where("fact_load_time IS NOT NULL AND ingestion_time IS NOT NULL")
    counts = known.groupBy(fact_latency().alias("latency")).agg(F.count("*").alias("n"))
    median = median_of_counts(counts, "latency", "n", MEDIAN_BUCKET_SECONDS).scalar()
    return counts.agg(
        F.lit("Ingestion Latency").alias("metric"),
        F.min("latency").alias("min_latency_sec"),
        F.max("latency").alias("max_latency_sec"),
        F.try_divide(
            F.sum(F.col("latency") * F.col("n")).cast("double"), F.sum("n").cast("double")
        ).alias("avg_latency_sec"),
    ).withColumn("median_latency_sec", median)


def pipeline_health(
    unstaged: DataFrame, staging: DataFrame, fact: DataFrame, run_log: DataFrame, as_of: AsOf = None
) -> DataFrame:
    """One row per rule of a healthy pipeline: whether it holds and what was seen."""
    required = F.lit(False)
    for column in ("badge_id", "user_key", "zone_key", "event_timestamp"):
        required = required | F.col(column).isNull()
    seen = fact.agg(
        F.count("*").alias("facts"),
        F.coalesce(F.max(fact_latency()), F.lit(0)).alias("latency"),
        F.count_if(required).alias("nulls"),
    )
    staged = staging.agg(F.count("*").alias("staged")).scalar()
    of_fact = seen.withColumn("surplus", staged - F.col("facts")).select(F.stack(
        F.lit(3),
        F.lit("staging covers facts"), F.col("surplus") >= 0, F.col("surplus"),
        F.lit("latency below 120 s"), F.col("latency") < HEALTHY_LATENCY_SECONDS, F.col("latency"),
        F.lit("required fields present"), F.col("nulls") == 0, F.col("nulls"),
    ).alias("rule", "ok", "observed"))

    def none(df: DataFrame, name: str, found: Column) -> DataFrame:
        return df.agg(F.lit(name).alias("rule"), (found == 0).alias("ok"), found.alias("observed"))

    failed = since(run_log, "scheduled_time", ago(as_of, 2)).where(F.col("state") == "FAILED")
    return (
        of_fact.unionByName(none(unstaged, "no pending rows", _pending_rows()))
        .unionByName(none(failed, "no failed runs", F.count("*")))
    )
