"""One batch from raw rows to facts, and the catch-up load."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from badgeflow.constants import RAW_TABLE
from badgeflow.functions.clock import AsOf, instant, truncated
from badgeflow.operators.facts import enrich
from badgeflow.operators.staging import stage, without_known
from badgeflow.operators.users import apply_user_changes, numbered_users, unknown_ids
from badgeflow.sources.tables import BATCHED, BY_HAND, Layout, with_file

Ends = tuple[datetime | None, datetime | None]
EPOCH = datetime(1970, 1, 1)


def write_ingest_log(
    layout: Layout, batch: DataFrame, batch_id: int, credits_per_row: float = 0.0, run: str = BY_HAND
) -> None:
    """One log row per minute of arrivals of the batch."""
    log = batch.groupBy(truncated("minute", F.col("ingestion_time")).alias("end_time")).agg(
        F.count("*").alias("num_rows_migrated"),
        F.sum(F.col("message_bytes").cast("bigint")).alias("num_bytes_migrated"),
    )
    log = log.select(
        F.lit(RAW_TABLE).alias("table_name"), "end_time", "num_rows_migrated", "num_bytes_migrated",
        (F.col("num_rows_migrated") * credits_per_row).cast("double").alias("credits_used"),
        F.to_date("end_time").alias("log_date"),
    )
    layout.write_batch(log, "ingest_log", run, batch_id, few_days=True)


def stage_batch(
    spark: SparkSession, layout: Layout, batch: DataFrame, batch_id: int, staging_time: AsOf = None, run: str = BY_HAND,
    span: Span | None = None,
) -> DataFrame:
    """Write a batch to staging, in place of an earlier attempt, and give it back.

    Files of the batch (column ``file``, where it has one) count as staged from then on. ``span`` is told the two
    ends of the batch's event times.
    """
    rows = stage(batch, staging_time).withColumn("load_date", F.to_date("staging_time"))
    if span is not None:
        rows = span.told_by(rows)
    layout.write_batch(rows, "staging", run, batch_id, few_days=run != BY_HAND)
    if "file" in batch.columns:
        layout.append_staged_files(batch.select("file", "ingestion_date").distinct())
    return layout.batch(spark, "staging", run, batch_id)


class Span:
    """The two ends of the event times of rows, taken while the rows are written."""

    def __init__(self) -> None:
        self._seen = Observation()

    def told_by(self, rows: DataFrame) -> DataFrame:
        micros = F.unix_micros(F.col("event_timestamp").cast("timestamp"))
        return rows.observe(self._seen, F.min(micros).alias("first"), F.max(micros).alias("last"))

    def ends(self) -> Ends:
        seen = self._seen.get
        first, last = (None if seen[end] is None else EPOCH + timedelta(microseconds=seen[end]) for end in ("first", "last"))
        return first, last


def ends_of(staging: DataFrame) -> Ends:
    return tuple(staging.agg(F.min("event_timestamp"), F.max("event_timestamp")).first())


def facts_between(fact: DataFrame, first: datetime | None, last: datetime | None) -> DataFrame:
    """Facts with event times between two moments; none if there are no moments.

    Days are folders. Within one day the hour prunes row groups and pages, as each file is sorted by time.
    """
    if first is None:
        return fact.where("false")
    between = fact.where(
        F.col("event_date").between(F.lit(first.date()), F.lit(last.date()))
        & F.col("event_timestamp").between(instant(first), instant(last))
    )
    return between.where(F.col("event_hour").between(first.hour, last.hour)) if first.date() == last.date() else between


def merge_batch_users(spark: SparkSession, layout: Layout, staging: DataFrame, as_of: AsOf = None) -> None:
    """Append the unknown users of a batch. A key, once given, never changes: a replay finds its
    users known, and so does any other batch. Users are numbered only if there are unknown ones."""
    users = layout.users(spark)
    unknown = unknown_ids(staging, users).persist()
    try:
        if unknown.take(1):
            layout.append_users(numbered_users(unknown, users, as_of))
    finally:
        unknown.unpersist()


def missing_facts(
    spark: SparkSession, layout: Layout, staging: DataFrame, load_time: AsOf = None, span: Span | None = None
) -> DataFrame:
    """Facts of staged rows that are not loaded yet.

    The two ends of the rows' event times bound what is read of the fact;
    ``enrich`` compares by key within them.
    """
    held = facts_between(layout.fact(spark), *(ends_of(staging) if span is None else span.ends()))
    return enrich(staging, layout.users(spark), layout.zones(spark), held, load_time)


def load_facts(
    spark: SparkSession, layout: Layout, staging: DataFrame, load_time: AsOf = None, span: Span | None = None,
    few_days: bool = False,
) -> None:
    layout.append_fact(missing_facts(spark, layout, staging, load_time, span), few_days)


def process_batch(
    spark: SparkSession,
    layout: Layout,
    batch: DataFrame,
    batch_id: int,
    as_of: AsOf = None,
    staging_time: AsOf = None,
    fact_load_time: AsOf = None,
    run: str = BY_HAND,
) -> str:
    """Stage a batch, add its unknown users, load its facts. Safe to repeat.

    A batch is named by its run and number; batches of different runs never replace each other.
    """
    span = Span()
    staged = stage_batch(spark, layout, batch, batch_id, as_of if staging_time is None else staging_time, run, span)
    enrich_batch(spark, layout, staged, as_of, fact_load_time, span, few_days=run != BY_HAND)
    return "COMPLETED"


def enrich_batch(
    spark: SparkSession, layout: Layout, staged: DataFrame, as_of: AsOf = None, fact_load_time: AsOf = None,
    span: Span | None = None, few_days: bool = False,
) -> None:
    merge_batch_users(spark, layout, staged, as_of)
    load_facts(spark, layout, staged, as_of if fact_load_time is None else fact_load_time, span, few_days)


def catch_up(spark: SparkSession, layout: Layout, load_time: AsOf = None) -> str:
    """Load facts for all staged rows that have none, such as those of zones added later."""
    load_facts(spark, layout, layout.staging(spark), load_time)
    return "COMPLETED"


# --- retention ------------------------------------------------------------------------------


def low_water_mark(spark: SparkSession, layout: Layout, table: str, before: str) -> str:
    """The day before which a table of raw or staged rows may be swept: ``before``, or the first day that holds a row
    which some consumer still needs.

    Raw rows are needed until their files are staged, staged rows until they have a fact. Only days before
    ``before`` are looked at.
    """
    day = BATCHED[table][1]
    if table == "raw":
        old = with_file(layout.raw(spark)).where(F.col(day) < F.lit(before).cast("date"))
        needed = layout.unstaged(spark, old)
    elif table == "staging":
        old = layout.staging(spark).where(F.col(day) < F.lit(before).cast("date"))
        needed = without_known(old, old, layout.fact(spark))
    else:
        return before
    first = needed.agg(F.min(day).cast("string")).first()[0]
    return min(before, first or before)


def sweep(spark: SparkSession, layout: Layout, before: dict[str, str]) -> dict[str, str]:
    """Remove days of tables that nothing needs any more; ``before`` names a day for each table.

    Returns the marks. Safe to run beside the stream: batches write to days from their own clock on, and what they have
    not loaded holds the mark.
    """
    marks = {table: low_water_mark(spark, layout, table, day) for table, day in before.items()}
    for table, mark in marks.items():
        layout.expire(spark, table, mark)
    return marks


def change_users(
    spark: SparkSession, layout: Layout, changes: DataFrame, attributes: list[str], as_of: AsOf = None
) -> None:
    """Apply Type-2 changes to the stored dimension. Batches loaded afterwards take the new keys."""
    layout.replace_users(apply_user_changes(layout.users(spark), changes, attributes, as_of))
