"""New raw rows to staging and facts, batch by batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import date, datetime, timedelta, timezone
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from badgeflow import schemas
from badgeflow.constants import ENRICH_TASK, STAGE_TASK
from badgeflow.functions.clock import AsOf
from badgeflow.plans.pipeline import Span, enrich_batch, stage_batch, sweep, write_ingest_log
from badgeflow.session import configure
from badgeflow.sources.tables import Layout
from badgeflow.streaming.runs import run_of

DATABASE = "BADGE_DB"
Clock = Callable[[], datetime]
T = TypeVar("T")


def _wall_clock() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def earlier_attempts(spark: SparkSession, layout: Layout, run: str, batch_id: int) -> dict[str, int]:
    """How often each task of a batch has been tried."""
    held = layout.batch(spark, "run_log", run, batch_id).groupBy("name").agg(F.max("attempt").alias("attempts"))
    return {r.name: r.attempts for r in held.collect()}  # two tasks


def run_row(
    task: str, attempt: int, run: str, batch_id: int, started: datetime, ended: datetime, error: Exception | None = None,
    credits: float = 0.0,
) -> tuple:
    """A row of the run log for an attempt of a task."""
    return (
        task,
        "FAILED" if error else "SUCCEEDED",
        type(error).__name__ if error else None,
        str(error) if error else None,
        DATABASE,
        started,
        ended,
        credits,
        attempt,
        started.date(),
        run,
        batch_id,
    )


def log_runs(spark: SparkSession, layout: Layout, attempts: list[tuple]) -> None:
    """Append rows to the run log. Earlier attempts of the batch keep theirs."""
    rows = spark.createDataFrame(attempts, schemas.RUN_LOG_FILES).coalesce(1)
    rows.write.mode("append").partitionBy("run_date", "run", "batch_id").parquet(layout.path("run_log"))


class Attempts:
    """The attempts at the tasks of a query's batches, logged batch by batch.

    Only a batch that is no newer than the newest one of this handler, or its first one, can have been tried before.
    """

    def __init__(self, layout: Layout, query: str, clock: Clock, credits: float):
        self.layout, self.query, self.clock, self.credits = layout, query, clock, credits
        self.newest = -1

    @contextmanager
    def of_batch(self, spark: SparkSession, batch_id: int) -> Iterator[tuple[str, Callable]]:
        """The run, and what runs a task and notes how it went. The log is written when the batch is done or has failed."""
        run = run_of(spark, self.layout.checkpoint(self.query))
        earlier = {} if -1 < self.newest < batch_id else earlier_attempts(spark, self.layout, run, batch_id)
        self.newest = max(self.newest, batch_id)
        tried: list[tuple] = []

        def logged(task: str, work: Callable[[], T]) -> T:
            started, failure = self.clock(), None
            try:
                return work()
            except Exception as error:
                failure = error
                raise
            finally:
                earlier[task] = earlier.get(task, 0) + 1
                tried.append(run_row(task, earlier[task], run, batch_id, started, self.clock(), failure, self.credits))

        try:
            yield run, logged
        finally:
            if tried:
                log_runs(spark, self.layout, tried)


def batch_handler(
    layout: Layout,
    as_of: AsOf = None,
    staging_time: AsOf = None,
    fact_load_time: AsOf = None,
    credits_per_row: float = 0.0,
    credits_per_run: float = 0.0,
    clock: Clock = _wall_clock,
    keep_days: dict[str, int] | None = None,
    enrich: bool = True,
) -> Callable[[DataFrame, int], None]:
    """What is done with a micro-batch of raw rows: two tasks, logged together when they are done or one has failed.

    A replay of a batch repeats its effect. Once a day of the clock, days of ``keep_days`` (a table and its number of
    days) are swept that no consumer needs any more. Without ``enrich`` the batch is only staged, and a marker row
    says so to ``follow_staged``.
    """
    swept: set[date] = set()
    attempts = Attempts(layout, "changes", clock, credits_per_run)

    def handle(batch: DataFrame, batch_id: int) -> None:
        # a stream's own session has adaptive execution off; the loads need it
        spark = configure(batch.sparkSession)
        span = Span()

        def stage(run: str) -> DataFrame:
            write_ingest_log(layout, batch, batch_id, credits_per_row, run)
            staged = stage_batch(spark, layout, batch, batch_id, as_of if staging_time is None else staging_time, run, span)
            if not enrich:
                layout.append_staged_batch(spark, run, batch_id, clock())
            return staged

        with attempts.of_batch(spark, batch_id) as (run, logged):
            staged = logged(STAGE_TASK, lambda: stage(run))
            if enrich:
                logged(ENRICH_TASK, lambda: enrich_batch(spark, layout, staged, as_of, fact_load_time, span, few_days=True))
        today = clock().date() if keep_days else None
        if keep_days and today not in swept:
            sweep(spark, layout, {table: str(today - timedelta(days=days)) for table, days in keep_days.items()})
            swept.add(today)

    return handle


def enrich_handler(
    layout: Layout,
    as_of: AsOf = None,
    fact_load_time: AsOf = None,
    credits_per_run: float = 0.0,
    clock: Clock = _wall_clock,
) -> Callable[[DataFrame, int], None]:
    """What is done with marker rows of staged batches: each batch is read from its own folders, once, in the order of
    staging. A batch that was staged again has another marker; its rows have their facts by then."""
    attempts = Attempts(layout, "staged", clock, credits_per_run)

    def handle(markers: DataFrame, batch_id: int) -> None:
        spark = configure(markers.sparkSession)
        order = markers.groupBy("run", "batch_id").agg(F.min("staged_at").alias("staged_at")).orderBy("staged_at", "run", "batch_id")
        batches = order.collect()  # a row for each staged batch of the trigger

        def load() -> None:
            for b in batches:
                staged = layout.batch(spark, "staging", b.run, b.batch_id)
                enrich_batch(spark, layout, staged, as_of, fact_load_time, few_days=True)

        with attempts.of_batch(spark, batch_id) as (_, logged):
            logged(ENRICH_TASK, load)

    return handle


def follow_staged(
    spark: SparkSession,
    layout: Layout,
    trigger: dict | None = None,
    handle: Callable[[DataFrame, int], None] | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """The second task as a stream of its own, with its own progress: facts of batches that were staged.

    Use it with ``batch_handler(enrich=False)``; staging then never waits for facts, nor fails with them.
    """
    return (
        layout.staged_batch_stream(spark, max_files).writeStream
        .option("checkpointLocation", layout.checkpoint("staged"))
        .foreachBatch(handle or enrich_handler(layout))
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def follow_raw(
    spark: SparkSession,
    layout: Layout,
    trigger: dict | None = None,
    handle: Callable[[DataFrame, int], None] | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Process raw rows added since the last commit of this query.

    With ``availableNow`` a run without new files calls no batch. Run only one such query per
    layout: the fact load is safe against replays, not against a second writer.
    """
    return (
        layout.raw_stream(spark, max_files).drop("raw_json").writeStream
        .option("checkpointLocation", layout.checkpoint("changes"))
        .foreachBatch(handle or batch_handler(layout))
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
