"""Queries of the pipeline on the given tables, and the same results as DuckDB SQL.

Badge messages and logs are derived from the whole ``events`` table (FIXTURES.md). Queries over
raw, staging, users and facts read tables that the pipeline itself has loaded into the shared
folder, once per application and input, as they would in operation.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import cached_property

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, DecimalType, DoubleType

import oracle
from badgeflow import schemas
from badgeflow.operators import facts, feed, rollups, staging, users
from badgeflow.plans import monitoring as m
from badgeflow.plans import quality, validation as v
from badgeflow.plans.pipeline import catch_up, change_users, load_facts, process_batch, sweep
from badgeflow.session import configure, work_dir
from badgeflow.sources import files, fixture, messages, sample, seeds
from badgeflow.sources.tables import Layout, with_file
from badgeflow.streaming import changes, ingest, live

try:
    import corpus_pipeline
    from badgeflow.llm import queries as llm
except ImportError:  # the subpackage, its pipeline, or a package that only they need can be missing
    corpus_pipeline = llm = None

ENTRY_DIR = "/root/testdata/sf0.001"
AS_OF = fixture.AS_OF
#: From when on the users are valid whose changes are applied.
USERS_SINCE = "2024-01-10 00:00:00"
#: Up to which day the swept layout is swept.
SWEPT_BEFORE = "2024-01-20"
#: A day whose files are merged there.
CLOSED_DAY = "2024-01-15"
DATABASE = fixture.DATABASE
TASK_PATTERN = "badge_%"
BADGE = "BADGE-000008"
SLICE = ("2024-01-10", "2024-01-16")
FOLDERS = ("load_date", "run", "batch_id")
#: Arrival times that part the rows of the streams into three files.
PARTS = ("2024-01-11", "2024-01-21")
#: Fields that are read from variant messages.
VARIANT_FIELDS = {
    "event_id": ("$.event_id", "bigint"), "exact_signal": ("$.signal_strength", "double"),
    "firmware": ("$.reader.firmware", "string"), "second_hop": ("$.reader.hops[1]", "int"),
    "zone_as_number": ("$.zone_id", "int"), "serial": ("$.reader.serial", "string"),
}
#: Start of the clock of the followed runs, and their stated costs.
RUNS_BEGIN = datetime(2024, 1, 30, 23, 30)
CREDITS_PER_ROW = 1e-6
CREDITS_PER_RUN = 0.25


def _staging_time() -> Column:
    return F.col("ingestion_time") + F.expr("INTERVAL '60' SECOND")


def _load_time() -> Column:
    seconds = F.second("event_timestamp").cast("bigint")
    return F.col("staging_time") + F.make_dt_interval(secs=seconds)


@dataclass(frozen=True)
class Inputs:
    spark: SparkSession
    sf_dir: str

    @property
    def events(self) -> DataFrame:
        return fixture.read_events(self.spark, self.sf_dir)

    @property
    def decoded(self) -> DataFrame:
        return fixture.decoded_messages(self.events)

    @property
    def seed_users(self) -> DataFrame:
        return seeds.seed_users(self.spark, AS_OF)

    @property
    def zones(self) -> DataFrame:
        return seeds.seed_zones(self.spark, AS_OF)

    @property
    def ingest_log(self) -> DataFrame:
        return fixture.ingest_log(self.raw)

    @property
    def scan_log(self) -> DataFrame:
        return fixture.scan_log(self.events)

    @property
    def run_log(self) -> DataFrame:
        return fixture.run_log(self.events)

    # --- loaded tables -----------------------------------------------------------------
    @cached_property
    def loaded(self) -> Layout:
        layout = Layout(work_dir(self.spark, "tables")).create(self.spark, AS_OF)
        layout.append_raw(messages.shape_events(self.decoded))
        process_batch(self.spark, layout, with_file(layout.raw(self.spark)), 0, AS_OF, _staging_time(), _load_time())
        return layout

    @property
    def raw(self) -> DataFrame:
        return self.loaded.raw(self.spark).drop(*FOLDERS)

    @property
    def staging(self) -> DataFrame:
        return self.loaded.staging(self.spark).drop(*FOLDERS)

    @property
    def users(self) -> DataFrame:
        return self.loaded.users(self.spark)

    @property
    def fact(self) -> DataFrame:
        return self.loaded.fact(self.spark)

    def _deliver(self, layout: Layout, delivery: int) -> None:
        layout.append_raw(messages.shape_events(self.decoded.where(F.col("redelivery") == delivery)))

    @cached_property
    def followed(self) -> Layout:
        """The same rows as a stream in two deliveries: first ones, then redeliveries.

        The clock stands still but for a minute a reading. The first attempt at the second
        delivery fails in its second task, and is tried again.
        """
        layout = Layout(work_dir(self.spark, "stream")).create(self.spark, AS_OF)
        minutes = itertools.count()
        options = {
            "credits_per_row": CREDITS_PER_ROW, "credits_per_run": CREDITS_PER_RUN,
            "clock": lambda: RUNS_BEGIN + timedelta(minutes=next(minutes)),
        }
        handle = changes.batch_handler(layout, AS_OF, _staging_time(), _load_time(), **options)
        failing = changes.batch_handler(layout, AS_OF, _staging_time(), F.col("no_such_column"), **options)
        for delivery, attempts in enumerate(([handle], [failing, handle])):
            self._deliver(layout, delivery)
            for attempt in attempts:
                query = changes.follow_raw(self.spark, layout, handle=attempt)
                try:
                    query.awaitTermination()
                except StreamingQueryException:
                    if attempt is handle:
                        raise
        return layout

    @cached_property
    def half_followed(self) -> Layout:
        """The first delivery is followed, the second has only arrived."""
        layout = Layout(work_dir(self.spark, "half")).create(self.spark, AS_OF)
        self._deliver(layout, 0)
        handle = changes.batch_handler(layout, AS_OF, _staging_time(), _load_time())
        changes.follow_raw(self.spark, layout, handle=handle).awaitTermination()
        self._deliver(layout, 1)
        return layout

    @property
    def unstaged(self) -> DataFrame:
        layout = self.half_followed
        return layout.unstaged(self.spark, with_file(layout.raw(self.spark)))

    @cached_property
    def backfilled(self) -> Layout:
        """Redeliveries loaded by hand as batch 0, then the first ones followed from batch 0 on.

        In between, users change their department, and the checkpoint is lost once.
        """
        layout = Layout(work_dir(self.spark, "backfill")).create(self.spark, AS_OF)
        again = messages.shape_events(self.decoded.where(F.col("redelivery") == 1))
        process_batch(self.spark, layout, again, 0, AS_OF, _staging_time(), _load_time())
        handle = changes.batch_handler(layout, AS_OF, _staging_time(), _load_time())
        self._deliver(layout, 0)
        changes.follow_raw(self.spark, layout, handle=handle).awaitTermination()
        files.remove(self.spark, layout.checkpoint("changes"))
        changes.follow_raw(self.spark, layout, handle=handle).awaitTermination()
        return layout

    @cached_property
    def changed(self) -> Layout:
        """Loaded users with two loads of Type-2 changes; every third message comes with the second one, out of order."""
        layout = Layout(work_dir(self.spark, "changed")).create(self.spark, USERS_SINCE)
        process_batch(self.spark, layout, self.loaded.raw(self.spark), 0, USERS_SINCE, _staging_time(), _load_time())
        for late in (False, True):
            changes = _department_changes(self).where((F.col("event_id") % 3 == 0) == late)
            change_users(self.spark, layout, changes, ["department"], AS_OF)
        layout.close_day(self.spark, "staging", CLOSED_DAY)
        return layout

    @cached_property
    def chained(self) -> Layout:
        """Both deliveries staged by one stream; facts by a second one, whose first attempt fails."""
        layout = Layout(work_dir(self.spark, "chained")).create(self.spark, AS_OF)
        stage = changes.batch_handler(layout, AS_OF, _staging_time(), enrich=False)
        for delivery in range(2):
            self._deliver(layout, delivery)
            changes.follow_raw(self.spark, layout, handle=stage).awaitTermination()
        for load_time in (F.col("no_such_column"), _load_time()):
            try:
                changes.follow_staged(self.spark, layout, handle=changes.enrich_handler(layout, AS_OF, load_time)).awaitTermination()
            except StreamingQueryException:
                if layout.fact(self.spark).take(1):
                    raise
        return layout

    @cached_property
    def swept(self) -> Layout:
        """Followed, and swept up to a day at which staged rows of an unknown zone still wait for it."""
        layout = Layout(work_dir(self.spark, "swept")).create(self.spark, AS_OF)
        layout.append_raw(messages.shape_events(self.decoded))
        handle = changes.batch_handler(layout, AS_OF, _staging_time(), _load_time())
        changes.follow_raw(self.spark, layout, handle=handle).awaitTermination()
        known = seeds.seed_zones(self.spark, AS_OF).limit(1).withColumns({
            "zone_key": F.lit(6).cast("bigint"), "zone_id": F.lit("ZONE-UNMAPPED"),
        })
        sweep(self.spark, layout, {"raw": SWEPT_BEFORE, "staging": SWEPT_BEFORE})  # unmapped rows hold back the staging
        known.write.mode("append").parquet(layout.path("dim_zones"))
        catch_up(self.spark, layout, _load_time())
        sweep(self.spark, layout, {"staging": SWEPT_BEFORE})
        return layout

    @cached_property
    def variants(self) -> Layout:
        """Raw messages as variants. Every third one has a nested object that no column was declared for."""
        n = F.col("event_id")
        reader = F.concat(
            F.lit(',"reader":{"firmware":"v'), n % 4, F.lit('","hops":['), n % 5, F.lit(","), n % 7, F.lit("]}}")
        )
        text = F.col("raw_json")
        grown = F.when(n % 3 == 0, F.concat(F.substring(text, F.lit(1), F.length(text) - 1), reader)).otherwise(text)
        layout = Layout(work_dir(self.spark, "variants"), variant=True).create(self.spark, AS_OF)
        layout.append_raw(messages.shape_events(self.decoded.withColumn("raw_json", grown)))
        return layout

    # --- streams -----------------------------------------------------------------------
    @cached_property
    def ingested(self) -> Layout:
        """The messages as text files, every fiftieth line holding two of them, ingested as a stream."""
        layout = Layout(work_dir(self.spark, "ingest")).create(self.spark, AS_OF)
        lines = layout.path("messages")
        fixture.message_lines(self.events).write.text(lines)
        ingest.ingest(self.spark, lines, layout, fixture.delivered_at()).awaitTermination()
        return layout

    def _arriving(self, name: str, part_of: Column, run: Callable[[Layout], StreamingQuery]) -> Layout:
        """Raw rows in three parts, each followed by an available-now run of the same stream."""
        layout = Layout(work_dir(self.spark, name)).create(self.spark, AS_OF)
        for part in range(3):
            rows = messages.shape_events(self.decoded.where(part_of == part)).select(*messages.RAW_COLUMNS)
            rows.write.mode("append").parquet(layout.path("arriving"))
            run(layout).awaitTermination()
        return layout

    @cached_property
    def rolled(self) -> Layout:
        """Parts by arrival, but that every tenth event comes a part later: days after its hour was counted."""
        arrival = sum((F.col("ingestion_time") >= F.lit(p).cast("timestamp_ntz")).cast("int") for p in PARTS)
        part = F.least(F.lit(len(PARTS)), arrival + (F.col("event_id") % 10 == 3).cast("int"))
        return self._arriving(
            "rolled", part, lambda layout: live.hourly_rollups(self.spark, self.raw_stream(layout.path("arriving")), layout)
        )

    @property
    def hourly(self) -> tuple[DataFrame, DataFrame]:
        return self.rolled.table(self.spark, "hourly_parts"), self.rolled.table(self.spark, "hourly_bits")

    @cached_property
    def first_arrived(self) -> Layout:
        """The older of two copies may come in a later part."""
        part = F.expr("(event_id div 20 + 2 * redelivery) % 3")
        return self._arriving(
            "first", part, lambda layout: live.first_arrivals(self.spark, self.raw_stream(layout.path("arriving")), layout)
        )

    def raw_stream(self, folders: str) -> DataFrame:
        return self.spark.readStream.schema(schemas.RAW).parquet(folders)


_INPUTS: dict[tuple[str, str], Inputs] = {}


def _inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    configure(spark)
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _INPUTS:
        _INPUTS[key] = Inputs(spark, sf_dir)
    return _INPUTS[key]


def _portable(df: DataFrame) -> DataFrame:
    """Short decimals as doubles, long ones and dates as text, which every client compares alike.

    Sums of credits depend on the order of addition in their last digits and are rounded.
    """

    def column(field):
        if "credits" in field.name and isinstance(field.dataType, DoubleType):
            return F.round(field.name, 9).alias(field.name)
        if isinstance(field.dataType, DecimalType):
            if field.dataType.precision > 15:
                return F.col(field.name).cast("string").alias(field.name)
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, DateType):
            return F.col(field.name).cast("string").alias(field.name)
        return F.col(field.name)

    return df.select(*[column(f) for f in df.schema.fields])


# --- queries that need more than one call ----------------------------------------------


def _ingest_stream(i: Inputs) -> DataFrame:
    return i.ingested.raw(i.spark).select(*messages.RAW_COLUMNS)


def _ingest_rejects_stream(i: Inputs) -> DataFrame:
    rejects = i.ingested.table(i.spark, "rejects").drop("ingestion_date", "run", "batch_id")
    return rejects.withColumn("broken_rules", F.array_join("broken_rules", "; "))


def _signal_quality(i: Inputs) -> DataFrame:
    return i.raw.groupBy("signal_strength", "signal_quality").agg(F.count("*").alias("row_count"))


def _fact_date_slice(i: Inputs) -> DataFrame:
    first, last = (F.lit(day).cast("date") for day in SLICE)
    return i.fact.where(F.col("event_date").between(first, last)).drop("load_date")


def _sample_events(i: Inputs) -> DataFrame:
    count = i.events.agg(F.count("*").alias("n")).scalar()
    return sample.sample_events(i.events.select(F.col("event_id").alias("index")), count, AS_OF)


def _events_to_json(i: Inputs) -> DataFrame:
    fields = [*messages.schemas.MESSAGE.fieldNames()]
    signal = F.col("signal_strength").cast("double").alias("signal_strength")
    return sample.to_ndjson(i.decoded.select(*[signal if f == "signal_strength" else f for f in fields]))


def _fact_load_incremental(i: Inputs) -> DataFrame:
    return i.followed.fact(i.spark).drop("load_date")


def _fact_user_ids(i: Inputs) -> DataFrame:
    """Which user each fact of a layout with several runs names."""
    users = i.backfilled.users(i.spark).select("user_key", "user_id")
    return i.backfilled.fact(i.spark).join(users, "user_key").select("badge_id", "event_timestamp", "user_id", "user_key")


def _swept_layers(i: Inputs) -> DataFrame:
    """Rows by day that are left of raw and staging, and the facts, which lack none of the swept rows."""
    def counted(layer: str, rows: DataFrame, day: str) -> DataFrame:
        return rows.groupBy(F.lit(layer).alias("layer"), F.col(day).alias("day")).agg(F.count("*").alias("row_count"))

    layout = i.swept
    return (
        counted("RAW", layout.raw(i.spark), "ingestion_date").unionByName(counted("STAGING", layout.staging(i.spark), "load_date"))
        .unionByName(counted("FACT", layout.fact(i.spark), "event_date"))
    )


def _raw_variant_paths(i: Inputs) -> DataFrame:
    """Fields of the messages that raw has no columns for, a nested one and one that no message has among them."""
    return messages.message_fields(i.variants.raw(i.spark), VARIANT_FIELDS).select(
        "badge_id", "event_timestamp", *VARIANT_FIELDS
    )


def _rejects(i: Inputs) -> DataFrame:
    decoded = messages.decode_messages(fixture.messages(i.events), F.col("timestamp"))
    return messages.rejected_events(decoded).withColumn(
        "broken_rules", F.array_join("broken_rules", "; ")
    )


def _department_changes(i: Inputs) -> DataFrame:
    department = F.when(F.col("direction").isNull(), "UNKNOWN").otherwise(F.upper("direction"))
    return i.decoded.select("event_id", "user_id", F.col("ingestion_time").alias("changed_at"), department.alias("department"))


def _scd2(i: Inputs) -> DataFrame:
    return i.changed.users(i.spark)


def _cdc_actions(i: Inputs) -> DataFrame:
    """What two loads changed in the users; and in staging, of which a day was merged: nothing."""
    of_users = i.changed.user_changes(i.spark, 0).select(
        F.lit("DIM_USERS").alias("table_name"), F.col("user_key").cast("string").alias("row_key"), "department",
        "effective_start_date", "effective_end_date", "change_action", "is_update",
    )
    merged = i.changed.staging(i.spark).drop(*FOLDERS)
    of_staging = feed.table_changes(i.staging, merged, staging.EVENT_KEY).select(
        F.lit("STG_BADGE_EVENTS").alias("table_name"), F.col("badge_id").alias("row_key"), F.col("user_id").alias("department"),
        F.col("event_timestamp").alias("effective_start_date"), F.col("staging_time").alias("effective_end_date"), "change_action", "is_update",
    )
    return of_users.unionByName(of_staging)


def _facts_after_change(i: Inputs) -> DataFrame:
    """A day later the same events come again under other badges: facts take the new keys."""
    layout = i.changed
    later = F.expr("INTERVAL '1' DAY")
    again = i.staging.withColumns({
        "badge_id": F.concat("badge_id", F.lit("-NEW")), "event_timestamp": F.col("event_timestamp") + later,
    })
    if not layout.fact(i.spark).where(F.endswith("badge_id", F.lit("-NEW"))).take(1):
        load_facts(i.spark, layout, again, AS_OF)
    return layout.fact(i.spark).groupBy("user_key").agg(F.count("*").alias("fact_rows"))


def _dim_unique(i: Inputs) -> DataFrame:
    """Dimensions as they would be without keys: a row for each way an id was seen with another column."""
    seen = i.raw.select("user_id", "reader_id", "zone_id", "direction").distinct()
    users_seen = seen.select("user_id", "direction").distinct().withColumn("is_current", F.coalesce(F.col("direction") != "EXIT", F.lit(True)))
    zones_seen = seen.select("zone_id", "reader_id", "direction").distinct()
    return quality.dimension_duplicates(users_seen, zones_seen, seen.select("reader_id", "direction").distinct())


def _fact_fk(i: Inputs) -> DataFrame:
    """Facts whose keys are moved beyond some of the dimension's keys."""
    moved = i.fact.withColumns({"user_key": F.col("user_key") * 2, "zone_key": F.col("zone_key") + 2})
    return quality.orphan_keys(moved, i.users, i.zones)


def _broken_messages(i: Inputs) -> DataFrame:
    return quality.broken_rule_counts(fixture.broken_messages(i.decoded))


def _nulls(i: Inputs) -> DataFrame:
    """Facts in which each checked column is missing now and then."""
    def missing(column: str, n: int):
        return F.when(F.col("event_hour") % n != 0, F.col(column))

    return v.null_check(i.fact.withColumns({
        "badge_id": missing("badge_id", 5), "user_key": missing("user_key", 7),
        "zone_key": missing("zone_key", 11), "event_timestamp": missing("event_timestamp", 13),
    }))


def _metrics_stream(i: Inputs) -> DataFrame:
    """Hours as three runs of the stream have left them, late rows included."""
    return rollups.hourly_stats(*i.hourly).select(
        F.col("ingestion_hour").alias("window_start"), (F.col("ingestion_hour") + F.expr("INTERVAL '1' HOUR")).alias("window_end"),
        "event_count", "unique_badges", "unique_zones", F.round("avg_signal_strength", 2).alias("avg_signal_strength"),
        "weak_signal_count", "entry_count", "exit_count", (F.col("entry_count") - F.col("exit_count")).alias("net_occupancy_change"),
    )


def _dedup_stream(i: Inputs) -> DataFrame:
    return i.first_arrived.table(i.spark, "first_events").drop("event_date", "run", "batch_id")


_QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {
    # sources and sinks
    "ingest_stream": _ingest_stream,
    "ingest_stream_rejects": _ingest_rejects_stream,
    "sample_events": _sample_events,
    "events_to_json": _events_to_json,
    "fact_date_slice": _fact_date_slice,
    "swept_layers": _swept_layers,
    "staging_retention": lambda i: staging.retained(i.loaded.staging(i.spark), AS_OF).drop(*FOLDERS),
    # parsing
    "ingest_parse": lambda i: messages.parse_messages(fixture.messages(i.events), F.col("timestamp")),
    "ingest_rejects": _rejects,
    "signal_quality": _signal_quality,
    "raw_variant_paths": _raw_variant_paths,
    # staging, dimensions, facts
    "stage_dedup": lambda i: staging.stage(i.raw, _staging_time()),
    "latest_rows_for_badge": lambda i: staging.latest_rows(i.raw, BADGE).select(*messages.RAW_COLUMNS),
    "dim_users_merge": lambda i: users.merge_users(i.staging, i.seed_users, AS_OF),
    "scd2_apply": _scd2,
    "fact_time_parts": lambda i: facts.with_time_parts(i.staging).select(
        *staging.EVENT_KEY, "event_date", "event_hour", "event_day_of_week", "is_after_hours", "is_weekend"
    ),
    "fact_load": lambda i: facts.enrich(i.staging, i.users, i.zones, None, _load_time()),
    "fact_user_ids": _fact_user_ids,
    "facts_after_change": _facts_after_change,
    "cdc_actions": _cdc_actions,
    "unmapped_zones": lambda i: facts.unmapped_zones(i.staging, i.zones),
    # monitoring
    "ingestion_metrics": lambda i: m.ingestion_metrics(i.raw, AS_OF),
    "layer_latency": lambda i: m.layer_latency(i.raw, i.staging, i.fact, AS_OF),
    "data_freshness": lambda i: m.data_freshness(i.raw, i.fact, AS_OF),
    "channel_status": lambda i: m.channel_status(i.ingest_log, AS_OF),
    "daily_ingest_cost": lambda i: m.daily_ingest_cost(i.ingest_log, AS_OF),
    "cost_total": lambda i: m.cost_total(i.ingest_log, AS_OF),
    "partition_efficiency": lambda i: m.partition_efficiency(i.scan_log, AS_OF),
    "run_history": lambda i: m.run_history(i.run_log, DATABASE, AS_OF),
    "run_summary": lambda i: m.run_summary(i.run_log, DATABASE, AS_OF),
    # the same, over the logs that the pipeline wrote
    "channel_status_logged": lambda i: m.channel_status(i.followed.ingest_log(i.spark), AS_OF),
    "daily_ingest_cost_logged": lambda i: m.daily_ingest_cost(i.followed.ingest_log(i.spark), AS_OF),
    "cost_total_logged": lambda i: m.cost_total(i.followed.ingest_log(i.spark), AS_OF),
    "run_history_logged": lambda i: m.run_history(i.followed.run_log(i.spark), DATABASE, AS_OF).withColumn(
        "error_message", F.col("error_message").isNotNull()
    ),
    "run_summary_logged": lambda i: m.run_summary(i.followed.run_log(i.spark), DATABASE, AS_OF),
    "recent_runs_logged": lambda i: v.recent_runs(i.followed.run_log(i.spark), DATABASE, AS_OF),
    "run_errors_logged": lambda i: v.run_errors(i.followed.run_log(i.spark), DATABASE, AS_OF).withColumn(
        "error_message", F.col("error_message").isNotNull()
    ),
    "task_credits_logged": lambda i: v.task_credits(i.followed.run_log(i.spark), TASK_PATTERN, AS_OF),
    # validation
    "layer_row_counts": lambda i: v.layer_row_counts(i.raw, i.staging, i.fact),
    "layer_row_summary": lambda i: v.layer_row_summary(i.raw, i.staging, i.fact),
    "pending_status": lambda i: v.pending_status(i.unstaged),
    "pending_count": lambda i: v.pending_count(i.unstaged),
    "recent_runs": lambda i: v.recent_runs(i.run_log, DATABASE, AS_OF),
    "run_errors": lambda i: v.run_errors(i.run_log, DATABASE, AS_OF),
    "task_credits": lambda i: v.task_credits(i.run_log, TASK_PATTERN, AS_OF),
    "raw_stats": lambda i: v.raw_stats(i.raw),
    "staging_stats": lambda i: v.staging_stats(i.staging),
    "user_dim_stats": lambda i: v.user_dim_stats(i.users),
    "auto_users_sample": lambda i: v.auto_users_sample(i.users),
    "fact_stats": lambda i: v.fact_stats(i.fact),
    "events_by_date": lambda i: v.events_by_date(i.fact),
    "direction_distribution": lambda i: v.direction_distribution(i.fact),
    "signal_distribution": lambda i: v.signal_distribution(i.fact),
    "flagged_access": lambda i: v.flagged_access(i.fact),
    "top_zones": lambda i: v.top_zones(i.fact, i.zones),
    "top_badges": lambda i: v.top_badges(i.fact, i.users),
    "null_check": lambda i: v.null_check(i.fact),
    "null_check_broken": _nulls,
    "ingestion_latency": lambda i: v.ingestion_latency(i.fact),
    "pipeline_health": lambda i: v.pipeline_health(
        i.unstaged, i.half_followed.staging(i.spark), i.half_followed.fact(i.spark), i.run_log, AS_OF
    ),
    # declared constraints
    "dq_staging_pk": lambda i: quality.staging_duplicates(i.followed.staging(i.spark)),
    "dq_dim_unique": _dim_unique,
    "dq_fact_fk": _fact_fk,
    "dq_required": lambda i: quality.broken_rule_counts(i.decoded),
    "dq_required_broken": _broken_messages,
    # streams
    "cdc_incremental": lambda i: i.followed.staging(i.spark).drop("load_date", "run"),
    "fact_load_incremental": _fact_load_incremental,
    "fact_load_chained": lambda i: i.chained.fact(i.spark).drop("load_date"),
    "ingestion_metrics_stream": _metrics_stream,
    "ingestion_metrics_rolled": lambda i: m.rolled_ingestion_metrics(*i.hourly, i.raw, AS_OF),
    "raw_stats_rolled": lambda i: v.rolled_raw_stats(*i.hourly),
    "stream_dedup_first": _dedup_stream,
}


def _registered(build: Callable[[Inputs], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _portable(build(_inputs(spark, sf_dir)))


def entry(spark: SparkSession) -> DataFrame:
    return queries()["top_zones"](spark, ENTRY_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {name: _registered(build) for name, build in _QUERIES.items()}
    return own | llm.QUERIES | {"pipeline": corpus_pipeline.run} if llm else own


def oracle_sql() -> dict[str, str]:
    if not llm:
        return oracle.statements()
    whole = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return oracle.statements() | llm.ORACLE_SQL | whole
