"""Plan shapes that matter at scale."""

import re

from badgeflow.functions.clock import ago, since
from badgeflow.operators import facts, staging, users
from badgeflow.plans import monitoring as m
from badgeflow.plans import pipeline, validation as v
from badgeflow.sources.seeds import seed_users, seed_zones
from badgeflow.streaming import changes
from helpers import AS_OF, raw, raw_row, staged
from pyspark.sql import functions as F


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_copies_are_dropped_before_the_shuffle(spark):
    text = plan(staging.stage(raw(spark, raw_row()), AS_OF))
    # top of the plan first: final limit, exchange, partial limit
    assert re.search(r"WindowGroupLimit.*Final.*Exchange hashpartitioning.*WindowGroupLimit.*Partial", text, re.S)


def many(spark, n=2000):
    return raw(spark, raw_row()).select(*staging.EVENT_COLUMNS).drop("badge_id", "event_timestamp").join(
        spark.range(n).select(
            F.concat(F.lit("B"), F.col("id").cast("string")).alias("badge_id"),
            (F.lit("2024-01-10").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id"))).alias("event_timestamp"),
        )
    ).withColumn("staging_time", F.col("ingestion_time"))


def test_a_small_load_does_not_shuffle_the_fact(spark, layout):
    """As loaded: 2,000 held facts of the day against two staged rows, with a low broadcast limit."""
    pipeline.load_facts(spark, layout, many(spark), AS_OF)
    known = raw_row(badge="B5", when="2024-01-10T00:00:05")
    staged_row = pipeline.stage_batch(spark, layout, raw(spark, raw_row(), known), 0, AS_OF)
    limit = str(50 * 1024)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", limit)
    try:
        made = pipeline.missing_facts(spark, layout, staged_row, AS_OF)
        assert made.count() == 1
        made.collect()
        text = plan(made)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    text = text.split("Initial Plan")[0]
    lines = text.splitlines()
    scan = next(n for n, line in enumerate(lines) if "FileScan" in line and "[isnotnull(event_date#" in line)
    joins = [n for n, line in enumerate(lines[:scan]) if "BroadcastHashJoin [event_timestamp" in line and "LeftSemi" in line]
    assert joins, text
    assert not any("Exchange" in line for line in lines[joins[-1] : scan]), "\n".join(lines[joins[-1] : scan + 1])


def test_users_are_not_hinted_as_broadcast(spark):
    made = facts.enrich(staged(spark, raw_row()), seed_users(spark, AS_OF), seed_zones(spark, AS_OF))
    assert "strategy=broadcast" not in optimized(made)


def test_hot_user_is_split(spark, layout, tmp_path):
    """The engine's own enrichment of rows of which two thirds are one user's."""
    path = str(tmp_path / "hot")
    n = F.col("id")
    one = raw(spark, raw_row()).select(*staging.EVENT_COLUMNS).drop("badge_id", "event_timestamp", "user_id")
    spark.range(0, 60_000, 1, 8).select(
        F.when(n % 3 > 0, "USR-HOT").otherwise(F.concat(F.lit("U"), (n % 5000).cast("string"))).alias("user_id"),
        F.sha2(n.cast("string"), 256).alias("badge_id"),
        (F.lit("2024-01-10").cast("timestamp_ntz") + F.make_dt_interval(secs=n)).alias("event_timestamp"),
    ).join(one).withColumn("staging_time", F.col("ingestion_time")).write.parquet(path)
    events = spark.read.parquet(path)
    pipeline.merge_batch_users(spark, layout, events, AS_OF)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        made = facts.enrich(events, layout.users(spark), layout.zones(spark), None, AS_OF)
        assert len(made.collect()) == 60_000
        assert "skew=true" in plan(made)
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def load(spark, layout, days=12):
    rows = [raw_row(badge=f"B{d}", when=f"2024-01-{d + 1:02d}T10:00:00") for d in range(days)]
    layout.append_raw(raw(spark, *rows))
    pipeline.process_batch(spark, layout, layout.raw(spark), 0, AS_OF, F.col("ingestion_time"), AS_OF)


def scanned_partitions(df) -> int:
    df.collect()
    scans, stack = [], [df._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            stack.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            stack.append(node.plan())
        if name == "FileSourceScanExec":
            scans.append(node.metrics().apply("numPartitions").value())
        children = node.children()
        stack.extend(children.apply(i) for i in range(children.size()))
    return min(scans)


def test_day_partitions_are_pruned(spark, layout):
    load(spark, layout)
    fact = layout.fact(spark)
    assert scanned_partitions(fact.where("event_date BETWEEN DATE'2024-01-03' AND DATE'2024-01-05'")) == 3
    recent = since(layout.raw(spark), "ingestion_time", ago("2024-01-12 12:00:00", 24))
    assert recent.count() == 1 and scanned_partitions(recent) == 2
    latest = fact.select("event_date").distinct().orderBy(F.desc("event_date")).limit(10)
    first = latest.agg(F.min("event_date")).scalar()
    assert scanned_partitions(fact.where(F.col("event_date") >= first)) == 10
    assert v.events_by_date(fact).count() == 10


def test_load_reads_only_the_dates_of_the_batch(spark, layout):
    load(spark, layout)
    staged_rows = pipeline.stage_batch(
        spark, layout, raw(spark, raw_row(when="2024-01-02T11:00:00"), raw_row(when="2024-01-04T10:00:00")), 7, AS_OF)
    made = pipeline.missing_facts(spark, layout, staged_rows, AS_OF)
    assert made.count() == 2
    text = optimized(made)
    assert re.search(r"event_date#\d+ >= 2024-01-02", text) and re.search(r"event_date#\d+ <= 2024-01-04", text)


def test_latency_prunes_all_three_layers(spark, layout):
    load(spark, layout)
    day = "2024-01-12 10:30:00"
    text = plan(m.layer_latency(layout.raw(spark), layout.staging(spark), layout.fact(spark), day))
    assert len(re.findall(r"PartitionFilters: \[[^\]]*(?:ingestion_date|load_date)[^\]]*>=", text)) == 3


def test_columns_are_pruned(spark, layout):
    load(spark, layout, days=2)
    text = plan(v.top_zones(layout.fact(spark), seed_zones(spark, AS_OF)))
    assert "ReadSchema: struct<zone_key:bigint>" in text


def test_names_are_joined_to_counts(spark, layout):
    load(spark, layout, days=2)
    text = optimized(v.top_badges(layout.fact(spark), layout.users(spark)))
    assert re.search(r"Join Inner.*\n.*(Aggregate|Project).*\n?.*Aggregate|Join Inner(.|\n)*Aggregate \[badge_id", text)


def test_stream_batches_run_adaptively(spark, layout):
    seen = []
    layout.append_raw(raw(spark, raw_row()))

    def handle(batch, batch_id):
        changes.batch_handler(layout, AS_OF, AS_OF, AS_OF)(batch, batch_id)
        seen.append(plan(staging.stage(batch, AS_OF)))

    changes.follow_raw(spark, layout, handle=handle).awaitTermination()
    assert "AdaptiveSparkPlan" in seen[0]
    assert "raw_json" not in seen[0]


def test_new_users_are_numbered_in_buckets(spark):
    text = plan(users.new_users(staged(spark, raw_row(user="X")), seed_users(spark, AS_OF), AS_OF))
    numbering = re.search(r"row_number\(\) windowspecdefinition\(([^)]*)\)", text).group(1)
    assert numbering.startswith("_bucket")
