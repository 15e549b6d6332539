import random
import statistics
from decimal import Decimal

import pytest
from badgeflow import schemas
from badgeflow.operators import facts
from badgeflow.plans import monitoring as m
from badgeflow.plans import validation as v
from badgeflow.sources.seeds import seed_users, seed_zones
from helpers import AS_OF, at, raw, raw_row, rows, staged
from pyspark.sql import functions as F


@pytest.mark.parametrize("age,status", [
    (0, "HEALTHY"), (120, "HEALTHY"), (121, "WARNING"), (300, "WARNING"), (301, "STALE"), (None, "HEALTHY"),
])
def test_health_edges(spark, age, status):
    df = spark.createDataFrame([(age,)], "age bigint")
    assert df.select(m.health(F.col("age"))).first()[0] == status
    if age is None:
        assert df.select(m.health(F.col("age"), "NO DATA")).first()[0] == "NO DATA"


def test_ingestion_metrics(spark):
    lines = [
        raw_row(arrived="2024-01-30T23:10:00", signal=-90, quality="WEAK"),
        raw_row(badge="B2", arrived="2024-01-30T23:20:00", signal=-999, direction="EXIT", zone="Z2"),
        raw_row(badge="B2", arrived="2024-01-30T23:59:59", signal=-51, direction=None),
        raw_row(arrived="2024-01-30T00:00:00"), raw_row(arrived="2024-01-29T23:59:59"),
    ]
    found = rows(m.ingestion_metrics(raw(spark, *lines), AS_OF))
    assert found[0] == (at("2024-01-30T23:00:00"), 3, 3 / 3600, 2, 2, -380.0, 1, 33.33, 1, 1, 0)
    assert [r[0].hour for r in found] == [23, 0]
    without = rows(m.ingestion_metrics(raw(spark, *lines), AS_OF, ignore_sentinel=True))
    assert without[0][5] == -70.5


def test_layer_latency_and_freshness_of_empty_tables(spark):
    empty_fact = spark.createDataFrame([], schemas.FACT)
    layers = rows(m.layer_latency(raw(spark, raw_row(arrived="2024-01-30T23:55:00")), staged(spark), empty_fact, AS_OF))
    assert layers == [
        ("RAW", at("2024-01-30T23:55:00"), 300, 1, "WARNING"),
        ("STAGING", None, None, 0, "HEALTHY"), ("ANALYTICS", None, None, 0, "HEALTHY")]
    fresh = rows(m.data_freshness(raw(spark), empty_fact, AS_OF))
    assert fresh[1] == ("FCT_ACCESS_EVENTS", None, None, None, None, 0, None)


def test_scan_classes(spark):
    log = spark.createDataFrame([
        ("RAW_BADGE_EVENTS", at("2024-01-30T12:00:00"), 2, 20, 80, 3 * 1024**3, 1024**3),
        ("FCT_ACCESS_EVENTS", at("2024-01-30T12:00:00"), 1, 0, 0, 0, 0),
        ("OTHER", at("2024-01-30T12:00:00"), 1, 1, 1, 1, 1),
        ("RAW_BADGE_EVENTS", at("2024-01-29T12:00:00"), 9, 9, 9, 9, 9),
    ], schemas.SCAN_LOG)
    assert sorted(rows(m.partition_efficiency(log, AS_OF))) == [
        ("FCT_ACCESS_EVENTS", 1, None, 0.0, None, "POOR"), ("RAW_BADGE_EVENTS", 2, 20.0, 3.0, 25.0, "GOOD")]


def run_log(spark, *lines):
    return spark.createDataFrame([
        (name, state, None, None, database, at(start), at(end) if end else None, credits)
        for name, state, database, start, end, credits in lines
    ], schemas.RUN_LOG)


def test_runs(spark):
    log = run_log(
        spark,
        ("t_one", "SUCCEEDED", "DB", "2024-01-30T23:50:00", "2024-01-30T23:50:05", 0.5),
        ("t_one", "FAILED", "DB", "2024-01-30T23:40:00", "2024-01-30T23:40:01", 0.25),
        ("t_two", "EXECUTING", "DB", "2024-01-30T23:30:00", None, 0.0),
        ("x_two", "SKIPPED", "OTHER", "2024-01-30T23:45:00", "2024-01-30T23:45:00", 9.0),
        ("t_one", "SUCCEEDED", "DB", "2024-01-30T01:00:00", "2024-01-30T01:00:15", 9.0),
    )
    history = rows(m.run_history(log, "DB", AS_OF).select("task_name", "duration_seconds", "execution_status"))
    assert history == [("t_one", 5, "SUCCESS"), ("t_one", 1, "FAILED"), ("t_two", None, "UNKNOWN"), ("t_one", 15, "SUCCESS")]
    assert m.run_history(log, "DB", AS_OF, limit=2).count() == 1  # the other database takes a place
    assert rows(m.run_summary(log, "DB", AS_OF)) == [("t_one", 2, 10.0)]
    assert v.recent_runs(log, "DB", AS_OF).count() == 3
    assert rows(v.task_credits(log, "t_%", AS_OF)) == [("t_one", 0.75, 2, 0.375), ("t_two", 0.0, 1, 0.0)]


def test_costs(spark):
    log = spark.createDataFrame([
        ("RAW_BADGE_EVENTS", at("2024-01-30T23:30:00"), 10, 1024**3, 1.0),
        ("RAW_BADGE_EVENTS", at("2024-01-30T23:30:40"), 30, 1024**3, 2.0),
        ("RAW_BADGE_EVENTS", at("2024-01-05T00:00:00"), 5, 0, 0.5),
        ("OTHER", at("2024-01-30T23:30:00"), 1, 1, 1.0),
    ], schemas.INGEST_LOG)
    assert rows(m.channel_status(log, AS_OF)) == [
        ("RAW_BADGE_EVENTS", at("2024-01-30T23:30:40"), 1760, 40, 2.0, 1, 20.0, 30, 3.0)]
    daily = [(str(r[0]), *r[1:]) for r in rows(m.daily_ingest_cost(log, AS_OF))]
    assert daily == [("2024-01-30", 2.0, 40, 3.0, 20.0), ("2024-01-05", 0.0, 5, 0.5, None)]
    assert rows(m.cost_total(log, AS_OF)) == [(3.5,)]


@pytest.fixture(scope="module")
def fact(spark):
    lines = staged(
        spark,
        raw_row(badge="B1", when="2024-01-06T05:00:00", direction=None, signal=-999),
        raw_row(badge="B1", when="2024-01-08T12:00:00", zone="ZONE-SERVER-B1", direction="EXIT"),
        raw_row(badge="B2", when="2024-01-08T23:00:00", user="USR-002", signal=-90, quality="WEAK"),
        raw_row(badge="B2", when="2024-01-09T13:00:00", user="USR-002"),
    )
    return facts.enrich(lines, seed_users(spark, AS_OF), seed_zones(spark, AS_OF), None, "2024-01-09 13:00:30")


def test_fact_reports(spark, fact):
    assert rows(v.flagged_access(fact)) == [
        ("After-Hours Events", 2, 50.0), ("Weekend Events", 1, 25.0), ("Restricted Access Events", 1, 25.0)]
    assert rows(v.direction_distribution(fact)) == [("ENTRY", 2, 50.0), (None, 1, 25.0), ("EXIT", 1, 25.0)]
    assert rows(v.signal_distribution(fact))[0] == ("STRONG", 3, -366.33, Decimal("-999.00"), Decimal("-50.00"))
    assert [(str(r[0]), *r[1:]) for r in rows(v.events_by_date(fact, dates=2))] == [
        ("2024-01-09", 1, 1, 1), ("2024-01-08", 2, 2, 2)]
    assert rows(v.top_zones(fact, seed_zones(spark, AS_OF), rows=1)) == [("Main Lobby", "LOBBY", "Main Building", 3)]
    assert rows(v.top_badges(fact, seed_users(spark, AS_OF)))[0] == ("B1", "John Smith", "EMPLOYEE", "Engineering", 2)
    assert rows(v.null_check(fact)) == [("Completeness Check", 4, 0, 0, 0, 0, 1)]


def test_reports_of_an_empty_fact(spark):
    empty = spark.createDataFrame([], schemas.FACT)
    assert rows(v.flagged_access(empty))[0] == ("After-Hours Events", 0, None)
    assert rows(v.direction_distribution(empty)) == []
    assert rows(v.ingestion_latency(empty)) == [("Ingestion Latency", None, None, None, None)]
    assert rows(v.events_by_date(empty)) == []


def unstaged(spark, *counts):
    return spark.createDataFrame([(n,) for n in counts], "n_rows bigint")


def test_pending_texts(spark):
    some, none = unstaged(spark, 1, 2), unstaged(spark)
    assert rows(v.pending_status(some))[0][1:] == ("true", "WARNING:  Data pending (tasks still processing)")
    assert rows(v.pending_status(none))[0][1:] == ("false", " Stream consumed (pipeline caught up)")
    assert rows(v.pending_count(some)) == [("Stream Pending Records", 3)]
    assert rows(v.pending_count(none)) == [("Stream Pending Records", 0)]


def test_pipeline_health(spark, fact):
    log = run_log(spark, ("t", "FAILED", "DB", "2024-01-30T23:50:00", None, 0.0))
    found = {r[0]: r[1:] for r in rows(v.pipeline_health(unstaged(spark, 4), staged(spark, raw_row()), fact, log, AS_OF))}
    assert found == {
        "staging covers facts": (False, -3), "no pending rows": (False, 4),
        "latency below 120 s": (False, 288030), "required fields present": (True, 0), "no failed runs": (False, 1)}


def test_limits_are_parameters(spark):
    log = run_log(spark, *[("t", "SUCCEEDED", "DB", f"2024-01-30T23:{m:02d}:00", f"2024-01-30T23:{m:02d}:05", 0.0) for m in range(30)])
    assert v.recent_runs(log, "DB", AS_OF).count() == 5 and v.recent_runs(log, "DB", AS_OF, limit=None).count() == 30
    assert v.run_errors(log, "DB", AS_OF).count() == 20 and v.run_errors(log, "DB", AS_OF, limit=25).count() == 25
    assert rows(m.run_summary(log, "DB", AS_OF)) == [("t", 30, 5.0)]
    assert rows(m.run_summary(log, "DB", AS_OF, limit=7)) == [("t", 7, 5.0)]


@pytest.mark.parametrize("seed", range(6))
def test_median_against_statistics(spark, seed):
    draw = random.Random(seed)
    values = [draw.choice([0, 5, -7, draw.randrange(-20_000, 20_000)]) for _ in range(draw.randrange(1, 60))]
    counts = spark.createDataFrame([(x,) for x in values], "x bigint").groupBy("x").agg(F.count("*").alias("n"))
    assert v.median_of_counts(counts, "x", "n", 3600).first()[0] == statistics.median(values)
