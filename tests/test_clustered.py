"""What is read of clustered files: rows that the scan hands on, after row groups and pages were left out."""

import glob
from datetime import timedelta

import pyarrow.parquet as pq
import pytest
from badgeflow.operators.staging import latest_rows
from badgeflow.plans import pipeline
from helpers import AS_OF, at, rows
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def filled(spark, tmp_path_factory):
    """Two days of 150,000 events, loaded in no order; one badge is in the second day only."""
    from badgeflow.sources.tables import Layout

    layout = Layout(str(tmp_path_factory.mktemp("clustered") / "tables")).create(spark, AS_OF)
    second = F.when(F.col("id") % 2 == 0, 86_400).otherwise(0) + F.expr("cast(pmod(xxhash64(id), 86400) AS bigint)")
    badge = F.when((F.col("id") % 2 == 0) & (F.col("id") % 20_000 == 0), "RARE").otherwise(F.concat(F.lit("BADGE-"), F.col("id").cast("string")))
    when = (F.lit(at("2024-01-10T00:00:00")) + F.make_dt_interval(secs=second)).alias("event_timestamp")
    raw = spark.range(300_000).repartition(6).select(
        badge.alias("badge_id"), F.lit("USR-001").alias("user_id"), F.lit("ZONE-LOBBY-1").alias("zone_id"), F.lit("R").alias("reader_id"),
        when, F.lit(-50).cast("decimal(5,2)").alias("signal_strength"), F.lit("STRONG").alias("signal_quality"),
        F.lit("ENTRY").alias("direction"), when.alias("ingestion_time"), F.col("id").cast("string").alias("raw_json"),
    )
    layout.append_raw(raw)
    pipeline.process_batch(spark, layout, layout.raw(spark), 0, AS_OF, F.col("ingestion_time"), F.col("ingestion_time"))
    return layout


def scanned(df):
    """Rows that file scans hand on."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(n).metrics().apply("numOutputRows").value() for n in range(leaves.size()))


def test_files_are_sorted(spark, filled):
    for table in ("raw", "staging", "fact"):
        for path in glob.glob(f"{filled.path(table)}/**/*.parquet", recursive=True):
            found = pq.ParquetFile(path).read(["event_timestamp", "badge_id"]).to_pylist()
            assert found == sorted(found, key=lambda r: (r["event_timestamp"], r["badge_id"]))


def test_an_hour_reads_few_pages(spark, filled):
    first = at("2024-01-11T09:00:00")
    hour = pipeline.facts_between(filled.fact(spark), first, first + timedelta(minutes=59)).select("badge_id", "event_timestamp")
    found, read = hour.count(), scanned(hour)
    assert found > 5000 and read <= 2 * 20_000  # two of fifteen pages
    two_days = pipeline.facts_between(filled.fact(spark), first - timedelta(days=1), first)
    assert two_days.count() == filled.fact(spark).where(F.col("event_timestamp").between(F.lit(first - timedelta(days=1)), F.lit(first))).count()
    assert pipeline.facts_between(filled.fact(spark), None, None).count() == 0


def test_a_rare_badge_is_looked_for_in_the_files_that_may_have_it(spark, filled):
    for day in ("2024-01-10", "2024-01-11"):
        filled.close_fact_day(spark, day)
        filled.close_day(spark, "staging", day)
    for table in (filled.staging(spark), filled.fact(spark)):
        assert table.where("badge_id = 'RARE'").count() == 15
        nobody = table.where("badge_id = 'BADGE-NOBODY'").select("badge_id", "event_timestamp")
        assert scanned(nobody) == 0
    assert len(rows(latest_rows(filled.raw(spark), "RARE"))) == 10


def test_missing_facts_reads_the_span_of_the_batch(spark, filled):
    span = pipeline.Span()
    batch = filled.raw(spark).where("event_timestamp >= TIMESTAMP_NTZ '2024-01-11 09:00:00' AND event_timestamp < TIMESTAMP_NTZ '2024-01-11 10:00:00'")
    staged = pipeline.stage_batch(spark, filled, batch, 1, F.col("ingestion_time"), "again", span)
    assert at("2024-01-11T09:00:00") <= span.ends()[0] < span.ends()[1] < at("2024-01-11T10:00:00")
    assert span.ends() == pipeline.ends_of(staged)
    assert pipeline.missing_facts(spark, filled, staged, AS_OF, span).count() == 0
