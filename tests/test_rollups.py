import random
from datetime import timedelta

import pytest
from badgeflow.operators import rollups
from badgeflow.plans import monitoring, validation
from badgeflow.streaming import live
from compare import spark_rows
from helpers import AS_OF, at, raw, raw_row
from pyspark.sql import functions as F


def lines(n=400):
    draw = random.Random(n)
    made = []
    for _ in range(n):
        arrived = at("2024-01-29T20:00:00") + timedelta(minutes=draw.randrange(28 * 60))
        made.append(raw_row(
            badge="HOT" if draw.random() < 0.3 else f"B{draw.randrange(60)}", zone=draw.choice(["Z1", "Z2", "Z3", None]),
            arrived=arrived.isoformat(), signal=draw.choice([-999, -50, -85, None]), quality=draw.choice(["WEAK", "STRONG"]),
            direction=draw.choice(["ENTRY", "EXIT", None]),
        ))
    return made


def kept(spark, layout, *batches):
    for number, batch in enumerate(batches):
        live.keep_rollups(spark, layout, raw(spark, *batch), "test", number)
    return layout.table(spark, "hourly_parts"), layout.table(spark, "hourly_bits")


@pytest.mark.parametrize("as_of", [AS_OF, "2024-01-31 00:20:30"])
@pytest.mark.parametrize("ignore_sentinel", [False, True])
def test_late_rows_correct_their_hours(spark, layout, as_of, ignore_sentinel):
    """Rows come in any order over three batches, hours late; each batch is tried twice."""
    all_rows = lines()
    batches = [all_rows[0::3], all_rows[1::3], all_rows[2::3]]
    kept(spark, layout, *batches)
    parts, bits = kept(spark, layout, *batches)
    whole = raw(spark, *all_rows)
    want = monitoring.ingestion_metrics(whole, as_of, ignore_sentinel)
    assert spark_rows(monitoring.rolled_ingestion_metrics(parts, bits, whole, as_of, ignore_sentinel)) == spark_rows(want)
    assert want.count() > 20
    assert spark_rows(validation.rolled_raw_stats(parts, bits)) == spark_rows(validation.raw_stats(whole))


def test_numbers_are_dense_and_stay(spark, layout):
    kept(spark, layout, [raw_row(badge=f"B{n}") for n in range(50)])
    first = {tuple(r) for r in layout.value_numbers(spark).collect()}
    kept(spark, layout, [raw_row(badge=f"B{n}", zone="Z9") for n in range(40, 70)])
    after = {tuple(r) for r in layout.value_numbers(spark).collect()}
    assert first < after and sorted(n for *_, n in after) == list(range(1, len(after) + 1))
    assert len({r[:2] for r in after}) == len(after)


def test_numbers_beyond_one_bitmap(spark):
    seen = spark.range(100_000).select(
        F.lit(at("2024-01-10T10:00:00")).alias("hour"), F.lit("badge_id").alias("column_name"), F.col("id").cast("string").alias("value"))
    numbers = seen.select("column_name", "value", (F.col("value").cast("bigint") + 1).alias("number"))
    bits = rollups.hourly_bits(seen, numbers)
    halves = rollups.hourly_bits(seen.where("value < 70000"), numbers).unionByName(rollups.hourly_bits(seen.where("value > 30000"), numbers))
    assert bits.count() == 4
    for b in (bits, halves):
        assert tuple(rollups.distinct_counts(b, []).first()) == (100_000, 0)


def test_rollups_do_not_read_raw(spark, layout):
    parts, bits = kept(spark, layout, lines(50))
    layout.append_raw(raw(spark, *lines(50)))
    for rolled in (monitoring.rolled_ingestion_metrics(parts, bits, layout.raw(spark), AS_OF), validation.rolled_raw_stats(parts, bits)):
        tables = {file.split("/tables/")[1].split("/")[0] for file in rolled.inputFiles()}
        assert tables == {"hourly_parts", "hourly_bits"}
    cut = monitoring.rolled_ingestion_metrics(parts, bits, layout.raw(spark), "2024-01-31 00:20:30")
    assert any("/raw/" in file for file in cut.inputFiles())


def test_empty(spark, layout):
    parts, bits = kept(spark, layout, [])
    assert validation.rolled_raw_stats(parts, bits).first().row_count == 0
    assert monitoring.rolled_ingestion_metrics(parts, bits, layout.raw(spark), AS_OF).collect() == []
