"""Hourly rollups of arrivals that merge: counts, sums, and distinct values as bitmaps.

Every batch adds a part for each hour of its rows, however late they are; reading adds the parts up, so a late row
corrects its hour whenever it comes. Distinct values are exact: each value gets a dense number once, and a part holds
the numbers of an hour as bitmaps of 32,768 bits. Parts are merged by OR, so neither the raw rows nor the values
are read or shuffled again, over any range of hours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from badgeflow.constants import MISSING_SIGNAL
from badgeflow.functions.clock import truncated
from badgeflow.functions.keys import with_dense_keys
from badgeflow.operators.staging import without_known

#: The columns whose distinct values are counted.
COUNTED = ("badge_id", "zone_id")
ID = ["column_name", "value"]
SIGNAL_SCALE = 100  # sums of signals are kept as whole hundredths

SUMS = (
    "event_count", "weak_signal_count", "entry_count", "exit_count", "signal_sum", "signal_count", "known_signal_sum",
    "known_signal_count",
)
ENDS = {"event_timestamp": ("earliest_event", "latest_event"), "ingestion_time": ("first_ingestion", "last_ingestion")}


def _hour() -> Column:
    return truncated("hour", F.col("ingestion_time")).alias("hour")


def hourly_parts(raw: DataFrame) -> DataFrame:
    """Counts, sums and ends of each hour of the rows."""
    hundredths = (F.col("signal_strength") * SIGNAL_SCALE).cast("bigint")
    known = F.when(F.col("signal_strength") != MISSING_SIGNAL, hundredths)
    ends = [f(c).alias(name) for c, names in ENDS.items() for f, name in zip((F.min, F.max), names)]
    return raw.groupBy(_hour()).agg(
        F.count("*").alias("event_count"),
        F.count_if(F.col("signal_quality") == "WEAK").alias("weak_signal_count"),
        F.count_if(F.col("direction") == "ENTRY").alias("entry_count"),
        F.count_if(F.col("direction") == "EXIT").alias("exit_count"),
        F.sum(hundredths).alias("signal_sum"), F.count(hundredths).alias("signal_count"),
        F.sum(known).alias("known_signal_sum"), F.count(known).alias("known_signal_count"),
        *ends, F.to_date("hour").alias("part_date"),
    )


def seen_values(raw: DataFrame) -> DataFrame:
    """hour, column_name, value: each once."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in COUNTED])
    return raw.select(_hour(), F.inline(pairs)).where("value IS NOT NULL").distinct()


def new_numbers(seen: DataFrame, numbers: DataFrame) -> DataFrame:
    """column_name, value, number of the values that have none yet; numbers go on from the last one."""
    wanted = seen.select(*ID).distinct()
    unknown = without_known(wanted, wanted, numbers, ID).withColumn("_id", F.concat_ws("=", *ID))
    last = numbers.agg(F.coalesce(F.max("number"), F.lit(0)).alias("last")).scalar()
    return with_dense_keys(unknown, "_id", "number", last).select(*ID, "number")


def hourly_bits(seen: DataFrame, numbers: DataFrame) -> DataFrame:
    """hour, column_name, bucket, bits of the values of each hour."""
    bucket = F.bitmap_bucket_number("number").alias("bucket")
    return seen.join(numbers, ID).groupBy("hour", "column_name", bucket).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")
    ).withColumn("part_date", F.to_date("hour"))


def distinct_counts(bits: DataFrame, by: list[str]) -> DataFrame:
    """A column ``distinct_<name>`` for each counted column, for each of ``by``: parts of one bitmap are merged first."""
    merged = bits.groupBy(*by, "column_name", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("size"))
    of_column = [F.when(F.col("column_name") == c, F.col("size")) for c in COUNTED]
    return merged.groupBy(*by).agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(f"distinct_{c}") for c, n in zip(COUNTED, of_column)])


def hourly_stats(parts: DataFrame, bits: DataFrame, ignore_sentinel: bool = False) -> DataFrame:
    """What ``monitoring.hourly_stats`` says of raw, from the parts of all batches."""
    sums = parts.groupBy("hour").agg(*[F.sum(c).alias(c) for c in SUMS])
    kind = "known_signal" if ignore_sentinel else "signal"
    mean = F.try_divide(F.col(f"{kind}_sum").cast("double"), F.col(f"{kind}_count") * F.lit(float(SIGNAL_SCALE)))
    return sums.join(distinct_counts(bits, ["hour"]), "hour", "left").select(
        F.col("hour").alias("ingestion_hour"), "event_count",
        F.coalesce("distinct_badge_id", F.lit(0)).alias("unique_badges"), F.coalesce("distinct_zone_id", F.lit(0)).alias("unique_zones"),
        mean.alias("avg_signal_strength"), "weak_signal_count", "entry_count", "exit_count",
    )


def total_stats(parts: DataFrame, bits: DataFrame) -> DataFrame:
    """One row: event_count, distinct values and the ends of all hours."""
    ends = [f(name).alias(name) for names in ENDS.values() for f, name in zip((F.min, F.max), names)]
    totals = parts.agg(F.coalesce(F.sum("event_count"), F.lit(0)).alias("event_count"), *ends)
    return totals.crossJoin(F.broadcast(distinct_counts(bits, [])))  # a row each
