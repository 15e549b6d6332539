"""Sample events and newline-delimited JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from badgeflow.functions.clock import AsOf, instant


def sample_events(indexes: DataFrame, count: Column | int, now: AsOf = None) -> DataFrame:
    """One sample message per row of ``indexes`` (column ``index``, 0 to ``count - 1``).

    Events lie two seconds apart and end two seconds before ``now``; they share one zone,
    alternate in direction and gain 1 dBm each.
    """
    count = F.lit(count) if isinstance(count, int) else count
    index = F.col("index")
    moment = instant(now) - F.make_dt_interval(secs=(count - index) * 2)
    return indexes.select(
        F.format_string("BADGE-%03d", index).alias("badge_id"),
        F.format_string("USR-%03d", index).alias("user_id"),
        F.lit("ZONE-LOBBY-1").alias("zone_id"),
        F.concat(F.lit("RDR-"), (index + 100).cast("string")).alias("reader_id"),
        # ISO 8601 with the UTC offset; the fraction is left out when it is zero
        F.concat(
            F.replace(moment.cast("string"), F.lit(" "), F.lit("T")), F.lit("+00:00")
        ).alias("event_timestamp"),
        (index.cast("double") - 65.0).alias("signal_strength"),
        F.when(index % 2 == 0, "ENTRY").otherwise("EXIT").alias("direction"),
    )


def to_ndjson(events: DataFrame) -> DataFrame:
    """Each row as one JSON line in column ``value``; null fields are left out."""
    return events.select(F.to_json(F.struct("*")).alias("value"))


def write_ndjson(events: DataFrame, path: str) -> None:
    to_ndjson(events).write.mode("append").text(path)
