"""Enriching staged events into facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from badgeflow import schemas
from badgeflow.constants import DAY_ENDS_AT, DAY_STARTS_AT
from badgeflow.functions.clock import AsOf, instant, weekday
from badgeflow.functions.keys import event_key
from badgeflow.operators.staging import EVENT_COLUMNS, latest_per_key, without_known
from badgeflow.operators.users import current

FACT_COLUMNS = schemas.FACT.fieldNames()


def with_time_parts(events: DataFrame) -> DataFrame:
    moment = F.col("event_timestamp")
    hour, day = F.hour(moment), weekday(moment)
    return events.withColumns({
        "event_date": F.to_date(moment),
        "event_hour": hour,
        "event_day_of_week": day,
        "is_after_hours": (hour < DAY_STARTS_AT) | (hour >= DAY_ENDS_AT),
        "is_weekend": day.isin(0, 6),
    })


def unmapped_zones(staging: DataFrame, zones: DataFrame) -> DataFrame:
    """Staged rows that no fact can be made of, because their zone is unknown."""
    return staging.join(zones.select("zone_id"), "zone_id", "left_anti").select(*staging.columns)


def enrich(
    staging: DataFrame,
    users: DataFrame,
    zones: DataFrame,
    fact: DataFrame | None = None,
    load_time: AsOf = None,
) -> DataFrame:
    """Fact rows for staged events that ``fact`` does not hold yet, one per key.

    Zones come first: events of unknown zones must not win over an earlier event of the same
    key. Of ``fact`` only the staged keys take part. Neither dimension is
    hinted as broadcast: users grow with the data, and Spark picks by measured size.
    """
    zone_part = zones.select("zone_id", "zone_key", F.col("is_restricted").alias("is_restricted_access"))
    in_zones = staging.select(*EVENT_COLUMNS, "staging_time").join(zone_part, "zone_id")
    fresh = latest_per_key(in_zones)
    if fact is not None:
        fresh = without_known(fresh, staging, fact)
    keyed = fresh.join(current(users).select("user_id", "user_key"), "user_id")
    return with_time_parts(keyed).select(
        event_key(F.col("badge_id"), F.col("event_timestamp")).alias("event_key"),
        *[c for c in FACT_COLUMNS if c not in ("event_key", "fact_load_time")],
        instant(load_time).alias("fact_load_time"),
    )
