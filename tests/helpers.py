"""Small hand-made inputs."""

from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

from badgeflow import schemas

AS_OF = "2024-01-31 00:00:00"


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def message(**changes) -> str:
    fields = {
        "badge_id": "BADGE-001", "user_id": "USR-001", "zone_id": "ZONE-LOBBY-1", "reader_id": "RDR-101",
        "event_timestamp": "2024-01-10T10:30:00", "signal_strength": -65.5, "direction": "ENTRY",
    } | changes
    return json.dumps({k: v for k, v in fields.items() if v is not ...})


def messages(spark, *lines: str):
    return spark.createDataFrame([(line,) for line in lines], "value string")


def raw_row(badge="B1", when="2024-01-10T10:00:00", arrived=None, user="USR-001", zone="ZONE-LOBBY-1",
            signal=-50, quality="STRONG", direction="ENTRY", reader="RDR-1"):
    arrived = arrived or when
    return (badge, user, zone, reader, at(when), None if signal is None else Decimal(signal),
            quality, direction, at(arrived), "{}")


def raw(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.RAW)


def staged(spark, *rows):
    from badgeflow.operators.staging import EVENT_COLUMNS
    from pyspark.sql import functions as F

    return raw(spark, *rows).select(*EVENT_COLUMNS, F.col("ingestion_time").alias("staging_time"))


def rows(df):
    return [tuple(r) for r in df.collect()]
