"""Seed rows of the dimensions."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from badgeflow import schemas
from badgeflow.constants import SEED_USERS, SEED_ZONES
from badgeflow.functions.clock import AsOf, instant


def _keyed(spark: SparkSession, rows: list[tuple], names: list[str], key: str) -> DataFrame:
    columns = {key: list(range(1, len(rows) + 1))}
    columns.update({name: [row[i] for row in rows] for i, name in enumerate(names)})
    # An Arrow table becomes a local relation: its exact size is known to the optimizer.
    return spark.createDataFrame(pa.table(columns))


def fill_columns(df: DataFrame, schema: StructType, defaults: dict) -> DataFrame:
    """All columns of ``schema`` in order: given ones kept, others from defaults, else null."""
    given = set(df.columns)

    def value(field):
        if field.name in given:
            return F.col(field.name)
        return defaults.get(field.name, F.lit(None))

    return df.select(*[value(f).cast(f.dataType).alias(f.name) for f in schema.fields])


def user_defaults(as_of: AsOf) -> dict:
    now = instant(as_of)
    return {
        "is_active": F.lit(True),
        "is_current": F.lit(True),
        "effective_start_date": now,
        "created_timestamp": now,
        "updated_timestamp": now,
    }


def zone_defaults(as_of: AsOf) -> dict:
    now = instant(as_of)
    return {
        "is_monitored": F.lit(True),
        "is_restricted": F.lit(False),
        "created_timestamp": now,
        "updated_timestamp": now,
    }


def reader_defaults(as_of: AsOf) -> dict:
    now = instant(as_of)
    return {"is_online": F.lit(True), "created_timestamp": now, "updated_timestamp": now}


def seed_users(spark: SparkSession, as_of: AsOf = None) -> DataFrame:
    names = ["user_id", "user_name", "user_type", "department", "clearance_level"]
    return fill_columns(
        _keyed(spark, SEED_USERS, names, "user_key"), schemas.USERS, user_defaults(as_of)
    )


def seed_zones(spark: SparkSession, as_of: AsOf = None) -> DataFrame:
    names = [
        "zone_id", "reader_id", "building_name", "floor_number", "zone_name", "zone_type",
        "capacity", "requires_clearance", "is_restricted", "reader_location", "reader_type",
    ]
    return fill_columns(
        _keyed(spark, SEED_ZONES, names, "zone_key"), schemas.ZONES, zone_defaults(as_of)
    )


def empty_readers(spark: SparkSession) -> DataFrame:
    """The reader dimension has a schema but no seed rows."""
    return fill_columns(spark.range(0).select(), schemas.READERS, {})
