"""Checks for the constraints that the tables declare."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from badgeflow.operators.staging import EVENT_KEY
from badgeflow.operators.users import current
from badgeflow.sources.messages import broken_rules


def staging_duplicates(staging: DataFrame) -> DataFrame:
    return staging.groupBy(*EVENT_KEY).agg(F.count("*").alias("row_count")).where("row_count > 1")


def dimension_duplicates(users: DataFrame, zones: DataFrame, readers: DataFrame) -> DataFrame:
    def repeated(df: DataFrame, table: str, column: str) -> DataFrame:
        return df.groupBy(F.col(column).alias("id")).agg(F.count("*").alias("row_count")).where(
            "row_count > 1"
        ).select(F.lit(table).alias("table_name"), "id", "row_count")

    return (
        repeated(current(users), "DIM_USERS", "user_id")
        .unionByName(repeated(zones, "DIM_ZONES", "zone_id"))
        .unionByName(repeated(readers, "DIM_READERS", "reader_id"))
    )


def orphan_keys(fact: DataFrame, users: DataFrame, zones: DataFrame) -> DataFrame:
    """Dimension keys used by facts but absent from the dimension, with their fact counts."""

    def orphans(dimension: DataFrame, key: str) -> DataFrame:
        used = fact.groupBy(key).agg(F.count("*").alias("fact_rows"))
        return used.join(dimension.select(key), key, "left_anti").select(
            F.lit(key).alias("key_column"), F.col(key).alias("missing_key"), "fact_rows"
        )

    return orphans(users, "user_key").unionByName(orphans(zones, "zone_key"))


def broken_rule_counts(decoded: DataFrame) -> DataFrame:
    """Messages per broken rule. A message that breaks two rules counts for both."""
    return decoded.select(F.explode(broken_rules()).alias("rule")).groupBy("rule").agg(
        F.count("*").alias("row_count")
    )
