"""Deduplication and staging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from badgeflow import schemas
from badgeflow.functions.clock import AsOf, ago, instant, since
from badgeflow.operators.feed import inserts

# The time comes first: sorts then compare longs, where badge ids often share a long prefix.
EVENT_KEY = ["event_timestamp", "badge_id"]
EVENT_COLUMNS = [c for c in schemas.STAGING.fieldNames() if c != "staging_time"]


def latest_per_key(
    rows: DataFrame, keys: list[str] = EVENT_KEY, newest: str = "ingestion_time"
) -> DataFrame:
    """The newest row of each key.

    Ties fall to the other columns, so that a rerun picks the same row. Spark keeps one row
    per key in each task before it shuffles, so copies of one key never meet in one task.
    """
    rest = [F.col(c).desc_nulls_last() for c in rows.columns if c not in (*keys, newest)]
    return _one_per_key(rows, keys, [F.col(newest).desc_nulls_last(), *rest])


def first_per_key(rows: DataFrame, keys: list[str] = EVENT_KEY, oldest: str = "ingestion_time") -> DataFrame:
    """The oldest row of each key; ties fall to the other columns."""
    rest = [F.col(c).asc_nulls_last() for c in rows.columns if c not in (*keys, oldest)]
    return _one_per_key(rows, keys, [F.col(oldest).asc_nulls_last(), *rest])


def _one_per_key(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    window = W.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def without_known(rows: DataFrame, keys: DataFrame, known: DataFrame, on: list[str] = EVENT_KEY) -> DataFrame:
    """Rows whose key is not known. ``keys`` holds the keys of the rows, or more.

    The known side is reduced to these keys first. Spark broadcasts them when they are few, so a
    large known side is neither shuffled nor sorted for a small batch.
    """
    held = known.select(*on).join(keys.select(*on), on, "left_semi")
    return rows.join(held, on, "left_anti")


def stage(raw: DataFrame, staging_time: AsOf = None) -> DataFrame:
    """One row per key of this batch, with the staging columns.

    Of change rows (with ``change_action``) only the inserts are staged; raw as files only ever grows.
    """
    rows = inserts(raw) if "change_action" in raw.columns else raw
    kept = latest_per_key(rows.select(*EVENT_COLUMNS))
    return kept.withColumn("staging_time", instant(staging_time))


def retained(staging: DataFrame, as_of: AsOf = None, days: int = 1) -> DataFrame:
    return since(staging, "staging_time", ago(as_of, 24 * days))


def latest_rows(raw: DataFrame, badge_id: str | Column | None = None, rows: int = 10) -> DataFrame:
    """The newest arrivals, of one badge or of all."""
    kept = raw if badge_id is None else raw.where(F.col("badge_id") == badge_id)
    return kept.orderBy(F.desc("ingestion_time"), F.desc("event_timestamp"), "badge_id").limit(rows)
