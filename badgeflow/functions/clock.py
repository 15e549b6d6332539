"""Clock values and time arithmetic on zone-less timestamps (session zone is UTC)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AsOf = datetime | str | Column | None

# Partition column that holds the day of a timestamp column, where a table has one.
DAY_OF = {
    "ingestion_time": "ingestion_date",
    "staging_time": "load_date",
    "fact_load_time": "load_date",
    "end_time": "log_date",
    "scheduled_time": "run_date",
    "hour": "part_date",
}


def instant(as_of: AsOf) -> Column:
    """``as_of`` as a zone-less timestamp; the wall clock when it is None."""
    if as_of is None:
        return F.localtimestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("timestamp_ntz")


def ago(as_of: AsOf, hours: int) -> Column:
    return instant(as_of) - F.expr(f"INTERVAL '{hours}' HOUR")


def since(df: DataFrame, column: str, cutoff: Column) -> DataFrame:
    """Rows at or after ``cutoff``; prunes the table's day partitions when it has them."""
    kept = df.where(F.col(column) >= cutoff)
    day = DAY_OF.get(column)
    if day in df.columns:
        kept = kept.where(F.col(day) >= F.to_date(cutoff))
    return kept


def truncated(unit: str, column: Column) -> Column:
    return F.date_trunc(unit, column).cast("timestamp_ntz")


def seconds_between(start: Column, end: Column) -> Column:
    """Number of second boundaries between two timestamps (00.9 to 02.1 is 2)."""

    def whole_seconds(column: Column) -> Column:
        return F.unix_seconds(column.cast("timestamp"))

    return whole_seconds(end) - whole_seconds(start)


def weekday(column: Column) -> Column:
    """Day of week with Sunday = 0."""
    return F.dayofweek(column) - 1
