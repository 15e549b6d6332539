"""Surrogate keys without a sequence generator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

KEY_DIGITS = 15  # hex digits of each half of an event key
BUCKET_DIGITS = 3  # 16**3 = 4096 buckets, the bound of the broadcast below


def event_key(badge_id: Column, event_timestamp: Column) -> Column:
    """120-bit number from the natural key (badge, time): the first 30 hex digits of its md5.

    Needs no coordination between tasks or batches and is the same on a replay. One 64-bit
    hash would collide at billions of rows; this one does not at trillions.
    """
    text = F.concat_ws("|", badge_id, F.unix_micros(event_timestamp.cast("timestamp")))

    def half(number: int) -> Column:
        digits = F.substring(F.md5(text), 1 + number * KEY_DIGITS, KEY_DIGITS)
        return F.conv(digits, 16, 10).cast("decimal(19,0)")

    shift = F.lit(str(16**KEY_DIGITS)).cast("decimal(19,0)")
    return (half(0) * shift + half(1)).cast("decimal(38,0)")


def with_dense_keys(rows: DataFrame, id_column: str, key_column: str, start: Column) -> DataFrame:
    """Number rows ``start + 1, start + 2, …`` without sending them all through one task.

    ``id_column`` must be unique. Rows are spread over at most 4096 digest buckets, numbered
    inside each, and shifted by the size of the buckets before it. Only the bucket sizes
    (at most 4096 rows) meet in one task and are broadcast.
    """
    # never null: the join below then adds no filter, and both uses of the rows are one shuffle
    bucket = F.coalesce(F.substring(F.md5(F.col(id_column)), 1, BUCKET_DIGITS), F.lit(""))
    spread = rows.withColumn("_bucket", bucket)
    sizes = spread.groupBy("_bucket").agg(F.count("*").alias("_size"))
    earlier = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_bucket", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    place = F.row_number().over(W.partitionBy("_bucket").orderBy(id_column))
    return (
        spread.withColumn("_place", place)
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(key_column, (start + F.col("_offset") + F.col("_place")).cast("bigint"))
        .drop("_bucket", "_place", "_offset")
    )
