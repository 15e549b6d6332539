"""The changes between two versions of a table, as change rows with their action."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Buckets that are compared by digest first; their list is broadcast, so the number is bounded.
BUCKETS = 4096
MAX_BUCKETS = 1 << 16
INSERT, DELETE = "INSERT", "DELETE"


def _digests(rows: DataFrame) -> DataFrame:
    """Rows and two 64-bit digests of each bucket, whatever the order of the rows."""
    return rows.groupBy("_bucket").agg(
        F.count("*").alias("_rows"), F.bit_xor(F.xxhash64("_row")).alias("_x"),
        F.sum((F.xxhash64(F.lit(1), "_row") % (1 << 32)).cast("decimal(38,0)")).alias("_y"),
    )


def changed_buckets(before: DataFrame, after: DataFrame) -> DataFrame:
    """_bucket of those whose rows differ; rows have _bucket and _row."""
    old, new = _digests(before), _digests(after)
    other = new.select("_bucket", *[F.col(c).alias(f"{c}_new") for c in ("_rows", "_x", "_y")])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"{c}_new")) for c in ("_rows", "_x", "_y")])
    return old.join(other, "_bucket", "full").where(~same).select("_bucket")


def table_changes(before: DataFrame, after: DataFrame, keys: list[str], buckets: int = BUCKETS) -> DataFrame:
    """What turns ``before`` into ``after``: columns of the table, ``change_action`` and ``is_update``.

    A changed row is a DELETE of the old and an INSERT of the new one, both marked as parts of an update; rows that were
    only moved to other files or written again are no change. Repeated rows count as often as they are there; a null
    key is a key like any other.

    Both versions are first reduced to digests of hash buckets of the keys. Only rows of buckets that differ are
    shuffled and compared, column by column. A row that changes its key is an insert and a delete.
    """
    if not 0 < buckets <= MAX_BUCKETS:
        raise ValueError(f"buckets must be between 1 and {MAX_BUCKETS}")
    columns = after.columns

    def spread(rows: DataFrame) -> DataFrame:
        row = F.struct(*[F.col(c) for c in columns]).alias("_row")
        return rows.select(row, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("_bucket"))

    old, new = spread(before), spread(after)
    differing = F.broadcast(changed_buckets(old, new))  # a row for each bucket at most

    def signed(rows: DataFrame, sign: int) -> DataFrame:
        return rows.join(differing, "_bucket", "left_semi").select("_row", F.lit(sign).alias("_sign"))

    net = signed(new, 1).unionByName(signed(old, -1)).groupBy("_row").agg(F.sum("_sign").alias("_net")).where("_net <> 0")
    each = net.select("_row", F.col("_net").alias("_net"), F.explode(F.sequence(F.lit(1), F.abs("_net"))).alias("_copy"))
    action: Column = F.when(F.col("_net") > 0, INSERT).otherwise(DELETE)
    acted = each.select("_row", action.alias("change_action"), F.struct(*[F.col(f"_row.{k}") for k in keys]).alias("_key"))
    both = acted.groupBy("_key").agg(F.countDistinct("change_action").alias("_actions")).where("_actions = 2").select(
        "_key", F.lit(True).alias("is_update")
    )
    return acted.join(both, "_key", "left").select(
        "_row.*", "change_action", F.coalesce("is_update", F.lit(False)).alias("is_update")
    )


def inserts(changes: DataFrame) -> DataFrame:
    """The rows that came in, those that replace another one included."""
    return changes.where(F.col("change_action") == INSERT).drop("change_action", "is_update")
