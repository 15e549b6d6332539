"""User dimension: adding unknown users, applying attribute changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from badgeflow import schemas
from badgeflow.constants import UNKNOWN, UNKNOWN_CLEARANCE
from badgeflow.functions.clock import AsOf, instant
from badgeflow.functions.keys import with_dense_keys
from badgeflow.operators.staging import latest_per_key, without_known
from badgeflow.sources.seeds import fill_columns, user_defaults

USER_COLUMNS = schemas.USERS.fieldNames()
ATTRIBUTES = ("user_name", "user_type", "department", "email", "phone", "clearance_level", "is_active")


def current(users: DataFrame) -> DataFrame:
    return users.where("is_current")


def _last_key(users: DataFrame) -> Column:
    return users.agg(F.coalesce(F.max("user_key"), F.lit(0)).alias("last")).scalar()


def unknown_ids(staging: DataFrame, users: DataFrame) -> DataFrame:
    """user_id of those that have no current row."""
    ids = staging.select("user_id").where("user_id IS NOT NULL")
    return without_known(ids.distinct(), ids, current(users), ["user_id"])


def new_users(staging: DataFrame, users: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Rows to append for user ids that have no current row. Nothing is updated."""
    return numbered_users(unknown_ids(staging, users), users, as_of)


def numbered_users(unknown: DataFrame, users: DataFrame, as_of: AsOf = None) -> DataFrame:
    keyed = with_dense_keys(unknown, "user_id", "user_key", _last_key(users))
    defaults = user_defaults(as_of) | {
        "user_name": F.lit(UNKNOWN),
        "user_type": F.lit(UNKNOWN),
        "department": F.lit(UNKNOWN),
        "clearance_level": F.lit(UNKNOWN_CLEARANCE),
    }
    return fill_columns(keyed, schemas.USERS, defaults)


def merge_users(staging: DataFrame, users: DataFrame, as_of: AsOf = None) -> DataFrame:
    return users.select(*USER_COLUMNS).unionByName(new_users(staging, users, as_of))


#: What happens at one time, in this order: a version ends, a version starts, a change is made.
ENDS, STARTS, CHANGES = 0, 1, 2


def apply_user_changes(
    users: DataFrame, changes: DataFrame, attributes: list[str], as_of: AsOf = None
) -> DataFrame:
    """The whole dimension after Type-2 changes, with a version for each of them.

    ``changes`` has ``user_id``, ``changed_at`` and the attributes, in any order and of any age. A change holds from
    its time to the next change, version or end of a version of its user, so a change older than a closed version
    splits that version; attributes that it does not speak of are those of the version at its time (or of the first
    one, before that). Neighbours with equal attributes are one version. A version that is in the dimension keeps its key and
    its row: it is shortened, and if a change takes all of its time, its interval is empty. A change that meets a
    later version with equal attributes moves that version's start. Applied twice, changes do nothing more.

    Changes without user or time are left out; of several at one time the last by the attributes counts. Write the
    result to a new folder, never over the one being read.

    The versions and changes of one user are ordered in one task, on disk where they are many; repeated values of a day
    are taken out before, day by day.
    """
    now = instant(as_of)
    given = changes.select("user_id", "changed_at", *attributes).where("user_id IS NOT NULL AND changed_at IS NOT NULL")
    given = latest_per_key(given, ["user_id", "changed_at"], attributes[0])
    # an empty version only serves facts that have its key
    lasting = F.col("effective_end_date").isNull() | (F.col("effective_end_date") > F.col("effective_start_date"))
    own = F.struct(*[F.col(a) for a in ATTRIBUTES]).alias("own")
    changed = F.struct(*[F.col(a) for a in attributes]).alias("changed")
    # the filter makes both uses of the ids equal, so that Spark shuffles them once
    ids = given.select("user_id").distinct()
    touched = users.where(lasting).join(ids, "user_id", "left_semi")
    row = F.struct(*USER_COLUMNS).alias("row")

    def nothing(of: DataFrame, struct: Column, name: str) -> Column:
        return F.lit(None).cast(of.select(struct).schema.fields[0].dataType).alias(name)

    no_row, no_own, no_change = nothing(users, row, "row"), nothing(users, own, "own"), nothing(given, changed, "changed")
    events = touched.select("user_id", F.col("effective_start_date").alias("at"), F.lit(STARTS).alias("kind"), own, no_change, row)
    events = events.unionByName(
        touched.where("effective_end_date IS NOT NULL").select(
            "user_id", F.col("effective_end_date").alias("at"), F.lit(ENDS).alias("kind"), no_own, no_change, no_row
        )
    ).unionByName(given.select("user_id", F.col("changed_at").alias("at"), F.lit(CHANGES).alias("kind"), no_own, changed, no_row))

    order = ["at", "kind", F.col("row.user_key")]
    day = W.partitionBy("user_id", F.to_date("at")).orderBy(*order)
    repeated = (F.col("kind") == CHANGES) & F.coalesce(F.lag("changed").over(day) == F.col("changed"), F.lit(False))
    events = events.withColumn("_repeated", repeated).where("NOT _repeated").drop("_repeated")

    user = W.partitionBy("user_id").orderBy(*order)
    before = F.last("own", ignorenulls=True).over(user.rowsBetween(W.unboundedPreceding, 0))
    after = F.first("own", ignorenulls=True).over(user.rowsBetween(0, W.unboundedFollowing))
    # the end of a version says nothing where the next one starts
    followed = (F.col("kind") == ENDS) & (F.lead("kind").over(user) == STARTS) & (F.lead("at").over(user) == F.col("at"))
    events = events.withColumns({"_held": F.coalesce(before, after), "_followed": F.coalesce(followed, F.lit(False))}).where("NOT _followed").drop("_followed")
    held = {a: F.col(f"_held.{a}") for a in ATTRIBUTES}
    overlaid = F.struct(*[(F.col(f"changed.{a}") if a in attributes else held[a]).alias(a) for a in ATTRIBUTES])
    events = events.withColumn("own", F.when(F.col("kind") == CHANGES, overlaid).otherwise(F.col("own"))).drop("_held", "changed")
    same = F.coalesce(F.lag("own").over(user) == F.col("own"), F.lit(False))
    events = events.withColumn("_same", (F.col("kind") == CHANGES) & same).where("NOT _same").drop("_same")

    of_neighbours = {
        "_next_at": F.lead("at").over(user),
        "_into_next": (F.lead("kind").over(user) == STARTS) & (F.lead("own").over(user) == F.col("own")),
        "_previous_at": F.lag("at").over(user),
        "_from_previous": (F.lag("kind").over(user) == CHANGES) & (F.lag("own").over(user) == F.col("own")),
    }
    pieces = events.withColumns(of_neighbours)
    start = F.when(F.coalesce("_from_previous", F.lit(False)), F.col("_previous_at")).otherwise(F.col("at"))
    kept = pieces.where(F.col("kind") == STARTS).select(start.alias("_start"), F.col("_next_at").alias("_end"), "row.*")
    moved = ~F.col("_start").eqNullSafe(F.col("effective_start_date")) | ~F.col("_end").eqNullSafe(F.col("effective_end_date"))
    kept = kept.withColumns({
        "updated_timestamp": F.when(moved, now).otherwise(F.col("updated_timestamp")),
        "is_current": F.col("is_current") & F.col("_end").isNull(),
        "effective_start_date": F.col("_start"),
        "effective_end_date": F.col("_end"),
    }).select(*USER_COLUMNS)

    opening = pieces.where((F.col("kind") == CHANGES) & ~F.coalesce("_into_next", F.lit(False))).select(
        "user_id", F.concat_ws("|", "user_id", F.unix_micros(F.col("at").cast("timestamp"))).alias("_version"),
        F.col("at").alias("effective_start_date"), F.col("_next_at").alias("effective_end_date"),
        F.col("_next_at").isNull().alias("is_current"), "own.*",
    )
    keyed = with_dense_keys(opening, "_version", "user_key", _last_key(users)).drop("_version")
    versions = keyed.withColumn("is_active", F.coalesce("is_active", F.lit(True)))
    untouched = users.where(~lasting).unionByName(users.where(lasting).join(ids, "user_id", "left_anti").select(*users.columns))
    return untouched.select(*USER_COLUMNS).unionByName(kept).unionByName(fill_columns(versions, schemas.USERS, user_defaults(as_of)))
