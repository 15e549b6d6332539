"""JSON badge messages: reading, parsing, checking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from badgeflow import schemas
from badgeflow.constants import (
    DIRECTION_LENGTH, EVENT_DAYS_AFTER_ARRIVAL, EVENT_DAYS_BEFORE_ARRIVAL, ID_FIELDS, ID_LENGTH, REQUIRED_FIELDS,
)
from badgeflow.functions.clock import AsOf, instant
from badgeflow.functions.signal import signal_bucket, signal_fits, stored_signal, whole_signal

RAW_COLUMNS = schemas.RAW.fieldNames()


def read_messages(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """One JSON message per line, in column ``value`` (the name a Kafka source uses too)."""
    reader = spark.readStream if stream else spark.read
    return reader.format("text").load(path).where(F.length(F.trim("value")) > 0)


def decode_messages(
    messages: DataFrame, ingestion_time: AsOf = None, value: str = "value"
) -> DataFrame:
    """Message fields as text, the message itself and its arrival time.

    Left at None, the arrival time is the wall clock, which is one value per micro-batch. A line
    must hold exactly one object: of any other line every field is missing.
    """
    body = F.col(value).cast("string")
    # inline() keeps later filters above the parse; a plain projection would be merged into
    # each of their conditions and parse the message once per condition
    objects = F.from_json(F.concat(F.lit("["), body, F.lit("]")), ArrayType(schemas.MESSAGE))
    # one row per line also where there are none or several objects; the parse is written once
    single = F.flatten(F.filter(F.array(objects), lambda found: F.size(found) == 1))
    return messages.select(
        F.inline_outer(single),
        instant(ingestion_time).alias("ingestion_time"),
        body.alias("raw_json"),
    )


def event_time() -> Column:
    """The event's time, which must begin with a whole date; null otherwise."""
    text = F.col("event_timestamp")
    return F.when(text.rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}"), text.try_cast("timestamp_ntz"))


def plausible(moment: Column) -> Column:
    """Whether an event's time lies within the stated days around its arrival."""
    arrival = F.col("ingestion_time")
    earliest = arrival - F.expr(f"INTERVAL '{EVENT_DAYS_BEFORE_ARRIVAL}' DAY")
    latest = arrival + F.expr(f"INTERVAL '{EVENT_DAYS_AFTER_ARRIVAL}' DAY")
    return moment.between(earliest, latest)


def broken_rules() -> Column:
    """Names of the rules a decoded row breaks; empty for a good row."""
    rules = [F.when(F.col(f).isNull(), f"{f} missing") for f in REQUIRED_FIELDS]
    rules += [F.when(F.length(f) > ID_LENGTH, f"{f} too long") for f in ID_FIELDS]
    number = whole_signal(F.col("signal_strength"))
    rules += [
        F.when(
            F.col("event_timestamp").isNotNull()
            & event_time().isNull(),
            "event_timestamp not a timestamp",
        ),
        F.when(~plausible(event_time()), "event_timestamp out of range"),
        F.when(
            F.col("signal_strength").isNotNull() & number.isNull(), "signal_strength not a number"
        ),
        F.when(~signal_fits(number), "signal_strength out of range"),
        F.when(F.length(F.upper("direction")) > DIRECTION_LENGTH, "direction too long"),
    ]
    return F.array_compact(F.array(*rules))


def _is_good() -> Column:
    """True for a row that breaks no rule; false or null otherwise."""
    signal, direction = F.col("signal_strength"), F.col("direction")
    good = plausible(event_time())
    for field in ID_FIELDS:
        good = good & (F.length(field) <= ID_LENGTH)
    good = good & (signal.isNull() | signal_fits(whole_signal(signal)))
    return good & (direction.isNull() | (F.length(F.upper(direction)) <= DIRECTION_LENGTH))


def shape_events(decoded: DataFrame, keep_fraction: bool = False) -> DataFrame:
    """Good decoded rows as typed raw rows, bound by name.

    Signals are rounded to whole dBm before they are stored and bucketed; ``keep_fraction``
    stores the decimals but buckets the same way.
    """
    number = whole_signal(F.col("signal_strength"))
    kept_signal = F.col("signal_strength").try_cast("decimal(5,2)") if keep_fraction else number
    return decoded.where(_is_good()).select(
        *ID_FIELDS,
        event_time().alias("event_timestamp"),
        stored_signal(kept_signal).alias("signal_strength"),
        signal_bucket(number).alias("signal_quality"),
        F.upper("direction").alias("direction"),
        "ingestion_time",
        "raw_json",
    )


def rejected_events(decoded: DataFrame) -> DataFrame:
    """Rows that break a rule, kept as they came, with the rules they break."""
    bad = ~F.coalesce(_is_good(), F.lit(False))
    return decoded.where(bad).withColumn("broken_rules", broken_rules())


def message_variant(text: str = "raw_json") -> Column:
    """The message as a variant; one that is no strict JSON (a key twice, single quotes) as a variant of its text."""
    return F.coalesce(F.try_parse_json(text), F.col(text).cast("variant"))


def message_fields(raw: DataFrame, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """Fields of variant messages next to the raw columns, as ``{name: (path, type)}``.

    A path that a message lacks, or whose value is of no fitting type, gives null. Nothing is parsed again, and the scan
    reads the named paths only, from their own Parquet columns where they were shredded.
    """
    return raw.withColumns({name: F.try_variant_get("raw_json", path, kind) for name, (path, kind) in fields.items()})


def parse_messages(messages: DataFrame, ingestion_time: AsOf = None) -> DataFrame:
    return shape_events(decode_messages(messages, ingestion_time))
