"""Table schemas."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, BinaryType, BooleanType, DataType, DateType, DecimalType, DoubleType, IntegerType, LongType, StringType,
    StructField, StructType, TimestampNTZType, VariantType,
)

TEXT, LONG, INT, BYTES = StringType(), LongType(), IntegerType(), BinaryType()
FLAG, DAY, MOMENT, REAL = BooleanType(), DateType(), TimestampNTZType(), DoubleType()
SIGNAL, DEGREES, DIGEST = DecimalType(5, 2), DecimalType(10, 6), DecimalType(38, 0)
VARIANT = VariantType()


def _table(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


def _with(schema: StructType, **columns: DataType) -> StructType:
    return StructType(schema.fields + _table(**columns).fields)


# The columns of this module are fixed values: their names and order are those of the tables.

# Every message field is read as text first, so that a bad value can be told from a missing one.
MESSAGE = _table(
    badge_id=TEXT,
    user_id=TEXT,
    zone_id=TEXT,
    reader_id=TEXT,
    event_timestamp=TEXT,
    signal_strength=TEXT,
    direction=TEXT,
)

_EVENT = _table(
    badge_id=TEXT,
    user_id=TEXT,
    zone_id=TEXT,
    reader_id=TEXT,
    event_timestamp=MOMENT,
    signal_strength=SIGNAL,
    signal_quality=TEXT,
    direction=TEXT,
    ingestion_time=MOMENT,
)
RAW = _with(_EVENT, raw_json=TEXT)
STAGING = _with(_EVENT, staging_time=MOMENT)

USERS = _table(
    user_key=LONG,
    user_id=TEXT,
    user_name=TEXT,
    user_type=TEXT,
    department=TEXT,
    email=TEXT,
    phone=TEXT,
    clearance_level=TEXT,
    is_active=FLAG,
    effective_start_date=MOMENT,
    effective_end_date=MOMENT,
    is_current=FLAG,
    created_timestamp=MOMENT,
    updated_timestamp=MOMENT,
)

ZONES = _table(
    zone_key=LONG,
    zone_id=TEXT,
    reader_id=TEXT,
    building_name=TEXT,
    floor_number=INT,
    zone_name=TEXT,
    zone_type=TEXT,
    capacity=LONG,
    requires_clearance=TEXT,
    is_monitored=FLAG,
    is_restricted=FLAG,
    reader_location=TEXT,
    reader_type=TEXT,
    latitude=DEGREES,
    longitude=DEGREES,
    created_timestamp=MOMENT,
    updated_timestamp=MOMENT,
)

READERS = _table(
    reader_key=LONG,
    reader_id=TEXT,
    reader_name=TEXT,
    reader_type=TEXT,
    manufacturer=TEXT,
    model=TEXT,
    firmware_version=TEXT,
    is_online=FLAG,
    last_heartbeat=MOMENT,
    created_timestamp=MOMENT,
    updated_timestamp=MOMENT,
)

# event_key is a 120-bit digest of the natural key; see functions.keys.
FACT = _table(
    event_key=DIGEST,
    user_key=LONG,
    zone_key=LONG,
    badge_id=TEXT,
    reader_id=TEXT,
    event_timestamp=MOMENT,
    event_date=DAY,
    event_hour=INT,
    event_day_of_week=INT,
    direction=TEXT,
    signal_strength=SIGNAL,
    signal_quality=TEXT,
    is_restricted_access=FLAG,
    is_after_hours=FLAG,
    is_weekend=FLAG,
    ingestion_time=MOMENT,
    fact_load_time=MOMENT,
)

INGEST_LOG = _table(
    table_name=TEXT,
    end_time=MOMENT,
    num_rows_migrated=LONG,
    num_bytes_migrated=LONG,
    credits_used=REAL,
)

SCAN_LOG = _table(
    table_name=TEXT,
    interval_start_time=MOMENT,
    num_queries=LONG,
    partitions_scanned=LONG,
    partitions_pruned=LONG,
    rows_scanned=LONG,
    rows_pruned=LONG,
)

RUN_LOG = _table(
    name=TEXT,
    state=TEXT,
    error_code=TEXT,
    error_message=TEXT,
    database_name=TEXT,
    scheduled_time=MOMENT,
    completed_time=MOMENT,
    credits_used=REAL,
)

# What the decoded messages carry next to their fields, and why one was rejected.
REJECTS = _with(MESSAGE, ingestion_time=MOMENT, raw_json=TEXT)
REJECTS = StructType([*REJECTS.fields, StructField("broken_rules", ArrayType(TEXT))])

# The same tables as files: with the columns that only the folders carry.
RAW_FILES = _with(RAW, message_bytes=INT, ingestion_date=DAY, run=TEXT, batch_id=LONG)
RAW_VARIANT_FILES = StructType([StructField(f.name, VARIANT) if f.name == "raw_json" else f for f in RAW_FILES])
REJECTS_FILES = _with(REJECTS, ingestion_date=DAY, run=TEXT, batch_id=LONG)
STAGING_FILES = _with(STAGING, load_date=DAY, run=TEXT, batch_id=LONG)
FIRST_EVENTS_FILES = _with(_EVENT, event_date=DAY, run=TEXT, batch_id=LONG)
STAGED_FILES = _table(file=TEXT, ingestion_date=DAY)
STAGED_BATCHES = _table(run=TEXT, batch_id=LONG, staged_at=MOMENT)
FACT_FILES = _with(FACT, load_date=DAY)
INGEST_LOG_FILES = _with(INGEST_LOG, log_date=DAY, run=TEXT, batch_id=LONG)
RUN_LOG_FILES = _with(RUN_LOG, attempt=LONG, run_date=DAY, run=TEXT, batch_id=LONG)

# Parts of hourly rollups, and the numbers of the values that their bitmaps count.
HOURLY_PARTS_FILES = _table(
    hour=MOMENT,
    event_count=LONG,
    weak_signal_count=LONG,
    entry_count=LONG,
    exit_count=LONG,
    signal_sum=LONG,
    signal_count=LONG,
    known_signal_sum=LONG,
    known_signal_count=LONG,
    earliest_event=MOMENT,
    latest_event=MOMENT,
    first_ingestion=MOMENT,
    last_ingestion=MOMENT,
    part_date=DAY,
    run=TEXT,
    batch_id=LONG,
)
HOURLY_BITS_FILES = _table(
    hour=MOMENT, column_name=TEXT, bucket=LONG, bits=BYTES, part_date=DAY, run=TEXT, batch_id=LONG
)
VALUE_NUMBERS = _table(column_name=TEXT, value=TEXT, number=LONG)
