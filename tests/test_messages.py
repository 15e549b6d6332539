import random
from decimal import Decimal

import pytest
from badgeflow import schemas
from badgeflow.sources.messages import (
    broken_rules, decode_messages, parse_messages, read_messages, rejected_events, shape_events,
)
from badgeflow.sources import sample, seeds
from helpers import AS_OF, at, message, messages, rows
from pyspark.sql import functions as F

COLUMNS = [
    "badge_id", "user_id", "zone_id", "reader_id", "event_timestamp", "signal_strength",
    "signal_quality", "direction", "ingestion_time", "raw_json",
]


def test_parsed_row(spark):
    line = message(direction="exit", extra={"a": 1})
    parsed = parse_messages(messages(spark, line), AS_OF)
    assert parsed.columns == COLUMNS
    assert rows(parsed) == [(
        "BADGE-001", "USR-001", "ZONE-LOBBY-1", "RDR-101", at("2024-01-10T10:30:00"), Decimal("-66.00"),
        "MEDIUM", "EXIT", at("2024-01-31T00:00:00"), line,
    )]


@pytest.mark.parametrize("signal,stored,bucket", [
    (-80.4, -80, "MEDIUM"), (-80.5, -81, "WEAK"), (-81, -81, "WEAK"), (-60, -60, "STRONG"),
    (-61, -61, "MEDIUM"), (-65.5, -66, "MEDIUM"), (-66.5, -67, "MEDIUM"), ("-70", -70, "MEDIUM"),
    (None, -999, "STRONG"), (..., -999, "STRONG"),
])
def test_signal(spark, signal, stored, bucket):
    parsed = parse_messages(messages(spark, message(signal_strength=signal)), AS_OF)
    assert rows(parsed.select("signal_strength", "signal_quality")) == [(Decimal(stored), bucket)]


def test_fraction_kept_on_request(spark):
    decoded = decode_messages(messages(spark, message(signal_strength=-80.4)), AS_OF)
    kept = shape_events(decoded, keep_fraction=True)
    assert rows(kept.select("signal_strength", "signal_quality")) == [(Decimal("-80.40"), "MEDIUM")]


@pytest.mark.parametrize("text", ["2024-11-04T10:30:00+05:00", "2024-11-04T10:30:00Z", "2024-11-04 10:30:00"])
def test_offset_is_dropped(spark, text):
    parsed = parse_messages(messages(spark, message(event_timestamp=text)), "2024-11-04 12:00:00")
    assert rows(parsed.select("event_timestamp")) == [(at("2024-11-04T10:30:00"),)]


EMPTY = [f"{f} missing" for f in ("badge_id", "user_id", "zone_id", "reader_id", "event_timestamp")]


@pytest.mark.parametrize("line,rules", [
    (message(badge_id=...), ["badge_id missing"]),
    (message(user_id=None, zone_id=...), ["user_id missing", "zone_id missing"]),
    (message(reader_id="R" * 51), ["reader_id too long"]),
    (message(event_timestamp="yesterday"), ["event_timestamp not a timestamp"]),
    (message(event_timestamp=...), ["event_timestamp missing"]),
    (message(signal_strength="loud"), ["signal_strength not a number"]),
    (message(signal_strength=1000), ["signal_strength out of range"]),
    (message(direction="D" * 11), ["direction too long"]),
    (message(BADGE_ID="x", badge_id=...), ["badge_id missing"]),
    ("not json", EMPTY), (message() + message(), EMPTY), (message() + "," + message(), EMPTY), ("[" + message() + "]", EMPTY),
    (message() + " x", EMPTY), ("[]", EMPTY), ("7", EMPTY),
    (message(event_timestamp="2024"), ["event_timestamp not a timestamp"]),
    (message(event_timestamp="2011-01-10T10:30:00"), ["event_timestamp out of range"]),
    (message(event_timestamp="2024-02-01T00:00:01"), ["event_timestamp out of range"]),
])
def test_rejects(spark, line, rules):
    decoded = decode_messages(messages(spark, line, message()), AS_OF)
    assert shape_events(decoded).count() == 1
    assert rows(rejected_events(decoded).select("raw_json", "broken_rules")) == [(line, rules)]


def test_good_rows_break_no_rule_and_others_do(spark):
    """The filter of good rows and the list of rules say the same."""
    draw = random.Random(1)
    texts = [None, "", "x", "x" * 50, "x" * 51]
    moments = [None, "", "2024", "2024-01-10", "2024-01-10T10:00", "2024-13-01", "1999-01-01", "2030-01-01", "x", " 2024-01-10 "]
    signals = [None, "", "x", "-65.5", "999.4", "999.5", "-1000", "1e3", "NaN"]
    lines = [
        tuple(draw.choice(c) for c in (texts, texts, texts, texts, moments, signals, [None, "", "ß" * 6, "d" * 11])) for _ in range(600)
    ]
    lines += [("b", "u", "z", "r", m, s, None) for m in moments for s in signals]
    decoded = spark.createDataFrame(lines, schemas.MESSAGE).withColumns({
        "ingestion_time": F.lit(AS_OF).cast("timestamp_ntz"), "raw_json": F.lit("{}"),
    })
    free = decoded.where(F.size(broken_rules()) == 0)
    assert 0 < free.count() == shape_events(decoded).count()
    assert rejected_events(decoded).where(F.size("broken_rules") == 0).count() == 0
    assert rejected_events(decoded).count() + free.count() == len(lines)


def test_limits_are_inclusive(spark):
    line = message(reader_id="R" * 50, direction="d" * 10, signal_strength=-999)
    decoded = decode_messages(messages(spark, line), AS_OF)
    assert shape_events(decoded).count() == 1 and rejected_events(decoded).count() == 0


def test_message_is_parsed_once(spark):
    plan = parse_messages(messages(spark, message()), AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def test_sample_events(spark):
    events = sample.sample_events(spark.range(3).withColumnRenamed("id", "index"), 3, AS_OF)
    assert rows(events) == [
        ("BADGE-000", "USR-000", "ZONE-LOBBY-1", "RDR-100", "2024-01-30T23:59:54+00:00", -65.0, "ENTRY"),
        ("BADGE-001", "USR-001", "ZONE-LOBBY-1", "RDR-101", "2024-01-30T23:59:56+00:00", -64.0, "EXIT"),
        ("BADGE-002", "USR-002", "ZONE-LOBBY-1", "RDR-102", "2024-01-30T23:59:58+00:00", -63.0, "ENTRY"),
    ]


def test_sample_events_round_trip(spark, tmp_path):
    path = str(tmp_path / "lines")
    events = sample.sample_events(spark.range(20).withColumnRenamed("id", "index"), 20, AS_OF)
    sample.write_ndjson(events, path)
    parsed = parse_messages(read_messages(spark, path), AS_OF)
    assert parsed.count() == 20
    assert parsed.agg(F.min("signal_strength")).first()[0] == Decimal("-65.00")


def test_blank_lines_are_skipped(spark, tmp_path):
    (tmp_path / "a.json").write_text(message() + "\n\n  \n" + message(badge_id="B2") + "\n")
    assert read_messages(spark, str(tmp_path)).count() == 2


def test_seeds(spark):
    users, zones = seeds.seed_users(spark, AS_OF), seeds.seed_zones(spark, AS_OF)
    assert [r.user_key for r in users.orderBy("user_id").collect()] == [1, 2, 3, 4, 5]
    assert {r.user_name: r.clearance_level for r in users.collect()}["Alice Williams"] == "SECRET"
    assert users.where("is_active AND is_current AND effective_end_date IS NULL").count() == 5
    assert [r.zone_id for r in zones.where("is_restricted").orderBy("zone_key").collect()] == [
        "ZONE-OFFICE-2A", "ZONE-SERVER-B1"
    ]
    assert zones.where("is_monitored").count() == 5
    assert seeds.empty_readers(spark).count() == 0
