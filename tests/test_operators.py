import datetime as dt
import random
from collections import Counter

import pytest
from badgeflow import schemas
from badgeflow.functions.clock import seconds_between
from badgeflow.functions.keys import event_key, with_dense_keys
from badgeflow.operators import facts, feed, staging, users
from badgeflow.plans import quality
from badgeflow.sources.seeds import fill_columns, reader_defaults, seed_users, seed_zones, zone_defaults
from helpers import AS_OF, at, raw, raw_row, rows, staged
from pyspark.sql import functions as F


def test_seconds_count_boundaries(spark):
    pairs = [("2024-01-01T00:00:00.900000", "2024-01-01T00:00:02.100000", 2),
             ("2024-01-01T00:00:00.100000", "2024-01-01T00:00:00.900000", 0),
             ("2024-01-01T00:00:02", "2024-01-01T00:00:00.999999", -2),
             ("1969-12-31T23:59:59.500000", "1970-01-01T00:00:00", 1)]
    df = spark.createDataFrame([(at(a), at(b), n) for a, b, n in pairs], "a timestamp_ntz, b timestamp_ntz, n int")
    assert df.where(seconds_between(F.col("a"), F.col("b")) != F.col("n")).count() == 0


@pytest.mark.parametrize("when,hour,day,after,weekend", [
    ("2024-01-06T05:59:00", 5, 6, True, True), ("2024-01-07T06:00:00", 6, 0, False, True),
    ("2024-01-08T21:59:59", 21, 1, False, False), ("2024-01-12T22:00:00", 22, 5, True, False),
])
def test_time_parts(spark, when, hour, day, after, weekend):
    row = facts.with_time_parts(raw(spark, raw_row(when=when))).first()
    assert (row.event_date.isoformat(), row.event_hour, row.event_day_of_week) == (when[:10], hour, day)
    assert (row.is_after_hours, row.is_weekend) == (after, weekend)


def test_latest_wins_and_ties_repeat(spark):
    lines = [raw_row(arrived="2024-01-10T10:00:01", direction="EXIT"), raw_row(arrived="2024-01-10T10:00:05"),
             raw_row(badge="B2", direction="ENTRY"), raw_row(badge="B2", direction="EXIT")]
    outcomes = set()
    for _ in range(4):
        random.shuffle(lines)
        kept = staging.stage(raw(spark, *lines).repartition(3), AS_OF).orderBy("badge_id")
        outcomes.add(tuple(rows(kept.select("badge_id", "direction", "ingestion_time", "staging_time"))))
    assert outcomes == {(
        ("B1", "ENTRY", at("2024-01-10T10:00:05"), at("2024-01-31T00:00:00")),
        ("B2", "EXIT", at("2024-01-10T10:00:00"), at("2024-01-31T00:00:00")),
    )}


def test_only_inserts_are_staged(spark):
    changes = raw(spark, raw_row(), raw_row(badge="B2")).withColumns({
        "change_action": F.when(F.col("badge_id") == "B1", feed.INSERT).otherwise(feed.DELETE), "is_update": F.lit(False)})
    assert [r.badge_id for r in staging.stage(changes, AS_OF).collect()] == ["B1"]


@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_table_changes_against_counting(spark, buckets):
    draw = random.Random(buckets)

    def row():
        return (draw.choice([None, *range(30)]), draw.choice("xy"), draw.choice([None, "a", "b"]), draw.choice([None, 1.5, 2.0]))

    old = [row() for _ in range(120)]
    new = [r for r in old if draw.random() < 0.8] + [row() for _ in range(30)] + old[:3]
    schema = "k1 long, k2 string, v string, change_number double"
    before, after = (spark.createDataFrame(rows_, schema).repartition(4) for rows_ in (old, new))
    found = Counter(tuple(r) for r in feed.table_changes(before, after, ["k1", "k2"], buckets).collect())
    gone, came = Counter(old) - Counter(new), Counter(new) - Counter(old)
    both = {r[:2] for r in gone} & {r[:2] for r in came}
    want = Counter()
    for action, changed in ((feed.INSERT, came), (feed.DELETE, gone)):
        for r, n in changed.items():
            want[(*r, action, r[:2] in both)] += n
    assert found == want and both
    assert feed.table_changes(after, after.repartition(3), ["k1", "k2"], buckets).count() == 0
    assert feed.table_changes(before.limit(0), before, ["k1"], buckets).count() == len(old)


def test_only_buckets_that_differ_are_compared(spark):
    before = spark.range(2000).selectExpr("id", "id % 7 AS v")
    after = before.where("id <> 5").unionByName(spark.createDataFrame([(5, 100)], "id long, v long"))
    spread = [d.selectExpr("struct(*) AS _row", "cast(pmod(xxhash64(id), 64) AS int) AS _bucket") for d in (before, after)]
    assert feed.changed_buckets(*spread).count() == 1
    found = feed.table_changes(before, after, ["id"], 64)
    assert sorted(rows(found)) == [(5, 5, "DELETE", True), (5, 100, "INSERT", True)]


def test_retention_edge(spark):
    kept = staging.retained(staged(
        spark, raw_row(badge="in", arrived="2024-01-30T00:00:00"),
        raw_row(badge="out", arrived="2024-01-29T23:59:59.999999")), AS_OF)
    assert [r.badge_id for r in kept.collect()] == ["in"]


def test_first_wins_and_known_keys_go(spark):
    lines = [raw_row(arrived=f"2024-01-10T10:{m:02d}:00", reader=f"R{m}") for m in range(59, -1, -1)] + [raw_row(badge="B2")]
    firsts = staging.first_per_key(raw(spark, *lines))
    assert sorted((r.badge_id, r.reader_id) for r in firsts.collect()) == [("B1", "R0"), ("B2", "RDR-1")]
    left = staging.without_known(firsts, firsts, raw(spark, raw_row(badge="B2"), raw_row(badge="B9")))
    assert [r.badge_id for r in left.collect()] == ["B1"]


def test_latest_rows(spark):
    lines = [raw_row(when=f"2024-01-10T10:00:{s:02d}") for s in range(15)] + [raw_row(badge="B2")]
    found = staging.latest_rows(raw(spark, *lines), "B1")
    assert [r.event_timestamp.second for r in found.collect()] == list(range(14, 4, -1))
    late = raw_row(badge="B2", arrived="2024-01-11T00:00:00")
    assert [r.badge_id for r in staging.latest_rows(raw(spark, *lines, late), rows=2).collect()] == ["B2", "B1"]


def test_dense_keys(spark):
    ids = spark.range(10_000).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("user_id"))
    keys = with_dense_keys(ids.repartition(7), "user_id", "k", F.lit(5))
    assert sorted(r.k for r in keys.collect()) == list(range(6, 10_006))
    again = with_dense_keys(ids.repartition(3), "user_id", "k", F.lit(5))
    assert keys.exceptAll(again).count() == 0


def test_event_keys_are_distinct(spark):
    moments = spark.range(50_000).select(
        F.concat(F.lit("B"), (F.col("id") % 50).cast("string")).alias("b"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=F.floor(F.col("id") / 50))).alias("t"))
    keyed = moments.select(event_key(F.col("b"), F.col("t")).alias("k"))
    assert keyed.distinct().count() == 50_000
    assert keyed.agg(F.min("k")).first()[0] >= 0


def test_unknown_users_are_added(spark):
    seeded = seed_users(spark, AS_OF)
    lines = [raw_row(user="USR-001"), raw_row(badge="B2", user="USR-000"), raw_row(badge="B3", user="USR-000")]
    added = users.new_users(staged(spark, *lines), seeded, AS_OF)
    row = added.first()
    assert added.count() == 1 and added.columns == schemas.USERS.fieldNames()
    assert (row.user_key, row.user_id, row.user_name, row.clearance_level, row.is_current) == (
        6, "USR-000", "UNKNOWN", "PUBLIC", True)
    merged = users.merge_users(staged(spark, *lines), seeded, AS_OF)
    assert merged.count() == 6
    assert users.new_users(staged(spark, *lines), merged, AS_OF).count() == 0


def test_user_with_closed_rows_only_is_added_again(spark):
    closed = seed_users(spark, AS_OF).withColumn("is_current", F.col("user_id") != "USR-001")
    added = users.new_users(staged(spark, raw_row(user="USR-001")), closed, AS_OF)
    assert rows(added.select("user_id", "user_key")) == [("USR-001", 6)]


CHANGES = "user_id string, changed_at timestamp_ntz, department string"


def test_type_2_changes(spark):
    changes = spark.createDataFrame([
        ("USR-001", at("2024-02-01T00:00:00"), "Sales"), ("USR-001", at("2024-02-02T00:00:00"), "Legal"),
        ("USR-001", at("2024-02-02T12:00:00"), "Legal"), ("USR-001", None, "Lost"), (None, at("2024-02-01T00:00:00"), "Lost"),
        ("USR-002", at("2024-02-01T00:00:00"), "HR"), ("USR-777", at("2024-02-01T00:00:00"), "New"),
    ], CHANGES)
    after = users.apply_user_changes(seed_users(spark, AS_OF), changes, ["department"], "2024-02-03 00:00:00")
    assert after.count() == 8 and after.columns == schemas.USERS.fieldNames()
    versions = rows(after.where("user_id = 'USR-001'").orderBy("effective_start_date").select(
        "user_name", "department", "is_current", "effective_end_date"))
    assert versions == [
        ("John Smith", "Engineering", False, at("2024-02-01T00:00:00")), ("John Smith", "Sales", False, at("2024-02-02T00:00:00")),
        ("John Smith", "Legal", True, None)]
    assert after.where("is_current AND user_id = 'USR-002'").first().user_key == 2
    assert after.where("user_id = 'USR-777'").first().department == "New"
    assert sorted(r.user_key for r in after.collect()) == [1, 2, 3, 4, 5, 6, 7, 8]
    unchanged = users.apply_user_changes(after, changes, ["department"], AS_OF)
    assert unchanged.exceptAll(after).count() == 0 and unchanged.count() == 8


def test_a_late_change_splits_a_closed_version(spark):
    def applied(dimension, *changes):
        given = spark.createDataFrame([("USR-001", at(f"2024-02-{d:02d}T00:00:00"), v) for d, v in changes], CHANGES)
        after = users.apply_user_changes(dimension, given, ["department"], AS_OF).where("user_id = 'USR-001'")
        return spark.createDataFrame(after.collect(), after.schema)

    def versions(dimension):
        found = [(r.effective_start_date.day, r.effective_end_date and r.effective_end_date.day, r.department, r.user_key)
                 for r in dimension.collect()]
        return sorted(found, key=lambda v: (v[0], v[1] or 99))

    one = applied(seed_users(spark, "2024-02-01 00:00:00"), (10, "B"))
    assert versions(one) == [(1, 10, "Engineering", 1), (10, None, "B", 6)]
    split = applied(one, (5, "C"), (7, "Engineering"))
    assert [v[:3] for v in versions(split)] == [(1, 5, "Engineering"), (5, 7, "C"), (7, 10, "Engineering"), (10, None, "B")]
    # equal to the next version: that one starts earlier, under its key
    assert versions(applied(one, (5, "B"))) == [(1, 5, "Engineering", 1), (5, None, "B", 6)]
    # equal to the version before: nothing changes
    assert versions(applied(one, (5, "Engineering"))) == versions(one)
    # all of a version's time is taken: its row stays, with an empty interval
    taken = applied(one, (10, "D"))
    assert versions(taken) == [(1, 10, "Engineering", 1), (10, 10, "B", 6), (10, None, "D", 7)]
    assert versions(applied(taken, (12, "E"))) == [
        (1, 10, "Engineering", 1), (10, 10, "B", 6), (10, 12, "D", 7), (12, None, "E", 8)]


def test_type_2_changes_against_a_timeline(spark):
    """Two loads out of order: what holds at each time is what a plain timeline says."""
    draw = random.Random(11)
    ids, hours = [f"U{n}" for n in range(12)], list(range(1, 60))

    def load(n):
        return [(draw.choice(ids), at("2024-02-01T00:00:00") + dt.timedelta(hours=draw.choice(hours)), draw.choice("ABC")) for _ in range(n)]

    def as_rows(dimension):
        return [(r.user_key, r.user_id, r.effective_start_date, r.effective_end_date, r.department, r.is_current, r.user_name) for r in dimension.collect()]

    base = fill_columns(
        spark.createDataFrame([(i + 1, u, f"name {u}", "A") for i, u in enumerate(ids[:9])], "user_key bigint, user_id string, user_name string, department string"),
        schemas.USERS, users.user_defaults("2024-02-02 00:00:00"))
    base = spark.createDataFrame(base.collect(), base.schema)
    keys = set()
    for n in (40, 40, 25):
        changes = load(n)
        told = {}  # a change that only repeats what holds leaves no trace for later loads
        for r in base.where("effective_end_date IS NULL OR effective_end_date > effective_start_date").collect():
            told.setdefault(r.user_id, {})[r.effective_start_date] = r.department
        after = users.apply_user_changes(base, spark.createDataFrame(changes, CHANGES).repartition(5), ["department"], "2024-03-01 00:00:00")
        base = spark.createDataFrame(after.collect(), after.schema)
        newest = {}
        for u, t, v in changes:
            newest[u, t] = max(newest.get((u, t), v), v)
        for (u, t), v in newest.items():
            told.setdefault(u, {})[t] = v
        found = as_rows(base)
        assert keys <= {r[0] for r in found} and len({r[0] for r in found}) == len(found)
        keys = {r[0] for r in found}
        for u, timeline in told.items():
            lasting = sorted((r for r in found if r[1] == u and r[2] != r[3]), key=lambda r: r[2])
            assert all(a[3] == b[2] for a, b in zip(lasting, lasting[1:])) and lasting[-1][3] is None
            assert [r[5] for r in lasting] == [False] * (len(lasting) - 1) + [True]
            for h in hours:
                t = at("2024-02-01T00:00:00") + dt.timedelta(hours=h)
                want = [timeline[k] for k in sorted(timeline) if k <= t][-1:]
                assert [r[4] for r in lasting if r[2] <= t and (r[3] is None or t < r[3])] == want
            assert u not in ids[:9] or {r[6] for r in lasting} == {f"name {u}"}


def test_enrich(spark):
    seeded, zones = seed_users(spark, AS_OF), seed_zones(spark, AS_OF)
    lines = staged(
        spark,
        raw_row(badge="B1", zone="ZONE-SERVER-B1"),
        raw_row(badge="B2", zone="ZONE-NOWHERE"),
        raw_row(badge="B3", arrived="2024-01-10T10:00:01"),
        raw_row(badge="B3", arrived="2024-01-10T10:00:09", zone="ZONE-NOWHERE"),
        raw_row(badge="B4", arrived="2024-01-10T10:00:01", direction="ENTRY"),
        raw_row(badge="B4", arrived="2024-01-10T10:00:02", direction="EXIT"),
    )
    made = facts.enrich(lines, seeded, zones, None, AS_OF)
    assert made.schema.simpleString() == schemas.FACT.simpleString()
    assert rows(made.orderBy("badge_id").select("badge_id", "user_key", "zone_key", "direction", "is_restricted_access")) == [
        ("B1", 1, 3, "ENTRY", True), ("B3", 1, 1, "ENTRY", False), ("B4", 1, 1, "EXIT", False)]
    assert [r.badge_id for r in facts.unmapped_zones(lines, zones).orderBy("badge_id").collect()] == ["B2", "B3"]
    # what is loaded stays, even when a newer copy arrives
    newer = staged(spark, raw_row(badge="B1", arrived="2024-01-11T00:00:00", direction="EXIT"), raw_row(badge="B5"))
    assert [r.badge_id for r in facts.enrich(newer, seeded, zones, made, AS_OF).collect()] == ["B5"]


def test_fact_takes_the_current_version(spark):
    changes = spark.createDataFrame([("USR-001", at("2024-02-01T00:00:00"), "Sales")],
                                    "user_id string, changed_at timestamp_ntz, department string")
    versions = users.apply_user_changes(seed_users(spark, AS_OF), changes, ["department"], AS_OF)
    made = facts.enrich(staged(spark, raw_row()), versions, seed_zones(spark, AS_OF), None, AS_OF)
    assert [r.user_key for r in made.collect()] == [6]


def test_hot_copies_against_counting(spark):
    """A third of all rows are copies of one key, another third belong to one badge."""
    draw = random.Random(7)
    lines = [raw_row(badge="HOT", arrived=f"2024-01-10T10:{draw.randrange(60):02d}:00", reader=f"R{n}") for n in range(300)]
    lines += [raw_row(badge="BUSY", when=f"2024-01-11T{n % 24:02d}:{n % 60:02d}:00") for n in range(300)]
    lines += [raw_row(badge=f"B{draw.randrange(200)}") for _ in range(300)]
    kept = staging.stage(raw(spark, *lines).repartition(8), AS_OF)
    newest = {}
    for line in lines:
        key = (line[0], line[4])
        newest[key] = max(newest.get(key, line[8]), line[8])
    assert {(r.badge_id, r.event_timestamp): r.ingestion_time for r in kept.collect()} == newest


def test_quality_checks(spark):
    twice = staged(spark, raw_row(), raw_row(arrived="2024-01-11T00:00:00"), raw_row(badge="B2"))
    assert rows(quality.staging_duplicates(twice)) == [(at("2024-01-10T10:00:00"), "B1", 2)]
    zones, seeded = seed_zones(spark, AS_OF), seed_users(spark, AS_OF)
    repeated = quality.dimension_duplicates(
        seeded.unionByName(seeded.where("user_key = 1")), zones.unionByName(zones.where("zone_key = 2")),
        spark.createDataFrame([("R1",), ("R1",), ("R2",)], "reader_id string"))
    assert Counter(rows(repeated)) == Counter(
        [("DIM_USERS", "USR-001", 2), ("DIM_ZONES", "ZONE-OFFICE-2A", 2), ("DIM_READERS", "R1", 2)])
    made = facts.enrich(staged(spark, raw_row(), raw_row(badge="B2")), seeded, zones, None, AS_OF)
    orphans = quality.orphan_keys(made, seeded.where("user_key > 1"), zones)
    assert rows(orphans) == [("user_key", 1, 2)]


def test_defaults_on_insert(spark):
    given = spark.createDataFrame([(1, "R1")], "reader_key bigint, reader_id string")
    reader = fill_columns(given, schemas.READERS, reader_defaults(AS_OF)).first()
    assert reader.is_online and reader.created_timestamp == at("2024-01-31T00:00:00") and reader.model is None
    given = spark.createDataFrame([("Z1", True)], "zone_id string, is_restricted boolean")
    zone = fill_columns(given, schemas.ZONES, zone_defaults(AS_OF)).first()
    assert zone.is_restricted and zone.is_monitored and zone.zone_key is None
