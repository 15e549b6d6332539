import glob

import pytest
from badgeflow.operators.facts import enrich
from badgeflow import schemas
from badgeflow.operators.staging import stage
from badgeflow.plans import pipeline, views
from badgeflow.plans import validation as v
from badgeflow.plans.quality import orphan_keys, staging_duplicates
from badgeflow.sources import files
from badgeflow.sources.messages import parse_messages
from badgeflow.sources.seeds import seed_users, seed_zones
from badgeflow.sources.tables import with_file
from badgeflow.streaming import changes, ingest, live
from helpers import AS_OF, at, message, raw, raw_row, rows
from pyspark.sql import functions as F

STAGED = "2024-01-31 00:01:00"


def follow(spark, layout, handle=None, **options):
    handle = handle or changes.batch_handler(layout, AS_OF, STAGED, STAGED)
    query = changes.follow_raw(spark, layout, handle=handle, **options)
    query.awaitTermination()
    return query


def event(n, **other):
    return raw_row(badge=f"B{n % 7}", when=f"2024-01-{n % 5 + 10}T10:{n:02d}:00", user=f"USR-{n % 9:03d}", **other)


def test_ingest_keeps_every_line(spark, layout, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    bad = [message(badge_id=...), message(badge_id="B8") + message(badge_id="B9"), "junk"]
    (folder / "a.json").write_text("\n".join([message(), *bad]) + "\n")
    ingest.ingest(spark, str(folder), layout, AS_OF).awaitTermination()
    (folder / "b.json").write_text(message(badge_id="B2") + "\n")
    ingest.ingest(spark, str(folder), layout, AS_OF).awaitTermination()
    loaded = layout.raw(spark)
    assert sorted(r.badge_id for r in loaded.collect()) == ["B2", "BADGE-001"]
    assert loaded.where(F.col("message_bytes") != F.octet_length("raw_json")).count() == 0
    rejects = layout.table(spark, "rejects")
    assert sorted(r.raw_json for r in rejects.collect()) == sorted(bad)
    assert rejects.where(F.size("broken_rules") == 0).count() == 0
    follow(spark, layout)
    assert layout.fact(spark).count() == 2
    assert layout.ingest_log(spark).first().num_rows_migrated == 2
    logged = layout.run_log(spark).orderBy("scheduled_time").collect()
    assert [(r.name, r.state, r.attempt) for r in logged] == [
        ("badge_stage_task", "SUCCEEDED", 1), ("badge_enrich_task", "SUCCEEDED", 1)]


def test_a_replayed_ingest_batch_replaces_itself(spark, layout):
    from badgeflow.sources.messages import decode_messages
    from helpers import messages

    for _ in range(2):
        ingest.write_messages(layout, decode_messages(messages(spark, message(), "junk"), AS_OF), "stream-a", 3)
    ingest.write_messages(layout, decode_messages(messages(spark, message()), AS_OF), "stream-b", 3)
    assert layout.raw(spark).count() == 2 and layout.table(spark, "rejects").count() == 1


def test_stream_equals_batch(spark, layout):
    everything = [event(n) for n in range(40)]
    for part in range(4):
        layout.append_raw(raw(spark, *everything[part::4]).coalesce(1))
    follow(spark, layout, max_files=3)
    batch = stage(raw(spark, *everything), STAGED)
    users = layout.users(spark)
    assert layout.staging(spark).select("batch_id").distinct().count() > 1
    assert layout.staging(spark).select(batch.columns).exceptAll(batch).count() == 0
    whole = enrich(batch, users, seed_zones(spark, AS_OF), None, STAGED)
    loaded = layout.fact(spark).select(whole.columns)
    assert loaded.exceptAll(whole).count() == 0 and loaded.count() == whole.count() == 40
    assert users.count() == 9 and users.select("user_key").distinct().count() == 9
    assert orphan_keys(loaded, users, layout.zones(spark)).count() == 0
    assert loaded.select("event_key").distinct().count() == 40


def test_empty_run_calls_no_batch(spark, layout):
    layout.append_raw(raw(spark, event(1)))
    follow(spark, layout)
    calls = []
    follow(spark, layout, handle=lambda batch, batch_id: calls.append(batch_id))
    assert calls == []


def test_later_copy_keeps_the_first_fact(spark, layout):
    layout.append_raw(raw(spark, raw_row(direction="ENTRY")))
    follow(spark, layout)
    layout.append_raw(raw(spark, raw_row(direction="EXIT", arrived="2024-01-12T00:00:00")))
    follow(spark, layout)
    assert [r.direction for r in layout.fact(spark).collect()] == ["ENTRY"]
    assert rows(staging_duplicates(layout.staging(spark)).select("row_count")) == [(2,)]


def test_replayed_batch_changes_nothing(spark, layout):
    first, second = raw(spark, *map(event, range(5))), raw(spark, *map(event, range(3, 20)))
    pipeline.process_batch(spark, layout, first, 0, AS_OF, STAGED, STAGED)
    pipeline.process_batch(spark, layout, second, 1, AS_OF, STAGED, STAGED)
    before = [rows(df.orderBy(*df.columns)) for df in (layout.users(spark), layout.staging(spark), layout.fact(spark))]
    assert pipeline.process_batch(spark, layout, second, 1, AS_OF, STAGED, STAGED) == "COMPLETED"
    after = [rows(df.orderBy(*df.columns)) for df in (layout.users(spark), layout.staging(spark), layout.fact(spark))]
    assert after == before


def test_replay_after_a_crash_between_users_and_facts(spark, layout):
    batch = raw(spark, *map(event, range(20)))
    staged = pipeline.stage_batch(spark, layout, batch, 0, STAGED)
    pipeline.merge_batch_users(spark, layout, staged, AS_OF)
    users = rows(layout.users(spark).orderBy("user_key"))
    pipeline.process_batch(spark, layout, batch, 0, AS_OF, STAGED, STAGED)
    assert rows(layout.users(spark).orderBy("user_key")) == users
    assert layout.fact(spark).count() == 20


def named(layout, spark):
    """Which user each fact names."""
    users = layout.users(spark).select("user_key", "user_id")
    return sorted(rows(layout.fact(spark).join(users, "user_key").select("badge_id", "event_timestamp", "user_id")))


def wanted(*lines):
    return sorted((r[0], r[4], r[1]) for r in lines)


def test_backfill_then_follow_keeps_users(spark, layout):
    old, new = list(map(event, range(20))), [event(n) for n in range(20, 40)]
    pipeline.process_batch(spark, layout, raw(spark, *old), 0, AS_OF, STAGED, STAGED)
    before = {r.user_id: r.user_key for r in layout.users(spark).collect()}
    layout.append_raw(raw(spark, *new))
    follow(spark, layout)
    assert named(layout, spark) == wanted(*old, *new)
    after = {r.user_id: r.user_key for r in layout.users(spark).collect()}
    assert before.items() <= after.items() and len(set(after.values())) == len(after)
    assert layout.staging(spark).count() == 40


def test_a_lost_checkpoint_changes_no_key(spark, layout):
    lines = [event(n, reader=f"R{n}") for n in range(30)]
    for part in range(3):
        layout.append_raw(raw(spark, *lines[part::3]).coalesce(1))
        follow(spark, layout)
    facts, users = named(layout, spark), rows(layout.users(spark).orderBy("user_key"))
    files.remove(spark, layout.checkpoint("changes"))
    follow(spark, layout)
    assert named(layout, spark) == facts == wanted(*lines)
    assert rows(layout.users(spark).orderBy("user_key")) == users
    assert layout.staging(spark).select("run").distinct().count() == 2  # the first run's batches are left alone


def test_every_attempt_is_logged(spark, layout):
    batch = raw(spark, event(1)).withColumn("message_bytes", F.lit(1))
    for lines in (batch.drop("zone_id"), batch):
        try:
            changes.batch_handler(layout, AS_OF)(lines, 0)
        except Exception:
            pass
    logged = layout.run_log(spark).orderBy("scheduled_time").collect()
    assert [(r.name, r.state, r.attempt) for r in logged] == [
        ("badge_stage_task", "FAILED", 1), ("badge_stage_task", "SUCCEEDED", 2), ("badge_enrich_task", "SUCCEEDED", 1)]
    assert logged[0].error_message


def pending(spark, layout):
    return v.pending_count(layout.unstaged(spark, with_file(layout.raw(spark)))).first().pending_count


def test_pending_counts_rows_of_files_not_taken(spark, layout):
    for part in range(4):
        layout.append_raw(raw(spark, *[event(n, arrived="2024-01-20T00:00:00") for n in range(part, 8, 4)]).coalesce(1))
    assert pending(spark, layout) == 8

    class Stop(Exception):
        pass

    taken = []

    def once(batch, batch_id):
        if taken:
            raise Stop
        taken.append(batch_id)
        changes.batch_handler(layout, AS_OF, STAGED, STAGED)(batch, batch_id)

    with pytest.raises(Exception):
        follow(spark, layout, handle=once, max_files=1)
    assert pending(spark, layout) == 6
    follow(spark, layout)
    assert pending(spark, layout) == 0
    layout.append_raw(raw(spark, event(9, arrived="2024-01-19T00:00:00")))  # older than what is staged
    assert pending(spark, layout) == 1


def test_closed_days_keep_their_rows_and_are_not_read_again(spark, layout):
    for n in range(4):
        layout.append_raw(raw(spark, event(n, arrived="2024-01-20T00:00:00")))
    with pytest.raises(RuntimeError):
        layout.close_day(spark, "raw", "2024-01-20")
    follow(spark, layout)
    everything = sorted(rows(layout.raw(spark).drop("run", "batch_id")))
    staging = sorted(rows(layout.staging(spark).drop("run", "batch_id")))
    for _ in range(2):
        layout.close_day(spark, "raw", "2024-01-20")
        layout.close_day(spark, "staging", "2024-01-31")
    folders = glob.glob(f"{layout.path('raw')}/ingestion_date=2024-01-20/run=*/batch_id=*")
    assert len(folders) == 1 and len(glob.glob(f"{folders[0]}/*.parquet")) == 1
    assert sorted(rows(layout.raw(spark).drop("run", "batch_id"))) == everything
    assert sorted(rows(layout.staging(spark).drop("run", "batch_id"))) == staging
    assert pending(spark, layout) == 0
    calls = []
    follow(spark, layout, handle=lambda batch, batch_id: calls.append(batch_id))
    assert calls == []
    layout.append_raw(raw(spark, event(7, arrived="2024-01-20T05:00:00")))
    follow(spark, layout)
    assert layout.fact(spark).count() == 5


def test_closing_goes_on_after_a_crash(spark, layout, monkeypatch):
    for n in range(3):
        pipeline.process_batch(spark, layout, raw(spark, event(n)), n, AS_OF, STAGED, STAGED)
    before = sorted(rows(layout.staging(spark).drop("run", "batch_id")))
    rename = files.rename
    monkeypatch.setattr(files, "rename", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        layout.close_day(spark, "staging", "2024-01-31")
    monkeypatch.setattr(files, "rename", rename)
    layout.close_day(spark, "staging", "2024-01-31")
    assert sorted(rows(layout.staging(spark).drop("run", "batch_id"))) == before


def test_fact_days_are_merged(spark, layout):
    for n in range(4):
        lines = [event(m) for m in range(n, 20, 4)]
        pipeline.process_batch(spark, layout, raw(spark, *lines), n, AS_OF, STAGED, f"2024-01-31 0{n // 2}:00:00")
    before = sorted(rows(layout.fact(spark)))
    for _ in range(2):
        for day in range(10, 15):
            layout.close_fact_day(spark, f"2024-01-{day}")
    assert sorted(rows(layout.fact(spark))) == before
    assert len(layout.fact(spark).inputFiles()) == 5
    pipeline.catch_up(spark, layout, STAGED)
    assert layout.fact(spark).count() == 20


def test_old_days_expire(spark, layout):
    for n, day in enumerate(("2024-01-29", "2024-01-30", "2024-01-31")):
        pipeline.process_batch(spark, layout, raw(spark, event(n)), n, AS_OF, f"{day} 00:01:00", STAGED)
    layout.expire(spark, "staging", "2024-01-31")
    assert [str(r.load_date) for r in layout.staging(spark).collect()] == ["2024-01-31"]
    assert layout.fact(spark).count() == 3


def test_a_batch_lists_its_own_folders_only(spark, layout):
    """What a batch reads of staging and logs does not grow with earlier batches."""
    for n in range(12):
        pipeline.process_batch(spark, layout, raw(spark, event(n)), n, AS_OF, STAGED, STAGED)
    own = layout.batch(spark, "staging", "by-hand", 11)
    assert len(own.inputFiles()) == 1 and own.count() == 1
    before = layout.users(spark).inputFiles()
    pipeline.process_batch(spark, layout, raw(spark, event(11)), 12, AS_OF, STAGED, STAGED)
    assert layout.users(spark).inputFiles() == before  # a batch without new users writes nothing
    layout.close_users(spark)
    assert len(layout.users(spark).inputFiles()) == 1
    layout.close_day(spark, "staging", "2024-01-31")
    assert len(layout.staging(spark).inputFiles()) == 1


def test_changed_users_are_stored_and_taken_by_later_loads(spark, layout):
    pipeline.process_batch(spark, layout, raw(spark, raw_row()), 0, AS_OF, STAGED, STAGED)
    change = spark.createDataFrame([("USR-001", at("2024-02-01T00:00:00"), "Sales")], "user_id string, changed_at timestamp_ntz, department string")
    pipeline.change_users(spark, layout, change, ["department"], AS_OF)
    pipeline.process_batch(spark, layout, raw(spark, raw_row(badge="B2")), 1, AS_OF, STAGED, STAGED)
    assert sorted((r.badge_id, r.user_key) for r in layout.fact(spark).collect()) == [("B1", 1), ("B2", 6)]
    assert layout.users(spark).where("user_key = 6").first().effective_start_date == at("2024-02-01T00:00:00")


def test_catch_up_loads_zones_added_later(spark, layout):
    pipeline.process_batch(spark, layout, raw(spark, event(1), event(2, zone="ZONE-NEW")), 0, AS_OF, STAGED, STAGED)
    assert layout.fact(spark).count() == 1
    added = seed_zones(spark, AS_OF).limit(1).withColumns(
        {"zone_key": F.lit(6).cast("bigint"), "zone_id": F.lit("ZONE-NEW")})
    added.write.mode("append").parquet(layout.path("dim_zones"))
    pipeline.catch_up(spark, layout, STAGED)
    pipeline.catch_up(spark, layout, STAGED)
    assert sorted(r.zone_key for r in layout.fact(spark).collect()) == [1, 6]


def test_enrichment_as_a_stream_of_its_own(spark, layout, tmp_path):
    """Staging goes on while the second task fails; a batch staged twice makes facts once."""
    from badgeflow.sources.tables import Layout

    deliveries = [raw(spark, *map(event, range(0, 12))), raw(spark, *[event(n, direction="EXIT") for n in range(6, 20)])]
    single = Layout(str(tmp_path / "single")).create(spark, AS_OF)
    stage_only = changes.batch_handler(layout, AS_OF, STAGED, enrich=False)
    for delivery in deliveries:
        single.append_raw(delivery)
        follow(spark, single)
        layout.append_raw(delivery)
        follow(spark, layout, stage_only)
    assert layout.fact(spark).count() == 0 and layout.staging(spark).count() == single.staging(spark).count()

    def enrich(handle):
        changes.follow_staged(spark, layout, handle=handle).awaitTermination()

    broken = changes.enrich_handler(layout, AS_OF, F.col("no_such_column"))
    with pytest.raises(Exception, match="no_such_column"):
        enrich(broken)
    first = layout.table(spark, "staging").select("run", "batch_id").distinct().orderBy("batch_id").first()
    layout.append_staged_batch(spark, first.run, first.batch_id, at("2024-03-01T00:00:00"))  # as after a crash of the first task
    enrich(changes.enrich_handler(layout, AS_OF, STAGED))
    loaded, want = (t.fact(spark).select("badge_id", "event_timestamp", "direction", "user_key", "zone_key") for t in (layout, single))
    assert loaded.exceptAll(want).count() == want.exceptAll(loaded).count() == 0 and loaded.count() == 20
    runs = layout.run_log(spark).where("name = 'badge_enrich_task' AND batch_id = 0").orderBy("attempt").collect()
    assert [(r.state, r.attempt) for r in runs] == [("FAILED", 1), ("SUCCEEDED", 2)]
    calls = []
    enrich(lambda markers, batch_id: calls.append(batch_id))
    assert calls == []


def days(df, column):
    return sorted(str(r[0]) for r in df.select(column).distinct().collect())


def test_sweep_keeps_what_is_still_needed(spark, layout):
    arrivals = ["2024-01-10", "2024-01-11", "2024-01-12", "2024-01-13"]
    lines = [raw_row(badge=f"B{d}", when=f"{d}T10:00:00", zone="ZONE-NEW" if d.endswith("11") else "ZONE-LOBBY-1") for d in arrivals]
    handle = changes.batch_handler(layout, AS_OF, F.col("ingestion_time"), F.col("ingestion_time"))
    layout.append_raw(raw(spark, *lines[:3]))
    follow(spark, layout, handle)
    layout.append_raw(raw(spark, lines[3], raw_row(badge="LATE", when="2024-01-10T11:00:00", arrived="2024-01-11T11:00:00")))
    # not staged yet: raw is held at the 11th; the row without a zone holds the staging there
    marks = pipeline.sweep(spark, layout, {"raw": "2024-01-13", "staging": "2024-01-13", "rejects": "2024-01-13"})
    assert marks == {"raw": "2024-01-11", "staging": "2024-01-11", "rejects": "2024-01-13"}
    assert days(layout.raw(spark), "ingestion_date") == arrivals[1:] and days(layout.staging(spark), "load_date") == arrivals[1:3]
    follow(spark, layout, handle)
    assert pipeline.sweep(spark, layout, {"raw": "2024-01-13"}) == {"raw": "2024-01-13"}
    assert days(layout.raw(spark), "ingestion_date") == arrivals[3:]
    added = seed_zones(spark, AS_OF).limit(1).withColumns({"zone_key": F.lit(6).cast("bigint"), "zone_id": F.lit("ZONE-NEW")})
    added.write.mode("append").parquet(layout.path("dim_zones"))
    pipeline.catch_up(spark, layout, STAGED)
    assert layout.fact(spark).count() == 5
    assert pipeline.sweep(spark, layout, {"staging": "2024-01-13"}) == {"staging": "2024-01-13"}
    assert days(layout.staging(spark), "load_date") == arrivals[3:]


def test_the_stream_sweeps_once_a_day(spark, layout):
    moments = iter(["2024-01-12T00:00:00"] * 5 + ["2024-01-14T00:00:00"] * 50)
    handle = changes.batch_handler(
        layout, AS_OF, F.col("ingestion_time"), F.col("ingestion_time"), clock=lambda: at(next(moments)), keep_days={"staging": 1})
    for day in ("10", "12", "13"):
        layout.append_raw(raw(spark, raw_row(badge=f"B{day}", when=f"2024-01-{day}T10:00:00")))
        follow(spark, layout, handle)
    assert days(layout.staging(spark), "load_date") == ["2024-01-13"]
    assert layout.fact(spark).count() == 3


def drained(spark, stream, folder):
    query = (stream.writeStream.format("parquet").option("path", f"{folder}/out")
             .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


def test_live_metrics(spark, layout, tmp_path):
    lines = [raw_row(badge=f"B{n}", arrived=f"2024-01-10T{10 + n // 30}:{n % 60:02d}:00", quality="WEAK") for n in range(90)]
    layout.append_raw(raw(spark, *lines))
    found = drained(spark, live.hourly_metrics(layout.raw_stream(spark)), tmp_path)
    # the last hour stays open: the watermark has not passed its end
    counts = {r.window_start.hour: r for r in found.collect()}
    assert set(counts) == {10, 11}
    assert counts[10].event_count == 30 and counts[10].weak_signal_count == 30
    assert abs(counts[10].approx_badges - 30) <= 3 and counts[10].approx_zones == 1
    assert counts[10].net_occupancy_change == 30


def arrivals(spark, layout, *deliveries):
    for lines in deliveries:
        raw(spark, *lines).coalesce(1).write.mode("append").parquet(layout.path("arriving"))
        stream = spark.readStream.schema(schemas.RAW).parquet(layout.path("arriving"))
        live.first_arrivals(spark, stream, layout).awaitTermination()
    return layout.table(spark, "first_events")


def test_the_first_of_a_hot_key_is_the_oldest(spark, layout):
    hot = [raw_row(arrived=f"2024-01-10T10:{n:02d}:00", reader=f"R{n}") for n in range(59, -1, -1)]
    found = arrivals(spark, layout, [*hot, *map(event, range(20))])
    assert found.count() == 21
    assert [r.reader_id for r in found.where("badge_id = 'B1' AND reader_id <> 'RDR-1'").collect()] == ["R0"]


def test_late_rows_are_kept_and_later_copies_are_not(spark, layout):
    late = raw_row(badge="C", arrived="2024-01-10T08:00:00")
    found = arrivals(
        spark, layout, [raw_row(badge="A", arrived="2024-01-20T00:00:00")],
        [raw_row(badge="B", arrived="2024-01-15T00:00:00"), raw_row(badge="A", arrived="2024-01-10T00:00:00")], [late])
    assert sorted((r.badge_id, r.ingestion_time.day) for r in found.collect()) == [("A", 20), ("B", 15), ("C", 10)]


def test_views_and_checks_by_name(spark, layout):
    layout.append_raw(raw(spark, *map(event, range(12))))
    follow(spark, layout)
    names = views.register(spark, layout, changes.DATABASE, as_of="2024-01-14 11:00:00")
    assert len(names) == 12
    for name in names:
        spark.table(name).collect()
    counts = spark.sql("SELECT sum(event_count) FROM V_INGESTION_METRICS").first()[0]
    assert counts == 2  # the last 24 hours hold minutes 4 and 9 of the 14th
    joined = spark.sql(
        "SELECT count(*) FROM FCT_ACCESS_EVENTS f JOIN DIM_USERS u ON f.user_key = u.user_key "
        "JOIN DIM_ZONES z ON f.zone_key = z.zone_key")
    assert joined.first()[0] == 12
    results = {n: rows(df) for n, df in views.run_checks(spark, layout, changes.DATABASE, "badge_%").items()}
    assert results["layer_row_counts"] == [("RAW Layer", 12), ("STAGING Layer", 12), ("ANALYTICS Layer", 12)]
    assert results["pending_status"][0][1] == "false"
    assert [r[1] for r in results["recent_runs"]] == ["SUCCEEDED"] * 2
    assert results["staging_duplicates"] == results["dimension_duplicates"] == results["orphan_keys"] == []


def test_a_batch_append_next_to_a_stream_is_followed(spark, layout, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(message() + "\n")
    ingest.ingest(spark, str(tmp_path / "in"), layout, AS_OF).awaitTermination()
    layout.append_raw(raw(spark, event(1)))
    follow(spark, layout)
    assert layout.raw(spark).count() == layout.fact(spark).count() == 2
