"""Sinks, table entries and whole runs on a small lake of hand-written files."""

import json
import os
import random
import shutil
import uuid
from collections import Counter, defaultdict
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from telemetry_lake import Lake, configure, create_tables, sinks, sources
from telemetry_lake import operators as ops
from telemetry_lake import storage
from telemetry_lake.journal import Journal
from telemetry_lake.lake import DEVICES, MARK_LOG, PIPELINE_RUNS, QUARANTINED, RAW_READINGS, READINGS, drop_partitions
from telemetry_lake.operators import gate
from telemetry_lake.plans import coverage, due_dates, due_groups, ingest, refresh, run
from telemetry_lake.plans.ingest import move_mark
from telemetry_lake.schemas import CLEAN, GROUPS, KPI_COLUMNS
from telemetry_lake.session import size_shuffles
from telemetry_lake.sinks import readings
from telemetry_lake.sinks.results import LOG_FILES, REPLACED


@pytest.fixture
def lake(spark, tmp_path):
    configure(spark)
    lake = Lake(str(tmp_path / "lake"), f"lake_{uuid.uuid4().hex}")
    create_tables(spark, lake)
    yield lake
    spark.sql(f"DROP DATABASE {lake.database} CASCADE")


def reading(device, hour, day="2026-01-01", kind="motor", **fields):
    row = {"device_id": device, "device_type": kind, "facility_id": "F", "zone": "z", "battery_pct": 50.5}
    return row | {"timestamp": f"{day}T{hour}:00:00+00:00", "status_code": "OK", "firmware_version": "1"} | fields


def put_raw(lake, rows, day, hour, name="batch.jsonl"):
    folder = Path(lake.path(RAW_READINGS)) / f"dt={day}" / f"hour={hour}"
    folder.mkdir(parents=True, exist_ok=True)
    text = "".join((row if isinstance(row, str) else json.dumps(row)) + "\n" for row in rows)
    (folder / name).write_text(text)


def two_hours(lake):
    put_raw(
        lake,
        [
            reading("m1", "00", vibration_mm_s=1.5, rpm=900),
            reading("m2", "00", vibration_mm_s=999999, rpm=900),
            reading("m3", "00", vibration_mm_s=None, rpm=900),
            reading("h1", "00", kind="hvac_unit", temperature_c=20.25, humidity_pct="40"),
            "not json",
        ],
        "2026-01-01",
        "00",
    )
    put_raw(
        lake,
        [reading("m1", "01", vibration_mm_s=2.5, rpm=900), *[reading("m2", "01", vibration_mm_s=2, rpm=900)] * 2],
        "2026-01-01",
        "01",
    )


def keys(df, *columns):
    return sorted(tuple(str(v) for v in row) for row in df.select(*columns).collect())


DAY = {"start_date": "2026-01-01", "end_date": "2026-01-01"}
GROUP = [{"dt": "2026-01-01", "hours": []}]


@pytest.mark.parametrize("blocks", [gate.FILTER_BLOCKS, 1])
def test_run_is_repeatable(spark, lake, blocks):
    two_hours(lake)
    for _ in range(2):
        result = run(spark, lake, backfill=DAY, filter_blocks=blocks)
        assert (result.loaded_until, result.aggregated_until) == ("2026-01-01T01", "2026-01-01")
        assert keys(spark.table(lake.table(READINGS)), "device_id", "hour") == [
            ("h1", "00"),
            ("m1", "00"),
            ("m1", "01"),
            ("m3", "00"),
        ]
        assert keys(spark.table(lake.table(QUARANTINED)), "device_id", "hour") == [
            ("None", "00"),
            ("m2", "00"),
            ("m2", "01"),
            ("m2", "01"),
        ]
        motor = spark.table(lake.table("daily_motor_vibration_trend"))
        assert keys(motor, "dt", "device_id", "avg_vibration_mm_s", "max_vibration_mm_s", "reading_count") == [
            ("2026-01-01", "m1", "2.00", "2.50", "2"),
            ("2026-01-01", "m3", "None", "None", "1"),
        ]
        health = spark.table(lake.table("daily_device_health_summary"))
        assert keys(health, "device_type", "clean_reading_count", "quarantined_reading_count", "dq_failure_rate_pct") == [
            ("None", "0", "1", "100.00"),
            ("hvac_unit", "1", "0", "0.00"),
            ("motor", "3", "3", "50.00"),
        ]
        assert health.agg(F.sum("total_reading_count")).first()[0] == 8
    hvac = spark.table(lake.table("daily_hvac_stability")).first()
    assert hvac.stddev_temperature_c is None and str(hvac.avg_temperature_c) == "20.25"
    audit = spark.table(lake.table(PIPELINE_RUNS))
    assert keys(audit, "target_date", "hours_processed", "records_clean", "records_quarantined") == [
        ("2026-01-01", "ALL", "4", "4")
    ] * 2
    assert spark.table(lake.table(MARK_LOG)).count() == 2


def test_quarantine_keeps_the_time_text(spark, lake):
    put_raw(lake, [reading("m1", "00", battery_pct=None), reading("m2", "00") | {"timestamp": "nope"}], "2026-01-01", "00")
    ingest(spark, lake, GROUP)
    bad = sources.read_quarantine(spark, lake.path(QUARANTINED))
    assert keys(bad, "device_id", "timestamp", "event_ts", "hour") == [
        ("m1", "2026-01-01T00:00:00+00:00", "2026-01-01T00:00:00.000Z", "00"),
        ("m2", "nope", "None", "00"),
    ]


def test_rerun_drops_partitions_that_went_empty(spark, lake):
    put_raw(lake, [reading("m1", "00", rpm=1)], "2026-01-01", "00")
    ingest(spark, lake, GROUP)
    assert spark.table(lake.table(QUARANTINED)).count() == 1
    put_raw(lake, [reading("m1", "00", rpm=1000)], "2026-01-01", "00")
    ingest(spark, lake, GROUP)
    assert spark.table(lake.table(QUARANTINED)).isEmpty()
    assert sources.read_quarantine(spark, lake.path(QUARANTINED)).isEmpty()
    assert keys(sources.read_clean(spark, lake.path(READINGS)), "device_id", "hour") == [("m1", "00")]


def test_stale_partitions_stay_without_pruning(spark, lake):
    put_raw(lake, [reading("m1", "00", rpm=1)], "2026-01-01", "00")
    ingest(spark, lake, GROUP)
    put_raw(lake, [reading("m1", "00", rpm=1000)], "2026-01-01", "00")
    ingest(spark, lake, GROUP, prune_stale=False)
    assert spark.table(lake.table(QUARANTINED)).count() == 1


def test_other_hours_are_left_alone(spark, lake):
    two_hours(lake)
    ingest(spark, lake, GROUP)
    before = keys(spark.table(lake.table(READINGS)).where("hour = '00'"), "device_id")
    put_raw(lake, [reading("m9", "01", rpm=1000)], "2026-01-01", "01")
    ingest(spark, lake, [{"dt": "2026-01-01", "hours": ["01"]}])
    table = spark.table(lake.table(READINGS))
    assert keys(table.where("hour = '00'"), "device_id") == before
    assert keys(table.where("hour = '01'"), "device_id") == [("m9",)]


def test_nothing_found_leaves_no_trace(spark, lake):
    assert ingest(spark, lake, GROUP) is None
    assert sources.read_raw(spark, lake.path(RAW_READINGS), GROUP).isEmpty()
    assert sources.read_raw(spark, lake.path("absent")).isEmpty()
    put_raw(lake, [reading("m1", "00")], "2026-01-05", "00")
    assert ingest(spark, lake, GROUP) is None
    for table in (READINGS, QUARANTINED, PIPELINE_RUNS, MARK_LOG):
        assert spark.table(lake.table(table)).isEmpty()


def test_overlapping_groups_read_a_file_once(spark, lake):
    two_hours(lake)
    raw = sources.read_raw(spark, lake.path(RAW_READINGS), [{"dt": "2026-01-01", "hours": ["00"]}, *GROUP, *GROUP])
    assert raw.count() == 8
    assert sources.read_raw(spark, lake.path(RAW_READINGS)).count() == 8
    assert sources.read_raw(spark, lake.path(RAW_READINGS), [{"dt": "2026-01-01", "hours": ["01", "02"]}]).count() == 3
    assert sources.read_raw(spark, lake.path(RAW_READINGS), []).isEmpty()


def test_scheduled_runs_follow_the_marks(spark, lake):
    for day, hour in (("2026-01-01", "22"), ("2026-01-01", "23"), ("2026-01-02", "00")):
        put_raw(lake, [reading("m1", hour, day, vibration_mm_s=1.0)], day, hour)
    first = run(spark, lake, now=datetime(2026, 1, 2, 0, 30))
    assert first.loaded_until == "2026-01-01T23" and first.dates == ("2026-01-01", "2026-01-01")
    second = run(spark, lake, now=datetime(2026, 1, 2, 1, 30))
    assert second.groups == [{"dt": "2026-01-02", "hours": ["00"]}]
    assert second.loaded_until == "2026-01-02T00" and second.dates is None
    third = run(spark, lake, now=datetime(2026, 1, 2, 1, 45))
    assert third.groups == [] and third.dates is None
    backfilled = run(spark, lake, backfill=DAY, now=datetime(2026, 1, 2, 1, 50))
    assert backfilled.loaded_until == "2026-01-01T23"
    assert due_groups(spark, lake, None, datetime(2026, 1, 2, 1, 59)) == []


def test_kpi_stage_runs_although_ingest_is_caught_up(spark, lake):
    put_raw(lake, [reading("m1", "23", vibration_mm_s=1.0)], "2026-01-01", "23")
    assert run(spark, lake, "ingest_only", now=datetime(2026, 1, 2, 0, 5)).dates is None
    result = run(spark, lake, now=datetime(2026, 1, 2, 0, 10))
    assert result.groups == [] and result.aggregated_until == "2026-01-01"
    assert due_dates(spark, lake, None, datetime(2026, 1, 2, 0, 10)) is None


def test_modes_and_ranges_are_checked_first(spark, lake):
    with pytest.raises(ValueError, match="unknown mode"):
        run(spark, lake, "everything")
    with pytest.raises(ValueError, match="before start_date"):
        run(spark, lake, backfill={"start_date": "2026-01-02", "end_date": "2026-01-01"})
    assert run(spark, lake, "kpi_only", backfill=DAY).aggregated_until is None
    assert spark.table(lake.table(MARK_LOG)).isEmpty()


def test_range_replace_drops_dates_without_rows(spark, lake):
    table = "daily_cold_storage_risk"
    row = "'c1' device_id, 'F' facility_id, {v} avg_temperature_c, 1L total_door_open_count, 1L reading_count"
    days = [spark.sql(f"SELECT date'2026-01-0{d}' dt, {row.format(v=d)}") for d in (1, 2, 3, 4)]
    old = days[0].union(days[1]).union(days[2]).union(days[3])
    sinks.range_replace(spark, lake, table, old, "2026-01-01", "2026-01-04")
    new = spark.sql(f"SELECT date'2026-01-03' dt, {row.format(v=9)}")
    for _ in range(2):
        sinks.range_replace(spark, lake, table, new, "2026-01-02", "2026-01-03")
        assert keys(spark.table(lake.table(table)), "dt", "avg_temperature_c") == [
            ("2026-01-01", "1.00"),
            ("2026-01-03", "9.00"),
            ("2026-01-04", "4.00"),
        ]
    sinks.range_replace(spark, lake, table, new.limit(0), "2026-01-01", "2026-01-04")
    assert spark.table(lake.table(table)).isEmpty()


def test_refresh_removes_kpi_rows_of_a_date_that_lost_its_readings(spark, lake):
    two_hours(lake)
    run(spark, lake, backfill=DAY)
    for table in (READINGS, QUARANTINED):
        drop_partitions(spark, lake, table, [{"dt": "2026-01-01", "hour": h} for h in ("00", "01")])
    assert refresh(spark, lake, "2026-01-01", "2026-01-01") is None
    for table in KPI_COLUMNS:
        assert spark.table(lake.table(table)).isEmpty()


def test_tables_are_found_again_by_a_new_catalog(spark, lake):
    two_hours(lake)
    run(spark, lake, backfill=DAY)
    again = Lake(lake.root, lake.database + "_again")
    create_tables(spark, again)
    for table in (READINGS, QUARANTINED, PIPELINE_RUNS, MARK_LOG, *KPI_COLUMNS):
        assert spark.table(again.table(table)).count() == spark.table(lake.table(table)).count()
    spark.sql(f"DROP DATABASE {again.database} CASCADE")


def landed(spark, lake):
    return keys(spark.table(lake.table(RAW_READINGS)), "device_id", "dt", "hour")


def test_batches_do_not_touch_each_other(spark, lake):
    """A, then B with a straggler of A's hour and an unreadable time, then C, then A again."""
    noon = datetime(2026, 1, 1, 14, 37)
    a = spark.createDataFrame([reading("m1", "13", rpm=900.0), reading("m2", "13", rpm=901.0), reading("m4", "12", rpm=900.0)])
    b = spark.createDataFrame([reading("m3", "13", rpm=950.0), reading("m5", "13", rpm=1.0) | {"timestamp": "nope"}])
    c = spark.createDataFrame([reading("m6", "14", rpm=950.0)])
    for batch, rows in (("a", a), ("a-b", b), ("c", c), ("a", a)):
        sinks.land_raw(rows, lake, batch, noon)
    day = "2026-01-01"
    expected = [("m1", day, "13"), ("m2", day, "13"), ("m3", day, "13"), ("m4", day, "12"), ("m5", day, "14"), ("m6", day, "14")]
    assert landed(spark, lake) == expected
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {lake.table(RAW_READINGS)}").collect()] == [f"dt={day}/hour={h}" for h in (12, 13, 14)]
    ingest(spark, lake, GROUP)
    assert keys(spark.table(lake.table(QUARANTINED)), "device_id", "timestamp") == [("m5", "nope")]
    assert spark.table(lake.table(READINGS)).count() == 5


@pytest.fixture
def plain_session(spark, lake):
    """The session with Spark's own default: an overwrite empties the table."""
    mode = "spark.sql.sources.partitionOverwriteMode"
    spark.conf.set(mode, "static")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    yield spark
    assert spark.conf.get(mode) == "static" and spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    spark.conf.set(mode, "dynamic")
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_sinks_keep_other_partitions_in_a_plain_session(plain_session, lake):
    spark = plain_session
    for day in ("2026-01-01", "2026-01-02", "2026-01-02"):
        row = spark.createDataFrame([reading("m1", "00", day) | {"dt": day, "hour": "05", "event_ts": datetime(2026, 1, 1)}])
        rows = row.select(*(c if c in row.columns else F.lit(None).cast(CLEAN[c].dataType).alias(c) for c in CLEAN.names))
        sinks.write_clean(rows, lake)
        sinks.write_quarantine(rows.withColumn("timestamp", F.lit("nope")), lake)
        kpi = spark.sql(f"SELECT 'm1' device_id, 'F' facility_id, 1.0 avg_vibration_mm_s, 2.0 max_vibration_mm_s, 1L reading_count, date'{day}' dt")
        sinks.range_replace(spark, lake, "daily_motor_vibration_trend", kpi, day, day)
    for table in (READINGS, QUARANTINED, "daily_motor_vibration_trend"):
        assert keys(spark.table(lake.table(table)), "dt") == [("2026-01-01",), ("2026-01-02",)]


def test_jobs_in_a_plain_session(plain_session, lake):
    """Landing files by UTC hours, and a whole run, whatever the session says."""
    rows = plain_session.createDataFrame([reading("m1", "23", vibration_mm_s=1.0), reading("m2", "01", vibration_mm_s=1.0)])
    sinks.land_raw(rows, lake, "a", datetime(2026, 1, 1, 14))
    assert landed(plain_session, lake) == [("m1", "2026-01-01", "23"), ("m2", "2026-01-01", "01")]
    for day in ("2026-01-01", "2026-01-02"):
        put_raw(lake, [reading("m3", "05", day, vibration_mm_s=1.0)], day, "05")
        run(plain_session, lake, backfill={"start_date": day, "end_date": day})
    assert keys(plain_session.table(lake.table(READINGS)), "device_id", "dt") == [
        ("m1", "2026-01-01"), ("m2", "2026-01-01"), ("m3", "2026-01-01"), ("m3", "2026-01-02")
    ]


def test_a_write_that_loses_partitions_is_heard_of(spark, lake, monkeypatch):
    from telemetry_lake.sinks import partitions

    names = iter([{"dt=1", "dt=2"}, {"dt=2"}])
    monkeypatch.setattr(partitions, "partition_names", lambda *_: next(names))
    kpi = spark.table(lake.table("daily_motor_vibration_trend")).limit(0)
    with pytest.raises(RuntimeError, match="lost 1 partitions"):
        partitions.replace_partitions(kpi, lake, "daily_motor_vibration_trend")


NOON = datetime(2026, 1, 1, 14, 37)


def test_landing_again_with_fewer_hours(spark, lake):
    first = [reading("m1", "12"), reading("m2", "13"), reading("m3", "13", "2026-01-02")]
    sinks.land_raw(spark.createDataFrame(first), lake, "a", NOON)
    sinks.land_raw(spark.createDataFrame([reading("other", "13")]), lake, "b", NOON)
    sinks.land_raw(spark.createDataFrame([reading("m9", "13")]), lake, "a", NOON)
    assert landed(spark, lake) == [("m9", "2026-01-01", "13"), ("other", "2026-01-01", "13")]
    sinks.land_raw(spark.createDataFrame(first).limit(0), lake, "a", NOON)
    assert landed(spark, lake) == [("other", "2026-01-01", "13")]
    journal = Journal(spark, lake.path(RAW_READINGS))
    assert journal.hidden() == set() and journal.versions("a") == [2]


def read_devices(spark, lake):
    return sorted(r.device_id for r in sources.read_raw(spark, lake.path(RAW_READINGS), GROUP).collect())


class Abort(Exception):
    pass


def abort(*_, **__):
    raise Abort


def test_a_landing_broken_off_before_its_manifest_is_undone(spark, lake, monkeypatch):
    old, new = (spark.createDataFrame([reading(d, h) for h in hours]) for d, hours in (("old", ("12", "13")), ("new", ("13", "14"))))
    sinks.land_raw(old, lake, "a", NOON)
    with monkeypatch.context() as patch, pytest.raises(Abort):
        patch.setattr(Journal, "commit", abort)
        sinks.land_raw(new, lake, "a", NOON)
    # The files of both are there; readers see the one that counts.
    assert len(landed(spark, lake)) == 4
    assert read_devices(spark, lake) == ["old", "old"]
    assert sources.read_raw(spark, lake.path(RAW_READINGS)).count() == 2
    sinks.settle_landing(spark, lake, "a")
    assert landed(spark, lake) == [("old", "2026-01-01", "12"), ("old", "2026-01-01", "13")]
    sinks.land_raw(new, lake, "a", NOON)
    assert read_devices(spark, lake) == ["new", "new"] and len(landed(spark, lake)) == 2


def test_a_landing_broken_off_after_its_manifest_is_finished(spark, lake, monkeypatch):
    old, new = (spark.createDataFrame([reading(d, h) for h in hours]) for d, hours in (("old", ("12", "13")), ("new", ("13", "14"))))
    sinks.land_raw(old, lake, "a", NOON)
    with monkeypatch.context() as patch, pytest.raises(Abort):
        patch.setattr(Journal, "_remove", abort)
        sinks.land_raw(new, lake, "a", NOON)
    assert len(landed(spark, lake)) == 4
    assert read_devices(spark, lake) == ["new", "new"]
    sinks.settle_landing(spark, lake, "a")
    assert read_devices(spark, lake) == ["new", "new"] and len(landed(spark, lake)) == 2
    assert Journal(spark, lake.path(RAW_READINGS)).hidden() == set()


def test_landing_evaluates_its_input_once(spark, lake):
    counter = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            counter.add(batch.num_rows)
            yield batch

    df = spark.createDataFrame([reading(f"m{n}", "12") for n in range(10)])
    sinks.land_raw(df.mapInArrow(count, df.schema), lake, "a", NOON)
    assert counter.value == 10 and len(landed(spark, lake)) == 10


def calls_of(monkeypatch):
    """Counts the calls for names in the file system."""
    made = Counter()
    for name in ("matching", "children", "exists"):
        def counted(*args, _name=name, _work=getattr(storage, name)):
            made[_name] += 1
            return _work(*args)

        monkeypatch.setattr(storage, name, counted)
    return made


def test_a_long_backfill_asks_for_names_a_bounded_number_of_times(spark, lake, monkeypatch):
    from datetime import date, timedelta

    days = [str(date(2025, 1, 1) + timedelta(days=n)) for n in range(365)]
    for day in days[::50]:
        put_raw(lake, [reading("m1", "05", day), reading("m2", "05", day)], day, "05")
        put_raw(lake, [reading("m1", "06", day)], day, "06")
    made = calls_of(monkeypatch)
    whole = sources.read_raw(spark, lake.path(RAW_READINGS), [{"dt": day, "hours": []} for day in days])
    assert whole.count() == 3 * len(days[::50]) and sum(made.values()) <= 10
    made.clear()
    parts = sources.read_raw(spark, lake.path(RAW_READINGS), [{"dt": day, "hours": ["06", "07"]} for day in days])
    assert parts.count() == len(days[::50]) and sum(made.values()) <= 10


def test_coverage_of_registered_devices(spark, lake):
    put_raw(lake, [reading("m1", "00"), reading("m1", "00"), reading("m2", "00")], "2026-01-01", "00")
    put_raw(lake, [reading("m1", "01", "2026-01-02")], "2026-01-02", "01")
    for day in ("2026-01-02", "2026-01-01", "2026-01-01"):
        ingest(spark, lake, [{"dt": day, "hours": []}])
    registry = spark.table(lake.table(DEVICES))
    assert keys(ops.known_devices(registry), "device_id", "first_dt") == [("m1", "2026-01-01"), ("m2", "2026-01-01")]
    assert registry.count() == 3  # a rerun adds nothing
    gaps = {(r.device_id, r.dt): len(r.hours) for r in coverage(spark, lake, "2026-01-02", "2026-01-03").collect()}
    assert gaps == {("m1", "2026-01-02"): 23, ("m2", "2026-01-02"): 24, ("m1", "2026-01-03"): 24, ("m2", "2026-01-03"): 24}


def test_landing_nothing_and_bad_names(spark, lake):
    df = spark.createDataFrame([reading("m1", "13")])
    sinks.land_raw(df.limit(0), lake, "empty", datetime(2026, 1, 1))
    assert landed(spark, lake) == []
    with pytest.raises(ValueError, match="batch"):
        sinks.land_raw(df, lake, "a/b", datetime(2026, 1, 1))


def test_no_reading_stops_or_blanks_a_kpi(spark, lake):
    """Values that are not finite or do not fit, and a long device type: the others keep their numbers."""
    long_type = "x" * 31
    rows = [
        reading("m1", "00", vibration_mm_s=1.5), reading("m2", "00", battery_pct="NaN"), reading("m3", "00", battery_pct="Infinity"),
        reading("m4", "00", battery_pct=1e12, vibration_mm_s=2.5), reading("t1", "00", kind=long_type),
        reading("e1", "00", kind="smart_meter", energy_kwh="NaN"), reading("e2", "00", kind="smart_meter", energy_kwh=2),
        reading("c1", "00", kind="cold_storage_unit", temperature_c=-20.0, door_open_count="1e30"),
    ]
    put_raw(lake, rows, "2026-01-01", "00")
    result = run(spark, lake, backfill=DAY, rules=())
    assert (result.loaded_until, result.aggregated_until) == ("2026-01-01T00", "2026-01-01")
    columns = ("device_type", "clean_reading_count", "quarantined_reading_count", "avg_battery_pct", "min_battery_pct")
    assert keys(spark.table(lake.table("daily_device_health_summary")), *columns) == [
        ("cold_storage_unit", "1", "0", "50.50", "50.50"),
        ("motor", "2", "2", "None", "50.50"),
        ("smart_meter", "2", "0", "50.50", "50.50"),
        (long_type, "1", "0", "50.50", "50.50"),
    ]
    energy = spark.table(lake.table("daily_energy_voltage_summary"))
    assert keys(energy, "device_id", "total_energy_kwh", "reading_count") == [("e1", "None", "1"), ("e2", "2.00", "1")]
    cold = spark.table(lake.table("daily_cold_storage_risk"))
    assert keys(cold, "device_id", "total_door_open_count") == [("c1", "None")]
    assert spark.table(lake.table(MARK_LOG)).where("last_aggregated_dt = '2026-01-01'").count() == 1


def test_unreadable_lines_can_be_read_in_quarantine(spark, lake):
    put_raw(lake, [reading("m1", "00"), "{broken: ", "not json"], "2026-01-01", "00")
    ingest(spark, lake, GROUP)
    assert keys(sources.read_quarantine(spark, lake.path(QUARANTINED)), "raw_line", "hour") == [("not json", "00"), ("{broken: ", "00")]
    assert "raw_line" not in spark.table(lake.table(READINGS)).columns


def test_audit_counts_beyond_an_int(spark, lake):
    groups = spark.createDataFrame([("2026-01-01", [])], GROUPS)
    summary = spark.createDataFrame([("2026-01-01", "00", False, 3_000_000_000)], "dt string, hour string, _is_bad boolean, rows long")
    run_values = {"run_id": "r", "run_timestamp": "t", "status": "SUCCESS", "started_at": "t", "completed_at": "t", "duration_seconds": 1.0}
    sinks.append_audit(ops.audit_records(groups, summary, "2026-01-01", run_values), lake)
    assert sources.read_audit(spark, lake.path(PIPELINE_RUNS)).first().records_clean == 3_000_000_000
    assert spark.table(lake.table(PIPELINE_RUNS)).first().records_clean == 3_000_000_000


@pytest.mark.parametrize("blocks", [gate.FILTER_BLOCKS, 1])
def test_small_raw_files_become_few_clean_ones(spark, lake, blocks):
    """480 files in 24 hours: one or two files per partition, however the gate joined."""
    for hour in range(24):
        for part in range(20):
            put_raw(lake, [reading(f"m{part}", f"{hour:02d}", vibration_mm_s=1.0)], "2026-01-01", f"{hour:02d}", f"b{part}.jsonl")
    run(spark, lake, "ingest_only", backfill=DAY, filter_blocks=blocks)
    folders = list((Path(lake.path(READINGS)) / "dt=2026-01-01").iterdir())
    assert len(folders) == 24
    assert max(len(list(folder.glob("*.parquet"))) for folder in folders) <= 2
    assert spark.table(lake.table(READINGS)).count() == 480


def test_mark_log_stays_small(spark, lake):
    for hour in range(50):
        move_mark(spark, lake, "p", "last_loaded_key", f"2026-01-{hour // 24 + 1:02d}T{hour % 24:02d}")
        if hour % 10 == 0:
            move_mark(spark, lake, "q", "last_aggregated_dt", f"2026-01-{hour // 10 + 1:02d}")
    # Those of the log, and those that the latest snapshot replaced.
    assert len(list(Path(lake.path(MARK_LOG)).glob("*.parquet"))) <= 2 * (LOG_FILES + 1)
    marks = {r.pipeline_id: r for r in ops.current_marks(spark.table(lake.table(MARK_LOG))).collect()}
    assert marks["p"].last_loaded_key == "2026-01-03T01" and marks["q"].last_aggregated_dt == "2026-01-05"


def test_a_reader_that_listed_the_log_before_a_compaction_keeps_its_marks(spark, lake):
    path = Path(lake.path(MARK_LOG))
    for hour in range(LOG_FILES):
        move_mark(spark, lake, "p", "last_loaded_key", f"2026-01-01T{hour:02d}")
    table = spark.table(lake.table(MARK_LOG))
    listed = spark.read.schema(table.schema).parquet(*(str(f) for f in path.glob("*.parquet")))
    move_mark(spark, lake, "p", "last_loaded_key", "2026-01-01T20")
    assert (path / REPLACED).exists()
    assert ops.current_marks(listed).first().last_loaded_key == f"2026-01-01T{LOG_FILES - 1:02d}"
    # At the compaction after this one they go.
    for hour in range(LOG_FILES + 1):
        move_mark(spark, lake, "p", "last_loaded_key", f"2026-01-02T{hour:02d}")
    assert not any(Path(f.replace("file://", "")).exists() for f in listed.inputFiles())
    assert ops.current_marks(spark.table(lake.table(MARK_LOG))).first().last_loaded_key == f"2026-01-02T{LOG_FILES:02d}"


def test_session_settings_come_back(spark, lake):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    before = {r["key"]: r["value"] for r in spark.sql("SET").collect()}
    try:
        two_hours(lake)
        run(spark, lake, backfill=DAY)
        assert {r["key"]: r["value"] for r in spark.sql("SET").collect()} == before
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_a_hot_hour_is_split_and_small_hours_are_not(spark, lake):
    """Rows of every hour in 16 tasks: few files for an hour, several for the one with a third of all rows."""
    n = F.col("id")
    rows = spark.range(0, 60_000, 1, 16).select(
        F.sha2(n.cast("string"), 256).alias("device_id"),
        F.lit("2026-01-01").alias("dt"),
        F.when(n % 3 == 0, "05").otherwise(F.lpad((n % 24).cast("string"), 2, "0")).alias("hour"),
    )
    rows = rows.select(*(c if c in rows.columns else F.lit(None).cast(CLEAN[c].dataType).alias(c) for c in CLEAN.names))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256KB")
    try:
        sinks.write_clean(rows, lake)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    day = Path(lake.path(READINGS)) / "dt=2026-01-01"
    files = {folder.name: len(list(folder.glob("*.parquet"))) for folder in day.iterdir()}
    assert files.pop("hour=05") > 1
    # Hours that share the hot hour's shuffle partition are cut along with it.
    assert sorted(files.values())[len(files) // 2] <= 2 and max(files.values()) < 16
    assert spark.table(lake.table(READINGS)).count() == 60_000


def test_landing_deals_an_hour_over_tasks_by_its_bytes(spark, lake, monkeypatch):
    """Rows that all lack a readable time share one hour; no task sorts, and no file holds, more than its bytes."""
    monkeypatch.setattr(readings, "LAND_BYTES", 1 << 16, raising=False)
    n = F.col("id")
    time = F.when(n % 4 == 0, F.format_string("2026-01-01T%02d:00:00Z", n % 12)).otherwise("nope")
    rows = spark.range(0, 8000, 1, 3).select(F.sha2(n.cast("string"), 256).alias("device_id"), time.alias("timestamp"))
    sinks.land_raw(rows, lake, "a", NOON)
    sinks.land_raw(rows, lake, "a", NOON)
    files = {}
    for folder in (Path(lake.path(RAW_READINGS)) / "dt=2026-01-01").iterdir():
        files[folder.name[5:]] = [len(file.read_text().splitlines()) for file in folder.glob("*.json")]
    hot = files.pop(f"{NOON.hour:02d}")
    assert sum(hot) == 6000 and len(hot) >= 8 and max(hot) < 1000
    assert sorted(files) == ["00", "04", "08"] and all(len(own) <= 2 for own in files.values())
    found = spark.table(lake.table(RAW_READINGS))
    assert found.count() == found.select("device_id").distinct().count() == 8000


@pytest.mark.parametrize("sizes", [[5], [1] * 50, [100], [3, 250, 4, 1, 90, 30, 1], [0, 9, 10, 11, 0]])
def test_no_task_gets_more_than_thrice_its_bytes(sizes):
    dealt, held = readings.deal_hours(sizes, 10), Counter()
    for size, (first, span) in zip(sizes, dealt, strict=True):
        for task in range(first, first + span):
            held[task] += size / span
    assert sum(held.values()) == pytest.approx(sum(sizes)) and max(held.values()) <= 30
    assert max(held) <= sum(sizes) // 10 + 1


def test_shuffles_follow_the_input_size(spark, lake):
    spark.range(100_000).selectExpr("id", "uuid() AS u").write.parquet(lake.path("big"))
    scan = spark.read.parquet(lake.path("big"))
    try:
        assert size_shuffles(scan) == 8
        assert size_shuffles(scan, 1 << 16) > 32
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")


# --- whole days ---


def test_made_up_day(spark, lake):
    """A seeded day with every kind of defect, against the same sums in plain Python."""
    rng = random.Random(11)
    measures = {"motor": "vibration_mm_s", "hvac_unit": "temperature_c", "smart_meter": "energy_kwh", "cold_storage_unit": "temperature_c"}
    inside = {"motor": (0.5, 4.5), "hvac_unit": (18, 26), "smart_meter": (0.1, 15), "cold_storage_unit": (-25, -10)}
    rows = defaultdict(list)
    for hour in range(24):
        for device in range(40):
            kind = list(measures)[device % 4]
            value = round(rng.uniform(*inside[kind]), 2)
            row = reading(f"d{device}", f"{hour:02d}", kind=kind, battery_pct=rng.randrange(15, 100), facility_id=f"F{device % 3}") | {measures[kind]: value}
            fate = rng.random()
            if fate < 0.03:
                row[measures[kind]] = 999999
            elif fate < 0.05:
                row["battery_pct"] = None
            elif fate < 0.08:
                rows[hour].append(dict(row))
            rows[hour].append(row)
        put_raw(lake, rows[hour], "2026-01-01", f"{hour:02d}")
    good, bad = [], []
    for hour in rows:
        copies = Counter(row["device_id"] for row in rows[hour])
        for row in rows[hour]:
            wrong = copies[row["device_id"]] > 1 or row["battery_pct"] is None or row[measures[row["device_type"]]] == 999999
            (bad if wrong else good).append(row)
    assert run(spark, lake, backfill=DAY).loaded_until == "2026-01-01T23"
    assert spark.table(lake.table(READINGS)).count() == len(good)
    assert spark.table(lake.table(QUARANTINED)).count() == len(bad)
    health = {(r.device_type, r.facility_id): r for r in spark.table(lake.table("daily_device_health_summary")).collect()}
    assert len(health) == 12
    for group, row in health.items():
        own = [[r for r in part if (r["device_type"], r["facility_id"]) == group] for part in (good, bad)]
        batteries = [r["battery_pct"] for r in own[0]]
        assert (row.clean_reading_count, row.quarantined_reading_count) == (len(own[0]), len(own[1]))
        assert float(row.avg_battery_pct) == pytest.approx(sum(batteries) / len(batteries), abs=0.0051)
        assert row.min_battery_pct == min(batteries)
    for spec in ops.DEVICE_KPIS:
        table = spark.table(lake.table(spec.table)).agg(F.count("*"), F.sum("reading_count")).first()
        own = [r for r in good if r["device_type"] == spec.device_type]
        assert tuple(table) == (len({r["device_id"] for r in own}), len(own))


# The folder of the sample day's raw files, dt=2026-01-01, if they are at hand.
SAMPLE_DAY = os.environ.get("SAMPLE_DAY_DIR")


def check_sample_day(spark, lake):
    shutil.copytree(Path(SAMPLE_DAY), Path(lake.path(RAW_READINGS)), dirs_exist_ok=True)
    assert run(spark, lake, backfill=DAY).loaded_until == "2026-01-01T23"
    clean, bad = spark.table(lake.table(READINGS)), spark.table(lake.table(QUARANTINED))
    assert (clean.count(), bad.count()) == (1368, 67)
    assert (clean.select("hour").distinct().count(), bad.select("hour").distinct().count()) == (24, 21)
    health = spark.table(lake.table("daily_device_health_summary"))
    assert keys(health.drop("dt", "total_reading_count"), *health.columns[:2], "clean_reading_count", "quarantined_reading_count", "dq_failure_rate_pct", "avg_battery_pct", "min_battery_pct") == [
        ("cold_storage_unit", "FAC-01", "117", "4", "3.31", "55.28", "15.00"),
        ("cold_storage_unit", "FAC-02", "47", "2", "4.08", "56.57", "19.00"),
        ("cold_storage_unit", "FAC-03", "181", "11", "5.73", "54.93", "15.00"),
        ("hvac_unit", "FAC-01", "185", "4", "2.12", "57.09", "15.50"),
        ("hvac_unit", "FAC-02", "65", "4", "5.80", "61.60", "15.00"),
        ("hvac_unit", "FAC-03", "91", "3", "3.19", "56.57", "15.70"),
        ("motor", "FAC-01", "114", "7", "5.79", "56.36", "16.50"),
        ("motor", "FAC-02", "93", "3", "3.13", "59.50", "15.10"),
        ("motor", "FAC-03", "129", "18", "12.24", "56.14", "15.40"),
        ("smart_meter", "FAC-01", "68", "4", "5.56", "66.34", "19.20"),
        ("smart_meter", "FAC-02", "115", "3", "2.54", "59.99", "15.50"),
        ("smart_meter", "FAC-03", "163", "4", "2.40", "59.48", "15.10"),
    ]
    counts = {spec.table: spark.table(lake.table(spec.table)).agg(F.count("*"), F.sum("reading_count")).first() for spec in ops.DEVICE_KPIS}
    assert {name: tuple(row) for name, row in counts.items()} == {
        "daily_motor_vibration_trend": (15, 336),
        "daily_cold_storage_risk": (15, 345),
        "daily_hvac_stability": (15, 341),
        "daily_energy_voltage_summary": (15, 346),
    }
    temperatures = {r.device_type: r.avg_temperature_c for r in ops.avg_temp_by_type(clean, "2026-01-01").collect()}
    assert temperatures["motor"] is None and temperatures["smart_meter"] is None
    assert round(temperatures["hvac_unit"], 4) == 22.1357 and round(temperatures["cold_storage_unit"], 4) == -17.4138


if SAMPLE_DAY:
    test_sample_day = check_sample_day
