"""Planners and marks: clock cases, backfill checks, forward-only marks, coverage."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from telemetry_lake import operators as ops
from telemetry_lake.schemas import MARKS


def mark(pipeline_id, dt=None, hour=None, aggregated=None):
    return (pipeline_id, None, dt, hour, dt and f"{dt}T{hour}", aggregated)


def marks(spark, *rows):
    return spark.createDataFrame(list(rows), MARKS)


HOUR_CASES = [
    (("2026-08-30", "12"), datetime(2026, 8, 30, 15, 30), {"2026-08-30": ["13", "14"]}),
    (("2026-08-30", "08"), datetime(2026, 8, 30, 10, 15), {"2026-08-30": ["09"]}),
    (("2026-08-31", "22"), datetime(2026, 9, 1, 2, 0), {"2026-08-31": ["23"], "2026-09-01": ["00", "01"]}),
    (("2026-08-30", "09"), datetime(2026, 8, 30, 10, 0), {}),
    (("2026-08-30", "20"), datetime(2026, 8, 30, 10, 0), {}),
]


@pytest.mark.parametrize("last, now, expected", HOUR_CASES)
def test_missing_hours(spark, last, now, expected):
    due = ops.missing_hours(marks(spark, mark("p", *last)), now).orderBy("dt").collect()
    assert {r.dt: r.hours for r in due} == expected


@pytest.mark.parametrize("minute", [0, 37])
def test_missing_hours_without_a_mark(spark, minute):
    due = ops.missing_hours(marks(spark, mark("p")), datetime(2026, 8, 30, 5, minute)).orderBy("dt").collect()
    assert [r.dt for r in due] == ["2026-08-29", "2026-08-30"]
    assert sum(len(r.hours) for r in due) == 23
    assert due[0].hours[0] == "06" and due[-1].hours[-1] == "04"


def test_missing_hours_plans_many_keys_and_long_gaps(spark):
    due = ops.missing_hours(
        marks(spark, mark("a", "2026-01-01", "05"), mark("b", "2026-02-28", "22"), mark("c", "2026-03-01", "09")),
        datetime(2026, 3, 1, 10, 5),
    )
    counts = {r.pipeline_id: r.n for r in due.groupBy("pipeline_id").agg(F.sum(F.size("hours")).alias("n")).collect()}
    assert counts == {"a": 18 + 58 * 24 + 10, "b": 1 + 10}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_planning_does_not_depend_on_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        due = ops.missing_hours(marks(spark, mark("p", "2026-03-08", "00")), datetime(2026, 3, 8, 5, 0)).collect()
        assert [(r.dt, r.hours) for r in due] == [("2026-03-08", ["01", "02", "03", "04"])]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


DATE_CASES = [
    (("2026-09-01", "14"), "2026-08-26", ("2026-08-27", "2026-08-31")),
    (("2026-09-01", "23"), "2026-08-26", ("2026-08-27", "2026-09-01")),
    (("2026-09-01", "23"), "2026-09-01", None),
    (("2026-09-01", "23"), None, ("2026-09-01", "2026-09-01")),
    (None, None, None),
    (None, "2026-08-26", None),
]


@pytest.mark.parametrize("upstream, own, expected", DATE_CASES)
def test_missing_dates(spark, upstream, own, expected):
    rows = ([mark("up", *upstream)] if upstream else []) + ([mark("own", aggregated=own)] if own else [])
    links = spark.createDataFrame([("own", "up")], ["pipeline_id", "upstream_id"])
    due = ops.missing_dates(marks(spark, *rows), links, date(2026, 9, 2)).collect()
    assert [(r.start_date, r.end_date) for r in due] == ([expected] if expected else [])


def test_backfill(spark):
    rows = ops.backfill_groups(spark, "2026-06-01", "2026-06-03").orderBy("dt").collect()
    assert [(r.dt, r.hours) for r in rows] == [(f"2026-06-0{d}", []) for d in (1, 2, 3)]
    assert ops.backfill_groups(spark, "2026-01-01", "2026-03-31").count() == 90
    assert ops.backfill_groups(spark, "2026-01-01", "2026-01-01").count() == 1


@pytest.mark.parametrize(
    "start, end, message",
    [("2026-06-05", "2026-06-01", "before start_date"), ("2026-01-01", "2026-04-01", "90-day safety cap")],
)
def test_backfill_rejects(spark, start, end, message):
    with pytest.raises(ValueError, match=message):
        ops.backfill_groups(spark, start, end)


def test_calendar(spark):
    calendar = ops.expected_partitions(spark, "2026-02-28", "2026-03-01")
    assert calendar.count() == 48 and calendar.distinct().count() == 48
    assert [tuple(r) for r in (calendar.orderBy("dt", "hour").first(), calendar.orderBy(F.desc("dt"), F.desc("hour")).first())] == [
        ("2026-02-28", "00"),
        ("2026-03-01", "23"),
    ]


def test_marks_only_move_forward(spark):
    before = marks(spark, mark("a", "2026-01-02", "05"), mark("b", "2026-01-02", "05"), mark("d", aggregated="2026-01-01"))
    found = spark.createDataFrame(
        [("a", "2026-01-02T04", None), ("b", "2026-01-03T00", None), ("b", "2026-01-02T23", None), ("c", "2026-01-01T00", None), ("d", None, "2026-01-05"), ("e", None, None)],
        "pipeline_id string, last_loaded_key string, last_aggregated_dt string",
    )
    after = {r.pipeline_id: (r.last_loaded_dt, r.last_loaded_hour, r.last_aggregated_dt) for r in ops.advance_marks(before, found).collect()}
    assert after == {
        "a": ("2026-01-02", "05", None),
        "b": ("2026-01-03", "00", None),
        "c": ("2026-01-01", "00", None),
        "d": (None, None, "2026-01-05"),
        "e": (None, None, None),
    }
    moved = ops.newer_marks(before, found)
    assert {r.pipeline_id for r in moved.collect()} == {"b", "c", "d"}
    log = before.unionByName(moved).unionByName(before)
    assert {r.pipeline_id: r.last_loaded_hour for r in ops.current_marks(log).collect()} == {"a": "05", "b": "00", "c": "00", "d": None}


def test_coverage_gaps(spark):
    rows = [("a", "2026-01-01", f"{h:02d}") for h in range(24) if h not in (3, 17)] * 2
    rows += [("a", "2026-01-02", f"{h:02d}") for h in range(24)] + [("b", "2026-01-02", "23")]
    rows += [(None, "2026-01-01", "00"), ("a", None, "00"), ("a", "2025-12-31", "00")]
    gaps = ops.coverage_gaps(spark.createDataFrame(rows, ["device_id", "dt", "hour"]), "device_id", "2026-01-01", "2026-01-02")
    every = [f"{h:02d}" for h in range(24)]
    expected = {("a", "2026-01-01"): ["03", "17"], ("b", "2026-01-01"): every, ("b", "2026-01-02"): every[:23]}
    assert {(r.device_id, r.dt): r.hours for r in gaps.collect()} == expected


def test_coverage_grows_with_keys_and_days(spark, tmp_path):
    """A thousand keys over four years: in seconds, and twice the days take about twice as long."""
    import time

    def seconds(start, end):
        begun = time.perf_counter()
        gaps = ops.coverage_gaps(table, "device_id", start, end, keys)
        rows = gaps.agg(F.count("*"), F.sum(F.size("hours"))).first()
        return time.perf_counter() - begun, tuple(rows)

    day = F.expr("cast(date_add(date'2022-01-01', cast(id % 1461 AS int)) AS string)")
    n = F.col("id")
    rows = spark.range(0, 1000 * 1461, 1, 8).select(
        (n / 1461).cast("long").cast("string").alias("device_id"), day.alias("dt"), F.lpad((n % 24).cast("string"), 2, "0").alias("hour")
    )
    rows.where(n % 1461 % 10 != 0).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    keys = spark.range(1000).select(F.col("id").cast("string").alias("device_id"))
    seconds("2022-01-01", "2022-01-31")
    half, _ = seconds("2022-01-01", "2023-12-31")
    whole, counts = seconds("2022-01-01", "2025-12-31")
    assert counts == (1000 * 1461, 1000 * (147 * 24 + 1314 * 23))
    assert whole < 20 and whole < 4 * half + 2


def test_coverage_of_given_keys_scans_the_range_only(spark, tmp_path):
    rows = [("a", "2026-01-01", "05"), ("old", "2025-01-01", "00")]
    readings = spark.createDataFrame(rows, ["device_id", "dt", "hour"])
    readings.write.partitionBy("dt").parquet(str(tmp_path / "t"))
    table = spark.read.schema("device_id string, hour string, dt string").parquet(str(tmp_path / "t"))
    keys = spark.createDataFrame([("a",), ("new",)], ["device_id"])
    gaps = ops.coverage_gaps(table, "device_id", "2026-01-01", "2026-01-01", keys)
    assert {(r.device_id, len(r.hours)) for r in gaps.collect()} == {("a", 23), ("new", 24)}
    assert {r.device_id for r in ops.coverage_gaps(table, "device_id", "2026-01-01", "2026-01-01").collect()} == {"a", "old"}
    plan = gaps._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all("dt#" in x and ">= 2026-01-01" in x and "<= 2026-01-01" in x for x in scans)


def test_audit_skips_dates_not_reached(spark):
    groups = spark.createDataFrame([("2026-01-01", ["00", "01"]), ("2026-01-02", []), ("2026-01-03", [])], "dt string, hours array<string>")
    summary = spark.createDataFrame([("2026-01-02", "05", False, 7), ("2026-01-02", "06", True, 2)], "dt string, hour string, _is_bad boolean, rows long")
    records = ops.audit_records(groups, summary, "2026-01-02", {"run_id": "r", "run_timestamp": "t", "status": "SUCCESS", "started_at": "t", "completed_at": "t", "duration_seconds": 1.5})
    assert {(r.target_date, r.hours_processed, r.records_clean, r.records_quarantined) for r in records.collect()} == {
        ("2026-01-01", "00,01", 0, 0),
        ("2026-01-02", "ALL", 7, 2),
    }
