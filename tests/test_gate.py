"""Gate flags on hand-made rows, and the duplicate count against a window."""

import random
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from telemetry_lake import operators as ops
from telemetry_lake import sources
from telemetry_lake.functions import SENSOR_RULES
from telemetry_lake.operators import gate
from telemetry_lake.schemas import CLEAN, NUMERIC_COLUMNS, QUARANTINE, RAW

T0 = "2026-01-01T00:00:00+00:00"


def reading(device="d1", kind="hvac_unit", ts=T0, battery="50", **fields):
    row = dict.fromkeys(RAW.names)
    row |= {"device_id": device, "device_type": kind, "timestamp": ts, "battery_pct": battery}
    return row | {"facility_id": "F", "dt": "2026-01-01", "hour": "00"} | fields


def prepared(spark, rows):
    return sources.with_event_ts(sources.normalize(spark.createDataFrame(rows, RAW)))


CASES = {
    "in range": (reading(temperature_c="20.5", humidity_pct="40"), ()),
    "on the lower bound": (reading(temperature_c="18", humidity_pct="30.0"), ()),
    "on the upper bound": (reading(temperature_c="26", humidity_pct="60"), ()),
    "above": (reading(temperature_c="26.01"), ("_range",)),
    "below": (reading(humidity_pct="29.9"), ("_range",)),
    "sentinel int": (reading(kind="motor", rpm="999999"), ("_range",)),
    "not a number": (reading(kind="motor", rpm="NaN"), ()),
    "infinite": (reading(kind="motor", rpm="-Infinity"), ()),
    "battery not a number": (reading(battery="NaN"), ("_null",)),
    "infinite battery": (reading(battery="Infinity"), ("_null",)),
    "time without a date": (reading(ts="12:30"), ("_null",)),
    "null sensor value": (reading(temperature_c=None, humidity_pct=None), ()),
    "text for a number": (reading(temperature_c="hot"), ()),
    "rule of another type": (reading(kind="smart_meter", temperature_c="999999"), ()),
    "unknown type": (reading(kind="toaster", temperature_c="999999"), ()),
    "null type": (reading(kind=None, temperature_c="999999"), ("_null",)),
    "null device": (reading(device=None), ("_null",)),
    "null battery": (reading(battery=None), ("_null",)),
    "unreadable time": (reading(ts="nope"), ("_null",)),
    "null and out of range": (reading(battery=None, temperature_c="-5"), ("_null", "_range")),
}


@pytest.mark.parametrize("few", [True, False])
def test_flags(spark, few):
    rows = [row | {"device_id": row["device_id"] and f"d{i}", "zone": name} for i, (name, (row, _)) in enumerate(CASES.items())]
    flagged = {r.zone: r for r in ops.dq_gate(prepared(spark, rows), keys_are_few=few).collect()}
    for name, (_, expected) in CASES.items():
        row = flagged[name]
        assert {f for f in ("_dup", "_null", "_range") if row[f]} == set(expected), name
        assert row._is_bad is bool(expected), name


def test_all_copies_are_bad_and_reasons_add_up(spark):
    rows = [reading(temperature_c="20")] * 3 + [reading("d2", temperature_c="99")] * 2 + [reading("d3")]
    flagged = ops.dq_gate(prepared(spark, rows))
    counts = {(r.device_id, r._dup, r._range): r["count"] for r in flagged.groupBy("device_id", "_dup", "_range").count().collect()}
    assert counts == {("d1", True, False): 3, ("d2", True, True): 2, ("d3", False, False): 1}
    assert ops.clean(flagged).count() == 1 and ops.quarantine(flagged).count() == 5


def test_split_columns(spark):
    flagged = ops.dq_gate(prepared(spark, [reading()]))
    assert set(ops.clean(flagged).columns) == set(CLEAN.names)
    assert set(ops.quarantine(flagged).columns) == set(QUARANTINE.names)


@pytest.mark.parametrize("mode", ["broadcast", "shuffled", "planned by Spark"])
def test_duplicates_equal_the_window(spark, mode, monkeypatch):
    """A third of all rows share one key, some keys are null, some repeat a few times."""
    monkeypatch.setattr(gate, "HOT_KEYS", 2)
    monkeypatch.setattr(gate, "HOT_COPIES", 3)
    n = F.col("id")
    rows = spark.range(0, 6000, 1, 7).select(
        "id",
        F.when(n % 3 == 0, "hot").when(n % 50 != 1, (n % 2500).cast("string")).alias("device_id"),
        F.when(n % 3 == 0, F.lit(datetime(2026, 1, 1))).when(n % 70 != 1, F.timestamp_seconds(n % 11)).alias("event_ts"),
    )
    expected = rows.withColumn("_dup", F.count("*").over(Window.partitionBy("device_id", "event_ts")) > 1)
    if mode == "shuffled":
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", -1)
    try:
        flagged = ops.flag_duplicates(rows, keys_are_few=mode == "broadcast").cache()
        assert flagged.count() == 6000
        assert flagged.exceptAll(expected).isEmpty() and expected.exceptAll(flagged).isEmpty()
        if mode == "shuffled":
            plan = flagged._jdf.queryExecution().toString()
            assert "SortMergeJoin" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        flagged.unpersist()


@pytest.mark.parametrize("blocks", [gate.FILTER_BLOCKS, 8, 1])
def test_suspects_equal_the_window(spark, tmp_path, blocks, monkeypatch):
    """Settled with a good, a poor and a full filter; with the good one little more than the copies is moved."""
    monkeypatch.setattr(gate, "HOT_KEYS", 2)
    monkeypatch.setattr(gate, "HOT_COPIES", 100)
    n = F.col("id")
    rows = spark.range(0, 30_000, 1, 7).select(
        "id",
        F.when(n % 3 == 0, "hot").when(n % 50 != 1, F.when(n % 40 == 2, n % 999).otherwise(n).cast("string")).alias("device_id"),
        F.when(n % 70 != 1, F.lit(datetime(2026, 1, 1))).alias("event_ts"),
    )
    rows.write.parquet(str(tmp_path / "rows"))
    rows, key = spark.read.parquet(str(tmp_path / "rows")), ("device_id", "event_ts")
    expected = rows.withColumn("_dup", F.count("*").over(Window.partitionBy(*key)) > 1).cache()
    gate.duplicate_keys(rows, key).write.parquet(str(tmp_path / "keys"))
    keys = spark.read.parquet(str(tmp_path / "keys"))
    marked = gate.mark_suspects(rows, key, keys, blocks)
    flagged = marked.where("_dup IS NOT NULL").unionByName(gate.settle_suspects(marked, key, keys))
    assert flagged.exceptAll(expected).isEmpty() and expected.exceptAll(flagged).isEmpty()
    moved, hot = gate.suspects(marked).count(), marked.where("_dup").count()
    copies = expected.where("_dup").count()
    assert hot >= 9_000 and moved + hot >= copies
    if blocks == gate.FILTER_BLOCKS:
        assert moved + hot <= copies + 30
    assert "Exchange hashpartitioning(device_id" not in marked._jdf.queryExecution().executedPlan().toString()


def test_one_hot_key_is_spread_over_the_reducers(spark):
    """In the shuffled form no reducer gets the copies of the hot key together."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        n = F.col("id")
        rows = spark.range(0, 64_000, 1, 64).select(
            F.when(n % 3 == 0, "hot").otherwise(n.cast("string")).alias("device_id"), F.lit(1).alias("event_ts")
        )
        flagged = ops.flag_duplicates(rows, ("device_id", "event_ts"))
        sizes = [r["count"] for r in flagged.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 64_000 and max(sizes) < 2 * 64_000 / 8


def test_random_rows_against_plain_python(spark):
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        kind = rng.choice(["hvac_unit", "motor", "cold_storage_unit", "smart_meter", "toaster", None])
        row = reading(rng.choice([None, *"abcdefgh"]), kind, f"2026-01-01T{rng.randrange(30):02d}:{rng.randrange(12):02d}:00+00:00")
        for column in NUMERIC_COLUMNS:
            row[column] = rng.choice([None, "999999", "x", str(rng.randrange(-30, 250)), str(round(rng.uniform(-30, 60), 2))])
        rows.append(row | {"zone": str(i)})

    def number(text):
        try:
            return float(text)
        except (TypeError, ValueError):
            return None

    def hour(row):
        return row["timestamp"] if int(row["timestamp"][11:13]) < 24 else None

    copies = Counter((row["device_id"], hour(row)) for row in rows)
    expected = {}
    for row in rows:
        null = row["device_id"] is None or row["device_type"] is None or hour(row) is None or number(row["battery_pct"]) is None
        outside = any(
            rule.device_type == row["device_type"]
            and number(row[rule.column]) is not None
            and not rule.low <= number(row[rule.column]) <= rule.high
            for rule in SENSOR_RULES
        )
        expected[row["zone"]] = (copies[row["device_id"], hour(row)] > 1, null, outside)
    flagged = ops.dq_gate(prepared(spark, rows))
    assert {r.zone: (r._dup, r._null, r._range) for r in flagged.collect()} == expected
    assert ops.clean(flagged).count() + ops.quarantine(flagged).count() == len(rows)


def test_summary_operators(spark):
    rows = [reading(), reading("d2", hour="05"), reading("d3", hour="05", battery=None), reading("d4", dt="2026-01-02", battery=None)]
    summary = ops.run_summary(ops.dq_gate(prepared(spark, rows)))
    assert ops.run_max_key(summary).first().max_key == "2026-01-02T00"
    assert {tuple(r) for r in ops.counts_per_date(summary).collect()} == {("2026-01-01", 2, 1), ("2026-01-02", 0, 1)}
    assert {tuple(r) for r in ops.partition_manifest(summary).collect()} == {
        ("2026-01-01", "00", True, False),
        ("2026-01-01", "05", True, True),
        ("2026-01-02", "00", False, True),
    }
    assert ops.run_max_key(summary.limit(0)).first().max_key is None


def test_group_filter(spark):
    rows = spark.createDataFrame([(f"2026-01-0{d}", f"{h:02d}") for d in (1, 2, 3) for h in range(24)], ["dt", "hour"])
    groups = [{"dt": "2026-01-01", "hours": ["00", "13"]}, {"dt": "2026-01-02", "hours": []}]
    found = {tuple(r) for r in sources.where_groups(rows, groups).collect()}
    assert found == {("2026-01-01", "00"), ("2026-01-01", "13")} | {("2026-01-02", f"{h:02d}") for h in range(24)}
    assert sources.where_groups(rows, []).isEmpty()
