"""Registered queries over the test tables, each with its SQL counterpart.

The telemetry tables are derived from `events` by `readings_from_events`; the SQL side
derives them by the READINGS common table expressions below. Results leave Spark as
strings, longs, doubles and booleans, so both engines hash them alike.
"""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Callable
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_lake import operators as ops
from telemetry_lake import sinks, sources
from telemetry_lake.functions import mark_key, null_flag, range_flag
from telemetry_lake.functions.rules import REPORT_KEY, REQUIRED_COLUMNS
from telemetry_lake.functions.times import event_time_text
from telemetry_lake.lake import DEVICES, MARK_LOG, PIPELINE_RUNS, QUARANTINED, RAW_READINGS, READINGS, Lake, create_tables, drop_lake
from telemetry_lake.plans import ingest, run
from telemetry_lake.schemas import KPI_COLUMNS, NUMERIC_COLUMNS, TEXT_COLUMNS
from telemetry_lake.session import configure
from telemetry_lake.sources.events import EVENT_RULES, readings_from_events
from telemetry_lake.storage import new_work_path

# When batches land and runs start; later than all readings.
NOW = datetime(2024, 2, 1, 5, 37)
RUN = {
    "run_id": "run-1",
    "run_timestamp": "2024-02-01T05:37:00+00:00",
    "status": "SUCCESS",
    "started_at": "2024-02-01T05:37:00+00:00",
    "completed_at": "2024-02-01T05:38:00+00:00",
    "duration_seconds": 60.0,
}


# --- inputs ---


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/events.parquet")


def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_from_events(_events(spark, sf_dir))


def _flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.dq_gate(_readings(spark, sf_dir), EVENT_RULES)


def _split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    flagged = _flagged(spark, sf_dir)
    return ops.clean(flagged), ops.quarantine(flagged)


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir)[0]


def _quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir)[1]


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.run_summary(_flagged(spark, sf_dir))


def _window(readings: DataFrame) -> tuple[str, str]:
    """First and last date of the readings."""
    first, last = readings.agg(F.min("dt"), F.max("dt")).first()
    return first, last


def _after(end: str) -> datetime:
    """In the morning after the last date: the clock of the planners."""
    return datetime.fromisoformat(end) + timedelta(days=1, hours=5, minutes=37)


def _in_new_lake(spark: SparkSession, work: Callable[[Lake], DataFrame]) -> DataFrame:
    """What `work` makes of an empty lake of its own in the shared folder, which goes afterwards.

    The result is checkpointed, so that it outlives the tables it was read from.
    """
    lake = Lake(new_work_path(configure(spark), "lake"), f"lake_{uuid.uuid4().hex}")
    try:
        return work(lake).checkpoint()
    finally:
        drop_lake(spark, lake)


def _device_marks(readings: DataFrame) -> DataFrame:
    """A mark per device: the last hour it reported in."""
    found = readings.select(F.col("device_id").alias("pipeline_id"), mark_key().alias("last_loaded_key"))
    return ops.current_marks(found)


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates as text."""
    targets = {T.DecimalType: "double", T.DateType: "string"}
    return df.select(
        *(F.col(f.name).cast(targets[type(f.dataType)]) if type(f.dataType) in targets else f.name for f in df.schema)
    )


# --- scans and sinks ---


def scan_date_groups(spark, sf_dir):
    """All hours due since a first run ended in mid-day: part of a date, then whole dates."""
    mark = spark.createDataFrame([("p", "2024-01-01", "11")], ["pipeline_id", "last_loaded_dt", "last_loaded_hour"])
    due = ops.missing_hours(mark, datetime(2024, 1, 31, 0, 30))
    groups = [{"dt": r.dt, "hours": r.hours if r.dt == "2024-01-01" else []} for r in due.collect()]
    rows = sources.where_groups(_readings(spark, sf_dir), groups)
    return rows.groupBy("dt", "hour").agg(F.count("*").alias("rows"), F.sum("battery_pct").alias("battery"))


def _incoming(readings: DataFrame) -> DataFrame:
    return readings.drop("event_id", "event_ts", "dt", "hour")


def _land(readings: DataFrame, lake: Lake, batch: str = "b1") -> None:
    sinks.land_raw(_incoming(readings), lake, batch, NOW)


def land_and_scan_raw(spark, sf_dir):
    """Land as JSON lines, scan the folders of the backfilled dates, normalise."""

    def work(lake):
        readings = _readings(spark, sf_dir)
        _land(readings, lake)
        groups = [r.asDict() for r in ops.backfill_groups(spark, *_window(readings)).collect()]
        raw = sources.with_event_ts(sources.normalize(sources.read_raw(spark, lake.path(RAW_READINGS), groups)))
        return _reading_rows(raw, "timestamp")

    return _in_new_lake(spark, work)


def land_two_batches(spark, sf_dir):
    """Batches that share all their hours, the second without readable times; the first one is landed
    whole at first, then corrected to readings of some hours only."""

    def work(lake):
        rows = _incoming(_readings(spark, sf_dir))
        late = F.col("device_id").cast("long") % 2 == 1
        first, second = rows.where(~late), rows.where(late)
        sinks.land_raw(rows, lake, "a", NOW)
        sinks.land_raw(second.withColumn("timestamp", F.concat(F.lit("at "), "timestamp")), lake, "b", NOW)
        sinks.land_raw(second, lake, "c", NOW)
        sinks.land_raw(first.where(F.substring("timestamp", 12, 2) < "12"), lake, "a", NOW)
        table = spark.table(lake.table(RAW_READINGS))
        return table.groupBy("dt", "hour").agg(
            F.count("*").alias("rows"), F.count(F.when(F.col("timestamp").startswith("at "), 1)).alias("unreadable")
        )

    return _in_new_lake(spark, work)


def _reading_rows(df: DataFrame, *more: str) -> DataFrame:
    """All columns of a table of readings; numbers as doubles, missing ones as -1."""
    numbers = [F.coalesce(F.col(c).cast("double"), F.lit(-1.0)).alias(c) for c in NUMERIC_COLUMNS]
    time = F.col("event_ts") if dict(df.dtypes)["event_ts"] == "string" else event_time_text(F.col("event_ts"))
    return df.select(*TEXT_COLUMNS, *numbers, time.alias("event_ts"), "dt", "hour", *more)


def register_raw_partitions(spark, sf_dir):
    """Landed files are visible in the catalog table."""

    def work(lake):
        _land(_readings(spark, sf_dir), lake)
        return spark.table(lake.table(RAW_READINGS)).groupBy("dt", "hour").agg(F.count("*").alias("rows"))

    return _in_new_lake(spark, work)


def normalize_numeric(spark, sf_dir):
    k = F.get_json_object("props", "$.k")
    text = F.when(k == "99", "n/a").when(k == "97", "NaN").when(k == "96", "-Infinity")
    text = text.when(k != "98", F.when(k < "5", k).otherwise(F.col("value").cast("string")))
    mixed = _events(spark, sf_dir).select("event_id", text.alias("number"))
    return sources.normalize(mixed, ["number"]).withColumn("number", F.coalesce("number", F.lit(-1.0)))


def parse_event_time(spark, sf_dir):
    k = F.get_json_object("props", "$.k")
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    text = F.when(k == "99", "nope").when(k == "98", "12:30").when(k < "5", F.concat(text, F.lit("+02:00"))).otherwise(F.concat(text, F.lit("Z")))
    parsed = sources.with_event_ts(_events(spark, sf_dir).select("event_id", text.alias("timestamp")))
    return parsed.select("event_id", F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss").alias("event_ts"))


def _twice(readings: DataFrame, write: Callable[[DataFrame, Lake], None], lake: Lake) -> None:
    """Write all hours, then those of the last date again, in a session that would empty a table."""
    spark, mode = readings.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    last = _window(readings)[1]
    try:
        for rows in (readings, readings.where(F.col("dt") == last)):
            spark.conf.set(mode, "static")
            write(rows, lake)
    finally:
        configure(spark)


def clean_table(spark, sf_dir):
    def work(lake):
        create_tables(spark, lake, [READINGS])
        _twice(_clean(spark, sf_dir), sinks.write_clean, lake)
        return _reading_rows(sources.read_clean(spark, lake.path(READINGS)))

    return _in_new_lake(spark, work)


def quarantine_table(spark, sf_dir):
    def work(lake):
        create_tables(spark, lake, [QUARANTINED])
        _twice(_quarantine(spark, sf_dir), sinks.write_quarantine, lake)
        return _reading_rows(sources.read_quarantine(spark, lake.path(QUARANTINED)), "timestamp", "raw_line")

    return _in_new_lake(spark, work)


# --- gate ---


def dq_nulls(spark, sf_dir):
    return _readings(spark, sf_dir).select("event_id", null_flag(REQUIRED_COLUMNS).alias("is_null"))


def dq_ranges(spark, sf_dir):
    return _readings(spark, sf_dir).select("event_id", range_flag(EVENT_RULES).alias("out_of_range"))


def dq_duplicates(spark, sf_dir):
    flagged = ops.flag_duplicates(_readings(spark, sf_dir), REPORT_KEY)
    return flagged.select("event_id", F.col("_dup").alias("is_duplicate"))


def dq_flags(spark, sf_dir):
    return _flagged(spark, sf_dir).groupBy(
        F.col("_dup").alias("is_duplicate"),
        F.col("_null").alias("is_null"),
        F.col("_range").alias("out_of_range"),
        F.col("_is_bad").alias("is_bad"),
    ).agg(F.count("*").alias("rows"))


def _with_id(df: DataFrame, *more: str) -> DataFrame:
    return df.select("event_id", "device_id", "device_type", "dt", "hour", *more)


def dq_clean(spark, sf_dir):
    return _with_id(_clean(spark, sf_dir))


def dq_quarantine(spark, sf_dir):
    return _with_id(_quarantine(spark, sf_dir), "timestamp")


# --- run summary and audit ---


def run_summary(spark, sf_dir):
    return _summary(spark, sf_dir).withColumnRenamed("_is_bad", "is_bad")


def run_max_key(spark, sf_dir):
    return ops.run_max_key(_readings(spark, sf_dir))


def empty_input_guard(spark, sf_dir):
    """Ingest the first date, then dates after the last: the second run finds nothing and touches no table."""

    def work(lake):
        readings = _readings(spark, sf_dir)
        start, end = _window(readings)
        _land(readings.where(F.col("dt") == start), lake)
        create_tables(spark, lake)
        parts = []
        for day in (start, _after(end).strftime("%Y-%m-%d")):
            found = ingest(spark, lake, [{"dt": day, "hours": []}], rules=EVENT_RULES)
            counted = [spark.table(lake.table(t)).count() for t in (READINGS, QUARANTINED, PIPELINE_RUNS, MARK_LOG, DEVICES)]
            parts.append((day, found or "none", *counted))
        names = ("clean_rows", "quarantined_rows", "audit_rows", "marks", "devices")
        return spark.createDataFrame(parts, "dt string, max_key string, " + ", ".join(f"{name} long" for name in names))

    return _in_new_lake(spark, work)


def counts_per_date(spark, sf_dir):
    return ops.counts_per_date(_summary(spark, sf_dir))


def partition_manifest(spark, sf_dir):
    return ops.partition_manifest(_summary(spark, sf_dir))


def audit_records(spark, sf_dir):
    """Whole-day groups for the range of the data."""
    summary = _summary(spark, sf_dir)
    last = F.split(ops.run_max_key(summary).scalar(), "T")[0]
    return ops.audit_records(ops.backfill_groups(spark, *_window(_readings(spark, sf_dir))), summary, last, RUN)


def audit_history(spark, sf_dir):
    """Two runs appended to the audit table: the whole range, then the hours of a re-run."""

    def work(lake):
        create_tables(spark, lake, [PIPELINE_RUNS])
        sinks.append_audit(audit_records(spark, sf_dir), lake)
        start, _ = _window(_readings(spark, sf_dir))
        again = spark.createDataFrame([(start, ["22", "23"])], ["dt", "hours"])
        rerun = ops.run_summary(sources.where_groups(_flagged(spark, sf_dir), [{"dt": start, "hours": ["22", "23"]}]))
        sinks.append_audit(ops.audit_records(again, rerun, start, {**RUN, "run_id": "run-2"}), lake)
        history = sources.read_audit(spark, lake.path(PIPELINE_RUNS))
        return history.select("run_id", "target_date", "hours_processed", "status", "records_clean", "records_quarantined")

    return _in_new_lake(spark, work)


# --- KPIs ---


def kpi_device_health(spark, sf_dir):
    return _plain(ops.device_health(*_split(spark, sf_dir), *_window(_readings(spark, sf_dir))))


def _device_kpi(spec):
    def query(spark, sf_dir):
        return _plain(ops.daily_kpi(_clean(spark, sf_dir), spec, *_window(_readings(spark, sf_dir))))

    return query


def good_and_bad_per_group(spark, sf_dir):
    keys = ["dt", "device_type", "facility_id"]
    good, bad = _split(spark, sf_dir)
    good = good.groupBy(*keys).agg(F.count("*").alias("good"))
    bad = bad.groupBy(*keys).agg(F.count("*").alias("bad"))
    return ops.full_join(good, bad, keys).fillna(0, ["good", "bad"])


def _motor_versions(spark, sf_dir):
    """Motor KPI of all readings, and of the clean ones for the middle of the range."""
    readings = _readings(spark, sf_dir)
    old = ops.daily_kpi(readings, ops.MOTOR_VIBRATION, *_window(readings))
    new = ops.daily_kpi(_clean(spark, sf_dir), ops.MOTOR_VIBRATION, *MIDDLE)
    return old, new


MIDDLE = ("2024-01-11", "2024-01-20")


def range_replace(spark, sf_dir):
    old, new = _motor_versions(spark, sf_dir)
    return _plain(sinks.replaced_range(old, new, *MIDDLE))


def kpi_table_range_replace(spark, sf_dir):
    """The same replacement done twice over in a stored KPI table."""

    def work(lake):
        table = ops.MOTOR_VIBRATION.table
        create_tables(spark, lake, [table])
        old, new = _motor_versions(spark, sf_dir)
        sinks.range_replace(spark, lake, table, old, *_window(_readings(spark, sf_dir)))
        for _ in range(2):
            sinks.range_replace(spark, lake, table, new, *MIDDLE)
        return _plain(spark.table(lake.table(table)))

    return _in_new_lake(spark, work)


def kpi_lookup(spark, sf_dir):
    """One device on one date, from the stored table."""

    def work(lake):
        table = ops.MOTOR_VIBRATION.table
        create_tables(spark, lake, [table])
        start, end = _window(_readings(spark, sf_dir))
        kpi = ops.daily_kpi(_clean(spark, sf_dir), ops.MOTOR_VIBRATION, start, end)
        sinks.range_replace(spark, lake, table, kpi, start, end)
        return _plain(ops.kpi_lookup(spark.table(lake.table(table)), "2024-01-07", "7"))

    return _in_new_lake(spark, work)


def max_clean_date(spark, sf_dir):
    return ops.max_clean_date(_clean(spark, sf_dir), *_window(_readings(spark, sf_dir)))


def avg_temp_by_type(spark, sf_dir):
    return ops.avg_temp_by_type(_clean(spark, sf_dir), "2024-01-15")


# --- planning and marks ---


def missing_hours(spark, sf_dir):
    readings = _readings(spark, sf_dir)
    due = ops.missing_hours(_device_marks(readings), _after(_window(readings)[1]))
    return due.select("pipeline_id", "dt", F.explode("hours").alias("hour"))


def ordered_groups(spark, sf_dir):
    """Due groups in the order they are worked on, oldest first, with the readings that wait there."""
    readings = _readings(spark, sf_dir)
    start, end = _window(readings)
    mark = spark.createDataFrame([("p", start, "11")], ["pipeline_id", "last_loaded_dt", "last_loaded_hour"])
    waiting = readings.groupBy("dt").agg(F.count("*").alias("rows"))
    due = ops.missing_hours(mark, _after(end)).join(waiting, "dt", "left").fillna(0, ["rows"])
    groups = [(n, r.dt, ",".join(r.hours), r.rows) for n, r in enumerate(due.orderBy("dt").collect())]
    return spark.createDataFrame(groups, "position long, dt string, hours string, rows long")


def missing_dates(spark, sf_dir):
    """Every device feeds a KPI of its own that stopped at the device's first date."""
    readings = _readings(spark, sf_dir)
    own_id = F.concat(F.lit("kpi-"), F.col("device_id")).alias("pipeline_id")
    first = F.min(F.col("dt").cast("date")).cast("string").alias("last_aggregated_dt")
    own = readings.groupBy("device_id").agg(first).select(own_id, "last_aggregated_dt")
    marks = _device_marks(readings).drop("last_aggregated_dt").unionByName(own, allowMissingColumns=True)
    links = readings.select(own_id, F.col("device_id").alias("upstream_id")).distinct()
    return ops.missing_dates(marks, links, _after(_window(readings)[1]).date())


def backfill_groups(spark, sf_dir):
    """The dates of a backfill with the readings waiting there."""
    readings = _readings(spark, sf_dir)
    waiting = readings.groupBy("dt").agg(F.count("*").alias("rows"))
    groups = ops.backfill_groups(spark, *_window(readings)).select("dt", F.size("hours").alias("hours_listed"))
    return groups.join(waiting, "dt", "left").fillna(0, ["rows"])


def advance_marks(spark, sf_dir):
    """Marks of the first half of the month, then everything found, older rows included."""
    readings = _readings(spark, sf_dir)
    marks = _device_marks(readings.where(F.col("dt") <= "2024-01-15"))
    found = readings.select(F.col("device_id").alias("pipeline_id"), mark_key().alias("last_loaded_key"))
    advanced = ops.advance_marks(marks, found)
    return advanced.select("pipeline_id", "last_loaded_dt", "last_loaded_hour", "last_loaded_key")


def newer_marks(spark, sf_dir):
    """Marks that a run over the error reports would move forward."""
    readings = _readings(spark, sf_dir)
    marks = _device_marks(readings.where(F.col("device_type") != "unmapped"))
    found = _device_marks(readings.where(F.col("device_type") == "unmapped"))
    return ops.newer_marks(marks, found).select("pipeline_id", "last_loaded_key")


def expected_partitions(spark, sf_dir):
    """The calendar with the readings of each hour, zero where there are none."""
    readings = _readings(spark, sf_dir)
    rows = readings.groupBy("dt", "hour").agg(F.count("*").alias("rows"))
    return ops.expected_partitions(spark, *_window(readings)).join(rows, ["dt", "hour"], "left").fillna(0, ["rows"])


def hour_coverage(spark, sf_dir):
    readings = _readings(spark, sf_dir)
    gaps = ops.coverage_gaps(readings, "device_id", *_window(readings))
    return gaps.withColumn("hours", F.concat_ws(",", "hours"))


# Ids and times of a run differ each time: one word each for what must hold of them.
_RUN_VALUES = {
    "run_id": "CASE WHEN run_id RLIKE '^[0-9]{8}T[0-9]{6}-[0-9a-f]{8}$' THEN 'an id' END",
    "run_timestamp": "CASE WHEN run_timestamp = started_at THEN 'the start' END",
    "started_at": "CASE WHEN to_timestamp(started_at) <= to_timestamp(completed_at) THEN 'a start' END",
    "completed_at": "CASE WHEN to_timestamp(completed_at) <= now() THEN 'an end' END",
    "duration_seconds": "CASE WHEN abs(cast(to_timestamp(completed_at) AS double) - cast(to_timestamp(started_at) AS double) "
    "- duration_seconds) < 0.06 THEN 'their difference' END",
}


def full_run(spark, sf_dir):
    """Land, backfill through the gate into the tables, refresh the KPIs: every row and column that the run wrote, in one long form."""

    def work(lake):
        readings = _readings(spark, sf_dir)
        start, end = _window(readings)
        _land(readings, lake)
        run(spark, lake, backfill={"start_date": start, "end_date": end}, now=NOW, max_days=100_000, rules=EVENT_RULES)
        parts = []
        for table in (READINGS, QUARANTINED, PIPELINE_RUNS, MARK_LOG, DEVICES, *KPI_COLUMNS):
            df = spark.table(lake.table(table))
            if table in (READINGS, QUARANTINED):
                numbers = (F.coalesce(F.col(c).cast("decimal(18,2)"), F.lit(-1)) for c in NUMERIC_COLUMNS)
                df = df.withColumns(dict(zip(NUMERIC_COLUMNS, numbers, strict=True)))
            if table == READINGS:
                df = df.withColumn("event_ts", event_time_text(F.col("event_ts")))
            if table == PIPELINE_RUNS:
                df = df.withColumns({name: F.expr(sql) for name, sql in _RUN_VALUES.items()})
            values = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("-")) for c in sorted(df.columns)]
            parts.append(df.select(F.lit(table).alias("table"), F.concat_ws("|", *values).alias("row")))
        return reduce(DataFrame.union, parts)

    return _in_new_lake(spark, work)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: daily device health of the smallest test set."""
    return kpi_device_health(spark, "/root/testdata/sf0.001")


def lake_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Query name -> callable(spark, sf_dir)."""
    listed = (
        scan_date_groups,
        land_and_scan_raw,
        land_two_batches,
        register_raw_partitions,
        normalize_numeric,
        parse_event_time,
        clean_table,
        quarantine_table,
        dq_nulls,
        dq_ranges,
        dq_duplicates,
        dq_flags,
        dq_clean,
        dq_quarantine,
        run_summary,
        run_max_key,
        empty_input_guard,
        counts_per_date,
        partition_manifest,
        audit_records,
        audit_history,
        kpi_device_health,
        good_and_bad_per_group,
        range_replace,
        kpi_table_range_replace,
        kpi_lookup,
        max_clean_date,
        avg_temp_by_type,
        missing_hours,
        ordered_groups,
        missing_dates,
        backfill_groups,
        advance_marks,
        newer_marks,
        expected_partitions,
        hour_coverage,
        full_run,
    )
    return {
        **{query.__name__: query for query in listed},
        "kpi_motor_vibration": _device_kpi(ops.MOTOR_VIBRATION),
        "kpi_cold_storage": _device_kpi(ops.COLD_STORAGE),
        "kpi_hvac_stability": _device_kpi(ops.HVAC_STABILITY),
        "kpi_energy_voltage": _device_kpi(ops.ENERGY_VOLTAGE),
    }


# --- SQL counterparts ---

READINGS_CTE = """
WITH ev AS (
  SELECT event_id, ts, user_id, event_type, value, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events
),
readings AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS device_id,
         CASE event_type WHEN 'click' THEN 'hvac_unit' WHEN 'purchase' THEN 'motor' WHEN 'view' THEN 'cold_storage_unit'
              WHEN 'signup' THEN 'smart_meter' WHEN 'error' THEN 'unmapped' END AS device_type,
         CASE WHEN k <> 97 THEN 'FAC-0' || CAST(k % 3 + 1 AS VARCHAR) END AS facility_id,
         'zone-' || CAST(k % 4 AS VARCHAR) AS zone,
         date_trunc('hour', ts) AS event_ts,
         CASE WHEN k <> 99 THEN CAST(k AS DOUBLE) END AS battery_pct,
         CASE WHEN k <> 98 THEN CAST(value AS DECIMAL(18,2)) END AS reading,
         CAST(k AS DOUBLE) AS second, k,
         strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%H') AS hour
  FROM ev
),
flags AS (
  SELECT *, count(*) OVER (PARTITION BY device_id, event_ts) > 1 AS is_duplicate,
         device_id IS NULL OR device_type IS NULL OR event_ts IS NULL OR battery_pct IS NULL AS is_null,
         COALESCE(device_type <> 'unmapped' AND (reading < 0.5 OR reading > 200), FALSE) AS out_of_range
  FROM readings
),
flagged AS (SELECT *, is_duplicate OR is_null OR out_of_range AS is_bad FROM flags),
clean AS (SELECT * FROM flagged WHERE NOT is_bad),
bad AS (SELECT * FROM flagged WHERE is_bad),
summary AS (SELECT dt, hour, is_bad, count(*) AS "rows" FROM flagged GROUP BY ALL),
per_date AS (
  SELECT dt, CAST(count(*) FILTER (NOT is_bad) AS BIGINT) AS records_clean,
         CAST(count(*) FILTER (is_bad) AS BIGINT) AS records_quarantined FROM flagged GROUP BY dt
),
marks AS (SELECT device_id, max(event_ts) AS last_ts, min(dt) AS first_dt FROM readings GROUP BY device_id)
"""

def _measure_sql(name: str, value: str, *types: str) -> str:
    listed = ", ".join(f"'{t}'" for t in types)
    return f"COALESCE(CASE WHEN device_type IN ({listed}) THEN CAST({value} AS DOUBLE) END, -1) AS {name}"


READING_ROWS = ", ".join(
    [
        "device_id, device_type, facility_id, zone, 'OK' AS status_code, '1.0.0' AS firmware_version",
        "COALESCE(battery_pct, -1) AS battery_pct",
        _measure_sql("temperature_c", "reading", "hvac_unit", "cold_storage_unit", "unmapped"),
        _measure_sql("humidity_pct", "second", "hvac_unit", "unmapped"),
        _measure_sql("vibration_mm_s", "reading", "motor"),
        _measure_sql("rpm", "second", "motor"),
        _measure_sql("door_open_count", "second", "cold_storage_unit"),
        _measure_sql("energy_kwh", "reading", "smart_meter"),
        _measure_sql("voltage", "second", "smart_meter"),
        "strftime(event_ts, '%Y-%m-%dT%H:%M:%S.000Z') AS event_ts, dt, hour",
    ]
)
TIME_TEXT = "strftime(event_ts, '%Y-%m-%dT%H:%M:%S+00:00') AS \"timestamp\""


def _round2(expr: str) -> str:
    """Two places, half up on the decimal digits, as a double."""
    return f"CAST(round(CAST({expr} AS DECIMAL(28,12)), 2) AS DOUBLE)"


def _mean2(column: str) -> str:
    return _round2(f"CAST(sum({column}) AS DOUBLE) / NULLIF(count({column}), 0)")


def _kpi_sql(source: str, device_type: str, keys: str, measures: str) -> str:
    return (
        f"SELECT dt, {keys}, {measures}, count(*) AS reading_count FROM {source} "
        f"WHERE device_type = '{device_type}' GROUP BY dt, {keys}"
    )


def _long_sql(table: str, source: str, **columns: str) -> str:
    """Rows of one table of `full_run`: its columns by name, as text."""
    values = ", ".join(f"COALESCE(CAST({columns[name]} AS VARCHAR), '-')" for name in sorted(columns))
    return f"SELECT '{table}' AS \"table\", concat_ws('|', {values}) AS \"row\" FROM ({source})"


def _full_run_sql(health: str, audit: str) -> str:
    money, rate = "CAST({} AS DECIMAL(10,2))", "CAST({} AS DECIMAL(5,2))"
    keys = {"dt": "dt", "device_id": "device_id", "facility_id": "facility_id", "reading_count": "reading_count"}

    def kpi(table: str, device_type: str, more_keys: str = "", **measures: str) -> str:
        named = ", ".join([f"{sql} AS {name}" for name, sql in measures.items()] + ["1 AS one"])
        source = _kpi_sql("clean", device_type, "device_id, facility_id" + more_keys, named)
        return _long_sql(table, source, **keys, **{name: name for name in measures}, **({"zone": "zone"} if more_keys else {}))

    counts = {c: c for c in ("dt", "device_type", "facility_id", "clean_reading_count", "quarantined_reading_count", "total_reading_count")}
    columns = {c: c for c in (*TEXT_COLUMNS, "event_ts", "dt", "hour")}
    columns |= {c: f"CAST({c} AS DECIMAL(18,2))" for c in NUMERIC_COLUMNS}
    average = money.format(_mean2("reading"))
    last = "(SELECT max(dt || 'T' || hour) AS key FROM readings)"
    parts = [
        _long_sql(READINGS, f"SELECT {READING_ROWS} FROM clean", **columns),
        _long_sql(QUARANTINED, f"SELECT {READING_ROWS}, {TIME_TEXT} FROM bad", **columns, timestamp='"timestamp"', raw_line="NULL"),
        _long_sql(DEVICES, "SELECT device_id, min(dt) AS first_dt FROM flagged GROUP BY device_id", device_id="device_id", first_dt="first_dt"),
        _long_sql(
            PIPELINE_RUNS, audit, dt="target_date", target_date="target_date", hours_processed="'ALL'", status="'SUCCESS'",
            records_clean="records_clean", records_quarantined="records_quarantined", run_id="'an id'",
            run_timestamp="'the start'", started_at="'a start'", completed_at="'an end'", duration_seconds="'their difference'",
        ),
        _long_sql(
            MARK_LOG, last, pipeline_id="'ingest'", status="NULL", last_loaded_dt="split_part(key, 'T', 1)",
            last_loaded_hour="split_part(key, 'T', 2)", last_loaded_key="key", last_aggregated_dt="NULL",
        ),
        _long_sql(
            MARK_LOG, "SELECT max(dt) AS dt FROM clean", pipeline_id="'kpi_refresh'", status="NULL", last_loaded_dt="NULL",
            last_loaded_hour="NULL", last_loaded_key="NULL", last_aggregated_dt="dt",
        ),
        _long_sql(
            ops.DEVICE_HEALTH_TABLE, health, **counts, dq_failure_rate_pct=rate.format("dq_failure_rate_pct"),
            avg_battery_pct=money.format("avg_battery_pct"), min_battery_pct=money.format("min_battery_pct"),
        ),
        kpi(ops.MOTOR_VIBRATION.table, "motor", avg_vibration_mm_s=average, max_vibration_mm_s=money.format("max(reading)")),
        kpi(
            ops.COLD_STORAGE.table, "cold_storage_unit", avg_temperature_c=average,
            total_door_open_count="CAST(sum(second) AS BIGINT)",
        ),
        kpi(
            ops.HVAC_STABILITY.table, "hvac_unit", ", zone", avg_temperature_c=average,
            stddev_temperature_c=money.format(_round2("stddev_samp(CAST(reading AS DOUBLE))")),
        ),
        kpi(
            ops.ENERGY_VOLTAGE.table, "smart_meter", total_energy_kwh=money.format("sum(reading)"),
            avg_voltage=money.format(_mean2("second")), min_voltage=money.format("min(second)"),
        ),
    ]
    return " UNION ALL ".join(parts)


def lake_sql() -> dict[str, str]:
    """Query name -> the same result in DuckDB SQL."""
    motor = f"{_mean2('reading')} AS avg_vibration_mm_s, CAST(max(reading) AS DOUBLE) AS max_vibration_mm_s"
    device_keys = "device_id, facility_id"
    health = f"""
      SELECT COALESCE(c.dt, q.dt) AS dt, COALESCE(c.device_type, q.device_type) AS device_type,
             COALESCE(c.facility_id, q.facility_id) AS facility_id,
             COALESCE(c.good, 0) AS clean_reading_count, COALESCE(q.bad, 0) AS quarantined_reading_count,
             COALESCE(c.good, 0) + COALESCE(q.bad, 0) AS total_reading_count,
             {_round2("CAST(COALESCE(q.bad, 0) AS DOUBLE) * 100 / (COALESCE(c.good, 0) + COALESCE(q.bad, 0))")}
               AS dq_failure_rate_pct,
             c.avg_battery_pct, c.min_battery_pct
      FROM (SELECT dt, device_type, facility_id, count(*) AS good, {_mean2("battery_pct")} AS avg_battery_pct,
                   min(battery_pct) AS min_battery_pct FROM clean GROUP BY ALL) c
      FULL OUTER JOIN (SELECT dt, device_type, facility_id, count(*) AS bad FROM bad GROUP BY ALL) q
        ON c.dt = q.dt AND c.device_type = q.device_type AND c.facility_id = q.facility_id"""
    replaced = f"""
      SELECT * FROM ({_kpi_sql("readings", "motor", device_keys, motor)})
        WHERE dt NOT BETWEEN '{MIDDLE[0]}' AND '{MIDDLE[1]}'
      UNION ALL
      SELECT * FROM ({_kpi_sql("clean", "motor", device_keys, motor)})
        WHERE dt BETWEEN '{MIDDLE[0]}' AND '{MIDDLE[1]}'"""
    calendar = """SELECT ts FROM (SELECT unnest(generate_series(
      CAST((SELECT min(dt) FROM readings) AS TIMESTAMP), CAST((SELECT max(dt) FROM readings) AS TIMESTAMP) + INTERVAL 23 HOUR,
      INTERVAL 1 HOUR)) AS ts)"""
    audit = f"""
      SELECT g.dt AS target_date, COALESCE(p.records_clean, 0)::BIGINT AS records_clean,
             COALESCE(p.records_quarantined, 0)::BIGINT AS records_quarantined
      FROM (SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS dt FROM ({calendar})) g LEFT JOIN per_date p ON g.dt = p.dt
      WHERE g.dt <= (SELECT max(dt) FROM readings)"""
    body = {
        "scan_date_groups": """
          SELECT dt, hour, count(*) AS "rows", sum(battery_pct) AS battery FROM readings
          WHERE (dt = '2024-01-01' AND hour >= '12') OR dt BETWEEN '2024-01-02' AND '2024-01-30' GROUP BY dt, hour""",
        "land_and_scan_raw": f"SELECT {READING_ROWS}, {TIME_TEXT} FROM readings",
        "land_two_batches": """
          SELECT dt, hour, count(*) AS "rows", count(*) FILTER (late) AS unreadable FROM (
            SELECT dt, hour, false AS late FROM readings WHERE hour < '12' OR CAST(device_id AS BIGINT) % 2 = 1
            UNION ALL SELECT '2024-02-01', '05', true FROM readings WHERE CAST(device_id AS BIGINT) % 2 = 1)
          GROUP BY dt, hour""",
        "register_raw_partitions": 'SELECT dt, hour, count(*) AS "rows" FROM readings GROUP BY dt, hour',
        "normalize_numeric": """
          SELECT event_id, COALESCE(TRY_CAST(CASE WHEN k = 99 THEN 'n/a' WHEN k IN (96, 97, 98) THEN NULL
              WHEN CAST(k AS VARCHAR) < '5' THEN CAST(k AS VARCHAR) ELSE CAST(value AS VARCHAR) END AS DOUBLE), -1)
              AS number FROM ev""",
        "parse_event_time": """
          SELECT event_id, CASE WHEN k IN (98, 99) THEN NULL WHEN CAST(k AS VARCHAR) < '5'
              THEN strftime(ts - INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S')
              ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS event_ts FROM ev""",
        "clean_table": f"SELECT {READING_ROWS} FROM clean",
        "quarantine_table": f"SELECT {READING_ROWS}, {TIME_TEXT}, NULL AS raw_line FROM bad",
        "dq_nulls": "SELECT event_id, is_null FROM flagged",
        "dq_ranges": "SELECT event_id, out_of_range FROM flagged",
        "dq_duplicates": "SELECT event_id, is_duplicate FROM flagged",
        "dq_flags": """
          SELECT is_duplicate, is_null, out_of_range, is_bad, count(*) AS "rows" FROM flagged
          GROUP BY is_duplicate, is_null, out_of_range, is_bad""",
        "dq_clean": "SELECT event_id, device_id, device_type, dt, hour FROM clean",
        "dq_quarantine": """
          SELECT event_id, device_id, device_type, dt, hour,
                 strftime(event_ts, '%Y-%m-%dT%H:%M:%S+00:00') AS "timestamp" FROM bad""",
        "run_summary": "SELECT * FROM summary",
        "run_max_key": "SELECT max(dt || 'T' || hour) AS max_key FROM readings",
        "empty_input_guard": """
          SELECT CASE WHEN n = 0 THEN first_dt ELSE next_dt END AS dt, CASE WHEN n = 0 THEN max_key ELSE 'none' END AS max_key,
                 clean_rows, quarantined_rows, 1 AS audit_rows, 1 AS marks, devices
          FROM (SELECT min(dt) AS first_dt, max(dt || 'T' || hour) AS max_key, count(*) FILTER (NOT is_bad) AS clean_rows,
                       count(*) FILTER (is_bad) AS quarantined_rows, count(DISTINCT device_id) AS devices
                FROM flagged WHERE dt = (SELECT min(dt) FROM readings)),
               (SELECT strftime(CAST(max(dt) AS DATE) + INTERVAL 1 DAY, '%Y-%m-%d') AS next_dt FROM readings),
               (SELECT unnest([0, 1]) AS n)""",
        "counts_per_date": "SELECT * FROM per_date",
        "partition_manifest": """
          SELECT dt, hour, bool_or(NOT is_bad) AS has_clean, bool_or(is_bad) AS has_quarantine
          FROM flagged GROUP BY dt, hour""",
        "audit_records": f"""
          SELECT 'run-1' AS run_id, '{RUN["run_timestamp"]}' AS run_timestamp, target_date, 'ALL' AS hours_processed,
                 'SUCCESS' AS status, '{RUN["started_at"]}' AS started_at, '{RUN["completed_at"]}' AS completed_at,
                 CAST(60 AS DOUBLE) AS duration_seconds, records_clean, records_quarantined, target_date AS dt
          FROM ({audit})""",
        "audit_history": f"""
          SELECT 'run-1' AS run_id, target_date, 'ALL' AS hours_processed, 'SUCCESS' AS status,
                 records_clean, records_quarantined FROM ({audit})
          UNION ALL
          SELECT 'run-2', (SELECT min(dt) FROM readings), '22,23', 'SUCCESS', (count(*) FILTER (NOT is_bad))::BIGINT,
                 (count(*) FILTER (is_bad))::BIGINT
          FROM flagged WHERE dt = (SELECT min(dt) FROM readings) AND hour IN ('22', '23')""",
        "kpi_device_health": health,
        "full_run": _full_run_sql(health, audit),
        "good_and_bad_per_group": """
          SELECT COALESCE(c.dt, q.dt) AS dt, COALESCE(c.device_type, q.device_type) AS device_type,
                 COALESCE(c.facility_id, q.facility_id) AS facility_id,
                 COALESCE(good, 0) AS good, COALESCE(bad, 0) AS bad
          FROM (SELECT dt, device_type, facility_id, count(*) AS good FROM clean GROUP BY ALL) c
          FULL OUTER JOIN (SELECT dt, device_type, facility_id, count(*) AS bad FROM bad GROUP BY ALL) q
            ON c.dt = q.dt AND c.device_type = q.device_type AND c.facility_id = q.facility_id""",
        "kpi_motor_vibration": _kpi_sql("clean", "motor", device_keys, motor),
        "kpi_cold_storage": _kpi_sql(
            "clean",
            "cold_storage_unit",
            device_keys,
            f"{_mean2('reading')} AS avg_temperature_c, CAST(sum(second) AS BIGINT) AS total_door_open_count",
        ),
        "kpi_hvac_stability": _kpi_sql(
            "clean",
            "hvac_unit",
            f"{device_keys}, zone",
            f"{_mean2('reading')} AS avg_temperature_c, "
            f"{_round2('stddev_samp(CAST(reading AS DOUBLE))')} AS stddev_temperature_c",
        ),
        "kpi_energy_voltage": _kpi_sql(
            "clean",
            "smart_meter",
            device_keys,
            f"CAST(sum(reading) AS DOUBLE) AS total_energy_kwh, {_mean2('second')} AS avg_voltage, "
            "min(second) AS min_voltage",
        ),
        "range_replace": replaced,
        "kpi_table_range_replace": replaced,
        "kpi_lookup": f"""
          SELECT * FROM ({_kpi_sql("clean", "motor", device_keys, motor)})
          WHERE dt = '2024-01-07' AND device_id = '7'""",
        "max_clean_date": "SELECT max(dt) AS max_dt FROM clean",
        "avg_temp_by_type": """
          SELECT device_type, CAST(sum(temperature) AS DOUBLE) / NULLIF(count(temperature), 0) AS avg_temperature_c
          FROM (SELECT *, CASE WHEN device_type NOT IN ('motor', 'smart_meter') THEN reading END AS temperature FROM clean)
          WHERE dt = '2024-01-15' GROUP BY device_type""",
        "missing_hours": """
          SELECT device_id AS pipeline_id, strftime(h, '%Y-%m-%d') AS dt, strftime(h, '%H') AS hour
          FROM (SELECT device_id, unnest(generate_series(last_ts + INTERVAL 1 HOUR, 
                (SELECT CAST(max(dt) AS TIMESTAMP) + INTERVAL 28 HOUR FROM readings), INTERVAL 1 HOUR)) AS h FROM marks)""",
        "ordered_groups": f"""
          SELECT row_number() OVER (ORDER BY dt) - 1 AS position, dt, hours, COALESCE(n, 0) AS "rows"
          FROM (SELECT strftime(ts, '%Y-%m-%d') AS dt, string_agg(strftime(ts, '%H'), ',' ORDER BY ts) AS hours
                FROM ({calendar} UNION ALL
                      SELECT unnest(generate_series(CAST(max(dt) AS TIMESTAMP) + INTERVAL 24 HOUR,
                             CAST(max(dt) AS TIMESTAMP) + INTERVAL 28 HOUR, INTERVAL 1 HOUR)) FROM readings)
                WHERE ts >= (SELECT CAST(min(dt) AS TIMESTAMP) + INTERVAL 12 HOUR FROM readings) GROUP BY 1)
          LEFT JOIN (SELECT dt, count(*) AS n FROM readings GROUP BY dt) USING (dt)""",
        "missing_dates": """
          SELECT 'kpi-' || device_id AS pipeline_id, start_date, end_date FROM (
            SELECT device_id, strftime(CAST(first_dt AS DATE) + INTERVAL 1 DAY, '%Y-%m-%d') AS start_date,
                   strftime(CASE WHEN hour(last_ts) = 23 THEN last_ts ELSE last_ts - INTERVAL 1 DAY END, '%Y-%m-%d')
                     AS end_date FROM marks) WHERE start_date <= end_date""",
        "backfill_groups": f"""
          SELECT g.dt, 0 AS hours_listed, count(r.event_id) AS "rows"
          FROM (SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS dt FROM ({calendar})) g
          LEFT JOIN readings r ON g.dt = r.dt GROUP BY g.dt""",
        "advance_marks": """
          SELECT device_id AS pipeline_id, strftime(last_ts, '%Y-%m-%d') AS last_loaded_dt,
                 strftime(last_ts, '%H') AS last_loaded_hour, strftime(last_ts, '%Y-%m-%dT%H') AS last_loaded_key
          FROM marks""",
        "newer_marks": """
          SELECT device_id AS pipeline_id, strftime(new_ts, '%Y-%m-%dT%H') AS last_loaded_key FROM (
            SELECT device_id, max(event_ts) FILTER (device_type = 'unmapped') AS new_ts,
                   max(event_ts) FILTER (device_type <> 'unmapped') AS old_ts FROM readings GROUP BY device_id)
          WHERE new_ts > old_ts OR (old_ts IS NULL AND new_ts IS NOT NULL)""",
        "expected_partitions": f"""
          SELECT strftime(c.ts, '%Y-%m-%d') AS dt, strftime(c.ts, '%H') AS hour, count(r.event_id) AS "rows"
          FROM ({calendar}) c LEFT JOIN readings r ON r.event_ts = c.ts GROUP BY c.ts""",
        "hour_coverage": f"""
          SELECT device_id, strftime(ts, '%Y-%m-%d') AS dt, string_agg(strftime(ts, '%H'), ',' ORDER BY ts) AS hours
          FROM (SELECT device_id, c.ts FROM marks CROSS JOIN ({calendar}) c
                EXCEPT SELECT device_id, event_ts FROM readings) GROUP BY ALL""",
    }
    return {name: READINGS_CTE + sql for name, sql in body.items()}


# --- everything registered ---


def _training_data() -> tuple[dict, dict]:
    """Queries and SQL of the training-data operators; none where that part is not installed."""
    try:
        import corpus_pipeline
        from telemetry_lake.llm import queries as llm
    except ImportError as error:
        if getattr(error, "name", None) not in ("corpus_pipeline", "telemetry_lake.llm"):
            warnings.warn(f"the training-data queries are left out: {error}", stacklevel=2)
        return {}, {}
    sql = {} if corpus_pipeline.ORACLE_SQL is None else {"pipeline": corpus_pipeline.ORACLE_SQL}
    return {**llm.QUERIES, "pipeline": corpus_pipeline.run}, {**llm.ORACLES, **sql}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**lake_queries(), **_training_data()[0]}


def oracle_sql() -> dict[str, str]:
    return {**lake_sql(), **_training_data()[1]}
