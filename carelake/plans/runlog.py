"""Stage metrics log and SLA report (as Spark queries over the log table)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.functions import lit_ts


def stage_log_from_events(events: DataFrame, logged_at: dt.datetime) -> DataFrame:
    """An ``audit.orchestration_log`` view of an event table: one stage per
    (user, event type), its first/last event as start/end, FAILED for error
    events."""
    return (events.groupBy("user_id", "event_type")
            .agg(F.min("ts").alias("start_time"), F.max("ts").alias("end_time"),
                 F.count(F.lit(1)).alias("row_count"))
            .select(F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("run_id"),
                    F.col("event_type").alias("stage_name"), "start_time", "end_time",
                    F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCESS")
                    .alias("status"),
                    F.col("row_count").cast("long").alias("row_count"),
                    F.to_json(F.struct(F.lit("events").alias("source"))).alias("details"),
                    lit_ts(logged_at).alias("logged_at")))


def stage_record(run_id: str, stage: str, start: dt.datetime | None, end: dt.datetime | None,
                 status: str, row_count: int | None, details: str, logged_at: dt.datetime):
    """One log row as a tuple in ``ORCHESTRATION_LOG`` column order."""
    return (run_id, stage, start, end, status, row_count, details, logged_at)


def sla_report(log: DataFrame, deadline: str = "06:00", timezone: str = "America/New_York"
               ) -> DataFrame:
    """Per run: last stage end (UTC wall clock) converted to ``timezone``;
    the SLA is met when that local time is at or before ``deadline`` on the
    same local day."""
    hh, mm = (int(x) for x in deadline.split(":"))
    local = F.convert_timezone(F.lit("UTC"), F.lit(timezone), F.col("run_end_time"))
    runs = log.groupBy("run_id").agg(
        F.max("end_time").alias("run_end_time"),
        F.count(F.lit(1)).alias("stage_count"),
        F.count_if(F.col("status") == "FAILED").alias("failed_stages"))
    runs = runs.withColumn("run_completed_local", local)
    cutoff = F.make_timestamp_ntz(F.year("run_completed_local"), F.month("run_completed_local"),
                                  F.dayofmonth("run_completed_local"), F.lit(hh), F.lit(mm),
                                  F.lit(0))
    return runs.withColumn("sla_met", F.col("run_completed_local") <= cutoff)
