"""Gold marts: billing claims, quality measures, care-gap queue."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.functions import calendar_years, days_between, flag, in_year, lit_date, lit_ts, tiered
from carelake.operators.lookup import bounded_broadcast
from carelake.operators.upsert import idempotency_summary, upsert_columns
from carelake.params import Params
from carelake.plans.staging import active_types

BILLING_KEYS = ["encounter_id", "charge_id"]
QUALITY_KEYS = ["pat_id", "encounter_id", "measure_id"]
GAP_KEYS = ["pat_id", "measure_id"]


def _update_cols(cols: list[str], keys: list[str]) -> list[str]:
    """Matched rows refresh everything but the keys and the first load time."""
    return [c for c in cols if c not in keys and c != "load_dttm"]


# ---- billing ----------------------------------------------------------------
def lookback_cutoff(params: Params) -> dt.datetime:
    """Midnight of ``as_of - lookback_days`` (``date_sub`` on a date)."""
    return dt.datetime.combine(params.as_of_date - dt.timedelta(days=params.lookback_days),
                               dt.time())


def billing_batch(dim_encounter: DataFrame, fact_charges: DataFrame,
                  encounter_types: DataFrame, params: Params) -> DataFrame:
    """Processed claims in the look-back window.

    * inner lookup to ACTIVE encounter types: unmapped visit types drop out
      (silver keeps them as OTHER);
    * ``claim_status != 'DENIED'`` also drops NULL statuses (3-valued logic);
    * look-back ``encounter_dttm >= as_of - N days`` (midnight), pushed to the
      scan;
    * the join has a hash of its key as a second key: an encounter side that a window left
      partitioned by ``encounter_id`` is exchanged again, so both inputs are plain exchanges and
      AQE can split the charges of a hot encounter.
    """
    cutoff = lookback_cutoff(params)
    types = bounded_broadcast(active_types(encounter_types)
                              .select("visit_type_c", F.col("encounter_type").alias("_det_type")))
    enc = (dim_encounter.filter(F.col("encounter_dttm") >= lit_ts(cutoff))
           .select("pat_id", "encounter_id", "encounter_dttm", "visit_type_c", "primary_dx_code")
           .join(types, "visit_type_c"))
    ch = (fact_charges.filter(F.col("claim_status") != F.lit("DENIED"))
          .select("encounter_id", "charge_id", "cpt_code", "billed_amt", "allowed_amt",
                  "paid_amt", "claim_status"))
    threshold = F.lit(params.high_cost_threshold).cast("decimal(20,2)")
    load = lit_ts(params.load_ts)
    spread = F.xxhash64("encounter_id")
    return enc.withColumn("_spread", spread).join(
        ch.withColumn("_spread", spread), ["encounter_id", "_spread"]).select(
        "pat_id", "encounter_id", "charge_id", "encounter_dttm",
        F.col("_det_type").alias("encounter_type"), "cpt_code", "primary_dx_code",
        F.lit(None).cast("string").alias("payer_id"),
        "billed_amt", "allowed_amt", "paid_amt",
        (F.col("allowed_amt") - F.col("paid_amt")).cast("decimal(12,2)")
        .alias("patient_responsibility"),
        flag(F.col("billed_amt") > threshold).alias("high_cost_flag"),
        "claim_status", load.alias("load_dttm"), load.alias("updated_dttm"))


def billing_upsert(target: DataFrame, batch: DataFrame, on_duplicate: str = "error") -> DataFrame:
    return upsert_columns(target, batch, BILLING_KEYS,
                          _update_cols(target.columns, BILLING_KEYS), on_duplicate)


# ---- quality ----------------------------------------------------------------
def quality_batch(eligibility: DataFrame, dim_encounter: DataFrame, dim_patient: DataFrame,
                  params: Params) -> DataFrame:
    """Eligible measure rows of the measurement year, enriched with the MRN
    token and the calendar-year age (``year(ts) - year(birth)``)."""
    enc = (dim_encounter.filter(in_year("encounter_dttm", params.measurement_year))
           .select("encounter_id", "encounter_dttm"))
    pat = (dim_patient.filter(F.col("is_current") == F.lit(True))
           .select("pat_id", F.col("mrn_token").alias("mrn"), "birth_date"))
    h = (eligibility.filter(F.col("measure_eligible") == "Y")
         .select("pat_id", "encounter_id", "measure_id", "measure_name", "measure_eligible",
                 "measure_compliant", "encounter_type"))
    load = lit_ts(params.load_ts)
    return h.join(enc, "encounter_id").join(pat, "pat_id").select(
        "pat_id", "encounter_id", "encounter_dttm", "mrn",
        calendar_years("encounter_dttm", "birth_date").alias("age_at_encounter"),
        "measure_id", "measure_name", "measure_eligible", "measure_compliant",
        "encounter_type", load.alias("load_dttm"), load.alias("updated_dttm"))


def quality_upsert(target: DataFrame, batch: DataFrame, on_duplicate: str = "error") -> DataFrame:
    return upsert_columns(target, batch, QUALITY_KEYS,
                          _update_cols(target.columns, QUALITY_KEYS), on_duplicate)


def quality_summary(measures: DataFrame, params: Params) -> DataFrame:
    """Measurement-year row count, distinct keys, compliant count, verdict."""
    cur = measures.filter(in_year("encounter_dttm", params.measurement_year))
    return idempotency_summary(cur, QUALITY_KEYS, {
        "compliant_count": F.count_if(F.col("measure_compliant") == "Y").cast("long")})


# ---- care gaps --------------------------------------------------------------
def last_encounter(dim_encounter: DataFrame, encounter_types: DataFrame) -> DataFrame:
    """Per patient: the latest encounter time and its canonical type.

    The latest time is taken over all encounters; its type comes from the
    active type table. Among encounters tied at the latest time a mapped one
    wins, then the highest ``encounter_id``. If none of the tied encounters
    maps, the patient has no row (as with the reference's inner join).

    One aggregate ``max(struct(...))`` per patient: partial aggregation on the
    map side keeps a patient with a huge history from landing in one task.
    """
    types = bounded_broadcast(active_types(encounter_types)
                              .select("visit_type_c", F.col("encounter_type").alias("_det_type")))
    top = F.max(F.struct(
        F.col("encounter_dttm").alias("ts"),
        F.col("_det_type").isNotNull().alias("mapped"),
        F.col("encounter_id").alias("encounter_id"),
        F.col("_det_type").alias("encounter_type")))
    return (dim_encounter.filter(F.col("encounter_dttm").isNotNull() & F.col("pat_id").isNotNull())
            .select("pat_id", "encounter_id", "encounter_dttm", "visit_type_c")
            .join(types, "visit_type_c", "left")
            .groupBy("pat_id").agg(top.alias("top"))
            .filter(F.col("top.mapped"))
            .select("pat_id", F.col("top.ts").alias("last_encounter_dttm"),
                    F.col("top.encounter_type").alias("encounter_type")))


def gap_batch(measures: DataFrame, dim_encounter: DataFrame, dim_patient: DataFrame,
              encounter_types: DataFrame, params: Params) -> DataFrame:
    """Open gaps (eligible, not compliant), one row per (patient, measure).

    Days since the last encounter: > high -> HIGH, > medium -> MEDIUM, else
    LOW (including patients without a usable last encounter).
    """
    gaps = (measures.filter((F.col("measure_eligible") == "Y") & (F.col("measure_compliant") == "N"))
            .groupBy("pat_id", "measure_id").agg(F.max("measure_name").alias("measure_name")))
    pat = (dim_patient.filter(F.col("is_current") == F.lit(True))
           .select("pat_id", F.col("mrn_token").alias("mrn"),
                   F.col("payer_name").alias("primary_payer_id")))
    lec = last_encounter(dim_encounter, encounter_types)
    days = days_between(lit_date(params.as_of_date), F.col("last_encounter_dttm"))
    load = lit_ts(params.load_ts)
    return (gaps.join(pat, "pat_id", "left").join(lec, "pat_id", "left").select(
        "pat_id", "mrn", "measure_id", "measure_name",
        days.cast("int").alias("days_since_last_encounter"),
        tiered(days, [(params.gap_high_days, "HIGH"), (params.gap_medium_days, "MEDIUM")], "LOW")
        .alias("gap_priority"),
        F.col("encounter_type").alias("encounter_type_for_outreach"),
        "primary_payer_id", load.alias("load_dttm"), load.alias("updated_dttm")))


def gap_upsert(target: DataFrame, batch: DataFrame, on_duplicate: str = "error") -> DataFrame:
    """Upsert the gap queue; gaps that closed since stay in it."""
    return upsert_columns(target, batch, GAP_KEYS, _update_cols(target.columns, GAP_KEYS), on_duplicate)


def gap_summary(queue: DataFrame) -> DataFrame:
    return idempotency_summary(queue, GAP_KEYS, {
        "high_priority": F.count_if(F.col("gap_priority") == "HIGH").cast("long")})


def gap_distribution(queue: DataFrame) -> DataFrame:
    return (queue.groupBy("gap_priority").agg(F.count(F.lit(1)).alias("gap_count"))
            .orderBy("gap_priority"))


def billing_summary(claims: DataFrame) -> DataFrame:
    return idempotency_summary(claims, BILLING_KEYS)
