"""Bronze -> silver staging (cleansing, tokenization, typing, de-duplication)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.functions import (amount_or_zero, lit_ts, row_fingerprint, strip_prefix,
                                tokenize, trim_or_default)
from carelake.operators.dedupe import latest_per_key
from carelake.operators.lookup import bounded_broadcast

PATIENT_ATTRS = ["mrn_token", "first_name", "last_name", "birth_date", "gender",
                 "zip_code", "payer_name"]
ENCOUNTER_COLS = ["pat_id", "encounter_id", "visit_type_c", "encounter_type",
                  "encounter_dttm", "dept_id", "prov_id", "primary_dx_id",
                  "primary_dx_code", "encounter_status"]
CHARGE_COLS = ["encounter_id", "charge_id", "cpt_code", "billed_amt", "paid_amt",
               "allowed_amt", "claim_status", "charge_dttm"]
CHARGE_KEYS = ["encounter_id", "charge_id"]


def charge_order() -> list[Column]:
    """Latest charge first (a total order within a key)."""
    return [F.col("charge_dttm").desc_nulls_last()] + [
        F.col(c).desc_nulls_last() for c in ("cpt_code", "billed_amt", "allowed_amt",
                                             "paid_amt", "claim_status")]


def latest_charges(staged: DataFrame) -> DataFrame:
    """One row per charge key, the same choice as the nightly upsert's."""
    return latest_per_key(staged, CHARGE_KEYS, charge_order())


def stage_patients(bronze_patient: DataFrame, mrn_salt: str | None = None,
                   latest_by: list[Column] | None = None) -> DataFrame:
    """Cleansed patient rows plus ``attr_hash``.

    * NULL ``pat_id`` rows dropped; MRN replaced by its SHA-256 token.
    * Names/gender/zip/payer: ``coalesce(trim(x), default)``.
    * ``dropDuplicates(pat_id, attr_hash)``; with ``latest_by`` (e.g. the
      ingestion timestamp descending) only the newest delivery per patient is
      kept, so two historic versions cannot both become current.
    """
    df = bronze_patient.filter(F.col("pat_id").isNotNull())
    if latest_by:
        df = latest_per_key(df, ["pat_id"], latest_by)
    df = df.select(
        "pat_id",
        tokenize("mrn", mrn_salt).alias("mrn_token"),
        trim_or_default("first_name", "UNKNOWN").alias("first_name"),
        trim_or_default("last_name", "UNKNOWN").alias("last_name"),
        F.col("birth_date").cast("date").alias("birth_date"),
        trim_or_default("gender", "U").alias("gender"),
        trim_or_default("zip_code", "00000").alias("zip_code"),
        trim_or_default("payer_name", "UNKNOWN").alias("payer_name"),
    )
    df = df.withColumn("attr_hash", row_fingerprint(*PATIENT_ATTRS))
    return df.dropDuplicates(["pat_id", "attr_hash"])


def active_types(encounter_types: DataFrame) -> DataFrame:
    return encounter_types.filter(F.col("is_active") == F.lit(True))


def stage_encounters(bronze_encounter: DataFrame, encounter_types: DataFrame,
                     load_ts: dt.datetime, tiebreak: list[Column] | None = None) -> DataFrame:
    """Typed, canonicalized encounters, one row per ``encounter_id``.

    ``encounter_type`` comes from the active type table (broadcast lookup);
    unmapped codes become ``OTHER``. The latest ``encounter_dttm`` wins
    (NULLs last); ``tiebreak`` makes the choice total.
    """
    types = bounded_broadcast(active_types(encounter_types)
                              .select("visit_type_c", "encounter_type"))
    df = (bronze_encounter
          .filter(F.col("pat_id").isNotNull() & F.col("encounter_id").isNotNull())
          .withColumn("encounter_dttm", F.col("encounter_dttm").cast("timestamp_ntz"))
          .withColumn("primary_dx_code", strip_prefix("primary_dx_id", "DX_"))
          .join(types, on="visit_type_c", how="left")
          .withColumn("encounter_type", F.coalesce(F.col("encounter_type"), F.lit("OTHER")))
          .select(*ENCOUNTER_COLS))
    order = [F.col("encounter_dttm").desc_nulls_last()]
    order += tiebreak if tiebreak is not None else [
        F.col(c).asc_nulls_last() for c in ("pat_id", "visit_type_c", "dept_id", "prov_id",
                                            "primary_dx_id", "encounter_status")]
    return latest_per_key(df, ["encounter_id"], order).withColumn("load_dttm", lit_ts(load_ts))


def stage_charges(bronze_charges: DataFrame, load_ts: dt.datetime) -> DataFrame:
    """Typed charges: NULL keys dropped, NULL amounts -> 0.00 (exact decimal)."""
    return (bronze_charges
            .filter(F.col("encounter_id").isNotNull() & F.col("charge_id").isNotNull())
            .select("encounter_id", "charge_id", "cpt_code",
                    amount_or_zero("billed_amt").alias("billed_amt"),
                    amount_or_zero("paid_amt").alias("paid_amt"),
                    amount_or_zero("allowed_amt").alias("allowed_amt"),
                    "claim_status",
                    F.col("charge_dttm").cast("timestamp_ntz").alias("charge_dttm"),
                    lit_ts(load_ts).alias("load_dttm")))
