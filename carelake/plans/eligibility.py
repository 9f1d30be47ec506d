"""Measure eligibility by exact-match joins to effective-dated code sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.functions import completed_years, flag, lit_ts, valid_on
from carelake.operators.lookup import bounded_broadcast
from carelake.params import Params

OUTPUT = ["pat_id", "encounter_id", "measure_id", "measure_name", "measure_eligible",
          "measure_compliant", "age_at_encounter", "encounter_type", "load_dttm"]


def valid_codes(codes: DataFrame, code_type: str, params: Params) -> DataFrame:
    """Codes of one type valid on ``params.code_date`` (inclusive at both ends)."""
    return (codes.filter((F.col("code_type") == code_type)
                         & valid_on("effective_date", "expiration_date", params.code_date))
            .select("measure_id", F.col("code_value")))


def measure_names(measure_defs: DataFrame) -> DataFrame:
    """One name per measure id (a re-delivered definition must not fan out
    eligibility keys): the newest delivery when ingestion metadata exists."""
    if "_ingestion_timestamp" in measure_defs.columns:
        name = F.max_by("measure_name", F.struct("_ingestion_timestamp", "measure_name"))
    else:
        name = F.max("measure_name")
    return (measure_defs.filter(F.col("measure_id").isNotNull())
            .groupBy("measure_id").agg(name.alias("measure_name")))


def eligibility_batch(dim_patient: DataFrame, dim_encounter: DataFrame,
                      fact_charges: DataFrame, codes: DataFrame, measure_defs: DataFrame,
                      params: Params, with_time: bool = False) -> DataFrame:
    """Per (patient, encounter, measure) eligibility, in one pass over encounters. ``with_time`` adds
    the encounter's time as ``_encounter_dttm``.

    * CPT: charges are reduced through the broadcast code set to one row per
      encounter holding the set of matched measures (``collect_set``, combined
      map-side), so a hot encounter collapses before the shuffle and the
      aggregate's ``encounter_id`` partitioning serves the join directly;
    * ICD-10: the encounter's primary diagnosis is matched by a broadcast
      join (no shuffle);
    * both candidates are exploded and de-duplicated (UNION semantics). The
      distinct is clustered by ``encounter_id`` already, so it adds no shuffle.
    """
    names = bounded_broadcast(measure_names(measure_defs))
    cpt = bounded_broadcast(valid_codes(codes, "CPT", params))
    icd = bounded_broadcast(valid_codes(codes, "ICD10", params)
                            .select(F.col("code_value").alias("_icd_code"),
                                    F.col("measure_id").alias("_icd_measure")))
    cpt_hits = (fact_charges.filter(F.col("cpt_code").isNotNull())
                .select("encounter_id", "cpt_code")
                .join(cpt, F.col("cpt_code") == F.col("code_value"))
                .groupBy("encounter_id")
                .agg(F.collect_set("measure_id").alias("_cpt_measures")))

    encounters = (dim_encounter
                  .filter(F.col("pat_id").isNotNull() & F.col("encounter_id").isNotNull()
                          & F.col("encounter_dttm").isNotNull())
                  .select("pat_id", "encounter_id", "encounter_dttm", "encounter_type",
                          "primary_dx_code"))
    candidates = (encounters
                  .join(icd, F.col("primary_dx_code") == F.col("_icd_code"), "left")
                  .join(cpt_hits, "encounter_id", "left"))
    eligible = (candidates
                .select("pat_id", "encounter_id", "encounter_dttm", "encounter_type",
                        F.explode(F.concat(
                            F.coalesce("_cpt_measures", F.array().cast("array<string>")),
                            F.array("_icd_measure"))).alias("measure_id"))
                .filter(F.col("measure_id").isNotNull())
                .distinct()
                .join(names, "measure_id", "left"))

    patients = (dim_patient.filter(F.col("is_current") == F.lit(True))
                .filter(F.col("birth_date").isNotNull())
                .select("pat_id", "birth_date"))
    return (eligible.join(patients, "pat_id")
            .select("pat_id", "encounter_id", "measure_id",
                    F.coalesce("measure_name", "measure_id").alias("measure_name"),
                    F.lit("Y").alias("measure_eligible"),
                    flag(F.col("encounter_type").isin(*params.compliant_types))
                    .alias("measure_compliant"),
                    completed_years("encounter_dttm", "birth_date").alias("age_at_encounter"),
                    "encounter_type",
                    lit_ts(params.load_ts).alias("load_dttm"),
                    *([F.col("encounter_dttm").alias("_encounter_dttm")] if with_time else [])))


def substring_false_positives(eligibility: DataFrame, fact_charges: DataFrame,
                              codes: DataFrame, probe_code: str = "9921",
                              full_code: str = "99213") -> DataFrame:
    """Eligibility rows whose encounter carries the truncated ``probe_code``
    and whose measure requires ``full_code`` (must be empty: exact match)."""
    measures = (codes.filter((F.col("code_type") == "CPT") & (F.col("code_value") == full_code))
                .select("measure_id"))
    probe = fact_charges.filter(F.col("cpt_code") == probe_code).select("encounter_id")
    return (eligibility.join(probe, "encounter_id")
            .join(bounded_broadcast(measures), "measure_id", "left_semi"))


def supported_pairs(dim_encounter: DataFrame, fact_charges: DataFrame, codes: DataFrame,
                    params: Params) -> DataFrame:
    """(encounter_id, measure_id) pairs backed by an exact code match."""
    cpt = bounded_broadcast(valid_codes(codes, "CPT", params))
    icd = bounded_broadcast(valid_codes(codes, "ICD10", params))
    by_cpt = (fact_charges.join(cpt, F.col("cpt_code") == F.col("code_value"))
              .select("encounter_id", "measure_id"))
    by_icd = (dim_encounter.join(icd, F.col("primary_dx_code") == F.col("code_value"))
              .select("encounter_id", "measure_id"))
    return by_cpt.unionByName(by_icd).distinct()


def unsupported_eligibility(eligibility: DataFrame, dim_encounter: DataFrame,
                            fact_charges: DataFrame, codes: DataFrame, params: Params
                            ) -> DataFrame:
    """Eligibility rows without any exact code match (must be empty).

    The probe-code form (``substring_false_positives``) also flags encounters
    that carry a truncated code *and* a genuine one, so it fails on valid
    data; this form checks the exact-match invariant itself.
    """
    return eligibility.join(supported_pairs(dim_encounter, fact_charges, codes, params),
                            ["encounter_id", "measure_id"], "left_anti")
