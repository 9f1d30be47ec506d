"""Assemble the silver layer (dim_patient, dim_encounter, fact_charges) lazily."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake import schemas
from carelake.operators.upsert import scd2_apply
from carelake.params import Params
from carelake.plans.staging import (PATIENT_ATTRS, latest_charges, stage_charges,
                                    stage_encounters, stage_patients)


class Silver:
    """Silver frames derived from bronze; each plan is built on first use."""

    def __init__(self, spark: SparkSession, bronze: dict, encounter_types: DataFrame,
                 params: Params):
        self.spark, self.bronze, self.types, self.params = spark, bronze, encounter_types, params

    @cached_property
    def dim_patient(self) -> DataFrame:
        return initial_dim_patient(self.spark, stage_patients(self.bronze["dim_patient"]()),
                                   self.params)

    @cached_property
    def dim_encounter(self) -> DataFrame:
        return stage_encounters(self.bronze["encounter"](), self.types, self.params.load_ts)

    def dim_encounter_where(self, cond) -> DataFrame:
        """``dim_encounter.filter(cond)`` for a condition that only *bounds*
        ``encounter_dttm`` (look-back, calendar year), applied before the
        latest-row dedupe. Equivalent because the dedupe keeps the latest
        ``encounter_dttm`` per key: if that row passes the bound, all rows tied
        with it pass too; if it fails, no row of the key passes. Pushed below
        the window, the bound reaches the Parquet scan."""
        return stage_encounters(self.bronze["encounter"]().filter(cond), self.types,
                                self.params.load_ts)

    @cached_property
    def fact_charges(self) -> DataFrame:
        return latest_charges(stage_charges(self.bronze["charge_detail"](), self.params.load_ts))

    def fact_charges_where(self, cond) -> DataFrame:
        """Charges of the encounters that ``cond`` keeps (see ``dim_encounter_where``): the semi
        join comes before the latest-row dedupe, so other charges meet one shuffle only.

        The join has a hash of its key as a second key. So its output does not count as partitioned by
        ``encounter_id``: the dedupe exchanges it by its own keys, and AQE may split a hot encounter in the join."""
        spread = F.xxhash64("encounter_id").alias("_spread")
        kept = self.bronze["encounter"]().filter(cond).select("encounter_id", spread)
        staged = stage_charges(self.bronze["charge_detail"](), self.params.load_ts)
        return latest_charges(staged.select("*", spread).join(kept, ["encounter_id", "_spread"], "left_semi")
                              .drop("_spread"))


def initial_dim_patient(spark: SparkSession, staged: DataFrame, params: Params) -> DataFrame:
    """First SCD2 load: every staged patient becomes a current version."""
    return scd2_apply(schemas.empty(spark, schemas.DIM_PATIENT), staged.drop("attr_hash"),
                      "pat_id", PATIENT_ATTRS, params.as_of_date, params.load_ts)


def build_silver(spark: SparkSession, bronze: dict, encounter_types: DataFrame,
                 params: Params) -> Silver:
    """``bronze`` maps entity -> zero-argument DataFrame factory."""
    return Silver(spark, bronze, encounter_types, params)
