"""Table contracts (explicit schemas, inference off) and conformance.

Timestamps are wall-clock ``TIMESTAMP_NTZ``: the landing extracts carry no
zone, and keeping them naive avoids session-zone shifts between engines.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, I, L, B = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType()
D, TS, AMT = T.DateType(), T.TimestampNTZType(), T.DecimalType(12, 2)


def _struct(*fields: tuple) -> T.StructType:
    """``(name, type[, nullable=True])`` tuples -> StructType."""
    out = []
    for f in fields:
        name, typ = f[0], f[1]
        nullable = f[2] if len(f) > 2 else True
        out.append(T.StructField(name, typ, nullable))
    return T.StructType(out)


# ---- bronze (landing) source schemas --------------------------------------
ENCOUNTER = _struct(
    ("pat_id", S, False), ("encounter_id", S, False), ("visit_type_c", I),
    ("encounter_dttm", TS), ("dept_id", S), ("prov_id", S),
    ("primary_dx_id", S), ("encounter_status", S))

CHARGE_DETAIL = _struct(
    ("encounter_id", S, False), ("charge_id", S, False), ("cpt_code", S),
    ("billed_amt", AMT), ("paid_amt", AMT), ("allowed_amt", AMT),
    ("claim_status", S), ("charge_dttm", TS))

DIM_PATIENT_SRC = _struct(
    ("pat_id", S, False), ("mrn", S), ("first_name", S), ("last_name", S),
    ("birth_date", D), ("gender", S), ("zip_code", S), ("payer_name", S))

MEASURE_DEFINITION = _struct(
    ("measure_id", S, False), ("measure_name", S), ("eligibility_cpt_set", S),
    ("eligibility_icd10_set", S), ("compliance_criteria", S),
    ("measurement_period_days", I))

ICD10_REFERENCE = _struct(
    ("icd10_code", S, False), ("short_description", S), ("category", S),
    ("chronic_flag", S))

BRONZE_METADATA = _struct(
    ("_ingestion_timestamp", TS), ("_source_file", S), ("_batch_id", S),
    ("_ingestion_date", D))

# ---- reference ------------------------------------------------------------
ENCOUNTER_TYPE = _struct(
    ("visit_type_c", I, False), ("encounter_type", S, False),
    ("description", S, False), ("effective_date", D, False),
    ("is_active", B, False))

ELIGIBILITY_CODES = _struct(
    ("measure_id", S, False), ("code_type", S, False), ("code_value", S, False),
    ("effective_date", D, False), ("expiration_date", D))

# ---- silver ---------------------------------------------------------------
DIM_PATIENT = _struct(
    ("pat_id", S, False), ("mrn_token", S, False), ("first_name", S, False),
    ("last_name", S, False), ("birth_date", D), ("gender", S, False),
    ("zip_code", S, False), ("payer_name", S, False),
    ("effective_date", D, False), ("expiration_date", D),
    ("is_current", B, False), ("load_dttm", TS, False))

DIM_ENCOUNTER = _struct(
    ("pat_id", S, False), ("encounter_id", S, False), ("visit_type_c", I),
    ("encounter_type", S, False), ("encounter_dttm", TS), ("dept_id", S),
    ("prov_id", S), ("primary_dx_id", S), ("primary_dx_code", S),
    ("encounter_status", S), ("load_dttm", TS, False))

FACT_CHARGES = _struct(
    ("encounter_id", S, False), ("charge_id", S, False), ("cpt_code", S),
    ("billed_amt", AMT, False), ("paid_amt", AMT, False),
    ("allowed_amt", AMT, False), ("claim_status", S), ("charge_dttm", TS),
    ("load_dttm", TS, False))

HEDIS_ELIGIBILITY = _struct(
    ("pat_id", S, False), ("encounter_id", S, False), ("measure_id", S, False),
    ("measure_name", S, False), ("measure_eligible", S, False),
    ("measure_compliant", S, False), ("age_at_encounter", I),
    ("encounter_type", S, False), ("load_dttm", TS, False))

# ---- gold -----------------------------------------------------------------
CLAIMS_PROCESSED = _struct(
    ("pat_id", S, False), ("encounter_id", S, False), ("charge_id", S, False),
    ("encounter_dttm", TS), ("encounter_type", S), ("cpt_code", S),
    ("primary_dx_code", S), ("payer_id", S), ("billed_amt", AMT),
    ("allowed_amt", AMT), ("paid_amt", AMT), ("patient_responsibility", AMT),
    ("high_cost_flag", S), ("claim_status", S), ("load_dttm", TS),
    ("updated_dttm", TS))

QUALITY_MEASURES = _struct(
    ("pat_id", S, False), ("encounter_id", S, False), ("encounter_dttm", TS),
    ("mrn", S), ("age_at_encounter", I), ("measure_id", S, False),
    ("measure_name", S), ("measure_eligible", S), ("measure_compliant", S),
    ("encounter_type", S), ("load_dttm", TS), ("updated_dttm", TS))

GAP_QUEUE = _struct(
    ("pat_id", S, False), ("mrn", S), ("measure_id", S, False),
    ("measure_name", S), ("days_since_last_encounter", I),
    ("gap_priority", S), ("encounter_type_for_outreach", S),
    ("primary_payer_id", S), ("load_dttm", TS), ("updated_dttm", TS))

# ---- audit ----------------------------------------------------------------
DQ_RESULTS = _struct(
    ("assertion_run_id", S), ("assertion_dttm", TS), ("mart_name", S),
    ("assertion_name", S), ("status", S), ("details", S))

ORCHESTRATION_LOG = _struct(
    ("run_id", S, False), ("stage_name", S, False), ("start_time", TS),
    ("end_time", TS), ("status", S, False), ("row_count", L), ("details", S),
    ("logged_at", TS, False))

CONTRACTS = {
    "bronze.encounter": ENCOUNTER,
    "bronze.charge_detail": CHARGE_DETAIL,
    "bronze.dim_patient": DIM_PATIENT_SRC,
    "bronze.hedis_measure_definition": MEASURE_DEFINITION,
    "bronze.icd10_reference": ICD10_REFERENCE,
    "reference.dim_encounter_type": ENCOUNTER_TYPE,
    "reference.hedis_eligibility_codes": ELIGIBILITY_CODES,
    "silver.dim_patient": DIM_PATIENT,
    "silver.dim_encounter": DIM_ENCOUNTER,
    "silver.fact_charges": FACT_CHARGES,
    "silver.hedis_eligibility": HEDIS_ELIGIBILITY,
    "gold_billing.claims_processed": CLAIMS_PROCESSED,
    "gold_quality.measures": QUALITY_MEASURES,
    "gold_care_mgmt.gap_queue": GAP_QUEUE,
    "audit.dq_results": DQ_RESULTS,
    "audit.orchestration_log": ORCHESTRATION_LOG,
}


# Column comments of the contracts (carried as StructField metadata).
COMMENTS = {
    ("silver.dim_patient", "mrn_token"): "SHA-256 token of the record number",
    ("silver.dim_encounter", "encounter_type"): "mapped visit type, OTHER if unknown",
    ("silver.dim_encounter", "primary_dx_code"): "diagnosis code without its prefix",
    ("silver.hedis_eligibility", "encounter_type"): "visit type of the matching encounter",
}


def with_comments(schema: T.StructType, table: str) -> T.StructType:
    """The contract with column comments attached as field metadata."""
    return T.StructType([
        T.StructField(f.name, f.dataType, f.nullable,
                      {**(f.metadata or {}), "comment": COMMENTS[(table, f.name)]}
                      if (table, f.name) in COMMENTS else f.metadata)
        for f in schema.fields])


def not_null_guard(col: Column, name: str, table: str) -> Column:
    """Column that fails the task when a NOT NULL column holds NULL (lazy)."""
    return F.when(col.isNull(), F.raise_error(
        F.lit(f"NOT NULL constraint violated: {table}.{name}"))).otherwise(col)


def conform(df: DataFrame, schema: T.StructType, table: str = "table",
            enforce_not_null: bool = True) -> DataFrame:
    """Select the contract's columns in order, cast to its types, and guard
    NOT NULL columns. Missing columns become typed NULLs (and trip the guard
    if the column is NOT NULL)."""
    have = set(df.columns)
    cols = []
    for f in schema.fields:
        c = F.col(f.name) if f.name in have else F.lit(None)
        c = c.cast(f.dataType)
        if enforce_not_null and not f.nullable:
            c = not_null_guard(c, f.name, table)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty table with the contract (create-if-missing). Built JVM-side
    (``range(0)``) so the optimizer can prune joins against it."""
    return spark.range(0).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def sql_literal(v, typ: T.DataType) -> str:
    """SQL text of one typed literal (for inline VALUES tables)."""
    if v is None:
        return f"CAST(NULL AS {typ.simpleString()})"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return f"CAST({v!r} AS {typ.simpleString()})"
    if isinstance(v, dt.datetime):
        return f"TIMESTAMP_NTZ '{v.isoformat(sep=' ')}'"
    if isinstance(v, dt.date):
        return f"DATE '{v.isoformat()}'"
    text = str(v).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def literal_frame(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """Small literal table (seed/lookup rows) as one inline ``VALUES``
    relation: a local relation inside the JVM plan, so no Python worker is
    needed to scan it and the planner knows its size."""
    if not rows:
        return empty(spark, schema)
    names = [f.name for f in schema.fields]
    values = ", ".join(
        "(" + ", ".join(sql_literal(v, f.dataType) for v, f in zip(row, schema.fields)) + ")"
        for row in rows)
    cols = ", ".join(f"CAST(`c{i}` AS {f.dataType.simpleString()}) AS `{f.name}`"
                     for i, f in enumerate(schema.fields))
    alias = ", ".join(f"`c{i}`" for i in range(len(names)))
    return spark.sql(f"SELECT {cols} FROM VALUES {values} AS t({alias})")
