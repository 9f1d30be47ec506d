"""Reference (lookup) tables: seed rows, CSV seed reading, replacement."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake import schemas

# --- Fixed values (must equal the reference's seed data) -------------------
# Canonical encounter types: visit_type_c, encounter_type, description,
# effective_date, is_active.
ENCOUNTER_TYPE_ROWS = [
    (101, "OFFICE", "Office visit — primary care or specialist", dt.date(2024, 1, 1), True),
    (102, "FOLLOWUP", "Follow-up visit — post-procedure or post-discharge", dt.date(2024, 1, 1), True),
    (103, "WELLNESS", "Annual wellness visit — preventive care", dt.date(2024, 1, 1), True),
    (201, "ACUTE", "Acute care — urgent or emergency encounter", dt.date(2024, 1, 1), True),
    (0, "OTHER", "Unmapped encounter type — catch-all for unknown codes", dt.date(2024, 1, 1), True),
]

# Eligibility code sets: measure_id, code_type, code_value, effective_date,
# expiration_date (NULL = open-ended).
ELIGIBILITY_CODE_ROWS = [
    ("CDC", "CPT", "99213", dt.date(2024, 1, 1), None),
    ("CDC", "CPT", "99214", dt.date(2024, 1, 1), None),
    ("CDC", "ICD10", "E119", dt.date(2024, 1, 1), None),
    ("AWV", "CPT", "99395", dt.date(2024, 1, 1), None),
    ("AWV", "CPT", "G0438", dt.date(2024, 1, 1), None),
    ("AWV", "CPT", "G0439", dt.date(2024, 1, 1), None),
    ("CBP", "ICD10", "I10", dt.date(2024, 1, 1), None),
    ("AAB", "ICD10", "J45909", dt.date(2024, 1, 1), None),
    ("LBP", "ICD10", "M545", dt.date(2024, 1, 1), None),
]
ALLOWED_CODE_TYPES = ("CPT", "ICD10")
MIN_CODE_LENGTH = {"CPT": 4, "ICD10": 3}
CODE_DELIMITERS = (",", " ")
# --- end of fixed values ---------------------------------------------------


def encounter_types(spark: SparkSession) -> DataFrame:
    return schemas.literal_frame(spark, ENCOUNTER_TYPE_ROWS, schemas.ENCOUNTER_TYPE)


def eligibility_codes(spark: SparkSession, extra_rows: list | None = None) -> DataFrame:
    return schemas.literal_frame(spark, ELIGIBILITY_CODE_ROWS + list(extra_rows or []),
                                 schemas.ELIGIBILITY_CODES)


def read_encounter_types_csv(spark: SparkSession, path: str) -> DataFrame:
    """Seed CSV with ``is_active`` as 1/0. Parsing ``1`` straight into a
    BOOLEAN yields NULL, so it is read as INT and cast."""
    raw = T.StructType([
        T.StructField("visit_type_c", T.IntegerType()),
        T.StructField("encounter_type", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("effective_date", T.DateType()),
        T.StructField("is_active", T.IntegerType()),
    ])
    df = spark.read.option("header", True).schema(raw).csv(path)
    return schemas.conform(df.withColumn("is_active", F.col("is_active").cast("boolean")),
                           schemas.ENCOUNTER_TYPE, "reference.dim_encounter_type")


def read_eligibility_codes_csv(spark: SparkSession, path: str) -> DataFrame:
    """Seed CSV; an empty ``expiration_date`` is NULL (open-ended)."""
    df = spark.read.option("header", True).schema(
        schemas._struct(*[(f.name, f.dataType) for f in schemas.ELIGIBILITY_CODES.fields])
    ).csv(path)
    return schemas.conform(df, schemas.ELIGIBILITY_CODES,
                           "reference.hedis_eligibility_codes")
