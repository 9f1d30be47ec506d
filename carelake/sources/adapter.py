"""Map the driver's TPC-H-style tables onto the bronze landing contracts.

The mapping is deterministic and row-wise (one projection per table), so every
downstream query grows with the input tables.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake import schemas

# --- Fixed values of the mapping (driver table -> clinical entity) ---------
PRIORITY_TO_VISIT_TYPE = [("1-URGENT", 201), ("2-HIGH", 101), ("3-MEDIUM", 102),
                          ("4-NOT SPECIFIED", 103)]
UNMAPPED_VISIT_TYPE = 999
DX_BY_ORDERKEY_MOD5 = ["DX_E119", "DX_I10", "J45909", "DX_M545", "DX_Z000"]
CPT_BY_PARTKEY_MOD6 = ["99213", "9921", "99395", "G0438", "99214", "80053"]

# Measure definitions (bronze.hedis_measure_definition). LBP is deliberately
# absent so the measure-name fallback to the id is exercised.
MEASURE_DEFINITION_ROWS = [
    ("CDC", "Comprehensive Diabetes Care", " 99213, 99214,,", "E119", "encounter_type in (WELLNESS, FOLLOWUP)", 365),
    ("AWV", "Annual Wellness Visit", "99395 ,G0438, G0439", None, "encounter_type in (WELLNESS, FOLLOWUP)", 365),
    ("CBP", "Controlling High Blood Pressure", None, " I10 ", "encounter_type in (WELLNESS, FOLLOWUP)", 365),
    ("AAB", "Appropriate Asthma Treatment", "", "J45909,", "encounter_type in (WELLNESS, FOLLOWUP)", 365),
]
# --- end of fixed values ---------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _pick(key: F.Column, values: list[str]) -> F.Column:
    out = None
    for i, v in enumerate(values):
        out = F.when(key == i, v) if out is None else out.when(key == i, v)
    return out


def dim_patient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return patient_from_customer(table(spark, sf_dir, "customer"))


def patient_from_customer(c: DataFrame, extra: list | None = None) -> DataFrame:
    """Row-wise mapping (usable on a stream)."""
    k = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    return c.select(
        F.concat(F.lit("P"), k.cast("string")).alias("pat_id"),
        F.when(k % 11 == 0, None).otherwise(F.concat(F.lit("M"), k.cast("string"))).alias("mrn"),
        F.when(k % 13 == 0, None).otherwise(F.concat(F.lit("  "), seg, F.lit(" "))).alias("first_name"),
        F.col("c_name").alias("last_name"),
        F.when(k % 17 == 0, None).otherwise(
            F.date_add(F.lit("1940-01-01").cast("date"), ((k * 37) % 20000).cast("int"))
        ).alias("birth_date"),
        F.when(F.col("c_nationkey") % 3 == 0, "F").when(F.col("c_nationkey") % 3 == 1, "M")
        .alias("gender"),
        F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("zip_code"),
        F.when(k % 19 == 0, None).otherwise(seg).alias("payer_name"),
        k.alias("_src_key"),
        *(extra or []),
    )


def encounter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encounter_from_orders(table(spark, sf_dir, "orders"))


def encounter_from_orders(o: DataFrame, extra: list | None = None) -> DataFrame:
    """Row-wise mapping (usable on a stream)."""
    k = F.col("o_orderkey")
    visit = None
    for prio, code in PRIORITY_TO_VISIT_TYPE:
        cond = F.col("o_orderpriority") == prio
        visit = F.when(cond, code) if visit is None else visit.when(cond, code)
    visit = visit.otherwise(UNMAPPED_VISIT_TYPE)
    return o.select(
        F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("pat_id"),
        F.concat(F.lit("E"), k.cast("string")).alias("encounter_id"),
        visit.cast("int").alias("visit_type_c"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("encounter_dttm"),
        F.concat(F.lit("D"), (k % 7).cast("string")).alias("dept_id"),
        F.concat(F.lit("R"), (k % 23).cast("string")).alias("prov_id"),
        _pick(k % 5, DX_BY_ORDERKEY_MOD5).alias("primary_dx_id"),
        F.col("o_orderstatus").alias("encounter_status"),
        k.alias("_src_key"),
        *(extra or []),
    )


def charge_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lineitem rows as charges; (encounter_id, charge_id) is NOT unique."""
    return charges_from_lineitem(table(spark, sf_dir, "lineitem"))


def charges_from_lineitem(li: DataFrame, extra: list | None = None) -> DataFrame:
    """Row-wise mapping (usable on a stream)."""
    billed = F.col("l_extendedprice").cast("decimal(12,2)")
    allowed = (billed - F.col("l_quantity").cast("decimal(12,2)")).cast("decimal(12,2)")
    paid = F.when(F.col("l_partkey") % 10 == 0, None).otherwise(
        (allowed - F.col("l_linenumber").cast("decimal(12,2)")).cast("decimal(12,2)"))
    status = (F.when(F.col("l_returnflag") == "R", "DENIED")
              .when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F"), None)
              .otherwise("PAID"))
    return li.select(
        F.concat(F.lit("E"), F.col("l_orderkey").cast("string")).alias("encounter_id"),
        F.concat(F.lit("C"), F.col("l_linenumber").cast("string")).alias("charge_id"),
        _pick(F.col("l_partkey") % 6, CPT_BY_PARTKEY_MOD6).alias("cpt_code"),
        billed.alias("billed_amt"),
        paid.alias("paid_amt"),
        allowed.alias("allowed_amt"),
        status.alias("claim_status"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("charge_dttm"),
        F.col("l_orderkey").alias("_src_key"),
        *(extra or []),
    )


def icd10_from_part(p: DataFrame, extra: list | None = None) -> DataFrame:
    """Row-wise mapping (usable on a stream): the code catalogue, which no later stage reads."""
    k = F.col("p_partkey")
    return p.select(
        F.concat(F.lit("Z"), k.cast("string")).alias("icd10_code"),
        F.col("p_name").alias("short_description"), F.col("p_type").alias("category"),
        F.when(F.col("p_size") > 25, "Y").otherwise("N").alias("chronic_flag"),
        *(extra or []))


def measure_definitions(spark: SparkSession) -> DataFrame:
    return schemas.literal_frame(spark, MEASURE_DEFINITION_ROWS, schemas.MEASURE_DEFINITION)


def bronze(spark: SparkSession, sf_dir: str) -> dict:
    """Bronze entities (contract columns only) as lazy factories."""
    return {
        "dim_patient": lambda: dim_patient(spark, sf_dir).drop("_src_key"),
        "encounter": lambda: encounter(spark, sf_dir).drop("_src_key"),
        "charge_detail": lambda: charge_detail(spark, sf_dir).drop("_src_key"),
        "hedis_measure_definition": lambda: measure_definitions(spark),
    }


# Explicit landing schemas of the driver tables (inference off).
CUSTOMER_SCHEMA = schemas._struct(
    ("c_custkey", schemas.L), ("c_name", schemas.S), ("c_nationkey", schemas.I),
    ("c_acctbal", schemas.T.DoubleType()), ("c_mktsegment", schemas.S))
ORDERS_SCHEMA = schemas._struct(
    ("o_orderkey", schemas.L), ("o_custkey", schemas.L), ("o_orderstatus", schemas.S),
    ("o_totalprice", schemas.T.DoubleType()), ("o_orderdate", schemas.TS),
    ("o_orderpriority", schemas.S))
LINEITEM_SCHEMA = schemas._struct(
    ("l_orderkey", schemas.L), ("l_partkey", schemas.L), ("l_suppkey", schemas.L),
    ("l_linenumber", schemas.I), ("l_quantity", schemas.T.DoubleType()),
    ("l_extendedprice", schemas.T.DoubleType()), ("l_discount", schemas.T.DoubleType()),
    ("l_tax", schemas.T.DoubleType()), ("l_returnflag", schemas.S), ("l_linestatus", schemas.S),
    ("l_shipdate", schemas.TS))

PART_SCHEMA = schemas._struct(
    ("p_partkey", schemas.L), ("p_name", schemas.S), ("p_brand", schemas.S), ("p_type", schemas.S),
    ("p_size", schemas.I), ("p_retailprice", schemas.T.DoubleType()))

_META = ["_ingestion_timestamp", "_source_file", "_batch_id", "_ingestion_date"]


def _carry_meta(df: DataFrame, fn, drop: list[str]) -> DataFrame:
    """Apply a row-wise mapping while keeping the ingest metadata columns:
    the metadata rides along in one struct column and is unpacked after."""
    packed = df.withColumn("_meta", F.struct(*[F.col(c) for c in _META]))
    out = fn(packed, extra=[F.col("_meta")])
    return out.drop(*drop).select("*", *[F.col(f"_meta.{c}").alias(c) for c in _META]).drop("_meta")


def land_measure_definitions(spark: SparkSession, landing_root: str) -> str:
    """Drop the measure catalogue into a landing folder (one Parquet file per
    delivery) for the streaming ingest; returns the folder."""
    folder = f"{landing_root}/hedis_measure_definition"
    measure_definitions(spark).coalesce(1).write.mode("append").parquet(folder)
    return folder


def measure_definition_spec(folder: str):
    from carelake.streaming.ingest import IngestSpec
    return IngestSpec("hedis_measure_definition", schemas.MEASURE_DEFINITION, folder,
                      file_glob="*.parquet")


#: Driver table -> (bronze entity, landing schema, row-wise mapping).
LANDED = {
    "orders": ("encounter", ORDERS_SCHEMA, encounter_from_orders),
    "lineitem": ("charge_detail", LINEITEM_SCHEMA, charges_from_lineitem),
    "customer": ("dim_patient", CUSTOMER_SCHEMA, patient_from_customer),
    "part": ("icd10_reference", PART_SCHEMA, icd10_from_part),
}


def _spec(table_name: str, folder: str, file_glob: str | None):
    from carelake.streaming.ingest import IngestSpec
    entity, schema, fn = LANDED[table_name]
    return IngestSpec(entity, schema, folder, lambda df: _carry_meta(df, fn, ["_src_key"]), file_glob)


def landing_specs(sf_dir: str, measures: str | None = None, code_catalogue: bool = False) -> list:
    """Streaming ingest specs that land the driver tables as bronze entities
    (row-wise mappings only, so they run on the stream). ``measures`` is the folder of
    the measure catalogue (``land_measure_definitions``), which the tables don't hold;
    ``code_catalogue`` adds the fifth entity, which no later stage reads."""
    catalogue = [measure_definition_spec(measures)] if measures else []
    tables = ["orders", "lineitem", "customer", *(["part"] if code_catalogue else [])]
    return catalogue + [_spec(t, sf_dir, f"{t}.parquet") for t in tables]


# ---- deliveries of two nights ------------------------------------------------------
#: Keys of orders that the second delivery adds start here.
NEW_ORDERS = 10_000_000_000


def delivery_specs(landing: str, measures: str) -> list:
    """Specs over landing folders that hold one subfolder per delivery."""
    return [measure_definition_spec(measures)] + [_spec(t, f"{landing}/{t}/*", None) for t in ("orders", "lineitem", "customer")]


def land_first_delivery(spark: SparkSession, sf_dir: str, landing: str) -> None:
    """The whole tables."""
    for t in ("orders", "lineitem", "customer"):
        table(spark, sf_dir, t).write.parquet(f"{landing}/{t}/d1")


def land_second_delivery(spark: SparkSession, sf_dir: str, landing: str) -> None:
    """One order in fifty is sent again a day later with its lines, one in a hundred is new, and one
    customer in twenty has another segment."""
    o, li, c = (table(spark, sf_dir, t) for t in ("orders", "lineitem", "customer"))
    day = F.expr("INTERVAL 1 DAY")
    again = o.filter("o_orderkey % 50 = 0").withColumn("o_orderdate", F.col("o_orderdate") + day).withColumn(
        "o_orderstatus", F.lit("F"))
    new = o.filter("o_orderkey % 100 = 7").withColumn("o_orderkey", F.col("o_orderkey") + F.lit(NEW_ORDERS))
    again.unionByName(new).write.parquet(f"{landing}/orders/d2")
    again = li.filter("l_orderkey % 50 = 0").withColumn("l_shipdate", F.col("l_shipdate") + day)
    new = li.filter("l_orderkey % 100 = 7").withColumn("l_orderkey", F.col("l_orderkey") + F.lit(NEW_ORDERS))
    again.unionByName(new).write.parquet(f"{landing}/lineitem/d2")
    c.filter("c_custkey % 20 = 0").withColumn("c_mktsegment", F.lit("SELFPAY")).write.parquet(f"{landing}/customer/d2")


# ---- deliveries with flaws -----------------------------------------------------------
def flawed_encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encounters some of which break row constraints: NULL, empty and listed keys, no time."""
    k = F.col("_src_key")
    enc = encounter(spark, sf_dir)
    return enc.withColumns({
        "pat_id": F.when(k % 101 == 0, None).when(k % 103 == 0, " ").otherwise(F.col("pat_id")),
        "encounter_id": F.when(k % 107 == 0, "").when(k % 109 == 0, F.concat("encounter_id", F.lit(",E0")))
        .otherwise(F.col("encounter_id")),
        "encounter_dttm": F.when(k % 113 == 0, None).otherwise(F.col("encounter_dttm"))}).drop("_src_key")


def flawed_charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Charges some of which break row constraints: NULL keys, empty, short and listed codes, negative amounts."""
    k = F.col("_src_key")
    return charge_detail(spark, sf_dir).withColumns({
        "charge_id": F.when(k % 127 == 0, None).otherwise(F.col("charge_id")),
        "cpt_code": F.when(k % 101 == 0, "").when(k % 103 == 0, "99213, 99214").when(k % 107 == 0, "992")
        .otherwise(F.col("cpt_code")),
        "paid_amt": F.when(k % 109 == 0, -F.col("paid_amt")).otherwise(F.col("paid_amt"))}).drop("_src_key")
