"""One key holding a third of all rows: results stay whole and exact, the
hot key is combined map-side or split by AQE instead of landing in one task."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from carelake.functions import lit_ts
from carelake.operators.dedupe import latest_per_key
from carelake.params import Params
from carelake.plans import marts
from carelake.plans.staging import latest_charges, stage_charges, stage_encounters
from carelake.sources import seeds

N = 120_000
P = Params(as_of_date=dt.date(2001, 8, 2), measurement_year=2000)


def _hot(col):
    """Every third row belongs to patient HOT, the rest spread over 4000."""
    return F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(
        F.concat(F.lit("P"), (F.col("id") % 4000).cast("string"))).alias(col)


@pytest.fixture()
def skew_conf(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_per_key_hot_key_limited_before_shuffle(spark):
    df = spark.range(N).select(_hot("k"), F.col("id").alias("v"))
    out = latest_per_key(df, ["k"], [F.col("v").desc()])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    got = {r.k: r.v for r in out.collect()}
    assert got["HOT"] == max(i for i in range(N) if i % 3 == 0)
    assert len(got) == 4001


def test_last_encounter_hot_patient_partial_aggregate(spark):
    enc = spark.range(N).select(
        _hot("pat_id"), F.concat(F.lit("E"), F.col("id").cast("string")).alias("encounter_id"),
        F.lit(101).alias("visit_type_c"),
        (lit_ts(dt.datetime(2000, 1, 1))
         + F.make_dt_interval(F.col("id") % 300)).alias("encounter_dttm"))
    out = marts.last_encounter(enc, seeds.encounter_types(spark))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Aggregate") >= 2  # partial (map side) + final
    hot = out.filter(F.col("pat_id") == "HOT").first()
    assert hot.last_encounter_dttm == dt.datetime(2000, 1, 1) + dt.timedelta(days=297)  # largest id % 300 with id % 3 == 0
    assert hot.encounter_type == "OFFICE"


def test_hot_patient_join_is_split_by_aqe(spark, skew_conf):
    h = spark.range(N).select(
        _hot("pat_id"), F.concat(F.lit("E"), F.col("id").cast("string")).alias("encounter_id"),
        F.lit("CDC").alias("measure_id"), F.lit("Diabetes").alias("measure_name"),
        F.lit("Y").alias("measure_eligible"), F.lit("N").alias("measure_compliant"),
        F.lit("OFFICE").alias("encounter_type"))
    enc = spark.range(N).select(
        F.concat(F.lit("E"), F.col("id").cast("string")).alias("encounter_id"),
        lit_ts(dt.datetime(2000, 5, 1)).alias("encounter_dttm"))
    pats = spark.range(4000).select(
        F.concat(F.lit("P"), F.col("id").cast("string")).alias("pat_id")).union(
        spark.range(1).select(F.lit("HOT").alias("pat_id"))).select(
        "pat_id", F.sha2("pat_id", 256).alias("mrn_token"),
        F.lit(dt.date(1960, 1, 1)).alias("birth_date"), F.lit(True).alias("is_current"))
    out = marts.quality_batch(h, enc, pats, P)
    plan = _final_plan(out)
    assert "skew=true" in plan
    assert out.count() == N  # nothing dropped or capped
    assert out.filter(F.col("pat_id") == "HOT").count() == N // 3


def test_hot_encounter_billing_is_split_by_aqe(spark, skew_conf):
    """Both inputs pass their latest-row windows first, as in the billing query."""
    encounter = F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(
        F.concat(F.lit("E"), (F.col("id") % 4000).cast("string"))).alias("encounter_id")
    money = [F.lit(5).cast("decimal(12,2)").alias(c) for c in ("billed_amt", "paid_amt", "allowed_amt")]
    charges = latest_charges(stage_charges(spark.range(N).select(
        encounter, F.concat(F.lit("C"), F.col("id").cast("string")).alias("charge_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("cpt_code"), *money, F.lit("PAID").alias("claim_status"),
        lit_ts(dt.datetime(2001, 7, 1)).alias("charge_dttm")), dt.datetime(2001, 8, 2)))
    visits = spark.range(4001).select(
        F.lit("P").alias("pat_id"),
        F.when(F.col("id") == 4000, "HOT").otherwise(F.concat(F.lit("E"), F.col("id").cast("string"))).alias("encounter_id"),
        F.lit(101).alias("visit_type_c"), lit_ts(dt.datetime(2001, 7, 1)).alias("encounter_dttm"),
        F.lit("D").alias("dept_id"), F.lit("R").alias("prov_id"), F.lit("DX_I10").alias("primary_dx_id"),
        F.lit("F").alias("encounter_status"))
    types = seeds.encounter_types(spark)
    visits = stage_encounters(visits, types, dt.datetime(2001, 8, 2))
    out = marts.billing_batch(visits, charges, types, P)
    assert "skew=true" in _final_plan(out)
    assert out.count() == N
    assert out.filter(F.col("encounter_id") == "HOT").count() == N // 3


def test_hot_encounter_semi_join_is_split_and_leaves_the_dedupe_its_own_key(spark, skew_conf):
    """``Silver.fact_charges_where``: the way of the billing and quality queries."""
    from carelake.plans.silver import build_silver
    encounter = F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(
        F.concat(F.lit("E"), (F.col("id") % 4000).cast("string"))).alias("encounter_id")
    money = [F.lit(5).cast("decimal(12,2)").alias(c) for c in ("billed_amt", "paid_amt", "allowed_amt")]
    charges = spark.range(N).select(
        encounter, F.concat(F.lit("C"), F.col("id").cast("string")).alias("charge_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("cpt_code"), *money, F.lit("PAID").alias("claim_status"),
        lit_ts(dt.datetime(2001, 7, 1)).alias("charge_dttm"))
    visits = spark.range(4001).select(
        F.lit("P").alias("pat_id"),
        F.when(F.col("id") == 4000, "HOT").otherwise(F.concat(F.lit("E"), F.col("id").cast("string"))).alias("encounter_id"),
        F.lit(101).alias("visit_type_c"), lit_ts(dt.datetime(2001, 7, 1)).alias("encounter_dttm"))
    bronze = {"encounter": lambda: visits, "charge_detail": lambda: charges}
    out = build_silver(spark, bronze, seeds.encounter_types(spark), P).fact_charges_where(
        F.col("encounter_dttm") >= lit_ts(dt.datetime(2001, 5, 1)))
    plan = _final_plan(out)
    assert "SortMergeJoin(skew=true)" in plan and "LeftSemi" in plan
    held = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(held) == N and max(held) < N // 3
