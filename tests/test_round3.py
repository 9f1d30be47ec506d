"""Row constraints, SQL text with arguments, observed ingest, and nights that follow the keys a delivery touches."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake import schemas
from carelake.operators import checks, constraints
from carelake.params import TESTDATA_PARAMS, Params
from carelake.plans import dq, sqltext
from carelake.plans.pipeline import Run, run_pipeline
from carelake.sources import adapter, seeds
from carelake.sources.store import Store
from carelake.streaming.ingest import ingest
from tests.conftest import SF_SMALL

DAY1 = TESTDATA_PARAMS.with_(as_of_date=dt.date(2001, 8, 1), as_of_ts=dt.datetime(2001, 8, 1))


# ---- row constraints ------------------------------------------------------------------
def _codes(spark, rows):
    return schemas.literal_frame(spark, rows, schemas._struct(*[(c, schemas.S) for c in ("measure_id", "code_type", "code_value")]))


def test_each_broken_rule_is_named_in_order(spark):
    df = _codes(spark, [("CDC", "CPT", "99213"), ("", "CPT", "992 13"), (None, " ", "1,2"), ("AWV", None, None)])
    got = [r[constraints.BROKEN] for r in constraints.check(df, constraints.CODE_RULES).collect()]
    assert got == [[], ["measure_id_filled", "code_value_single"],
                   ["measure_id_not_null", "code_type_filled", "code_value_single"], ["code_type_not_null", "code_value_not_null"]]


def test_quarantine_splits_once_and_keeps_whole_rows(spark, tmpdir_path):
    store = Store(spark, tmpdir_path)
    df = _codes(spark, [("CDC", "CPT", "99213"), ("", "CPT", "992 13"), ("", "CPT", "992 13")])
    kept = constraints.quarantine(store, "codes", df, constraints.CODE_RULES)
    bad = store.read("quarantine.codes", T.StructType([*kept.schema.fields, T.StructField(constraints.BROKEN, T.ArrayType(T.StringType()))]))
    assert [tuple(r) for r in kept.collect()] == [("CDC", "CPT", "99213")]
    assert [tuple(r) for r in bad.collect()] == [("", "CPT", "992 13", ["measure_id_filled", "code_value_single"])] * 2
    report = {r.rule: (r.rows_broken, r.rows_kept, r.rows_quarantined)
              for r in constraints.rule_report(kept, bad, "codes", constraints.CODE_RULES).collect()}
    assert report["measure_id_filled"] == (2, 1, 2) and report["code_type_filled"] == (0, 1, 2)
    again = constraints.quarantine(store, "codes", df.limit(0), constraints.CODE_RULES)
    assert again.count() == 0 and store.read("quarantine.codes", bad.schema).count() == 2


def test_a_night_with_quarantine_stages_clean_rows_only(spark, tmpdir_path):
    landing = os.path.join(tmpdir_path, "landing")
    measures = adapter.land_measure_definitions(spark, landing)
    adapter.land_first_delivery(spark, SF_SMALL, landing)
    adapter.table(spark, SF_SMALL, "orders").limit(3).withColumns(
        {"o_orderkey": F.lit(None).cast("bigint"), "o_orderdate": F.lit(None).cast("timestamp_ntz")}).write.parquet(f"{landing}/orders/bad")
    store = Store(spark, os.path.join(tmpdir_path, "store"))
    run_pipeline(Run(spark, store, TESTDATA_PARAMS, adapter.delivery_specs(landing, measures), cross_mart="log", quarantine=True))
    bad = spark.table(store.table("quarantine.encounter"))
    assert bad.count() == 3 and bad.first()[constraints.BROKEN] == ["encounter_id_not_null", "encounter_dttm_not_null"]
    assert spark.table(store.table("quarantine.charge_detail")).count() == 0
    assert store.read("silver.dim_encounter").count() == adapter.table(spark, SF_SMALL, "orders").count()


# ---- drift, null rates ------------------------------------------------------------------
def test_unmapped_types_before_and_drift_after_staging(spark):
    enc = spark.createDataFrame([(101,), (999,), (999,), (None,)], "visit_type_c int")
    types = seeds.encounter_types(spark)
    got = {r.visit_type_c: r.encounters for r in checks.unmapped_types(enc, types).collect()}
    assert got == {999: 2, None: 1}
    staged = spark.createDataFrame([(201, "ACUTE"), (999, "OTHER"), (101, "OFFICE")], "visit_type_c int, encounter_type string")
    assert checks.mapping_drift(staged, types).first().unmapped_count == 0
    assert tuple(checks.mapping_drift(staged, types.filter("visit_type_c <> 201")).first()) == (1, "FAIL")


def test_null_rate_record_lists_the_failing_columns(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    r = dq.null_rate_record(df, "t", ["a", "b"], "run", dt.datetime(2024, 1, 1)).first()
    failures = spark.sql("SELECT get_json_object(:d, '$.failures') AS f", args={"d": r.details}).first().f
    assert r.status == "FAIL" and failures == '[{"column_name":"b","null_count":1,"null_rate":0.5}]'


def test_code_rules_per_type_and_per_measure(spark):
    rows = [("CDC", "CPT", "99213"), ("CDC", "CPT", "99213"), ("CDC", "ICD10", "E119"), ("AWV", "CPT", "992")]
    got = {(r.code_type, r.measure_id): (r.row_count, r.distinct_keys, r.short_codes, r.status)
           for r in checks.validate_codes(_codes(spark, rows)).collect()}
    assert got == {("CPT", None): (3, 2, 1, "FAIL"), ("ICD10", None): (1, 1, 0, "PASS"),
                   (None, "CDC"): (3, 2, 0, "FAIL"), (None, "AWV"): (1, 1, 1, "FAIL")}


# ---- SQL text -----------------------------------------------------------------------------
def test_sql_text_follows_the_session_settings(spark):
    enc = spark.createDataFrame([("E1", "OFFICE", dt.datetime(2001, 8, 1)), ("E2", "OFFICE", dt.datetime(2001, 6, 1))],
                                "encounter_id string, encounter_type string, encounter_dttm timestamp_ntz")
    ch = spark.sql("SELECT e AS encounter_id, CAST(m AS DECIMAL(12,2)) AS billed_amt, 'PAID' AS claim_status "
                   "FROM VALUES ('E1', 50), ('E1', 20000), ('E2', 700) AS t(e, m)")

    def run():
        params = Params.from_conf(spark, as_of_date=dt.date(2001, 8, 2))
        return [tuple(r)[1:] for r in sqltext.run_text(spark, sqltext.BILLED_BY_TYPE, params,
                                                       {"dim_encounter": enc, "fact_charges": ch}).collect()]
    charges, _, high, _ = run()[0]
    assert (charges, high) == (3, 1)
    spark.conf.set("carelake.lookback_days", "10")
    spark.conf.set("carelake.high_cost_threshold", "10")
    try:
        charges, _, high, _ = run()[0]
    finally:
        spark.conf.unset("carelake.lookback_days")
        spark.conf.unset("carelake.high_cost_threshold")
    assert (charges, high) == (2, 2)


# ---- observed ingest ------------------------------------------------------------------------
@pytest.mark.parametrize("kept_progress", [100, 2])
def test_observed_rows_and_times_equal_the_table(spark, tmpdir_path, kept_progress):
    """Also if Spark has forgotten the progress of the first micro-batches."""
    spec = adapter.landing_specs(SF_SMALL)[2]
    landing = os.path.join(tmpdir_path, "landing")
    for i in range(4):
        adapter.table(spark, SF_SMALL, "customer").filter(f"c_custkey % 4 = {i}").coalesce(1).write.parquet(f"{landing}/f{i}")
    spec.landing_path, spec.file_glob, spec.max_files_per_trigger = landing + "/*", None, 1
    old = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", str(kept_progress))
    try:
        target = Store(spark, tmpdir_path).table("bronze.dim_patient")
        got = ingest(spark, spec, target, os.path.join(tmpdir_path, "ckpt"), "b1")
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", old)
    us = lambda f: f"unix_micros(CAST({f}(_ingestion_timestamp) AS TIMESTAMP))"
    want = spark.table(target).selectExpr("count(*)", us("min"), us("max")).first()
    assert (got["rows_added"], got["first_micros"], got["last_micros"]) == tuple(want) and want[1] < want[2]


# ---- touched keys -----------------------------------------------------------------------------
def test_a_small_second_delivery_stages_little_and_rewrites_its_months(spark, tmpdir_path):
    landing = os.path.join(tmpdir_path, "landing")
    measures = adapter.land_measure_definitions(spark, landing)
    adapter.land_first_delivery(spark, SF_SMALL, landing)
    specs = adapter.delivery_specs(landing, measures)
    store = Store(spark, os.path.join(tmpdir_path, "store"))
    run_pipeline(Run(spark, store, DAY1, specs, cross_mart="log", incremental=True))
    tables = ["silver.dim_encounter", "silver.fact_charges", "silver.hedis_eligibility", dq.BILLING, dq.QUALITY]
    files = {t: set(spark.table(store.table(t)).inputFiles()) for t in tables}
    o, li = adapter.table(spark, SF_SMALL, "orders"), adapter.table(spark, SF_SMALL, "lineitem")
    month = "o_orderdate >= '2000-05-01' AND o_orderdate < '2000-05-08'"
    late = o.filter(month).withColumn("o_orderstatus", F.lit("F"))
    n = late.count()
    late.write.parquet(f"{landing}/orders/d2")
    li.limit(0).write.parquet(f"{landing}/lineitem/d2")
    run_pipeline(Run(spark, store, TESTDATA_PARAMS, specs, cross_mart="log", incremental=True))
    assert 0 < n < 0.02 * o.count()
    assert store.read("staging.touched", schemas._struct(("encounter_id", schemas.S))).count() == n
    for t in tables:
        now = set(spark.table(store.table(t)).inputFiles())
        new = now - files[t]
        if t in ("silver.fact_charges", dq.BILLING):  # no charge came, and the week is outside the look-back
            assert not new and now == files[t]
        else:
            assert new and all("_month=2000-05-01" in f for f in new)
            assert all("_month=2000-05-01" in f for f in files[t] - now)
    assert store.read("silver.dim_encounter").filter("encounter_status = 'F'").filter(
        "encounter_dttm >= '2000-05-01' AND encounter_dttm < '2000-05-08'").count() == n
