"""Gated pipeline run, resume, and physical-plan shape."""

import pytest
from pyspark.sql import functions as F

from carelake.params import TESTDATA_PARAMS
from carelake.plans.pipeline import STAGES, PipelineHalted, Run, run_pipeline
from carelake.queries import REGISTRY
from carelake.sources import adapter
from carelake.sources.store import Store

from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_gated_run_halts_then_resumes(spark, tmpdir_path):
    store = Store(spark, tmpdir_path)
    measures = adapter.land_measure_definitions(spark, f"{tmpdir_path}/_landing")
    run = Run(spark, store, TESTDATA_PARAMS, adapter.landing_specs(SF_SMALL, measures))
    with pytest.raises(PipelineHalted, match="Referential integrity"):
        run_pipeline(run)
    log = {r.stage_name: r.status for r in
           store.read("audit.orchestration_log").filter(F.col("run_id") == run.run_id)
           .collect()}
    assert log["quality_dq"] == "FAILED"
    assert log["gold_care_gaps"] == log["care_gaps_dq"] == "UPSTREAM_FAILED"
    assert all(log[s] == "SUCCESS" for s in STAGES[:6])
    # repair run from the failed gate, recording the cross-mart verdict only
    run2 = Run(spark, store, TESTDATA_PARAMS, run.landing, cross_mart="log")
    out = run_pipeline(run2, resume_from="quality_dq")
    assert {r.stage_name: r.status for r in out.collect()} == {
        s: "SUCCESS" for s in STAGES[STAGES.index("quality_dq"):]}
    gaps = store.read("gold_care_mgmt.gap_queue")
    assert gaps.count() > 0
    # validating ALL marts: null-rate + row-count per mart, then cross-mart RI
    from carelake.plans import dq, runlog
    counts = dq.validate(store, "ALL", "manual", TESTDATA_PARAMS, cross_mart="log")
    assert counts == {t: store.read(t).count() for t, _ in dq.MARTS.values()}
    names = [r.assertion_name for r in store.read(dq.AUDIT).filter("assertion_run_id = 'manual'").collect()]
    assert names.count("row_count_threshold") == 3 and sum(n.startswith("referential") for n in names) == 1
    # SLA report over our own stage log (halted stages have no end time)
    sla = runlog.sla_report(store.read("audit.orchestration_log")).collect()
    assert {r.run_id for r in sla} == {run.run_id, run2.run_id}
    assert all(r.run_end_time is not None for r in sla)
    # second full run over the same landing files: bronze gets nothing new,
    # marts are idempotent
    before = store.read("gold_billing.claims_processed").count()
    run3 = Run(spark, store, TESTDATA_PARAMS, run.landing, cross_mart="log")
    run_pipeline(run3)
    assert store.read("gold_billing.claims_processed").count() == before
    assert store.read("bronze.encounter").count() == adapter.table(
        spark, SF_SMALL, "orders").count()


def test_plans_broadcast_lookups_and_push_filters(spark):
    plan = _plan(REGISTRY["billing_batch"](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BroadcastHashJoin" in plan
    assert "WindowGroupLimit" in plan  # latest-row dedupe limited before the shuffle


def test_quality_year_filter_reaches_scan(spark):
    enc_path = f"{SF_SMALL}/orders.parquet"
    df = spark.read.parquet(enc_path).select(
        F.col("o_orderdate").alias("encounter_dttm"), F.col("o_orderkey").alias("k"))
    from carelake.functions import in_year
    plan = df.filter(in_year("encounter_dttm", 2000))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan


def test_all_registered_queries_build(spark):
    from __spark_entry__ import oracle_sql, queries
    qs, orc = queries(), oracle_sql()
    assert set(orc) <= set(qs)
    assert set(REGISTRY) <= set(orc)  # each of these has a DuckDB twin


def test_any_failure_is_logged_and_stops_the_run(spark, tmpdir_path, monkeypatch):
    """A Spark error (not one of ours) in a stage leaves FAILED with its whole text, then UPSTREAM_FAILED."""
    from carelake.plans import pipeline
    text = "duplicate key: " + "k" * 2000
    bad = lambda run: spark.range(1).select(F.raise_error(F.lit(text))).collect()
    monkeypatch.setitem(pipeline.STAGE_FN, "bronze_ingestion", bad)
    run = Run(spark, Store(spark, tmpdir_path), TESTDATA_PARAMS, [])
    log = {r.stage_name: r for r in run_pipeline(run, raise_on_failure=False).collect()}
    assert [log[s].status for s in STAGES] == ["FAILED"] + ["UPSTREAM_FAILED"] * (len(STAGES) - 1)
    assert text in log[STAGES[0]].details
    with pytest.raises(PipelineHalted):
        run_pipeline(Run(spark, run.store, TESTDATA_PARAMS, []))
