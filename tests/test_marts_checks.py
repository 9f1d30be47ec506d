"""Mart rules and data-quality checks on literal frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from carelake import schemas
from carelake.operators import checks
from carelake.params import Params
from carelake.plans import dq, marts
from carelake.plans.staging import stage_encounters
from carelake.sources import seeds
from carelake.sources.store import Store

P = Params(as_of_date=dt.date(2024, 6, 30), measurement_year=2024)
ENC = ("pat_id string, encounter_id string, visit_type_c int, encounter_dttm timestamp_ntz, "
       "dept_id string, prov_id string, primary_dx_id string, encounter_status string")


def _enc(spark, rows):
    return stage_encounters(spark.createDataFrame(rows, ENC), seeds.encounter_types(spark),
                            P.load_ts)


def test_stage_encounters_type_mapping_and_dedupe(spark):
    types = seeds.encounter_types(spark).withColumn(
        "is_active", F.col("visit_type_c") != 102)  # FOLLOWUP inactive
    rows = [("P1", "E1", 101, dt.datetime(2024, 1, 1), "D", "R", "DX_E119", "C"),
            ("P1", "E1", 101, dt.datetime(2024, 2, 1), "D", "R", "DX_I10", "C"),
            ("P1", "E2", 102, None, "D", "R", "J45909", "C"),
            ("P1", "E2", 102, dt.datetime(2023, 1, 1), "D", "R", "J45909", "C"),
            ("P2", "E3", 999, dt.datetime(2024, 3, 1), "D", "R", None, "C")]
    out = stage_encounters(spark.createDataFrame(rows, ENC), types, P.load_ts)
    got = {r.encounter_id: (r.encounter_type, r.primary_dx_code, r.encounter_dttm)
           for r in out.collect()}
    assert got == {"E1": ("OFFICE", "I10", dt.datetime(2024, 2, 1)),
                   "E2": ("OTHER", "J45909", dt.datetime(2023, 1, 1)),
                   "E3": ("OTHER", None, dt.datetime(2024, 3, 1))}


def test_billing_drops_denied_null_status_unmapped_and_old(spark):
    enc = _enc(spark, [("P1", "E1", 101, dt.datetime(2024, 6, 1), "D", "R", "DX_E119", "C"),
                       ("P1", "E2", 999, dt.datetime(2024, 6, 1), "D", "R", "DX_E119", "C"),
                       ("P1", "E3", 101, dt.datetime(2024, 4, 1), "D", "R", "DX_E119", "C"),
                       ("P1", "E4", 101, dt.datetime(2024, 4, 1, 0, 0), "D", "R", "X", "C")])
    ch = spark.createDataFrame(
        [("E1", "C1", "99213", "10000.00", "5.00", "100.00", "PAID"),
         ("E1", "C2", "99213", "10000.01", "5.00", "100.00", "DENIED"),
         ("E1", "C3", "99213", "10000.01", "5.00", "100.00", None),
         ("E1", "C4", "99213", "10000.01", "5.00", "100.00", "PAID"),
         ("E2", "C1", "99213", "1.00", "1.00", "1.00", "PAID"),
         ("E3", "C1", "99213", "1.00", "1.00", "1.00", "PAID")],
        "encounter_id string, charge_id string, cpt_code string, billed_amt string, "
        "paid_amt string, allowed_amt string, claim_status string")
    ch = ch.select("encounter_id", "charge_id", "cpt_code",
                   *[F.col(c).cast("decimal(12,2)").alias(c)
                     for c in ("billed_amt", "paid_amt", "allowed_amt")], "claim_status")
    out = marts.billing_batch(enc, ch, seeds.encounter_types(spark), P)  # cutoff 2024-04-01
    got = sorted((r.encounter_id, r.charge_id, r.high_cost_flag, str(r.patient_responsibility))
                 for r in out.collect())
    assert got == [("E1", "C1", "N", "95.00"), ("E1", "C4", "Y", "95.00"),
                   ("E3", "C1", "N", "0.00")]


def test_gap_batch_collapses_and_null_days_low(spark):
    enc = _enc(spark, [("P1", "E1", 103, dt.datetime(2023, 6, 1), "D", "R", "X", "C"),
                       ("P1", "E2", 999, dt.datetime(2023, 6, 1), "D", "R", "X", "C"),
                       ("P2", "E3", 999, dt.datetime(2024, 6, 1), "D", "R", "X", "C")])
    pat = spark.createDataFrame([("P1", "tok1", "PAY", True), ("P2", "tok2", "PAY", True)],
                                "pat_id string, mrn_token string, payer_name string, "
                                "is_current boolean")
    q = spark.createDataFrame(
        [("P1", "E1", "CDC", "Diabetes", "Y", "N"), ("P1", "E2", "CDC", "Diabetes", "Y", "N"),
         ("P2", "E3", "CBP", "BP", "Y", "N"), ("P2", "E3", "AWV", "W", "Y", "Y")],
        "pat_id string, encounter_id string, measure_id string, measure_name string, "
        "measure_eligible string, measure_compliant string")
    out = marts.gap_batch(q, enc, pat, seeds.encounter_types(spark), P)
    got = sorted((r.pat_id, r.measure_id, r.days_since_last_encounter, r.gap_priority,
                  r.encounter_type_for_outreach) for r in out.collect())
    # P1: tie at the latest time -> the mapped encounter (WELLNESS) wins; 395 days -> HIGH
    # P2: latest encounter unmapped -> no days -> LOW
    assert got == [("P1", "CDC", 395, "HIGH", "WELLNESS"), ("P2", "CBP", None, "LOW", None)]
    assert marts.gap_summary(out).first().status == "PASS"


def test_null_rate_rounding_and_empty(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    r = {x.column_name: x for x in checks.null_rate(df, "t", ["a", "b"]).collect()}
    assert (r["a"].null_count, r["a"].column_status) == (0, "PASS")
    assert (r["b"].null_rate, r["b"].column_status) == (0.5, "FAIL")
    empty = spark.createDataFrame([], "a int")
    v = checks.null_rate_verdict(checks.null_rate(empty, "t", ["a"])).first()
    assert (v.row_count, v.status) == (0, "PASS")


def test_row_count_threshold(spark):
    cur = spark.range(79)
    hist = spark.createDataFrame([(100,), (100,)], "row_count long")
    v = checks.row_count_threshold(cur, hist, "t", 0.8).first()
    assert (v.minimum_required, v.status) == (80, "FAIL")
    v = checks.row_count_threshold(spark.range(80), hist, "t", 0.8).first()
    assert v.status == "PASS"
    none = spark.createDataFrame([], "row_count long")
    v = checks.row_count_threshold(spark.range(0), none, "t", 0.8).first()
    assert (v.current_count, v.history_samples, v.status) == (0, 0, "PASS")


def test_snapshot_history_window_and_json(spark):
    at = dt.datetime(2024, 6, 30, 12)
    audit = spark.createDataFrame([
        ("r", dt.datetime(2024, 6, 23, 0, 0), "t", "row_count_snapshot", "PASS", '{"row_count": 10}'),
        ("r", dt.datetime(2024, 6, 22, 23, 59), "t", "row_count_snapshot", "PASS", '{"row_count": 99}'),
        ("r", dt.datetime(2024, 6, 29), "t", "row_count_snapshot", "FAIL", '{"row_count": 99}'),
        ("r", dt.datetime(2024, 6, 29), "u", "row_count_snapshot", "PASS", '{"row_count": 99}'),
        ("r", dt.datetime(2024, 6, 29), "t", "row_count_snapshot", "PASS", '{"x": 1}'),
    ], schemas.DQ_RESULTS)
    h = checks.snapshot_history(audit, "t", at, 7)
    assert [r.row_count for r in h.collect()] == [10]


def test_referential_integrity_null_child_is_orphan(spark):
    child = spark.createDataFrame([("a",), (None,), ("b",), ("b",)], "pat_id string")
    parent = spark.createDataFrame([("a",)], "pat_id string")
    v = checks.referential_integrity(child, parent, "pat_id", "c", "p").first()
    assert (v.orphan_count, v.status) == (2, "FAIL")
    empty = spark.createDataFrame([], "pat_id string")
    assert checks.referential_integrity(empty, parent, "pat_id", "c", "p").first().status == "PASS"
    sample = [r.pat_id for r in checks.orphan_sample(child, parent, "pat_id").collect()]
    assert sample == [None, "b"]


def test_unknown_mart_key(spark, tmpdir_path):
    with pytest.raises(ValueError, match="Unknown mart key"):
        dq.run_assertions_for_mart(Store(spark, tmpdir_path), "nope", "run", P)


def test_mart_gate_logs_then_snapshots(spark, tmpdir_path):
    store = Store(spark, tmpdir_path)
    billing = schemas.literal_frame(spark, [("P1", "E1", "C1")] + [(None, "E2", "C2")],
                                    schemas._struct(("pat_id", schemas.S),
                                                    ("encounter_id", schemas.S),
                                                    ("charge_id", schemas.S)))
    store.replace(dq.BILLING, billing)
    with pytest.raises(dq.DataQualityError, match="null_rate"):
        dq.run_assertions_for_mart(store, "billing", "run1", P)
    log = store.read(dq.AUDIT)
    assert sorted((r.assertion_name, r.status) for r in log.collect()) == [
        ("null_rate:pat_id,encounter_id,charge_id", "FAIL"), ("row_count_threshold", "PASS")]
    store.replace(dq.BILLING, billing.filter(F.col("pat_id").isNotNull()))
    dq.run_assertions_for_mart(store, "billing", "run2", P)
    snaps = store.read(dq.AUDIT).filter(F.col("assertion_name") == "row_count_snapshot")
    assert [r.details for r in snaps.collect()] == [
        '{"table":"gold_billing.claims_processed","row_count":1}']


def test_bound_before_dedupe_equals_bound_after(spark):
    """The look-back / year bound commutes with latest-row dedupe."""
    from carelake.functions import in_year, lit_ts
    from carelake.plans.silver import Silver
    t = dt.datetime
    rows = [("P1", "E1", 101, t(2024, 5, 1), "D1", "R", "X", "C"),   # latest, passes
            ("P1", "E1", 101, t(2024, 1, 1), "D2", "R", "X", "C"),   # older, passes alone
            ("P1", "E2", 101, t(2024, 5, 1), "D1", "R", "X", "C"),   # tie at latest
            ("P1", "E2", 102, t(2024, 5, 1), "D0", "R", "X", "C"),
            ("P1", "E3", 101, t(2023, 12, 31), "D", "R", "X", "C"),  # latest fails
            ("P1", "E3", 101, None, "D", "R", "X", "C"),
            ("P1", "E4", 101, None, "D", "R", "X", "C"),             # only NULL time
            ("P1", "E5", 101, t(2024, 3, 1), "D", "R", "X", "C"),
            ("P1", "E5", 101, t(2023, 3, 1), "D", "R", "X", "C")]
    bronze = spark.createDataFrame(rows, ENC)
    silver = Silver(spark, {"encounter": lambda: bronze}, seeds.encounter_types(spark), P)
    for cond in [F.col("encounter_dttm") >= lit_ts(t(2024, 1, 1)),
                 in_year("encounter_dttm", 2024)]:
        before = silver.dim_encounter_where(cond)
        after = silver.dim_encounter.filter(cond)
        assert sorted(map(str, before.collect())) == sorted(map(str, after.collect()))
