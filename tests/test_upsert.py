"""Upsert / SCD2 semantics on literal frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from carelake import schemas
from carelake.operators.upsert import (duplicate_keys, idempotency_summary, scd2_apply,
                                       upsert_all, upsert_columns)
from carelake.plans.staging import PATIENT_ATTRS

T = "k string, v string, load_dttm timestamp_ntz, updated_dttm timestamp_ntz"
D1, D2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)


def rows(df, order="k"):
    return [tuple(r) for r in df.orderBy(F.col(order).asc_nulls_first(), "v").collect()]


def test_upsert_all_update_insert_keep(spark):
    tgt = spark.createDataFrame([("a", "1", D1, D1), ("b", "1", D1, D1)], T)
    src = spark.createDataFrame([("b", "2", D2, D2), ("c", "2", D2, D2)], T)
    assert rows(upsert_all(tgt, src, ["k"])) == [
        ("a", "1", D1, D1), ("b", "2", D2, D2), ("c", "2", D2, D2)]


def test_upsert_columns_keeps_first_load_time(spark):
    tgt = spark.createDataFrame([("a", "1", D1, D1), ("b", "1", D1, D1)], T)
    src = spark.createDataFrame([("b", "2", D2, D2), ("c", "2", D2, D2)], T)
    out = upsert_columns(tgt, src, ["k"], ["v", "updated_dttm"])
    assert rows(out) == [("a", "1", D1, D1), ("b", "2", D1, D2), ("c", "2", D2, D2)]


def test_upsert_applied_twice_is_idempotent(spark):
    tgt = spark.createDataFrame([("a", "1", D1, D1)], T)
    src = spark.createDataFrame([("a", "2", D2, D2), ("b", "2", D2, D2)], T)
    once = upsert_columns(tgt, src, ["k"], ["v", "updated_dttm"])
    twice = upsert_columns(once, src, ["k"], ["v", "updated_dttm"])
    assert rows(once) == rows(twice)
    assert idempotency_summary(twice, ["k"]).first().status == "PASS"


def test_null_keys_never_match(spark):
    tgt = spark.createDataFrame([(None, "t", D1, D1)], T)
    src = spark.createDataFrame([(None, "s", D2, D2)], T)
    assert len(rows(upsert_all(tgt, src, ["k"]))) == 2
    assert len(rows(upsert_columns(tgt, src, ["k"], ["v"]))) == 2


def test_duplicate_source_keys_raise(spark):
    tgt = spark.createDataFrame([], T)
    src = spark.createDataFrame([("a", "1", D1, D1), ("a", "2", D2, D2)], T)
    with pytest.raises(Exception, match="duplicate key"):
        upsert_all(tgt, src, ["k"]).collect()
    latest = upsert_all(tgt, src, ["k"], on_duplicate="latest",
                        order=[F.col("load_dttm").desc()])
    assert rows(latest) == [("a", "2", D2, D2)]


def test_duplicate_keys_probe_and_empty_table(spark):
    src = spark.createDataFrame([("a", "1", D1, D1), ("a", "2", D2, D2), ("b", "1", D1, D1)], T)
    assert [tuple(r) for r in duplicate_keys(src, ["k"]).collect()] == [("a", 2)]
    empty = spark.createDataFrame([], T)
    v = idempotency_summary(empty, ["k"]).first()
    assert (v.row_count, v.distinct_keys, v.status) == (0, 0, "PASS")


def _staged(spark, data):
    return spark.createDataFrame(data, "pat_id string, mrn_token string, first_name string, "
                                 "last_name string, birth_date date, gender string, "
                                 "zip_code string, payer_name string")


def test_scd2_expire_insert_and_noop(spark):
    b = dt.date(1970, 1, 1)
    day1, day2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    s1 = _staged(spark, [("P1", "t", "A", "X", b, "F", "1", "PAY"),
                         ("P2", "t", "B", "Y", None, "M", "2", "PAY"),
                         ("P3", "t", "C", "Z", None, "M", "3", "PAY")])
    t1 = scd2_apply(schemas.empty(spark, schemas.DIM_PATIENT), s1, "pat_id", PATIENT_ATTRS,
                    day1, D1)
    # P1 payer changes; P2 birth NULL -> set (null-safe change); P3 unchanged (NULL<=>NULL)
    s2 = _staged(spark, [("P1", "t", "A", "X", b, "F", "1", "SELF"),
                         ("P2", "t", "B", "Y", b, "M", "2", "PAY"),
                         ("P3", "t", "C", "Z", None, "M", "3", "PAY"),
                         ("P4", "t", "D", "W", b, "U", "4", "PAY")])
    t2 = scd2_apply(t1, s2, "pat_id", PATIENT_ATTRS, day2, D2)
    got = sorted(((r.pat_id, r.payer_name, r.is_current, r.effective_date, r.expiration_date)
                  for r in t2.collect()), key=lambda x: (x[0], x[2]))
    assert got == [
        ("P1", "PAY", False, day1, day2), ("P1", "SELF", True, day2, None),
        ("P2", "PAY", False, day1, day2), ("P2", "PAY", True, day2, None),
        ("P3", "PAY", True, day1, None), ("P4", "PAY", True, day2, None)]
    t3 = scd2_apply(t2, s2, "pat_id", PATIENT_ATTRS, day2, D2)
    assert sorted(map(str, t3.collect())) == sorted(map(str, t2.collect()))


def test_column_merge_updates_inserts_and_keeps(spark):
    tgt = spark.createDataFrame([("a", "1", D1, D1), ("b", "1", D1, D1), (None, "n", D1, D1)], T)
    src = spark.createDataFrame([("b", "2", D2, D2), ("c", "2", D2, D2), (None, "m", D2, D2), (None, "m", D2, D2)], T)
    out = upsert_columns(tgt, src, ["k"], ["v", "updated_dttm"])
    assert rows(out) == [(None, "m", D2, D2), (None, "m", D2, D2), (None, "n", D1, D1), ("a", "1", D1, D1),
                         ("b", "2", D1, D2), ("c", "2", D2, D2)]


def test_a_repeated_target_key_is_an_error_and_latest_picks_one(spark):
    twice = spark.createDataFrame([("a", "1", D1, D1), ("a", "2", D2, D2)], T)
    none = spark.createDataFrame([], T)
    with pytest.raises(Exception, match="target has duplicate key: a"):
        upsert_all(twice, none, ["k"]).count()
    out = upsert_all(none, twice, ["k"], on_duplicate="latest", order=[F.col("load_dttm").desc()])
    assert rows(out) == [("a", "2", D2, D2)]


@pytest.mark.parametrize("merge", [
    lambda t, s: upsert_all(t, s, ["k"]), lambda t, s: upsert_columns(t, s, ["k"], ["v"])])
def test_a_merge_is_one_scan_of_each_input_and_one_exchange(spark, tmpdir_path, merge):
    for name in ("t", "s"):
        spark.createDataFrame([(name, "1", D1, D1)], T).write.parquet(f"{tmpdir_path}/{name}")
    out = merge(*[spark.read.parquet(f"{tmpdir_path}/{n}") for n in ("t", "s")])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    assert out.count() == 2


def test_lookup_is_checked_again_after_it_grew(spark, tmpdir_path):
    from carelake.operators.lookup import bounded_broadcast, plan_bytes
    path = f"{tmpdir_path}/lookup"
    spark.range(3).write.parquet(path)
    limit = plan_bytes(spark.read.parquet(path)) + 10
    hinted = lambda: "broadcast" in bounded_broadcast(
        spark.read.parquet(path), limit)._jdf.queryExecution().logical().toString().lower()
    assert hinted()
    spark.range(5000).write.mode("append").parquet(path)
    assert not hinted()


def test_scd2_is_one_exchange_and_leaves_history_alone(spark, tmpdir_path):
    spark.createDataFrame([("a", "m", D1.date(), None, True, D1), ("a", "l", D1.date(), D1.date(), False, D1)],
                          "pat_id string, mrn string, effective_date date, expiration_date date, is_current boolean, "
                          "load_dttm timestamp_ntz").write.parquet(f"{tmpdir_path}/t")
    out = scd2_apply(spark.read.parquet(f"{tmpdir_path}/t"), spark.createDataFrame([("a", "n")], "pat_id string, mrn string"),
                     "pat_id", ["mrn"], D2.date(), D2, null_safe=())
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    assert sorted((r.mrn, r.is_current) for r in out.collect()) == [("l", False), ("m", False), ("n", True)]


def test_merge_latest_newer_wins_older_loses(spark):
    from carelake.operators.upsert import merge_latest
    tgt = spark.createDataFrame([("a", "1", D2, D2), ("b", "1", D2, D2), ("c", "1", D1, D1)], T)
    batch = spark.createDataFrame([("a", "new", D2 + dt.timedelta(days=1), D2),
                                   ("b", "old", D1, D1), ("d", "2", D1, D1)], T)
    out = merge_latest(tgt, batch, ["k"], [F.col("load_dttm").desc()])
    assert [(r[0], r[1]) for r in rows(out)] == [("a", "new"), ("b", "1"), ("c", "1"),
                                                ("d", "2")]
