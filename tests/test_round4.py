"""First loads exchange keys only, micro-batches are written unsorted, and a first night looks for no touched encounters."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from carelake import schemas
from carelake.operators.lookup import proven_empty
from carelake.operators.upsert import upsert_all, upsert_columns
from carelake.params import TESTDATA_PARAMS
from carelake.plans import pipeline
from carelake.plans.pipeline import Run, run_pipeline
from carelake.sources import adapter
from carelake.sources.store import Store
from carelake.streaming.ingest import open_writers
from tests.conftest import SF_SMALL

KV = schemas._struct(("k", schemas.S), ("j", schemas.S), ("v", schemas.S))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def test_a_first_load_gives_the_rows_of_a_merge_with_an_empty_table(spark):
    src = spark.createDataFrame([("a", "1", "x"), ("b", None, "y"), ("b", None, "y"), (None, "1", "z"), ("c", "1", None)], KV)
    empty, none_left = schemas.empty(spark, KV), src.where("v = 'none'")
    assert proven_empty(empty) and not proven_empty(none_left)
    for fn in (lambda t: upsert_all(t, src, ["k", "j"]), lambda t: upsert_columns(t, src, ["k", "j"], ["v"]),
               lambda t: upsert_all(t, src, ["k", "j"], "latest", [F.col("v").desc()])):
        assert _rows(fn(empty)) == _rows(fn(none_left))


def test_a_first_load_still_fails_on_a_repeated_key(spark):
    src = spark.createDataFrame([("a", "1", "x"), ("a", "1", "y")], KV)
    with pytest.raises(Exception, match="duplicate key: a|1"):
        upsert_all(schemas.empty(spark, KV), src, ["k", "j"]).write.format("noop").mode("overwrite").save()


def test_a_first_load_exchanges_keys_only(spark):
    src = spark.range(10).selectExpr("cast(id as string) k", "'1' j", "'v' v")
    plan = _plan(upsert_all(schemas.empty(spark, KV), src, ["k", "j"]))
    assert "SortAggregate" not in plan and "REPARTITION_BY_COL" not in plan


def test_writers_stay_open_during_an_ingest_only(spark):
    key = "spark.sql.maxConcurrentOutputFileWriters"
    old = spark.conf.get(key)
    with pytest.raises(KeyError), open_writers(spark):
        assert int(spark.conf.get(key)) > 0
        raise KeyError
    assert spark.conf.get(key) == old


def test_a_first_night_touches_every_encounter_without_a_list(spark, tmpdir_path):
    landing = os.path.join(tmpdir_path, "landing")
    measures = adapter.land_measure_definitions(spark, landing)
    adapter.land_first_delivery(spark, SF_SMALL, landing)
    specs = adapter.delivery_specs(landing, measures)
    store = Store(spark, os.path.join(tmpdir_path, "store"))
    day1 = TESTDATA_PARAMS.with_(as_of_date=dt.date(2001, 8, 1))
    run = Run(spark, store, day1, specs, cross_mart="log", incremental=True)
    run_pipeline(run)
    assert [tuple(r) for r in store.read("staging.touched", pipeline.TOUCHED).collect()] == [(None,)]
    assert "Join" not in _plan(pipeline._silver(run, "silver.fact_charges"))
    adapter.land_second_delivery(spark, SF_SMALL, landing)
    run = Run(spark, store, TESTDATA_PARAMS, specs, cross_mart="log", incremental=True)
    run_pipeline(run)
    touched = store.read("staging.touched", pipeline.TOUCHED)
    for table in pipeline.TOUCHED_ROWS:
        held = pipeline._silver(run, table)
        assert "Join" not in _plan(held) and 0 < held.count() < store.read(table).count()
        assert _rows(held) == _rows(store.read(table).join(touched, "encounter_id", "left_semi").select(held.columns))
