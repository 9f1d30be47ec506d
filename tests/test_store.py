"""Tables keep their committed state whatever is lost around it, and merges rewrite what a batch touches."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from carelake import schemas
from carelake.operators.upsert import upsert_all
from carelake.sources.store import PENDING, Store

ENC = "silver.dim_encounter"


def _ids(store, name="silver.t", schema="id bigint"):
    from pyspark.sql.types import _parse_datatype_string
    return sorted(r[0] for r in store.read(name, _parse_datatype_string(schema)).collect())


def _encounters(spark, rows):
    """(encounter number, time) rows under the contract."""
    at = dt.datetime(2001, 8, 1)
    return schemas.literal_frame(spark, [("P", f"E{i}", 101, "OFFICE", t, "D", "R", "DX_I10", "I10", "F", at)
                                         for i, t in rows], schemas.DIM_ENCOUNTER)


def _merge(store, batch):
    return store.merge(ENC, store.stage("b", batch), ["encounter_id"], lambda o, n: upsert_all(o, n, ["encounter_id"]))


def _held(store):
    return sorted((r.encounter_id, r.encounter_dttm) for r in store.read(ENC).collect())


def _months(spark, store):
    """Month folder -> files of the merged table."""
    out = {}
    for f in spark.table(store.table(ENC)).inputFiles():
        out.setdefault(f.split("_month=")[1][:10], set()).add(f)
    return out


MAY, JUNE, JULY = (dt.datetime(2001, m, 10) for m in (5, 6, 7))


def test_a_crash_between_write_and_view_swap_keeps_the_old_state(spark, tmpdir_path, monkeypatch):
    s = Store(spark, tmpdir_path)
    s.replace("silver.t", spark.range(2))
    with monkeypatch.context() as m:
        m.setattr(Store, "_point", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            s.replace("silver.t", spark.range(9))
    fresh = Store(spark, tmpdir_path)
    assert _ids(fresh) == [0, 1]
    fresh.replace("silver.t", spark.range(3))
    assert _ids(Store(spark, tmpdir_path)) == [0, 1, 2]


def test_a_batch_of_one_month_rewrites_one_month(spark, tmpdir_path):
    s = Store(spark, tmpdir_path)
    first = _merge(s, _encounters(spark, [(1, MAY), (2, JUNE), (3, JULY), (4, None)]))
    assert (first.rows, first.total, first.months) == (4, 4, None)
    before = _months(spark, s)
    assert set(before) == {"2001-05-01", "2001-06-01", "2001-07-01", "1900-01-01"}
    done = _merge(s, _encounters(spark, [(2, JUNE + dt.timedelta(days=3)), (5, JUNE)]))
    after = _months(spark, s)
    assert {m for m in after if after[m] != before[m]} == {"2001-06-01"}
    assert (done.rows, done.total, done.months) == (2, 5, [dt.date(2001, 6, 1)])
    assert _held(s) == [("E1", MAY), ("E2", JUNE + dt.timedelta(days=3)), ("E3", JULY), ("E4", None), ("E5", JUNE)]
    # a reader that asks for months reads their partitions only
    plan = s.read(ENC, months=(dt.date(2001, 6, 15), None))._jdf.queryExecution().executedPlan().toString()
    assert "_month" in plan.split("PartitionFilters:")[1][:80]
    assert s.read(ENC, months=(dt.date(2001, 6, 15), dt.date(2001, 6, 15))).count() == 2


def test_a_row_that_moves_leaves_its_old_month(spark, tmpdir_path):
    s = Store(spark, tmpdir_path)
    _merge(s, _encounters(spark, [(1, MAY), (2, JUNE)]))
    done = _merge(s, _encounters(spark, [(1, JULY)]))
    assert done.months == [dt.date(2001, 5, 1), dt.date(2001, 7, 1)] and done.total == 2
    assert set(_months(spark, s)) == {"2001-06-01", "2001-07-01"}  # May is empty and gone
    assert _held(s) == [("E1", JULY), ("E2", JUNE)]
    assert _merge(s, _encounters(spark, [])).months == []


def test_a_merge_that_died_in_its_copy_is_completed_by_the_next_reader(spark, tmpdir_path, monkeypatch):
    s = Store(spark, tmpdir_path)
    _merge(s, _encounters(spark, [(1, MAY), (2, JUNE)]))
    with monkeypatch.context() as m:
        m.setattr(Store, "_copy", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            _merge(s, _encounters(spark, [(1, JULY)]))
    spark.sql(f"ALTER TABLE {s.table(ENC)} DROP PARTITION (_month = DATE'2001-05-01')")  # half of the copy was done
    fresh = Store(spark, tmpdir_path)
    assert _held(fresh) == [("E1", JULY), ("E2", JUNE)]
    assert PENDING not in fresh.properties(ENC)


def test_a_failed_write_commits_nothing(spark, tmpdir_path):
    s = Store(spark, tmpdir_path)
    s.replace("silver.t", spark.range(2))
    with pytest.raises(Exception, match="boom"):
        s.replace("silver.t", spark.range(2).select(F.raise_error(F.lit("boom")).cast("bigint").alias("id")))
    assert _ids(Store(spark, tmpdir_path)) == [0, 1]


def test_unreadable_log_is_an_error_not_an_empty_table(spark, tmpdir_path):
    s = Store(spark, tmpdir_path)
    s.append("audit.dq_results", schemas.empty(spark, schemas.DQ_RESULTS).union(
        spark.sql("SELECT 'r', TIMESTAMP_NTZ'2001-08-02', 'm', 'a', 'PASS', '{}'")))
    for f in spark.table(s.table("audit.dq_results")).inputFiles():
        with open(f.removeprefix("file://").removeprefix("file:"), "w") as out:
            out.write("damaged")
    with pytest.raises(Exception):  # noqa: B017 - Spark's own error
        s.read("audit.dq_results").collect()


def test_retention_keeps_the_newest_states(spark, tmpdir_path):
    s = Store(spark, tmpdir_path, retain=2)
    for n in range(1, 5):
        s.replace("silver.t", spark.range(n))
    assert [spark.table(t).count() for t in s._states("silver.t")] == [3, 4]
    assert _ids(s) == [0, 1, 2, 3]
    with pytest.raises(ValueError):
        Store(spark, tmpdir_path, retain=1)


def test_properties_stay_with_the_name(spark, tmpdir_path):
    s = Store(spark, tmpdir_path)
    s.replace("silver.t", spark.range(1))
    s.set_properties("silver.t", {"a": "1"})
    s.set_properties("silver.t", {"b": "it's"})
    s.replace("silver.t", spark.range(2))
    assert Store(spark, tmpdir_path).properties("silver.t") == {"a": "1", "b": "it's"}


def test_shared_folder_must_be_named_on_a_cluster(monkeypatch, spark):
    from carelake import session

    class Context:
        master = "spark://host:7077"

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_a_contract_holds_on_write(spark, tmpdir_path):
    """Types and column order are the contract's; a NULL key fails the write and commits nothing."""
    table = "gold_care_mgmt.gap_queue"
    s = Store(spark, tmpdir_path)
    row = spark.sql("SELECT 'CDC' AS measure_id, 'P1' AS pat_id, 400L AS days_since_last_encounter, 1 AS other")
    assert s.replace_checked(table, row).rows == 1
    kept = spark.table(s.table(table))
    assert [(f.name, f.dataType) for f in kept.schema] == [(f.name, f.dataType) for f in schemas.GAP_QUEUE]
    with pytest.raises(Exception, match="NOT NULL constraint violated"):
        s.replace_checked(table, row.selectExpr("CAST(NULL AS STRING) AS pat_id", "measure_id"))
    assert Store(spark, tmpdir_path).read(table).count() == 1
