"""Streaming ingest (exactly once per file) and reference-table loading."""

import datetime as dt
import os

from pyspark.sql import functions as F

from carelake import schemas
from carelake.plans import reference
from carelake.sources import adapter, seeds
from carelake.sources.store import Store
from carelake.streaming.ingest import IngestSpec, ingest, ingest_profile

from tests.conftest import SF_SMALL


def test_ingest_once_then_only_new_files(spark, tmpdir_path):
    landing = os.path.join(tmpdir_path, "landing", "encounter")
    src = adapter.table(spark, SF_SMALL, "orders")
    src.filter("o_orderkey % 2 = 0").write.parquet(os.path.join(landing, "part1"))
    spec = IngestSpec("encounter", adapter.ORDERS_SCHEMA, landing + "/*",
                      lambda df: adapter._carry_meta(df, adapter.encounter_from_orders,
                                                     ["_src_key"]))
    target, ckpt = Store(spark, tmpdir_path).table("bronze.encounter"), os.path.join(tmpdir_path, "ckpt")
    r1 = ingest(spark, spec, target, ckpt, "b1")
    n_even = src.filter("o_orderkey % 2 = 0").count()
    assert r1["rows_added"] == n_even
    r2 = ingest(spark, spec, target, ckpt, "b2")  # replay: nothing new
    assert r2["rows_added"] == 0
    src.filter("o_orderkey % 2 = 1").write.parquet(os.path.join(landing, "part2"))
    r3 = ingest(spark, spec, target, ckpt, "b3")
    assert r3["rows_added"] == src.count() - n_even
    bronze = spark.table(target)
    assert bronze.count() == src.count()
    assert set(bronze.columns) >= {"pat_id", "encounter_id", "_ingestion_timestamp",
                                   "_source_file", "_batch_id", "_ingestion_date"}
    prof = ingest_profile({"bronze.encounter": bronze}).first()
    assert (prof.total_rows, prof.distinct_batches) == (src.count(), 2)
    assert bronze.filter(F.col("_source_file").contains("part2")).count() == r3["rows_added"]


def test_backlog_drains_in_bounded_batches(spark, tmpdir_path):
    landing = os.path.join(tmpdir_path, "landing")
    src = adapter.table(spark, SF_SMALL, "customer")
    for i in range(3):
        src.filter(f"c_custkey % 3 = {i}").write.parquet(os.path.join(landing, f"f{i}"))
    spec = IngestSpec("dim_patient", adapter.CUSTOMER_SCHEMA, landing + "/*",
                      lambda df: adapter._carry_meta(df, adapter.patient_from_customer,
                                                     ["_src_key"]),
                      max_files_per_trigger=1)
    target = Store(spark, tmpdir_path).table("bronze.dim_patient")
    r = ingest(spark, spec, target, os.path.join(tmpdir_path, "ckpt"), "b1")
    assert r["rows_added"] == src.count()
    assert spark.table(target).count() == src.count()
    commits = os.listdir(os.path.join(tmpdir_path, "ckpt", "commits"))
    assert len([c for c in commits if not c.startswith(".")]) >= 3


def test_seed_tables_and_validation(spark, tmpdir_path):
    store = Store(spark, tmpdir_path)
    v = reference.load_encounter_types(spark, store).first()
    assert (v.row_count, v.distinct_keys, v.other_rows, v.status) == (5, 5, 1, "PASS")
    res = {r.code_type: r for r in reference.load_eligibility_codes(spark, store).collect()}
    assert res["CPT"].row_count == 5 and res["ICD10"].row_count == 4
    assert all(r.status == "PASS" for r in res.values())
    assert len(store._states(reference.ELIGIBILITY_CODES)) == 1
    reference.load_eligibility_codes(spark, store)
    assert len(store._states(reference.ELIGIBILITY_CODES)) == 2
    assert store.read(reference.ELIGIBILITY_CODES).count() == 9


def test_seed_csv_reads_int_flag_and_empty_expiry(spark, tmpdir_path):
    p1 = os.path.join(tmpdir_path, "types.csv")
    with open(p1, "w") as f:
        f.write("visit_type_c,encounter_type,description,effective_date,is_active\n"
                "101,OFFICE,Office,2024-01-01,1\n0,OTHER,Other,2024-01-01,0\n")
    rows = seeds.read_encounter_types_csv(spark, p1).orderBy("visit_type_c").collect()
    assert [(r.visit_type_c, r.is_active) for r in rows] == [(0, False), (101, True)]
    p2 = os.path.join(tmpdir_path, "codes.csv")
    with open(p2, "w") as f:
        f.write("measure_id,code_type,code_value,effective_date,expiration_date\n"
                "CDC,CPT,99213,2024-01-01,\nOLD,CPT,99999,2020-01-01,2021-01-01\n")
    rows = seeds.read_eligibility_codes_csv(spark, p2).orderBy("measure_id").collect()
    assert [(r.measure_id, r.expiration_date) for r in rows] == [
        ("CDC", None), ("OLD", dt.date(2021, 1, 1))]


def test_normalize_code_sets_trims_and_drops_blanks(spark):
    codes = reference.normalize_code_sets(adapter.measure_definitions(spark))
    got = sorted((r.measure_id, r.code_type, r.code_value) for r in codes.collect())
    assert got == [("AAB", "ICD10", "J45909"), ("AWV", "CPT", "99395"), ("AWV", "CPT", "G0438"),
                   ("AWV", "CPT", "G0439"), ("CBP", "ICD10", "I10"), ("CDC", "CPT", "99213"),
                   ("CDC", "CPT", "99214"), ("CDC", "ICD10", "E119")]
    assert reference.check_rows(codes).count() == 0
    assert all(r.status == "PASS" for r in reference.validate_code_sets(codes).collect())


def test_validate_codes_flags_short_and_delimited(spark):
    bad = schemas.literal_frame(spark, [("X", "CPT", "9921", dt.date(2024, 1, 1), None),
                                        ("X", "CPT", "99 13", dt.date(2024, 1, 1), None),
                                        ("X", "HCPCS", "A123", dt.date(2024, 1, 1), None)],
                                schemas.ELIGIBILITY_CODES)
    r = {x.code_type: x for x in reference.validate_code_sets(bad).collect()}
    assert (r["CPT"].short_codes, r["CPT"].delimited_codes, r["CPT"].status) == (0, 1, "FAIL")
    assert (r["HCPCS"].invalid_types, r["HCPCS"].status) == (1, "FAIL")
    assert reference.check_rows(bad).count() == 1


def test_code_validity_expired_and_future(spark):
    from carelake.params import Params
    from carelake.plans.eligibility import valid_codes
    extra = [("OLD", "CPT", "11111", dt.date(2020, 1, 1), dt.date(2023, 12, 31)),
             ("NEW", "CPT", "22222", dt.date(2025, 1, 1), None),
             ("EDGE", "CPT", "33333", dt.date(2024, 1, 1), dt.date(2024, 6, 30))]
    codes = seeds.eligibility_codes(spark, extra)
    got = {r.measure_id for r in valid_codes(codes, "CPT", Params(
        as_of_date=dt.date(2024, 6, 30))).collect()}
    assert got == {"CDC", "AWV", "EDGE"}


def test_store_properties_views_and_versions(spark, tmpdir_path):
    store = Store(spark, tmpdir_path)
    reference.load_encounter_types(spark, store)
    props = store.properties(reference.ENCOUNTER_TYPES)
    assert props["quality"] == "reference"
    store.set_properties(reference.ENCOUNTER_TYPES, {"steward": "data-eng"})
    assert set(store.properties(reference.ENCOUNTER_TYPES)) == {
        "quality", "source", "description", "steward"}
    views = store.register_views([reference.ENCOUNTER_TYPES])
    assert spark.sql(f"SELECT count(*) AS n FROM {views[0]}").first().n == 5
    # missing table reads as an empty table with its contract
    assert store.read("silver.dim_patient").columns == schemas.DIM_PATIENT.fieldNames()
    c = schemas.with_comments(schemas.DIM_PATIENT, "silver.dim_patient")
    assert "SHA-256" in c["mrn_token"].metadata["comment"]


def test_cluster_by_narrows_row_groups_for_range_filters(spark, tmpdir_path):
    import pyarrow.parquet as pq
    from carelake.plans.staging import stage_encounters
    old = spark.conf.get("parquet.block.size", None)
    spark.conf.set("parquet.block.size", str(64 * 1024))
    try:
        store = Store(spark, tmpdir_path)
        enc = stage_encounters(adapter.encounter(spark, "/root/testdata/sf0.01"),
                               seeds.encounter_types(spark), dt.datetime(2001, 8, 2))
        cutoff = dt.datetime(2001, 5, 4)
        hits = {}
        for name, cluster in [("silver.plain", None), ("silver.clustered", ["encounter_dttm"])]:
            store.replace(name, enc, cluster_by=cluster)
            groups = 0
            hits[name] = 0
            for f in (u.removeprefix("file://") for u in spark.table(store.table(name)).inputFiles()):
                md = pq.ParquetFile(f).metadata
                col = pq.ParquetFile(f).schema_arrow.get_field_index("encounter_dttm")
                for i in range(md.num_row_groups):
                    groups += 1
                    hits[name] += md.row_group(i).column(col).statistics.max >= cutoff
        assert hits["silver.clustered"] < hits["silver.plain"]
        assert store.read("silver.clustered").count() == enc.count()
    finally:
        if old is None:
            spark.conf.unset("parquet.block.size")
        else:
            spark.conf.set("parquet.block.size", old)
