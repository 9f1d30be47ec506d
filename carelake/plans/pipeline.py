"""The nightly medallion run as one gated driver function.

Stages run in dependency order; each writes its output table to the store
(cutting lineage), logs start/end/status/row count to
``audit.orchestration_log``, and a failing gate stops all later stages
(logged as ``UPSTREAM_FAILED``). ``resume_from`` re-runs from a stage
without repeating the ones before it (repair run).
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake import schemas
from carelake.operators import checks, constraints
from carelake.operators.lookup import proven_empty
from carelake.operators.upsert import duplicate_keys, merge_latest, scd2_apply, upsert_all
from carelake.params import Params
from carelake.plans import dq, eligibility, marts, reference, runlog
from carelake.plans.staging import (PATIENT_ATTRS, charge_order, stage_charges, stage_encounters,
                                    stage_patients)
from carelake.sources.store import Store
from carelake.streaming.ingest import IngestSpec, ingest_all

LOG = "audit.orchestration_log"

STAGES = ["bronze_ingestion", "silver_patient_encounter", "silver_hedis_eligibility",
          "gold_billing_mart", "billing_dq", "gold_quality_mart", "quality_dq",
          "gold_care_gaps", "care_gaps_dq"]

OUTPUT_TABLE = {
    "bronze_ingestion": "bronze.encounter",
    "silver_patient_encounter": "silver.dim_encounter",
    "silver_hedis_eligibility": "silver.hedis_eligibility",
    "gold_billing_mart": dq.BILLING, "billing_dq": dq.BILLING,
    "gold_quality_mart": dq.QUALITY, "quality_dq": dq.QUALITY,
    "gold_care_gaps": dq.GAPS, "care_gaps_dq": dq.GAPS,
}


@dataclass
class Run:
    spark: SparkSession
    store: Store
    params: Params
    landing: list[IngestSpec]
    run_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    cross_mart: str = "raise"
    # False: silver is rebuilt from all of bronze each night (the reference's
    # behaviour). True: only bronze rows past the recorded watermark are
    # staged and merged, and later stages look at the encounters they touch, so
    # nightly work grows with new data, not history.
    incremental: bool = False
    # True: delivered encounters and charges that break a row constraint go to
    # quarantine tables before staging.
    quarantine: bool = False


class PipelineHalted(RuntimeError):
    pass


# ---- stages --------------------------------------------------------------------------
# Each stage returns the rows its output table holds, as observed while they were written.
ROWS = "carelake.rows"


def _bronze(run: Run, entity: str) -> DataFrame:
    return run.store.read(f"bronze.{entity}")


def _reference_gate(table: str, verdict: DataFrame) -> None:
    """Halt on a reference load that does not validate."""
    failed = [r.asDict() for r in verdict.collect() if r.status == "FAIL"]
    if failed:
        raise dq.DataQualityError(f"{table} failed its validation: {failed}")


def stage_bronze(run: Run) -> int:
    s = run.store
    if not s.exists(reference.ENCOUNTER_TYPES):
        _reference_gate(reference.ENCOUNTER_TYPES, reference.load_encounter_types(run.spark, s))
    if not s.exists(reference.ELIGIBILITY_CODES):
        _reference_gate(reference.ELIGIBILITY_CODES, reference.load_eligibility_codes(run.spark, s))
    # the row total is taken off while rows stream in, so that a run that dies here leaves none to trust
    main = OUTPUT_TABLE["bronze_ingestion"]
    held = s.properties(main).get(ROWS)
    before = int(held) if held is not None else s.read(main).count() if s.exists(main) else 0
    if held is not None:
        s.drop_property(main, ROWS)
    done = ingest_all(run.spark, list(run.landing), lambda e: s.table(f"bronze.{e}"),
                      lambda e: f"{s.root}/_checkpoints/bronze/{e}", run.run_id)
    rows = before + sum(d["rows_added"] for d in done if d["target"] == s.table(main))
    if s.exists(main):
        s.set_properties(main, {ROWS: str(rows)})
    return rows


def _concurrently(*jobs) -> list:
    """Run independent Spark actions side by side (one driver thread each);
    re-raise the first failure after all have finished."""
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        futures = [pool.submit(j) for j in jobs]
    errors = [f.exception() for f in futures if f.exception() is not None]
    if errors:
        raise errors[0]
    return [f.result() for f in futures]


WATERMARK = "carelake.bronze_watermark"


def _bronze_since_watermark(run: Run, entity: str, target: str):
    """Bronze rows to stage, and the new watermark to record on success."""
    df = _bronze(run, entity)
    if not run.incremental:
        return df, None
    mark = run.store.properties(target).get(WATERMARK)
    if mark:
        since = F.lit(mark).cast("timestamp_ntz")  # the date prunes partitions
        df = df.filter((F.col("_ingestion_date") >= since.cast("date")) & (F.col("_ingestion_timestamp") > since))
    new_mark = df.agg(F.max("_ingestion_timestamp")).first()[0]
    return df, new_mark


def _clean(run: Run, entity: str, df: DataFrame, rules: list) -> DataFrame:
    return constraints.quarantine(run.store, entity, df, rules) if run.quarantine else df


def _record_watermark(run: Run, target: str, mark) -> None:
    if run.incremental and mark is not None:
        run.store.set_properties(target, {WATERMARK: str(mark)})


def stage_silver(run: Run) -> int:
    """Patients, encounters and charges side by side; then, in incremental mode, the encounters whose rows or
    patients changed (``staging.touched``), which is all that later stages look at."""
    s, p = run.store, run.params
    types = s.read(reference.ENCOUNTER_TYPES)
    patient, encounter, charge = "silver.dim_patient", "silver.dim_encounter", "silver.fact_charges"

    def patients():
        bronze, mark = _bronze_since_watermark(run, "dim_patient", patient)
        newest = [F.col("_ingestion_timestamp").desc(), F.col("_source_file").desc(),
                  F.xxhash64(*[c for c in bronze.columns if not c.startswith("_")]).desc()]
        staged = s.stage("patients", stage_patients(bronze, latest_by=newest).drop("attr_hash"))
        s.replace_checked(patient, scd2_apply(s.read(patient), staged, "pat_id", PATIENT_ATTRS, p.as_of_date, p.load_ts))
        _record_watermark(run, patient, mark)
        return staged.select("pat_id")

    def encounters():
        bronze, mark = _bronze_since_watermark(run, "encounter", encounter)
        bronze = _clean(run, "encounter", bronze, constraints.ENCOUNTER_RULES)
        batch = s.stage("encounters", stage_encounters(bronze, types, p.load_ts))
        keys = ["encounter_id"]
        written = s.merge(encounter, batch, keys, lambda old, new: merge_latest(old, new, keys, encounter_order())
                          if run.incremental and not proven_empty(old) else upsert_all(old, new, keys))
        _record_watermark(run, encounter, mark)
        return written.total, batch.select("encounter_id")

    def charges():
        bronze, mark = _bronze_since_watermark(run, "charge_detail", charge)
        bronze = _clean(run, "charge_detail", bronze, constraints.CHARGE_RULES)
        # one projection of bronze rows, which are a table already: reading them again costs less than staging them
        batch = stage_charges(bronze, p.load_ts)
        keys = ["encounter_id", "charge_id"]
        s.merge(charge, batch, keys, lambda old, new: merge_latest(old, new, keys, charge_order()) if run.incremental
                else upsert_all(old, new, keys, on_duplicate="latest", order=charge_order()))
        _record_watermark(run, charge, mark)
        return batch.select("encounter_id")

    first = not s.exists("staging.touched")  # no delivery has been worked off before this one
    delivered, (rows, changed), charged = _concurrently(patients, encounters, charges)
    if run.incremental and first:
        s.replace("staging.touched", schemas.literal_frame(run.spark, [(EVERY,)], TOUCHED))
    elif run.incremental:
        theirs = s.read(encounter).join(delivered, "pat_id", "left_semi").select("encounter_id")
        s.replace("staging.touched", changed.unionByName(charged).unionByName(theirs).distinct())
        for table in TOUCHED_ROWS:  # later stages read these several times
            s.replace(TOUCHED_ROWS[table], _touched(run, s.read(table)))
    silver_gates(run)
    return rows


def _touched(run: Run, df: DataFrame) -> DataFrame:
    """In incremental mode the rows of the encounters that this night's deliveries touch. A change of the
    parameters or of the reference tables concerns all rows: run that night in full."""
    if not run.incremental:
        return df
    touched = run.store.read("staging.touched", TOUCHED)
    if _every(touched):
        return df
    return df.join(touched.hint("shuffle_hash"), "encounter_id", "left_semi")


def _every(touched: DataFrame) -> bool:
    return bool(touched.where(F.col("encounter_id").isNull()).limit(1).count())


def _silver(run: Run, table: str, months: tuple | None = None) -> DataFrame:
    """A silver table for the stages after it: in incremental mode the rows of touched encounters, which the silver
    stage has written."""
    s = run.store
    if run.incremental and not _every(s.read("staging.touched", TOUCHED)) and s.exists(TOUCHED_ROWS[table]):
        return s.read(TOUCHED_ROWS[table], schemas.CONTRACTS[table])
    return _touched(run, s.read(table, months=months))


# Latest-row orders of silver (total within a key, so merges are exact).
def encounter_order():
    return [F.col("encounter_dttm").desc_nulls_last()] + [
        F.col(c).asc_nulls_last() for c in ("pat_id", "visit_type_c", "dept_id", "prov_id",
                                            "primary_dx_id", "encounter_status")]


def silver_gates(run: Run) -> None:
    s = run.store
    nulls = checks.null_key_counts({
        "silver.dim_patient": (s.read("silver.dim_patient"), ["pat_id"]),
        "silver.dim_encounter": (s.read("silver.dim_encounter"), ["pat_id", "encounter_id"]),
        "silver.fact_charges": (s.read("silver.fact_charges"), ["encounter_id"]),
    }).filter(F.col("status") == "FAIL").collect()
    if nulls:
        raise dq.DataQualityError(f"Null keys in silver: {[r.asDict() for r in nulls]}")
    drift = checks.mapping_drift(s.read("silver.dim_encounter"),
                                 s.read(reference.ENCOUNTER_TYPES)).first()
    if drift.status == "FAIL":
        raise dq.DataQualityError(f"{drift.unmapped_count} encounters with unexpected type")


def stage_eligibility(run: Run) -> int:
    s, p = run.store, run.params
    codes = s.read(reference.ELIGIBILITY_CODES)
    enc, charges = _silver(run, "silver.dim_encounter"), _silver(run, "silver.fact_charges")
    batch = s.stage("hedis_eligibility", eligibility.eligibility_batch(
        s.read("silver.dim_patient"), enc, charges, codes, _bronze(run, "hedis_measure_definition"), p, with_time=True))
    keys = ["pat_id", "encounter_id", "measure_id"]
    table = "silver.hedis_eligibility"
    written = s.merge(table, batch, keys, lambda old, new: upsert_all(old, new, keys))
    result = _touched(run, s.read(table))

    def exact_match_only():
        bad = eligibility.unsupported_eligibility(result, enc, charges, codes, p)
        if bad.limit(1).count():
            raise dq.DataQualityError("Eligibility rows without an exact code match")

    def unique_keys():
        if duplicate_keys(result, keys).limit(1).count():
            raise dq.DataQualityError("Duplicate keys in silver.hedis_eligibility after upsert")

    _concurrently(exact_match_only, unique_keys)
    return written.total


def _idempotent(df: DataFrame, table: str) -> None:
    v = df.first()
    if v.status == "FAIL":
        raise RuntimeError(f"{table} is not unique by its key: {v.row_count} rows, {v.distinct_keys} keys")


def stage_billing(run: Run) -> int:
    s, p = run.store, run.params
    since = (marts.lookback_cutoff(p).date(), None)
    batch = s.stage("billing_batch", marts.billing_batch(
        _silver(run, "silver.dim_encounter", months=since), _silver(run, "silver.fact_charges"),
        s.read(reference.ENCOUNTER_TYPES), p))
    written = s.merge(dq.BILLING, batch, marts.BILLING_KEYS, marts.billing_upsert)
    _idempotent(marts.billing_summary(s.read(dq.BILLING)), dq.BILLING)
    run.spark.conf.set("carelake.dq.last_mart", dq.BILLING)
    return written.total


def stage_quality(run: Run) -> int:
    s, p = run.store, run.params
    year = (dt.date(p.measurement_year, 1, 1), dt.date(p.measurement_year, 12, 31))
    batch = s.stage("quality_batch", marts.quality_batch(
        _touched(run, s.read("silver.hedis_eligibility", months=year)), s.read("silver.dim_encounter", months=year),
        s.read("silver.dim_patient"), p))
    written = s.merge(dq.QUALITY, batch, marts.QUALITY_KEYS, marts.quality_upsert)
    _idempotent(marts.quality_summary(s.read(dq.QUALITY), p), dq.QUALITY)
    run.spark.conf.set("carelake.dq.last_mart", dq.QUALITY)
    return written.total


def stage_gaps(run: Run) -> int:
    """The whole queue, in incremental mode too: the days since the last visit change every night."""
    s, p = run.store, run.params
    batch = s.stage("gap_batch", marts.gap_batch(
        s.read(dq.QUALITY), s.read("silver.dim_encounter"), s.read("silver.dim_patient"),
        s.read(reference.ENCOUNTER_TYPES), p))
    written = s.merge(dq.GAPS, batch, marts.GAP_KEYS, marts.gap_upsert)
    _idempotent(marts.gap_summary(s.read(dq.GAPS)), dq.GAPS)
    run.spark.conf.set("carelake.dq.last_mart", dq.GAPS)
    return written.total


TOUCHED = schemas._struct(("encounter_id", schemas.S))
#: The one row of ``staging.touched`` after a first delivery, which touches every encounter (silver holds no such id).
EVERY = None
TOUCHED_ROWS = {"silver.dim_encounter": "staging.touched_encounters", "silver.fact_charges": "staging.touched_charges"}

STAGE_FN = {
    "bronze_ingestion": stage_bronze,
    "silver_patient_encounter": stage_silver,
    "silver_hedis_eligibility": stage_eligibility,
    "gold_billing_mart": stage_billing,
    "billing_dq": lambda r: dq.validate(r.store, "billing", r.run_id, r.params)[dq.BILLING],
    "gold_quality_mart": stage_quality,
    "quality_dq": lambda r: dq.validate(r.store, "quality", r.run_id, r.params, r.cross_mart)[dq.QUALITY],
    "gold_care_gaps": stage_gaps,
    "care_gaps_dq": lambda r: dq.validate(r.store, "care_gaps", r.run_id, r.params)[dq.GAPS],
}


def _row_count(store: Store, table: str) -> int | None:
    """Rows of a failed stage's output, if it has any yet."""
    return store.read(table).count() if store.exists(table) else None


def run_pipeline(run: Run, resume_from: str | None = None, raise_on_failure: bool = True
                 ) -> DataFrame:
    """Run the stages in order; returns this run's stage log rows."""
    start_at = STAGES.index(resume_from) if resume_from else 0
    failure: Exception | None = None
    for stage in STAGES[start_at:]:
        began = _utcnow()
        if failure is not None:
            _log_stage(run, stage, None, None, "UPSTREAM_FAILED", None, "{}", began)
            continue
        status, detail = "SUCCESS", "{}"
        try:
            rows = STAGE_FN[stage](run)
            ended = _utcnow()
        except Exception as e:  # noqa: BLE001 - any failure ends the run, after it is logged
            status, failure, ended = "FAILED", e, _utcnow()
            detail = json.dumps({"error": str(e), "type": type(e).__name__})
            try:
                rows = _row_count(run.store, OUTPUT_TABLE[stage])
            except Exception:  # noqa: BLE001 - a metric must not hide the stage's own failure
                rows = None
        _log_stage(run, stage, began, ended, status, rows, detail, ended)
    log = run.store.read(LOG).filter(F.col("run_id") == run.run_id)
    if failure is not None and raise_on_failure:
        raise PipelineHalted(str(failure)) from failure
    return log


def _log_stage(run: Run, *record) -> None:
    """One log record as the stage ends, so that a later crash loses none."""
    row = runlog.stage_record(run.run_id, *record)
    run.store.append(LOG, run.spark.createDataFrame([row], schemas.ORCHESTRATION_LOG).coalesce(1))


def _utcnow() -> dt.datetime:
    """Naive UTC wall clock (the log's timestamp convention)."""
    return dt.datetime.now(dt.UTC).replace(tzinfo=None)

