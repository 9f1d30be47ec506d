"""Incremental Parquet ingestion (bronze), run to completion per call.

``readStream`` with an explicit schema (no inference) -> metadata columns ->
append-only Parquet sink partitioned by ingestion date, ``availableNow``
trigger. The checkpoint (one per entity) records which files were read, so
a re-run ingests only new files (exactly once per file).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass
class IngestSpec:
    entity: str                 # landing folder / bronze table name
    schema: T.StructType        # explicit source schema
    landing_path: str           # landing folder
    transform: Callable[[DataFrame], DataFrame] | None = None  # row-wise only
    file_glob: str | None = None  # only files whose name matches (pathGlobFilter)
    # Bounded micro-batches: a large backlog is drained in several commits
    # instead of one giant batch (availableNow still reads every file).
    max_files_per_trigger: int | None = 1000


def with_ingest_metadata(df: DataFrame, batch_id: str) -> DataFrame:
    """``_ingestion_timestamp`` (fixed per micro-batch), ``_source_file``
    (hidden ``_metadata.file_path``), ``_batch_id``, ``_ingestion_date``."""
    return (df.withColumn("_ingestion_timestamp", F.current_timestamp().cast("timestamp_ntz"))
            .withColumn("_source_file", F.col("_metadata.file_path"))
            .withColumn("_batch_id", F.lit(batch_id))
            .withColumn("_ingestion_date", F.to_date("_ingestion_timestamp")))


def _micros(at) -> Column:
    return F.unix_micros(at.cast("timestamp"))


def _seen() -> list[Column]:
    """Rows, and the first and last ingestion time in microseconds (progress reports cut times to seconds)."""
    at = _micros(F.col("_ingestion_timestamp"))
    return [F.count(F.lit(1)).alias("rows"), F.min(at).alias("first"), F.max(at).alias("last")]


@contextmanager
def open_writers(spark: SparkSession, n: int = 8) -> Iterator[None]:
    """Up to ``n`` files per task stay open: a micro-batch has one ingestion date, so its rows need no sort by it
    before they are written (Spark sorts the rest of a task that meets more dates)."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    old = spark.conf.get(key)
    if int(old) > 0:
        yield
        return
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, old)


def start(spark: SparkSession, spec: IngestSpec, target: str, checkpoint_path: str,
          batch_id: str):
    """Start the available-now streaming query of one entity into the catalog table ``target`` (non-blocking).
    Rows and the first and last ingestion time are observed as they stream."""
    reader = spark.readStream.schema(spec.schema)
    if spec.file_glob:
        reader = reader.option("pathGlobFilter", spec.file_glob)
    if spec.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", spec.max_files_per_trigger)
    stream = reader.parquet(spec.landing_path)
    stream = with_ingest_metadata(stream, batch_id)
    if spec.transform is not None:
        stream = spec.transform(stream)
    return (stream.observe("ingest", *_seen())
            .writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint_path)
            .partitionBy("_ingestion_date")
            .trigger(availableNow=True)
            .toTable(target))


def _summary(spark: SparkSession, q, spec: IngestSpec, target: str, batch_id: str) -> dict:
    """What the query's micro-batches observed. Spark keeps the progress of the last micro-batches only
    (``spark.sql.streaming.numRecentProgressUpdates``); if there were more, the target is asked."""
    q.awaitTermination()
    spark.catalog.refreshTable(target)
    seen = [p for p in q.recentProgress if p.numInputRows]
    got = [p.observedMetrics["ingest"] for p in seen if "ingest" in p.observedMetrics]
    keeps = int(spark.conf.get("spark.sql.streaming.numRecentProgressUpdates"))
    if len(q.recentProgress) >= keeps - 1 or len(got) < len(seen):
        got = spark.table(target).where(F.col("_batch_id") == batch_id).agg(*_seen()).collect()
    return {"entity": spec.entity, "target": target, "batch_id": batch_id, "landing_path": spec.landing_path,
            "rows_added": sum(g["rows"] for g in got),
            "first_micros": min((g["first"] for g in got if g["first"]), default=None),
            "last_micros": max((g["last"] for g in got if g["last"]), default=None)}


def ingest(spark: SparkSession, spec: IngestSpec, target: str, checkpoint_path: str,
           batch_id: str | None = None) -> dict:
    """Ingest unseen landing files of one entity into a table; blocks until done."""
    batch_id = batch_id or str(uuid.uuid4())
    with open_writers(spark):
        q = start(spark, spec, target, checkpoint_path, batch_id)
        return _summary(spark, q, spec, target, batch_id)


def ingest_all(spark: SparkSession, specs: list[IngestSpec], target_of: Callable[[str], str],
               checkpoint_of: Callable[[str], str], batch_id: str | None = None,
               concurrent: bool = True) -> list[dict]:
    """One independent streaming query per entity, each with its own
    checkpoint. With ``concurrent`` all queries run side by side (small
    entities do not wait behind the largest) and are awaited together; a
    failure of any query is raised after all have stopped."""
    batch_id = batch_id or str(uuid.uuid4())
    if not concurrent:
        return [ingest(spark, s, target_of(s.entity), checkpoint_of(s.entity), batch_id)
                for s in specs]
    with open_writers(spark):
        running = [(s, start(spark, s, target_of(s.entity), checkpoint_of(s.entity), batch_id))
                   for s in specs]
        out, error = [], None
        for s, q in running:
            try:
                out.append(_summary(spark, q, s, target_of(s.entity), batch_id))
            except Exception as e:  # noqa: BLE001 - let the others finish first
                error = error or e
    if error is not None:
        raise error
    return out


METADATA = ("_ingestion_timestamp", "_source_file", "_batch_id", "_ingestion_date")


def ingest_profile(tables: dict[str, DataFrame], observed: list[dict] | None = None) -> DataFrame:
    """Per bronze table: rows, distinct batches, rows with all four metadata columns, first/last ingestion time
    (one aggregate per table, unioned). With ``observed`` (the summaries of ``ingest_all``, of a first ingest):
    whether rows and times are those that the streams saw."""
    seen = {f"bronze.{o['entity']}": o for o in observed or []}
    out = None
    for name, df in tables.items():
        complete = F.lit(True)
        for c in METADATA:
            complete = complete & F.col(c).isNotNull()
        r = df.agg(F.count(F.lit(1)).alias("total_rows"),
                   F.count_distinct("_batch_id").alias("distinct_batches"),
                   F.count_if(complete).alias("rows_with_metadata"),
                   F.min("_ingestion_timestamp").alias("earliest_ingestion"),
                   F.max("_ingestion_timestamp").alias("latest_ingestion")
                   ).select(F.lit(name).alias("table_name"), "*")
        if observed is not None:
            o = seen[name]
            same = lambda c, us: _micros(F.col(c)).eqNullSafe(F.lit(us).cast("bigint"))
            r = r.withColumn("observed_agrees", (F.col("total_rows") == F.lit(o["rows_added"]))
                             & same("earliest_ingestion", o["first_micros"]) & same("latest_ingestion", o["last_micros"]))
        out = r if out is None else out.unionByName(r)
    return out
