"""Medallion tables in the session's catalog: ``layer.table`` names mapped to one database.

Storage, commits and file layout are Spark's own (``saveAsTable``, ``insertInto``, views, TBLPROPERTIES):

* a replaced table is a view: a new state is written as a table of its own, then the view is pointed to it.
  A crash in between leaves the old state current; earlier states beyond ``retain`` are dropped;
* a table with a month in ``PARTITIONS`` is merged in place: only the months that a batch touches (those of its rows,
  and those that hold rows with its keys) are read, merged and overwritten (dynamic partition overwrite). The
  merged months are written to a table first and copied from there; the target names that table in a property until the
  copy is done, so a job that died in the copy is completed by whoever opens the table next;
* logs (bronze, audit) are appended to.

One job writes a table at a time. The database lies in the folder given (below ``spark.checkpoint.dir``, which the
cluster shares).
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake import schemas
from carelake.session import shared_dir

#: Merged tables: the column whose month places a row.
PARTITIONS = {"silver.dim_encounter": "encounter_dttm", "silver.fact_charges": "charge_dttm",
              "silver.hedis_eligibility": "_encounter_dttm",
              "gold_billing.claims_processed": "encounter_dttm", "gold_quality.measures": "encounter_dttm"}
#: Columns that are stored beside the contract's and not read back.
HIDDEN = {"silver.hedis_eligibility": schemas._struct(("_encounter_dttm", schemas.TS)).fields}
MONTH = "_month"
NO_MONTH = dt.date(1900, 1, 1)
PENDING, GONE = "carelake.pending", "carelake.pending_months"

# Columns that the ingest adds to every bronze row.
INGEST_COLUMNS = schemas._struct(
    ("_ingestion_timestamp", schemas.TS), ("_source_file", schemas.S), ("_batch_id", schemas.S),
    ("_ingestion_date", schemas.D))


def month_of(column: str) -> Column:
    """First day of the month; rows without a time share one partition."""
    return F.coalesce(F.trunc(F.col(column), "MM"), F.lit(NO_MONTH)).alias(MONTH)


@dataclass
class Written:
    """What a write observed while it ran: rows written, and for a merge the months and the table's rows after it."""

    rows: int
    total: int
    months: list[dt.date] | None = None


class Store:
    def __init__(self, spark: SparkSession, root: str, retain: int | None = 3):
        """``root``: folder of the database. ``retain``: states of a replaced table that stay (at least 2; None: all)."""
        if retain is not None and retain < 2:
            raise ValueError("retain must be at least 2: a job may still read the previous state")
        self.spark, self.retain, self.root = spark, retain, root.rstrip("/")
        label = re.sub(r"\W+", "_", self.root.rsplit("/", 1)[-1]).lower()
        self.database = f"carelake_{label}_{hashlib.sha256(self.root.encode()).hexdigest()[:8]}"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database} LOCATION '{self.root}/tables'")
        # copies of merged months overwrite the partitions they hold; other writes of the session keep its own mode
        self._copier = spark.newSession()
        self._copier.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        # the files to copy hold one month each, a task reads few of them: their rows need no sort by month
        self._copier.conf.set("spark.sql.maxConcurrentOutputFileWriters", "16")
        self._opened: set[str] = set()

    @classmethod
    def shared(cls, spark: SparkSession, *parts: str, retain: int | None = 3) -> Store:
        return cls(spark, shared_dir(spark, *parts), retain)

    # ---- names ---------------------------------------------------------------
    def table(self, name: str) -> str:
        """The catalog name of ``layer.table``."""
        return f"{self.database}.{name.replace('.', '__')}"

    def exists(self, name: str) -> bool:
        if not self.spark.catalog.tableExists(self.table(name)):
            return False
        if name not in self._opened:
            self._opened.add(name)
            if PENDING in self._raw_properties(name):
                self._copy(name)
        return True

    def _states(self, name: str) -> list[str]:
        """Tables that hold the states of a replaced table, oldest first."""
        like = self.table(name).split(".")[1] + "__at_*"
        rows = self.spark.sql(f"SHOW TABLES IN {self.database} LIKE '{like}'").collect()
        return sorted(f"{self.database}.{r.tableName}" for r in rows)

    def _new_state(self, name: str) -> str:
        return f"{self.table(name)}__at_{dt.datetime.now(dt.UTC):%Y%m%d%H%M%S%f}_{uuid.uuid4().hex[:6]}"

    # ---- reading ----------------------------------------------------------------
    def read(self, name: str, schema: T.StructType | None = None, months: tuple | None = None) -> DataFrame:
        """The table's contract columns; an empty table with the contract if missing. ``months`` (first and last date,
        either may be None) prunes the partitions of a merged table; it must follow from the caller's own filter."""
        schema = schema or schemas.CONTRACTS.get(name)
        if schema is not None and name.startswith("bronze."):
            have = set(schema.fieldNames())
            schema = T.StructType(schema.fields + [f for f in INGEST_COLUMNS if f.name not in have])
        if not self.exists(name):
            if schema is None:
                raise KeyError(f"table {name} does not exist and has no contract")
            return schemas.empty(self.spark, schema)
        df = self.spark.table(self.table(name))
        if months and MONTH in df.columns:
            for day, keep in zip(months, (lambda m, d: m >= d, lambda m, d: m <= d), strict=True):
                if day is not None:
                    df = df.where(keep(F.col(MONTH), F.lit(dt.date(day.year, day.month, 1))))
        if schema is None:
            return df.drop(MONTH)
        have = {f.name: f.dataType.simpleString() for f in df.schema}
        return df.select(*[F.col(f.name) if have.get(f.name) == f.dataType.simpleString() else
                           (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                           for f in schema.fields])

    def register_views(self, names: list[str]) -> list[str]:
        """Expose tables to SQL as temp views ``<layer>_<table>``."""
        views = [n.replace(".", "_") for n in names]
        for n, view in zip(names, views, strict=True):
            self.read(n).createOrReplaceTempView(view)
        return views

    # ---- replaced tables -----------------------------------------------------------
    def replace(self, name: str, df: DataFrame, cluster_by: list[str] | None = None) -> Written:
        """Write ``df`` as a new state and point the view to it.

        ``cluster_by`` sorts rows within each task before writing (no
        shuffle): row groups then cover narrow ranges of those columns, so
        range filters on them skip row groups via Parquet min/max statistics.
        """
        state = self._new_state(name)
        seen = Observation()
        df = df.sortWithinPartitions(*cluster_by) if cluster_by else df
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.saveAsTable(state)
        self._point(name, state)
        return Written(seen.get["rows"], seen.get["rows"])

    def _point(self, name: str, state: str) -> None:
        """Make ``state`` the current one; properties stay with the name."""
        verb = "ALTER VIEW" if self.spark.catalog.tableExists(self.table(name)) else "CREATE VIEW"
        self.spark.sql(f"{verb} {self.table(name)} AS SELECT * FROM {state}")
        if self.retain is not None:
            for old in self._states(name)[:-self.retain]:
                self.spark.sql(f"DROP TABLE IF EXISTS {old}")

    def replace_checked(self, name: str, df: DataFrame, cluster_by: list[str] | None = None) -> Written:
        """``replace`` under the table's contract: its columns and types; a NULL in a NOT NULL
        column fails the write, and the state before stays current."""
        return self.replace(name, schemas.conform(df, schemas.CONTRACTS[name], name), cluster_by)

    # ---- merged tables --------------------------------------------------------------
    def stage(self, name: str, df: DataFrame) -> DataFrame:
        """Write a batch once and read it back: its lineage is cut, and its size is known to whoever joins it."""
        self.replace(f"staging.{name}", df)
        return self.read(f"staging.{name}", df.schema)

    def merge(self, name: str, batch: DataFrame, keys: list[str], fn: Callable[[DataFrame, DataFrame], DataFrame]) -> Written:
        """Replace the months that ``batch`` touches by ``fn(their rows, batch)``, under the table's contract. Of a table
        without months, the whole is replaced. ``batch`` is read several times: pass a staged one."""
        contract = T.StructType(schemas.CONTRACTS[name].fields + HIDDEN.get(name, []))
        if name not in PARTITIONS:
            return self.replace_checked(name, fn(self.read(name), batch))
        month = month_of(PARTITIONS[name])
        if not self.exists(name):
            new = schemas.conform(fn(schemas.empty(self.spark, contract), batch), contract, name)
            rows = self._write_months(new, month, self.table(name))
            return Written(rows, rows)
        held = self.spark.table(self.table(name))
        sizes, touched = self._touched(held, batch, keys, month)
        if not touched:
            return Written(0, sum(sizes.values()), [])
        old = held.where(F.col(MONTH).isin(touched)).drop(MONTH)
        new = schemas.conform(fn(old, batch), contract, name)
        copy = f"{self._new_state('merge.' + name)}"
        rows = self._write_months(new, month, copy)
        self.set_properties(name, {PENDING: copy, GONE: ",".join(map(str, touched))})
        self._copy(name)
        return Written(rows, sum(sizes.values()) - sum(sizes.get(m, 0) for m in touched) + rows, touched)

    @staticmethod
    def _touched(held: DataFrame, batch: DataFrame, keys: list[str], month: Column) -> tuple[dict, list]:
        """(rows of each month, months that the batch touches): its rows' own, and those that hold its keys now."""
        wanted = batch.select(*keys).distinct().withColumn("_in", F.lit(True))
        rows = (held.select(*keys, MONTH).join(wanted, keys, "left").groupBy(MONTH)
                .agg(F.count(F.lit(1)).alias("n"), F.count("_in").alias("hit")).collect())
        own = {r[0] for r in batch.select(month).distinct().collect()}
        return {r[MONTH]: r.n for r in rows}, sorted(own | {r[MONTH] for r in rows if r.hit})

    def _write_months(self, df: DataFrame, month: Column, table: str) -> int:
        """Write ``df`` partitioned by month; large months are split among tasks, small ones share a task."""
        seen = Observation()
        (df.select("*", month).hint("rebalance", MONTH).observe(seen, F.count(F.lit(1)).alias("rows"))
         .write.partitionBy(MONTH).saveAsTable(table))
        return seen.get["rows"]

    def _copy(self, name: str) -> None:
        """Overwrite the months that the pending table holds and drop those it left empty. May be repeated."""
        table, props = self.table(name), self._raw_properties(name)
        copy, months = props[PENDING], props[GONE].split(",")
        source = self._copier.table(copy)
        source.select(*self.spark.table(table).columns).write.mode("overwrite").insertInto(table)
        kept = {str(r[0]) for r in source.select(MONTH).distinct().collect()}
        for gone in sorted(set(months) - kept):
            self.spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({MONTH} = DATE'{gone}')")
        self.spark.catalog.refreshTable(table)
        self.spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ('{PENDING}', '{GONE}')")
        self.spark.sql(f"DROP TABLE IF EXISTS {copy}")

    # ---- properties -------------------------------------------------------------------
    def set_properties(self, name: str, props: dict[str, str]) -> None:
        """Table properties (quality, source, description, ...), merged with existing ones."""
        quoted = lambda x: "'" + str(x).replace("\\", "\\\\").replace("'", "\\'") + "'"
        kind = "VIEW" if self.spark.catalog.getTable(self.table(name)).tableType == "VIEW" else "TABLE"
        pairs = ", ".join(f"{quoted(k)} = {quoted(v)}" for k, v in props.items())
        self.spark.sql(f"ALTER {kind} {self.table(name)} SET TBLPROPERTIES ({pairs})")

    def drop_property(self, name: str, key: str) -> None:
        self.spark.sql(f"ALTER TABLE {self.table(name)} UNSET TBLPROPERTIES IF EXISTS ('{key}')")

    def properties(self, name: str) -> dict[str, str]:
        return self._raw_properties(name) if self.exists(name) else {}

    def _raw_properties(self, name: str) -> dict[str, str]:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.table(name)}").collect()
        return {r.key: r.value for r in rows if not r.key.startswith("view.")}

    # ---- logs ------------------------------------------------------------------------
    def append(self, name: str, df: DataFrame) -> None:
        df.write.mode("append").saveAsTable(self.table(name))
        self._opened.add(name)
