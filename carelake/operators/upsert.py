"""Keyed upserts and SCD Type 2 as pure DataFrame functions.

Each returns the *new* state ``f(target, source) -> DataFrame`` of the rows it is given; the store persists it.
Semantics follow SQL MERGE: NULL keys never match (such source rows are always inserted), target-only rows stay, and at
most one source row may match a target row. A table's own keys are unique; a target that repeats one is an error.

All of them stand on ``merged_pairs``: both inputs are tagged, united and grouped by the keys, so a merge reads each
input once and exchanges it once, and the duplicate guard is a count of the same groups. If the plan of the target
proves it empty (a first load), only the source's keys are exchanged, for the guard.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.functions import changed_any, lit_date, lit_ts
from carelake.operators.dedupe import latest_per_key
from carelake.operators.lookup import proven_empty


def _any_null(keys: list[str]) -> Column:
    out = F.col(keys[0]).isNull()
    for k in keys[1:]:
        out = out | F.col(k).isNull()
    return out


def merged_pairs(target: DataFrame, source: DataFrame, keys: list[str], on_duplicate: str = "error",
                 order: list[Column] | None = None, first_load: bool = True) -> DataFrame:
    """Columns ``t`` and ``s``: the target's and the source's row of each key as structs, either may be null.

    ``on_duplicate``: ``error`` fails the task that meets a key twice in the source; ``latest`` keeps its first
    row under ``order``. Rows with a NULL key stand alone; a number of their own spreads them over the
    partitions, so they don't gather where NULL hashes to. ``first_load``: a target proven empty is not merged with,
    which reads the source a second time for its keys.
    """
    if on_duplicate == "latest":
        if not order:
            raise ValueError("on_duplicate='latest' needs an order")
        source = latest_per_key(source.withColumn("_alone", _alone(keys)), [*keys, "_alone"], order).drop("_alone")
    elif on_duplicate != "error":
        raise ValueError(f"unknown on_duplicate mode: {on_duplicate}")
    if first_load and proven_empty(target):
        return _first_load(target, source, keys, unique=on_duplicate == "latest")
    names = [f"_k{i}" for i in range(len(keys))]
    # the key columns of both sides share a type; rows keep their own
    types = [target.schema[k].dataType for k in keys]

    def side(df: DataFrame, tag: str, other: str, other_type) -> DataFrame:
        return df.select(*[F.col(k).cast(t).alias(n) for k, n, t in zip(keys, names, types)], _alone(keys, int(tag == "s")).alias("_alone"),
                         F.struct(*[F.col(c) for c in df.columns]).alias(tag), F.lit(None).cast(other_type).alias(other))

    both = side(target, "t", "s", source.schema).unionByName(side(source, "s", "t", target.schema))
    grouped = both.repartition(*names, "_alone").groupBy(*names, "_alone").agg(
        F.count("t").alias("_nt"), F.count("s").alias("_ns"), F.first("t", ignorenulls=True).alias("t"),
        F.first("s", ignorenulls=True).alias("s"))
    return grouped.where(F.when(F.col("_ns") > 1, _twice("source", names)).when(F.col("_nt") > 1, _twice("target", names))
                         .otherwise(True)).select("t", "s")


def _twice(what: str, keys: list[str]) -> Column:
    key = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return F.raise_error(F.concat(F.lit(f"upsert {what} has duplicate key: "), key)).cast("boolean")


def _first_load(target: DataFrame, source: DataFrame, keys: list[str], unique: bool) -> DataFrame:
    """``merged_pairs`` with an empty target: rows are not exchanged. The guard counts the keys alone, beside them; it
    gives no row, or fails."""
    no_target = F.lit(None).cast(target.schema).alias("t")
    pairs = source.select(no_target, F.struct(*[F.col(c) for c in source.columns]).alias("s"))
    if unique:
        return pairs
    names = [f"_k{i}" for i in range(len(keys))]
    counted = (source.where(~_any_null(keys))
               .select(*[F.col(k).cast(target.schema[k].dataType).alias(n) for k, n in zip(keys, names)])
               .groupBy(*names).agg(F.count(F.lit(1)).alias("_n")))
    guard = counted.where(F.when(F.col("_n") > 1, _twice("source", names)).otherwise(False)).select(
        no_target, F.lit(None).cast(pairs.schema["s"].dataType).alias("s"))
    return pairs.unionByName(guard)


def _alone(keys: list[str], side: int = 0) -> Column:
    """A number of its own for a row with a NULL key, never the same on both sides; else null."""
    return F.when(_any_null(keys), 2 * F.monotonically_increasing_id() + side)


def upsert_all(target: DataFrame, source: DataFrame, keys: list[str],
               on_duplicate: str = "error", order: list[Column] | None = None) -> DataFrame:
    """MERGE ... WHEN MATCHED UPDATE SET * WHEN NOT MATCHED INSERT *: matched rows are replaced
    wholesale (including their load time)."""
    cols = target.columns
    pairs = merged_pairs(target, source.select(*cols), keys, on_duplicate, order)
    return pairs.select(*_typed(target, {c: F.when(F.col("s").isNotNull(), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))
                                         for c in cols}))


def _typed(target: DataFrame, values: dict[str, Column]) -> list[Column]:
    return [values[f.name].cast(f.dataType).alias(f.name) for f in target.schema.fields]


def merge_latest(target: DataFrame, batch: DataFrame, keys: list[str], order: list[Column]
                 ) -> DataFrame:
    """Incremental form of "latest row per key over all deliveries": stored and new rows compete
    under ``order`` (latest-of-latest equals latest over everything, so the result equals a full
    recompute). One scan of each input, one exchange."""
    return latest_per_key(target.unionByName(batch.select(*target.columns)), keys, order)


def upsert_columns(target: DataFrame, source: DataFrame, keys: list[str],
                   update_cols: list[str], on_duplicate: str = "error",
                   order: list[Column] | None = None) -> DataFrame:
    """MERGE with an explicit column map.

    Matched: ``update_cols`` take the source value, every other column
    (keys, first load time) keeps the target value. Not matched: the source
    row is inserted whole.
    """
    cols = target.columns
    pairs = merged_pairs(target, source.select(*cols), keys, on_duplicate, order)
    t_in, s_in = F.col("t").isNotNull(), F.col("s").isNotNull()
    return pairs.select(*_typed(target, {
        c: F.when(s_in, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")) if c in update_cols
        else F.when(t_in, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")) for c in cols}))


def scd2_apply(target: DataFrame, staged: DataFrame, key: str, attrs: list[str],
               as_of_date: dt.date, load_ts: dt.datetime,
               null_safe: tuple[str, ...] = ("birth_date",),
               on_duplicate: str = "error") -> DataFrame:
    """SCD Type 2 in one merge of the current versions with the delivery.

    * current row whose attributes changed -> ``expiration_date = as_of``,
      ``is_current = false`` (same-day stamps allowed);
    * new key, or changed attributes -> new current version stamped
      ``effective_date = as_of``, ``expiration_date = NULL``, ``load_dttm``;
    * unchanged -> nothing, so re-applying the same batch is a no-op.

    History rows (``is_current = false``) are never exchanged.
    """
    cols = target.columns
    history = target.filter(~F.col("is_current"))
    pairs = merged_pairs(target.filter(F.col("is_current")), staged, [key], on_duplicate, first_load=False)
    t_in, s_in = F.col("t").isNotNull(), F.col("s").isNotNull()
    changed = t_in & s_in & changed_any("t", "s", attrs, null_safe)

    fresh = {
        "effective_date": lit_date(as_of_date),
        "expiration_date": F.lit(None).cast("date"),
        "is_current": F.lit(True),
        "load_dttm": lit_ts(load_ts),
    }
    ended = {"expiration_date": F.when(changed, lit_date(as_of_date)).otherwise(F.col("t.expiration_date")),
             "is_current": F.when(changed, F.lit(False)).otherwise(F.col("t.is_current"))}
    old = F.struct(*_typed(target, {c: ended.get(c, F.col(f"t.{c}")) for c in cols}))
    new = F.struct(*_typed(target, {c: fresh[c] if c in fresh else F.col(f"s.{c}") for c in cols}))
    # each pair gives the version it keeps or ends, the one it starts, or both
    versions = F.array_compact(F.array(F.when(t_in, old), F.when(s_in & (~t_in | changed), new)))
    applied = pairs.select(F.explode(versions).alias("_v")).select(*[F.col(f"_v.{c}").alias(c) for c in cols])
    return history.unionByName(applied)


def idempotency_summary(df: DataFrame, keys: list[str], extra: dict[str, Column] | None = None
                        ) -> DataFrame:
    """One-row ``row_count`` / ``distinct_keys`` / ``status`` verdict.

    ``COUNT(DISTINCT a, b)`` ignores tuples with a NULL part; the verdict is
    FAIL when rows > 0 and rows != distinct keys.
    """
    aggs = [F.count(F.lit(1)).alias("row_count"),
            F.count_distinct(*[F.col(k) for k in keys]).alias("distinct_keys")]
    for name, c in (extra or {}).items():
        aggs.append(c.alias(name))
    out = df.agg(*aggs)
    return out.withColumn("status", F.when(
        (F.col("row_count") > 0) & (F.col("row_count") != F.col("distinct_keys")), "FAIL")
        .otherwise("PASS"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once (``GROUP BY keys HAVING count > 1``)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("dup_count"))
            .filter(F.col("dup_count") > 1))
