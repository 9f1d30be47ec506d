"""Helpers shared by the operators: table access, shared-folder tables, skew-proof joins."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.session import ensure_checkpoint_dir

#: White space of the word and line contracts: space and the controls 9 to 13.
WHITE = r"[\x20\x09-\x0D]"
WHITE_CHARS = " \t\n\x0b\f\r"

#: A key with more than this share of all rows is hot; fewer than 1000 keys can be.
HOT_PARTS = 1000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, label: str) -> str:
    """A new folder name under the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts the lineage: a lost executor costs only the tasks it was running,
    and the part files survive it because the folder is shared.
    """
    spark = df.sparkSession
    path = shared_path(spark, label)
    (df.write.partitionBy(partition_by) if partition_by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` computed once per row, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def split_words(text: Column) -> Column:
    """Words of a text: maximal runs of characters that are not white space."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITE + "+"), "")


def left_join_counted(left: DataFrame, right: DataFrame, keys: list[str], n: str,
                      total: int, parts: int = HOT_PARTS) -> DataFrame:
    """Left join to a table with one row per key, safe for hot keys.

    ``right[n]`` is the number of left rows of the key (at least), ``total`` the sum
    of these numbers. Keys with ``n * parts > total`` are fewer than ``parts``, which
    bounds their broadcast; their rows are answered without a shuffle. The others
    meet in a shuffled join where no key holds more than one part. Rows answered by
    the broadcast are spread by a hash of their own in that join.
    """
    cols = [c for c in right.columns if c not in keys and c != n]
    out = [c for c in left.columns if c not in keys]
    cold = right.where(F.col(n) * parts <= total).select(
        F.xxhash64(*keys).alias("__rk"), *[F.col(k).alias(f"__r_{k}") for k in keys],
        *[F.col(c).alias(f"__c_{c}") for c in cols])
    hot = right.where(F.col(n) * parts > total).select(
        *[F.col(k).alias(f"__h_{k}") for k in keys], *[F.col(c).alias(f"__h_c_{c}") for c in cols],
        F.lit(True).alias("__hot"))
    j = left.join(F.broadcast(hot), [F.col(k) == F.col(f"__h_{k}") for k in keys], "left")
    spread = F.when(F.col("__hot"), F.xxhash64(*(out or keys))).otherwise(F.xxhash64(*keys))
    # a hash join of the cold keys: the wide left rows need no sort
    j = j.withColumn("__lk", spread).join(
        cold.hint("shuffle_hash"),
        [F.col("__lk") == F.col("__rk"), *[F.col(k) == F.col(f"__r_{k}") for k in keys]], "left")
    return j.select(*keys, *out, *[F.coalesce(f"__h_c_{c}", f"__c_{c}").alias(c) for c in cols])


def inner_join_counted(left: DataFrame, right: DataFrame, keys: list[str], n: str, total: int,
                       wanted: Column | None = None, parts: int = HOT_PARTS) -> DataFrame:
    """Inner join to the ``wanted`` rows of a table with one row per key, safe for hot keys.

    ``right[n]`` and ``total`` are as in ``left_join_counted``; ``right`` should hold the unwanted hot keys as well, whose
    rows then go nowhere. The hashes of the hot keys, fewer than ``parts``, are read first and part the rows by a filter:
    rows of hot keys are answered by a broadcast and not shuffled, so each join makes rows that match only. A cold key
    with the hash of a hot one is answered with the hot ones. ``right`` is computed once more for the hashes, ``left``
    is read twice if there are any.
    """
    wanted = F.lit(True) if wanted is None else wanted
    digest = F.xxhash64(*keys)
    hot = [r[0] for r in right.where(F.col(n) * parts > total).select(digest).distinct().collect()]
    right = right.withColumn("__wanted", wanted).drop(n)
    side = lambda which: right.where(which & F.col("__wanted")).drop("__wanted")
    if not hot:
        return left.join(side(F.lit(True)).hint("shuffle_hash"), keys)
    is_hot = digest.isin(hot)
    near = left.where(is_hot).join(F.broadcast(side(is_hot)), keys)
    far = left.where(~is_hot).join(side(~is_hot).hint("shuffle_hash"), keys)
    return near.unionByName(far)
