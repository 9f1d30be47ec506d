"""Latest-row-per-key and duplicate drops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column],
                   rank_col: str = "_rn") -> DataFrame:
    """Keep the first row per key under ``order`` (``row_number() = 1``).

    Spark plans this as a partial ``WindowGroupLimit`` before the shuffle, so
    each map task forwards at most one row per key: a hot key cannot flood a
    single reducer. Callers should make ``order`` a total order within the key
    for deterministic output.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn(rank_col, F.row_number().over(w))
            .filter(F.col(rank_col) == 1).drop(rank_col))
