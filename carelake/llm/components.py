"""Connected components of links too many for one machine: alternating star contraction.

Each round every node points to the smallest node it sees (large star, then small star)
until all links lead straight to the smallest node of their component. Sums and minima are
taken by partial aggregation, and a node with a large share of all links is looked up by a
broadcast of fewer than 1000 nodes, so hubs don't gather in one task. Each round is written to the
shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import inner_join_counted, left_join_counted, materialize


def _signature(links: DataFrame) -> tuple:
    r = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b) but the roots themselves.

    Links of a node with itself and repeated links are ignored; no links give no rows.
    """
    cur = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                      .distinct(), "links")
    before = _signature(cur)
    while before[0]:
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        small = both.groupBy("u").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("m")).select(
            "u", "n", F.least("u", "m").alias("m"))
        large = (left_join_counted(both, small, ["u"], "n", 2 * before[0]).where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = materialize(large, "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        nxt = inner_join_counted(large, least, ["u"], "n", large.count()).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        cur = materialize(nxt.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        after = _signature(cur)
        if after == before:
            break
        before = after
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
