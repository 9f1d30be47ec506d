"""Inner joins to counted keys: hot keys part from the others without a join of all rows."""

import pytest
from pyspark.sql import functions as F

from carelake.llm import near_dedup
from carelake.llm.common import inner_join_counted
from tests.llm.test_operators import exact_components, near_rows, table

LEFT = [(1, i) for i in range(40)] + [(2, i) for i in range(9)] + [(3, 7), (3, 7), (None, 5), (4, 1), (5, 2)]
RIGHT = [(1, 40, "a", True), (2, 9, "b", False), (3, 2, "c", True), (4, 1, "d", False), (6, 1, "e", True), (None, 1, "n", True)]


@pytest.mark.parametrize("parts", [1, 2, 10, 1000])
@pytest.mark.parametrize("some", [True, False])
def test_counted_inner_join_is_the_plain_one(spark, parts, some):
    left = spark.createDataFrame(LEFT, "k bigint, v bigint").repartition(3)
    right = spark.createDataFrame(RIGHT, "k bigint, n bigint, c string, w boolean")
    total = sum(r[1] for r in RIGHT)
    got = inner_join_counted(left, right, ["k"], "n", total, F.col("w") if some else None, parts)
    want = [(k, v, c, w) for k, v in LEFT for x, _, c, w in RIGHT if k is not None and k == x and (w or not some)]
    assert got.columns == ["k", "v", "c", "w"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    assert inner_join_counted(left, right.limit(0), ["k"], "n", 0, None, parts).count() == 0


def test_unanswered_rows_leave_no_join(spark):
    """No join passes on the rows without a match: each is an inner one, hot keys or not."""
    left = spark.range(5000).select((F.col("id") % 1000).alias("k"), F.col("id").alias("v")).unionByName(
        spark.range(3000).select(F.lit(7).cast("bigint").alias("k"), F.col("id").alias("v")))
    right = spark.createDataFrame([(7, 3005, "a"), (8, 5, "b")], "k bigint, n bigint, c string")
    got = inner_join_counted(left, right, ["k"], "n", 3010, None, 2)
    assert got.count() == 3010
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan and "LeftAnti" not in plan and "LeftOuter" not in plan


@pytest.mark.parametrize("parts", [1, 1000])
def test_near_duplicates_are_the_same_with_and_without_hot_buckets(spark, monkeypatch, parts):
    rows, asked = near_rows(), []

    def join(left, right, keys, n, total, wanted=None):
        asked.append(right.where(F.col(n) * parts > total).count())
        return inner_join_counted(left, right, keys, n, total, wanted, parts)

    monkeypatch.setattr(near_dedup, "inner_join_counted", join)
    want = exact_components(rows, near_dedup.STAGE)
    got = near_dedup.near_duplicates(table(spark, rows), near_dedup.STAGE).collect()
    assert {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None} == want
    assert any(asked) == (parts == 1000)
