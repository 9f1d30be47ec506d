"""Lookup (dimension) joins with a checked broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Lookup tables (encounter types, code sets, measure catalogue) hold a few hundred rows by
# nature; one whose plan may hold more than this is joined by shuffle.
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def plan_bytes(df: DataFrame) -> int:
    """Upper estimate of the size from the plan's statistics (file sizes included); runs no job."""
    plan = df._jdf.queryExecution().optimizedPlan()
    return int(str(plan.stats().sizeInBytes()))


def proven_empty(df: DataFrame) -> bool:
    """Whether the plan itself bounds the rows by 0 (a literal empty table); runs no job."""
    most = df._jdf.queryExecution().optimizedPlan().maxRows()
    return most.isDefined() and int(str(most.get())) == 0


def bounded_broadcast(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast only while its plan proves it small.

    The check is made for every plan that is built, so a lookup that has grown since is
    checked again. A larger one is returned without a hint: the planner keeps a
    shuffle join (AQE may still broadcast from runtime statistics).
    """
    return F.broadcast(df) if plan_bytes(df) <= max_bytes else df
