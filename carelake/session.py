"""SparkSession helpers shared by tests, bench and the driver entry point."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every carelake job relies on. AQE re-plans joins and coalesces
# shuffle partitions at runtime; skew-join splitting covers hot keys in the
# sort-merge joins (one patient or encounter holding a large share of rows).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "carelake", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with carelake's defaults.

    On a cluster ``master`` stays None so spark-submit decides; locally the
    tests pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared filesystem folder and is used as
    is. Only when it is unset (local tests) is a fresh scratch folder created.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it must name a folder that "
                               "the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="carelake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A sub-folder of the shared checkpoint folder (for snapshots/stream state)."""
    return os.path.join(ensure_checkpoint_dir(spark), *parts)
