"""Session construction and the shared working folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins and coalesces shuffle
# partitions at runtime; skew-join splits oversized join partitions (one
# warehouse, item or customer may hold a third of all rows).
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}


def get_session(
    master: str | None = None,
    app_name: str = "stockledger",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the mart's defaults.

    On a cluster leave ``master`` unset and size ``shuffle_partitions`` to the
    data (about 128-256 MB of shuffle per partition); AQE coalesces from there.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if master and master.startswith("local"):
        # One machine: list partition folders on the driver instead of
        # launching a listing job per read (the cluster default stays).
        conf["spark.sql.sources.parallelPartitionDiscovery.threshold"] = "100000"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _checkpoint_dir(spark: SparkSession) -> str | None:
    try:
        d = spark.sparkContext.getCheckpointDir()
    except Exception:  # pragma: no cover - Spark Connect has no SparkContext
        d = None
    if d:
        return d
    try:
        return spark.conf.get("spark.checkpoint.dir", None) or None
    except Exception:  # pragma: no cover
        return None


def shared_dir(spark: SparkSession, purpose: str = "work") -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    The cluster names its shared folder in ``spark.checkpoint.dir``; that is
    where intermediate tables go so that any executor can read them and they
    survive executor loss. Only on a local master without the setting (tests)
    is a private temporary folder created and registered as the checkpoint
    dir; on a cluster the missing setting is an error, as executors could not
    read each other's local folders.
    Each call returns a new sub-folder, so runs never clean up after each other.
    """
    base = _checkpoint_dir(spark)
    if not base:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on master {master}")
        base = tempfile.mkdtemp(prefix="stockledger-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
        base = _checkpoint_dir(spark) or base
    return os.path.join(base, "stockledger", f"{purpose}-{uuid.uuid4().hex[:12]}")
