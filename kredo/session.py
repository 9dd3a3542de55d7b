"""Session helpers: sensible defaults, and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the library relies on.  They are applied only where the cluster
# has not set them already (a cluster's own values always win).
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def get_session(master: str | None = None, partitions: int = 8, app: str = "kredo") -> SparkSession:
    """Local/test session.  On a cluster use the session the platform gives you."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.sql.shuffle.partitions", str(partitions))
          .config("spark.driver.memory", os.environ.get("KREDO_DRIVER_MEMORY", "4g")))
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting is always used, else a folder set with ``setCheckpointDir``.  Only a session
    that runs in one process (``local[...]``, as in tests) may go without: a folder is chosen, once
    per session (remembered in the session conf, so every later call returns the same folder).  On
    any other master a missing folder is an error: executors could not share a local one.
    """
    d = (spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("kredo.checkpoint.base", None)
         or spark.sparkContext.getCheckpointDir())
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="kredo-ckpt-")
        spark.conf.set("kredo.checkpoint.base", d)
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (for written intermediate tables)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *parts])


def cluster_settings(input_bytes: int, executor_cores_total: int,
                     target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Suggested settings for a cluster run over ``input_bytes`` of filings.

    * The heaviest shuffle carries one narrow row per filing (sums, not
      rubrics), roughly 1/3 of the input; start with enough partitions for
      ~256 MB each and let AQE coalesce small ones.
    * Scan splits of 512 MB keep tasks few but well under executor memory:
      the rubric arrays shrink ~100x in the map-side aggregate.
    * Broadcasts stay under Spark's size check; nothing that grows with the
      data is forced to broadcast.
    """
    shuffle_bytes = max(input_bytes // 3, 1)
    partitions = max(executor_cores_total * 2, -(-shuffle_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(512 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.sources.bucketing.enabled": "true",
    }
