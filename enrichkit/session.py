"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. Shuffle partitions are sized by the caller:
# on a cluster keep the default AQE-coalesced value high (e.g. 4000 for
# 100 TB) and let AQE merge small partitions at run time.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Broadcast only what adaptive execution has measured as small: the static
    # planner's guess from file sizes is off.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "enrichkit", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    The cluster's ``spark.checkpoint.dir`` wins. Only a local master without
    it (tests) gets a folder of our own; on a cluster a machine-local folder
    would be another one on every node, so there it is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or _session_conf(spark)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the whole cluster shares")
        configured = os.path.join("/tmp", "enrichkit-checkpoints")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def _session_conf(spark: SparkSession) -> str | None:
    try:
        return spark.conf.get("spark.checkpoint.dir", None)
    except Exception:
        return None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root, for written tables and
    stream checkpoints. Every call gets a new folder; nothing is cleared."""
    root = _session_conf(spark) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None) \
        or ensure_checkpoint_dir(spark)
    return f"{root.rstrip('/')}/enrichkit/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df):
    """Reliable checkpoint into the shared checkpoint folder (survives lost
    executors, unlike a local checkpoint). The frame is persisted first so
    the checkpoint write does not compute it a second time; the cache is
    released once the checkpoint files exist."""
    from pyspark import StorageLevel
    ensure_checkpoint_dir(df.sparkSession)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = cached.checkpoint(eager=True)
    cached.unpersist()
    return out
