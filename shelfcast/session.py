"""Session helpers: defaults every job relies on, and the shared scratch root."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators depend on for correct results (not tuning knobs).
REQUIRED_CONF = {
    # Every timestamp in the model is UTC.
    "spark.sql.session.timeZone": "UTC",
    # Python's json keeps the last of duplicate keys; so does the variant parser with this on.
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Runtime re-planning: coalesce small shuffles, split skewed join partitions,
# demote joins to broadcast only when the measured side is small.
ADAPTIVE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "shelfcast",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        **REQUIRED_CONF,
        **ADAPTIVE_CONF,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # checkpointed stand-ins for stored tables are removed once unreferenced
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor; 1g default heap thrashes
        conf["spark.driver.memory"] = "8g"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_required_conf(spark)
    return spark


def apply_required_conf(spark: SparkSession) -> None:
    """Pin the settings results depend on, on a session someone else built."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)


def shared_root(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the platform and is visible to every executor.
    Only when it is unset (local tests) do we pick a fresh local folder.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="shelfcast-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique folder under the shared root for tables a job writes."""
    return os.path.join(shared_root(spark), "shelfcast", *parts, uuid.uuid4().hex)
