"""Session helpers.

Library code never creates its own session; it takes the caller's.  These
helpers are for tests, bench and scripts.  Cluster-wide settings such as
``spark.checkpoint.dir`` are read from the session and only filled in when
unset (local tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings we want on every session we create.  AQE re-plans joins at runtime
# from real shuffle sizes (broadcast only when the materialised side is under
# the threshold), coalesces small partitions and splits skewed ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app_name: str = "confluo", extra: dict | None = None) -> SparkSession:
    master = master or os.environ.get("CONFLUO_MASTER", "local[8]")
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def case_sensitive(spark: SparkSession) -> SparkSession:
    """A session beside the caller's, of the same application and settings, in which names tell capitals apart."""
    own = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if spark.conf.isModifiable(k):
            own.conf.set(k, v)
    own.conf.set("spark.sql.caseSensitive", "true")
    return own


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS/object store)
    folder and is used as is.  Only when it is unset on a local master (tests) do
    we set a scratch folder of our own; elsewhere it is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir() if hasattr(
            spark.sparkContext, "getCheckpointDir") else None
    if current:
        return current
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    path = fallback or tempfile.mkdtemp(prefix="confluo-ckpt-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(path)
    try:   # some sessions reject setting core configs at runtime; the context setting is what counts
        spark.conf.set("spark.checkpoint.dir", path)
    except Exception:
        pass
    return path
