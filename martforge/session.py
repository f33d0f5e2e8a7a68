"""Session helpers: a tuned local/cluster session and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. Shuffle partition count is left to the caller:
# on a cluster it should be sized so one partition is ~128-256 MB of shuffle
# data; AQE coalesces small ones and splits skewed ones at runtime.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files of a finished query are removed once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int = 8,
    app_name: str = "martforge",
    extra_conf: dict | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the settings the operators assume."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the deployment (a shared filesystem or
    object store); a non-local master without it is refused. Only on a local master - in
    tests - a scratch folder is created and registered, so later lookups agree.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: only the conf is visible
        sc = None
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        if sc is None or not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="martforge-ckpt-", dir=os.environ.get("MARTFORGE_SCRATCH", "/tmp"))
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root.rstrip("/")


def shared_dir(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A fresh sub-folder of the shared checkpoint root for written tables."""
    pieces = [checkpoint_root(spark), "martforge", *parts]
    if unique:
        pieces.append(uuid.uuid4().hex[:12])
    return "/".join(pieces)


def materialize(df):
    """Cut lineage with a reliable checkpoint in the shared folder.

    Used where one intermediate feeds several branches of a plan, so it is
    computed once. Losing an executor does not lose the files; Spark removes them once
    nothing refers to the DataFrame (``spark.cleaner.referenceTracking.cleanCheckpoints``).
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint()
