"""Session helpers.

Library code never hard-codes cluster sizing; it only asks for settings that
change *results* (UTC session zone) or that every plan benefits from (AQE with
skew-join and partition coalescing).  How a write treats existing partitions is
said per write, never by a setting of the session.  Sizing such
as ``spark.sql.shuffle.partitions`` is left to whoever builds the session.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the operators rely on for correct results or sane plans at scale.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tidewater") -> SparkSession:
    """A local session for tests and the bench (UI off, small shuffle count)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("TIDEWATER_DRIVER_MEMORY", "16g"))
        .config("spark.sql.ansi.enabled", "true")
        # materialised states (reliable checkpoints) are removed once unreferenced
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_required_conf(spark)
    return spark


def apply_required_conf(spark: SparkSession) -> SparkSession:
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster this setting points at a shared file system and is only read
    (unset is an error there).  When it is unset in local mode (tests) a
    scratch folder is registered on the context (the core setting itself is
    never written: Spark rejects that at runtime).
    """
    sc = spark.sparkContext
    conf = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        conf = sc.getCheckpointDir()        # registered earlier in this context
    if not conf:
        if not (sc.master or "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/ABFS...): "
                               "a machine-local folder would not survive the loss of an executor")
        conf = tempfile.mkdtemp(prefix="tidewater-ckpt-")
    if not sc.getCheckpointDir():          # each call would otherwise open a new sub-folder
        sc.setCheckpointDir(conf)
        if not sc.getConf().get("spark.checkpoint.dir", None):
            conf = sc.getCheckpointDir()
    return conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the checkpoint folder for written intermediate tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"
