"""Session helpers: the configuration the plans are written against."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the plans rely on; sizes are for the cluster, tests override partitions.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "cohortlens", **extra) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(RECOMMENDED_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update({k: str(v) for k, v in extra.items()})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``.  Only a local-mode session
    (tests) with none configured falls back to a fresh temporary folder; on a
    cluster a machine-local folder would not survive executor loss, so an
    unset directory is an error there."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to shared storage before checkpointing")
        path = tempfile.mkdtemp(prefix="cohortlens-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path under the folder that all executors share (``spark.checkpoint.dir``)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
