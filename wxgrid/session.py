"""Spark session helpers.

The library never creates clusters or paths on its own in production: a
cluster names its shared checkpoint folder in ``spark.checkpoint.dir`` and
we read it from the session.  Only tests and local runs fall back to a
scratch folder, and only when the setting is absent.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on.  AQE re-plans joins and shuffle partition
# counts from runtime sizes; skew-join splitting covers hot region keys.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


# Settings for a large cluster (100 TB of observations, ~1000 executors).
# Shuffles start wide and AQE coalesces them to its default ~64 MB target,
# so a partition fits an executor core's memory at any scale while mid-sized
# shuffles (the spatial join's candidates) still spread over many tasks;
# file splits of 256 MB keep scan tasks in the tens of thousands rather than
# millions; skewed join partitions are split by AQE's skew-join rule (on in
# DEFAULT_CONF, with Spark's default thresholds).
CLUSTER_CONF = {
    **DEFAULT_CONF,
    "spark.sql.shuffle.partitions": "8000",
    # the grid -> region mapping of mapped cells is about 15 MB: broadcast by
    # its measured size, so that readings are never shuffled to meet it
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession, conf: dict | None = None) -> SparkSession:
    """Apply ``conf`` (default: ``CLUSTER_CONF``) to a running session, but
    only for settings that neither the cluster set at launch nor the caller in
    this session (where it differs from a fresh one)."""
    launched, fresh = spark.sparkContext.getConf(), spark.newSession()
    for k, v in (conf or CLUSTER_CONF).items():
        if k == "spark.ui.enabled" or launched.contains(k) or spark.conf.get(k, None) != fresh.conf.get(k, None):
            continue  # static, or chosen by the cluster or the caller
        spark.conf.set(k, v)
    return spark


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "8g", app: str = "wxgrid") -> SparkSession:
    """Local session for tests, benches and the smoke entry point."""
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", driver_memory))
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session.  When it is unset
    (tests, a laptop) a fresh scratch folder is created and registered, so a
    local run still cuts lineage the same way a cluster job does.
    """
    conf = spark.sparkContext.getConf()
    path = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/object store) "
                               "before running jobs that checkpoint")
        path = tempfile.mkdtemp(prefix="wxgrid-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    return os.path.join(checkpoint_dir(spark), name)
