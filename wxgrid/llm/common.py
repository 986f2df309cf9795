"""Session settings, row helpers and written tables shared by the operators."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: Bytes of one Arrow batch sent to a Python worker (Spark's default is 256 MB).
ARROW_BATCH_BYTES = 8 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Bound a worker's memory by bytes, not rows, unless the cluster chose."""
    if not spark.sparkContext.getConf().contains(_BATCH_CONF):
        spark.conf.set(_BATCH_CONF, str(ARROW_BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage and
    survives the loss of any executor.  The shuffle files of the write go when
    it ends, as nothing reads them again."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    before = spark.conf.get(_CLEANUP_CONF, "false")
    spark.conf.set(_CLEANUP_CONF, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP_CONF, before)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id) -> F.Column:
    """crc32 of the id as text, modulo 5, is 0 (null id: false)."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))
