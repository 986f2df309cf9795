"""Streaming ingest of the landing directory.

New response files are picked up by a file stream (``wholetext``: one row
per file).  Each micro-batch is parsed like the batch ingest; accepted hours
go to a staging table partitioned by (var, date, hour) and rejected ones to
the quarantine.  A (var, date) is promoted to the observation cache once its
staging partitions hold every expected hour -- only the days touched by the
batch are checked, so the state lives in the staging table (shared storage)
rather than in executor memory, and a restarted query resumes from its
checkpoint.  Partition overwrites (staging hours, quarantine by batch id,
promoted days) make a replayed batch idempotent.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from ..operators import gates, ingest
from ..sinks import writers as W
from ..sources.readers import RESPONSE_NAME

TEXT_SCHEMA = StructType([StructField("value", StringType())])
# Staging rows; partition columns typed explicitly so the day joins prune
# partitions (no cast on the partition column).
STAGING_SCHEMA = StructType([
    StructField("path", StringType()), StructField("grid_idx", LongType()),
    StructField("value", DoubleType()), StructField("ord", LongType()),
    StructField("var", StringType()), StructField("date", StringType()), StructField("hour", IntegerType()),
])


def landing_stream(spark: SparkSession, landing: str, max_files: int = 256,
                   recursive: bool = False) -> DataFrame:
    df = (spark.readStream.format("text").schema(TEXT_SCHEMA)
          .option("wholetext", True).option("maxFilesPerTrigger", max_files)
          .option("recursiveFileLookup", recursive).load(landing))
    p = F.col("_metadata.file_path")
    return df.select(p.alias("path"),
                     F.regexp_extract(p, RESPONSE_NAME, 1).alias("var"),
                     F.regexp_extract(p, RESPONSE_NAME, 2).alias("tm"),
                     F.col("value").alias("text"))


def _process_batch(batch: DataFrame, batch_id: int, variables, n_expected, staging: str,
                   obs_root: str, quarantine_root: str) -> None:
    spark = batch.sparkSession
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    resp = gates.season_filter(batch.where(F.col("var").isin(*list(variables)))
                               .withColumn("date", F.substring("tm", 1, 8))).drop("date")
    valid = ingest.validate(resp, n_expected).cache()
    try:
        # Staging keeps the source file of every row: a later batch's file
        # for the same hour replaces the hour's partition, and two files for
        # one hour within a batch are resolved at promotion.
        long = ingest.to_long(valid, extra=("path",))
        long.write.mode("overwrite").partitionBy("var", "date", "hour").parquet(staging)
        # Quarantine rows are keyed by the batch id: a replayed batch (same id
        # after a restart) replaces its own rows instead of adding them again.
        (ingest.rejected(valid).withColumn("batch", F.lit(batch_id))
               .write.mode("overwrite").partitionBy("batch").parquet(quarantine_root))
        # Day and hour tables below are bounded by the micro-batch
        # (maxFilesPerTrigger responses), so they are broadcast.
        touched = valid.where(F.col("vals").isNotNull()).select("var", "date").distinct()
        staged = (spark.read.schema(STAGING_SCHEMA).parquet(staging)
                  .join(F.broadcast(touched), ["var", "date"], "left_semi"))
        # One source file per (var, date, hour): the greatest path.  Reads
        # only the partition columns and the dictionary-encoded path column.
        chosen = staged.groupBy("var", "date", "hour").agg(F.max("path").alias("path"))
        status = gates.hour_status(chosen, variables)
        ready = chosen.join(F.broadcast(status.where("complete").select("var", "date")), ["var", "date"],
                            "left_semi")
        promote = staged.join(F.broadcast(ready), ["var", "date", "hour", "path"], "left_semi")
        W.write_observations(promote.select("grid_idx", "date", "var", "hour", "value", "ord"), obs_root)
        # Promoted days go to the same manifest the batch ingest keeps, with
        # the hours that hold a reading (regional sums read it, no scan).
        value_hours = (promote.where(F.col("value").isNotNull()).select("date", "var", "hour").distinct()
                       .groupBy("date", "var").agg(F.array_sort(F.collect_list("hour")).alias("value_hours")))
        done = (ready.select("date", "var").distinct().join(value_hours, ["date", "var"], "left")
                .select("date", "var", F.lit(True).alias("complete"), F.lit("").alias("missing_hours"),
                        F.coalesce("value_hours", F.array().cast("array<int>")).alias("value_hours"),
                        F.current_timestamp().alias("logged_at")))
        done.write.mode("append").parquet(obs_root.rstrip("/") + "_manifest")
    finally:
        valid.unpersist()


def start_ingest_stream(spark: SparkSession, landing: str, root: str, variables,
                        n_expected: int | None, trigger_once: bool = False,
                        recursive: bool = False) -> StreamingQuery:
    """Run the landing-directory ingest; ``root`` (shared storage) holds the
    staging, observation, quarantine and checkpoint folders."""
    staging = os.path.join(root, "staging")
    obs_root = os.path.join(root, "observations")
    quarantine_root = os.path.join(root, "quarantine")
    writer = (landing_stream(spark, landing, recursive=recursive).writeStream
              .foreachBatch(lambda df, i: _process_batch(df, i, variables, n_expected, staging,
                                                         obs_root, quarantine_root))
              .option("checkpointLocation", os.path.join(root, "_checkpoint")))
    if trigger_once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
