"""Writers: partitioned parquet and CSV outputs, quarantine, reports.

All writes are Spark writes with dynamic partition overwrite, so rerunning
a day replaces exactly that day's partitions and a lost executor's task is
simply retried (the committer makes the output atomic per job).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _dynamic(df: DataFrame) -> None:
    df.sparkSession.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")


def write_observations(obs: DataFrame, root: str) -> None:
    """Observation cache: ``root/var=/year=/month=/date=/part-*.parquet``.

    No shuffle: each response is parsed by one task, so a task's rows
    already belong to one (var, date) and it writes one file per hourly
    response.  (Clustering by (var, date) instead would send a whole
    day -- 100M rows -- through a single writer task.)
    """
    _dynamic(obs)
    out = (obs.withColumn("year", F.substring("date", 1, 4))
              .withColumn("month", F.substring("date", 5, 2)))
    out.write.mode("overwrite").partitionBy("var", "year", "month", "date").parquet(root)


def write_staged(rows: DataFrame, root: str) -> None:
    """Staging of an ingest run, partitioned by variable and date: publishing
    a complete day reads that day's files only."""
    rows.write.partitionBy("var", "date").parquet(root)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder of this run on the cluster's file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def write_mapping(mapping: DataFrame, path: str) -> None:
    mapping.write.mode("overwrite").parquet(path)


def write_quarantine(quarantine: DataFrame, root: str) -> None:
    """Validation log as a table: appended, partitioned by variable and year.

    A day has a few rejected responses, so folders by day would be as many as
    the days of a run, each with a file of every task, renamed one by one when
    the job commits.  Rows are dealt by variable and year (AQE joins small
    shares and splits large ones) and sorted by date in every file, whose
    statistics let a day be read without the others.
    """
    out = quarantine.withColumn("year", F.substring("date", 1, 4))
    (out.hint("rebalance", "var", "year").sortWithinPartitions("var", "year", "date")
        .write.mode("append").partitionBy("var", "year").parquet(root))


def write_bucketed(df: DataFrame, name: str, path: str, buckets: int, key: str = "grid_idx", partition_by=()) -> DataFrame:
    """``df`` as the table ``name`` at ``path``, dealt into ``buckets`` files by
    ``key`` (in each partition folder), and read back.

    Tables of equally many buckets meet on ``key`` without a shuffle, and an
    aggregate whose keys contain it needs none either: with the readings and the
    mapping bucketed by cell, ``regional.region_day`` shuffles only its partial
    aggregates, first-wins stage included.  Rows are dealt once, here, and each
    bucket is written by one task in the order of ``key``.
    """
    out = df.repartition(buckets, key).write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key)
    if partition_by:
        out = out.partitionBy(*partition_by)
    out.format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def write_region_days(wide: DataFrame, root: str, region_type: str) -> None:
    """Interim per-day regional table, partitioned by region type and date.
    A date is one row per region, so it goes to one task and is one file."""
    _dynamic(wide)
    (wide.repartition("date").withColumn("region_type", F.lit(region_type))
         .write.mode("overwrite").partitionBy("region_type", "date").parquet(root))


#: Rows of one CSV file of the monthly and yearly tables.
ROWS_PER_FILE = 200_000


def _write_sorted_csv(wide: DataFrame, root: str, periods: dict, rows_per_file: int) -> None:
    """CSV folders per period, sorted by date and codes across their files.

    Rows are dealt by ranges of (date, codes), so a long period is spread over
    many tasks, and each range is sorted: the files of a folder, in the order of
    their names, are the sorted table.  No file is longer than ``rows_per_file``.
    """
    _dynamic(wide)
    order = ["date", *[c for c in wide.columns if c in ("HJD_CD", "EMD_CD")]]
    out = wide.repartitionByRange(*order)
    for name, value in periods.items():
        out = out.withColumn(name, value)
    # the writer keeps an order that begins with its partition columns
    out = out.sortWithinPartitions(*periods, *order)
    (out.write.mode("overwrite").option("header", True).option("maxRecordsPerFile", rows_per_file)
        .partitionBy(*periods).csv(root))


def write_monthly_csv(wide: DataFrame, root: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """One CSV folder per (year, month), sorted across its files."""
    periods = {"year": F.substring("date", 1, 4), "month": F.substring("date", 5, 2)}
    _write_sorted_csv(wide, root, periods, rows_per_file)


def write_yearly_csv(wide: DataFrame, root: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """One CSV folder per year, sorted across its files."""
    _write_sorted_csv(wide, root, {"year": F.substring("date", 1, 4)}, rows_per_file)


def write_station_tables(table: DataFrame, root: str, keys=("year",)) -> None:
    """Station tables as CSV folders per key (the job uses year and the
    file's station, so a rerun replaces exactly its station-years).  A
    station-year is at most some hundred rows: one task, one file."""
    _dynamic(table)
    keys = [keys] if isinstance(keys, str) else list(keys)
    table.repartition(*keys).write.mode("overwrite").option("header", True).partitionBy(*keys).csv(root)


def failure_summary(status: DataFrame) -> DataFrame:
    """Per day: variables written and variables failed (sorted, comma
    joined).  ``status`` is (date, var, complete); a day has a few variables."""
    return status.groupBy("date").agg(
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("complete"), F.col("var")))), ",").alias("ok"),
        F.array_join(F.array_sort(F.collect_list(F.when(~F.col("complete"), F.col("var")))), ",").alias("failed"))


def markdown_by_key(df: DataFrame, key: str, order, cap: int, title: str, labels: dict | None = None) -> DataFrame:
    """(key, text): one markdown table per key value, rendered in Spark.

    A table shows the first ``cap`` rows of its key and says how many of how
    many those are; ``labels`` renames columns for display.  A group that is
    joined to text holds at most ``cap`` short lines; rows beyond are only
    counted, and nothing goes through the driver.
    """
    cols = [c for c in df.columns if c not in (key, "rank", "shown")]
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))
    if "rank" in df.columns:
        ranked = df.withColumnRenamed("rank", "_rn")
    else:
        ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    names = [(labels or {}).get(c, c) for c in cols]
    header = "| " + " | ".join(names) + " |\n| " + " | ".join("---" for _ in cols) + " |\n"
    shown = F.when(F.col("_rn") <= cap, F.struct("_rn", line.alias("l")))
    body = ranked.groupBy(key).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(shown)), lambda x: x["l"]), "\n").alias("_body"),
        F.count(F.lit(1)).alias("_all"))
    total = F.when(F.col("_all") > cap, F.concat(F.lit(f"\n{cap} of "), F.col("_all").cast("string"), F.lit(" rows\n"))).otherwise(F.lit(""))
    return body.select(key, F.concat(F.lit(f"## {title}\n\n{header}"), F.col("_body"), F.lit("\n"), total).alias("text"))


def write_reports(reports: DataFrame, root: str, key: str = "year") -> None:
    """Write (key, text) report sections as text, one folder per key."""
    _dynamic(reports)
    reports.write.mode("overwrite").partitionBy(key).text(root)
