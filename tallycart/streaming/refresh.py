"""Pick up event files that arrived since the last refresh.

The scheduled refresh is a file stream that runs until it has read what is there and stops. Its
checkpoint remembers which files were read, so a restart neither skips nor repeats one. Every
micro-batch becomes a folder of the event store, overwritten when the batch is run again, with
one folder a month inside and rows in order of time: a range of days reads its months,
and statistics exclude the other days of a month.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import RAW_EVENT
from ..sources import commits
from ..sources.files import cap_rows_per_group, timed_events


def ingest_new_files(spark: SparkSession, csv_folder: str, parquet_folder: str, checkpoint: str, rows_per_file: int = 0) -> DataFrame:
    """Append new CSV files, or the first rows of each, to the event store and return it."""
    files = spark.readStream.schema(RAW_EVENT).option("header", True).csv(csv_folder)
    if rows_per_file > 0:
        files = files.select("*", F.col("_metadata.file_path").alias("_file"))

    def keep(batch: DataFrame, number: int) -> None:
        if rows_per_file > 0:
            batch = cap_rows_per_group(batch, "_file", rows_per_file).drop("_file")
        timed = timed_events(batch).withColumn("month", F.date_format("event_time", "yyyy-MM"))
        # an exchange that sizes tasks by bytes and splits a hot month; no sampling pass
        ordered = timed.hint("rebalance", "month").sortWithinPartitions("month", "event_time")
        ordered.write.mode("overwrite").partitionBy("month").parquet(f"{parquet_folder}/batch={number}")

    query = files.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return stored_events(spark, parquet_folder).drop("batch", "month")


def stored_batches(spark: SparkSession, parquet_folder: str) -> list[int]:
    """Numbers of the micro-batches the store holds."""
    return sorted(int(n.removeprefix("batch=")) for n in commits.names(spark, parquet_folder) if n.startswith("batch="))


def stored_events(spark: SparkSession, parquet_folder: str) -> DataFrame:
    """All events of the store with their ``batch`` and ``month``, which prune folders."""
    kind = timed_events(spark.createDataFrame([], RAW_EVENT)).schema.add("batch", "integer").add("month", "string")
    if not stored_batches(spark, parquet_folder):
        return spark.createDataFrame([], kind)
    return spark.read.schema(kind).parquet(parquet_folder)
