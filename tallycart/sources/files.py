"""CSV and Parquet readers and writers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.utils import AnalysisException

from ..operators.ranking import first_rows
from ..schema import RAW_EVENT

BATCH_ROWS = 500_000
# Bounds a refresh request may ask for, per file.
MIN_ROWS_PER_FILE = 10_000
MAX_ROWS_PER_FILE = 25_000_000


def read_events_csv(
    spark: SparkSession,
    paths: Sequence[str],
    schema: StructType = RAW_EVENT,
    rows_per_file: int = 0,
) -> DataFrame:
    """All files as one table; with a cap, the first rows of each file by time.

    The cap holds for every file, also where a path is a folder or a pattern of many; all are
    read by one scan.
    """
    events = spark.read.schema(schema).option("header", True).csv(list(paths))
    if rows_per_file <= 0:
        return events
    file = F.col("_metadata.file_path").alias("_file")
    return cap_rows_per_group(events.select("*", file), "_file", rows_per_file).drop("_file")


def cap_rows_per_group(df: DataFrame, group: str, rows: int) -> DataFrame:
    """The earliest ``rows`` rows of each group, ids break ties.

    Ranks up to the cap are found per task before rows are exchanged, so a group
    sends at most the cap from each task.
    """
    own = Window.partitionBy(group).orderBy(*_cap_order(df))
    return df.withColumn("_row", F.row_number().over(own)).filter(F.col("_row") <= rows).drop("_row")


def _cap_order(df: DataFrame) -> list[Column]:
    names = ("event_time", "user_id", "product_id", "event_type", "category_code", "brand", "price", "user_session")
    return [F.col(c).asc_nulls_last() for c in names if c in df.columns]


def cap_rows(df: DataFrame, rows: int) -> DataFrame:
    """Deterministic row cap: earliest rows first, ids break ties. No cap when rows <= 0."""
    if rows <= 0:
        return df
    return first_rows(df, _cap_order(df), rows)


def checked_rows_per_file(rows: int) -> int:
    """Validate the cap a caller asks for; 0 or less means no cap."""
    if rows > 0 and not MIN_ROWS_PER_FILE <= rows <= MAX_ROWS_PER_FILE:
        raise ValueError(f"rows per file must lie in {MIN_ROWS_PER_FILE}..{MAX_ROWS_PER_FILE}")
    return rows


def union_tables(tables: Sequence[DataFrame]) -> DataFrame:
    """Union by name; columns missing on one side become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def count_rows(df: DataFrame) -> DataFrame:
    """Force a scan and count it, as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias("rows"))


def write_parquet_batches(df: DataFrame, path: str, batch_rows: int = BATCH_ROWS) -> None:
    """Overwrite ``path`` with Parquet files of at most ``batch_rows`` rows."""
    writer = df.write.mode("overwrite")
    if batch_rows > 0:
        writer = writer.option("maxRecordsPerFile", batch_rows)
    writer.parquet(path)


def write_csv_per_value(df: DataFrame, column: str, path: str, most_open: int = 100) -> None:
    """One CSV file per value of ``column`` below ``path``; null and empty text share one.

    A value goes to one task, which writes rows as they arrive. Spark would sort a task's rows by value
    first, unless the task may keep several files open; only values beyond ``most_open`` in one task are sorted.
    """
    conf, setting = df.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(setting)
    conf.set(setting, str(most_open))
    try:
        kind = F.nullif(F.col(column), F.lit(""))  # both are written to the folder of missing values
        df.withColumn("kind", kind).repartition("kind").write.partitionBy("kind").option("header", True).csv(path)
    finally:
        conf.set(setting, before)


def csv_to_parquet(
    spark: SparkSession,
    paths: Sequence[str],
    out: str,
    rows_per_file: int = 0,
    batch_rows: int = BATCH_ROWS,
    schema: StructType = RAW_EVENT,
    seen: Observation | None = None,
) -> DataFrame:
    """Convert CSV files to Parquet and return the Parquet table.

    Times are parsed once, here; text that is none becomes NULL. Days lie together and in
    order of time, so that file and row-group statistics exclude what a range of days does not need.
    ``seen`` receives the number of rows read, counted while they are written
    rather than by another scan of the CSV.
    """
    source = read_events_csv(spark, paths, schema, rows_per_file)
    if seen is not None:
        source = source.observe(seen, F.count(F.lit(1)).alias("rows"))
    typed = timed_events(source)
    if "event_time" in typed.columns:
        # days are gathered by an exchange that sizes tasks by bytes and splits a hot day; no sampling pass
        gathered = typed.withColumn("_day", F.to_date("event_time")).hint("rebalance", "_day")
        typed = gathered.sortWithinPartitions("event_time").drop("_day")
    write_parquet_batches(typed, out, batch_rows)
    return spark.read.schema(typed.schema).parquet(out)


#: Column of the text of a record that does not fit its schema.
RECORD = "_record"


def checked_events(spark: SparkSession, paths: Sequence[str], schema: StructType = RAW_EVENT) -> DataFrame:
    """All rows of the files with ``reason``: why a row cannot be used, NULL where it can.

    A row is of use when it has a time and a user. ``record`` is its text where anything in it did not
    parse; a row with an unreadable price, say, is kept without it, and counts as repaired.
    """
    # the user is read as text, to tell one that is missing from one that is no number
    fields = [StructField(f.name, StringType()) if f.name == "user_id" else f for f in schema.fields]
    whole = StructType([*fields, StructField(RECORD, StringType())])
    rows = spark.read.schema(whole).option("header", True).option("columnNameOfCorruptRecord", RECORD).csv(list(paths))
    time, user = F.try_to_timestamp("event_time"), F.col("user_id").try_cast("bigint")
    reason = (
        F.when(F.col("event_time").isNull(), "no time")
        .when(time.isNull(), "bad time")
        .when(F.col("user_id").isNull(), "no user")
        .when(user.isNull(), "bad user")
    )
    text = F.coalesce(F.col(RECORD), F.when(reason.isNotNull(), F.to_csv(F.struct(*schema.names))))
    parsed = {"event_time": time, "user_id": user}
    return rows.select(*[parsed.get(c, F.col(c)).alias(c) for c in schema.names], reason.alias("reason"), text.alias("record"))


def csv_to_checked_parquet(
    spark: SparkSession, paths: Sequence[str], out: str, batch_rows: int = BATCH_ROWS, seen: Observation | None = None
) -> tuple[DataFrame, DataFrame]:
    """Convert CSV files, rows of no use apart: the events and the quarantined rows, from one scan.

    Both lie below ``out``, days together and in order of time. Rows in are rows kept and rows quarantined.
    """
    checked = checked_events(spark, paths)
    if seen is not None:
        checked = checked.observe(seen, F.count(F.lit(1)).alias("rows"))
    gathered = checked.withColumn("kept", F.col("reason").isNull()).withColumn("_day", F.to_date("event_time")).hint("rebalance", "kept", "_day")
    writer = gathered.sortWithinPartitions("kept", "event_time").drop("_day").write.mode("overwrite").partitionBy("kept")
    if batch_rows > 0:
        writer = writer.option("maxRecordsPerFile", batch_rows)
    writer.parquet(out)
    kept, put_aside = (read_or_empty(spark, f"{out}/kept={k}", checked.schema) for k in ("true", "false"))
    return kept.drop("reason", "record"), put_aside


def quarantine_report(spark: SparkSession, out: str) -> DataFrame:
    """Rows per outcome of a checked conversion: kept, repaired among them, and one row per reason."""
    schema = StructType.fromDDL("reason string, record string")
    kept, aside = (read_or_empty(spark, f"{out}/kept={k}", schema) for k in ("true", "false"))
    good = kept.agg(F.count(F.lit(1)).alias("kept"), F.count("record").alias("repaired"))
    return good.select(F.inline(F.array(*[F.struct(F.lit(c).alias("outcome"), F.col(c).alias("rows")) for c in ("kept", "repaired")]))).unionByName(
        aside.groupBy(F.col("reason").alias("outcome")).agg(F.count(F.lit(1)).alias("rows"))
    )


def timed_events(events: DataFrame) -> DataFrame:
    """Events with ``event_time`` as a timestamp."""
    if dict(events.dtypes).get("event_time") != "string":
        return events
    return events.withColumn("event_time", F.try_to_timestamp("event_time"))


def conversion_report(csv_rows: int | DataFrame, parquet: DataFrame, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """Rows in and out, files written, batches and the fullest file, as one row."""
    per_file = parquet.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"))
    out = per_file.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("parquet_rows"),
        F.count(F.lit(1)).alias("num_parquet_files"),
        F.coalesce(F.max("n"), F.lit(0)).alias("max_rows_in_file"),
    )
    batches = (
        F.ceil(F.col("parquet_rows") / F.lit(batch_rows)) if batch_rows > 0 else F.lit(0)
    ).cast("bigint")
    read = count_rows(csv_rows).scalar() if isinstance(csv_rows, DataFrame) else F.lit(csv_rows).cast("bigint")
    return out.select(
        read.alias("csv_rows"),
        "parquet_rows",
        F.lit(batch_rows).cast("bigint").alias("batch_size"),
        "num_parquet_files",
        batches.alias("num_batches"),
        "max_rows_in_file",
    )


def compare_scan_times(csv_seconds: float, parquet_seconds: float) -> dict[str, float | str]:
    """Speed-up and winner of two measured scans."""
    return {
        "csv_read_seconds": round(csv_seconds, 3),
        "parquet_read_seconds": round(parquet_seconds, 3),
        "speedup_csv_vs_parquet": round(csv_seconds / max(parquet_seconds, 0.001), 2),
        "winner": "parquet" if parquet_seconds < csv_seconds else "csv",
    }


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The staged table at ``path``, or an empty table when there is none."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], schema)


def export_daily_csv(daily: DataFrame, path: str) -> None:
    """The daily series as CSV with headers Date, Revenue, Orders, Buyers."""
    daily_export(daily).write.mode("overwrite").option("header", True).csv(path)


def daily_export(daily: DataFrame) -> DataFrame:
    return daily.select(
        F.col("event_date").alias("Date"),
        F.col("revenue").alias("Revenue"),
        F.col("orders").alias("Orders"),
        F.col("dau").alias("Buyers"),
    ).orderBy("Date")
