"""Readers and writers of the lake: raw JSON, clean and derived Parquet, archives, logs, text."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeromill.operators.silver import BRONZE, nearest_partition_days, within_days

ARCHIVE_COLUMNS = ("location_id", "sensors_id", "location", "datetime", "lat", "lon", "parameter", "units", "value")


def read_raw(spark: SparkSession, path: str, day_from: date | None = None, day_to: date | None = None) -> DataFrame:
    """Raw rows with their ``ingest_date``; the day filter prunes partitions.

    A folder that a stream writes also gets batch appends. The reader is told to list the files
    itself, because the stream's own log knows only the files that the stream wrote.
    """
    reader = spark.read.schema(f"{BRONZE}, ingest_date date")
    rows = reader.option("basePath", path).json(f"{path}/ingest_date=*") if _streamed(spark, path) else reader.json(path)
    return rows if day_from is None else rows.where(nearest_partition_days(day_from, day_to or day_from))


def read_lines(spark: SparkSession, path: str, day_from: date, day_to: date) -> DataFrame:
    """The raw lines (value) of the partitions that ``read_raw`` would read, as they were written."""
    rows = spark.read.option("basePath", path).text(f"{path}/ingest_date=*")
    return rows.where(nearest_partition_days(day_from, day_to)).select("value")


def _streamed(spark: SparkSession, path: str) -> bool:
    log = spark._jvm.org.apache.hadoop.fs.Path(path, "_spark_metadata")
    return log.getFileSystem(spark._jsc.hadoopConfiguration()).exists(log)


def append_raw(rows: DataFrame, path: str) -> None:
    rows.repartition("ingest_date").write.mode("append").option("compression", "gzip").partitionBy("ingest_date").json(path)


def read_silver(spark: SparkSession, path: str, first: date, last: date, warm_up: int = 1) -> DataFrame:
    return spark.read.parquet(path).where(within_days(first, last, warm_up))


def overwrite_partitions(rows: DataFrame, path: str, *keys: str) -> None:
    """Replace only the partitions that ``rows`` has, one file each."""
    rows.repartition(*keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def _files(spark: SparkSession, path: str):
    """(file system, path, maker of paths)"""
    make = spark._jvm.org.apache.hadoop.fs.Path
    root = make(path)
    return root.getFileSystem(spark._jsc.hadoopConfiguration()), root, make


def days_in(spark: SparkSession, path: str, key: str = "date_local") -> dict[str, list[str]]:
    """Folders of each day's partitions, up to two levels of keys above them."""
    fs, _, make = _files(spark, path)
    out: dict[str, list[str]] = {}
    for status in fs.globStatus(make(path, f"{{{key}=*,*/{key}=*,*/*/{key}=*}}")) or []:
        out.setdefault(status.getPath().getName().partition("=")[2], []).append(status.getPath().toString())
    return out


def overwrite_days(rows: DataFrame, path: str, first: date, last: date, *keys: str) -> None:
    """Replace the days from ``first`` to ``last``: those that ``rows`` lacks are left empty.

    The new rows are written beside the table first, so nothing old goes before all of them are there;
    then their partitions replace the old ones, and days without rows are cleared.
    """
    spark, fresh = rows.sparkSession, f"{path}.{uuid.uuid4().hex}"
    rows.repartition(*keys).write.partitionBy(*keys).parquet(fresh)
    fs, _, make = _files(spark, path)
    found = days_in(spark, fresh)
    if found:
        written = spark.read.schema(rows.schema).option("basePath", fresh).parquet(fresh)
        overwrite_partitions(written, path, *keys)
    for day, folders in days_in(spark, path).items():
        if first.isoformat() <= day <= last.isoformat() and day not in found:
            for folder in folders:
                fs.delete(make(folder), True)
    fs.delete(make(fresh), True)
    spark.catalog.refreshByPath(path)


def replace_table(rows: DataFrame, path: str) -> None:
    """Overwrite a table that ``rows`` may be read from: write beside it, then swap.

    The old table is moved aside and goes only after the new one is in its place; ``exists`` and the
    next call put it back if the swap broke off between.
    """
    spark, fresh = rows.sparkSession, f"{path}.{uuid.uuid4().hex}"
    recover(spark, path)
    rows.write.parquet(fresh)
    fs, target, make = _files(spark, path)
    aside = make(f"{path}.old")
    if fs.exists(target) and not fs.rename(target, aside):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(make(fresh), target):
        recover(spark, path)
        raise OSError(f"cannot move {fresh} to {path}")
    fs.delete(aside, True)
    spark.catalog.refreshByPath(path)


def recover(spark: SparkSession, path: str) -> None:
    """Settle a swap that broke off: the old table comes back if the new one is not in its place."""
    fs, target, make = _files(spark, path)
    aside = make(f"{path}.old")
    if not fs.exists(aside):
        return
    if fs.exists(target):
        fs.delete(aside, True)
    else:
        fs.rename(aside, target)


def exists(spark: SparkSession, path: str) -> bool:
    if "*" not in path:
        recover(spark, path)
    fs, target, _ = _files(spark, path)
    return bool(fs.globStatus(target))


def total_bytes(spark: SparkSession, path: str) -> int:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Archive CSV (gzip too) with a header; the needed columns as strings, whatever else there is."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path).select(*ARCHIVE_COLUMNS)


def archive_globs(root: str, locations: list[int], months: list[tuple[int, int]]) -> list[str]:
    return [f"{root}/locationid={i}/year={y}/month={m:02d}/*.csv.gz" for i in sorted(locations) for y, m in months]


def anonymous_bucket(bucket: str, endpoint: str = "s3.us-east-1.amazonaws.com", region: str = "us-east-1") -> dict[str, str]:
    """Session settings to read one public bucket without credentials."""
    prefix = f"spark.hadoop.fs.s3a.bucket.{bucket}"
    return {
        f"{prefix}.endpoint": endpoint,
        f"{prefix}.endpoint.region": region,
        f"{prefix}.path.style.access": "false",
        f"{prefix}.connection.ssl.enabled": "true",
        f"{prefix}.aws.credentials.provider": "org.apache.hadoop.fs.s3a.AnonymousAWSCredentialsProvider",
    }


def publish(rows: DataFrame, servers: str, topic: str, key: str | None = None) -> None:
    """Append rows as JSON messages to a log (needs the Kafka connector on the class path)."""
    as_messages(rows, key).write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def as_messages(rows: DataFrame, key: str | None = None) -> DataFrame:
    """(key, value) of each row, as they go to a log: times as UTC text."""
    fields = [F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias(c) if t == "timestamp" else F.col(c) for c, t in rows.dtypes]
    return rows.select((F.col(key).cast("string") if key else F.lit(None).cast("string")).alias("key"), F.to_json(F.struct(*fields)).alias("value"))


def read_log(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """A whole log (needs the Kafka connector on the class path): key and value as text."""
    rows = spark.read.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    loaded = rows.option("startingOffsets", "earliest").option("endingOffsets", "latest").load()
    return loaded.select(F.col("key").cast("string"), F.col("value").cast("string"), "partition", "offset", "timestamp")


def stream_log(spark: SparkSession, servers: str, topic: str, per_trigger: int = 10_000) -> DataFrame:
    rows = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    return rows.option("startingOffsets", "latest").option("maxOffsetsPerTrigger", per_trigger).load()


def stream_files(spark: SparkSession, path: str, schema: str, kind: str = "json", per_trigger: int | None = 1) -> DataFrame:
    """Files as they come, so many a batch, or, without a number, all that there are."""
    reader = spark.readStream.schema(schema).format(kind)
    return (reader if per_trigger is None else reader.option("maxFilesPerTrigger", per_trigger)).load(path)


def write_lines(rows: DataFrame, path: str) -> None:
    """A small table as one JSON-lines file."""
    rows.coalesce(1).write.mode("overwrite").json(path)


def write_jdbc(rows: DataFrame, url: str, table: str, **properties: str) -> None:
    """Replace a database table's rows and keep its definition (needs a driver on the class path)."""
    rows.write.format("jdbc").option("url", url).option("dbtable", table).options(**properties).option("truncate", "true").mode("overwrite").save()


def wave(spark: SparkSession, sensors: int, minutes: int, base: float = 30.0, swing: float = 25.0, spike_at: int | None = None, spike: float = 200.0) -> DataFrame:
    """Deterministic readings: a daily cosine per sensor, one a minute, with an optional spike."""
    minute = F.col("id") % minutes
    value = F.lit(base) + swing * F.cos(2 * F.lit(3.141592653589793) * minute / 1440 + F.floor(F.col("id") / minutes))
    if spike_at is not None:
        value = F.when(minute == spike_at, F.lit(spike)).otherwise(value)
    return spark.range(sensors * minutes).select(
        F.floor(F.col("id") / minutes).cast("int").alias("sensor_id"),
        F.timestamp_seconds(F.lit(1_700_000_000) + minute * 60).alias("event_time"),
        F.round(F.greatest(value, F.lit(0.0)), 2).alias("value"),
    )
