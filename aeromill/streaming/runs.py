"""Finite runs of the streaming queries over a batch of rows: land them as files, stream, read back."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from aeromill.operators.silver import BRONZE
from aeromill.sources import tables
from aeromill.streaming import queries

#: Times as whole microseconds; by default JSON is written with milliseconds only.
MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
#: The temporary folder of local sessions without one, once it is made.
_OWN: list[str] = []


def workspace(spark: SparkSession) -> str:
    """A folder that driver and executors share; a temporary one only in unset local sessions."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    master = spark.sparkContext.master
    if not base and (not master.startswith("local") or master.startswith("local-cluster")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not base:
        if not _OWN:
            _OWN.append(tempfile.mkdtemp(prefix="aeromill-"))
            atexit.register(shutil.rmtree, _OWN[0], True)
        base = _OWN[0]
    return f"{base.rstrip('/')}/stream-{uuid.uuid4().hex}"


def _landed(spark: SparkSession, rows: DataFrame, schema: str, at: str, files: int | None = 1000) -> DataFrame:
    rows.write.option("timestampFormat", MICROS).json(f"{at}/in")
    return tables.stream_files(spark, f"{at}/in", schema, per_trigger=files)


def run_raw(spark: SparkSession, messages: DataFrame) -> DataFrame:
    at = workspace(spark)
    stream = _landed(spark, messages, BRONZE.replace("timestamp string", "timestamp timestamp"), at)
    queries.land_raw(stream, f"{at}/raw", f"{at}/check", every=None).awaitTermination()
    return tables.read_raw(spark, f"{at}/raw")


def run_dedupe(spark: SparkSession, messages: DataFrame) -> DataFrame:
    at = workspace(spark)
    stream = _landed(spark, messages, BRONZE, at)
    sink = queries.keep_new(f"{at}/readings", ["sensor_id", "event_time"])
    queries.start(queries.deduped(stream).writeStream.foreachBatch(sink), f"{at}/check", None).awaitTermination()
    return spark.read.parquet(f"{at}/readings").drop("event_day")


def run_alerts(spark: SparkSession, index: DataFrame) -> DataFrame:
    """Alerts of a stream of index rows (location_id, event_time, station_aqi).

    All files are one batch: they are not in time order, and a station ignores what is older than its state.
    """
    at = workspace(spark)
    rows = index.select("location_id", "event_time", "station_aqi")
    stream = _landed(spark, rows, "location_id long, event_time timestamp, station_aqi int", at, files=None)
    found = queries.station_alerts(stream).writeStream.format("parquet").option("path", f"{at}/alerts")
    queries.start(found, f"{at}/check", None).awaitTermination()
    return spark.read.schema(queries.ALERTS).parquet(f"{at}/alerts")


def run_regions(spark: SparkSession, index: DataFrame, stations: DataFrame, per_time: bool = True) -> DataFrame:
    """Region alerts of a stream of index rows; one batch per event time, or one for all."""
    at = workspace(spark)
    rows = index.select("location_id", "event_time", "station_aqi", "dominant_pollutant")
    schema = "location_id long, event_time timestamp, station_aqi int, dominant_pollutant string"
    times = [r[0] for r in rows.select("event_time").distinct().orderBy("event_time").collect()] if per_time else [None]
    for moment in times:  # a bounded list: for tests and demonstrations
        (rows if moment is None else rows.where(rows["event_time"] == moment)).coalesce(1).write.mode("append").option("timestampFormat", MICROS).json(f"{at}/in")
        stream = tables.stream_files(spark, f"{at}/in", schema, per_trigger=1000)
        sink = queries.region_alerts(f"{at}/tables", stations)
        queries.start(queries.station_trail(stream).writeStream.foreachBatch(sink), f"{at}/check", None).awaitTermination()
    return spark.read.parquet(f"{at}/tables/alerts").drop("event_day")
