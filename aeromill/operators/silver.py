"""Raw messages to clean readings: parse, enrich, localise, flag, deduplicate."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeromill.functions import geo, quality, timeparts

MEASUREMENT = (
    "sensor_id int, location_id int, value double, datetime_utc string, datetime_local string, lat double, lon double, "
    "ingested_at string, source string, parameter string, units string, location_name string"
)
SENSOR = "sensor_id int, location_id int, location_name string, parameter string, units string, lat double, lon double, updated_at string"
BRONZE = "value string, topic string, partition int, offset long, timestamp string"
SILVER = (
    "sensor_id", "location_id", "location_name", "parameter", "units", "value", "lat", "lon", "datetime_utc", "event_time",
    "datetime_local", "date_local", "hour_local", "borough", "quality_flag", "ingested_at", "source", "year", "month",
)
#: Source of archived readings (fixed value on the wire); their ingestion time says nothing about lateness.
ARCHIVE = "openaq-archive"
#: What a reading may take from its sensor's metadata.
_ENRICHED = ("parameter", "units", "location_name", "lat", "lon")


def raw_rows(messages: DataFrame) -> DataFrame:
    """Source messages as raw rows; the partition column is the date of the broker's timestamp."""
    return messages.select(F.col("value").cast("string").alias("value"), "topic", "partition", "offset", "timestamp", F.to_date("timestamp").alias("ingest_date"))


def parse(bronze: DataFrame) -> DataFrame:
    """Measurements inside raw rows, with the message offset; rows without a sensor id go.

    A field of the wrong type becomes null and leaves the others as they are.
    """
    offset = F.col("offset") if "offset" in bronze.columns else F.lit(0)
    return (
        bronze.select(F.from_json("value", MEASUREMENT).alias("m"), offset.cast("long").alias("kafka_offset"))
        .select("m.*", "kafka_offset")
        .where("sensor_id IS NOT NULL")
    )


def first_rows(rows: DataFrame, keys: list[str] | tuple[str, ...], *order: Column) -> DataFrame:
    """The first row of each key in that order.

    Written as a ranked window, which Spark cuts to one row per key before the shuffle too, so a
    busy key costs one row per map task; an aggregation of whole rows would have to sort them as well.
    """
    ranks = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(ranks)).where("_rank = 1").drop("_rank")


def latest_per_key(changes: DataFrame, schema: str = SENSOR) -> DataFrame:
    """The last value of each key of a compacted log (key, value, partition, offset).

    A key whose last value is null was deleted.
    """
    last = first_rows(changes, ["key"], F.desc("partition"), F.desc("offset")).where("value IS NOT NULL")
    return last.select(F.from_json("value", schema).alias("m")).select("m.*").where("sensor_id IS NOT NULL")


def placed(sensors: DataFrame) -> DataFrame:
    """Sensors with the region of their place, so that it is looked up once per sensor."""
    return geo.with_region(sensors)


def enrich(readings: DataFrame, sensors: DataFrame) -> DataFrame:
    """Fill what a reading lacks from its sensor. Sensors are left to the planner to broadcast by size.

    Where ``sensors`` have regions (``placed``), so do readings; one that names another place than
    its sensor's is looked up itself.
    """
    regional = "borough" in sensors.columns
    meta = sensors.select(F.col("sensor_id").alias("m_sensor"), *[F.col(c).alias(f"m_{c}") for c in (*_ENRICHED, *["borough"] * regional)])
    joined = readings.join(meta, F.col("sensor_id") == F.col("m_sensor"), "left")
    joined = joined.withColumns({c: F.coalesce(c, f"m_{c}") for c in _ENRICHED})
    if regional:
        there = F.col("lat").eqNullSafe(F.col("m_lat")) & F.col("lon").eqNullSafe(F.col("m_lon")) & F.col("m_sensor").isNotNull()
        joined = joined.withColumn("borough", F.when(there, F.col("m_borough")).otherwise(geo.region_of(F.col("lat"), F.col("lon")))).drop("m_borough")
    return joined.drop("m_sensor", *[f"m_{c}" for c in _ENRICHED])


def localise(readings: DataFrame, day_from: date | None = None, day_to: date | None = None) -> DataFrame:
    """UTC and local time columns; readings without a valid time, or outside the local days, go."""
    timed = readings.withColumn("event_time", F.try_to_timestamp("datetime_utc")).where("event_time IS NOT NULL")
    wall = timeparts.local(F.col("event_time"))
    timed = timed.withColumns({"date_local": F.to_date(wall), "hour_local": F.hour(wall), "datetime_utc": timeparts.wire(F.col("event_time"))})
    if day_from is not None:
        timed = timed.where(F.col("date_local").between(F.lit(day_from), F.lit(day_to or day_from)))
    return timed


def flagged(readings: DataFrame, now: Column | None = None, archive: str = ARCHIVE) -> DataFrame:
    """The quality flag. Late by ``now`` if given, else by the ingestion time of live readings."""
    reference = F.when(F.col("source") != archive, F.try_to_timestamp("ingested_at")) if now is None else now
    return readings.withColumn("quality_flag", quality.flag(F.col("parameter"), F.col("units"), F.col("value"), F.col("event_time"), reference))


def dedupe_latest(readings: DataFrame, keys: tuple[str, ...] = ("sensor_id", "event_time")) -> DataFrame:
    """The reading per key that came in last: by ingestion time (a string; null first), offset, value."""
    return first_rows(readings, keys, *[F.desc(c) for c in ("ingested_at", "kafka_offset", "value")])


def clean(parsed: DataFrame, sensors: DataFrame, box: str = geo.DEFAULT_BOX, day_from: date | None = None, day_to: date | None = None) -> DataFrame:
    """Parsed measurements to clean readings (columns SILVER)."""
    located = localise(enrich(parsed, placed(sensors)), day_from, day_to).where(geo.in_box(F.col("lat"), F.col("lon"), box))
    kept = flagged(located).where(~F.col("quality_flag").isin(*quality.DROPPED))
    return dedupe_latest(kept).withColumns({"year": F.year("date_local"), "month": F.month("date_local")}).select(*SILVER)


def funnel(parsed: DataFrame, sensors: DataFrame, box: str = geo.DEFAULT_BOX) -> DataFrame:
    """Rows per quality flag after the box filter, and whether a batch keeps them."""
    located = localise(enrich(parsed, sensors)).where(geo.in_box(F.col("lat"), F.col("lon"), box))
    return flagged(located).groupBy("quality_flag").agg(F.count("*").alias("n")).withColumn("kept", ~F.col("quality_flag").isin(*quality.DROPPED))


def sensor_lookup(sensors: DataFrame, readings: DataFrame) -> DataFrame:
    """(sensor_id, parameter, units): from metadata if known there, else from readings (least pair)."""
    both = sensors.select("sensor_id", "parameter", "units", F.lit(0).alias("prio")).unionByName(readings.select("sensor_id", "parameter", "units", F.lit(1).alias("prio")))
    return both.where("parameter IS NOT NULL").groupBy("sensor_id").agg(F.min(F.struct("prio", "parameter", "units")).alias("m")).select("sensor_id", "m.parameter", "m.units")


def rolling_history(readings: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    """Readings no older than ``days`` before ``as_of`` (retention)."""
    return readings.where(F.col("event_time") >= as_of - F.expr(f"INTERVAL {days} DAYS"))


def nearest_partition_days(day_from: date, day_to: date) -> Column:
    """Raw partitions that may hold readings of these local days: one more day at the end."""
    return F.col("ingest_date").between(F.lit(day_from), F.date_add(F.lit(day_to), 1))


def within_days(first: date, last: date, warm_up: int = 1) -> Column:
    """Clean partitions of these days and ``warm_up`` days before (for windows that reach back)."""
    return F.col("date_local").between(F.date_sub(F.lit(first), warm_up), F.lit(last))
