"""Readings derived from the generic ``events`` table, for registered queries and benchmarks.

``dense``: 4 locations with two pollutants, so days are complete. ``wide``: 25 locations (the
``nation`` table) in 5 regions with one pollutant per event type and mixed units. ``defective``:
wide readings with missing, negative, absurd and late ones. ``messages``: defective readings as
raw JSON messages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aeromill.functions.index import air_index, level_number
from aeromill.operators.gold import station_index

#: event type -> (pollutant, unit, divisor of the value).
WIDE = {
    "click": ("pm25", "µg/m³", 1.0),
    "view": ("pm10", "ug/m3", 1.0),
    "purchase": ("no2", "ppb", 1.0),
    "signup": ("so2", " µg / m³", 1.0),
    "error": ("co", "mg/m3", 10.0),
}
TYPES = tuple(sorted(WIDE))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a UTC timestamp (the file's type has no zone)."""
    return table(spark, sf_dir, "events").withColumn("event_time", F.col("ts").cast("timestamp"))


def dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = F.col("event_id") % 2 == 0
    location = F.col("user_id") % 4 + 1
    return _events(spark, sf_dir).select(
        "event_id",
        (location * 10 + F.col("event_id") % 2).cast("int").alias("sensor_id"),
        location.cast("int").alias("location_id"),
        F.concat(F.lit("station "), location.cast("string")).alias("location_name"),
        (40.6 + location / 20).alias("lat"),
        (-73.9 - location / 50).alias("lon"),
        F.element_at(F.array(F.lit("Queens"), F.lit("Brooklyn"), F.lit("Bronx"), F.lit(None).cast("string")), location.cast("int")).alias("borough"),
        F.when(even, "pm25").otherwise("o3").alias("parameter"),
        F.when(even, "µg/m³").otherwise("ppm").alias("units"),
        F.when(even, F.col("value")).otherwise(F.col("value") / 1000.0).alias("value"),
        "event_time",
    )


def _by_type(field: int) -> Column:
    entries = [x for t in TYPES for x in (F.lit(t), F.lit(WIDE[t][field]))]
    return F.create_map(*entries)[F.col("event_type")]


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select(
        "event_id",
        ((F.col("user_id") % 25) * 10 + F.array_position(F.array(*[F.lit(t) for t in TYPES]), F.col("event_type"))).cast("int").alias("sensor_id"),
        (F.col("user_id") % 25).cast("int").alias("location_id"),
        _by_type(0).alias("parameter"),
        _by_type(1).alias("units"),
        (F.col("value") / _by_type(2)).alias("value"),
        "event_time",
    )


def dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as stations of regions; the region MIDDLE EAST stands for an unknown one."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("int").alias("location_id"),
        F.col("n_name").alias("name"),
        (40.5 + F.col("n_nationkey") / 60).alias("lat"),
        (-74.2 + F.col("n_nationkey") / 50).alias("lon"),
        F.when(F.col("r_name") != "MIDDLE EAST", F.col("r_name")).alias("borough"),
    )


def defective(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    return wide(spark, sf_dir).select(
        "event_id", "sensor_id", "location_id", "event_time",
        F.when(i % 101 != 0, F.col("parameter")).alias("parameter"),
        F.when(i % 103 != 0, F.col("units")).alias("units"),
        F.when(i % 83 == 0, F.lit(None)).when(i % 97 == 0, -F.col("value")).when(i % 89 == 0, F.lit(250000.0)).otherwise(F.col("value")).alias("value"),
        (F.col("event_time") + F.make_interval(hours=(i % 5).cast("int"))).alias("ingested_at"),
        F.when(i % 7 == 0, "openaq-archive").when(i % 11 != 0, "openaq-api").alias("source"),
    )


def sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata of the wide view's sensors but every 13th."""
    types = spark.createDataFrame([(k + 1, *WIDE[t][:2]) for k, t in enumerate(TYPES)], "k int, parameter string, units string")
    rows = dim(spark, sf_dir).crossJoin(types)  # 5 rows a station
    return rows.select(
        (F.col("location_id") * 10 + F.col("k")).alias("sensor_id"), "location_id", F.col("name").alias("location_name"), "parameter", "units", "lat", "lon"
    ).where("sensor_id % 13 != 0")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows: hourly times repeat per sensor, every 61st message is not JSON, some lack a sensor."""
    i, hour = F.col("event_id"), F.date_trunc("hour", "event_time")
    wire = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    record = F.to_json(
        F.struct(
            F.when(i % 59 != 0, F.col("sensor_id")).alias("sensor_id"), "location_id", "value",
            F.date_format(hour, wire).alias("datetime_utc"), F.date_format("ingested_at", wire).alias("ingested_at"), "source",
        )
    )
    return defective(spark, sf_dir).select(
        F.when(i % 61 == 0, "not json").otherwise(record).alias("value"), F.lit("measurements").alias("topic"),
        (i % 6).cast("int").alias("partition"), i.alias("offset"), F.col("event_time").alias("timestamp"),
    )


def station_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last index of each wide station with a level, as the serving layer keeps it."""
    index = air_index(F.col("parameter"), F.col("value"), F.col("units"))
    latest = station_index(wide(spark, sf_dir).withColumn("aqi_instant", index)).groupBy("location_id").agg(
        F.max_by(F.struct("station_aqi", "dominant_pollutant", "event_time"), "event_time").alias("s")
    )
    return latest.select(
        "location_id", "s.station_aqi", "s.dominant_pollutant", level_number(F.col("s.station_aqi")).alias("alerted_level"), F.col("s.event_time").alias("last_event_time")
    )
