"""Serving tables: idempotent writes as DataFrames, and the read queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeromill.operators.silver import first_rows


def upsert(old: DataFrame, new: DataFrame, key: str, newer: str) -> DataFrame:
    """Rows by key; the one with the larger ``newer`` wins (null loses), at a tie the old one."""
    both = old.withColumn("_age", F.lit(1)).unionByName(new.withColumn("_age", F.lit(0)))
    return first_rows(both, [key], F.col(newer).desc_nulls_last(), F.desc("_age")).select(old.columns)


def insert_ignore(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``old`` and the rows of ``new`` whose key it lacks; of repeated new keys the least row."""
    once = first_rows(new, keys, *[F.col(c).asc() for c in new.columns if c not in keys])
    return old.unionByName(once.join(old.select(*keys), keys, "left_anti").select(old.columns))


def pending(alerts: DataFrame) -> DataFrame:
    """Region alerts that are not published yet, oldest first."""
    return alerts.where("scope = 'region' AND published_at IS NULL").orderBy("created_at", "alert_id")


def mark_published(alerts: DataFrame, delivered: DataFrame, at: Column) -> DataFrame:
    """Set ``published_at`` of the delivered ids that have none."""
    ids = delivered.select("alert_id").distinct().withColumn("_sent", F.lit(True))
    return alerts.join(ids, "alert_id", "left").withColumn("published_at", F.coalesce("published_at", F.when(F.col("_sent"), at))).drop("_sent").select(alerts.columns)


def publish_pending(alerts: DataFrame, send: Callable[[DataFrame], None], at: Column) -> DataFrame:
    """Send the pending alerts, then give the table with those marked; a failed send marks none.

    A crash after the send repeats it, so receivers drop repeats by alert_id (``first_of_each``).
    """
    due = pending(alerts)
    send(due)
    return mark_published(alerts, due, at)


def overview(status: DataFrame, readings: DataFrame, alerts: DataFrame, summary: DataFrame) -> DataFrame:
    """One row of totals."""
    s = status.agg(
        F.count("last_event_time").alias("stations"),
        F.coalesce(F.round(F.avg("station_aqi")), F.lit(0)).cast("int").alias("avg_aqi"),
        F.coalesce(F.max("station_aqi"), F.lit(0)).cast("int").alias("max_aqi"),
    )
    r = readings.agg(F.count("*").alias("readings"), F.min("event_time").alias("first_reading"), F.max("event_time").alias("last_reading"))
    a = alerts.agg(F.count_if(F.col("scope") == "region").alias("alerts"))
    d = summary.agg(F.count("*").alias("daily_records"))
    return s.crossJoin(r).crossJoin(a).crossJoin(d)  # one row each


def stations(status: DataFrame, dim: DataFrame) -> DataFrame:
    joined = dim.select("location_id", "name", "lat", "lon", "borough").join(status.where("last_event_time IS NOT NULL"), "location_id")
    return joined.select("location_id", "name", "lat", "lon", "borough", "station_aqi", "dominant_pollutant", "alerted_level", "last_event_time").orderBy("borough", "name", "location_id")


def bounded(value: int | None, top: int, default: int) -> int:
    """``value`` if it is in (0, top], else the default."""
    return value if value is not None and 0 < value <= top else default


def recent_readings(readings: DataFrame, dim: DataFrame, now: Column, hours: int | None = 24, limit: int = 500) -> DataFrame:
    since = now - F.expr(f"INTERVAL {bounded(hours, 720, 24)} HOURS")
    rows = readings.where(F.col("event_time") >= since).join(dim.select("location_id", "name", "borough"), "location_id")
    columns = ["location_id", "name", "borough", "parameter", "value", "units", "aqi_instant", "event_time"]
    return rows.orderBy(F.desc("event_time"), *[c for c in ("sensor_id",) if c in readings.columns], "location_id").limit(limit).select(*columns)


def recent_hourly(hourly: DataFrame, now: Column, hours: int | None = 72) -> DataFrame:
    since = now - F.expr(f"INTERVAL {bounded(hours, 720, 72)} HOURS")
    return hourly.where(F.col("bucket") >= since).select("borough", "bucket", "aqi_max", F.round("aqi_avg").cast("int").alias("aqi_avg"), "n_readings").orderBy("bucket", "borough")


def latest_alerts(alerts: DataFrame, limit: int | None = 50) -> DataFrame:
    return alerts.where("scope = 'region'").orderBy(F.desc("created_at"), "alert_id").limit(bounded(limit, 500, 50))


def latest_summary(summary: DataFrame, limit: int = 1000) -> DataFrame:
    return summary.where("borough IS NOT NULL").orderBy(F.desc("date_local"), "borough", "location_id").limit(limit)


def cluster_profiles(profiles: DataFrame) -> DataFrame:
    tenths = ["aqi_mean", "aqi_max", "hours_over_100", "peak_hour"]
    return profiles.select(
        "cluster", "cluster_name", "description", "share_of_days", "n_days", *[F.round(c, 1).alias(c) for c in tenths], F.round("pm25_o3_ratio", 2).alias("pm25_o3_ratio")
    ).orderBy("cluster")


def region_statistics(stats: DataFrame) -> DataFrame:
    return stats.withColumn("aqi_avg", F.round("aqi_avg", 1)).orderBy("borough", "period_type", "period")


def worst_stations(status: DataFrame, dim: DataFrame, n: int = 10) -> DataFrame:
    rows = status.where("station_aqi IS NOT NULL").join(dim.select("location_id", "name", "borough"), "location_id")
    return rows.orderBy(F.desc("station_aqi"), "location_id").limit(n).select("location_id", "name", "borough", "station_aqi", "dominant_pollutant")


def alerts_since(alerts: DataFrame, now: Column, hours: int = 24, borough: str | None = None) -> DataFrame:
    rows = alerts.where(F.col("event_time") >= now - F.expr(f"INTERVAL {hours} HOURS"))
    return (rows if borough is None else rows.where(F.col("borough") == borough)).orderBy(F.desc("event_time"), "alert_id")


def alerts_by_prefix(alerts: DataFrame, prefix: str) -> DataFrame:
    """Alerts of one place and hour: their ids begin with both."""
    return alerts.where(F.col("alert_id").startswith(prefix)).orderBy("alert_id")


def first_of_each(alerts: DataFrame) -> DataFrame:
    """Each alert once, however often it was delivered."""
    return first_rows(alerts, ["alert_id"], *[F.col(c).asc() for c in alerts.columns if c != "alert_id"])


def region_levels(status: DataFrame) -> DataFrame:
    """Each region's level and when it last changed."""
    return status.select("borough", "level", F.col("last").alias("last_event_time")).orderBy("borough")
