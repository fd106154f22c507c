"""Streaming twins: raw landing, parse and dedupe, alerts with state, idempotent tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime, timedelta, timezone

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from aeromill.functions.index import air_index, level_label
from aeromill.operators import gold, serving, silver
from aeromill.operators.alerts import TRAIL, Rules, State, Station, alert_id, expire, observe, step
from aeromill.sources import tables

#: Readings may come this much later than the newest one seen.
LATENESS = "2 hours"


def start(writer, checkpoint: str, every: str | None) -> StreamingQuery:
    """A long-running query at an interval, or, without one, all that is available and then stop."""
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def land_raw(messages: DataFrame, path: str, checkpoint: str, every: str | None = "5 minutes") -> StreamingQuery:
    """Every message, untouched, as compressed JSON by ingestion date."""
    writer = silver.raw_rows(messages).writeStream.format("json").option("path", path).option("compression", "gzip").partitionBy("ingest_date")
    return start(writer, checkpoint, every)


def deduped(messages: DataFrame, lateness: str = LATENESS, horizon: str | None = None) -> DataFrame:
    """One measurement per sensor and event time within the lateness.

    ``horizon`` drops readings dated so far after their message; one such reading would push the
    watermark on and silently lose what comes after it.
    """
    parsed = messages.select(F.from_json(F.col("value").cast("string"), silver.MEASUREMENT).alias("m"), F.col("timestamp").alias("seen"))
    rows = parsed.withColumn("event_time", F.try_to_timestamp("m.datetime_utc")).where("m.sensor_id IS NOT NULL AND event_time IS NOT NULL")
    if horizon:
        rows = rows.where(F.col("event_time") <= F.col("seen").cast("timestamp") + F.expr(f"INTERVAL {horizon}"))
    rows = rows.select("m.sensor_id", "m.location_id", "m.value", "m.datetime_utc", "m.ingested_at", "event_time")
    return rows.withWatermark("event_time", lateness).dropDuplicatesWithinWatermark(["sensor_id", "event_time"])


def indexed(readings: DataFrame, sensors: DataFrame) -> DataFrame:
    """Readings with metadata and instant index; only those without a flaw (late ones go too)."""
    meta = sensors.select(F.col("sensor_id").alias("m_sensor"), "parameter", "units")
    joined = readings.join(meta, F.col("sensor_id") == F.col("m_sensor"), "left").drop("m_sensor").withColumn("source", F.lit(None).cast("string"))
    kept = silver.flagged(joined, F.current_timestamp()).where("quality_flag = 'OK'")
    return kept.withColumn("aqi_instant", air_index(F.col("parameter"), F.col("value"), F.col("units")))


_STATE = "level int, candidate int, seen int, last long, alerted_at long, alerted_level int"
ALERTS = "location_id long, alert_type string, level int, previous_level int, aqi int, event_time timestamp"


def _micros(at: datetime | None) -> int | None:
    return None if at is None else (at - datetime(1970, 1, 1)) // timedelta(microseconds=1)


def _instant(micros: int | None) -> datetime | None:
    return None if micros is None else datetime(1970, 1, 1) + timedelta(microseconds=micros)


def _loaded(state: GroupState) -> State:
    if not state.exists:
        return State()
    level, candidate, seen, last, alerted_at, alerted_level = state.get
    return State(level, candidate, seen, _instant(last), _instant(alerted_at), alerted_level)


def station_alerts(index: DataFrame, rules: Rules = Rules(), timeouts: bool = False) -> DataFrame:  # noqa: B008
    """Alerts of each station as its index rows come in; state lives in the state store.

    A replayed batch repeats times that the state has seen, and the machine ignores those. With
    ``timeouts`` (long-running queries only) a station that stays silent becomes unknown.
    """

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        before, out = _loaded(state), []
        after = before
        if state.hasTimedOut:
            after, alert = expire(before, datetime.now(timezone.utc).replace(tzinfo=None), rules)
            out += [alert] if alert else []
        else:
            rows = pd.concat(list(frames)).sort_values("event_time", kind="stable")
            for r in rows.itertuples():
                after, alert = step(after, r.event_time.to_pydatetime(), None if pd.isna(r.station_aqi) else int(r.station_aqi), rules=rules)
                out += [alert] if alert else []
        state.update((after.level, after.candidate, after.seen, _micros(after.last), _micros(after.alerted_at), after.alerted_level))
        if timeouts:
            state.setTimeoutDuration(rules.stale_after * 1000 + 1)
        yield pd.DataFrame(
            [(key[0], a.kind, a.level, a.previous, a.aqi, pd.Timestamp(a.at)) for a in out],
            columns=[c.split()[0] for c in ALERTS.split(", ")],
        ).astype({"level": "Int32", "previous_level": "Int32", "aqi": "Int32", "event_time": "datetime64[ns]"})

    rows = index.select(F.col("location_id").cast("long").alias("location_id"), "event_time", F.col("station_aqi").cast("int").alias("station_aqi"))
    timeout = GroupStateTimeout.ProcessingTimeTimeout if timeouts else GroupStateTimeout.NoTimeout
    return rows.groupBy("location_id").applyInPandasWithState(update, ALERTS, _STATE, "append", timeout)


def station_trail(index: DataFrame, rules: Rules = Rules()) -> DataFrame:  # noqa: B008
    """The state of each station after every reading, as ``alerts.station_trail`` gives it in batch."""

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now, out = _loaded(state), []
        for r in pd.concat(list(frames)).sort_values("event_time", kind="stable").itertuples():
            if now.last is not None and r.event_time.to_pydatetime() <= now.last:
                continue  # a replayed reading
            aqi = None if pd.isna(r.station_aqi) else int(r.station_aqi)
            now, alert = step(now, r.event_time.to_pydatetime(), aqi, rules=rules)
            told = (alert.kind, alert.level, alert.previous) if alert else (None, None, None)
            out.append((key[0], r.event_time, aqi, r.dominant_pollutant, now.level, now.candidate, now.seen, *told))
        state.update((now.level, now.candidate, now.seen, _micros(now.last), _micros(now.alerted_at), now.alerted_level))
        yield pd.DataFrame(out, columns=[c.split()[0] for c in TRAIL.split(", ")]).astype(
            {c: "Int32" for c in ("station_aqi", "level", "candidate", "seen", "alert_level", "previous_level")} | {"event_time": "datetime64[ns]"}
        )

    rows = index.select(F.col("location_id").cast("long").alias("location_id"), "event_time", F.col("station_aqi").cast("int").alias("station_aqi"), "dominant_pollutant")
    return rows.groupBy("location_id").applyInPandasWithState(update, TRAIL, _STATE, "append", GroupStateTimeout.NoTimeout)


_REGION = "borough string, trigger_location_id long, level int, candidate int, seen int, last timestamp, alerted_at timestamp, alerted_level int"
_REGION_OUT = f"{_REGION}, alert_type string, alert_level int, previous_level int, aqi int, dominant_pollutant string"


def region_alerts(root: str, stations: DataFrame, rules: Rules = Rules()) -> Callable[[DataFrame, int], None]:  # noqa: B008
    """A ``foreachBatch`` sink of ``station_trail``: station status, region states, region alerts.

    Regions with a changed station are evaluated once per batch, at the batch's newest event time
    (not by the wall clock, so that a replay comes to the same). Alerts are kept once per id.
    """
    keep_status = keep_latest(f"{root}/station_status", "location_id", "event_time")
    keep_regions = keep_latest(f"{root}/region_status", "borough", "last")
    keep_alerts = keep_new(f"{root}/alerts", ["alert_id"])

    def fold(rows: pd.DataFrame) -> pd.DataFrame:
        first = rows.iloc[0]
        whole = lambda x: None if pd.isna(x) else int(x)
        time = lambda x: None if pd.isna(x) else x.to_pydatetime()
        state = State(whole(first.r_level) or 0, whole(first.candidate), whole(first.seen) or 0, time(first["last"]), time(first.alerted_at), whole(first.alerted_level))
        members = [Station(int(r.location_id), int(r.level), whole(r.station_aqi), r.dominant_pollutant, time(r.event_time)) for r in rows.itertuples()]
        seen = observe(members, state.level, time(first.moment), rules)
        columns = [c.split()[0] for c in _REGION_OUT.split(", ")]
        out = []
        if seen is not None and not seen.held_up:
            after, alert = step(state, seen.at, seen.aqi, seen.level, rules)
            if after is not state:
                told = (alert.kind, alert.level, alert.previous, alert.aqi) if alert else (None,) * 4
                out.append((first.borough, seen.location_id, after.level, after.candidate, after.seen, after.last, after.alerted_at, after.alerted_level, *told, seen.pollutant))
        frame = pd.DataFrame(out, columns=columns)
        kinds = {c: "Int32" for c in ("level", "candidate", "seen", "alerted_level", "alert_level", "previous_level", "aqi")}
        return frame.astype(kinds | {"trigger_location_id": "Int64", "last": "datetime64[ns]", "alerted_at": "datetime64[ns]"})

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        spark: SparkSession = batch.sparkSession
        state = F.struct("event_time", "station_aqi", "dominant_pollutant", "level")
        newest = batch.groupBy("location_id").agg(F.max_by(state, "event_time").alias("s")).select("location_id", "s.*")
        keep_status(newest, batch_id)
        known = stations.where("borough IS NOT NULL").select(F.col("location_id").cast("long").alias("location_id"), "borough")
        changed = batch.select("location_id", "event_time").join(known, "location_id").groupBy("borough").agg(F.max("event_time").alias("moment"))
        path = f"{root}/region_status"
        regions = spark.read.schema(_REGION).parquet(path) if tables.exists(spark, path) else spark.createDataFrame([], _REGION)
        rows = (
            spark.read.parquet(f"{root}/station_status").join(known, "location_id").join(changed, "borough")
            .join(regions.withColumnRenamed("level", "r_level").drop("trigger_location_id"), "borough", "left")
        )
        step_path = f"{root}/steps/{batch_id}"
        rows.groupBy("borough").applyInPandas(fold, _REGION_OUT).write.mode("overwrite").parquet(step_path)
        out = spark.read.schema(_REGION_OUT).parquet(step_path)
        keep_regions(out.select([c.split()[0] for c in _REGION.split(", ")]), batch_id)
        told = out.where("alert_type IS NOT NULL")
        name = level_label(F.col("alert_level"))
        keep_alerts(
            told.select(
                alert_id("region", F.col("borough"), F.col("last"), name).alias("alert_id"), F.lit("region").alias("scope"), "borough", "trigger_location_id", "aqi", name.alias("level"),
                level_label(F.col("previous_level")).alias("prev_level"), F.col("alert_type").alias("type"), "dominant_pollutant", F.col("last").alias("event_time"),
            ), batch_id,
        )

    return write


def keep_new(path: str, keys: list[str], at: str = "event_time") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink that appends rows whose key the table lacks; replays add nothing.

    The table is partitioned by the day of ``at``, which belongs to the key or follows from it, so a
    batch is held against its own days only. Of rows with one key in a batch the least stays.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        spark: SparkSession = batch.sparkSession
        rest = [F.col(c).asc() for c in batch.columns if c not in keys]
        once = silver.first_rows(batch, keys, *rest).withColumn("event_day", F.to_date(at))
        if tables.exists(spark, path):
            span = batch.agg(F.min(at).cast("date").alias("first"), F.max(at).cast("date").alias("last")).first()
            known = spark.read.parquet(path).where(F.col("event_day").isNull() | F.col("event_day").between(F.lit(span["first"]), F.lit(span["last"])))
            once = once.join(known.select(*keys), keys, "left_anti")
        once.write.mode("append").partitionBy("event_day").parquet(path)

    return write


def keep_latest(path: str, key: str, newer: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink that keeps one row per key, the newest; the table is swapped whole."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        spark: SparkSession = batch.sparkSession
        old = spark.read.parquet(path) if tables.exists(spark, path) else batch.limit(0)
        tables.replace_table(serving.upsert(old, batch, key, newer), path)

    return write


def hourly_windows(readings: DataFrame, stations: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Instant index by region and hour, each hour once when the watermark has passed it."""
    joined = readings.withWatermark("event_time", lateness).join(stations.select("location_id", "borough"), "location_id")
    windows = joined.groupBy("borough", F.window("event_time", "1 hour").alias("w")).agg(
        F.max("aqi_instant").alias("aqi_max"), F.avg("aqi_instant").alias("aqi_avg"), F.count("*").alias("n_readings")
    )
    return windows.select("borough", F.col("w.start").alias("bucket"), "aqi_max", "aqi_avg", "n_readings")


def station_index_batches(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink: readings of a batch to the station status table."""
    keep = keep_latest(path, "location_id", "event_time")

    def write(batch: DataFrame, batch_id: int) -> None:
        newest = F.max_by(F.struct("event_time", "station_aqi", "dominant_pollutant"), "event_time").alias("s")
        keep(gold.station_index(batch).groupBy("location_id").agg(newest).select("location_id", "s.*"), batch_id)

    return write


def with_sensors(path: str, write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink that reads the sensor table anew for each batch, then indexes the readings.

    New sensors count from the next batch on, without a restart or a cache to expire.
    """

    def enrich(batch: DataFrame, batch_id: int) -> None:
        write(indexed(batch, batch.sparkSession.read.parquet(path)), batch_id)

    return enrich
