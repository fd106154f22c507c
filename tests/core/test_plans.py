import json
import re
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from aeromill.operators import gold, ingest, serving, silver
from aeromill.plans import batch, reports
from aeromill.sources import events, rest, tables
from aeromill.streaming import queries

SF = "/root/testdata/sf0.001"


def plan(df):
    return reports.explain(df)


def test_no_python_in_facts_and_marts(spark):
    q = __spark_entry__.queries()
    for name in ("fact_hourly", "fact_daily", "mart_region_daily", "mart_temporal", "cluster_features", "region_stats", "silver_clean", "quality_funnel", "daily_stats"):
        if name in q:
            assert not re.search("EvalPython|InArrow|InPandas", plan(q[name](spark, SF))), name


def test_scans_read_only_what_is_needed(spark):
    text = plan(gold.fact_hourly(events.wide(spark, SF)))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in text
    assert "event_id" not in re.search(r"ReadSchema: (.*)", text)[1]


def test_temporal_mart_scans_once(spark):
    text = plan(gold.mart_temporal(gold.fact_hourly(events.wide(spark, SF)), events.dim(spark, SF)))
    assert text.count("events.parquet") <= 2 and "Expand" in text and "Union" not in text


def test_partition_filters_reach_the_listing(spark, tmp_path):
    rows = spark.createDataFrame([(date(2026, 1, d), d) for d in range(1, 9)], "date_local date, v int").withColumns({"year": F.lit(2026), "month": F.lit(1)})
    tables.overwrite_partitions(rows, f"{tmp_path}/silver", "year", "month", "date_local")
    got = tables.read_silver(spark, f"{tmp_path}/silver", date(2026, 1, 4), date(2026, 1, 5))
    assert sorted(r.v for r in got.collect()) == [3, 4, 5]
    assert "PartitionFilters: [isnotnull(date_local" in plan(got)
    tables.overwrite_partitions(rows.where("v = 4").withColumn("v", F.lit(40)), f"{tmp_path}/silver", "year", "month", "date_local")
    assert sorted(r.v for r in spark.read.parquet(f"{tmp_path}/silver").collect()) == [1, 2, 3, 5, 6, 7, 8, 40]
    tables.overwrite_days(rows.where("v = 7"), f"{tmp_path}/silver", date(2026, 1, 7), date(2026, 1, 8), "year", "month", "date_local")
    assert sorted(r.v for r in spark.read.parquet(f"{tmp_path}/silver").collect()) == [1, 2, 3, 5, 6, 7, 40]


def test_a_day_stays_if_its_rerun_fails(spark, tmp_path):
    rows = spark.createDataFrame([(date(2026, 1, d), d) for d in (1, 2)], "date_local date, v int")
    tables.overwrite_days(rows, f"{tmp_path}/t", date(2026, 1, 1), date(2026, 1, 2), "date_local")
    broken = rows.withColumn("v", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        tables.overwrite_days(broken, f"{tmp_path}/t", date(2026, 1, 1), date(2026, 1, 2), "date_local")
    assert sorted(r.v for r in spark.read.parquet(f"{tmp_path}/t").collect()) == [1, 2]
    tables.overwrite_days(rows.limit(0), f"{tmp_path}/t", date(2026, 1, 2), date(2026, 1, 2), "date_local")
    assert list(tables.days_in(spark, f"{tmp_path}/t")) == ["2026-01-01"]


def test_a_swap_that_breaks_off_is_settled(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.range(3).write.parquet(f"{path}.old")  # moved aside, and then the job was lost
    assert tables.exists(spark, path) and spark.read.parquet(path).count() == 3
    spark.range(5).write.parquet(f"{path}.old")  # the new table is in its place, the old one was not deleted yet
    tables.replace_table(spark.read.parquet(path).selectExpr("id + 1 AS id"), path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 2, 3] and not tables.exists(spark, f"{path}.old")


def test_no_aggregation_of_facts_sorts(spark):
    dense, dim = events.dense(spark, SF), events.dim(spark, SF)
    hourly = gold.fact_hourly(dense)
    daily = gold.fact_daily(hourly)
    summary = gold.daily_summary(daily, daily.selectExpr("location_id", "date_local", "1 AS cluster", "level AS cluster_name"), dim)
    plans = {
        "fact_hourly": hourly, "fact_daily": daily, "cluster_features": gold.cluster_features(hourly), "mart_region_daily": gold.mart_region_daily(daily, dim),
        "station_index": gold.station_index(dense.withColumn("aqi_instant", F.lit(5))), "dim_station": gold.dim_station(dense), "region_stats": gold.region_stats(summary),
        "silver_dedupe": silver.dedupe_latest(dense.withColumns({"ingested_at": F.lit("x"), "kafka_offset": F.col("event_id")})),
        "latest_per_key": silver.latest_per_key(dense.selectExpr("'k' AS key", "'{}' AS value", "1 AS partition", "event_id AS offset")),
    }
    for name, df in plans.items():
        assert "SortAggregate" not in plan(df), name
    assert "WindowGroupLimit" in plan(plans["silver_dedupe"])
    own = spark.createDataFrame(summary.limit(5).collect(), summary.schema)
    assert plan(gold.region_stats(own)).count("Scan ") == 2  # named in the tree and in the list below it: one scan


def test_regions_are_looked_up_per_sensor(spark):
    meta = spark.createDataFrame([(1, "pm25", "ug/m3", "A", 40.73, -73.82), (2, "pm25", "ug/m3", "B", 40.65, -73.95)], "sensor_id int, parameter string, units string, location_name string, lat double, lon double")
    rows = spark.createDataFrame([(1, None, None), (1, 40.85, -73.87), (2, 40.65, -73.95), (3, 40.65, -73.95), (4, None, None)], "sensor_id int, lat double, lon double")
    full = rows.selectExpr("*", "CAST(NULL AS string) AS parameter", "CAST(NULL AS string) AS units", "CAST(NULL AS string) AS location_name")
    got = sorted((r.sensor_id, r.borough or "") for r in silver.enrich(full, silver.placed(meta)).collect())
    assert got == [(1, "Bronx"), (1, "Queens"), (2, "Brooklyn"), (3, "Brooklyn"), (4, "")]


def test_replace_a_table_that_is_read(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.range(3).write.parquet(path)
    tables.replace_table(spark.read.parquet(path).selectExpr("id + 10 AS id"), path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [10, 11, 12]
    assert tables.exists(spark, path) and tables.total_bytes(spark, path) > 0 and tables.total_bytes(spark, f"{tmp_path}/none") == 0


def test_reports_are_saved(spark, tmp_path):
    facts = gold.fact_hourly(events.wide(spark, SF))
    result = reports.run("q2_borough_hour", fact_hourly=facts, dim_station=events.dim(spark, SF))
    reports.save(result, "q2", str(tmp_path))
    assert spark.read.option("header", True).csv(f"{tmp_path}/sql/q2").count() == result.count()
    assert "Physical Plan" in spark.read.text(f"{tmp_path}/plans/q2").first().value


def test_registry():
    found, oracles = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(oracles) <= set(found) and len(found) > 60


def test_wave(spark):
    rows = tables.wave(spark, 2, 10, spike_at=5)
    assert rows.count() == 20 and rows.where("value = 200.0").count() == 2 and rows.exceptAll(tables.wave(spark, 2, 10, spike_at=5)).count() == 0


def test_client(spark):
    pages = {1: [{"id": 1}, {"id": 2}], 2: [{"id": 3}]}
    asked, slept = [], []
    answers = iter([429, 503])

    def get(path, params):
        asked.append(params.get("page"))
        status = next(answers, 200)
        return status, {"Retry-After": "7"} if status == 429 else {}, json.dumps({"results": pages[params["page"]]}) if status == 200 else ""

    client = rest.Client(get, sleep=slept.append, clock=lambda: 0.0)
    assert [i["id"] for i in client.items("/locations", page_size=2)] == [1, 2, 3]
    assert asked == [1, 1, 1, 2] and 7.0 in slept and 2.0 in slept and slept.count(1.1) == 3
    with pytest.raises(OSError):
        rest.Client(lambda *_: (404, {}, ""), sleep=slept.append).fetch("/x")
    with pytest.raises(OSError):
        rest.Client(lambda *_: (500, {}, ""), retries=2, sleep=slept.append).fetch("/x")
    item = {"sensorsId": 7, "value": 1.5, "datetime": {"utc": "2026-01-01T00:00:00Z"}}
    assert ingest.measurements(rest.payloads(spark, iter([item]), 9, 40.7, -73.9), "now").first().location_id == 9


def test_fresh_sensors_for_each_batch(spark, tmp_path):
    now = datetime.now(timezone.utc).replace(microsecond=0, tzinfo=None)
    readings = spark.createDataFrame([(1, 5, 20.0, now), (2, 5, 30.0, now)], "sensor_id int, location_id int, value double, event_time timestamp")
    sensor = lambda *ids: spark.createDataFrame([(i, "pm25", "ug/m3") for i in ids], "sensor_id int, parameter string, units string")
    sink = queries.with_sensors(f"{tmp_path}/sensors", queries.keep_new(f"{tmp_path}/out", ["sensor_id", "event_time"]))
    sensor(1).write.parquet(f"{tmp_path}/sensors")
    sink(readings, 0)
    sensor(1, 2).write.mode("overwrite").parquet(f"{tmp_path}/sensors")
    sink(readings, 1)
    assert sorted((r.sensor_id, r.aqi_instant) for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [(1, 71), (2, 90)]


def test_new_rows_are_held_against_their_own_days(spark, tmp_path):
    path = f"{tmp_path}/t"
    rows = [(1, datetime(2026, 1, d, 5), v) for d in (1, 2, 3) for v in ("b", "a")]
    batch_ = spark.createDataFrame(rows, "k int, event_time timestamp, v string")
    sink = queries.keep_new(path, ["k", "event_time"])
    sink(batch_, 0)
    sink(batch_.withColumn("v", F.lit("0")), 0)  # a replay with other values
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == ["a", "a", "a"]
    sink(spark.createDataFrame([(1, datetime(2026, 1, 3, 5), "c"), (2, datetime(2026, 1, 3, 5), "c")], "k int, event_time timestamp, v string"), 1)
    assert spark.read.parquet(path).count() == 4 and len(list((tmp_path / "t").glob("event_day=*"))) == 3


def test_two_streams_over_one_source_late_rows_and_a_restart(spark, tmp_path):
    def message(sensor, hour, minute=0):
        at = f"2026-01-01T{hour:02d}:{minute:02d}:00Z"
        value = json.dumps({"sensor_id": sensor, "location_id": 1, "value": 5.0, "datetime_utc": at, "ingested_at": at})
        return (value, "t", 0, sensor * 100 + hour, at)

    def land(rows, name):
        spark.createDataFrame(rows, silver.BRONZE).coalesce(1).write.mode("append").json(f"{tmp_path}/in")

    def both():
        source = tables.stream_files(spark, f"{tmp_path}/in", silver.BRONZE)
        raw = queries.land_raw(source.withColumn("timestamp", F.col("timestamp").cast("timestamp")), f"{tmp_path}/raw", f"{tmp_path}/check-raw", None)
        kept = queries.start(queries.deduped(source).writeStream.foreachBatch(queries.keep_new(f"{tmp_path}/kept", ["sensor_id", "event_time"])), f"{tmp_path}/check-kept", None)
        raw.awaitTermination()
        kept.awaitTermination()

    land([message(1, 1), message(1, 2), message(1, 2)], "a")
    both()
    land([message(1, 12)], "b")
    both()  # the watermark is at 10 o'clock from the next batch on
    land([message(2, 3), message(2, 11), message(1, 12)], "c")  # too late, late in time, a repeat
    both()
    got = sorted((r.sensor_id, r.event_time.hour) for r in spark.read.parquet(f"{tmp_path}/kept").collect())
    assert got == [(1, 1), (1, 2), (1, 12), (2, 11)]
    assert tables.read_raw(spark, f"{tmp_path}/raw").count() == 7


def test_region_levels(spark):
    status = spark.createDataFrame([("Queens", 3, datetime(2026, 1, 1)), ("Bronx", 0, None)], "borough string, level int, last timestamp")
    assert [(r.borough, r.level) for r in serving.region_levels(status).collect()] == [("Bronx", 0), ("Queens", 3)]
    assert batch.main.__doc__
