"""Registered queries: every operator applied to the test tables, with SQL oracles.

Times leave as text and means are rounded, so that results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aeromill.functions import geo, quality, timeparts
from aeromill.functions.index import air_index, in_unit, level_label, level_number, unit_key
from aeromill.operators import alerts, clusters, gold, ingest, serving, silver, stats
from aeromill.plans import oracle as o
from aeromill.plans import reports
from aeromill.plans.registry import ORACLES, QUERIES
from aeromill.sources import events as e
from aeromill.sources import tables
from aeromill.streaming import runs

#: "Now" of the serving queries.
NOW = datetime(2024, 1, 30, 12)
NOW_SQL = "TIMESTAMP '2024-01-30 12:00:00'"


def query(sql: str | None = None) -> Callable:
    """Register a function under its own name."""

    def add(fn: Callable[[SparkSession, str], DataFrame]) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return as_text(fn(spark, sf_dir))

        QUERIES[fn.__name__] = run
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def as_text(df: DataFrame) -> DataFrame:
    kinds = {"timestamp": "yyyy-MM-dd HH:mm:ss", "date": "yyyy-MM-dd"}
    return df.select(*[F.date_format(c, kinds[t]).alias(c) if t in kinds else F.col(c) for c, t in df.dtypes])


def now() -> Column:
    return F.lit(NOW).cast("timestamp")


def index_of(value: str = "value") -> Column:
    return air_index(F.col("parameter"), F.col(value), F.col("units"))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fact_hourly(e.dense(spark, sf_dir))


def wide_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fact_hourly(e.wide(spark, sf_dir))


def dense_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_station(e.dense(spark, sf_dir))


def rounded(df: DataFrame, *columns: str, places: int = 10) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


# ---- scalar functions


@query(f"WITH {o.WIDE_CTE} SELECT event_id, {o.air_index('parameter', 'value', 'units')} AS idx FROM wide")
def index_instant(spark, d):
    return e.wide(spark, d).select("event_id", index_of().alias("idx"))


@query(
    f"WITH {o.DENSE} SELECT event_id, {o.air_index('parameter', 'value * 3', 'units', '8h')} AS idx_8h, {o.air_index('parameter', 'value * 3', 'units', '1h')} AS idx_1h,"
    f" {o.air_index('parameter', 'value * 3', 'units')} AS idx FROM dense"
)
def index_averaging(spark, d):
    rows = e.dense(spark, d).withColumn("v", F.col("value") * 3)
    return rows.select("event_id", *[air_index(F.col("parameter"), F.col("v"), F.col("units"), a).alias(n) for a, n in (("8h", "idx_8h"), ("1h", "idx_1h"), ("instant", "idx"))])


@query(
    f"WITH {o.WIDE_CTE}, i AS (SELECT {o.air_index('parameter', 'value', 'units')} AS idx FROM wide) "
    f"SELECT CAST({o.level_number('idx')} AS INTEGER) AS level, {o.level_label(o.level_number('idx'))} AS name, count(*) AS n, min(idx) AS lo, max(idx) AS hi FROM i GROUP BY ALL"
)
def index_levels(spark, d):
    rows = e.wide(spark, d).select(index_of().alias("idx"))
    level = level_number(F.col("idx"))
    return rows.groupBy(level.alias("level"), level_label(level).alias("name")).agg(F.count("*").alias("n"), F.min("idx").alias("lo"), F.max("idx").alias("hi"))


_UNITS = ["ppm", "PPB", "µg/m³", "μg/m3", " mg / m3 ", "", "furlong"]


@query(
    "WITH u AS (SELECT event_id, value, [" + ", ".join(f"'{u}'" for u in _UNITS) + "][event_id % 7 + 1] AS units FROM events) "
    f"SELECT event_id, {o.unit_key('units')} AS unit, round({o.in_unit('value', 'units', 'o3', 'ppm')}, 12) AS o3_ppm, round({o.in_unit('value', 'units', 'no2', 'ppb')}, 6) AS no2_ppb,"
    f" round({o.in_unit('value', 'units', 'pm25', 'ug/m3')}, 10) AS pm25_mass FROM u"
)
def unit_convert(spark, d):
    units = F.element_at(F.array(*[F.lit(u) for u in _UNITS]), (F.col("event_id") % 7 + 1).cast("int"))
    rows = e.table(spark, d, "events").select("event_id", "value", units.alias("units"))
    v, u = F.col("value"), F.col("units")
    return rows.select(
        "event_id", unit_key(u).alias("unit"), F.round(in_unit(v, u, "o3", "ppm"), 12).alias("o3_ppm"), F.round(in_unit(v, u, "no2", "ppb"), 6).alias("no2_ppb"),
        F.round(in_unit(v, u, "pm25", "ug/m3"), 10).alias("pm25_mass"),
    )


@query(f"WITH {o.DEFECTIVE} SELECT parameter, units, round(max({o.limit('parameter', 'units', 2)}), 10) AS threshold, count(*) FILTER (WHERE value > {o.limit('parameter', 'units', 2)}) AS n_over FROM defective GROUP BY ALL")
def thresholds(spark, d):
    p, u, v = F.col("parameter"), F.col("units"), F.col("value")
    return e.defective(spark, d).groupBy("parameter", "units").agg(F.round(F.max(quality.threshold(p, u)), 10).alias("threshold"), F.count_if(quality.exceeds(p, u, v)).alias("n_over"))


@query(
    f"SELECT event_id, {o.day(o.local('ts'))} AS day, CAST(hour({o.local('ts')}) AS INTEGER) AS hour, CAST(dayofweek({o.local('ts')}) + 1 AS INTEGER) AS dow,"
    f" strftime({o.local('ts')}, '%Y') || '-' || CASE WHEN month({o.local('ts')}) IN (12, 1, 2) THEN 'winter' WHEN month({o.local('ts')}) < 6 THEN 'spring' WHEN month({o.local('ts')}) < 9 THEN 'summer' ELSE 'autumn' END AS season FROM events"
)
def local_time(spark, d):
    wall = timeparts.local(F.col("ts").cast("timestamp"))
    rows = e.table(spark, d, "events").select("event_id", wall.alias("w"))
    return rows.select("event_id", F.date_format("w", "yyyy-MM-dd").alias("day"), F.hour("w").alias("hour"), F.dayofweek("w").alias("dow"), timeparts.period(F.col("w"), "season").alias("season"))


_POINT = "SELECT event_id, 40.45::DOUBLE + (event_id % 53) / 100.0::DOUBLE AS lat, -74.28::DOUBLE + (event_id % 61) / 100.0::DOUBLE AS lon FROM events"


@query(f"SELECT event_id, {o.region('lat', 'lon')} AS borough, lat BETWEEN 40.48 AND 40.93 AND lon BETWEEN -74.27 AND -73.68 AS in_box FROM ({_POINT})")
def region_lookup(spark, d):
    i = F.col("event_id")
    points = e.table(spark, d, "events").select("event_id", (40.45 + i % 53 / 100).alias("lat"), (-74.28 + i % 61 / 100).alias("lon"))
    return geo.with_region(points).select("event_id", "borough", geo.in_box(F.col("lat"), F.col("lon")).alias("in_box"))


# ---- raw to clean


@query(
    f"WITH {o.DEFECTIVE} SELECT sensor_id, location_id, round(value, 10) AS value, strftime(date_trunc('hour', event_time), '%Y-%m-%dT%H:%M:%SZ') AS datetime_utc, source, event_id AS kafka_offset"
    " FROM defective WHERE event_id % 61 <> 0 AND event_id % 59 <> 0"
)
def bronze_parse(spark, d):
    return rounded(silver.parse(e.messages(spark, d)), "value").select("sensor_id", "location_id", "value", "datetime_utc", "source", "kafka_offset")


@query(f"SELECT {o.day('ts')} AS ingest_date, count(*) AS n, CAST(min(event_id) AS BIGINT) AS first_offset FROM events GROUP BY ALL")
def bronze_partitions(spark, d):
    return silver.raw_rows(e.messages(spark, d)).groupBy("ingest_date").agg(F.count("*").alias("n"), F.min("offset").alias("first_offset"))


@query(
    f"WITH {o.DEFECTIVE}, f AS (SELECT {o.flag('parameter', 'units', 'value', 'event_time', 'CASE WHEN source <> ' + repr('openaq-archive') + ' THEN ingested_at END')} AS quality_flag FROM defective)"
    " SELECT quality_flag, count(*) AS n, quality_flag NOT IN ('NO_METADATA', 'NEGATIVE', 'OUT_OF_RANGE') AS kept FROM f GROUP BY ALL"
)
def quality_funnel(spark, d):
    rows = silver.flagged(e.defective(spark, d))
    return rows.groupBy("quality_flag").agg(F.count("*").alias("n")).withColumn("kept", ~F.col("quality_flag").isin(*quality.DROPPED))


@query(f"WITH {o.DEFECTIVE} SELECT event_id, {o.flag('parameter', 'units', 'value', 'event_time', NOW_SQL)} AS quality_flag FROM defective")
def quality_flags_now(spark, d):
    return silver.flagged(e.defective(spark, d), now()).select("event_id", "quality_flag")


_DEDUPED = """deduped AS (
  SELECT sensor_id, date_trunc('hour', event_time) AS hour, max({'a': strftime(ingested_at, '%Y-%m-%dT%H:%M:%SZ'), 'o': event_id}) AS last, count(*) AS n FROM defective GROUP BY ALL)"""


@query(f"WITH {o.DEFECTIVE}, {_DEDUPED} SELECT sensor_id, {o.text('hour')} AS event_time, last.o AS kafka_offset FROM deduped")
def silver_dedupe(spark, d):
    rows = e.defective(spark, d).withColumns(
        {"event_time": F.date_trunc("hour", "event_time"), "ingested_at": timeparts.wire(F.col("ingested_at")), "kafka_offset": F.col("event_id")}
    )
    return silver.dedupe_latest(rows).select("sensor_id", "event_time", "kafka_offset")


_SILVER = f"""{o.DEFECTIVE}, {o.SENSORS}, parsed AS (
  SELECT r.sensor_id, r.location_id, r.value, date_trunc('hour', r.event_time) AS event_time, date_trunc('second', r.ingested_at) AS ingested_at, r.source, r.event_id, s.parameter, s.units, s.location_name, s.lat, s.lon
  FROM defective r LEFT JOIN sensors s USING (sensor_id) WHERE r.event_id % 61 <> 0 AND r.event_id % 59 <> 0
), flagged AS (
  SELECT *, {o.flag('parameter', 'units', 'value', 'event_time', 'CASE WHEN source <> ' + repr('openaq-archive') + ' THEN ingested_at END')} AS quality_flag,
    CAST({o.local('event_time')} AS DATE) AS date_local, CAST(hour({o.local('event_time')}) AS INTEGER) AS hour_local
  FROM parsed WHERE lat BETWEEN 40.48 AND 40.93 AND lon BETWEEN -74.27 AND -73.68
), kept AS (
  SELECT *, row_number() OVER (PARTITION BY sensor_id, event_time ORDER BY ingested_at DESC, event_id DESC) AS rn FROM flagged
  WHERE date_local BETWEEN DATE '2024-01-03' AND DATE '2024-01-20' AND quality_flag NOT IN ('NO_METADATA', 'NEGATIVE', 'OUT_OF_RANGE'))"""


@query(
    f"WITH {_SILVER} SELECT sensor_id, location_id, location_name, parameter, units, round(value, 10) AS value, {o.text('event_time')} AS event_time, {o.day('date_local')} AS date_local, hour_local,"
    f" {o.region('lat', 'lon')} AS borough, quality_flag, source, CAST(year(date_local) AS INTEGER) AS year, CAST(month(date_local) AS INTEGER) AS month FROM kept WHERE rn = 1"
)
def silver_clean(spark, d):
    rows = silver.clean(silver.parse(e.messages(spark, d)), e.sensors(spark, d), day_from=date(2024, 1, 3), day_to=date(2024, 1, 20))
    return rounded(rows, "value").drop("lat", "lon", "datetime_utc", "datetime_local", "ingested_at")


@query(f"WITH {o.DEFECTIVE}, {o.SENSORS} SELECT sensor_id, parameter, units FROM sensors UNION ALL SELECT sensor_id, min(parameter), min(units) FROM wide WHERE sensor_id % 13 = 0 GROUP BY sensor_id")
def sensor_lookup(spark, d):
    return silver.sensor_lookup(e.sensors(spark, d), e.wide(spark, d))


def _changes(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("event_id")
    value = F.to_json(F.struct(F.col("user_id").cast("int").alias("sensor_id"), F.col("event_type").alias("parameter")))
    return e.table(spark, d, "events").select(F.col("user_id").cast("string").alias("key"), F.when(i % 5 != 0, value).alias("value"), (i % 3).alias("partition"), i.alias("offset"))


@query("SELECT CAST(user_id AS INTEGER) AS sensor_id, last.t AS parameter FROM (SELECT user_id, max({'p': event_id % 3, 'o': event_id, 't': event_type}) AS last FROM events GROUP BY user_id) WHERE last.o % 5 <> 0")
def latest_per_key(spark, d):
    return silver.latest_per_key(_changes(spark, d)).select("sensor_id", "parameter")


# ---- facts, marts, features


@query(f"WITH {o.DENSE}, {o.hourly('dense')} SELECT location_id, parameter, {o.text('hour_utc')} AS hour_utc, round(value_avg, 10) AS value_avg, n_readings, units, {o.day('date_local')} AS date_local, hour_local, aqi_hourly FROM fact_hourly")
def fact_hourly(spark, d):
    return rounded(hourly(spark, d), "value_avg")


@query(f"WITH {o.DENSE}, {o.hourly('dense')}, {o.ROLLED} SELECT location_id, parameter, {o.text('hour_utc')} AS hour_utc, n_8h, round(avg_8h, 10) AS avg_8h FROM rolled")
def rolling_8h(spark, d):
    return rounded(gold.rolling_8h(hourly(spark, d)), "avg_8h").select("location_id", "parameter", "hour_utc", "n_8h", "avg_8h")


@query(f"WITH {o.DENSE}, {o.hourly('dense')}, {o.DAILY} SELECT location_id, {o.day('date_local')} AS date_local, parameter, n_hours, param_aqi FROM param_daily WHERE param_aqi IS NOT NULL")
def parameter_daily(spark, d):
    return gold.parameter_daily(hourly(spark, d)).select("location_id", "date_local", "parameter", "n_hours", "param_aqi")


@query(f"WITH {o.DENSE}, {o.hourly('dense')}, {o.DAILY} SELECT location_id, {o.day('date_local')} AS date_local, dominant_pollutant, aqi_daily, level FROM fact_daily")
def fact_daily(spark, d):
    return gold.fact_daily(hourly(spark, d))


@query(
    f"WITH {o.DENSE} SELECT location_id, max_by(location_name, event_time) AS name, max_by(borough, event_time) AS borough, array_to_string(list_sort(list(DISTINCT parameter)), ',') AS parameters FROM dense GROUP BY location_id"
)
def dim_station(spark, d):
    return dense_dim(spark, d).select("location_id", "name", "borough", F.array_join("parameters", ",").alias("parameters"))


@query(
    f"WITH {o.DENSE}, {o.DIM} SELECT coalesce(n.location_id, s.location_id) AS location_id, CASE WHEN n.location_id IS NOT NULL THEN n.name ELSE s.name END AS name,"
    " CASE WHEN n.location_id IS NULL THEN 'co' ELSE 'co,o3,pm25' END AS parameters FROM dim_station s FULL JOIN (SELECT DISTINCT location_id, location_name AS name FROM dense) n USING (location_id)"
)
def dim_merge(spark, d):
    old = e.dim(spark, d).withColumn("parameters", F.array(F.lit("co")))
    return gold.merge_dim(dense_dim(spark, d), old).select("location_id", "name", F.array_join("parameters", ",").alias("parameters"))


_REGION_DAILY = f"WITH {o.DENSE}, {o.hourly('dense')}, {o.DAILY}, dim_station AS (SELECT DISTINCT location_id, borough FROM dense)"


@query(
    f"{_REGION_DAILY} SELECT borough, {o.day('date_local')} AS date_local, max(aqi_daily) AS aqi_max, round(avg(aqi_daily), 10) AS aqi_avg, count(DISTINCT location_id) AS n_stations,"
    " count(*) FILTER (WHERE aqi_daily >= 101) AS n_stations_usg FROM fact_daily JOIN dim_station USING (location_id) WHERE borough IS NOT NULL GROUP BY ALL"
)
def mart_region_daily(spark, d):
    return rounded(gold.mart_region_daily(gold.fact_daily(hourly(spark, d)), dense_dim(spark, d)), "aqi_avg")


@query(f"WITH {o.WIDE_CTE}, {o.hourly('wide')}, {o.STATION_HOURLY} SELECT location_id, {o.text('hour_utc')} AS hour_utc, {o.day('date_local')} AS date_local, hour_local, aqi, aqi_pm25, aqi_o3 FROM station_hourly")
def station_hourly(spark, d):
    return gold.station_hourly(wide_hourly(spark, d))


@query(
    f"WITH {o.WIDE_CTE}, {o.DIM}, {o.hourly('wide')}, {o.STATION_HOURLY}, j AS (SELECT * FROM station_hourly JOIN dim_station USING (location_id) WHERE borough IS NOT NULL), g AS ("
    "SELECT borough, 'hour_local' AS grain, hour_local AS bucket, aqi FROM j UNION ALL SELECT borough, 'dow', CAST(dayofweek(date_local) + 1 AS INTEGER), aqi FROM j"
    " UNION ALL SELECT borough, 'month', CAST(month(date_local) AS INTEGER), aqi FROM j)"
    " SELECT borough, grain, bucket, round(avg(aqi), 10) AS aqi_avg, count(*) FILTER (WHERE aqi > 100) AS hours_over_100, count(aqi) AS n_station_hours FROM g GROUP BY ALL"
)
def mart_temporal(spark, d):
    return rounded(gold.mart_temporal(wide_hourly(spark, d), e.dim(spark, d)), "aqi_avg")


@query(
    f"WITH {o.DENSE}, {o.hourly('dense')}, {o.STATION_HOURLY}, f AS (SELECT location_id, date_local, count(aqi) AS n_hours, avg(aqi) AS aqi_mean, max(aqi) AS aqi_max, count(*) FILTER (WHERE aqi > 100) AS hours_over_100,"
    " min({'low': -aqi, 'h': hour_local}).h AS peak_hour, coalesce(avg(aqi_pm25), 0) AS dust, coalesce(avg(aqi_o3), 0) AS ozone FROM station_hourly GROUP BY ALL)"
    f" SELECT location_id, {o.day('date_local')} AS date_local, round(aqi_mean, 10) AS aqi_mean, aqi_max, hours_over_100, peak_hour, round(dust / (dust + ozone), 10) AS pm25_o3_ratio, n_hours FROM f WHERE n_hours >= 18 AND dust + ozone > 0"
)
def cluster_features(spark, d):
    return rounded(gold.cluster_features(hourly(spark, d)), "aqi_mean", "pm25_o3_ratio")


def _summary(spark: SparkSession, d: str) -> DataFrame:
    """Daily facts with a cluster by level, so that the result does not hang on a fitted model."""
    daily = gold.fact_daily(hourly(spark, d))
    by_level = daily.where("aqi_daily % 5 <> 0").select("location_id", "date_local", level_number(F.col("aqi_daily")).alias("cluster"), F.lower("level").alias("cluster_name"))
    return gold.daily_summary(daily, by_level, dense_dim(spark, d))


_SUMMARY = (
    f"{_REGION_DAILY}, summary AS (SELECT location_id, date_local, borough, aqi_daily, dominant_pollutant, level, CASE WHEN aqi_daily % 5 <> 0 THEN {o.level_number('aqi_daily')} END AS cluster,"
    " CASE WHEN aqi_daily % 5 <> 0 THEN lower(level) END AS cluster_name FROM fact_daily JOIN dim_station USING (location_id))"
)
_PERIODS = f"""{_SUMMARY}, periods AS (
  SELECT s.*, p.period_type, CASE p.period_type WHEN 'year' THEN strftime(date_local, '%Y') WHEN 'month' THEN strftime(date_local, '%Y-%m')
    ELSE strftime(date_local, '%Y') || '-' || CASE WHEN month(date_local) IN (12, 1, 2) THEN 'winter' WHEN month(date_local) < 6 THEN 'spring' WHEN month(date_local) < 9 THEN 'summer' ELSE 'autumn' END END AS period
  FROM summary s CROSS JOIN (VALUES ('year'), ('season'), ('month')) p(period_type) WHERE borough IS NOT NULL
), counted AS (SELECT borough, period_type, period, cluster_name, count(*) AS n FROM periods WHERE cluster_name IS NOT NULL GROUP BY borough, period_type, period, cluster_name
), shares AS (
  SELECT borough, period_type, period, cluster_name, round(CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY borough, period_type, period), 4) AS share FROM counted)"""


@query(f"{_SUMMARY} SELECT location_id, {o.day('date_local')} AS date_local, borough, aqi_daily, dominant_pollutant, level, CAST(cluster AS INTEGER) AS cluster, cluster_name FROM summary")
def daily_summary(spark, d):
    return _summary(spark, d)


@query(
    f"{_PERIODS} SELECT borough, period_type, period, count(*) AS n_station_days, round(avg(aqi_daily), 10) AS aqi_avg, max(aqi_daily) AS aqi_max, count(DISTINCT date_local) FILTER (WHERE aqi_daily > 100) AS days_over_100 FROM periods GROUP BY ALL"
)
def region_stats(spark, d):
    return rounded(gold.region_stats(_summary(spark, d)), "aqi_avg").drop("cluster_distribution")


@query(f"{_PERIODS} SELECT borough, period_type, period, cluster_name, share FROM shares")
def cluster_distribution(spark, d):
    stats_ = gold.region_stats(_summary(spark, d))
    shares = F.explode(F.from_json("cluster_distribution", "map<string,double>"))
    return stats_.select("borough", "period_type", "period", shares.alias("cluster_name", "share"))


@query(
    f"WITH {o.WIDE_CTE}, {o.DIM}, {o.STATUS} SELECT borough, {o.text(chr(34) + 'bucket' + chr(34))} AS bucket, aqi_max, aqi_avg, n_readings FROM (SELECT borough, date_trunc('hour', event_time) AS bucket, max(aqi_instant) AS aqi_max, round(avg(aqi_instant), 10) AS aqi_avg, count(*) AS n_readings"
    " FROM indexed JOIN dim_station USING (location_id) GROUP BY ALL)"
)
def hourly_by_region(spark, d):
    return rounded(gold.hourly_by_region(e.wide(spark, d).withColumn("aqi_instant", index_of()), e.dim(spark, d)), "aqi_avg")


# ---- SQL reports


_REPORT_FACTS = f"{o.DENSE}, dim_station AS (SELECT DISTINCT location_id, borough FROM dense), {o.hourly('dense')}, {o.DAILY}, known AS (SELECT * FROM fact_daily JOIN dim_station USING (location_id) WHERE borough IS NOT NULL)"


def _daily_views(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """Daily reports read the dense view, as its days are complete."""
    return {"fact_daily": gold.fact_daily(hourly(spark, d)), "dim_station": dense_dim(spark, d)}


@query(
    f"WITH {_REPORT_FACTS}, days AS (SELECT borough, date_local, max(aqi_daily) AS worst FROM known GROUP BY ALL), counted AS (SELECT year(date_local) AS y, borough, count(*) AS bad_days FROM days WHERE worst > 100 GROUP BY ALL)"
    " SELECT CAST(c.y AS INTEGER) AS year, c.borough, c.bad_days, CAST(1 + (SELECT count(*) FROM counted x WHERE x.y = c.y AND x.bad_days > c.bad_days) AS INTEGER) AS rank FROM counted c"
)
def q1_bad_days_rank(spark, d):
    return reports.run("q1_bad_days_rank", **_daily_views(spark, d))


@query(
    f"WITH {o.WIDE_CTE}, {o.DIM}, {o.hourly('wide')}, {o.STATION_HOURLY} SELECT borough, hour_local, round(sum(aqi) / count(aqi), 1) AS aqi_avg, count(*) AS n_station_hours"
    " FROM station_hourly JOIN dim_station USING (location_id) WHERE borough IS NOT NULL GROUP BY borough, hour_local"
)
def q2_borough_hour(spark, d):
    return reports.run("q2_borough_hour", fact_hourly=wide_hourly(spark, d), dim_station=e.dim(spark, d))


@query(
    f"WITH {_REPORT_FACTS} SELECT borough, CAST(month(date_local) AS INTEGER) AS month, round(avg(aqi_daily), 1) AS aqi_avg, count(*) FILTER (WHERE aqi_daily > 100) AS station_days_over_100 FROM known GROUP BY ALL"
)
def q2_borough_month(spark, d):
    return reports.run("q2_borough_month", **_daily_views(spark, d))


@query(
    f"WITH {_REPORT_FACTS} SELECT {o.day('date_local')} AS date_local, count(*) AS n_stations, count(*) FILTER (WHERE aqi_daily >= 101) AS n_usg, round(avg(CASE WHEN aqi_daily >= 101 THEN 1.0::DOUBLE ELSE 0 END), 3) AS share_usg"
    " FROM known GROUP BY known.date_local HAVING avg(CASE WHEN aqi_daily >= 101 THEN 1.0::DOUBLE ELSE 0 END) >= 0.5"
)
def q3_widespread_days(spark, d):
    return reports.run("q3_widespread_days", **_daily_views(spark, d))


@query(f"WITH {_REPORT_FACTS} SELECT borough, level, count(*) AS n FROM known GROUP BY ALL")
def sql_over_views(spark, d):
    return reports.sql(spark, "SELECT borough, level, count(*) AS n FROM fact_daily JOIN dim_station USING (location_id) WHERE borough IS NOT NULL GROUP BY borough, level", **_daily_views(spark, d))


# ---- statistics twice


_STATS = f"""WITH {o.DENSE}, days AS (SELECT *, CAST({o.local('event_time')} AS DATE) AS date_local FROM dense), stats AS (
  SELECT location_id, parameter, date_local, count(value) AS count, sum(value) AS sum, max(value) AS max, avg(value) AS avg, count(*) FILTER (WHERE value > {o.limit('parameter', 'units', 2)}) AS hours_over_threshold
  FROM days GROUP BY location_id, parameter, date_local)"""


def _days(spark: SparkSession, d: str) -> DataFrame:
    return e.dense(spark, d).withColumn("date_local", F.to_date(timeparts.local(F.col("event_time"))))


@query(f"{_STATS} SELECT location_id, parameter, {o.day('date_local')} AS date_local, count, round(sum, 8) AS sum, round(max, 10) AS max, round(avg, 10) AS avg, hours_over_threshold FROM stats")
def daily_stats(spark, d):
    return rounded(rounded(stats.daily_stats(_days(spark, d)), "max", "avg"), "sum", places=8)


@query(
    f"{_STATS} SELECT count(*) AS total_keys, count(*) FILTER (WHERE location_id <> 4) AS matched_keys, count(*) FILTER (WHERE location_id = 4) AS left_only, 0 AS right_only,"
    " count(*) FILTER (WHERE location_id = 2) AS value_mismatches, 'FAIL' AS status FROM stats"
)
def cross_validate(spark, d):
    ours = as_text(stats.daily_stats(_days(spark, d)))
    key = F.to_json(F.array(F.col("location_id").cast("string"), "parameter", "date_local"))
    off = F.when(F.col("location_id") == 2, 1.0).otherwise(0.0)
    value = F.to_json(F.struct("count", (F.col("sum") + off).alias("sum"), "max", "avg", "hours_over_threshold"))
    lines = ours.where("location_id <> 4").select(F.concat(key, F.lit("\t"), value).alias("value"))
    report = stats.comparison_report(ours, stats.parse_stats_lines(lines))
    return report.select("total_keys", "matched_keys", "left_only", F.col("right_only").cast("int").alias("right_only"), "value_mismatches", "status")


def _lines(spark: SparkSession, d: str) -> DataFrame:
    """The messages as raw lines, as they lie in files."""
    return e.messages(spark, d).select(F.to_json(F.struct("value", "topic", "partition", "offset")).alias("value"))


_RAW_STATS = f"""WITH {_SILVER}, stats AS (
  SELECT location_id, parameter, date_local, count(*) AS count, sum(value) AS sum, max(value) AS max, avg(value) AS avg, count(*) FILTER (WHERE value > {o.limit('parameter', 'units', 2)}) AS hours_over_threshold
  FROM kept WHERE rn = 1 GROUP BY ALL)"""
_FIRST, _LAST = date(2024, 1, 3), date(2024, 1, 20)


@query(f"{_RAW_STATS} SELECT location_id, parameter, {o.day('date_local')} AS date_local, count, round(sum, 8) AS sum, round(max, 10) AS max, round(avg, 10) AS avg, hours_over_threshold FROM stats")
def daily_stats_raw(spark, d):
    found = stats.daily_stats_raw(_lines(spark, d), e.sensors(spark, d), _FIRST, _LAST)
    return rounded(rounded(found, "max", "avg"), "sum", places=8)


@query(f"{_RAW_STATS} SELECT count(*) AS total_keys, count(*) AS matched_keys, 0 AS left_only, 0 AS right_only, 0 AS value_mismatches, 'PASS' AS status FROM stats")
def cross_validate_raw(spark, d):
    """Statistics of clean readings against those from raw lines, through their text form."""
    clean = silver.clean(silver.parse(e.messages(spark, d)), e.sensors(spark, d), day_from=_FIRST, day_to=_LAST)
    other = stats.parse_stats_lines(stats.stats_lines(stats.daily_stats_raw(_lines(spark, d), e.sensors(spark, d), _FIRST, _LAST)))
    report = stats.comparison_report(as_text(stats.daily_stats(clean)), other)
    return report.select("total_keys", "matched_keys", *[F.col(c).cast("int").alias(c) for c in ("left_only", "right_only", "value_mismatches")], "status")


@query(f"{_STATS} SELECT location_id, parameter, {o.day('date_local')} AS date_local FROM stats WHERE location_id = 3 ORDER BY 1, 2, 3 LIMIT 20")
def mismatch_sample(spark, d):
    ours = as_text(stats.daily_stats(_days(spark, d)))
    return stats.sample_mismatches(ours, ours.where("location_id <> 3")).select(*stats.KEYS)


# ---- ingestion


_BAD = "CASE event_id % 11 WHEN 1 THEN 'missing_sensor_id' WHEN 2 THEN 'invalid_sensor_id' WHEN 3 THEN 'missing_value' WHEN 4 THEN 'value_not_numeric' WHEN 5 THEN 'missing_datetime_utc' WHEN 6 THEN 'invalid_datetime_utc' WHEN 7 THEN 'not_an_object' WHEN 9 THEN 'invalid_lat' WHEN 10 THEN 'invalid_lon' END"


def _items(spark: SparkSession, d: str) -> DataFrame:
    """Result items with one defect in nine of eleven."""
    i = F.col("event_id")
    k = i % 11
    at = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    payload = F.to_json(
        F.struct(
            F.struct(F.when(k != 5, F.when(k == 6, F.regexp_replace(at, "Z", "")).otherwise(at)).alias("utc")).alias("datetime"),
            F.when(k != 3, F.when(k == 4, "n/a").otherwise(F.col("value").cast("string"))).alias("value"),
            F.when(k != 1, F.when(k == 2, "x7").otherwise(F.col("user_id").cast("string"))).alias("sensorsId"),
            F.struct(F.when(k == 9, "north").alias("latitude"), F.when(k == 10, "west").otherwise("-73.9").alias("longitude")).alias("coordinates"),
        )
    )
    return e.table(spark, d, "events").select(F.when(k == 7, "[1]").otherwise(payload).alias("payload"), F.lit(77).alias("location_id"), F.lit(40.7).alias("lat"), F.lit(-73.9).alias("lon"))


@query(f"SELECT error, count(*) AS n FROM (SELECT {_BAD} AS error FROM events) WHERE error IS NOT NULL GROUP BY error")
def dlq_split(spark, d):
    return ingest.rejected(_items(spark, d), "/latest", "2024-02-01T00:00:00Z").groupBy("error").agg(F.count("*").alias("n"))


@query("SELECT CAST(user_id AS INTEGER) AS sensor_id, 77 AS location_id, round(value, 10) AS value, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS datetime_utc, 40.7::DOUBLE AS lat, 'openaq-api' AS source FROM events WHERE event_id % 11 IN (0, 8)")
def measurements(spark, d):
    return rounded(ingest.measurements(_items(spark, d), "2024-02-01T00:00:00Z"), "value").select("sensor_id", "location_id", "value", "datetime_utc", "lat", "source")


@query(f"WITH {o.SENSORS} SELECT sensor_id, location_id, location_name, parameter, units, round(lat, 10) AS lat FROM sensors")
def sensor_flatten(spark, d):
    nested = F.struct(F.col("sensor_id").alias("id"), F.struct(F.col("parameter").alias("name"), "units").alias("parameter"))
    by_location = e.sensors(spark, d).groupBy("location_id", "location_name", "lat", "lon").agg(F.collect_list(nested).alias("sensors"))
    payload = F.to_json(F.struct(F.col("location_id").alias("id"), F.col("location_name").alias("name"), F.struct(F.col("lat").alias("latitude"), F.col("lon").alias("longitude")).alias("coordinates"), "sensors"))
    flat = ingest.sensors(by_location.select(payload.alias("payload")), "2024-02-01T00:00:00Z")
    return rounded(flat, "lat").select("sensor_id", "location_id", "location_name", "parameter", "units", "lat")


@query("SELECT CAST(year(m) AS INTEGER) AS year, CAST(month(m) AS INTEGER) AS month FROM generate_series(DATE '2023-11-01', DATE '2025-02-01', INTERVAL 1 MONTH) t(m)")
def archive_months(spark, d):
    return ingest.archive_months(spark, date(2023, 11, 17), date(2025, 2, 3))


@query(
    f"WITH {o.WIDE_CTE}, {o.DIM} SELECT event_id, sensor_id, round(w.value, 10) AS value, strftime(event_time, '%Y-%m-%dT%H:%M:%SZ') AS datetime_utc, name AS location_name, {o.day('event_time')} AS ingest_date FROM wide w JOIN dim_station USING (location_id)"
    " WHERE lat BETWEEN 40.48 AND 40.93 AND lon BETWEEN -74.27 AND -73.68 AND event_time >= TIMESTAMP '2024-01-05' AND event_time < TIMESTAMP '2024-01-21'"
)
def archive_backfill(spark, d):
    rows = e.wide(spark, d).join(e.dim(spark, d), "location_id").select(
        F.col("location_id").cast("string").alias("location_id"), F.col("sensor_id").cast("string").alias("sensors_id"), F.col("name").alias("location"),
        F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("datetime"), F.col("lat").cast("string").alias("lat"), F.col("lon").cast("string").alias("lon"),
        "parameter", F.col("event_id").cast("string").alias("units"), F.col("value").cast("string").alias("value"),
    )
    raw = ingest.archive_to_raw(rows, "2024-02-01T00:00:00Z", first=date(2024, 1, 5), last=date(2024, 1, 20))
    m = F.from_json("value", silver.MEASUREMENT)
    return rounded(raw.select(m.alias("m"), "ingest_date").select(F.col("m.units").cast("long").alias("event_id"), "m.sensor_id", "m.value", "m.datetime_utc", "m.location_name", "ingest_date"), "value")


# ---- serving


def _alerts(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("event_id")
    scope = F.when(i % 3 != 0, "region").otherwise("station")
    place = F.element_at(F.array(F.lit("Queens"), F.lit("Staten Island"), F.lit("Bronx")), (F.col("user_id") % 3 + 1).cast("int"))
    level = level_label((i % 6).cast("int"))
    at = F.col("ts").cast("timestamp")
    return e.table(spark, d, "events").select(
        F.when(scope == "region", alerts.alert_id("region", place, at, level)).otherwise(alerts.alert_id("station", F.col("user_id"), at, level)).alias("alert_id"),
        scope.alias("scope"), place.alias("borough"), F.floor("value").cast("int").alias("aqi"), level.alias("level"), F.when(i % 10 == 0, "RECOVERED").otherwise("ESCALATE").alias("type"),
        F.lit("MODERATE").alias("prev_level"), F.when(i % 8 == 0, "pm25").alias("dominant_pollutant"), at.alias("event_time"), (at + F.expr("INTERVAL 90 SECONDS")).alias("created_at"),
        F.when(i % 16 == 0, at).alias("published_at"), "event_id",
    )


_ALERT_CTE = f"""raw_alerts AS (
  SELECT CASE WHEN event_id % 3 <> 0 THEN replace(place, ' ', '') ELSE 'station' || user_id END || '_' || strftime(ts, '%Y%m%d%H') || '_' || lv AS alert_id,
    CASE WHEN event_id % 3 <> 0 THEN 'region' ELSE 'station' END AS scope, place AS borough, CAST(floor(value) AS INTEGER) AS aqi, lv AS level,
    CASE WHEN event_id % 10 = 0 THEN 'RECOVERED' ELSE 'ESCALATE' END AS type, CASE WHEN event_id % 8 = 0 THEN 'pm25' END AS dominant_pollutant, ts AS event_time, ts + INTERVAL 90 SECONDS AS created_at,
    CASE WHEN event_id % 16 = 0 THEN ts END AS published_at, event_id
  FROM (SELECT *, ['Queens', 'Staten Island', 'Bronx'][user_id % 3 + 1] AS place, {o.level_label('event_id % 6')} AS lv FROM events))"""


@query(f"WITH {_ALERT_CTE} SELECT event_id, alert_id FROM raw_alerts")
def alert_ids(spark, d):
    return _alerts(spark, d).select("event_id", "alert_id")


@query(f"WITH {_ALERT_CTE} SELECT count(DISTINCT alert_id) AS n_alerts, count(*) AS n_delivered FROM raw_alerts")
def alert_dedupe(spark, d):
    rows = _alerts(spark, d)
    once = serving.first_of_each(rows.drop("event_id"))
    return once.agg(F.count("*").alias("n_alerts")).crossJoin(rows.agg(F.count("*").alias("n_delivered")))


@query(
    f"WITH {_ALERT_CTE} SELECT event_id, CASE type WHEN 'ESCALATE' THEN 'ALERT' ELSE 'RECOVERED' END || ' air quality in ' || borough || ': MODERATE -> ' || level || ', index ' || aqi ||"
    " CASE WHEN dominant_pollutant IS NOT NULL THEN ', mainly ' || dominant_pollutant ELSE '' END || ', at ' || strftime(event_time, '%Y-%m-%d %H:%M') || ' UTC' AS message FROM raw_alerts"
)
def alert_messages(spark, d):
    return _alerts(spark, d).select("event_id", alerts.notification().alias("message"))


@query(f"WITH {_ALERT_CTE} SELECT event_id, scope, {o.text('created_at')} AS created_at FROM raw_alerts WHERE scope = 'region' AND published_at IS NULL")
def alert_outbox(spark, d):
    return serving.pending(_alerts(spark, d)).select("event_id", "scope", "created_at")


@query(f"WITH {_ALERT_CTE} SELECT alert_id, {o.text('created_at')} AS created_at FROM raw_alerts WHERE scope = 'region' ORDER BY raw_alerts.created_at DESC, alert_id LIMIT 50")
def latest_alerts(spark, d):
    return serving.latest_alerts(_alerts(spark, d)).select("alert_id", "created_at")


@query(f"WITH {_ALERT_CTE} SELECT event_id, alert_id, level FROM raw_alerts WHERE event_time >= {NOW_SQL} - INTERVAL 24 HOURS AND borough = 'Queens'")
def alerts_last_day(spark, d):
    return serving.alerts_since(_alerts(spark, d), now(), 24, "Queens").select("event_id", "alert_id", "level")


@query(f"WITH {_ALERT_CTE} SELECT event_id, level FROM raw_alerts WHERE alert_id LIKE 'Queens_2024011%'")
def alerts_by_prefix(spark, d):
    return serving.alerts_by_prefix(_alerts(spark, d), "Queens_2024011").select("event_id", "level")


_STATUS = f"WITH {o.WIDE_CTE}, {o.DIM}, {o.STATUS}"


@query(
    f"{_STATUS} SELECT (SELECT count(*) FROM status) AS stations, (SELECT CAST(round(avg(station_aqi)) AS INTEGER) FROM status) AS avg_aqi, (SELECT max(station_aqi) FROM status) AS max_aqi,"
    f" (SELECT count(*) FROM wide) AS readings, (SELECT {o.text('min(event_time)')} FROM wide) AS first_reading, (SELECT {o.text('max(event_time)')} FROM wide) AS last_reading,"
    " (SELECT count(*) FROM events WHERE event_id % 3 <> 0) AS alerts, (SELECT count(*) FROM nation) AS daily_records"
)
def overview(spark, d):
    return serving.overview(e.station_status(spark, d), e.wide(spark, d), _alerts(spark, d), e.table(spark, d, "nation"))


@query(f"{_STATUS} SELECT location_id, name, borough, station_aqi, dominant_pollutant, CAST(alerted_level AS INTEGER) AS alerted_level, {o.text('last_event_time')} AS last_event_time FROM status JOIN dim_station USING (location_id)")
def stations(spark, d):
    return serving.stations(e.station_status(spark, d), e.dim(spark, d)).drop("lat", "lon")


@query(f"{_STATUS} SELECT location_id, name, borough, parameter, round(value, 10) AS value, aqi_instant, {o.text('event_time')} AS event_time FROM indexed JOIN dim_station USING (location_id) WHERE event_time >= {NOW_SQL} - INTERVAL 24 HOURS ORDER BY indexed.event_time DESC, sensor_id, location_id LIMIT 500")
def recent_readings(spark, d):
    rows = e.wide(spark, d).withColumn("aqi_instant", index_of())
    return rounded(serving.recent_readings(rows, e.dim(spark, d), now()), "value").drop("units")


@query(
    f"{_STATUS} SELECT borough, {o.text('b')} AS bucket, max(aqi_instant) AS aqi_max, CAST(round(avg(aqi_instant)) AS INTEGER) AS aqi_avg, count(*) AS n_readings"
    f" FROM (SELECT borough, date_trunc('hour', event_time) AS b, aqi_instant FROM indexed JOIN dim_station USING (location_id)) WHERE b >= {NOW_SQL} - INTERVAL 72 HOURS GROUP BY borough, b"
)
def recent_hourly(spark, d):
    return serving.recent_hourly(gold.hourly_by_region(e.wide(spark, d).withColumn("aqi_instant", index_of()), e.dim(spark, d)), now(), 72)


@query(f"{_SUMMARY} SELECT location_id, {o.day('date_local')} AS date_local, borough, aqi_daily FROM summary WHERE borough IS NOT NULL ORDER BY summary.date_local DESC, borough, location_id LIMIT 1000")
def latest_summary(spark, d):
    return serving.latest_summary(_summary(spark, d)).select("location_id", "date_local", "borough", "aqi_daily")


@query(f"{_PERIODS} SELECT borough, period_type, period, round(avg(aqi_daily), 1) AS aqi_avg, max(aqi_daily) AS aqi_max FROM periods GROUP BY ALL")
def region_statistics(spark, d):
    return serving.region_statistics(gold.region_stats(_summary(spark, d))).select("borough", "period_type", "period", "aqi_avg", "aqi_max")


@query(f"{_STATUS} SELECT location_id, name, borough, station_aqi, dominant_pollutant FROM status JOIN dim_station USING (location_id) ORDER BY station_aqi DESC, location_id LIMIT 10")
def worst_stations(spark, d):
    return serving.worst_stations(e.station_status(spark, d), e.dim(spark, d))


@query(f"WITH {o.WIDE_CTE} SELECT count(*) AS n, {o.text('min(event_time)')} AS oldest FROM wide WHERE event_time >= TIMESTAMP '2024-02-10 00:00:00' - INTERVAL 30 DAYS")
def retention(spark, d):
    kept = silver.rolling_history(e.wide(spark, d), F.lit(datetime(2024, 2, 10)).cast("timestamp"))
    return kept.agg(F.count("*").alias("n"), F.min("event_time").alias("oldest"))


@query(
    f"{_SUMMARY} SELECT s.location_id, {o.day('s.date_local')} AS date_local, s.aqi_daily, count(*) AS n_readings, round(max(r.value), 10) AS max_value FROM summary s JOIN dense r ON r.location_id = s.location_id"
    f" AND CAST({o.local('r.event_time')} AS DATE) = s.date_local GROUP BY ALL"
)
def summary_with_readings(spark, d):
    joined = _summary(spark, d).join(_days(spark, d).select("location_id", "date_local", "value"), ["location_id", "date_local"])
    return rounded(joined.groupBy("location_id", "date_local", "aqi_daily").agg(F.count("*").alias("n_readings"), F.max("value").alias("max_value")), "max_value")


_HALF = "TIMESTAMP '2024-01-15 00:00:00'"


@query(f"WITH {o.WIDE_CTE} SELECT location_id, {o.text('max(event_time)')} AS last_event_time, max_by(event_id, {{'t': event_time, 'i': event_id}}) AS event_id FROM wide GROUP BY location_id")
def status_upsert(spark, d):
    def last(rows: DataFrame) -> DataFrame:
        pick = F.max_by(F.struct("event_id", "event_time"), F.struct("event_time", "event_id")).alias("r")
        return rows.groupBy("location_id").agg(pick).select("location_id", "r.event_id", F.col("r.event_time").alias("last_event_time"))

    rows, half = e.wide(spark, d), F.lit(datetime(2024, 1, 15)).cast("timestamp")
    late = last(rows.where(F.col("event_time") >= half))
    return serving.upsert(late, last(rows.where(F.col("event_time") < half)).unionByName(late), "location_id", "last_event_time")


@query(f"WITH {o.WIDE_CTE} SELECT sensor_id, {o.text('h')} AS event_time, CASE WHEN min(event_id) FILTER (WHERE event_id % 2 = 0) IS NOT NULL THEN 'old' ELSE 'new' END AS origin FROM (SELECT *, date_trunc('hour', event_time) AS h FROM wide) GROUP BY sensor_id, h")
def readings_insert_ignore(spark, d):
    rows = e.wide(spark, d).select("sensor_id", F.date_trunc("hour", "event_time").alias("event_time"), "event_id")
    old = rows.where("event_id % 2 = 0").select("sensor_id", "event_time").distinct().withColumn("origin", F.lit("old"))
    new = rows.where("event_id % 3 >= 0").select("sensor_id", "event_time", F.lit("new").alias("origin"))
    return serving.insert_ignore(old, new, ["sensor_id", "event_time"])


# ---- alerts and clusters: the folds as recursions


def _trail(spark: SparkSession, d: str) -> DataFrame:
    return alerts.station_trail(gold.station_index(e.dense(spark, d).withColumn("aqi_instant", index_of())))


_TRAIL = f"WITH RECURSIVE {o.DENSE}, {o.TRAIL}"


@query(
    f"{_TRAIL} SELECT location_id, {o.text('event_time')} AS event_time, aqi AS station_aqi, dominant_pollutant, lv AS level, cand AS candidate, seen, kind AS alert_type, alert_level, previous AS previous_level"
    " FROM trail WHERE kind IS NOT NULL"
)
def alert_replay(spark, d):
    return _trail(spark, d).where("alert_type IS NOT NULL")


@query(f"{_TRAIL} SELECT location_id, {o.text('event_time')} AS event_time, lv AS level, cand AS candidate, seen FROM trail")
def alert_states(spark, d):
    return _trail(spark, d).select("location_id", "event_time", "level", "candidate", "seen")


_ENDS = "TIMESTAMP '2024-02-01 00:00:00'"


@query(
    f"{_TRAIL}, homes AS (SELECT DISTINCT location_id AS home, borough FROM dense WHERE borough IS NOT NULL), region_obs AS (SELECT borough AS k, event_time, aqi, lv AS s, location_id, dominant_pollutant,"
    f" row_number() OVER (PARTITION BY borough ORDER BY event_time) AS rn FROM trail JOIN homes ON home = location_id), {o.fold('region_obs', True, 'region_fold')}, steps AS ("
    " SELECT f.*, o.event_time, o.aqi, o.location_id, o.dominant_pollutant, max(o.rn) OVER (PARTITION BY o.k) AS n FROM region_fold f JOIN region_obs o ON o.k = f.k AND o.rn = f.rn)"
    f" SELECT k AS borough, location_id AS trigger_location_id, aqi, alert_level AS level, previous AS previous_level, kind AS alert_type, dominant_pollutant, {o.text('event_time')} AS event_time FROM steps WHERE kind IS NOT NULL"
    f" UNION ALL SELECT k, NULL, NULL, -1, lv, 'UNKNOWN', NULL, {o.text('event_time')} FROM steps WHERE rn = n AND lv >= 2 AND epoch({_ENDS}) - epoch(event_time) > 10800"
)
def alert_regions(spark, d):
    return alerts.region_alerts(_trail(spark, d), dense_dim(spark, d), now=datetime(2024, 2, 1))


@query(
    f"{_TRAIL} SELECT location_id, 'UNKNOWN' AS alert_type, -1 AS alert_level, lv AS previous_level, {o.text('event_time')} AS event_time"
    f" FROM (SELECT *, max(rn) OVER (PARTITION BY location_id) AS n FROM trail) WHERE rn = n AND lv >= 2 AND epoch({_ENDS}) - epoch(event_time) > 10800"
)
def alert_timeouts(spark, d):
    return alerts.timeouts(_trail(spark, d), datetime(2024, 2, 1))


@query()
def cluster_profiles(spark, d):
    features = gold.cluster_features(hourly(spark, d))
    result = clusters.fit(features)
    return serving.cluster_profiles(clusters.profiles(clusters.predictions(features, result), result))


#: Centres (of clusters.FEATURES) for the assignment that SQL can check.
_CENTRES = [[60.0, 100.0, 2.0, 8.0, 0.3], [90.0, 150.0, 6.0, 14.0, 0.5], [130.0, 200.0, 12.0, 18.0, 0.6]]
_DISTANCES = ", ".join("(" + " + ".join(f"power({c} - {x}::DOUBLE, 2)" for c, x in zip(clusters.FEATURES, centre, strict=True)) + ")" for centre in _CENTRES)


@query(
    f"WITH {o.DENSE}, {o.hourly('dense')}, {o.STATION_HOURLY}, f AS (SELECT location_id, date_local, count(aqi) AS n_hours, avg(aqi) AS aqi_mean, max(aqi) AS aqi_max, count(*) FILTER (WHERE aqi > 100) AS hours_over_100,"
    " min({'low': -aqi, 'h': hour_local}).h AS peak_hour, coalesce(avg(aqi_pm25), 0) AS dust, coalesce(avg(aqi_o3), 0) AS ozone FROM station_hourly GROUP BY ALL),"
    f" g AS (SELECT location_id, date_local, [{_DISTANCES}] AS far FROM (SELECT *, dust / (dust + ozone) AS pm25_o3_ratio FROM f WHERE n_hours >= 18 AND dust + ozone > 0))"
    f" SELECT location_id, {o.day('date_local')} AS date_local, CAST(list_position(far, list_min(far)) - 1 AS INTEGER) AS cluster FROM g"
)
def cluster_assigned(spark, d):
    return clusters.assigned(gold.cluster_features(hourly(spark, d)), _CENTRES).drop("cluster_name")


# ---- files: written to the shared folder and read back


@query(ORACLES["archive_backfill"])
def archive_files(spark, d):
    """The archive as compressed CSV files, through the reader of the archive."""
    path = f"{runs.workspace(spark)}/archive"
    rows = e.wide(spark, d).join(e.dim(spark, d), "location_id").select(
        F.col("location_id"), F.col("sensor_id").alias("sensors_id"), F.col("name").alias("location"), F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("datetime"),
        "lat", "lon", "parameter", F.col("event_id").alias("units"), "value", F.lit("US").alias("country"),
    )
    rows.write.option("header", True).option("compression", "gzip").csv(path)
    raw = ingest.archive_to_raw(tables.read_archive(spark, path), "2024-02-01T00:00:00Z", first=date(2024, 1, 5), last=date(2024, 1, 20))
    m = F.from_json("value", silver.MEASUREMENT)
    return rounded(raw.select(m.alias("m"), "ingest_date").select(F.col("m.units").cast("long").alias("event_id"), "m.sensor_id", "m.value", "m.datetime_utc", "m.location_name", "ingest_date"), "value")


@query(f"SELECT {o.day('ts')} AS ingest_date, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS offsets FROM events WHERE ts >= DATE '2024-01-09' AND ts < DATE '2024-01-13' GROUP BY 1")
def bronze_days(spark, d):
    """Raw files by ingestion date; of three local days the reader takes four partitions."""
    path = f"{runs.workspace(spark)}/bronze"
    tables.append_raw(silver.raw_rows(e.messages(spark, d)), path)
    rows = tables.read_raw(spark, path, date(2024, 1, 9), date(2024, 1, 11))
    return rows.groupBy("ingest_date").agg(F.count("*").alias("n"), F.sum("offset").alias("offsets"))


@query(
    f"WITH {_SILVER}, days AS (SELECT date_local, count(*) AS n, round(sum(value), 6) AS total FROM kept WHERE rn = 1 AND NOT (date_local = DATE '2024-01-12') GROUP BY date_local)"
    f" SELECT {o.day('date_local')} AS date_local, n, total FROM days WHERE date_local BETWEEN DATE '2024-01-10' AND DATE '2024-01-13'"
)
def silver_days(spark, d):
    """Clean partitions: all days, then one of them again without rows; read with a day of warm-up."""
    path = f"{runs.workspace(spark)}/silver"
    rows = silver.clean(silver.parse(e.messages(spark, d)), e.sensors(spark, d), day_from=_FIRST, day_to=_LAST)
    keys = ("year", "month", "date_local")
    tables.overwrite_days(rows, path, _FIRST, _LAST, *keys)
    tables.overwrite_days(rows.where("value < -1"), path, date(2024, 1, 12), date(2024, 1, 12), *keys)
    back = tables.read_silver(spark, path, date(2024, 1, 11), date(2024, 1, 13))
    return back.groupBy("date_local").agg(F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("total"))


@query(ORACLES["sensor_lookup"])
def lookup_lines(spark, d):
    path = f"{runs.workspace(spark)}/lookup"
    tables.write_lines(silver.sensor_lookup(e.sensors(spark, d), e.wide(spark, d)), path)
    return spark.read.schema("sensor_id int, parameter string, units string").json(path)


@query(
    "SELECT CAST(s AS INTEGER) AS sensor_id, strftime(make_timestamp(CAST((1700000000 + m * 60) * 1000000 AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS event_time, CASE WHEN m = 100 THEN 200.0::DOUBLE ELSE"
    " round(greatest(30.0::DOUBLE + 25.0::DOUBLE * cos(2.0::DOUBLE * 3.141592653589793::DOUBLE * m / 1440 + s), 0), 2) END AS value FROM range(4) a(s), range(1440) b(m)"
)
def wave_series(spark, d):
    return tables.wave(spark, 4, 1440, spike_at=100)


@query(f"{_STATUS} SELECT borough, max(CAST(alerted_level AS INTEGER)) AS level, {o.text('max(last_event_time)')} AS last_event_time FROM status JOIN dim_station USING (location_id) WHERE borough IS NOT NULL GROUP BY borough")
def region_levels(spark, d):
    known = e.station_status(spark, d).join(e.dim(spark, d).where("borough IS NOT NULL").select("location_id", "borough"), "location_id")
    return serving.region_levels(known.groupBy("borough").agg(F.max("alerted_level").alias("level"), F.max("last_event_time").alias("last")))


@query(f"WITH {_ALERT_CTE} SELECT alert_id AS key, count(*) AS n, min(strftime(created_at, '%Y-%m-%dT%H:%M:%SZ')) AS created_at FROM raw_alerts WHERE scope = 'region' AND published_at IS NULL GROUP BY alert_id")
def outbox_messages(spark, d):
    """What a publisher sends for the pending alerts, from its wire format."""
    sent = tables.as_messages(serving.pending(_alerts(spark, d)), "alert_id")
    return sent.groupBy("key").agg(F.count("*").alias("n"), F.min(F.get_json_object("value", "$.created_at")).alias("created_at"))


# ---- streams


@query("SELECT count(*) AS n, count(DISTINCT strftime(ts, '%Y-%m-%d')) AS days, CAST(sum(event_id) AS BIGINT) AS offsets FROM events")
def stream_raw(spark, d):
    rows = runs.run_raw(spark, e.messages(spark, d))
    return rows.agg(F.count("*").alias("n"), F.countDistinct("ingest_date").alias("days"), F.sum("offset").alias("offsets"))


@query(f"WITH {o.DEFECTIVE} SELECT DISTINCT sensor_id, {o.text('date_trunc(' + repr('hour') + ', event_time)')} AS event_time FROM defective WHERE event_id % 61 <> 0 AND event_id % 59 <> 0")
def stream_dedupe(spark, d):
    return runs.run_dedupe(spark, e.messages(spark, d)).select("sensor_id", "event_time")


@query(f"{_TRAIL} SELECT location_id, kind AS alert_type, alert_level AS level, previous AS previous_level, aqi, {o.text('event_time')} AS event_time FROM trail WHERE kind IS NOT NULL")
def stream_alerts(spark, d):
    return runs.run_alerts(spark, gold.station_index(e.dense(spark, d).withColumn("aqi_instant", index_of())))
