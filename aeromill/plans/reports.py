"""Named reports over ``fact_daily``, ``fact_hourly`` and ``dim_station``, built from the marts."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aeromill.operators import gold

#: Index from which a region's day is bad (above it), and a station's (from it on).
BAD, USG = 100, 101


def bad_days_rank(fact_daily: DataFrame, dim_station: DataFrame) -> DataFrame:
    """Regions ranked within each year by their days with an index above BAD somewhere."""
    days = gold.mart_region_daily(fact_daily, dim_station).where(F.col("aqi_max") > BAD)
    counted = days.groupBy(F.year("date_local").alias("year"), "borough").agg(F.count("*").alias("bad_days"))
    place = F.rank().over(Window.partitionBy("year").orderBy(F.desc("bad_days")))
    return counted.withColumn("rank", place).orderBy("year", "rank", "borough")


def borough_hour(fact_hourly: DataFrame, dim_station: DataFrame) -> DataFrame:
    """Mean index of station hours by region and local hour: a slice of the temporal mart."""
    hours = gold.mart_temporal(fact_hourly, dim_station).where("grain = 'hour_local'")
    return hours.select("borough", F.col("bucket").alias("hour_local"), F.round("aqi_avg", 1).alias("aqi_avg"), "n_station_hours").orderBy("borough", "hour_local")


def borough_month(fact_daily: DataFrame, dim_station: DataFrame) -> DataFrame:
    """Mean daily index and bad station days by region and calendar month."""
    by_index = gold.in_regions(fact_daily, dim_station).groupBy("borough", F.month("date_local").alias("month"), "aqi_daily").agg(F.count("*").alias("n"))
    months = by_index.groupBy("borough", "month").agg(
        F.round(F.sum(F.col("aqi_daily") * F.col("n")) / F.sum(F.when(F.col("aqi_daily").isNotNull(), F.col("n"))), 1).alias("aqi_avg"),
        F.coalesce(F.sum(F.when(F.col("aqi_daily") > BAD, F.col("n"))), F.lit(0)).alias("station_days_over_100"),
    )
    return months.orderBy("borough", "month")


def widespread_days(fact_daily: DataFrame, dim_station: DataFrame) -> DataFrame:
    """Days on which half of the stations or more are at USG or above."""
    days = gold.mart_region_daily(fact_daily, dim_station).groupBy("date_local").agg(F.sum("n_stations").alias("n_stations"), F.sum("n_stations_usg").alias("n_usg"))
    share = F.col("n_usg") / F.col("n_stations")
    return days.where((F.col("n_usg") > 0) & (share >= 0.5)).withColumn("share_usg", F.round(share, 3)).orderBy("date_local")


REPORTS: dict[str, Callable[..., DataFrame]] = {
    "q1_bad_days_rank": bad_days_rank,
    "q2_borough_hour": borough_hour,
    "q2_borough_month": borough_month,
    "q3_widespread_days": widespread_days,
}


def needs(name: str) -> tuple[str, ...]:
    """The views that a report reads."""
    fn = REPORTS[name]
    return fn.__code__.co_varnames[: fn.__code__.co_argcount]


def run(name: str, **views: DataFrame) -> DataFrame:
    """A report over the given views; others than it reads may be given too."""
    return REPORTS[name](**{v: views[v] for v in needs(name)})


def sql(spark: SparkSession, text: str, **views: DataFrame) -> DataFrame:
    """SQL of one's own over the given DataFrames, named as in the text."""
    return spark.sql(re.sub(rf"\b({'|'.join(views)})\b", r"{\1}", text), **views)


def explain(df: DataFrame, mode: str = "formatted") -> str:
    """The plan as text."""
    from contextlib import redirect_stdout
    from io import StringIO

    out = StringIO()
    with redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def save(result: DataFrame, name: str, folder: str) -> None:
    """A report's rows as one CSV file with a header and its plan as text, under ``folder``."""
    spark = result.sparkSession
    spark.createDataFrame([(explain(result),)], "plan string").coalesce(1).write.mode("overwrite").option("lineSep", "\n").text(f"{folder}/plans/{name}")
    result.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{folder}/sql/{name}")
