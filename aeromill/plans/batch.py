"""The daily batch: clean, derive, cross-check, cluster, summarise, with reports of quality and validation."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeromill.operators import clusters, gold, silver, stats
from aeromill.plans import reports
from aeromill.sources import tables


def clean_days(spark: SparkSession, lake: str, sensors: DataFrame, first: date, last: date) -> None:
    """Raw rows of the days (and the day after) to clean partitions; days left empty are cleared."""
    parsed = silver.parse(tables.read_raw(spark, f"{lake}/bronze", first, last))
    tables.overwrite_days(silver.clean(parsed, sensors, day_from=first, day_to=last), f"{lake}/silver", first, last, "year", "month", "date_local")


def quality_report(spark: SparkSession, lake: str, sensors: DataFrame, first: date, last: date) -> DataFrame:
    """Rows per quality flag of the raw partitions, and whether they are kept."""
    return silver.funnel(silver.parse(tables.read_raw(spark, f"{lake}/bronze", first, last)), sensors)


def derive_days(spark: SparkSession, lake: str, first: date, last: date) -> None:
    """Facts, marts and features of the days; the station dimension and the temporal mart whole."""
    rows = tables.read_silver(spark, f"{lake}/silver", first, last)
    in_days = f"date_local BETWEEN DATE '{first}' AND DATE '{last}'"
    dim = gold.dim_station(rows)
    if tables.exists(spark, f"{lake}/gold/dim_station"):
        dim = gold.merge_dim(dim, spark.read.parquet(f"{lake}/gold/dim_station"))
    tables.replace_table(dim, f"{lake}/gold/dim_station")
    dim = spark.read.parquet(f"{lake}/gold/dim_station")

    def store(facts: DataFrame, name: str) -> DataFrame:
        tables.overwrite_days(facts.where(in_days), f"{lake}/gold/{name}", first, last, "date_local")
        return spark.read.schema(facts.schema).parquet(f"{lake}/gold/{name}") if tables.days_in(spark, f"{lake}/gold/{name}") else facts.limit(0)

    hourly = gold.fact_hourly(rows)  # with the day before, for windows that reach back
    facts = store(hourly, "fact_hourly")
    daily = store(gold.fact_daily(hourly), "fact_daily")
    store(gold.mart_region_daily(daily.where(in_days), dim), "mart_region_daily")
    store(gold.cluster_features(facts.where(in_days)), "cluster_features")
    tables.replace_table(gold.mart_temporal(facts, dim), f"{lake}/gold/mart_temporal")


def validate_days(spark: SparkSession, lake: str, other: DataFrame, first: date, last: date) -> dict:
    """Report of our daily statistics against another computation's; FAIL raises, after the report is stored."""
    rows = tables.read_silver(spark, f"{lake}/silver", first, last, warm_up=0).withColumn("date_local", F.col("date_local").cast("string"))
    ours = stats.daily_stats(rows)
    report = stats.comparison_report(ours, other)
    tables.write_lines(report, f"{lake}/reports/validation/{first}_{last}")
    found = report.first().asDict()
    if found["status"] != "PASS":
        tables.write_lines(stats.sample_mismatches(ours, other), f"{lake}/reports/validation/{first}_{last}-mismatches")
        raise ValueError(f"statistics disagree: {found}")
    return found


def raw_statistics(spark: SparkSession, lake: str, sensors: DataFrame, first: date, last: date) -> DataFrame:
    """The other computation: from the raw lines, stored as text lines and read back."""
    path = f"{lake}/validation/daily_stats/{first}_{last}"
    lines = stats.stats_lines(stats.daily_stats_raw(tables.read_lines(spark, f"{lake}/bronze", first, last), sensors, first, last))
    lines.write.mode("overwrite").text(path)
    return stats.parse_stats_lines(spark.read.text(path))


def analyse(spark: SparkSession, lake: str, k: int | None = None) -> dict[str, DataFrame]:
    """SQL reports, clusters, daily summary and region statistics."""
    read = lambda name: spark.read.parquet(f"{lake}/gold/{name}")
    views = {name: read(name) for name in ("fact_hourly", "fact_daily", "dim_station")}
    out = {name: reports.run(name, **views) for name in reports.REPORTS}
    features = read("cluster_features")
    try:
        result = clusters.fit(features, chosen=k)
        predicted = clusters.predictions(features, result)
        out["cluster_profiles"] = clusters.profiles(predicted, result)
        clusters.save(spark, result, f"{lake}/models/kmeans")
    except clusters.TooFewRows:
        predicted = spark.createDataFrame([], "location_id int, date_local date, cluster int, cluster_name string")
    out["daily_summary"] = gold.daily_summary(views["fact_daily"], predicted, views["dim_station"])
    out["region_stats"] = gold.region_stats(out["daily_summary"])
    return out


def attempt(step: Callable, *arguments, retries: int = 1, wait: float = 0.0):
    """A step of the chain, tried again after ``wait`` seconds if it fails; steps may be repeated."""
    for left in range(retries, -1, -1):
        try:
            return step(*arguments)
        except Exception:
            if not left:
                raise
            time.sleep(wait)


def run_days(spark: SparkSession, lake: str, sensors: DataFrame, first: date, last: date, retries: int = 1, wait: float = 0.0) -> dict[str, DataFrame]:
    """The chain: clean, then statistics from raw and facts, then their comparison, then analysis.

    A comparison that fails stops the chain before the analysis.
    """
    days = (first, last)
    attempt(clean_days, spark, lake, sensors, *days, retries=retries, wait=wait)
    attempt(lambda: tables.write_lines(quality_report(spark, lake, sensors, *days), f"{lake}/reports/data_quality/{first}_{last}"), retries=retries, wait=wait)
    other = attempt(raw_statistics, spark, lake, sensors, *days, retries=retries, wait=wait)
    attempt(derive_days, spark, lake, *days, retries=retries, wait=wait)
    validate_days(spark, lake, other, *days)
    return attempt(analyse, spark, lake, retries=retries, wait=wait)


def main(arguments: list[str] | None = None) -> None:
    """``python -m aeromill.plans.batch --lake PATH --sensors PATH --from DAY --to DAY``"""
    import argparse

    parser = argparse.ArgumentParser(description="Run the daily batch over some local days.")
    parser.add_argument("--lake", required=True)
    parser.add_argument("--sensors", required=True, help="Parquet table of sensor metadata")
    parser.add_argument("--from", dest="first", type=date.fromisoformat, required=True)
    parser.add_argument("--to", dest="last", type=date.fromisoformat)
    options = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("aeromill-batch").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    out = run_days(spark, options.lake, spark.read.parquet(options.sensors), options.first, options.last or options.first)
    for name, df in out.items():
        if name in reports.REPORTS:
            reports.save(df, name, f"{options.lake}/reports")
        else:
            df.write.mode("overwrite").parquet(f"{options.lake}/analytics/{name}")


if __name__ == "__main__":
    main()
