"""Daily statistics computed twice, and their comparison.

``daily_stats`` aggregates clean readings. ``daily_stats_raw`` goes from the raw lines to the same
figures on another way, with no code in common but the fixed values: lines are parsed by Python,
limits come from a joined table, and repeats are settled in the reducer, which sees every reading of
a location, pollutant and day (some thousands at most).
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import date, datetime, timezone
from zoneinfo import ZoneInfo

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeromill.functions import quality
from aeromill.functions.geo import DEFAULT_BOX, parse_box

KEYS = ("location_id", "parameter", "date_local")
METRICS = ("count", "sum", "max", "avg", "hours_over_threshold")
TOLERANCE = 1e-6


def daily_stats(readings: DataFrame) -> DataFrame:
    """Count, sum, maximum, mean and hours over the threshold per location, pollutant and local day."""
    value = F.col("value")
    return readings.groupBy(*KEYS).agg(
        F.count(value).alias("count"),
        F.sum(value).alias("sum"),
        F.max(value).alias("max"),
        F.avg(value).alias("avg"),
        F.count_if(quality.exceeds(F.col("parameter"), F.col("units"), value)).alias("hours_over_threshold"),
    )


_MAPPED = "sensor_id long, location_id long, parameter string, units string, lat double, lon double, value double, at string, day string, ingested string, place long"
_REDUCED = "location_id int, parameter string, date_local string, count long, sum double, max double, avg double, hours_over_threshold long"


def _number(x) -> float | None:
    return float(x) if isinstance(x, (int, float)) and not isinstance(x, bool) else None


def map_line(line: str, zone: ZoneInfo) -> tuple | None:
    """One raw line (JSON with the message in ``value``) as a row of _MAPPED; None if it holds no measurement."""
    try:
        row = json.loads(line)
        data = json.loads(row["value"])
        moment = datetime.fromisoformat(data["datetime_utc"])
        moment = moment.replace(tzinfo=moment.tzinfo or timezone.utc).astimezone(timezone.utc)
        sensor, location = data["sensor_id"], data["location_id"]
    except (ValueError, KeyError, TypeError, OverflowError):
        return None
    if type(sensor) is not int or type(location) is not int:
        return None
    text = lambda k: data.get(k) if isinstance(data.get(k), str) else None
    return (
        sensor, location, text("parameter"), text("units"), _number(data.get("lat")), _number(data.get("lon")), _number(data.get("value")),
        moment.isoformat(), moment.astimezone(zone).date().isoformat(), text("ingested_at") or "", int(row.get("offset") or 0),
    )


def reduce_rows(rows: pd.DataFrame) -> pd.DataFrame:
    """Statistics of one location, pollutant and day; of repeats the one that came in last counts."""
    last = rows.sort_values(["ingested", "place", "value"], kind="stable").drop_duplicates(["sensor_id", "at"], keep="last")
    values, over = last["value"].sort_values(), (last["value"] > last["threshold"]).sum()
    first = rows.iloc[0]
    out = (int(first["location_id"]), first["parameter"], first["day"], len(values), float(values.sum()), float(values.max()), float(values.mean()), int(over))
    return pd.DataFrame([out], columns=[c.split()[0] for c in _REDUCED.split(", ")])


def daily_stats_raw(lines: DataFrame, sensors: DataFrame, first: date | None = None, last: date | None = None, box: str = DEFAULT_BOX, zone: str = "America/New_York") -> DataFrame:
    """``daily_stats`` from raw lines (value) and sensors (sensor_id, parameter, units, lat, lon)."""

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, names = ZoneInfo(zone), [c.split()[0] for c in _MAPPED.split(", ")]
        for frame in frames:
            found = [r for r in (map_line(x, place) for x in frame["value"] if x) if r is not None]
            yield pd.DataFrame(found, columns=names).astype({"sensor_id": "int64", "location_id": "int64", "place": "int64", "lat": float, "lon": float, "value": float})

    mapped = lines.select("value").mapInPandas(parse, _MAPPED)
    if first is not None:
        mapped = mapped.where(F.col("day").between(first.isoformat(), (last or first).isoformat()))
    own = ("parameter", "units", "lat", "lon")
    known = sensors.select(F.col("sensor_id").alias("s_id"), *[F.col(c).alias(f"s_{c}") for c in own])
    west, south, east, north = parse_box(box)
    full = mapped.join(known, F.col("sensor_id") == F.col("s_id"), "left").withColumns({c: F.coalesce(F.nanvl(c, F.lit(None)) if c in ("lat", "lon") else F.col(c), f"s_{c}") for c in own})
    inside = full.where(f"lat BETWEEN {south} AND {north} AND lon BETWEEN {west} AND {east} AND parameter IS NOT NULL AND NOT isnan(value) AND value >= 0")
    limits = lines.sparkSession.createDataFrame(
        [(p, u, float(low), float(high), float(over)) for p, by in quality.RANGES.items() for u, (low, high, over) in by.items()], "l_parameter string, l_unit string, low double, high double, threshold double"
    )
    unit = F.expr("coalesce(regexp_replace(replace(replace(replace(lower(trim(units)), 'µ', 'u'), 'μ', 'u'), '³', '3'), ' ', ''), '')")
    judged = inside.join(limits, (F.lower("parameter") == F.col("l_parameter")) & (unit == F.col("l_unit")), "left").where("low IS NULL OR value BETWEEN low AND high")
    return judged.select("sensor_id", "location_id", "parameter", "day", "at", "ingested", "place", "value", "threshold").groupBy("location_id", "parameter", "day").applyInPandas(reduce_rows, _REDUCED)


def stats_lines(stats: DataFrame) -> DataFrame:
    """Statistics as text lines ``[location, pollutant, day] TAB {metrics}``."""
    key = F.to_json(F.array(F.col("location_id").cast("string"), F.col("parameter"), F.col("date_local").cast("string")))
    return stats.select(F.concat(key, F.lit("\t"), F.to_json(F.struct(*METRICS))).alias("value"))


def parse_stats_lines(lines: DataFrame) -> DataFrame:
    """Statistics from text lines ``[location, pollutant, day] TAB {metrics}``; other lines go."""
    parts = F.split("value", "\t", 2)
    parsed = lines.select(
        F.from_json(parts[0], "array<string>").alias("k"),
        F.from_json(F.try_element_at(parts, F.lit(2)), "count long, sum double, max double, avg double, hours_over_threshold long").alias("m"),
    ).where("k IS NOT NULL AND m IS NOT NULL")
    return parsed.select(F.try_element_at("k", F.lit(1)).try_cast("int").alias("location_id"), F.try_element_at("k", F.lit(2)).alias("parameter"), F.try_element_at("k", F.lit(3)).alias("date_local"), "m.*")


def compared(left: DataFrame, right: DataFrame) -> DataFrame:
    """Both sides by key with absolute differences; a missing side is null."""
    a = left.select(*KEYS, *[F.col(m).alias(f"a_{m}") for m in METRICS], F.lit(True).alias("in_a"))
    b = right.select(*KEYS, *[F.col(m).alias(f"b_{m}") for m in METRICS], F.lit(True).alias("in_b"))
    both = a.join(b, list(KEYS), "full_outer")
    return both.withColumns({f"diff_{m}": F.abs(F.col(f"a_{m}") - F.col(f"b_{m}")) for m in METRICS})


def comparison_report(left: DataFrame, right: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """One row: keys on both sides and on one, mismatches, largest differences, PASS or FAIL.

    A single aggregation over the joined rows.
    """
    off = F.greatest(*[F.col(f"diff_{m}").cast("double") for m in METRICS]) > tolerance
    row = compared(left, right).agg(
        F.count("*").alias("total_keys"),
        F.count_if(F.col("in_a") & F.col("in_b")).alias("matched_keys"),
        F.count_if(F.col("in_b").isNull()).alias("left_only"),
        F.count_if(F.col("in_a").isNull()).alias("right_only"),
        F.count_if(off).alias("value_mismatches"),
        *[F.coalesce(F.max(f"diff_{m}").cast("double"), F.lit(0.0)).alias(f"max_diff_{m}") for m in METRICS],
    )
    good = (F.col("left_only") == 0) & (F.col("right_only") == 0) & (F.col("value_mismatches") == 0)
    return row.withColumn("status", F.when(good, "PASS").otherwise("FAIL"))


def sample_mismatches(left: DataFrame, right: DataFrame, n: int = 20, tolerance: float = TOLERANCE) -> DataFrame:
    """Up to ``n`` keys that differ or lie on one side only, in key order."""
    off = F.greatest(*[F.col(f"diff_{m}").cast("double") for m in METRICS]) > tolerance
    return compared(left, right).where(off | F.col("in_a").isNull() | F.col("in_b").isNull()).orderBy(*KEYS).limit(n)
