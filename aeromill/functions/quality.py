"""Data-quality flags and exceedance thresholds per pollutant and unit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aeromill.functions.index import unit_key

# Per pollutant and unit the plausible range and the concentration at index 100.
RANGES = {
    "pm25": {"ug/m3": (0, 1000, 35.4)},
    "pm10": {"ug/m3": (0, 2000, 154)},
    "o3": {"ppm": (0, 1.0, 0.070), "ppb": (0, 1000, 70), "ug/m3": (0, 2000, 137)},
    "no2": {"ppm": (0, 2.0, 0.100), "ppb": (0, 2000, 100), "ug/m3": (0, 4000, 188)},
    "so2": {"ppm": (0, 2.0, 0.075), "ppb": (0, 2000, 75), "ug/m3": (0, 5000, 196)},
    "co": {"ppm": (0, 100, 9.4), "ppb": (0, 100000, 9400), "ug/m3": (0, 120000, 10800)},
}
# Flags by priority, and those that a batch drops (late data is kept as history).
FLAGS = ("NO_METADATA", "NEGATIVE", "OUT_OF_RANGE", "STALE", "OK")
DROPPED = ("NO_METADATA", "NEGATIVE", "OUT_OF_RANGE")
STALE_SECONDS = 10800


def _of(parameter: Column, units: Column, field: int) -> Column:
    """One field of the matching range; null where pollutant and unit have none.

    A map literal keeps this a single hash lookup whatever the number of rules.
    """
    entries = [x for p, by_unit in RANGES.items() for u, r in by_unit.items() for x in (F.lit(f"{p} {u}"), F.lit(float(r[field])))]
    return F.try_element_at(F.create_map(*entries), F.concat_ws(" ", F.lower(parameter), unit_key(units)))


def threshold(parameter: Column, units: Column) -> Column:
    """Concentration at index 100, or null."""
    return _of(parameter, units, 2)


def exceeds(parameter: Column, units: Column, value: Column) -> Column:
    """Whether the value is strictly above its threshold; false where there is none."""
    return F.coalesce(value > threshold(parameter, units), F.lit(False))


def flag(parameter: Column, units: Column, value: Column, event: Column | None = None, reference: Column | None = None) -> Column:
    """The first flag that holds. STALE needs a reference time more than STALE_SECONDS after the event."""
    out = (
        F.when(parameter.isNull(), "NO_METADATA")
        .when(value.isNull() | (value < 0), "NEGATIVE")
        .when((value < _of(parameter, units, 0)) | (value > _of(parameter, units, 1)), "OUT_OF_RANGE")
    )
    if event is not None and reference is not None:
        out = out.when(F.unix_timestamp(reference) - F.unix_timestamp(event) > STALE_SECONDS, "STALE")
    return out.otherwise("OK")
