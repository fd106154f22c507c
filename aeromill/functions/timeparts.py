"""Local time of UTC instants, and calendar periods."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZONE = "America/New_York"
#: Timestamps on the wire.
WIRE = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def local(instant: Column, zone: str = ZONE) -> Column:
    """Wall-clock time in ``zone`` of a UTC timestamp (sessions run in UTC)."""
    return F.from_utc_timestamp(instant, zone)


def wire(instant: Column) -> Column:
    return F.date_format(instant, WIRE)


def season(day: Column) -> Column:
    """winter, spring, summer or autumn of the day's month."""
    return F.element_at(F.array(*[F.lit(s) for s in ("winter", "spring", "summer", "autumn")]), F.floor(F.month(day) % 12 / 3).cast("int") + 1)


def period(day: Column, kind: str) -> Column:
    """Label of the day's year, season or month; a season carries the day's own calendar year."""
    if kind == "year":
        return F.date_format(day, "yyyy")
    if kind == "month":
        return F.date_format(day, "yyyy-MM")
    if kind == "season":
        return F.concat_ws("-", F.date_format(day, "yyyy"), season(day))
    raise ValueError("kind is year, season or month")
