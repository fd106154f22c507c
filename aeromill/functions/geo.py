"""Bounding boxes, and regions of points by ray casting against a small edge table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: lon, lat, lon, lat.
DEFAULT_BOX = "-74.27,40.48,-73.68,40.93"

#: Rough outlines (lon, lat) of the five regions, drawn for this library; good to about a
#: kilometre. Order matters: a point in two outlines belongs to the first.
OUTLINES = {
    "Manhattan": [(-74.02, 40.70), (-73.97, 40.71), (-73.94, 40.775), (-73.927, 40.80), (-73.932, 40.835), (-73.907, 40.876), (-73.93, 40.88), (-74.013, 40.757)],
    "Bronx": [(-73.93, 40.88), (-73.907, 40.876), (-73.932, 40.835), (-73.927, 40.80), (-73.88, 40.795), (-73.78, 40.81), (-73.75, 40.87), (-73.86, 40.905), (-73.915, 40.917)],
    "Queens": [(-73.962, 40.74), (-73.94, 40.775), (-73.91, 40.79), (-73.78, 40.80), (-73.70, 40.755), (-73.725, 40.65), (-73.75, 40.59), (-73.94, 40.54), (-73.83, 40.60), (-73.86, 40.67), (-73.90, 40.70)],
    "Brooklyn": [(-73.962, 40.74), (-73.90, 40.70), (-73.86, 40.67), (-73.88, 40.60), (-73.94, 40.565), (-74.01, 40.565), (-74.045, 40.62), (-74.02, 40.68), (-73.99, 40.705)],
    "Staten Island": [(-74.05, 40.60), (-74.07, 40.65), (-74.20, 40.645), (-74.255, 40.51), (-74.24, 40.495), (-74.10, 40.54)],
}


def parse_box(box: str = DEFAULT_BOX) -> tuple[float, float, float, float]:
    """(min lon, min lat, max lon, max lat) of "lon,lat,lon,lat"."""
    west, south, east, north = map(float, box.split(","))
    return west, south, east, north


def in_box(lat: Column, lon: Column, box: str = DEFAULT_BOX) -> Column:
    """Inclusive; null coordinates are outside."""
    west, south, east, north = parse_box(box)
    return F.coalesce(lat.between(south, north) & lon.between(west, east), F.lit(False))


def edge_table(spark: SparkSession, outlines: dict[str, list[tuple[float, float]]] | None = None) -> DataFrame:
    """One row per outline edge: (region, rank, x1, y1, x2, y2)."""
    rows = [
        (name, rank, *a, *b)
        for rank, (name, ring) in enumerate((OUTLINES if outlines is None else outlines).items())
        for a, b in zip(ring, [*ring[1:], ring[0]], strict=True)
    ]
    return spark.createDataFrame(rows, "region string, rank int, x1 double, y1 double, x2 double, y2 double")


def region_of(lat: Column, lon: Column, outlines: dict | None = None) -> Column:
    """The first region whose outline holds the point, or null.

    A point is inside if a ray from it crosses the outline an odd number of times. The outlines are
    literals in plain arithmetic (their size is fixed by configuration), so this is compiled and
    needs no join.
    """
    found = F.when(lat.isNull() | lon.isNull(), F.lit(None).cast("string"))
    for name, ring in (OUTLINES if outlines is None else outlines).items():
        crossed = None
        for (x1, y1), (x2, y2) in zip(ring, [*ring[1:], ring[0]], strict=True):
            if y1 == y2:
                continue  # no ray crosses a level edge
            one = (((F.lit(y1) > lat) != (F.lit(y2) > lat)) & (lon < F.lit(x2 - x1) * (lat - F.lit(y1)) / F.lit(y2 - y1) + F.lit(x1))).cast("int")
            crossed = one if crossed is None else crossed + one
        found = found.when(crossed % 2 == 1, F.lit(name))
    return found


def with_region(points: DataFrame, lat: str = "lat", lon: str = "lon", column: str = "borough", outlines: dict | None = None) -> DataFrame:
    """``points`` with their region."""
    return points.withColumn(column, region_of(F.col(lat), F.col(lon), outlines))
