import math
import random
from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aeromill.functions import geo, quality, timeparts
from aeromill.functions import index as ix

MICRO, MU = "µg/m³", "μg/m³"


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def index(spark, parameter, value, units, averaging="instant"):
    return one(spark, ix.air_index(F.lit(parameter).cast("string"), F.lit(value).cast("double"), F.lit(units).cast("string"), averaging))[0]


def plain(parameter, value, units, averaging="instant"):
    """The same in plain Python, written from the published rules."""
    if parameter is None or value is None or math.isnan(value) or value < 0:
        return None
    name = parameter.lower()

    def table(key, c):
        _, decimals, rows = ix.BREAKPOINTS[key]
        c = math.floor(c * 10**decimals + 1e-9) / 10**decimals
        if c < rows[0][0]:
            return None
        lo, hi, a, b = next((r for r in rows if c <= r[1]), rows[-1])
        return math.floor((b - a) / (hi - lo) * (c - lo) + a + 0.5)

    def unit(target):
        key = (units or "").strip().lower().replace("µ", "u").replace("μ", "u").replace("³", "3").replace(" ", "")
        steps = ix.unit_steps(name, target).get(key)
        c = value
        for op, n in steps or []:
            c = c * n if op == "*" else c / n
        return None if steps is None else c

    if name == "o3":
        c = unit("ppm")
        if c is None:
            return None
        eight = table("o3_8h", c) if math.floor(c * 1000 + 1e-9) / 1000 <= 0.2 else None
        hour = table("o3_1h", c)
        if averaging == "1h":
            return hour
        if averaging == "8h":
            return hour if eight is None else eight
        return max((x for x in (eight, hour) if x is not None), default=None)
    if name not in ix.BREAKPOINTS or "_" in name:
        return None
    c = unit(ix.BREAKPOINTS[name][0])
    return None if c is None else table(name, c)


@pytest.mark.parametrize(
    "args,want",
    [
        (("pm25", 20.0, MICRO), 71), (("pm25", 9.0, MICRO), 50), (("pm25", 9.1, MICRO), 51), (("pm25", 35.4, MU), 100), (("pm25", 35.5, "ug/m3"), 101),
        (("pm25", 9.09, MICRO), 50), (("PM25", 60.0, MICRO), 154), (("o3", 0.060, "ppm", "8h"), 67), (("no2", 53.0, "ppb"), 50), (("no2", 0.054, "ppm"), 51),
        (("no2", 18.82, MICRO), 9), (("pm25", 1.0, "ppm"), None), (("bc", 3.0, MICRO), None), (("o3", 0.1, "ppm", "1h"), None), (("pm25", -1.0, MICRO), None),
        (("pm25", float("nan"), MICRO), None), ((None, 1.0, MICRO), None), (("pm25", None, MICRO), None), (("pm25", 20.0, None), 71), (("o3_8h", 0.06, "ppm"), None),
    ],
)
def test_known_values(spark, args, want):
    assert index(spark, *args) == want
    assert plain(*args) == want


def test_above_the_table(spark):
    assert index(spark, "pm25", 400.0, MICRO) > 500
    assert index(spark, "o3", 0.25, "ppm", "8h") == plain("o3", 0.25, "ppm", "1h")


def test_random_grid_against_plain_python(spark):
    r = random.Random(11)
    units = ["ppm", "ppb", MICRO, MU, "mg/m3", " UG / M3 ", "", None, "x"]
    rows = [(r.choice(["pm25", "pm10", "o3", "no2", "SO2", "co", "x"]), round(10 ** r.uniform(-3, 3.3), r.randrange(5)), r.choice(units)) for _ in range(4000)]
    df = spark.createDataFrame(rows, "p string, v double, u string")
    for averaging in ix.AVERAGINGS:
        got = df.select("*", ix.air_index(F.col("p"), F.col("v"), F.col("u"), averaging).alias("i")).collect()
        bad = [(g, plain(g.p, g.v, g.u, averaging)) for g in got if g.i != plain(g.p, g.v, g.u, averaging)]
        assert not bad, bad[:3]


def test_index_never_falls(spark):
    for name, (unit, _, rows) in ix.BREAKPOINTS.items():
        top = rows[-1][1] * 1.5
        df = spark.range(2000).select((F.col("id") * top / 2000).alias("c"))
        values = [r.i for r in df.orderBy("c").select(ix.from_table(name, F.col("c")).alias("i")).collect() if r.i is not None]
        assert values == sorted(values) and unit


@given(st.one_of(st.none(), st.integers(-5, 900)))
@settings(max_examples=60, deadline=None)
def test_levels(value):
    level = ix.level_of(value)
    assert level == (-1 if value is None else max([k for k, x in enumerate(ix.LEVEL_FROM) if value >= x], default=0))
    assert ix.label_of(level) == ("UNKNOWN" if level < 0 else ix.LEVELS[level])


def test_level_columns(spark):
    values = [None, 0, 50, 51, 100, 101, 150, 151, 200, 201, 300, 301, 900]
    df = spark.createDataFrame([(v,) for v in values], "v int")
    got = df.select("v", ix.level_number(F.col("v")).alias("n"), ix.level_label(ix.level_number(F.col("v"))).alias("t")).collect()
    assert [(r.n, r.t) for r in got] == [(ix.level_of(v), ix.label_of(ix.level_of(v))) for v in values]


def test_flags(spark):
    now = datetime(2026, 9, 26, 14)

    def flag(p, u, v, hours=None):
        event = None if hours is None else F.lit(now - timedelta(hours=hours)).cast("timestamp")
        return one(spark, quality.flag(F.lit(p).cast("string"), F.lit(u), F.lit(v).cast("double"), event, None if hours is None else F.lit(now).cast("timestamp")))[0]

    assert flag(None, "ppm", 1.0) == "NO_METADATA"
    assert flag("pm25", MICRO, -1.0) == flag("pm25", MICRO, None) == "NEGATIVE"
    assert flag("pm25", MICRO, 5000.0) == "OUT_OF_RANGE"
    assert (flag("o3", "ppm", 0.05, 4), flag("o3", "ppm", 0.05, 3), flag("o3", "ppm", 0.05, 1)) == ("STALE", "OK", "OK")
    assert flag("bc", MICRO, 3.0) == "OK"
    thresholds = one(spark, quality.threshold(F.lit("pm25"), F.lit(MICRO)), quality.threshold(F.lit("bc"), F.lit(MICRO)))
    assert thresholds == (35.4, None)
    assert one(spark, quality.exceeds(F.lit("pm25"), F.lit(MICRO), F.lit(35.4)), quality.exceeds(F.lit("bc"), F.lit(MICRO), F.lit(1e9))) == (False, False)


def test_regions_and_box(spark):
    points = [(40.73, -73.82, "Queens"), (40.78, -73.97, "Manhattan"), (40.84, -73.88, "Bronx"), (40.65, -73.95, "Brooklyn"), (40.58, -74.15, "Staten Island"), (40.74, -74.17, None), (None, -73.9, None)]
    df = spark.createDataFrame(points, "lat double, lon double, want string")
    assert all(r.want == r.borough for r in geo.with_region(df).collect())
    assert [r[0] for r in df.select(geo.in_box(F.col("lat"), F.col("lon"))).collect()] == [True] * 6 + [False]
    assert one(spark, geo.in_box(F.lit(34.05), F.lit(-118.24))) == (False,)
    assert geo.edge_table(spark).count() == sum(map(len, geo.OUTLINES.values()))


def test_periods_and_daylight_saving(spark):
    day = lambda d: F.lit(d).cast("date")
    got = one(spark, *[timeparts.season(day(f"2025-{m:02d}-15")) for m in range(1, 13)])
    assert got == ("winter",) * 2 + ("spring",) * 3 + ("summer",) * 3 + ("autumn",) * 3 + ("winter",)
    assert one(spark, timeparts.period(day("2025-12-31"), "season"), timeparts.period(day("2025-12-31"), "month")) == ("2025-winter", "2025-12")
    hours = spark.createDataFrame([("2026-11-01 05:30:00",), ("2026-11-01 06:30:00",)], "t string").select(F.hour(timeparts.local(F.col("t").cast("timestamp"))).alias("h")).collect()
    assert [r.h for r in hours] == [1, 1]
