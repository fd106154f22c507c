"""Air-quality index as column expressions: unit conversion, truncation, interpolation, levels.

Everything here builds plain Catalyst expressions; no Python runs per row. Each builder has a
twin in ``aeromill.plans.oracle`` that writes the same arithmetic as SQL text for another engine.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# The published breakpoint tables. Per table: unit, decimals kept by truncation,
# rows of (concentration from, to, index from, to).
BREAKPOINTS = {
    "pm25": ("ug/m3", 1, [
        (0.0, 9.0, 0, 50), (9.1, 35.4, 51, 100), (35.5, 55.4, 101, 150),
        (55.5, 125.4, 151, 200), (125.5, 225.4, 201, 300), (225.5, 325.4, 301, 500),
    ]),
    "pm10": ("ug/m3", 0, [
        (0, 54, 0, 50), (55, 154, 51, 100), (155, 254, 101, 150),
        (255, 354, 151, 200), (355, 424, 201, 300), (425, 604, 301, 500),
    ]),
    "o3_8h": ("ppm", 3, [
        (0.000, 0.054, 0, 50), (0.055, 0.070, 51, 100), (0.071, 0.085, 101, 150),
        (0.086, 0.105, 151, 200), (0.106, 0.200, 201, 300),
    ]),
    "o3_1h": ("ppm", 3, [
        (0.125, 0.164, 101, 150), (0.165, 0.204, 151, 200),
        (0.205, 0.404, 201, 300), (0.405, 0.604, 301, 500),
    ]),
    "no2": ("ppb", 0, [
        (0, 53, 0, 50), (54, 100, 51, 100), (101, 360, 101, 150),
        (361, 649, 151, 200), (650, 1249, 201, 300), (1250, 2049, 301, 500),
    ]),
    "so2": ("ppb", 0, [
        (0, 35, 0, 50), (36, 75, 51, 100), (76, 185, 101, 150),
        (186, 304, 151, 200), (305, 604, 201, 300), (605, 1004, 301, 500),
    ]),
    "co": ("ppm", 1, [
        (0.0, 4.4, 0, 50), (4.5, 9.4, 51, 100), (9.5, 12.4, 101, 150),
        (12.5, 15.4, 151, 200), (15.5, 30.4, 201, 300), (30.5, 50.4, 301, 500),
    ]),
}
# Level names from 0 up, the index at which each begins, the level of no data.
LEVELS = ("GOOD", "MODERATE", "USG", "UNHEALTHY", "VERY_UNHEALTHY", "HAZARDOUS")
LEVEL_FROM = (0, 51, 101, 151, 201, 301)
UNKNOWN = -1
# Molar masses (g/mol) and molar volume (l/mol at 25 degrees C, 1 atm).
MOLAR_MASS = {"o3": 48.00, "no2": 46.01, "so2": 64.07, "co": 28.01}
MOLAR_VOLUME = 24.45
#: The 8-hour ozone table ends here; above it only the 1-hour table is defined.
OZONE_8H_TOP = 0.200

POLLUTANTS = ("pm25", "pm10", "o3", "no2", "so2", "co")
AVERAGINGS = ("instant", "1h", "8h", "24h")


@dataclass(frozen=True)
class Segment:
    """One straight piece of a table: index = slope * (c - start) + base for c up to ``end``."""

    start: float
    end: float
    base: int
    slope: float


def segments(table: str) -> list[Segment]:
    return [Segment(float(a), float(b), i, (j - i) / (float(b) - float(a))) for a, b, i, j in BREAKPOINTS[table][2]]


def unit_steps(parameter: str, target: str) -> dict[str, list[tuple[str, float]]]:
    """Arithmetic steps (operator, number) from each convertible unit to ``target``."""
    steps: dict[str, list[tuple[str, float]]] = {target: [], "": []}
    mass = MOLAR_MASS.get(parameter)
    if target in ("ppb", "ppm"):
        down = [("/", 1000.0)] if target == "ppm" else []
        if mass:
            steps["ug/m3"] = [("*", MOLAR_VOLUME), ("/", mass), *down]
            steps["mg/m3"] = [("*", 1000.0), ("*", MOLAR_VOLUME), ("/", mass), *down]
        steps["ppb" if target == "ppm" else "ppm"] = [("/", 1000.0)] if target == "ppm" else [("*", 1000.0)]
    elif target == "ug/m3":
        steps["mg/m3"] = [("*", 1000.0)]
    return steps


def unit_key(units: Column) -> Column:
    """Canonical unit: trimmed, lower case, micro signs as u, superscript 3 as 3, no spaces; "" for null."""
    return F.coalesce(F.translate(F.lower(F.trim(units)), "µμ³ ", "uu3"), F.lit(""))


def in_unit(value: Column, units: Column, parameter: str, target: str) -> Column:
    """``value`` in the ``target`` unit; null where the unit cannot be converted. No unit counts as the target."""
    key, out = unit_key(units), None
    for unit, steps in unit_steps(parameter, target).items():
        v = value
        for op, number in steps:
            v = v * F.lit(number) if op == "*" else v / F.lit(number)
        out = F.when(key == unit, v) if out is None else out.when(key == unit, v)
    return out


def truncated(value: Column, decimals: int) -> Column:
    """Cut (not rounded) to so many decimals; a tiny allowance covers binary fractions."""
    factor = float(10**decimals)
    return F.floor(value * factor + 1e-9) / F.lit(factor)


def _n(x: float) -> str:
    return f"{float(x)!r}D"


def _let(value: str, name: str, body: str) -> str:
    """``body`` of a value that is computed once, however often the body names it.

    Without it the tables below would repeat the whole unit conversion in every branch, and the
    optimiser, which writes expressions out when it moves filters, would multiply it again.
    """
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _applied(value: Column, body: str) -> Column:
    """A SQL lambda over one column: a few calls, whatever the size of its body."""
    return F.element_at(F.call_function("transform", F.array(value), F.expr(body)), 1)


@cache
def _table_sql(table: str, c: str) -> str:
    rows = segments(table)
    factor = _n(10 ** BREAKPOINTS[table][1])
    at = [f"CAST(floor({_n(s.slope)} * (t - {_n(s.start)}) + {_n(s.base)} + 0.5D) AS INT)" for s in rows]
    cases = [f"WHEN t < {_n(rows[0].start)} THEN NULL"] + [f"WHEN t <= {_n(s.end)} THEN {v}" for s, v in zip(rows[:-1], at, strict=False)]
    return _let(f"floor({c} * {factor} + 1e-9D) / {factor}", "t", f"CASE {' '.join(cases)} ELSE {at[-1]} END")


@cache
def _index_sql(averaging: str, pollutants: tuple[str, ...]) -> str:
    """A lambda from (name, unit, value) to the index."""
    one = _table_sql("o3_1h", "c")
    eight = f"CASE WHEN floor(c * 1000.0D + 1e-9D) / 1000.0D <= {_n(OZONE_8H_TOP)} THEN {_table_sql('o3_8h', 'c')} END"
    ozone = {"1h": one, "8h": f"coalesce({eight}, {one})"}.get(averaging, f"greatest({eight}, {one})")
    cases = []
    for name, unit in {t.split("_")[0]: unit for t, (unit, _, _) in BREAKPOINTS.items()}.items():
        if name not in pollutants:
            continue
        units = []
        for source, steps in unit_steps(name, unit).items():
            units.append(f"WHEN '{source}' THEN " + "".join(["r.value", *[f" {op} {_n(n)}" for op, n in steps]]))
        body = ozone if name == "o3" else _table_sql(name, "c")
        cases.append(f"WHEN '{name}' THEN " + _let(f"CASE r.unit {' '.join(units)} END", "c", body))
    return f"r -> CASE r.name {' '.join(cases)} END"


def from_table(table: str, concentration: Column) -> Column:
    """Index by interpolation in one table, half rounded up; the last piece runs on above its end."""
    return _applied(F.when(concentration >= 0, concentration.cast("double")), f"c -> {_table_sql(table, 'c')}")


def air_index(parameter: Column, value: Column, units: Column, averaging: str = "instant", pollutants: tuple[str, ...] = POLLUTANTS) -> Column:
    """Index of one pollutant's concentration as an integer column.

    ``averaging`` matters for ozone only: "8h" uses the 8-hour table and, above its end, the
    1-hour one; "1h" the 1-hour table; anything else the larger of both. Null where a part is
    missing, the value is negative or NaN, or pollutant or unit is unknown. ``pollutants``
    narrows the expression where others cannot occur.
    """
    if averaging not in AVERAGINGS:
        raise ValueError(f"averaging is one of {AVERAGINGS}")
    value = value.cast("double")
    reading = F.struct(F.lower(parameter).alias("name"), unit_key(units).alias("unit"), F.when((value >= 0) & ~F.isnan(value), value).alias("value"))
    return _applied(reading, _index_sql(averaging, pollutants))


def level_number(index: Column) -> Column:
    """0..5 by the index at which each level begins; -1 for null."""
    out = F.when(index.isNull(), F.lit(UNKNOWN))
    for level in range(len(LEVELS) - 1, 0, -1):
        out = out.when(index >= LEVEL_FROM[level], F.lit(level))
    return out.otherwise(F.lit(0))


def level_label(level: Column) -> Column:
    """Name of a level number; UNKNOWN for any other number or null."""
    names = F.array(*[F.lit(x) for x in LEVELS])
    return F.when((level >= 0) & (level < len(LEVELS)), F.element_at(names, level + 1)).otherwise(F.lit("UNKNOWN"))


def level_of(index: float | None) -> int:
    """The level of one index value, for the state machine."""
    if index is None:
        return UNKNOWN
    return max((k for k, start in enumerate(LEVEL_FROM) if index >= start), default=0)


def label_of(level: int) -> str:
    return LEVELS[level] if 0 <= level < len(LEVELS) else "UNKNOWN"
