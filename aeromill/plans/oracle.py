"""The same arithmetic as SQL text for another engine, to check the engine's results against."""

from __future__ import annotations

from aeromill.functions import geo
from aeromill.functions.index import BREAKPOINTS, LEVEL_FROM, LEVELS, OZONE_8H_TOP, segments, unit_steps
from aeromill.functions.quality import RANGES, STALE_SECONDS
from aeromill.operators.gold import DAILY_HOURS, WINDOW_HOURS
from aeromill.sources.events import TYPES, WIDE


def num(x: float) -> str:
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def unit_key(u: str) -> str:
    return f"coalesce(translate(lower(trim({u})), 'µμ³ ', 'uu3'), '')"


def in_unit(value: str, units: str, parameter: str, target: str) -> str:
    cases = []
    for unit, steps in unit_steps(parameter, target).items():
        v = value
        for op, number in steps:
            v = f"({v} {op} {num(number)})"
        cases.append(f"WHEN '{unit}' THEN {v}")
    return f"CASE {unit_key(units)} {' '.join(cases)} END"


def truncated(value: str, decimals: int) -> str:
    factor = num(10**decimals)
    return f"(floor({value} * {factor} + {num(1e-9)}) / {factor})"


def from_table(table: str, value: str) -> str:
    rows, c = segments(table), truncated(value, BREAKPOINTS[table][1])
    at = [f"CAST(floor({num(s.slope)} * ({c} - {num(s.start)}) + {num(s.base)} + 0.5) AS INTEGER)" for s in rows]
    cases = [f"WHEN {value} IS NULL OR {value} < 0 OR {c} < {num(rows[0].start)} THEN NULL"]
    cases += [f"WHEN {c} <= {num(s.end)} THEN {a}" for s, a in zip(rows[:-1], at, strict=False)]
    return f"CASE {' '.join(cases)} ELSE {at[-1]} END"


def air_index(parameter: str, value: str, units: str, averaging: str = "instant") -> str:
    ozone = in_unit(value, units, "o3", "ppm")
    eight = f"CASE WHEN {truncated(ozone, 3)} <= {num(OZONE_8H_TOP)} THEN {from_table('o3_8h', ozone)} END"
    one = from_table("o3_1h", ozone)
    o3 = {"8h": f"coalesce({eight}, {one})", "1h": one}.get(averaging, f"greatest({eight}, {one})")
    cases = [f"WHEN 'o3' THEN {o3}"]
    cases += [f"WHEN '{t}' THEN {from_table(t, in_unit(value, units, t, u))}" for t, (u, _, _) in BREAKPOINTS.items() if not t.startswith("o3")]
    return f"CASE WHEN {value} >= 0 THEN CASE lower({parameter}) {' '.join(cases)} END END"


def level_number(index: str) -> str:
    cases = " ".join(f"WHEN {index} >= {LEVEL_FROM[k]} THEN {k}" for k in range(5, 0, -1))
    return f"CASE WHEN {index} IS NULL THEN -1 {cases} ELSE 0 END"


def level_label(level: str) -> str:
    return f"CASE {level} {' '.join(f'WHEN {k} THEN {name!r}' for k, name in enumerate(LEVELS))} ELSE 'UNKNOWN' END"


def limit(parameter: str, units: str, field: int) -> str:
    cases = " ".join(f"WHEN '{p} {u}' THEN {num(r[field])}" for p, by in RANGES.items() for u, r in by.items())
    return f"CASE lower({parameter}) || ' ' || {unit_key(units)} {cases} END"


def flag(parameter: str, units: str, value: str, event: str, reference: str) -> str:
    return f"""CASE WHEN {parameter} IS NULL THEN 'NO_METADATA' WHEN {value} IS NULL OR {value} < 0 THEN 'NEGATIVE'
      WHEN {value} < {limit(parameter, units, 0)} OR {value} > {limit(parameter, units, 1)} THEN 'OUT_OF_RANGE'
      WHEN floor(epoch({reference})) - floor(epoch({event})) > {STALE_SECONDS} THEN 'STALE' ELSE 'OK' END"""


def local(ts: str) -> str:
    return f"timezone('America/New_York', timezone('UTC', {ts}))"


def text(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"


def day(d: str) -> str:
    return f"strftime({d}, '%Y-%m-%d')"


def by_type(field: int) -> str:
    value = (lambda v: num(v)) if field == 2 else (lambda v: f"'{v}'")
    return f"CASE event_type {' '.join(f'WHEN {t!r} THEN {value(WIDE[t][field])}' for t in TYPES)} END"


def region(lat: str, lon: str) -> str:
    """Ray casting as one CASE: parity of the edges that a ray from the point crosses."""
    cases = []
    for name, ring in geo.OUTLINES.items():
        crossings = [
            f"CASE WHEN ({num(y1)} > {lat}) <> ({num(y2)} > {lat}) AND {lon} < ({num(x2)} - {num(x1)}) * ({lat} - {num(y1)}) / ({num(y2)} - {num(y1)}) + {num(x1)} THEN 1 ELSE 0 END"
            for (x1, y1), (x2, y2) in zip(ring, [*ring[1:], ring[0]], strict=True)
        ]
        cases.append(f"WHEN ({' + '.join(crossings)}) % 2 = 1 THEN '{name}'")
    return f"CASE {' '.join(cases)} END"


DENSE = """dense AS (
  SELECT event_id, CAST((user_id % 4 + 1) * 10 + event_id % 2 AS INTEGER) AS sensor_id, CAST(user_id % 4 + 1 AS INTEGER) AS location_id,
    'station ' || CAST(user_id % 4 + 1 AS VARCHAR) AS location_name,
    CASE user_id % 4 WHEN 0 THEN 'Queens' WHEN 1 THEN 'Brooklyn' WHEN 2 THEN 'Bronx' END AS borough,
    CASE WHEN event_id % 2 = 0 THEN 'pm25' ELSE 'o3' END AS parameter, CASE WHEN event_id % 2 = 0 THEN 'µg/m³' ELSE 'ppm' END AS units,
    CASE WHEN event_id % 2 = 0 THEN value ELSE value / 1000.0::DOUBLE END AS value, ts AS event_time
  FROM events)"""
WIDE_CTE = f"""wide AS (
  SELECT event_id, CAST(user_id % 25 * 10 + list_position([{', '.join(repr(t) for t in TYPES)}], event_type) AS INTEGER) AS sensor_id,
    CAST(user_id % 25 AS INTEGER) AS location_id, {by_type(0)} AS parameter, {by_type(1)} AS units, value / {by_type(2)} AS value, ts AS event_time
  FROM events)"""
DIM = """dim_station AS (
  SELECT CAST(n_nationkey AS INTEGER) AS location_id, n_name AS name, 40.5::DOUBLE + n_nationkey / 60.0::DOUBLE AS lat, -74.2::DOUBLE + n_nationkey / 50.0::DOUBLE AS lon,
    CASE WHEN r_name <> 'MIDDLE EAST' THEN r_name END AS borough
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""
DEFECTIVE = f"""{WIDE_CTE}, defective AS (
  SELECT event_id, sensor_id, location_id, event_time, CASE WHEN event_id % 101 <> 0 THEN parameter END AS parameter, CASE WHEN event_id % 103 <> 0 THEN units END AS units,
    CASE WHEN event_id % 83 = 0 THEN NULL WHEN event_id % 97 = 0 THEN -value WHEN event_id % 89 = 0 THEN 250000.0::DOUBLE ELSE value END AS value,
    event_time + to_hours(CAST(event_id % 5 AS INTEGER)) AS ingested_at,
    CASE WHEN event_id % 7 = 0 THEN 'openaq-archive' WHEN event_id % 11 <> 0 THEN 'openaq-api' END AS source
  FROM wide)"""
SENSORS = f"""{DIM}, sensors AS (
  SELECT d.location_id * 10 + t.k AS sensor_id, d.location_id, d.name AS location_name, t.parameter, t.units, d.lat, d.lon
  FROM dim_station d CROSS JOIN (VALUES {', '.join(f"({k + 1}, '{WIDE[t][0]}', '{WIDE[t][1]}')" for k, t in enumerate(TYPES))}) t(k, parameter, units)
  WHERE (d.location_id * 10 + t.k) % 13 <> 0)"""


def hourly(source: str, name: str = "fact_hourly") -> str:
    return f"""{name} AS (
  SELECT *, CAST({local('hour_utc')} AS DATE) AS date_local, CAST(hour({local('hour_utc')}) AS INTEGER) AS hour_local,
    {air_index('parameter', 'value_avg', 'units')} AS aqi_hourly
  FROM (SELECT location_id, parameter, date_trunc('hour', event_time) AS hour_utc, avg(value) AS value_avg, count(value) AS n_readings, min(units) AS units
        FROM {source} GROUP BY ALL))"""


ROLLED = f"""rolled AS (
  SELECT *, CASE WHEN n_8h >= {WINDOW_HOURS} THEN avg_raw END AS avg_8h FROM (
    SELECT *, count(value_avg) OVER w AS n_8h, avg(value_avg) OVER w AS avg_raw FROM fact_hourly
    WINDOW w AS (PARTITION BY location_id, parameter ORDER BY hour_utc RANGE BETWEEN INTERVAL 7 HOURS PRECEDING AND CURRENT ROW)))"""
DAILY = f"""{ROLLED}, param_daily AS (
  SELECT *, CASE WHEN parameter IN ('pm25', 'pm10') THEN CASE WHEN n_hours >= {DAILY_HOURS} THEN {air_index('parameter', 'avg_24h', 'units', '24h')} END
      WHEN parameter = 'o3' THEN greatest({air_index('parameter', 'max_8h', 'units', '8h')}, {air_index('parameter', 'max_1h', 'units', '1h')})
      WHEN parameter = 'co' THEN {air_index('parameter', 'max_8h', 'units', '8h')}
      WHEN parameter IN ('no2', 'so2') THEN {air_index('parameter', 'max_1h', 'units')} END AS param_aqi
  FROM (SELECT location_id, date_local, parameter, avg(value_avg) AS avg_24h, count(value_avg) AS n_hours, max(value_avg) AS max_1h, max(avg_8h) AS max_8h, min(units) AS units
        FROM rolled GROUP BY ALL)
), fact_daily AS (
  SELECT location_id, date_local, top.p AS dominant_pollutant, top.v AS aqi_daily, {level_label(level_number('top.v'))} AS level
  FROM (SELECT location_id, date_local, max({{'v': param_aqi, 'p': parameter}}) AS top FROM param_daily WHERE param_aqi IS NOT NULL GROUP BY ALL))"""
STATION_HOURLY = """station_hourly AS (
  SELECT location_id, hour_utc, date_local, hour_local, max(aqi_hourly) AS aqi, max(aqi_hourly) FILTER (WHERE parameter = 'pm25') AS aqi_pm25,
    max(aqi_hourly) FILTER (WHERE parameter = 'o3') AS aqi_o3
  FROM fact_hourly WHERE aqi_hourly IS NOT NULL GROUP BY ALL)"""
STATUS = f"""indexed AS (SELECT *, {air_index('parameter', 'value', 'units')} AS aqi_instant FROM wide
), station_index AS (
  SELECT location_id, event_time, top.v AS station_aqi, top.p AS dominant_pollutant
  FROM (SELECT location_id, event_time, max({{'v': aqi_instant, 'p': parameter}}) AS top FROM indexed WHERE aqi_instant IS NOT NULL GROUP BY ALL)
), status AS (
  SELECT location_id, s.station_aqi, s.dominant_pollutant, {level_number('s.station_aqi')} AS alerted_level, s.event_time AS last_event_time
  FROM (SELECT location_id, max_by({{'station_aqi': station_aqi, 'dominant_pollutant': dominant_pollutant, 'event_time': event_time}}, event_time) AS s FROM station_index GROUP BY ALL))"""


def fold(obs: str, settled: bool, name: str = "fold") -> str:
    """The alert machine as a recursion over ``obs`` (k, rn from 1, event_time, aqi, s: level), one row per key and step."""
    near = "FALSE" if settled else f"aqi > [{', '.join(map(str, LEVEL_FROM))}][lv + 1] - 10"
    return f"""{name} AS (
  SELECT DISTINCT k, CAST(0 AS BIGINT) AS rn, CAST(0 AS INTEGER) AS lv, CAST(NULL AS INTEGER) AS cand, CAST(0 AS INTEGER) AS seen, CAST(NULL AS TIMESTAMP) AS told_at,
    CAST(NULL AS INTEGER) AS told_level, CAST(NULL AS VARCHAR) AS kind, CAST(NULL AS INTEGER) AS alert_level, CAST(NULL AS INTEGER) AS previous FROM {obs}
  UNION ALL
  SELECT k, rn, CAST(next AS INTEGER), CAST(next_cand AS INTEGER), CAST(CASE WHEN next_cand IS NULL THEN 0 ELSE n END AS INTEGER), CASE WHEN said THEN event_time ELSE told_at END,
    CAST(CASE WHEN said THEN next ELSE told_level END AS INTEGER), CASE WHEN said THEN want END, CAST(CASE WHEN said THEN next END AS INTEGER), CAST(CASE WHEN said THEN lv END AS INTEGER)
  FROM (SELECT *, want IS NOT NULL AND NOT (told_at IS NOT NULL AND epoch(event_time) - epoch(told_at) < 3600 AND told_level = next) AS said FROM (
    SELECT *, CASE WHEN s > lv THEN CASE WHEN s = 2 AND n < 2 THEN lv ELSE s END WHEN s < lv AND lv < 2 THEN s WHEN s < lv AND NOT near AND n >= 2 THEN target ELSE lv END AS next,
      CASE WHEN s > lv AND s = 2 AND n < 2 THEN s WHEN s < lv AND lv >= 2 AND NOT near AND n < 2 THEN target END AS next_cand,
      CASE WHEN s > lv AND (s > 2 OR (s = 2 AND n >= 2)) THEN 'ESCALATE' WHEN s < lv AND lv >= 2 AND NOT near AND n >= 2 AND target < 2 THEN 'RECOVERED' END AS want
    FROM (SELECT *, CASE WHEN s > lv THEN CASE WHEN cand = s THEN seen + 1 ELSE 1 END WHEN cand < lv THEN seen + 1 ELSE 1 END AS n, CASE WHEN cand < lv THEN greatest(cand, s) ELSE s END AS target
      FROM (SELECT f.k, o.rn, o.event_time, o.aqi, o.s, f.lv, f.cand, f.seen, f.told_at, f.told_level, coalesce({near.replace('aqi', 'o.aqi').replace('lv', 'f.lv')}, FALSE) AS near
        FROM {name} f JOIN {obs} o ON o.k = f.k AND o.rn = f.rn + 1)))))"""


#: The dense view's index rows, the machine's steps over them, and the trail.
TRAIL = f"""indexed AS (SELECT *, {air_index('parameter', 'value', 'units')} AS aqi_instant FROM dense), obs AS (
  SELECT location_id AS k, event_time, top.v AS aqi, top.p AS dominant_pollutant, {level_number('top.v')} AS s, row_number() OVER (PARTITION BY location_id ORDER BY event_time) AS rn
  FROM (SELECT location_id, event_time, max({{'v': aqi_instant, 'p': parameter}}) AS top FROM indexed WHERE aqi_instant IS NOT NULL GROUP BY ALL)
), {fold('obs', False)}, trail AS (
  SELECT CAST(o.k AS BIGINT) AS location_id, o.event_time, o.aqi, o.dominant_pollutant, f.lv, f.cand, f.seen, f.kind, f.alert_level, f.previous, o.rn FROM obs o JOIN fold f ON f.k = o.k AND f.rn = o.rn)"""
