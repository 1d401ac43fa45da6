"""SQL fragments for the second-engine check (DuckDB dialect).

They restate the fixture derivation and the operator semantics as plain SQL
so that every registered query has an independent answer to compare with.
"""

from __future__ import annotations

from ..functions.geo import SPHERE_R, WGS84_A, WGS84_F
from ..sources import derived as D


def geodesic_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    f = repr(WGS84_F)
    b1 = f"atan((1 - {f}) * tan(radians({lat1})))"
    b2 = f"atan((1 - {f}) * tan(radians({lat2})))"
    dl = f"radians({lon2} - {lon1})"
    h = f"(pow(sin(({b2} - {b1}) / 2), 2) + cos({b1}) * cos({b2}) * pow(sin({dl} / 2), 2))"
    sigma = f"(2 * asin(sqrt(least(greatest({h}, 0.0), 1.0))))"
    p = f"(({b1} + {b2}) / 2)"
    q = f"(({b2} - {b1}) / 2)"
    x = f"(({sigma} - sin({sigma})) * pow(sin({p}), 2) * pow(cos({q}), 2) / pow(cos({sigma} / 2), 2))"
    y = (f"(({sigma} + sin({sigma})) * pow(cos({p}), 2) * pow(sin({q}), 2) / "
         f"nullif(pow(sin({sigma} / 2), 2), 0))")
    return (f"(CASE WHEN {sigma} = 0 THEN 0.0 ELSE "
            f"{WGS84_A!r} * ({sigma} - {WGS84_F / 2!r} * ({x} + {y})) END)")


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (f"(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
         f" * pow(sin(radians({lon2} - {lon1}) / 2), 2))")
    return f"({SPHERE_R!r} * 2 * atan2(sqrt({a}), sqrt(1 - {a})))"


def dur_sql(t0: str, t1: str) -> str:
    return f"((epoch_us({t1}) - epoch_us({t0})) / 1e6)"


def speed_sql(m: str, s: str) -> str:
    return f"coalesce(CASE WHEN {s} = 0 THEN NULL ELSE {m} / {s} * 3.6 END, 0.0)"


_modes = ", ".join(f"'{m}'" for m in D.MODES)
_windows = ", ".join(f"({i}, TIMESTAMP '{s}', TIMESTAMP '{t}')" for i, s, t in D.LABEL_WINDOWS)

# Base relations shared by the trajectory queries: points, labels, matched,
# dedup, lagged (with speed), clean.
BASE_CTES = f"""
ev AS (
  SELECT event_id, ts, CAST(user_id AS INTEGER) AS user_id,
         (event_id * {D.LAT_MULT}) % {D.STEP_MOD} - {D.STEP_HALF} AS dlat,
         (event_id * {D.LON_MULT}) % {D.STEP_MOD} - {D.STEP_HALF} AS dlon
  FROM events),
walk AS (
  SELECT *,
    CAST(sum(dlat) OVER (PARTITION BY user_id ORDER BY ts, event_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS slat,
    CAST(sum(dlon) OVER (PARTITION BY user_id ORDER BY ts, event_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS slon
  FROM ev),
points AS (
  SELECT user_id, CASE WHEN ts < TIMESTAMP '{D.FILE_SPLIT_TS}' THEN 0 ELSE 1 END AS plt_idx,
         event_id * 2 AS line_no, ts,
         CASE WHEN event_id % {D.BAD_LAT_EVERY} = 0 THEN {D.BAD_LAT}
              ELSE ({D.LAT0_MICRO} + slat) / 1e6 END AS lat,
         CASE WHEN event_id % {D.NULL_LON_EVERY} = 0 THEN NULL WHEN event_id % {D.NAN_LON_EVERY} = 0 THEN CAST('nan' AS DOUBLE)
              ELSE ({D.LON0_MICRO} + slon) / 1e6 END AS lon, CAST(0.0 AS DOUBLE) AS altitude
  FROM walk
  UNION ALL
  SELECT user_id, CASE WHEN ts < TIMESTAMP '{D.FILE_SPLIT_TS}' THEN 0 ELSE 1 END,
         event_id * 2 + 1, ts, ({D.LAT0_MICRO} + slat + {D.DUP_LAT_SHIFT}) / 1e6,
         ({D.LON0_MICRO} + slon) / 1e6, CAST(0.0 AS DOUBLE)
  FROM walk WHERE event_id % {D.DUP_EVERY} = 0),
lab AS (
  SELECT u.user_id, w.label_idx, w.start_ts, w.end_ts,
         ([{_modes}])[(u.user_id + w.label_idx) % 5 + 1] AS transport_mode
  FROM (SELECT DISTINCT CAST(user_id AS INTEGER) AS user_id FROM events
        WHERE user_id % {D.NO_LABEL_USER_MOD[0]} <> {D.NO_LABEL_USER_MOD[1]}) u,
       (VALUES {_windows}) w(label_idx, start_ts, end_ts)),
matched AS (
  SELECT printf('%03d_%04d_%04d', p.user_id, l.label_idx, p.plt_idx) AS unique_id,
         p.user_id, p.plt_idx, l.label_idx, p.line_no, p.ts, p.lat, p.lon, p.altitude,
         l.transport_mode
  FROM points p JOIN lab l ON p.user_id = l.user_id AND p.ts BETWEEN l.start_ts AND l.end_ts),
ranged AS (SELECT * FROM matched WHERE lat BETWEEN -90 AND 90 AND NOT isnan(lat)),
located AS (SELECT * FROM ranged WHERE lon IS NOT NULL AND isfinite(lon)),
dedup AS (
  SELECT * FROM located
  QUALIFY row_number() OVER (PARTITION BY unique_id, ts ORDER BY line_no) = 1),
lagged AS (
  SELECT *, lag(lat) OVER w AS prev_lat, lag(lon) OVER w AS prev_lon, lag(ts) OVER w AS prev_ts
  FROM dedup WINDOW w AS (PARTITION BY unique_id ORDER BY ts)),
dist AS (
  SELECT *, {geodesic_sql('lat', 'lon', 'prev_lat', 'prev_lon')} AS distance_m,
         {dur_sql('prev_ts', 'ts')} AS time_s
  FROM lagged WHERE prev_lat IS NOT NULL),
speeds AS (SELECT *, {speed_sql('distance_m', 'time_s')} AS speed_kmh FROM dist),
fast_ok AS (SELECT * FROM speeds WHERE speed_kmh <= 200.0),
valid_ids AS (SELECT unique_id FROM fast_ok GROUP BY unique_id HAVING count(*) >= 10),
clean AS (
  SELECT unique_id, user_id, ts, lat, lon, altitude, transport_mode
  FROM fast_ok WHERE unique_id IN (SELECT unique_id FROM valid_ids)),
ksteps0 AS (
  SELECT *, lag(lat) OVER w AS p_lat, lag(lon) OVER w AS p_lon, lag(ts) OVER w AS p_ts
  FROM clean WHERE transport_mode IS NOT NULL WINDOW w AS (PARTITION BY unique_id ORDER BY ts)),
ksteps1 AS (
  SELECT *, {haversine_sql('p_lat', 'p_lon', 'lat', 'lon')} AS step_m,
         greatest({dur_sql('p_ts', 'ts')}, 1e-6) AS dt_s
  FROM ksteps0 WHERE p_ts IS NOT NULL),
ksteps2 AS (
  SELECT *, step_m / dt_s AS v FROM ksteps1),
ksteps AS (
  SELECT *, CASE WHEN q_v IS NULL THEN 0.0
                 WHEN (dt_s + q_dt) / 2.0 > 1e-6 THEN (v - q_v) / ((dt_s + q_dt) / 2.0)
                 ELSE 0.0 END AS acc
  FROM (SELECT *, lag(v) OVER w AS q_v, lag(dt_s) OVER w AS q_dt FROM ksteps2
        WINDOW w AS (PARTITION BY unique_id ORDER BY ts)))
"""


def with_base(body: str, ctes: str = "") -> str:
    """A full statement: the shared relations, extra ``ctes``, then ``body``."""
    extra = (",\n" + ctes.strip().rstrip(",")) if ctes.strip() else ""
    return "WITH " + BASE_CTES.strip() + extra + "\n" + body
