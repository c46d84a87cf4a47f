"""Independent SQL (DuckDB dialect) for every registered plan, over the raw `events` table.

The feeds are re-derived in SQL with the same integer/string rules as
roadpulse.sources.feeds, deduplicated with DISTINCT (re-deliveries are identical copies),
and every figure is written the plain way, joins included. Two parity rules keep the
engines bit-identical: a rounded value is rounded HALF_UP from its shortest decimal text
(as Spark's round does), and a mean is an exact sum divided once: of whole numbers for columns
the rules round, of the values' own decimal texts for raw measurements.
"""

from __future__ import annotations

# Fixed values shared with the feed derivation.
_MAKES = "['Toyota', 'Kia', 'Hyundai', 'VinFast', 'Ford']"
_MODELS = "['Vios', 'Morning', 'Accent', 'VF8', 'Ranger']"
_FUELS = "['Gasoline', 'Electric', 'Hybrid']"
_CONDITIONS = "['Sunny', 'Cloudy', 'Rain', 'Stormy']"


def R(x: str, k: int) -> str:
    """HALF_UP rounding of a double through its shortest decimal text."""
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,18)), {k}) AS DOUBLE)"


def M(x: str, scale: int) -> str:
    """Exact mean of a column with `scale` decimals."""
    f = 10 ** scale
    return (f"(CAST(SUM(CAST(round(({x}) * {f}) AS BIGINT)) AS DOUBLE) / "
            f"CAST(COUNT({x}) * {f} AS DOUBLE))")


def WM(x: str) -> str:
    """Exact mean of a raw measurement: its decimal texts summed."""
    return (f"(CAST(CAST(SUM(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,12))) AS VARCHAR) AS DOUBLE) / "
            f"CAST(COUNT({x}) AS DOUBLE))")


def RM(x: str, scale: int, k: int) -> str:
    return R(M(x, scale), k)


def SD(x: str, scale: int) -> str:
    """Sample stddev from exact integer moments (same arithmetic as exact_stddev)."""
    f = 10 ** scale
    s = f"CAST(round(({x}) * {f}) AS HUGEINT)"
    n = f"CAST(COUNT({x}) AS HUGEINT)"
    return (f"CASE WHEN COUNT({x}) > 1 THEN sqrt(CAST({n} * SUM({s} * {s}) - SUM({s}) * SUM({s}) AS DOUBLE)"
            f" / CAST({n} * ({n} - 1) AS DOUBLE)) / {float(f)} END")


_LOC = ("'[10.' || CAST(4113 + n % 3657 AS VARCHAR) || '1,106.' || "
        "CAST(7009 + n % 2991 AS VARCHAR) || '1]'")
_COMMON = ("'{p}' || CAST(n AS VARCHAR) AS id, 'Vehicle-' || CAST(user_id AS VARCHAR) AS vehicle_id")

CTES: dict[str, tuple[list[str], str]] = {
    "obs": ([], """SELECT n, ts, user_id, event_type, value FROM (
        SELECT event_id AS n, ts, user_id, event_type, value,
               unnest(CASE WHEN event_id % 10 = 0 THEN [0, 1] ELSE [0] END) AS copy FROM events)"""),
    "raw_vehicle": (["obs"], f"""SELECT 'veh-' || CAST(n AS VARCHAR) AS id,
        CASE WHEN n % 101 <> 0 THEN 'Vehicle-' || CAST(user_id AS VARCHAR) END AS vehicle_id,
        ts AS timestamp, {_LOC} AS location,
        value + CAST(n % 8 AS DOUBLE) / CAST(1000 AS DOUBLE) AS speed, 'South-East' AS direction, ({_MAKES})[n % 5 + 1] AS make,
        ({_MODELS})[(n // 5) % 5 + 1] AS model, CAST(2018 + n % 7 AS INTEGER) AS year,
        CASE WHEN n % 97 <> 0 THEN ({_FUELS})[n % 3 + 1] END AS fuelType FROM obs"""),
    "raw_gps": (["obs"], f"""SELECT {_COMMON.format(p='gps-')}, ts AS timestamp, value AS speed,
        'South-East' AS direction, 'private' AS vehicleType FROM obs"""),
    "raw_traffic": (["obs"], f"""SELECT {_COMMON.format(p='cam-')},
        'Camera-HighwayAI-0' || CAST(n % 5 AS VARCHAR) AS camera_id, {_LOC} AS location,
        ts AS timestamp, 'Base64EncodedString' AS snapshot FROM obs"""),
    "raw_weather": (["obs"], f"""SELECT {_COMMON.format(p='wx-')}, {_LOC} AS location, ts AS timestamp,
        CAST((n * 7919) % 80000 AS DOUBLE) / CAST(1000 AS DOUBLE) - CAST(15 AS DOUBLE) AS temperature,
        ({_CONDITIONS})[n % 4 + 1] AS weatherCondition,
        CAST((n * 3) % 500 AS DOUBLE) / CAST(10 AS DOUBLE) AS precipitation,
        CAST((n * 11) % 600 AS DOUBLE) / CAST(10 AS DOUBLE) AS windSpeed,
        CAST(n % 111 AS INTEGER) - 5 AS humidity,
        CASE WHEN n % 89 <> 0 THEN CAST((n * 13) % 2500 AS DOUBLE) / CAST(10 AS DOUBLE) END AS airQualityIndex
        FROM obs"""),
    "raw_emergency": (["obs"], f"""SELECT {_COMMON.format(p='emg-')}, 'inc-' || CAST(n AS VARCHAR) AS incidentId,
        CASE event_type WHEN 'error' THEN 'Accident' WHEN 'signup' THEN 'Fire' WHEN 'purchase' THEN 'Medical'
          WHEN 'click' THEN 'Police' WHEN 'view' THEN 'None' END AS type,
        ts AS timestamp, {_LOC} AS location, CASE WHEN n % 2 = 0 THEN 'Active' ELSE 'Resolved' END AS status,
        'Incident on the expressway' AS description FROM obs"""),
    "vehicle": (["raw_vehicle"], f"""SELECT *, strftime(timestamp, '%Y-%m-%d') AS date,
        CAST(hour(timestamp) AS INTEGER) AS hour, {R('speed', 1)} AS speed_kmh,
        fuelType = 'Electric' AS is_ev
        FROM (SELECT DISTINCT * FROM raw_vehicle) WHERE speed BETWEEN 0 AND 200"""),
    "gps": (["raw_gps"], """SELECT *, strftime(timestamp, '%Y-%m-%d') AS date,
        CAST(hour(timestamp) AS INTEGER) AS hour
        FROM (SELECT DISTINCT * FROM raw_gps) WHERE speed BETWEEN 0 AND 200"""),
    "traffic": (["raw_traffic"], """SELECT id, vehicle_id, camera_id, location, timestamp,
        strftime(timestamp, '%Y-%m-%d') AS date FROM (SELECT DISTINCT * FROM raw_traffic)"""),
    "weather": (["raw_weather"], f"""SELECT *, strftime(timestamp, '%Y-%m-%d') AS date,
        {R('temperature + CAST(0.33 AS DOUBLE) * humidity / CAST(10 AS DOUBLE) - CAST(4.0 AS DOUBLE)', 1)} AS heat_index,
        CASE WHEN airQualityIndex <= 50 THEN 'Good' WHEN airQualityIndex <= 100 THEN 'Moderate'
             WHEN airQualityIndex <= 150 THEN 'Unhealthy for Sensitive' ELSE 'Unhealthy' END AS aqi_category
        FROM (SELECT DISTINCT * FROM raw_weather)
        WHERE temperature BETWEEN -10 AND 60 AND humidity BETWEEN 0 AND 100"""),
    "emergency": (["raw_emergency"], """SELECT *, strftime(timestamp, '%Y-%m-%d') AS date,
        status = 'Active' AS is_active, type <> 'None' AS is_real_incident
        FROM (SELECT DISTINCT * FROM raw_emergency)"""),
}


def with_ctes(*names: str) -> str:
    """WITH clause holding the named CTEs and everything they depend on, in order."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in CTES[name][0]:
            visit(dep)
        order.append(name)

    for name in names:
        visit(name)
    return "WITH " + ",\n".join(f"{name} AS ({CTES[name][1]})" for name in order) + "\n"


def sql(uses: list[str], body: str) -> str:
    return with_ctes(*uses) + body


ORACLE: dict[str, str] = {}
_SHORT = ["vehicle", "gps", "traffic", "weather", "emergency"]
for _f in _SHORT:
    ORACLE[f"derive_{_f}"] = sql([f"raw_{_f}"], f"SELECT * FROM raw_{_f}")
    ORACLE[f"refine_{_f}"] = sql([_f], f"SELECT * FROM {_f}")

ORACLE["decode_roundtrip"] = sql(["raw_vehicle"], "SELECT * FROM raw_vehicle")
ORACLE["dedup_id"] = sql(["raw_vehicle"], "SELECT DISTINCT * FROM raw_vehicle")
ORACLE["valid_speed"] = sql(["raw_gps"], "SELECT * FROM raw_gps WHERE speed BETWEEN 0 AND 200")
ORACLE["valid_weather"] = sql(["raw_weather"], """SELECT * FROM raw_weather
    WHERE temperature BETWEEN -10 AND 60 AND humidity BETWEEN 0 AND 100""")

ORACLE["speed_by_make_fuel"] = sql(["vehicle"], f"""
SELECT make, fuelType, COUNT(*) AS trip_count, {RM('speed_kmh', 1, 1)} AS avg_speed_kmh,
       {R('MIN(speed_kmh)', 1)} AS min_speed_kmh, {R('MAX(speed_kmh)', 1)} AS max_speed_kmh,
       {R(SD('speed_kmh', 1), 2)} AS stddev_speed
FROM vehicle GROUP BY make, fuelType ORDER BY avg_speed_kmh DESC""")

ORACLE["speed_by_hour"] = sql(["vehicle"], f"""
SELECT hour, COUNT(*) AS observations, {RM('speed_kmh', 1, 1)} AS avg_speed,
       {R('quantile_disc(speed_kmh, 0.5)', 1)} AS p50_speed, {R('quantile_disc(speed_kmh, 0.95)', 1)} AS p95_speed
FROM vehicle GROUP BY hour ORDER BY hour""")

ORACLE["ev_share_by_date"] = sql(["vehicle"], f"""
SELECT date, COUNT(*) AS total_vehicles, CAST(SUM(CAST(is_ev AS INTEGER)) AS BIGINT) AS ev_count,
       {R('CAST(100 AS DOUBLE) * CAST(SUM(CAST(is_ev AS INTEGER)) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE)', 1)} AS ev_pct
FROM vehicle GROUP BY date ORDER BY date DESC""")

ORACLE["top_models"] = sql(["vehicle"], f"""
SELECT make, model, year, COUNT(*) AS trip_count, {RM('speed_kmh', 1, 1)} AS avg_speed_kmh
FROM vehicle GROUP BY make, model, year ORDER BY trip_count DESC, make, model, year LIMIT 15""")

ORACLE["speed_by_make"] = sql(["vehicle"], f"""
SELECT make, {R(WM('speed'), 1)} AS avg_speed, COUNT(*) AS trips
FROM vehicle GROUP BY make ORDER BY avg_speed DESC""")

ORACLE["speed_by_weather"] = sql(["vehicle", "weather"], f"""
SELECT w.weatherCondition, w.aqi_category, COUNT(v.id) AS vehicle_obs,
       {RM('v.speed_kmh', 1, 1)} AS avg_speed_kmh, {R(WM('w.temperature'), 1)} AS avg_temp_c,
       {RM('w.heat_index', 1, 1)} AS avg_heat_index, {RM('w.humidity', 0, 0)} AS avg_humidity_pct
FROM vehicle v JOIN weather w ON v.vehicle_id = w.vehicle_id AND v.date = w.date
GROUP BY w.weatherCondition, w.aqi_category ORDER BY avg_speed_kmh DESC""")

ORACLE["daily_kpi"] = sql(["vehicle", "weather", "emergency"], f"""
SELECT v.date, COUNT(DISTINCT v.vehicle_id) AS unique_vehicles, COUNT(v.id) AS total_records,
       {RM('v.speed_kmh', 1, 1)} AS avg_speed_kmh,
       CAST(SUM(CAST(v.is_ev AS INTEGER)) AS BIGINT) AS ev_trips, {R(WM('w.temperature'), 1)} AS avg_temp_c,
       COUNT(e.id) AS total_incidents, CAST(SUM(CAST(e.is_real_incident AS INTEGER)) AS BIGINT) AS real_incidents
FROM vehicle v
LEFT JOIN weather w ON v.vehicle_id = w.vehicle_id AND v.date = w.date
LEFT JOIN emergency e ON v.vehicle_id = e.vehicle_id AND v.date = e.date
GROUP BY v.date ORDER BY v.date DESC""")

ORACLE["daily_kpi_exact"] = sql(["vehicle", "weather", "emergency"], f"""
SELECT vd.date, vd.unique_vehicles, vd.total_records, vd.avg_speed_kmh, vd.ev_trips, wd.avg_temp_c,
       COALESCE(ed.total_incidents, 0) AS total_incidents, ed.real_incidents
FROM (SELECT date, COUNT(DISTINCT vehicle_id) AS unique_vehicles, COUNT(id) AS total_records,
             {RM('speed_kmh', 1, 1)} AS avg_speed_kmh, CAST(SUM(CAST(is_ev AS INTEGER)) AS BIGINT) AS ev_trips
      FROM vehicle GROUP BY date) vd
LEFT JOIN (SELECT date, {R(WM('temperature'), 1)} AS avg_temp_c FROM weather GROUP BY date) wd ON vd.date = wd.date
LEFT JOIN (SELECT date, COUNT(id) AS total_incidents,
                  CAST(SUM(CAST(is_real_incident AS INTEGER)) AS BIGINT) AS real_incidents
           FROM emergency GROUP BY date) ed ON vd.date = ed.date
ORDER BY vd.date DESC""")

ORACLE["incidents_by_day"] = sql(["emergency"], """
SELECT date, type AS incident_type, status, COUNT(*) AS total_events,
       CAST(SUM(CAST(is_active AS INTEGER)) AS BIGINT) AS active_count,
       CAST(SUM(CAST(is_real_incident AS INTEGER)) AS BIGINT) AS real_incident_count
FROM emergency GROUP BY date, type, status ORDER BY date DESC, total_events DESC""")

ORACLE["active_incidents"] = sql(["emergency"], """
SELECT id, vehicle_id, incidentId, type, timestamp, location, description
FROM emergency
WHERE is_active = TRUE AND is_real_incident = TRUE AND date = (SELECT max(date) FROM emergency)
ORDER BY timestamp DESC""")

ORACLE["resolution_rate"] = sql(["emergency"], f"""
SELECT type AS incident_type, COUNT(*) AS total,
       CAST(SUM(CASE WHEN status = 'Resolved' THEN 1 ELSE 0 END) AS BIGINT) AS resolved,
       CAST(SUM(CASE WHEN status = 'Active' THEN 1 ELSE 0 END) AS BIGINT) AS still_active,
       {R("CAST(100 AS DOUBLE) * CAST(SUM(CASE WHEN status = 'Resolved' THEN 1 ELSE 0 END) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE)", 1)} AS resolution_rate_pct
FROM emergency WHERE is_real_incident = TRUE GROUP BY type ORDER BY total DESC""")

ORACLE["incidents_by_hour_of_day"] = sql(["emergency"], """
SELECT CAST(hour(timestamp) AS INTEGER) AS hour_of_day, type AS incident_type, COUNT(*) AS event_count
FROM emergency WHERE is_real_incident = TRUE GROUP BY hour(timestamp), type
ORDER BY hour_of_day, event_count DESC""")

ORACLE["top_incident_vehicles"] = sql(["emergency"], """
SELECT vehicle_id, COUNT(*) AS total_incidents,
       CAST(SUM(CAST(is_real_incident AS INTEGER)) AS BIGINT) AS real_incidents,
       array_to_string(list_sort(list(DISTINCT type) FILTER (WHERE type IS NOT NULL)), ', ') AS incident_types
FROM emergency GROUP BY vehicle_id HAVING SUM(CAST(is_real_incident AS INTEGER)) > 0
ORDER BY real_incidents DESC, vehicle_id LIMIT 20""")

ORACLE["active_incident_feed"] = sql(["emergency"], """
SELECT type, status, timestamp, description FROM emergency
WHERE status = 'Active' AND type <> 'None' ORDER BY timestamp DESC""")

_VCOLS = "timestamp, speed, speed_kmh, make, model, fuelType, is_ev, hour, date"
_WCOLS = ("timestamp, temperature, weatherCondition, precipitation, windSpeed, humidity, airQualityIndex, "
          "heat_index, aqi_category, date")
_ECOLS = "timestamp, type, status, location, description, is_active, is_real_incident, date"
ORACLE["latest_vehicle"] = sql(["vehicle"], f"SELECT {_VCOLS} FROM vehicle ORDER BY timestamp DESC, id LIMIT 500")
ORACLE["latest_weather"] = sql(["weather"], f"SELECT {_WCOLS} FROM weather ORDER BY timestamp DESC, id LIMIT 500")
ORACLE["latest_emergency"] = sql(["emergency"],
                                 f"SELECT {_ECOLS} FROM emergency ORDER BY timestamp DESC, id LIMIT 500")

ORACLE["kpi_row"] = sql(["vehicle", "weather", "emergency"], f"""
SELECT COALESCE({R(WM('speed'), 1)}, 0.0) AS avg_speed,
       COALESCE({R('AVG(CAST(is_ev AS DOUBLE)) * 100', 1)}, 0.0) AS ev_pct,
       COUNT(*) AS total_records,
       (SELECT COUNT(*) FILTER (WHERE status = 'Active') FROM emergency) AS active_incidents,
       (SELECT COUNT(*) FILTER (WHERE is_real_incident) FROM emergency) AS real_incidents,
       COALESCE((SELECT {R(WM('temperature'), 1)} FROM weather), 0.0) AS avg_temp
FROM vehicle""")

ORACLE["speed_timeline"] = sql(["vehicle"], f"""
SELECT timestamp, speed, (SELECT {WM('speed')} FROM vehicle) AS mean_speed FROM vehicle ORDER BY timestamp""")
ORACLE["mean_speed_by_hour"] = sql(["vehicle"], f"""
SELECT hour, {WM('speed')} AS speed FROM vehicle WHERE hour IS NOT NULL GROUP BY hour ORDER BY hour""")


def _counts(table: str, column: str, label: str, share: bool, where: str = "TRUE") -> str:
    share_col = (f", CAST(COUNT(*) AS DOUBLE) / CAST((SELECT COUNT(*) FROM {table} WHERE {column} IS NOT NULL "
                 f"AND {where}) AS DOUBLE) AS share") if share else ""
    return sql([table], f"""SELECT {column} AS {label}, COUNT(*) AS count{share_col}
FROM {table} WHERE {column} IS NOT NULL AND {where} GROUP BY {column} ORDER BY count DESC, {label}""")


ORACLE["make_counts"] = _counts("vehicle", "make", "make", False)
ORACLE["fuel_share"] = _counts("vehicle", "fuelType", "fuelType", True)
ORACLE["condition_share"] = _counts("weather", "weatherCondition", "condition", True)
ORACLE["aqi_counts"] = _counts("weather", "aqi_category", "category", False)
ORACLE["incident_type_counts"] = _counts("emergency", "type", "type", False, "type IS DISTINCT FROM 'None'")
ORACLE["speed_mean_max_by_make"] = sql(["vehicle"], f"""
SELECT make, {WM('speed')} AS avg_speed, MAX(speed) AS max_speed FROM vehicle
WHERE make IS NOT NULL GROUP BY make ORDER BY make""")
ORACLE["weather_series"] = sql(["weather"], "SELECT timestamp, temperature, humidity FROM weather ORDER BY timestamp")
ORACLE["active_table"] = sql(["emergency"], """
SELECT timestamp, type, status, description FROM emergency
WHERE status = 'Active' AND type IS DISTINCT FROM 'None' ORDER BY timestamp DESC, id LIMIT 10""")
ORACLE["incident_timeline"] = sql(["emergency"], """
SELECT date_trunc('hour', timestamp) AS timestamp, type, COUNT(*) AS count FROM emergency
WHERE type IS DISTINCT FROM 'None' AND type IS NOT NULL AND timestamp IS NOT NULL
GROUP BY date_trunc('hour', timestamp), type ORDER BY 1, 2""")


ORACLE["raw_roundtrip"] = sql(["raw_vehicle"], "SELECT * FROM raw_vehicle")
ORACLE["refined_write_read"] = sql(["vehicle"], "SELECT * FROM vehicle")
ORACLE["catalog_pruned_scan"] = ORACLE["active_incidents"]
ORACLE["refine_all_status"] = sql(["vehicle", "gps", "traffic", "weather", "emergency"], " UNION ALL ".join(
    f"SELECT '{t}_data' AS feed, 'OK' AS status, COUNT(*) AS rows FROM {t}" for t in _SHORT))
ORACLE["stream_ingest"] = sql([f"raw_{t}" for t in _SHORT], " UNION ALL ".join(
    f"""SELECT '{t}_data' AS feed, COUNT(*) AS records, COUNT(DISTINCT id) AS ids,
           MIN(timestamp) AS first_time, MAX(timestamp) AS last_time FROM raw_{t}""" for t in _SHORT))
ORACLE["lat_lon"] = sql(["vehicle"], """SELECT id, location, (TRY_CAST(location AS DOUBLE[]))[1] AS lat,
    (TRY_CAST(location AS DOUBLE[]))[2] AS lon FROM vehicle""")
ORACLE["stream_dedup"] = sql(["raw_vehicle"], "SELECT DISTINCT * FROM raw_vehicle")
ORACLE["stream_refine"] = sql(["vehicle"], "SELECT * FROM vehicle")
ORACLE["stream_incident_timeline"] = ORACLE["incident_timeline"]
ORACLE["stream_sliding_speed"] = sql(["vehicle"], f"""
SELECT window_start, window_start + INTERVAL 10 MINUTE AS window_end, COUNT(*) AS observations,
       {RM('speed_kmh', 1, 1)} AS avg_speed_kmh, MAX(speed_kmh) AS max_speed_kmh
FROM (SELECT make_timestamp((epoch_us(timestamp) // 300000000) * 300000000) AS window_start, speed_kmh FROM vehicle
      UNION ALL
      SELECT make_timestamp((epoch_us(timestamp) // 300000000 - 1) * 300000000) AS window_start, speed_kmh FROM vehicle)
GROUP BY window_start""")
ORACLE["stream_join_weather"] = sql(["vehicle", "weather"], """
SELECT v.id AS vehicle_record, v.vehicle_id, v.timestamp AS vehicle_time, v.speed_kmh,
       w.id AS weather_record, w.timestamp AS weather_time, w.temperature, w.weatherCondition
FROM vehicle v JOIN weather w ON v.vehicle_id = w.vehicle_id
 AND w.timestamp BETWEEN v.timestamp - INTERVAL 5 MINUTE AND v.timestamp + INTERVAL 5 MINUTE""")
ORACLE["trips"] = sql(["vehicle"], f"""
SELECT vehicle_id, MIN(timestamp) AS trip_start, MAX(timestamp) AS trip_end, COUNT(*) AS points,
       {RM('speed_kmh', 1, 1)} AS avg_speed_kmh,
       CAST((epoch_us(MAX(timestamp)) - epoch_us(MIN(timestamp))) // 1000000 AS BIGINT) AS duration_s
FROM (SELECT *, SUM(is_start) OVER (PARTITION BY vehicle_id ORDER BY timestamp ROWS UNBOUNDED PRECEDING) AS trip_no
      FROM (SELECT vehicle_id, timestamp, speed_kmh,
                   CASE WHEN lag(timestamp) OVER w IS NULL
                          OR epoch_us(timestamp) - epoch_us(lag(timestamp) OVER w) >= 7200000000 THEN 1 ELSE 0 END
                   AS is_start
            FROM vehicle WHERE vehicle_id IS NOT NULL AND timestamp IS NOT NULL
            WINDOW w AS (PARTITION BY vehicle_id ORDER BY timestamp)))
GROUP BY vehicle_id, trip_no ORDER BY vehicle_id, trip_start""")
ORACLE["asof_weather"] = sql(["vehicle", "weather"], """
SELECT v.id, v.vehicle_id, v.timestamp, v.speed_kmh, w.id AS weather_id, w.timestamp AS weather_time,
       w.temperature, w.weatherCondition
FROM vehicle v
ASOF LEFT JOIN (SELECT * FROM weather WHERE vehicle_id IS NOT NULL AND timestamp IS NOT NULL) w
  ON v.vehicle_id = w.vehicle_id AND v.timestamp >= w.timestamp""")
ORACLE["dead_letter"] = sql(["raw_vehicle", "obs"], """SELECT r.id AS key, 'vehicle_data' AS feed, '~' AS noise, r.id AS id, r.vehicle_id AS vehicle_id,
       r.speed AS speed, r.make AS make
FROM raw_vehicle r WHERE r.id IN (SELECT 'veh-' || CAST(n AS VARCHAR) FROM obs WHERE event_type = 'error')""")
_CORRECTED = """SELECT CASE WHEN step % 500 <> 1 THEN id END AS id, * EXCLUDE (id, step) FROM (
  SELECT *, CAST(substr(id, 5) AS BIGINT) AS step FROM raw_vehicle
  UNION ALL
  SELECT * REPLACE (timestamp + INTERVAL 1 SECOND AS timestamp, speed + 1.0 AS speed), CAST(substr(id, 5) AS BIGINT) AS step
  FROM raw_vehicle WHERE CAST(substr(id, 5) AS BIGINT) % 10 = 0)"""
ORACLE["dedup_latest"] = sql(["raw_vehicle"], f"""
SELECT * EXCLUDE (copy) FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY timestamp DESC NULLS LAST, vehicle_id DESC NULLS LAST, location DESC NULLS LAST,
    speed DESC NULLS LAST, direction DESC NULLS LAST, make DESC NULLS LAST, model DESC NULLS LAST, year DESC NULLS LAST,
    fuelType DESC NULLS LAST) AS copy FROM ({_CORRECTED})) WHERE copy = 1""")
ORACLE["dedup_id_copies"] = sql(["raw_vehicle"], f"SELECT DISTINCT id FROM ({_CORRECTED})")


def _rejects(feed: str, table: str, checks: dict[str, str]) -> str:
    parts = []
    every = " AND ".join(f"COALESCE({c}, FALSE)" for c in checks.values())
    for rule, cond in list(checks.items()) + [("any_rule", every)]:
        cond = cond if rule == "any_rule" else f"COALESCE({cond}, FALSE)"
        parts.append(f"SELECT '{feed}' AS feed, '{rule}' AS rule, COUNT(*) FILTER (WHERE NOT ({cond})) AS rejected, "
                     f"COUNT(*) AS checked FROM (SELECT DISTINCT * FROM {table})")
    return " UNION ALL ".join(parts)


ORACLE["reject_counts"] = sql(["raw_vehicle", "raw_gps", "raw_weather"], " UNION ALL ".join([
    _rejects("vehicle_data", "raw_vehicle", {"speed_range": "speed BETWEEN 0 AND 200"}),
    _rejects("gps_data", "raw_gps", {"speed_range": "speed BETWEEN 0 AND 200"}),
    _rejects("weather_data", "raw_weather", {"temperature_range": "temperature BETWEEN -10 AND 60",
                                             "humidity_range": "humidity BETWEEN 0 AND 100"}),
]))
ORACLE["incremental_refine"] = sql(["raw_vehicle"], f"""SELECT id, vehicle_id, timestamp, strftime(timestamp, '%Y-%m-%d') AS date, speed,
       {R("speed", 1)} AS speed_kmh
FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY batch DESC, timestamp DESC NULLS LAST) AS place
  FROM (
    SELECT CASE WHEN step % 500 <> 1 THEN id END AS id, vehicle_id, CASE WHEN step % 97 <> 0 THEN timestamp END AS timestamp,
           CASE WHEN recent AND step % 5 = 1 THEN 1.0 ELSE speed END AS speed, 0 AS batch
    FROM steps WHERE NOT (recent AND step % 5 = 0)
    UNION ALL
    SELECT id, vehicle_id, timestamp + INTERVAL 1 DAY, speed, 0 FROM steps WHERE step % 7 = 3 AND step % 97 <> 0 AND step % 500 <> 1
    UNION ALL
    SELECT CASE WHEN step % 500 <> 1 THEN id END, vehicle_id, timestamp, speed + CASE WHEN step % 21 = 3 THEN 2.0 ELSE 0.0 END, 1
    FROM steps WHERE ((recent AND step % 5 < 2) OR step % 97 = 0 OR step % 21 = 3) AND (step % 500 <> 1 OR step = 1)
    UNION ALL
    SELECT 'new-' || CAST(step AS VARCHAR), vehicle_id, timestamp, speed, 2 FROM steps WHERE step % 50 = 7) AS arrivals)
WHERE place = 1 AND speed BETWEEN 0 AND 200""")
ORACLE["incremental_refine"] = ORACLE["incremental_refine"].replace("FROM steps", """FROM (
      SELECT *, CAST(substr(id, 5) AS BIGINT) AS step,
             CAST(timestamp AS DATE) >= (SELECT MAX(CAST(timestamp AS DATE)) FROM raw_vehicle) - 2 AS recent FROM raw_vehicle)""")
ORACLE["speed_by_weather_bucketed"] = ORACLE["speed_by_weather"]
ORACLE["daily_kpi_bucketed"] = ORACLE["daily_kpi"]
ORACLE["speed_by_hour_merged"] = sql(["vehicle"], """SELECT hour, COUNT(*) AS observations, TRUE AS p50_near, TRUE AS p95_near
FROM vehicle GROUP BY hour""")
ORACLE["active_incidents_today"] = ORACLE["active_incidents"]
ORACLE["timestamp_cast"] = sql(["raw_gps"], """SELECT id, strftime(timestamp, '%Y-%m-%dT%H:%M:%S') AS text, timestamp FROM raw_gps""")
# The columns of the refined tables, in their natural order.
_COLUMNS = {
    "vehicle": "id, vehicle_id, timestamp, location, speed, direction, make, model, year, fuelType, hour, speed_kmh, is_ev, date",
    "gps": "id, vehicle_id, timestamp, speed, direction, vehicleType, hour, date",
    "traffic": "id, vehicle_id, camera_id, location, timestamp, date",
    "weather": "id, vehicle_id, location, timestamp, temperature, weatherCondition, precipitation, windSpeed, humidity, airQualityIndex, "
               "heat_index, aqi_category, date",
    "emergency": "id, vehicle_id, incidentId, type, timestamp, location, status, description, is_active, is_real_incident, date",
}
ORACLE["feed_registry"] = sql(_SHORT, " UNION ALL ".join(
    f"SELECT '{t}_data' AS feed, '{names}' AS columns, COUNT(*) AS rows FROM (SELECT {names} FROM {t})" for t, names in _COLUMNS.items()))
ORACLE["stream_trips"] = ORACLE["trips"]
ORACLE["stream_rejects"] = ORACLE["reject_counts"]
ORACLE["stream_recovery"] = sql(["raw_vehicle"], """SELECT sink, raw_vehicle.* FROM raw_vehicle CROSS JOIN (VALUES ('file'), ('split')) AS sinks(sink)""")
ORACLE["stream_late_rows"] = sql(["raw_vehicle"], """SELECT id, timestamp,
       COALESCE(m <= MAX(MAX(m)) OVER (ORDER BY batch RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 120000000, FALSE) AS late
FROM (
  SELECT id, timestamp, m, least(4, (m - low) * 5 // (high - low + 1) + CASE WHEN step % 50 = 7 THEN 2 ELSE 0 END) AS batch, copy
  FROM (SELECT id, timestamp, epoch_us(timestamp) AS m, CAST(substr(id, 5) AS BIGINT) AS step, row_number() OVER () AS copy,
               MIN(epoch_us(timestamp)) OVER () AS low, MAX(epoch_us(timestamp)) OVER () AS high FROM raw_vehicle))
GROUP BY id, timestamp, m, batch, copy""")
ORACLE["latest_by_partition"] = ORACLE["latest_vehicle"]
ORACLE["speed_by_hour_sketch"] = ORACLE["speed_by_hour"]


# dashboard datasets over the newest 500 rows of their tables
for _name, _tables in (("kpi_row", ("vehicle", "weather", "emergency")), ("fuel_share", ("vehicle",)), ("condition_share", ("weather",)),
                       ("active_table", ("emergency",)), ("incident_timeline", ("emergency",))):
    _body = ORACLE[_name][len(with_ctes(*_tables)):]
    for _t in _tables:
        _body = _body.replace(f"FROM {_t}", f"FROM newest_{_t}")
    ORACLE[f"{_name}_newest"] = with_ctes(*_tables).rstrip() + ",\n" + ",\n".join(
        f"newest_{t} AS (SELECT * FROM {t} ORDER BY timestamp DESC NULLS LAST, id LIMIT 500)" for t in _tables) + "\n" + _body

ORACLE["catalog_tables"] = sql(["vehicle", "gps", "traffic", "weather", "emergency"], " UNION ALL ".join(
    f"SELECT '{t}_data' AS \"table\", COUNT(*) AS rows, COUNT(DISTINCT date) AS dates FROM {t}" for t in _SHORT))


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
