"""DuckDB SQL for the registered queries, independent of the Spark code.

Every text starts from the `events` table and repeats the derivation of the telemetry, the
clean rows and the windows as common table expressions.
"""

from __future__ import annotations

import zlib

# Typed readings per event, and the message bodies made of them.
RAW = """
raw AS (
  SELECT event_id, ts AS broker_time, event_type,
         TIMESTAMP '2024-01-01'
           + to_seconds((epoch_us(ts) - 1704067200000000) // 120000000) AS t,
         CASE WHEN event_id % 97 = 0 THEN NULL
              WHEN user_id % 13 = 12 THEN 'TRK-CHI-SPARE'
              WHEN user_id % 13 = 11 AND ts >= TIMESTAMP '2024-01-10' THEN 'TRK-CHI-0001'
              ELSE 'TRK-CHI-' || lpad(CAST(user_id % 13 + 1 AS VARCHAR), 4, '0') END AS v,
         15.0::DOUBLE + CAST(json_extract_string(props, '$.k') AS INT) * 0.25::DOUBLE AS ambient,
         CASE WHEN event_id % 59 <> 0 THEN
           1.5::DOUBLE + floor(value / 5) * 0.25::DOUBLE + (event_id % 11) * 0.00046::DOUBLE
           + CASE WHEN user_id % 13 IN (2, 5) THEN 7.0::DOUBLE ELSE 0.0::DOUBLE END END AS cargo,
         CAST(CASE WHEN user_id % 3 = 0 THEN 92 + event_id % 5 ELSE 10 + event_id * 7 % 86 END
              AS DOUBLE) AS hum,
         (event_id * 7 % 26) * 0.125::DOUBLE AS vib,
         CASE WHEN event_type = 'error' AND CAST(json_extract_string(props, '$.k') AS INT) < 10
              THEN 'OPEN' ELSE 'CLOSED' END AS door,
         CASE WHEN event_id % 53 <> 0
              THEN 41.5::DOUBLE + (event_id % 512) / 1024.0::DOUBLE END AS lat,
         CASE WHEN event_id % 53 <> 0
              THEN -88.25::DOUBLE + (event_id % 256) / 512.0::DOUBLE END AS lon
  FROM events
)"""

BODY = """
body AS (
  SELECT *,
    CASE WHEN event_id % 89 = 0 THEN '{bad json' ELSE
      '{"eventId":"evt-' || event_id || '",'
      || CASE WHEN v IS NULL THEN '' ELSE '"vehicleId":"' || v || '",' END
      || '"timestamp":"'
      || CASE WHEN event_id % 101 = 0 THEN strftime(t, '%Y-%m-%dT%H:%M:%SZ')
              ELSE strftime(t, '%Y-%m-%d %H:%M:%S') END
      || '","routeContext":{'
      || CASE WHEN lat IS NULL THEN ''
              ELSE '"latitude":' || CAST(lat AS VARCHAR)
                   || ',"longitude":' || CAST(lon AS VARCHAR) || ',' END
      || '"origin":"North Depot","destination":"South Hub"},"telemetry":{"ambientTempC":'
      || CAST(ambient AS VARCHAR)
      || CASE WHEN cargo IS NULL THEN ''
              ELSE ',"cargoContainerTempC":' || CAST(cargo AS VARCHAR) END
      || ',"relativeHumidityPct":' || CAST(hum AS VARCHAR)
      || ',"vibrationG":' || CAST(vib AS VARCHAR)
      || ',"doorStatus":"' || door || '"}}'
    END AS txt,
    CASE WHEN event_id % 89 = 0 THEN '{bad json' ELSE
      '{"Timestamp":"' || strftime(t, '%Y-%m-%dT%H:%M:%SZ') || '",'
      || CASE WHEN v IS NULL THEN '' ELSE '"Vehicle_ID":"' || v || '",' END
      || '"Ambient_Temp":' || CAST(ambient AS VARCHAR)
      || CASE WHEN cargo IS NULL THEN '' ELSE ',"Cargo_Temp":' || CAST(cargo AS VARCHAR) END
      || ',"Humidity":' || CAST(hum AS VARCHAR)
      || ',"Vibration":' || CAST(vib AS VARCHAR)
      || ',"Door_Status":"' || door || '"}'
    END AS flat_txt
  FROM raw
)"""

BRONZE = f"{RAW},{BODY}"

# What decoding must give: NULLs for a broken body, NULL time for the other pattern.
DECODED = f"""{RAW},
decoded AS (
  SELECT event_id, broker_time,
    CASE WHEN event_id % 89 <> 0 AND event_id % 101 <> 0 THEN t END AS t,
    CASE WHEN event_id % 89 <> 0 THEN v END AS v,
    CASE WHEN event_id % 89 <> 0 THEN ambient END AS ambient,
    CASE WHEN event_id % 89 <> 0 THEN cargo END AS cargo,
    CASE WHEN event_id % 89 <> 0 THEN hum END AS hum,
    CASE WHEN event_id % 89 <> 0 THEN vib END AS vib,
    CASE WHEN event_id % 89 <> 0 THEN door END AS door,
    CASE WHEN event_id % 89 <> 0 THEN lat END AS lat,
    CASE WHEN event_id % 89 <> 0 THEN lon END AS lon
  FROM raw
)"""

_DELTA = "round((cargo - ambient)::DECIMAL(18,8), 2)::DOUBLE + 0.0::DOUBLE"
_GAMMA = "17.27::DOUBLE * cargo / (237.7::DOUBLE + cargo) + ln(hum / 100.0::DOUBLE)"
_DEW = (
    "round((237.7::DOUBLE * gamma / (17.27::DOUBLE - gamma))::DECIMAL(18,10), 2)::DOUBLE"
    " + 0.0::DOUBLE"
)

MEASURED = f"""{DECODED},
valid AS (SELECT * FROM decoded WHERE v IS NOT NULL AND t IS NOT NULL),
measured AS (
  SELECT *, (cargo - dew) < 2.0::DOUBLE AS risk
  FROM (SELECT *, {_DEW} AS dew
        FROM (SELECT *, {_DELTA} AS delta, {_GAMMA} AS gamma FROM valid))
)"""

_SILVER_COLUMNS = """
  t AS "timestamp", v AS vehicle_id, ambient AS ambient_temp, cargo AS cargo_temp,
  hum AS humidity, vib AS vibration, door AS door_status, delta AS temp_delta,
  lat AS latitude, lon AS longitude, dew AS dew_point, risk AS condensation_risk"""

SILVER = f"""{MEASURED},
silver AS (
  SELECT {_SILVER_COLUMNS}
  FROM measured
  QUALIFY row_number() OVER (PARTITION BY v, t ORDER BY event_id % 3, event_id) = 1
)"""

FLAT_SILVER = f"""{RAW},
flat_silver AS (
  SELECT t AS "timestamp", v AS vehicle_id, ambient AS ambient_temp, cargo AS cargo_temp,
         hum AS humidity, vib AS vibration, door AS door_status, {_DELTA} AS temp_delta
  FROM raw WHERE event_id % 89 <> 0 AND v IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY v, t ORDER BY event_id % 3, event_id) = 1
)"""


def _units(column: str) -> str:
    """Exact sum in billionths, by way of the digits of decimals."""
    return f"sum(CAST(replace(CAST(CAST({column} AS DECIMAL(28,9)) AS VARCHAR), '.', '') AS HUGEINT))"


def _mean(column: str, digits: int = 2) -> str:
    """Half-up rounded mean in whole-number arithmetic."""
    total, count, power, unit = _units(column), f"count({column})", 10**digits, 10**9
    return (
        f"CAST(CASE WHEN {count} > 0 THEN sign({total}) * ((2 * {power} * abs({total}) + {unit} * {count})"
        f" // (2 * {unit} * {count})) END AS DOUBLE) / {power}.0::DOUBLE + 0.0::DOUBLE"
    )


def _gold(silver: str, condensation: bool) -> str:
    extra = (
        f""", {_mean("dew_point")} AS avg_dew_point,
         CAST(sum(CASE WHEN condensation_risk THEN 1 ELSE 0 END) AS BIGINT)
           AS condensation_risk_count"""
        if condensation
        else ""
    )
    return f"""
gold AS (
  SELECT *, avg_cargo_temp > 8.0 OR door_open_count > 0 OR max_vibration > 3.0 AS anomaly_flag
  FROM (
    SELECT window_start, window_start + INTERVAL 60 SECOND AS window_end, vehicle_id,
           {_mean("cargo_temp")} AS avg_cargo_temp,
           {_mean("ambient_temp")} AS avg_ambient_temp,
           round(max(vibration)::DECIMAL(18,8), 2)::DOUBLE AS max_vibration,
           CAST(sum(CASE WHEN door_status = 'OPEN' THEN 1 ELSE 0 END) AS BIGINT)
             AS door_open_count{extra}
    FROM (SELECT *, time_bucket(INTERVAL 10 SECOND, "timestamp") - to_seconds(10 * i)
                      AS window_start
          FROM {silver} CROSS JOIN range(0, 6) steps(i))
    GROUP BY window_start, vehicle_id
  )
)"""


GOLD = f"{SILVER},{_gold('silver', True)}"
FLAT_GOLD = f"{FLAT_SILVER},{_gold('flat_silver', False)}"
# What a stream has passed on once all rows are read: times that the watermark is behind.
PASSED = "(SELECT max(t) FROM valid) - INTERVAL 10 SECOND"
FLAT_PASSED = "(SELECT max(t) FROM raw WHERE event_id % 89 <> 0 AND v IS NOT NULL) - INTERVAL 10 SECOND"
CHAINED = f"""{SILVER},
passed AS (SELECT * FROM silver WHERE "timestamp" <= {PASSED}),{_gold('passed', True)},
closed AS (
  SELECT * FROM gold
  WHERE window_end <= (SELECT max("timestamp") FROM passed) - INTERVAL 10 SECOND
)"""
CLOSED = f"""{GOLD},
closed AS (
  SELECT * FROM gold
  WHERE window_end <= (SELECT max("timestamp") FROM silver) - INTERVAL 10 SECOND
)"""

RECENT = f"""{SILVER},
recent AS (SELECT * FROM silver ORDER BY "timestamp" DESC, vehicle_id LIMIT 500)"""

_STATE_COLUMNS = (
    "ambient_temp", "cargo_temp", "humidity", "vibration", "door_status", "temp_delta",
    "latitude", "longitude", "dew_point", "condensation_risk",
)


def _latest(source: str) -> str:
    columns = ", ".join(f'arg_max({c}, "timestamp") AS {c}' for c in _STATE_COLUMNS)
    return f"""
latest AS (
  SELECT vehicle_id, max("timestamp") AS "timestamp", {columns}, count(*) AS events
  FROM {source} GROUP BY vehicle_id
)"""


_ALL_SILVER = "SELECT * FROM silver"
_EVENT_ANOMALY = "cargo_temp > 8.0 OR door_status = 'OPEN' OR vibration > 3.0"
# One colour per slot, in slot order.
_PALETTE = (
    "['#00d2ff', '#ff6b6b', '#2ed573', '#a55eea', '#fed330', '#ff4b91', '#1dd1a1', '#4b7bec',"
    " '#fa8231', '#26de81']"
)
# The vehicle without a number takes its slot from a hash that DuckDB lacks.
_SPARE_SLOT = zlib.crc32(b"TRK-CHI-SPARE") % 10
_SLOT = (
    f"coalesce((TRY_CAST(split_part(vehicle_id, '-', 3) AS INT) - 1) % 10, {_SPARE_SLOT})"
)


def _text(column: str) -> str:
    return f"coalesce(CAST({column} AS VARCHAR), 'N/A')"


def _status_queries() -> dict[str, str]:
    """Fleet status over all events."""
    latest = f"WITH {SILVER},{_latest('silver')}"
    trail = f"""WITH {SILVER},
trail AS (
  SELECT latitude AS lat, longitude AS lon, vehicle_id, cargo_temp, door_status, vibration,
         condensation_risk, strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS "timestamp",
         {_PALETTE}[{_SLOT} + 1] AS color
  FROM (SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY "timestamp" DESC) AS r
        FROM silver)
  WHERE r <= 15 AND latitude IS NOT NULL AND longitude IS NOT NULL AND cargo_temp IS NOT NULL
    AND door_status IS NOT NULL AND vibration IS NOT NULL AND condensation_risk IS NOT NULL
)"""
    return {
        "latest_per_vehicle": f"{latest} SELECT * EXCLUDE (events) FROM latest",
        "fleet_kpis": f"""{latest}
SELECT *, CASE WHEN active_anomalies > 0 THEN 'alert' ELSE 'ok' END AS active_anomalies_status,
  CASE WHEN condensation_risks > 0 THEN 'alert' ELSE 'ok' END AS condensation_risks_status,
  CASE WHEN open_doors > 0 THEN 'alert' ELSE 'ok' END AS open_doors_status
FROM (
  SELECT CAST(sum(events) AS BIGINT) AS sample_events,
    {_mean("cargo_temp")} AS avg_cargo_temp,
    count(*) FILTER (WHERE {_EVENT_ANOMALY}) AS active_anomalies,
    count(*) FILTER (WHERE condensation_risk) AS condensation_risks,
    count(*) FILTER (WHERE door_status = 'OPEN') AS open_doors,
    CASE WHEN {_units("cargo_temp")} > 6000000000 * count(cargo_temp)
         THEN 'alert' ELSE 'ok' END AS cargo_temp_status
  FROM latest)""",
        "active_anomalies": f"""{latest}
SELECT * EXCLUDE (events) FROM latest WHERE {_EVENT_ANOMALY}""",
        "active_condensation": f"""{latest}
SELECT * EXCLUDE (events) FROM latest WHERE condensation_risk""",
        "alert_feed": f"""{latest}
SELECT 'anomaly' AS kind, vehicle_id,
  vehicle_id || ' out of range: cargo ' || {_text("cargo_temp")} || ' C, vibration '
  || {_text("vibration")} || ' g, door ' || {_text("door_status")} AS message
FROM latest WHERE {_EVENT_ANOMALY}
UNION ALL
SELECT 'condensation', vehicle_id,
  vehicle_id || ' close to its dew point: cargo ' || {_text("cargo_temp")} || ' C, dew point '
  || {_text("dew_point")} || ' C, humidity ' || {_text("humidity")} || ' percent'
FROM latest WHERE condensation_risk""",
        "route_trail": f"{trail} SELECT * FROM trail",
        "map_center": f"""{trail}
SELECT {_mean("lat", 4)} AS lat, {_mean("lon", 4)} AS lon FROM trail""",
        "timeline_cargo": f"""WITH {SILVER}
SELECT "timestamp", vehicle_id, cargo_temp FROM silver""",
        "timeline_vibration": f"""WITH {SILVER}
SELECT "timestamp", vehicle_id, vibration FROM silver""",
    }


_SAMPLE_COLUMNS = """event_id AS "offset", t AS "timestamp", v AS vehicle_id,
  ambient AS ambient_temp, cargo AS cargo_temp, hum AS humidity, vib AS vibration,
  door AS door_status, lat AS latitude, lon AS longitude"""

_GOLD_LIST = """window_start, window_end, vehicle_id, avg_cargo_temp, avg_ambient_temp,
  max_vibration, door_open_count, anomaly_flag, avg_dew_point, condensation_risk_count"""

_LAYER_COUNTS = """
counts AS (
  SELECT 'bronze' AS layer, count(*) AS total FROM raw
  UNION ALL SELECT 'silver', count(*) FROM silver
  UNION ALL SELECT 'gold', count(*) FROM gold
)"""

# Columns and types of the layers.
_LAYER_COLUMNS = {
    "bronze": "key binary, value binary, topic string, partition int, offset bigint, "
    "timestamp timestamp, timestampType int",
    "silver": "timestamp timestamp, vehicle_id string, ambient_temp double, "
    "cargo_temp double, humidity double, vibration double, door_status string, "
    "temp_delta double, latitude double, longitude double, dew_point double, "
    "condensation_risk boolean",
    "gold": "window_start timestamp, window_end timestamp, vehicle_id string, "
    "avg_cargo_temp double, avg_ambient_temp double, max_vibration double, "
    "door_open_count bigint, anomaly_flag boolean, avg_dew_point double, "
    "condensation_risk_count bigint",
}


def _column_values() -> str:
    rows = [
        f"('{layer}', {position}, '{column.split()[0]}', '{column.split()[1]}')"
        for layer, columns in _LAYER_COLUMNS.items()
        for position, column in enumerate(columns.split(", "))
    ]
    return ", ".join(rows)


def _retention(layer: str, source: str, time: str, horizon: str) -> str:
    return f"""
SELECT '{layer}' AS layer,
  CASE WHEN {time} >= (SELECT max({time}) FROM {source}) - INTERVAL {horizon}
       THEN 'hot' ELSE 'archive' END AS tier,
  count(*) AS total, min({time}) AS oldest, max({time}) AS newest
FROM {source} GROUP BY ALL"""


# Flagged windows with each event that raised the flag.
RAISED = f"""{GOLD},
raised AS (
  SELECT * FROM (
    SELECT g.vehicle_id, g.window_start, g.window_end, g.avg_cargo_temp, e."timestamp", e.cargo_temp, e.vibration,
           e.door_status,
           concat_ws('+', CASE WHEN e.cargo_temp > 8.0 AND g.avg_cargo_temp > 8.0 THEN 'cargo' END,
                          CASE WHEN e.door_status = 'OPEN' THEN 'door' END,
                          CASE WHEN round(e.vibration::DECIMAL(18,8), 2)::DOUBLE > 3.0 THEN 'vibration' END) AS cause
    FROM gold g JOIN silver e ON e.vehicle_id = g.vehicle_id
      AND e."timestamp" >= g.window_start AND e."timestamp" < g.window_end
    WHERE g.anomaly_flag)
  WHERE cause <> ''
)"""


def _trips(seconds: int, more: str = "") -> str:
    """Events less than a gap apart, by running sums over the gaps between them."""
    return f"""
SELECT vehicle_id, min("timestamp") AS trip_start, max("timestamp") AS trip_end, count(*) AS events,
  min(cargo_temp) AS min_cargo_temp, max(cargo_temp) AS max_cargo_temp,
  round(max(vibration)::DECIMAL(18,8), 2)::DOUBLE AS max_vibration,
  count(*) FILTER (WHERE door_status = 'OPEN') AS door_open_count{more}
FROM (SELECT *, sum(starts) OVER (PARTITION BY vehicle_id ORDER BY "timestamp") AS trip
      FROM (SELECT *, CASE WHEN "timestamp" - lag("timestamp") OVER (PARTITION BY vehicle_id ORDER BY "timestamp")
                                <= INTERVAL {seconds} SECOND THEN 0 ELSE 1 END AS starts FROM silver))
GROUP BY vehicle_id, trip"""


def _differences() -> dict[str, str]:
    """Joins along time, stretches of events, roll-ups, shapes and differences of layers."""
    copies = "CASE WHEN epoch(\"timestamp\")::BIGINT % 50 = 0 THEN 0 WHEN epoch(\"timestamp\")::BIGINT % 70 = 0 THEN 3 ELSE 1 END"
    return {
        "window_causes": f"""WITH {RAISED}
SELECT vehicle_id, window_start, window_end, "timestamp" AS event_time, cause, cargo_temp, vibration, door_status,
       count(*) OVER (PARTITION BY vehicle_id, window_start) AS raising_events
FROM raised QUALIFY row_number() OVER (PARTITION BY vehicle_id, window_start ORDER BY "timestamp") = 1""",
        "stream_flagged_events": f"WITH {RAISED} SELECT * FROM raised",
        "alert_positions": f"""WITH {SILVER}
SELECT a.vehicle_id, a."timestamp", a.cargo_temp, a.vibration, a.door_status, a.condensation_risk,
       p."timestamp" AS position_time, p.latitude, p.longitude,
       (epoch(a."timestamp") - epoch(p."timestamp"))::BIGINT AS position_age
FROM (SELECT * FROM silver WHERE {_EVENT_ANOMALY} OR condensation_risk) a
ASOF LEFT JOIN (SELECT * FROM silver WHERE latitude IS NOT NULL AND longitude IS NOT NULL) p
  ON a.vehicle_id = p.vehicle_id AND a."timestamp" >= p."timestamp\"""",
        "trip_sessions": f"""WITH {SILVER} {_trips(300, ", '5 minutes' AS gap")}
UNION ALL {_trips(60, ", '1 minute' AS gap")}""",
        "stream_trip_sessions": f"""WITH {SILVER}
SELECT * FROM ({_trips(60)})
WHERE trip_end + INTERVAL 60 SECOND <= (SELECT max("timestamp") FROM silver) - INTERVAL 10 SECOND""",
        "door_episodes": f"""WITH {SILVER},
marked AS (SELECT *, door_status = 'OPEN' AS is_open,
                  sum(changed) OVER (PARTITION BY vehicle_id ORDER BY "timestamp") AS run
           FROM (SELECT *, CASE WHEN (door_status = 'OPEN') = lag(door_status = 'OPEN') OVER (PARTITION BY vehicle_id ORDER BY "timestamp")
                                THEN 0 ELSE 1 END AS changed FROM silver WHERE door_status IS NOT NULL)),
runs AS (SELECT vehicle_id, run, is_open, min("timestamp") AS opened_at, max("timestamp") AS last_open, count(*) AS events,
                max(cargo_temp) AS max_cargo_temp FROM marked GROUP BY ALL),
followed AS (SELECT *, lead(opened_at) OVER (PARTITION BY vehicle_id ORDER BY run) AS closed_at FROM runs)
SELECT vehicle_id, opened_at, last_open, closed_at, events, max_cargo_temp,
       (epoch(coalesce(closed_at, last_open)) - epoch(opened_at))::BIGINT AS seconds
FROM followed WHERE is_open""",
        "fleet_rollup": f"""WITH {SILVER}
SELECT vehicle_id, day, hour,
  CASE GROUPING(vehicle_id, day, hour) WHEN 0 THEN 'hour' WHEN 1 THEN 'day' WHEN 3 THEN 'vehicle' ELSE 'fleet' END AS level,
  count(*) AS events, count(cargo_temp) AS cargo_readings, {_mean("cargo_temp")} AS avg_cargo_temp,
  round(max(vibration)::DECIMAL(18,8), 2)::DOUBLE AS max_vibration,
  count(*) FILTER (WHERE door_status = 'OPEN') AS door_open_count
FROM (SELECT *, date_trunc('day', "timestamp")::TIMESTAMP AS day, date_trunc('hour', "timestamp") AS hour FROM silver)
GROUP BY ROLLUP (vehicle_id, day, hour)""",
        "vehicle_days": f"""WITH {SILVER}
SELECT vehicle_id, date_trunc('day', "timestamp")::TIMESTAMP AS day, count(DISTINCT (latitude, longitude)) FILTER (WHERE latitude IS NOT NULL AND longitude IS NOT NULL) AS positions,
       count(cargo_temp) AS cargo_readings, quantile_disc(cargo_temp, 0.5) AS cargo_median, quantile_disc(cargo_temp, 0.95) AS cargo_p95
FROM silver GROUP BY ALL""",
        "vehicle_sketches": f"""WITH {SILVER}
SELECT vehicle_id, date_trunc('day', "timestamp")::TIMESTAMP AS day, count(cargo_temp) AS cargo_readings,
       true AS positions_close, true AS cargo_median_close, true AS cargo_p95_close
FROM silver GROUP BY ALL""",
        "payload_drift": f"""WITH {BRONZE},
topic AS (SELECT txt FROM body UNION ALL SELECT flat_txt FROM body),
shaped AS (
  SELECT CASE WHEN json_valid(txt) THEN txt::JSON END AS j,
    CASE WHEN NOT json_valid(txt) THEN 'broken' WHEN json_exists(txt, '$.telemetry') THEN 'nested'
         WHEN json_exists(txt, '$.Vehicle_ID') OR json_exists(txt, '$.Timestamp') THEN 'flat' ELSE 'other' END AS shape
  FROM topic),
outer_ AS (SELECT shape, key, json_extract(j, '$."' || key || '"') AS v
           FROM (SELECT shape, j, unnest(json_keys(j)) AS key FROM shaped WHERE j IS NOT NULL)),
inner_ AS (SELECT shape, key || '.' || k AS key, json_extract(v, '$."' || k || '"') AS v
           FROM (SELECT *, unnest(json_keys(v)) AS k FROM outer_ WHERE json_type(v) = 'OBJECT'))
SELECT shape, '' AS field, '' AS "type", count(*) AS bodies FROM shaped GROUP BY ALL
UNION ALL
SELECT shape, key, CASE json_type(v) WHEN 'VARCHAR' THEN 'STRING' WHEN 'OBJECT' THEN 'OBJECT' ELSE 'NUMBER' END, count(*)
FROM (SELECT * FROM outer_ UNION ALL SELECT * FROM inner_) GROUP BY ALL""",
        "layer_reconcile": f"""WITH {SILVER}
SELECT CASE WHEN n = 0 THEN 'missing' ELSE 'unexpected' END AS side, (CASE WHEN n = 0 THEN 1 ELSE n - 1 END)::BIGINT AS copies,
       * EXCLUDE (n)
FROM (SELECT *, {copies} AS n FROM silver) WHERE n <> 1""",
        "retention_move": f"""WITH {GOLD}
SELECT {_GOLD_LIST}, strftime(window_end, '%Y-%m-%d-%H') AS piece,
       CASE WHEN window_end >= (SELECT max(window_end) FROM gold) - INTERVAL 1 HOUR THEN 'hot' ELSE 'archive' END AS tier
FROM gold""",
        "compact_small_files": f"WITH {GOLD} SELECT {_GOLD_LIST} FROM gold",
    }


def oracle_sql() -> dict[str, str]:
    silver_rows = f"WITH {SILVER} {_ALL_SILVER}"
    gold_rows = f"WITH {GOLD} SELECT {_GOLD_LIST} FROM gold"
    closed_rows = f"WITH {CLOSED} SELECT {_GOLD_LIST} FROM closed"
    envelope = f"""WITH {BRONZE}
SELECT 'fleet-telemetry' AS topic, CAST(event_id % 3 AS INT) AS "partition", event_id AS "offset",
       broker_time AS "timestamp" FROM body"""
    texts = {
        # decoding and derived measures
        "parse_nested": f"WITH {DECODED} SELECT {_SAMPLE_COLUMNS} FROM decoded",
        "parse_flat": f"""WITH {RAW}
SELECT event_id AS "offset", CASE WHEN ok THEN t END AS "timestamp",
  CASE WHEN ok THEN v END AS vehicle_id, CASE WHEN ok THEN ambient END AS ambient_temp,
  CASE WHEN ok THEN cargo END AS cargo_temp, CASE WHEN ok THEN hum END AS humidity,
  CASE WHEN ok THEN vib END AS vibration, CASE WHEN ok THEN door END AS door_status
FROM (SELECT *, event_id % 89 <> 0 AS ok FROM raw)""",
        "payload_roundtrip": f"WITH {SILVER} SELECT * EXCLUDE (temp_delta, dew_point, condensation_risk) FROM silver",
        "valid_events": f"WITH {MEASURED} SELECT {_SAMPLE_COLUMNS} FROM valid",
        "rejected_events": f"""WITH {DECODED}
SELECT {_SAMPLE_COLUMNS} FROM decoded WHERE v IS NULL OR t IS NULL""",
        "dedup_first": f"""WITH {MEASURED}
SELECT {_SAMPLE_COLUMNS} FROM valid
QUALIFY row_number() OVER (PARTITION BY v, t ORDER BY event_id % 3, event_id) = 1""",
        "temp_delta": f"""WITH {MEASURED}
SELECT event_id AS "offset", cargo AS cargo_temp, ambient AS ambient_temp, delta AS temp_delta
FROM measured""",
        "dew_point": f"""WITH {MEASURED}
SELECT event_id AS "offset", cargo AS cargo_temp, hum AS humidity, dew AS dew_point
FROM measured""",
        "condensation_risk": f"""WITH {MEASURED}
SELECT event_id AS "offset", cargo AS cargo_temp, dew AS dew_point, risk AS condensation_risk
FROM measured""",
        "silver_events": silver_rows,
        "flat_silver": f"WITH {FLAT_SILVER} SELECT * FROM flat_silver",
        # windows
        "window_metrics": gold_rows,
        "anomaly_windows": gold_rows + " WHERE anomaly_flag",
        "flat_window_metrics": f"WITH {FLAT_GOLD} SELECT * FROM gold",
        # whole-table reports
        "vehicle_totals": f"""WITH {SILVER}
SELECT vehicle_id, count(*) AS total_events, max(cargo_temp) AS max_cargo_temp
FROM silver GROUP BY vehicle_id""",
        "risk_events": f"""WITH {SILVER}
SELECT * FROM silver WHERE {_EVENT_ANOMALY} OR condensation_risk""",
        "vehicle_ids": f"WITH {SILVER} SELECT DISTINCT vehicle_id FROM silver",
        "vehicle_slot": f"""WITH {SILVER}
SELECT vehicle_id, CAST({_SLOT} AS INT) AS slot, {_PALETTE}[{_SLOT} + 1] AS color
FROM (SELECT DISTINCT vehicle_id FROM silver)""",
        "layer_heartbeat": f"""WITH {GOLD}
SELECT 'bronze' AS layer, count(*) AS total,
       strftime(max(broker_time), '%Y-%m-%d %H:%M:%S') AS latest,
       max(event_id) AS latest_offset FROM raw
UNION ALL SELECT 'silver', count(*), strftime(max("timestamp"), '%Y-%m-%d %H:%M:%S'), NULL
FROM silver
UNION ALL SELECT 'gold', count(*), strftime(max(window_end), '%Y-%m-%d %H:%M:%S'), NULL
FROM gold""",
        "partition_offsets": """
SELECT 'fleet-telemetry' AS topic, CAST(event_id % 3 AS INT) AS "partition", count(*) AS total,
       max(event_id) AS latest_offset FROM events GROUP BY ALL""",
        "layer_feed": f"""WITH {GOLD},{BODY}
(SELECT 'bronze' AS layer, 'raw #' || event_id || ' at '
   || strftime(broker_time, '%Y-%m-%d %H:%M:%S') || ': ' || substring(txt, 1, 110) AS line
 FROM body ORDER BY broker_time DESC, event_id % 3, event_id LIMIT 5)
UNION ALL
(SELECT 'silver', 'event of ' || vehicle_id || ' at ' || strftime("timestamp", '%Y-%m-%d %H:%M:%S')
   || ': cargo ' || {_text("cargo_temp")} || ' C (' || {_text("temp_delta")}
   || ' to outside), door ' || {_text("door_status")}
 FROM silver ORDER BY "timestamp" DESC, vehicle_id LIMIT 5)
UNION ALL
(SELECT 'gold', 'window of ' || vehicle_id || ' from ' || strftime(window_start, '%H:%M:%S')
   || ' to ' || strftime(window_end, '%H:%M:%S') || ': mean cargo ' || {_text("avg_cargo_temp")}
   || ' C, flagged ' || {_text("anomaly_flag")}
 FROM gold ORDER BY window_end DESC, vehicle_id LIMIT 5)""",
        # newest-k reports
        "bronze_latest": f"""WITH {BRONZE}
SELECT txt AS payload, broker_time AS "timestamp", CAST(event_id % 3 AS INT) AS "partition",
       event_id AS "offset" FROM body ORDER BY broker_time DESC, event_id % 3, event_id LIMIT 5""",
        "payload_preview": f"""WITH {BRONZE}
SELECT broker_time AS "timestamp", CAST(event_id % 3 AS INT) AS "partition", event_id AS "offset",
       substring(txt, 1, 150) AS payload FROM body ORDER BY broker_time DESC, event_id % 3, event_id LIMIT 20""",
        "console_raw": f"""WITH {BRONZE}
SELECT broker_time AS "timestamp", CAST(event_id % 3 AS INT) AS "partition", event_id AS "offset",
       substring(txt, 1, 120) AS payload_preview
FROM body ORDER BY broker_time DESC, event_id % 3, event_id LIMIT 10""",
        "silver_latest": f"""WITH {SILVER}
SELECT "timestamp", vehicle_id, ambient_temp, cargo_temp, temp_delta, door_status
FROM silver ORDER BY "timestamp" DESC, vehicle_id LIMIT 5""",
        "silver_recent": f"WITH {RECENT} SELECT * FROM recent",
        "gold_latest": f"""WITH {GOLD}
SELECT window_start, window_end, vehicle_id, avg_cargo_temp, max_vibration, door_open_count,
       anomaly_flag FROM gold ORDER BY window_end DESC, vehicle_id LIMIT 10""",
        "gold_recent": f"""WITH {GOLD}
SELECT {_GOLD_LIST} FROM gold ORDER BY window_end DESC, vehicle_id LIMIT 100""",
        "anomaly_events": f"""WITH {SILVER}
SELECT "timestamp", vehicle_id, cargo_temp, dew_point, humidity, condensation_risk
FROM silver WHERE {_EVENT_ANOMALY} OR condensation_risk
ORDER BY "timestamp" DESC, vehicle_id LIMIT 50""",
        "console_latest_events": f"""WITH {SILVER}
SELECT "timestamp", vehicle_id, ambient_temp, cargo_temp, dew_point, condensation_risk
FROM silver ORDER BY "timestamp" DESC, vehicle_id LIMIT 10""",
        "console_gold": f"""WITH {GOLD}
SELECT window_start, window_end, vehicle_id, avg_cargo_temp, avg_dew_point,
       condensation_risk_count FROM gold ORDER BY window_end DESC, vehicle_id LIMIT 20""",
        # stored layers
        "register_layers": f"WITH {GOLD},{_LAYER_COUNTS} SELECT layer, total FROM counts",
        "schema_explorer": f"""WITH {GOLD},{_LAYER_COUNTS}
SELECT c.layer, CAST(c."position" AS INT) AS "position", c."column", c."type",
       counts.total AS total_rows
FROM (VALUES {_column_values()}) c(layer, "position", "column", "type") JOIN counts USING (layer)""",
        "bootstrap_tables": f"""WITH {GOLD},{_LAYER_COUNTS}
SELECT c.layer, c."column", c."type", counts.total AS total_rows
FROM (VALUES {_column_values()}) c(layer, "position", "column", "type") JOIN counts USING (layer)""",
        "adhoc_sql": f"""WITH {GOLD}
SELECT s.vehicle_id, s.events, g.windows, g.flagged, (SELECT count(*) FROM raw) AS envelopes
FROM (SELECT vehicle_id, count(*) AS events FROM silver GROUP BY 1) s
JOIN (SELECT vehicle_id, count(*) AS windows, count(*) FILTER (WHERE anomaly_flag) AS flagged
      FROM gold GROUP BY 1) g USING (vehicle_id)""",
        "silver_partition_counts": f"""WITH {SILVER}
SELECT vehicle_id, count(*) AS total FROM silver GROUP BY vehicle_id""",
        "compact_layer": gold_rows,
        "cluster_by_time": silver_rows,
        "maintain_layers": f"""WITH {GOLD},{_LAYER_COUNTS}
SELECT layer, CASE WHEN layer = 'silver' THEN 'cluster' ELSE 'compact' END AS operation,
       'done' AS status, total AS rows_before, total AS rows_after FROM counts""",
        "retention_split": f"""WITH {GOLD}
{_retention("bronze", "raw", "broker_time", "7 DAYS")}
UNION ALL {_retention("silver", "silver", '"timestamp"', "3 HOURS")}
UNION ALL {_retention("gold", "gold", "window_end", "1 HOUR")}""",
        # streams
        "ingest_envelope": envelope,
        "bronze_stream_append": f"""WITH {BRONZE}
SELECT 'fleet-telemetry' AS topic, CAST(event_id % 3 AS INT) AS "partition", event_id AS "offset",
       broker_time AS "timestamp", txt AS payload FROM body
UNION ALL
SELECT 'fleet-telemetry', CAST(event_id % 3 AS INT), event_id, broker_time, flat_txt FROM body""",
        "stream_to_table": f"""WITH {FLAT_SILVER}
SELECT * FROM flat_silver WHERE "timestamp" <= {FLAT_PASSED}""",
        "stream_dedup_keys": f"""WITH {MEASURED}
SELECT DISTINCT v AS vehicle_id, t AS "timestamp" FROM valid""",
        "stream_silver": silver_rows + f""" WHERE "timestamp" <= {PASSED}""",
        "stream_window_metrics": closed_rows,
        "stream_late_drop": closed_rows,
        "layers_end_to_end": f"WITH {CHAINED} SELECT {_GOLD_LIST} FROM closed",
    }
    texts["bronze_latest_stored"] = texts["bronze_latest"]
    return texts | _status_queries() | _differences()
