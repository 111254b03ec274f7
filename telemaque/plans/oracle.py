"""The same queries in ANSI SQL over the same tables, for an independent check.

Written from the definitions, not from the Spark plans: joins are spelled out pair by pair where
the Spark side works with totals.
"""

from __future__ import annotations

# The events table as topic rows.
_BOUND = """
placed AS (
  SELECT *, CAST(event_id % 4 AS INTEGER) AS "partition", event_id // 4 AS "offset" FROM events
),
flat_text AS (
  SELECT "partition", "offset", event_id, event_type, props,
         'TR' || user_id AS "tripId",
         'D' || (user_id % 7) AS departure_name,
         CAST(45 + value / 1000 AS VARCHAR) AS departure_latitude,
         CAST(-73 + value / 1000 AS VARCHAR) AS departure_longitude,
         'A' || (user_id % 5) AS arrival_name,
         CAST(46.5::DOUBLE + (user_id % 10) / 10.0::DOUBLE AS VARCHAR) AS arrival_latitude,
         '-71.5' AS arrival_longitude,
         ts AS heure_depart,
         event_type = 'purchase' AS flag_arrivee
  FROM placed
),
flat AS (
  SELECT * REPLACE (
    CAST(departure_latitude AS DOUBLE) AS departure_latitude,
    CAST(departure_longitude AS DOUBLE) AS departure_longitude,
    CAST(arrival_latitude AS DOUBLE) AS arrival_latitude,
    CAST(arrival_longitude AS DOUBLE) AS arrival_longitude)
  FROM flat_text
),
vehicle AS (
  SELECT CAST(user_id % 4 AS INTEGER) AS "partition", user_id // 4 AS "offset",
         'V' || user_id AS immatriculation,
         'VIN' || user_id AS vin,
         'Make ' || (user_id % 14) AS marque,
         CAST(2010 + user_id % 15 AS INTEGER) AS "année",
         'Color ' || (user_id % 7) AS color,
         'Fuel ' || (user_id % 4) AS "fuelType",
         'TR' || user_id AS "IDTrajet",
         'C' || user_id AS "IDChauffeur",
         CAST(0.0 AS FLOAT) AS speed,
         min(ts) AS "DateDebutTrajet"
  FROM events WHERE event_type = 'signup' GROUP BY user_id
),
emergency_raw AS (
  SELECT "partition", "offset", ts AS "EmergencyTime", 'V' || user_id AS "evehicleID",
         'TR' || user_id AS "emergencyTrip",
         ['ACCIDENT','FIRE','POLICE','MEDICAL','NONE'][event_id % 5 + 1] AS "emergencyType",
         ['RESOLVED','ON GOING'][event_id % 2 + 1] AS "emergencyStatus"
  FROM placed WHERE event_type = 'error'
),
emergency AS (
  SELECT * REPLACE (CASE WHEN "emergencyType" = 'NONE' THEN 'NONE' ELSE "emergencyStatus" END AS "emergencyStatus")
  FROM emergency_raw
),
weather AS (
  SELECT "partition", "offset", ts AS "WeatherTime", 'V' || user_id AS "wvehicleID",
         'TR' || user_id AS "weatherTrip",
         ['RAIN','SNOW','CLOUDY'][event_id % 3 + 1] AS "weatherCondition",
         CAST(event_id % 61 - 30 AS INTEGER) AS temperature,
         CAST(event_id % 51 AS INTEGER) AS wind_speed,
         ['W','S','O','E'][event_id % 4 + 1] AS wind_dir,
         CAST(event_id % 61 AS INTEGER) AS wind_degree,
         CAST(event_id % 101 AS INTEGER) AS humidity
  FROM placed WHERE event_type = 'view'
),
"""

_FLAT_NAMES = (
    '"tripId", departure_name, departure_latitude, departure_longitude, '
    "arrival_name, arrival_latitude, arrival_longitude, heure_depart, flag_arrivee"
)
_PLACE = '"partition", "offset"'
_PING = f'{_PLACE}, "tripId", heure_depart, departure_latitude, departure_longitude, flag_arrivee'


def _iso(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%dT%H:%M:%S.%f')"


def _json(*fields: tuple[str, str, bool]) -> str:
    """A JSON object of (name, SQL text expression, quoted) as one SQL expression."""
    parts = []
    for name, expression, quoted in fields:
        q = '"' if quoted else ""
        parts.append(f"""'"{name}":{q}' || {expression} || '{q}'""")
    return "'{' || " + " || ',' || ".join(parts) + " || '}'"


def _gps(end: str) -> str:
    return _json(*[(field, f"{end}_{field}", True) for field in ("name", "latitude", "longitude")])


_TRIP_TEXT = _json(
    ("tripId", '"tripId"', True),
    ("departure", _gps("departure"), False),
    ("arrival", _gps("arrival"), False),
    ("heure_depart", _iso("heure_depart"), True),
    ("flag_arrivee", "CAST(flag_arrivee AS VARCHAR)", False),
)
_TEXTS = {
    ("trajet_data1", "flat_text"): _TRIP_TEXT,
    ("vehicle_data1", "vehicle"): _json(
        *[(c, f'"{c}"', True) for c in ("immatriculation", "vin", "marque")],
        ("année", '"année"', False),
        *[(c, f'"{c}"', True) for c in ("color", "fuelType", "IDTrajet", "IDChauffeur")],
        ("speed", "'0.0'", False),
        ("DateDebutTrajet", _iso('"DateDebutTrajet"'), True),
    ),
    ("emergency_data1", "emergency_raw"): _json(
        ("EmergencyTime", _iso('"EmergencyTime"'), True),
        *[(c, f'"{c}"', True) for c in ("evehicleID", "emergencyTrip", "emergencyType", "emergencyStatus")],
    ),
    ("weather_data1", "weather"): _json(
        ("WeatherTime", _iso('"WeatherTime"'), True),
        *[(c, f'"{c}"', True) for c in ("wvehicleID", "weatherTrip", "weatherCondition")],
        *[(c, c, False) for c in ("temperature", "wind_speed")],
        ("wind_dir", "wind_dir", True),
        *[(c, c, False) for c in ("wind_degree", "humidity")],
    ),
}

_LINE = (
    """'trajets,tripId=' || "tripId" || ',departure=' || departure_name || ',arrival=' || arrival_name """
    """|| ' departure_latitude=' || departure_latitude || ',departure_longitude=' || departure_longitude """
    """|| ',arrival_latitude=' || arrival_latitude || ',arrival_longitude=' || arrival_longitude """
    """|| ',flag_arrivee=' || CAST(flag_arrivee AS VARCHAR) """
    """|| ' ' || CAST(floor(epoch(heure_depart)) AS BIGINT)"""
)


def _haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (
        f"pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) "
        f"* pow(sin((radians({lon2}) - radians({lon1})) / 2), 2)"
    )
    return f"(6371.0::DOUBLE * 2 * atan2(sqrt({a}), sqrt(1 - ({a}))))"


_DISTANCE = _haversine("departure_latitude", "departure_longitude", "arrival_latitude", "arrival_longitude")


def _sql(body: str, *ctes: str) -> str:
    extra = "".join(f"{cte},\n" for cte in ctes)
    bound = (_BOUND + extra).strip().rstrip(",")
    return f"WITH {bound}\n{body}"


# All pings with the broker's time; each trip of an even user ends with one that repeats the last time, with the flag.
_STORED = """stored AS (
  SELECT *, heure_depart AS "timestamp" FROM flat
  UNION ALL
  SELECT * REPLACE (CAST(("partition" + 1) % 4 AS INTEGER) AS "partition", "offset" - 1 AS "offset", true AS flag_arrivee),
         heure_depart AS "timestamp"
  FROM (SELECT * FROM flat WHERE CAST(substr("tripId", 3) AS BIGINT) % 2 = 0
        QUALIFY row_number() OVER (PARTITION BY "tripId" ORDER BY heure_depart DESC, "partition" DESC, "offset" DESC) = 1)
)"""
_LAST = 'heure_depart DESC, flag_arrivee DESC, "timestamp" DESC, "partition" DESC, "offset" DESC'
_STATUS = f"""{_STORED},
status AS (
  SELECT "tripId", heure_depart AS last_ping, flag_arrivee AS arrived
  FROM (SELECT *, row_number() OVER (PARTITION BY "tripId" ORDER BY {_LAST}) AS rn FROM stored) WHERE rn = 1
)"""

# Slices of time in which messages are sent, and the watermark that the last of them leads to.
def _sliced(count: int) -> str:
    return f"""span AS (
  SELECT CAST(floor(epoch(min(heure_depart))) AS BIGINT) AS low, CAST(floor(epoch(max(heure_depart))) AS BIGINT) AS high,
         max(heure_depart) AS last FROM flat
),
sliced AS (
  SELECT f.*, ({count} * (CAST(floor(epoch(heure_depart)) AS BIGINT) - low)) // (high - low + 1) AS own
  FROM flat f, span
),
sent AS (
  SELECT *, CASE WHEN event_id % 7 = 0 THEN least(own + 1, {count - 1}) ELSE own END AS slice FROM sliced
),
taken AS (SELECT * FROM sliced WHERE NOT (own = 0 AND event_id % 11 = 0)),
mark AS (
  SELECT date_trunc('milliseconds', last) - to_seconds((high - low + 1 + {count - 1}) // {count} + 3600) AS watermark FROM span
)"""


_MEASURES = """count(*) AS n_pings, count(*) FILTER (flag_arrivee) AS n_arrivals, min(heure_depart) AS first_ping,
       max(heure_depart) AS last_ping, min(departure_latitude) AS min_latitude, max(departure_latitude) AS max_latitude"""


def _windows(size_h: int, slide_h: int) -> str:
    starts = ", ".join(str(i) for i in range(size_h // slide_h))
    return _sql(
        f"""SELECT departure_name, window_start, window_start + INTERVAL '{size_h}' HOUR AS window_end, {_MEASURES}
FROM (SELECT *, time_bucket(INTERVAL '{slide_h}' HOUR, heure_depart, TIMESTAMP '1970-01-01') - to_hours({slide_h} * i) AS window_start
      FROM taken, (SELECT unnest([{starts}]) AS i)), mark
GROUP BY departure_name, window_start, watermark
HAVING window_start + INTERVAL '{size_h}' HOUR <= watermark""",
        _sliced(4),
    )


_MESSAGE_TEXT = "\nUNION ALL\n".join(
    f"SELECT '{topic}' AS topic, {_PLACE}, {text} AS decoded_value FROM {table}"
    for (topic, table), text in _TEXTS.items()
)

ORACLE_SQL: dict[str, str] = {
    "topic_replay": _sql(f"SELECT {_PLACE}, {_FLAT_NAMES} FROM flat_text"),
    "topic_counts": _sql(
        "\nUNION ALL\n".join(
            f"SELECT '{topic}' AS topic, count(*) AS n_rows FROM {table}" for topic, table in _TEXTS
        )
    ),
    "json_scan": _sql(
        f"SELECT {_FLAT_NAMES} FROM (SELECT * REPLACE ({_iso('heure_depart')} AS heure_depart) FROM flat_text)"
    ),
    "json_scan_typed": _sql(f"SELECT {_FLAT_NAMES} FROM flat_text"),
    "decode_value": _sql(f"SELECT {_PLACE}, {_TRIP_TEXT} AS decoded_value FROM flat_text"),
    "parse_trip": _sql(
        f'SELECT {_PLACE}, "tripId", {_gps("departure")} AS departure, {_gps("arrival")} AS arrival, '
        "heure_depart, flag_arrivee FROM flat_text"
    ),
    "parse_vehicle": _sql("SELECT * FROM vehicle"),
    "parse_emergency": _sql("SELECT * FROM emergency_raw"),
    "parse_weather": _sql("SELECT * FROM weather"),
    "encode_topic": _sql(_MESSAGE_TEXT),
    "rejected_rows": _sql(
        f"""SELECT {_PLACE},
       CASE event_type WHEN 'error' THEN props WHEN 'view' THEN '' ELSE '{{"tripId":"' || "tripId" END AS payload,
       CASE event_type WHEN 'error' THEN 'missing tripId' WHEN 'view' THEN 'empty' ELSE 'malformed' END AS reason
FROM flat_text WHERE event_type IN ('error', 'signup', 'view')"""
    ),
    "accepted_rows": _sql(
        f"SELECT {_PLACE}, {_FLAT_NAMES} FROM flat_text WHERE event_type NOT IN ('error', 'signup', 'view')"
    ),
    "dedupe_events": _sql(f"SELECT DISTINCT {_FLAT_NAMES} FROM flat"),
    "flatten_trip": _sql(f"SELECT {_PLACE}, {_FLAT_NAMES} FROM flat_text"),
    "cast_trip": _sql(f"SELECT {_PLACE}, {_FLAT_NAMES} FROM flat"),
    "trip_typed": _sql(f"SELECT {_PLACE}, {_FLAT_NAMES} FROM flat"),
    "line_protocol": _sql(f"SELECT {_PLACE}, {_LINE} AS line FROM flat"),
    "line_protocol_strict": _sql(f"SELECT {_PLACE}, {_LINE} AS line FROM flat"),
    "geo_points": _sql(
        f'SELECT {_PLACE}, "tripId", departure_latitude AS departure_lat, departure_longitude AS departure_lon, '
        "arrival_latitude AS arrival_lat, arrival_longitude AS arrival_lon FROM flat"
    ),
    "dedupe_columns": _sql(
        'SELECT f."tripId", f.heure_depart, f.departure_name, v.immatriculation '
        'FROM flat f JOIN vehicle v ON f."tripId" = v."IDTrajet"'
    ),
    "trip_distance": _sql(f'SELECT {_PLACE}, "tripId", round({_DISTANCE}, 6) AS distance_km FROM flat'),
    "arrived_trips": _sql(
        f"""SELECT * FROM (
  SELECT {_PLACE}, "tripId", arrival_name, round({_DISTANCE}, 6) AS distance_km FROM flat)
WHERE distance_km <= 210"""
    ),
    "emergency_normalize": _sql("SELECT * FROM emergency"),
    "trip_vehicle": _sql(
        f"""SELECT {_PING}, v.* EXCLUDE ("partition", "offset", "IDTrajet")
FROM flat f JOIN vehicle v ON f."tripId" = v."IDTrajet" """.replace(_PING, _PING.replace(_PLACE, 'f."partition", f."offset"'))
    ),
    "trip_emergency": _sql(
        """SELECT f."partition", f."offset", f."tripId", f.heure_depart, f.departure_latitude, f.departure_longitude,
       f.flag_arrivee, e."emergencyType", e."emergencyStatus", count(*) AS n_reports,
       min(e."EmergencyTime") AS first_report, max(e."EmergencyTime") AS last_report
FROM flat f JOIN emergency e ON f."tripId" = e."emergencyTrip" GROUP BY ALL"""
    ),
    "trip_weather": _sql(
        """SELECT f."partition", f."offset", f."tripId", f.heure_depart, f.departure_latitude, f.departure_longitude,
       f.flag_arrivee, w."weatherCondition", count(*) AS n_reports,
       min(w.temperature) AS min_temperature, max(w.temperature) AS max_temperature,
       max(w.wind_speed) AS max_wind_speed, min(w.humidity) AS min_humidity, max(w.humidity) AS max_humidity
FROM flat f JOIN weather w ON f."tripId" = w."weatherTrip" GROUP BY ALL"""
    ),
    "trip_360": _sql(
        """SELECT f."tripId",
       count(DISTINCT f.event_id) AS n_pings, min(f.heure_depart) AS first_ping, max(f.heure_depart) AS last_ping,
       bool_or(f.flag_arrivee) AS ever_arrived,
       count(DISTINCT v.immatriculation) AS n_vehicles, min(v.immatriculation) AS immatriculation,
       count(DISTINCT (e."partition", e."offset")) AS n_emergencies,
       count(DISTINCT (e."partition", e."offset")) FILTER (e."emergencyStatus" = 'ON GOING') AS n_ongoing,
       count(DISTINCT (w."partition", w."offset")) AS n_weathers,
       min(w.temperature) AS min_temperature, max(w.temperature) AS max_temperature,
       count(*) AS view_rows
FROM flat f
JOIN vehicle v ON f."tripId" = v."IDTrajet"
JOIN emergency e ON f."tripId" = e."emergencyTrip"
JOIN weather w ON f."tripId" = w."weatherTrip"
GROUP BY f."tripId" """
    ),
    "trip_360_interval": _sql(
        """SELECT f."tripId", f."partition", f."offset", f.heure_depart,
       count(DISTINCT (e."partition", e."offset")) AS n_emergencies,
       count(DISTINCT (w."partition", w."offset")) AS n_weathers,
       CAST(sum(w.temperature) * count(DISTINCT (w."partition", w."offset")) // count(*) AS BIGINT) AS sum_temperature,
       count(DISTINCT v.immatriculation) AS n_vehicles,
       count(*) AS view_rows
FROM flat f
JOIN vehicle v ON f."tripId" = v."IDTrajet"
JOIN emergency e ON f."tripId" = e."emergencyTrip"
 AND e."EmergencyTime" BETWEEN f.heure_depart - INTERVAL '6' HOUR AND f.heure_depart + INTERVAL '6' HOUR
JOIN weather w ON f."tripId" = w."weatherTrip"
 AND w."WeatherTime" BETWEEN f.heure_depart - INTERVAL '6' HOUR AND f.heure_depart + INTERVAL '6' HOUR
GROUP BY ALL"""
    ),
    "released_vehicles": _sql(
        """SELECT * EXCLUDE ("partition", "offset") FROM vehicle v
WHERE EXISTS (SELECT 1 FROM flat f WHERE f."tripId" = v."IDTrajet" AND f.flag_arrivee)"""
    ),
    "available_vehicles": _sql(
        """SELECT * EXCLUDE ("partition", "offset") FROM vehicle v
WHERE EXISTS (
  SELECT 1 FROM status s WHERE s."tripId" = v."IDTrajet" AND s.arrived)""",
        _STATUS,
    ),
    "point_upsert": _sql(
        f"""SELECT "tripId", departure_name, arrival_name, epoch_s, {_PLACE}, departure_latitude, departure_longitude,
       arrival_latitude, arrival_longitude, heure_depart, flag_arrivee, "timestamp"
FROM (
  SELECT *, row_number() OVER (PARTITION BY "tripId", departure_name, arrival_name, epoch_s ORDER BY {_LAST}) AS rn
  FROM (SELECT *, CAST(floor(epoch(heure_depart)) AS BIGINT) // 3600 * 3600 AS epoch_s FROM stored))
WHERE rn = 1""",
        _STORED,
    ),
    "trip_latest": _sql(
        f"""SELECT {_PLACE}, {_FLAT_NAMES}, "timestamp" FROM (
  SELECT *, row_number() OVER (PARTITION BY "tripId" ORDER BY {_LAST}) AS rn FROM stored)
WHERE rn = 1""",
        _STORED,
    ),
    "trip_status": _sql('SELECT "tripId", last_ping, arrived, NOT arrived AS open FROM status', _STATUS),
    "payload_chunks": _sql(
        f"""SELECT "partition", "offset" // 1000 AS chunk, count(*) AS n_lines,
       string_agg(line, chr(10) ORDER BY "offset") AS body
FROM (SELECT {_PLACE}, {_LINE} AS line FROM flat) GROUP BY 1, 2"""
    ),
    "parquet_roundtrip": _sql(f"SELECT {_PLACE}, {_FLAT_NAMES}, CAST(heure_depart AS DATE) AS event_date FROM flat"),
    "csv_roundtrip": _sql(
        f"""SELECT {_PLACE}, {_FLAT_NAMES},
       CASE event_id % 6 WHEN 0 THEN 'a' || chr(10) || 'b' WHEN 1 THEN '' WHEN 2 THEN ' x ' WHEN 3 THEN 'say "yes", no'
         WHEN 4 THEN 'c:' || chr(92) || 'new' || chr(92) || chr(13) || chr(10) END AS note
FROM flat"""
    ),
    "stream_to_parquet": _sql(f"SELECT {_PLACE}, {_FLAT_NAMES}, CAST(heure_depart AS DATE) AS event_date FROM flat"),
    "stream_line_protocol": _sql(f"SELECT {_LINE} AS line FROM flat"),
    "fan_out": _sql(
        "\nUNION ALL\n".join(
            f'SELECT \'{name}\' AS stream, count(*) AS n_rows, count(DISTINCT "{key}") AS n_trips FROM {table}'
            for name, key, table in (
                ("points", "tripId", "flat"),
                ("trajet", "tripId", "flat"),
                ("cars", "IDTrajet", "vehicle"),
                ("emergency", "emergencyTrip", "emergency"),
                ("weather", "weatherTrip", "weather"),
            )
        )
    ),
    "trip_sessions": _sql(
        f"""SELECT "tripId", min(heure_depart) AS session_start, max(heure_depart) + INTERVAL '6' HOUR AS session_end, {_MEASURES}
FROM (
  SELECT *, sum(starts) OVER (PARTITION BY "tripId" ORDER BY heure_depart, event_id) AS session FROM (
    SELECT *, CASE WHEN heure_depart <= lag(heure_depart) OVER (PARTITION BY "tripId" ORDER BY heure_depart, event_id)
      + INTERVAL '6' HOUR THEN 0 ELSE 1 END AS starts FROM taken)), mark
GROUP BY "tripId", session, watermark
HAVING max(heure_depart) + INTERVAL '6' HOUR <= watermark""",
        _sliced(4),
    ),
    "departure_days": _windows(24, 24),
    "departure_windows": _windows(24, 12),
    "trip_360_stream": _sql(
        """SELECT f."partition", f."offset", f."tripId", f.heure_depart, v.immatriculation, v."DateDebutTrajet",
       e."EmergencyTime", e."emergencyType", e."emergencyStatus", w."WeatherTime", w."weatherCondition", w.temperature
FROM flat f
JOIN vehicle v ON f."tripId" = v."IDTrajet"
 AND v."DateDebutTrajet" BETWEEN f.heure_depart - INTERVAL '10' DAY AND f.heure_depart + INTERVAL '10' DAY
JOIN emergency e ON f."tripId" = e."emergencyTrip"
 AND e."EmergencyTime" BETWEEN f.heure_depart - INTERVAL '6' HOUR AND f.heure_depart + INTERVAL '6' HOUR
JOIN weather w ON f."tripId" = w."weatherTrip"
 AND w."WeatherTime" BETWEEN f.heure_depart - INTERVAL '6' HOUR AND f.heure_depart + INTERVAL '6' HOUR"""
    ),
    "dedupe_stream": _sql(f"SELECT DISTINCT {_FLAT_NAMES} FROM flat"),
    "one_read_two_sinks": _sql(
        "\nUNION ALL\n".join(
            f"""SELECT '{sink}' AS sink, CAST(slice AS INTEGER) AS batch_id, count(*) AS n_rows, count(DISTINCT "tripId") AS n_trips
FROM sent GROUP BY slice"""
            for sink in ("rows", "points")
        ),
        _sliced(3),
    ),
    "compacted_rows": _sql(f"SELECT {_PLACE}, {_FLAT_NAMES} FROM flat"),
    "offset_ranges": _sql(
        f"""SELECT {_PLACE}, {_FLAT_NAMES} FROM flat f
WHERE ("partition" = 0 AND "offset" >= 10 AND "offset" < 120) OR ("partition" = 1 AND "offset" >= 50)
   OR ("partition" >= 2 AND "offset" BETWEEN (SELECT min("offset") FROM flat d WHERE d."partition" = f."partition"
        AND d.heure_depart >= TIMESTAMP '2024-01-10' AND d.heure_depart < TIMESTAMP '2024-01-11')
      AND (SELECT max("offset") FROM flat d WHERE d."partition" = f."partition"
        AND d.heure_depart >= TIMESTAMP '2024-01-10' AND d.heure_depart < TIMESTAMP '2024-01-11'))"""
    ),
    "recovered_sink": _sql(f"SELECT {_LINE} AS line FROM flat"),
}
# What a table kept up to date batch by batch holds in the end is what one pass over all rows gives.
ORACLE_SQL |= {"trip_latest_stream": ORACLE_SQL["trip_latest"], "point_upsert_stream": ORACLE_SQL["point_upsert"]}
