"""What each query must return, in SQL over the same tables."""

from __future__ import annotations

from faultline.schemas import STATION_MESSAGE

KEYS = 4000
NOW = "TIMESTAMP '2024-01-30 23:59:00'"

_QUAKES = """
q AS (
  SELECT event_id, ts, user_id, event_type, value, k,
         (event_id * 37) % 2000 / CAST(10 AS DOUBLE) - 100 AS lat,
         (event_id * 91) % 3800 / CAST(10 AS DOUBLE) - 190 AS lon,
         value / 50 AS mag,
         CASE WHEN k % 10 <> 0 THEN CAST(k * 7 AS DOUBLE) END AS depth
  FROM (SELECT *, CAST((props->>'k') AS BIGINT) AS k FROM events)
),
v AS (SELECT * FROM q WHERE lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180)"""

_SITES = """
s AS (
  SELECT s_suppkey AS site_id, s_name,
         (s_suppkey * 53) % 1800 / CAST(10 AS DOUBLE) - 90 AS slat,
         (s_suppkey * 131) % 3600 / CAST(10 AS DOUBLE) - 180 AS slon,
         CASE WHEN s_suppkey % 7 <> 0 THEN 'K' || s_suppkey END AS icao,
         CASE WHEN s_suppkey % 5 <> 0 THEN 'I' || s_suppkey END AS ident
  FROM supplier
)"""

_A = (
    "pow(sin(radians(slat - lat) / 2), 2)"
    " + cos(radians(lat)) * cos(radians(slat)) * pow(sin(radians(slon - lon) / 2), 2)"
)
_KM = f"2 * 6371 * asin(least(1, sqrt({_A})))"
_PAIRS = f"p AS (SELECT v.*, s.*, {_KM} AS km FROM v, s)"
# Of a spot's sites only those can be nearest that lie within its size of the nearest spot's: all pairs are too many.
_NEAR_PAIRS = f"""
spot AS (SELECT round(slat, 0) AS la, round(slon, 0) AS lo, min(slat) AS slat, min(slon) AS slon FROM s GROUP BY ALL),
d AS (SELECT v.*, spot.la, spot.lo, {_KM} AS far FROM v, spot),
near AS (SELECT * FROM d QUALIFY far <= min(far) OVER (PARTITION BY event_id) + 60),
p AS (SELECT near.*, s.*, {_KM.replace('slat', 's.slat').replace('slon', 's.slon')} AS km
      FROM near JOIN s ON round(s.slat, 0) = la AND round(s.slon, 0) = lo)"""
_CLEAN_PAIRS = f"p AS (SELECT v.*, s.*, {_KM} AS km FROM v, s WHERE icao IS NOT NULL OR ident IS NOT NULL)"
_RANKED = (
    "r AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY round(km, 6), site_id) AS rank FROM p)"
)
_MOVED = """
m AS (
  SELECT *,
    round(exp(-2.5 + 0.8 * mag - 1.2 * ln(km3 + 1) - 0.005 * depth), 9) AS pgv,
    round(exp(-3.0 + 0.9 * mag - 1.3 * ln(km3 + 1) - 0.006 * depth), 9) AS pgd
  FROM (SELECT *, round(km, 3) AS km3 FROM r WHERE rank = 1)
)"""
_LABEL = (
    "CASE WHEN pgv < CAST({low} AS DOUBLE) THEN 'Low' WHEN pgv < CAST({mid} AS DOUBLE)"
    " THEN 'Moderate' {other} END"
)
_NULLS_KEPT = "WHEN pgv IS NOT NULL THEN 'High'"


def _station_fields() -> str:
    given = {"region": "event_type", "latitude": "latitude", "longitude": "longitude", "create_at": "create_at"}
    given["update_at"] = "CAST(ts AS VARCHAR)"
    kinds = {
        "double": "value * {i}",
        "string": "'{name}' || (event_id % 8)",
        "boolean": "(event_id + {i}) % 2 = 0",
    }
    return ", ".join(
        given.get(f.name, kinds[f.dataType.simpleString()].format(i=i, name=f.name)) + f' AS "{f.name}"'
        for i, f in enumerate(STATION_MESSAGE.fields, 1)
    )


def _with(*parts: str) -> str:
    return "WITH " + ", ".join(p.strip() for p in parts) + "\n"


def _labelled(low: str = "0.00001", mid: str = "0.0001", other: str = _NULLS_KEPT) -> str:
    label = _LABEL.format(low=low, mid=mid, other=other)
    return f"c AS (SELECT *, {label} AS intensity_label FROM m)"


_NEAREST = _with(_QUAKES, _SITES, _PAIRS, _RANKED)
_INTENSITY = (_QUAKES, _SITES, _PAIRS, _RANKED, _MOVED)
_FLAG = "coalesce(intensity_label = 'High', false)"
_SUMMARY = (
    f"SELECT intensity_label, count(*) AS events, count(*) FILTER ({_FLAG}) AS high_intensity_events"
    " FROM c GROUP BY intensity_label"
)

_STAMP = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"
_ISO = "replace(CAST(ts AS VARCHAR), ' ', 'T') || 'Z'"

# The fault of each message, as the inputs put them in.
_FAULTY = """
f AS (
  SELECT *, CASE
    WHEN event_id % 37 = 0 THEN 'blank' WHEN event_id % 23 = 0 THEN 'cut'
    WHEN event_id % 31 = 0 THEN 'bare' WHEN event_id % 41 = 0 THEN 'array'
    WHEN event_id % 29 = 0 THEN 'text' WHEN event_id % 43 = 0 THEN 'quoted' ELSE 'fine' END AS fault,
    event_id % 17 = 0 AS no_unid, event_id % 13 = 0 AS no_mag,
    lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180 AS inside
  FROM q
)"""
_CHECKED = """
e AS (
  SELECT CASE
    WHEN fault IN ('blank', 'cut') THEN 'malformed_json' WHEN fault = 'bare' THEN 'empty_properties'
    WHEN fault = 'array' THEN 'no_data' WHEN no_unid THEN 'missing_unid'
    WHEN no_mag THEN 'missing_mag' WHEN fault = 'text' THEN 'not_numeric'
    WHEN NOT inside THEN 'out_of_range' ELSE 'valid' END AS reason
  FROM f
)"""
_STATIONS = """
st AS (
  SELECT *, CASE WHEN event_id % 11 = 0 THEN 'heartbeat' WHEN event_id % 19 = 0 THEN 'missing_Station'
       ELSE 'valid' END AS reason,
    (user_id * 29) % 1800 / CAST(10 AS DOUBLE) - 90 AS latitude,
    (user_id * 71) % 3600 / CAST(10 AS DOUBLE) - 180 AS longitude,
    strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS create_at
  FROM events
)"""
_REJECTS = """
j AS (
  SELECT CASE
    WHEN fault = 'blank' THEN 'empty' WHEN fault = 'cut' THEN 'malformed_json'
    WHEN fault IN ('bare', 'array') OR no_unid THEN 'missing_unid'
    WHEN fault IN ('text', 'quoted') THEN 'missing_coordinates'
    WHEN NOT inside THEN 'out_of_range' ELSE 'accepted' END AS reject_reason
  FROM f
)"""
_REJECTS_OF = _REJECTS.replace("END AS reject_reason", "END AS bad, *")
_LATE = """
l AS (
  SELECT *, ts < (SELECT max(ts) FROM j, h WHERE bad = 'accepted' AND event_id < half) - INTERVAL 15 MINUTE AS late FROM j
)"""
_CLUSTERED = """
s AS (
  SELECT c_custkey AS site_id,
         (c_nationkey * 53) % 150 - 75 + (c_custkey * 7919) % 1000 / CAST(10000 AS DOUBLE) AS slat,
         (c_nationkey * 131) % 340 - 170 + (c_custkey * 104729) % 997 / CAST(9970 AS DOUBLE) AS slon
  FROM customer
)"""
_ACCEPTED = (
    "SELECT CAST(event_id AS VARCHAR) AS event_id, 'u' || event_id AS unid, lat AS latitude,"
    " lon AS longitude, CASE WHEN NOT no_mag THEN mag END AS magnitude{more}"
    " FROM f WHERE fault = 'fine' AND NOT no_unid AND inside"
)
_METRICS = (
    "SELECT '{feed}' AS feed, count(*) FILTER (reason = 'valid') AS sent,"
    " count(*) FILTER (reason NOT IN ('valid', 'malformed_json', 'heartbeat')) AS validation_errors,"
    " count(*) FILTER (reason = 'malformed_json') AS json_errors,"
    " count(*) FILTER (reason = 'heartbeat') AS heartbeats FROM {table}"
)
_HALF = "h AS (SELECT (max(event_id) + 2) // 2 AS half FROM events)"
_STATION_KEYS = "SELECT DISTINCT event_type AS region, create_at, latitude, longitude FROM st"


def _one_per_key(direction: str) -> str:
    return _with(_QUAKES) + (
        f"SELECT event_id % {KEYS} AS unid, event_id, mag AS magnitude FROM q QUALIFY row_number()"
        f" OVER (PARTITION BY event_id % {KEYS} ORDER BY ts {direction}, event_id {direction}) = 1"
    )


def _distance(km: str) -> str:
    return _with(_QUAKES, _SITES) + (
        f"SELECT event_id, site_id, round({km}, 3) AS km FROM q JOIN s"
        " ON site_id = user_id % (SELECT count(*) FROM supplier)"
    )


_SLC = (
    "6371 * acos(greatest(-1, least(1, cos(radians(lat)) * cos(radians(slat))"
    " * cos(radians(slon) - radians(lon)) + sin(radians(lat)) * sin(radians(slat)))))"
)


def _audit(name: str, column: str | None) -> str:
    if column is None:
        return (
            f"SELECT '{name}' AS name, count(*) AS total, -1 AS recent, 'OK' AS status,"
            f" 'no time column' AS note FROM {name}"
        )
    recent = f"count(*) FILTER ({column} > {NOW} - INTERVAL 10 MINUTE)"
    return (
        f"SELECT '{name}' AS name, count(*) AS total, {recent} AS recent,"
        f" CASE WHEN {recent} = 0 THEN 'WARN' ELSE 'OK' END AS status,"
        f" CASE WHEN {recent} = 0 THEN 'no rows in the last 10 minutes' ELSE '' END AS note FROM {name}"
    )


_NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()

_RULE = "=" * 80
_TEXT = (
    f"chr(10) || '{_RULE}' || chr(10) || '[create] Earthquake Event' || chr(10) || '{_RULE}' || chr(10)"
    f" || '  Time:      ' || {_ISO} || chr(10) || '  Magnitude: ml ' || CAST(mag AS VARCHAR) || chr(10)"
    " || '  Location:  ' || upper(event_type) || chr(10)"
    " || '  Depth:     ' || coalesce(CAST(depth AS VARCHAR), 'N/A') || ' km' || chr(10)"
    " || '  Coords:    ' || CAST(lat AS VARCHAR) || '°N, ' || CAST(lon AS VARCHAR) || '°E' || chr(10)"
    " || '  Authority: A' || (user_id % 7) || chr(10) || '  Event ID:  u' || event_id || chr(10)"
    f" || '{_RULE}' || chr(10)"
)


def oracle_sql() -> dict[str, str]:
    out = {
        "parse_flatten_events": _with(_QUAKES)
        + f"""SELECT 'create' AS action, CAST(event_id AS VARCHAR) AS event_id, 'u' || event_id AS unid,
            {_STAMP.format('ts')} AS event_time, {_STAMP.format('ts + to_seconds(k)')} AS last_update,
            lat AS latitude, lon AS longitude, depth AS depth_km, lon AS coord_longitude,
            lat AS coord_latitude, -depth AS coord_depth, mag AS magnitude, 'ml' AS magnitude_type,
            upper(event_type) AS region, 'A' || (user_id % 7) AS authority, 'ke' AS event_type,
            CAST(user_id AS VARCHAR) AS source_id, 'CAT' AS source_catalog FROM q""",
        "valid_coordinates": _with(_QUAKES, _FAULTY) + _ACCEPTED.format(more=""),
        "stamped_columns": _with(_QUAKES) + "SELECT count(*) AS processed, count(*) AS dated FROM v",
        "parse_stations": _with(_STATIONS)
        + f"""SELECT CASE WHEN event_id % 11 = 0 THEN 'heartbeat' ELSE 'reading' END AS type,
            event_type AS region, latitude, longitude, '1' AS version, value AS PGA, value / 4 AS PGV,
            value * 2 AS Max_PGA, CAST(event_id % 8 AS VARCHAR) AS Shindo, value / 8 AS Intensity,
            user_id % 2 = 0 AS private, create_at,
            CASE WHEN event_id % 19 <> 0 THEN 'S' || user_id END AS Station,
            {_STAMP.format('ts')} AS kafka_timestamp,
            {_STAMP.format("date_trunc('day', ts)")} AS create_at_ts,
            {_STAMP.format('ts')} AS update_at_ts FROM st""",
        "station_fields": _with(_STATIONS) + f"SELECT {_station_fields()} FROM st",
        "stations_required": _with(_STATIONS)
        + "SELECT event_type AS region, create_at, count(*) AS rows FROM st"
        " WHERE event_id % 7 <> 0 AND event_id % 5 <> 0 GROUP BY ALL",
        "event_points_strings": _with(_QUAKES, _FAULTY)
        + "SELECT CAST(event_id AS VARCHAR) AS event_id, lat, lon, mag AS magnitude, upper(event_type) AS region"
        " FROM f WHERE fault = 'fine' AND NOT no_unid AND inside AND NOT no_mag",
        "validate_events_reasons": _with(_QUAKES, _FAULTY, _CHECKED)
        + "SELECT reason, count(*) AS messages FROM e GROUP BY reason",
        "validate_stations_reasons": _with(_STATIONS)
        + "SELECT reason, count(*) AS messages FROM st GROUP BY reason",
        "validation_metrics": _with(_QUAKES, _FAULTY, _CHECKED, _STATIONS)
        + _METRICS.format(feed="events", table="e")
        + " UNION ALL "
        + _METRICS.format(feed="stations", table="st"),
        "rejects": _with(_QUAKES, _FAULTY, _REJECTS)
        + "SELECT reject_reason, count(*) AS messages FROM j WHERE reject_reason <> 'accepted'"
        " GROUP BY reject_reason",
        "dedup_events_first": _one_per_key("ASC"),
        "dedup_events_latest": _one_per_key("DESC"),
        "dedup_stations": _with(_STATIONS) + _STATION_KEYS,
        "clean_sites": _with(_SITES)
        + """SELECT CAST(site_id AS INTEGER) AS id, ident, icao, s.s_name AS name, slat AS latitude,
            slon AS longitude, s_acctbal AS elevation, 'country-' || s_nationkey AS country
            FROM s JOIN supplier ON s_suppkey = site_id WHERE icao IS NOT NULL OR ident IS NOT NULL""",
        "dedup_sites_null_keys": _with(_SITES)
        + """SELECT 'coalesce' AS mode, coalesce(icao, ident) AS site_key, CAST(min(site_id) AS INTEGER) AS id
            FROM s GROUP BY ALL
            UNION ALL SELECT 'icao', icao, CAST(min(site_id) AS INTEGER) FROM s GROUP BY ALL""",
        "distance_haversine": _distance(_KM),
        "distance_slc": _distance(_SLC),
        "proximity_rows": _with(_QUAKES, _SITES, _PAIRS)
        + "SELECT event_id, site_id, s_name AS airport_name, mag AS magnitude, upper(event_type) AS region,"
        " round(km, 3) AS km FROM p WHERE km < 500",
        "top3_sites": _NEAREST
        + "SELECT event_id, CAST(rank AS INTEGER) AS rank, site_id, round(km, 3) AS km FROM r WHERE rank <= 3",
        "ground_motion": _with(*_INTENSITY)
        + "SELECT event_id, pgv AS estimated_pgv, pgd AS estimated_pgd FROM m",
        "intensity_class": _with(*_INTENSITY, _labelled())
        + f"SELECT event_id, intensity_label, {_FLAG} AS high_intensity_flag FROM c",
        "intensity_class_reference_nulls": _with(*_INTENSITY, _labelled(other="ELSE 'High'"))
        + f"SELECT event_id, intensity_label, {_FLAG} AS high_intensity_flag FROM c",
        "high_intensity": _with(*_INTENSITY, _labelled())
        + "SELECT event_id, mag AS magnitude, site_id FROM c WHERE intensity_label = 'High'",
        "intensity_summary": _with(*_INTENSITY, _labelled()) + _SUMMARY,
        "intensity_table": _with(_QUAKES, _SITES, _CLEAN_PAIRS, _RANKED, _MOVED, _labelled("0.1", "1.0"))
        + _SUMMARY,
        "audit_tables": "\nUNION ALL ".join(
            [_audit("events", "ts"), _audit("orders", "o_orderdate"), _audit("lineitem", None)]
            + ["SELECT 'absent', -1, -1, 'FAILED', 'table does not exist'"]
        ),
        "recent_count": f"SELECT count(*) AS total, count(*) FILTER (ts > {NOW} - INTERVAL 1440 MINUTE)"
        " AS recent FROM events",
        "latest_rows": f"SELECT event_id, user_id, value, {_STAMP.format('ts')} AS processed_at FROM events"
        " ORDER BY ts DESC, event_id LIMIT 20",
        "table_summary": "\nUNION ALL ".join(
            f"SELECT '{n}.parquet' AS \"table\", CAST(1 AS BIGINT) AS files, count(*) AS \"rows\","
            f" true AS has_bytes FROM {n}"
            for n in _NAMES
        ),
        "table_overwrite": "SELECT user_id, count(*) AS events, max(event_id) AS last_id FROM events GROUP BY user_id",
        "size_in_mb": "SELECT source, round(sum(strlen(text)) / 1024 / 1024, 2) AS size_mb FROM documents GROUP BY source",
        "table_history": """
            SELECT 'events' AS "table", version, operation, n AS "rows"
            FROM (SELECT count(*) AS n FROM events),
                 (VALUES (1::BIGINT, 'append'), (2, 'overwrite'), (3, 'append')) AS w(version, operation)
            UNION ALL SELECT 'orders', 0::BIGINT, 'overwrite', count(*) FROM orders""",
        "render_events": _with(_QUAKES) + f"SELECT 'u' || event_id AS event_id, {_TEXT} AS text FROM q",
        "export_csv_rows": _with(_QUAKES)
        + f"""SELECT true AS received, {_ISO} AS event_time, 'create' AS action,
            CAST(mag AS VARCHAR) AS magnitude, 'ml' AS magnitude_type, upper(event_type) AS region,
            CAST(depth AS VARCHAR) AS depth_km, CAST(lat AS VARCHAR) AS latitude,
            CAST(lon AS VARCHAR) AS longitude, 'A' || (user_id % 7) AS authority,
            'u' || event_id AS event_id FROM q""",
        "keyed_json": _with(_QUAKES)
        + "SELECT 'u' || event_id AS key, 'u' || event_id AS unid, lat, lon, depth, mag FROM v",
        "stream_ingest": _with(_QUAKES, _FAULTY)
        + _ACCEPTED.format(more=f", {_STAMP.format('ts')} AS event_time"),
        "stream_stations": _with(_STATIONS) + _STATION_KEYS,
        "stream_rejects": _with(_QUAKES, _FAULTY, _REJECTS)
        + "SELECT reject_reason, count(*) AS messages FROM j GROUP BY reject_reason",
        "stream_dedup_restart": _with(_QUAKES, _HALF)
        + f"SELECT 'u' || (event_id % {KEYS}) AS unid, CASE WHEN min(event_id) < any_value(half)"
        " THEN 'create' ELSE 'update' END AS action FROM v, h GROUP BY event_id % 4000",
        "stream_dedup_watermark": _with(
            _QUAKES,
            _HALF,
            "g AS (SELECT event_id, ts, event_id % half AS id, event_id < half AS first FROM v, h)",
            "w AS (SELECT max(ts) AS last FROM g WHERE first)",
            # Ids whose state the first run leaves behind.
            "kept AS (SELECT id FROM g, w WHERE first AND ts > last - INTERVAL 30 MINUTE)",
        )
        + """SELECT CAST(event_id AS VARCHAR) AS event_id, 'u' || id AS unid FROM g, w
            WHERE first OR (ts > last - INTERVAL 15 MINUTE AND id NOT IN (SELECT id FROM kept))""",
        "stream_late_rows": _with(_QUAKES)
        + f"SELECT DISTINCT 'u' || (event_id % {KEYS}) AS unid, CAST(1 AS BIGINT) AS rows FROM v",
        "stream_bad_times": _with(_QUAKES)
        + f"SELECT DISTINCT 'u' || (event_id % {KEYS}) AS unid, CAST(1 AS BIGINT) AS rows,"
        " CAST(0 AS BIGINT) AS times FROM v",
        "ingest_accounted": _with(_QUAKES, _FAULTY, _REJECTS)
        + "SELECT CASE WHEN reject_reason = 'accepted' THEN 'accepted' ELSE 'rejected' END AS outcome,"
        " CAST(sum(CASE WHEN reject_reason = 'accepted' THEN 1 ELSE 2 END) AS BIGINT) AS messages"
        " FROM j GROUP BY 1",
        "nearest_site_clustered": _with(_QUAKES, _CLUSTERED, _NEAR_PAIRS, _RANKED)
        + "SELECT event_id, site_id, round(km, 3) AS km FROM r WHERE rank = 1",
        "stream_exact_dedup": _with(_QUAKES, _HALF)
        + f"SELECT 'u' || (event_id % {KEYS}) AS unid, CAST(event_id AS VARCHAR) AS event_id,"
        f" {_STAMP.format('ts')} AS event_time FROM v, h QUALIFY row_number() OVER"
        f" (PARTITION BY event_id % {KEYS} ORDER BY event_id >= half, ts, ts + to_seconds(k), CAST(event_id AS VARCHAR)) = 1",
        "stream_accounts": _with(_QUAKES, _FAULTY, _REJECTS_OF, _HALF, _LATE)
        + """SELECT outcome, reason, count(*) AS messages FROM (
            SELECT CASE WHEN bad <> 'accepted' THEN 'rejected' ELSE 'accepted' END AS outcome,
                   CASE WHEN bad <> 'accepted' THEN bad ELSE '' END AS reason FROM j, h WHERE event_id < half
            UNION ALL
            SELECT CASE WHEN bad <> 'accepted' THEN 'rejected' WHEN late THEN 'late' WHEN event_id < half THEN 'repeat'
                   ELSE 'accepted' END, CASE WHEN bad <> 'accepted' THEN bad ELSE '' END FROM l, h
        ) GROUP BY ALL""",
        "stream_late_table": _with(_QUAKES, _FAULTY, _REJECTS_OF, _HALF, _LATE)
        + f"""SELECT 'late' AS reason, 'u' || event_id AS unid, CAST(event_id AS VARCHAR) AS event_id, lat AS latitude,
            lon AS longitude, CASE WHEN NOT no_mag THEN mag END AS magnitude, {_STAMP.format('ts')} AS event_time
            FROM l WHERE late AND bad = 'accepted'""",
        "stream_station_accounts": _with(_STATIONS)
        + """, o AS (SELECT CASE WHEN event_id % 13 = 0 THEN 'malformed_json' WHEN event_id % 7 = 0 THEN 'missing_region'
                   WHEN event_id % 5 = 0 THEN 'missing_create_at' ELSE 'fine' END AS fault, * FROM st)
            SELECT 'rejected' AS outcome, fault AS reason, 2 * count(*) AS messages FROM o WHERE fault <> 'fine' GROUP BY fault
            UNION ALL SELECT 'accepted', '', count(DISTINCT (event_type, create_at, latitude, longitude)) FROM o WHERE fault = 'fine'
            UNION ALL SELECT 'repeat', '', 2 * count(*) - count(DISTINCT (event_type, create_at, latitude, longitude))
            FROM o WHERE fault = 'fine'""",
        "sample_rows_known": "SELECT least(count(*), 5) AS rows FROM events",
        "stream_revisions": _with(_QUAKES)
        + f"""SELECT 'u' || (event_id % {KEYS}) AS unid, CAST(event_id AS VARCHAR) AS event_id FROM v
            QUALIFY row_number() OVER (PARTITION BY event_id % {KEYS}
            ORDER BY ts + to_seconds(k) DESC, ts DESC) = 1""",
        "stream_proximity": _with(_QUAKES, _SITES, _CLEAN_PAIRS)
        + "SELECT event_id, coalesce(icao, ident) AS site_id, s_name AS airport_name, mag AS magnitude,"
        " upper(event_type) AS region, round(km, 3) AS km FROM p WHERE km < 500",
    }
    within = _with(_QUAKES, _SITES, _PAIRS) + "SELECT event_id, site_id, round(km, 3) AS km FROM p WHERE km < 500"
    nearest = _NEAREST + "SELECT event_id, site_id, round(km, 3) AS km FROM r WHERE rank = 1"
    out["nearest_site_slc"] = _NEAREST + f"SELECT event_id, site_id, round({_SLC}, 3) AS km FROM r WHERE rank = 1"
    out |= {n: within for n in ("within_500km", "within_500km_grid")}
    out |= {n: nearest for n in ("nearest_site_auto", "nearest_site_grid", "stream_nearest")}
    return out
