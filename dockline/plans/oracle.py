"""DuckDB oracle SQL for every key with a SQL equivalent.

The domain views of ``dockline.sources.fixtures`` are restated as CTEs over
the driver tables; each key's SQL is written independently of the Spark
code (window functions and brute force where the Spark job uses partial
aggregates or a grid join). Rows-only keys (the fitted models) have none.
"""
from __future__ import annotations


def _hav(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (f"pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) "
         f"* pow(sin(radians({lon2} - {lon1}) / 2), 2)")
    return f"(12742.0 * atan2(sqrt({a}), sqrt(1.0 - ({a}))))"


def _tenths(x: str) -> str:
    t = f"cast(floor(({x}) * 10.0 + 0.5) as bigint)"
    return f"(cast({t} // 10 as varchar) || '.' || cast({t} % 10 as varchar))"


VIEWS = """
stations_b AS (
  SELECT c.c_custkey AS skey, cast(c.c_custkey AS varchar) AS station_id, c.c_name AS name,
    CASE WHEN c.c_custkey % 53 = 7 THEN 43.2965::double
         ELSE 48.80::double + cast(c.c_custkey % 101 AS double) * 0.001::double END AS latitude,
    2.25::double + cast(c.c_custkey % 151 AS double) * 0.001::double AS longitude,
    CASE WHEN c.c_custkey % 37 = 5 THEN NULL ELSE 40 + c.c_custkey % 41 END AS capacity,
    CASE WHEN c.c_custkey % 11 = 3 THEN NULL ELSE n.n_name END AS commune
  FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
  WHERE c.c_custkey IN (SELECT user_id FROM events)),
stations_v AS (SELECT station_id, name, latitude, longitude, capacity, commune FROM stations_b),
known_v AS (SELECT station_id, name, latitude, longitude, capacity, commune FROM stations_b WHERE skey % 4 <> 0),
readings_b AS (
  SELECT event_id, cast(user_id AS varchar) AS station_id,
    cast(floor(value / 4) AS bigint) AS num_bikes_available,
    try_cast(json_extract_string(props, '$.k') AS bigint) % 5 AS num_ebikes_available,
    try_cast(json_extract_string(props, '$.k') AS bigint) % 40 AS num_docks_available,
    event_type <> 'error' AS is_renting, event_type <> 'signup' AS is_returning, ts AS observed_at
  FROM events),
readings_v AS (SELECT station_id, num_bikes_available, num_ebikes_available, num_docks_available,
    is_renting, is_returning, observed_at FROM readings_b),
ratio_v AS (SELECT *, num_bikes_available::double
    / nullif((num_bikes_available + num_docks_available)::double, 0.0) AS ratio FROM readings_v),
av_rec AS (
  SELECT r.*, s.name, s.capacity, s.latitude, s.longitude, s.commune, date_trunc('hour', r.observed_at) AS slot
  FROM readings_b r LEFT JOIN stations_v s USING (station_id)),
av_cnt AS (SELECT slot, count(*) AS n FROM av_rec GROUP BY slot),
av_page AS (SELECT a.*, a.event_id % cast(ceil(c.n / 100.0) AS bigint) AS page
  FROM av_rec a JOIN av_cnt c USING (slot)),
av_env AS (
  SELECT slot, page, slot + INTERVAL 1 HOUR AS fetched_at,
    'b-' || strftime(slot, '%Y%m%d%H') || '-' || cast(page AS varchar) AS batch_id,
    count(*) AS n_results, cast(page % 4 AS integer) AS "partition",
    (epoch_us(slot) // 3600000000) * 4294967296 + page AS "offset"
  FROM av_page GROUP BY slot, page),
av_parsed AS (
  SELECT p.*, e.fetched_at, e.batch_id, e."partition", e."offset", e.fetched_at AS micro_batch,
    row_number() OVER (PARTITION BY p.slot, p.page ORDER BY p.observed_at, p.station_id, p.event_id) - 1 AS pos,
    (p.station_id IS NOT NULL AND p.num_bikes_available IS NOT NULL AND p.num_bikes_available >= 0
     AND p.num_docks_available IS NOT NULL AND p.num_docks_available >= 0 AND p.observed_at IS NOT NULL
     AND NOT coalesce(p.capacity IS NOT NULL
                      AND p.num_bikes_available + p.num_docks_available > p.capacity + 2, false)) AS is_valid
  FROM av_page p JOIN av_env e USING (slot, page)),
bad_msg AS (
  SELECT event_id, ts, event_id % 97 = 0 AS is_corrupt FROM events
  WHERE event_id % 97 = 0 OR event_id % 89 = 0),
st_seen AS (SELECT DISTINCT user_id AS skey, cast(ts AS date) AS day FROM events),
st_rec AS (
  SELECT s.skey, v.day, s.station_id, s.name, s.capacity + dayofmonth(v.day) % 2 AS capacity,
    s.latitude, s.longitude
  FROM st_seen v JOIN stations_b s USING (skey)),
st_cnt AS (SELECT day, count(*) AS n FROM st_rec GROUP BY day),
st_parsed AS (
  SELECT r.*, cast(r.day + INTERVAL 1 DAY AS timestamp) AS fetched_at,
    cast(r.day + INTERVAL 1 DAY AS timestamp) AS micro_batch,
    's-' || strftime(r.day, '%Y%m%d') || '-' || cast(r.skey % cast(ceil(c.n / 100.0) AS bigint) AS varchar) AS batch_id,
    cast((r.skey % cast(ceil(c.n / 100.0) AS bigint)) % 2 AS integer) AS "partition",
    date_diff('day', DATE '1970-01-01', r.day) * 4294967296 + r.skey % cast(ceil(c.n / 100.0) AS bigint) AS "offset",
    (r.station_id IS NOT NULL AND r.capacity IS NOT NULL AND r.capacity >= 0
     AND r.latitude IS NOT NULL AND r.latitude BETWEEN 48.0 AND 49.5
     AND r.longitude IS NOT NULL AND r.longitude BETWEEN 1.5 AND 3.0) AS is_valid
  FROM st_rec r JOIN st_cnt c USING (day)),
av_ratio AS (
  SELECT micro_batch, count(*) AS n_total, count(*) FILTER (WHERE is_valid) AS n_valid,
    arg_max(batch_id, "partition" * 10000000000000000 + "offset") AS batch_id, max(fetched_at) AS as_of,
    (count(*) FILTER (WHERE NOT is_valid))::double / count(*) AS reject_ratio
  FROM av_parsed GROUP BY micro_batch),
st_ratio AS (
  SELECT micro_batch, count(*) AS n_total, count(*) FILTER (WHERE is_valid) AS n_valid,
    arg_max(batch_id, "partition" * 10000000000000000 + "offset") AS batch_id, max(fetched_at) AS as_of,
    (count(*) FILTER (WHERE NOT is_valid))::double / count(*) AS reject_ratio
  FROM st_parsed GROUP BY micro_batch),
av_fresh AS (
  SELECT micro_batch, arg_max(batch_id, "partition" * 10000000000000000 + "offset") AS batch_id,
    max(observed_at) AS max_observed_at, max(fetched_at) AS as_of,
    (epoch_us(max(fetched_at)) - epoch_us(max(observed_at))) / 60000000.0 AS freshness_min
  FROM av_parsed WHERE is_valid GROUP BY micro_batch),
fetch_min AS (SELECT DISTINCT event_type AS source, date_trunc('minute', ts) AS fetched_at FROM events),
gaps AS (
  SELECT source, fetched_at, (epoch_us(fetched_at) - epoch_us(prev)) / 60000000.0 AS gap_min FROM (
    SELECT source, fetched_at, lag(fetched_at) OVER (PARTITION BY source ORDER BY fetched_at) AS prev FROM fetch_min)
  WHERE prev IS NOT NULL),
alert_reject AS (
  SELECT md5(concat_ws('|', 'TAUX_REJET_ELEVE', 'stations', batch_id)) AS alert_id, 'TAUX_REJET_ELEVE' AS alert_type,
    'WARNING' AS severity,
    'Stations : ' || __TENTHS_ST__ || '% of records rejected by the quality rules' AS description,
    reject_ratio AS metric_value, batch_id, as_of AS detected_at
  FROM st_ratio WHERE reject_ratio > 0.02
  UNION ALL
  SELECT md5(concat_ws('|', 'TAUX_REJET_ELEVE', 'disponibilite', batch_id)), 'TAUX_REJET_ELEVE', 'WARNING',
    'Disponibilite : ' || __TENTHS_AV__ || '% of records rejected by the quality rules',
    reject_ratio, batch_id, as_of
  FROM av_ratio WHERE reject_ratio > 0.02),
alert_fresh AS (
  SELECT md5(concat_ws('|', 'FRAICHEUR_DEGRADEE', 'disponibilite', batch_id)) AS alert_id,
    'FRAICHEUR_DEGRADEE' AS alert_type, 'WARNING' AS severity,
    'newest reading is ' || __TENTHS_FR__ || ' minutes old' AS description,
    freshness_min AS metric_value, batch_id, as_of AS detected_at
  FROM av_fresh WHERE freshness_min > 10),
alert_empty AS (
  SELECT md5(concat_ws('|', 'API_REPONSE_VIDE', 'availability.raw', '4', cast(event_id AS varchar))) AS alert_id,
    'API_REPONSE_VIDE' AS alert_type, 'WARNING' AS severity, 'disponibilite returned 0 records' AS description,
    NULL::double AS metric_value, NULL::varchar AS batch_id, ts AS detected_at
  FROM bad_msg WHERE NOT is_corrupt),
alert_bad AS (
  SELECT md5(concat_ws('|', 'SCHEMA_INVALIDE', 'availability.raw', '4', cast(event_id AS varchar))) AS alert_id,
    'SCHEMA_INVALIDE' AS alert_type, 'CRITICAL' AS severity,
    'unparseable message availability.raw/4/' || cast(event_id AS varchar) AS description,
    NULL::double AS metric_value, NULL::varchar AS batch_id, ts AS detected_at
  FROM bad_msg WHERE is_corrupt),
alert_gap AS (
  SELECT md5(concat_ws('|', 'API_INDISPONIBLE', source, cast(epoch_us(fetched_at) AS varchar))) AS alert_id,
    'API_INDISPONIBLE' AS alert_type, 'CRITICAL' AS severity,
    source || ' feed silent for ' || __TENTHS_GAP__ || ' minutes' AS description,
    gap_min AS metric_value, NULL::varchar AS batch_id, fetched_at AS detected_at
  FROM gaps WHERE gap_min > 10),
alerts_v AS (
  SELECT * FROM alert_reject UNION ALL SELECT * FROM alert_fresh UNION ALL SELECT * FROM alert_empty
  UNION ALL SELECT * FROM alert_gap UNION ALL SELECT * FROM alert_bad),
ml_v AS (
  SELECT r.station_id, r.num_bikes_available, r.num_docks_available, r.observed_at, s.capacity, s.commune,
    s.name, s.latitude, s.longitude
  FROM readings_v r JOIN stations_v s USING (station_id) WHERE s.capacity > 0 AND s.commune IS NOT NULL),
latest_ml AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY observed_at DESC) AS rn FROM ml_v)
  WHERE rn = 1),
positions_v AS (
  SELECT s_suppkey AS position_id, 48.82::double + cast(s_suppkey % 60 AS double) * 0.001::double AS latitude,
    2.28::double + cast(s_suppkey % 120 AS double) * 0.001::double AS longitude FROM supplier)
"""
VIEWS = (VIEWS.replace("__TENTHS_ST__", _tenths("reject_ratio * 100"))
              .replace("__TENTHS_AV__", _tenths("reject_ratio * 100"))
              .replace("__TENTHS_FR__", _tenths("freshness_min"))
              .replace("__TENTHS_GAP__", _tenths("gap_min")))

STATION_VIOLATION = """CASE
  WHEN station_id IS NULL THEN 'station_id_null' WHEN length(station_id) > 64 THEN 'station_id_too_long'
  WHEN name IS NULL THEN 'name_null' WHEN length(name) > 255 THEN 'name_too_long'
  WHEN latitude IS NULL THEN 'latitude_null' WHEN longitude IS NULL THEN 'longitude_null'
  WHEN capacity IS NULL THEN 'capacity_null'
  WHEN capacity < 0 OR capacity > 2147483647 THEN 'capacity_out_of_range'
  WHEN length(commune) > 128 THEN 'commune_too_long' END"""

READING_VIOLATION = """CASE
  WHEN station_id IS NULL THEN 'station_id_null' WHEN length(station_id) > 64 THEN 'station_id_too_long'
  WHEN num_bikes_available IS NULL THEN 'bikes_null'
  WHEN num_bikes_available < 0 OR num_bikes_available > 2147483647 THEN 'bikes_out_of_range'
  WHEN num_ebikes_available IS NULL THEN 'ebikes_null'
  WHEN num_ebikes_available < 0 OR num_ebikes_available > 2147483647 THEN 'ebikes_out_of_range'
  WHEN num_docks_available IS NULL THEN 'docks_null'
  WHEN num_docks_available < 0 OR num_docks_available > 2147483647 THEN 'docks_out_of_range'
  WHEN is_renting IS NULL THEN 'is_renting_null' WHEN is_returning IS NULL THEN 'is_returning_null'
  WHEN observed_at IS NULL THEN 'observed_at_null' WHEN batch_id IS NULL THEN 'batch_id_null'
  WHEN length(batch_id) > 64 THEN 'batch_id_too_long' END"""

STATION_REASON = """CASE
  WHEN station_id IS NULL THEN 'missing_station_id' WHEN capacity IS NULL THEN 'missing_capacity'
  WHEN capacity < 0 THEN 'negative_capacity' WHEN latitude IS NULL THEN 'missing_latitude'
  WHEN NOT (latitude BETWEEN 48.0 AND 49.5) THEN 'latitude_out_of_box'
  WHEN longitude IS NULL THEN 'missing_longitude'
  WHEN NOT (longitude BETWEEN 1.5 AND 3.0) THEN 'longitude_out_of_box' END"""


def _reading_reason(strict: bool) -> str:
    s = """CASE
  WHEN station_id IS NULL THEN 'missing_station_id' WHEN num_bikes_available IS NULL THEN 'missing_bikes'
  WHEN num_bikes_available < 0 THEN 'negative_bikes' WHEN num_docks_available IS NULL THEN 'missing_docks'
  WHEN num_docks_available < 0 THEN 'negative_docks' WHEN observed_at IS NULL THEN 'missing_observed_at'"""
    if strict:
        s += "\n  WHEN capacity IS NULL THEN 'unknown_capacity'"
    s += """
  WHEN capacity IS NOT NULL AND num_bikes_available + num_docks_available > capacity + 2 THEN 'over_capacity' END"""
    return s


FACT = ("station_id, num_bikes_available, num_ebikes_available, num_docks_available, is_renting, is_returning, "
        "observed_at, batch_id")
ALERT = "alert_id, alert_type, severity, description, metric_value, batch_id, detected_at"
USER = ("48.8530::double", "2.3499::double")

Q: dict[str, str] = {
    "top_stations_panel": """
SELECT s.name AS station_name, s.commune, round(avg(r.ratio) * 100, 9) AS occupancy_pct
FROM ratio_v r JOIN stations_v s USING (station_id)
GROUP BY s.name, s.commune
ORDER BY occupancy_pct DESC NULLS FIRST, station_name ASC NULLS FIRST, commune ASC NULLS FIRST LIMIT 10""",
    "network_overview": """
SELECT count(*) AS n_stations, cast(sum(capacity) AS bigint) AS total_capacity,
  count(DISTINCT commune) AS n_communes,
  (SELECT count(DISTINCT station_id) FROM readings_v) AS n_stations_observed
FROM stations_v""",
    "observation_span": """
SELECT count(*) AS n_readings, min(observed_at) AS first_observed_at, max(observed_at) AS last_observed_at
FROM readings_v""",
    "network_occupancy": "SELECT round(avg(ratio) * 100, 9) AS occupancy_pct FROM ratio_v",
    "capacity_incoherent": """
SELECT n_incoherent, n_readings, round(n_incoherent::double / nullif(n_readings, 0), 9) AS share_incoherent FROM (
  SELECT count(*) FILTER (WHERE r.num_bikes_available + r.num_docks_available > s.capacity + 5) AS n_incoherent,
    count(*) AS n_readings
  FROM readings_v r LEFT JOIN stations_v s USING (station_id))""",
    "stations_by_commune": """
SELECT commune, count(*) AS n_stations FROM stations_v WHERE commune IS NOT NULL
GROUP BY commune ORDER BY n_stations DESC, commune ASC LIMIT 10""",
    "station_occupancy": """
SELECT r.station_id, s.name, round(avg(r.ratio), 9) AS mean_occupancy
FROM ratio_v r LEFT JOIN stations_v s USING (station_id) WHERE s.name IS NOT NULL
GROUP BY r.station_id, s.name""",
    "top10_loaded": """
SELECT * FROM (
  SELECT r.station_id, s.name, round(avg(r.ratio), 9) AS mean_occupancy
  FROM ratio_v r LEFT JOIN stations_v s USING (station_id) WHERE s.name IS NOT NULL
  GROUP BY r.station_id, s.name)
ORDER BY mean_occupancy DESC NULLS LAST, station_id ASC LIMIT 10""",
    "bottom10_loaded": """
SELECT * FROM (
  SELECT r.station_id, s.name, round(avg(r.ratio), 9) AS mean_occupancy
  FROM ratio_v r LEFT JOIN stations_v s USING (station_id) WHERE s.name IS NOT NULL
  GROUP BY r.station_id, s.name)
ORDER BY mean_occupancy ASC NULLS FIRST, station_id DESC LIMIT 10""",
    "hourly_availability": """
SELECT date_trunc('hour', observed_at) AS hour, round(avg(num_bikes_available), 9) AS avg_bikes
FROM readings_v GROUP BY 1 ORDER BY 1""",
    "hourly_resample": """
WITH sp AS (SELECT date_trunc('hour', observed_at) AS h, sum(num_bikes_available) AS s,
                   count(num_bikes_available) AS c FROM readings_v GROUP BY 1),
     b AS (SELECT min(h) AS lo, max(h) AS hi FROM sp),
     g AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS hour FROM b)
SELECT g.hour, round(CASE WHEN sp.c > 0 THEN sp.s::double / sp.c END, 9) AS avg_bikes
FROM g LEFT JOIN sp ON sp.h = g.hour""",
    "latest_reading": """
SELECT station_id, observed_at, num_bikes_available, num_ebikes_available, num_docks_available,
  is_renting, is_returning FROM (
  SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY observed_at DESC) AS rn FROM readings_v)
WHERE rn = 1""",
    "bikes_histogram": """
WITH st AS (SELECT min(num_bikes_available)::double AS mn, max(num_bikes_available)::double AS mx FROM readings_v),
     b AS (SELECT CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS lo,
                  CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS hi FROM st),
     c AS (SELECT cast(least(floor((r.num_bikes_available::double - b.lo) * 30.0 / (b.hi - b.lo)), 29) AS integer)
                  AS bin, count(*) AS n
           FROM readings_v r CROSS JOIN b WHERE r.num_bikes_available IS NOT NULL GROUP BY 1),
     g AS (SELECT cast(range AS integer) AS bin FROM range(30))
SELECT g.bin, round(b.lo + g.bin * ((b.hi - b.lo) / 30.0), 9) AS bin_start,
  round(b.lo + (g.bin + 1) * ((b.hi - b.lo) / 30.0), 9) AS bin_end, coalesce(c.n, 0) AS n
FROM g CROSS JOIN b LEFT JOIN c ON c.bin = g.bin""",
    "occupancy_per_reading": "SELECT station_id, observed_at, ratio AS occupancy FROM ratio_v",
    "calendar_features": """
SELECT station_id, observed_at, cast(hour(observed_at) AS integer) AS hour,
  cast(isodow(observed_at) - 1 AS integer) AS weekday FROM readings_v""",
    "readings_enriched": """
SELECT r.*, s.name, s.commune, s.capacity FROM readings_v r LEFT JOIN stations_v s USING (station_id)""",
    "orphan_readings": """
SELECT station_id, observed_at FROM readings_v r
WHERE NOT EXISTS (SELECT 1 FROM known_v k WHERE k.station_id = r.station_id)""",
    "message_rate": """
WITH w AS (SELECT event_type AS topic, date_trunc('minute', ts) - to_minutes(k) AS window_start
           FROM events CROSS JOIN range(0, 5) t(k))
SELECT topic, window_start, window_start + INTERVAL 5 MINUTE AS window_end, count(*) AS n_messages,
  count(*) / 300.0 AS rate_per_s
FROM w GROUP BY topic, window_start""",
    "valid_stations": f"""
SELECT station_id, name, capacity, latitude, longitude FROM stations_v WHERE ({STATION_REASON}) IS NULL""",
    "valid_readings": f"""
SELECT station_id, observed_at, num_bikes_available, num_docks_available, capacity FROM (
  SELECT r.*, s.capacity FROM readings_v r LEFT JOIN stations_v s USING (station_id))
WHERE ({_reading_reason(False)}) IS NULL""",
    "valid_readings_strict": f"""
SELECT station_id, observed_at, num_bikes_available, num_docks_available, capacity FROM (
  SELECT r.*, s.capacity FROM readings_v r LEFT JOIN stations_v s USING (station_id))
WHERE ({_reading_reason(True)}) IS NULL""",
    "reject_reasons": f"""
SELECT feed, reason, count(*) AS n FROM (
  SELECT 'stations' AS feed, {STATION_REASON} AS reason FROM stations_v
  UNION ALL
  SELECT 'disponibilite', {_reading_reason(False)} FROM (
    SELECT r.*, s.capacity FROM readings_v r LEFT JOIN stations_v s USING (station_id)))
WHERE reason IS NOT NULL GROUP BY feed, reason""",
    "constraint_violations": f"""
SELECT * FROM (
  SELECT 'disponibilite_releve' AS table_name, station_id, observed_at, {READING_VIOLATION} AS violation
  FROM av_parsed WHERE is_valid
  UNION ALL
  SELECT 'stations', station_id, NULL::timestamp, {STATION_VIOLATION} FROM (
    SELECT DISTINCT station_id, name, latitude, longitude, capacity, commune FROM av_parsed WHERE is_valid))
WHERE violation IS NOT NULL""",
    "parse_props": """
SELECT 'availability.raw' AS topic, "partition", "offset", 'disponibilite' AS source, batch_id, fetched_at,
  n_results AS total_count, cast(n_results AS integer) AS n_results, false AS is_corrupt FROM av_env
UNION ALL
SELECT 'availability.raw', 4, event_id, CASE WHEN is_corrupt THEN NULL ELSE 'disponibilite' END,
  CASE WHEN is_corrupt THEN NULL ELSE 'e-' || cast(event_id AS varchar) END,
  CASE WHEN is_corrupt THEN NULL ELSE ts END, CASE WHEN is_corrupt THEN NULL ELSE 0 END, 0, is_corrupt
FROM bad_msg""",
    "explode_results": "SELECT batch_id, cast(pos AS integer) AS pos, station_id FROM av_parsed",
    "station_project": "SELECT batch_id, station_id, name, capacity, latitude, longitude FROM st_parsed",
    "reading_project": """
SELECT batch_id, station_id, num_bikes_available, num_ebikes_available, num_docks_available, is_renting,
  is_returning, observed_at, capacity, name, latitude, longitude, commune FROM av_parsed""",
    "reading_fact_rows": f"SELECT {FACT} FROM av_parsed WHERE is_valid",
    "timestamp_parse": """
SELECT station_id, strftime(observed_at, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS duedate, observed_at
FROM av_parsed""",
    "envelope_build": """
SELECT 'disponibilite' AS source, batch_id, fetched_at, n_results AS total_count,
  cast(n_results AS integer) AS n_results FROM av_env""",
    "bronze_archive": """
SELECT 'disponibilite' AS source, strftime(fetched_at, '%Y-%m-%d') AS dt, batch_id, 'availability.raw' AS topic,
  "partition", "offset", false AS is_corrupt, cast(n_results AS integer) AS n_results FROM av_env
UNION ALL
SELECT CASE WHEN is_corrupt THEN 'availability.raw' ELSE 'disponibilite' END, strftime(ts, '%Y-%m-%d'),
  CASE WHEN is_corrupt THEN 'availability.raw-4-' || cast(event_id AS varchar) ELSE 'e-' || cast(event_id AS varchar) END,
  'availability.raw', 4, event_id, is_corrupt, 0 FROM bad_msg""",
    "bronze_replay": f"SELECT {FACT} FROM av_parsed WHERE is_valid",
    "station_upsert": """
WITH new AS (
  SELECT station_id, arg_max(name, fetched_at) AS name, arg_max(latitude, fetched_at) AS latitude,
    arg_max(longitude, fetched_at) AS longitude, arg_max(capacity, fetched_at) AS capacity, max(fetched_at) AS updated_at
  FROM st_parsed WHERE is_valid GROUP BY station_id),
stored AS (
  SELECT station_id, name, latitude, longitude, coalesce(capacity, 1) AS capacity, commune, skey % 5 <> 0 AS is_installed
  FROM stations_b WHERE skey % 4 <> 0)
SELECT n.station_id, n.name, n.latitude, n.longitude, n.capacity, s.commune, coalesce(s.is_installed, true) AS is_installed, n.updated_at
FROM new n LEFT JOIN stored s USING (station_id)
UNION ALL
SELECT station_id, name, latitude, longitude, capacity, commune, is_installed, TIMESTAMP '2000-01-01 00:00:00'
FROM stored WHERE station_id NOT IN (SELECT station_id FROM new)""",
    "reading_dedup": f"SELECT {FACT} FROM av_parsed WHERE is_valid",
    "station_stub": f"""
SELECT station_id, name, latitude, longitude, capacity, 'snapshot' AS origin FROM known_v
UNION ALL
SELECT station_id, name, latitude, longitude, capacity, 'stub' FROM (
  SELECT station_id, arg_min(name, fetched_at) AS name, arg_min(latitude, fetched_at) AS latitude,
    arg_min(longitude, fetched_at) AS longitude, arg_min(capacity, fetched_at) AS capacity, NULL AS commune
  FROM av_parsed p WHERE is_valid AND NOT EXISTS (SELECT 1 FROM known_v k WHERE k.station_id = p.station_id)
  GROUP BY station_id)
WHERE ({STATION_VIOLATION}) IS NULL""",
    "commune_backfill": """
SELECT k.station_id, coalesce(u.commune, 'UNKNOWN') AS commune FROM known_v k LEFT JOIN (
  SELECT station_id, arg_max(commune, fetched_at) AS commune FROM av_parsed
  WHERE is_valid AND commune IS NOT NULL AND commune <> '' GROUP BY station_id) u USING (station_id)""",
    "reject_ratio": "SELECT micro_batch, batch_id, n_total, n_valid, reject_ratio FROM av_ratio",
    "freshness": "SELECT micro_batch, batch_id, max_observed_at, as_of, freshness_min FROM av_fresh",
    "alert_reject_rate": f"SELECT {ALERT} FROM alert_reject",
    "alert_freshness": f"SELECT {ALERT} FROM alert_fresh",
    "empty_fetches": f"SELECT {ALERT} FROM alert_empty",
    "malformed_messages": f"SELECT {ALERT} FROM alert_bad",
    "alert_feed_gap": f"SELECT {ALERT} FROM alert_gap",
    "alerts_all": f"SELECT {ALERT} FROM alerts_v",
    "alert_counts": """
SELECT alert_type, severity, count(*) AS n FROM alerts_v GROUP BY alert_type, severity
ORDER BY n DESC, alert_type, severity""",
    "latest_alerts": """
SELECT detected_at, alert_type, severity, description, alert_id FROM alerts_v
ORDER BY detected_at DESC NULLS LAST, alert_id ASC LIMIT 20""",
    "pipeline_kpis": """
WITH m AS (SELECT (SELECT count(*) FROM av_env) + (SELECT count(*) FROM bad_msg) AS n_messages,
                  (SELECT count(*) FROM bad_msg WHERE is_corrupt) AS n_malformed),
     r AS (SELECT count(*) AS n_records, count(*) FILTER (WHERE NOT is_valid) AS n_rejected,
             round(avg(CASE WHEN is_valid THEN (epoch_us(fetched_at) - epoch_us(observed_at)) / 60000000.0 END), 6)
               AS avg_feed_latency_min,
             count(DISTINCT micro_batch) AS n_batches, min(micro_batch) AS b0, max(micro_batch) AS b1
           FROM av_parsed)
SELECT m.n_messages, m.n_malformed, r.n_records, r.n_rejected,
  round(r.n_rejected::double / nullif(r.n_records, 0), 9) AS reject_share,
  (SELECT count(*) FROM alerts_v) AS n_alerts, r.avg_feed_latency_min,
  round(r.n_batches::double
        / (cast(floor((epoch_us(r.b1) - epoch_us(r.b0)) / 60000000.0 / 60) AS bigint) + 1), 9) AS feed_availability
FROM m CROSS JOIN r""",
    "haversine_distance": f"""
SELECT station_id, round({_hav(USER[0], USER[1], 'latitude', 'longitude')}, 6) AS distance_km
FROM stations_v WHERE latitude IS NOT NULL AND longitude IS NOT NULL""",
    "recommend_bike": f"""
SELECT station_id, name, round(dd, 6) AS distance_km, num_bikes_available, num_docks_available FROM (
  SELECT *, {_hav(USER[0], USER[1], 'latitude', 'longitude')} AS dd FROM latest_ml WHERE num_bikes_available > 0)
ORDER BY dd, name, station_id LIMIT 3""",
    "recommend_dock": f"""
SELECT station_id, name, round(dd, 6) AS distance_km, num_bikes_available, num_docks_available FROM (
  SELECT *, {_hav(USER[0], USER[1], 'latitude', 'longitude')} AS dd FROM latest_ml WHERE num_docks_available > 0)
ORDER BY dd, name, station_id LIMIT 3""",
    "recommend_many_users": f"""
SELECT position_id, cast(rank AS integer) AS rank, station_id, name, round(dd, 6) AS distance_km FROM (
  SELECT *, row_number() OVER (PARTITION BY position_id ORDER BY dd, name, station_id) AS rank FROM (
    SELECT p.position_id, l.station_id, l.name,
      {_hav('p.latitude', 'p.longitude', 'l.latitude', 'l.longitude')} AS dd
    FROM positions_v p CROSS JOIN (SELECT * FROM latest_ml WHERE num_bikes_available > 0) l))
WHERE rank <= 3""",
    "ml_training_set": """
SELECT station_id, observed_at, commune, capacity, cast(hour(observed_at) AS integer) AS hour,
  cast(isodow(observed_at) - 1 AS integer) AS weekday, num_bikes_available FROM ml_v""",
    "ml_split_counts": """
SELECT CASE WHEN cast('0x' || substr(md5(station_id || '|' || cast(epoch_us(observed_at) AS varchar)), 1, 6)
                      AS bigint) % 100 < 80 THEN 'train' ELSE 'test' END AS split, count(*) AS n_rows
FROM ml_v GROUP BY 1""",
}


def oracle_sql() -> dict[str, str]:
    out = {}
    for k, v in Q.items():
        body = v.strip()
        if body.upper().startswith("WITH "):
            out[k] = f"WITH {VIEWS.strip()},\n{body[5:]}"
        else:
            out[k] = f"WITH {VIEWS.strip()}\n{body}"
    return out
