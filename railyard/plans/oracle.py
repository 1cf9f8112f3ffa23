"""DuckDB oracle SQL, one statement per registered query.

Written from SURVEY/FIXTURES semantics in plain window/join SQL (ROW_NUMBER,
LAG, LEAD, last_value IGNORE NULLS, NOT EXISTS), independently of the Spark
plans, which use bucketed windows, ``max_by`` and date-keyed joins.
"""

from __future__ import annotations

from .oracle_base import EVENT_BASE, ts

ARR = "current_status IN ('STOPPED_AT', 'INCOMING_AT')"
D = "CAST(100 AS DOUBLE)"


def W(*ctes: str) -> str:
    return "WITH " + ",\n".join([EVENT_BASE.strip()] + [c.strip() for c in ctes]) + "\n"


# ---------------------------------------------------------------- shared CTEs
MSG = """
msg_ev0 AS (
  SELECT *,
    CASE WHEN route IN ('A', 'C', 'E') THEN 'ace' ELSE 'bdfm' END AS feed,
    event_id % 31 AS d, msg_id % 97 AS m,
    CASE WHEN event_id % 31 IN (0, 1, 5) THEN 'unknown'
         WHEN st = 'IN_TRANSIT_TO' THEN 'trip_update' ELSE 'vehicle' END AS kind
  FROM ev_rows),
msg_ev AS (
  SELECT * EXCLUDE (feed_timestamp),
    m > 5 AS msg_ok, m > 5 AND m <> 7 AS list_ok,
    CASE WHEN m <> 8 THEN feed_timestamp END AS feed_timestamp,
    CASE WHEN d NOT IN (0, 7) THEN entity_id END AS e_id,
    CASE WHEN d = 4 AND kind = 'vehicle' THEN NULL
         WHEN user_id % 23 = 0 THEN 'G' ELSE route END AS msg_route,
    CASE WHEN d = 2 OR d = 4 AND kind = 'vehicle' THEN NULL
         WHEN user_id % 37 = 0 THEN '060300_' || route || dir || '55R'
         WHEN user_id % 19 = 0 THEN '060300_' || route || '..X55R'
         ELSE trip_id END AS trip_text,
    CASE WHEN user_id % 37 = 0 OR user_id % 19 = 0 THEN 'U' ELSE dir END AS p_dir,
    CASE WHEN user_id % 37 = 0 THEN NULL ELSE '55R' END AS p_path,
    CASE WHEN d NOT IN (3, 6) THEN 1 END AS sane
  FROM msg_ev0),
stops AS (
  SELECT * EXCLUDE (stop_id, current_stop_sequence), 0 AS stop_pos, stop_id, current_stop_sequence,
    CASE WHEN k % 13 = 0 THEN NULL WHEN k % 3 = 0 THEN 0 ELSE veh_epoch END AS arr,
    CASE WHEN k % 13 <> 0 THEN veh_epoch + 30 END AS dep
  FROM msg_ev WHERE kind = 'trip_update' AND list_ok AND d <> 4
  UNION ALL BY NAME
  SELECT * EXCLUDE (stop_id, current_stop_sequence), 1 AS stop_pos,
    route || CAST((k + 1) % 4 AS VARCHAR) || dir AS stop_id,
    current_stop_sequence + 1 AS current_stop_sequence, veh_epoch + 120 AS arr, NULL AS dep
  FROM msg_ev WHERE kind = 'trip_update' AND list_ok AND d <> 4 AND k % 4 = 1)"""

P3 = """
p3 AS (
  SELECT e_id AS entity_id, trip_text AS trip_id, msg_route AS route_id,
    CAST(NULL AS VARCHAR) AS start_time, CAST(NULL AS VARCHAR) AS start_date,
    p_dir AS direction, p_path AS path_id, CAST(NULL AS VARCHAR) AS train_id,
    CAST(NULL AS VARCHAR) AS nyct_direction, CAST(NULL AS VARCHAR) AS scheduled_track,
    CAST(NULL AS VARCHAR) AS actual_track, stop_id, current_stop_sequence, current_status,
    CASE WHEN sane = 1 THEN vehicle_timestamp END AS vehicle_timestamp, feed_timestamp, ingest_time
  FROM msg_ev WHERE list_ok AND kind = 'vehicle' AND trip_text IS NOT NULL AND k % 11 <> 0)"""

P4 = f"""
p4 AS (
  SELECT coalesce(e_id, 'None') || '__' || stop_id AS entity_id, trip_text AS trip_id, msg_route AS route_id,
    start_time, start_date, p_dir AS direction, p_path AS path_id, train_id, nyct_direction,
    scheduled_track, actual_track, stop_id, current_stop_sequence,
    'IN_TRANSIT_TO' AS current_status,
    CASE WHEN sane = 1 THEN {ts('CASE WHEN arr = 0 THEN dep ELSE arr END')} END AS vehicle_timestamp,
    feed_timestamp, ingest_time
  FROM stops WHERE trip_text IS NOT NULL AND arr IS NOT NULL)"""

TRACKS = """
trk AS (
  SELECT feed || ':' || CAST(msg_id AS VARCHAR) AS snapshot, trip_text AS trip_id,
    msg_route AS route_id, train_id, nyct_direction AS direction, stop_id,
    scheduled_track, actual_track
  FROM stops)"""

# V1 over extracted rows: the first check that fails
V1_REASON = """CASE WHEN entity_id IS NULL THEN 'missing:entity_id'
  WHEN vehicle_timestamp IS NULL THEN 'missing:vehicle_timestamp'
  WHEN feed_timestamp IS NULL THEN 'missing:feed_timestamp'
  WHEN route_id NOT IN ('A', 'B', 'C', 'D', 'E', 'F', 'H', 'M', 'S') THEN 'invalid_route' END"""

ALERTS = f"""
al_ev AS (
  SELECT *, event_id // 120 AS amsg, 'a' || CAST(user_id AS VARCHAR) AS alert_id,
    route || CAST(k % 4 AS VARCHAR) || dir AS a_stop,
    substr('ACEBDFMS7G', CAST(k % 10 AS INTEGER) + 1, 1) AS extra,
    event_id % 17 AS d, (event_id // 120) % 13 NOT IN (1, 2) AS msg_ok
  FROM ev_b WHERE event_type = 'signup'),
al_rows AS (
  SELECT amsg AS msg_id, alert_id,
    CASE k % 3 WHEN 0 THEN 'Delays' WHEN 1 THEN 'Planned - Part Suspended'
         ELSE 'Station Notice' END AS alert_type,
    CASE WHEN user_id % 5 = 0 THEN ''
         WHEN k % 6 = 0 THEN route
         WHEN extra IN ('A', 'B', 'C', 'D', 'E', 'F', 'M', 'S') AND extra <> route
           THEN least(route, extra) || ',' || greatest(route, extra)
         ELSE route END AS affected_routes,
    CASE WHEN user_id % 5 = 0 THEN '701N' ELSE a_stop END AS affected_stops,
    CASE WHEN k % 10 = 0 THEN NULL ELSE {ts('feed_epoch')} END AS active_period_start,
    CASE WHEN k % 10 = 0 OR k % 9 = 0 THEN NULL
         ELSE {ts('feed_epoch + 3600 * (1 + k % 4)')} END AS active_period_end,
    CASE WHEN k % 7 = 0 THEN NULL
         WHEN k % 2 = 0 THEN 'Alert ' || CAST(event_id AS VARCHAR)
         ELSE 'Avis ' || CAST(event_id AS VARCHAR) END AS header_text,
    CASE WHEN k % 3 = 0 THEN NULL ELSE 'Delays on ' || route END AS description_text,
    CASE WHEN d <> 2 THEN {ts('feed_epoch - 600')} END AS created_at,
    {ts('feed_epoch - 60')} AS updated_at,
    CASE WHEN amsg % 11 = 0 THEN NULL ELSE {ts('1704067200 + amsg * 3600')} END AS feed_timestamp,
    {ts('1704067200 + amsg * 3600 + 2')} AS ingest_time,
    user_id % 5 = 0 OR d = 3 AS no_target
  FROM al_ev WHERE msg_ok AND d NOT IN (0, 1)),
al_flat AS (
  SELECT alert_id, alert_type, affected_routes, affected_stops, active_period_start,
    active_period_end, header_text, description_text, created_at, updated_at,
    feed_timestamp, ingest_time
  FROM al_rows WHERE NOT no_target),
al_valid AS (SELECT * FROM al_flat WHERE feed_timestamp IS NOT NULL),
al_latest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY alert_id ORDER BY feed_timestamp DESC,
      coalesce(updated_at, TIMESTAMP '1970-01-01') DESC,
      coalesce(ingest_time, TIMESTAMP '1970-01-01') DESC,
      coalesce(header_text, '') DESC, coalesce(description_text, '') DESC,
      coalesce(alert_type, '') DESC, coalesce(affected_stops, '') DESC) AS rn
    FROM al_valid) WHERE rn = 1)"""

HW = f"""
hw_o AS (
  SELECT route_id, direction, stop_id, trip_id, vehicle_timestamp AS arrival_time,
    LAG(vehicle_timestamp) OVER (PARTITION BY route_id, direction, stop_id
      ORDER BY vehicle_timestamp, trip_id, entity_id) AS prev_t
  FROM raw_positions
  WHERE {ARR} AND vehicle_timestamp IS NOT NULL AND route_id IN ('A', 'C', 'E')),
hw AS (
  SELECT route_id, direction, stop_id, trip_id, arrival_time,
    CAST(epoch(arrival_time) - epoch(prev_t) AS BIGINT) AS headway_seconds,
    CAST(arrival_time AS DATE) AS date, CAST(hour(arrival_time) AS INTEGER) AS hour,
    CAST(dayofweek(arrival_time) + 1 AS INTEGER) AS day_of_week
  FROM hw_o WHERE prev_t IS NOT NULL
    AND epoch(arrival_time) - epoch(prev_t) > 0 AND epoch(arrival_time) - epoch(prev_t) < 3600)"""

def h5_sql(keys: str = "stop_id") -> str:
    return f"""
h5 AS (
  SELECT TIMESTAMP '1970-01-01' + to_microseconds((epoch_us(arrival_time) // 300000000) * 300000000)
      AS bin_start, {keys}, avg(headway_seconds) AS mean_headway
  FROM hw GROUP BY ALL)"""


def grid_sql(keys: str = "stop_id") -> str:
    return f"""
imp AS (
  SELECT b.bin_start, s.*, h.mean_headway,
    coalesce(h.mean_headway, avg(h.mean_headway) OVER (PARTITION BY {keys})) AS value,
    h.mean_headway IS NULL AS is_imputed
  FROM (SELECT DISTINCT bin_start FROM h5) b
  CROSS JOIN (SELECT DISTINCT {keys} FROM hw) s
  LEFT JOIN h5 h USING (bin_start, {keys})),
norm AS (
  SELECT bin_start, {keys}, value,
    (value - avg(value) OVER (PARTITION BY {keys}))
      / (stddev_samp(value) OVER (PARTITION BY {keys}) + 1e-8) AS z
  FROM imp),
nb AS (
  SELECT bin_start, CAST(row_number() OVER (ORDER BY bin_start) - 1 AS INTEGER) AS bin_idx
  FROM (SELECT DISTINCT bin_start FROM norm)),
g AS (SELECT n.*, nb.bin_idx FROM norm n JOIN nb USING (bin_start)),
win AS (
  SELECT s.bin_idx AS window_idx, s.bin_start AS window_start, {', '.join('s.' + k for k in keys.split(', '))},
    CAST(x.bin_idx - s.bin_idx AS INTEGER) AS "offset", x.z AS value
  FROM g s JOIN g x ON {' AND '.join(f'x.{k} = s.{k}' for k in keys.split(', '))}
    AND x.bin_idx BETWEEN s.bin_idx AND s.bin_idx + 23
  WHERE s.bin_idx + 23 <= (SELECT max(bin_idx) FROM nb)),
splits AS (
  SELECT window_idx, window_start,
    CASE WHEN window_idx < floor(n * CAST(0.7 AS DOUBLE)) THEN 'train'
         WHEN window_idx < floor(n * (CAST(0.7 AS DOUBLE) + CAST(0.15 AS DOUBLE))) THEN 'val'
         ELSE 'test' END AS split
  FROM (SELECT DISTINCT window_idx, window_start FROM win),
       (SELECT count(DISTINCT window_idx) AS n FROM win))"""


H5, GRID = h5_sql(), grid_sql()
BY_ROUTE = "route_id, direction, stop_id"

ADJ = """
tr AS (
  SELECT stop_id AS from_stop,
    LEAD(stop_id) OVER (PARTITION BY route_id, direction, trip_id
      ORDER BY arrival_time, stop_id) AS to_stop
  FROM hw),
cnt AS (SELECT from_stop, to_stop, count(*) AS n_transitions FROM tr
        WHERE to_stop IS NOT NULL GROUP BY 1, 2),
adj AS (
  SELECT * FROM (SELECT from_stop, to_stop,
    n_transitions / sum(n_transitions) OVER (PARTITION BY from_stop) AS weight FROM cnt)
  WHERE weight > 0.1),
loops AS (SELECT DISTINCT stop_id AS from_stop, stop_id AS to_stop, CAST(1 AS DOUBLE) AS weight FROM hw),
fw AS (SELECT from_stop, to_stop, sum(weight) AS weight FROM
       (SELECT from_stop, to_stop, weight FROM adj UNION ALL SELECT * FROM loops) GROUP BY 1, 2),
bw AS (SELECT from_stop, to_stop, sum(weight) AS weight FROM
       (SELECT to_stop AS from_stop, from_stop AS to_stop, weight FROM adj
        UNION ALL SELECT * FROM loops) GROUP BY 1, 2),
dt AS (
  SELECT 'forward' AS direction, from_stop, to_stop,
    weight / (sum(weight) OVER (PARTITION BY from_stop) + 1e-8) AS weight FROM fw
  UNION ALL
  SELECT 'backward', from_stop, to_stop,
    weight / (sum(weight) OVER (PARTITION BY from_stop) + 1e-8) FROM bw)"""

J2 = f"""
rel AS (
  SELECT *, (current_status = 'IN_TRANSIT_TO'
             AND (coalesce(scheduled_track, '') <> '' OR coalesce(actual_track, '') <> '')) AS src
  FROM raw_positions
  WHERE coalesce(trip_id, '') <> '' AND coalesce(stop_id, '') <> ''),
rel2 AS (SELECT * FROM rel WHERE coalesce(src, false) OR {ARR}),
stt AS (
  SELECT *, last_value(CASE WHEN src THEN struct_pack(s := scheduled_track, a := actual_track,
      t := train_id, d := nyct_direction, c := vehicle_timestamp) END IGNORE NULLS)
    OVER (PARTITION BY trip_id, stop_id ORDER BY feed_timestamp, entity_id
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS state
  FROM rel2),
enr0 AS (
  SELECT *, state IS NOT NULL
    AND epoch_us(vehicle_timestamp) - epoch_us(state.c) <= 900000000 AS fresh
  FROM stt WHERE {ARR}),
enr AS (
  SELECT entity_id, trip_id, route_id, start_time, start_date, direction, path_id,
    CASE WHEN fresh AND coalesce(train_id, '') = '' THEN state.t ELSE train_id END AS train_id,
    CASE WHEN fresh AND coalesce(nyct_direction, '') = '' THEN state.d ELSE nyct_direction END
      AS nyct_direction,
    CASE WHEN fresh THEN state.s ELSE scheduled_track END AS scheduled_track,
    CASE WHEN fresh THEN state.a ELSE actual_track END AS actual_track,
    stop_id, current_stop_sequence, current_status, vehicle_timestamp, feed_timestamp,
    ingest_time,
    CASE WHEN state IS NULL THEN 'no_track' WHEN fresh THEN 'enriched' ELSE 'stale' END
      AS enrichment
  FROM enr0)"""

W1 = """
tp AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY trip_id, stop_id, CAST(vehicle_timestamp AS DATE)
      ORDER BY feed_timestamp DESC, entity_id DESC) AS rn
  FROM raw_positions WHERE current_status = 'IN_TRANSIT_TO' AND actual_track IS NOT NULL),
w1 AS (
  SELECT trip_id, stop_id, CAST(vehicle_timestamp AS DATE) AS prediction_date, entity_id,
    train_id, nyct_direction, scheduled_track, actual_track,
    vehicle_timestamp AS predicted_arrival, feed_timestamp
  FROM tp WHERE rn = 1)"""

VCOLS = ("entity_id, trip_id, route_id, start_time, start_date, direction, path_id, train_id, "
         "nyct_direction, scheduled_track, actual_track, stop_id, current_stop_sequence, "
         "current_status, vehicle_timestamp, feed_timestamp, ingest_time")


def _pct(part: str, total: str) -> str:
    return f"round({D} * {part} / CASE WHEN {total} > 0 THEN {total} END, 1)"


ORACLE: dict[str, str] = {}

ORACLE["headway"] = W(HW) + "SELECT * FROM hw"

ORACLE["latest_prediction"] = W(W1) + "SELECT * FROM w1"

ORACLE["arrivals_with_tracks"] = W(W1) + f"""
SELECT v.entity_id, v.trip_id, v.route_id, v.start_time, v.start_date, v.direction, v.path_id,
  t.train_id, t.nyct_direction, t.scheduled_track, t.actual_track, v.stop_id,
  v.current_stop_sequence, v.current_status, v.vehicle_timestamp AS actual_arrival,
  t.predicted_arrival,
  CAST(trunc(epoch(v.vehicle_timestamp) - epoch(t.predicted_arrival)) AS BIGINT)
    AS prediction_error_seconds,
  v.feed_timestamp, v.ingest_time
FROM raw_positions v LEFT JOIN w1 t
  ON v.trip_id = t.trip_id AND v.stop_id = t.stop_id
  AND abs(epoch_us(v.vehicle_timestamp) - epoch_us(t.predicted_arrival)) < 900000000
WHERE v.{ARR}"""

ORACLE["arrival_track_asof"] = W(J2) + "SELECT * FROM enr"

ORACLE["feed_parse_rejects"] = W(MSG) + """
SELECT DISTINCT feed, msg_id, 'json_parse_error' AS reject_reason FROM msg_ev WHERE NOT msg_ok"""

ORACLE["vehicle_flatten"] = W(MSG, P3) + "SELECT * FROM p3"

ORACLE["trip_update_flatten"] = W(MSG, P4) + "SELECT * FROM p4"

ORACLE["trip_id_parse"] = W(MSG) + """
SELECT DISTINCT trip_text AS trip_id, p_dir AS direction, p_path AS path_id
FROM msg_ev WHERE list_ok AND kind <> 'unknown' AND trip_text IS NOT NULL"""

ORACLE["alert_text_pick"] = W(ALERTS) + """
SELECT msg_id, alert_id, header_text, description_text FROM al_rows"""

ORACLE["alert_flatten"] = W(ALERTS) + "SELECT * FROM al_flat"

ORACLE["alert_validate"] = W(ALERTS) + "SELECT * FROM al_valid"

ORACLE["vehicle_validate"] = W(MSG, P3, P4) + f"""
SELECT {VCOLS} FROM (SELECT * FROM p3 UNION ALL SELECT * FROM p4) WHERE {V1_REASON} IS NULL"""

ORACLE["vehicle_rejects"] = W(MSG, P3, P4) + f"""
SELECT * FROM (
  SELECT entity_id, trip_id, route_id, stop_id, {V1_REASON} AS reject_reason
  FROM (SELECT * FROM p3 UNION ALL SELECT * FROM p4))
WHERE reject_reason IS NOT NULL"""

ORACLE["track_rows"] = W(MSG, TRACKS) + """
SELECT * FROM trk WHERE scheduled_track IS NOT NULL OR actual_track IS NOT NULL"""

ORACLE["feed_union"] = W(MSG) + """
SELECT feed, msg_id, msg_ok, CASE WHEN list_ok THEN CAST(count(*) AS INTEGER) END AS n_entities
FROM msg_ev GROUP BY feed, msg_id, msg_ok, list_ok"""

ORACLE["entity_kinds"] = W(MSG) + """
SELECT feed, kind, count(*) AS n_entities FROM msg_ev WHERE list_ok GROUP BY 1, 2"""

ORACLE["snapshot_summary"] = W(MSG, TRACKS) + f"""
SELECT *, {_pct('with_actual', 'total')} AS pct_actual,
  {_pct('with_scheduled', 'total')} AS pct_scheduled FROM (
  SELECT snapshot, count(*) AS total, count(actual_track) AS with_actual,
    count(scheduled_track) AS with_scheduled,
    coalesce(array_to_string(list_sort(list_distinct(list(actual_track))), ','), '')
      AS actual_codes,
    coalesce(array_to_string(list_sort(list_distinct(list(scheduled_track))), ','), '')
      AS scheduled_codes
  FROM trk WHERE scheduled_track IS NOT NULL OR actual_track IS NOT NULL GROUP BY snapshot
  UNION ALL
  SELECT 'ALL', count(*), count(actual_track), count(scheduled_track),
    coalesce(array_to_string(list_sort(list_distinct(list(actual_track))), ','), ''),
    coalesce(array_to_string(list_sort(list_distinct(list(scheduled_track))), ','), '')
  FROM trk WHERE scheduled_track IS NOT NULL OR actual_track IS NOT NULL)"""

EXTRACTS = """
ent_at AS (
  SELECT event_id, row_number() OVER (PARTITION BY feed, msg_id ORDER BY event_id) - 1 AS ent_pos FROM msg_ev),
pos AS (
  SELECT *, feed || ':' || CAST(msg_id AS VARCHAR) AS snapshot,
    CASE WHEN arr = 0 THEN 0 WHEN d = 6 THEN NULL WHEN d = 3 THEN arr * 1000000 ELSE arr END AS arr_epoch,
    CASE WHEN d = 6 THEN NULL WHEN d = 3 THEN dep * 1000000 ELSE dep END AS dep_epoch
  FROM stops JOIN ent_at USING (event_id)),
std_x AS (SELECT snapshot, ent_pos, stop_pos, trip_text AS trip_id, msg_route AS route_id, stop_id,
    arr_epoch, dep_epoch FROM pos),
ext_x AS (SELECT snapshot, ent_pos, stop_pos, trip_text AS trip_id, msg_route AS route_id, stop_id,
    train_id, nyct_direction AS direction, scheduled_track, actual_track
  FROM pos)"""

ORACLE["extractor_comparison"] = W(MSG, EXTRACTS) + f"""
SELECT *, {_pct('with_actual', 'extension_rows')} AS pct_actual FROM (
  SELECT coalesce(snapshot, 'ALL') AS snapshot,
    CAST(sum(s) AS BIGINT) AS current_rows, CAST(sum(x) AS BIGINT) AS extension_rows,
    count(*) FILTER (x = 0) AS current_only, count(*) FILTER (s = 0) AS extension_only,
    CAST(sum(a) AS BIGINT) AS with_actual, CAST(sum(c) AS BIGINT) AS with_scheduled,
    CAST(sum(t) AS BIGINT) AS with_train_id
  FROM (
    SELECT snapshot, ent_pos, stop_pos, max(s) AS s, max(x) AS x, max(a) AS a, max(c) AS c, max(t) AS t
    FROM (SELECT snapshot, ent_pos, stop_pos, 1 AS s, 0 AS x, 0 AS a, 0 AS c, 0 AS t FROM std_x
          UNION ALL
          SELECT snapshot, ent_pos, stop_pos, 0, 1, (actual_track IS NOT NULL)::INT,
            (scheduled_track IS NOT NULL)::INT, (train_id IS NOT NULL)::INT FROM ext_x)
    GROUP BY snapshot, ent_pos, stop_pos)
  GROUP BY ROLLUP (snapshot))"""

ORACLE["sample_match"] = W(MSG, EXTRACTS) + """,
pick AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY snapshot
    ORDER BY actual_track IS NULL, ent_pos, stop_pos) AS rn FROM ext_x) WHERE rn = 1)
SELECT p.snapshot, p.trip_id, p.stop_id, p.route_id, p.train_id, p.direction, p.scheduled_track,
  p.actual_track, s.route_id AS current_route_id, s.arr_epoch AS current_arrival_time,
  s.dep_epoch AS current_departure_time
FROM pick p LEFT JOIN std_x s ON s.snapshot = p.snapshot AND s.ent_pos * 2 + s.stop_pos = (
  SELECT min(f.ent_pos * 2 + f.stop_pos) FROM std_x f WHERE f.snapshot = p.snapshot
    AND f.trip_id IS NOT DISTINCT FROM p.trip_id AND f.stop_id = p.stop_id)"""
ORACLE["sample_match"] = ORACLE["sample_match"].replace("\n,\npick AS", ",\npick AS")

ORACLE["latest_tracked"] = W(J2) + """
SELECT trip_id, stop_id, actual_track, scheduled_track, train_id, nyct_direction,
  vehicle_timestamp
FROM enr WHERE actual_track IS NOT NULL
ORDER BY vehicle_timestamp DESC, entity_id DESC LIMIT 10"""

ORACLE["track_coverage"] = W(J2) + f"""
SELECT *, {_pct('with_actual_track', 'total_records')} AS track_coverage_pct FROM (
  SELECT CAST(vehicle_timestamp AS DATE) AS date, count(*) AS total_records,
    count(actual_track) AS with_actual_track, count(scheduled_track) AS with_scheduled_track,
    count(train_id) AS with_train_id
  FROM enr GROUP BY 1)"""

ORACLE["enrichment_recent"] = W(J2) + f"""
SELECT *, {_pct('with_track_data', 'total_arrivals')} AS enrichment_pct FROM (
  SELECT count(*) AS total_arrivals, count(actual_track) AS with_track_data
  FROM enr WHERE vehicle_timestamp > (SELECT max(vehicle_timestamp) FROM enr) - INTERVAL 1 HOUR)"""

ORACLE["track_frequency"] = W(J2) + """
SELECT actual_track, count(*) AS count FROM enr WHERE actual_track IS NOT NULL GROUP BY 1"""

VMSG = f"""
vmsg AS (SELECT {VCOLS} FROM (SELECT * FROM p3 UNION ALL SELECT * FROM p4) WHERE {V1_REASON} IS NULL)"""

ORACLE["job_counters"] = W(MSG, P3, P4, VMSG, J2.replace("raw_positions", "vmsg"), ALERTS) + f"""
SELECT 'messages_processed' AS counter, count(DISTINCT (feed, msg_id)) AS value
  FROM msg_ev WHERE msg_ok
UNION ALL SELECT 'parse_errors', count(DISTINCT (feed, msg_id)) FROM msg_ev WHERE NOT msg_ok
UNION ALL SELECT 'vehicles_extracted', count(*) FROM p3
UNION ALL SELECT 'trip_updates_processed', count(*) FROM p4
UNION ALL SELECT 'invalid_vehicles', count(*) FROM msg_ev
  WHERE list_ok AND kind = 'vehicle' AND (trip_text IS NULL OR k % 11 = 0)
UNION ALL SELECT 'valid_records', count(*) FROM vmsg
UNION ALL SELECT 'invalid_records', count(*)
  FROM (SELECT * FROM p3 UNION ALL SELECT * FROM p4) WHERE {V1_REASON} IS NOT NULL
UNION ALL SELECT 'enriched_records', count(*) FROM enr WHERE enrichment = 'enriched'
UNION ALL SELECT 'no_track_data', count(*) FROM enr WHERE enrichment = 'no_track'
UNION ALL SELECT 'stale_track_data', count(*) FROM enr WHERE enrichment = 'stale'
UNION ALL SELECT 'track_data_cached', count(*) FROM rel WHERE src
UNION ALL SELECT 'alert_messages_processed', count(DISTINCT amsg) FROM al_ev WHERE msg_ok
UNION ALL SELECT 'alert_parse_errors', count(DISTINCT amsg) FROM al_ev WHERE NOT msg_ok
UNION ALL SELECT 'alerts_extracted', count(*) FROM al_flat
UNION ALL SELECT 'alerts_filtered', count(*) FROM al_rows WHERE no_target
UNION ALL SELECT 'valid_alerts', count(*) FROM al_valid
UNION ALL SELECT 'invalid_alerts', count(*) FROM al_flat WHERE feed_timestamp IS NULL"""

ORACLE["feed_rejects"] = W(MSG) + """
SELECT DISTINCT feed, msg_id, 'message' AS kind, CAST(NULL AS VARCHAR) AS entity_id,
  CAST(NULL AS VARCHAR) AS trip_id, CAST(NULL AS VARCHAR) AS route_id,
  CAST(NULL AS VARCHAR) AS stop_id,
  CASE WHEN msg_ok THEN 'entity_not_a_list' ELSE 'json_parse_error' END AS reject_reason
FROM msg_ev WHERE NOT list_ok
UNION ALL
SELECT feed, msg_id, kind, e_id, NULL, NULL, NULL, 'unknown_entity' FROM msg_ev
WHERE list_ok AND kind = 'unknown'
UNION ALL
SELECT feed, msg_id, kind, e_id, trip_text, msg_route, NULL, 'missing:' ||
  CASE WHEN trip_text IS NULL THEN 'trip_id' ELSE 'stop_time_update' END
FROM msg_ev WHERE list_ok AND kind = 'trip_update' AND d = 4
UNION ALL
SELECT * FROM (
  SELECT feed, msg_id, kind,
    CASE WHEN kind = 'vehicle' THEN e_id ELSE coalesce(e_id, 'None') || '__' || stop_id END AS entity_id,
    trip_text AS trip_id, msg_route AS route_id, stop_id,
    CASE WHEN trip_text IS NULL THEN 'missing:trip_id'
         WHEN stop_id IS NULL THEN 'missing:stop_id'
         WHEN no_time THEN 'missing:time'
         WHEN kind = 'vehicle' AND e_id IS NULL THEN 'missing:entity_id'
         WHEN sane IS NULL THEN 'missing:vehicle_timestamp'
         WHEN feed_timestamp IS NULL THEN 'missing:feed_timestamp'
         WHEN msg_route = 'G' THEN 'invalid_route' END AS reject_reason
  FROM (
    SELECT * REPLACE (CASE WHEN k % 11 <> 0 THEN stop_id END AS stop_id), false AS no_time
    FROM msg_ev WHERE list_ok AND kind = 'vehicle'
    UNION ALL BY NAME
    SELECT * EXCLUDE (stop_pos, arr, dep), arr IS NULL AS no_time FROM stops))
WHERE reject_reason IS NOT NULL"""

ORACLE["alert_rejects"] = W(ALERTS) + """
SELECT msg_id, alert_id, CASE WHEN no_target THEN 'no_target_route'
  ELSE 'missing:feed_timestamp' END AS reject_reason
FROM al_rows WHERE no_target OR feed_timestamp IS NULL
UNION ALL
SELECT amsg, CASE WHEN d = 0 THEN alert_id END, 'no_alert' FROM al_ev WHERE msg_ok AND d IN (0, 1)
UNION ALL
SELECT DISTINCT amsg, CAST(NULL AS VARCHAR), 'json_parse_error' FROM al_ev WHERE NOT msg_ok"""

ORACLE["station_index"] = W(HW) + """
SELECT stop_id, count(*) AS n_rows,
  CAST(row_number() OVER (ORDER BY count(*) DESC, stop_id) - 1 AS INTEGER) AS station_idx
FROM hw GROUP BY stop_id"""

ORACLE["stop_transitions"] = W(HW, ADJ) + "SELECT * FROM cnt"

ORACLE["adjacency"] = W(HW, ADJ) + "SELECT * FROM adj"

ORACLE["headway_5min"] = W(HW, H5) + "SELECT * FROM h5"

ORACLE["headway_imputed"] = W(HW, H5, GRID) + "SELECT * FROM imp"

ORACLE["headway_normalised"] = W(HW, H5, GRID) + """
SELECT bin_start, stop_id, value, round(z, 9) + 0.0 AS z FROM norm"""

ORACLE["training_windows"] = W(HW, H5, GRID) + """
SELECT window_idx, window_start, stop_id, "offset", round(value, 9) + 0.0 AS value FROM win"""

ORACLE["temporal_split"] = W(HW, H5, GRID) + "SELECT * FROM splits"

ORACLE["forecast_errors"] = W(HW, H5, GRID) + """
SELECT split, count(*) AS n, avg(abs(e)) AS mae, sqrt(avg(e * e)) AS rmse,
  avg(CASE WHEN abs(actual) > 1e-9 THEN abs(e) / abs(actual) END) AS mape
FROM (
  SELECT s.split, y.value AS actual, p.value - y.value AS e
  FROM win y JOIN win p ON p.window_idx = y.window_idx AND p.stop_id = y.stop_id
    AND p."offset" = 11
  JOIN splits s ON s.window_idx = y.window_idx
  WHERE y."offset" >= 12)
GROUP BY split"""

ORACLE["forecast_errors_by_route"] = W(HW, h5_sql(BY_ROUTE), grid_sql(BY_ROUTE)) + f"""
SELECT split, route_id, direction, count(*) AS n, avg(abs(e)) AS mae, sqrt(avg(e * e)) AS rmse,
  avg(CASE WHEN abs(actual) > 1e-9 THEN abs(e) / abs(actual) END) AS mape
FROM (
  SELECT s.split, route_id, direction, y.value AS actual, p.value - y.value AS e
  FROM win y JOIN (SELECT window_idx, {BY_ROUTE}, value FROM win WHERE "offset" = 11) p
    USING (window_idx, {BY_ROUTE})
  JOIN splits s USING (window_idx)
  WHERE y."offset" >= 12)
GROUP BY split, route_id, direction"""

ORACLE["diffusion_transition"] = W(HW, ADJ) + "SELECT * FROM dt"

ORACLE["diffusion_features"] = W(HW, ADJ) + """,
x0 AS (SELECT stop_id, avg(headway_seconds) AS value FROM hw GROUP BY stop_id)
SELECT d.direction, 0 AS k, x0.stop_id, x0.value
FROM (VALUES ('forward'), ('backward')) d(direction), x0
UNION ALL
SELECT dt.direction, 1, dt.from_stop, sum(dt.weight * x0.value)
FROM dt JOIN x0 ON x0.stop_id = dt.to_stop GROUP BY dt.direction, dt.from_stop"""
ORACLE["diffusion_features"] = ORACLE["diffusion_features"].replace(
    "\n,\nx0 AS", ",\nx0 AS")

ORACLE["alerts_latest"] = W(ALERTS) + "SELECT * FROM al_latest"

ORACLE["time_features"] = W() .rstrip().rstrip(",") + f"""
SELECT entity_id, route_id, stop_id, vehicle_timestamp,
  CAST(hour(vehicle_timestamp) AS INTEGER) AS hour,
  CAST(dayofweek(vehicle_timestamp) + 1 AS INTEGER) AS day_of_week,
  dayofweek(vehicle_timestamp) IN (0, 6) AS is_weekend,
  ((hour(vehicle_timestamp) >= 7 AND hour(vehicle_timestamp) < 10)
   OR (hour(vehicle_timestamp) >= 16 AND hour(vehicle_timestamp) < 19))
   AND dayofweek(vehicle_timestamp) NOT IN (0, 6) AS is_peak,
  CAST(hour(vehicle_timestamp) * 60 + minute(vehicle_timestamp) AS INTEGER) AS minute_of_day
FROM raw_positions WHERE {ARR}"""

ORACLE["headway_regularity"] = W(HW) + """,
med AS (SELECT route_id, direction, stop_id, median(headway_seconds) AS planned_headway
        FROM hw GROUP BY 1, 2, 3)
SELECT route_id, direction, stop_id, count(*) AS n, any_value(planned_headway) AS planned_headway,
  avg(abs(headway_seconds - planned_headway) / planned_headway) AS prdm
FROM hw JOIN med USING (route_id, direction, stop_id) GROUP BY 1, 2, 3"""
ORACLE["headway_regularity"] = ORACLE["headway_regularity"].replace("\n,\nmed AS", ",\nmed AS")

ORACLE["arrivals_under_alert"] = W(ALERTS) + f"""
SELECT v.entity_id, v.route_id, v.stop_id, v.vehicle_timestamp, a.alert_id, a.alert_type
FROM raw_positions v
JOIN (SELECT *, unnest(string_split(affected_routes, ',')) AS r FROM al_latest) a
  ON v.route_id = a.r AND a.active_period_start IS NOT NULL
  AND v.vehicle_timestamp >= a.active_period_start
  AND (a.active_period_end IS NULL OR v.vehicle_timestamp < a.active_period_end)
WHERE v.{ARR}"""

ORACLE["ingest_lag"] = W() .rstrip().rstrip(",") + """
SELECT CAST(feed_timestamp AS DATE) AS date, count(*) AS n,
  min(lag_s) AS min_lag_s, avg(lag_s) AS avg_lag_s, max(lag_s) AS max_lag_s,
  quantile_disc(lag_s, 0.5) AS p50_lag_s, quantile_disc(lag_s, 0.95) AS p95_lag_s
FROM (SELECT feed_timestamp,
        (epoch_us(ingest_time) - epoch_us(feed_timestamp)) / 1e6 AS lag_s FROM raw_positions)
GROUP BY 1"""

ORACLE["bin_completeness"] = W(HW) + """,
b AS (SELECT stop_id, TIMESTAMP '1970-01-01'
        + to_microseconds((epoch_us(arrival_time) // 300000000) * 300000000) AS b FROM hw)
SELECT stop_id, min(b) AS first_bin, max(b) AS last_bin, count(DISTINCT b) AS observed_bins,
  CAST((epoch(max(b)) - epoch(min(b))) / 300 + 1 AS BIGINT) AS expected_bins,
  count(DISTINCT b) / ((epoch(max(b)) - epoch(min(b))) / 300 + 1) AS completeness
FROM b GROUP BY stop_id"""
ORACLE["bin_completeness"] = ORACLE["bin_completeness"].replace("\n,\nb AS", ",\nb AS")

ORACLE["ghost_trains"] = W(W1) + f"""
SELECT * FROM w1 p WHERE NOT EXISTS (
  SELECT 1 FROM raw_positions a
  WHERE a.{ARR} AND a.trip_id = p.trip_id AND a.stop_id = p.stop_id
    AND abs(epoch_us(p.predicted_arrival) - epoch_us(a.vehicle_timestamp)) < 900000000)"""

ORACLE["headway_interpolated"] = W(HW, H5) + """,
span AS (SELECT stop_id, min(bin_start) AS a, max(bin_start) AS b FROM h5 GROUP BY stop_id),
grid AS (SELECT stop_id, unnest(generate_series(a, b, INTERVAL 5 MINUTE)) AS bin_start FROM span),
gj AS (
  SELECT g.stop_id, g.bin_start, h.mean_headway,
    last_value(CASE WHEN h.mean_headway IS NOT NULL
      THEN struct_pack(t := epoch(g.bin_start), v := h.mean_headway) END IGNORE NULLS)
      OVER (PARTITION BY g.stop_id ORDER BY g.bin_start
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS p,
    first_value(CASE WHEN h.mean_headway IS NOT NULL
      THEN struct_pack(t := epoch(g.bin_start), v := h.mean_headway) END IGNORE NULLS)
      OVER (PARTITION BY g.stop_id ORDER BY g.bin_start
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS n
  FROM grid g LEFT JOIN h5 h ON h.stop_id = g.stop_id AND h.bin_start = g.bin_start)
SELECT bin_start, stop_id,
  coalesce(mean_headway, p.v + (n.v - p.v) * (epoch(bin_start) - p.t) / (n.t - p.t))
    AS mean_headway,
  mean_headway IS NULL AS is_filled
FROM gj"""
ORACLE["headway_interpolated"] = ORACLE["headway_interpolated"].replace(
    "\n,\nspan AS", ",\nspan AS")

ORACLE["alert_lifecycle"] = W(ALERTS) + """
SELECT alert_id, alert_type, active_period_start, active_period_end, as_of,
  CASE WHEN active_period_start IS NULL THEN 'unknown'
       WHEN as_of < active_period_start THEN 'future'
       WHEN active_period_end IS NULL OR as_of < active_period_end THEN 'active'
       ELSE 'ended' END AS state
FROM al_latest, (SELECT max(feed_timestamp) AS as_of FROM al_latest)"""

AL_HISTORY = """
al_one AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY alert_id, feed_timestamp ORDER BY
      coalesce(updated_at, TIMESTAMP '1970-01-01') DESC,
      coalesce(ingest_time, TIMESTAMP '1970-01-01') DESC,
      coalesce(header_text, '') DESC, coalesce(description_text, '') DESC,
      coalesce(alert_type, '') DESC, coalesce(affected_stops, '') DESC) AS rn
    FROM al_valid) WHERE rn = 1)"""

ORACLE["alert_history"] = W(ALERTS, AL_HISTORY) + """
SELECT alert_id, feed_timestamp AS valid_from,
  LEAD(feed_timestamp) OVER (PARTITION BY alert_id ORDER BY feed_timestamp) AS valid_to, alert_type, affected_routes
FROM (SELECT *, row_number() OVER w AS n, LAG(alert_type) OVER w AS was_type, LAG(affected_routes) OVER w AS was_routes
  FROM al_one WINDOW w AS (PARTITION BY alert_id ORDER BY feed_timestamp))
WHERE n = 1 OR alert_type IS DISTINCT FROM was_type OR affected_routes IS DISTINCT FROM was_routes"""

ORACLE["alert_states"] = W(ALERTS, AL_HISTORY) + """
SELECT alert_id, alert_type, active_period_start, active_period_end, as_of,
  CASE WHEN active_period_start IS NULL THEN 'unknown'
       WHEN as_of < active_period_start THEN 'future'
       WHEN active_period_end IS NULL OR as_of < active_period_end THEN 'active'
       ELSE 'ended' END AS state
FROM (SELECT unnest(generate_series((SELECT min(feed_timestamp) FROM al_valid),
        (SELECT max(feed_timestamp) FROM al_valid), INTERVAL 6 HOUR)) AS as_of) t
JOIN (SELECT *, LEAD(feed_timestamp) OVER (PARTITION BY alert_id ORDER BY feed_timestamp) AS until FROM al_one) v
  ON v.feed_timestamp <= as_of AND (until IS NULL OR as_of < until)"""

FIRST_DAYS = "BETWEEN DATE '2024-01-01' AND DATE '2024-01-02'"
ORACLE["headway_range"] = W(HW.replace(
    "WHERE {ARR} AND".format(ARR=ARR), f"WHERE {ARR} AND CAST(vehicle_timestamp AS DATE) {FIRST_DAYS} AND")) + """
SELECT * FROM hw"""

ORACLE["ingest_lag_range"] = W().rstrip().rstrip(",") + f"""
SELECT count(*) AS n, min(lag_s) AS min_lag_s, avg(lag_s) AS avg_lag_s, max(lag_s) AS max_lag_s,
  quantile_disc(lag_s, 0.5) AS p50_lag_s, quantile_disc(lag_s, 0.95) AS p95_lag_s
FROM (SELECT (epoch_us(ingest_time) - epoch_us(feed_timestamp)) / 1e6 AS lag_s FROM raw_positions
      WHERE CAST(feed_timestamp AS DATE) {FIRST_DAYS})
HAVING count(*) > 0"""

ORACLE["hourly_coverage"] = W(J2) + f"""
SELECT *, {_pct('with_actual_track', 'total_records')} AS track_coverage_pct FROM (
  SELECT date_trunc('hour', vehicle_timestamp) AS window_start,
    date_trunc('hour', vehicle_timestamp) + INTERVAL 1 HOUR AS window_end, count(*) AS total_records,
    count(actual_track) AS with_actual_track, count(scheduled_track) AS with_scheduled_track,
    count(train_id) AS with_train_id
  FROM enr GROUP BY 1, 2)"""
