"""DuckDB text of the fixtures, written from FIXTURES.md (not generated from
the Spark code).  Each oracle query is ``WITH <these CTEs> SELECT ...`` over
the driver's pre-registered views (``events``, ``embeddings``)."""

from __future__ import annotations


def ts(seconds_expr: str) -> str:
    """Naive-UTC timestamp from epoch seconds (DuckDB)."""
    return f"(TIMESTAMP '1970-01-01 00:00:00' + to_seconds({seconds_expr}))"


def ts_us(micros_expr: str) -> str:
    return f"(TIMESTAMP '1970-01-01 00:00:00' + to_microseconds({micros_expr}))"



EVENT_BASE = f"""
ev_k AS (
  SELECT event_id, user_id, event_type,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         event_id // 2 AS msg_id
  FROM events),
ev_b AS (
  SELECT *,
    substr('ACEBDFMS', CAST(user_id % 8 AS INTEGER) + 1, 1) AS route,
    CASE WHEN (user_id // 8) % 2 = 0 THEN 'N' ELSE 'S' END AS dir,
    CASE WHEN event_type IN ('view', 'error') THEN 'IN_TRANSIT_TO'
         WHEN event_type = 'click' THEN 'STOPPED_AT'
         WHEN event_type = 'purchase' THEN 'INCOMING_AT' END AS st,
    1704067200 + msg_id * 60 AS feed_epoch
  FROM ev_k),
ev_p AS (
  SELECT *,
    CASE WHEN st = 'IN_TRANSIT_TO' THEN feed_epoch + k * 10 ELSE feed_epoch END AS veh_epoch
  FROM ev_b),
ev_rows AS (
  SELECT *,
    'e' || CAST(event_id AS VARCHAR) AS entity_id,
    '060300_' || route || '..' || dir || '55R' AS trip_id,
    route AS route_id,
    CASE WHEN st = 'IN_TRANSIT_TO' THEN '06:03:00' END AS start_time,
    CASE WHEN st = 'IN_TRANSIT_TO' THEN strftime({ts('feed_epoch')}, '%Y%m%d') END AS start_date,
    dir AS direction,
    '55R' AS path_id,
    CASE WHEN st = 'IN_TRANSIT_TO' AND k % 7 <> 0
         THEN '0' || route || ' ' || CAST(user_id % 50 AS VARCHAR) END AS train_id,
    CASE WHEN st = 'IN_TRANSIT_TO' THEN CASE WHEN dir = 'N' THEN 'NORTH' ELSE 'SOUTH' END END
      AS nyct_direction,
    CASE WHEN st = 'IN_TRANSIT_TO' AND k % 2 = 0 THEN 'F' || CAST(k % 3 AS VARCHAR) END
      AS scheduled_track,
    CASE WHEN st = 'IN_TRANSIT_TO' AND k % 5 <> 0 THEN 'F' || CAST(k % 3 + 1 AS VARCHAR) END
      AS actual_track,
    route || CAST(k % 4 AS VARCHAR) || dir AS stop_id,
    CAST(k % 4 + 1 AS BIGINT) AS current_stop_sequence,
    st AS current_status,
    {ts('veh_epoch')} AS vehicle_timestamp,
    {ts('feed_epoch')} AS feed_timestamp,
    {ts_us('(feed_epoch + 1 + msg_id % 7) * 1000000 + 250000')} AS ingest_time
  FROM ev_p),
raw_positions AS (
  SELECT entity_id, trip_id, route_id, start_time, start_date, direction, path_id,
         train_id, nyct_direction, scheduled_track, actual_track, stop_id,
         current_stop_sequence, current_status, vehicle_timestamp, feed_timestamp,
         ingest_time
  FROM ev_rows)"""
