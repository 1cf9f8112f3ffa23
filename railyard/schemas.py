"""Table and message schemas (the warehouse tables and the JSON feeds)."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, TS = T.StringType(), T.LongType(), T.TimestampType()

# The vehicle_positions table, columns in warehouse order,
# (name, type, required).
VEHICLE_POSITIONS_FIELDS = [
    ("entity_id", S, True),
    ("trip_id", S, True),
    ("route_id", S, True),
    ("start_time", S, False),
    ("start_date", S, False),
    ("direction", S, True),
    ("path_id", S, False),
    ("train_id", S, False),
    ("nyct_direction", S, False),
    ("scheduled_track", S, False),
    ("actual_track", S, False),
    ("stop_id", S, True),
    ("current_stop_sequence", L, False),
    ("current_status", S, False),
    ("vehicle_timestamp", TS, True),
    ("feed_timestamp", TS, True),
    ("ingest_time", TS, True),
]

# The service_alerts table.
SERVICE_ALERTS_FIELDS = [
    ("alert_id", S, True),
    ("alert_type", S, False),
    ("affected_routes", T.ArrayType(S), False),
    ("affected_stops", T.ArrayType(S), False),
    ("active_period_start", TS, False),
    ("active_period_end", TS, False),
    ("header_text", S, False),
    ("description_text", S, False),
    ("created_at", TS, False),
    ("updated_at", TS, False),
    ("feed_timestamp", TS, True),
    ("ingest_time", TS, True),
]

VEHICLE_POSITIONS = T.StructType(
    [T.StructField(n, t, not req) for n, t, req in VEHICLE_POSITIONS_FIELDS])
SERVICE_ALERTS = T.StructType(
    [T.StructField(n, t, not req) for n, t, req in SERVICE_ALERTS_FIELDS])
VEHICLE_COLUMNS = [n for n, _, _ in VEHICLE_POSITIONS_FIELDS]
ALERT_COLUMNS = [n for n, _, _ in SERVICE_ALERTS_FIELDS]

# Feed messages.  Every scalar is read as text, so that a field of another type
# than usual never spoils its message; the parsers convert them.
_TRIP = T.StructType([
    T.StructField("trip_id", S), T.StructField("route_id", S),
    T.StructField("start_time", S), T.StructField("start_date", S),
    T.StructField("train_id", S), T.StructField("direction", S),
])
_STU = T.StructType([
    T.StructField("stop_id", S),
    T.StructField("stop_sequence", S),
    T.StructField("arrival", T.StructType([T.StructField("time", S)])),
    T.StructField("departure", T.StructType([T.StructField("time", S)])),
    T.StructField("scheduled_track", S),
    T.StructField("actual_track", S),
])
GTFS_MESSAGE = T.StructType([
    T.StructField("header", T.StructType([
        T.StructField("gtfs_realtime_version", S),
        T.StructField("timestamp", S)])),
    T.StructField("_ingest_time", S),
    T.StructField("entity", T.ArrayType(T.StructType([
        T.StructField("id", S),
        T.StructField("vehicle", T.StructType([
            T.StructField("trip", _TRIP),
            T.StructField("current_stop_sequence", S),
            T.StructField("stop_id", S),
            T.StructField("current_status", S),
            T.StructField("timestamp", S)])),
        T.StructField("trip_update", T.StructType([
            T.StructField("trip", _TRIP),
            T.StructField("stop_time_update", T.ArrayType(_STU))])),
    ]))),
])

_TRANSLATED = T.StructType([T.StructField("translation", T.ArrayType(
    T.StructType([T.StructField("language", S), T.StructField("text", S)])))])
MERCURY_KEY = "transit_realtime.mercury_alert"
ALERTS_MESSAGE = T.StructType([
    T.StructField("header", T.StructType([T.StructField("timestamp", S)])),
    T.StructField("_ingest_time", S),
    T.StructField("entity", T.ArrayType(T.StructType([
        T.StructField("id", S),
        T.StructField("alert", T.StructType([
            T.StructField("informed_entity", T.ArrayType(T.StructType([
                T.StructField("route_id", S), T.StructField("stop_id", S)]))),
            T.StructField("active_period", T.ArrayType(T.StructType([
                T.StructField("start", S), T.StructField("end", S)]))),
            T.StructField("header_text", _TRANSLATED),
            T.StructField("description_text", _TRANSLATED),
            T.StructField(MERCURY_KEY, T.StructType([
                T.StructField("alert_type", S), T.StructField("created_at", S),
                T.StructField("updated_at", S)])),
        ])),
    ]))),
])

_WAREHOUSE_NAMES = {
    T.StringType: "STRING", T.LongType: "INTEGER", T.IntegerType: "INTEGER",
    T.TimestampType: "TIMESTAMP", T.TimestampNTZType: "TIMESTAMP",
    T.DoubleType: "FLOAT", T.BooleanType: "BOOLEAN", T.DateType: "DATE",
}


def _type_name(dt: T.DataType) -> str:
    if isinstance(dt, T.ArrayType):
        return f"ARRAY<{_type_name(dt.elementType)}>"
    return _WAREHOUSE_NAMES[type(dt)]


def schema_string(schema: T.StructType) -> str:
    """``name:TYPE,...`` text of a table schema; arrays as ``ARRAY<T>``."""
    return ",".join(f"{f.name}:{_type_name(f.dataType)}" for f in schema.fields)


def conform(df, schema: T.StructType):
    """Select and cast ``df`` to the column order and types of ``schema``."""
    from pyspark.sql import functions as F
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name)
                      for f in schema.fields])
