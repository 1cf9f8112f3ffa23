"""Feed decoding, flattening, projection and validation.

Plain ``DataFrame -> DataFrame`` functions usable with ``df.transform`` on
batch and streaming frames alike.  JSON is parsed into a VARIANT and read
from it field by field against explicit schemas; flattening is ``explode``;
every rule is a built-in expression, so a message is never handled by Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import (epoch_lenient, epoch_text_to_ts, iso_to_ts,
                                 parse_trip_id, pick_translation, truthy, truthy_epoch,
                                 typed, whole_number)
from ..schemas import (ALERTS_MESSAGE, GTFS_MESSAGE, MERCURY_KEY,  # noqa: F401
                       SERVICE_ALERTS, VEHICLE_POSITIONS, conform)

# Accepted routes.
VALID_VEHICLE_ROUTES = ("A", "B", "C", "D", "E", "F", "H", "M", "S")
ALERT_TARGET_ROUTES = ("A", "B", "C", "D", "E", "F", "M", "S")
VALID_DIRECTIONS = ("N", "S", "U")
# Required fields of V1 and V2, in the order they are checked.
VEHICLE_REQUIRED = ("entity_id", "trip_id", "route_id", "direction", "stop_id",
                    "vehicle_timestamp", "feed_timestamp", "ingest_time")
ALERT_REQUIRED = ("alert_id", "feed_timestamp", "ingest_time")


# ---------------------------------------------------------------- P1 decode
def decode(messages: DataFrame, schema=GTFS_MESSAGE, value_col: str = "value") -> DataFrame:
    """Parse JSON text (or UTF-8 bytes) once into a VARIANT and read the
    typed column ``msg`` from it field by field, so that a field, a stop
    update or an entity of an unexpected type costs only itself.  ``msg_ok``
    is false for text that is not one JSON object and nothing else (blank, an
    array, a lone value, anything after the object); ``list_ok`` is false if
    the message has an ``entity`` that is no list.  Of a repeated key the last
    value counts where ``spark.sql.variant.allowDuplicateKeys`` is on, as in
    the package's sessions; else such a message fails."""
    v = F.col(value_col)
    if dict(messages.dtypes).get(value_col) == "binary":
        v = F.decode(v, "UTF-8")
    # both parsers stop after the first value; text that is one value within braces and
    # within brackets has nothing behind it
    doc = F.try_parse_json(F.concat(F.lit('{"m":'), v, F.lit("}")))
    alone = F.json_array_length(F.concat(F.lit("["), v, F.lit("]"))) == 1
    ok = F.coalesce(v.rlike(r"^[ \t\r\n]*\{") & alone & F.col("_doc").isNotNull(), F.lit(False))
    root = "$['m']"
    listed = F.try_variant_get("_doc", f"{root}['entity']", "variant").isNull() \
        | F.try_variant_get("_doc", f"{root}['entity']", "array<variant>").isNotNull()
    return (messages.withColumn("_doc", doc).withColumn("msg_ok", ok)
            .withColumn("list_ok", F.when(F.col("msg_ok"), F.coalesce(listed, F.lit(True))))
            .withColumn("msg", F.when(F.col("msg_ok"), typed(F.col("_doc"), schema, root)))
            .drop("_doc"))


def parse_rejects(decoded: DataFrame, keys=("feed", "msg_id")) -> DataFrame:
    """P1 reject output: one row per unparsable message."""
    return decoded.where(~F.col("msg_ok")).select(
        *keys, F.lit("json_parse_error").alias("reject_reason"),
        F.length("value").alias("value_length"))


# ---------------------------------------------------------------- P2 entities
def _entity_rows(decoded: DataFrame, keys, with_failed: bool) -> DataFrame:
    """One row per entity with its place in the message; ``with_failed``
    adds one row of NULL entity, with ``failure``, per message that is not one
    JSON object or whose ``entity`` is no list."""
    failure = F.when(~F.col("msg_ok"), F.lit("json_parse_error")) \
        .when(~F.col("list_ok"), F.lit("entity_not_a_list"))
    ent, d = F.col("msg.entity"), decoded.withColumn("failure", failure)
    if with_failed:
        none = F.lit(None).cast(decoded.schema["msg"].dataType["entity"].dataType.elementType)
        ent = F.when(F.col("failure").isNull(), ent).otherwise(F.array(none))
    else:
        d = d.where(F.col("failure").isNull())
    return d.select(*keys, "failure",
                    F.col("msg.header.timestamp").alias("_feed_ts_text"),
                    F.col("msg._ingest_time").alias("_ingest_text"),
                    F.posexplode(ent).alias("ent_pos", "ent"))


def entities(decoded: DataFrame, keys=("feed", "msg_id"), with_failed: bool = False) -> DataFrame:
    """One row per entity of every parsed message, with the feed-level
    fields; ``kind`` is vehicle (wins), trip_update or unknown (also for an
    entity that is no object), and message for the row that ``with_failed``
    gives a message that failed (``failure`` says why)."""
    kind = (F.when(F.col("failure").isNotNull(), F.lit("message"))
            .when(F.col("ent.vehicle").isNotNull(), F.lit("vehicle"))
            .when(F.col("ent.trip_update").isNotNull(), F.lit("trip_update"))
            .otherwise(F.lit("unknown")))
    return _entity_rows(decoded, keys, with_failed).withColumn("kind", kind)


def _feed_times() -> list[Column]:
    feed_ts = F.when(truthy_epoch("_feed_ts_text"), epoch_text_to_ts("_feed_ts_text"))
    return [feed_ts.alias("feed_timestamp"), iso_to_ts("_ingest_text").alias("ingest_time")]


# ---------------------------------------------------------------- P3, P4 records
def _first_missing(*checks: tuple[str, Column]) -> Column:
    """``missing:<name>`` of the first check that fails, else NULL."""
    return F.coalesce(*[F.when(~present, F.lit(f"missing:{name}")) for name, present in checks])


def _stop_time(update: Column) -> Column:
    arr, dep = update["arrival"]["time"], update["departure"]["time"]
    return F.when(truthy_epoch(arr), arr).when(truthy_epoch(dep), dep)


def position_candidates(ents: DataFrame, keep=()) -> DataFrame:
    """P3 and P4 before anything is dropped: every record an entity could
    yield, with ``extract_reason`` NULL where it does yield it.

    A vehicle gives one record: tracks NULL, direction and path parsed from
    the trip id; it needs trip_id, route_id, stop_id and timestamp.  A trip
    update gives one record per stop update: time = arrival.time if truthy
    else departure.time if truthy, status IN_TRANSIT_TO; it needs trip_id,
    route_id, stop and time.  A trip update without stop updates, an entity
    of unknown kind and a failed message give one record with a reason.  A
    timestamp that is not a number gives NULL vehicle_timestamp (the
    validator rejects the row; only that row is lost).

    One pass: each entity becomes an array of records and the arrays are
    exploded once, so messages are decoded once."""
    veh, vtrip = F.col("ent.vehicle"), F.col("ent.vehicle.trip")
    ttrip, updates = F.col("ent.trip_update.trip"), F.col("ent.trip_update.stop_time_update")
    has_updates = F.coalesce(F.size(updates) > 0, F.lit(False))
    null_s = F.lit(None).cast("string")

    def record(entity_id, trip, sched, actual, stop, seq, status, ts_text, reason):
        direction, path = parse_trip_id(trip["trip_id"])
        return F.struct(
            entity_id.alias("entity_id"), trip["trip_id"].alias("trip_id"),
            trip["route_id"].alias("route_id"), trip["start_time"].alias("start_time"),
            trip["start_date"].alias("start_date"), direction.alias("direction"),
            path.alias("path_id"), trip["train_id"].alias("train_id"),
            trip["direction"].alias("nyct_direction"), sched.alias("scheduled_track"),
            actual.alias("actual_track"), stop.alias("stop_id"),
            whole_number(seq).alias("current_stop_sequence"), status.alias("current_status"),
            epoch_text_to_ts(ts_text).alias("vehicle_timestamp"),
            reason.alias("extract_reason"))

    v_rec = record(
        F.col("ent.id"), vtrip, null_s, null_s, veh["stop_id"], veh["current_stop_sequence"],
        veh["current_status"], veh["timestamp"],
        F.when(F.col("kind") == "message", F.col("failure"))
        .when(F.col("kind") == "unknown", F.lit("unknown_entity"))
        .otherwise(_first_missing(
            ("trip_id", truthy(vtrip["trip_id"])), ("route_id", truthy(vtrip["route_id"])),
            ("stop_id", truthy(veh["stop_id"])), ("timestamp", truthy_epoch(veh["timestamp"])))))

    def t_rec(u):
        return record(
            F.when(truthy(u["stop_id"]), F.concat(F.coalesce(F.col("ent.id"), F.lit("None")),
                                                  F.lit("__"), u["stop_id"]))
            .otherwise(F.col("ent.id")),
            ttrip, u["scheduled_track"], u["actual_track"], u["stop_id"], u["stop_sequence"],
            F.lit("IN_TRANSIT_TO"), _stop_time(u),
            _first_missing(
                ("trip_id", truthy(ttrip["trip_id"])), ("route_id", truthy(ttrip["route_id"])),
                ("stop_time_update", has_updates), ("stop_id", truthy(u["stop_id"])),
                ("time", _stop_time(u).isNotNull())))

    # without stop updates, one NULL update carries the reason
    no_update = F.array(F.lit(None).cast(ents.schema["ent"].dataType["trip_update"].dataType
                                         ["stop_time_update"].dataType.elementType))
    t_recs = F.transform(F.when(has_updates, updates).otherwise(no_update), t_rec)
    recs = F.when(F.col("kind") == "trip_update", t_recs).otherwise(F.array(v_rec))
    return ents.select(*keep, "kind", *_feed_times(), F.explode(recs).alias("r")) \
        .select(*keep, "kind", "r.*", "feed_timestamp", "ingest_time")


def _extracted(ents: DataFrame, keep=()) -> DataFrame:
    return position_candidates(ents, keep).where(F.col("extract_reason").isNull()) \
        .drop("extract_reason")


def vehicle_records(ents: DataFrame, keep=()) -> DataFrame:
    """The records of vehicle entities."""
    return _extracted(ents.where(F.col("kind") == "vehicle"), keep).drop("kind")


def trip_update_records(ents: DataFrame, keep=()) -> DataFrame:
    """The records of trip updates, one per kept stop update."""
    return _extracted(ents.where(F.col("kind") == "trip_update"), keep).drop("kind")


def extract_positions(decoded: DataFrame, keep=(), with_kind: bool = False) -> DataFrame:
    """Every record a GTFS message yields, before validation."""
    out = _extracted(entities(decoded), keep)
    return out if with_kind else out.drop("kind")


# ---------------------------------------------------------------- V1
def _vehicle_reason() -> Column:
    reason = None
    for f in VEHICLE_REQUIRED:
        c = F.col(f)
        missing = c.isNull() if f.endswith(("timestamp", "time")) else ~truthy(c)
        reason = (F.when(missing, F.lit(f"missing:{f}")) if reason is None
                  else reason.when(missing, F.lit(f"missing:{f}")))
    return reason.when(~F.col("route_id").isin(*VALID_VEHICLE_ROUTES), F.lit("invalid_route"))


def with_vehicle_verdict(records: DataFrame) -> DataFrame:
    """V1 verdict: ``reject_reason`` NULL for a valid row, else the first
    failing check (required fields in list order, then the route set)."""
    return records.withColumn("reject_reason", _vehicle_reason())


def validate_vehicles(records: DataFrame) -> DataFrame:
    """V1: valid rows; a direction outside N/S/U becomes U."""
    return _valid_direction(with_vehicle_verdict(records).where(F.col("reject_reason").isNull())
                            .drop("reject_reason"))


def _valid_direction(records: DataFrame) -> DataFrame:
    return records.withColumn("direction", F.when(F.col("direction").isin(*VALID_DIRECTIONS),
                                                  F.col("direction")).otherwise(F.lit("U")))


def vehicle_rejects(records: DataFrame) -> DataFrame:
    """V1 reject output (the dead-letter table): failing rows and reason."""
    return with_vehicle_verdict(records).where(F.col("reject_reason").isNotNull())


def position_outcomes(decoded: DataFrame, keys=("feed", "msg_id"),
                      with_failed: bool = False) -> DataFrame:
    """Every candidate record with ``extract_reason`` (P1, P3, P4) and
    ``reject_reason``: that one, else the validator's (V1), else NULL for a
    row that reaches the table.  Accepted and rejected rows add up to the
    candidates, and each entity and failed message has one at least."""
    c = with_vehicle_verdict(position_candidates(entities(decoded, keys, with_failed), keys))
    return c.withColumn("reject_reason", F.coalesce("extract_reason", "reject_reason"))


def accepted_positions(outcomes: DataFrame) -> DataFrame:
    """The accepted rows of ``position_outcomes`` in table schema."""
    return conform(_valid_direction(outcomes.where(F.col("reject_reason").isNull())),
                   VEHICLE_POSITIONS)


def feed_rejects(decoded: DataFrame, keys=("feed", "msg_id")) -> DataFrame:
    """Dead letters of a GTFS feed, in one pass: failed messages, entities
    and stop updates that yield no record, and records that fail V1."""
    r = position_outcomes(decoded, keys, with_failed=True)
    return r.where(F.col("reject_reason").isNotNull()).select(
        *keys, "kind", "entity_id", "trip_id", "route_id", "stop_id", "reject_reason")


def vehicle_table(decoded: DataFrame) -> DataFrame:
    """P1-P6 + V1 in table schema: what the raw sink appends."""
    return conform(validate_vehicles(extract_positions(decoded)), VEHICLE_POSITIONS)


# ---------------------------------------------------------------- alerts P7-P9, V2
def alert_entities(decoded: DataFrame, keys=("msg_id",)) -> DataFrame:
    return _entity_rows(decoded, keys, False).where(F.col("ent.alert").isNotNull())


def alert_texts(ents: DataFrame, keep=("msg_id",)) -> DataFrame:
    """P8 on every alert entity: picked header and description text."""
    return ents.select(*keep, F.col("ent.id").alias("alert_id"),
                       pick_translation(F.col("ent.alert.header_text")).alias("header_text"),
                       pick_translation(F.col("ent.alert.description_text"))
                       .alias("description_text"))


def _nonempty_sorted(arr: Column, field: str) -> Column:
    vals = F.transform(arr, lambda x: x[field])
    return F.array_sort(F.array_distinct(F.filter(vals, lambda x: x.isNotNull() & (x != ""))))


def alert_candidates(ents: DataFrame, target_routes=ALERT_TARGET_ROUTES, keep=()) -> DataFrame:
    """P9 before anything is dropped: one row per alert; routes are the
    sorted intersection with the target set, stops all distinct non-empty
    stops, sorted; only the first active period is kept."""
    a = F.col("ent.alert")
    routes = _nonempty_sorted(a["informed_entity"], "route_id")
    target = F.array(*[F.lit(r) for r in target_routes])
    hit = F.array_sort(F.array_intersect(routes, target))
    first = F.get(a["active_period"], 0)
    merc = a[MERCURY_KEY]
    feed_ts = epoch_lenient("_feed_ts_text")
    return ents.select(
        *keep,
        F.col("ent.id").alias("alert_id"),
        merc["alert_type"].alias("alert_type"),
        hit.alias("affected_routes"),
        _nonempty_sorted(a["informed_entity"], "stop_id").alias("affected_stops"),
        epoch_lenient(first["start"]).alias("active_period_start"),
        epoch_lenient(first["end"]).alias("active_period_end"),
        pick_translation(a["header_text"]).alias("header_text"),
        pick_translation(a["description_text"]).alias("description_text"),
        epoch_lenient(merc["created_at"]).alias("created_at"),
        epoch_lenient(merc["updated_at"]).alias("updated_at"),
        feed_ts.alias("feed_timestamp"),
        iso_to_ts("_ingest_text").alias("ingest_time"))


def _hits_target() -> Column:
    return F.coalesce(F.size("affected_routes") > 0, F.lit(False))


def alert_records(ents: DataFrame, target_routes=ALERT_TARGET_ROUTES, keep=()) -> DataFrame:
    """The alerts whose routes meet the target set."""
    return alert_candidates(ents, target_routes, keep).where(_hits_target())


def _alert_missing() -> Column:
    """V2: the first required field that is missing, else NULL."""
    return _first_missing(*[(f, truthy(F.col(f)) if f == "alert_id" else F.col(f).isNotNull())
                            for f in ALERT_REQUIRED])


def _arrays_present(records: DataFrame) -> DataFrame:
    empty = F.array().cast("array<string>")
    return (records.withColumn("affected_routes", F.coalesce("affected_routes", empty))
            .withColumn("affected_stops", F.coalesce("affected_stops", empty)))


def validate_alerts(records: DataFrame) -> DataFrame:
    """V2: alert_id, feed_timestamp, ingest_time present; NULL arrays empty."""
    return _arrays_present(records.where(_alert_missing().isNull()))


def alert_outcomes(decoded: DataFrame, keys=("msg_id",), target_routes=ALERT_TARGET_ROUTES,
                   with_failed: bool = False) -> DataFrame:
    """Every alert entity with ``reject_reason``: ``no_alert`` (an entity of
    another kind), ``no_target_route`` (P9), ``missing:<field>`` (V2),
    ``json_parse_error`` or ``entity_not_a_list`` (the row of a failed
    message), or NULL for a row that reaches the table."""
    rows = _entity_rows(decoded, keys, with_failed) \
        .withColumn("_is_alert", F.col("ent.alert").isNotNull())
    reason = (F.when(F.col("failure").isNotNull(), F.col("failure"))
              .when(~F.col("_is_alert"), F.lit("no_alert"))
              .when(~_hits_target(), F.lit("no_target_route"))
              .otherwise(_alert_missing()))
    return alert_candidates(rows, target_routes, (*keys, "failure", "_is_alert")) \
        .withColumn("reject_reason", reason).drop("failure", "_is_alert")


def accepted_alerts(outcomes: DataFrame) -> DataFrame:
    """The accepted rows of ``alert_outcomes`` in table schema."""
    return conform(_arrays_present(outcomes.where(F.col("reject_reason").isNull())),
                   SERVICE_ALERTS)


def alert_rejects(decoded: DataFrame, keys=("msg_id",)) -> DataFrame:
    """Dead letters of the alerts feed: failed messages, filtered and invalid
    alerts, entities that hold no alert."""
    r = alert_outcomes(decoded, keys, with_failed=True)
    return r.where(F.col("reject_reason").isNotNull()).select(*keys, "alert_id", "reject_reason")


def alert_table(decoded: DataFrame) -> DataFrame:
    return conform(validate_alerts(alert_records(alert_entities(decoded))), SERVICE_ALERTS)


# ---------------------------------------------------------------- P11, P12
def _stop_updates(ents: DataFrame, snapshot: Column) -> DataFrame:
    t = ents.where(F.col("ent.trip_update").isNotNull())
    return t.select(snapshot.alias("snapshot"), "ent_pos", F.col("ent.trip_update.trip").alias("trip"),
                    F.posexplode("ent.trip_update.stop_time_update").alias("stop_pos", "stu"))


def _extract_base() -> list[Column]:
    return [F.col("snapshot"), F.col("ent_pos"), F.col("stop_pos"),
            F.col("trip.trip_id").alias("trip_id"),
            F.coalesce(F.col("trip.route_id"), F.lit("N/A")).alias("route_id"),
            F.col("stu.stop_id").alias("stop_id"),
            F.col("stu.arrival.time").try_cast("bigint").alias("arrival_time")]


def standard_extract(ents: DataFrame, snapshot: Column) -> DataFrame:
    """P12, standard fields alone: one row per stop update of every trip
    update, keyed by its places in the message; arrival and departure apart."""
    return _stop_updates(ents, snapshot).select(
        *_extract_base(), F.col("stu.departure.time").try_cast("bigint").alias("departure_time"))


def extension_extract(ents: DataFrame, snapshot: Column) -> DataFrame:
    """P12, with the extension fields: train, direction and tracks (NULL
    where the extension is absent); no filter on tracks."""
    return _stop_updates(ents, snapshot).select(
        *_extract_base(), F.col("trip.train_id").alias("train_id"),
        F.col("trip.direction").alias("direction"),
        F.col("stu.scheduled_track").alias("scheduled_track"),
        F.col("stu.actual_track").alias("actual_track"))


def track_rows(ents: DataFrame, snapshot: Column) -> DataFrame:
    """Stop updates that carry a scheduled or an actual track."""
    r = extension_extract(ents, snapshot)
    return r.where(truthy(F.col("scheduled_track")) | truthy(F.col("actual_track"))).select(
        "snapshot", "trip_id", "route_id", "train_id", "direction", "stop_id",
        "scheduled_track", "actual_track")


def feed_union(*feeds: DataFrame) -> DataFrame:
    """O2: UNION ALL of several feeds' message frames (same columns)."""
    out = feeds[0]
    for f in feeds[1:]:
        out = out.unionByName(f)
    return out

