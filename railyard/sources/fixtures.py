"""Transit-shaped data derived from the driver's ``events`` table.

The reference ships no data, so every input here is computed by Spark from
``events`` (one row per event, so the work grows with the table):

* ``raw_positions`` -- the validated ``vehicle_positions`` table, one row per
  event.  Defined in FIXTURES.md and mirrored by the DuckDB oracle.
* ``gtfs_messages`` -- JSON feed messages (two feeds) built with ``to_json``
  from the same events, with derived defects (``ENTITY_DEFECTS``,
  ``MESSAGE_DEFECTS`` and the rules of ``gtfs_entities``).
* ``alert_messages`` -- alerts feed messages built from ``signup`` events,
  with defects of their own.

All rules are functions of event columns only; the oracle SQL repeats them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the fixture (FIXTURES.md).
BASE_EPOCH = 1704067200          # 2024-01-01T00:00:00Z, time of message 0
ROUTE_LETTERS = "ACEBDFMS"        # route = letter (user_id % 8) + 1
ACE_ROUTES = ("A", "C", "E")      # feed "ace"; every other route is "bdfm"
ALERT_EXTRA_ROUTES = "ACEBDFMS7G"  # second informed route, letter (k % 10) + 1
# Defect of an entity by event_id % 31 and of a message by msg_id % 97.
ENTITY_DEFECTS = {0: "a text", 1: "neither kind", 2: "no trip id", 3: "times in microseconds", 4: "mistyped",
                  5: "vehicle null", 6: "times that are words", 7: "no id"}
MESSAGE_DEFECTS = {0: "cut in half", 1: "null", 2: "blank", 3: "text behind it", 4: "in a list",
                   5: "closing bracket behind it", 6: "header twice", 7: "entity is no list",
                   8: "header time in microseconds"}
ALERT_TYPES = ("Delays", "Planned - Part Suspended", "Station Notice")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def event_base(events: DataFrame) -> DataFrame:
    """Per-event transit attributes shared by every fixture."""
    e = events.select(
        "event_id", "user_id", "event_type", _k().alias("k"),
        F.expr("event_id div 2").alias("msg_id"))
    route = F.substring(F.lit(ROUTE_LETTERS),
                        (F.col("user_id") % 8).cast("int") + 1, 1)
    direction = F.when((F.expr("user_id div 8") % 2) == 0,
                       F.lit("N")).otherwise(F.lit("S"))
    status = (F.when(F.col("event_type").isin("view", "error"), F.lit("IN_TRANSIT_TO"))
              .when(F.col("event_type") == "click", F.lit("STOPPED_AT"))
              .when(F.col("event_type") == "purchase", F.lit("INCOMING_AT")))
    feed_epoch = F.lit(BASE_EPOCH) + F.col("msg_id") * 60
    return e.select(
        "*", route.alias("route"), direction.alias("dir"), status.alias("st"),
        feed_epoch.alias("feed_epoch"))


def _positions_columns(b: DataFrame) -> DataFrame:
    transit = F.col("st") == "IN_TRANSIT_TO"
    k = F.col("k")
    veh_epoch = F.when(transit, F.col("feed_epoch") + k * 10) \
        .otherwise(F.col("feed_epoch"))
    return b.select(
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("entity_id"),
        F.concat(F.lit("060300_"), "route", F.lit(".."), "dir", F.lit("55R")).alias("trip_id"),
        F.col("route").alias("route_id"),
        F.when(transit, F.lit("06:03:00")).alias("start_time"),
        F.when(transit, F.date_format(F.timestamp_seconds("feed_epoch"), "yyyyMMdd"))
        .alias("start_date"),
        F.col("dir").alias("direction"),
        F.lit("55R").alias("path_id"),
        F.when(transit & (k % 7 != 0),
               F.concat(F.lit("0"), "route", F.lit(" "),
                        (F.col("user_id") % 50).cast("string"))).alias("train_id"),
        F.when(transit, F.when(F.col("dir") == "N", F.lit("NORTH"))
               .otherwise(F.lit("SOUTH"))).alias("nyct_direction"),
        F.when(transit & (k % 2 == 0),
               F.concat(F.lit("F"), (k % 3).cast("string"))).alias("scheduled_track"),
        F.when(transit & (k % 5 != 0),
               F.concat(F.lit("F"), (k % 3 + 1).cast("string"))).alias("actual_track"),
        F.concat("route", (k % 4).cast("string"), "dir").alias("stop_id"),
        (k % 4 + 1).cast("bigint").alias("current_stop_sequence"),
        F.col("st").alias("current_status"),
        F.timestamp_seconds(veh_epoch).alias("vehicle_timestamp"),
        F.timestamp_seconds("feed_epoch").alias("feed_timestamp"),
        F.timestamp_micros((F.col("feed_epoch") + 1 + F.col("msg_id") % 7) * 1_000_000
                           + 250_000).alias("ingest_time"),
        # carried for the message builder, dropped by raw_positions()
        "event_id", "msg_id", "user_id", "k", "route", "dir", "st", "feed_epoch",
        veh_epoch.alias("veh_epoch"),
    )


def raw_positions(events: DataFrame) -> DataFrame:
    """The validated ``vehicle_positions`` table of FIXTURES.md, every status."""
    from ..schemas import VEHICLE_COLUMNS
    return _positions_columns(event_base(events)).select(*VEHICLE_COLUMNS)


def _iso_ingest(c: Column) -> Column:
    return F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def gtfs_entities(events: DataFrame) -> DataFrame:
    """One feed entity (JSON text) per event, with its message key and feed."""
    p = _positions_columns(event_base(events))
    k, uid, defect = F.col("k"), F.col("user_id"), F.col("event_id") % 31
    transit = F.coalesce(F.col("st") == "IN_TRANSIT_TO", F.lit(False))
    # derived defects
    msg_route = F.when(uid % 23 == 0, F.lit("G")).otherwise(F.col("route"))
    trip_text = (F.when(defect == 2, F.lit(None))
                 .when(uid % 37 == 0, F.concat(F.lit("060300_"), "route", "dir", F.lit("55R")))
                 .when(uid % 19 == 0, F.concat(F.lit("060300_"), "route", F.lit("..X55R")))
                 .otherwise(F.col("trip_id")))
    trip = F.struct(
        trip_text.alias("trip_id"), msg_route.alias("route_id"),
        F.col("start_time"), F.col("start_date"),
        F.col("train_id"), F.col("nyct_direction").alias("direction"))
    entity_id = F.when(defect != 7, F.col("entity_id")).alias("id")

    def entity(as_text: bool):
        def at(epoch):
            t = F.when(defect == 3, epoch * 1_000_000).otherwise(epoch)
            return F.when(defect == 6, F.lit("soon")).otherwise(t.cast("string")) if as_text else t
        ve, zero = F.col("veh_epoch"), F.lit("0") if as_text else F.lit(0).cast("bigint")
        kind = "string" if as_text else "bigint"
        departs = F.struct(at(ve + 30).alias("time"))
        first = F.struct(
            F.col("stop_id"), F.col("current_stop_sequence").alias("stop_sequence"),
            F.when(k % 13 != 0, F.struct(F.when(k % 3 == 0, zero).otherwise(at(ve)).alias("time"))).alias("arrival"),
            F.when(k % 13 != 0, departs).alias("departure"),
            F.col("scheduled_track"), F.col("actual_track"))
        second = F.struct(
            F.concat("route", ((k + 1) % 4).cast("string"), "dir").alias("stop_id"),
            (F.col("current_stop_sequence") + 1).alias("stop_sequence"),
            F.struct(at(ve + 120).alias("time")).alias("arrival"),
            F.lit(None).cast(f"struct<time:{kind}>").alias("departure"),
            F.col("scheduled_track"), F.col("actual_track"))
        updates = F.when(k % 4 == 1, F.array(first, second)).otherwise(F.array(first))
        vehicle = F.struct(
            F.struct(trip_text.alias("trip_id"), msg_route.alias("route_id")).alias("trip"),
            F.col("current_stop_sequence"), F.when(k % 11 != 0, F.col("stop_id")).alias("stop_id"),
            F.col("current_status"), at(ve).alias("timestamp"))
        # to_json leaves out NULL fields, so each entity has one of the two keys
        return F.to_json(F.struct(
            entity_id, F.when(~transit, vehicle).alias("vehicle"),
            F.when(transit, F.struct(trip.alias("trip"), updates.alias("stop_time_update"))).alias("trip_update")))

    mistyped = F.to_json(F.struct(
        entity_id, F.when(~transit, F.struct(F.col("route").alias("trip"), F.when(k % 11 != 0, F.col("stop_id"))
                                             .alias("stop_id"))).alias("vehicle"),
        F.when(transit, F.struct(trip.alias("trip"), F.struct("stop_id").alias("stop_time_update")))
        .alias("trip_update")))
    text = (F.when(defect == 0, F.to_json(F.array("entity_id")).substr(F.lit(2), F.length("entity_id") + 2))
            .when(defect == 1, F.to_json(F.struct(entity_id)))
            .when(defect == 4, mistyped)
            .when(defect == 5, F.concat(F.lit('{"id":"'), "entity_id", F.lit('","vehicle":null}')))
            .when((defect == 6) | (F.col("event_id") % 5 == 4), entity(True)).otherwise(entity(False)))
    feed = F.when(F.col("route").isin(*ACE_ROUTES), F.lit("ace")).otherwise(F.lit("bdfm"))
    return p.select(feed.alias("feed"), "msg_id", "event_id", "feed_epoch",
                    F.col("ingest_time"), text.alias("entity"))


def gtfs_messages(events: DataFrame) -> DataFrame:
    """Feed messages as JSON text: ``(feed, msg_id, value)``.

    One message per (feed, minute), with the defects of ``MESSAGE_DEFECTS``.
    Entities are ordered by event.
    """
    ent = gtfs_entities(events)
    msgs = ent.groupBy("feed", "msg_id").agg(
        F.min("feed_epoch").alias("feed_epoch"),
        F.min("ingest_time").alias("ingest_time"),
        F.array_sort(F.collect_list(F.struct("event_id", "entity"))).alias("ents"))
    defect = F.col("msg_id") % 97
    header = F.concat(F.lit('"header":{"gtfs_realtime_version":"2.0","timestamp":'),
                      (F.col("feed_epoch") * F.when(defect == 8, 1_000_000).otherwise(1)).cast("string"), F.lit("},"))
    texts = F.transform("ents", lambda x: x["entity"])
    listed = F.concat(F.lit("["), F.array_join(texts, ","), F.lit("]"))
    doc = F.concat(F.lit("{"), F.when(defect == 6, F.lit('"header":{"timestamp":1},')).otherwise(F.lit("")), header,
                   F.lit('"_ingest_time":"'), _iso_ingest(F.col("ingest_time")), F.lit('","entity":'),
                   F.when(defect == 7, F.get(texts, 0)).otherwise(listed), F.lit("}"))
    value = (F.when(defect == 0, F.substring(doc, F.lit(1), (F.length(doc) / 2).cast("int")))
             .when(defect == 1, F.lit("null")).when(defect == 2, F.lit(" "))
             .when(defect == 3, F.concat(doc, F.lit(" and more"))).when(defect == 4, F.concat(F.lit("["), doc, F.lit("]")))
             .when(defect == 5, F.concat(doc, F.lit("]{}"))).otherwise(doc))
    return msgs.select("feed", "msg_id", value.alias("value"))


def alert_messages(events: DataFrame) -> DataFrame:
    """Alerts feed messages ``(msg_id, value)`` from ``signup`` events, one
    message per hour of events (``event_id div 120``).

    Defects by event_id % 17: 0 no alert, 1 a text, 2 created_at in
    microseconds, 3 informed_entity no list; by message % 13: 1 cut in half,
    2 text behind it; by message % 11: 0 header without a time."""
    b = event_base(events).where(F.col("event_type") == "signup")
    k, uid, eid = F.col("k"), F.col("user_id"), F.col("event_id").cast("string")
    stop = F.concat("route", (k % 4).cast("string"), "dir")
    extra = F.substring(F.lit(ALERT_EXTRA_ROUTES), (k % 10) + 1, 1)
    informed = (F.when(uid % 5 == 0, F.array(F.struct(
        F.lit("7").alias("route_id"), F.lit("701N").alias("stop_id"))))
        .when(k % 6 == 0, F.array(
            F.struct(F.col("route").alias("route_id"), stop.alias("stop_id")),
            F.struct(F.lit("").alias("route_id"), F.lit("").alias("stop_id"))))
        .otherwise(F.array(
            F.struct(F.col("route").alias("route_id"), stop.alias("stop_id")),
            F.struct(extra.alias("route_id"), F.lit(None).cast("string").alias("stop_id")))))
    start = F.col("feed_epoch")
    one = F.array(F.struct(start.alias("start"), F.lit(None).cast("bigint").alias("end")))
    period = (F.when(k % 10 == 0, F.filter(one, lambda x: F.lit(False)))
              .when(k % 9 == 0, F.array(F.struct(start.alias("start"),
                                                 F.lit(None).cast("bigint").alias("end"))))
              .otherwise(F.array(F.struct(start.alias("start"),
                                          (start + 3600 * (1 + k % 4)).alias("end")))))
    tr = "array<struct<language:string,text:string>>"
    header = (F.when(k % 7 == 0, F.lit(None).cast(f"struct<translation:{tr}>"))
              .when(k % 2 == 0, F.struct(F.array(
                  F.struct(F.lit("es").alias("language"), F.concat(F.lit("Aviso "), eid).alias("text")),
                  F.struct(F.lit("en").alias("language"), F.concat(F.lit("Alert "), eid).alias("text"))
              ).alias("translation")))
              .otherwise(F.struct(F.array(
                  F.struct(F.lit("fr").alias("language"), F.concat(F.lit("Avis "), eid).alias("text"))
              ).alias("translation"))))
    desc = F.when(k % 3 == 0, F.struct(F.array(F.struct(
        F.lit("en").alias("language"), F.lit(None).cast("string").alias("text"))).alias("translation"))) \
        .otherwise(F.struct(F.array(F.struct(
            F.lit("en").alias("language"), F.concat(F.lit("Delays on "), "route").alias("text")
        )).alias("translation")))
    atype = F.element_at(F.array(*[F.lit(t) for t in ALERT_TYPES]), (k % 3 + 1).cast("int"))
    defect = F.col("event_id") % 17
    created = (start - 600) * F.when(defect == 2, 1_000_000).otherwise(1)
    mercury = F.struct(atype.alias("alert_type"), created.alias("created_at"),
                       (start - 60).alias("updated_at"))
    alert_id = F.concat(F.lit("a"), uid.cast("string")).alias("id")

    def entity(informed):
        return F.to_json(F.struct(alert_id, F.struct(
            informed.alias("informed_entity"), period.alias("active_period"),
            header.alias("header_text"), desc.alias("description_text"),
            mercury.alias("transit_realtime.mercury_alert")).alias("alert")))

    text = (F.when(defect == 0, F.to_json(F.struct(alert_id)))
            .when(defect == 1, F.concat(F.lit('"a'), uid.cast("string"), F.lit('"')))
            .when(defect == 3, entity(F.get(informed, 0))).otherwise(entity(informed)))
    amsg = F.expr("event_id div 120")
    msgs = b.select(amsg.alias("msg_id"), "event_id", text.alias("entity")) \
        .groupBy("msg_id").agg(
            F.array_sort(F.collect_list(F.struct("event_id", "entity"))).alias("ents"))
    feed_epoch = F.lit(BASE_EPOCH) + F.col("msg_id") * 3600
    time = F.when(F.col("msg_id") % 11 == 0, F.lit("")) \
        .otherwise(F.concat(F.lit('"timestamp":'), feed_epoch.cast("string")))
    doc = F.concat(F.lit('{"header":{'), time, F.lit('},"_ingest_time":"'),
                   _iso_ingest(F.timestamp_seconds(feed_epoch + 2)), F.lit('","entity":['),
                   F.array_join(F.transform("ents", lambda x: x["entity"]), ","), F.lit("]}"))
    value = (F.when(F.col("msg_id") % 13 == 1, F.substring(doc, F.lit(1), (F.length(doc) / 2).cast("int")))
             .when(F.col("msg_id") % 13 == 2, F.concat(doc, F.lit(" and more"))).otherwise(doc))
    return msgs.select("msg_id", value.alias("value"))
