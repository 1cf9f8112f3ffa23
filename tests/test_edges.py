"""Edge tables with hand-written answers."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from railyard.functions.columns import parse_trip_id, pick_translation
from railyard.operators import parse, reports, tracks
from railyard.schemas import VEHICLE_POSITIONS, schema_string, SERVICE_ALERTS


def test_parse_trip_id(spark):
    cases = [("060300_A..N55R", "N", "55R"), ("060300_A..S", "S", None),
             ("060300_A..X9", "U", "9"), ("060300_A..N", "N", None),
             ("060300_AN55R", "U", None), ("060300", "U", None),
             ("060300_A..", "U", None), ("a_b..S1_c", "S", "1"), ("", "U", None)]
    df = spark.createDataFrame([(c[0],) for c in cases], "t string")
    d, p = parse_trip_id(F.col("t"))
    got = {r.t: (r.d, r.p) for r in df.select("t", d.alias("d"), p.alias("p")).collect()}
    assert got == {c[0]: (c[1], c[2]) for c in cases}


def test_pick_translation(spark):
    schema = "id int, tr struct<translation:array<struct<language:string,text:string>>>"
    rows = [(1, {"translation": [{"language": "es", "text": "x"}, {"language": "en", "text": "y"}]}),
            (2, {"translation": [{"language": "fr", "text": "z"}]}),
            (3, {"translation": []}), (4, None),
            (5, {"translation": [{"language": "en", "text": None}, {"language": "es", "text": "w"}]})]
    df = spark.createDataFrame(rows, schema)
    got = dict(df.select("id", pick_translation(F.col("tr")).alias("t")).collect())
    assert got == {1: "y", 2: "z", 3: None, 4: None, 5: None}


def test_decode_rejects_and_alert_rules(spark):
    msgs = [
        (1, '{"header": {"timestamp": 1704067200}, "_ingest_time": "2024-01-01T00:00:01+00:00",'
            ' "entity": [{"id": "a1", "alert": {'
            '"informed_entity": [{"route_id": "A", "stop_id": "A1N"}, {"route_id": "7"},'
            ' {"route_id": "", "stop_id": ""}, {"route_id": "C", "stop_id": "A1N"}],'
            '"active_period": [{"start": 0, "end": "bad"}, {"start": 5}],'
            '"header_text": {"translation": [{"language": "es", "text": "x"},'
            ' {"language": "en", "text": "y"}]},'
            '"transit_realtime.mercury_alert": {"alert_type": "Delays", "created_at": "17"}}},'
            ' {"id": "a2", "alert": {"informed_entity": [{"route_id": "7"}]}},'
            ' {"id": "a3"}]}'),
        (2, '{"header": {"timest'),
    ]
    dec = parse.decode(spark.createDataFrame(msgs, "msg_id int, value string"),
                       parse.ALERTS_MESSAGE)
    assert [r.msg_id for r in parse.parse_rejects(dec, keys=("msg_id",)).collect()] == [2]
    rows = parse.alert_records(parse.alert_entities(dec)).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r.alert_id == "a1" and r.affected_routes == ["A", "C"]
    assert r.affected_stops == ["A1N"]
    assert r.active_period_start == datetime(1970, 1, 1) and r.active_period_end is None
    assert r.header_text == "y" and r.description_text is None
    assert r.created_at == datetime(1970, 1, 1, 0, 0, 17) and r.updated_at is None


def test_vehicle_validation_order(spark):
    base = dict(entity_id="e", trip_id="t_A..N1", route_id="A", start_time=None,
                start_date=None, direction="N", path_id="1", train_id=None,
                nyct_direction=None, scheduled_track=None, actual_track=None, stop_id="A1N",
                current_stop_sequence=1, current_status="STOPPED_AT",
                vehicle_timestamp=datetime(2024, 1, 1), feed_timestamp=datetime(2024, 1, 1),
                ingest_time=datetime(2024, 1, 1))
    rows = [dict(base, entity_id="ok"), dict(base, entity_id="dir", direction="Q"),
            dict(base, entity_id="route", route_id="7"),
            dict(base, entity_id="two", route_id="", stop_id=""),
            dict(base, entity_id="")]
    df = spark.createDataFrame([tuple(r[c] for c in VEHICLE_POSITIONS.names) for r in rows],
                               VEHICLE_POSITIONS)
    ok = {r.entity_id: r.direction for r in parse.validate_vehicles(df).collect()}
    assert ok == {"ok": "N", "dir": "U"}
    rej = {r.entity_id: r.reject_reason for r in parse.vehicle_rejects(df).collect()}
    assert rej == {"route": "invalid_route", "two": "missing:route_id", "": "missing:entity_id"}
    assert parse.validate_vehicles(df).count() + parse.vehicle_rejects(df).count() == len(rows)


def test_schema_strings():
    s = schema_string(SERVICE_ALERTS)
    assert s.startswith("alert_id:STRING,alert_type:STRING,affected_routes:ARRAY<STRING>")
    assert "current_stop_sequence:INTEGER" in schema_string(VEHICLE_POSITIONS)


T0 = datetime(2024, 1, 1, 10, 0, 0)


def enrichment_rows():
    """T1 rules 1-5 with ages of exactly 15 min, 15 min + 1 s and negative."""
    def row(eid, trip, stop, status, vts, feed_s, sched=None, actual=None, train=None,
            ndir=None):
        return (eid, trip, "A", None, None, "N", "1", train, ndir, sched, actual, stop, 1,
                status, vts, T0 + timedelta(seconds=feed_s), T0 + timedelta(seconds=feed_s))
    m = timedelta(minutes=1)
    return [
        row("u1", "T", "S", "IN_TRANSIT_TO", T0, 0, "F1", "F2", "t1", "NORTH"),
        row("a1", "T", "S", "STOPPED_AT", T0 + 15 * m, 10),                     # age 15:00
        row("a2", "T", "S", "STOPPED_AT", T0 + 15 * m + timedelta(seconds=1), 20),  # stale
        row("u2", "T", "S", "IN_TRANSIT_TO", T0 + 99 * m, 30),                  # no tracks
        row("a3", "T", "S", "INCOMING_AT", T0 - 10 * m, 40),                    # age -10
        row("n1", "T", "S", None, T0, 50),                                      # dropped
        row("a4", "T", "S2", "STOPPED_AT", T0, 60),                             # no state
        row("u3", "T", "S3", "IN_TRANSIT_TO", T0 + 60 * m, 70, "F3", None, "t3", "SOUTH"),
        row("a5", "T", "S3", "STOPPED_AT", T0 + 65 * m, 80, None, None, "own", None),
    ]


EXPECTED = {
    "a1": ("F1", "F2", "t1", "NORTH", "enriched"),
    "a2": (None, None, None, None, "stale"),
    "a3": ("F1", "F2", "t1", "NORTH", "enriched"),
    "a4": (None, None, None, None, "no_track"),
    "a5": ("F3", None, "own", "SOUTH", "enriched"),
}


def _got(rows):
    return {r.entity_id: (r.scheduled_track, r.actual_track, r.train_id, r.nyct_direction,
                          r.enrichment) for r in rows}


def test_asof_enrichment_rules(spark):
    df = spark.createDataFrame(enrichment_rows(), VEHICLE_POSITIONS)
    assert _got(tracks.arrival_track_asof(df).collect()) == EXPECTED


def test_stream_enrichment_rules(spark, tmp_path):
    from railyard.streaming.enrich import enrich_tracks
    src = str(tmp_path / "src")
    rows = enrichment_rows()
    # one file per row so that the stream sees several micro-batches
    for i, r in enumerate(rows):
        spark.createDataFrame([r], VEHICLE_POSITIONS).coalesce(1).write \
            .mode("append").parquet(src)
    stream = spark.readStream.schema(VEHICLE_POSITIONS).option("maxFilesPerTrigger", 3) \
        .parquet(src)
    q = (enrich_tracks(stream).writeStream.format("memory").queryName("t1_rules")
         .outputMode("append").option("checkpointLocation", str(tmp_path / "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination(180)
    assert _got(spark.table("t1_rules").collect()) == EXPECTED


def test_one_group_of_keys_folds_like_many(spark, tmp_path):
    """The rules again with all keys in one state row."""
    from railyard.streaming.enrich import enrich_tracks
    src = str(tmp_path / "src")
    for r in enrichment_rows():
        spark.createDataFrame([r], VEHICLE_POSITIONS).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(VEHICLE_POSITIONS).option("maxFilesPerTrigger", 2).parquet(src)
    q = (enrich_tracks(stream, keep_minutes=None, key_groups=1).writeStream.format("memory")
         .queryName("t1_one").outputMode("append").option("checkpointLocation", str(tmp_path / "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination(180)
    assert _got(spark.table("t1_one").collect()) == EXPECTED


def test_every_entity_is_accepted_or_rejected(spark):
    """Each candidate record has one outcome, with its reason."""
    head = '{"header": {"timestamp": 1704067200}, "_ingest_time": "2024-01-01T00:00:01+00:00",'
    trip = '"trip": {"trip_id": "060300_A..N55R", "route_id": "A"}'
    msgs = [
        (1, head + ' "entity": ['
            f'{{"id": "v1", "vehicle": {{{trip}, "stop_id": "A1N", "timestamp": 1704067200}}}},'
            '{"id": "v2", "vehicle": {"trip": {"route_id": "A"}, "stop_id": "A1N", "timestamp": 5}},'
            f'{{"id": "v3", "vehicle": {{{trip}, "stop_id": "A1N"}}}},'
            f'{{"id": "v4", "vehicle": {{{trip}, "stop_id": "A1N", "timestamp": "bad"}}}},'
            f'{{"id": "t1", "trip_update": {{{trip}, "stop_time_update": ['
            '{"stop_id": "A1N", "arrival": {"time": 1704067300}},'
            '{"stop_id": "A2N", "arrival": {"time": 0}}, {"departure": {"time": 7}}]}},'
            f'{{"id": "t2", "trip_update": {{{trip}, "stop_time_update": []}}}},'
            f'{{"id": "t3", "trip_update": {{{trip}}}}},'
            '{"id": "t4", "trip_update": {"trip": {"trip_id": "x"}, "stop_time_update": ['
            '{"stop_id": "A1N", "arrival": {"time": 1704067300}}]}},'
            '{"id": "u1", "shape": {}}]}'),
        (2, '{"header": '), (3, "null"), (4, ""), (5, None), (6, head + ' "entity": []}'),
    ]
    dec = parse.decode(spark.createDataFrame(msgs, "msg_id int, value string")
                       .withColumn("feed", F.lit("ace")))
    got = sorted((r.msg_id, r.entity_id or "", r.reject_reason) for r in
                 parse.feed_rejects(dec).collect())
    assert got == sorted([
        (1, "v2", "missing:trip_id"), (1, "v3", "missing:timestamp"),
        (1, "v4", "missing:vehicle_timestamp"), (1, "t1__A2N", "missing:time"),
        (1, "t1", "missing:stop_id"), (1, "t2", "missing:stop_time_update"),
        (1, "t3", "missing:stop_time_update"), (1, "t4__A1N", "missing:route_id"),
        (1, "u1", "unknown_entity")] + [(i, "", "json_parse_error") for i in (2, 3, 4, 5)])
    kept = sorted(r.entity_id for r in parse.vehicle_table(dec).collect())
    assert kept == ["t1__A1N", "v1"]
    every = parse.position_outcomes(dec, with_failed=True)
    assert every.count() == len(got) + len(kept)


def test_alert_rejects(spark):
    head = '"_ingest_time": "2024-01-01T00:00:01+00:00", "entity": ['
    alert = '"alert": {"informed_entity": [{"route_id": "A"}]}'
    msgs = [(1, '{"header": {"timestamp": 5}, ' + head + f'{{"id": "ok", {alert}}}, {{{alert}}},'
                ' {"id": "far", "alert": {"informed_entity": [{"route_id": "7"}]}},'
                ' {"id": "none", "alert": {}}, {"id": "other"}]}'),
            (2, '{"header": {}, ' + head + f'{{"id": "late", {alert}}}]}}'), (3, "[]")]
    dec = parse.decode(spark.createDataFrame(msgs, "msg_id int, value string"),
                       parse.ALERTS_MESSAGE)
    got = sorted((r.msg_id, r.alert_id or "", r.reject_reason)
                 for r in parse.alert_rejects(dec).collect())
    assert got == [(1, "", "missing:alert_id"), (1, "far", "no_target_route"),
                   (1, "none", "no_target_route"), (1, "other", "no_alert"),
                   (2, "late", "missing:feed_timestamp"), (3, "", "json_parse_error")]
    assert [r.alert_id for r in parse.alert_table(dec).collect()] == ["ok"]


def test_extracts_without_partner_and_sample(spark):
    """R5 counts rows that one extract lacks; J3 takes the first tracked row."""
    std = spark.createDataFrame(
        [("s", 0, 0, "t", "A", "x", 1, 2), ("s", 1, 0, "t", "A", "y", 3, None),
         ("s", 2, 0, "t", "A", "y", 4, None)],
        "snapshot string, ent_pos int, stop_pos int, trip_id string, route_id string,"
        " stop_id string, arrival_time long, departure_time long")
    ext = spark.createDataFrame(
        [("s", 1, 0, "t", "A", "y", 3, None, None, None, "F1"),
         ("s", 9, 0, "t", "A", "q", 3, "0A", "N", None, "F2"),
         ("z", 0, 0, None, "A", "q", 3, "0A", "N", None, "")],
        "snapshot string, ent_pos int, stop_pos int, trip_id string, route_id string,"
        " stop_id string, arrival_time long, train_id string, direction string,"
        " scheduled_track string, actual_track string")
    r = {x.snapshot: x for x in reports.extractor_comparison(std, ext).collect()}
    assert (r["s"].current_rows, r["s"].extension_rows, r["s"].current_only,
            r["s"].extension_only, r["s"].with_actual) == (3, 2, 2, 1, 2)
    assert (r["ALL"].current_rows, r["ALL"].extension_rows, r["ALL"].extension_only) == (3, 3, 2)
    m = {x.snapshot: x for x in reports.sample_match(std, ext).collect()}
    assert (m["s"].stop_id, m["s"].current_arrival_time) == ("y", 3)
    assert m["z"].actual_track == "" and m["z"].current_route_id is None


def test_alert_periods_of_every_length(spark):
    """L4 against every (arrival, alert) pair tried by hand: minutes, hours
    with both ends on the hour, weeks, open, empty, reversed, no start."""
    import datetime as dt

    from railyard.operators.planned import arrivals_under_alert
    t0 = dt.datetime(2024, 1, 1)
    h = dt.timedelta(hours=1)
    arr = [(f"e{i}", "AC"[i % 2], "s1", t0 + i * 7 * h) for i in range(120)] + [("n", "A", "s1", None),
                                                                             ("m", None, "s1", t0)]
    spans = [(0 * h, h / 2), (7 * h, 14 * h), (7 * h, 55 * h), (7 * h, 56 * h), (21 * h, 500 * h), (49 * h, None),
             (63 * h, 63 * h), (70 * h, 63 * h), (None, 90 * h), (-900 * h, 9000 * h)]
    alerts = [(f"a{i}", "x", ["A"] if i % 3 else ["A", "C"], None if a is None else t0 + a,
               None if b is None else t0 + b) for i, (a, b) in enumerate(spans)]
    want = sorted((e, a) for e, r, _, t in arr for a, _, routes, s, end in alerts
                  if t and r in routes and s and s <= t and (end is None or t < end))
    got = arrivals_under_alert(
        spark.createDataFrame(arr, "entity_id string, route_id string, stop_id string, vehicle_timestamp timestamp"),
        spark.createDataFrame(alerts, "alert_id string, alert_type string, affected_routes array<string>, "
                                      "active_period_start timestamp, active_period_end timestamp"))
    assert sorted((r["entity_id"], r["alert_id"]) for r in got.collect()) == want


HEAD = '{"header": {"timestamp": 1704067200}, "_ingest_time": "2024-01-01T00:00:01+00:00", "entity": '


def vehicle(i, **over):
    import json
    v = {"trip": {"trip_id": "060300_A..N55R", "route_id": "A"}, "stop_id": "A1N", "timestamp": 1704067200} | over
    return json.dumps({"id": i, "vehicle": v})


def feed(spark, msgs):
    df = spark.createDataFrame(list(enumerate(msgs)), "msg_id int, value string")
    return parse.decode(df.withColumn("feed", F.lit("ace")))


def test_an_entity_of_the_wrong_type_costs_only_itself(spark):
    stops = '"stop_time_update": [7, {"stop_id": "A1N", "arrival": {"time": 1704067300}}, null,' \
            ' {"stop_id": "A2N", "arrival": "soon", "departure": {"time": "1704067300"}}]'
    dec = feed(spark, [
        HEAD + f'["x", {vehicle("v1")}, 7, null, [1], {vehicle("v2")}]}}',
        HEAD + f'{{"id": "o", "vehicle": {vehicle("v")}}}}}', HEAD + "null}", HEAD + '"text"}', HEAD + "[]}",
        '{"header": 3, "_ingest_time": {}, "entity": [' + vehicle("v3") + "]}", "{}",
        HEAD + f'[{vehicle("v4", trip="A")}, {vehicle("v5", stop_id=None)}, {{"id": "v6", "vehicle": "here"}},'
               f' {{"id": "v7", "vehicle": null}}, {vehicle("v8", current_stop_sequence="2.5")}]}}',
        HEAD + '[{"id": "t1", "trip_update": {"trip": {"trip_id": "x_A..N1", "route_id": "A"}, ' + stops + "}},"
               ' {"id": "t2", "trip_update": {"trip": {"trip_id": "x", "route_id": "A"}, "stop_time_update": {}}}]}',
    ])
    rejects = sorted((r.msg_id, r.kind, r.entity_id or "", r.reject_reason) for r in parse.feed_rejects(dec).collect())
    assert rejects == sorted(
        [(0, "unknown", "", "unknown_entity")] * 4
        + [(i, "message", "", "entity_not_a_list") for i in (1, 2, 3)]
        + [(5, "vehicle", "v3", "missing:feed_timestamp"), (7, "vehicle", "v4", "missing:trip_id"),
           (7, "vehicle", "v5", "missing:stop_id"), (7, "vehicle", "v6", "missing:trip_id"),
           (7, "unknown", "v7", "unknown_entity"), (8, "trip_update", "t1", "missing:stop_id"),
           (8, "trip_update", "t1", "missing:stop_id"), (8, "trip_update", "t2", "missing:stop_time_update")])
    kept = {r.entity_id: r.current_stop_sequence for r in parse.vehicle_table(dec).collect()}
    assert kept == {"v1": None, "v2": None, "v8": None, "t1__A1N": None, "t1__A2N": None}
    every = parse.position_outcomes(dec, with_failed=True)
    assert every.count() == len(rejects) + len(kept)


def test_a_message_is_one_object_and_nothing_else(spark):
    doc = HEAD + f'[{vehicle("v")}]}}'
    bad = [doc + " x", doc + "]", doc + "]{}", doc + "}", doc + "," + doc, doc + ', "m": {}', doc + ', "z": 1}',
           f"[{doc}]", f'"{"a"}"', "null", "7", "", "  ", None, doc[:-1], doc[:-2], "{", "NaN", "{'a': 1}"]
    good = [doc, f" \t\r\n{doc}\n ", '{"header": {"timestamp": 1}, "header": {"timestamp": 1704067200}, ' + doc[1:]]
    dec = feed(spark, bad + good)
    assert [r.msg_id for r in dec.where("msg_ok").orderBy("msg_id").collect()] == [*range(len(bad), len(bad + good))]
    assert {r.feed_timestamp for r in parse.vehicle_table(dec).collect()} == {datetime(2024, 1, 1)}
    twice = '{"header": {"timestamp": 1704067200}, "entity": [], "entity": [' + vehicle("w") + "]}"
    assert feed(spark, [twice]).selectExpr("size(msg.entity)").first()[0] == 1


def test_epochs_outside_the_calendar_are_null(spark):
    from railyard.functions.columns import epoch_text_to_ts
    cases = {"1704067200": True, "1704067200.25": True, "-62135596800": True, "-62135596801": False,
             "253402300799": True, "253402300800": False, "1704067200000000": False, "9999999999999999": False,
             "1704067200000000000": False, "99999999999999999999": False, "1e300": False, "-1e300": False,
             "1.7e9": True, "NaN": False, "Infinity": False, "soon": False, "": False, "-5": True, "0": True}
    df = spark.createDataFrame([(c,) for c in [*cases, None]], "t string")
    got = {r.t: r.ok for r in df.select("t", epoch_text_to_ts("t").isNotNull().alias("ok")).collect()}
    assert got == cases | {None: False}
    dec = feed(spark, [HEAD + f'[{vehicle("big", timestamp=9999999999999999)}, {vehicle("ok")}]}}',
                       (HEAD + f'[{vehicle("w")}]}}').replace("1704067200}", "1704067200000000}", 1)])
    assert [r.entity_id for r in parse.vehicle_table(dec).collect()] == ["ok"]
    assert sorted((r.entity_id, r.reject_reason) for r in parse.feed_rejects(dec).collect()) == [
        ("big", "missing:vehicle_timestamp"), ("w", "missing:feed_timestamp")]


def test_dyadic_blocks_compare_little_more_than_they_match(spark):
    """L4 over three years: alerts of hours, days, years and without an end;
    the pairs compared and the blocks of an alert stay few."""
    import math
    import random
    from railyard.operators import planned
    rng, t0, h = random.Random(8), datetime(2022, 1, 1), timedelta(hours=1)
    arr = [(f"e{i}", rng.choice("AACD"), "s", t0 + timedelta(seconds=rng.randrange(3 * 365 * 86_400)))
           for i in range(3000)]
    spans = [(i * 700 * h + timedelta(seconds=rng.randrange(3600)), n * h) for i, n in
             enumerate([3, 3, 3, 72, 72, 72, 24 * 400, 24 * 1095, 24 * 2000, 0.25, 1 / 3600, 700])]
    alerts = [(f"a{i}", "x", ["A", "C"] if i % 2 else ["A"], t0 + s, t0 + s + n) for i, (s, n) in enumerate(spans)]
    alerts += [("open", "x", ["C"], t0 + 9000 * h, None), ("early", "x", ["A"], t0 - 9000 * h, t0 - h),
               ("late", "x", ["A"], t0 + 99_999 * h, None), ("wide", "x", ["D"], datetime(1960, 1, 1), datetime(9999, 1, 1))]
    v = spark.createDataFrame(arr, "entity_id string, route_id string, stop_id string, vehicle_timestamp timestamp")
    a = spark.createDataFrame(alerts, "alert_id string, alert_type string, affected_routes array<string>, "
                                      "active_period_start timestamp, active_period_end timestamp")
    want = sorted((e, i) for e, r, _, t in arr for i, _, routes, s, end in alerts
                  if r in routes and s <= t and (end is None or t < end))
    assert sorted((r.entity_id, r.alert_id) for r in planned.arrivals_under_alert(v, a).collect()) == want
    compared = planned.alert_candidates(v, a)
    assert len(want) <= compared.count() <= 1.01 * len(want) + 20
    assert compared.select("entity_id", "alert_id").distinct().count() == compared.count()
    lo, hi = (F.lit(x) for x in (min(t for *_, t in arr), max(t for *_, t in arr)))
    cells = 3 * 365 * 96
    per = planned.alert_blocks(a, lo, hi).groupBy("alert_id", "_route").count().collect()
    assert max(r["count"] for r in per) <= 2 * math.log2(cells) + cells / 2 ** planned.TOP_LEVEL
    assert planned.arrivals_under_alert(v.limit(0), a).count() == 0
    assert planned.arrivals_under_alert(v, a.limit(0)).count() == 0


def test_alert_history_merges_equal_versions(spark):
    from railyard.operators import planned
    from railyard.schemas import SERVICE_ALERTS
    t0, h = datetime(2024, 1, 1), timedelta(hours=1)

    def version(i, at, kind, start=None, end=None, header="x"):
        return (i, kind, ["A"], [], start, end, header, None, None, t0 + at, t0 + at, t0 + at)
    rows = [version("p", n * h, "Delays", t0 + 5 * h, None) for n in range(0, 60)]
    rows += [version("p", n * h, "Delays", t0 + 5 * h, t0 + 70 * h) for n in range(60, 62)]
    rows += [version("p", 62 * h, "Delays", t0 + 5 * h, None), version("q", 3 * h, None), version("q", 4 * h, "Notice"),
             version("q", 4 * h, "Notice", header="a"), version("q", 4 * h, "Notice")]
    a = spark.createDataFrame(rows, SERVICE_ALERTS)
    hist = planned.alert_history(a)
    got = sorted(((r.alert_id, r.valid_from, r.valid_to, r.alert_type, r.active_period_end) for r in hist.collect()),
                 key=str)
    assert got == sorted([
        ("p", t0, t0 + 60 * h, "Delays", None), ("p", t0 + 60 * h, t0 + 62 * h, "Delays", t0 + 70 * h),
        ("p", t0 + 62 * h, None, "Delays", None), ("q", t0 + 3 * h, t0 + 4 * h, None, None),
        ("q", t0 + 4 * h, None, "Notice", None)], key=str)
    times = [t0 - h, t0, t0 + 5 * h, t0 + 60 * h, t0 + 61.5 * h, t0 + 100 * h]
    states = sorted((r.as_of, r.alert_id, r.state) for r in planned.alert_states(
        hist, F.array(*[F.lit(t) for t in times])).collect())
    assert states == sorted(
        [(times[1], "p", "future"), (times[2], "p", "active"), (times[3], "p", "active"), (times[4], "p", "active"),
         (times[5], "p", "active")] + [(t, "q", "unknown") for t in times[2:]])
    assert planned.alert_history(a.limit(0)).count() == 0


def test_lag_sketches_answer_any_range(spark, tmp_path):
    """Merged daily sketches against the exact quantiles of the range;
    a day that comes later is added without reading the others again."""
    import random
    from railyard.operators import planned
    rng, t0 = random.Random(2), datetime(2024, 1, 1)
    rows = [(t0 + timedelta(days=d, seconds=i), t0 + timedelta(days=d, seconds=i + rng.expovariate(1 / (5 + 20 * d))))
            for d in range(5) for i in range(4000)] + [(t0, None), (None, t0)]
    df = spark.createDataFrame(rows, "feed_timestamp timestamp, ingest_time timestamp")
    early = F.col("feed_timestamp") < F.lit(t0 + timedelta(days=3))
    path = str(tmp_path / "sketches")
    planned.lag_sketches(df.where(early)).write.parquet(path)
    planned.lag_sketches(df.where(~early)).write.mode("append").parquet(path)
    stored = spark.read.parquet(path)
    assert stored.count() == 5
    for a, b in ((0, 4), (1, 2), (3, 3)):
        lags = sorted((i - f).total_seconds() for f, i in rows if f and i and a <= (f - t0).days <= b)
        r = planned.lag_over(stored, (t0 + timedelta(days=a)).date(), (t0 + timedelta(days=b)).date(), (0.1, 0.5, 0.95)).first()
        assert (r.n, r.min_lag_s, r.max_lag_s) == (len(lags), lags[0], lags[-1])
        for q, got in ((0.1, r.p10_lag_s), (0.5, r.p50_lag_s), (0.95, r.p95_lag_s)):
            assert abs(sum(x <= got for x in lags) / len(lags) - q) < 0.015
    assert planned.lag_over(stored, "2030-01-01", "2030-01-02").count() == 0
