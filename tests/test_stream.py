"""Stream = batch: the feed messages of the fixture land as
files in time order; the streaming job (T2 + T1 + T4) runs in many
micro-batches with a restart from its checkpoint in the middle, and its
output equals the batch as-of (J2) over the same validated rows."""

import os

from railyard.operators import parse, reports, tracks
from railyard.sources import fixtures
from railyard.sources.tables import events
from railyard.streaming import ingest


def _messages(spark, sf_dir):
    msgs = fixtures.gtfs_messages(events(spark, sf_dir)).toPandas()
    msgs["block"] = msgs["msg_id"] // 60
    return msgs


def _land(msgs, root, blocks=None):
    """Write messages as text files, one per 60 minutes of feed time and
    feed; modification times follow feed time, so files are read in order."""
    for (block, feed), g in sorted(msgs.groupby(["block", "feed"])):
        if blocks is not None and block not in blocks:
            continue
        d = os.path.join(root, feed)
        os.makedirs(d, exist_ok=True)
        p = os.path.join(d, f"{block:06d}.json")
        with open(p, "w") as f:
            f.write("\n".join(g.sort_values("msg_id")["value"]) + "\n")
        os.utime(p, (1_000_000 + block, 1_000_000 + block))


def _key(row):
    return tuple("" if v is None else str(v) for v in row)


def test_stream_equals_batch_with_restart(spark, sf_dir, tmp_path):
    land = str(tmp_path / "landing")
    msgs = _messages(spark, sf_dir)
    blocks = sorted(msgs["block"].unique())
    half = set(blocks[: len(blocks) // 2])
    _land(msgs, land, half)
    feeds = {"ace": os.path.join(land, "ace"), "bdfm": os.path.join(land, "bdfm")}
    table, ck = str(tmp_path / "vehicles"), str(tmp_path / "ck")
    q = ingest.start_enriched_vehicles(spark, feeds, table, ck, max_files_per_trigger=2,
                                       available_now=True)
    q.awaitTermination(600)
    first = spark.read.parquet(table).count()
    # the rest lands while the job is down; the restart resumes from the checkpoint
    _land(msgs, land, set(blocks) - half)
    q = ingest.start_enriched_vehicles(spark, feeds, table, ck, max_files_per_trigger=2,
                                       available_now=True)
    q.awaitTermination(600)
    got = spark.read.parquet(table).drop("event_date")
    assert got.count() > first > 0

    batch_msgs = spark.createDataFrame(msgs[["feed", "msg_id", "value"]])
    valid = parse.vehicle_table(parse.decode(batch_msgs))
    want = tracks.arrival_track_asof(valid)
    cols = sorted(want.columns)
    a = sorted(_key(r) for r in got.select(*cols).collect())
    b = sorted(_key(r) for r in want.select(*cols).collect())
    assert len(a) == len(b)
    assert a == b
    kinds = {r.enrichment for r in got.select("enrichment").distinct().collect()}
    assert kinds == {"enriched", "stale", "no_track"}


def test_raw_and_alert_sinks(spark, sf_dir, tmp_path):
    land = str(tmp_path / "landing")
    msgs = _messages(spark, sf_dir)
    _land(msgs, land)
    feeds = {"ace": os.path.join(land, "ace"), "bdfm": os.path.join(land, "bdfm")}
    q = ingest.start_raw_vehicles(spark, feeds, str(tmp_path / "raw"), str(tmp_path / "ck1"),
                                  available_now=True)
    q.awaitTermination(600)
    raw = spark.read.parquet(str(tmp_path / "raw"))
    batch = parse.vehicle_table(parse.decode(spark.createDataFrame(msgs[["feed", "msg_id", "value"]])))
    assert raw.count() == batch.count()
    assert "event_date" in raw.columns
    al = fixtures.alert_messages(events(spark, sf_dir)).toPandas()
    os.makedirs(str(tmp_path / "alerts"))
    with open(str(tmp_path / "alerts" / "a.json"), "w") as f:
        f.write("\n".join(al["value"]) + "\n")
    q = ingest.start_alerts(spark, str(tmp_path / "alerts"), str(tmp_path / "alert_tbl"),
                            str(tmp_path / "ck2"), available_now=True)
    q.awaitTermination(600)
    got = spark.read.parquet(str(tmp_path / "alert_tbl")).count()
    want = parse.alert_table(parse.decode(spark.createDataFrame(al[["msg_id", "value"]]),
                                          parse.ALERTS_MESSAGE)).count()
    assert got == want > 0


def test_alert_versions_deduplicated(spark, sf_dir, tmp_path):
    """Every alerts message lands twice (a re-poll); with L1 on, each alert
    version is appended once."""
    al = fixtures.alert_messages(events(spark, sf_dir)).toPandas()
    d = tmp_path / "alerts"
    os.makedirs(str(d))
    for name, t in (("a.json", 1_000_000), ("b.json", 1_000_100)):
        with open(str(d / name), "w") as f:
            f.write("\n".join(al["value"]) + "\n")
        os.utime(str(d / name), (t, t))
    q = ingest.start_alerts(spark, str(d), str(tmp_path / "tbl"), str(tmp_path / "ck"),
                            max_files_per_trigger=1, dedupe_delay="3650 days",
                            available_now=True)
    q.awaitTermination(600)
    got = spark.read.parquet(str(tmp_path / "tbl"))
    once = parse.alert_table(parse.decode(spark.createDataFrame(al[["msg_id", "value"]]),
                                          parse.ALERTS_MESSAGE))
    assert got.count() == once.select("alert_id", "updated_at").distinct().count() > 0
    assert got.count() == got.select("alert_id", "updated_at").distinct().count()


def test_stream_counters_observed(spark, sf_dir, tmp_path):
    """R8 on a stream: message counters arrive with each query progress."""
    msgs = _messages(spark, sf_dir)
    land = str(tmp_path / "landing")
    _land(msgs, land)
    feeds = {"ace": os.path.join(land, "ace"), "bdfm": os.path.join(land, "bdfm")}
    q = ingest.start_raw_vehicles(spark, feeds, str(tmp_path / "raw"), str(tmp_path / "ck"),
                                  available_now=True)
    q.awaitTermination(600)
    seen = [p["observedMetrics"]["feed_counters"] for p in q.recentProgress
            if "feed_counters" in p.get("observedMetrics", {})]
    ok = sum(int(m["messages_processed"]) for m in seen)
    bad = sum(int(m["parse_errors"]) for m in seen)
    assert ok + bad == len(msgs)
    assert bad == int((msgs["msg_id"] % 97 <= 5).sum()) > 0


def _observed(q, name):
    """Sum of an observed metric set over all progress reports."""
    total = {}
    for p in q.recentProgress:
        m = p.get("observedMetrics", {}).get(name)
        for k, v in (m.asDict() if hasattr(m, "asDict") else dict(m or {})).items():
            total[k] = total.get(k, 0) + int(v)
    return total


def test_all_counters_observed_equal_batch(spark, sf_dir, tmp_path):
    """What the streams observe adds up to the batch counters."""
    msgs = _messages(spark, sf_dir)
    land = str(tmp_path / "landing")
    _land(msgs, land)
    feeds = {"ace": os.path.join(land, "ace"), "bdfm": os.path.join(land, "bdfm")}
    q = ingest.start_enriched_vehicles(spark, feeds, str(tmp_path / "t"), str(tmp_path / "ck"),
                                       available_now=True)
    q.awaitTermination(600)
    al = fixtures.alert_messages(events(spark, sf_dir)).toPandas()
    os.makedirs(str(tmp_path / "alerts"))
    with open(str(tmp_path / "alerts" / "a.json"), "w") as f:
        f.write("\n".join(al["value"]) + "\n")
    qa = ingest.start_alerts(spark, str(tmp_path / "alerts"), str(tmp_path / "ta"),
                             str(tmp_path / "cka"), available_now=True)
    qa.awaitTermination(600)
    got = (_observed(q, "feed_counters") | _observed(q, "record_counters")
           | _observed(q, "enrichment_counters")
           | {f"alert_{k}": v for k, v in _observed(qa, "feed_counters").items()}
           | _observed(qa, "alert_counters"))
    want = reports.job_counters(
        parse.decode(spark.createDataFrame(msgs[["feed", "msg_id", "value"]])),
        parse.decode(spark.createDataFrame(al[["msg_id", "value"]]), parse.ALERTS_MESSAGE))
    assert got == {r.counter: r.value for r in want.collect()}
    arrivals = parse.vehicle_table(parse.decode(
        spark.createDataFrame(msgs[["feed", "msg_id", "value"]]))) \
        .where("current_status in ('STOPPED_AT', 'INCOMING_AT')").count()
    assert got["enriched_records"] + got["no_track_data"] + got["stale_track_data"] == arrivals


def test_reject_tables_equal_batch(spark, sf_dir, tmp_path):
    """The reject tables hold what the batch rejects hold."""
    msgs = _messages(spark, sf_dir)
    land = str(tmp_path / "landing")
    _land(msgs, land)
    feeds = {"ace": os.path.join(land, "ace"), "bdfm": os.path.join(land, "bdfm")}
    q = ingest.start_vehicle_rejects(spark, feeds, str(tmp_path / "r"), str(tmp_path / "ck"),
                                     available_now=True)
    q.awaitTermination(600)
    cols = ["feed", "kind", "entity_id", "trip_id", "route_id", "stop_id", "reject_reason"]
    got = sorted(_key(r) for r in spark.read.parquet(str(tmp_path / "r")).select(*cols).collect())
    batch = parse.feed_rejects(parse.decode(
        spark.createDataFrame(msgs[["feed", "msg_id", "value"]])))
    assert got == sorted(_key(r) for r in batch.select(*cols).collect())
    assert {k[-1] for k in got} >= {"json_parse_error", "missing:stop_id", "missing:time"}
    os.makedirs(str(tmp_path / "alerts"))
    al = fixtures.alert_messages(events(spark, sf_dir)).toPandas()
    with open(str(tmp_path / "alerts" / "a.json"), "w") as f:
        f.write("\n".join(al["value"]) + "\n{\n")
    q = ingest.start_alert_rejects(spark, str(tmp_path / "alerts"), str(tmp_path / "ra"),
                                   str(tmp_path / "cka"), available_now=True)
    q.awaitTermination(600)
    got = sorted(_key(r) for r in spark.read.parquet(str(tmp_path / "ra"))
                 .select("alert_id", "reject_reason").collect())
    batch = parse.alert_rejects(parse.decode(spark.createDataFrame(al[["msg_id", "value"]]),
                                             parse.ALERTS_MESSAGE))
    want = [_key(r) for r in batch.select("alert_id", "reject_reason").collect()]
    assert got == sorted(want + [("", "json_parse_error")])


def _positions_stream(spark, rows, tmp_path, name, **kw):
    """T1 over one file per feed hour; returns output rows and checkpoint."""
    from pyspark.sql import functions as F
    from railyard.schemas import VEHICLE_POSITIONS
    from railyard.streaming.enrich import enrich_tracks
    src, ck = str(tmp_path / f"{name}-src"), str(tmp_path / f"{name}-ck")
    hours = sorted(r[0] for r in rows.select(F.date_trunc("hour", "feed_timestamp")).distinct().collect())
    for i, h in enumerate(hours):
        d = os.path.join(src, f"{i:04d}")
        rows.where(F.date_trunc("hour", "feed_timestamp") == F.lit(h)).coalesce(1).write.parquet(d)
        for f in os.listdir(d):
            os.utime(os.path.join(d, f), (1_000_000 + i, 1_000_000 + i))
    stream = spark.readStream.schema(VEHICLE_POSITIONS).option("maxFilesPerTrigger", 1) \
        .option("recursiveFileLookup", True).parquet(src)
    q = (enrich_tracks(stream, **kw).writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination(600)
    return spark.table(name), ck


def test_state_as_a_table_is_the_last_update_of_each_key(spark, sf_dir, tmp_path):
    """The checkpoint read by the state source."""
    from pyspark.sql import functions as F
    from railyard.sources.tables import positions
    from railyard.streaming.enrich import held_tracks
    pos = positions(spark, sf_dir)
    _, ck = _positions_stream(spark, pos, tmp_path, "t3_all", keep_minutes=None, key_groups=16)
    cols = ["scheduled_track", "actual_track", "train_id", "nyct_direction", F.col("vehicle_timestamp").alias("cached_at"),
            F.col("feed_timestamp").alias("seen_at")]
    want = pos.where(tracks.is_track_update()).groupBy("trip_id", "stop_id").agg(F.max_by(
        F.struct(*cols), F.struct("feed_timestamp", "entity_id")).alias("s")).select("trip_id", "stop_id", "s.*")
    got = held_tracks(spark, ck)
    assert sorted(_key(r) for r in got.select(*want.columns).collect()) == sorted(_key(r) for r in want.collect())
    assert 1 < got.select("key_group").distinct().count() <= 16


def test_state_is_bounded_by_event_time(spark, sf_dir, tmp_path):
    """Old tracks leave the state; rows come out as without the bound, but for
    the label of arrivals that only had a stale one."""
    from pyspark.sql import functions as F
    from railyard.sources.tables import positions
    from railyard.streaming.enrich import held_tracks
    pos = positions(spark, sf_dir)
    out, ck = _positions_stream(spark, pos, tmp_path, "t1_kept", keep_minutes=30, key_groups=4)
    held = held_tracks(spark, ck)
    newest = pos.agg(F.max("feed_timestamp")).first()[0]
    every = pos.where(tracks.is_track_update()).select("trip_id", "stop_id").distinct().count()
    assert 0 < held.count() < every
    assert held.where(F.greatest("cached_at", "seen_at") < F.lit(newest) - F.expr("interval 60 minutes")).count() == 0
    want = tracks.arrival_track_asof(pos)
    cols = [c for c in want.columns if c != "enrichment"]
    assert sorted(_key(r) for r in out.select(*cols).collect()) == sorted(_key(r) for r in want.select(*cols).collect())
    label = {r.entity_id: r.enrichment for r in want.collect()}
    pairs = {(label[r.entity_id], r.enrichment) for r in out.collect()}
    assert pairs == {("enriched", "enriched"), ("stale", "stale"), ("stale", "no_track"), ("no_track", "no_track")}


def test_newest_before_by_hand():
    import numpy as np
    from railyard.streaming.enrich import newest_before
    rng = np.random.default_rng(6)
    for n in (0, 1, 2, 40, 300):
        code, update = rng.integers(0, 7, n), rng.random(n) < 0.4
        at, final = newest_before(code, update)
        for i in range(n):
            before = [j for j in range(i) if code[j] == code[i] and update[j]]
            assert at[i] == (before[-1] if before else -1)
        last = {c: max([j for j in range(n) if code[j] == c and update[j]], default=-1) for c in set(code.tolist())}
        assert sorted(final.tolist()) == sorted(last.values())


def _tables(spark, paths, drop=("observed_at", "event_date")):
    return [sorted(_key(r) for r in spark.read.parquet(p).drop(*drop).collect()) for p in paths]


def test_one_decode_many_sinks_and_a_batch_that_runs_twice(spark, sf_dir, tmp_path):
    msgs = _messages(spark, sf_dir)
    land = str(tmp_path / "landing")
    _land(msgs, land)
    feeds = {f: os.path.join(land, f) for f in ("ace", "bdfm")}
    paths, ck = [str(tmp_path / x) for x in ("ok", "lost", "counted")], str(tmp_path / "ck")

    def run():
        q = ingest.start_feed_tables(spark, feeds, *paths, ck, max_files_per_trigger=3, available_now=True)
        assert q.awaitTermination(600)
    run()
    dec = parse.decode(spark.createDataFrame(msgs[["feed", "msg_id", "value"]]))
    want = parse.vehicle_table(dec)
    ok = spark.read.parquet(paths[0])
    assert sorted(_key(r) for r in ok.select(*want.columns).collect()) == sorted(_key(r) for r in want.collect())
    lost = ["feed", "kind", "entity_id", "trip_id", "route_id", "stop_id", "reject_reason"]
    assert sorted(_key(r) for r in spark.read.parquet(paths[1]).select(*lost).collect()) == \
        sorted(_key(r) for r in parse.feed_rejects(dec).select(*lost).collect())
    total = {r.counter: r.n for r in spark.read.parquet(paths[2]).groupBy("counter").agg({"value": "sum"})
             .toDF("counter", "n").collect()}
    batch = {r.counter: r.value for r in reports.job_counters(dec).collect()}
    assert total == {c: batch[c] for c in total} and len(total) == 8
    before, batches = _tables(spark, paths), ok.select("batch_id").distinct().count()
    assert batches > 1
    # the driver fails between the writes and the commit: the last batch runs again
    commits = sorted((int(f) for f in os.listdir(os.path.join(ck, "commits")) if f.isdigit()))
    for f in (f"{commits[-1]}", f".{commits[-1]}.crc"):
        if os.path.exists(os.path.join(ck, "commits", f)):
            os.remove(os.path.join(ck, "commits", f))
    run()
    assert _tables(spark, paths) == before


def test_alert_tables_from_one_decode(spark, sf_dir, tmp_path):
    al = fixtures.alert_messages(events(spark, sf_dir)).toPandas()
    os.makedirs(str(tmp_path / "alerts"))
    with open(str(tmp_path / "alerts" / "a.json"), "w") as f:
        f.write("\n".join(al["value"]) + "\n{\n")
    paths = [str(tmp_path / x) for x in ("ok", "lost", "counted")]
    q = ingest.start_feed_tables(spark, {"alerts": str(tmp_path / "alerts")}, *paths, str(tmp_path / "ck"),
                                 alerts=True, available_now=True)
    assert q.awaitTermination(600)
    dec = parse.decode(spark.createDataFrame(al[["msg_id", "value"]]), parse.ALERTS_MESSAGE)
    want = parse.alert_table(dec)
    assert sorted(_key(r) for r in spark.read.parquet(paths[0]).select(*want.columns).collect()) == \
        sorted(_key(r) for r in want.collect())
    assert spark.read.parquet(paths[1]).count() == parse.alert_rejects(dec).count() + 1
    counted = {r.counter: r.value for r in spark.read.parquet(paths[2]).collect()}
    assert counted["valid_alerts"] == want.count() and counted["parse_errors"] > 1


def test_hourly_coverage_on_the_stream_equals_the_batch(spark, sf_dir, tmp_path):
    """Closed windows equal the batch report; a row behind the watermark is
    dropped and counted, one within the delay is not."""
    from pyspark.sql import functions as F
    from railyard.schemas import VEHICLE_POSITIONS
    from railyard.sources.tables import positions
    pos = positions(spark, sf_dir).where("current_status <> 'IN_TRANSIT_TO'").select(*VEHICLE_POSITIONS.names)
    src = str(tmp_path / "src")
    hours = sorted(r[0] for r in pos.select(F.date_trunc("hour", "vehicle_timestamp")).distinct().collect())
    in_hour = lambda h: F.date_trunc("hour", "vehicle_timestamp") == F.lit(h)                # noqa: E731
    late = pos.where(in_hour(hours[0])).limit(3).withColumn("entity_id", F.lit("late"))
    soon = pos.where(in_hour(hours[-2])).limit(2).withColumn("entity_id", F.lit("soon"))
    for i, h in enumerate(hours):
        part = pos.where(in_hour(h))
        if h == hours[-1]:
            part = part.unionByName(late).unionByName(soon)
        d = os.path.join(src, f"{i:04d}")
        part.coalesce(1).write.parquet(d)
        for f in os.listdir(d):
            os.utime(os.path.join(d, f), (1_000_000 + i, 1_000_000 + i))
    stream = spark.readStream.schema(VEHICLE_POSITIONS).option("maxFilesPerTrigger", 1) \
        .option("recursiveFileLookup", True).parquet(src)
    q = ingest.start_coverage(stream, str(tmp_path / "t"), str(tmp_path / "ck"), delay="90 minutes", available_now=True)
    assert q.awaitTermination(600)
    assert ingest.late_rows(q) > 0
    got = sorted(_key(r) for r in spark.read.parquet(str(tmp_path / "t")).drop("event_date").collect())
    newest = pos.agg(F.max("vehicle_timestamp")).first()[0]
    want = reports.windowed_coverage(pos.unionByName(soon)).where(
        F.col("window_end") <= F.lit(newest) - F.expr("interval 90 minutes"))
    assert got == sorted(_key(r) for r in want.collect()) and len(got) >= len(hours) - 3


def test_ghost_trains_of_the_stream_equal_the_batch(spark, sf_dir, tmp_path):
    """L7 once the watermark has passed: rows of three days, then one far
    ahead that closes them."""
    from pyspark.sql import functions as F
    from railyard.schemas import VEHICLE_POSITIONS
    from railyard.sources.tables import positions
    from railyard.streaming.ghosts import ghost_train_stream
    pos = positions(spark, sf_dir).select(*VEHICLE_POSITIONS.names)
    days = [pos.withColumn("vehicle_timestamp", F.col("vehicle_timestamp") + F.expr(f"interval {d * 17} hours"))
            .withColumn("entity_id", F.concat("entity_id", F.lit(f"d{d}"))) for d in range(3)]
    far = pos.orderBy("entity_id").limit(1).withColumn("vehicle_timestamp", F.lit("2024-02-01").cast("timestamp")) \
        .withColumn("current_status", F.lit("STOPPED_AT"))
    src = str(tmp_path / "src")
    for i, part in enumerate([*days, far]):
        d = os.path.join(src, f"{i:04d}")
        part.coalesce(1).write.parquet(d)
        for f in os.listdir(d):
            os.utime(os.path.join(d, f), (1_000_000 + i, 1_000_000 + i))
    stream = spark.readStream.schema(VEHICLE_POSITIONS).option("maxFilesPerTrigger", 1) \
        .option("recursiveFileLookup", True).parquet(src)
    q = ingest.write_table(ghost_train_stream(stream, delay="20 hours"), str(tmp_path / "t"), str(tmp_path / "ck"),
                           "predicted_arrival", available_now=True)
    assert q.awaitTermination(600)
    assert ingest.late_rows(q) == 0
    every = days[0].unionByName(days[1]).unionByName(days[2])
    want = tracks.ghost_trains(every)
    got = spark.read.parquet(str(tmp_path / "t")).select(*want.columns)
    assert sorted(_key(r) for r in got.collect()) == sorted(_key(r) for r in want.collect())
    assert 0 < got.count() < tracks.latest_prediction(every).count()
