"""Continuous ingest (T2, T4, T5): feed landing folders to tables.

Sources are text files of JSON messages, one message per line, in one
landing folder per feed (a broker source is a deployment choice: the same
frames come from ``readStream.format("kafka")`` where its jar is installed).
Sinks are file tables with a checkpoint: a restarted query resumes from the
checkpoint and its appends are exactly-once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import parse, reports
from ..schemas import ALERTS_MESSAGE
from .enrich import KEEP_MINUTES, enrich_tracks

DEFAULT_TRIGGER = "30 seconds"     # the poll interval of the feeds


def feed_stream(spark: SparkSession, path: str, feed: str,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Messages landing in ``path`` as ``(feed, msg_id, value)``;
    ``msg_id`` is the file name and a hash of the text, so two equal lines
    of one file share it."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.load(path)
    return df.select(F.lit(feed).alias("feed"),
                     F.concat(F.col("_metadata.file_name"), F.lit("#"),
                              F.xxhash64("value").cast("string")).alias("msg_id"),
                     "value")


def vehicle_stream(feeds: list[DataFrame]) -> DataFrame:
    """Union of the GTFS feeds (O2), decoded, flattened and validated.
    The R8 counters of both steps are observed on the way."""
    dec = parse.decode(parse.feed_union(*feeds)) \
        .observe("feed_counters", *reports.message_counters())
    out = parse.position_outcomes(dec).observe("record_counters", *reports.record_counters())
    return parse.accepted_positions(out)


def alert_stream(feed: DataFrame) -> DataFrame:
    """T2 for the alerts feed, with its R8 counters."""
    dec = parse.decode(feed, ALERTS_MESSAGE).observe("feed_counters", *reports.message_counters())
    out = parse.alert_outcomes(dec).observe("alert_counters", *reports.alert_counters())
    return parse.accepted_alerts(out)


def vehicle_reject_stream(feeds: list[DataFrame]) -> DataFrame:
    """Dead letters of the GTFS feeds (``parse.feed_rejects``) with the time
    of rejection."""
    return parse.feed_rejects(parse.decode(parse.feed_union(*feeds))) \
        .withColumn("rejected_at", F.current_timestamp())


def alert_reject_stream(feed: DataFrame) -> DataFrame:
    """Dead letters of the alerts feed (``parse.alert_rejects``)."""
    return parse.alert_rejects(parse.decode(feed, ALERTS_MESSAGE)) \
        .withColumn("rejected_at", F.current_timestamp())


def dedupe_alert_versions(alerts: DataFrame, delay: str = "6 hours") -> DataFrame:
    """L1 on a stream: each poll re-sends every active alert, so one version
    of an alert (alert_id, updated_at) is kept once.  The watermark on
    feed_timestamp bounds the dedup state; a copy arriving later than
    ``delay`` behind the newest feed time is dropped as late."""
    return (alerts.withWatermark("feed_timestamp", delay)
            .dropDuplicatesWithinWatermark(["alert_id", "updated_at"]))


def write_table(df: DataFrame, path: str, checkpoint: str, time_col: str,
                trigger: str | None = DEFAULT_TRIGGER, available_now: bool = False,
                query_name: str | None = None):
    """Append to a day-partitioned parquet table with a checkpoint.
    ``available_now`` processes what has landed and stops (tests, backfill)."""
    w = (df.withColumn("event_date", F.to_date(F.col(time_col)))
         .writeStream.format("parquet").outputMode("append")
         .option("path", path).option("checkpointLocation", checkpoint)
         .partitionBy("event_date"))
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()


def start_raw_vehicles(spark, feed_dirs: dict[str, str], table: str, checkpoint: str,
                       max_files_per_trigger: int | None = None, **kw):
    """T5: validated rows of every status, unenriched (feeds the J1 view)."""
    feeds = [feed_stream(spark, p, f, max_files_per_trigger) for f, p in feed_dirs.items()]
    return write_table(vehicle_stream(feeds), table, checkpoint, "vehicle_timestamp", **kw)


def start_enriched_vehicles(spark, feed_dirs: dict[str, str], table: str, checkpoint: str,
                            max_files_per_trigger: int | None = None,
                            keep_minutes: float | None = KEEP_MINUTES, **kw):
    """T1 + T2 + T4: enriched arrivals appended to the vehicle table."""
    feeds = [feed_stream(spark, p, f, max_files_per_trigger) for f, p in feed_dirs.items()]
    enriched = enrich_tracks(vehicle_stream(feeds), keep_minutes=keep_minutes) \
        .observe("enrichment_counters", *reports.enrichment_counters())
    return write_table(enriched, table, checkpoint, "vehicle_timestamp", **kw)


def start_alerts(spark, alerts_dir: str, table: str, checkpoint: str,
                 max_files_per_trigger: int | None = None, dedupe_delay: str | None = None,
                 **kw):
    """S2 + T2 + S4: validated alerts appended to the alerts table;
    ``dedupe_delay`` turns on L1 (one row per alert version)."""
    src = feed_stream(spark, alerts_dir, "alerts", max_files_per_trigger)
    a = alert_stream(src)
    if dedupe_delay:
        a = dedupe_alert_versions(a, dedupe_delay)
    return write_table(a, table, checkpoint, "feed_timestamp", **kw)


def start_vehicle_rejects(spark, feed_dirs: dict[str, str], table: str, checkpoint: str,
                          max_files_per_trigger: int | None = None, **kw):
    """The reject table beside the vehicle table: a query of its own over the
    same folders, so that a failure of one sink never holds up the other."""
    feeds = [feed_stream(spark, p, f, max_files_per_trigger) for f, p in feed_dirs.items()]
    return write_table(vehicle_reject_stream(feeds), table, checkpoint, "rejected_at", **kw)


def start_alert_rejects(spark, alerts_dir: str, table: str, checkpoint: str,
                        max_files_per_trigger: int | None = None, **kw):
    """The reject table beside the alerts table."""
    src = feed_stream(spark, alerts_dir, "alerts", max_files_per_trigger)
    return write_table(alert_reject_stream(src), table, checkpoint, "rejected_at", **kw)


# ---------------------------------------------------------------- one decode, many sinks
def _put(df: DataFrame, path: str, time_col: str, batch_id: int) -> None:
    """Write one micro-batch's rows under event_date=.../batch_id=...: only
    these folders are replaced, so a batch that runs again leaves the table as
    if it had run once."""
    (df.withColumn("event_date", F.to_date(F.col(time_col))).withColumn("batch_id", F.lit(batch_id))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("event_date", "batch_id").parquet(path))


def write_feed_batch(messages: DataFrame, batch_id: int, accepted: str, rejects: str, counters: str,
                     alerts: bool = False) -> None:
    """One micro-batch of raw messages to three tables, decoded
    once: accepted rows, dead letters, and the R8 counters as (counter,
    value).  ``observed_at`` of dead letters and counters is the time of the
    batch, which is not the same when a batch runs again."""
    decoded = parse.decode(messages, *([ALERTS_MESSAGE] if alerts else [])).persist()
    try:
        now = F.current_timestamp()
        if alerts:
            out, count = parse.alert_outcomes(decoded), reports.alert_counters()
            _put(parse.accepted_alerts(out), accepted, "feed_timestamp", batch_id)
            lost = parse.alert_rejects(decoded)
        else:
            out, count = parse.position_outcomes(decoded), reports.record_counters()
            _put(parse.accepted_positions(out), accepted, "vehicle_timestamp", batch_id)
            lost = parse.feed_rejects(decoded)
        _put(lost.withColumn("observed_at", now), rejects, "observed_at", batch_id)
        rows = [reports.longform(decoded.agg(*reports.message_counters())), reports.longform(out.agg(*count))]
        _put(rows[0].unionByName(rows[1]).withColumn("observed_at", now), counters, "observed_at", batch_id)
    finally:
        decoded.unpersist()


def start_feed_tables(spark, feed_dirs: dict[str, str], accepted: str, rejects: str, counters: str,
                      checkpoint: str, alerts: bool = False, max_files_per_trigger: int | None = None,
                      trigger: str | None = DEFAULT_TRIGGER, available_now: bool = False):
    """Accepted rows, dead letters and counters of the feeds from one query
    (``foreachBatch``), each message decoded once.  Tables are day-partitioned;
    a batch that a failure interrupted is written again over itself."""
    feeds = [feed_stream(spark, p, f, max_files_per_trigger) for f, p in feed_dirs.items()]
    w = parse.feed_union(*feeds).writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda df, batch_id: write_feed_batch(df, batch_id, accepted, rejects, counters, alerts))
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)).start()


def start_coverage(records: DataFrame, table: str, checkpoint: str, window: str = "1 hour",
                   delay: str = "30 minutes", **kw):
    """R2 / R3 live: the coverage of each closed window of a stream of
    (enriched) rows, appended to a table."""
    return write_table(reports.windowed_coverage(records, window, delay), table, checkpoint, "window_start", **kw)


def late_rows(query) -> int:
    """Rows that a query has dropped for being behind its watermark, over the
    progress reports it still holds."""
    return sum(int(op["numRowsDroppedByWatermark"]) for p in query.recentProgress for op in p["stateOperators"])
