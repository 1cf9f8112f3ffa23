"""Reports (R1-R8): the coverage SQL, message peek, parser comparison and
job counters, as aggregates over DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import truthy


def latest_tracked(table: DataFrame, n: int = 10) -> DataFrame:
    """Newest ``n`` rows with an actual track (a top-k: the limit is the
    feature).  Ties on time are broken by entity_id."""
    return (table.where(F.col("actual_track").isNotNull())
            .orderBy(F.col("vehicle_timestamp").desc(), F.col("entity_id").desc())
            .limit(n)
            .select("trip_id", "stop_id", "actual_track", "scheduled_track", "train_id",
                    "nyct_direction", "vehicle_timestamp"))


def _pct(part: Column, total: Column) -> Column:
    return F.round(F.lit(100.0) * part / F.when(total > 0, total), 1)


def track_coverage(table: DataFrame, day=None, by_day: bool = False) -> DataFrame:
    """R2: totals with actual track, scheduled track and train id, and the
    actual-track percentage (1 decimal).  ``day`` restricts to one date of
    vehicle_timestamp; ``by_day`` gives one row per date."""
    t = table
    if day is not None:
        t = t.where(F.to_date("vehicle_timestamp") == F.lit(str(day)).cast("date"))
    g = t.groupBy(F.to_date("vehicle_timestamp").alias("date")) if by_day else t.groupBy()
    return _coverage(g)


def _coverage(grouped) -> DataFrame:
    return grouped.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col("actual_track").isNotNull()).alias("with_actual_track"),
        F.count_if(F.col("scheduled_track").isNotNull()).alias("with_scheduled_track"),
        F.count_if(F.col("train_id").isNotNull()).alias("with_train_id")
    ).withColumn("track_coverage_pct", _pct(F.col("with_actual_track"), F.col("total_records")))


def windowed_coverage(table: DataFrame, window: str = "1 hour", delay: str | None = None) -> DataFrame:
    """R2, R3 per event-time window, of a table or of a stream: the counts and
    percentage of every window of ``vehicle_timestamp``.

    On a stream ``delay`` sets the watermark: a window is given out once
    (append mode), when the newest time seen lies ``delay`` behind its end;
    rows that come later than that are dropped and counted by the query
    (``numRowsDroppedByWatermark``).  State is one row per open window."""
    t = table.withWatermark("vehicle_timestamp", delay) if delay else table
    return _coverage(t.groupBy(F.window("vehicle_timestamp", window).alias("_w"))).select(
        F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "total_records",
        "with_actual_track", "with_scheduled_track", "with_train_id", "track_coverage_pct")


def enrichment_recent(table: DataFrame, now=None, hours: int = 1) -> DataFrame:
    """Arrivals newer than ``now - hours`` and the share with a track.

    ``now`` defaults to the newest vehicle_timestamp in the table: one
    scalar aggregate, then a literal predicate that reaches the parquet scan
    (row-group min/max skipping) instead of a join against the aggregate.  On
    the stored table the days before are pruned."""
    if now is None:
        now = table.agg(F.max("vehicle_timestamp")).first()[0]
    since = F.lit(now).cast("timestamp") - F.make_dt_interval(hours=F.lit(hours))
    t = table.where(F.col("vehicle_timestamp") > since)
    if "event_date" in table.columns:
        t = t.where(F.col("event_date") >= F.to_date(since))
    r = t.groupBy().agg(
        F.count(F.lit(1)).alias("total_arrivals"),
        F.count_if(F.col("actual_track").isNotNull()).alias("with_track_data"))
    return r.withColumn("enrichment_pct", _pct(F.col("with_track_data"), F.col("total_arrivals")))


def track_frequency(table: DataFrame) -> DataFrame:
    """Rows per actual track, most frequent first (ties by track); the
    result has one row per track code, so the final sort is small."""
    return (table.where(F.col("actual_track").isNotNull())
            .groupBy("actual_track").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), F.col("actual_track")))


def entity_kinds(ents: DataFrame) -> DataFrame:
    """Entities per feed and kind (vehicle / trip_update / unknown)."""
    return ents.groupBy("feed", "kind").agg(F.count(F.lit(1)).alias("n_entities"))


def snapshot_summary(tracks: DataFrame) -> DataFrame:
    """Per snapshot and overall (``snapshot = 'ALL'``): track rows, rows
    with actual and scheduled tracks, their percentages, and the sorted
    distinct track codes.  A code set holds distinct track codes (a small
    physical domain, a few dozen), not rows."""
    a, s = F.col("actual_track"), F.col("scheduled_track")
    aggs = [F.count(F.lit(1)).alias("total"),
            F.count_if(truthy(a)).alias("with_actual"),
            F.count_if(truthy(s)).alias("with_scheduled"),
            F.array_sort(F.collect_set(F.when(truthy(a), a))).alias("actual_codes"),
            F.array_sort(F.collect_set(F.when(truthy(s), s))).alias("scheduled_codes")]
    return _with_overall(tracks, aggs) \
        .withColumn("pct_actual", _pct(F.col("with_actual"), F.col("total"))) \
        .withColumn("pct_scheduled", _pct(F.col("with_scheduled"), F.col("total")))


def _with_overall(rows: DataFrame, aggs: list[Column]) -> DataFrame:
    """Per snapshot and overall in one pass over ``rows`` (a rollup, partially
    aggregated before the shuffle)."""
    r = rows.rollup("snapshot").agg(F.grouping("snapshot").alias("_all"), *aggs)
    names = [c for c in r.columns if c not in ("snapshot", "_all")]
    return r.select(F.when(F.col("_all") == 1, F.lit("ALL")).otherwise(F.col("snapshot"))
                    .alias("snapshot"), *names)


def extractor_comparison(standard: DataFrame, extension: DataFrame) -> DataFrame:
    """Standard against extended extraction (P12) per snapshot and overall
    (``snapshot = 'ALL'``): rows each way, rows without partner, rows with
    tracks and train ids, pct.  Rows meet on their place in the message, which
    is unique, so the join has no hot key."""
    place = ["snapshot", "ent_pos", "stop_pos"]
    s = standard.select(*place, F.lit(True).alias("_std"))
    e = extension.select(*place, "actual_track", "scheduled_track", "train_id",
                         F.lit(True).alias("_ext"))
    j = s.join(e, place, "full")
    std, ext = F.col("_std").isNotNull(), F.col("_ext").isNotNull()
    r = _with_overall(j, [
        F.count_if(std).alias("current_rows"), F.count_if(ext).alias("extension_rows"),
        F.count_if(std & ~ext).alias("current_only"),
        F.count_if(ext & ~std).alias("extension_only"),
        F.count_if(truthy(F.col("actual_track"))).alias("with_actual"),
        F.count_if(truthy(F.col("scheduled_track"))).alias("with_scheduled"),
        F.count_if(truthy(F.col("train_id"))).alias("with_train_id")])
    return r.withColumn("pct_actual", _pct(F.col("with_actual"), F.col("extension_rows")))


def sample_match(standard: DataFrame, extension: DataFrame) -> DataFrame:
    """Per snapshot the first extended row with an actual track (else the
    first row) beside the first standard row of its trip and stop.  Both firsts
    are ``min_by`` aggregates by place in the message; ids match NULL-safely."""
    order = [F.col("ent_pos"), F.col("stop_pos")]
    shown = ["trip_id", "stop_id", "route_id", "train_id", "direction", "scheduled_track",
             "actual_track"]
    ext = extension.groupBy("snapshot").agg(F.min_by(
        F.struct(*shown), F.struct(~truthy(F.col("actual_track")), *order)).alias("e"))
    e = ext.select("snapshot", "e.*").alias("e")
    s = standard.alias("s")
    pair = s.join(e, (F.col("s.snapshot") == F.col("e.snapshot"))
                  & F.col("s.trip_id").eqNullSafe(F.col("e.trip_id"))
                  & F.col("s.stop_id").eqNullSafe(F.col("e.stop_id"))) \
        .groupBy(F.col("e.snapshot").alias("snapshot")).agg(F.min_by(
            F.struct(F.col("s.route_id").alias("current_route_id"),
                     F.col("s.arrival_time").alias("current_arrival_time"),
                     F.col("s.departure_time").alias("current_departure_time")),
            F.struct(*[F.col(f"s.{c}") for c in ("ent_pos", "stop_pos")])).alias("c"))
    return ext.select("snapshot", "e.*").join(pair.select("snapshot", "c.*"), "snapshot", "left")


# ---------------------------------------------------------------- R8
def message_counters() -> list[Column]:
    """Over decoded messages."""
    return [F.count_if(F.col("msg_ok")).alias("messages_processed"),
            F.count_if(~F.col("msg_ok")).alias("parse_errors")]


def record_counters() -> list[Column]:
    """Over ``parse.position_outcomes``."""
    from .tracks import is_track_update
    extracted, valid = F.col("extract_reason").isNull(), F.col("reject_reason").isNull()
    kind = F.col("kind")
    return [F.count_if(extracted & (kind == "vehicle")).alias("vehicles_extracted"),
            F.count_if(extracted & (kind == "trip_update")).alias("trip_updates_processed"),
            F.count_if(~extracted & (kind == "vehicle")).alias("invalid_vehicles"),
            F.count_if(valid).alias("valid_records"),
            F.count_if(extracted & ~valid).alias("invalid_records"),
            F.count_if(valid & F.coalesce(is_track_update(), F.lit(False)))
            .alias("track_data_cached")]


def enrichment_counters() -> list[Column]:
    """Over enriched arrivals."""
    e = F.col("enrichment")
    return [F.count_if(e == "enriched").alias("enriched_records"),
            F.count_if(e == "no_track").alias("no_track_data"),
            F.count_if(e == "stale").alias("stale_track_data")]


def alert_counters() -> list[Column]:
    """Over ``parse.alert_outcomes``."""
    r = F.col("reject_reason")
    dropped = F.coalesce(r.isin("no_alert", "no_target_route", "json_parse_error", "entity_not_a_list"), F.lit(False))
    return [F.count_if(~dropped).alias("alerts_extracted"),
            F.count_if(r == "no_target_route").alias("alerts_filtered"),
            F.count_if(r.isNull()).alias("valid_alerts"),
            F.count_if(~dropped & r.isNotNull()).alias("invalid_alerts")]


def longform(df: DataFrame) -> DataFrame:
    """A row of counters as ``(counter, value)`` rows."""
    pairs = ", ".join(f"'{c}', `{c}`" for c in df.columns)
    return df.selectExpr(f"stack({len(df.columns)}, {pairs}) AS (counter, value)")


def job_counters(decoded: DataFrame, alerts_decoded: DataFrame | None = None) -> DataFrame:
    """The job counters as ``(counter, value)`` rows.  All come from the
    decoded messages, so they reconcile: records = valid + invalid, and the
    arrivals among the valid ones = enriched + no track + stale.  A stream
    observes the same expressions (``streaming.ingest``)."""
    from ..session import materialize
    from .parse import accepted_positions, alert_outcomes, position_outcomes
    from .tracks import arrival_track_asof
    # read by the record counters and by both sides of the as-of
    outcomes = materialize(position_outcomes(decoded))
    parts = [decoded.agg(*message_counters()), outcomes.agg(*record_counters()),
             arrival_track_asof(accepted_positions(outcomes)).agg(*enrichment_counters())]
    if alerts_decoded is not None:
        m = alerts_decoded.agg(*message_counters())
        parts += [m.select([F.col(c).alias(f"alert_{c}") for c in m.columns]),
                  alert_outcomes(alerts_decoded).agg(*alert_counters())]

    out = longform(parts[0])
    for d in parts[1:]:
        out = out.unionByName(longform(d))
    return out
