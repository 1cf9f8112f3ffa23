"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of SURVEY section 2.  Each reads the driver tables (``events``,
``embeddings``) over their whole extent.

Array results are rendered as comma-joined text here so that Spark and the
DuckDB oracle compare equal; the operators themselves return arrays.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import graph, headway as hw, parse, planned, reports, tracks
from ..schemas import ALERTS_MESSAGE
from ..sources import fixtures
from ..session import materialize
from ..sources.tables import events, landed, positions, write_partitioned

Query = Callable[[SparkSession, str], DataFrame]


# ------------------------------------------------------------------ inputs
def _gtfs_messages(spark, sf):
    return landed(spark, sf, "gtfs", lambda p: fixtures.gtfs_messages(events(spark, sf))
                  .write.mode("overwrite").parquet(p))


def _alert_messages(spark, sf):
    return landed(spark, sf, "alerts", lambda p: fixtures.alert_messages(events(spark, sf))
                  .write.mode("overwrite").parquet(p))


def _store_decoded(decoded, path):
    # the text stays with failed messages alone: their dead letters show it
    decoded.withColumn("value", F.when(~F.col("msg_ok"), F.col("value"))) \
        .write.mode("overwrite").parquet(path)


def _decoded(spark, sf):
    """Messages decoded once; queries read the typed columns they need."""
    return landed(spark, sf, "gtfs_decoded",
                  lambda p: _store_decoded(parse.decode(_gtfs_messages(spark, sf)), p))


def _ents(spark, sf):
    return parse.entities(_decoded(spark, sf))


def _alert_decoded(spark, sf):
    return landed(spark, sf, "alerts_decoded", lambda p: _store_decoded(
        parse.decode(_alert_messages(spark, sf), ALERTS_MESSAGE), p))


def _alert_ents(spark, sf):
    return parse.alert_entities(_alert_decoded(spark, sf))


def _alerts(spark, sf):
    return parse.validate_alerts(parse.alert_records(_alert_ents(spark, sf)))


def _alerts_latest(spark, sf):
    return planned.alerts_latest(_alerts(spark, sf))


def _arrivals(spark, sf):
    return hw.arrivals(positions(spark, sf))


def _headway(spark, sf):
    return hw.headway(_arrivals(spark, sf))


def _enriched(spark, sf):
    return tracks.arrival_track_asof(positions(spark, sf))


def _enriched_table(spark, sf):
    """The enriched table as the stream writes it: day-partitioned, clustered;
    the reports read it."""
    return landed(spark, sf, "vehicle_positions_enriched", lambda p: write_partitioned(
        _enriched(spark, sf), p, "vehicle_timestamp", ["route_id", "direction", "stop_id"],
        mode="overwrite"))


def _snapshot():
    return F.concat(F.col("feed"), F.lit(":"), F.col("msg_id").cast("string"))


def _extracts(spark, sf):
    e = _ents(spark, sf)
    return parse.standard_extract(e, _snapshot()), parse.extension_extract(e, _snapshot())


def _text(c: str) -> F.Column:
    return F.array_join(F.col(c), ",").alias(c)


def _stations(spark, sf):
    return graph.station_index(_headway(spark, sf))


def _h5(spark, sf):
    return hw.headway_5min(_headway(spark, sf))


def _means(spark, sf, keys=("stop_id",)):
    # bins, series and cells of the training chain all come from the 5-minute means
    return materialize(hw.headway_5min(_headway(spark, sf), keys))


def _split_windows(spark, sf, keys=("stop_id",)):
    h5 = _means(spark, sf, keys)
    return hw.temporal_split(hw.training_windows(h5, keys=keys), h5)


def _graph_rows(spark, sf):
    # rows, neighbours and station index all read the headway frame
    return materialize(_headway(spark, sf).select(
        "route_id", "direction", "trip_id", "stop_id", "arrival_time", "headway_seconds"))


def _adjacency(spark, sf):
    return graph.adjacency(graph.stop_transitions(_graph_rows(spark, sf)))


def _transition(spark, sf, h=None):
    h = h if h is not None else _graph_rows(spark, sf)
    # both directions and their row sums read the edges
    adj = materialize(graph.adjacency(graph.stop_transitions(h)))
    return graph.diffusion_transition(adj, graph.station_index(h))


# ------------------------------------------------------------------ queries
def q_headway(spark, sf):
    return _headway(spark, sf)


#: The dates of the queries that take a range (S5): the first two of the feed.
FIRST_DAYS = ("2024-01-01", "2024-01-02")


def q_headway_range(spark, sf):
    """A1 over a date range of the stored table: day folders are pruned."""
    return hw.headway(_arrivals(spark, sf), start_date=FIRST_DAYS[0], end_date=FIRST_DAYS[1])


def q_latest_prediction(spark, sf):
    return tracks.latest_prediction(positions(spark, sf))


def q_arrivals_with_tracks(spark, sf):
    return tracks.arrivals_with_tracks(positions(spark, sf))


def q_arrival_track_asof(spark, sf):
    return _enriched(spark, sf)


def q_feed_parse_rejects(spark, sf):
    return parse.parse_rejects(_decoded(spark, sf)).drop("value_length")


def q_vehicle_flatten(spark, sf):
    return parse.vehicle_records(_ents(spark, sf))


def q_trip_update_flatten(spark, sf):
    return parse.trip_update_records(_ents(spark, sf))


def q_trip_id_parse(spark, sf):
    e = _ents(spark, sf)
    tid = F.coalesce(F.col("ent.vehicle.trip.trip_id"), F.col("ent.trip_update.trip.trip_id"))
    ids = e.select(tid.alias("trip_id")).where(F.col("trip_id").isNotNull()).distinct()
    d, p = parse.parse_trip_id(F.col("trip_id"))
    return ids.select("trip_id", d.alias("direction"), p.alias("path_id"))


def q_alert_text_pick(spark, sf):
    return parse.alert_texts(_alert_ents(spark, sf))


def q_alert_flatten(spark, sf):
    a = parse.alert_records(_alert_ents(spark, sf))
    return a.select(*[(_text(c) if c in ("affected_routes", "affected_stops") else c)
                      for c in a.columns])


def q_alert_validate(spark, sf):
    a = _alerts(spark, sf)
    return a.select(*[(_text(c) if c in ("affected_routes", "affected_stops") else c)
                      for c in a.columns])


def q_vehicle_validate(spark, sf):
    return parse.validate_vehicles(parse.extract_positions(_decoded(spark, sf)))


def q_vehicle_rejects(spark, sf):
    r = parse.vehicle_rejects(parse.extract_positions(_decoded(spark, sf)))
    return r.select("entity_id", "trip_id", "route_id", "stop_id", "reject_reason")


def q_feed_rejects(spark, sf):
    return parse.feed_rejects(_decoded(spark, sf))


def q_alert_rejects(spark, sf):
    return parse.alert_rejects(_alert_decoded(spark, sf))


def q_track_rows(spark, sf):
    return parse.track_rows(_ents(spark, sf), _snapshot())


def q_feed_union(spark, sf):
    msgs = _gtfs_messages(spark, sf)
    ace = parse.decode(msgs.where(F.col("feed") == "ace"))
    bdfm = parse.decode(msgs.where(F.col("feed") == "bdfm"))
    u = parse.feed_union(ace, bdfm)
    return u.select("feed", "msg_id", "msg_ok",
                    F.when(F.col("msg_ok"), F.size("msg.entity")).alias("n_entities"))


def q_entity_kinds(spark, sf):
    return reports.entity_kinds(_ents(spark, sf))


def q_snapshot_summary(spark, sf):
    s = reports.snapshot_summary(parse.track_rows(_ents(spark, sf), _snapshot()))
    return s.select("snapshot", "total", "with_actual", "with_scheduled",
                    _text("actual_codes"), _text("scheduled_codes"),
                    "pct_actual", "pct_scheduled")


def q_extractor_comparison(spark, sf):
    return reports.extractor_comparison(*_extracts(spark, sf))


def q_sample_match(spark, sf):
    return reports.sample_match(*_extracts(spark, sf))


def q_latest_tracked(spark, sf):
    return reports.latest_tracked(_enriched_table(spark, sf))


def q_track_coverage(spark, sf):
    return reports.track_coverage(_enriched_table(spark, sf), by_day=True)


def q_hourly_coverage(spark, sf):
    return reports.windowed_coverage(_enriched_table(spark, sf))


def q_enrichment_recent(spark, sf):
    return reports.enrichment_recent(_enriched_table(spark, sf))


def q_track_frequency(spark, sf):
    return reports.track_frequency(_enriched_table(spark, sf))


def q_job_counters(spark, sf):
    return reports.job_counters(_decoded(spark, sf), _alert_decoded(spark, sf))


def q_station_index(spark, sf):
    return _stations(spark, sf)


def q_stop_transitions(spark, sf):
    return graph.stop_transitions(_graph_rows(spark, sf))


def q_adjacency(spark, sf):
    return _adjacency(spark, sf)


def q_headway_5min(spark, sf):
    return _h5(spark, sf)


def q_headway_imputed(spark, sf):
    return hw.headway_imputed(_means(spark, sf))


def _z(c: str) -> F.Column:
    """z-scores for comparison: an imputed bin sits at the stop mean, where z
    is float noise around 0; rounded to 9 places, negative zero made 0."""
    return (F.round(F.col(c), 9) + F.lit(0.0)).alias(c)


def q_headway_normalised(spark, sf):
    return hw.headway_normalised(_means(spark, sf)).select("bin_start", "stop_id", "value", _z("z"))


def q_training_windows(spark, sf):
    w = hw.training_windows(_means(spark, sf))
    return w.select("window_idx", "window_start", "stop_id",
                    F.posexplode(F.concat("x", "y")).alias("offset", "value")) \
        .select("window_idx", "window_start", "stop_id", "offset", _z("value"))


def q_temporal_split(spark, sf):
    h5 = _means(spark, sf)
    return hw.temporal_split(hw.window_starts(h5), h5)


def q_forecast_errors(spark, sf):
    return hw.forecast_errors(_split_windows(spark, sf))


def q_forecast_errors_by_route(spark, sf):
    return hw.forecast_errors(_split_windows(spark, sf, ("route_id", "direction", "stop_id")),
                              ("route_id", "direction"))


def q_diffusion_transition(spark, sf):
    return _transition(spark, sf)


def q_diffusion_features(spark, sf):
    # the headway frame and the transition matrix are each read by every
    # diffusion step: both are checkpointed once instead of recomputed
    h = _graph_rows(spark, sf)
    feats = h.groupBy("stop_id").agg(F.avg("headway_seconds").alias("x"))
    return graph.diffusion_features(materialize(_transition(spark, sf, h)), feats)


def q_alerts_latest(spark, sf):
    a = _alerts_latest(spark, sf)
    return a.select(*[(_text(c) if c in ("affected_routes", "affected_stops") else c)
                      for c in a.columns])


def q_time_features(spark, sf):
    return planned.time_features(_arrivals(spark, sf))


def q_headway_regularity(spark, sf):
    return hw.headway_regularity(_headway(spark, sf))


def q_arrivals_under_alert(spark, sf):
    return planned.arrivals_under_alert(_arrivals(spark, sf), _alerts_latest(spark, sf))


def q_ingest_lag(spark, sf):
    return planned.ingest_lag(positions(spark, sf))


def _lag_sketches(spark, sf):
    return landed(spark, sf, "lag_sketches", lambda p: planned.lag_sketches(positions(spark, sf))
                  .write.mode("overwrite").parquet(p))


def q_ingest_lag_range(spark, sf):
    """L5 over a date range, from the stored sketches alone."""
    return planned.lag_over(_lag_sketches(spark, sf), *FIRST_DAYS)


def q_bin_completeness(spark, sf):
    return hw.bin_completeness(_headway(spark, sf))


def q_ghost_trains(spark, sf):
    return tracks.ghost_trains(positions(spark, sf))


def q_headway_interpolated(spark, sf):
    return hw.headway_interpolated(_h5(spark, sf))


def q_alert_lifecycle(spark, sf):
    a = _alerts(spark, sf)
    last = a.agg(F.max("feed_timestamp")).scalar()
    return planned.alert_states(planned.alert_history(a), F.array(last))


def q_alert_states(spark, sf):
    """States at every sixth hour of the feed."""
    a = _alerts(spark, sf)
    times = a.agg(F.sequence(F.min("feed_timestamp"), F.max("feed_timestamp"), F.expr("interval 6 hours"))).scalar()
    return planned.alert_states(planned.alert_history(a), times)


def q_alert_history(spark, sf):
    """When which routes were named, by type."""
    h = planned.alert_history(_alerts(spark, sf), ("alert_type", "affected_routes"))
    return h.select("alert_id", "valid_from", "valid_to", "alert_type", _text("affected_routes"))


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}

#: Stored inputs in the order they are built; the bench times each on its own.
INPUTS: dict[str, Query] = {
    "gtfs_messages": _gtfs_messages, "alert_messages": _alert_messages,
    "gtfs_decoded": _decoded, "alerts_decoded": _alert_decoded,
    "vehicle_positions": positions, "vehicle_positions_enriched": _enriched_table,
}
