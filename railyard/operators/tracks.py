"""Track assignment for arrivals: the SQL view (W1 + J1), the as-of lookup
that is the batch twin of the stream enrichment (J2), and ghost trains (L7).

Join keys always include a calendar date next to (trip_id, stop_id): trip
ids recur every day, so (trip, stop) alone would put a station's whole
history into one task.  The 15-minute band reaches at most one day either
side, which is what makes the date key exact (see ``_candidate_dates``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import minutes_between, seconds_between, truthy
from .headway import ARRIVAL_STATUSES
from .windows import asof_last, hour_bucket

# Fixed values (reference constants).
MATCH_WINDOW_S = 15 * 60        # view: |arrival - predicted| < 15 min
STALE_MINUTES = 15              # stream: age > 15 min is stale
PREDICTION_STATUS = "IN_TRANSIT_TO"


def predictions(positions: DataFrame) -> DataFrame:
    """V4: track predictions -- IN_TRANSIT_TO rows with an actual track."""
    return positions.where((F.col("current_status") == PREDICTION_STATUS)
                           & F.col("actual_track").isNotNull())


def latest_prediction(positions: DataFrame) -> DataFrame:
    """Newest prediction per (trip, stop, DATE(predicted arrival)) by
    feed_timestamp, ties broken by entity_id (both descending).

    Written as a ``max_by`` aggregate rather than ROW_NUMBER = 1: it is
    partially aggregated before the shuffle, so a hot key costs one row per
    map task, not a sorted partition."""
    p = predictions(positions)
    pack = F.struct("entity_id", "train_id", "nyct_direction", "scheduled_track",
                    "actual_track", F.col("vehicle_timestamp").alias("predicted_arrival"),
                    "feed_timestamp")
    top = p.groupBy("trip_id", "stop_id",
                    F.to_date("vehicle_timestamp").alias("prediction_date")) \
        .agg(F.max_by(pack, F.struct("feed_timestamp", "entity_id")).alias("t"))
    return top.select("trip_id", "stop_id", "prediction_date", "t.*")


def _candidate_dates(ts: Column, band_s: int) -> Column:
    """Dates d for which some time within ``band_s`` of ``ts`` falls on d."""
    lo = F.to_date(ts - F.make_dt_interval(secs=F.lit(band_s)))
    hi = F.to_date(ts + F.make_dt_interval(secs=F.lit(band_s)))
    return F.array_distinct(F.array(lo, hi))


def within_band(a: Column, b: Column, band_s: int = MATCH_WINDOW_S) -> Column:
    """``ABS(TIMESTAMP_DIFF(a, b, MINUTE)) < 15``: whole minutes truncate
    toward zero, so this is |a - b| < 900 s exactly."""
    return F.abs(F.unix_micros(a) - F.unix_micros(b)) < band_s * 1_000_000


def arrivals_with_tracks(positions: DataFrame, band_s: int = MATCH_WINDOW_S) -> DataFrame:
    """Every arrival (V3), left-joined to the newest prediction of its
    (trip, stop) and day (W1) when the prediction lies within the band.

    The band is tested only after the per-day top-1, so an older prediction
    inside the band is not a fallback; near midnight an arrival can match
    the top predictions of two days and appears twice (as in the view).
    Each top prediction is offered to the arrival dates its band touches
    (at most two), and the join runs on (trip, stop, arrival date) with the
    band as a residual condition of the ON clause."""
    v = positions.where(F.col("current_status").isin(*ARRIVAL_STATUSES)).select(
        "entity_id", "trip_id", "route_id", "start_time", "start_date", "direction",
        "path_id", "stop_id", "current_stop_sequence", "current_status",
        F.col("vehicle_timestamp").alias("actual_arrival"), "feed_timestamp", "ingest_time",
        F.to_date("vehicle_timestamp").alias("_d"))
    t = latest_prediction(positions).select(
        F.col("trip_id").alias("_t_trip"), F.col("stop_id").alias("_t_stop"),
        "train_id", "nyct_direction", "scheduled_track", "actual_track", "predicted_arrival",
        F.explode(_candidate_dates(F.col("predicted_arrival"), band_s)).alias("_td"))
    cond = ((v["trip_id"] == t["_t_trip"]) & (v["stop_id"] == t["_t_stop"])
            & (v["_d"] == t["_td"])
            & within_band(v["actual_arrival"], t["predicted_arrival"], band_s))
    j = v.join(t, cond, "left")
    return j.select(
        "entity_id", "trip_id", "route_id", "start_time", "start_date", "direction", "path_id",
        "train_id", "nyct_direction", "scheduled_track", "actual_track", "stop_id",
        "current_stop_sequence", "current_status", "actual_arrival", "predicted_arrival",
        seconds_between(F.col("actual_arrival"), F.col("predicted_arrival"))
        .alias("prediction_error_seconds"),
        "feed_timestamp", "ingest_time")


# ---------------------------------------------------------------- J2
STATE_FIELDS = ["scheduled_track", "actual_track", "train_id", "nyct_direction", "cached_at"]
ENRICHED_COLUMNS = STATE_FIELDS[:4]


def is_track_update(status: Column = None) -> Column:
    """Rows that overwrite the enrichment state: IN_TRANSIT_TO with either
    track truthy."""
    return ((F.col("current_status") == PREDICTION_STATUS)
            & (truthy(F.col("scheduled_track")) | truthy(F.col("actual_track"))))


def enrich_from_state(state: Column, stale_minutes: float = STALE_MINUTES) -> list[Column]:
    """The arrival-side rule of the enrichment, given the state struct:
    returns the replaced columns and the outcome label.  Shared by the
    batch as-of (J2) and used as the definition the stream matches."""
    age = minutes_between(F.col("vehicle_timestamp"), state["cached_at"])
    fresh = state.isNotNull() & (age <= stale_minutes)
    outcome = (F.when(state.isNull(), F.lit("no_track"))
               .when(fresh, F.lit("enriched")).otherwise(F.lit("stale")))
    return [
        F.when(fresh, state["scheduled_track"]).otherwise(F.col("scheduled_track"))
        .alias("scheduled_track"),
        F.when(fresh, state["actual_track"]).otherwise(F.col("actual_track")).alias("actual_track"),
        F.when(fresh & ~truthy(F.col("train_id")), state["train_id"])
        .otherwise(F.col("train_id")).alias("train_id"),
        F.when(fresh & ~truthy(F.col("nyct_direction")), state["nyct_direction"])
        .otherwise(F.col("nyct_direction")).alias("nyct_direction"),
        outcome.alias("enrichment"),
    ]


def arrival_track_asof(positions: DataFrame, stale_minutes: float = STALE_MINUTES,
                       bucket_seconds: int = 3600) -> DataFrame:
    """Each arrival with the newest earlier track update of its
    (trip, stop), in stream order (feed_timestamp, entity_id).

    ``cached_at`` is the update's vehicle_timestamp (its predicted
    arrival); an age above 15 minutes is stale and the arrival stays as it
    is; a negative age is accepted.  Rows of any other status are dropped.
    Output: the table columns plus ``enrichment`` (enriched / stale /
    no_track)."""
    from ..schemas import VEHICLE_COLUMNS
    keyed = positions.where(truthy(F.col("trip_id")) & truthy(F.col("stop_id")))
    rel = keyed.where(is_track_update() | F.col("current_status").isin(*ARRIVAL_STATUSES))
    rel = rel.withColumn("cached_at", F.col("vehicle_timestamp"))
    s = asof_last(rel, ["trip_id", "stop_id"], ["feed_timestamp", "entity_id"],
                  is_track_update(), STATE_FIELDS,
                  hour_bucket("feed_timestamp", bucket_seconds), "_state")
    arr = s.where(F.col("current_status").isin(*ARRIVAL_STATUSES))
    replaced = enrich_from_state(F.col("_state"), stale_minutes)
    keep = [c for c in VEHICLE_COLUMNS if c not in ENRICHED_COLUMNS]
    out = arr.select(*keep, *replaced)
    return out.select(*VEHICLE_COLUMNS, "enrichment")


# ---------------------------------------------------------------- L7
def ghost_trains(positions: DataFrame, band_s: int = MATCH_WINDOW_S) -> DataFrame:
    """Newest predictions (W1) at a stop for which no arrival of the
    same trip is seen within the band: a left anti join on (trip, stop,
    date) with the band as residual condition.  Arrivals are offered to the
    prediction dates their band touches."""
    p = latest_prediction(positions).withColumn("_d", F.to_date("predicted_arrival"))
    a = positions.where(F.col("current_status").isin(*ARRIVAL_STATUSES)).select(
        F.col("trip_id").alias("_a_trip"), F.col("stop_id").alias("_a_stop"),
        F.col("vehicle_timestamp").alias("_a_ts"),
        F.explode(_candidate_dates(F.col("vehicle_timestamp"), band_s)).alias("_ad"))
    cond = ((p["trip_id"] == a["_a_trip"]) & (p["stop_id"] == a["_a_stop"])
            & (p["_d"] == a["_ad"]) & within_band(p["predicted_arrival"], a["_a_ts"], band_s))
    return p.join(a, cond, "left_anti").drop("_d")
