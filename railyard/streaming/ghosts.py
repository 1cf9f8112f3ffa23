"""L7 on a stream: predictions whose train was never seen to arrive.

The newest prediction per trip, stop and day (W1) is a windowed aggregate; it
meets the arrivals in a left outer join within the time band.  Both are
bounded by the watermark: a day's predictions go on once the watermark has
passed its end, and a prediction without an arrival comes out once no arrival
in its band can follow.  Rows behind the watermark are dropped, so ``delay``
is how late a feed may be.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.headway import ARRIVAL_STATUSES
from ..operators.tracks import MATCH_WINDOW_S, predictions, within_band


def ghost_train_stream(positions: DataFrame, delay: str = "2 hours", band_s: int = MATCH_WINDOW_S) -> DataFrame:
    """Ghost trains of a stream of positions (every status), with the columns
    of ``tracks.ghost_trains``."""
    seen = positions.withWatermark("vehicle_timestamp", delay)
    # a value of its own: a stream has one event time, from here on the end of the day
    predicted = F.timestamp_micros(F.unix_micros("vehicle_timestamp")).alias("predicted_arrival")
    pack = F.struct("entity_id", "train_id", "nyct_direction", "scheduled_track", "actual_track", predicted,
                    "feed_timestamp")
    p = (predictions(seen).groupBy("trip_id", "stop_id", F.window("vehicle_timestamp", "1 day").alias("day"))
         .agg(F.max_by(pack, F.struct("feed_timestamp", "entity_id")).alias("t"))
         .select("trip_id", "stop_id", F.to_date("day.start").alias("prediction_date"),
                 F.window_time("day").alias("_closed"), "t.*"))
    a = seen.where(F.col("current_status").isin(*ARRIVAL_STATUSES)).select(
        F.col("trip_id").alias("_a_trip"), F.col("stop_id").alias("_a_stop"),
        F.col("vehicle_timestamp").alias("_a_ts"))
    reach = F.expr(f"interval {86_400 + band_s} seconds")
    cond = ((F.col("trip_id") == F.col("_a_trip")) & (F.col("stop_id") == F.col("_a_stop"))
            & (F.col("_a_ts") >= F.col("_closed") - reach) & (F.col("_a_ts") <= F.col("_closed") + reach)
            & within_band(F.col("predicted_arrival"), F.col("_a_ts"), band_s))
    return p.join(a, cond, "left_outer").where(F.col("_a_trip").isNull()).drop("_a_trip", "_a_stop", "_a_ts", "_closed")
