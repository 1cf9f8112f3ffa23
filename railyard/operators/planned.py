"""Operators the reference plans without code (L1, L2, L4, L5, L9), with
definitions of our own (README).  L3, L6, L8 live in ``headway``, L7 in
``tracks``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import day_of_week
from ..sources.tables import date_range
from .windows import hour_bucket, ordered_neighbor

# Fixed values of our definitions.
PEAK_HOURS = ((7, 10), (16, 19))     # [start, end) on weekdays
ALERT_CONTENT = ("alert_type", "affected_routes", "affected_stops", "active_period_start", "active_period_end",
                 "header_text", "description_text", "created_at")
SKETCH_SIZE = 400                    # k of the stored lag sketches
CELL_SECONDS = 900                   # smallest dyadic block of L4
TOP_LEVEL = 12                       # largest: 2^12 cells, 42 days


def _alert_order() -> Column:
    """Total order of alert versions: newest feed first, then the content."""
    return F.struct(
        F.col("feed_timestamp"), F.coalesce(F.col("updated_at"), F.timestamp_seconds(F.lit(0))),
        F.coalesce(F.col("ingest_time"), F.timestamp_seconds(F.lit(0))),
        F.coalesce(F.col("header_text"), F.lit("")),
        F.coalesce(F.col("description_text"), F.lit("")),
        F.coalesce(F.col("alert_type"), F.lit("")),
        F.coalesce(F.array_join("affected_stops", ","), F.lit("")))


def alerts_latest(alerts: DataFrame) -> DataFrame:
    """L1: newest version of each alert_id (``max_by``, partially
    aggregated).  On a stream use ``dropDuplicatesWithinWatermark``."""
    cols = [c for c in alerts.columns if c != "alert_id"]
    top = alerts.groupBy("alert_id").agg(
        F.max_by(F.struct(*cols), _alert_order()).alias("a"))
    return top.select("alert_id", "a.*")


def time_features(arr: DataFrame, time_col: str = "vehicle_timestamp") -> DataFrame:
    """L2: hour, day of week (Sunday = 1), weekend and peak flags, minute
    of day, per row (no shuffle)."""
    t = F.col(time_col)
    hour, dow = F.hour(t), day_of_week(t)
    weekend = dow.isin(1, 7)
    peak = F.lit(False)
    for a, b in PEAK_HOURS:
        peak = peak | ((hour >= a) & (hour < b))
    return arr.select("entity_id", "route_id", "stop_id", t.alias(time_col),
                      hour.alias("hour"), dow.alias("day_of_week"),
                      weekend.alias("is_weekend"), (peak & ~weekend).alias("is_peak"),
                      (hour * 60 + F.minute(t)).alias("minute_of_day"))


def _cell(micros: Column, seconds: int) -> Column:
    return F.floor(micros / (seconds * 1_000_000)).cast("long")


def alert_blocks(alerts: DataFrame, lo: Column, hi: Column, cell_seconds: int = CELL_SECONDS,
                 top: int = TOP_LEVEL) -> DataFrame:
    """Each alert and route with the dyadic blocks of its active period, as
    ``_route``, ``_level``, ``_block``: the cells of ``cell_seconds`` that the
    period meets between the times ``lo`` and ``hi``, in aligned runs of
    2^level cells.

    A level gives the run at the left end if that is the right half of its
    parent, and the one at the right end if that is a left half, so a period
    of n cells has at most 2 log2(n) blocks, and one for each run of the
    level ``top`` between them."""
    s, e = F.col("active_period_start"), F.col("active_period_end")
    first = F.greatest(_cell(F.unix_micros(s), cell_seconds), _cell(F.unix_micros(lo), cell_seconds))
    last = F.least(_cell(F.unix_micros(e) - 1, cell_seconds), _cell(F.unix_micros(hi), cell_seconds))
    a = alerts.where(s.isNotNull() & (e.isNull() | (s < e))).select(
        "alert_id", "alert_type", F.explode("affected_routes").alias("_route"),
        "active_period_start", "active_period_end", first.alias("_a"), (last + 1).alias("_b"))

    def at(level: int, block: Column) -> Column:
        return F.struct(F.lit(level).alias("level"), block.alias("block"))

    found = []
    for level in range(top + 1):
        left, right = F.shiftright(F.col("_a") + (1 << level) - 1, level), F.shiftright("_b", level)
        some = left < right
        if level < top:
            found += [F.array(F.when(some & (left % 2 != 0), at(level, left)),
                              F.when(some & (right % 2 != 0), at(level, right - 1)))]
        else:
            runs = F.sequence(left, F.greatest(left, right - 1))
            found += [F.when(some, F.transform(runs, lambda block: at(top, block)))]
    none = F.array().cast("array<struct<level:int,block:bigint>>")
    blocks = F.array_compact(F.concat(*[F.coalesce(f, none) for f in found]))
    return a.select("*", F.explode(blocks).alias("_at")).select(
        "alert_id", "alert_type", "active_period_start", "active_period_end", "_route",
        F.col("_at.level").alias("_level"), F.col("_at.block").alias("_block"))


def alert_candidates(arr: DataFrame, alerts: DataFrame, cell_seconds: int = CELL_SECONDS,
                     top: int = TOP_LEVEL) -> DataFrame:
    """L4 before the exact test of the period: arrivals beside the alerts
    that have a block on their route over them.  The blocks of an alert do not
    overlap, so no pair repeats; only cells at the ends of a period give pairs
    that fail the test."""
    t = F.col("vehicle_timestamp")
    span = arr.agg(F.struct(F.min(t).alias("lo"), F.max(t).alias("hi"))).scalar()
    a = alert_blocks(alerts, span["lo"], span["hi"], cell_seconds, top)
    levels = a.agg(F.sort_array(F.collect_set("_level"))).scalar()       # top + 1 numbers at most
    v = arr.select("entity_id", "route_id", "stop_id", "vehicle_timestamp", F.explode(levels).alias("_of")) \
        .withColumn("_over", F.call_function("shiftright", _cell(F.unix_micros(t), cell_seconds), F.col("_of")))
    return v.join(a, (v["route_id"] == a["_route"]) & (v["_of"] == a["_level"]) & (v["_over"] == a["_block"]))


def arrivals_under_alert(arr: DataFrame, alerts: DataFrame, cell_seconds: int = CELL_SECONDS,
                         top: int = TOP_LEVEL) -> DataFrame:
    """L4: arrivals on a route named by an alert while it is active
    (start <= t, and t < end unless the end is open).

    An interval join as an equi-join on (route, level, block): the period is
    cut into dyadic blocks, an arrival looks into the one block over it on
    each level that some alert uses.  The key is never the route alone, and
    an alert is compared with arrivals of its own period only, however long
    it lasts.  ``top`` bounds what one key holds (2^top cells of a route)."""
    t, s, e = F.col("vehicle_timestamp"), F.col("active_period_start"), F.col("active_period_end")
    return alert_candidates(arr, alerts, cell_seconds, top).where((t >= s) & (e.isNull() | (t < e))).select(
        "entity_id", "route_id", "stop_id", "vehicle_timestamp", "alert_id", "alert_type")


# ---------------------------------------------------------------- L9
def alert_history(alerts: DataFrame, content=ALERT_CONTENT) -> DataFrame:
    """What was said of each alert when: its versions merged into
    intervals [valid_from, valid_to) of equal ``content`` (NULL: still valid),
    with the number of versions in each.

    Each poll sends every alert again, so an alert may have very many
    versions: neighbours are found per day (``ordered_neighbor``), and only
    those that differ from the one before go on.  Of several versions of one
    feed time the last in the order of L1 counts."""
    one = alerts.groupBy("alert_id", "feed_timestamp").agg(
        F.max_by(F.struct(*content), _alert_order()).alias("_c"))
    day = hour_bucket("feed_timestamp", 86_400)
    was = ordered_neighbor(one, ["alert_id"], ["feed_timestamp"], ["_c"], day, "_was")
    new = was.where(F.col("_was").isNull() | ~F.col("_was._c").eqNullSafe(F.col("_c"))).drop("_was")
    runs = ordered_neighbor(new, ["alert_id"], ["feed_timestamp"], ["feed_timestamp"], day, "_next", "next")
    return runs.select("alert_id", F.col("feed_timestamp").alias("valid_from"),
                       F.col("_next.feed_timestamp").alias("valid_to"), "_c.*")


def alert_states(history: DataFrame, times: Column) -> DataFrame:
    """State of every alert at each of ``times`` (an array of timestamps):
    future, active or ended, ``unknown`` without a start, by the version
    valid then.  One pass: each version takes the times in its interval."""
    s, e = F.col("active_period_start"), F.col("active_period_end")
    here = F.filter("_times", lambda t: (t >= F.col("valid_from")) & (F.col("valid_to").isNull() | (t < F.col("valid_to"))))
    t = F.col("as_of")
    state = (F.when(s.isNull(), F.lit("unknown")).when(t < s, F.lit("future"))
             .when(e.isNull() | (t < e), F.lit("active")).otherwise(F.lit("ended")))
    return history.withColumn("_times", times).select(
        "alert_id", "alert_type", s, e, F.explode(here).alias("as_of")).withColumn("state", state)


def _lag_seconds() -> Column:
    return (F.unix_micros("ingest_time") - F.unix_micros("feed_timestamp")) / 1e6


def ingest_lag(table: DataFrame) -> DataFrame:
    """Feed-to-ingest lag in seconds per feed date: min, mean, max and
    approximate p50/p95 (``percentile_approx``, mergeable sketches)."""
    d = table.select(F.to_date("feed_timestamp").alias("date"), _lag_seconds().alias("lag_s"))
    return d.groupBy("date").agg(
        F.count(F.lit(1)).alias("n"), F.min("lag_s").alias("min_lag_s"),
        F.avg("lag_s").alias("avg_lag_s"), F.max("lag_s").alias("max_lag_s"),
        F.percentile_approx("lag_s", 0.5, 100000).alias("p50_lag_s"),
        F.percentile_approx("lag_s", 0.95, 100000).alias("p95_lag_s"))


def lag_sketches(table: DataFrame, k: int = SKETCH_SIZE) -> DataFrame:
    """L5, stored: one row per feed date with count, sum, bounds and a
    mergeable quantile sketch (KLL) of the lag.  A few kB a day, whatever the
    day holds, so a day is scanned once and any range is answered from here."""
    d = table.select(F.to_date("feed_timestamp").alias("date"), _lag_seconds().alias("lag_s")).where("lag_s IS NOT NULL")
    return d.groupBy("date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("lag_s").alias("sum_lag_s"), F.min("lag_s").alias("min_lag_s"),
        F.max("lag_s").alias("max_lag_s"), F.kll_sketch_agg_double("lag_s", F.lit(k)).alias("sketch"))


def lag_over(sketches: DataFrame, start=None, end=None, quantiles=(0.5, 0.95)) -> DataFrame:
    """L5 for the dates from ``start`` to ``end`` (inclusive) as one row, by
    merging their sketches; no position is read.  A sketch of size k is off by
    about 1.7 / k^0.9 of the rows in rank, merged or not."""
    d = date_range(sketches, "date", start, end, date_col="date")
    at = [F.kll_sketch_get_quantile_double("_s", F.lit(float(q))).alias(f"p{round(q * 100)}_lag_s") for q in quantiles]
    return d.agg(F.sum("n").alias("n"), F.min("min_lag_s").alias("min_lag_s"),
                 (F.sum("sum_lag_s") / F.sum("n")).alias("avg_lag_s"), F.max("max_lag_s").alias("max_lag_s"),
                 F.kll_merge_agg_double("sketch").alias("_s")).where(F.col("n") > 0).select(
        "n", "min_lag_s", "avg_lag_s", "max_lag_s", *at)
