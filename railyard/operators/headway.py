"""Headways and the station-by-time training set.

A1 headway, A5 5-minute means, A6 imputation, A7 z-normalisation, W4 sliding
windows, W5 temporal split, A10 forecast errors, and the planned quality
measures L3 (regularity), L6 (bin completeness), L8 (interpolated gaps).

Everything stays a DataFrame and nothing is collected.  Per-stop statistics
are aggregates joined back; ordered work runs per (stop, bucket of bins) or
per day, so that one busy stop spreads over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import day_of_week, seconds_between
from ..sources.tables import date_range
from .windows import hour_bucket, ordered_neighbor

# Fixed values (reference defaults).
ARRIVAL_STATUSES = ("STOPPED_AT", "INCOMING_AT")
DEFAULT_ROUTES = ("A", "C", "E")
MIN_HEADWAY_S = 0          # strict lower bound
MAX_HEADWAY_S = 3600       # strict upper bound
BIN = "5 minutes"
BIN_SECONDS = 300
INPUT_WINDOW = 12
OUTPUT_HORIZON = 12
TRAIN_RATIO = 0.7
VAL_RATIO = 0.15
NORM_EPS = 1e-8
MAPE_MIN_ABS = 1e-9
STOP_BUCKETS = 16          # arrays of stops that a bin meets in the dense grid
BIN_BUCKET = 1024          # bins of one series that a row of the chain holds


def arrivals(positions: DataFrame) -> DataFrame:
    """V3: rows of an arrival status (the table the headway query reads)."""
    return positions.where(F.col("current_status").isin(*ARRIVAL_STATUSES))


def headway(df: DataFrame, time_col: str = "vehicle_timestamp",
            routes=DEFAULT_ROUTES, start_date=None, end_date=None,
            bucket_seconds: int = 3600) -> DataFrame:
    """A1: time since the previous train at the same (route, direction, stop).

    Filters on time, routes and dates run *before* the LAG; the outlier filter
    ``0 < h < 3600`` runs after it, so a dropped outlier still serves as the
    next row's predecessor.  Ties in time are broken by trip_id, entity_id.
    """
    d = df.where(F.col(time_col).isNotNull() & F.col("route_id").isin(*routes))
    # on the stored table the range also prunes day folders (event_date)
    part = "event_date" if "event_date" in df.columns and time_col == "vehicle_timestamp" else None
    d = date_range(d, time_col, start_date, end_date, date_col=part)
    d = d.select("route_id", "direction", "stop_id", "trip_id", "entity_id",
                 F.col(time_col).alias("arrival_time"))
    d = ordered_neighbor(d, ["route_id", "direction", "stop_id"],
                         ["arrival_time", "trip_id", "entity_id"], ["arrival_time"],
                         hour_bucket("arrival_time", bucket_seconds), "_prev")
    h = seconds_between(F.col("arrival_time"), F.col("_prev.arrival_time"))
    return (d.where(F.col("_prev").isNotNull())
            .select("route_id", "direction", "stop_id", "trip_id", "arrival_time",
                    h.alias("headway_seconds"),
                    F.to_date("arrival_time").alias("date"),
                    F.hour("arrival_time").alias("hour"),
                    day_of_week("arrival_time").alias("day_of_week"))
            .where((F.col("headway_seconds") > MIN_HEADWAY_S)
                   & (F.col("headway_seconds") < MAX_HEADWAY_S)))


def bin_start(ts: Column, bin_seconds: int = BIN_SECONDS) -> Column:
    """Start of the epoch-aligned bin holding ``ts``."""
    us = bin_seconds * 1_000_000
    return F.timestamp_micros(F.floor(F.unix_micros(ts) / us) * us)


def headway_5min(h: DataFrame, keys=("stop_id",)) -> DataFrame:
    """A5: mean headway per 5-minute bin and series, long form; a series is a
    stop, or what ``keys`` name (a route's direction at a stop).  Bins with no
    row are absent.  Partial aggregation runs before the shuffle."""
    return (h.groupBy(bin_start(F.col("arrival_time")).alias("bin_start"), *keys)
            .agg(F.avg("headway_seconds").alias("mean_headway")))


def headway_5min_wide(h5: DataFrame, stations: list[str]) -> DataFrame:
    """A5 wide form: one column per station in index order (fixed pivot list)."""
    return h5.groupBy("bin_start").pivot("stop_id", stations).agg(F.first("mean_headway"))


def bin_ordinals(h5: DataFrame) -> DataFrame:
    """Position of each present bin (0-based): its place in its day, plus the
    bins of earlier days (a running sum over one row per day)."""
    bins = h5.select("bin_start").distinct().withColumn("_day", F.to_date("bin_start"))
    days = bins.groupBy("_day").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    start = days.select("_day", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_day").orderBy("bin_start")) - 1
    return bins.withColumn("_at", place).join(start, "_day").select(
        "bin_start", (F.col("_at") + F.col("_before")).cast("bigint").alias("bin_idx"))


def _n_bins(h5: DataFrame) -> Column:
    """Number of present bins, as a scalar subquery."""
    return h5.agg(F.countDistinct("bin_start")).scalar()


def series_fit(h5: DataFrame, keys=("stop_id",), fit_before=None) -> DataFrame:
    """A6, A7 per series, from its present cells alone: ``stop_mean`` (the
    mean of its bin means, which fills its holes) and ``mu``, ``sd`` of the
    filled series over all present bins.

    With n cells of mean m in N bins and holes filled with c, the mean is
    mu = (n m + (N - n) c) / N and the sum of squares about it is that of the
    cells about m, plus n (m - mu)^2 + (N - n) (c - mu)^2.  ``fit_before`` (a
    timestamp) restricts mu and sd to earlier bins; the holes are filled over
    the whole range either way."""
    v, early = F.col("mean_headway"), h5
    if fit_before is not None:
        early = h5.where(F.col("bin_start") < F.lit(fit_before))
        v = F.when(F.col("bin_start") < F.lit(fit_before), v)
    fit = h5.groupBy(*keys).agg(F.avg("mean_headway").alias("stop_mean"), F.count(v).alias("_n"),
                                F.avg(v).alias("_m"), F.var_pop(v).alias("_var")).withColumn("_bins", _n_bins(early).cast("double"))
    n, N, c = F.col("_n"), F.col("_bins"), F.col("stop_mean")
    m = F.coalesce("_m", c)
    mu = F.when(n == N, m).when(m == c, c).otherwise((n * m + (N - n) * c) / N)
    square = (n * F.coalesce("_var", F.lit(0.0)) + n * (m - F.col("mu")) ** 2 + (N - n) * (c - F.col("mu")) ** 2)
    return fit.withColumn("mu", mu).withColumn("sd", F.sqrt(square / F.when(N > 1, N - 1))) \
        .select(*keys, "stop_mean", "mu", "sd")


def _timelines(h5: DataFrame, keys, fit_before=None, bucket: int = BIN_BUCKET, overlap: int = 0) -> DataFrame:
    """One row per series and ``bucket`` of present bins: ``starts`` of the
    bucket's own bins and ``values`` of these and the next ``overlap`` bins
    (``reach`` in all), NULL in holes, with the series' fit.

    Only present cells are moved; the holes are made in the row.  A row holds
    ``bucket + overlap`` values at most, so a busy series spreads over rows."""
    idx, n_bins = bin_ordinals(h5), _n_bins(h5)
    own = F.floor(F.col("bin_idx") / bucket)
    starts = idx.groupBy(own.alias("_bucket")).agg(
        F.sort_array(F.collect_list("bin_start")).alias("starts")).withColumn("_total", n_bins)
    also = (F.col("bin_idx") % bucket < overlap) & (F.col("_own") > 0)
    cells = h5.join(idx, "bin_start").withColumn("_own", own).withColumn("_bucket", F.explode(
        F.when(also, F.array(F.col("_own"), F.col("_own") - 1)).otherwise(F.array(F.col("_own")))))
    cells = cells.groupBy(*keys, "_bucket").agg(F.sort_array(F.collect_list(F.struct(
        (F.col("bin_idx") - F.col("_bucket") * bucket).cast("int").alias("at"), "mean_headway"))).alias("_cells"))
    rows = (series_fit(h5, keys, fit_before)
            .withColumn("_bucket", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((n_bins - 1) / bucket))))
            .join(starts, "_bucket").join(cells, [*keys, "_bucket"], "left"))
    # a few rows of cells become very many windows: keep them on all cores
    spark = h5.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.repartition(tasks, F.xxhash64(*keys, "_bucket"))
    hole, seen = F.lit(None).cast("double"), F.coalesce("_cells", F.array().cast("array<struct<at:int,mean_headway:double>>"))
    reach = F.least(F.lit(bucket + overlap), F.col("_total") - F.col("_bucket") * bucket).cast("int")
    at = lambda i: F.coalesce(F.get("_cells", i)["at"], F.lit(-1))                          # noqa: E731
    filled = F.flatten(F.transform(seen, lambda c, i: F.concat(
        F.array_repeat(hole, c["at"] - F.when(i == 0, F.lit(-1)).otherwise(at(i - 1)) - 1), F.array(c["mean_headway"]))))
    rest = F.array_repeat(hole, F.col("reach") - 1 - F.when(F.size(seen) == 0, F.lit(-1)).otherwise(at(F.size(seen) - 1)))
    return rows.withColumn("reach", reach).withColumn("values", F.concat(filled, rest)).drop("_cells", "_total")


def _grid(h5: DataFrame, fit_before=None) -> DataFrame:
    """The dense (present bin) x (stop) rows with each stop's fit: an
    equi-join of bins and stops on a bucket of stops, then the cells."""
    stops = series_fit(h5, fit_before=fit_before).groupBy(
        F.pmod(F.xxhash64("stop_id"), F.lit(STOP_BUCKETS)).alias("_b")).agg(
        F.collect_list(F.struct("stop_id", "stop_mean", "mu", "sd")).alias("_stops"))
    bins = h5.select("bin_start").distinct().withColumn("_b", F.explode(
        F.sequence(F.lit(0).cast("bigint"), F.lit(STOP_BUCKETS - 1).cast("bigint"))))
    grid = bins.join(stops, "_b").select("bin_start", F.explode("_stops").alias("_s")).select("bin_start", "_s.*")
    return grid.join(h5, ["bin_start", "stop_id"], "left").withColumn("value", F.coalesce("mean_headway", "stop_mean"))


def headway_imputed(h5: DataFrame) -> DataFrame:
    """The dense (present bin) x (stop) grid; a hole gets the stop's mean
    of bin means.  Only bins with at least one value exist."""
    return _grid(h5).select("bin_start", "stop_id", "mean_headway", "value",
                            F.col("mean_headway").isNull().alias("is_imputed"))


def _z(value: Column) -> Column:
    return (value - F.col("mu")) / (F.col("sd") + NORM_EPS)


def headway_normalised(h5: DataFrame, fit_before=None) -> DataFrame:
    """Per-stop z-score ``(v - mean) / (std + 1e-8)`` of the filled grid,
    sample std.

    By default the statistics span the whole range, as in the reference;
    ``fit_before`` (a timestamp) restricts them to earlier bins."""
    return _grid(h5, fit_before).select("bin_start", "stop_id", "value", _z(F.col("value")).alias("z"))


def training_windows(h5: DataFrame, input_window: int = INPUT_WINDOW, horizon: int = OUTPUT_HORIZON,
                     bucket: int = BIN_BUCKET, keys=("stop_id",), fit_before=None) -> DataFrame:
    """Sliding windows of z-scores (A7) over present bins, step 1: ``x``
    the first ``input_window`` values, ``y`` the next ``horizon``; n - 23
    windows.

    One row per (window, series), cut from the series' timelines, whose last
    windows reach into the bins of the next bucket."""
    total = input_window + horizon
    if bucket < total:
        raise ValueError("a bucket holds at least one whole window")
    t = _timelines(h5, keys, fit_before, bucket, total - 1).withColumn(
        "_z", F.transform("values", lambda v: _z(F.coalesce(v, F.col("stop_mean")))))
    last = F.least(F.size("starts"), F.col("reach") - total + 1) - 1
    t = t.where(last >= 0).withColumn("_w", F.explode(F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(
        (F.col("_bucket") * bucket + i).alias("window_idx"), F.get("starts", i).alias("window_start"),
        F.slice("_z", i + 1, input_window).alias("x"), F.slice("_z", i + 1 + input_window, horizon).alias("y")))))
    return t.select("_w.window_idx", "_w.window_start", *keys, "_w.x", "_w.y")


def window_starts(h5: DataFrame, total: int = INPUT_WINDOW + OUTPUT_HORIZON) -> DataFrame:
    """Position and first bin of every window, from the bins alone."""
    idx = bin_ordinals(h5)
    return idx.where(F.col("bin_idx") < _n_bins(h5) - (total - 1)).select(
        F.col("bin_idx").alias("window_idx"), F.col("bin_start").alias("window_start"))


def temporal_split(windows: DataFrame, h5: DataFrame, train_ratio: float = TRAIN_RATIO,
                   val_ratio: float = VAL_RATIO, total: int = INPUT_WINDOW + OUTPUT_HORIZON) -> DataFrame:
    """``train`` below int(n*0.7), ``val`` below int(n*(0.7+0.15)), else
    ``test``; n counts window positions, which the bins of ``h5`` give: a
    scalar subquery over them, so no window is joined, moved or made twice."""
    n = _n_bins(h5) - (total - 1)
    split = (F.when(F.col("window_idx") < F.floor(n * F.lit(train_ratio)), F.lit("train"))
             .when(F.col("window_idx") < F.floor(n * F.lit(train_ratio + val_ratio)), F.lit("val"))
             .otherwise(F.lit("test")))
    return windows.withColumn("split", split)


def forecast_errors(split_windows: DataFrame, group_cols: tuple = ()) -> DataFrame:
    """A10: MAE, RMSE and MAPE of the naive last-value forecast (every
    horizon step predicted by the last input value), per split, and per
    ``group_cols`` as well.  Windows of series by (route, direction, stop)
    give the cut by route and direction in which each error counts once.

    Targets are z-scores; an imputed bin sits at the stop mean, i.e. at
    z = 0 up to rounding noise, so MAPE leaves out targets with |y| <= 1e-9."""
    e = split_windows.select("split", *group_cols, F.element_at("x", -1).alias("pred"), F.explode("y").alias("actual"))
    err = F.col("pred") - F.col("actual")
    return e.groupBy("split", *group_cols).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.when(F.abs(F.col("actual")) > MAPE_MIN_ABS, F.abs(err) / F.abs(F.col("actual"))))
        .alias("mape"))


def headway_regularity(h: DataFrame) -> DataFrame:
    """L3 (PRDM): mean of |h - planned| / planned per (route, direction,
    stop), planned = the group's median headway (no timetable exists).
    The median is an aggregate joined back, never a per-key window."""
    keys = ["route_id", "direction", "stop_id"]
    med = h.groupBy(*keys).agg(F.median("headway_seconds").alias("planned_headway"))
    d = h.join(med, keys)
    dev = F.abs(F.col("headway_seconds") - F.col("planned_headway")) / F.col("planned_headway")
    return d.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                                F.first("planned_headway").alias("planned_headway"),
                                F.avg(dev).alias("prdm"))


def bin_completeness(h: DataFrame, bin_seconds: int = BIN_SECONDS) -> DataFrame:
    """Observed 5-minute bins against the bins expected between a stop's
    first and last observation."""
    b = h.select("stop_id", bin_start(F.col("arrival_time"), bin_seconds).alias("b"))
    agg = b.groupBy("stop_id").agg(F.min("b").alias("first_bin"), F.max("b").alias("last_bin"),
                                   F.countDistinct("b").alias("observed_bins"))
    expected = ((F.unix_seconds(F.col("last_bin")) - F.unix_seconds(F.col("first_bin")))
                / bin_seconds + 1).cast("bigint")
    return agg.select("stop_id", "first_bin", "last_bin", "observed_bins",
                      expected.alias("expected_bins"),
                      (F.col("observed_bins") / expected).alias("completeness"))


def headway_interpolated(h5: DataFrame, bin_seconds: int = BIN_SECONDS,
                         bucket_seconds: int = 86_400) -> DataFrame:
    """Each stop's 5-minute timeline between its first and last present
    bin; missing bins are filled linearly in time between the neighbouring
    present values and flagged ``is_filled``.

    Each present bin makes the holes since the present bin before it (found
    per day, with the last one of earlier days carried over), so no stop's
    whole timeline meets in one task or array."""
    p = ordered_neighbor(h5.select("bin_start", "stop_id", "mean_headway"), ["stop_id"], ["bin_start"],
                         ["bin_start", "mean_headway"], hour_bucket("bin_start", bucket_seconds), "_prev")
    step = F.make_dt_interval(secs=F.lit(bin_seconds))
    first = F.coalesce(F.col("_prev.bin_start") + step, F.col("bin_start"))
    every = p.select("stop_id", "mean_headway", "_prev", F.col("bin_start").alias("_at"),
                     F.explode(F.sequence(first, F.col("bin_start"), step)).alias("bin_start"))
    filled = F.col("bin_start") < F.col("_at")
    t0 = F.unix_seconds("_prev.bin_start")
    frac = (F.unix_seconds("bin_start") - t0) / (F.unix_seconds("_at") - t0)
    interp = F.col("_prev.mean_headway") + (F.col("mean_headway") - F.col("_prev.mean_headway")) * frac
    return every.select("bin_start", "stop_id", F.when(filled, interp).otherwise(F.col("mean_headway"))
                        .alias("mean_headway"), filled.alias("is_filled"))
