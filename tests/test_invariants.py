"""Invariants on the driver data."""

from pyspark.sql import functions as F

from railyard.operators import graph, headway as hw, parse, tracks
from railyard.sources import fixtures
from railyard.sources.tables import events, positions


def test_adjacency_row_sums_at_most_one(spark, sf_dir):
    h = hw.headway(hw.arrivals(positions(spark, sf_dir)))
    adj = graph.adjacency(graph.stop_transitions(h))
    sums = adj.groupBy("from_stop").agg(F.sum("weight").alias("s")).collect()
    assert sums and all(r.s <= 1 + 1e-12 for r in sums)
    trans = graph.diffusion_transition(adj, graph.station_index(h))
    rows = trans.groupBy("direction", "from_stop").agg(F.sum("weight").alias("s")).collect()
    assert all(abs(r.s - 1) < 1e-6 for r in rows)


def test_windows_count_and_split(spark, sf_dir):
    h = hw.headway(hw.arrivals(positions(spark, sf_dir)))
    st = [r.stop_id for r in h.select("stop_id").distinct().collect()]
    h5 = hw.headway_5min(h)
    n_bins = hw.headway_normalised(h5).select("bin_start").distinct().count()
    w = hw.training_windows(h5)
    assert w.select("window_idx").distinct().count() == n_bins - 23
    assert w.count() == (n_bins - 23) * len(st)
    s = hw.temporal_split(w, h5).select("window_idx", "split").distinct()
    per = {r.split: r.n for r in s.groupBy("split").agg(F.count("*").alias("n")).collect()}
    n = n_bins - 23
    assert per["train"] == int(n * 0.7)
    assert sum(per.values()) == n                        # complete
    assert s.select("window_idx").distinct().count() == n  # disjoint


def test_view_keeps_every_arrival(spark, sf_dir):
    pos = positions(spark, sf_dir)
    arr = hw.arrivals(pos)
    j = tracks.arrivals_with_tracks(pos)
    assert j.select("entity_id").distinct().count() == arr.count()
    assert j.count() >= arr.count()


def test_accepted_plus_rejected_is_input(spark, sf_dir):
    dec = parse.decode(fixtures.gtfs_messages(events(spark, sf_dir)))
    rec = parse.extract_positions(dec)
    assert (parse.validate_vehicles(rec).count() + parse.vehicle_rejects(rec).count()
            == rec.count())


def test_asof_equals_plain_window(spark, sf_dir):
    """The bucketed as-of equals the one-partition-per-key window it replaces,
    also with one-minute buckets (many bucket boundaries)."""
    from pyspark.sql import Window
    pos = positions(spark, sf_dir)
    fine = tracks.arrival_track_asof(pos, bucket_seconds=60)
    coarse = tracks.arrival_track_asof(pos, bucket_seconds=10 ** 9)
    a = sorted(map(str, fine.collect()))
    b = sorted(map(str, coarse.collect()))
    assert a == b
    h1 = hw.headway(hw.arrivals(pos), bucket_seconds=60)
    h2 = hw.headway(hw.arrivals(pos), bucket_seconds=10 ** 9)
    assert sorted(map(str, h1.collect())) == sorted(map(str, h2.collect()))


def test_wide_pivot_and_fit_before(spark, sf_dir):
    h = hw.headway(hw.arrivals(positions(spark, sf_dir)))
    st = [r.stop_id for r in graph.station_index(h).orderBy("station_idx").collect()]
    h5 = hw.headway_5min(h)
    wide = hw.headway_5min_wide(h5, st)
    assert wide.columns == ["bin_start"] + st
    assert wide.count() == h5.select("bin_start").distinct().count()
    cells = sum(wide.select(F.count(c).alias("n")).first().n for c in st)
    assert cells == h5.count()
    imp = hw.headway_imputed(h5)
    lo, hi = imp.agg(F.min("bin_start"), F.max("bin_start")).first()
    cut = lo + (hi - lo) / 2
    z = hw.headway_normalised(h5, fit_before=cut)
    fit = z.where(F.col("bin_start") < F.lit(cut)).groupBy("stop_id").agg(F.avg("z").alias("m"))
    assert all(abs(r.m) < 1e-6 for r in fit.collect())


def test_one_stop_spreads_over_buckets_and_buckets_do_not_matter(spark):
    rows = spark.range(400).select(
        F.timestamp_seconds(F.col("id") * 300 + F.when(F.col("id") > 200, 90_000).otherwise(0)).alias("bin_start"),
        F.when(F.col("id") % 40 == 0, "b").otherwise("a").alias("stop_id"),
        (F.col("id") % 17).cast("double").alias("mean_headway"))
    fine, coarse = hw.training_windows(rows, bucket=32), hw.training_windows(rows, bucket=10_000)
    assert fine.count() == (400 - 23) * 2
    assert sorted(map(str, fine.collect())) == sorted(map(str, coarse.collect()))
    a, b = (hw.headway_interpolated(rows, bucket_seconds=s) for s in (3600, 10 ** 9))
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_messages_survive_odd_fields_and_odd_text_is_rejected(spark):
    import json

    from railyard.operators import parse

    def message(seq):
        ent = [{"id": str(i), "vehicle": {"trip": {"trip_id": "t"}, "current_stop_sequence": s, "stop_id": "x"}}
               for i, s in enumerate([1, seq, 3])]
        return json.dumps({"header": {"timestamp": 5}, "entity": ent})
    good = [message("2"), message(2.0), message("two"), message({"a": 1}), message(None)]
    bad = ["null", "[]", "", "  ", "3", good[0] + " x", good[0][:-1], None]
    frame = spark.createDataFrame([("f", str(i), v) for i, v in enumerate(good + bad)],
                                  "feed string, msg_id string, value string")
    decoded = parse.decode(frame)
    assert [r.msg_ok for r in decoded.orderBy(F.col("msg_id").cast("int")).collect()] == [True] * 5 + [False] * 8
    assert parse.entities(decoded).where("kind = 'vehicle'").count() == 15
    assert parse.parse_rejects(decoded).count() == 8
    from railyard.functions.columns import whole_number
    seq = whole_number(F.col("ent.vehicle.current_stop_sequence"))
    got = [r[0] for r in parse.entities(decoded).where("ent.id = '1'").orderBy("msg_id").select(seq).collect()]
    assert got == [2, 2, None, None, None]


def _dense(cells, bins, cut=None):
    """A6, A7 by hand: per series the filled values and their z-scores."""
    import statistics as st
    out = {}
    for key in {k for k, _ in cells}:
        mean = st.fmean(v for (k, _), v in cells.items() if k == key)
        values = [cells.get((key, b), mean) for b in bins]
        fit = [v for v, b in zip(values, bins, strict=True) if cut is None or b < cut]
        out[key] = [(v - st.fmean(fit)) / (st.stdev(fit) + hw.NORM_EPS) for v in values]
    return out


def test_sparse_windows_equal_the_dense_ones(spark):
    """Holes at the edges of buckets, series without a cell in a bucket, and a
    fit on earlier bins, against the filled grid by hand."""
    import random
    from datetime import datetime, timedelta
    rng, t0 = random.Random(4), datetime(2024, 1, 1)
    bins = [t0 + timedelta(minutes=5 * i * (1 + i // 40)) for i in range(90)]
    cells = {("r", b): rng.uniform(60, 900) for b in bins if rng.random() < 0.9 or b in (bins[0], bins[-1])}
    cells |= {("q", b): rng.uniform(60, 900) for b in bins if rng.random() < 0.1}
    cells |= {("one", bins[31]): 300.0}
    bins = sorted({b for _, b in cells})
    h5 = spark.createDataFrame([(b, "A", k, v) for (k, b), v in cells.items()],
                               "bin_start timestamp, route_id string, stop_id string, mean_headway double")
    for cut in (None, bins[50]):
        want = _dense(cells, bins, cut)
        got = {(r.stop_id, r.bin_start): r.z for r in hw.headway_normalised(h5, fit_before=cut).collect()}
        assert got.keys() == {(k, b) for k in want for b in bins}
        assert all(abs(got[k, b] - z) < 1e-9 * max(1, abs(z)) for k in want for b, z in zip(bins, want[k], strict=True))
        rows = hw.training_windows(h5, bucket=30, keys=("route_id", "stop_id"), fit_before=cut).collect()
        assert len(rows) == 3 * (len(bins) - 23)
        for r in rows:
            z = want[r.stop_id][r.window_idx:r.window_idx + 24]
            assert r.window_start == bins[r.window_idx] and (len(r.x), len(r.y)) == (12, 12)
            assert all(abs(a - b) < 1e-9 * max(1, abs(b)) for a, b in zip(r.x + r.y, z, strict=True))
    starts = [tuple(r) for r in hw.window_starts(h5).orderBy("window_idx").collect()]
    assert starts == list(enumerate(bins[:len(bins) - 23]))
    short = h5.where(F.col("bin_start") < F.lit(bins[20]))
    assert hw.training_windows(short).count() == 0 and hw.window_starts(short).count() == 0
    assert hw.training_windows(h5.limit(0)).count() == 0 and hw.headway_imputed(h5.limit(0)).count() == 0


def test_forecast_errors_by_route_count_each_error_once(spark):
    """Two routes share a stop: each has its own series and its own errors."""
    rows = spark.range(60).select(F.timestamp_seconds(F.col("id") * 300).alias("arrival_time"), F.lit("s").alias("stop_id"),
                                  F.when(F.col("id") % 3 == 0, "A").otherwise("C").alias("route_id"),
                                  F.lit("N").alias("direction"), (F.col("id") * 7 % 11 + 60).alias("headway_seconds"))
    keys = ("route_id", "direction", "stop_id")
    h5 = hw.headway_5min(rows, keys)
    w = hw.temporal_split(hw.training_windows(h5, keys=keys), h5)
    per = hw.forecast_errors(w, ("route_id", "direction")).collect()
    assert sorted({r.route_id for r in per}) == ["A", "C"] and sum(r.n for r in per) == 2 * 37 * 12
    one = h5.where("route_id = 'A'").select("bin_start", "stop_id", "mean_headway")
    a = [r for r in per if r.route_id == "A" and r.split == "train"][0]
    assert hw.training_windows(one).count() == max(0, one.count() - 23) and a.mae > 0
