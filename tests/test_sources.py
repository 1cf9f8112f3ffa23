"""Sources and sinks: date range (S5), partitioned table + retention (S8),
CSV export (S6), schema text (S7)."""

import os

from pyspark.sql import functions as F

from railyard.operators import parse
from railyard.sources import fixtures, tables
from railyard.sources.tables import events, positions


def test_date_range_inclusive(spark, sf_dir):
    pos = positions(spark, sf_dir)
    days = sorted(r.d for r in pos.select(F.to_date("vehicle_timestamp").alias("d"))
                  .distinct().collect())
    one = tables.date_range(pos, "vehicle_timestamp", days[0], days[0])
    assert one.count() == pos.where(F.to_date("vehicle_timestamp") == days[0]).count() > 0
    assert tables.date_range(pos, "vehicle_timestamp").count() == pos.count()


def test_partitioned_table_and_retention(spark, sf_dir, tmp_path):
    pos = positions(spark, sf_dir)
    path = str(tmp_path / "vp")
    tables.write_partitioned(pos, path, "vehicle_timestamp",
                             ["route_id", "direction", "stop_id"])
    dirs = sorted(d for d in os.listdir(path) if d.startswith("event_date="))
    assert dirs
    back = spark.read.parquet(path)
    assert back.count() == pos.count()
    last = max(r.d for r in back.select(F.max("event_date").alias("d")).collect())
    kept = tables.retain(back, last, keep_days=1)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "event_date" in plan
    old = tables.expired_dates(spark, path, last, keep_days=1).collect()
    assert len(old) == len(dirs) - 2 or len(old) == len(dirs) - 1
    pruned = tables.date_range(back, "vehicle_timestamp", last, last, date_col="event_date")
    assert pruned.count() == back.where(F.col("event_date") == last).count()


def test_csv_export(spark, sf_dir, tmp_path):
    ents = parse.entities(parse.decode(fixtures.gtfs_messages(events(spark, sf_dir))))
    rows = parse.track_rows(ents, F.lit("s"))
    out = str(tmp_path / "tracks_csv")
    assert tables.export_track_csv(rows, out)
    back = spark.read.option("header", True).csv(out)
    assert back.columns == tables.TRACK_CSV_COLUMNS
    assert back.count() == rows.count()
    empty = str(tmp_path / "empty_csv")
    assert not tables.export_track_csv(rows.where(F.lit(False)), empty)
    assert not os.path.exists(empty)


def test_headway_date_range_prunes_partitions(spark, sf_dir):
    from railyard.operators import headway as hw
    pos = positions(spark, sf_dir)
    assert "event_date" in pos.columns
    day = pos.select(F.min("event_date")).first()[0]
    h = hw.headway(hw.arrivals(pos), start_date=day, end_date=day)
    plan = h._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    # the range filters before the LAG: the day's first arrival has no predecessor
    full = hw.headway(hw.arrivals(pos)).where(F.col("date") == day).count()
    assert 0 < h.count() <= full
    assert {r.date for r in h.select("date").distinct().collect()} <= {day}


def test_compaction_replaces_only_its_days(spark, tmp_path):
    """A closed day is rewritten clustered; a second run changes nothing."""
    src = spark.range(0, 96, numPartitions=12).select(
        (F.col("id") % 4).cast("string").alias("stop_id"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 1800).alias("ts"))
    streamed, out = str(tmp_path / "streamed"), str(tmp_path / "table")
    src.withColumn("event_date", F.to_date("ts")).write.partitionBy("event_date").parquet(streamed)
    table = spark.read.parquet(streamed)
    for day in ("2024-01-01", "2024-01-02", "2024-01-02"):
        tables.compact_days(table, out, "ts", ["stop_id"], day, day, num_partitions=2)
    got = spark.read.parquet(out)
    assert got.count() == 96 and got.distinct().count() == 96
    assert len(got.inputFiles()) < len(table.inputFiles())
    assert dict(got.groupBy("event_date").count().selectExpr("string(event_date)", "count")
                .collect()) == {"2024-01-01": 48, "2024-01-02": 48}


def test_expired_days_are_dropped(spark, tmp_path):
    name = "railyard_retention_probe"
    path = str(tmp_path / "t")
    spark.sql(f"CREATE TABLE {name} (id INT, event_date DATE) USING parquet"
              f" PARTITIONED BY (event_date) LOCATION '{path}'")
    try:
        spark.sql(f"INSERT INTO {name} VALUES (1, DATE'2024-01-01'), (2, DATE'2024-03-01'),"
                  " (3, DATE'2024-03-31')")
        assert tables.drop_expired(spark, name, "2024-03-31", 30) == ["2024-01-01"]
        assert sorted(r.id for r in spark.table(name).collect()) == [2, 3]
        assert tables.drop_expired(spark, name, "2024-03-31", 30) == []
    finally:
        spark.sql(f"DROP TABLE {name}")
