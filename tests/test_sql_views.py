"""The reference's report SQL, in Spark's dialect, over the registered views
equals the DataFrame reports."""

from pyspark.sql import functions as F

from railyard.operators import reports, tracks
from railyard.plans.views import register_views
from railyard.sources.tables import positions


def test_coverage_sql_matches_report(spark, sf_dir):
    register_views(spark, sf_dir)
    sql = spark.sql("""
        SELECT COUNT(*) AS total_records,
               COUNT_IF(actual_track IS NOT NULL) AS with_actual_track,
               COUNT_IF(scheduled_track IS NOT NULL) AS with_scheduled_track,
               COUNT_IF(train_id IS NOT NULL) AS with_train_id,
               ROUND(100.0 * COUNT_IF(actual_track IS NOT NULL) / COUNT(*), 1)
                 AS track_coverage_pct
        FROM vehicle_positions""").first()
    enriched = tracks.arrival_track_asof(positions(spark, sf_dir))
    df = reports.track_coverage(enriched).first()
    assert sql.total_records == df.total_records > 0
    assert sql.with_actual_track == df.with_actual_track
    assert sql.with_train_id == df.with_train_id
    assert float(sql.track_coverage_pct) == df.track_coverage_pct


def test_latest_and_frequency_sql(spark, sf_dir):
    register_views(spark, sf_dir)
    top = spark.sql("""
        SELECT trip_id, stop_id, actual_track, scheduled_track, train_id,
               nyct_direction, vehicle_timestamp
        FROM vehicle_positions WHERE actual_track IS NOT NULL
        ORDER BY vehicle_timestamp DESC, entity_id DESC LIMIT 10""").collect()
    enriched = tracks.arrival_track_asof(positions(spark, sf_dir))
    assert top == reports.latest_tracked(enriched).collect()
    freq = spark.sql("""
        SELECT actual_track, COUNT(*) AS count FROM vehicle_positions
        WHERE actual_track IS NOT NULL GROUP BY actual_track
        ORDER BY count DESC, actual_track""").collect()
    assert freq == reports.track_frequency(enriched).collect()


def test_view_sql(spark, sf_dir):
    register_views(spark, sf_dir)
    n = spark.sql("""SELECT COUNT(*) AS n, COUNT(actual_track) AS tracked
                     FROM arrivals_with_tracks""").first()
    arr = positions(spark, sf_dir).where(
        F.col("current_status").isin("STOPPED_AT", "INCOMING_AT")).count()
    assert n.n >= arr and n.tracked <= n.n
    assert spark.sql("SELECT COUNT(*) FROM service_alerts_latest").first()[0] > 0
