"""SQL entry point: the warehouse names as Spark temp views.

``register_views`` makes the tables and the view of the reference queryable
with ``spark.sql``: ``vehicle_positions`` (enriched arrivals, what the
current stream writes), ``vehicle_positions_raw`` (validated rows of every
status, what the earlier stream wrote and the view reads),
``service_alerts`` and ``arrivals_with_tracks``.  Spark's own SQL parser and
optimizer run the text; nothing here parses SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import parse, planned, tracks
from ..schemas import ALERTS_MESSAGE
from ..sources import fixtures
from ..sources.tables import events, positions


def register_views(spark: SparkSession, sf_dir: str | None = None,
                   raw: DataFrame | None = None, alerts: DataFrame | None = None) -> list[str]:
    """Register the views over stored tables (``raw``, ``alerts``) or, given
    ``sf_dir``, over the fixtures derived from the driver tables."""
    if raw is None:
        raw = positions(spark, sf_dir)
    if alerts is None:
        dec = parse.decode(fixtures.alert_messages(events(spark, sf_dir)), ALERTS_MESSAGE)
        alerts = parse.alert_table(dec)
    views = {
        "vehicle_positions_raw": raw,
        "vehicle_positions": tracks.arrival_track_asof(raw).drop("enrichment"),
        "service_alerts": alerts,
        "service_alerts_latest": planned.alerts_latest(alerts),
        "arrivals_with_tracks": tracks.arrivals_with_tracks(raw),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return sorted(views)
