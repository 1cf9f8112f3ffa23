"""Table access: scans, date-range reads and the partitioned table sinks."""

from __future__ import annotations

import os
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


_DEFINED: dict = {}


def defined(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """Define an input frame once per session and folder, as a temp view
    would: the lazy plan is reused, no data is cached."""
    key = (spark, os.path.abspath(sf_dir), name)
    if key not in _DEFINED:
        _DEFINED[key] = build()
    return _DEFINED[key]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table.  Column pruning and filters reach the parquet scan
    because callers only ``select``/``where`` on the returned frame."""
    return defined(spark, sf_dir, f"table:{name}",
                   lambda: spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet")))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event fact table every fixture derives from."""
    return read_table(spark, sf_dir, "events")


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``vehicle_positions`` table (FIXTURES.md view over the whole
    ``events``), stored day-partitioned and clustered by route, direction
    and stop as the warehouse table is; queries read the table and can
    prune on ``event_date``."""
    from .fixtures import raw_positions
    return landed(spark, sf_dir, "vehicle_positions", lambda path: write_partitioned(
        raw_positions(events(spark, sf_dir)), path, "vehicle_timestamp",
        ["route_id", "direction", "stop_id"], mode="overwrite"))


def date_range(df: DataFrame, time_col: str, start: str | date | None = None,
               end: str | date | None = None, date_col: str | None = None) -> DataFrame:
    """``DATE(time_col) BETWEEN start AND end``, both ends inclusive.

    When the table is partitioned by a date column (``date_col``), the
    predicate is put on that column as well so that partitions are pruned;
    ``to_date(ts)`` alone does not prune.
    """
    d = F.to_date(F.col(time_col))
    cond = F.lit(True)
    if start is not None:
        cond = cond & (d >= F.lit(str(start)).cast("date"))
        if date_col:
            cond = cond & (F.col(date_col) >= F.lit(str(start)).cast("date"))
    if end is not None:
        cond = cond & (d <= F.lit(str(end)).cast("date"))
        if date_col:
            cond = cond & (F.col(date_col) <= F.lit(str(end)).cast("date"))
    return df.where(cond)


def write_partitioned(df: DataFrame, path: str, time_col: str, cluster_by: list[str],
                      date_col: str = "event_date", mode: str = "append",
                      num_partitions: int | None = None, replace_days: bool = False) -> None:
    """Day-partitioned, clustered table: one folder per date of ``time_col``,
    rows range-partitioned on (date, clustering columns) and sorted within
    each file, so parquet min/max statistics skip row groups.  Range
    partitioning spreads one busy day over many tasks and files instead of
    sending a whole day to one task.  Appends are atomic per job;
    ``replace_days`` with mode overwrite replaces only the days in ``df``."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.withColumn(date_col, F.to_date(F.col(time_col)))
       .repartitionByRange(n, date_col, *cluster_by)
       .sortWithinPartitions(date_col, *cluster_by)
       .write.mode(mode).partitionBy(date_col)
       .option("partitionOverwriteMode", "dynamic" if replace_days else "static").parquet(path))


def landed(spark: SparkSession, sf_dir: str, name: str, write) -> DataFrame:
    """Derived input stored once per session under the shared checkpoint
    folder (``spark.checkpoint.dir``) and read back, the way the pipeline
    lands messages and tables for the jobs that read them.  ``write(path)``
    writes it."""
    import hashlib

    from ..session import scratch_path

    def land():
        digest = hashlib.sha1(os.path.abspath(sf_dir).encode()).hexdigest()[:12]
        path = scratch_path(spark, f"landing/{spark.sparkContext.applicationId}/{digest}/{name}")
        write(path)
        return spark.read.parquet(path)
    return defined(spark, sf_dir, f"landed:{name}", land)


def compact_days(df: DataFrame, path: str, time_col: str, cluster_by: list[str],
                 start: str | date, end: str | date, date_col: str = "event_date",
                 num_partitions: int | None = None) -> None:
    """Rewrite closed days of a streamed table (``df``, many small files per
    day) into the clustered table at ``path``.  Only the days in the range are
    replaced, so a repeated run gives the same table; the streamed table keeps
    its files, whose commit log the stream owns."""
    days = date_range(df, time_col, start, end, date_col if date_col in df.columns else None)
    write_partitioned(days.drop(date_col), path, time_col, cluster_by, date_col,
                      mode="overwrite", num_partitions=num_partitions, replace_days=True)


def expired_dates(spark: SparkSession, path: str, today: str | date, keep_days: int = 90,
                  date_col: str = "event_date") -> DataFrame:
    """Partitions older than the retention period (90 days by default).

    Only the partition column is read, so the scan touches file metadata.
    """
    cutoff = F.date_sub(F.lit(str(today)).cast("date"), keep_days)
    return (spark.read.parquet(path).select(date_col).distinct()
            .where(F.col(date_col) < cutoff))


def drop_expired(spark: SparkSession, table: str, today: str | date, keep_days: int = 90,
                 date_col: str = "event_date") -> list[str]:
    """Drop the day partitions of a catalog table that are older than the
    retention period and return their dates.  The driver gets the names of
    expired days, one per day of the table."""
    cutoff = F.date_sub(F.lit(str(today)).cast("date"), keep_days)
    old = [str(r[0]) for r in spark.table(table).select(date_col).distinct()
           .where(F.col(date_col) < cutoff).orderBy(date_col).collect()]
    for day in old:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({date_col} = DATE '{day}')")
    return old


def retain(df: DataFrame, today: str | date, keep_days: int = 90,
           date_col: str = "event_date") -> DataFrame:
    """Rows inside the retention period; prunes partitions on ``date_col``."""
    cutoff = F.date_sub(F.lit(str(today)).cast("date"), keep_days)
    return df.where(F.col(date_col) >= cutoff)


# The columns of the track extract, in order.
TRACK_CSV_COLUMNS = ["trip_id", "route_id", "train_id", "direction", "stop_id",
                     "scheduled_track", "actual_track"]


def export_track_csv(df: DataFrame, path: str) -> bool:
    """Track rows to CSV with a header and the seven extract columns.

    Nothing is written when the frame is empty (checked with a one-row
    probe, not a count).  Returns whether files were written.
    """
    rows = df.select(*TRACK_CSV_COLUMNS)
    if not rows.take(1):
        return False
    rows.write.mode("overwrite").option("header", True).csv(path)
    return True
