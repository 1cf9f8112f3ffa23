"""Ordered neighbour look-ups that stay parallel when one key is hot.

``LAG``/``LEAD``/"last value so far" over ``PARTITION BY key ORDER BY t``
puts a whole key into one task.  Feed keys (a station, a trip id that recurs
every day) can hold a large share of all rows, so these helpers split each
key's timeline into time buckets:

1. the window runs per ``(key, bucket)``, so a hot key is spread over many
   tasks;
2. a per-``(key, bucket)`` summary (``max_by``/``min_by``, partially
   aggregated before the shuffle) gives the edge row of each bucket;
3. a window over the summaries (one row per key and bucket) carries the edge
   of the nearest earlier/later bucket, which is joined back on
   ``(key, bucket)`` -- the same keys the first window is partitioned by, so
   the large side is not shuffled again.

The result equals the plain window for any total order ``order``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET = "_bucket"


def hour_bucket(ts_col: str, seconds: int = 3600) -> Column:
    """Time bucket of a timestamp; monotone in the timestamp."""
    return F.floor(F.unix_micros(F.col(ts_col)) / (seconds * 1_000_000)).cast("bigint")


def _pack(values: list[str]) -> Column:
    return F.struct(*[F.col(v).alias(v) for v in values])


def ordered_neighbor(df: DataFrame, keys: list[str], order: list[str], values: list[str],
                     bucket: Column, out: str, direction: str = "prev") -> DataFrame:
    """Add struct column ``out`` holding ``values`` of the previous
    (``direction="prev"``) or next row of the same ``keys`` in ascending
    ``order`` (a total order; ``bucket`` must be monotone in it).  NULL for
    the first (last) row of a key."""
    prev = direction == "prev"
    d = df.withColumn(BUCKET, bucket)
    w = Window.partitionBy(*keys, BUCKET).orderBy(*order)
    pack = _pack(values)
    inner = (F.lag(pack, 1) if prev else F.lead(pack, 1)).over(w)
    d = d.withColumn("_nb_in", inner)
    okey = F.struct(*[F.col(c) for c in order])
    edge = F.max_by(pack, okey) if prev else F.min_by(pack, okey)
    summ = df.withColumn(BUCKET, bucket).groupBy(*keys, BUCKET).agg(edge.alias("_edge"))
    ws = Window.partitionBy(*keys).orderBy(BUCKET)
    carry = (F.lag("_edge", 1) if prev else F.lead("_edge", 1)).over(ws)
    summ = summ.select(*keys, BUCKET, carry.alias("_nb_carry"))
    j = d.join(summ, [*keys, BUCKET], "left")
    return j.withColumn(out, F.coalesce(F.col("_nb_in"), F.col("_nb_carry"))) \
        .drop("_nb_in", "_nb_carry", BUCKET)


def asof_last(df: DataFrame, keys: list[str], order: list[str], is_source: Column,
              values: list[str], bucket: Column, out: str) -> DataFrame:
    """Add struct column ``out``: ``values`` of the last row with
    ``is_source`` strictly before each row in ascending ``order`` within
    ``keys`` (NULL when there is none).  Exact and skew-safe."""
    d = df.withColumn(BUCKET, bucket).withColumn("_src", is_source)
    pack = F.when(F.col("_src"), _pack(values))
    w = Window.partitionBy(*keys, BUCKET).orderBy(*order) \
        .rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("_nb_in", F.last(pack, ignorenulls=True).over(w))
    # one row per (key, bucket) that holds any row; its edge is the newest
    # source row, NULL when it has none (max_by skips NULL orderings)
    okey = F.when(is_source, F.struct(*[F.col(c) for c in order]))
    buckets = (df.withColumn(BUCKET, bucket).groupBy(*keys, BUCKET)
               .agg(F.max_by(F.when(is_source, _pack(values)), okey).alias("_edge")))
    ws = Window.partitionBy(*keys).orderBy(BUCKET) \
        .rowsBetween(Window.unboundedPreceding, -1)
    carried = buckets.select(*keys, BUCKET,
                             F.last("_edge", ignorenulls=True).over(ws).alias("_nb_carry"))
    j = d.join(carried, [*keys, BUCKET], "left")
    return j.withColumn(out, F.coalesce(F.col("_nb_in"), F.col("_nb_carry"))) \
        .drop("_nb_in", "_nb_carry", "_src", BUCKET)
