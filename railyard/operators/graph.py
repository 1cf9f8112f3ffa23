"""Station graph: index (A2), transitions (A3), adjacency (A4), diffusion
transition matrices (A8) and K-hop diffusion of a node feature (A9).

Matrices are edge lists ``(from_stop, to_stop, weight)``; an N x N matrix is
never materialised on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .windows import hour_bucket, ordered_neighbor

# Fixed values (reference defaults).
ADJ_THRESHOLD = 0.1
DIFFUSION_EPS = 1e-8
DIFFUSION_STEPS = 2


def station_index(h: DataFrame) -> DataFrame:
    """A2: stops by row count descending (ties: stop_id), position from 0.
    The global rank runs on the per-stop aggregate, one row per stop."""
    c = h.groupBy("stop_id").agg(F.count(F.lit(1)).alias("n_rows"))
    w = Window.orderBy(F.col("n_rows").desc(), F.col("stop_id"))
    return c.select("stop_id", "n_rows", (F.row_number().over(w) - 1).alias("station_idx"))


def stop_transitions(h: DataFrame, bucket_seconds: int = 3600) -> DataFrame:
    """A3: consecutive stops inside (route, direction, trip) ordered by
    arrival time (ties: stop_id), counted per (from, to).  The ``lead`` is
    bucketed by hour so that a trip id that recurs daily is not one task."""
    d = h.select("route_id", "direction", "trip_id", "stop_id", "arrival_time")
    n = ordered_neighbor(d, ["route_id", "direction", "trip_id"], ["arrival_time", "stop_id"],
                         ["stop_id"], hour_bucket("arrival_time", bucket_seconds), "_next",
                         direction="next")
    return (n.where(F.col("_next").isNotNull())
            .groupBy(F.col("stop_id").alias("from_stop"), F.col("_next.stop_id").alias("to_stop"))
            .agg(F.count(F.lit(1)).alias("n_transitions")))


def adjacency(transitions: DataFrame, threshold: float = ADJ_THRESHOLD) -> DataFrame:
    """A4: transition counts divided by their row sum; weights above the
    threshold (strict) are kept and not re-normalised."""
    row = F.sum("n_transitions").over(Window.partitionBy("from_stop"))
    w = transitions.select("from_stop", "to_stop", (F.col("n_transitions") / row).alias("weight"))
    return w.where(F.col("weight") > threshold)


def diffusion_transition(adj: DataFrame, stations: DataFrame, eps: float = DIFFUSION_EPS) -> DataFrame:
    """``(A + I) / (rowsum + eps)`` for A (``forward``) and its transpose
    (``backward``); nodes are the stations of the index."""
    loops = stations.select(F.col("stop_id").alias("from_stop"), F.col("stop_id").alias("to_stop"),
                            F.lit(1.0).alias("weight"))

    def one(edges: DataFrame, name: str) -> DataFrame:
        a = edges.unionByName(loops).groupBy("from_stop", "to_stop") \
            .agg(F.sum("weight").alias("weight"))
        deg = F.sum("weight").over(Window.partitionBy("from_stop"))
        return a.select(F.lit(name).alias("direction"), "from_stop", "to_stop",
                        (F.col("weight") / (deg + eps)).alias("weight"))

    fwd = adj.select("from_stop", "to_stop", "weight")
    bwd = adj.select(F.col("to_stop").alias("from_stop"), F.col("from_stop").alias("to_stop"),
                     "weight")
    return one(fwd, "forward").unionByName(one(bwd, "backward"))


def diffusion_features(trans: DataFrame, features: DataFrame, steps: int = DIFFUSION_STEPS) -> DataFrame:
    """``P^k x`` for k = 0 .. steps-1 in both directions, x a node
    feature ``(stop_id, x)``.  Each hop is a join of the edges with the
    current vector and a ``sum(weight * x)`` per row node."""
    out = []
    for name in ("forward", "backward"):
        p = trans.where(F.col("direction") == name)
        x = features.select("stop_id", F.col("x").alias("value"))
        for k in range(steps):
            if k > 0:
                x = (p.join(x.withColumnRenamed("stop_id", "to_stop"), "to_stop")
                     .groupBy(F.col("from_stop").alias("stop_id"))
                     .agg(F.sum(F.col("weight") * F.col("value")).alias("value")))
            out.append(x.select(F.lit(name).alias("direction"), F.lit(k).alias("k"),
                                "stop_id", "value"))
    res = out[0]
    for o in out[1:]:
        res = res.unionByName(o)
    return res
