"""Stateful track enrichment of the vehicle stream.

``groupBy(hash of (trip_id, stop_id)).applyInPandasWithState``: one Exchange,
and one state row and one Python call per *group of keys* and micro-batch.
Rules (SURVEY 2.8):

1. rows without trip_id or stop_id are dropped;
2. IN_TRANSIT_TO with a scheduled or actual track overwrites the state
   (tracks, train_id, nyct_direction, cached_at = its vehicle_timestamp),
   nothing is emitted; an update without tracks leaves the state alone;
3./4. STOPPED_AT / INCOMING_AT: age = arrival - cached_at in minutes; above
   15 the row is emitted unchanged (stale); otherwise both tracks are
   overwritten and train_id / nyct_direction filled when missing; no state:
   emitted unchanged;
5. any other status (NULL included) is dropped, before the shuffle.

Inside a micro-batch the rows of a key are sorted by (feed_timestamp,
entity_id) -- the order the batch twin (``tracks.arrival_track_asof``) uses.
All keys of a group are folded at once: the held tracks stand before the new
rows, and each row finds the newest update before it in its key by a running
maximum over row positions.

State is bounded by event time: a held track goes once both its arrival and
the time it was fed lie more than ``keep_minutes`` behind the newest row its
group has seen.  No row is dropped as late, which a watermark with timers
would do; an arrival after that is emitted unchanged, as a stale one is.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from ..operators.headway import ARRIVAL_STATUSES
from ..operators.tracks import STALE_MINUTES, is_track_update
from ..schemas import VEHICLE_COLUMNS, VEHICLE_POSITIONS
from ..functions.columns import truthy

KEY_GROUPS = 256            # fixed for the life of a checkpoint
KEEP_MINUTES = 24 * 60
KEYS = ("trip_id", "stop_id")
TRACKS = ("scheduled_track", "actual_track")
TRAIN = ("train_id", "nyct_direction")
TEXTS = KEYS + TRACKS + TRAIN
# the held tracks of a group of keys, one element a key
STATE_SCHEMA = T.StructType(
    [T.StructField(c, T.ArrayType(T.StringType())) for c in TEXTS]
    + [T.StructField("cached_at_us", T.ArrayType(T.LongType())),
       T.StructField("seen_us", T.ArrayType(T.LongType())), T.StructField("clock_us", T.LongType())])
OUTPUT_SCHEMA = T.StructType(
    [T.StructField(f.name, f.dataType, True) for f in VEHICLE_POSITIONS.fields]
    + [T.StructField("enrichment", T.StringType())])
OUT_COLS = [f.name for f in OUTPUT_SCHEMA.fields]
NEVER = np.iinfo(np.int64).min // 4


def _truthy_str(a: np.ndarray) -> np.ndarray:
    return np.array([x is not None and x == x and x != "" for x in a], bool)


def _micros(s: pd.Series) -> np.ndarray:
    out = s.to_numpy("datetime64[us]").astype(np.int64)
    return np.where(s.isna().to_numpy(), NEVER, out)


def newest_before(code: np.ndarray, update: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows in order, by key code: the row of the newest update of the
    same key before each row, and of each key's last update (-1: none)."""
    order = np.argsort(code, kind="stable")
    c, n = code[order], len(code)
    first = np.flatnonzero(np.r_[True, c[1:] != c[:-1]]) if n else np.zeros(0, np.int64)
    begin = np.repeat(first, np.diff(np.r_[first, n]))
    last = np.maximum.accumulate(np.where(update[order], np.arange(n), -1)) if n else np.zeros(0, np.int64)
    prev = np.r_[-1, last[:-1]][:n]
    at = np.full(n, -1, np.int64)
    at[order] = np.where(prev >= begin, order[prev], -1)
    ends = np.r_[first[1:], n][:len(first)] - 1
    return at, np.where(last[ends] >= first, order[last[ends]], -1)


def make_fold(stale_minutes: float = STALE_MINUTES, keep_minutes: float | None = KEEP_MINUTES):
    stale_us = int(stale_minutes * 60e6)

    def fold(key, pdfs, state):
        held = dict(zip(STATE_SCHEMA.names, state.get, strict=True)) if state.exists else \
            {c: [] for c in STATE_SCHEMA.names} | {"clock_us": NEVER}
        new = pd.concat(list(pdfs), ignore_index=True) \
            .sort_values(["feed_timestamp", "entity_id"], kind="mergesort").reset_index(drop=True)
        k, n = len(held["trip_id"]), len(new)
        text = {c: np.concatenate([np.array(held[c], object), new[c].to_numpy(object)]) for c in TEXTS}
        time = np.concatenate([np.array(held["cached_at_us"], np.int64), _micros(new["vehicle_timestamp"])])
        seen = np.concatenate([np.array(held["seen_us"], np.int64), _micros(new["feed_timestamp"])])
        status = new["current_status"]
        updates = (status == "IN_TRANSIT_TO").to_numpy() & (
            _truthy_str(text["scheduled_track"][k:]) | _truthy_str(text["actual_track"][k:]))
        code = pd.MultiIndex.from_arrays([text[c] for c in KEYS]).factorize()[0]
        at, final = newest_before(code, np.r_[np.ones(k, bool), updates])

        arrives = k + np.flatnonzero(status.isin(ARRIVAL_STATUSES).to_numpy())
        src = at[arrives]
        found, src = src >= 0, np.maximum(src, 0)
        fresh = found & (time[arrives] != NEVER) & (time[src] != NEVER) & (time[arrives] - time[src] <= stale_us)
        out = new.iloc[arrives - k].copy()
        for c in TRACKS + TRAIN:
            own = text[c][arrives]
            take = fresh if c in TRACKS else fresh & ~_truthy_str(own)
            out[c] = np.where(take, text[c][src], own)
        out["enrichment"] = np.where(~found, "no_track", np.where(fresh, "enriched", "stale"))

        clock = max(held["clock_us"], int(seen.max(initial=NEVER)))
        final = final[final >= 0]
        if keep_minutes is not None:
            final = final[np.maximum(time[final], seen[final]) >= clock - int(keep_minutes * 60e6)]
        if len(final):
            state.update((*[text[c][final].tolist() for c in TEXTS], time[final].tolist(), seen[final].tolist(), clock))
        elif state.exists:
            state.remove()
        if len(out):
            yield out[OUT_COLS]

    return fold


def enrich_tracks(records: DataFrame, stale_minutes: float = STALE_MINUTES,
                  keep_minutes: float | None = KEEP_MINUTES, key_groups: int = KEY_GROUPS) -> DataFrame:
    """T1 on a (streaming or batch) frame of validated vehicle rows.

    ``keep_minutes=None`` keeps every held track for ever, as the reference
    does.  ``key_groups`` is how many state rows there are; it must not change
    while a checkpoint is in use."""
    r = records.where(truthy(F.col("trip_id")) & truthy(F.col("stop_id"))
                      & (is_track_update() | F.col("current_status").isin(*ARRIVAL_STATUSES))) \
        .select(*VEHICLE_COLUMNS)
    r = r.withColumn("key_group", F.pmod(F.xxhash64(*KEYS), F.lit(key_groups)))
    return r.groupBy("key_group").applyInPandasWithState(
        make_fold(stale_minutes, keep_minutes), OUTPUT_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout)


def held_tracks(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """The state of T1 as a table, one row per (trip_id, stop_id), read
    from the checkpoint by the state data source (the last committed batch,
    or ``batch_id``)."""
    r = spark.read.format("statestore")
    if batch_id is not None:
        r = r.option("batchId", batch_id)
    lists = [f.name for f in STATE_SCHEMA.fields if isinstance(f.dataType, T.ArrayType)]
    s = r.load(checkpoint).select(F.col("key.key_group"), "value.groupState.*")
    rows = s.select("key_group", F.explode(F.arrays_zip(*lists)).alias("h"))
    return rows.select("key_group", *[f"h.{c}" for c in TEXTS],
                       F.when(F.col("h.cached_at_us") != NEVER, F.timestamp_micros("h.cached_at_us")).alias("cached_at"),
                       F.timestamp_micros("h.seen_us").alias("seen_at"))
