"""SimHash near-duplicates by the generalised pigeonhole principle.

The bits of a fingerprint are grouped into a few partitions, correlated bits
together.  Two fingerprints at distance d or less agree within t_i bits in at
least one partition i whenever the sum of (t_i + 1) is d + 1, so every
fingerprint spends d + 1 units on its own partitions: none skips a partition,
one asks for the same value there, two for values one bit away, and so on.
The cheapest split, probes plus estimated candidates, is found per
fingerprint by dynamic programming.  Probes meet the plain partition values
of all fingerprints in one shuffle, and every candidate is verified.

Only distinct fingerprints are compared, and a probe group hands on a
spanning forest of its links, never all its pairs.  A group above
``BLOCK`` rows is split into blocks that meet block by block.

Null and wordless texts have fingerprint zero and are linked like any other.
A component of rows without a doc_id has component_id null; repeated rows
share a component; an empty table gives no rows.  Other input columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard.llm.common import fresh, landed, own_columns, python_batches

BITS = 64
SHINGLE = 4
DISTANCE = 4
PARTITIONS = 3
BLOCK = 4096            # rows of one side of a probe group that meet in one piece
BROADCAST_ROWS = 50_000  # 16 bytes each; beyond it the join shuffles
BINS = 11               # bits of one histogram of the candidate estimate


def _fingerprint(text: bytes | None, shingle: int) -> int:
    import xxhash
    words = (text or b"").lower().split()       # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    digest = xxhash.xxh64_intdigest
    if len(words) < shingle:
        hashes = [digest(joined, 42)]
    else:
        last = (ends[shingle - 1:] - 1).tolist()
        hashes = [digest(joined[a:b], 42) for a, b in zip([0, *ends.tolist()], last, strict=False)]
    n = len(hashes)
    raw = np.array(hashes, "<u8").view(np.uint8).reshape(n, 8)
    ones = np.zeros(BITS, np.int64)
    for a in range(0, n, 1 << 16):
        ones += np.unpackbits(raw[a:a + (1 << 16)], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and the 64-bit fingerprint (signed) of every whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done: dict[bytes | None, int] = {}          # copies stand close together
            fps = []
            for text in batch.column(1).to_pylist():
                if text not in done:
                    done[text] = _fingerprint(text, shingle)
                fps.append(done[text])
            fp = pa.array(np.array(fps, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), fp], ["doc_id", "fp"])

    python_batches(docs.sparkSession, 2000)
    texts = own_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long"),
                                                       F.col("text").cast("string").cast("binary"))
    return texts.mapInArrow(run, "doc_id long, fp long")


# ------------------------------------------------------------- partitions

def _bit_columns(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_groups(distinct: DataFrame, partitions: int = PARTITIONS) -> list[list[int]]:
    """Bits dealt into groups of nearly equal width, correlated bits together.

    Joint counts of all bit pairs come from the whole column: 64 x 64 sums per
    task, added up by Spark; 4,096 numbers reach the driver at any input size.
    """
    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((BITS, BITS))
        for pdf in frames:
            bits = _bit_columns(pdf["fp"].to_numpy(np.int64)).astype(np.float32)
            total += bits.T @ bits
        a, b = np.divmod(np.arange(BITS * BITS), BITS)
        yield pd.DataFrame({"a": a, "b": b, "n": total.ravel()})

    rows = (distinct.select("fp").mapInPandas(count, "a long, b long, n double")
            .groupBy("a", "b").agg(F.sum("n").alias("n")).collect())
    joint = np.zeros((BITS, BITS))
    for r in rows:
        joint[r["a"], r["b"]] = r["n"]
    n = max(1, distinct.count())
    p = np.diag(joint) / n
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    tie = np.abs((joint / n - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(tie, 0)
    left, groups = list(range(BITS)), []
    for k in range(partitions):
        width = BITS // partitions + (k < BITS % partitions)
        group = [max(left, key=lambda b: (tie[b, left].sum(), -b))]
        left.remove(group[0])
        while len(group) < width:
            nxt = max(left, key=lambda b: (tie[b, group].sum(), -b))
            group.append(nxt)
            left.remove(nxt)
        groups.append(sorted(group))
    return groups


def _gather(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    """The named bits of each fingerprint, packed into the low bits."""
    out = np.zeros(len(fps), np.uint64)
    for k, b in enumerate(bits):
        out |= ((fps >> np.uint64(b)) & np.uint64(1)) << np.uint64(k)
    return out


def _halves(groups: list[list[int]]) -> list[list[list[int]]]:
    return [[g[i:i + BINS] for i in range(0, len(g), BINS)] for g in groups]


def estimates(distinct: DataFrame, groups: list[list[int]], distance: int) -> list[list[np.ndarray]]:
    """For every part of a group (at most 2^11 values): the share of
    fingerprints at each small distance from each value."""
    parts = [(i, j, bits) for i, h in enumerate(_halves(groups)) for j, bits in enumerate(h)]

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = [np.zeros(1 << len(bits), np.int64) for _, _, bits in parts]
        for pdf in frames:
            fps = pdf["fp"].to_numpy(np.int64).view(np.uint64)
            for s, (_, _, bits) in zip(sums, parts, strict=True):
                s += np.bincount(_gather(fps, bits).astype(np.int64), minlength=len(s))
        for k, s in enumerate(sums):
            v = np.flatnonzero(s)
            yield pd.DataFrame({"part": np.full(len(v), k), "v": v, "n": s[v]})

    found = (distinct.select("fp").mapInPandas(count, "part long, v long, n long")
             .groupBy("part", "v").agg(F.sum("n").alias("n")).toPandas())
    out: list[list[np.ndarray]] = [[] for _ in groups]
    for k, (i, _, bits) in enumerate(parts):
        own = found[found["part"] == k]
        n = np.zeros(1 << len(bits))
        n[own["v"].to_numpy()] = own["n"].to_numpy()
        # counts at exact distance r, one bit after the other
        at = np.zeros((distance + 1, len(n)))
        at[0] = n
        value = np.arange(len(n))
        for b in range(len(bits)):
            moved = np.zeros_like(at)
            moved[1:] = at[:-1][:, value ^ (1 << b)]
            at = at + moved
        out[i].append((at / max(1.0, n.sum())).astype(np.float32))
    return out


def allocate(fps: np.ndarray, groups: list[list[int]], shares: list[list[np.ndarray]], total: int,
             distance: int) -> np.ndarray:
    """Units per fingerprint and group, by dynamic programming on probes plus
    estimated candidates."""
    cost = np.zeros((len(groups), distance + 2, len(fps)), np.float32)
    for i, (bits, parts) in enumerate(zip(groups, _halves(groups), strict=True)):
        near = np.zeros((distance + 1, len(fps)), np.float32)
        near[0] = 1.0
        for part, share in zip(parts, shares[i], strict=True):
            own = share[:, _gather(fps, part).astype(np.int64)]
            near = np.stack([sum(near[a] * own[r - a] for a in range(r + 1)) for r in range(distance + 1)])
        probes = np.cumsum([comb(len(bits), r) for r in range(distance + 1)])
        cost[i, 1:] = probes[:, None] + total * np.cumsum(near, axis=0)
    best = np.full((distance + 2, len(fps)), np.inf, np.float32)
    best[0] = 0
    chosen = np.zeros((len(groups), distance + 2, len(fps)), np.int8)
    for i in range(len(groups)):
        new = np.full_like(best, np.inf)
        for u in range(distance + 2):
            for give in range(u + 1):
                c = best[u - give] + cost[i, give]
                better = c < new[u]
                new[u][better] = c[better]
                chosen[i, u][better] = give
        best = new
    units = np.zeros((len(fps), len(groups)), np.int8)
    left = np.full(len(fps), distance + 1)
    every = np.arange(len(fps))
    for i in reversed(range(len(groups))):
        units[:, i] = chosen[i, left, every]
        left = left - units[:, i]
    return units


# ------------------------------------------------------------- probing

def _keyed(distinct: DataFrame, groups: list[list[int]], shares: list[list[np.ndarray]], total: int,
           distance: int) -> DataFrame:
    """(key, fp, probe): each group's own value, and the probes around it."""
    flips = [[np.array([sum(1 << b for b in c) for c in combinations(range(len(g)), r)] or [0], np.uint64)
              for r in range(distance + 1)] for g in groups]

    def keys(values: np.ndarray, group: int) -> np.ndarray:
        return ((values << np.uint64(3)) | np.uint64(group)).view(np.int64)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in frames:
            for at in range(0, len(whole), 4096):
                fps = whole["fp"].to_numpy(np.int64)[at:at + 4096].view(np.uint64)
                units = allocate(fps, groups, shares, total, distance)
                for i, bits in enumerate(groups):
                    value = _gather(fps, bits)
                    yield pd.DataFrame({"key": keys(value, i), "fp": fps.view(np.int64), "probe": False})
                    for r in range(distance + 1):
                        own = units[:, i] > r
                        if own.any():
                            near = value[own][:, None] ^ flips[i][r][None, :]
                            yield pd.DataFrame({"key": keys(near.ravel(), i), "probe": True,
                                                "fp": np.repeat(fps[own].view(np.int64), near.shape[1])})

    return distinct.select("fp").mapInPandas(run, "key long, fp long, probe boolean")


def _forest(x: np.ndarray, y: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that join what probes ``x`` and values ``y`` of one group join.

    Breadth first: whoever is reached leaves the search, so a dense group
    costs about its size, and at most one link per member is handed on.
    """
    out = []
    x_left, y_left = np.unique(x), np.unique(y)
    while len(x_left) and len(y_left):
        front, side, x_left = [x_left[0]], 0, x_left[1:]
        todo = [(front[0], 0)]
        while todo:
            v, side = todo.pop()
            pool = y_left if side == 0 else x_left
            if not len(pool):
                continue
            near = np.bitwise_count(pool ^ v) <= distance
            reached = pool[near]
            if side == 0:
                y_left = pool[~near]
            else:
                x_left = pool[~near]
            out += [(int(v), int(w)) for w in reached if w != v]
            todo += [(w, 1 - side) for w in reached]
    return out


def _meet(frames: Iterator[pd.DataFrame], distance: int) -> Iterator[pd.DataFrame]:
    """Links of groups that arrive sorted by (key, block); a group spans
    batches at most by one, and holds at most two blocks."""
    rest: pd.DataFrame | None = None

    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        key = pdf["group"].to_numpy()
        fp = pdf["fp"].to_numpy(np.int64).view(np.uint64)
        probe = pdf["probe"].to_numpy(bool)
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        n = np.diff(np.r_[starts, len(key)])
        values = np.add.reduceat(~probe, starts, dtype=np.int64) if len(starts) else n
        work = values * (n - values)
        found: list[np.ndarray] = []
        # values stand first in a group (false sorts before true)
        small = (work > 0) & (work <= 64)
        if small.any():
            s, v, p = starts[small], values[small], (n - values)[small]
            reps = v * p
            base = np.repeat(np.arange(len(s)), reps)
            k = np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
            y = fp[s[base] + k // p[base]]
            x = fp[s[base] + v[base] + k % p[base]]
            near = (x != y) & (np.bitwise_count(x ^ y) <= distance)
            found.append(np.stack([x[near], y[near]], axis=1))
        for at in np.flatnonzero(work > 64):
            a, m = starts[at], starts[at] + values[at]
            pairs = _forest(fp[m:starts[at] + n[at]], fp[a:m], distance)
            if pairs:
                found.append(np.array(pairs, np.uint64))
        pairs = np.concatenate(found) if found else np.zeros((0, 2), np.uint64)
        pairs = np.unique(np.sort(pairs, axis=1), axis=0).view(np.int64)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    for pdf in frames:
        pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
        whole = pdf["group"] != pdf["group"].iloc[-1] if len(pdf) else pd.Series([], dtype=bool)
        rest = pdf[~whole]
        if whole.any():
            yield links(pdf[whole])
    if rest is not None and len(rest):
        yield links(rest)


def links(distinct: DataFrame, distance: int = DISTANCE, partitions: int = PARTITIONS,
          block: int = BLOCK) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints at ``distance`` or less: not all
    of them, but enough to join whatever any of them joins."""
    total = distinct.count()
    groups = bit_groups(distinct, partitions)
    shares = estimates(distinct, groups, distance)
    keyed = landed(_keyed(distinct, groups, shares, total, distance), "probes")
    sides = keyed.groupBy("key").agg(F.count(F.when(~F.col("probe"), 1)).alias("values"),
                                     F.count(F.when(F.col("probe"), 1)).alias("probes"))
    met = sides.where("values > 0 and probes > 0")
    large = landed(met.where((F.col("values") > block) | (F.col("probes") > block)).select(
        "key", F.ceil(F.col("values") / block).cast("int").alias("vb"),
        F.ceil(F.col("probes") / block).cast("int").alias("pb")), "large")
    if large.count() <= BROADCAST_ROWS:
        large = F.broadcast(large)
    # a large group's value block v meets its probe block p in the piece (v, p)
    split = (keyed.join(large, "key", "left")
             .withColumn("own", F.pmod(F.xxhash64("fp"), F.coalesce(
                 F.when(F.col("probe"), F.col("pb")).otherwise(F.col("vb")), F.lit(1))))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce(
                 F.when(F.col("probe"), F.col("vb")).otherwise(F.col("pb")), F.lit(1)) - 1)))
             .select(F.xxhash64("key", F.when(F.col("probe"), F.col("other")).otherwise(F.col("own")),
                                F.when(F.col("probe"), F.col("own")).otherwise(F.col("other"))).alias("group"),
                     "fp", "probe"))
    n = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    python_batches(distinct.sparkSession, 100_000)
    return (split.repartition(n, "group").sortWithinPartitions("group", "probe")
            .mapInPandas(lambda frames: _meet(frames, distance), "a long, b long"))


# ------------------------------------------------------------- components

def components(pairs: DataFrame) -> DataFrame:
    """(node, root): each linked node with the least node of its component.

    Large-star / small-star rounds: every round is two grouped aggregations
    and joins over at most as many links as there were, with a written table
    between rounds, until the links no longer change.
    """
    pairs = landed(pairs.distinct(), "links")
    seen = None
    while True:
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # large star: larger neighbours move to the least of the neighbourhood
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        # small star: smaller neighbours and the node itself move there, too
        down = large.where("a > b").distinct()
        lows = down.groupBy("a").agg(F.min("b").alias("m"))
        small = (down.join(lows, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(lows.select("a", F.col("m").alias("b"))).where("a > b").distinct())
        pairs = landed(small, "links")
        state = pairs.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
        if state == seen:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE,
                    partitions: int = PARTITIONS, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, fp, fingerprint (16 hex digits) and
    component_id, the least doc_id that links reach from it."""
    own = landed(fingerprints(docs, shingle), "fingerprints")
    distinct = landed(own.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = components(links(distinct, distance, partitions, block))
    classes = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = landed(classes.join(ids, "root").select("fp", "component_id"), "classes")
    return own.join(by_fp, "fp").select(
        "doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def survivors(docs: DataFrame, **how) -> DataFrame:
    """The documents less all but one of each component: the one with the
    least doc_id stays.  Rows without a doc_id stay; of rows that repeat a
    doc_id one stays."""
    keep = fresh(docs, "keep")
    ids = near_duplicates(docs, **how).where("doc_id = component_id").select(F.col("doc_id").alias(keep)).distinct()
    named = docs.join(ids, F.col("doc_id").cast("long") == F.col(keep)).drop(keep)
    return named.dropDuplicates(["doc_id"]).unionByName(docs.where("doc_id is null"))
