"""Exact k-means over integer vectors by dictionaries of subvectors.

The dimensions are split into blocks of ``WIDTH``.  Once, before the rounds,
every run of at most ``CHUNK`` vectors of a task is encoded without loss: for
each block the distinct subvectors and, per vector, the code of its own.  A
round computes the squared distance of each distinct subvector to its block
of every centroid, once, and a vector's distance is the sum of the entries at
its codes; the sums that give the next centroids come from the same codes
(how often a cluster uses each, times the subvector).  All of it in integers.

A dictionary belongs to its chunk, so its size has a bound: one over all
vectors has none, and would have to be sent to every task or joined in each
round.  The encoded chunks are written to the shared folder; nothing is
shuffled but one row of sums per task and cluster, and the driver sees only
the centroids.

Vectors are kept if they have exactly ``dims`` components, none null or not
finite.  A component of 2^21 or more in size is the one further reason to
leave a vector out: squared distances would not fit a long.  Rows without a
vec_id are clustered and come last as first centroids; rows repeating a
vec_id are vectors of their own, as first centroids in the order of their
components.  With fewer than ``k`` kept vectors there are so many clusters;
an empty table gives no rows; further input columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard.llm.common import landed, own_columns

DIMS = 64
K = 16
ROUNDS = 3
SCALE = 64                    # component x becomes floor(SCALE * x)
WIDTH = 2                     # dimensions of a block
CHUNK = 1 << 16               # vectors that share dictionaries; codes fit 16 bits
LIMIT = float(1 << 21)

CHUNKS = ("vec_id array<long>, codes binary, sizes array<int>, words binary, "
          "seeds array<struct<hash:string, vector:array<long>>>")


def encode(vectors: np.ndarray, width: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Codes (n x blocks, 16 bits) and, for each block, its distinct subvectors."""
    n, dims = vectors.shape
    codes, words = np.empty((n, -(-dims // width)), np.uint16), []
    for b, at in enumerate(range(0, dims, width)):
        block = vectors[:, at:at + width]
        code = np.zeros(n, np.int64)
        for column in block.T:                      # mixed radix, made dense after each dimension
            values, digit = np.unique(column, return_inverse=True)
            _, first, code = np.unique(code * len(values) + digit, return_index=True, return_inverse=True)
        codes[:, b] = code
        words.append(block[first])
    return codes, words


def distances(codes: np.ndarray, words: list[np.ndarray], centroids: np.ndarray) -> np.ndarray:
    """Squared distance of every vector (row) to every centroid, by code."""
    total, at = np.zeros((len(codes), len(centroids)), np.int64), 0
    for b, word in enumerate(words):
        part = centroids[:, at:at + word.shape[1]]
        total += ((word[:, None, :] - part[None, :, :]) ** 2).sum(axis=2)[codes[:, b]]
        at += word.shape[1]
    return total


def cluster_sums(codes: np.ndarray, words: list[np.ndarray], cluster: np.ndarray, k: int) -> np.ndarray:
    """Componentwise sum of each cluster's vectors, by code."""
    parts = []
    for b, word in enumerate(words):
        used = np.bincount(cluster * len(word) + codes[:, b], minlength=k * len(word))
        parts.append(used.reshape(k, len(word)) @ word)
    return np.concatenate(parts, axis=1)


def kept_vectors(vectors: DataFrame, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """vec_id, vector (integers) and the hash that orders first centroids."""
    rows = own_columns(vectors, "vec_id", "embedding").select(
        F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("x"))
    fits = F.forall("x", lambda v: v.isNotNull() & (F.abs(v) < LIMIT))
    return rows.where((F.size("x") == dims) & fits).select(
        "vec_id", F.transform("x", lambda v: F.floor(v * scale)).alias("vector"),
        F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256).alias("hash"))


def encoded(kept: DataFrame, dims: int = DIMS, width: int = WIDTH, chunk: int = CHUNK, k: int = K) -> DataFrame:
    """Chunks of :func:`kept_vectors` with their dictionaries, and of each the
    ``k`` vectors that come first by hash."""
    def row(ids, hashes, vectors: np.ndarray) -> tuple:
        codes, words = encode(vectors, width)
        first = sorted(range(len(ids)), key=lambda i: (hashes[i] is None, hashes[i] or "", vectors[i].tolist()))[:k]
        return (ids, codes.tobytes(), [len(w) for w in words], np.concatenate([w.ravel() for w in words]).tobytes(),
                [{"hash": hashes[i], "vector": vectors[i].tolist()} for i in first])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def out(table: pa.Table) -> pa.RecordBatch:
            flat = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            r = row(table.column("vec_id").to_pylist(), table.column("hash").to_pylist(),
                    flat.astype(np.int64).reshape(-1, dims))
            seeds = pa.list_(pa.struct([("hash", pa.string()), ("vector", pa.list_(pa.int64()))]))
            kinds = (pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int32()), pa.binary(), seeds)
            return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(r, kinds, strict=True)],
                                              ["vec_id", "codes", "sizes", "words", "seeds"])

        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            while rows >= chunk:
                table = pa.Table.from_batches(held)
                yield out(table.slice(0, chunk))
                rows -= chunk
                held = table.slice(chunk).to_batches()
        if rows:
            yield out(pa.Table.from_batches(held))

    return kept.mapInArrow(run, CHUNKS)


def _chunks(batches: Iterator[pa.RecordBatch], dims: int, width: int):
    """vec_ids (Arrow), codes and dictionaries of each encoded chunk."""
    for batch in batches:
        for i in range(batch.num_rows):
            sizes = batch.column("sizes")[i].as_py()
            codes = np.frombuffer(batch.column("codes")[i].as_buffer(), np.uint16).reshape(-1, len(sizes))
            flat, words, at = np.frombuffer(batch.column("words")[i].as_buffer(), np.int64), [], 0
            for b, n in enumerate(sizes):
                w = min(width, dims - b * width)
                words.append(flat[at:at + n * w].reshape(n, w))
                at += n * w
            ids = batch.column("vec_id")[i].values if "vec_id" in batch.schema.names else None
            yield ids, codes, words


def next_centroids(chunks: DataFrame, centroids: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """One round: floor of the mean of each cluster; an empty one stays."""
    k, dims = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for _, codes, words in _chunks(batches, dims, width):
            cluster = distances(codes, words, centroids).argmin(axis=1)
            total += cluster_sums(codes, words, cluster, k)
            count += np.bincount(cluster, minlength=k)
        columns = [pa.array(range(k), pa.int32()), pa.array(count), *(pa.array(c) for c in total.T)]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "n", *(f"s{i}" for i in range(dims))])

    schema = "cluster int, n long, " + ", ".join(f"s{i} long" for i in range(dims))
    rows = (chunks.select("codes", "sizes", "words").mapInArrow(sums, schema)
            .groupBy("cluster").agg(*[F.sum(c).alias(c) for c in ("n", *(f"s{i}" for i in range(dims)))]).collect())
    new = centroids.copy()
    for r in rows:                                   # at most k rows
        if r["n"]:
            new[r["cluster"]] = [r[f"s{i}"] // r["n"] for i in range(dims)]
    return new


def assigned(chunks: DataFrame, centroids: np.ndarray, width: int = WIDTH) -> DataFrame:
    """vec_id, cluster, distance of every vector; the smaller number on ties."""
    dims = centroids.shape[1]

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, codes, words in _chunks(batches, dims, width):
            d = distances(codes, words, centroids)
            cluster = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(cluster.astype(np.int32)), pa.array(d[np.arange(len(d)), cluster])],
                ["vec_id", "cluster", "distance"])

    return chunks.select("vec_id", "codes", "sizes", "words").mapInArrow(
        nearest, "vec_id long, cluster int, distance long")


def centroid_hash(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def clustered(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE,
              width: int = WIDTH, chunk: int = CHUNK) -> DataFrame:
    """Cluster of every kept vector: vec_id, cluster, distance,
    cluster_inertia, inertia, centroid_sha256."""
    spark = vectors.sparkSession
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    chunks = landed(encoded(kept_vectors(vectors, dims, scale), dims, width, chunk, k), "subvectors")
    seeds = (chunks.select(F.explode("seeds").alias("s")).select("s.*")
             .orderBy(F.col("hash").asc_nulls_last(), "vector").limit(k).collect())
    centroids = np.array([r["vector"] for r in seeds], np.int64).reshape(-1, dims)
    if not seeds:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, " + schema.split(", ", 1)[1])
    for _ in range(rounds):
        centroids = next_centroids(chunks, centroids, width)
    rows = landed(assigned(chunks, centroids, width), "assigned")
    sums = {r["cluster"]: int(r["d"]) for r in rows.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}            # at most k rows
    fit = lambda n: n if n < 1 << 63 else None                                           # noqa: E731
    found = [(c, fit(d), fit(sum(sums.values())), centroid_hash(centroids[c])) for c, d in sorted(sums.items())]
    return rows.join(F.broadcast(spark.createDataFrame(found, schema)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql(rounds: int = ROUNDS) -> str:
    ctes = [f"""
v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS a
  FROM embeddings WHERE len(embedding) = {DIMS}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND abs(CAST(x AS DOUBLE)) < {int(LIMIT)})) = {DIMS}),
p AS (SELECT r, unnest(range(1, {DIMS + 1})) AS i, unnest(a) AS x FROM v),
t AS (SELECT r, row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR)) NULLS LAST, a) - 1 AS c FROM v),
c0 AS (SELECT c, i, x FROM t JOIN p USING (r) WHERE c < {K})"""]
    for n in range(rounds + 1):
        ctes.append(f"""
d{n} AS (SELECT r, c, sum((p.x - q.x) * (p.x - q.x)) AS d FROM p JOIN c{n} q USING (i) GROUP BY r, c),
a{n} AS (SELECT r, c, d FROM d{n} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)""")
        if n < rounds:
            ctes.append(f"""
s{n} AS (SELECT c, i, sum(x) AS s, count(*) AS n FROM a{n} JOIN p USING (r) GROUP BY c, i),
c{n + 1} AS (
  SELECT q.c, q.i, CAST(coalesce((s - (s % n + n) % n) // n, q.x) AS BIGINT) AS x
  FROM c{n} q LEFT JOIN s{n} USING (c, i))""")
    return "WITH" + ",".join(ctes) + f""",
h AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS h FROM c{rounds} GROUP BY c)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
  CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
  h AS centroid_sha256
FROM a{rounds} JOIN v USING (r) JOIN h USING (c)
"""


SQL = _sql()
