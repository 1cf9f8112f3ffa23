"""Interaction audit of five filters over all 120 orders of application.

A document is known by the set of filters it fails (a mask of 5 bits).  The
orders that begin with the same letters are neighbours in lexicographic
order, so the orders in which a mask is removed at step k by the k-th letter
are intervals of Lehmer ranks: one for every beginning whose last letter
alone is in the mask, (5 - k)! ranks long.  Per part and mask, the counts are
added at the beginning of each interval and taken off at its end; one prefix
sum over the 120 ranks of a step then gives the removals of every order.

Per document a few numbers are kept beside a digest of its text (SHA-256):
copies meet by digest and doc_id, never by digest alone, so a large group of
copies is spread over tasks, and repeated rows are counted before they move.

Null text counts as empty, null source as the part with the empty name; rows
without a doc_id are documents without labels that fail E never and make no
other row fail it; rows repeating a doc_id are documents of their own, and
equal texts under one doc_id do not fail E by each other; a document is good
(toxic) if any row of ``labels`` says so; an empty table has no parts and
gives no rows; further input columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from railyard.llm.common import landed, own_columns, small_batches

LETTERS = "ABCDE"
STEPS = len(LETTERS)
MIN_WORDS = 200               # A: fewer words
MIN_DISTINCT = 50             # B: percent of distinct words
MAX_CAPITALS = 2              # C: percent of A-Z among the code points
SYMBOLS = b"#$%&*|"           # D: any of these bytes
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
NULL_SALTS = 1024
BATCH_BYTES = 16 << 20


def own_failures(text: bytes, code_points: int) -> int:
    """Bits A to D of a UTF-8 text (E needs the other documents)."""
    words = text.split()                                   # ASCII white space
    n = len(words)
    capitals = len(text) - len(text.translate(None, CAPITALS))
    return ((n < MIN_WORDS) | (100 * len(set(words)) < MIN_DISTINCT * n) << 1
            | (100 * capitals > MAX_CAPITALS * code_points) << 2
            | (len(text.translate(None, SYMBOLS)) < len(text)) << 3)


def failures(docs: DataFrame) -> DataFrame:
    """doc_id, part, mask (bits A to D) and digest of every row."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, BATCH_BYTES):
            size = pc.utf8_length(batch.column(2)).to_pylist()
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            mask = [own_failures(t, n) for t, n in zip(texts, size, strict=True)]
            digest = [hashlib.sha256(t).digest() for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(mask, pa.int32()), pa.array(digest, pa.binary())],
                ["doc_id", "part", "mask", "digest"])

    rows = own_columns(docs, "doc_id", "source", "text").select(
        F.col("doc_id").cast("long"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(scan, "doc_id long, part string, mask int, digest binary")


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Add good and toxic; rows without a doc_id are spread over salts."""
    known = (own_columns(labels, "doc_id", "quality", "toxic").where(F.col("doc_id").isNotNull())
             .groupBy(F.col("doc_id").cast("long").alias("_id"))
             .agg(F.max(F.coalesce(F.col("quality").cast("long") == 1, F.lit(False))).alias("good"),
                  F.max(F.coalesce(F.col("toxic").cast("long") == 1, F.lit(False))).alias("toxic"))
             .withColumn("_s", F.lit(-1)))
    salt = F.when(F.col("doc_id").isNull(), F.pmod(F.monotonically_increasing_id(), F.lit(NULL_SALTS)).cast("int"))
    return (rows.withColumn("_salt", F.coalesce(salt, F.lit(-1)))
            .join(known, (F.col("doc_id") == F.col("_id")) & (F.col("_salt") == F.col("_s")), "left")
            .select("doc_id", "part", "mask", "digest", F.coalesce("good", F.lit(False)).alias("good"),
                    F.coalesce("toxic", F.lit(False)).alias("toxic")))


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask (5 bits), n, good, toxic: documents by what they fail."""
    rows = landed(failures(docs), "failures")
    first = (rows.where(F.col("doc_id").isNotNull()).groupBy(F.col("digest").alias("_digest"))
             .agg(F.min("doc_id").alias("_first")))
    counted = labelled(rows, labels).groupBy("digest", "doc_id", "part", "mask", "good", "toxic").agg(
        F.count(F.lit(1)).alias("n"))
    copy = F.col("_first").isNull() & F.col("doc_id").isNotNull()
    return (counted.join(first, (F.col("digest") == F.col("_digest")) & (F.col("doc_id") == F.col("_first")), "left")
            .groupBy("part", (F.col("mask") + F.when(copy, 1 << 4).otherwise(0)).alias("mask"))
            .agg(F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
                 F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic")))


def orders() -> list[str]:
    """The 120 orders by Lehmer rank."""
    return ["".join(p) for p in permutations(LETTERS)]


def removal_intervals() -> list[tuple[int, int, int, int]]:
    """(mask, step, first rank, rank after the last) of every interval."""
    rank: dict[str, int] = {}
    for r, order in enumerate(orders()):
        for k in range(1, STEPS + 1):
            rank.setdefault(order[:k], r)                  # of the first order that begins so
    out = []
    for mask in range(1, 1 << STEPS):
        fails = {c for i, c in enumerate(LETTERS) if mask >> i & 1}
        for begin, r in rank.items():
            if begin[-1] in fails and not fails & set(begin[:-1]):
                out.append((mask, len(begin), r, r + factorial(STEPS - len(begin))))
    return out


def audited(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, filter_order and step: kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley."""
    spark = docs.sparkSession
    counts = landed(mask_counts(docs, labels), "mask-counts")      # at most 32 rows a part
    spans = F.broadcast(spark.createDataFrame(removal_intervals(), "mask int, step int, first int, after int"))
    ends = counts.join(spans, "mask").select("part", "step", F.explode(F.array(
        F.struct(F.col("first").alias("rank"), "n", "good", "toxic"),
        F.struct(F.col("after").alias("rank"), (-F.col("n")).alias("n"), (-F.col("good")).alias("good"),
                 (-F.col("toxic")).alias("toxic")))).alias("e")).select("part", "step", "e.*")
    fails = [F.sum(F.when(F.col("mask").bitwiseAND(1 << i) != 0, F.col("n")).otherwise(0)) for i in range(STEPS)]
    alone = [F.sum(F.when(F.col("mask") == 1 << i, F.col("n")).otherwise(0)) for i in range(STEPS)]
    parts = counts.groupBy("part").agg(F.sum("n").alias("total"), F.array(*fails).alias("fails"),
                                       F.array(*alone).alias("alone"))
    grid = counts.select("part").distinct().select(
        "part", F.explode(F.sequence(F.lit(1), F.lit(STEPS))).alias("step")).select(
        "part", "step", F.explode(F.sequence(F.lit(0), F.lit(factorial(STEPS) - 1))).alias("rank"),
        *[F.lit(0).cast("long").alias(c) for c in ("n", "good", "toxic")])
    along = Window.partitionBy("part", "step").orderBy("rank")
    removed = (ends.where(F.col("rank") < factorial(STEPS)).unionByName(grid)
               .groupBy("part", "step", "rank").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])
               .select("part", "step", "rank", *[F.sum(c).over(along).alias(c) for c in ("n", "good", "toxic")]))
    order = F.element_at(F.lit(orders()), F.col("rank") + 1)
    so_far = Window.partitionBy("part", "rank").orderBy("step")
    here = (removed.join(parts.withColumnRenamed("part", "_part"), F.col("part") == F.col("_part"))
            .withColumn("filter_order", order)
            .withColumn("_at", F.instr(F.lit(LETTERS), F.substring("filter_order", F.col("step"), 1)))
            .withColumn("_kept", F.col("total") - F.sum("n").over(so_far)))
    return here.select(
        "part", "filter_order", "step", F.col("_kept").alias("kept"), F.col("n").alias("removed"),
        (F.element_at("fails", F.col("_at")) - F.col("n")).alias("redundant"),
        F.element_at("alone", F.col("_at")).alias("unique_fails"),
        F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"),
        F.sum("n").over(Window.partitionBy("part", "_at")).alias("shapley"))


SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS smallest
  FROM d),
l AS (
  SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
  FROM labels GROUP BY doc_id),
f AS (
  SELECT w.part, coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic, concat(
    CASE WHEN len(words) < 200 THEN 'A' ELSE '' END,
    CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END,
    CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) THEN 'C' ELSE '' END,
    CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END,
    CASE WHEN w.doc_id > smallest THEN 'E' ELSE '' END) AS failed
  FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
c AS (
  SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM f GROUP BY part, failed),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (
  SELECT concat(p.x, q.x, r.x, s.x, t.x) AS filter_order FROM x p, x q, x r, x s, x t
  WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
s AS (SELECT filter_order, CAST(step AS INTEGER) AS step, substr(filter_order, CAST(step AS INTEGER), 1) AS letter,
        substr(filter_order, 1, CAST(step AS INTEGER) - 1) AS before FROM o, range(1, 6) r(step)),
g AS (
  SELECT part, filter_order, step, letter,
    CAST(sum(n) FILTER (translate(failed, concat(before, letter), '') = failed) AS BIGINT) AS kept,
    CAST(sum(n) FILTER (contains(failed, letter) AND translate(failed, before, '') = failed) AS BIGINT) AS removed,
    CAST(sum(n) FILTER (contains(failed, letter) AND translate(failed, before, '') <> failed) AS BIGINT) AS redundant,
    CAST(sum(n) FILTER (failed = letter) AS BIGINT) AS unique_fails,
    CAST(sum(good) FILTER (contains(failed, letter) AND translate(failed, before, '') = failed) AS BIGINT) AS good_lost,
    CAST(sum(toxic) FILTER (contains(failed, letter) AND translate(failed, before, '') = failed) AS BIGINT) AS toxic_lost
  FROM c, s GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, step, coalesce(kept, 0) AS kept, coalesce(removed, 0) AS removed,
  coalesce(redundant, 0) AS redundant, coalesce(unique_fails, 0) AS unique_fails, coalesce(good_lost, 0) AS good_lost,
  coalesce(toxic_lost, 0) AS toxic_lost,
  CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM g
"""
