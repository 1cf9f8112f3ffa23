"""Chat formatting after the collapse of cumulative snapshots.

A log may hold the same conversation several times, each time a few turns
longer.  Rolling hashes of the turns so far identify every prefix; a
conversation whose whole is a proper prefix of another one goes (anti-join),
of equal ones the least conv_id stays, and what stays is rendered.

DataFrame functions only; the prefixes move as numbers, texts only when they
are rendered.  Turns are put in order by range partitions of about ``TASK``
rows, so that no conversation, however long, becomes one task: what stands
before a partition comes from one summary row per conversation and partition.
A conversation is rendered in one row per ``BLOCK`` turns (``segment``).

Turns are ordered by number, then role, then text, nulls first; equal rows
count once.  Rows without a conv_id form one conversation; it stays under the
null id unless an equal conversation has an id.  A null role is rendered as
``unknown``, a null text as empty.  An empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from railyard.llm.common import landed, own_columns

BLOCK = 1024            # turns in a rendered row
TASK = 1 << 16          # rows that a range partition holds on average

ORDER = ["conv_id", "turn", "role", "text"]


def _ordered(conversations: DataFrame, task: int) -> DataFrame:
    """Distinct turns with their hash, range partition (``part``) and place in
    it (``at``), written down, so that places stay what they are."""
    rows = landed(own_columns(conversations, *ORDER).select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"),
        F.col("text").cast("string")).distinct(), "distinct-turns")
    parts = rows.count() // task + 1
    place = F.monotonically_increasing_id()     # partition in the high bits, row in the low 33
    return landed(rows.repartitionByRange(parts, *ORDER).sortWithinPartitions(*ORDER).select(
        *ORDER, F.xxhash64(F.col("role").isNull(), "role", F.col("text").isNull(), "text").alias("h"),
        F.shiftright(place, 33).alias("part"), place.bitwiseAND((1 << 33) - 1).alias("at")), "ordered-turns")


def _beside(rows: DataFrame, summary: DataFrame) -> DataFrame:
    """Rows with the summary row of their conversation and partition."""
    names = [c for c in summary.columns if c not in ("conv_id", "part")]
    right = summary.select(F.col("conv_id").alias("_c"), F.col("part").alias("_p"), *names)
    return rows.join(right, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("part") == F.col("_p"))).drop("_c", "_p")


def _offsets(turns: DataFrame) -> DataFrame:
    """conv_id, part, ``shift`` from a place to the number of turns so far,
    and ``n_turns`` of the whole conversation."""
    own = Window.partitionBy("conv_id")
    before = own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = turns.groupBy("conv_id", "part").agg(F.count("*").alias("n"), F.min("at").alias("lo"))
    return sizes.select("conv_id", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("lo") + 1).alias(
        "shift"), F.sum("n").over(own).alias("n_turns"))


def _prefixes(turns: DataFrame, offsets: DataFrame) -> DataFrame:
    """conv_id, n_turns, length and hash of every prefix.

    A prefix hash is the exclusive or of the hashes of (position, turn): a
    running one inside a partition, and that of all partitions before.
    """
    placed = landed(_beside(turns.select("conv_id", "part", "at", "h"), offsets).select(
        "conv_id", "part", "n_turns", (F.col("at") + F.col("shift")).alias("length"),
        F.xxhash64(F.col("at") + F.col("shift"), "h").alias("x")), "turns")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    start = placed.groupBy("conv_id", "part").agg(F.bit_xor("x").alias("x")).select(
        "conv_id", "part", F.coalesce(F.bit_xor("x").over(before), F.lit(0)).alias("start"))
    so_far = Window.partitionBy("conv_id", "part").orderBy("length").rowsBetween(Window.unboundedPreceding, 0)
    return _beside(placed.withColumn("own", F.bit_xor("x").over(so_far)), start).select(
        "conv_id", "n_turns", "length", F.col("own").bitwiseXOR(F.col("start")).alias("prefix"))


def prefixes(conversations: DataFrame, task: int = TASK) -> DataFrame:
    """conv_id, n_turns, length and hash of every prefix, longest included."""
    turns = _ordered(conversations, task)
    return _prefixes(turns, _offsets(turns))


def _maximal(every: DataFrame) -> DataFrame:
    """Whole conversations that no longer one passes through."""
    unique = (every.where("length = n_turns").groupBy("length", "prefix")
              .agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("copies")))
    inner = every.where("length < n_turns").select("length", "prefix").distinct()
    return unique.join(inner, ["length", "prefix"], "left_anti").select(
        "conv_id", F.col("length").alias("n_turns"), "copies")


def maximal(conversations: DataFrame, task: int = TASK) -> DataFrame:
    """conv_id, n_turns and copies (itself included) of what stays."""
    return _maximal(landed(prefixes(conversations, task), "prefixes"))


def formatted(conversations: DataFrame, block: int = BLOCK, task: int = TASK) -> DataFrame:
    """conv_id, segment, n_turns, copies and the rendered text of every
    maximal conversation.  Markers inside a text are broken up."""
    turns = _ordered(conversations, task)
    offsets = landed(_offsets(turns), "offsets")
    keep = _maximal(landed(_prefixes(turns, offsets), "prefixes"))
    keep = keep.select(F.col("conv_id").alias("_k"), "copies")
    kept = offsets.join(keep, F.col("conv_id").eqNullSafe(F.col("_k"))).drop("_k")
    place = F.col("at") + F.col("shift")

    def plain(c):
        return F.replace(c, F.lit("<|"), F.lit("< |"))

    line = F.concat(F.lit("<|im_start|>"), plain(F.coalesce("role", F.lit("unknown"))), F.lit("\n"),
                    plain(F.coalesce("text", F.lit(""))), F.lit("<|im_end|>\n"))
    shown = (_beside(turns.drop("turn", "h"), kept)
             .groupBy("conv_id", F.floor((place - 1) / block).alias("segment"), "n_turns", "copies")
             .agg(F.sort_array(F.collect_list(F.struct(place.alias("at"), line.alias("line")))).alias("lines")))
    return shown.select("conv_id", "segment", "n_turns", "copies", F.array_join("lines.line", "").alias("text"))


SQL = f"""
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS k,
        md5(coalesce(role, chr(1)) || chr(31) || coalesce(text, chr(1))) AS h FROM t),
p AS (SELECT conv_id, k, string_agg(h, ',') OVER (
        PARTITION BY conv_id ORDER BY k ROWS UNBOUNDED PRECEDING) AS prefix,
        count(*) OVER (PARTITION BY conv_id) AS n FROM o),
whole AS (SELECT min(conv_id) AS conv_id, n, prefix, count(*) AS copies FROM p WHERE k = n GROUP BY n, prefix),
kept AS (SELECT * FROM whole WHERE prefix NOT IN (SELECT prefix FROM p WHERE k < n))
SELECT o.conv_id, CAST((k - 1) // {BLOCK} AS BIGINT) AS segment, CAST(n AS BIGINT) AS n_turns,
  CAST(copies AS BIGINT) AS copies,
  string_agg('<|im_start|>' || replace(coalesce(role, 'unknown'), '<|', '< |') || chr(10)
    || replace(coalesce(text, ''), '<|', '< |') || '<|im_end|>' || chr(10), '' ORDER BY k) AS text
FROM o JOIN kept ON o.conv_id IS NOT DISTINCT FROM kept.conv_id GROUP BY ALL
"""
