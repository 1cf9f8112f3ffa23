"""License scan by diagonal voting over word k-grams.

The rolling k-gram hashes of every text are joined to the positions of the
same k-grams in the templates: naming phrases, and notices and whole texts of
licenses.  Hits of one template with the same offset (text position less
template position) lie on one diagonal; neighbouring diagonals, at most
``SLACK`` words apart, are merged, so that a few words put in or left out do
not split a match.  A merged diagonal is judged by the stretch of the
template that it covers:

* of a whole text, at least ``STRETCH`` words with ``MIN_COVER`` of their
  k-grams; ``MIN_WORDS`` of the stretch's words must stand in the span;
* a phrase is short, and one word lost, changed or put in may leave a single
  k-gram: the span is as long as the phrase with a word more on each side, and
  must hold all its words but one, and the ones that name the license.

DataFrame functions only.  The templates are fixed, so their positions are a
table of constant size (about 1,300 k-grams).  Texts without any k-gram of a template, found out
by set overlap inside the row, do not enter the join.

Null text: empty (no words, no labels).  Rows without a doc_id and repeated
rows are scanned like any other; an empty table gives no rows; further input
columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from railyard.llm import license_texts
from railyard.llm.common import ascii_lower, landed, own_columns

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GRAM = 3
SLACK = 2
STRETCH = 12
MIN_COVER = 0.5
MIN_WORDS = 0.8
MAX_STRETCH = 2

# fixed values: phrases of the base scan
PHRASES = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}


def _split(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


#: label, words, naming words (of phrases; none for whole texts)
TEMPLATES = [(label, _split(text), _split(keys)) for label, text, keys in license_texts.PHRASES] + [
    (label, _split(text), []) for label, text in license_texts.TEXTS]


def _grams(words: list[str]) -> list[list[str]]:
    return [words[i:i + GRAM] for i in range(len(words) - GRAM + 1)]


def _template_table(spark: SparkSession) -> DataFrame:
    rows = [(t, at, gram) for t, (_, words, _) in enumerate(TEMPLATES) for at, gram in enumerate(_grams(words))]
    made = spark.createDataFrame(rows, "template int, at int, gram array<string>")
    return made.select("template", "at", F.xxhash64(*[F.get("gram", F.lit(i)) for i in range(GRAM)]).alias("gram"))


def _template_words(spark: SparkSession) -> DataFrame:
    rows = [(t, label, words, keys, bool(keys)) for t, (label, words, keys) in enumerate(TEMPLATES)]
    return spark.createDataFrame(rows, "template int, label string, template_words array<string>, "
                                       "keys array<string>, phrase boolean")


def _places(phrase: str) -> Column:
    words = phrase.split()
    at = F.filter(F.sequence(F.lit(0), F.size("w") - 1), lambda i: F.coalesce(
        F.forall(F.array(*[F.get("w", i + k) == F.lit(x) for k, x in enumerate(words)]), lambda y: y), F.lit(False)))
    return F.when(F.concat(F.lit(" "), F.array_join("w", " "), F.lit(" ")).contains(f" {phrase} "), at).otherwise(
        F.array().cast("array<int>"))


def scanned(docs: DataFrame) -> DataFrame:
    """Base places per document; words and k-grams of those that share one
    with a template."""
    rows = own_columns(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long"), F.array_remove(F.split(ascii_lower(
            F.coalesce(F.col("text").cast("string"), F.lit(""))), NOT_WORD), "").alias("w"))
    n = F.size("w")
    rows = rows.select("*", *[_places(p).alias(f"_{k}") for k, p in PHRASES.items()], F.when(
        n >= GRAM, F.transform(F.sequence(F.lit(0), n - GRAM), lambda i: F.xxhash64(
            *[F.get("w", i + k) for k in range(GRAM)]))).alias("grams"))
    known = F.array(*[F.xxhash64(*map(F.lit, g)) for _, words, _ in TEMPLATES for g in _grams(words)])
    near = F.coalesce(F.arrays_overlap("grams", known), F.lit(False))
    places = [F.col(f"`_{k}`") for k in PHRASES]
    base = F.array_compact(F.array(*[F.when(F.size(p) > 0, F.lit(k)) for k, p in zip(PHRASES, places, strict=True)]))
    return rows.select(
        F.monotonically_increasing_id().alias("_row"), "doc_id", n.cast("long").alias("n_words"),
        sum((F.size(p) for p in places), F.lit(0)).cast("long").alias("n_base"),
        F.array_min(F.concat(*places)).cast("long").alias("first_word"),
        F.array_max(F.concat(*places)).cast("long").alias("last_word"),
        F.sort_array(base).alias("base"), F.when(near, F.col("w")).alias("w"),
        F.when(near, F.col("grams")).alias("grams"))


def _spans(rows: DataFrame) -> DataFrame:
    spark = rows.sparkSession
    hits = (rows.where("grams is not null").select("_row", F.posexplode("grams").alias("pos", "gram"))
            .join(F.broadcast(_template_table(spark)), "gram")
            .withColumn("diagonal", F.col("pos") - F.col("at")))
    votes = hits.groupBy("_row", "template", "diagonal").agg(
        F.min("pos").alias("lo"), F.max("pos").alias("hi"), F.collect_set("at").alias("ats"))
    line = Window.partitionBy("_row", "template").orderBy("diagonal")
    merged = (votes.withColumn("new", F.coalesce(
                  (F.col("diagonal") - F.lag("diagonal").over(line) > SLACK).cast("int"), F.lit(1)))
              .withColumn("run", F.sum("new").over(line))
              .groupBy("_row", "template", "run").agg(
                  F.min("lo").alias("lo"), F.max("hi").alias("hi"),
                  F.array_sort(F.array_distinct(F.flatten(F.collect_list("ats")))).alias("ats")))
    first, last = F.element_at("ats", 1), F.element_at("ats", -1)
    whole = F.size("template_words")
    found = merged.join(F.broadcast(_template_words(spark)), "template").select(
        "_row", "label", "keys", "phrase",
        F.when(F.col("phrase"), F.greatest(F.col("lo") - first - 1, F.lit(0))).otherwise(F.col("lo")).alias("lo"),
        F.when(F.col("phrase"), F.col("hi") - last + whole + 1).otherwise(F.col("hi") + GRAM).alias("stop"),
        F.when(F.col("phrase"), F.col("template_words")).otherwise(
            F.slice("template_words", first + 1, last - first + GRAM)).alias("need"),
        (F.size("ats") / (last - first + 1)).alias("cover"))
    found = found.where((F.col("stop") - F.col("lo") <= MAX_STRETCH * F.size("need")) & (
        F.col("phrase") | ((F.size("need") >= STRETCH) & (F.col("cover") >= MIN_COVER))))
    checked = found.join(rows.where("w is not null").select(F.col("_row").alias("_r"), "w"),
                         F.col("_row") == F.col("_r"))
    own = F.slice("w", F.col("lo") + 1, F.col("stop") - F.col("lo"))
    checked = checked.select("_row", "label", "phrase", "keys", "lo", own.alias("own"),
                             F.array_distinct("need").alias("need"))
    held = F.size(F.array_intersect("need", "own"))
    good = F.when(F.col("phrase"), (held >= F.size("need") - 1) & (F.size(F.array_except("keys", "own")) == 0)
                  ).otherwise(held >= MIN_WORDS * F.size("need"))
    at = F.filter(F.sequence(F.lit(0), F.size("own") - 1), lambda i: F.array_contains("need", F.get("own", i)))
    return checked.where(good).withColumn("at", at).select(
        "_row", "label", (F.col("lo") + F.array_min("at")).cast("long").alias("start"),
        (F.array_max("at") - F.array_min("at") + 1).cast("long").alias("length"),
        (held / F.size("need")).alias("cover"))


def license_spans(docs: DataFrame) -> DataFrame:
    """doc_id, label, start and length in words, share of the words looked
    for; overlapping spans of one label are one."""
    rows = landed(scanned(docs), "license-words")
    order = Window.partitionBy("_row", "label").orderBy("start", "length")
    reach = F.max(F.col("start") + F.col("length")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    merged = (_spans(rows).withColumn("new", F.coalesce((F.col("start") >= reach).cast("int"), F.lit(1)))
              .withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
              .groupBy("_row", "label", "run").agg(
                  F.min("start").alias("start"), F.max(F.col("start") + F.col("length")).alias("stop"),
                  F.max("cover").alias("cover")))
    return merged.join(rows.select("_row", "doc_id"), "_row").select(
        "doc_id", "label", "start", (F.col("stop") - F.col("start")).alias("length"), "cover")


def license_labels(docs: DataFrame) -> DataFrame:
    """One row per document: base places, labels of base and verified spans,
    and a score (1 for a base phrase, else the best span's share)."""
    rows = landed(scanned(docs), "license-words")
    by_row = _spans(rows).groupBy("_row").agg(F.collect_set("label").alias("own"), F.max("cover").alias("cover"))
    none = F.array().cast("array<string>")
    return rows.drop("w", "grams").join(by_row, "_row", "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union("base", F.coalesce("own", none))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("cover", F.lit(0.0))).alias("score"))


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)


def _sql() -> str:
    grams = _values((t, at, " ".join(g)) for t, (_, w, _) in enumerate(TEMPLATES) for at, g in enumerate(_grams(w)))
    words = ", ".join(f"({t}, '{label}', {w}, {k}::VARCHAR[], {bool(k)})" for t, (label, w, k) in enumerate(TEMPLATES))
    phrases = _values((k, len(p.split()), p) for k, p in PHRASES.items())
    return rf"""
WITH grams(template, tpos, gram) AS (VALUES {grams}),
words(template, label, words, keys, phrase) AS (VALUES {words}),
phrases(label, n, phrase) AS (VALUES {phrases}),
d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{NOT_WORD}'), lambda x: x <> '') AS w FROM documents),
p AS (SELECT r, w, unnest(range(0, len(w))) AS pos FROM d),
base AS (SELECT r, label, pos FROM p JOIN phrases ON pos + n <= len(w)
  AND array_to_string(list_slice(w, pos + 1, pos + n), ' ') = phrase),
by_base AS (SELECT r, count(*) AS n, min(pos) AS lo, max(pos) AS hi, list(DISTINCT label) AS labels
  FROM base GROUP BY r),
hits AS (SELECT r, template, tpos, pos, pos - tpos AS diagonal FROM p JOIN grams
  ON pos + {GRAM} <= len(w) AND array_to_string(list_slice(w, pos + 1, pos + {GRAM}), ' ') = gram),
steps AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER o <= {SLACK} THEN 0 ELSE 1 END AS new
  FROM hits WINDOW o AS (PARTITION BY r, template ORDER BY diagonal)),
runs AS (SELECT *, sum(new) OVER (PARTITION BY r, template ORDER BY diagonal) AS run FROM steps),
merged AS (SELECT r, template, run, min(pos) AS lo, max(pos) AS hi, min(tpos) AS tlo, max(tpos) AS thi,
  count(DISTINCT tpos) AS hit FROM runs GROUP BY r, template, run),
found AS (SELECT r, label, keys, phrase, hit / (thi - tlo + 1) AS cover,
    CASE WHEN phrase THEN greatest(lo - tlo - 1, 0) ELSE lo END AS lo,
    CASE WHEN phrase THEN hi - thi + len(words) + 1 ELSE hi + {GRAM} END AS stop,
    CASE WHEN phrase THEN words ELSE list_slice(words, tlo + 1, thi + {GRAM}) END AS need
  FROM merged JOIN words USING (template)),
spans AS (SELECT r, label, phrase, keys, list_slice(w, lo + 1, stop) AS own, list_distinct(need) AS need
  FROM found JOIN d USING (r)
  WHERE stop - lo <= {MAX_STRETCH} * len(need) AND (phrase OR (len(need) >= {STRETCH} AND cover >= {MIN_COVER}))),
held AS (SELECT *, len(list_filter(need, lambda x: list_contains(own, x))) AS held FROM spans),
checked AS (SELECT r, label, held / len(need) AS cover FROM held WHERE CASE
  WHEN phrase THEN held >= len(need) - 1 AND len(list_filter(keys, lambda x: NOT list_contains(own, x))) = 0
  ELSE held >= {MIN_WORDS} * len(need) END),
by_span AS (SELECT r, list(DISTINCT label) AS labels, max(cover) AS cover FROM checked GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(by_base.n, 0) AS BIGINT) AS n_base,
  CAST(lo AS BIGINT) AS first_word, CAST(hi AS BIGINT) AS last_word,
  coalesce(array_to_string(list_sort(by_base.labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(
    coalesce(by_base.labels, []), coalesce(by_span.labels, [])))), ','), '') AS labels,
  CASE WHEN by_base.n > 0 THEN 1.0::DOUBLE ELSE coalesce(cover, 0)::DOUBLE END AS score
FROM d LEFT JOIN by_base USING (r) LEFT JOIN by_span USING (r)
"""


SQL = _sql()
