"""Quality rules with the cross-document frequency of lines.

Every non-blank line is normalised (lower case, single spaces) and hashed;
for each host (column ``source``) the distinct documents that hold a line
are counted, documents of one host with the same text counting once (copies
are the near-duplicate operator's matter).  A line in at least ``min_docs``
texts is removed if it is in more than ``max_share`` of the host's texts or in
``many`` of them, so that hosts of every size lose their boilerplate; a
document is depleted, and rejected, when fewer than ``min_left`` words or less
than ``min_left_share`` of its words stay.

DataFrame functions only.  Each text is read once; the lines go on as hashes
in arrays beside the document's counts, in a written table.

Null text: no words (rejected by the base rule).  A null host is a host.
Rows without a doc_id and repeated rows are judged like any other; an empty
table gives no rows; further input columns pass through ``accepted``
unchanged and are ignored elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railyard.llm.common import WORD_BREAK, landed, own_columns, quoted

MIN_DOCS = 5
MAX_SHARE = 0.05
MANY = 1000
MIN_LEFT = 10
MIN_LEFT_SHARE = 0.5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SYMBOLS = "#*$%&|<>"
BROADCAST_ROWS = 50_000     # lines of 16 bytes and a host name; beyond it line hashes are shuffled


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, WORD_BREAK), "")


def _normal_lines(text: Column) -> Column:
    """Normalised lines, one for each line of the text (blank ones empty)."""
    tidy = F.regexp_replace(F.lower(text), r"[\x20\x09\x0B-\x0D]+", " ")
    return F.transform(F.split(tidy, "\n"), lambda x: F.trim(x))


def measured(docs: DataFrame, whole: bool = False) -> DataFrame:
    """Base counts per document and, in arrays, hash and words of its lines;
    ``whole`` adds the document itself as the struct ``_doc``."""
    beside = ["_doc"] if whole else []
    if whole:
        docs = docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("_doc"), *[
            c for c in ("doc_id", "source", "text") if c in docs.columns])
    rows = own_columns(docs, *beside, "doc_id", "source", "text").select(
        *beside, F.col("doc_id").cast("long"), F.col("source").cast("string"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.select("*", _words(F.col("text")).alias("w"),
                       F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("raw"),
                       _normal_lines(F.col("text")).alias("lines"))
    n = F.size("w")
    rows = rows.select(
        "*", F.when(n >= WINDOW, F.transform(
            F.sequence(F.lit(0), n - WINDOW),
            lambda i: F.xxhash64(*[F.get("w", i + k) for k in range(WINDOW)]))).alias("h"))
    rows = rows.select("*", F.when(F.size(F.array_distinct("h")) < F.size("h"), F.sort_array(
        F.transform("h", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))).alias("s"))

    def twice(i: Column) -> Column:
        own = F.get("s", i)["x"]
        return F.coalesce(own == F.get("s", i - 1)["x"], F.lit(False)) | F.coalesce(
            own == F.get("s", i + 1)["x"], F.lit(False))

    rows = rows.withColumn("p", F.when(F.col("s").isNotNull(), F.sort_array(F.transform(
        F.filter(F.sequence(F.lit(0), F.size("s") - 1), twice), lambda i: F.get("s", i)["i"]))))
    covered = F.aggregate(F.sequence(F.lit(0), F.size("p") - 1), F.lit(0), lambda acc, j: acc + F.least(
        F.lit(WINDOW), F.coalesce(F.get("p", j + 1) - F.get("p", j), F.lit(WINDOW))))
    return rows.select(
        *beside, F.monotonically_increasing_id().alias("_row"), "doc_id", "source", F.xxhash64("text").alias("text_hash"),
        n.cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("raw") - F.size(F.array_distinct("raw"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("p").isNotNull(), covered).otherwise(0).cast("long").alias("n_repeat_words"),
        F.transform("lines", lambda x: F.when(x != "", F.xxhash64(x))).alias("line_hash"),
        F.transform("lines", lambda x: F.when(x != "", F.length(x) - F.length(F.replace(x, F.lit(" ")))
                                              + 1).otherwise(0)).alias("line_words"))


def frequent_lines(rows: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE,
                   many: int = MANY) -> DataFrame:
    """(source, line) above the limits, from the rows of :func:`measured`."""
    texts = rows.groupBy("source", "text_hash").agg(F.first(F.array_distinct("line_hash")).alias("lines"))
    texts = landed(texts, "host-texts")
    hosts = texts.groupBy("source").agg(F.count("*").alias("docs"))
    lines = (texts.select("source", F.explode("lines").alias("line")).where("line is not null")
             .groupBy("source", "line").agg(F.count("*").alias("held")).where(F.col("held") >= min_docs))
    above = lines.join(hosts.withColumnRenamed("source", "_host"), F.col("source").eqNullSafe(F.col("_host")))
    return above.where((F.col("held") > F.col("docs") * max_share) | (F.col("held") >= many)).select(
        "source", "line", "held")


def _hits(rows: DataFrame, frequent: DataFrame) -> DataFrame:
    """_row, place, hash and words of the lines that go; hashes alone move."""
    lines = (rows.select("_row", "source", F.posexplode("line_hash").alias("at", "line"), "line_words")
             .where("line is not null")
             .select("_row", F.col("source").alias("_host"), "at", F.col("line").alias("_line"),
                     F.get("line_words", F.col("at")).alias("words")))
    return lines.join(frequent, F.col("_host").eqNullSafe(F.col("source")) & (F.col("_line") == F.col("line")))


def _verdict(min_left: int, min_left_share: float) -> tuple[Column, Column]:
    """base_failed and depleted, from n_words, n_repeat_words, removed_words."""
    left = F.col("n_words") - F.coalesce("removed_words", F.lit(0))
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return base, F.col("removed_words").isNotNull() & (
        (left < min_left) | (left < F.col("n_words") * min_left_share))


def judged(docs: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE, many: int = MANY,
           min_left: int = MIN_LEFT, min_left_share: float = MIN_LEFT_SHARE) -> DataFrame:
    """Counts and verdict of every document, with the places of the lines
    that go (``removed``, from 0, null if none) and the words in them."""
    rows = landed(measured(docs), "measured")
    frequent = landed(frequent_lines(rows, min_docs, max_share, many), "frequent-lines")
    if frequent.count() <= BROADCAST_ROWS:
        frequent = F.broadcast(frequent)
    removed = _hits(rows, frequent).groupBy("_row").agg(F.sum("words").alias("removed_words"),
                                      F.sort_array(F.collect_list("at")).alias("removed"))
    base, depleted = _verdict(min_left, min_left_share)
    return (rows.drop("line_hash", "line_words").join(removed, "_row", "left")
            .withColumn("removed_words", F.coalesce("removed_words", F.lit(0)).cast("long"))
            .withColumn("base_failed", base).withColumn("depleted", depleted)
            .withColumn("kept", ~base & ~F.coalesce("depleted", F.lit(False))).drop("_row"))


def accepted(docs: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE, many: int = MANY,
             min_left: int = MIN_LEFT, min_left_share: float = MIN_LEFT_SHARE) -> DataFrame:
    """The documents that pass, less their frequent lines; all columns stay,
    and n_chars, if there, follows the text.

    Texts are written beside their counts and meet the frequent lines of
    their host as one array, so no text is shuffled unless there are more
    than ``BROADCAST_ROWS`` frequent lines.  Then line hashes find the lines
    of each row that go, and texts meet those by row, never by host.
    """
    rows = landed(measured(docs, whole=True), "measured")
    frequent = landed(frequent_lines(rows, min_docs, max_share, many), "frequent-lines")
    if frequent.count() <= BROADCAST_ROWS:
        hosts = frequent.groupBy(F.col("source").alias("_host")).agg(F.collect_set("line").alias("frequent"))
        rows = rows.join(F.broadcast(hosts), F.col("source").eqNullSafe(F.col("_host")), "left")
    else:
        own = _hits(rows, frequent).groupBy("_row").agg(F.collect_set("line").alias("frequent"))
        rows = rows.join(own, "_row", "left")

    def goes(line: Column) -> Column:
        return F.coalesce(F.array_contains("frequent", line), F.lit(False))

    hit = F.coalesce(F.arrays_overlap("line_hash", "frequent"), F.lit(False))
    words = F.zip_with("line_hash", "line_words", lambda x, n: F.when(goes(x), n).otherwise(0))
    base, depleted = _verdict(min_left, min_left_share)
    kept = (rows.withColumn("hit", hit)
            .withColumn("removed_words", F.when(F.col("hit"), F.aggregate(words, F.lit(0), lambda x, n: x + n)))
            .where(~base & ~F.coalesce(depleted, F.lit(False))))
    own = {c: F.col("_doc")[c] for c in docs.columns}
    own["text"] = F.when(F.col("hit"), F.array_join(F.filter(
        F.split(own["text"], "\n"), lambda _, i: ~goes(F.get("line_hash", i))), "\n")).otherwise(own["text"])
    if "n_chars" in own:
        own["n_chars"] = F.when(F.col("hit"), F.length(own["text"]).cast(docs.schema["n_chars"].dataType)).otherwise(
            own["n_chars"])
    return kept.select(*[own[c].alias(c) for c in docs.columns])


SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, list_filter(string_split_regex(text, '{WORD_BREAK}'), lambda x: x <> '') AS w FROM d),
grams AS (
  SELECT r, i, array_to_string(list_slice(w, i, i + {WINDOW - 1}), ' ') AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM w WHERE len(w) >= {WINDOW})),
repeated AS (SELECT r, i FROM grams QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
covered AS (
  SELECT r, sum(least({WINDOW}, coalesce(nxt - i, {WINDOW}))) AS n
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM repeated) GROUP BY r),
raw AS (
  SELECT r, count(*) - count(DISTINCT l) AS n FROM (SELECT r, unnest(string_split(text, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
lines AS (
  SELECT r, source, text, trim(l) AS l FROM (
    SELECT r, source, text, unnest(string_split(
      regexp_replace(lower(text), '[\x20\x09\x0B-\x0D]+', ' ', 'g'), chr(10))) AS l FROM d)
  WHERE trim(l) <> ''),
hosts AS (SELECT source, count(DISTINCT text) AS docs FROM d GROUP BY source),
frequent AS (
  SELECT lines.source, l FROM lines JOIN hosts ON lines.source IS NOT DISTINCT FROM hosts.source
  GROUP BY lines.source, l, docs
  HAVING count(DISTINCT text) >= {MIN_DOCS}
    AND (count(DISTINCT text) > docs * {MAX_SHARE} OR count(DISTINCT text) >= {MANY})),
gone AS (
  SELECT r, sum(len(string_split(lines.l, ' '))) AS n
  FROM lines JOIN frequent ON lines.source IS NOT DISTINCT FROM frequent.source AND lines.l = frequent.l
  GROUP BY r),
counts AS (
  SELECT d.doc_id, CAST(len(w.w) AS BIGINT) AS n_words,
    CAST(length(array_to_string(w.w, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(raw.n, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(gone.n, 0) AS BIGINT) AS removed_words
  FROM d JOIN w USING (r) LEFT JOIN raw USING (r) LEFT JOIN covered USING (r) LEFT JOIN gone USING (r)),
judged AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
    removed_words > 0 AND (n_words - removed_words < {MIN_LEFT}
      OR n_words - removed_words < n_words * {MIN_LEFT_SHARE}) AS depleted
  FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT depleted AS kept, removed_words FROM judged
"""
