"""Language of web pages by fusion of evidence.

Four independent hints make one posterior: the text (character trigrams
under a multinomial model per language, tempered, since trigrams of one page
are not independent), the language the markup declares (how far that can be
trusted is measured over all pages), and the page's place: suffix, domain
and host have priors that shrink towards each other level by level,
host -> domain -> suffix -> all pages, computed by grouped aggregation of the
text posteriors with each page's own share taken out.

The text model counts the trigrams of all labelled documents; the languages
are their labels of two or three letters.

Null html: no text, no declaration (the place decides).  A null or odd url
has the empty host.  Rows without a page_id and repeated rows are judged
like any other; ties go to the first language in order; without labelled
documents the language is null; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railyard.llm.common import landed, own_columns, python_batches

BUCKETS = 1 << 14
WEIGHT = 60             # trigrams of one page that count as independent
STRENGTH = 10.0         # pages that a parent level's prior is worth

_RAW = re.compile(r"(?i)<(?:(script|style|template|noscript)\b|!--)")
_RAW_END = {name: re.compile(rf"(?i)</{name}\s*>") for name in ("script", "style", "template", "noscript")}
_RAW_END[None] = re.compile("-->")
_TAG = re.compile(r"<[^<>]*>")
_ROOT = re.compile(r"(?i)<html\b")
_LANG = re.compile(r"""(?i)\s(?:xml:)?lang\s*=\s*(?:["']\s*)?([a-z]{2,3})(?![a-z])""")


def _buckets(text: str) -> np.ndarray:
    raw = np.frombuffer(text.lower().encode(), np.uint8).astype(np.uint32)
    if len(raw) < 3:
        return np.zeros(0, np.int64)
    code = (raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(18)).astype(np.int64)


class TextModel:
    """Log likelihood of trigram buckets per language."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        smooth = counts + 0.5
        self.log = np.log(smooth / smooth.sum(axis=1, keepdims=True)).astype(np.float32)

    def scores(self, text: str) -> np.ndarray:
        """Tempered log likelihoods, the best one 0."""
        b = _buckets(text)
        if not len(b) or not self.languages:
            return np.zeros(len(self.languages))
        s = self.log[:, b].mean(axis=1, dtype=np.float64) * min(len(b), WEIGHT)
        return s - s.max()


def text_model(docs: DataFrame) -> TextModel:
    """Trigram counts of every labelled document, by language."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[str, np.ndarray] = {}
        for pdf in frames:
            for lang, text in zip(pdf["lang"], pdf["text"], strict=True):
                own = counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
                own += np.bincount(_buckets(text), minlength=BUCKETS)
        for lang, n in counts.items():
            b = np.flatnonzero(n)
            yield pd.DataFrame({"lang": lang, "bucket": b, "n": n[b]})

    python_batches(docs.sparkSession, 2000)
    rows = (own_columns(docs, "lang", "text").select(F.col("lang").cast("string"), F.col("text").cast("string"))
            .where("text is not null and lang rlike '^[a-z]{2,3}$'"))
    got = (rows.mapInPandas(run, "lang string, bucket long, n long").groupBy("lang", "bucket")
           .agg(F.sum("n").alias("n")).toPandas())          # languages x BUCKETS rows at most
    languages = sorted(got["lang"].unique())
    counts = np.zeros((len(languages), BUCKETS))
    counts[[languages.index(x) for x in got["lang"]], got["bucket"].to_numpy(np.int64)] = got["n"].to_numpy()
    return TextModel(languages, counts)


def visible(html: str) -> str:
    """The text outside tags, comments and raw elements that are closed."""
    out, at, open_ended = [], 0, set()
    for m in _RAW.finditer(html):
        name = m[1] and m[1].lower()
        if m.start() < at or name in open_ended:
            continue
        end = _RAW_END[name].search(html, m.end())
        if end:
            out.append(html[at:m.start()])
            at = end.end()
        else:
            open_ended.add(name)        # no end from here on
    return entities.unescape(_TAG.sub(" ", " ".join([*out, html[at:]])))


def declared_language(html: str) -> str | None:
    """Language of the first html tag that has one."""
    done = 0
    for m in _ROOT.finditer(html):
        if m.start() >= done:
            done = html.find(">", m.end())
            done = len(html) if done < 0 else done
            lang = _LANG.search(html, m.end(), done)
            if lang:
                return lang[1].lower()
    return None


def evidence(pages: DataFrame, model: TextModel) -> DataFrame:
    """page_id, host, domain, suffix, declared language and text scores."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            declared, scores = [], []
            for html in batch.column(2).to_pylist():
                declared.append(declared_language(html or ""))
                scores.append(model.scores(visible(html or "")).tolist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(declared, pa.string()),
                                              pa.array(scores, pa.list_(pa.float64()))],
                                             ["page_id", "host", "declared", "scores"])

    python_batches(pages.sparkSession, 1000)
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    rows = own_columns(pages, "page_id", "url", "html").select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    rows = rows.select("page_id", F.coalesce(host, F.lit("")).alias("host"), "html")
    return (rows.mapInArrow(run, "page_id long, host string, declared string, scores array<double>")
            .withColumn("domain", F.substring_index("host", ".", -2))
            .withColumn("suffix", F.substring_index("host", ".", -1)))


def _shared(scores: Column) -> Column:
    """Posterior of log scores."""
    top = F.transform(scores, lambda x: F.exp(x - F.array_max(scores)))
    return F.transform(top, lambda x: x / F.aggregate(top, F.lit(0.0), lambda a, b: a + b))


def identified(pages: DataFrame, docs: DataFrame, strength: float = STRENGTH) -> DataFrame:
    """One row per page: page_id, host, declared, text_lang, lang and the
    posterior of lang."""
    model = text_model(docs)
    names = model.languages
    if not names:
        none = F.lit(None).cast("string")
        return evidence(pages, model).select("page_id", "host", "declared", none.alias("text_lang"),
                                             none.alias("lang"), F.lit(None).cast("double").alias("posterior"))
    every = range(len(names))
    rows = landed(evidence(pages, model).withColumn("post", _shared(F.col("scores"))), "evidence")
    known = F.when(F.col("declared").isin(names), F.col("declared")).when(
        F.col("declared").isNotNull(), F.lit("other")).otherwise(F.lit("none"))
    rows = rows.withColumn("said", known)

    def sums(df: DataFrame, *keys: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.count("*").alias("n"), *[F.sum(F.get("post", F.lit(i))).alias(f"s{i}")
                                                                for i in every])

    hosts = landed(sums(rows, "host", "domain", "suffix"), "hosts")

    def level(*keys: str) -> DataFrame:
        return hosts.groupBy(*keys).agg(F.sum("n").alias("n"), *[F.sum(f"s{i}").alias(f"s{i}") for i in every])

    def shrunk(parent: list[Column]) -> list[Column]:
        return [(F.col(f"s{i}") + strength * parent[i]) / (F.col("n") + strength) for i in every]

    # all pages, and how often a language's pages declare what: constant sizes
    total = hosts.agg(F.sum("n").alias("n"), *[F.sum(f"s{i}").alias(f"s{i}") for i in every]).first()
    root = [((total[f"s{i}"] or 0) + 1) / ((total["n"] or 0) + len(names)) for i in every]
    said = {r["said"]: r for r in sums(rows, "said").collect()}
    kinds = [*names, "other", "none"]
    trust = {k: [(((said[k][f"s{i}"] if k in said else 0) + 1) / ((total[f"s{i}"] or 0) + len(kinds))) for i in every]
             for k in kinds}
    suffixes = level("suffix").select("suffix", F.array(*shrunk([F.lit(p) for p in root])).alias("ps"))
    domains = (level("domain", "suffix").join(suffixes, "suffix")
               .select("domain", "suffix", F.array(*shrunk([F.get("ps", F.lit(i)) for i in every])).alias("pd")))
    priors = (hosts.join(domains, ["domain", "suffix"])
              .select(F.col("host").alias("_host"), "n", F.array(*[F.col(f"s{i}") for i in every]).alias("s"), "pd"))
    joined = rows.join(priors, F.col("host") == F.col("_host"))
    # a page's own posterior is left out of its host's prior
    log = [F.get("scores", F.lit(i)) + F.log(
               (F.greatest(F.get("s", F.lit(i)) - F.get("post", F.lit(i)), F.lit(0.0))
                + strength * F.get("pd", F.lit(i))) / (F.col("n") - 1 + strength))
           + F.log(F.coalesce(*[F.when(F.col("said") == k, F.lit(float(trust[k][i]))) for k in kinds])) for i in every]
    lang = F.array(*map(F.lit, names))

    def best(scores: str) -> Column:
        return F.get(lang, (F.array_position(scores, F.array_max(scores)) - 1).cast("int"))

    return (joined.withColumn("log", F.array(*log)).withColumn("fused", _shared(F.col("log")))
            .select("page_id", "host", "declared", best("scores").alias("text_lang"), best("fused").alias("lang"),
                    F.array_max("fused").alias("posterior")))
