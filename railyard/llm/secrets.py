"""Secret scan with corpus-wide ownership frequency.

Patterns propose candidates; each value's hash is then counted over the
whole corpus by distinct repository (column ``repo``, if the input has it)
and distinct owner (column ``source``).  A value many owners or repositories
hold is a copied example; one that stays with its owner and looks random is
a live credential.  Base spans always stay; further candidates become spans
only if they look live.

Scanning is per text (Arrow batches, cheap substring tests before any
pattern); hashes, places and counts are all that is shuffled.

Null text: empty (no spans).  A null owner counts as one owner, null
repositories as one of each owner, so copies in documents without one do not
make a value an example.  Rows without a doc_id and repeated rows are scanned like any
other; an empty table gives no rows; further input columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard.llm.common import landed, own_columns, python_batches

# fixed values: the base kinds in order, then this scan's own
KINDS = ("assign", "access", "hex", "vendor", "private_key", "generic")
BASE = 3

MAX_OWNERS = 2
MAX_REPOS = 9
MIN_ENTROPY = 3.0           # bits a character
LONG = 24                   # characters of a generic token

_KEYS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ASSIGN = re.compile(r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_VENDOR = re.compile(r"(?:gh[pousr]_|glpat-|xox[abprs]-|[sr]k_live_)[A-Za-z0-9_-]{16,}")
_PRIVATE = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END [A-Z ]*PRIVATE KEY-----)?")
_TOKEN = re.compile(rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{LONG},}}")


def entropy(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) if n else 0.0


def scan(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind number, end, value) of every candidate, by start and kind."""
    found = []
    lower = text.lower()
    if any(k in lower for k in _KEYS):
        found += [(m.start(), 0, m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    if "-----BEGIN" in text:
        found += [(m.start(), 4, m.end(), m[0]) for m in _PRIVATE.finditer(text)]
    if max(map(len, text.split()), default=0) >= 20:
        found += [(m.start(), 2, m.end(), m[0]) for m in _HEX.finditer(text)]
        found += [(m.start(), 3, m.end(), m[0]) for m in _VENDOR.finditer(text)]
        taken = [(a, b) for a, _, b, _ in found]
        for m in _TOKEN.finditer(text):
            mixed = re.search("[0-9]", m[0]) and re.search("[a-z]", m[0]) and re.search("[A-Z]", m[0])
            if mixed and not any(a < m.end() and m.start() < b for a, b in taken):
                found.append((m.start(), 5, m.end(), m[0]))
    return sorted(found)


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b, *_ in spans)


SPANS = "array<struct<start:long,kind:int,stop:long,value:string,live:boolean>>"


def candidates(docs: DataFrame) -> DataFrame:
    """Per document: base counts and digest, and every candidate with the
    hash of its value and whether it looks random."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("stop", pa.int64()),
                               ("value", pa.string()), ("live", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, counts, digests = [], [[], [], []], []
            for text in batch.column(3).to_pylist():
                spans = scan(text or "")
                base = [s for s in spans if s[1] < BASE]
                for k in range(BASE):
                    counts[k].append(sum(s[1] == k for s in base))
                digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                rows.append([{"start": a, "kind": k, "stop": b, "value": hashlib.sha256(v.encode()).hexdigest()[:32],
                              "live": entropy(v) >= MIN_ENTROPY} for a, k, b, v in spans])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], *[pa.array(c, pa.int64()) for c in counts], pa.array(digests, pa.string()),
                 pa.array(rows, kind)],
                ["doc_id", "owner", "repo", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    python_batches(docs.sparkSession, 2000)
    rows = own_columns(docs, "doc_id", "source", "repo", "text")
    rows = rows.select(F.col("doc_id").cast("long"), F.col("source").cast("string").alias("owner"),
                       F.col("repo").cast("string"),       # null throughout: owners alone decide
                       F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, owner string, repo string, n_assign long, n_access long, n_hex long, "
                                f"base_sha256 string, spans {SPANS}")


def _judged(rows: DataFrame, max_owners: int, max_repos: int) -> DataFrame:
    """One row per candidate span with its value's owners and repositories."""
    spans = rows.select("_row", "owner", "repo", F.explode("spans").alias("s")).select("_row", "owner", "repo", "s.*")
    held = (spans.groupBy("value", "owner", "repo").agg(F.count("*").alias("n"))
            .groupBy("value", "owner").agg(F.count("*").alias("repos"))
            .groupBy("value").agg(F.count("*").alias("n_owners"), F.sum("repos").alias("n_repos")))
    out = spans.drop("owner", "repo").join(held, "value")
    copied = (F.col("n_owners") > max_owners) | (F.col("n_repos") > max_repos)
    return out.withColumn("verdict", F.when(copied, "copied").when(F.col("live"), "live").otherwise("weak"))


def _name() -> F.Column:
    return F.get(F.array(*map(F.lit, KINDS)), F.col("kind"))


def secret_spans(docs: DataFrame, max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS) -> DataFrame:
    """Every candidate: doc_id, kind, start, stop, owners, repositories of
    its value, and a verdict: copied, live or weak (not random enough)."""
    rows = landed(candidates(docs).withColumn("_row", F.monotonically_increasing_id()), "secrets")
    return (_judged(rows, max_owners, max_repos).join(rows.select("_row", "doc_id"), "_row")
            .select("doc_id", _name().alias("kind"), "start", "stop", "n_owners", "n_repos", "verdict"))


def secret_report(docs: DataFrame, max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS) -> DataFrame:
    """One row per document: base counts and digest, all spans (base ones
    and further live ones), and how many are live or copied."""
    rows = landed(candidates(docs).withColumn("_row", F.monotonically_increasing_id()), "secrets")
    judged = _judged(rows, max_owners, max_repos).where((F.col("kind") < BASE) | (F.col("verdict") == "live"))
    one = F.struct("start", "kind", "stop", _name().alias("name"))
    by_row = judged.groupBy("_row").agg(
        F.sort_array(F.collect_list(one)).alias("all"),
        F.count(F.when(F.col("verdict") == "live", 1)).alias("n_live"),
        F.count(F.when(F.col("verdict") == "copied", 1)).alias("n_copied"))
    text = F.array_join(F.transform("all", lambda s: F.concat_ws(
        ":", s["name"], s["start"].cast("string"), s["stop"].cast("string"))), ",")
    return rows.drop("spans", "owner", "repo").join(by_row, "_row", "left").select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", F.coalesce(text, F.lit("")).alias("spans"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"), F.coalesce("n_copied", F.lit(0)).alias("n_copied"))
