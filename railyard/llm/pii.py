"""Personal data by boosted trees over candidate spans.

Generators of high recall propose spans, overlapping ones included: the four
base kinds, looser numbers, spelled-out addresses, account codes.  Base
spans always stay.  Gradient-boosted trees score the others by format and
context, and a threshold for each kind is calibrated on held-out examples to
``PRECISION``.  Of overlapping accepted spans the best score wins.

The tables hold no labels, so examples come from two places:

* the corpus, every clear one: base spans are personal, the number of a base
  phone without its ``+`` too; candidates are impersonal when the word before
  says so (order, version, ...), when they are amounts or dates, or when they
  lie inside a longer run of letters and digits.  All others are unclear and
  left out.
* written examples of each format and of its decoys, with and without a word
  that names them, drawn with a fixed seed (``examples``).  They weigh more
  as the corpus grows, as if it held about ``BALANCE`` examples.

Cuts, trees and thresholds come from all of them, a third held out for the
thresholds.  Equal examples are counted, and Spark adds up the counts by
node, feature and bin for each level of a tree; the sums are whole numbers,
so the model does not depend on how the rows are spread.

Texts never move: one pass writes the candidates, and redaction is another
pass over the texts with the finished model.

Null text: empty (no spans; it stays null when redacted).  An empty table
gives no rows.  Rows without a doc_id and repeated rows are scanned like any
other; further columns are ignored, and kept by ``redacted``.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from railyard.llm.common import landed, map_rows, own_columns, python_batches

# fixed values: the base kinds in order, then this scan's own
KINDS = ("email", "ip", "card", "phone", "number", "spelled", "account")
BASE = 4

BALANCE = 20_000            # corpus examples that weigh one each; more weigh about as much together
PRECISION = 0.95
TREES, DEPTH, RATE = 40, 3, 0.2
SHARES = np.linspace(0.05, 0.95, 16)    # quantiles between which a feature is cut into bins
BINS = len(SHARES) + 1
ONE = 1 << 20               # gradients are whole multiples of 1 / ONE
HERE_ROWS = 1 << 16         # distinct rows of bins whose sums the driver makes itself
CELLS = 1 << 14             # of scores, each of which is taken or left whole

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_NUMBER = re.compile(r"[+(]?[0-9](?:[\x20().,/:-]{0,2}[0-9]){5,}")
_PLAIN = re.compile(r"[0-9]{6,}")
_AT = re.compile(r"\x20?(?:\(at\)|\[at\]|\{at\})\x20?[A-Za-z0-9-]+"
                 r"(?:\x20?(?:\.|\(dot\)|\[dot\]|\{dot\})\x20?[A-Za-z0-9-]+)+")
_ACCOUNT = re.compile(r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?\b"
                      r"|\b[A-Z]{1,2}[0-9]{6,9}\b")
_GROUPS = re.compile("[0-9]+")
_WORD = re.compile("[a-z]+")
_DATE = re.compile(r"(?:(?:19|20)[0-9]{2}[./-][0-9]{1,2}[./-][0-9]{1,2}|[0-9]{1,2}[./-][0-9]{1,2}[./-](?:19|20)[0-9]{2})"
                   r"(?:[\x20:0-9-]*)")
# fixed values: words beside personal numbers, and words before impersonal ones
_HINTS = frozenset("tel telephone phone call calls fax mobile cell contact card visa account iban bank ssn security "
                   "passport mail email write".split())
_OTHERS = frozenset("order invoice item version build release serial model part sku isbn issn page pages chapter "
                    "section line lines ticket case batch lot id ref reference total price sum about year years usd "
                    "eur token password secret key hash commit tracking row rows record records count".split())


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """Four numbers with dots between, each at most 255, from left to right."""
    runs = [m.span() for m in _GROUPS.finditer(text)] if "." in text else []
    i = 0
    while i + 3 < len(runs):
        four = runs[i:i + 4]
        if any(b[0] - a[1] != 1 or text[a[1]] != "." for a, b in zip(four, four[1:], strict=False)):
            i += 1
            continue
        parts = [text[a:b].lstrip("0") for a, b in four]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            yield four[0][0], four[3][1]
        i += 4


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base kinds, by start and kind."""
    found, done = [], 0
    if "@" in text:
        for m in _DOMAIN.finditer(text):
            a = m.start()
            while a > done and text[a - 1] in _LOCAL:
                a -= 1
            if a < m.start():
                found.append((a, 0, m.end()))
                done = m.end()
    if _DIGIT.search(text):
        found += [(a, 1, b) for a, b in _addresses(text)]
        for m in _CARD.finditer(text):
            d = _digits(m[0])
            if 12 <= len(d) <= 19 and luhn(d):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_digits(m[0])) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


def proposals(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Further spans, overlapping ones included; base spans are not repeated."""
    found = set()
    if _DIGIT.search(text):
        for pattern, kind in ((_NUMBER, 4), (_PLAIN, 4), (_ACCOUNT, 6)):
            found |= {(m.start(), kind, m.end()) for m in pattern.finditer(text)}
    if "at)" in text or "at]" in text or "at}" in text:
        done = 0
        for m in _AT.finditer(text):
            a = m.start()
            while a > done and text[a - 1] in _LOCAL:
                a -= 1
            if a < m.start():
                found.add((a, 5, m.end()))
                done = m.end()
    taken = {(a, b) for a, _, b in base}
    return sorted(s for s in found if (s[0], s[2]) not in taken)


def _iban(s: str) -> bool:
    """Check digits of an account number: remainder 1 modulo 97."""
    s = s.replace(" ", "")
    return 15 <= len(s) <= 34 and s[:2].isalpha() and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _named(before: str, after: str) -> tuple[bool, bool]:
    """Whether the nearest words name a personal number, or another one."""
    words = _WORD.findall(before.lower())[-3:]
    near = words + _WORD.findall(after.lower())[:1]
    return any(w in _HINTS for w in near), any(w in _OTHERS for w in words)


def features(text: str, start: int, kind: int, end: int) -> list[float]:
    """Format and context of a span; a leading ``+`` is not looked at, as it
    tells no more than the base rule."""
    s = text[start:end]
    digits = _digits(s)
    groups = [len(g) for g in _GROUPS.findall(s)] or [0]
    before, after = text[max(0, start - 24):start], text[end:end + 24]
    hint, other = _named(before, after)
    last = groups[-4:]
    return [float(x) for x in (
        len(s), len(digits), len(groups), max(groups), min(groups), len(digits) / max(1, len(s)),
        "(" in s, s.count("-"), s.count("."), s.count(" "), s.count(",") + s.count("/") + s.count(":"),
        sum(c.isalpha() for c in s), kind == 5, kind == 6, groups[-2:] == [3, 4], groups == [3, 2, 4],
        len(last) == 4 and set(last) == {4}, s.lstrip("+(")[:1] == "0", luhn(digits) and len(digits) >= 12,
        kind == 6 and _iban(s), bool(_DATE.fullmatch(s)), hint, other,
        before[-1:].isalnum() or before[-1:] == "_", after[:1].isalnum() or after[:1] == "_",
        before.rstrip()[-1:] in ("=", "#", "$", "€", "£"), after.lstrip()[:1] in ("%", "$", "€", "£"))]


def _impersonal(text: str, start: int, end: int) -> bool:
    """Clearly not personal: part of a longer code, an amount, a date, or
    named as something else and not as personal."""
    before, after = text[max(0, start - 24):start], text[end:end + 24]
    hint, other = _named(before, after)
    return (before[-1:].isalpha() or after[:1].isalpha() or before.rstrip()[-1:] in ("$", "€", "£")
            or bool(_DATE.fullmatch(text[start:end])) or (other and not hint))


def _random_iban(rng: np.random.Generator) -> str:
    country, digits = str(rng.choice(["DE", "GB", "FR", "ES"])), "".join(map(str, rng.integers(0, 10, 18)))
    rest = int("".join(str(int(c, 36)) for c in f"{digits}{country}00")) % 97
    s = f"{country}{98 - rest:02d}{digits}"
    return " ".join(s[i:i + 4] for i in range(0, len(s), 4)) if rng.random() < 0.5 else s


#: formats of written examples: N a digit, A a capital, and the words before
PERSONAL = [("NNN-NNN-NNNN", 4, ("phone", "call", "tel:", "mobile", "")), ("(NNN) NNN NNNN", 4, ("call", "fax", "")),
            ("(NNN) NNN-NNNN", 4, ("phone", "contact", "")), ("0NNNN NNNNNN", 4, ("mobile", "tel", "")),
            ("NNN.NNN.NNNN", 4, ("phone", "cell", "")), ("NNN-NN-NNNN", 4, ("ssn", "security", "")),
            ("0NN NNNN NNNN", 4, ("phone", "call", "")), ("NNNNNNNNN", 4, ("passport no", "passport", "account")),
            ("AANNNNNNN", 6, ("passport", "passport no")), ("ANNNNNNNN", 6, ("passport", "passport number"))]
IMPERSONAL = [("NNNNNNNN", 4, ("order", "invoice", "item", "")), ("NNN-NNN-NNNN", 4, ("order", "part", "serial")),
              ("N.NN.NNNN", 4, ("version", "build", "")), ("20NN-0N-1N", 4, ("", "since", "year")),
              ("1N.0N.20NN", 4, ("", "on")), ("N,NNN,NNN", 4, ("total", "about", "$", "")),
              ("97NNNNNNNNNNN", 4, ("isbn", "")), ("NNNNNN-NNNNNN", 4, ("pages", "lines", "")),
              ("NNNNNNNNNNNNNNNN", 4, ("id", "record", "tracking", "")), ("20NN/20NN", 4, ("year", "")),
              ("AANNNNNNN", 6, ("model", "part", "order", "")), ("ANNNNNNNN", 6, ("sku", "serial", "")),
              ("AANN NNNN NNNN NNNN NNNN", 6, ("serial", "key", "")), ("NNN-NN-NNNN", 4, ("item", "sku", "part")),
              ("(NNN) NNN NNNN", 4, ("order", "row")), ("0NNNN NNNNNN", 4, ("serial", "batch", "lot"))]


@cache
def examples(n: int = 3000, seed: int = 1) -> list[tuple[int, int, list[float]]]:
    """(kind, label, features) of written examples, ``n`` of each label.

    The span found by the generators is scored, so that training sees what
    scanning sees.
    """
    rng = np.random.default_rng(seed)
    letters, filler = list("abcdefghijklmnopqrstuvwxyz"), ["the", "and", "of", "is", "it", "in", "der", "la", "que", "et"]

    def word():
        return str(rng.choice(filler)) if rng.random() < 0.5 else "".join(rng.choice(letters, rng.integers(3, 9)))

    def one(y):
        sort = rng.random()
        if sort < 0.15:
            mark = str(rng.choice(["(at)", "[at]", "{at}"]))
            if y:
                dot = str(rng.choice([" (dot) ", "[dot]", ".", " [dot] ", "(dot)"]))
                return f"{word()} {mark} {word()}{dot}{rng.choice(['com', 'org', 'net', 'de'])}", 5, (
                    "mail", "write", "")
            return f"{word()} {mark} {word()}. {word().title()}", 5, ("met", "price", "")
        if y and sort < 0.3:
            return _random_iban(rng), 6, ("iban", "account", "bank", "")
        form, kind, names = (PERSONAL if y else IMPERSONAL)[rng.integers(len(PERSONAL if y else IMPERSONAL))]
        while True:
            s = "".join(str(rng.integers(10)) if c == "N" else chr(65 + rng.integers(26)) if c == "A" else c
                        for c in form)
            if y or not _iban(s):
                return s, kind, names

    out = []
    for y in (1, 0):
        for _ in range(n):
            span, kind, names = one(y)
            left = " ".join([word() for _ in range(3)] + [str(rng.choice(names))]).rstrip()
            if left[-1].isalpha() and rng.random() < 0.3 and not left.endswith(tuple(filler)):
                left += str(rng.choice([":", " is", " number"]))
            left += "" if left.endswith("$") else " "
            right = str(rng.choice([" ", ". ", ", ", ") "])) + word()
            out.append((kind, y, features(left + span + right, len(left), kind, len(left) + len(span))))
    return out


# ------------------------------------------------------------- boosted trees

class BoostedTrees:
    """Logistic gradient boosting of shallow trees on binned features.

    Node i of a tree asks whether the bin of ``feature[i]`` is above
    ``cut[i]`` and leads to node 2i + 1 (no) or 2i + 2 (yes); one that does
    not split leads all to 2i + 1.  Examples are rows of bins that stand for
    ``yes`` personal and ``no`` impersonal ones.
    """

    def __init__(self, trees: int = TREES, depth: int = DEPTH, rate: float = RATE):
        self.trees, self.depth, self.rate = trees, depth, rate
        self.start, self.cuts = 0.0, []
        self.feature = np.zeros((0, 2 ** depth - 1), np.int64)
        self.cut = np.zeros((0, 2 ** depth - 1), np.int64)
        self.leaf = np.zeros((0, 2 ** depth))

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        self.cuts = [np.unique(np.quantile(x[:, f], SHARES)) for f in range(x.shape[1])]
        yes = y.astype(np.int64)
        return self.grown(int(yes.sum()), len(yes), self.summed_here(self.binned(x), yes, 1 - yes))

    def binned(self, x: np.ndarray) -> np.ndarray:
        """Bin k of a feature: above k of its cuts."""
        return np.stack([np.searchsorted(c, x[:, f]) for f, c in enumerate(self.cuts)], axis=1).astype(np.uint8)

    def margin(self, bins: np.ndarray, score: np.ndarray | None = None, first: int = 0) -> np.ndarray:
        """Log odds; ``score`` holds those of the trees before ``first``."""
        score = np.full(len(bins), self.start) if score is None else score
        tree, row = np.arange(len(self.leaf) - first), np.arange(len(bins))[:, None]
        at = np.zeros((len(bins), len(tree)), np.int64)
        for _ in range(self.depth):
            at = 2 * at + 1 + (bins[row, self.feature[first + tree, at]] > self.cut[first + tree, at])
        for t in tree:                          # one after the other, so that parts give the same
            score = score + self.rate * self.leaf[first + t, at[:, t] - (2 ** self.depth - 1)]
        return score

    def predict(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(self.binned(x))))

    def sums(self, bins: np.ndarray, yes: np.ndarray, no: np.ndarray, score: np.ndarray, feature: np.ndarray,
             cut: np.ndarray, level: int) -> np.ndarray:
        """Gradients and curvatures (in 1 / ONE) and numbers of examples, by
        node of the level, feature and bin, for the tree begun."""
        p = 1 / (1 + np.exp(-score))
        n, q = yes + no, np.rint(p * ONE).astype(np.int64)
        node, row = np.zeros(len(bins), np.int64), np.arange(len(bins))
        for _ in range(level):
            node = 2 * node + 1 + (bins[row, feature[node]] > cut[node])
        width = bins.shape[1]
        slot = ((node - (2 ** level - 1))[:, None] * width + np.arange(width)) * BINS + bins
        size = 2 ** level * width * BINS
        # whole numbers, exact up to 2^33 examples in one call
        return np.stack([np.bincount(slot.ravel(), np.repeat(v, width), size) for v in (
            (ONE - q) * yes - q * no, np.rint(p * (1 - p) * ONE).astype(np.int64) * n, n)]).astype(np.int64)

    def summed_here(self, bins: np.ndarray, yes: np.ndarray, no: np.ndarray) -> Callable[..., np.ndarray]:
        """Sums over rows that are all here; scores are kept from tree to tree."""
        kept = {"score": None, "first": 0}

        def level_sums(feature, cut, level):
            if kept["score"] is None or kept["first"] < len(self.leaf):
                kept.update(score=self.margin(bins, kept["score"], kept["first"]), first=len(self.leaf))
            return self.sums(bins, yes, no, kept["score"], feature, cut, level)

        return level_sums

    def grown(self, yes: int, total: int, level_sums: Callable[..., np.ndarray], unit: int = 1) -> BoostedTrees:
        """All trees, level by level, from the sums that ``level_sums``
        gives; ``unit`` examples weigh as much as one."""
        def gain(a, b):
            return a * a / (b + 1.0)

        p = min(max(yes / total, 1e-3), 1 - 1e-3)
        self.start = float(np.log(p / (1 - p)))
        for _ in range(self.trees):
            feature, cut = np.zeros(2 ** self.depth - 1, np.int64), np.full(2 ** self.depth - 1, BINS)
            leaf = np.zeros((2 ** (self.depth - 1), 2))
            for level in range(self.depth):
                found = level_sums(feature, cut, level).reshape(3, 2 ** level, -1, BINS)
                low = np.cumsum(found, axis=3) / (np.array([ONE, ONE, 1]) * float(unit))[:, None, None, None]
                whole = low[:, :, :1, -1:]
                high = whole - low
                won = gain(low[0], low[1]) + gain(high[0], high[1]) - gain(whole[0], whole[1])
                won = np.where((whole[2] >= 8) & (low[2] >= 4) & (high[2] >= 4), won, 0).reshape(2 ** level, -1)
                best = won.argmax(axis=1)
                for i, (k, node) in enumerate(zip(best, range(2 ** level - 1, 2 ** (level + 1) - 1), strict=True)):
                    sides = [whole[:2, i, 0, 0], np.zeros(2)]
                    if won[i, k] > 1e-6:
                        feature[node], cut[node] = divmod(int(k), BINS)
                        sides = [side[:2, i, feature[node], cut[node]] for side in (low, high)]
                    if level == self.depth - 1:
                        leaf[i] = [g / (h + 1.0) for g, h in sides]
            self.feature = np.vstack([self.feature, feature])
            self.cut = np.vstack([self.cut, cut])
            self.leaf = np.vstack([self.leaf, leaf.ravel()])
        return self


def calibrated(score: np.ndarray, y: np.ndarray, precision: float = PRECISION, n: np.ndarray | None = None) -> float:
    """The least threshold from which held-out precision reaches the target
    (Laplace-smoothed), just above the first score that would spoil it; above
    1 if none does.  Of ``n`` examples (one) of a score, ``y`` are personal."""
    order = np.argsort(-score, kind="stable")
    hits, seen = np.cumsum(y[order]), np.cumsum((np.ones(len(y)) if n is None else n)[order])
    ok = np.flatnonzero((hits + 1) / (seen + 2) >= precision)
    if not len(ok):
        return 2.0
    below = score[order][ok[-1] + 1:]
    return float(np.nextafter(below[0], 2)) if len(below) else float(score[order][-1])


class Model:
    """Scores, a threshold for each kind and the choice among overlapping spans."""

    def __init__(self, trees: BoostedTrees | None, thresholds: dict[int, float]):
        self.trees, self.thresholds = trees, thresholds

    def added(self, base, found, rows) -> list[tuple[int, int, int]]:
        if not found or self.trees is None:
            return []
        # as precise as stored features, so that redaction and report agree
        scores = self.trees.predict(np.array(rows, np.float32).astype(float))
        out, starts, ends = [], [], []          # taken stretches, disjoint and in order
        for a, _, b in sorted(base):
            if ends and a < ends[-1]:
                ends[-1] = max(ends[-1], b)
            else:
                starts.append(a)
                ends.append(b)
        for score, span in sorted(zip(scores.tolist(), found, strict=True), key=lambda t: (-t[0], t[1])):
            if score < self.thresholds.get(span[1], 2.0):
                continue
            at = bisect_left(starts, span[2])
            if not at or ends[at - 1] <= span[0]:
                out.append(span)
                starts.insert(at, span[0])
                ends.insert(at, span[2])
        return out


def spans_of(text: str, model: Model) -> list[tuple[int, int, int]]:
    base = base_spans(text)
    found = proposals(text, base)
    return sorted(base + model.added(base, found, [features(text, *s) for s in found]))


def joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


# ------------------------------------------------------------- Spark

ROWS = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base string, "
        "found array<struct<start:long,kind:int,stop:long,x:array<float>>>, "
        "known array<struct<kind:int,y:int,x:array<float>>>")


def _known(text: str, base, found) -> list[dict]:
    """Examples of clear label in one text."""
    out = [{"kind": 4, "y": 1, "x": features(text, a, 4, b)} for a, k, b in base if k in (2, 3)]
    for a, k, b in base:
        if k == 3:          # the same number without its country
            at = text.find(" ", a, b) + 1
            if at and len(_digits(text[at:b])) >= 7:
                out.append({"kind": 4, "y": 1, "x": features(text[at:b + 24], 0, 4, b - at)})
    spans = sorted((a, b) for a, _, b in base)
    for a, k, b in found:
        at = bisect_left(spans, (b,))
        if not (at and spans[at - 1][1] > a) and _impersonal(text, a, b):
            out.append({"kind": k, "y": 0, "x": features(text, a, k, b)})
    return out


def candidates(docs: DataFrame) -> DataFrame:
    """Per document: base counts, digest and spans; further candidates with
    features; and the examples of clear label."""
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for doc_id, text in zip(pdf.iloc[:, 0], pdf.iloc[:, 1], strict=True):
                text = text or ""
                base = base_spans(text)
                found = proposals(text, base)
                text_base = joined(base)
                out.append((doc_id, *[sum(s[1] == k for s in base) for k in range(BASE)],
                            hashlib.sha256(text_base.encode()).hexdigest(), text_base,
                            [{"start": a, "kind": k, "stop": b, "x": features(text, a, k, b)} for a, k, b in found],
                            _known(text, base, found)))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in re.split(r",\s(?=\w+\s)", ROWS)]).astype(
                {"doc_id": "Int64"})

    python_batches(docs.sparkSession, 2000)
    rows = own_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInPandas(run, ROWS)


def weighed(rows: DataFrame, balance: int = BALANCE) -> tuple[DataFrame, int]:
    """All examples of the corpus and all written ones, equal ones counted
    (held, kind, x, yes, no), and how many of the corpus weigh as much as one
    below ``balance``; a written one counts as that many.

    Every third is held out, by place in the order of hashes: places within
    a range of hashes, and what stands before the range (4,096 numbers).
    """
    known = (rows.select("doc_id", F.explode("known").alias("e")).select("doc_id", "e.kind", "e.y", "e.x")
             .withColumn("at", F.xxhash64("doc_id", "kind", "y", "x")))
    known = landed(known.groupBy("at", "doc_id", "kind", "y", "x").agg(F.count("*").alias("n"))
                   .withColumn("part", F.shiftright("at", 52)), "private-examples")
    parts = known.groupBy("part").agg(F.sum("n").alias("size"))
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    parts = parts.select("part", (F.sum("size").over(upto) - F.col("size")).alias("before"))
    own = Window.partitionBy("part").orderBy("at", "doc_id", "kind", "y", "x").rowsBetween(Window.unboundedPreceding, 0)
    last = F.col("before") + F.sum("n").over(own)
    third = F.ceil(last / 3) - F.ceil((last - F.col("n")) / 3)
    split = known.join(F.broadcast(parts), "part").select("kind", "y", "x", "n", third.alias("third")).select(
        "kind", "y", "x", F.explode(F.array(F.struct(F.lit(True).alias("held"), F.col("third").alias("n")), F.struct(
            F.lit(False).alias("held"), (F.col("n") - F.col("third")).alias("n")))).alias("e"))
    corpus = landed(split.where("e.n > 0").groupBy("e.held", "kind", "x").agg(
        F.sum(F.col("e.n") * F.col("y")).alias("yes"), F.sum(F.col("e.n") * (1 - F.col("y"))).alias("no")),
        "private-corpus")
    unit = max(1, round((corpus.agg(F.sum(F.col("yes") + F.col("no"))).first()[0] or 0) / balance))
    kind, y, x = zip(*examples(), strict=True)
    yes = np.array(y, np.int64) * unit
    written = rows.sparkSession.createDataFrame(pa.table({
        "held": np.arange(len(y)) % 3 == 0, "kind": np.array(kind, np.int32), "x": pa.array(x, pa.list_(pa.float32())),
        "yes": yes, "no": unit - yes}))
    return corpus.unionByName(written), unit


def feature_cuts(every: DataFrame) -> list[np.ndarray]:
    """Quantiles of each feature over all examples that are not held out."""
    values = (every.where("not held").select(F.posexplode("x").alias("f", "v"), (F.col("yes") + F.col("no")).alias("n"))
              .groupBy("f", F.col("v").cast("double").alias("v")).agg(F.sum("n").alias("n")))
    cuts = values.groupBy("f").agg(F.percentile("v", SHARES.tolist(), F.col("n")).alias("cuts")).orderBy("f").collect()
    return [np.unique(r["cuts"]) for r in cuts]


def _bins(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(len(column), -1)


def summed_by_spark(trees: BoostedTrees, train: DataFrame) -> Callable[..., np.ndarray]:
    """Sums over rows of any number: each task adds up its own, Spark theirs."""
    def level_sums(feature, cut, level):
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = None
            for pdf in frames:
                bins = _bins(pdf["bins"])
                own = trees.sums(bins, pdf["yes"].to_numpy(), pdf["no"].to_numpy(), trees.margin(bins),
                                 feature, cut, level)
                total = own if total is None else total + own
            if total is not None:
                slot = np.flatnonzero(total[2])
                yield pd.DataFrame({"slot": slot, **dict(zip("ghn", total[:, slot], strict=True))})

        got = (train.select("bins", "yes", "no").mapInPandas(run, "slot long, g long, h long, n long")
               .groupBy("slot").agg(*[F.sum(c).alias(c) for c in "ghn"]).collect())
        out = np.zeros((3, 2 ** level * len(trees.cuts) * BINS), np.int64)
        for r in got:
            out[:, r["slot"]] = r["g"], r["h"], r["n"]
        return out

    return level_sums


def trained(rows: DataFrame, precision: float = PRECISION, balance: int = BALANCE, here: int = HERE_ROWS) -> Model:
    """Trees, and a threshold for each kind, from all written examples and
    all of the corpus.  Up to ``here`` distinct rows of bins are summed on the
    driver, more by Spark, with the same result."""
    every, unit = weighed(rows, balance)
    trees = BoostedTrees()
    trees.cuts = feature_cuts(every)

    def bins(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            if len(pdf):
                own = trees.binned(np.stack(pdf["x"]).astype(float))
                yield pdf.drop(columns="x").assign(bins=[r.tobytes() for r in own])

    python_batches(rows.sparkSession, 1 << 14)
    binned = landed(every.mapInPandas(bins, "held boolean, kind int, yes long, no long, bins binary")
                    .groupBy("held", "kind", "bins").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")),
                    "private-bins")
    train = binned.where("not held")
    n, yes, no = train.agg(F.count("*"), F.sum("yes"), F.sum("no")).first()
    if n <= here:
        pdf = train.toPandas()
        sums = trees.summed_here(_bins(pdf["bins"]), pdf["yes"].to_numpy(), pdf["no"].to_numpy())
    else:
        sums = summed_by_spark(trees, train)
    trees.grown(yes, yes + no, sums, unit)

    def scores(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            if len(pdf):
                score = 1 / (1 + np.exp(-trees.margin(_bins(pdf["bins"]))))
                yield pdf.drop(columns="bins").assign(score=score, cell=np.floor(score * CELLS).astype(np.int64))

    held = (binned.where("held").drop("held").mapInPandas(scores, "kind int, yes long, no long, score double, cell long")
            .groupBy("kind", "cell").agg(F.max("score").alias("score"), F.sum("yes").alias("yes"),
                                         F.sum(F.col("yes") + F.col("no")).alias("n"))).toPandas()
    python_batches(rows.sparkSession, 2000)
    return Model(trees, {int(k): max(0.5, calibrated(own["score"].to_numpy(), own["yes"].to_numpy() / unit, precision,
                                                     own["n"].to_numpy() / unit)) for k, own in held.groupby("kind")})


def private_report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, base counts and digest, and all spans."""
    rows = landed(candidates(docs), "private")
    model = trained(rows)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for base, found in zip(pdf["base"], pdf["found"], strict=True):
                own = [(int(a), KINDS.index(k), int(b)) for k, a, b in (s.split(":") for s in base.split(",") if s)]
                spans = [(int(s["start"]), int(s["kind"]), int(s["stop"])) for s in found]
                out.append(joined(sorted(own + model.added(own, spans, [s["x"] for s in found]))))
            yield pdf.drop(columns=["base", "found"]).assign(spans=out).astype({"doc_id": "Int64"})

    return rows.drop("known").mapInPandas(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
                                               "base_sha256 string, spans string")


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Spans, overlapping ones together, give way to their kind's name."""
    out, at = [], 0
    for a, k, b in spans:
        if a >= at:
            out += [text[at:a], f"<{KINDS[k].upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame) -> DataFrame:
    """The documents with their spans redacted; n_chars, if there, follows."""
    model = trained(landed(candidates(docs), "private"))
    schema, at = docs.schema, docs.columns.index("text")
    chars = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = list(batch.columns)
            texts = cols[at].to_pylist()
            new = [t and redact(t, spans_of(t, model)) for t in texts]
            cols[at] = pa.array(new, cols[at].type)
            if chars is not None:
                cols[chars] = pa.array([n if a == b else len(b) for n, a, b in zip(
                    cols[chars].to_pylist(), texts, new, strict=True)], cols[chars].type)
            yield pa.RecordBatch.from_arrays(cols, schema=batch.schema)

    python_batches(docs.sparkSession, 2000)
    return map_rows(docs, run, schema)
