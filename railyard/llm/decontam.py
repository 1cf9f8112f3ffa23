"""Benchmark decontamination by latent semantic retrieval.

Passages are TF-IDF vectors over hashed words.  A randomised SVD of all
passages gives latent coordinates: one pass over the corpus multiplies the
Gram matrix of the passages with a random test matrix (per-task sums that
Spark adds up), and the small matrix that this leaves gives the leading
directions (single-pass, Nystrom form); passages with a feature are counted
while the words are written.  Overlapping windows of every document meet the windows
of the benchmark items, a stated query set taken in blocks, by cosine; what
comes near is checked on the words: length of the longest common subsequence
against the item's, and of its answer (the closing sentence), so that
paraphrases with words changed, added or lost are found and passages that
merely share vocabulary are not.  A short item fills only part of a window,
so its cosine need only reach what that part allows.  Beside the latent
search, every place that shares ``GRAM`` words in a row with an item (two for
an item of at most ``WINDOW`` words, all of one of fewer) is checked the same
way, so a copy is found whatever its vector is worth.

Words: runs without ASCII white space, lower case, outer punctuation off,
hashed to 32 bits, which is what the checks compare; the low 12 bits are the
TF-IDF feature.

Null texts hold no passage; null, wordless items match nothing; items of
fewer than ``SHORT`` words match only whole.  Rows without a doc_id and
repeated rows are searched like any other; ties all count; an empty table on
either side gives no rows; further columns are ignored, and kept by
``decontaminated``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard.llm.common import landed, map_rows, own_columns, small_batches

FEATURES = 4096
RANK = 112
OVERSAMPLE = 8
WINDOW = 32             # words of a passage and of a query window
STRIDE = 16
NEAR = 0.4              # cosine of a candidate, for items that fill a window
MATCH = 0.8             # share of an item in order, alone enough
PARAPHRASE = 0.6        # share that is enough with the answer
ANSWER = 0.6            # share of the answer in order
SHORT = 8
BLOCK_ITEMS = 1000      # items of one block of queries
CHUNK = 65_536          # words worked on at once
GRAM = 3                # words in a row that make a place a candidate
PROBED = 1 << 20        # places of grams worked on at once
PAIRS = 8192            # candidate places checked at once
MASK_BYTES = 64 << 20   # of a block's match masks as one table; looked up by key beyond
BATCH_BYTES = 8 << 20
EDGES = ".,;:!?\"'()[]{}<>*#|"


# ------------------------------------------------------------- words

def _word_ids(texts: pa.Array) -> Iterator[np.ndarray]:
    """32-bit word hashes of each text, in order; words of which nothing is
    left are dropped."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    coded = pc.dictionary_encode(split.flatten())
    plain = pc.dictionary_encode(pc.utf8_trim(pc.utf8_lower(coded.dictionary), EDGES))
    names = plain.dictionary.to_numpy(zero_copy_only=False)
    hashes = pd.util.hash_array(names, categorize=False).astype(np.uint32) if len(names) else np.zeros(0, np.uint32)
    at = plain.indices.to_numpy(zero_copy_only=False)[coded.indices.to_numpy(zero_copy_only=False)]
    every, left = hashes[at], (names != "")[at]
    bounds = split.offsets.to_numpy() - split.offsets[0].as_py()
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        yield every[a:b] if left[a:b].all() else every[a:b][left[a:b]]


def _hash(word: str) -> int:
    """32-bit hash of a word, -1 if nothing is left of it."""
    own = next(_word_ids(pa.array([word])))
    return int(own[0]) if len(own) else -1


def passages_with(texts: list[np.ndarray]) -> np.ndarray:
    """How many passages of the texts hold each feature, and how many there are."""
    size = np.array([len(x) for x in texts], np.int64)
    rows = -(-size // WINDOW)
    flat = np.concatenate([*texts, np.zeros(0, np.uint32)])
    table = np.full(int(rows.sum()) * WINDOW, FEATURES, np.uint16)
    shift = (np.cumsum(rows) - rows) * WINDOW - (np.cumsum(size) - size)
    table[np.arange(len(flat)) + np.repeat(shift, size)] = flat & (FEATURES - 1)
    table = np.sort(table.reshape(-1, WINDOW), axis=1)
    once = np.ones(table.shape, bool)
    once[:, 1:] = table[:, 1:] != table[:, :-1]
    return np.append(np.bincount(table[once], minlength=FEATURES + 1)[:FEATURES], len(table))


def tokens(docs: DataFrame) -> DataFrame:
    """doc_id and the word hashes of every whole text; beside the first row
    of a batch, what ``passages_with`` says of the batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, BATCH_BYTES):
            texts = list(_word_ids(batch.column(1)))
            held = sum(passages_with(texts[a:b]) for a, b in _runs(texts, CHUNK)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x.tobytes() for x in texts], pa.binary()),
                 pa.array([held.tobytes()] + [None] * (len(texts) - 1), pa.binary())], ["doc_id", "ids", "held"])
        pa.default_memory_pool().release_unused()

    rows = own_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, ids binary, held binary")


def _ids(column) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint32) for x in column]


def _runs(texts: list[np.ndarray], words: int) -> Iterator[tuple[int, int]]:
    """Neighbouring texts of about ``words`` words together."""
    first, size = 0, 0
    for i, x in enumerate(texts):
        size += len(x)
        if size >= words:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


# ------------------------------------------------------------- model

def inverse_frequency(words: DataFrame) -> np.ndarray:
    """log(1 + passages / passages with the feature), over all passages:
    above 0 for every feature, however common."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(FEATURES + 1, np.int64)
        for pdf in frames:
            for held in pdf["held"]:
                total += np.frombuffer(held, np.int64)
        yield pd.DataFrame({"f": np.arange(FEATURES + 1), "n": total})

    rows = (words.where(F.col("held").isNotNull()).select("held").mapInPandas(run, "f long, n long")
            .groupBy("f").agg(F.sum("n").alias("n")).collect())
    n = np.zeros(FEATURES + 1)
    for r in rows:
        n[r["f"]] = r["n"]
    return np.log1p((n[FEATURES] + 1) / (n[:FEATURES] + 1)).astype(np.float32)


def _slots(place: np.ndarray, members: np.ndarray, width: int, none: int) -> tuple[np.ndarray, np.ndarray]:
    """Members in rows of ``width``, one ``place`` a row (rows of a place stand
    together, the last one filled up with ``none``), and each row's place.
    ``place`` must not decrease."""
    starts = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    count = np.diff(np.r_[starts, len(place)])
    rows = -(-count // width)
    first = (np.cumsum(rows) - rows) * width
    out = np.full(int(rows.sum()) * width, none, np.int64)
    out[np.arange(len(place)) - np.repeat(starts - first, count)] = members
    return out.reshape(-1, width), np.repeat(place[starts], rows)


def _row_sums(table: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Sum of the table's rows that each row of slots names."""
    out = table.take(slots[:, 0], axis=0)
    for k in range(1, slots.shape[1]):
        out += table.take(slots[:, k], axis=0)
    return out


def _product(words: DataFrame, idf: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A'(A right) for the matrix A of all passages (unit rows)."""
    width = right.shape[1]
    base = np.zeros((FEATURES + 1, width), np.float32)      # the last row fills up
    base[:-1] = right * idf[:, None]
    square = np.append(idf * idf, 0).astype(np.float32)

    def add(out: np.ndarray, ids: np.ndarray, place: np.ndarray) -> None:
        f = (ids & (FEATURES - 1)).astype(np.int64)
        slots, _ = _slots(place, f, WINDOW, FEATURES)
        rows = np.zeros((len(slots) + 1, width), np.float32)
        rows[:-1] = _row_sums(base, slots) / np.maximum(square[slots].sum(axis=1), 1e-6)[:, None]
        passage = np.cumsum(np.r_[0, place[1:] != place[:-1]])
        order = np.argsort(f.astype(np.uint16), kind="stable")
        back, feature = _slots(f[order], passage[order], 8, len(slots))
        seg = np.flatnonzero(np.r_[True, feature[1:] != feature[:-1]])
        at = feature[seg]
        out[at] += np.add.reduceat(_row_sums(rows, back), seg, axis=0) * idf[at][:, None]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = np.zeros((FEATURES, width))
        for pdf in frames:
            texts = _ids(pdf["ids"])
            for a, b in _runs(texts, CHUNK):
                if not sum(map(len, texts[a:b])):
                    continue
                # texts never share a passage: each one's places start anew
                at = np.concatenate([np.arange(len(x)) // WINDOW for x in texts[a:b]])
                size = np.array([-(-len(x) // WINDOW) for x in texts[a:b]])
                at += np.repeat(np.cumsum(size) - size, [len(x) for x in texts[a:b]])
                ids = np.concatenate(texts[a:b])
                for k in range(0, len(ids), 2 * CHUNK):
                    add(out, ids[k:k + 2 * CHUNK], at[k:k + 2 * CHUNK])
        yield pd.DataFrame({"f": np.arange(FEATURES), "v": list(out.astype(np.float32))})

    parts = words.select("ids").mapInPandas(run, "f int, v array<float>")
    sums = parts.groupBy("f").agg(*[F.sum(F.get("v", F.lit(k)).cast("double")).alias(f"v{k}") for k in range(width)])
    total = np.zeros((FEATURES, width))
    for r in sums.collect():                    # FEATURES rows at any input size
        total[r["f"]] = r[1:]
    return total


class Latent:
    """Projection of feature counts to whitened latent coordinates."""

    def __init__(self, table: np.ndarray):
        # a row per feature, idf and scaling included; the last one fills up
        self.table = np.concatenate([table, np.zeros((1, table.shape[1]))]).astype(np.float32)

    def windows(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Unit coordinates of the overlapping windows of all texts, the
        number of each one's text, and its first word there."""
        n = np.array([max(1, -(-len(x) // STRIDE)) for x in texts])
        first = np.cumsum(n) - n
        place = np.concatenate([np.arange(len(x)) // STRIDE + a for x, a in zip(texts, first, strict=True)])
        blocks = np.zeros((int(n.sum()), self.table.shape[1]), np.float32)
        if len(place):
            slots, at = _slots(place, (np.concatenate(texts) & (FEATURES - 1)).astype(np.int64), STRIDE, FEATURES)
            blocks[at] = _row_sums(self.table, slots)
        owner = np.repeat(np.arange(len(texts)), n)
        k = np.arange(len(owner)) - first[owner]
        # a window is two neighbouring blocks; a text of one block is its own
        head = (k < n[owner] - 1) | (n[owner] == 1)
        blocks[:-1] += np.where(owner[1:] == owner[:-1], 1, 0)[:, None].astype(np.float32) * blocks[1:]
        out, owner, k = blocks[head], owner[head], k[head]
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-6), owner, k * STRIDE


def leading(product: np.ndarray, test: np.ndarray, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """Leading eigenvectors and values of a positive matrix G from G test
    alone (``test`` with orthonormal columns): those of the matrix of low rank
    (G test) (test' G test)^-1 (G test)', by a Cholesky factor of the middle,
    slightly shifted so that it has one."""
    shift = 1e-7 * max(float(np.linalg.norm(product)), 1e-12)
    product = product + shift * test
    middle = test.T @ product
    factor = np.linalg.cholesky((middle + middle.T) / 2)
    vectors, sizes, _ = np.linalg.svd(np.linalg.solve(factor, product.T).T, full_matrices=False)
    return vectors[:, :rank], np.maximum(sizes[:rank] ** 2 - shift, 0)


def latent_model(words: DataFrame, rank: int = RANK, seed: int = 7) -> Latent:
    """Randomised SVD of the TF-IDF matrix of all passages, in one pass."""
    idf = inverse_frequency(words)
    test, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((FEATURES, rank + OVERSAMPLE)))
    vectors, values = leading(_product(words, idf, test), test, rank)
    scale = 1 / np.sqrt(np.maximum(values, 1e-9 * max(values.max(), 1e-9)))
    return Latent(vectors * scale[None, :] * idf[:, None])


# ------------------------------------------------------------- queries

LANE = 64               # words whose matches one machine word holds


def _lanes(masks: Iterator[np.ndarray], pairs: int) -> np.ndarray:
    """Longest common subsequence of many (item lane, slice) pairs at once,
    by bit-parallel addition; the masks of word k of the slices say, per
    pair, which of the item's words equal it.  Lanes shorter than 64 words
    leave ones."""
    row = np.full(pairs, ~np.uint64(0))
    for own in masks:
        u = row & own
        row = (row + u) | (row - u)
    return LANE - np.bitwise_count(row).astype(np.int64)


class Matches:
    """Which of a lane's words each word code stands for: one table where it
    is small, else looked up by (lane, code)."""

    def __init__(self, lane: np.ndarray, code: np.ndarray, place: np.ndarray, lanes: int, codes: int):
        self.lanes, self.codes = lanes, codes
        self.keys, first = np.unique(lane.astype(np.int64) * codes + code, return_inverse=True)
        self.bits = np.zeros(len(self.keys), np.uint64)
        np.bitwise_or.at(self.bits, first, np.uint64(1) << place.astype(np.uint64))
        self.table = None                               # made where it is used, never sent

    def of(self, lane: np.ndarray, slices: np.ndarray) -> Iterator[np.ndarray]:
        """Masks of slices (words x pairs) against each pair's lane, word by word."""
        small, row = self.lanes * self.codes * 8 <= MASK_BYTES, lane * self.codes
        if small and self.table is None:
            self.table = np.zeros(self.lanes * self.codes, np.uint64)
            self.table[self.keys] = self.bits
        for words in slices:
            key = row + words
            if small:
                yield self.table.take(key)
            else:
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                yield np.where(self.keys[at] == key, self.bits[at], np.uint64(0))

    def lcs(self, lane: np.ndarray, slices: np.ndarray) -> np.ndarray:
        return _lanes(self.of(lane, slices), len(lane))


def lcs(words: list[int], other: list[int]) -> int:
    """Longest common subsequence for items beyond one lane."""
    masks: dict[int, int] = {}
    for i, x in enumerate(words):
        masks[x] = masks.get(x, 0) | 1 << i
    full = row = (1 << len(words)) - 1
    for x in other:
        u = row & masks.get(x, 0)
        row = ((row + u) | (row - u)) & full
    return len(words) - row.bit_count()


class Items:
    """One block of benchmark items: query windows, and which of an item's
    words each word of the block's vocabulary stands for."""

    def __init__(self, rows: list[tuple[int, str]], model: Latent):
        self.model = model
        texts = [t or "" for _, t in rows]
        closing = [t.rstrip(" \t\n.!?").replace("!", ".").replace("?", ".").rpartition(".")[2] for t in texts]
        words = list(_word_ids(pa.array(texts, pa.string())))
        tails = list(_word_ids(pa.array(closing, pa.string())))
        self.items = [(r[0], w, t) for r, w, t in zip(rows, words, tails, strict=True) if len(w)]
        own = [w for _, w, _ in self.items] or [np.zeros(0, np.uint32)]
        self.vectors, self.owner, self.start = model.windows(own)
        if not self.items:
            self.vectors = self.vectors[:0]
        self.n = np.array([len(w) for w in own])
        self.gate = np.sqrt(np.minimum(self.n, WINDOW) / WINDOW)[self.owner].astype(np.float32)
        self.vocabulary = np.unique(np.concatenate(own))
        self.codes = len(self.vocabulary) + 1           # 0: not in any item
        self.tables = self._by_low_bits()
        self.lane_of = np.cumsum(-(-self.n // LANE)) - -(-self.n // LANE)
        self.tail_n, parts, tails = np.ones(len(own)), [], []
        for o, (_, w, t) in enumerate(self.items):
            code, tail = self.code(w), self.code(t[-LANE:] if len(t) else w[-LANE:])
            self.tail_n[o] = len(tail)
            at = np.arange(len(code))
            parts.append((self.lane_of[o] + at // LANE, code, at % LANE))
            tails.append((np.full(len(tail), o), tail, np.arange(len(tail))))
        none = [(np.zeros(0, np.int64),) * 3]
        self.matches, self.tail_matches = (
            Matches(*map(np.concatenate, zip(*(x or none), strict=True)), lanes, self.codes)
            for x, lanes in ((parts, int((-(-self.n // LANE)).sum())), (tails, len(own))))
        self.grams = {}         # words in a row: keys in order, item and place of each
        for k in range(1, GRAM + 1):
            parts = [(self._keys(self.code(w), k), o) for o, (_, w, _) in enumerate(self.items)
                     if k == min(2 if len(w) <= WINDOW else GRAM, len(w))]
            if parts:
                key = np.concatenate([x for x, _ in parts])
                order = np.argsort(key, kind="stable")
                self.grams[k] = (key[order], np.concatenate([np.full(len(x), o) for x, o in parts])[order],
                                 np.concatenate([np.arange(len(x)) for x, _ in parts])[order])

    def _by_low_bits(self) -> list[np.ndarray]:
        """Codes of the vocabulary by the low 16 bits of the hash; words that
        share them stand in further tables."""
        tables, left = [], np.arange(len(self.vocabulary))
        while len(left) or not tables:
            table = np.zeros(1 << 16, np.int32)
            low, first = np.unique(self.vocabulary[left] & 0xFFFF, return_index=True)
            table[low] = left[first] + 1
            tables.append(table)
            left = np.delete(left, first)
        return tables

    def code(self, words: np.ndarray) -> np.ndarray:
        """Place of each word in the block's vocabulary, from 1; 0 if it is
        in no item.  All 32 bits are compared."""
        out, low = np.zeros(len(words), np.int32), words & 0xFFFF
        if len(self.vocabulary):
            for table in self.tables:
                found = table[low]
                out += np.where((found > 0) & (self.vocabulary[found - 1] == words), found, 0)
        return out

    def _keys(self, codes: np.ndarray, k: int) -> np.ndarray:
        """One number for every ``k`` codes in a row."""
        n = max(0, len(codes) - k + 1)
        key = np.zeros(n, np.int64)
        for j in range(k):
            key = key * self.codes + codes[j:j + n]
        return key

    def _probed(self, codes: np.ndarray, sizes: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Document, item, place in the document and place in the item of all
        grams that both hold, one for each pair and ``STRIDE`` diagonals."""
        for k, (keys, items, places) in self.grams.items():
            at = np.flatnonzero(codes[:max(0, len(codes) - k + 1)])
            for j in range(1, k):
                at = at[codes[at + j] > 0]
            key = np.zeros(len(at), np.int64)
            for j in range(k):
                key = key * self.codes + codes[at + j]
            low = np.searchsorted(keys, key)
            has = keys[np.minimum(low, len(keys) - 1)] == key
            at, low, key = at[has], low[has], key[has]
            doc = np.searchsorted(ends, at, "right")
            has = at + k <= ends[doc]
            at, low, doc = at[has], low[has], doc[has]
            count = np.searchsorted(keys, key[has], "right") - low
            batch = (np.cumsum(count) - count) // PROBED
            for a, b in zip(*(lambda x: (x[:-1], x[1:]))(np.r_[0, np.flatnonzero(np.diff(batch)) + 1, len(at)]),
                            strict=True):
                n = count[a:b]
                if not n.sum():
                    continue
                gram = np.repeat(low[a:b] - np.cumsum(n) + n, n) + np.arange(n.sum())
                d, item, place = np.repeat(doc[a:b], n), items[gram], places[gram]
                inside = np.repeat(at[a:b], n) - ends[d] + sizes[d]
                diagonal = (inside - place) // STRIDE
                pair = (d * len(self.items) + item) * int(np.ptp(diagonal) + 1) + diagonal - diagonal.min()
                one = np.unique(pair, return_index=True)[1]
                yield d[one], item[one], inside[one], place[one]

    def _checked(self, flat: np.ndarray, codes: np.ndarray, ends: np.ndarray, doc: np.ndarray, item: np.ndarray,
                 begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Matched words and answer share of candidate places, many at once."""
        reach = self.n[item] + WINDOW + STRIDE
        span = int(reach.max())
        rows = np.lib.stride_tricks.sliding_window_view(np.append(codes, np.zeros(span, codes.dtype)), span)[begin]
        rows[np.arange(span)[None, :] >= np.minimum(reach, ends[doc] - begin)[:, None]] = 0
        slices = np.ascontiguousarray(rows.T)
        matched = np.zeros(len(item), np.int64)
        for lane in range(int(-(-self.n[item].max() // LANE))):
            has = np.flatnonzero(self.n[item] > lane * LANE)
            own = slices if len(has) == len(item) else slices[:, has]
            matched[has] += self.matches.lcs(self.lane_of[item[has]] + lane, own)
        answer = np.zeros(len(item))
        near = np.flatnonzero(matched >= PARAPHRASE * self.n[item])
        if len(near):
            answer[near] = self.tail_matches.lcs(item[near], slices[:, near]) / self.tail_n[item[near]]
        # the sum over lanes bounds a long item's match; what passes is counted exactly
        for k in near[self.n[item[near]] > LANE].tolist():
            own = flat[begin[k]:min(ends[doc[k]], begin[k] + reach[k])]
            matched[k] = lcs(self.items[item[k]][1].tolist(), own.tolist())
        return matched, answer

    def _leaks(self, texts: list[np.ndarray], near: float) -> Iterator[pd.DataFrame]:
        windows, owner, start = self.model.windows(texts)
        sizes = np.array([len(x) for x in texts])
        ends = np.cumsum(sizes)
        flat = np.concatenate(texts)
        codes = self.code(flat)
        own_window, own_query = np.searchsorted(owner, np.arange(len(texts))), np.searchsorted(
            self.owner, np.arange(len(self.items)))

        def places() -> Iterator[tuple[np.ndarray, ...]]:
            for a in range(0, len(windows), 2048):
                cosine = windows[a:a + 2048] @ self.vectors.T
                w, q = np.nonzero(cosine >= near * self.gate)
                doc, item = owner[a + w], self.owner[q]
                yield doc, item, np.maximum(0, start[a + w] - self.start[q] - STRIDE), cosine[w, q]
            last_window = np.r_[own_window[1:], len(owner)] - 1
            last_query = np.r_[own_query[1:], len(self.owner)] - 1
            for doc, item, inside, place in self._probed(codes, sizes, ends):
                w = np.minimum(own_window[doc] + inside // STRIDE, last_window[doc])
                q = np.minimum(own_query[item] + place // STRIDE, last_query[item])
                cosine = np.concatenate([(windows[w[k:k + 8192]] * self.vectors[q[k:k + 8192]]).sum(axis=1)
                                         for k in range(0, len(w), 8192)])
                yield doc, item, np.maximum(0, (inside - place) // STRIDE * STRIDE - STRIDE), cosine

        for docs, items, begins, cosines in places():
            order = np.argsort(self.n[items], kind="stable")        # items of like length together
            docs, items, begins, cosines = docs[order], items[order], begins[order], cosines[order]
            for k in range(0, len(docs), PAIRS):
                doc, item, offset = docs[k:k + PAIRS], items[k:k + PAIRS], begins[k:k + PAIRS]
                begin = ends[doc] - sizes[doc] + offset
                matched, answer = self._checked(flat, codes, ends, doc, item, begin)
                n = self.n[item]
                share = matched / n
                leak = np.where(n < SHORT, share == 1, (share >= MATCH) | ((share >= PARAPHRASE) & (answer >= ANSWER)))
                if leak.any():
                    yield pd.DataFrame({"doc": doc, "item": item, "start_word": offset,
                                        "matched_words": matched, "share": share, "answer_share": answer,
                                        "cosine": cosines[k:k + PAIRS].astype(float)})[leak]

    def found(self, texts: list[np.ndarray], near: float = NEAR) -> pd.DataFrame:
        """(doc, item_id, start_word, matched_words, share, answer_share,
        cosine) of the items that the texts hold, each at its best place;
        ``doc`` counts the texts from 0."""
        parts = []
        if len(self.vectors):
            for a, b in _runs(texts, CHUNK):
                if sum(map(len, texts[a:b])):
                    parts += [p.assign(doc=p["doc"] + a) for p in self._leaks(texts[a:b], near)]
        names = ["doc", "item_id", "start_word", "matched_words", "share", "answer_share", "cosine"]
        if not parts:
            return pd.DataFrame({c: pd.Series([], dtype=float) for c in names})
        best = (pd.concat(parts).sort_values(["doc", "item", "share", "cosine", "start_word"],
                                             ascending=[True, True, False, False, True])
                .drop_duplicates(["doc", "item"]).reset_index(drop=True))
        return best.assign(item_id=[self.items[o][0] for o in best["item"]])[names]


def item_blocks(benchmark: DataFrame, model: Latent, block_items: int = BLOCK_ITEMS) -> Iterator[Items]:
    """The queries, ``block_items`` or so at a time."""
    rows = own_columns(benchmark, "item_id", "text").select(
        F.col("item_id").cast("long"), F.col("text").cast("string"))
    n = max(1, -(-rows.count() // block_items))
    for k in range(n):
        own = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield Items([(r["item_id"], r["text"]) for r in own.collect()], model)


FOUND = ("doc_id long, item_id long, start_word long, matched_words long, share double, answer_share double, "
         "cosine double")


def leaks(docs: DataFrame, benchmark: DataFrame, near: float = NEAR, rank: int = RANK) -> DataFrame:
    """Every (document, item) pair that passes the checks, at its best place;
    all blocks of items are searched in one pass."""
    words = landed(tokens(docs), "words")
    blocks = list(item_blocks(benchmark, latent_model(words, rank)))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            texts = _ids(pdf["ids"])
            for items in blocks:
                hits = items.found(texts, near)
                doc_ids = pdf["doc_id"].astype("Int64").to_numpy()[hits["doc"].to_numpy(np.int64)]
                yield hits.drop(columns="doc").assign(doc_id=pd.array(doc_ids, "Int64")).astype({"item_id": "Int64"})[
                    [c.split()[0] for c in FOUND.split(", ")]]

    return words.select("doc_id", "ids").mapInPandas(run, FOUND)


def decontaminated(docs: DataFrame, benchmark: DataFrame, near: float = NEAR, rank: int = RANK) -> DataFrame:
    """The documents that hold no benchmark item, all columns unchanged;
    words are made once for all blocks of items."""
    at = docs.columns.index("text")
    blocks = list(item_blocks(benchmark, latent_model(landed(tokens(docs), "words"), rank)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, BATCH_BYTES):
            texts = list(_word_ids(batch.column(at).cast(pa.string())))
            keep = np.ones(len(texts), bool)
            for items in blocks:
                left = np.flatnonzero(keep)
                keep[left[items.found([texts[i] for i in left], near)["doc"].to_numpy(np.int64)]] = False
            yield batch.filter(pa.array(keep))

    return map_rows(docs, run, docs.schema)
