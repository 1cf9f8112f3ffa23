"""Sum-of-squares packing of tokenised documents into fixed-length sequences.

Tokenising is one pass over the texts that keeps only lengths and digests;
the placement then moves a few numbers per piece, never the tokens.

Placement: pieces are dealt at random over shards of a bounded size.  In a
shard they are placed from the longest to the shortest; each goes to the open
bin, among those with room, for which the sum over residual gaps of (number
of open bins with that gap) squared becomes smallest, and a bin is opened
only when none has room.  Shards do not grow with the input, their number
does; each wastes about one bin.

Null texts count as empty (one piece: the closing id).  Pieces without a
doc_id, repeated rows and ties are packed like any other row; an empty table
gives no rows; further input columns are ignored.
"""

from __future__ import annotations

import os
import string
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard.llm.common import landed, own_columns, python_batches

SEQUENCE = 2048
END_ID = 0
SHARD_PIECES = 32_768
WORDS_KEPT = 400_000          # words, and runs of letters, remembered by a task, then forgotten

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class WordTokenizer:
    """Ids of whole columns of texts under a word-level BPE file.

    No token of such a file spans white space, so the ids of a text are those
    of its words in order.  Each distinct word of a batch is encoded once, by
    its letters where it is of the common form, and the batch is put together
    from them by index.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tok = Tokenizer.from_file(path)
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        # plain Latin words take the short way below; others, and those that
        # may hold a special token, the tokenizer's own
        self.plain = regex.compile(r"(?!.*<\|)[!-~\u00a1-\u024f]*").fullmatch
        self.cut = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+|\n")
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in shown]
        self.byte_char = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}
        marks = {c: self.tok.encode(c, add_special_tokens=False).ids for c in string.punctuation}
        self.marks = {c: ids[0] for c, ids in marks.items() if len(ids) == 1}
        self.easy = f"^[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+[{regex.escape(''.join(self.marks))}]?$"

    def forget(self) -> None:
        """Give back what a task has remembered: its worker lives on."""
        self.words, self.parts = {}, {}
        pa.default_memory_pool().release_unused()

    def _part(self, part: str) -> bytes:
        text = part if part.isascii() else "".join([self.byte_char[b] for b in part.encode()])
        ids = [t.id for t in self.tok.model.tokenize(text)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _learn(self, words: list[str]) -> None:
        plain = [w for w in words if self.plain(w)]
        for w in words:
            if not self.plain(w):
                ids = self.tok.encode(w, add_special_tokens=False).ids
                self.words[w] = np.array(ids, "<u4").tobytes()
        known, at, out = self.parts, 0, []
        for part in self.cut.findall("\n".join(plain).lower()) if plain else ():
            if part == "\n":
                self.words[plain[at]] = b"".join(out)
                at, out = at + 1, []
                continue
            ids = known.get(part)
            if ids is None:
                ids = known[part] = self._part(part)
            out.append(ids)
        if plain:
            self.words[plain[at]] = b"".join(out)

    def _cores(self, words: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Ids of distinct cores, each word's core, and the id after it (-1: none).

        A run of Latin letters with at most one mark behind it, by far the
        most common word, is its lower-case letters and the mark's own id;
        words that differ in capitals and marks share a core.
        """
        easy = pc.match_substring_regex(words, self.easy)
        mask = easy.to_numpy(zero_copy_only=False)
        lower = pc.utf8_lower(words.filter(easy))
        ends = pc.dictionary_encode(pc.utf8_slice_codeunits(lower, -1))
        marks = np.array([self.marks.get(c, -1) for c in ends.dictionary.to_pylist()], np.int64)
        stems = pc.dictionary_encode(pc.utf8_rtrim(lower, "".join(self.marks)))
        others = words.filter(pc.invert(easy)).to_pylist()
        for known in (self.words, self.parts):
            if len(known) > WORDS_KEPT:
                known.clear()
        cores = []
        for part in stems.dictionary.to_pylist():
            ids = self.parts.get(part)
            if ids is None:
                ids = self.parts[part] = self._part(part)
            cores.append(ids)
        core, after = np.empty(len(words), np.int64), np.full(len(words), -1, np.int64)
        core[mask] = stems.indices.to_numpy(zero_copy_only=False)
        after[mask] = marks[ends.indices.to_numpy(zero_copy_only=False)]
        core[~mask] = len(cores) + np.arange(len(others))
        if missing := [w for w in others if w not in self.words]:
            self._learn(missing)
        return cores + [self.words[w] for w in others], core, after

    def batch(self, texts: pa.Array) -> Iterator[bytes]:
        """Little-endian 32-bit ids of each text (null: empty)."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = pc.dictionary_encode(split.flatten())
        cores, core, after = self._cores(coded.dictionary)
        n_core = np.fromiter((len(x) >> 2 for x in cores), np.int64, len(cores))
        at_core = np.cumsum(n_core) - n_core
        n = n_core[core]
        size = n + (after >= 0)
        first = np.cumsum(size) - size
        flat, begin = np.empty(int(size.sum()), "<u4"), np.cumsum(n) - n
        step = np.arange(int(n.sum()))
        flat[step + np.repeat(first - begin, n)] = np.frombuffer(b"".join(cores), "<u4")[
            step + np.repeat(at_core[core] - begin, n)]
        flat[(first + n)[after >= 0]] = after[after >= 0]
        codes = coded.indices.to_numpy(zero_copy_only=False)
        bounds = split.offsets.to_numpy() - split.offsets[0].as_py()
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            code = codes[a:b]
            n = size[code]
            begin = np.cumsum(n) - n
            total = int(n.sum())
            yield flat[np.arange(total) + np.repeat(first[code] - begin, n)].tobytes()


_TOKENIZERS: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def pieces(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE) -> DataFrame:
    """Cut every document (its ids, then END_ID) into pieces of at most
    ``sequence`` ids: doc_id, piece, start, length, ids_crc32."""
    end = np.array([END_ID], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = word_tokenizer(tokenizer)
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), tok.batch(batch.column(1)), strict=True):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * sequence)):
                    part = ids[at:at + 4 * sequence]
                    rows.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)))
            cols = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32"])
        tok.forget()

    python_batches(docs.sparkSession, 4000)
    texts = own_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long"),
                                                       F.col("text").cast("string"))
    return texts.mapInArrow(cut, PIECES)


def place(lengths: np.ndarray, sequence: int = SEQUENCE) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece, for lengths from long to short.

    ``open_bins[g]`` lists the open bins with gap ``g``.  Moving a bin from
    gap g to g - s changes the sum of squares by 2 (N[g-s] - N[g] + 1), and by
    1 - 2 N[g] if it closes; the smallest change wins, the tightest on ties.
    """
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(sequence)]
    count = np.zeros(sequence, np.int64)
    never, opened = np.int64(1) << 60, 0
    for i, s in enumerate(lengths.tolist()):
        gap = sequence
        if s < sequence:
            here = count[s:]
            change = np.where(here > 0, 2 * (count[:sequence - s] - here + 1), never)
            if here[0] > 0:
                change[0] = 1 - 2 * here[0]
            best = int(change.argmin())
            if change[best] < never:
                gap = s + best
        if gap == sequence:
            b, opened = opened, opened + 1
        else:
            b = open_bins[gap].pop()
            count[gap] -= 1
        bins[i], offsets[i] = b, sequence - gap
        if gap > s:
            open_bins[gap - s].append(b)
            count[gap - s] += 1
    return bins, offsets


def pack(cut: DataFrame, sequence: int = SEQUENCE, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Add sequence_id and offset to the rows of :func:`pieces`."""
    rows = landed(cut.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    shards = max(1, -(-rows.count() // shard_pieces))

    def shard(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "_row"], ascending=[False, True], kind="stable")
        bins, offsets = place(pdf["length"].to_numpy(), sequence)
        pdf = pdf.drop(columns=["_row", "_shard"])
        return pdf.assign(sequence_id=bins * shards + int(key[0]), offset=offsets)

    return (rows.withColumn("_shard", F.pmod(F.xxhash64("_row"), F.lit(shards)))
            .groupBy("_shard").applyInPandas(shard, PIECES + ", sequence_id long, offset long"))


def write_sequences(docs: DataFrame, packed: DataFrame, tokenizer: str, path: str,
                    sequence: int = SEQUENCE) -> DataFrame:
    """Write the packed ids themselves, one row a sequence, as Parquet.

    Documents are tokenised again beside their placements (joined by doc_id,
    piece digests tell texts apart), so only the ids that are written move.
    Rows: sequence_id, ids array<int>, doc_ids, lengths (in order of offset).
    """
    by_doc = packed.groupBy("doc_id").agg(F.collect_list(
        F.struct("piece", "ids_crc32", "sequence_id", "offset")).alias("placed"))
    joined = (own_columns(docs, "doc_id", "text").dropDuplicates()
              .join(by_doc.withColumnRenamed("doc_id", "_id"), F.col("doc_id").eqNullSafe(F.col("_id")))
              .select(F.col("doc_id").cast("long"), F.col("text").cast("string"), "placed"))
    end = np.array([END_ID], "<u4").tobytes()

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = word_tokenizer(tokenizer)
        for batch in batches:
            out = []
            for doc_id, ids, placed in zip(batch.column(0).to_pylist(), tok.batch(batch.column(1)),
                                           batch.column(2).to_pylist(), strict=True):
                ids += end
                for p in placed:
                    part = ids[4 * sequence * p["piece"]:4 * sequence * (p["piece"] + 1)]
                    if part and zlib.crc32(part) == p["ids_crc32"]:
                        out.append((p["sequence_id"], p["offset"], doc_id, np.frombuffer(part, "<i4").tolist()))
            cols = list(zip(*out, strict=True)) or [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                             ["sequence_id", "offset", "doc_id", "ids"])

    parts = (joined.mapInArrow(emit, "sequence_id long, offset long, doc_id long, ids array<int>")
             .dropDuplicates(["sequence_id", "offset"]))
    ordered = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    sequences = parts.groupBy("sequence_id").agg(ordered.alias("parts")).select(
        "sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("doc_ids"),
        F.transform("parts.ids", lambda x: F.size(x)).alias("lengths"))
    sequences.write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def pack_documents(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE,
                   shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Placement of every piece: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset (gapless from 0 in each sequence)."""
    return pack(pieces(docs, tokenizer, sequence), sequence, shard_pieces)
