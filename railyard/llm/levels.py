"""Online sum-of-squares packing into windows, with an array of fill levels.

One pass: each task tokenises its documents and places them as they come, so
neither texts nor ids are shuffled.  Whole windows are cut off the front of a
longer document; what is left (shorter than a window) goes to the fill level,
an empty window among them, for which the sum over levels of (number of
windows filled so far)^2 becomes smallest; the fullest on ties.  ``count`` is
that level array.  A full window is passed on at once.

A sequence shorter than the window is padded unless its length is a power of
two.  So at the end of a task the windows still open are joined, the emptiest
into the fullest, cutting a piece where one fills up, and the one left over is
cut by the binary digits of its length: nothing is padded, and only a piece
for each window then open and each binary digit is cut.  The same joining (the
last window stays open) bounds a task's memory: it happens whenever
``OPEN_WINDOWS`` windows are open.

Null texts count as empty (the closing id alone); rows without a doc_id,
repeated rows and ties are packed like any other, each on its own; an empty
table gives no rows; further input columns are ignored.  A task that is run
again reads the same rows in the same order and gives the same windows;
sequence_id carries the partition in its upper 32 bits.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard.llm.common import own_columns, small_batches
from railyard.llm.packing import word_tokenizer

WINDOW = 2048
CLOSING_ID = 1
OPEN_WINDOWS = 4096           # x WINDOW ids of 4 bytes: what a task holds at most
BATCH_BYTES = 16 << 20

Piece = tuple[int | None, int, bytes, int]        # doc_id, start, ids, ids of the document


class FillLevels:
    """Open windows of one task, by how many ids each holds."""

    def __init__(self, window: int = WINDOW, most: int = OPEN_WINDOWS):
        self.window, self.most, self.n_open = window, most, 0
        self.count = np.zeros(window + 1, np.int64)
        self.held: list[list[list[Piece]]] = [[] for _ in range(window)]
        self.full: list[list[Piece]] = []

    def level_for(self, s: int) -> int:
        """The level whose window takes ``s`` more ids.

        A window that goes from level h to h + s changes the sum of squares
        by 2 (N[h+s] - N[h] + 1); one that becomes full by 1 - 2 N[h]; a new
        one by 2 N[s] + 1.
        """
        n = self.count
        change = 2 * (n[s:] - n[:self.window + 1 - s] + 1)
        change[-1] -= 1                                   # level `window` is not counted
        change[n[:self.window + 1 - s] == 0] = np.iinfo(np.int64).max
        change[0] = 2 * n[s] + 1
        return len(change) - 1 - int(change[::-1].argmin())

    def _open(self, level: int, pieces: list[Piece]) -> None:
        self.held[level].append(pieces)
        self.count[level] += 1
        self.n_open += 1

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """Place a document given by its ids (little-endian, 4 bytes each)."""
        total, step = len(ids) // 4, 4 * self.window
        whole = len(ids) - len(ids) % step
        self.full += [[(doc_id, a // 4, ids[a:a + step], total)] for a in range(0, whole, step)]
        s = (len(ids) - whole) // 4
        if not s:
            return
        level = self.level_for(s)
        pieces: list[Piece] = []
        if level:
            pieces = self.held[level].pop()
            self.count[level] -= 1
            self.n_open -= 1
        pieces.append((doc_id, whole // 4, ids[whole:], total))
        if level + s == self.window:
            self.full.append(pieces)
        else:
            self._open(level + s, pieces)
            if self.n_open >= self.most:
                self.join()

    def join(self) -> None:
        """Fill the fullest open windows from the emptiest; at most one stays open."""
        rest = [(level, p) for level in range(self.window - 1, 0, -1) for p in self.held[level]]
        self.count[:] = 0
        self.held, self.n_open = [[] for _ in range(self.window)], 0
        while rest:
            level, pieces = rest.pop(0)
            while level < self.window and rest:
                last, donor = rest[-1]
                doc_id, start, ids, total = donor.pop()
                take = min(self.window - level, len(ids) // 4)
                pieces.append((doc_id, start, ids[:4 * take], total))
                if len(ids) > 4 * take:
                    donor.append((doc_id, start + take, ids[4 * take:], total))
                level += take
                rest[-1] = (last - take, donor)
                if not donor:
                    rest.pop()
            if level == self.window:
                self.full.append(pieces)
            else:
                self._open(level, pieces)

    def close(self) -> None:
        """Join, then cut the window left over into lengths that are powers of two."""
        self.join()
        for level in np.flatnonzero(self.count).tolist():
            pieces = self.held[level].pop()[::-1]
            for size in (1 << b for b in range(level.bit_length() - 1, -1, -1) if level >> b & 1):
                part = []
                while size:
                    doc_id, start, ids, total = pieces.pop()
                    take = min(size, len(ids) // 4)
                    part.append((doc_id, start, ids[:4 * take], total))
                    if len(ids) > 4 * take:
                        pieces.append((doc_id, start + take, ids[4 * take:], total))
                    size -= take
                self.full.append(part)
        self.count[:], self.n_open = 0, 0

    def take(self) -> list[list[Piece]]:
        done, self.full = self.full, []
        return done


def _packed(docs: DataFrame, tokenizer: str, window: int, most: int, names: dict[str, pa.DataType],
            rows, schema: str) -> DataFrame:
    """One pass over ``docs``; ``rows(sequence_id, pieces)`` gives the output rows of a window."""
    closing = np.array([CLOSING_ID], "<u4").tobytes()

    def batch_of(windows, first: int) -> pa.RecordBatch:
        out = [r for k, w in enumerate(windows) for r in rows(first + k, w)]
        cols = list(zip(*out, strict=True)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, names.values(), strict=True)],
                                          list(names))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, levels, at = word_tokenizer(tokenizer), FillLevels(window, most), 0
        for batch in small_batches(batches, BATCH_BYTES):
            at = at or batch.column(2)[0].as_py() << 32
            for doc_id, ids in zip(batch.column(0).to_pylist(), tok.batch(batch.column(1)), strict=True):
                levels.add(doc_id, ids + closing)
            done = levels.take()
            yield batch_of(done, at)
            at += len(done)
        tok.forget()
        levels.close()
        yield batch_of(levels.take(), at)

    texts = own_columns(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long"), F.col("text").cast("string"), F.spark_partition_id().cast("long").alias("part"))
    return texts.mapInArrow(pack, schema)


def pack_online(docs: DataFrame, tokenizer: str, window: int = WINDOW, most: int = OPEN_WINDOWS) -> DataFrame:
    """Place of every piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset (gapless from 0 in each sequence)."""
    def rows(sequence_id, pieces):
        offset = 0
        for doc_id, start, ids, total in pieces:
            yield doc_id, start, len(ids) // 4, zlib.crc32(ids), total, sequence_id, offset
            offset += len(ids) // 4

    names = dict.fromkeys(("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"), pa.int64())
    return _packed(docs, tokenizer, window, most, names, rows, ", ".join(f"{n} long" for n in names))


def online_sequences(docs: DataFrame, tokenizer: str, window: int = WINDOW, most: int = OPEN_WINDOWS) -> DataFrame:
    """The sequences themselves: sequence_id, ids array<int>, and for each
    piece doc_ids, starts and lengths, in order of offset."""
    def rows(sequence_id, pieces):
        yield (sequence_id, np.frombuffer(b"".join(p[2] for p in pieces), "<i4"), [p[0] for p in pieces],
               [p[1] for p in pieces], [len(p[2]) // 4 for p in pieces])

    longs = pa.list_(pa.int64())
    names = {"sequence_id": pa.int64(), "ids": pa.list_(pa.int32()), "doc_ids": longs, "starts": longs, "lengths": longs}
    return _packed(docs, tokenizer, window, most, names, rows, "sequence_id long, ids array<int>, "
                   "doc_ids array<long>, starts array<long>, lengths array<long>")
