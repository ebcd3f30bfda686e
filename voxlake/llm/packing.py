"""Operator 13: documents packed into token windows online by the sum-of-squares rule.

A document's ids (closed by the end id) are cut into full windows from its start; what is left, the tail, is an item of 1 to size - 1 ids.  Each item
goes to the fill level h for which the sum over all levels of N(h)^2 is smallest afterwards, where N(h) counts the open windows that hold h
ids; level 0 stands for a new window.  N is the level array; ties go to the fullest level, and of its windows to the one that reached it last.
A window that becomes full is closed.

Each Spark task packs its own documents in the order in which it reads them, so nothing is shuffled and a lost task packs the same documents
again.  Ids of windows hold the partition's number.  What waits in a task are the pieces of open windows (at most size ids each).  If more
than `most_open` are open, and at the end of the task, they are settled without padding: the fullest window is topped up with ids cut from the emptiest, again
and again.  At the end the one window left is cut into sequences of powers of two, which need no padding: a task adds at most log2(size)
short sequences, and no sequence of an even split is ever padded.

Null and empty texts are documents of the end id alone.  Rows with null or repeated doc_ids are documents of their own.  Extra columns are ignored; an
empty table gives an empty result.  Texts of any length are encoded in slices cut at white space where the tokenizer's settings allow it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from voxlake.llm import tokenstore
from voxlake.llm.common import blocks, text_bytes

END = 2
SIZE = 4096
MOST_OPEN = 8192
SLICE = 4 << 20  # bytes of one text encoded at once
PARTITION_BITS = 38  # below the partition's number in a sequence_id

_FIELDS = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.list_(pa.int32()))]
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids array<int>"

#: A piece: doc_id, start, doc_tokens, ids.
Piece = tuple[int | None, int, int, np.ndarray]


def best_level(counts: np.ndarray, item: int) -> int:
    """The fill level for an item: counts[h] is the number of open windows with h ids, counts[0] is 0.

    Moving a window from h to h + item changes the sum of squares by 2 (N(h + item) - N(h) + 1); a new window by 2 N(item) + 1; filling
    a window up by 1 - 2 N(h).
    """
    size = len(counts)
    change = np.full(size - item + 1, np.iinfo(np.int64).max)
    change[0] = 2 * counts[item] + 1
    old = counts[1 : size - item]
    change[1:-1] = np.where(old > 0, 2 * (counts[item + 1 :] - old + 1), change[1:-1])
    if counts[size - item]:
        change[-1] = 1 - 2 * counts[size - item]
    return len(change) - 1 - int(np.argmin(change[::-1]))


class Packer:
    """Windows of one task; closed ones are handed to emit(pieces)."""

    def __init__(self, size: int, most_open: int, emit):
        self.size, self.most_open, self.emit = size, most_open, emit
        self.counts = np.zeros(size, np.int64)
        self.open: list[list[list[Piece]]] = [[] for _ in range(size)]  # by fill level
        self.n_open = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        whole = len(ids) // self.size * self.size
        for a in range(0, whole, self.size):
            self.emit([(doc_id, a, len(ids), ids[a : a + self.size])])
        if whole < len(ids):
            self._place((doc_id, whole, len(ids), ids[whole:].copy()))
            if self.n_open > self.most_open:
                self._settle(self.most_open // 2)

    def _place(self, piece: Piece) -> None:
        item = len(piece[3])
        h = best_level(self.counts, item)
        window = self.open[h].pop() if h else []
        window.append(piece)
        if h:
            self.counts[h] -= 1
        else:
            self.n_open += 1
        if h + item == self.size:
            self.n_open -= 1
            self.emit(window)
        else:
            self.counts[h + item] += 1
            self.open[h + item].append(window)

    def _settle(self, leave: int) -> None:
        """Tops the fullest open windows up with ids of the emptiest until at most `leave` are open."""
        windows = [w for level in self.open for w in level]
        self.counts[:] = 0
        self.open = [[] for _ in range(self.size)]
        low, high = 0, len(windows) - 1
        while high > low and high - low + 1 > leave:
            room = self.size - sum(len(p[3]) for p in windows[high])
            while room and low < high:
                doc_id, start, total, ids = windows[low].pop()
                if len(ids) > room:
                    keep = len(ids) - room
                    windows[low].append((doc_id, start, total, ids[:keep]))
                    start, ids = start + keep, ids[keep:]
                windows[high].append((doc_id, start, total, ids))
                room -= len(ids)
                low += not windows[low]
            if room:
                break
            self.emit(windows[high])
            high -= 1
        rest = windows[low : high + 1]
        self.n_open = len(rest)
        for w in rest:
            fill = sum(len(p[3]) for p in w)
            self.counts[fill] += 1
            self.open[fill].append(w)

    def close(self) -> None:
        self._settle(1)
        for window in [w for level in self.open for w in level]:
            left = sum(len(p[3]) for p in window)
            while left:
                part, want = [], 1 << (left.bit_length() - 1)
                left -= want
                while want:
                    doc_id, start, total, ids = window.pop(0)
                    if len(ids) > want:
                        window.insert(0, (doc_id, start + want, total, ids[want:]))
                        ids = ids[:want]
                    part.append((doc_id, start, total, ids))
                    want -= len(ids)
                self.emit(part)


def _slices(text: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Of one text, cut before white space; a longer stretch without any stays whole."""
    a, n = 0, len(text)
    while n - a > size:
        gaps = np.flatnonzero(np.isin(text[a + size : a + 2 * size], (9, 10, 13, 32)))
        while not len(gaps) and a + 2 * size < n:
            size *= 2
            gaps = np.flatnonzero(np.isin(text[a + size : a + 2 * size], (9, 10, 13, 32)))
        if not len(gaps):
            break
        yield text[a : a + size + gaps[0]]
        a += size + int(gaps[0])
    yield text[a:]


def document_ids(own: tokenstore.Encoder, text: np.ndarray, off: np.ndarray, size: int = SLICE) -> Iterator[np.ndarray]:
    """Ids of each text, with the end id."""
    for i, j in blocks(off, size):
        if j == i + 1 and off[j] - off[i] > size and own.proved:
            parts = [own.encode(s, np.array([0, len(s)]))[0][:-1] for s in _slices(text[off[i] : off[j]], size)]
            yield np.append(np.concatenate(parts), np.int32(own.end))
        else:
            ids, sizes = own.encode(text[off[i] : off[j]], off[i : j + 1] - off[i])
            yield from np.split(ids, np.cumsum(sizes)[:-1])


def _pack(tokenizer: str, size: int, end: int, most_open: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, sequence, rows = tokenstore.encoder(tokenizer, end), TaskContext.get().partitionId() << PARTITION_BITS, []

        def emit(window: list[Piece]) -> None:
            nonlocal sequence
            at = 0
            for doc_id, start, total, ids in window:
                rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, sequence, at, ids if with_ids else None))
                at += len(ids)
            sequence += 1

        def table() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), _FIELDS, strict=True)], [n for n, _ in _FIELDS])
            rows.clear()
            return out

        packer = Packer(size, most_open, emit)
        for batch in batches:
            text, off = text_bytes(batch.column(1))
            for doc_id, ids in zip(batch.column(0).to_pylist(), document_ids(own, text, off), strict=True):
                packer.add(doc_id, ids)
                if len(rows) >= 10_000:
                    yield table()
        packer.close()
        if rows:
            yield table()

    return run


def pack(docs: DataFrame, tokenizer: str, size: int = SIZE, end: int = END, most_open: int = MOST_OPEN, with_ids: bool = True) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids (null unless with_ids).

    A sequence is the pieces of one sequence_id by offset; its length is `size`, or a power of two.
    """
    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(_pack(tokenizer, size, end, most_open, with_ids), SCHEMA)
