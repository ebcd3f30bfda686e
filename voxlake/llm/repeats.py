"""Operator 3: exact removal of repeated passages (every byte of a repeated `width`-byte string).

Method. The task names a run-length compressed Burrows-Wheeler index.  Building one over a sharded corpus needs
every document streamed against every shard, so its work grows with the square of the shards (figures in the README).
This module reaches the same exact result with work linear in the corpus:

1. every `width`-byte window gets a strong 64-bit hash and the minimum of its `k`-byte hashes (its *anchor*); equal
   windows have equal anchors, so all copies of a window meet under one anchor;
2. neighbouring windows with the same anchor form a *segment* (some 35 windows), which one (anchor, digest) row stands
   for; only segment rows are shuffled.  An anchor seen once proves its windows unique; identical segments are removed
   whole except the earliest;
3. only segments whose anchor has several different contexts are compared window by window, by (hash, anchor): 128 bits.

Hot anchors: each task collapses what it has seen itself, so a passage that a third of all documents share adds at most
one row per task to the task that owns its anchor.

Nulls and empty texts have no windows and come back with zero counts.  Rows with a null doc_id come back uncut, with zero counts.
Repeated doc_ids: rows with the same id are documents of their own, in text order; what the later repeat is removed
like any other copy.  Extra columns are ignored unless `carry` names them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlake.llm.common import blocks, spread, text_bytes
from voxlake.plans.scratch import saved
from voxlake.plans.workers import lean

WIDTH = 100
K = 48
PIECE = 64  # most windows in one segment row
BLOCK = 1 << 19  # bytes hashed at once: some 50 MB
FLUSH = 1_000_000  # rows gathered before a task collapses them

_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))
_BYTE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64)
_SHIFT = np.uint64(31)


def mix(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """A strong hash of two hashes; not symmetric."""
    z = x * _M1
    z += y * _M2
    z ^= z >> _SHIFT
    z *= _M3
    z ^= z >> _SHIFT
    return z


def hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all K-byte and all WIDTH-byte strings of data."""
    level = {1: _BYTE[data]}
    for n in (1, 2, 4, 8, 16, 32):
        x = level[n]
        level[2 * n] = mix(x[:-n], x[n:])
        if n in (1, 2, 8):
            del level[n]
    h4, h32, h64 = level[4], level[32], level[64]
    n = len(data) - WIDTH + 1
    return mix(h32[:-16], level[16][32:]), mix(h64[:n], mix(h32[64 : 64 + n], h4[96 : 96 + n]))


def sliding(f, x: np.ndarray, n: int) -> np.ndarray:
    """f (minimum or maximum) of each n neighbours."""
    have = 1
    while 2 * have <= n:
        x = f(x[:-have], x[have:])
        have *= 2
    return f(x[: len(x) - (n - have)], x[n - have :]) if n > have else x


def segments(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of a block of texts: window hashes, anchors of windows, and segments as (first window, windows, repeats inside)."""
    none = np.empty(0, np.int64)
    if len(data) < WIDTH or not (ends - starts >= WIDTH).any():
        return np.empty(0, np.uint64), np.empty(0, np.uint64), none, none, none.astype(bool)
    short, w = hashes(data)
    span = WIDTH - K + 1
    low = sliding(np.minimum, short, span)[: len(w)]
    step = np.zeros(len(w) + 1, np.int8)  # +1 where a document's windows begin, -1 where they end
    long = ends - starts >= WIDTH
    step[starts[long]] += 1
    step[ends[long] - WIDTH + 1] -= 1
    valid = np.cumsum(step[:-1], dtype=np.int8) > 0
    new = valid.copy()
    new[1:] &= (low[1:] != low[:-1]) | ~valid[:-1]
    first = np.flatnonzero(new)
    last = np.flatnonzero(valid & np.append(new[1:] | ~valid[1:], True))
    count = last - first + 1
    masked = np.where(valid, low, np.uint64(0))
    top = sliding(np.maximum, np.concatenate([np.zeros(span - 1, np.uint64), masked, np.zeros(span - 1, np.uint64)]), span)
    at = np.flatnonzero(short[: len(top)] == top)  # k-byte strings that are the minimum of some window
    twin = np.flatnonzero(short[at[1:]] == short[at[:-1]])  # pairs of neighbours with one value
    a, b = at[twin], at[twin + 1]
    i = np.searchsorted(a, first)
    i_ok = np.minimum(i, max(len(a) - 1, 0))
    again = (i < len(a)) & (b[i_ok] <= last + span - 1) if len(a) else np.zeros(len(first), bool)
    if (count > PIECE).any():  # periodic text: pieces, of which first and last window fix every byte
        pieces = -(-count // PIECE)
        k = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        end = np.repeat(last + 1, pieces)
        first, again = np.repeat(first, pieces) + k * PIECE, np.repeat(again, pieces)
        count = np.minimum(end - first, PIECE)
    return w, low, first, count, again


def _first(order_keys: tuple[np.ndarray, ...], doc: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted by keys, then place: the order, where a group starts, and which rows are later than their group's first."""
    order = np.lexsort((pos, doc, *order_keys[::-1]))
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = False
        for k in order_keys:
            new[1:] |= k[order[1:]] != k[order[:-1]]
    head = np.flatnonzero(new)[np.cumsum(new) - 1] if len(order) else order
    d, p = doc[order], pos[order]
    return order, new, (d != d[head]) | (p != p[head])


ROUTED = pa.schema([("key", pa.int64()), ("kind", pa.int8()), ("g", pa.int64()), ("doc", pa.int64()), ("s", pa.int32()), ("n", pa.int32())])
REMOVED, SINGLE, OPEN, MANY = 0, 1, 2, 3


def _rows(kind: int, a: np.ndarray, g: np.ndarray, doc: np.ndarray, s: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """Rows in the order of documents (they compress well so); known segments are dealt by anchor, the others evenly."""
    key = a if kind in (SINGLE, MANY) else mix(doc.astype(np.uint64), s.astype(np.uint64))
    order = np.lexsort((s, doc))
    cols = [c[order] for c in (key.view(np.int64), np.full(len(a), kind, np.int8), g.view(np.int64), doc, s.astype(np.int32), n.astype(np.int32))]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], schema=ROUTED)


def _settle(a: np.ndarray, g: np.ndarray, doc: np.ndarray, s: np.ndarray, n: np.ndarray, twice: np.ndarray) -> Iterator[pa.RecordBatch]:
    """What one task can say about its own segments."""
    order, new, later = _first((a, g), doc, s)
    a, g, doc, s, n, twice = (x[order] for x in (a, g, doc, s, n, twice))
    yield _rows(REMOVED, a[later], g[later], doc[later], s[later], n[later])
    group = np.cumsum(np.append(True, a[1:] != a[:-1])) - 1
    many = (np.bincount(group, weights=new) > 1) | (np.bincount(group, weights=twice) > 0)
    open_ = new & many[group]
    yield _rows(OPEN, a[open_], g[open_], doc[open_], s[open_], n[open_])
    lone = new & ~many[group]
    yield _rows(SINGLE, a[lone], g[lone], doc[lone], s[lone], n[lone])
    head = np.append(True, a[1:] != a[:-1]) & many[group]
    yield _rows(MANY, a[head], g[head], doc[head], s[head], n[head])


def _columns(kept: list[tuple[np.ndarray, ...]]) -> list[np.ndarray]:
    """What a task has gathered, which is then not held twice."""
    out = [np.concatenate(c) for c in zip(*kept, strict=True)]
    kept.clear()
    return out


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept, rows = [], 0
    for batch in batches:
        doc = batch.column(0).to_numpy()
        data, off = text_bytes(batch.column(1))
        for i, j in blocks(off, BLOCK):
            starts = off[i:j] - off[i]
            w, low, first, count, twice = segments(data[off[i] : off[j]], starts, off[i + 1 : j + 1] - off[i])
            if not len(first):
                continue
            row = np.searchsorted(starts, first, "right") - 1
            digest = mix(w[first], w[first + count - 1]) + count.astype(np.uint64)
            kept.append((low[first], digest, doc[i + row], first - starts[row], count, twice))
            rows += len(first)
            if rows >= FLUSH:
                yield from _settle(*_columns(kept))
                kept, rows = [], 0
    if kept:
        yield from _settle(*_columns(kept))


SPANS = pa.schema([("kind", pa.int8()), ("doc", pa.int64()), ("s", pa.int32()), ("n", pa.int32())])


def _runs(doc: np.ndarray, s: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Touching or overlapping runs of windows of a document, joined."""
    order = np.lexsort((s, doc))
    doc, s, n = doc[order], s[order].astype(np.int64), n[order].astype(np.int64)
    head = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (s[1:] > s[:-1] + n[:-1]))) if len(doc) else np.empty(0, np.int64)
    last = np.append(head[1:], len(doc))[: len(head)] - 1
    return doc[head], s[head], s[last] + n[last] - s[head]


def _spans(kind: int, doc: np.ndarray, s: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row a run of windows."""
    if kind == REMOVED:
        doc, s, n = _runs(doc, s, n)
    for i in range(0, len(doc), 50_000):
        part = slice(i, i + 50_000)
        cols = [np.full(len(doc[part]), kind, np.int8), doc[part], s[part].astype(np.int32), n[part].astype(np.int32)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], schema=SPANS)


def _by_document(joined: bool):
    """Task over all runs of its documents: one row a document with lists of starts and lengths (joined where they touch)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = _gather(batches)
        if not x:
            return
        order = np.lexsort((x["s"], x["doc"]))
        doc, s, n = _runs(x["doc"], x["s"], x["n"]) if joined else (x[c][order] for c in ("doc", "s", "n"))
        starts = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
        bounds = np.append(starts, len(doc))
        for i in range(0, len(starts), 2000):
            b = bounds[i : i + 2001]
            off = pa.array((b - b[0]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(off, pa.array(c[b[0] : b[-1]].astype(np.int32))) for c in (s, n)]
            yield pa.RecordBatch.from_arrays([pa.array(doc[b[:-1]]), *lists], ["place", "s", "n"])

    return run


def _gather(batches: Iterator[pa.RecordBatch]) -> dict[str, np.ndarray]:
    parts = [b for b in batches if b.num_rows]
    if not parts:
        return {}
    t = pa.Table.from_batches(parts)
    return {c: t[c].to_numpy() for c in t.column_names}


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All that is known of each anchor meets here: what is removed whole, and what must be compared by windows."""
    x = _gather(batches)
    if not x:
        return
    kind, doc, s, n = x["kind"], x["doc"], x["s"], x["n"]
    known = (kind == SINGLE) | (kind == MANY)
    a, g = x["key"][known], x["g"][known]
    order, new, later = _first((a, g), doc[known], s[known])
    a, single = a[order], (kind[known] == SINGLE)[order]
    group = np.cumsum(np.append(True, a[1:] != a[:-1])) - 1 if len(a) else a
    many = (np.bincount(group, weights=new) > 1) | (np.bincount(group, weights=~single) > 0) if len(a) else np.zeros(0, bool)
    gone, open_ = single & later & ~many[group], single & many[group]
    d, p, m = doc[known][order], s[known][order], n[known][order]
    was, todo = kind == REMOVED, kind == OPEN
    yield from _spans(REMOVED, np.concatenate([doc[was], d[gone]]), np.concatenate([s[was], p[gone]]), np.concatenate([n[was], m[gone]]))
    yield from _spans(OPEN, np.concatenate([doc[todo], d[open_]]), np.concatenate([s[todo], p[open_]]), np.concatenate([n[todo], m[open_]]))


WINDOWS = pa.schema([("w", pa.int64()), ("a", pa.int32()), ("doc", pa.int64()), ("s", pa.int32()), ("n", pa.int32())])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of open segments; of those that a task has met before, only the runs to remove."""
    kept, rows = [], 0

    def settle() -> Iterator[pa.RecordBatch]:
        w, a, doc, s = _columns(kept)
        order, new, later = _first((w, a), doc, s)
        new, later = np.sort(order[new]), order[later]  # as they came: by document
        d, p, n = _runs(doc[later], s[later], np.ones(len(later), np.int64))
        route = mix(d.astype(np.uint64), p.astype(np.uint64)).view(np.int64)
        short = (a[new] >> np.uint64(32)).astype(np.uint32).view(np.int32)
        for cols in ((w[new].view(np.int64), short, doc[new], s[new].astype(np.int32), np.zeros(len(new), np.int32)), (route, np.zeros(len(d), np.int32), d, p.astype(np.int32), n.astype(np.int32))):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], schema=WINDOWS)

    for batch in batches:
        doc = batch.column(0).to_numpy()
        data, off = text_bytes(batch.column(1))
        s_all, n_all = batch.column(2), batch.column(3)
        s_off = np.append(0, np.cumsum(np.diff(s_all.offsets.to_numpy())))
        s_val, n_val = (x.flatten().to_numpy().astype(np.int64) for x in (s_all, n_all))
        for i, j in blocks(off, BLOCK):
            starts = off[i:j] - off[i]
            w, low, *_ = segments(data[off[i] : off[j]], starts, off[i + 1 : j + 1] - off[i])
            cut = slice(s_off[i], s_off[j])
            row = np.repeat(np.arange(j - i), np.diff(s_off[i : j + 1]))
            n = n_val[cut]
            place = np.repeat(s_val[cut], n) + spread(n)
            row = np.repeat(row, n)
            at = starts[row] + place
            kept.append((mix(w[at], low[at]), low[at], doc[i + row], place))
            rows += len(at)
            if rows >= FLUSH:
                yield from settle()
                kept, rows = [], 0
    if kept:
        yield from settle()


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    x = _gather(batches)
    if x:
        known = x["n"] > 0
        x, gone = {k: v[~known] for k, v in x.items()}, {k: v[known] for k, v in x.items()}
        order, _, later = _first((x["w"], x["a"]), x["doc"], x["s"])
        doc, s = x["doc"][order][later], x["s"][order][later]
        yield from _spans(REMOVED, *map(np.concatenate, ((gone["doc"], doc), (gone["s"], s), (gone["n"], np.ones(len(doc), np.int64)))))


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string"


def _cut(batches: Iterator[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, off = text_bytes(batch.column(1))
        for i, j in blocks(off, 4 * BLOCK):
            m, starts = j - i, off[i:j] - off[i]
            size = np.diff(off[i : j + 1])
            s, n = batch.column(2).slice(i, m), batch.column(3).slice(i, m)
            per = np.diff(s.offsets.to_numpy())
            s, n = s.flatten().to_numpy().astype(np.int64), n.flatten().to_numpy().astype(np.int64)
            row = np.repeat(np.arange(m), per)
            step = np.zeros(off[j] - off[i] + 1, np.int32)
            begin, end = starts[row] + s, np.minimum(starts[row] + s + n + WIDTH - 1, starts[row] + size[row])
            ok = begin < end
            np.add.at(step, begin[ok], 1)
            np.add.at(step, end[ok], -1)
            gone = np.cumsum(step[:-1]) > 0
            total = np.append(0, np.cumsum(gone))
            removed = total[starts + size] - total[starts]
            edge = gone.copy()
            edge[1:] &= ~gone[:-1]
            edge[starts[size > 0]] |= gone[starts[size > 0]]
            runs = np.append(0, np.cumsum(edge))
            spans = runs[starts + size] - runs[starts]
            keep = data[off[i] : off[j]][~gone]
            bound = (starts - total[starts]).tolist() + [len(keep)]
            kept = [keep[bound[k] : bound[k + 1]].tobytes() for k in range(m)]
            sha = [hashlib.sha256(x).hexdigest() for x in kept]
            carried = {name: batch.column(c).slice(i, m) for c, name in enumerate(batch.schema.names) if c > 3}
            cols = [batch.column(0).slice(i, m), pa.array(size), pa.array(removed), pa.array(spans), pa.array(sha, pa.string()), pa.array([x.decode("utf-8", "ignore") for x in kept] if with_text else [None] * m, pa.string())]
            yield pa.RecordBatch.from_arrays([*cols, *carried.values()], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", *carried])


def _placed(texts: DataFrame) -> DataFrame:
    """Texts with a place for every row, in the order of doc_id, then text: the doc_id where none is repeated, else a rank written with the texts."""
    again = texts.where("doc_id is not null").groupBy("doc_id").count().where("count > 1")
    if again.isEmpty():
        return texts.withColumn("place", F.col("doc_id"))
    ranked = texts.repartitionByRange("doc_id", "text").sortWithinPartitions("doc_id", "text").withColumn("place", F.monotonically_increasing_id())
    return saved(ranked, "repeats-placed")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept, carry...): each text without bytes of strings that start earlier.

    kept_sha256 is of the bytes that are left; kept is their text, without the halves of characters that a cut went through.
    """
    texts = _placed(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"), *carry))
    known = texts.where("doc_id is not null and length(text) >= 100").select("place", "text")
    routed = known.mapInArrow(lean(_scan), "key long, kind byte, g long, doc long, s int, n int").repartition("key")
    flat, lists = "kind byte, doc long, s int, n int", "place long, s array<int>, n array<int>"
    spans = saved(routed.mapInArrow(lean(_decide), flat), "repeats")
    todo = spans.where(F.col("kind") == OPEN).repartition("doc").mapInArrow(lean(_by_document(False)), lists)
    windows = known.join(todo, "place").select("place", "text", "s", "n").mapInArrow(lean(_windows), "w long, a int, doc long, s int, n int").repartition("w", "a")
    fine = saved(windows.mapInArrow(lean(_compare), flat), "repeats-fine")
    gone = spans.where(F.col("kind") == REMOVED).unionAll(fine).repartition("doc").mapInArrow(lean(_by_document(True)), lists)
    none = F.array().cast("array<int>")
    joined = texts.join(gone, "place", "left").select("doc_id", "text", F.coalesce("s", none).alias("s"), F.coalesce("n", none).alias("n"), *carry)
    types = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    return joined.mapInArrow(lean(lambda batches: _cut(batches, with_text)), RESULT + types)
