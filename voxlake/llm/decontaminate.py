"""Operator 9: benchmark decontamination by word-pair seeds and exact Smith-Waterman alignment.

A local alignment of an item of n words (match 2, mismatch and gap -1) is a chain of matches; the step between two matches is worth 2 less its
errors.  So a score of S needs steps worth S - 2: 2 for neighbours in both texts, 1 for a step with one error (1 or 2 words on in either).  Each
item word starts one step at most, so with less than half of S - 2 item words left out (those whose pairs are commonest in a sample
of the texts and in the items) at least one step of the others is in every passage that reaches the threshold: these are the seeds.
A task hashes the words of its whole texts, probes the sorted seeds, joins the hits of a text and an item whose windows overlap, drops windows in which
all steps together are worth less than S - 2, and aligns the others, many at once.  No passage that reaches the threshold is left out
(hashes that collide only add work); windows hold the whole of any such alignment.  The score is the best local alignment over the item's own, 0 to
1; texts with a score of at least `threshold` for some item are contaminated.

Test items are driven in blocks of at most `block` items, each broadcast with its seeds (a size bound by construction); every block
scans all texts.  Words are runs of letters, digits and non-ASCII bytes; ASCII and Latin-1 letters are compared in lower case.

Ties: of equally good passages of an item in a document the one that starts first, then the longest.  Blocks change the work, not the result.

Null and empty texts and items match nothing; an item with fewer than three words is matched as a whole.  Rows with a null item_id or
doc_id are left out.  Repeated item_ids are items of their own under one id (the best counts); repeated doc_ids are one document.
Extra columns are ignored; empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlake.llm.common import blocks, spread, text_bytes
from voxlake.llm.repeats import mix
from voxlake.llm.runs import hashes, runs
from voxlake.plans.workers import lean

N = 3  # shorter items are matched as a whole
THRESHOLD = 0.5
BLOCK_ITEMS = 20_000
BYTES = 1 << 20
MATCH, OTHER = 2, -1
SAMPLE_TEXTS, SAMPLE_LENGTH = 500, 2000  # only the choice of seeds (speed) depends on the sample
SLOTS = 12  # bits of a pair's place in an item's table of steps

_IS_WORD = np.zeros(256, np.uint8)
_IS_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def words(data: np.ndarray, offsets: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words of some bytes; upper and lower case of ASCII and Latin-1 letters are one."""
    capital = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
    if len(capital):
        data = data.copy()
        data[capital] += 0x20
    starts, ends = runs(data, np.array([0, len(data)]) if offsets is None else offsets, _IS_WORD)
    return starts, ends, hashes(data, starts, ends)


def pairs(h: np.ndarray, step: int) -> np.ndarray:
    return mix(h[:-step], h[step:]) if len(h) > step else np.empty(0, np.uint64)


class Seeds:
    """Sorted seeds with the items and places where they stand."""

    def __init__(self, rows: list[tuple[np.ndarray, int, np.ndarray]]):
        seed = np.concatenate([r[0] for r in rows]) if rows else np.empty(0, np.uint64)
        item = np.repeat(np.array([r[1] for r in rows], np.int64), [len(r[0]) for r in rows])
        place = np.concatenate([r[2] for r in rows]) if rows else np.empty(0, np.int64)
        order = np.argsort(seed, kind="stable")
        self.seed, self.item, self.place = seed[order], item[order], place[order]
        self.bits = np.zeros(1 << 22, bool)
        self.bits[self.seed >> np.uint64(42)] = True

    def find(self, g: np.ndarray, ok: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index in g, item, place) of every seed among g."""
        if not len(self.seed):
            return (np.empty(0, np.int64),) * 3
        at = np.flatnonzero(self.bits[g >> np.uint64(42)] & ok)
        low, high = (np.searchsorted(self.seed, g[at], side) for side in ("left", "right"))
        count = high - low
        k = np.repeat(low, count) + spread(count)
        return np.repeat(at, count), self.item[k], self.place[k]


class Items:
    """A block of test items: word hashes, seeds, and what an alignment that reaches the threshold needs."""

    def __init__(self, ids: list[int], texts: list[str], threshold: float = THRESHOLD, sample: str = ""):
        self.ids = np.array(ids, np.int64)
        self.words = [words(np.frombuffer(t.encode(), np.uint8))[2] for t in texts]
        self.short = np.array([len(w) for w in self.words], np.int64)
        score = np.ceil(threshold * MATCH * self.short - 1e-9).astype(np.int64)  # least score that counts
        self.need = score - 2  # least worth of the steps
        self.reach = np.maximum(0, MATCH * self.short - score)  # most errors, so most words that a passage has beyond the item's
        seen = np.concatenate([words(np.frombuffer(sample.encode(), np.uint8))[2], *self.words])
        vocab, counts = np.unique(seen, return_counts=True)
        share = counts / max(1, len(seen))
        twice, often = np.unique(np.concatenate([np.empty(0, np.uint64), *[pairs(w, 1) for w in self.words]]), return_counts=True)
        single, whole, double = [], [], []
        for i, w in enumerate(self.words):
            n = len(w)
            if n == 0:
                continue
            if n == 1 or n >= N and self.need[i] < 1:
                single.append((w, i, np.arange(n)))
            elif n < N:
                whole.append((pairs(w, 1), i, np.arange(1)))
            else:
                f = share[np.searchsorted(vocab, w)]
                after = f[1:] + np.append(f[2:], 0.0)
                cost = f[:-1] * after * often[np.searchsorted(twice, pairs(w, 1))]
                kept = np.sort(np.argsort(cost, kind="stable")[: n - 1 - (int(self.need[i]) - 1) // 2])
                for step in (1, 2):
                    at = kept[kept + step < n]
                    double.append((mix(w[at], w[at + step]), i, at))
        self.single, self.whole, self.double = Seeds(single), Seeds(whole), Seeds(double)

    def hits(self, h: np.ndarray, near: np.ndarray, far: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, item, place) of every seed among the words h of several texts (doc: text of each word) and their pairs."""
        one, two = doc[: len(near)] == doc[1:], doc[: len(far)] == doc[2:]
        out = [self.single.find(h, np.ones(len(h), bool)), self.whole.find(near, one), self.double.find(near, one), self.double.find(far, two)]
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def worth(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """What a pair of words one apart, and two apart, is worth as a step of an item, by the first bits of its hash; never too little."""
        w, near, far = self.words[i], np.zeros(1 << SLOTS, np.int8), np.zeros(1 << SLOTS, np.int8)
        a, b = slots(pairs(w, 1)), slots(pairs(w, 2))
        near[b] = far[a] = far[b] = 1
        near[a] = 2
        return near, far


def slots(g: np.ndarray) -> np.ndarray:
    return (g >> np.uint64(64 - SLOTS)).astype(np.int16)


def align(item: np.ndarray, passages: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best local alignments of one item with padded passages: scores, and first and last+1 word of each alignment."""
    m, width = passages.shape
    valid = np.arange(width) < sizes[:, None]
    up, begin = np.zeros((m, width + 1), np.int32), np.tile(np.arange(width + 1, dtype=np.int32), (m, 1))
    best, first, last = np.zeros(m, np.int32), np.zeros(m, np.int32), np.zeros(m, np.int32)
    steps = np.arange(width + 1, dtype=np.int32)
    for w in item:
        score = np.where((passages == w) & valid, MATCH, OTHER).astype(np.int32)
        diagonal, above = up[:, :-1] + score, up[:, 1:] + OTHER
        now = np.zeros((m, width + 1), np.int32)
        came = np.tile(steps, (m, 1))
        now[:, 1:] = np.maximum(diagonal, above)
        came[:, 1:] = np.where(diagonal >= above, begin[:, :-1], begin[:, 1:])
        came[now <= 0] = np.broadcast_to(steps, came.shape)[now <= 0]
        np.maximum(now, 0, out=now)
        far = now - OTHER * steps  # a gap in the item costs one a word: running maximum along the passage
        top = np.maximum.accumulate(far, axis=1)
        source = np.maximum.accumulate(np.where(far == top, steps, 0), axis=1)
        value = top + OTHER * steps
        came = np.where(value > 0, np.take_along_axis(came, source, 1), steps)
        up, begin = np.where(np.concatenate([np.ones((m, 1), bool), valid], axis=1), np.maximum(value, 0), 0).astype(np.int32), came
        at = up.argmax(axis=1)
        peak = up[np.arange(m), at]
        better = peak > best
        best[better], first[better], last[better] = peak[better], begin[np.arange(m), at][better], at[better]
    return best, first, last


def _enough(items: Items, it: int, near: np.ndarray, far: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Of windows: those with a stretch as long as an alignment can be whose steps are worth enough."""
    one, two = items.worth(it)
    width, longest = int((stop - begin).max()), int(items.short[it] + items.reach[it])
    at = begin[:, None] + np.arange(width)
    inside = at < stop[:, None]
    np.minimum(at, len(near) - 1, out=at)
    total = np.zeros((len(begin), width + 1), np.int32)
    np.cumsum(np.maximum(one[near[at]], two[far[at]]) * inside, axis=1, out=total[:, 1:])
    most = total[:, -1] if width <= longest else (total[:, longest:] - total[:, :-longest]).max(axis=1)
    return np.flatnonzero(most >= items.need[it])


def scan(items: Items, threshold: float):
    """Task: (doc_id, item_id, score, start, end) of every passage that reaches the threshold; places are byte offsets."""

    def settle(docs: np.ndarray, off: np.ndarray, data: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts, ends, h = words(data, off)
        doc = np.searchsorted(off, starts, "right") - 1
        inner = np.searchsorted(starts, off)  # first word of each text; words do not span texts: see below
        near, far = pairs(h, 1), pairs(h, 2)
        word, item, place = items.hits(h, near, far, doc)
        if not len(word):
            return
        shift = word - place
        order = np.lexsort((shift, item, doc[word]))
        word, item, shift = (x[order] for x in (word, item, shift))
        text = doc[word]
        new = np.append(True, (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (shift[1:] - shift[:-1] > items.reach[item[1:]]))
        head = np.flatnonzero(new)
        n, reach = items.short[item[head]], items.reach[item[head]]
        low, high = shift[head], shift[np.append(head[1:], len(shift)) - 1]
        begin = np.maximum(low - reach, inner[text[head]])
        stop = np.minimum(high + n + reach, inner[text[head] + 1])
        # no alignment is longer than n + reach: windows of twice that, half overlapping, hold each one whole
        longest = n + reach
        parts = np.maximum(1, -(-(stop - begin - 2 * longest) // longest) + 1)
        k = spread(parts)
        owner = np.repeat(np.arange(len(head)), parts)
        begin = begin[owner] + k * longest[owner]
        stop = np.minimum(begin + 2 * longest[owner], stop[owner])
        ok = stop > begin
        owner, begin, stop = owner[ok], begin[ok], stop[ok]
        who, where = item[head][owner], text[head][owner]
        near, far = (np.append(slots(g), np.zeros(len(h) - len(g), np.int16)) for g in (near, far))
        order = np.argsort(who, kind="stable")
        bounds = np.append(np.flatnonzero(np.append(True, who[order][1:] != who[order][:-1])), len(order))
        out = []
        for x, y in zip(bounds[:-1], bounds[1:], strict=True):
            it = who[order[x]]
            length = len(items.words[it])
            for i in range(x, y, 2000):
                r = order[i : min(y, i + 2000)]
                if length >= N and items.need[it] >= 1:
                    r = r[_enough(items, it, near, far, begin[r], stop[r])]
                    if not len(r):
                        continue
                sizes = stop[r] - begin[r]
                grid = np.minimum(begin[r][:, None] + np.arange(sizes.max()), len(h) - 1)
                best, first, last = align(items.words[it], h[grid], sizes)
                good = np.flatnonzero(best >= threshold * MATCH * length - 1e-9)
                for g in good.tolist():
                    a, b = begin[r[g]] + first[g], begin[r[g]] + last[g] - 1
                    base = off[where[r[g]]]
                    out.append((int(docs[where[r[g]]]), int(items.ids[it]), best[g] / (MATCH * length), int(starts[a] - base), int(ends[b] - base)))
        if out:
            types = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(types)], ["doc_id", "item_id", "score", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch.column(0).to_numpy()
            data, off = text_bytes(batch.column(1))  # every text ends with a line feed, so no word spans two
            for i, j in blocks(off, BYTES):
                yield from settle(docs[i:j], off[i : j + 1] - off[i], data[off[i] : off[j]])

    return run


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK_ITEMS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, score, start, end): the best passage of each contaminated document for each test item."""
    spark = docs.sparkSession
    texts = docs.where(F.col(id_col).isNotNull() & (F.length(text_col) > 0)).select(F.col(id_col).cast("long").alias("doc_id"), F.concat(F.col(text_col), F.lit("\n")).alias("text"))
    known = benchmark.where("item_id is not null and length(text) > 0").select(F.col("item_id").cast("long").alias("item_id"), "text")
    parts = max(1, -(-known.count() // block))
    sample = " ".join(r.text for r in texts.select(F.substring("text", 1, SAMPLE_LENGTH).alias("text")).limit(SAMPLE_TEXTS).collect())
    found = None
    for k in range(parts):
        mine = known.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == k).collect() if parts > 1 else known.collect()
        items = spark.sparkContext.broadcast(Items([r.item_id for r in mine], [r.text for r in mine], threshold, sample))  # about block items
        part = texts.mapInArrow(lean(lambda batches, items=items: scan(items.value, threshold)(batches)), "doc_id long, item_id long, score double, start long, end long")
        found = part if found is None else found.unionAll(part)
    best = F.max(F.struct(F.col("score"), (-F.col("start")).alias("s"), F.col("end").alias("e"))).alias("b")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", F.col("b.score").alias("score"), (-F.col("b.s")).alias("start"), F.col("b.e").alias("end"))
