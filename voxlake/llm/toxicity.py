"""Operator 8: toxicity by nearest labelled examples.

Every text is a TF-IDF vector over the terms (words, and word beginnings of four and five letters) whose document frequencies differ between
the two classes of examples, in either direction, at a log-likelihood ratio of at least `least`; document frequencies are those of all examples.
One constant axis more makes a text without such terms nearest to the examples without them.  The examples lie in inverted lists cut into
blocks of BLOCK neighbours; each list keeps its largest weight in every block, and only blocks whose bound reaches the k-th best cosine
so far are scored, so the k nearest are exact.  Votes are weighted by 1 / (distance + 0.05); a monotone map, fitted to
leave-one-out votes of the examples, makes scores probabilities.

Bound (documented parameter): at most about `per_class` labelled rows of each class, taken by a hash of doc_id, are the
examples.  Every document is scored, over its whole text.

Null and empty texts get the score of a text without terms.  Rows without doc_id are scored and count as not held out.
Rows that repeat a doc_id are each scored; conflicting labels of one doc_id count as toxic.  Of examples at one distance the one whose terms
come first counts first (the K nearest hold whole vectors: examples that are equal in all terms are one).  Without any labelled row of
both classes every score is the share of toxic labels (0 without labels).  Extra columns are ignored.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from copy import copy
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlake.llm.common import spread
from voxlake.plans.workers import lean

K = 16
BLOCK = 16
NEAR = 0.05
THRESHOLD = 0.3
PER_CLASS = 2_000
LEAST = 6.63  # significance of one per cent
KNOWN = 300_000  # tokens that a task remembers
BINS = 20
_WORD = re.compile(r"[^\W\d_]+")


def terms(token: str) -> list[str]:
    """Terms of one white-space token in lower case."""
    out = []
    for w in _WORD.findall(token):
        out.append(w)
        out += [f"^{w[:n]}" for n in (4, 5) if len(w) >= n]
    return out


class Terms:
    """Counts a text's terms that are in a vocabulary; remembers tokens."""

    def __init__(self, vocabulary: dict[str, int]):
        self.vocabulary, self.seen, self.hot = vocabulary, set(), {}

    def of(self, text: str) -> tuple[tuple[int, int], ...]:
        tokens = Counter(text.lower().split())
        if new := tokens.keys() - self.seen:
            if len(self.seen) > KNOWN:
                self.seen, self.hot, new = set(), {}, set(tokens)
            for token in new:
                if ids := [self.vocabulary[t] for t in terms(token) if t in self.vocabulary]:
                    self.hot[token] = ids
            self.seen |= new
        count: dict[int, int] = {}
        for token in tokens.keys() & self.hot.keys():
            for t in self.hot[token]:
                count[t] = count.get(t, 0) + tokens[token]
        return tuple(sorted(count.items()))


class Index:
    """Distinct example vectors in block-max inverted lists.

    Lists of more than a sixteenth of the examples are kept as rows of a matrix, so that many texts meet them in one product; what these
    give is exact, and with the bounds of the other lists it tells which blocks the other lists need to be read for.
    """

    def __init__(self, idf: np.ndarray, patterns: list[tuple], counts: np.ndarray, first: np.ndarray):
        """patterns: ((term, count), ...) each; counts: examples of class 0 and 1 with it; first: its smallest doc_id."""
        rare = [tuple(sorted((-idf[t], t) for t, _ in p)) for p in patterns]  # examples that share rare terms lie in one block
        order = sorted(range(len(patterns)), key=lambda i: (rare[i], patterns[i], i))
        self.idf, self.counts, self.first = idf, counts[order].astype(float), first[order]
        self.place = {patterns[i]: n for n, i in enumerate(order)}
        vectors = [self.vector(patterns[i]) for i in order]
        term, weight = (np.concatenate([v[k] for v in vectors]) for k in (0, 1))
        row = np.repeat(np.arange(len(order)), [len(v[0]) for v in vectors])
        self.blocks = -(-len(order) // BLOCK)
        often = np.bincount(term, minlength=len(idf) + 1) * 16 > len(order)
        self.slot = np.where(often, np.cumsum(often) - 1, -1)
        self.matrix = np.zeros((often.sum(), self.blocks * BLOCK))
        self.matrix[self.slot[term[often[term]]], row[often[term]]] = weight[often[term]]
        term, weight, row = (x[~often[term]] for x in (term, weight, row))
        by = np.lexsort((row, term))
        term, self.rows, self.weights = term[by], row[by], weight[by]
        self.start = np.searchsorted(term, np.arange(len(idf) + 2))
        head = np.flatnonzero(np.append(True, (term[1:] != term[:-1]) | (self.rows[1:] // BLOCK != self.rows[:-1] // BLOCK))[: len(term)])
        self.tops, self.top_blocks = (np.maximum.reduceat(self.weights, head) if len(head) else np.empty(0)), self.rows[head] // BLOCK
        self.top_start = np.searchsorted(term[head], np.arange(len(idf) + 2))

    def vector(self, pattern: tuple) -> tuple[np.ndarray, np.ndarray]:
        """Terms (the constant axis is the last) and weights of length one."""
        x = np.array(pattern, np.int64).reshape(-1, 2)
        w = np.append((1 + np.log(x[:, 1])) * self.idf[x[:, 0]], 1.0)
        return np.append(x[:, 0], len(self.idf)), w / np.sqrt((w * w).sum())

    def _read(self, start: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of all entries of some lists, and how many each list has."""
        count = start[term + 1] - start[term]
        return np.repeat(start[term], count) + spread(count), count

    def nearest(self, patterns: list[tuple], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each pattern the k + 1 nearest examples, ties by place, and their cosines; blocks whose bound is below the k + 1st best are not read."""
        out, n = [], min(k + 1, len(self.first))
        for i in range(0, len(patterns), 256):
            part = [self.vector(p) for p in patterns[i : i + 256]]
            q = np.zeros((len(part), len(self.matrix)))
            for r, (term, weight) in enumerate(part):
                at = self.slot[term]
                q[r, at[at >= 0]] = weight[at >= 0]
            base = q @ self.matrix
            most = base.reshape(len(part), self.blocks, BLOCK).max(axis=2)
            floor = np.partition(most, self.blocks - n, axis=1)[:, self.blocks - n] if self.blocks >= n else np.full(len(part), -1.0)
            for r, (term, weight) in enumerate(part):
                rest = self.slot[term] < 0
                term, weight = term[rest], weight[rest]
                at, count = self._read(self.top_start, term)
                bound = most[r] + np.bincount(self.top_blocks[at], np.repeat(weight, count) * self.tops[at], self.blocks)
                alive = bound + 1e-9 >= floor[r]
                at, count = self._read(self.start, term)
                w = np.repeat(weight, count)
                good = alive[self.rows[at] // BLOCK]
                at, w = at[good], w[good]
                cos = base[r] + np.bincount(self.rows[at], w * self.weights[at], base.shape[1])
                who = np.flatnonzero(np.repeat(alive, BLOCK)[: len(self.first)])
                best = cos[who]
                if len(who) > n:
                    good = np.flatnonzero(best >= np.partition(best, len(best) - n)[len(best) - n])
                    who, best = who[good], best[good]
                order = np.lexsort((who, -best))[:n]
                out.append((who[order], best[order]))
        return out

    def tally(self, pattern: tuple, share: np.ndarray, who: np.ndarray, cos: np.ndarray, without: int | None = None) -> tuple[float, int, float]:
        counts = self.counts[who].copy()
        if without is not None:
            counts[who == self.place.get(pattern, -1), without] -= 1
        some = np.flatnonzero(counts.sum(axis=1) > 0)[:K]
        if not len(some):
            return float(share[1] / share.sum()), 0, 0.0
        votes = counts[some] * share / (1 - np.minimum(cos[some], 1) + NEAR)[:, None]
        return float(votes[:, 1].sum() / votes.sum()), int(self.first[who[some[0]]]), float(cos[some[0]])


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, toxic, documents): what one task has counted; it sends what it has whenever that grows large."""
    count: Counter[tuple[str, int]] = Counter()

    def send() -> pa.RecordBatch:
        keys = list(count)
        return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()), pa.array(list(count.values()), pa.int64())], ["term", "toxic", "n"])

    for batch in batches:
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            count.update({(t, toxic) for token in set(text.lower().split()) for t in terms(token)})
            if len(count) > KNOWN:
                yield send()
                count.clear()
    if count:
        yield send()


def _monotone(hits: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Shares per bin, pooled until they do not fall."""
    pools: list[list[float]] = []
    for h, n in zip(hits.tolist(), totals.tolist(), strict=True):
        pools.append([h, n, 1])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] > pools[-1][0] * pools[-2][1]:
            h2, n2, m2 = pools.pop()
            pools[-1] = [pools[-1][0] + h2, pools[-1][1] + n2, pools[-1][2] + m2]
    return np.concatenate([np.full(int(m), h / n) for h, n, m in pools])


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, least: float = LEAST) -> tuple | None:
    """(vocabulary, index, class weights, calibration) from labelled documents; None if a class has no example."""
    spark = docs.sparkSession
    marks = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")).where("toxic in (0, 1)")
    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    totals = {r.toxic: r.n for r in rows.select("doc_id").join(marks, "doc_id").groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2:
        return (totals.get(1, 0) / max(1, sum(totals.values())),)
    rate = F.when(F.col("toxic") == 1, F.lit(min(1.0, per_class / totals[1]))).otherwise(F.lit(min(1.0, per_class / totals[0])))
    chosen = marks.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < rate * (1 << 20))
    # bounded: about two times per_class rows of an id and a label
    sample = rows.join(F.broadcast(chosen), "doc_id").groupBy("text", "toxic").agg(F.min("doc_id").alias("doc_id")).select("text", "toxic", "doc_id").persist()
    sizes = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        sample.unpersist()
        return (totals[1] / sum(totals.values()),)
    one, zero = sizes[1], sizes[0]
    df = sample.mapInArrow(lean(_partial), "term string, toxic int, n long").groupBy("term").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("a"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("b"))
    xlogx = lambda c: F.when(c > 0, c * F.log(c.cast("double"))).otherwise(0.0)
    a, b, n = F.col("a"), F.col("b"), one + zero
    ratio = 2 * (xlogx(a) + xlogx(b) + xlogx(one - a) + xlogx(zero - b) - xlogx(a + b) - xlogx(n - a - b) - xlogx(F.lit(one)) - xlogx(F.lit(zero)) + xlogx(F.lit(n)))
    picked = df.where(ratio >= least).orderBy("term").collect()  # bounded by the words of the sample
    vocabulary = {r.term: i for i, r in enumerate(picked)}
    idf = np.array([np.log((n + 1) / (r.a + r.b + 1)) + 1 for r in picked])

    def patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Terms(vocabulary)
        for batch in batches:
            found = [known.of(t) for t in batch.column(0).to_pylist()]
            flat = pa.array([[v for pair in p for v in pair] for p in found], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([flat, batch.column(1), batch.column(2)], ["p", "toxic", "doc_id"])

    told = sample.mapInArrow(lean(patterns), "p array<int>, toxic int, doc_id long").groupBy("p").agg(F.sum(F.col("toxic").cast("long")).alias("one"), F.count("*").alias("n"), F.min("doc_id").alias("first")).collect()
    sample.unpersist()
    told.sort(key=lambda r: r["first"])
    shapes = [tuple(zip(r.p[::2], r.p[1::2], strict=True)) for r in told]
    counts = np.array([[r.n - r.one, r.one] for r in told])
    index = Index(idf, shapes, counts, np.array([r["first"] for r in told]))
    share = np.array([totals[0] / zero, totals[1] / one])
    cases = spark.sparkContext.broadcast((index, share))

    def leave_one_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, share = cases.value
        for batch in batches:
            shapes = [tuple(zip(p[::2], p[1::2], strict=True)) for p in batch.column(0).to_pylist()]
            for pattern, near, zero, one in zip(shapes, index.nearest(shapes, K), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                votes = [(int(min(BINS - 1, index.tally(pattern, share, *near, y)[0] * BINS)), y, float(m)) for y, m in ((0, zero), (1, one)) if m]
                yield pa.RecordBatch.from_arrays([pa.array([v[i] for v in votes], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.float64()))], ["bin", "toxic", "n"])

    shown = spark.createDataFrame([(r.p, r.n - r.one, r.one) for r in told], "p array<int>, zero long, one long").repartition(16)
    hits, seen = np.full(BINS, 0.0), np.full(BINS, 0.0)
    for r in shown.mapInArrow(lean(leave_one_out), "bin int, toxic int, n double").groupBy("bin", "toxic").agg(F.sum("n").alias("n")).collect():
        seen[r.bin] += r.n * share[r.toxic]
        hits[r.bin] += r.n * share[r.toxic] * r.toxic
    prior = (np.arange(BINS) + 0.5) / BINS  # an empty bin stands for itself
    return vocabulary, index, share, _monotone(hits + prior, seen + 1)


def score(docs: DataFrame, model: tuple) -> DataFrame:
    """(doc_id, score, nearest_doc_id, nearest_cosine) of every row of (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    if len(model) == 1:
        return rows.select("doc_id", F.lit(float(model[0])).alias("score"), F.lit(None).cast("long").alias("nearest_doc_id"), F.lit(0.0).alias("nearest_cosine"))
    vocabulary, index, share, shares = model
    index = copy(index)
    index.place = {}  # only leaving examples out asks for it
    cases = docs.sparkSession.sparkContext.broadcast((vocabulary, index, share, shares))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, index, share, shares = cases.value
        known, told = Terms(vocabulary), {}
        middle = (np.arange(BINS) + 0.5) / BINS
        for batch in batches:
            out = []
            for i in range(0, batch.num_rows, 500):
                patterns = [known.of(text) for text in batch.column(1).slice(i, 500).to_pylist()]
                if len(told) > 50_000:
                    told.clear()
                packed = [array("q", chain.from_iterable(p)).tobytes() for p in patterns]  # pairs of objects take ten times as much
                new = {k: p for k, p in zip(packed, patterns, strict=True) if k not in told}
                for (key, pattern), near in zip(new.items(), index.nearest(list(new.values()), K), strict=True):
                    vote, doc, cos = index.tally(pattern, share, *near)
                    told[key] = (float(np.interp(vote, middle, shares)), doc, cos)
                out += map(told.__getitem__, packed)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([o[i] for o in out], t) for i, t in enumerate((pa.float64(), pa.int64(), pa.float64())))], ["doc_id", "score", "nearest_doc_id", "nearest_cosine"])

    return rows.mapInArrow(lean(run), "doc_id long, score double, nearest_doc_id long, nearest_cosine double")


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, per_class: int = PER_CLASS, least: float = LEAST) -> DataFrame:
    """(doc_id, held_out, score, predicted, nearest_doc_id, nearest_cosine) of every row; learns from rows not held out."""
    model = fit(docs.where(~held_out()), labels.where(~held_out()), per_class, least)
    predicted = (F.col("score") >= threshold).cast("int").alias("predicted")
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", predicted, "nearest_doc_id", "nearest_cosine")
