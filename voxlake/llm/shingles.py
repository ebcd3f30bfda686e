"""Links between texts whose sets of w-word shingles have a Jaccard similarity of at least `similarity`, by rare prefixes.

Words are those of operator 7.  A set of n shingles that is similar enough to another shares one of its n - ceil(similarity * n) + 1 rarest
shingles with the rarest ones of the other, for any order of shingles that all texts share.  The order here is by hash, with shingles
that a bounded sample of texts shows to be common last; the sample changes work only, never a link.  Texts with equal sets are one.

Lists of texts under a shingle are worked through in rounds.  In each, a few pivots of a list (of its smaller components first; sixteen
times as many as in the round before, up to 512) are compared with all of the list that is in another component, and leave the list; lists whose rest is one
component are done.  So a list of near copies costs a comparison each, all pairs under a list are never emitted at once, and no link between components is
lost.  Pairs are verified on whole sets (64-bit hashes); pairs of sets of `judged` shingles or more are passed over first when their SimHashes differ in more than
`far` of 64 bits, where similar ones differ in about 10 (five standard deviations below).

Null texts and texts without words have no shingles and no links here; shorter texts than a shingle are one shingle.  Rows that repeat a
doc_id are one node, linked by any of their texts; rows without doc_id have no links.  Links have no ties.  An empty table gives no links;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxlake.llm.common import text_bytes
from voxlake.operators.graph import connected_components
from voxlake.plans.scratch import discard, saved
from voxlake.plans.workers import lean, small_batches

WORDS = 5
SIMILARITY = 0.8
SAMPLE = 4_000  # texts that tell which shingles are common
COMMON = 100_000  # of these at most are put last
JUDGED, FAR = 20, 24
SEED = 42
ROWS = 256  # texts that travel to a Python worker at once; sets of long texts are large


def shingle_set(text: bytes, words: int = WORDS) -> np.ndarray:
    """Distinct shingles of a text as sorted unsigned hashes."""
    found = text.lower().split()
    if not found:
        return np.empty(0, np.uint64)
    line, n = b" ".join(found), max(1, len(found) - words + 1)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    ends = (ends[words - 1 :] if len(found) >= words else ends[-1:]).tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter([digest(line[a:b], SEED) for a, b in zip(starts, ends, strict=True)], np.uint64, n))


def prefix_length(n: int, similarity: float = SIMILARITY) -> int:
    share = Fraction(str(similarity))
    return n - -(-n * share.numerator // share.denominator) + 1


def sketch(found: np.ndarray) -> int:
    """The SimHash of a set, signed."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(found), 4096):
        ones += np.unpackbits(found[i : i + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(found), bitorder="little").view(np.int64)[0])


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, shingles): the set of each text with words as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = text_bytes(batch.column(1))
            found = [shingle_set(data[off[i] : off[i + 1]].tobytes(), words) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.tobytes() if len(s) else None for s in found], pa.binary())], ["doc_id", "shingles"])

    return docs.mapInArrow(lean(run), "doc_id long, shingles binary").where("shingles is not null")


def _common(docs: DataFrame, words: int, sample: int, most: int) -> np.ndarray:
    """Shingles that several texts of a sample hold, the commonest last (bounded by `most`)."""
    rate = min(1.0, sample / max(1, docs.count()))
    some = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < rate * (1 << 20)).dropDuplicates(["text"])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shingles in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(shingles, np.int64))], ["h"])

    counted = _sets(some, words).select("shingles").mapInArrow(lean(split), "h long").groupBy("h").agg(F.count("*").alias("n")).where("n > 2")
    rows = counted.orderBy(F.desc("n"), "h").limit(most).collect()
    return np.array([r.h for r in reversed(rows)], np.int64).view(np.uint64)


def _prefixes(docs: DataFrame, words: int, similarity: float, common: np.ndarray) -> DataFrame:
    """(doc_id, sig, n, fp, prefix) of every text with words."""
    by = np.argsort(common)
    held = docs.sparkSession.sparkContext.broadcast((common[by], by + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rank = held.value
        for batch in batches:
            data, off = text_bytes(batch.column(1))
            rows = []
            for i in range(batch.num_rows):
                found = shingle_set(data[off[i] : off[i + 1]].tobytes(), words)
                if not len(found):
                    continue
                place = np.zeros(len(found), np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, found), len(known) - 1)
                    place = np.where(known[at] == found, rank[at], 0)
                first = found[np.argsort(place, kind="stable")][: prefix_length(len(found), similarity)]
                rows.append((i, xxhash.xxh128_digest(found.tobytes()), len(found), sketch(found), first.view(np.int64)))
            cols = list(zip(*rows, strict=True)) or [()] * 5
            ids = batch.column(0).take(pa.array(cols[0], pa.int64()))
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, cols[4])]), pa.int32()), pa.array(np.concatenate([np.empty(0, np.int64), *cols[4]])))
            yield pa.RecordBatch.from_arrays([ids, pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64()), lists], ["doc_id", "sig", "n", "fp", "prefix"])

    return docs.mapInArrow(lean(run), "doc_id long, sig binary, n long, fp long, prefix array<long>")


def _verified(pairs: DataFrame, docs: DataFrame, words: int, similarity: float) -> DataFrame:
    """The pairs (src, dst) of which some texts are similar enough."""
    share = Fraction(str(similarity))
    ids = pairs.select(F.col("src").alias("doc_id")).unionAll(pairs.select(F.col("dst").alias("doc_id"))).distinct()
    sets = saved(_sets(docs.join(ids, "doc_id", "left_semi").select("doc_id", "text"), words), "shingle-sets")
    both = pairs.join(sets.toDF("src", "a"), "src").join(sets.toDF("dst", "b"), "dst").select("src", "dst", "a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for a, b in zip(batch.column(2), batch.column(3), strict=True):
                a, b = (np.frombuffer(x.as_buffer(), np.uint64) for x in (a, b))
                same = len(np.intersect1d(a, b, assume_unique=True))
                good.append(same * share.denominator >= (len(a) + len(b) - same) * share.numerator)
            yield batch.select(["src", "dst"]).filter(pa.array(good, pa.bool_()))

    out = saved(both.mapInArrow(lean(run), "src long, dst long").distinct(), "shingle-links")
    discard(sets)
    return out


def links(docs: DataFrame, known: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, sample: int = SAMPLE, common: int = COMMON, judged: int = JUDGED, far: int = FAR) -> DataFrame:
    """(src, dst): with the links `known` (src, dst), enough links for the components of known links and of similar texts of (doc_id, text)."""
    with small_batches(docs.sparkSession, ROWS):
        return _links(docs, known, words, similarity, sample, common, judged, far)


def _links(docs: DataFrame, known: DataFrame, words: int, similarity: float, sample: int, common: int, judged: int, far: int) -> DataFrame:
    share = Fraction(str(similarity))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    rows = saved(_prefixes(docs, words, similarity, _common(docs, words, sample, common)), "shingle-prefixes")
    first = saved(rows.groupBy("sig").agg(F.min("doc_id").alias("rep")), "shingle-first")
    edges = known.select("src", "dst").unionAll(rows.select("doc_id", "sig").join(first, "sig").where("doc_id <> rep").select(F.col("doc_id").alias("src"), F.col("rep").alias("dst")))
    edges = saved(edges.distinct(), "shingle-edges")
    heads = saved(rows.join(first, "sig").where("doc_id = rep").dropDuplicates(["sig"]).select("rep", "n", "fp", "prefix"), "shingle-heads")
    discard(rows)
    posted = heads.select(F.explode("prefix").alias("key"), "rep", "n", "fp")
    shared = posted.select("key", "rep").groupBy("key").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low <> high").select("key")
    lists = saved(posted.join(shared, "key"), "shingle-lists")
    discard(heads)
    pivots, parts = 1, connected_components(edges).withColumnRenamed("node", "rep")
    while True:
        members = lists.join(parts, "rep", "left").withColumn("c", F.coalesce("component", "rep")).drop("component")
        members = saved(members, "shingle-members")
        major = members.groupBy("key", "c").agg(F.count("*").alias("m")).groupBy("key").agg(F.max(F.struct("m", "c")).getField("c").alias("major"), F.count("*").alias("parts"))
        rest = saved(members.join(major.where("parts > 1").drop("parts"), "key"), "shingle-open")
        discard(members)
        if rest.isEmpty():
            return edges
        order = Window.partitionBy("key").orderBy(F.col("c") == F.col("major"), F.xxhash64("rep"), "rep", "fp", "n")
        # the limit on the row number is pushed below the shuffle, so a task sends few rows of a long list
        chosen = saved(rest.withColumn("r", F.row_number().over(order)).where(F.col("r") <= pivots).drop("r", "major"), "shingle-pivots")
        p = chosen.toDF("key", "rep1", "n1", "fp1", "c1")
        met = rest.join(p, "key").where((F.col("c") != F.col("c1")) & (F.least("n", "n1") * share.denominator >= F.greatest("n", "n1") * share.numerator))
        met = met.where((F.least("n", "n1") < judged) | (F.bit_count(F.col("fp").bitwiseXOR(F.col("fp1"))) <= far))
        pairs = saved(met.select(F.greatest("rep", "rep1").alias("src"), F.least("rep", "rep1").alias("dst")).distinct(), "shingle-pairs")
        if not pairs.isEmpty() and not (new := _verified(pairs, docs, words, similarity)).isEmpty():
            edges = saved(edges.unionAll(new), "shingle-edges")
            parts = connected_components(edges).withColumnRenamed("node", "rep")
        lists = saved(rest.join(chosen.select("key", "rep", "n", "fp"), ["key", "rep", "n", "fp"], "left_anti").select("key", "rep", "n", "fp"), "shingle-lists")
        for df in (rest, chosen, pairs):
            discard(df)
        pivots = min(512, pivots * 16)
