"""Operator 12: collocations from a bidirectional FM-index of word ids per shard.

A shard is a block of whole texts: words are numbered per language, pieces are closed by symbol 0, and `ShardIndex` holds the Burrows-Wheeler transforms of
the sequence and of its reverse, sorted as deep as the longest phrase.  A phrase is a pair of intervals of equal size; `left` and `right` extend
all given phrases at once by every symbol that occurs before or after them and give the counts.  Counts are then summed across shards.

Two passes keep the sums small, as most phrases occur once:

1. every shard counts its two-word phrases under 64-bit keys; keys that sum to `least` or more set bits of a bitmap of fixed largest size (`BITS`).
   Foreign keys under a set bit cost work, never a wrong count;
2. every shard emits, by their text, its words, the two-word phrases whose bit is set, and those longer phrases whose neighbouring words all have
   their bits set (a phrase is no commoner than any two neighbours in it).

The rest are joins on phrases.  Counts are longs, products decimals of 38 digits (exact up to counts of 10^15).  The first `top` of a language are found in 64 parts first.

Null texts are empty, null langs `und`; rows with any doc_id count as they are, repeated ones again.  Ties go by a, then by phrase; equal cuts to the first.  Extra
columns are ignored; an empty table gives an empty result.  Blocks end at a separator, so a text of any length is cut; a piece of any length is whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxlake.llm.common import spread, text_bytes
from voxlake.llm.repeats import mix
from voxlake.llm.runs import RANDOM, hashes
from voxlake.plans.scratch import discard, saved

BITS = 28  # log2 of the bitmap's largest size: 32 MB
SHARD = 2 << 20  # bytes of text
EMIT = 100_000
_CLASS = np.full(256, 1, np.uint8)  # 1 word, 0 blank, 2 separator
_CLASS[[0x20, 0x09]] = 0
_CLASS[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class ShardIndex:
    """Bidirectional FM-index of symbols 0 (end of a piece) to n - 1, for phrases of up to depth symbols."""

    def __init__(self, symbols: np.ndarray, n: int, depth: int):
        self.n = n
        self.first = np.append(0, np.cumsum(np.bincount(symbols, minlength=n)))  # where suffixes of each symbol begin, in both directions
        self.bwt, self.lf = self._transform(symbols, depth)
        self.back_bwt, self.back_lf = self._transform(symbols[::-1], depth)

    def _transform(self, symbols: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """The symbol before each suffix in the order of their first `depth` symbols, and the place of the suffix that begins with it."""
        key, span = symbols.astype(np.int64), self.n
        for k in range(1, depth):
            if span * self.n >= 1 << 62:
                distinct, key = np.unique(key, return_inverse=True)
                span = len(distinct)
            key *= self.n
            key[: len(key) - k] += symbols[k:]
            span *= self.n
        bwt = np.roll(symbols, 1)[np.argsort(key, kind="stable")]
        lf = np.empty(len(bwt), np.int64)
        lf[np.argsort(bwt, kind="stable")] = np.arange(len(bwt))
        return bwt, lf

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Intervals (begin here, begin in the reverse, size) of symbols 1 to n - 1."""
        return self.first[1:-1], self.first[1:-1], np.diff(self.first)[1:]

    def _extend(self, bwt: np.ndarray, lf: np.ndarray, begin: np.ndarray, other: np.ndarray, size: np.ndarray):
        phrase = np.repeat(np.arange(len(size)), size)
        row = np.repeat(begin, size) + spread(size)
        key = phrase * self.n + bwt[row]
        order = np.argsort(key, kind="stable")
        key = key[order]
        at = np.flatnonzero(np.diff(key, prepend=-1))
        count = np.diff(np.append(at, len(key)))
        parent, symbol = np.divmod(key[at], self.n)
        new_begin = lf[row[order[at]]]
        new_other = other[parent] + at - (np.cumsum(size) - size)[parent]  # rows with smaller symbols in the same interval come before
        keep = symbol > 0
        return parent[keep], symbol[keep], new_begin[keep], new_other[keep], count[keep]

    def left(self, begin: np.ndarray, back: np.ndarray, size: np.ndarray):
        """Of each phrase P and each symbol c before it: P's number, c, and the intervals of cP."""
        return self._extend(self.bwt, self.lf, begin, back, size)

    def right(self, begin: np.ndarray, back: np.ndarray, size: np.ndarray):
        """Of each phrase P and each symbol c after it: P's number, c, and the intervals of Pc."""
        parent, symbol, back, begin, count = self._extend(self.back_bwt, self.back_lf, back, begin, size)
        return parent, symbol, begin, back, count


def ngrams(index: ShardIndex, longest: int, wanted) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For 2 to `longest`: phrases as rows of symbols, and their counts; wanted(a, b) tells which neighbours may stand in a phrase."""
    begin, back, size = index.words()
    parent, symbol, begin, back, size = index.left(begin, back, size)
    phrases = np.stack([symbol, parent + 1], 1)
    keep = wanted(phrases[:, 0], phrases[:, 1])
    for n in range(2, longest + 1):
        phrases, begin, back, size = phrases[keep], begin[keep], back[keep], size[keep]
        yield phrases, size
        if n < longest:
            parent, symbol, begin, back, size = index.right(begin, back, size)
            phrases = np.column_stack([phrases[parent], symbol])
            keep = wanted(phrases[:, -2], phrases[:, -1])


class Shard:
    """Words of a block of texts as symbols."""

    def __init__(self, data: np.ndarray, off: np.ndarray, langs: pa.Array):
        data = _LOWER[data]
        kind = _CLASS[data]
        edge = np.ones(len(data) + 1, bool)
        edge[1:-1] = kind[1:] != kind[:-1]
        edge[off] = True
        edge = np.flatnonzero(edge)
        starts, ends = edge[:-1], edge[1:]
        word = kind[starts] == 1 if len(data) else np.zeros(0, bool)
        starts, ends = starts[word], ends[word]
        sizes = ends - starts
        flat = data[kind == 1]
        column = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(np.append(0, np.cumsum(sizes)).astype(np.int64)), pa.py_buffer(flat)]).dictionary_encode()
        lang = langs.dictionary_encode()
        doc = np.searchsorted(off, starts, "right") - 1
        n_words = max(len(column.dictionary), 1)
        pairs, symbols = np.unique(lang.indices.to_numpy(zero_copy_only=False)[doc].astype(np.int64) * n_words + column.indices.to_numpy(zero_copy_only=False), return_inverse=True)
        separators = np.append(0, np.cumsum(kind == 2))
        last = np.ones(len(starts), bool)
        last[:-1] = (doc[1:] != doc[:-1]) | (separators[starts[1:]] != separators[starts[:-1]])
        self.symbols = np.insert(symbols + 1, np.flatnonzero(last) + 1, 0).astype(np.int64)
        self.n = len(pairs) + 1
        self.lang, self.word = np.divmod(pairs, n_words)
        self.langs, self.texts = lang.dictionary, column.dictionary

    def keys(self) -> np.ndarray:
        """A hash of each symbol's language and text; symbol 0 has 0."""
        def of(column: pa.Array) -> np.ndarray:
            data, off = text_bytes(column)
            return hashes(data, off[:-1], off[1:], RANDOM)

        return np.append(np.uint64(0), mix(of(self.texts)[self.word], of(self.langs)[self.lang])) if self.n > 1 else np.zeros(1, np.uint64)

    def table(self, phrases: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(phrases), EMIT):
            rows = phrases[i : i + EMIT] - 1
            parts = [self.texts.take(pa.array(self.word[c])) for c in rows.T]
            text = pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())) if len(parts) > 1 else parts[0]
            lang = self.langs.take(pa.array(self.lang[rows[:, 0]]))
            yield pa.RecordBatch.from_arrays([lang.cast(pa.string()), pa.array(np.full(len(rows), rows.shape[1], np.int32)), text.cast(pa.string()), pa.array(counts[i : i + EMIT], pa.int64())], ["lang", "words", "phrase", "n"])


def pair_keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a, b * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))


def shards(batch: pa.RecordBatch, size: int) -> Iterator[Shard]:
    """Blocks of about `size` bytes of (text, lang), cut at the ends of texts or else at a separator."""
    data, off = text_bytes(batch.column(0))
    langs = pc.fill_null(batch.column(1), "und")
    a = 0
    while a < len(data):
        b = min(a + size, len(data))
        if b < len(data):
            i = int(np.searchsorted(off, b, "right")) - 1
            if off[i] > a:
                b = int(off[i])
            else:
                end, step = int(off[i + 1]), 1 << 16
                while b < end:
                    cut = np.flatnonzero(_CLASS[data[b : min(b + step, end)]] == 2)
                    b = min(b + step, end) if not len(cut) else b + int(cut[0]) + 1
                    if len(cut):
                        break
        i, j = int(np.searchsorted(off, a, "right")) - 1, int(np.searchsorted(off, b, "left"))
        yield Shard(data[a:b], np.clip(off[i : j + 1], a, b) - a, langs.slice(i, j - i))
        a = b


def _pairs(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in shards(batch, size):
                key = shard.keys()
                for phrases, counts in ngrams(ShardIndex(shard.symbols, shard.n, 2), 2, lambda a, b: np.ones(len(a), bool)):
                    found = pair_keys(key[phrases[:, 0]], key[phrases[:, 1]]).view(np.int64)
                    for i in range(0, len(found), EMIT):
                        yield pa.RecordBatch.from_arrays([pa.array(found[i : i + EMIT]), pa.array(counts[i : i + EMIT], pa.int64())], ["key", "n"])

    return run


def _phrases(size: int, longest: int, bits: int, bitmap):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = np.frombuffer(bitmap.value, np.uint8)
        for batch in batches:
            for shard in shards(batch, size):
                if shard.n == 1:
                    continue
                key = shard.keys()

                def wanted(a: np.ndarray, b: np.ndarray, key=key) -> np.ndarray:
                    slot = pair_keys(key[a], key[b]) >> np.uint64(64 - bits)
                    return common[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8) & 1 == 1

                index = ShardIndex(shard.symbols, shard.n, longest)
                counts = index.words()[2]
                yield from shard.table(np.arange(1, shard.n)[:, None], counts)
                totals = np.bincount(shard.lang, weights=counts, minlength=len(shard.langs)).astype(np.int64)
                none = pa.nulls(len(totals), pa.string())
                yield pa.RecordBatch.from_arrays([shard.langs.cast(pa.string()), pa.array(np.zeros(len(totals), np.int32)), none, pa.array(totals)], ["lang", "words", "phrase", "n"])
                for phrases, counts in ngrams(index, longest, wanted):
                    yield from shard.table(phrases, counts)

    return run


def common_pairs(docs: DataFrame, least: int, size: int = SHARD, most_bits: int = BITS) -> tuple[int, bytes]:
    """log2 of the bitmap's size, and the bitmap of two-word phrases that occur `least` times."""
    keys = docs.select("text", "lang").mapInArrow(_pairs(size), "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("key")
    keys = saved(keys, "common-pairs")
    bits = min(max((16 * keys.count()).bit_length(), 16), most_bits)
    slot = F.shiftrightunsigned("key", 64 - bits) + 1
    rows = keys.select(F.bitmap_bucket_number(slot).alias("bucket"), F.bitmap_bit_position(slot).alias("bit")).groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("part"))
    bitmap = np.zeros(1 << (bits - 3), np.uint8)
    for r in rows.toLocalIterator():  # 4 KB each, 2^bits / 32768 rows at most
        bitmap[(r.bucket - 1) * 4096 : r.bucket * 4096] = np.frombuffer(bytes(r.part), np.uint8)
    discard(keys)
    return bits, bitmap.tobytes()


def phrase_counts(docs: DataFrame, longest: int = 3, least: int = 10, size: int = SHARD, most_bits: int = BITS) -> DataFrame:
    """(lang, words, phrase, n): all phrases of 1 to `longest` words that occur `least` times; words = 0 has each language's number of words."""
    bits, bitmap = common_pairs(docs, least, size, most_bits)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)
    rows = docs.select("text", "lang").mapInArrow(_phrases(size, longest, bits, shared), "lang string, words int, phrase string, n long")
    return rows.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n")).where((F.col("n") >= least) | (F.col("words") == 0))


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, top: int = 2000, share: int = 50, size: int = SHARD, most_bits: int = BITS) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase of 2 to `longest` words with a >= least occurrences scores floor(10^6 a a / (l r)) at its lowest-scoring cut into parts of l and r occurrences.  It is
    dropped if it lies in a longer candidate that has at least `share` per cent of its occurrences.
    """
    counts = saved(phrase_counts(docs, longest, least, size, most_bits), "phrase-counts")
    words = F.split("phrase", " ")
    candidates = counts.where("words >= 2").select("lang", "words", "phrase", F.col("n").alias("a"))
    join_part = lambda begin, n: F.array_join(F.slice("w", begin, n), " ")
    cuts = candidates.withColumn("w", words).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", join_part(F.lit(1), F.col("k")).alias("first"), join_part(F.col("k") + 1, F.col("words") - F.col("k")).alias("rest"))
    part = lambda name, to: counts.where(f"words between 1 and {longest - 1}").select("lang", F.col("phrase").alias(name), F.col("n").alias(to))
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    scored = cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"])
    scored = scored.select("lang", "phrase", "a", "k", "l", "r", wide("a").alias("a_"), wide("l").alias("l_"), wide("r").alias("r_")).withColumn("score", F.expr("(cast(1000000 as decimal(7,0)) * a_ * a_) div (l_ * r_)"))
    scored = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("s"))
    inside = candidates.where("words > 2").withColumn("w", words)
    inside = inside.withColumn("m", F.explode(F.sequence(F.lit(2), F.col("words") - 1))).withColumn("begin", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("m") + 1)))
    inside = inside.select("lang", join_part(F.col("begin"), F.col("m")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(inside, ["lang", "phrase"], "left").where(f"longer is null or 100 * longer < {share} * s.a").select("lang", "phrase", "s.*")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    kept = kept.withColumn("part", F.pmod(F.hash("phrase"), F.lit(64))).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    totals = counts.where("words = 0").select("lang", F.col("n"))
    return kept.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = """
WITH pieces AS (
  SELECT lang, regexp_extract_all(unnest(string_split_regex(text, '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents)
), occurrences AS (
  SELECT lang, 1 AS words, unnest(w) AS phrase FROM pieces
  UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM pieces
  UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM pieces
), f AS (SELECT lang, words, phrase, count(*) AS n FROM occurrences GROUP BY ALL),
totals AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE words = 1 GROUP BY ALL),
candidates AS (SELECT lang, words, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE words > 1 AND n >= 10),
cuts AS (
  SELECT lang, phrase, a, 1 AS k, w[1] AS first, array_to_string(w[2:], ' ') AS rest FROM candidates
  UNION ALL SELECT lang, phrase, a, 2, w[1] || ' ' || w[2], w[3] FROM candidates WHERE words = 3
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, l.n AS l, r.n AS r, ((1000000::HUGEINT * c.a * c.a) // (l.n::HUGEINT * r.n))::BIGINT AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = c.first JOIN f r ON r.lang = c.lang AND r.phrase = c.rest
), lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (
  SELECT lang, phrase, max(a) AS a FROM (
    SELECT lang, w[1] || ' ' || w[2] AS phrase, a FROM candidates WHERE words = 3 UNION ALL SELECT lang, w[2] || ' ' || w[3], a FROM candidates WHERE words = 3
  ) GROUP BY ALL
), kept AS (SELECT s.* FROM lowest s LEFT JOIN longer x ON x.lang = s.lang AND x.phrase = s.phrase WHERE x.a IS NULL OR 100 * x.a < 50 * s.a)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY k.score DESC, k.a DESC, k.phrase) AS rank, k.phrase, k.a, k.l, k.r, t.n, k.score
FROM kept k JOIN totals t ON t.lang = k.lang
QUALIFY rank <= 2000
"""
