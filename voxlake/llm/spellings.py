"""Operator 11: spelling variants by an index of variable-length grams.

Words are maximal runs of letters, counted over whole texts (JVM functions only).  Two words are near at one inserted, deleted or replaced letter.

* Dictionary: a gram of 1 to `longest` - 1 letters is common if it makes up more than 1 in `share` of the gram places of all words, so it has at
  most `share` grams of a length and is broadcast.
* Decomposition: a padded word is cut from its start into grams, each the shortest prefix of what is left that is not common, or `longest` letters; and once
  more from its end, by the reversed dictionary.  A gram depends on its own letters only.
* Affected grams: an edit at place i leaves the forward grams that end before i and the backward grams that begin after it.  Those are the grams that
  both words must share, and the bound is per word and place: all of them.  Lists are therefore not merged one by one; a word is posted once
  under each distinct set of surviving grams (some 10 for a word of 8 letters), by a hash of what the set spells, with the few letters that the set
  leaves open.  An equi-join meets words of equal sets, and of those the open letters must be within one edit.
* Verification: pairs that remain are compared as whole words (Levenshtein distance 1), so foreign sets of equal hash only cost work.

A set leaves at most 2 `longest` - 1 letters open, which bounds a posting list by the words that differ there.  Forms are chosen by n, ties by the smallest word
in code-point order; roots by pointer doubling in shared tables: a form has at least twice its word's n, so chains are short.

Null texts have no words; rows with any doc_id count (a null id is written as nothing in the typing rule), repeated ones again.  Extra columns are ignored; an empty
table gives an empty result.  Words of any length are posted by hashes and open letters, so their postings stay small.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlake.llm.common import spread, text_bytes
from voxlake.llm.repeats import mix
from voxlake.llm.runs import RANDOM, powers
from voxlake.plans.scratch import discard, saved

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUN = "[A-Za-z\\u00C0-\\u00FF]+"
TYPED = 97  # of so many runs one loses a letter, see word_counts
SHORTEST, LEAST = 5, 3
LONGEST, SHARE = 2, 150
BEGIN, END = "^", "_"  # no word holds them


def word_counts(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, typed: int = TYPED) -> DataFrame:
    """(word, n) of words of at least `shortest` letters that occur `least` times.

    Runs are lower-cased (A-Z only); where `typed` divides the crc32 h of `<doc_id>:<run>`, the run's letter h % length is left out.
    """
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(F.expr(f"regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{RUN}', 0)")).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = runs.withColumn("h", h).select(F.when(F.col("h") % typed == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def common_grams(words: DataFrame, longest: int = LONGEST, share: int = SHARE) -> list[str]:
    """Grams of 1 to longest - 1 letters of padded words above 1 in `share` of all gram places: at most `share` of a length."""
    padded = words.select(F.concat(F.lit(BEGIN), "word", F.lit(END)).alias("w"))
    out: list[str] = []
    for q in range(1, longest):
        grams = padded.where(F.length("w") >= q).select(F.explode(F.transform(F.sequence(F.lit(1), F.length("w") - q + 1), lambda p, q=q: F.substring("w", p, F.lit(q)))).alias("g"))
        counts = grams.groupBy("g").agg(F.count("*").alias("n"))
        total = counts.agg(F.sum("n")).first()[0] or 0
        out += [r.g for r in counts.where(F.col("n") * share > total).collect()]  # at most `share`
    return out


def code(letter: str) -> int:
    """Seven bits: letters U+00C0 to U+00FF take 0 to 63."""
    return ord(letter) & 63 if ord(letter) >= 0xC0 else ord(letter)


class Grams:
    """Decomposition of a block of padded words by a dictionary of common grams."""

    def __init__(self, common: list[str], longest: int):
        self.longest = longest
        self.common = {q: np.unique([self._pack(np.array([code(c) for c in g], np.uint64)) for g in common if len(g) == q]).astype(np.uint64) for q in range(1, longest)}

    @staticmethod
    def _pack(codes: np.ndarray) -> np.uint64:
        out = np.uint64(0)
        for c in codes:
            out = out * np.uint64(128) + c
        return out

    def cuts(self, codes: np.ndarray, off: np.ndarray, back: bool) -> np.ndarray:
        """Which of the len(codes) + 1 places are ends of grams: from the starts of words, or from their ends."""
        if back:
            marks = self._cuts(codes[::-1], len(codes) - off[::-1], True)
            return marks[::-1]
        return self._cuts(codes, off, False)

    def _cuts(self, codes: np.ndarray, off: np.ndarray, back: bool) -> np.ndarray:
        step = np.ones(len(codes), np.int64)
        packed, open_ = codes.astype(np.uint64), np.ones(len(codes), bool)
        for q in range(1, self.longest):
            if q > 1:
                more = np.append(codes[q - 1 :], np.zeros(min(q - 1, len(codes)), codes.dtype)).astype(np.uint64)
                packed = packed + (more << np.uint64(7 * (q - 1))) if back else packed * np.uint64(128) + more
            open_ &= np.isin(packed, self.common[q])
            step += open_
        marks = np.zeros(len(codes) + 1, bool)
        at, end = off[:-1], off[1:]
        marks[off] = True
        while len(at):
            at = at + step[at]
            inside = at < end  # a gram that would pass the end is none
            at, end = at[inside], end[inside]
            marks[at] = True
        return marks


def surviving(codes: np.ndarray, off: np.ndarray, grams: Grams) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word, key, begin, end) of each distinct set of grams that an edit of the word may leave: its prefix up to a forward cut at begin, its suffix from a
    backward cut at end."""
    n, size = len(codes), np.diff(off)
    places = np.arange(n + 1)
    before = np.maximum.accumulate(np.where(grams.cuts(codes, off, False), places, 0))  # the last forward cut at or before
    after = np.minimum.accumulate(np.where(grams.cuts(codes, off, True), places, n)[::-1])[::-1]  # the first backward cut at or after
    letters = size - 2
    word = np.repeat(np.arange(len(size)), 2 * letters + 1)
    k = spread(2 * letters + 1)  # even: a gap before letter k / 2, odd: letter (k - 1) / 2 itself
    i = off[word] + 1 + k // 2
    a, z = before[i], after[i + k % 2]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (z[1:] != z[:-1]) | (word[1:] != word[:-1])
    word, a, z = word[new], a[new], z[new]
    up, down = powers(n)
    total = np.append(np.uint64(0), np.cumsum(RANDOM[codes] * up, dtype=np.uint64))
    part = lambda s, e: mix((total[e] - total[s]) * down[np.minimum(s, max(n - 1, 0))], (e - s).astype(np.uint64))
    key = mix(part(off[word], a), part(z, off[word + 1]))
    order = np.lexsort((key, word))  # two families of edits may leave the same set
    word, key, a, z = word[order], key[order], a[order], z[order]
    first = np.ones(len(word), bool)
    first[1:] = (word[1:] != word[:-1]) | (key[1:] != key[:-1])
    return word[first], key[first].view(np.int64), a[first], z[first]


def padded_codes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all padded words and where each begins."""
    data, off = text_bytes(words)
    lead = (data & 0xC0) != 0x80
    codes = np.where(data == 0xC3, np.append(data[1:], 0) & 63, data)[lead]  # U+00C0 to U+00FF are C3 and six bits more
    at = np.append(0, np.cumsum(lead))[off] + 2 * np.arange(len(off))
    out = np.empty(at[-1], np.uint8)
    inner = np.ones(len(out), bool)
    inner[at[:-1]] = inner[at[1:] - 1] = False
    out[inner], out[at[:-1]], out[at[1:] - 1] = codes, ord(BEGIN), ord(END)
    return out, at


def _post(common: list[str], longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(common, longest)
        for batch in batches:
            if not batch.num_rows:
                continue
            codes, at = padded_codes(batch.column(1))
            word, key, begin, end = surviving(codes, at, grams)
            size = end - begin
            flat = codes[np.repeat(begin, size) + spread(size)]
            open_ = pa.Array.from_buffers(pa.string(), len(size), [None, pa.py_buffer(np.append(0, np.cumsum(size)).astype(np.int32)), pa.py_buffer(flat)])
            yield pa.RecordBatch.from_arrays([pa.array(key), batch.column(0).take(pa.array(word)), open_], ["key", "id", "letters"])

    return run


def near_pairs(words: DataFrame, longest: int = LONGEST, share: int = SHARE) -> DataFrame:
    """(word, n, other, other_n) of words (id, word, n): near words, each pair once."""
    posts = words.select("id", "word").mapInArrow(_post(common_grams(words, longest, share), longest), "key long, id long, letters string")
    met = posts.alias("a").join(posts.alias("b"), F.col("a.key") == F.col("b.key"))  # equal sides: posted and shuffled once
    met = met.where((F.col("a.id") < F.col("b.id")) & (F.levenshtein("a.letters", "b.letters", 1) >= 0)).select(F.col("a.id").alias("id"), F.col("b.id").alias("other_id")).distinct()
    other = words.select(F.col("id").alias("other_id"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    return met.join(words, "id").join(other, "other_id").where(F.levenshtein("word", "other", 1) == 1).select("word", "n", "other", "other_n")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): forms followed to the last, by doubling."""
    jump = saved(forms.select("word", F.col("form").alias("to")), "spelling-roots")
    while True:
        on = jump.select(F.col("word").alias("to"), F.col("to").alias("further"))
        step = saved(jump.join(on, "to", "left").select("word", F.coalesce("further", "to").alias("to"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        discard(jump)
        jump = step
        if not step.where("moved").take(1):
            return jump.select("word", F.col("to").alias("root"))


def variants(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, typed: int = TYPED, longest: int = LONGEST, share: int = SHARE) -> DataFrame:
    """One row a word: word, form, root, n, n_near, form_n."""
    words = saved(word_counts(docs, shortest, least, typed).withColumn("id", F.monotonically_increasing_id()), "spelling-words")
    pairs = near_pairs(words, longest, share)
    both = F.explode(F.array(F.struct("word", "n", "other", "other_n"), F.struct(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n"))))
    near = pairs.select(both.alias("p")).groupBy("p.word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("p.other_n")).alias("order"), F.col("p.other").alias("best"))).alias("b"))
    near = near.select(F.col("word").alias("of"), "n_near", F.col("b.best").alias("best"), (-F.col("b.order")).alias("best_n"))
    has = F.col("best_n") >= 2 * F.col("n")
    rows = words.join(near, F.col("word") == F.col("of"), "left").select("word", F.when(has, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(has, F.col("best_n")).alias("form_n"))
    rows = saved(rows, "spelling-forms")
    last = roots(rows.where("form is not null")).withColumnRenamed("word", "of")
    return rows.join(last, F.col("word") == F.col("of"), "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


ORACLE = """
WITH RECURSIVE crc AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda c, z: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c FROM range(256) r(i))
), runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\\x{00C0}-\\x{00FF}]+')) AS run FROM documents
), counted AS (SELECT id, run, count(*) AS n FROM runs GROUP BY ALL),
codes AS (SELECT *, list_transform(string_split(id || ':' || run, ''), lambda c: unicode(c)::BIGINT) AS u FROM counted),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(u, lambda c: CASE WHEN c < 128 THEN [c] ELSE [195, c - 64] END))),
    lambda s, b: xor(s >> 8, t[(xor(s, b) & 255) + 1]))) AS h FROM codes, crc
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::INT) || substring(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), cuts AS (SELECT word, n, i, left(word, i) || substring(word, i + 2) AS cut FROM (SELECT word, n, unnest(range(length(word)))::INT AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM cuts c JOIN words w ON w.word = c.cut
  UNION SELECT w.word, c.word, c.n FROM cuts c JOIN words w ON w.word = c.cut
), best AS (SELECT word, count(*) AS n_near, max(other_n) AS best_n FROM near GROUP BY word),
named AS (SELECT b.word, n_near, best_n, min(other) AS best FROM best b JOIN near x ON x.word = b.word AND x.other_n = b.best_n GROUP BY ALL),
rows_ AS (
  SELECT w.word, CASE WHEN best_n >= 2 * w.n THEN best END AS form, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN best_n >= 2 * w.n THEN best_n END AS form_n
  FROM words w LEFT JOIN named USING (word)
), chain AS (
  SELECT word, word AS at FROM rows_ UNION ALL SELECT c.word, r.form FROM chain c JOIN rows_ r ON r.word = c.at WHERE r.form IS NOT NULL
)
SELECT r.word, r.form, c.at AS root, r.n, r.n_near, r.form_n
FROM rows_ r JOIN chain c ON c.word = r.word JOIN rows_ last ON last.word = c.at AND last.form IS NULL
"""
