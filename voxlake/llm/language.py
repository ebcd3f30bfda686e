"""Operator 10: language identification, words first, then ever shorter character n-grams.

Each language keeps the log frequency of its commonest words.  A known word scores by them; a word that no language knows falls
back to the first of its 5-, 4-, 3-, 2- and 1-grams (with edges) that the model knows, at every position, averaged over the
word.  A text's score for a language is the sum over its words; the posterior of the best one, over a length-damped sum, is the score.

Bounds (documented parameters): the model learns from about `per_lang` documents of each language, taken by a hash of doc_id,
and keeps at most `max_words` words and `max_grams` n-grams in all.  Every text is scored as a whole.

Texts that are null or have no letter get `und` with score 0.  Without a single labelled text every prediction is `und`.
Ties go to the first language in order.  Rows with null or repeated doc_ids are predicted like any other and rows without doc_id count as
not held out (they are not learned from either).  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlake.llm.common import blocks, text_bytes
from voxlake.llm.runs import Memo, hashes, runs, unknown

PER_LANG = 4000
MAX_WORDS = 100_000
MAX_GRAMS = 200_000
KNOWN = 1_000_000  # runs of letters that a worker remembers
SENT = 20_000  # words that a task counts before it sends them
BYTES = 2 << 20
DAMP = 0.5
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """Runs of letters; number signs that Python counts among word characters (general category N) part them."""
    out = _WORD.findall(text)
    if all(map(str.isalpha, out)):
        return out
    return [w for x in out for w in "".join(c if c.isalpha() else " " for c in x).split()]


def grams(word: str, n: int) -> list[str]:
    w = f"<{word}>"
    return [w[i : i + n] for i in range(len(w) - n + 1)]


#: Classes of bytes: letters (and all beyond ASCII, which words() sorts out), and the rest, which parts runs.
_CLASS = np.zeros(256, np.uint8)
_CLASS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_WORKERS: dict[str, tuple[Memo, np.ndarray]] = {}


class Model:
    """Log frequencies by language; rows of `table` are words or n-grams."""

    def __init__(self, langs: list[str], words: dict[str, int], table: np.ndarray, gram_ids: dict[str, int], gram_table: np.ndarray):
        self.langs, self.words, self.table, self.grams, self.gram_table = langs, words, table, gram_ids, gram_table
        whole = hashlib.sha256(repr((langs, list(words.items()), list(gram_ids.items()))).encode())
        whole.update(table.tobytes())
        whole.update(gram_table.tobytes())
        self.name = whole.hexdigest()

    def of(self, word: str) -> np.ndarray:
        if word in self.words:
            return self.table[self.words[word]]
        w, total, n = f"<{word}>", np.zeros(len(self.langs)), 0
        ids = []
        for i in range(len(w)):
            for size in (5, 4, 3, 2, 1):
                if (g := self.grams.get(w[i : i + size])) is not None and i + size <= len(w):
                    ids.append(g)
                    break
        n = len(ids)
        return self.gram_table[ids].sum(axis=0) / n if n else total

    def _run(self, run: str) -> np.ndarray:
        """Of a run of letters: the sum over its words, and their number."""
        found = words_of(run.lower())
        if len(found) == 1:
            return np.append(self.of(found[0]), 1.0)
        return np.append(sum((self.of(w) for w in found), np.zeros(len(self.langs))), float(len(found)))

    def predict(self, data: np.ndarray, off: np.ndarray) -> tuple[list[str], list[float]]:
        """Languages and scores of a block of texts; what a run means is remembered by the worker."""
        if self.name not in _WORKERS:
            _WORKERS.clear()  # one model at a time
        memo, rows = _WORKERS.get(self.name) or (Memo(KNOWN), np.empty((0, len(self.langs) + 1)))
        if len(memo.keys) > KNOWN:
            memo, rows = Memo(KNOWN), rows[:0]
        starts, ends = runs(data, off, _CLASS)
        doc = np.searchsorted(off, starts, "right") - 1
        h = hashes(data, starts, ends)
        new, first = unknown(memo, h)
        if len(new):
            memo.add(new, np.zeros(0, np.int32), np.zeros(len(new), np.int64))
            rows = np.concatenate([rows, np.stack([self._run(data[a:b].tobytes().decode("utf-8", "ignore")) for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)])])
        _WORKERS[self.name] = memo, rows
        at, n = memo.find(h), len(off) - 1
        total = np.stack([np.bincount(doc, weights=rows[at, k], minlength=n) for k in range(rows.shape[1])], axis=1) if len(doc) else np.zeros((n, rows.shape[1]))
        count, total = total[:, -1], total[:, :-1]
        if not self.langs:
            return ["und"] * n, [0.0] * n
        best = total.argmax(axis=1)
        odds = np.exp((total - total[np.arange(n), best][:, None]) / np.maximum(1.0, count)[:, None] ** DAMP)
        blank = count == 0
        return [("und" if b else self.langs[k]) for b, k in zip(blank.tolist(), best.tolist(), strict=True)], np.where(blank, 0.0, 1 / odds.sum(axis=1)).tolist()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, kind, unit, n): words (kind 0) and, once per distinct word of a text, n-grams (kind n)."""
    words: dict[tuple[str, str], list[int]] = {}

    def send() -> pa.RecordBatch:
        count: Counter[tuple] = Counter()
        for (lang, w), (n, texts) in words.items():
            count[lang, 0, w] += n
            for size in (1, 2, 3, 4, 5):
                for g in grams(w, size):
                    count[lang, size, g] += texts
        keys = list(count)
        types = (pa.string(), pa.int32(), pa.string())
        return pa.RecordBatch.from_arrays([*(pa.array([k[i] for k in keys], t) for i, t in enumerate(types)), pa.array(list(count.values()), pa.int64())], ["lang", "kind", "unit", "n"])

    for batch in batches:
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for w, n in Counter(words_of(text.lower())).items():
                own = words.setdefault((lang, w), [0, 0])
                own[0] += n
                own[1] += 1
            if len(words) > SENT:
                yield send()
                words = {}
    if words:
        yield send()


def fit(docs: DataFrame, per_lang: int = PER_LANG, max_words: int = MAX_WORDS, max_grams: int = MAX_GRAMS) -> Model:
    """Of (doc_id, text, lang); rows without any of the three are ignored."""
    known = docs.where("doc_id is not null and text is not null and lang is not null").select("doc_id", "text", "lang")
    totals = {r.lang: r["count"] for r in known.groupBy("lang").count().collect()}  # one row a language
    langs = sorted(totals)
    if not langs:
        return Model([], {}, np.empty((0, 0)), {}, np.empty((0, 0)))
    rate = F.coalesce(*[F.when(F.col("lang") == g, F.lit(min(1.0, per_lang / totals[g]))) for g in langs])
    sample = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < rate * (1 << 20))
    units = sample.select("text", "lang").mapInArrow(_count, "lang string, kind int, unit string, n long").groupBy("lang", "kind", "unit").agg(F.sum("n").alias("n")).persist()
    sums = {(r.lang, r.kind): r.n for r in units.groupBy("lang", "kind").agg(F.sum("n").alias("n")).collect()}
    seen = [F.sum(F.when(F.col("lang") == g, F.col("n")).otherwise(0)).alias(f"c{i}") for i, g in enumerate(langs)]
    together = units.groupBy("kind", "unit").agg(F.sum("n").alias("n"), *seen).where("n >= 2")
    words = together.where("kind = 0").orderBy(F.desc("n"), "unit").limit(max_words).drop("n").toArrow()
    parts = together.where("kind > 0").orderBy(F.desc("n"), "unit").limit(max_grams).drop("n").toArrow()
    units.unpersist()

    def logs(rows: pa.Table) -> np.ndarray:
        out, kind = np.empty((rows.num_rows, len(langs))), rows["kind"].to_numpy()
        for j, g in enumerate(langs):
            total = np.array([sums.get((g, k), 0) for k in range(6)], float)[kind]
            out[:, j] = np.log((rows[f"c{j}"].to_numpy() + 0.1) / (total + 1))
        return np.maximum(out - out.max(axis=1, keepdims=True), -8.0) if rows.num_rows else out

    numbered = lambda rows: {u: i for i, u in enumerate(rows["unit"].to_pylist())}
    return Model(langs, numbered(words), logs(words), numbered(parts), logs(parts))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by max_words and max_grams

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            data, off = text_bytes(batch.column(1))
            for i, j in blocks(off, BYTES):
                langs, scores = model.predict(data[off[i] : off[j]], off[i : j + 1] - off[i])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def held_out():
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def identify(docs: DataFrame, per_lang: int = PER_LANG) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row; learns from the rows not held out."""
    model = fit(docs.where(~held_out()).select("doc_id", "text", "lang"), per_lang)
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
