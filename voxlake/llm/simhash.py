"""Operator 7: SimHash near-duplicates by a byte-position inverted index with count filtering.

A fingerprint is eight positional bytes.  Two that differ in at most `bits` = 2 bits share at least 8 - 2 = 6 positional
bytes.  Posting lists of single (position, byte) entries would be hot for every value, so the index intersects them four
at a time: the bytes form four pairs of positions, at least two pairs are untouched, and six keys of four bytes meet every
link.  Under a key the shared positional bytes of each pair are tallied; pairs below the guaranteed minimum are dropped and
the rest verified by bit_count.

Buckets above `dense` members (groups of near copies) would emit pairs in the square of their size.  There an exact way
without pairs is used: fingerprints are within two bits if and only if their radius-1 balls meet, so every member is listed
under the 65 values of its ball and each value links its (at most 65) members to the smallest.

With `similarity` given, texts whose sets of `words`-word shingles have that Jaccard similarity link as well (see shingles.py): two such texts
differ in about 10 bits at 0.8, beyond what shared bytes guarantee (up to 7), so their candidates come from rare shingles, with verification on whole sets.

The result has no ties: a component's name is its smallest doc_id.  Null or word-less texts have fingerprint zero.  Rows with a null doc_id are fingerprinted and stay without component.
Rows that repeat a doc_id are one node.  Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlake.llm import shingles
from voxlake.llm.common import text_bytes
from voxlake.operators.graph import connected_components
from voxlake.plans.scratch import saved
from voxlake.plans.workers import lean

SEED = 42
DENSE = 64


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """The fingerprint as a signed 64-bit integer."""
    words = text.lower().split()  # bytes: only A-Z change, and the separators are \\x20 and \\x09-\\x0D
    if not words:
        return 0
    line, n = b" ".join(words), max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    ends = (ends[shingle - 1 :] if len(words) >= shingle else ends[-1:]).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter([digest(line[a:b], SEED) for a, b in zip(starts, ends, strict=True)], np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 4096):
        ones += np.unpackbits(hashes[i : i + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, fp): the SimHash of each whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = text_bytes(batch.column(1))
            fps = [fingerprint(data[off[i] : off[i + 1]].tobytes(), shingle) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(lean(run), "doc_id long, fp long")


def links(fps: DataFrame, dense: int = DENSE) -> DataFrame:
    """(src, dst): enough links between distinct fingerprints (fp, rep) for the components of all links of <= 2 bits."""
    pairs = (0xFFFF, 0xFFFF << 16, 0xFFFF << 32, 0xFFFF << 48)
    masks = [a | b for a, b in combinations(pairs, 2)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keyed = fps.select("fp", "rep", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in signed])).alias("k", "key"))
    keyed = saved(keyed, "simhash-index")
    size = keyed.groupBy("k", "key").agg(F.count("*").alias("members")).where("members > 1")
    sized = keyed.join(size, ["k", "key"])
    sparse = sized.where(F.col("members") <= dense).select("k", "key", "fp", "rep")
    other = sparse.select("k", "key", F.col("fp").alias("fp2"), F.col("rep").alias("rep2"))
    same = F.col("fp").bitwiseXOR(F.col("fp2"))
    tally = sum(((F.shiftrightunsigned(same, 8 * i).bitwiseAND(F.lit(255))) == 0).cast("int") for i in range(8))
    found = sparse.join(other, ["k", "key"]).where(F.col("rep") < F.col("rep2")).where(tally >= 6).where(F.bit_count(same) <= 2)
    crowded = sized.where(F.col("members") > dense).select("fp", "rep").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.lit((1 << i) - (1 << 64) if i == 63 else 1 << i).cast("long") for i in range(64)])
    ball = crowded.select("fp", "rep", F.explode(flips).alias("flip")).select(F.col("fp").bitwiseXOR(F.col("flip")).alias("centre"), "rep")
    stars = ball.groupBy("centre").agg(F.collect_list("rep").alias("reps")).where(F.size("reps") > 1)
    stars = stars.select(F.explode("reps").alias("src"), F.array_min("reps").alias("dst")).where("src <> dst")
    return found.select(F.col("rep").alias("src"), F.col("rep2").alias("dst")).unionAll(stars)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, dense: int = DENSE, similarity: float | None = None, words: int = shingles.WORDS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row; component_id is the smallest doc_id reachable over links."""
    docs = docs.select(F.col(id_col).alias(id_col), F.col(text_col).alias(text_col))
    fps = saved(fingerprints(docs, id_col, text_col, shingle), "simhash")
    distinct = saved(fps.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-distinct")
    parts = connected_components(links(distinct, dense)).withColumnRenamed("node", "rep")
    named = distinct.join(parts, "rep", "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    out = fps.join(named, "fp", "left")
    if similarity is not None:
        out = saved(out, "simhash-parts")
        known = out.where("doc_id <> component_id").select(F.col("doc_id").alias("src"), F.col("component_id").alias("dst"))
        more = shingles.links(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), known, words, similarity)
        parts = connected_components(more).toDF("doc_id", "part")
        out = out.join(parts, "doc_id", "left").withColumn("component_id", F.coalesce("part", "component_id"))
    part = F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), part)
