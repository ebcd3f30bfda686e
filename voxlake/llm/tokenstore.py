"""Operator 6: token ids in a content-addressed store.

Texts are encoded with the tokenizers library (the end id closes each document); a rolling hash over the last eight ids cuts
each document's id stream into chunks, so equal passages give equal chunks wherever they stand.  The store is a folder:

* `chunks/`   each distinct chunk once, under its 128-bit digest, as little-endian ids (16 bits where the vocabulary allows);
* `recipes/`  one row per document in ascending doc_id order (null first): its chunk digests, id count, start (ids before it) and leaf hash;
* `manifest/` a Merkle root for every range of recipes and one over them all.

`read` joins recipes to chunks, rebuilds every document, and raises if a digest, a leaf or a root differs.

Where the tokenizer file says that white space parts tokens and is dropped, that letters are folded to lower case, and that its pattern never joins
letters with other characters but for apostrophes (PROVED), only tokens that a worker has not met go through the library; texts with apostrophes,
special tokens or characters beyond Latin-1 are cut at white space only.  With any other file every whole text goes through the library.
Nulls count as empty: the end id alone.  Rows with null or repeated doc_ids are documents of their own.  Extra columns are ignored; an empty
table gives an empty store.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxlake.llm.common import blocks, spread, text_bytes
from voxlake.llm.runs import Memo, hashes, runs, unknown
from voxlake.plans.scratch import discard, saved, scratch_dir, tidy

END = 1
CUT = 255  # a chunk ends where the rolling hash has these bits zero: 256 ids on average
LONGEST = 2048
KNOWN = 1_500_000  # tokens that a worker remembers
BYTES = 2 << 20  # of text encoded at once
_TOKENS = re.compile(r"[^ \t\r\n]+").findall
_WORKERS: dict[tuple[str, int], Encoder] = {}

#: Classes of bytes: 0 white space that only parts tokens, 1 letters (ASCII, and the Latin-1 letters in two bytes), 2 others.
_CLASS = np.full(256, 2, np.uint8)
_CLASS[[9, 10, 13, 32]] = 0
_CLASS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
#: Bytes that send a text the slow way: an apostrophe, a bar (special tokens), and beyond ASCII all but U+00C0 to U+00FF.
_SLOW = np.zeros(256, bool)
_SLOW[[39, 124, *range(0xC0, 0xC3), *range(0xC4, 256)]] = True


#: Settings of a tokenizer file for which runs of a class can be encoded by themselves (normalizer, pattern of its pre-tokenizer).
PROVED = (
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
)


def settings(path: str) -> tuple[int, bool]:
    """Of a tokenizer file: one more than its largest id, and whether its settings are the proved ones."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    added = file.get("added_tokens") or []
    vocab = file["model"]["vocab"]
    ids = vocab.values() if isinstance(vocab, dict) else range(len(vocab))
    most = max([*ids, *(t["id"] for t in added)], default=-1) + 1
    splits = [p for p in (file.get("pre_tokenizer") or {}).get("pretokenizers", []) if p.get("type") != "ByteLevel" or p.get("use_regex") or p.get("add_prefix_space")]
    plain = all("|" in t["content"] and not t.get("lstrip") and not t.get("rstrip") for t in added)
    return most, file.get("normalizer") == PROVED[0] and splits == [PROVED[1]] and plain and file["model"].get("type") == "BPE"


class Encoder:
    """Ids of texts; one per worker and vocabulary."""

    def __init__(self, path: str, end: int = END):
        self.end = end
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.proved = Tokenizer.from_file(path), settings(path)[1]
        self.memo, self.words = Memo(KNOWN), {}

    def _library(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(tokens, add_special_tokens=False)]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter((i for x in ids for i in x), np.int32, sizes.sum()), sizes

    def _slow(self, texts: list[str]) -> list[np.ndarray]:
        """Texts with characters that join across letters: whole white-space tokens go through the library."""
        if len(self.words) > KNOWN // 20:
            self.words = {}
        tokens = [_TOKENS(t) for t in texts]
        new = list({w for t in tokens for w in t} - self.words.keys())
        if new:
            flat, sizes = self._library(new)
            self.words.update(zip(new, np.split(flat, np.cumsum(sizes)[:-1]), strict=True))
        return [np.concatenate([np.empty(0, np.int32), *map(self.words.__getitem__, t)]) for t in tokens]

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids with the end id after each text, and the number of each."""
        if not self.proved:
            ids, sizes = self._library([data[a:b].tobytes().decode() for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)])
            return np.insert(ids, np.cumsum(sizes), self.end), sizes + 1
        if len(self.memo.keys) > KNOWN:
            self.memo.clear()
        odd = np.append(0, np.cumsum(_SLOW[data] | (data == 0xC3) & np.isin(np.append(data[1:], 0), (0x97, 0xB7)))) if len(data) else np.zeros(1, np.int64)
        slow = np.flatnonzero(odd[off[1:]] > odd[off[:-1]])
        starts, ends = runs(data, off, _CLASS)
        doc = np.searchsorted(off, starts, "right") - 1
        if len(slow):
            keep = ~np.isin(doc, slow)
            starts, ends, doc = starts[keep], ends[keep], doc[keep]
        h = hashes(data, starts, ends)
        new, first = unknown(self.memo, h)
        if len(new):
            self.memo.add(new, *self._library([data[a:b].tobytes().decode() for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]))
        ids, sizes = self.memo.values(self.memo.find(h))
        counts = np.bincount(doc, weights=sizes, minlength=len(off) - 1).astype(np.int64) if len(doc) else np.zeros(len(off) - 1, np.int64)
        if len(slow):
            fast = np.append(0, np.cumsum(counts))
            parts = [ids[fast[i] : fast[i + 1]] for i in range(len(counts))]
            for i, own in zip(slow.tolist(), self._slow([data[off[i] : off[i + 1]].tobytes().decode() for i in slow.tolist()]), strict=True):
                parts[i], counts[i] = own, len(own)
            ids = np.concatenate(parts)
        ends = np.cumsum(counts)
        return np.insert(ids, ends, self.end), counts + 1


def encoder(path: str, end: int = END) -> Encoder:
    if (path, end) not in _WORKERS:
        _WORKERS[path, end] = Encoder(path, end)
    return _WORKERS[path, end]


def cuts(ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Ends of chunks: where the hash of the last eight ids says so, at the end of each text, and after LONGEST ids."""
    h = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    for n in (1, 2, 4):
        h = np.concatenate([h[:n], h[n:] + h[:-n] * np.uint64(0xD6E8FEB86659FD93)]) if len(h) > n else h
        h ^= h >> np.uint64(32)
    here = (h & np.uint64(CUT)) == 0
    bounds = np.cumsum(sizes)
    here[bounds - 1] = True
    ends = np.flatnonzero(here) + 1
    gap = np.diff(np.append(0, ends))
    if (gap > LONGEST).any():
        pieces = -(-gap // LONGEST)
        k = spread(pieces)
        last = np.repeat(ends, pieces)
        ends = np.where(k + 1 == np.repeat(pieces, pieces), last, np.repeat(ends - gap, pieces) + (k + 1) * LONGEST)
    return ends


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _leaf(digests: list[bytes], n: int) -> bytes:
    return hashlib.sha256(b"".join(digests) + n.to_bytes(8, "little")).digest()


def root(leaves: list[bytes]) -> bytes:
    """Of a Merkle tree; an odd node moves up."""
    while len(leaves) > 1:
        leaves = [hashlib.sha256(b"".join(leaves[i : i + 2])).digest() if i + 1 < len(leaves) else leaves[i] for i in range(0, len(leaves), 2)]
    return leaves[0] if leaves else hashlib.sha256(b"").digest()


def _encode(path: str, width: str, size: int = BYTES):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            text, off = text_bytes(batch.column(1))
            for i, j in blocks(off, size):
                part = batch.slice(i, j - i)
                ids, sizes = own.encode(text[off[i] : off[j]], off[i : j + 1] - off[i])
                ends = cuts(ids, sizes)
                data = ids.astype(width)
                starts = np.append(0, ends[:-1])
                chunks = [data[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                names = [_digest(c) for c in chunks]
                bound = np.append(0, np.searchsorted(ends, np.cumsum(sizes)) + 1)
                leaves = [_leaf(names[a:b], n) for a, b, n in zip(bound[:-1].tolist(), bound[1:].tolist(), sizes.tolist(), strict=True)]
                listed = pa.ListArray.from_arrays(pa.array(bound.astype(np.int32)), pa.StructArray.from_arrays([pa.array(names, pa.binary()), pa.array(chunks, pa.binary())], ["digest", "ids"]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes), pa.array(leaves, pa.binary()), listed], ["doc_id", "n_tokens", "leaf", "chunks"])

    return run


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The root of each part; parts come whole and in order."""
    part, leaves = None, []
    for batch in batches:
        for p, leaf in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if p != part and leaves:
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([len(leaves)], pa.int64()), pa.array([root(leaves)], pa.binary())], ["part", "documents", "root"])
                leaves = []
            part = p
            leaves.append(leaf)
    if leaves:
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([len(leaves)], pa.int64()), pa.array([root(leaves)], pa.binary())], ["part", "documents", "root"])


def _manifest(recipes: DataFrame) -> DataFrame:
    return recipes.select("part", "leaf", "row").repartition("part").sortWithinPartitions("part", "row").select("part", "leaf").mapInArrow(_roots, "part int, documents long, root binary")


def write(docs: DataFrame, path: str, tokenizer: str) -> None:
    """The store of all documents of (doc_id, text) under path."""
    spark = docs.sparkSession
    width = "<u2" if max(settings(tokenizer)[0], END + 1) <= 1 << 16 else "<u4"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_encode(tokenizer, width), "doc_id long, n_tokens long, leaf binary, chunks array<struct<digest: binary, ids: binary>>")
    rows = saved(rows.withColumn("uid", F.monotonically_increasing_id()), "token-ids", "zstd")
    chunks = rows.select("uid", F.posexplode("chunks").alias("k", "c")).groupBy("c.digest").agg(F.first("c.ids").alias("ids"), F.min(F.struct("uid", "k")).alias("home"), F.count("*").alias("copies"))
    with tidy(spark):
        chunks.select("digest", "ids", "home.uid", "home.k", "copies").write.parquet(f"{path}/chunks", compression="zstd")
    ordered = rows.select("uid", "doc_id", "n_tokens", "leaf", F.col("chunks.digest").alias("digests")).repartitionByRange("doc_id", "leaf", "uid").sortWithinPartitions("doc_id", "leaf", "uid")
    ordered = saved(ordered.withColumn("part", F.spark_partition_id()).withColumn("row", F.monotonically_increasing_id()), "recipes")
    totals = ordered.groupBy("part").agg(F.sum("n_tokens").alias("ids")).withColumn("before", F.coalesce(F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inside = F.coalesce(F.sum("n_tokens").over(Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    recipes = ordered.withColumn("inside", inside).join(F.broadcast(totals.select("part", "before")), "part")  # one row a partition
    with tidy(spark):
        recipes.select("part", "row", "uid", "doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "leaf", "digests").sortWithinPartitions("part", "row").write.parquet(f"{path}/recipes")
    parts = _manifest(spark.read.parquet(f"{path}/recipes")).orderBy("part").collect()  # one row a partition
    top = [(r.part, r.documents, bytes(r.root)) for r in parts]
    top.append((-1, sum(r[1] for r in top), root([r[2] for r in top])))
    spark.createDataFrame([(*r, width) for r in top], "part int, documents long, root binary, width string").coalesce(1).write.parquet(f"{path}/manifest")
    discard(rows)
    discard(ordered)


def _rebuild(width: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid, head, names, parts = None, None, [], []

        def close() -> tuple:
            data = b"".join(parts)
            ids = np.frombuffer(data, width).astype("<u4")
            doc, start, n, leaf = head or (None, None, -1, b"")
            if len(ids) != n or _leaf(names, n) != leaf or any(_digest(c) != d for c, d in zip(parts, names, strict=True)):
                raise ValueError(f"the store's document {doc} differs from its recipe")
            return doc, start, n, zlib.crc32(ids.tobytes()), ids.astype(np.int64) if with_ids else None

        def table(out: list[tuple]) -> pa.RecordBatch:
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(types)], ["doc_id", "start", "n_tokens", "ids_crc32", "ids"])

        for batch in batches:
            out = []
            for u, k, name, ids, doc, start, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if u != uid:
                    if uid is not None:
                        out.append(close())
                    uid, head, names, parts = u, None, [], []
                if k < 0:
                    head = (doc, start, n, name)
                else:
                    names.append(name)
                    parts.append(ids)
            if out:
                yield table(out)
        if uid is not None:
            yield table([close()])

    return run


def read(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of every document of a store, verified."""
    recipes = spark.read.parquet(f"{path}/recipes")
    manifest = {r.part: r for r in spark.read.parquet(f"{path}/manifest").collect()}  # one row a partition
    found = {r.part: bytes(r.root) for r in _manifest(recipes).collect()}
    if found != {p: bytes(r.root) for p, r in manifest.items() if p >= 0} or root([found[p] for p in sorted(found)]) != bytes(manifest[-1].root):
        raise ValueError("the store's recipes differ from its manifest")
    chunks = spark.read.parquet(f"{path}/chunks")
    none = F.lit(None).cast("long")
    more = (none.alias("doc_id"), none.alias("start"), none.alias("n_tokens"))
    heads = recipes.select("uid", F.lit(-1).alias("k"), F.col("leaf").alias("digest"), F.lit(None).cast("binary").alias("ids"), "doc_id", "start", "n_tokens")
    home = chunks.select("uid", "k", "digest", "ids", *more)  # the first document with a chunk gets it without a join
    shared = chunks.where("copies > 1").select("digest", "ids", F.col("uid").alias("home_uid"), F.col("k").alias("home_k"))
    refs = recipes.select("uid", F.posexplode("digests").alias("k", "digest")).join(shared, "digest").where("uid <> home_uid or k <> home_k").select("uid", "k", "digest", "ids", *more)
    full = heads.unionAll(home).unionAll(refs).repartition("uid").sortWithinPartitions("uid", "k")
    return full.mapInArrow(_rebuild(manifest[-1].width, with_ids), "doc_id long, start long, n_tokens long, ids_crc32 long, ids array<long>")


def store_and_read(docs: DataFrame, tokenizer: str, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """Writes the store (to a new shared folder unless path is given) and reads it back."""
    path = path or f"{scratch_dir(docs.sparkSession)}/token-store-{uuid.uuid4().hex}"
    write(docs, path, tokenizer)
    return read(docs.sparkSession, path, with_ids)
