"""Operator 13 against the tokenizers library and a plain sum-of-squares packer."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from voxlake.llm import packing, queries

PATH = public_tokenizers.path("word_bpe_49k.json")
COLUMNS = {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}


def check(rows, docs, size, end=packing.END):
    """Every id of every document in exactly one piece; sequences gapless, full or a power of two."""
    t = Tokenizer.from_file(PATH)
    want = sorted(([*t.encode(x or "", add_special_tokens=False).ids, end] for _, x in docs), key=repr)
    sequences, found = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r.length > 0 and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        sequences[r.sequence_id].append(r)
        found[r.doc_id, r.doc_tokens].append(r)
    for s in sequences.values():
        s.sort(key=lambda r: r.offset)
        ends = np.cumsum([r.length for r in s])
        assert [r.offset for r in s] == [0, *ends[:-1]] and (ends[-1] == size or ends[-1] < size and not ends[-1] & (ends[-1] - 1))
    return sequences, found, want


def rebuilt(found):
    out = []
    for (_, total), pieces in found.items():
        pieces.sort(key=lambda r: r.start)
        assert [r.start for r in pieces] == [0, *np.cumsum([r.length for r in pieces])[:-1]] and sum(r.length for r in pieces) == total
        out.append([i for r in pieces for i in r.ids])
    return sorted(out, key=repr)


def test_whole_table(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = packing.pack(df, PATH).collect()
    sequences, found, want = check(rows, [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()], 4096)
    assert rebuilt(found) == want
    got = queries.op13_packing(spark, sf_dir)
    assert COLUMNS <= set(got.columns)
    digest = lambda q: sorted((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens, r.sequence_id, r.offset) for r in q)
    assert digest(got.collect()) == digest(rows)


def test_partitions_and_small_windows(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").repartition(7, "doc_id")
    for size, most in ((256, 8192), (64, 4)):
        rows = packing.pack(df, PATH, size=size, most_open=most).collect()
        sequences, found, want = check(rows, [(r.doc_id, r.text) for r in df.collect()], size)
        assert rebuilt(found) == want
        short = [s for s in sequences.values() if s[-1].offset + s[-1].length < size]
        assert len(short) <= 7 * size.bit_length()


def plain(sizes, capacity):
    """Windows as lists of item numbers by the definition: every level tried, the sum of squares recounted."""
    windows, fills = [], []
    for k, s in enumerate(sizes):
        best = None
        for h in sorted({0, *(f for f in fills if f + s <= capacity and f < capacity)}, reverse=True):
            after = [f for f in fills if f < capacity]
            if h:
                after.remove(h)
            if h + s < capacity:
                after.append(h + s)
            total = sum(after.count(f) ** 2 for f in set(after))
            if best is None or total < best[0]:
                best = (total, h)
        h = best[1]
        if h:
            at = max((i for i, f in enumerate(fills) if f == h), key=lambda i: windows[i][-1])
        else:
            at = len(windows)
            windows.append([])
            fills.append(0)
        windows[at].append(k)
        fills[at] += s
    return sorted(tuple(w) for w, f in zip(windows, fills, strict=True) if f == capacity)


@pytest.mark.parametrize("seed", range(8))
def test_rule(seed):
    rng = random.Random(seed)
    capacity = rng.choice([8, 13, 40])
    sizes = [rng.randint(1, capacity - 1) for _ in range(120)]
    closed = []
    packer = packing.Packer(capacity, 10_000, closed.append)
    for k, s in enumerate(sizes):
        packer.add(k, np.zeros(s, np.int32))
    assert sorted(tuple(p[0] for p in w) for w in closed) == plain(sizes, capacity)
    packer.close()
    assert sum(len(p[3]) for w in closed for p in w) == sum(sizes)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "a b"), (3, "same words"), (3, "same words"), (4, "long " * 9000), (5, "x" * 5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "7 as start", "8 as ids").coalesce(1)
    got = packing.pack(df, PATH, size=512).collect()
    sequences, found, want = check(got, rows, 512)
    lengths = {r.doc_id: r.doc_tokens for r in got}
    assert lengths[1] == lengths[2] == 1 and sum(r.length for r in got) == sum(map(len, want))
    assert packing.pack(df.limit(0), PATH).collect() == []


def test_long_texts_in_slices():
    own = packing.tokenstore.encoder(PATH, packing.END)
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab c\té'.|") for _ in range(rng.randint(0, 900))) for _ in range(60)] + ["a" * 700, "b" * 300 + " " + "c" * 300]
    data = [np.frombuffer(t.encode(), np.uint8) for t in texts]
    off = np.append(0, np.cumsum([len(d) for d in data]))
    t = Tokenizer.from_file(PATH)
    got = [x.tolist() for x in packing.document_ids(own, np.concatenate(data), off, size=64)]
    assert got == [[*t.encode(x, add_special_tokens=False).ids, packing.END] for x in texts]
