"""Operator 6 against the tokenizers library and its own files."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from voxlake.llm import tokenstore
from voxlake.plans.scratch import scratch_dir

PATH = public_tokenizers.path("word_bpe_49k.json")


def brute(rows):
    t, start, out = Tokenizer.from_file(PATH), 0, []
    for doc, text in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def run(df, **k):
    return [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in sorted(tokenstore.store_and_read(df, PATH, **k).collect(), key=lambda r: r.start)]


def test_table(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert run(df) == brute([(r.doc_id, r.text) for r in df.orderBy("doc_id").collect()])


def test_many_blocks(spark, sf_dir, monkeypatch):
    import functools

    monkeypatch.setattr(tokenstore, "_encode", functools.partial(tokenstore._encode, size=5000))
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert run(df) == brute([(r.doc_id, r.text) for r in df.orderBy("doc_id").collect()])


def test_odd_texts(spark):
    rng = random.Random(6)
    alphabet = "aB'stré ºª½ \t\n\x1c\x85\xa0.,<|>éŁΣς東🙂12"
    texts = [None, "", " ", "it's I'll 'story don't", "a<|endoftext|>b", "ÀÉ aºb x½2", "é e ́", "Iİ STRASSE Σας", "word " * 6000]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(400)]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows[::-1], "doc_id long, text string").selectExpr("*", "1 as start", "2 as row").repartition(5)
    assert run(df) == brute(rows)


def test_null_and_repeated_ids_and_empty(spark):
    df = spark.createDataFrame([(None, "x"), (3, "same text"), (3, "same text"), (1, "y z")], "doc_id long, text string")
    assert run(df) == brute([(None, "x"), (1, "y z"), (3, "same text"), (3, "same text")])
    assert run(df.limit(0)) == []


def test_damage_is_found(spark):
    df = spark.createDataFrame([(i, f"text {i} " * 300) for i in range(20)], "doc_id long, text string")
    path = f"{scratch_dir(spark)}/damaged"
    tokenstore.write(df, path, PATH)
    chunks = spark.read.parquet(f"{path}/chunks")
    assert chunks.count() == chunks.select("digest").distinct().count()
    broken = [(r.digest, bytes(r.ids)[::-1] if i == 0 else r.ids, r.uid, r.k, r.copies) for i, r in enumerate(chunks.collect())]
    spark.createDataFrame(broken, chunks.schema).write.mode("overwrite").parquet(f"{path}/chunks")
    with pytest.raises(Exception, match="differs from its recipe"):
        tokenstore.read(spark, path).collect()


def test_other_tokenizers(spark):
    """Files with other settings: cased words, larger vocabularies; whole texts go through the library."""
    import json
    import tempfile

    assert tokenstore.settings(PATH) == (49_408, True) and tokenstore.settings(public_tokenizers.path("byte_bpe_50k.json")) == (50_257, False)
    vocab = {w: i for i, w in enumerate(["[UNK]", "Apple", "apple", "pie", "Pie,"])} | {"far": 70_000}
    file = {"version": "1.0", "truncation": None, "padding": None, "added_tokens": [], "normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "post_processor": None, "decoder": None, "model": {"type": "WordLevel", "vocab": vocab, "unk_token": "[UNK]"}}
    with tempfile.NamedTemporaryFile("w", suffix=".json", delete=False) as f:
        json.dump(file, f)
    df = spark.createDataFrame([(1, "Apple apple Pie, pie"), (2, "far away"), (3, None)], "doc_id long, text string")
    assert [r.ids for r in sorted(tokenstore.store_and_read(df, f.name, with_ids=True).collect(), key=lambda r: r.start)] == [[1, 2, 4, 3, 1], [70_000, 0, 1], [1]]
    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    texts = ["It's  Apples\n and apples", "É 12 x"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.ids for r in sorted(tokenstore.store_and_read(df, path, with_ids=True).collect(), key=lambda r: r.start)] == [[*t.encode(x, add_special_tokens=False).ids, 1] for x in texts]
