"""Operators 3 and 7 against brute force."""

import hashlib
import random

import xxhash
from pyspark.sql import functions as F

from voxlake.llm import repeats, shingles, simhash


def brute_repeats(docs, width=100):
    seen, out = {}, {}
    for doc, text in sorted(docs, key=lambda x: x[0]):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - width + 1):
            if data[i : i + width] in seen:
                gone[i : i + width] = b"\1" * width
            else:
                seen[data[i : i + width]] = 1
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[doc] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def brute_fp(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hs = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_shingles(text, words=5):
    found = "".join(c.lower() if c.isascii() else c for c in text or "").translate(str.maketrans("\t\n\v\f\r", "     ")).split(" ")
    found = [w for w in found if w]
    return {tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1))} if found else set()


def brute_parts(ids, fps, bits=2, sets=None):
    """Components of fingerprints, and with sets those of pairs of a Jaccard similarity of at least 0.8 too."""
    part = {i: i for i in ids}

    def root(i):
        while part[i] != i:
            i = part[i]
        return i

    for a, x in enumerate(fps):
        for b in range(a):
            near = sets and sets[a] and sets[b] and min(len(sets[a]), len(sets[b])) * 5 >= max(len(sets[a]), len(sets[b])) * 4 and len(sets[a] & sets[b]) * 5 >= len(sets[a] | sets[b]) * 4
            if near or (x ^ fps[b]).bit_count() <= bits:
                i, j = sorted((root(ids[a]), root(ids[b])))
                part[j] = i
    return {i: root(i) for i in ids}


def check_repeats(spark, rows, parts=5):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.remove_repeats(df).collect()}
    assert got == brute_repeats(rows)


def test_repeats_fixture(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9)))
    passage = " ".join(word() for _ in range(60))
    rows = [(0, None), (1, ""), (2, "x" * 99), (3, "x" * 100), (4, "x" * 101), (5, "x" * 450), (6, "ab" * 300), (7, "y" + "ab" * 200)]
    for i in range(8, 60):
        text = " ".join(word() for _ in range(rng.randint(1, 120)))
        if i % 3 == 0:
            cut = rng.randint(0, 120)
            text += passage[cut : cut + rng.randint(90, 200)] + " ".join(word() for _ in range(30))
        rows.append((i, text))
    rows += [(100 + i, rows[20 + i][1]) for i in range(8)] + [(200, passage + passage + "q" + passage[:130])]
    rows += [(300 + i, rows[30][1][:60] + chr(97 + i) + rows[30][1][60:]) for i in range(12)]
    check_repeats(spark, rows)
    check_repeats(spark, rows, 1)


def test_cuts_through_characters(spark):
    line = "ä" * 49 + "é" + "b" + "ü" * 30
    rows = [(1, line + "x"), (2, "q" + line.encode()[1:].decode("utf-8", "ignore") + "y"), (3, "é" + "ã" * 49 + "x"), (4, "ê" + "ã" * 49 + "z")]
    check_repeats(spark, rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id: r.kept for r in repeats.remove_repeats(df).collect()}
    assert kept[1] == rows[0][1] and all("�" not in k for k in kept.values())


def test_repeats_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    check_repeats(spark, [tuple(r) for r in docs.collect()], 7)


def test_repeats_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, s int, n int, kept string")
    assert repeats.remove_repeats(empty).count() == 0
    odd = spark.createDataFrame([(None, "z" * 300, 1), (1, "z" * 99, 2), (1, "z" * 99, 3)], "doc_id long, text string, n_bytes int")
    assert sorted(r.n_removed for r in repeats.remove_repeats(odd).collect()) == [0, 0, 0]


def test_repeats_of_one_id(spark):
    """Rows of one id, with equal and with different texts, are documents of their own in text order."""
    rng = random.Random(6)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    a, b, c = text(400), text(900), text(250)
    rows = [(5, a), (5, a), (3, b), (3, b[:300] + c), (4, b[100:260] + a[:150]), (3, None), (6, c[:120]), (None, a)]
    rows += [(7, text(2000)), (7, a[:200] + text(101)), (8, "x" * 100)]
    ranked = sorted(((i, t) for i, t in rows if i is not None), key=lambda r: (r[0], r[1] or ""))
    want = [(ranked[k][0], *v) for k, v in brute_repeats([(k, t) for k, (_, t) in enumerate(ranked)]).items()]
    for parts in (1, 4):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        got = [tuple(r)[:5] for r in repeats.remove_repeats(df).collect()]
        assert sorted(r for r in got if r[0] is not None) == sorted(want)
        assert [r[1:4] for r in got if r[0] is None] == [(400, 0, 0)]


def test_repeats_stage_of_one_id(spark):
    import corpus_pipeline

    a, b = "".join(map(str, range(500, 550))), "".join(map(str, range(90)))
    rows = [(1, a, "en", "p", 150), (1, b, "de", "q", 170), (2, a, "fr", "r", 150), (3, b + "tail", "es", "s", 174), (None, None, "en", "t", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {tuple(r) for r in corpus_pipeline.unrepeated_text(spark, docs, "").collect()}
    assert got == {*rows[:2], (3, "tail", "es", "s", 4), rows[4]}


def test_simhash_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    fps = [brute_fp(r.text) for r in rows]
    parts = brute_parts([r.doc_id for r in rows], fps)
    for dense in (simhash.DENSE, 1):
        got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs, dense=dense).collect()}
        assert got == {r.doc_id: (f"{fp:016x}", parts[r.doc_id]) for r, fp in zip(rows, fps)}


def test_simhash_odd(spark):
    rows = [(5, None), (4, ""), (3, "\t \n"), (7, "A b"), (8, "a  B"), (9, "a b c"), (None, "q r s t"), (7, "A b")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("clash"))
    got = sorted((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(df).collect() if r.doc_id is not None)
    fp = f"{brute_fp('a b'):016x}"
    assert got[:3] == [(i, "0" * 16, 3) for i in (3, 4, 5)]
    assert got[3:6] == [(7, fp, 7), (7, fp, 7), (8, fp, 7)]
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_simhash_dense_links(spark):
    rng = random.Random(1)
    base = rng.getrandbits(63)
    fps = sorted({base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(300)} | {rng.getrandbits(64) for _ in range(50)})
    rows = [(fp - (1 << 64) if fp >> 63 else fp, i) for i, fp in enumerate(fps)]
    from voxlake.operators.graph import connected_components

    for dense in (4, 64):
        e = simhash.links(spark.createDataFrame(rows, "fp long, rep long"), dense)
        got = {r.node: r.component for r in connected_components(e).collect()}
        want = brute_parts(list(range(len(fps))), fps)
        assert {i: got.get(i, i) for i in want} == want


def edited(rng, text, times, vocabulary):
    words = text.split()
    for _ in range(times):
        words[rng.randrange(len(words))] = rng.choice(vocabulary)
    return " ".join(words)


def test_similar_texts(spark):
    """Components of both kinds of links equal brute force, with chains of edits, groups of near copies, shared passages, short and odd texts."""
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(3000)]
    draw = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passages = [draw(30) for _ in range(4)]
    texts = [draw(rng.randint(20, 120)) for _ in range(60)]
    for base in texts[:20]:  # chains: each link is near the threshold
        for _ in range(4):
            base = edited(rng, base, rng.randint(1, 3), vocabulary)
            texts.append(base)
    hub = draw(100)
    texts += [edited(rng, hub, rng.randint(0, 3), vocabulary) for _ in range(120)]
    texts += [" ".join(rng.sample(passages, 3)) + " " + draw(rng.randint(0, 12)) for _ in range(60)]
    texts += [draw(n) for n in (1, 2, 3, 4, 5, 6) for _ in range(2)] + ["one two", "ONE\ttwo", None, "", texts[3], texts[3].upper()]
    rng.shuffle(texts)
    rows = list(enumerate(texts)) + [(None, hub)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as fp", "2 as rep", "3 as key", "4 as n").repartition(6)
    ids = [i for i, _ in rows[:-1]]
    fps, sets = [brute_fp(t) for t in texts], [brute_shingles(t) for t in texts]
    want = brute_parts(ids, fps, sets=sets)
    assert len(set(want.values())) < len(set(brute_parts(ids, fps).values())) - 20  # many links lie beyond two bits
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(df, similarity=0.8).collect()}
    assert got.pop(None) is None and got == want
    assert simhash.near_duplicates(df.limit(0), similarity=0.8).count() == 0


def test_prefixes():
    assert [shingles.prefix_length(n) for n in (1, 4, 5, 6, 10, 100)] == [1, 1, 2, 2, 3, 21]
    assert shingles.shingle_set(b" \t\n").size == 0 and shingles.shingle_set(b"A b").size == 1
    assert (shingles.shingle_set(b"A b c\x0bd e F") == shingles.shingle_set(b"a B c d e f")).all()


def test_similar_texts_of_one_id(spark):
    """Rows that repeat a doc_id are one node: 1 and 3 meet over the two texts of 2."""
    a, b = (" ".join(f"{p}{i}" for i in range(40)) for p in "ab")
    df = spark.createDataFrame([(1, a), (2, a + " end"), (2, b + " end"), (3, b), (4, "else")], "doc_id long, text string")
    got = sorted((r.doc_id, r.component_id) for r in simhash.near_duplicates(df, similarity=0.8).collect())
    assert got == [(1, 1), (2, 1), (2, 1), (3, 1), (4, 4)]
