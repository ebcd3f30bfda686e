"""Operator 12 against its DuckDB oracle and plain counting."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from oracle import connect, differences

from voxlake.llm import collocations as C
from voxlake.llm import queries

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def brute(docs, longest=3, least=10, top=2000, share=50):
    f, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, longest + 1):
                f[lang].update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, own in f.items():
        found = []
        candidates = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        for p, a in candidates.items():
            if any(100 * b >= share * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in candidates.items() if len(q) > len(p)):
                continue
            score, k = min((1_000_000 * a * a // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def run(df, **k):
    return sorted(tuple(r) for r in C.collocations(df, **k).collect())


def texts(seed, n, vocabulary=9):
    rng = random.Random(seed)
    words = ["A", "b", "É", "é", "x-y", "東京", "don't", "(c)", "the"][:vocabulary]
    return [(rng.choice(["en", "de", None, "und"]), "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ". ", "\n", ",", "\x0b", "\xa0"]) for _ in range(rng.randint(0, 60)))) for _ in range(n)]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_oracle(spark, sf):
    sf_dir = f"/root/testdata/{sf}"
    assert differences(spark, connect(sf_dir), "op12", queries.op12_phrase_collocations, C.ORACLE, sf_dir) is None


def test_brute_force(spark):
    rows = [*texts(1, 900), (None, None), ("en", ""), ("fr", " .,\n")]
    df = spark.createDataFrame([(i, *r, 1, "x") for i, r in enumerate(rows)], "doc_id long, lang string, text string, n long, phrase string").repartition(5)
    want = brute(rows)
    assert len(want) > 50 and run(df) == want
    assert run(df, size=40, most_bits=16) == want  # blocks within texts
    assert run(df, longest=5, least=4, top=40, share=80) == brute(rows, 5, 4, 40, 80)  # ties at the end of the list
    assert run(df, least=1) == brute(rows, least=1)


def test_full_bitmap_and_repeats(spark):
    """A bitmap that lets everything pass changes nothing; repeated rows count again; one hot phrase."""
    rows = [*texts(2, 40, 4), *[("en", "a b the")] * 3000]
    df = spark.createDataFrame(rows, "lang string, text string")
    assert run(df, most_bits=16) == brute(rows)
    with_all = lambda docs, least, size, bits: (16, b"\xff" * (1 << 13))
    kept, C.common_pairs = C.common_pairs, with_all
    try:
        assert run(df) == brute(rows)
    finally:
        C.common_pairs = kept


def test_empty_tables(spark):
    df = spark.createDataFrame([(None, None)], "lang string, text string")
    assert run(df) == [] and run(df.limit(0)) == []


def test_large_counts_are_exact(spark):
    """Products beyond 64 bits: the score's decimals against Python integers."""
    rng = random.Random(7)
    for _ in range(20):
        a = rng.randint(1, 10**14)
        l, r = a + rng.randint(0, 10**14), a + rng.randint(0, 10**13)
        got = spark.sql(f"select (cast(1000000 as decimal(7,0)) * cast({a}L as decimal(20,0)) * cast({a}L as decimal(20,0))) div (cast({l}L as decimal(20,0)) * cast({r}L as decimal(20,0))) as s").first().s
        assert got == 1_000_000 * a * a // (l * r)


def test_index():
    """Every interval of the bidirectional index, to depth 4, by left and by right extension."""
    rng = np.random.default_rng(4)
    for n in (3, 6):
        s = np.append(rng.integers(0, n, 300), 0)
        s = s[np.append(True, (s[1:] != 0) | (s[:-1] != 0))]
        want = Counter(tuple(s[i : i + m]) for m in range(1, 5) for i in range(len(s) - m + 1) if (s[i : i + m] > 0).all())
        index = C.ShardIndex(s, n, 4)
        for extend, join in ((index.left, lambda p, c: (c, *p)), (index.right, lambda p, c: (*p, c))):
            begin, back, size = index.words()
            phrases = [(c,) for c in range(1, n)]
            for _ in range(4):
                assert {p: c for p, c in zip(phrases, size.tolist()) if c} == {p: c for p, c in want.items() if len(p) == len(phrases[0])}
                parent, symbol, begin, back, size = extend(begin, back, size)
                phrases = [join(phrases[p], c) for p, c in zip(parent.tolist(), symbol.tolist())]
        mixed = {}
        for phrases, size in C.ngrams(index, 4, lambda a, b: np.ones(len(a), bool)):
            mixed.update(zip(map(tuple, phrases.tolist()), size.tolist()))
        assert mixed == {p: c for p, c in want.items() if len(p) > 1}
