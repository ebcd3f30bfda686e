"""Operator 11 against its DuckDB oracle and plain comparison of all pairs."""

import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from oracle import connect, differences

from voxlake.llm import queries
from voxlake.llm import spellings as S

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[i + (len(a) >= len(b)) :] == b[i + (len(b) >= len(a)) :]


def brute(docs, shortest=5, least=3, typed=97):
    c = Counter()
    for doc, text in docs:
        for w in re.findall("[A-Za-z\u00C0-\u00FF]+", (text or "").translate(LOWER)):
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if h % typed == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            c[w] += 1
    c = {w: n for w, n in c.items() if n >= least and len(w) >= shortest}
    out = {}
    for w, n in c.items():
        others = [x for x in c if near(w, x)]
        best = min(others, key=lambda x: (-c[x], x), default=None)
        out[w] = (best if best is not None and c[best] >= 2 * n else None, n, len(others))
    rows = []
    for w, (form, n, k) in out.items():
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        rows.append((w, form, root, n, k, c[form] if form is not None else None))
    return sorted(rows)


def run(df, **k):
    return sorted(tuple(r) for r in S.variants(df, **k).collect())


def texts(seed, n, alphabet="abé", longest=9):
    rng = random.Random(seed)
    return [(i, " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(3, longest))) for _ in range(rng.randint(0, 80)))) for i in range(n)]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_oracle(spark, sf):
    sf_dir = f"/root/testdata/{sf}"
    assert differences(spark, connect(sf_dir), "op11", queries.op11_spelling_variants, S.ORACLE, sf_dir) is None


@pytest.mark.parametrize("longest, share", [(2, 150), (2, 3), (3, 8), (5, 40)])
def test_brute_force(spark, longest, share):
    rows = [*texts(1, 160), *texts(2, 60, "abcdeÿÀÉABC", 7), (None, "Naïve naïve NAÏVE naive naive naive naive naives naives naives"), (7, None), (8, ""), (9, "×÷×÷× ×÷×÷× ×÷×÷×")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n long, word string").repartition(4)
    want = brute(rows, typed=5)
    assert len(want) > 90 and any(r[1] for r in want) and run(df, typed=5, longest=longest, share=share) == want


def test_chains_ties_and_repeats(spark):
    """A chain of forms, equal n on both sides, and a form that is itself a variant."""
    counts = {"abcde": 3, "abcdf": 6, "abcgf": 12, "abhgf": 24, "aihgf": 48, "xxxxx": 5, "xxxxy": 10, "xxxxz": 10, "zzzzzz": 4, "zzzzz": 7}
    rows = [(1, " ".join([w] * n)) for w, n in counts.items()] + [(2, "ab ab ab ab")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r[0]: r for r in run(df, typed=10**9 + 7)}
    assert got["abcde"][1:3] == ("abcdf", "aihgf") and got["xxxxx"][1] == "xxxxy" and got["zzzzzz"][1] is None and got["zzzzz"][4] == 1
    assert sorted(got.values()) == brute(rows, typed=10**9 + 7)


def test_long_words_and_empty_tables(spark):
    long = "".join(random.Random(1).choice("abcdefgh") for _ in range(60_000))
    other = long[:30_000] + "z" + long[30_001:]
    df = spark.createDataFrame([(1, f"{long} {long} {long} {other} {other} {other} {other} {other} {other}"), (2, None)], "doc_id long, text string")
    got = run(df, typed=10**9 + 7)
    assert [(r[0] == long, r[1] == other, r[2] == other, r[3], r[4]) for r in got] == [(True, True, True, 3, 1), (False, False, True, 6, 1)] or got[0][0] == other and got[1][1] == other
    assert run(df.limit(0)) == [] and run(spark.createDataFrame([(1, None)], "doc_id long, text string")) == []


def test_every_edit_meets():
    """Of random words and their edits, each pair shares a key, whatever the dictionary."""
    rng = random.Random(5)
    for longest, share in ((2, 3), (3, 2), (4, 9)):
        letters = "abcé"
        common = ["".join(rng.choice(letters) for _ in range(rng.randint(1, longest - 1))) for _ in range(share)]
        grams = S.Grams(common, longest)
        words = []
        for _ in range(300):
            w = "".join(rng.choice(letters) for _ in range(rng.randint(5, 14)))
            i = rng.randrange(len(w) + 1)
            words += [w, rng.choice([w[:i] + "b" + w[i:], w[: max(i - 1, 0)] + "c" + w[max(i, 1) :], w[: max(i - 1, 0)] + w[max(i, 1) :]])]
        word, key, begin, end = S.surviving(*S.padded_codes(pa.array(words)), grams)
        assert (end - begin).max() <= 2 * longest
        sets = [set() for _ in words]
        for w, k in zip(word.tolist(), key.tolist()):
            sets[w].add(k)
        assert all(sets[i] & sets[i + 1] for i in range(0, len(words), 2))
