"""Operator 8: exact neighbours, brute force of the whole operator, held-out accuracy, odd tables."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from voxlake.llm import toxicity


def test_nearest_is_exact():
    rng = random.Random(2)
    pats = list({tuple(sorted({(rng.randrange(30), rng.randint(1, 3)) for _ in range(rng.randint(0, 5))})) for _ in range(700)})
    pats = [p for p in pats if len({t for t, _ in p}) == len(p)]
    index = toxicity.Index(np.linspace(1, 4, 30), pats, np.ones((len(pats), 2)), np.arange(len(pats)))
    dense = np.zeros((len(pats), 31))
    for p, at in index.place.items():
        t, w = index.vector(p)
        dense[at, t] = w
    for p in pats[:60] + [((3, 9),), ()]:
        t, w = index.vector(p)
        cos = dense[:, t] @ w
        who, got = index.nearest([p], 16)[0]
        assert np.allclose(np.sort(cos)[::-1][:16], got[:16])
        assert np.allclose(cos[who], got)


def test_nearest_in_many_blocks():
    rng = random.Random(3)
    zipf = [min(int(rng.paretovariate(0.7)), 400) - 1 for _ in range(90_000)]
    pats = list({tuple(sorted(Counter(rng.choices(zipf, k=rng.randint(1, 25))).items())) for _ in range(3000)})
    index = toxicity.Index(np.linspace(1, 6, 400), pats, np.ones((len(pats), 2)), np.arange(len(pats)))
    dense = np.zeros((len(pats), 401))
    for p, at in index.place.items():
        t, w = index.vector(p)
        dense[at, t] = w
    asked = [*pats[:300], ((399, 1),), ()]
    for p, (who, got) in zip(asked, index.nearest(asked, 16), strict=True):
        t, w = index.vector(p)
        assert np.allclose(np.sort(dense[:, t] @ w)[::-1][:17], got) and np.allclose((dense[:, t] @ w)[who], got)


def brute(docs, labels, least, k=16, bins=20):
    """Scores by all cosines, from the definition."""

    def bag(text):
        out = Counter()
        for w in re.findall(r"[^\W\d_]+", text.lower()):
            out.update([w, *(f"^{w[:n]}" for n in (4, 5) if len(w) >= n)])
        return out

    shown = [(bag(t), labels[i]) for i, t in docs if i in labels and zlib.crc32(str(i).encode()) % 4 != 2]
    n, one = len(shown), sum(y for _, y in shown)
    df, hot = Counter(w for b, _ in shown for w in b), Counter(w for b, y in shown if y for w in b)
    x = lambda v: v * math.log(v) if v > 0 else 0.0
    llr = lambda a, c: 2 * (x(a) + x(c) + x(one - a) + x(n - one - c) - x(a + c) - x(n - a - c) - x(one) - x(n - one) + x(n))
    vocabulary = {w for w in df if llr(hot[w], df[w] - hot[w]) >= least}

    def vector(b):
        v = {w: (1 + math.log(c)) * (math.log((n + 1) / (df[w] + 1)) + 1) for w, c in b.items() if w in vocabulary} | {"": 1.0}
        norm = math.sqrt(sum(z * z for z in v.values()))
        return {w: z / norm for w, z in v.items()}

    groups = {}
    for b, y in shown:
        key = tuple(sorted((w, c) for w, c in b.items() if w in vocabulary))
        groups.setdefault(key, [vector(b), [0, 0]])[1][y] += 1

    def vote(b, leave=None):
        key, v = tuple(sorted((w, c) for w, c in b.items() if w in vocabulary)), vector(b)
        near = []
        for other, (u, counts) in groups.items():
            counts = [c - (other == key and y == leave) for y, c in enumerate(counts)]
            if sum(counts):
                near.append((sum(z * u.get(w, 0) for w, z in v.items()), counts))
        near.sort(key=lambda r: -r[0])
        tied = len(near) > k and abs(near[k - 1][0] - near[k][0]) < 1e-9
        weight = [[c / (1 - min(cos, 1) + 0.05) for c in counts] for cos, counts in near[:k]]
        return sum(w[1] for w in weight) / sum(map(sum, weight)), tied

    hits, seen, ties = [(i + 0.5) / bins for i in range(bins)], [1.0] * bins, 0
    for b, y in shown:
        v, tied = vote(b, y)
        ties += tied
        at = min(bins - 1, int(v * bins))
        seen[at] += 1
        hits[at] += y
    pools = [[h, m, 1] for h, m in zip(hits, seen)]
    while any(a[0] / a[1] > b[0] / b[1] + 1e-12 for a, b in zip(pools, pools[1:])):
        i = next(i for i, (a, b) in enumerate(zip(pools, pools[1:])) if a[0] / a[1] > b[0] / b[1] + 1e-12)
        pools[i : i + 2] = [[p + q for p, q in zip(pools[i], pools[i + 1])]]
    shares = [h / m for h, m, c in pools for _ in range(c)]
    out = {}
    for i, t in docs:
        v, tied = vote(bag(t))
        out[i] = (float(np.interp(v, [(j + 0.5) / bins for j in range(bins)], shares)), tied)
    return out, ties


def test_against_brute_force(spark):
    rng = random.Random(12)
    words = ["".join(rng.choice("abdefgilmnoprstu") for _ in range(rng.randint(3, 8))) for _ in range(60)]
    bad, good = words[:6], words[6:14]
    docs, labels = [], {}
    for i in range(240):
        y = int(rng.random() < 0.4)
        text = [rng.choice(words[14:]) for _ in range(rng.randint(5, 40))] + [rng.choice(bad if y else good) for _ in range(rng.randint(0, 4))]
        rng.shuffle(text)
        docs.append((i, " ".join(text)))
        if i % 5:
            labels[i] = y if rng.random() < 0.93 else 1 - y
    want, ties = brute(docs, labels, 5.0)
    assert ties == 0  # at the 16th neighbour
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.score for r in toxicity.toxicity(d, spark.createDataFrame(list(labels.items()), "doc_id long, toxic int"), least=5.0).collect()}
    assert set(got) == set(want) and len(set(map(str, got.values()))) > 20
    assert all(abs(got[i] - s) < 1e-9 for i, (s, tied) in want.items() if not tied) and sum(t for _, t in want.values()) < 20


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    rows = toxicity.toxicity(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50
    assert np.mean([r.predicted == r.toxic for r in rows]) >= 0.9
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "scum scum"), (4, "fine words"), (4, "fine words")], "doc_id long, text string").selectExpr("*", "1 as score", "0 as toxic")
    labels = spark.createDataFrame([(1, 0), (2, None), (None, 1), (4, 1), (4, 0)], "doc_id long, toxic int")
    rows = toxicity.toxicity(docs, labels).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    assert [r.score for r in toxicity.toxicity(docs, labels.limit(0)).collect()] == [0.0] * 5
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0
