"""Operator 2 against brute force."""

import math

import numpy as np

from voxlake.llm import embeddings


def brute(rows, cosine=0.98):
    good = [(i, np.array(v, float), lab) for i, v, lab in rows if lab is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)]
    part = {i: i for i, *_ in rows}
    links = dict.fromkeys(part, 0)

    def root(i):
        while part[i] != i:
            i = part[i]
        return i

    for a, (i, x, p) in enumerate(good):
        for j, y, q in good[:a]:
            if p == q and len(x) == len(y) and x @ y / math.sqrt((x @ x) * (y @ y)) >= cosine:
                links[i] += 1
                links[j] += 1
                r, s = sorted((root(i), root(j)))
                part[s] = r
    return {i: (links[i], root(i), root(i) == i) for i in part}


def run(df, **k):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(df, **k).collect()}


def test_table(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    assert run(df) == brute([(r.vec_id, r.embedding, r.label) for r in df.collect()])


def test_clusters_and_odd_rows(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(6, 20))
    rows = [(i, (base[i % 6] + rng.normal(size=20) * (0.02 + 0.15 * (i % 4))).tolist(), i % 2) for i in range(160)]
    rows += [(200 + i, rows[3][1], 1) for i in range(20)] + [(230, rows[3][1], None), (231, None, 1), (232, [], 1), (233, [0.0] * 20, 1), (234, [float("nan")] * 20, 1), (235, [None] * 20, 1), (236, rows[3][1][:7], 1), (237, rows[3][1][:7], 1), (238, [x * 1e150 for x in rows[3][1]], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    want = brute([(i, v if i != 238 else rows[3][1], lab) for i, v, lab in rows])
    assert run(df) == want
    assert run(df, limit=7, axes=3) == want
    assert run(df, limit=1, axes=0) == want
    assert run(df, limit=5, cell=3, sample=0) == want
    assert run(df.union(df), axes=2) == want
    assert run(df.limit(0)) == {}


def test_dense_groups(spark):
    """Clusters that are counted whole, that touch each other, and stragglers around them."""
    rng = np.random.default_rng(11)
    centre = rng.normal(size=(3, 24))
    centre[1] = centre[0] + 0.12 * rng.normal(size=24)
    spread = (0.03, 0.05, 0.08, 0.1, 0.14, 0.18)
    rows = [(i, (centre[i % 3] + spread[i % 6] * rng.normal(size=24)).tolist(), 0 if i % 5 else 1) for i in range(420)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    want = brute(rows)
    assert len(embeddings.centres([(r[2], r[1]) for r in rows], 0.98)) == 2
    assert run(df) == want
    assert run(df, limit=16, cell=20) == want
    assert run(df, limit=16, cell=20, axes=2, sample=0) == want
    assert run(df, sample=0, limit=1000, cell=30) == want
    extra = df.selectExpr("*", "label as block", "vec_id as rep", "vec_id as n", "label as guest", "label as cluster")
    assert run(extra) == want


def test_boxes_prune():
    """Random unit vectors, which have no near pair, are the worst case of a cell: of 100,000 few pairs are compared in a block; none within the budget is missed."""
    rng = np.random.default_rng(3)
    share = {}
    for n in (10_000, 100_000):
        u = rng.normal(size=(n, 64))
        x = (u / np.linalg.norm(u, axis=1, keepdims=True))[:, :8].astype(np.float32)
        rows = np.arange(n)
        reach = embeddings.Reach(x, rows, np.float32(embeddings._budget(0.98, 64, 8)[0]))
        home = embeddings.boxes(x, rows, embeddings.LEAF)
        assert sorted(np.concatenate(home).tolist()) == rows.tolist() and max(map(len, home)) <= embeddings.LEAF
        some = home[:: 1 + n // 10_000]
        share[n] = sum(len(a) * len(reach.of(a)) for a in some) / sum(map(len, some)) / n
        for a in home[::50]:
            near = ((x[a][:, None].astype(float) - x[None, :2000]) ** 2).sum(axis=2) <= embeddings._budget(0.98, 64, 8)[0]
            assert set(np.flatnonzero(near.any(axis=0))) <= set(reach.of(a).tolist())
    assert share[100_000] < 0.01 and share[100_000] < share[10_000] / 2, share
