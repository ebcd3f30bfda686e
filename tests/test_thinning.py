"""G9 against a plain sequential version, for images of one and of many bricks."""

from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F  # noqa: F401

from voxlake.operators import iterative as G
from voxlake.operators.projections import VK

CUBE = [d for d in product((-1, 0, 1), repeat=3) if any(d)]
SIDES = [(0, -1, 0), (0, 1, 0), (0, 0, 1), (0, 0, -1), (1, 0, 0), (-1, 0, 0)]


def pieces(cells):
    left, n = set(cells), 0
    while left:
        n, stack = n + 1, [left.pop()]
        while stack:
            a = stack.pop()
            near = {b for b in left if max(abs(p - q) for p, q in zip(a, b)) == 1}
            left -= near
            stack += near
    return n


def euler(cells):
    """Of the union of closed unit cubes: corners - edges + faces - cubes, counted one by one."""
    parts = {(2 * z + i, 2 * y + j, 2 * x + k) for z, y, x in cells for i, j, k in product((-1, 0, 1), repeat=3)}
    return sum((-1) ** sum(c % 2 == 0 for c in p) for p in parts)


def brute(cells):
    alive = set(cells)
    around = lambda v: {d for d in CUBE if (v[0] + d[0], v[1] + d[1], v[2] + d[2]) in alive}
    quiet = 0
    while quiet < 6:
        for s in SIDES:
            found = []
            for v in sorted(alive):
                if (v[0] + s[0], v[1] + s[1], v[2] + s[2]) in alive:
                    continue
                near = around(v)
                if len(near) != 1 and euler(near | {(0, 0, 0)}) == euler(near) and pieces(near) <= 1:
                    found.append(v)
            gone = 0
            for v in found:
                if pieces(around(v)) <= 1:
                    alive.discard(v)
                    gone += 1
            quiet = 0 if gone else quiet + 1
            if quiet == 6:
                break
    return alive


@pytest.mark.parametrize("density", [0.45, 0.8])
def test_random_volumes(spark, density):
    rng = np.random.default_rng(int(density * 100))
    images = {i: [tuple(c) for c in np.argwhere(rng.random((7, 9, 10)) < density).tolist()] for i in range(3)}
    images[3] = [(z, y, x) for z in range(5) for y in range(7) for x in range(12)]
    df = spark.createDataFrame([(i, 0, *c) for i, cells in images.items() for c in cells], "image_id long, t int, z int, y int, x int")
    want = sorted((i, *c) for i, cells in images.items() for c in brute(cells))
    assert sorted((r.image_id, r.z, r.y, r.x) for r in G.thin(df).collect()) == want
    some = df.where("image_id in (0, 3)") if density > 0.5 else df.where("image_id = 1")
    bricks = sorted((r.image_id, r.z, r.y, r.x) for r in G.thin(some, (4, 5, 6)).collect())
    assert bricks == [w for w in want if w[0] in ((0, 3) if density > 0.5 else (1,))]


def test_tables_by_rule():
    rng = np.random.default_rng(1)
    for code in rng.integers(0, 1 << 26, 300).tolist() + [0, 1, (1 << 26) - 1]:
        near = {d for i, d in enumerate(CUBE) if code >> i & 1}
        assert G.euler_kept(np.array([code]))[0] == (euler(near | {(0, 0, 0)}) == euler(near))
        assert G.in_one_piece(np.array([code]))[0] == (pieces(near) <= 1)


def test_repeated_voxels_and_nothing(spark):
    df = spark.createDataFrame([(1, 0, 0, 0, x) for x in range(4)] * 2, "image_id long, t int, z int, y int, x int")
    assert sorted(r.x for r in G.thin(df).collect()) == [0, 1, 2, 3]
    assert G.thin(df.limit(0)).select(*VK).collect() == []
