"""W6 by content: far shifts, several bricks, peaks between voxels."""

import numpy as np
import pytest

from voxlake.operators import registration as R
from voxlake.operators import windows as W


def frames(spark, volumes):
    rows = [(image, t, *map(int, c), float(v)) for (image, t), a in volumes.items() for c, v in zip(np.argwhere(~np.isnan(a)), a[~np.isnan(a)])]
    return spark.createDataFrame(rows, "image_id long, t int, z int, y int, x int, v double")


def test_scores_are_sums_of_products():
    rng = np.random.default_rng(1)
    late, early = (np.unique(rng.integers(0, 9, (60, 3)), axis=0) for _ in range(2))
    v, w = rng.normal(size=len(late)), rng.normal(size=len(early))
    score, pairs = R.correlation((late, v), (early, w), (1, 2, 3))
    for s in np.ndindex(3, 5, 7):
        d = np.array(s) - (1, 2, 3)
        hit = [(a, b) for a, p in zip(v, late) for b, q in zip(w, early) if (q == p + d).all()]
        assert pairs[s] == len(hit) and score[s] == pytest.approx(sum(a * b for a, b in hit), abs=1e-9)


def test_far_shifts_in_bricks(spark):
    rng = np.random.default_rng(2)
    scene = rng.random((60, 80, 90))
    cut = lambda z, y, x: scene[20 + z : 28 + z, 30 + y : 50 + y, 30 + x : 55 + x]
    df = frames(spark, {(1, 0): cut(0, 0, 0), (1, 1): cut(2, -9, 11), (1, 2): cut(-1, -9, 8), (2, 0): cut(0, 0, 0)})
    want = {(1, 0): (0, 0, 0), (1, 1): (2, -9, 11), (1, 2): (-1, -9, 8), (2, 0): (0, 0, 0)}
    assert {(r.image_id, r.t): (r.shift_z, r.shift_y, r.shift_x) for r in W.chain_shift_by_content(df, "v", (4, 12, 16)).collect()} == want
    small = R.chain(df, R.best_shifts(df, "v", (4, 12, 16), block={"z": 4, "y": 8, "x": 16}))
    assert {(r.image_id, r.t): (r.shift_z, r.shift_y, r.shift_x) for r in small.collect()} == want


def test_peak_between_voxels(spark):
    z, y, x = np.meshgrid(np.arange(9), np.arange(40), np.arange(40), indexing="ij")
    blob = lambda cy, cx: np.exp(-((z - 4) ** 2 + (y - cy) ** 2 + (x - cx) ** 2) / 18)
    df = frames(spark, {(1, 0): blob(20, 20), (1, 1): blob(18.7, 22.4)})
    got = {r.t: r for r in W.chain_shift_by_content(df, "v", (1, 5, 5), between=True).collect()}
    assert abs(got[1].shift_z) < 0.05 and abs(got[1].shift_y - 1.3) < 0.1 and abs(got[1].shift_x + 2.4) < 0.1
    assert W.chain_shift_by_content(df.limit(0), "v", (1, 1, 1)).collect() == []
