"""Dense bricks and whole lines against plain loops: distances, kernels, running minima, rolling balls, hulls of parts."""

import math
from fractions import Fraction
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxlake.operators import aggregates as A
from voxlake.operators import dense as D
from voxlake.operators import filters as L
from voxlake.operators import joins as J
from voxlake.operators.hulls import convex_hull
from voxlake.operators.projections import VK


def volume(spark, cells, image=1):
    return spark.createDataFrame([(image, 0, *map(int, c)) for c in cells], "image_id long, t int, z int, y int, x int")


@pytest.mark.parametrize("seed", range(4))
def test_envelope(seed):
    rng = np.random.default_rng(seed)
    s, q = np.sort(rng.choice(60, 25, replace=False)) * 1.5, np.sort(rng.choice(80, 40, replace=False)) * 1.5
    f = rng.integers(0, 900, (25, 7)).astype(float)
    f[rng.random(f.shape) < 0.4] = np.inf
    f[:, 3] = np.inf
    want = (f[:, None, :] + (q[None, :, None] - s[:, None, None]) ** 2).min(0)
    assert np.allclose(D.envelope(f, s, q), want, rtol=1e-12)


@pytest.mark.parametrize("sampling", [(1.0, 1.0, 1.0), (3.0, 0.5, 1.0)])
def test_distance_beyond_tiles(spark, sampling):
    """Several images, one without targets, coordinates below 0, ties, repeated rows; tiles of 4 and of 32 columns."""
    rng = np.random.default_rng(2)
    rows, aims = [], []
    for image in (1, 2, 3):
        for c in rng.integers((-3, -20, -30), (9, 40, 60), (120, 3)).tolist():
            rows.append((image, image % 2, *c))
        if image != 2:
            aims += [(image, image % 2, *c) for c in rng.integers((-3, -20, -30), (9, 40, 60), (4 + 30 * (image == 3), 3)).tolist()]
    vox = spark.createDataFrame(rows + rows[:3], "image_id long, t int, z int, y int, x int").withColumn("d2", F.lit(7)).withColumn("xb", F.lit("x"))
    targets = spark.createDataFrame(aims + aims[:2], "image_id long, t int, z int, y int, x int")

    def least(r):
        found = [sum(((a - b) * s) ** 2 for a, b, s in zip(r[2:], c[2:], sampling)) for c in aims if c[:2] == r[:2]]
        return round(math.sqrt(min(found)), 9) if found else None

    want = sorted(((*r, least(r)) for r in rows + rows[:3]), key=repr)
    for got in (D.line_distance(vox, targets, sampling, 4), J.distance_to(vox, targets, sampling=sampling)):
        assert sorted(((*[r[c] for c in VK], None if r.distance is None else round(r.distance, 9)) for r in got.collect()), key=repr) == want
    assert D.line_distance(vox, targets.limit(0)).where("distance is not null").isEmpty() and D.line_distance(vox.limit(0), targets).isEmpty()


def test_kernel_in_bricks(spark):
    """Small bricks with halos give what one plain sum over all voxels gives; repeated voxels add up, nulls are missing."""
    rng = np.random.default_rng(3)
    cells = np.unique(rng.integers(-4, 9, (150, 3)), axis=0)
    rows = [(1, 0, *c.tolist(), float(v)) for c, v in zip(cells, rng.random(len(cells)))]
    rows += [rows[0], (1, 0, 50, 50, 50, None)]
    df = spark.createDataFrame(rows, "image_id long, t int, z int, y int, x int, v double")
    sigma = {"z": 0.6, "y": 1.0, "x": 0.8}
    taps = [dict(L.kernel(s)) for s in sigma.values()]
    got = {tuple(r[c] for c in "zyx"): r.v for r in L.gaussian(df, "v", sigma, VK).collect()}
    blur = lambda a: [D.convolve(D.convolve(D.convolve(a[0], list(taps[0].items()), 1), list(taps[1].items()), 2), list(taps[2].items()), 3)]
    small = D.dense_map(df, ["v"], VK, {c: max(t) for c, t in zip("zyx", taps)}, blur, ["v"], block={"z": 2, "y": 3, "x": 4})
    small = {tuple(r[c] for c in "zyx"): r.v for r in small.collect()}
    for c in got:
        want = sum((r[5] or 0.0) * math.prod(t.get(a - b, 0.0) for a, b, t in zip(c, r[2:5], taps)) for r in rows)
        assert got[c] == pytest.approx(want, abs=1e-12) and small[c] == pytest.approx(want, abs=1e-12)
    assert len(got) == len(cells) + 1


def test_running_least():
    rng = np.random.default_rng(4)
    a = rng.random((3, 17, 11))
    a[rng.random(a.shape) < 0.2] = np.inf
    for radius in (0, 1, 4, 30):
        for axis in (1, 2):
            n = a.shape[axis]
            want = np.stack([a.take(range(max(0, i - radius), min(n, i + radius + 1)), axis).min(axis) for i in range(n)], axis)
            assert np.array_equal(D.running_least(a, radius, axis), want)


def test_rolling_ball(spark):
    """Against the definition on one plane with holes; a wide ball over a tilted plane leaves almost nothing, whatever its radius."""
    rng = np.random.default_rng(5)
    v = {(y, x): float(rng.integers(0, 9)) for y in range(12) for x in range(14) if rng.random() < 0.9}
    df = spark.createDataFrame([(1, y, x, h) for (y, x), h in v.items()], "image_id long, y int, x int, v double")
    keys = ["image_id", "y", "x"]
    cap, half = L.ball(4)
    cap = {(i - half, j - half): h for (i, j), h in np.ndenumerate(cap) if np.isfinite(h)}
    lift = {}
    for cy in range(-half, 12 + half):
        for cx in range(-half, 14 + half):
            under = [v[cy + i, cx + j] - h for (i, j), h in cap.items() if (cy + i, cx + j) in v]
            lift[cy, cx] = min(under, default=math.inf)
    want = {c: h - max(lift.get((c[0] - i, c[1] - j), -math.inf) + g for (i, j), g in cap.items()) for c, h in v.items()}
    got = {(r.y, r.x): r.v for r in L.subtract_background(df, "v", 4, keys, "ball").collect()}
    assert got.keys() == want.keys() and all(got[c] == pytest.approx(want[c], abs=1e-9) and got[c] >= -1e-9 for c in want)
    plane = spark.range(80 * 90).selectExpr("1L as image_id", "cast(id / 90 as int) as y", "cast(id % 90 as int) as x", "0.5 * cast(id % 90 as int) + if(id = 4000, 300, 0) as v")
    for radius in (25, 200):
        rest = {(r.y, r.x): r.v for r in L.subtract_background(plane, "v", radius, keys, "ball").collect()}
        assert len(rest) == 7200 and rest[4000 // 90, 4000 % 90] > 280 and np.median(list(rest.values())) < 0.5 * L.ball_shrink(radius) + 1


def test_flat_opening_in_bricks(spark):
    rng = np.random.default_rng(6)
    v = {(y, x): float(rng.integers(0, 50)) for y in range(20) for x in range(25) if rng.random() < 0.85}
    df = spark.createDataFrame([(1, y, x, h) for (y, x), h in v.items()], "image_id long, y int, x int, v double")
    near = lambda c, r: [(y, x) for y in range(c[0] - r, c[0] + r + 1) for x in range(c[1] - r, c[1] + r + 1) if (y, x) in v]
    low = {c: min(v[k] for k in near(c, 3)) for c in v}
    want = {c: v[c] - max(low[k] for k in near(c, 3)) for c in v}
    got = {(r.y, r.x): r.v for r in L.subtract_background(df, "v", 3, ["image_id", "y", "x"]).collect()}
    assert got == pytest.approx(want)


def brute_hull(p):
    """Six times the volume: supporting planes through three points, each with the area of its hull from sorted angles."""
    p = [tuple(map(int, q)) for q in p]
    planes = {}
    for a, b, c in combinations(p, 3):
        n = np.cross(np.subtract(b, a), np.subtract(c, a))
        if not n.any():
            continue
        side = [int(n @ np.subtract(q, a)) for q in p]
        if min(side) < 0 < max(side):
            continue
        n = -n if max(side) > 0 else n
        g = math.gcd(*map(int, n))
        planes[tuple(int(v) // g for v in n)] = [q for q, s in zip(p, side) if s == 0]
    total = Fraction(0)
    inner = [Fraction(sum(q[k] for q in p), len(p)) for k in range(3)]
    for n, pts in planes.items():
        k = max(range(3), key=lambda i: abs(n[i]))
        flat = sorted((q[(k + 1) % 3], q[(k + 2) % 3], q) for q in pts)
        chain = []
        for order in (flat, flat[::-1]):
            part = []
            for q in order:
                while len(part) > 1 and (part[-1][0] - part[-2][0]) * (q[1] - part[-2][1]) - (part[-1][1] - part[-2][1]) * (q[0] - part[-2][0]) <= 0:
                    part.pop()
                part.append(q)
            chain += part[:-1]
        area = abs(sum(a[0] * b[1] - a[1] * b[0] for a, b in zip(chain, chain[1:] + chain[:1])))
        total += Fraction(area, abs(n[k])) * abs(sum(n[i] * (chain[0][2][i] - inner[i]) for i in range(3)))
    return total


@pytest.mark.parametrize("seed", range(6))
def test_convex_hull(seed):
    rng = np.random.default_rng(seed)
    p = np.unique(rng.integers(0, (3, 5, 4) if seed % 2 else (9, 9, 9), (22, 3)), axis=0)
    at, volume_ = convex_hull(p)
    assert volume_ == brute_hull(p) and convex_hull(p[at])[1] == volume_


def test_hull_of_parts(spark):
    """An object over many bricks, in rounds of merged parts, equals the hull of all its corners; a single voxel is a cube."""
    rng = np.random.default_rng(8)
    cells = np.unique((rng.normal(0, 6, (900, 3)) + 25).astype(int), axis=0)
    df = volume(spark, cells).withColumn("label", F.lit(5).cast("long")).unionByName(volume(spark, [(0, 0, 0)], 2).withColumn("label", F.lit(1).cast("long")))
    corners = np.unique((cells[:, None] + np.array([[i, j, k] for i in (0, 1) for j in (0, 1) for k in (0, 1)])).reshape(-1, 3), axis=0)
    for brick in ((64, 256, 256), (3, 4, 2)):
        got = {r.label: r for r in A.hull_volume(df, brick).collect()}
        assert got[5].six_vol == convex_hull(corners)[1] and got[1].six_vol == 6 and got[5].area == len(cells)
    assert A.hull_volume(df.limit(0)).collect() == []


def test_poisson_at_every_rate(spark):
    """Mean and variance of small and very large rates; the plan has no sequence that grows with the rate."""
    rates = [0.5, 127.0, 130.0, 400.0, 6e4, 1e9]
    df = spark.range(4000 * len(rates)).selectExpr("id as image_id", "0 as t", "0 as z", "0 as y", "0 as x", f"array({', '.join(f'{r}D' for r in rates)})[id % {len(rates)}] as v", f"id % {len(rates)} as k")
    got = {r.k: r for r in L.poisson_noise(df, "v", 1.0, 11).groupBy("k").agg(F.avg("v").alias("m"), F.variance("v").alias("s")).collect()}
    for k, mu in enumerate(rates):
        assert abs(got[k].m - mu) < 5 * math.sqrt(mu / 4000) and abs(got[k].s / mu - 1) < 0.12
    odd = spark.createDataFrame([(1, 0, 0, 0, 0, None), (1, 0, 0, 0, 1, -3.0)], "image_id long, t int, z int, y int, x int, v double")
    assert [r.v for r in L.poisson_noise(odd, "v", 1.0, 11).collect()] == [0.0, 0.0]


def test_log_factorial(spark):
    got = spark.range(200).select("id", L.log_factorial(F.col("id").cast("double")).alias("f")).collect()
    assert all(abs(r.f - math.lgamma(r.id + 1)) < 1e-11 * max(1, r.f) for r in got)


def test_running_sums_over_partitions(spark):
    """Groups over many range partitions: sums and the row before, also across their borders."""
    from voxlake.operators.ranks import running

    rng = np.random.default_rng(9)
    rows = [(g, float(v), int(rng.integers(1, 5))) for g, n in ((1, 600), (2, 1), (None, 40)) for v in rng.choice(5000, n, replace=False)]
    df = spark.createDataFrame(rows, "g long, v double, n long").repartition(3)
    got = {(r.g, r.v): (r.upto_, r.total_, r.before_value_, r.before_upto_) for r in running(df, ["g"], "v", "n").collect()}
    for g in (1, 2, None):
        own = sorted((v, n) for k, v, n in rows if k == g)
        total, run, last = sum(n for _, n in own), 0, (None, None)
        for v, n in own:
            run += n
            assert got[g, v] == (run, total, *last)
            last = (v, run)


@pytest.mark.parametrize("n_in, n_out", [(8, 12), (8, 3), (50, 50), (1, 4), (2, 5), (60, 7), (33, 90)])
def test_resampling_weights(n_in, n_out):
    """Spline weights equal those of the dense inverse of the collocation matrix; lines add up to one; long axes have few weights a line."""
    fold = lambda i: np.where(np.mod(i, 2 * n_in) < n_in, np.mod(i, 2 * n_in), 2 * n_in - 1 - np.mod(i, 2 * n_in))
    dense, at = np.zeros((n_in, n_in)), np.arange(n_in)
    for k, v in ((-1, 1 / 6), (0, 4 / 6), (1, 1 / 6)):
        np.add.at(dense, (at, fold(at + k)), v)
    for smooth in (False, True):
        w, x = np.zeros((n_out, n_in)), (np.arange(n_out) + 0.5) * n_in / n_out - 0.5
        for k in (-1, 0, 1, 2):
            d = np.abs(x - (np.floor(x).astype(int) + k))
            np.add.at(w, (np.arange(n_out), fold(np.floor(x).astype(int) + k)), np.where(d < 1, 2 / 3 - d**2 + d**3 / 2, np.maximum(2 - d, 0) ** 3 / 6))
        w = w @ np.linalg.inv(dense)
        if smooth and n_out < n_in:
            blur = np.zeros((n_in, n_in))
            for k, v in L.kernel((n_in / n_out - 1) / 2):
                np.add.at(blur, (at, fold(at + k)), v)
            w = w @ blur
        got = np.zeros((n_out, n_in))
        for o, i, v in L.axis_weights(n_in, n_out, 3, smooth):
            got[o, i] = v
        assert np.abs(got - w).max() < 1e-11 and np.allclose(got.sum(1), 1, atol=1e-9)
    assert len(L.axis_weights(4000, 4000, 3)) < 60 * 4000
