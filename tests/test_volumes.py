"""Micro volumes with known answers, and properties of operators without an oracle."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxlake.operators import aggregates as A
from voxlake.operators import filters as L
from voxlake.operators import iterative as G
from voxlake.operators import joins as J
from voxlake.operators import projections as P
from voxlake.operators import windows as W
from voxlake.operators.projections import VK


def volume(spark, cells, image=1, t=0):
    return spark.createDataFrame([(image, t, *c) for c in cells], "image_id long, t int, z int, y int, x int")


def cube(z, y, x, n=3):
    return [(z + a, y + b, x + c) for a in range(n) for b in range(n) for c in range(n)]


def cells(df):
    return {(r.z, r.y, r.x) for r in df.collect()}


def test_corner_contact(spark):
    two = volume(spark, cube(0, 0, 0) + cube(3, 3, 3))
    for brick in ((64, 64, 64), (2, 3, 4), (3, 3, 3)):
        assert G.label_components(two, 26, brick).select("label").distinct().count() == 1
        assert G.label_components(two, 6, brick).select("label").distinct().count() == 2
    assert G.label_components(two.limit(0), 26).count() == 0


def test_components_do_not_depend_on_bricks(spark):
    rng = np.random.default_rng(3)
    vox = volume(spark, np.argwhere(rng.random((9, 14, 17)) < 0.25).tolist())
    want = {(r.z, r.y, r.x): r.label for r in G.label_components(vox, 6).collect()}
    got = {(r.z, r.y, r.x): r.label for r in G.label_components(vox, 6, (2, 5, 3)).collect()}
    assert got == want


def test_flat_and_single(spark):
    plate = volume(spark, [(0, y, x) for y in range(4) for x in range(5)]).withColumn("label", F.lit(1).cast("long"))
    box = A.bbox(plate).first()
    assert (box.area, box.bbox_vol, box.extent) == (20, 20, 1.0)
    assert A.surface_area(plate).first().surf_area == 20 * 2 + 2 * (4 + 5)
    assert A.hull_volume(plate).first().convex_vol == pytest.approx(20.0)
    one = plate.limit(1)
    assert A.feret_max(one).first().feret_max == 0.0 and A.hull_volume(one).first().convex_vol == pytest.approx(1.0)
    assert A.drop_degenerate(plate, 1, 0.4, 0.0, 3).count() == 0


def test_hull_of_cube_and_l_shape(spark):
    l_shape = cube(0, 0, 0, 2) + cube(0, 0, 2, 2) + cube(0, 2, 0, 2)
    df = volume(spark, l_shape).withColumn("label", F.lit(1).cast("long")).unionByName(volume(spark, cube(0, 0, 0, 4)).withColumn("label", F.lit(2).cast("long")))
    rows = {r.label: r for r in A.hull_volume(df).collect()}
    assert rows[2].solidity == pytest.approx(1.0) and rows[1].convex_vol == pytest.approx(2 * (16 - 2))


def test_inertia_of_a_rod(spark):
    rod = volume(spark, [(0, 0, x) for x in range(12)]).withColumn("label", F.lit(1).cast("long"))
    r = A.inertia_axes(rod).first()
    assert r.e2 == pytest.approx((144 - 1) / 12 + 1 / 12) and r.axis_major > 5 * r.axis_minor


def test_distance_and_coarse(spark):
    a, b = volume(spark, [(0, 0, 0), (2, 3, 4)]), volume(spark, [(0, 0, 5), (4, 3, 4)])
    got = {(r.z, r.y, r.x): r.distance for r in J.distance_to(a, b, 10).collect()}
    assert got == {(0, 0, 0): 5.0, (2, 3, 4): 2.0}
    assert [r.distance for r in J.distance_to(a, b, 1).collect()] == [None, None]
    sampled = {(r.z, r.y, r.x): r.distance for r in J.distance_to(a, b, 10, (3.0, 1.0, 1.0)).collect()}
    assert sampled[2, 3, 4] == pytest.approx(min(6.0, math.sqrt(36 + 9 + 1)))


def test_thinning_keeps_topology(spark):
    ring = [(z, y, x) for z in range(3) for y in range(7) for x in range(7) if not (2 <= y <= 4 and 2 <= x <= 4)]
    bar = [(z, y, x) for z in range(10, 13) for y in range(3) for x in range(15)]
    thin = G.thin(volume(spark, ring + bar))
    assert cells(thin) < set(ring + bar)
    assert G.label_components(thin, 26).select("label").distinct().count() == 2
    assert len([c for c in cells(thin) if c[0] >= 10]) >= 5
    hole = G.label_components(volume(spark, sorted({(1, y, x) for y in range(-1 + 1, 7) for x in range(7)} - {(1, c[1], c[2]) for c in cells(thin) if c[0] < 5})), 6)
    assert hole.select("label").distinct().count() >= 2  # the ring still parts inside from outside


def test_growth_geodesic_and_split(spark):
    line = [(0, 0, x) for x in range(10)]
    seeds = volume(spark, [(0, 0, 0)]).withColumn("label", F.lit(4).cast("long")).unionByName(volume(spark, [(0, 0, 9)]).withColumn("label", F.lit(7).cast("long")))
    grown = {r.x: r.label for r in G.grow_labels(seeds, volume(spark, line)).collect()}
    assert grown == {x: 4 if x < 5 else 7 for x in range(10)}
    hops = {r.x: r.hops for r in G.geodesic(volume(spark, line).withColumn("label", F.lit(1).cast("long"))).collect()}
    assert hops == {x: x for x in range(10)}
    mask = volume(spark, line).withColumn("p", F.when(F.col("x") == 3, 9.0).otherwise(1.0))
    split = {r.x: r.label for r in G.seeded_split(mask, seeds, "p").collect()}
    assert split == {x: 4 if x < 3 else 7 for x in range(10)} | {3: split[3]}


def test_paths(spark):
    plane = [(0, y, x) for y in range(3) for x in range(8)]
    cost = volume(spark, plane).withColumn("cost", F.when(F.col("y") == 2, 0.1).otherwise(1.0) * (10 - F.col("x")))
    spine = volume(spark, [(0, 1, 0)]).withColumn("label", F.lit(1).cast("long"))
    path = G.greedy_paths(cost, spine, volume(spark, [(0, 1, 7)])).collect()
    assert path and max(r.x for r in path) == 6
    cheap = volume(spark, plane).withColumn("cost", F.when(F.col("y") == 0, 0.1).otherwise(5.0)).withColumn("label", F.lit(1).cast("long"))
    ends = volume(spark, [(0, 0, 7)]).withColumn("label", F.lit(1).cast("long"))
    walk = G.least_cost_path(cheap, volume(spark, [(0, 0, 0)]).withColumn("label", F.lit(1).cast("long")), ends).collect()
    assert sorted((r.x, r.y) for r in walk) == [(x, 0) for x in range(8)]


def test_round_trips(spark):
    vox = volume(spark, cube(0, 0, 0)).withColumn("cls", (F.col("x") + 1).cast("int"))
    back = P.channels_to_labels(P.labels_to_channels(vox, 3), 3)
    assert {(r.z, r.y, r.x, r.cls) for r in back.collect()} == {(r.z, r.y, r.x, r.cls) for r in vox.collect()}
    assert A.iou(vox, vox).first().iou == 1.0
    tiles = L.extract_tiles(vox, (3, 3, 3), (3, 3, 3), (3, 3, 3))
    assert A.majority_vote(tiles).count() == 27
    path = W.polyline_length(vox.withColumn("label", F.lit(1)), ["label"], ["z", "y", "x"], (1.0, 1.0, 1.0)).first().length
    assert path >= math.sqrt(12)
    blur = L.gaussian(vox.withColumn("v", F.lit(2.0)), "v", {"x": 0.5}, VK).agg(F.max("v")).first()[0]
    assert 0 < blur <= 2.0


def test_noise_is_repeatable(spark):
    vox = volume(spark, cube(0, 0, 0)).withColumn("v", F.lit(5.0))
    a, b = ([r.v for r in L.poisson_noise(vox.repartition(n), "v", 1.0, 3).orderBy(*VK).collect()] for n in (1, 4))
    assert a == b and len(set(a)) > 1 and abs(np.mean(a) - 5) < 2


def test_depth_at_any_distance(spark):
    thick = volume(spark, cube(0, 0, 0, 9)).withColumn("label", F.lit(1).cast("long"))
    deep = G.deepest_point(thick).first()
    assert (deep.z, deep.y, deep.x, deep.distance) == (4, 4, 4, 5.0)
    assert (4, 4, 4) in cells(G.seeds_from_distance(thick, 0.7))
    line = volume(spark, [(0, 0, x) for x in range(12)])
    far = {r.x: r.distance for r in J.distance_to(line, line.where("x = 0")).collect()}
    assert far == {x: float(x) for x in range(12)}


def test_nearest_far_away(spark):
    frames = spark.createDataFrame([(1, 0, 0.0, 0.0, 0.0), (2, 1, 0.0, 0.0, 5000.0), (3, 1, 0.0, 5001.0, 0.0)], "spine_id long, timepoint long, z double, y double, x double")
    got = {r.source: (r.target, r.distance) for r in J.link_nearest(frames).collect()}
    assert got == {1: (2, 5000.0), 2: (None, None), 3: (None, None)}


def test_paths_of_touching_objects(spark):
    """On one line: object 1 from 0 to 10, object 2 from 8 to 2 (cells of both)."""
    line = [(0, 0, x) for x in range(11)]
    one, two = (volume(spark, line).withColumn("label", F.lit(k).cast("long")).withColumn("cost", F.lit(1.0)) for k in (1, 2))
    at = lambda x, k: volume(spark, [(0, 0, x)]).withColumn("label", F.lit(k).cast("long"))
    for brick in ((64, 64, 64), (2, 2, 3)):
        walk = G.least_cost_path(one.unionByName(two), at(0, 1).unionByName(at(8, 2)), at(10, 1).unionByName(at(2, 2)), brick).collect()
        assert sorted((r.label, r.step, r.x) for r in walk) == [(1, i, 10 - i) for i in range(11)] + [(2, i, 2 + i) for i in range(7)]


def test_long_walk(spark):
    """A path of 1,500 voxels through many bricks."""
    path = [(0, 2 * k + (0 if i < 29 else 1), i if k % 2 == 0 else 28 - i) for k in range(50) for i in range(29)]
    path = [(0, 2 * k, x) for k in range(50) for x in range(29)] + [(0, 2 * k + 1, 28 if k % 2 == 0 else 0) for k in range(49)]
    vox = volume(spark, path).withColumn("label", F.lit(1).cast("long")).withColumn("cost", F.lit(1.0))
    at = lambda c: volume(spark, [c]).withColumn("label", F.lit(1).cast("long"))
    walk = G.least_cost_path(vox, at((0, 0, 0)), at((0, 98, 0 if 49 % 2 else 28)), (4, 25, 30)).collect()
    assert len({r.step for r in walk}) == len(walk) and len(walk) > 1300
    field = {(r.y, r.x): r.hops for r in G.geodesic(vox, at((0, 0, 0)), (4, 25, 30)).collect()}
    assert max(field.values()) >= 49 * 29 and field == {(r.y, r.x): r.hops for r in G.geodesic(vox, at((0, 0, 0))).collect()}


def test_bricks_change_nothing(spark):
    """Growth, splits, geodesics, thinning, greedy paths and distances with images of one and of many bricks."""
    rng = np.random.default_rng(8)
    full = np.argwhere(rng.random((7, 15, 18)) < 0.6).tolist()
    vox = volume(spark, full).unionByName(volume(spark, full[::2], image=1 << 61))
    mask = vox.withColumn("p", (F.col("z") * 5 + F.col("y") * 3 + F.col("x") * 7) % 4 + F.lit(0.0))
    seeds = vox.where("(z * 15 + y) * 18 + x < 400 and x % 5 = 0 and y % 4 = 0").withColumn("label", F.col("x") + F.col("y") * 100 + F.lit(1).cast("long"))
    cost = mask.select(*VK, (1 + F.col("p") * F.col("x")).alias("cost"))
    small = (3, 4, 5)
    key = lambda df: sorted(tuple(r) for r in df.collect())
    for f in (
        lambda **k: G.label_components(vox, 6, **k).select(*VK, "label"),
        lambda **k: G.grow_labels(seeds, mask, 6, **k),
        lambda **k: G.seeded_split(mask, seeds, "p", 6, **k),
        lambda **k: G.thin(vox, **k),
        lambda **k: G.greedy_paths(cost, seeds, vox.where("x > 15"), **k).select(*VK, "label", "step"),
        lambda **k: J.distance_to(vox, seeds, 6, (2.0, 1.0, 1.0), **k),
    ):
        assert key(f()) == key(f(brick=small))


def test_nearest_beyond_many_rings(spark):
    """Far targets, many of them, equal brute force; a point without any gets nulls."""
    rng = np.random.default_rng(2)
    pts = spark.createDataFrame([(i, 1, *map(float, rng.integers(0, 60, 3))) for i in range(40)] + [(99, 2, 0.0, 0.0, 0.0)], "id long, image_id long, z double, y double, x double")
    far = [(1, *map(float, rng.integers(400, 900, 3)), k) for k in range(300)] + [(1, 0.0, 0.0, 520.0, 900), (1, 0.0, 1414.0, 0.0, 901)]
    targets = spark.createDataFrame(far, "image_id long, z double, y double, x double, name long")
    got = {r.id: (r.distance, r.name) for r in J.nearest_point(pts, targets, ["id"], ["name"]).collect()}
    want = {99: (None, None)}
    for r in pts.where("image_id = 1").collect():
        want[r.id] = min((math.dist((r.z, r.y, r.x), t[1:4]), t[4]) for t in far)
    assert set(got) == set(want) and got[99] == (None, None)
    assert all(got[i][1] == want[i][1] and abs(got[i][0] - want[i][0]) < 1e-9 for i in want if i != 99)


def test_nearest_at_any_distance(spark):
    """Near and far points at once, unequal sampling, negative places and ties equal brute force; as many jobs however far the targets are."""
    rng = np.random.default_rng(8)
    sampling = (2.0, 0.5, 1.0)
    places = lambda n, spread: [tuple(map(float, rng.integers(-spread, spread + 1, 3))) for _ in range(n)]
    asked = [(f"{spread}-{i}", 1 + i % 2, *p) for spread in (3, 50, 2_000, 300_000) for i, p in enumerate(places(8, spread))]
    there = [(1 + i % 2, *p, i // 2) for spread in (2, 60, 3_000) for i, p in enumerate(places(12, spread))]
    there += [(1, 250_000.0, 8.0, 8.0, -k) for k in range(3)]
    pts = spark.createDataFrame(asked, "id string, image_id long, z double, y double, x double")
    targets = lambda by: spark.createDataFrame([(t[0], t[1] + by, *t[2:]) for t in there], "image_id long, z double, y double, x double, name long")

    def brute(by):
        away = lambda a, t: math.sqrt(sum(((p - q) * s) ** 2 for p, q, s in zip(a[2:], (t[1] + by, *t[2:4]), sampling, strict=True)))
        found = {a[0]: min((round(away(a, t), 9), t[1] + by, *t[2:]) for t in there if t[0] == a[1]) for a in asked}
        return {k: (v[0], v[-1]) for k, v in found.items()}

    jobs = []
    for by in (0.0, 1_000.0, 5_000_000.0):
        spark.sparkContext.setJobGroup(f"nearest-{by}", "nearest")
        found = {r.id: (round(r.distance, 9), r.name) for r in J.nearest_point(pts, targets(by), ["id"], ["name"], sampling).collect()}
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"nearest-{by}")))
        assert found == brute(by)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert abs(jobs[2] - jobs[1]) <= 4, jobs
    within = {k: v if v[0] <= 700.0 else (None, None) for k, v in brute(0.0).items()}
    got = {r.id: (r.distance and round(r.distance, 9), r.name) for r in J.nearest_point(pts, targets(0.0), ["id"], ["name"], sampling, max_dist=700.0).collect()}
    assert {k: v[1] for k, v in got.items()} == {k: v[1] for k, v in within.items()}


def test_usual_axis_lengths(spark):
    """A slice at unequal sampling is flat: twice its least moment is 0."""
    plane = volume(spark, [(0, y, x) for y in range(20) for x in range(20)]).withColumn("label", F.lit(1).cast("long"))
    r = A.inertia_axes(plane, (1.0, 0.102, 0.102)).first()
    assert r.axis_major_table == 0.0 and r.axis_minor_table == 0.0
    box = volume(spark, [(z, y, x) for z in range(3) for y in range(6) for x in range(12)]).withColumn("label", F.lit(1).cast("long"))
    assert A.inertia_axes(box).first().axis_major_table == pytest.approx(math.sqrt(12 * (9 - 1) / 12))


def test_feret_of_large_objects(spark):
    ball = [(z, y, x) for z in range(15) for y in range(15) for x in range(21) if ((z - 7) / 7) ** 2 + ((y - 7) / 7) ** 2 + ((x - 10) / 10) ** 2 <= 1]
    cloud = np.unique(np.random.default_rng(4).integers(0, 30, (400, 3)), axis=0).tolist()
    df = volume(spark, ball).withColumn("label", F.lit(1).cast("long")).unionByName(volume(spark, cloud).withColumn("label", F.lit(2).cast("long")))
    got = {r.label: r.feret_max for r in A.feret_max(df, (2.0, 1.0, 0.5)).collect()}
    for label, c in ((1, ball), (2, cloud)):
        p = np.array(c) * (2.0, 1.0, 0.5)
        assert got[label] == pytest.approx(np.sqrt(((p[:, None] - p[None]) ** 2).sum(-1)).max())


def test_mesh(spark):
    one = lambda c, k: volume(spark, c).withColumn("label", F.lit(k).cast("long"))
    rng = np.random.default_rng(5)
    ball = [(z, y, x) for z in range(21) for y in range(21) for x in range(21) if (z - 10) ** 2 + (y - 10) ** 2 + (x - 10) ** 2 <= 81]
    rows = {r.label: r for r in A.surface_mesh(one([(0, 0, 0)], 1).unionByName(one(ball, 2)).unionByName(one(np.argwhere(rng.random((5, 5, 5)) < 0.5).tolist(), 3))).collect()}
    assert rows[1].mesh_area == pytest.approx(math.sqrt(3)) and rows[1].mesh_vol == pytest.approx(1 / 6)  # an octahedron
    assert rows[2].mesh_vol == pytest.approx(4 / 3 * math.pi * 9**3, rel=0.05) and rows[2].mesh_area == pytest.approx(4 * math.pi * 9**2, rel=0.12)
    table = np.array(A.mesh_cells((1.0, 1.0, 1.0)))
    moved = A.surface_mesh(one([(z + 7, y + 3, x) for z, y, x in ball], 2)).first()
    assert moved.mesh_vol == pytest.approx(rows[2].mesh_vol) and (table[:, 0] > 0).sum() == 254


def test_ranks_and_percentiles(spark):
    rng = np.random.default_rng(1)
    rows = [(int(g), float(v)) for g, v in zip(rng.choice([1, 1, 1, 2, 3], 900), rng.integers(0, 40, 900))]
    df = spark.createDataFrame(rows, "image_id long, v double").repartition(5)
    got = {r.image_id: (r.p_low, r.p_high) for r in A.percentiles(df, "v", 0.02, 0.737, ["image_id"]).collect()}
    for g in (1, 2, 3):
        assert got[g] == pytest.approx(np.percentile([v for k, v in rows if k == g], (2, 73.7)))
    assert A.percentiles(df.limit(0), "v", 0.1, 0.9, ["image_id"]).count() == 0


def test_spline(spark):
    """The spline goes through cubics exactly, and through its points."""
    t = np.linspace(0, 1, 9)
    flat = W._spline(np.stack([0 * t, 3 * t, 4 * t], axis=1), 50)
    assert np.allclose(flat, np.stack([0 * np.linspace(0, 1, 50), 3 * np.linspace(0, 1, 50), 4 * np.linspace(0, 1, 50)], axis=1))
    turn = np.linspace(0, np.pi, 40)
    arc = W._spline(np.stack([0 * turn, np.sin(turn), np.cos(turn)], axis=1), 60)
    assert np.allclose(np.hypot(arc[:, 1], arc[:, 2]), 1, atol=1e-5)
    df = volume(spark, [(0, 0, 0), (0, 1, 2), (0, 2, 2), (0, 3, 5), (0, 4, 4)]).withColumn("label", F.lit(1))
    out = W.resample_polyline(df, ["label"], ["y"], 7).orderBy("step").collect()
    assert len(out) == 7 and (out[0].y, out[0].x) == (0.0, 0.0) and out[-1].y == pytest.approx(4) and out[-1].x == pytest.approx(4)
    assert W.resample_polyline(df.limit(2), ["label"], ["y"], 7).count() == 2


def test_cubic_weights():
    for n_in, n_out in ((8, 12), (9, 9), (12, 5)):
        w = np.zeros((n_out, n_in))
        for o, i, v in L.axis_weights(n_in, n_out, 3):
            w[o, i] += v
        assert np.allclose(w.sum(axis=1), 1) and (n_in != n_out or np.allclose(w, np.eye(n_in), atol=1e-9))
    blurred = sum(abs(v) for o, i, v in L.axis_weights(40, 10, 3, True) if o == 5)
    assert blurred < sum(abs(v) for o, i, v in L.axis_weights(40, 10, 3) if o == 5)


def test_necks_without_a_neck_class(spark):
    vox = volume(spark, [(z, y, x) for z in range(3) for y in range(3) for x in range(9)]).withColumn("v", F.col("x") * 3.0 + 1)
    spine, dendrite = vox.where("x <= 1").withColumn("label", F.lit(5).cast("long")), vox.where("x >= 7")
    necks = G.neck_generation(spine, None, dendrite, vox, "v").collect()
    assert necks and {r.label for r in necks} == {5} and all(1 < r.x < 7 for r in necks) and max(r.x for r in necks) == 6
    cost, deep = G.midline_cost(spine.select(*VK, "label"), 3)
    assert deep.count() == 1 and cost.where("cost < 0").count() == 0


def test_registered_paths_have_no_short_limit(spark, sf_dir, monkeypatch):
    from voxlake import registry

    seen, walk = [], G.greedy_paths

    def spy(cost, objects, target, steps=200, most=20.0, **rest):
        seen.append(steps)
        return walk(cost, objects, target, 1, most, **rest)

    monkeypatch.setattr(G, "greedy_paths", spy)
    for name in ("g11_greedy_paths", "g12_neck_generation"):
        registry.QUERIES[name](spark, sf_dir)
    assert seen == [200, 200]


def test_rounds_write_what_changed(spark, monkeypatch):
    """A long line through many bricks: each round's version holds one brick or two, whatever the image holds besides."""
    from voxlake.operators import bricks

    line = volume(spark, [(0, 0, x) for x in range(60)]).unionByName(volume(spark, [(0, 9, x) for x in range(60)], image=2))
    seed = volume(spark, [(0, 0, 0)]).withColumn("label", F.lit(4).cast("long"))
    sizes, real = [], bricks.saved
    monkeypatch.setattr(bricks, "saved", lambda df, name, *a: (out := real(df, name, *a), sizes.append((name, out.count())))[0])
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")  # else bricks share tasks, which settle them together
    try:
        got = G.grow_labels(seed, line, 26, (4, 4, 5)).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(got) == 60 and {r.label for r in got} == {4}
    written = [n for name, n in sizes if name == "relax"]
    assert len(written) > 4 and sum(written[1:]) < 30 * len(written[1:])


def test_versions_of_bricks(spark):
    from voxlake.operators.bricks import Versions

    frame = lambda rows: spark.createDataFrame(rows, "brick long, v int")
    state, want = Versions(frame([(b, 0) for b in range(6)] * 2), "test"), {b: 0 for b in range(6)}
    for k in range(1, 20):
        some = [k % 6, (k * 5) % 6]
        state.add(frame([(b, k) for b in set(some) if b != 3]), frame([(b, 0) for b in set(some)]))
        want.update(dict.fromkeys(some, k))
        want.pop(3, None) if 3 in some else None
    assert {r.brick: r.v for r in state.rows().collect()} == want and len(state.tables) <= Versions.MOST
    assert {r.brick for r in state.rows(frame([(1, 0), (2, 0)])).collect()} == {1, 2}


def test_objects_in_parts(spark):
    """An object of most voxels is many parts; order of merging, errors in any step, and nothing at all."""
    big = volume(spark, cube(0, 0, 0, 12)).withColumn("label", F.lit(1).cast("long"))
    small = volume(spark, [(50, 0, 0), (50, 0, 20)]).withColumn("label", F.lit(2).cast("long"))
    bad = volume(spark, [(60, 0, x) for x in range(30)]).withColumn("label", F.lit(3).cast("long"))

    def part(rows):
        if (rows.z == 60).any() and (rows.x == 29).any():
            raise LookupError("bad")
        return {"n": len(rows), "total": float(rows.x.sum())}

    merge = lambda s: {"n": int(s.n.sum()), "total": float(s.total.sum())}
    finish = lambda s: {"mean": s["total"] / s["n"]}
    vox = big.unionByName(small).unionByName(bad)
    for fan in (2, 16):
        got = {r.label: (r.mean, r.error) for r in L.map_objects_in_parts(vox, part, merge, finish, "n long, total double", ["mean"], (3, 3, 4), fan).collect()}
        assert got == {1: (5.5, None), 2: (10.0, None), 3: (None, "LookupError")}
    assert L.map_objects_in_parts(vox.limit(0), part, merge, finish, "n long, total double", ["mean"]).collect() == []


def test_components_with_columns_and_least_size(spark):
    """carry and least equal a join and a filter afterwards, with images of one and of many bricks."""
    rng = np.random.default_rng(12)
    vox = volume(spark, np.argwhere(rng.random((6, 9, 11)) < 0.3).tolist()).unionByName(volume(spark, np.argwhere(rng.random((5, 9, 9)) < 0.2).tolist(), image=7))
    vox = vox.withColumn("v", F.col("x") * 0.5 + F.col("z")).withColumn("root", F.lit("r"))
    key = lambda df: sorted(tuple(r) for r in df.collect())
    want = key(A.filter_components(G.label_components(vox, 6), 3).select(*VK, "label").join(vox.select(*VK, "v"), VK).select(*VK, "v", "label"))
    for brick in ((64, 256, 256), (3, 4, 5)):
        assert key(G.label_components(vox, 6, brick, carry=("v",), least=3)) == want
