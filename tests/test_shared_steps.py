"""Steps that many queries share: masks in bricks, halos, groups in batches, places, exact decimals."""

import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from voxlake.operators import aggregates as A
from voxlake.operators import filters as L
from voxlake.operators import iterative as G
from voxlake.operators import joins as J
from voxlake.operators.bricks import Grid, latest, least
from voxlake.operators.dense import dense_map, mask_map, moved
from voxlake.sources import tables as S


def voxels(spark, cells):
    return spark.createDataFrame([(i, 0, *map(int, c)) for i, c in cells], "image_id long, t int, z int, y int, x int")


def scene(n=400, images=3, seed=5):
    rng = np.random.default_rng(seed)
    return {(int(i), *map(int, c)) for i, c in zip(rng.integers(0, images, n), rng.integers(0, 9, (n, 3)), strict=True)}


def got(df):
    rows = [tuple(r) for r in df.select("image_id", "z", "y", "x").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_masks_in_small_bricks(spark):
    cells = scene()
    vox = voxels(spark, [(c[0], c[1:]) for c in cells])
    ball = [d for d in itertools.product((-2, -1, 0, 1, 2), repeat=3) if sum(v * v for v in d) <= 4] + [(0, 2, 1)]
    shifted = lambda d: {(c[0], *(a + b for a, b in zip(c[1:], d, strict=True))) for c in cells}
    assert got(G.dilate(vox, ball)) == set().union(*map(shifted, ball))
    flat = [(0, 0, 0), (0, 0, 1), (0, -1, 0)]
    assert got(G.erode(vox, flat)) == {c for c in cells if all((c[0], *(a + b for a, b in zip(c[1:], d, strict=True))) in cells for d in flat)}
    around = set().union(*map(shifted, itertools.product((-1, 0, 1), repeat=3))) - cells
    assert got(G.shell_of(vox)) == around
    small = {"z": 2, "y": 3, "x": 4}
    assert got(mask_map(vox, (0, 0, 1), lambda m: m | moved(m, (0, 0, 1)), small)) == cells | shifted((0, 0, 1))


def test_no_copies_before_the_first_brick(spark):
    """Images of one brick are not sent to bricks before it, where nobody asks."""
    vox = voxels(spark, [(c[0], c[1:]) for c in scene()]).selectExpr("*", "1.0D as v")
    df = dense_map(vox, ["v"], ["image_id", "t", "z", "y", "x"], {"z": 2, "y": 40, "x": 40}, lambda a: a, ["v"])
    assert df.count() == vox.count()
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "- 40" not in plan  # ranges of bricks begin at a voxel's own


def test_many_groups_in_a_batch(spark, monkeypatch):
    monkeypatch.setattr(L, "GROUPED", 50)
    rows = [(i % 37, None if i % 41 == 0 else i % 5, float(i)) for i in range(2000)]
    df = spark.createDataFrame(rows, "a long, b long, v double").repartition(3)
    want = pd.DataFrame(rows, columns=["a", "b", "v"]).groupby(["a", "b"], dropna=False).v.agg(["size", "sum"])
    found = L.map_groups(df, ["a", "b"], lambda who, p: [{"s": float(p.v.sum()), "a": who[0], "n": len(p), "first": int(p.index[0])}], "a long, n long, s double, first int", ["v"]).collect()
    assert sorted((r.n, r.s) for r in found) == sorted(zip(want["size"].tolist(), want["sum"].tolist(), strict=True)) and {r.first for r in found} == {0}


def test_points_and_targets_that_share_places(spark):
    """All of 300 x 300 pairs lie in one cell; places meet instead."""
    rng = np.random.default_rng(3)
    p, t = rng.integers(0, 6, (300, 3)), rng.integers(0, 6, (300, 3))
    rows = lambda a: [(i, 0, *map(int, c)) for i, c in enumerate(a)]
    points = spark.createDataFrame(rows(p) + [(900, 0, None, 1, 1), (901, 5, 1, 1, 1)], "who long, image_id long, z int, y int, x int")
    targets = spark.createDataFrame(rows(t), "what long, image_id long, z int, y int, x int")
    found = {r.who: (r.distance, r.what) for r in J.nearest_point(points, targets, ["who"], ["what"]).collect()}
    for i, c in enumerate(p):
        d = np.sqrt(((t - c) ** 2).sum(1))
        best = min(range(300), key=lambda k: (round(d[k], 9), *t[k], k))
        assert found[i] == (d[best], best)
    assert found[900] == (None, None) and found[901] == (None, None) and len(found) == 302


def test_exact_halves_are_even(spark):
    values = [0.03125, 0.09375, 0.40625, 0.12345, 2 / 3, 0.0, 1.0, None]
    df = spark.createDataFrame([(v,) for v in values], "dice double")
    assert [r.dice for r in S.format_report(df, ["dice"]).collect()] == ["0.0312", "0.0938", "0.4062", "0.1235" if f"{0.12345:.4f}" == "0.1235" else "0.1234", "0.6667", "0.0000", "1.0000", None]


def test_depth_without_a_shell(spark):
    """Capped depths come from the voxels alone: no row of an empty cell is made or joined; volumes cross the bricks' borders."""
    cells = {c for c in itertools.product(range(60, 72), range(250, 260), range(3)) if sum(c) % 11}
    df = G.inside_distance(voxels(spark, [(1, c) for c in cells] + [(2, (0, 0, 0))]), 2)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Union" not in plan
    got_ = {(r.image_id, r.z, r.y, r.x): r.distance for r in df.collect()}
    want = {(2, 0, 0, 0): 1.0}
    for c in cells:
        d2 = [sum(v * v for v in d) for d in itertools.product(range(-2, 3), repeat=3) if sum(v * v for v in d) <= 4 and tuple(a + b for a, b in zip(c, d, strict=True)) not in cells]
        want[(1, *c)] = min(d2) ** 0.5 if d2 else None
    assert got_ == want


def test_otsu_mask_grows_in_bricks(spark):
    """A shuffle of the bright voxels for all steps together, not one of copies an axis."""
    rng = np.random.default_rng(4)
    rows = [(1, 0, z, y, x, float(rng.integers(0, 5)) + 100.0 * (z == 3 and y > 7)) for z in range(7) for y in range(10) for x in range(20)]
    df = A.otsu_mask(spark.createDataFrame(rows, "image_id long, t int, z int, y int, x int, v double"), "v", (6, 10, 20), 2)
    assert "left" not in df._jdf.queryExecution().optimizedPlan().toString().replace("left_", "")
    bright = {r[2:5] for r in rows if r[5] >= 100.0}
    want = {(1, z, y, x) for z in range(6) for y in range(10) for x in range(20) if any(abs(z - a) + abs(y - b) + abs(x - c) <= 2 for a, b, c in bright)}
    assert got(df) == want


def test_a_round_drops_old_versions_itself(spark):
    """Bricks that copies reach keep their last version and the copies; others go.  Copies for the bricks around are written beside the rows."""
    rows = [(5, 0, False, 1), (5, 1, False, 2), (5, -1, True, 3), (7, 0, False, 4), (9, 0, False, 5), (9, -1, True, 6)]
    t = pa.table(dict(zip(("brick", "version", "ghost", "v"), map(list, zip(*rows, strict=True)), strict=True)))
    assert latest(t)["v"].to_pylist() == [2, 3, 5, 6]
    vox = voxels(spark, [(c[0], c[1:]) for c in scene(60)])
    grid = Grid(vox, (3, 1, 4))
    both = grid.with_neighbours(vox.withColumn("f", F.col("x") > 2), F.col("f"))
    assert both.where("not ghost").count() == vox.count() and both.where("ghost and not f").isEmpty()
    side = lambda v, n: {v // n, (v - 1) // n, (v + 1) // n}
    want = sum(len(side(r.z, 3)) * len(side(r.y, 1)) * len(side(r.x, 4)) - 1 for r in vox.collect() if r.x > 2)
    assert both.where("ghost").count() == want


def test_path_costs_of_whole_images(spark, monkeypatch):
    """Images that fit into an array are done in one shuffle, with the values that passes over lines and bricks give; other rows of targets and objects give none."""
    cells = sorted(scene(500))
    vox = voxels(spark, [(c[0], c[1:]) for c in cells]).withColumn("v", (F.col("z") * 7 + F.col("y") * 5 + F.col("x") * 3) % 11 + F.lit(0.0))
    aim = vox.where("image_id < 2 and x > 6").select("image_id", "t", "z", "y", "x").unionByName(voxels(spark, [(1, (0, 12, 0)), (1, (0, 12, 0)), (9, (1, 1, 1))]))
    own = vox.where("y = 2")
    written, real = [], G.saved
    monkeypatch.setattr(G, "saved", lambda df, name, *a: written.append(name) or real(df, name, *a))
    found = lambda: {tuple(r)[:5]: r.cost for r in G.path_cost_field(own, aim, vox, "v").collect()}
    at_once = found()
    assert written == ["cost-input"] and set(at_once) == {(c[0], 0, *c[1:]) for c in cells}
    monkeypatch.setattr(G, "WHOLE", 0)
    by_passes = found()
    assert set(by_passes) == set(at_once) and all(abs(by_passes[k] - at_once[k]) < 1e-9 for k in by_passes)


def test_paths_without_copies_of_neighbours(spark):
    """No row is made for each of the 27 voxels around; paths equal a plain walk, with targets and objects that lie beyond the costs."""
    cells = sorted(scene(700, 2, 8))
    value = lambda z, y, x: round(((z * 31 + y * 17 + x * 7) % 23) / 4 + 0.01 * x, 9)
    price = {c: value(*c[1:]) for c in cells}
    cost = spark.createDataFrame([(c[0], 0, *c[1:], v) for c, v in price.items()], "image_id long, t int, z int, y int, x int, cost double")
    bodies = {(i, lab): [(i, z, y, x) for z, y, x in places] for i in (0, 1) for lab, places in ((1, [(2, 2, -1), (2, 3, -1)]), (2, [(4, 4, 4), (4, 4, 5), (2, 3, -1)]), (3, [(8, 9, 9), (60, 9, 9)]))}
    aims = {(i, z, y, 9) for i in (0, 1) for z in range(9) for y in range(9)} | {(0, 0, -1, 0), (1, 5, 5, 5), (1, 700, 5, 5)}
    rows = lambda some: voxels(spark, [(c[0], c[1:]) for c in some])
    objects = spark.createDataFrame([(c[0], 0, *c[1:], lab) for (_, lab), places in bodies.items() for c in places], "image_id long, t int, z int, y int, x int, label long")
    moves = [d for d in itertools.product((-1, 0, 1), repeat=3) if any(d)]
    step = lambda c, d: (c[0], *(a + b for a, b in zip(c[1:], d, strict=True)))
    taken = {c for places in bodies.values() for c in places}
    want = set()
    for (_, lab), places in bodies.items():
        shell = [c for c in {step(p, d) for p in places for d in moves} if c in price and c not in taken]
        at, walk, arrived = min(shell, key=lambda c: (price[c], c), default=None), [], False
        while at and len(walk) < 200:
            walk.append(at)
            if at not in aims and any(step(at, d) in aims for d in moves):
                arrived = True
                break
            ways = [(price[c], d[1:] != (0, 0), c) for d in moves if (c := step(at, d)) in price and c not in aims] + ([(price[at], True, at)] if at not in aims else [])
            best = min(ways, default=(0, 0, at))[2]
            at = None if best == at else best
        if arrived:
            want |= {(c[0], 0, *c[1:], lab, k) for k, c in enumerate(walk) if price[c] <= 20 and c not in taken}
    assert want
    for brick in ((64, 256, 256), (3, 4, 5)):
        df = G.greedy_paths(cost, objects, rows(aims), brick=brick).select("image_id", "t", "z", "y", "x", "label", "step")
        assert {tuple(r) for r in df.collect()} == want, brick
    assert "Generate" not in G.greedy_paths(cost, objects, rows(aims))._jdf.queryExecution().optimizedPlan().toString()


def test_nearest_places_in_bricks(spark, monkeypatch):
    """Near places are looked up in bricks, without a row for each cell around a point; far ones, ties, limits, unequal sampling and bricks' borders equal brute force."""
    rng = np.random.default_rng(6)
    p = np.concatenate([rng.integers(-9, 12, (120, 3)), rng.integers(0, 300, (20, 3)), [[0, 0, 0], [255, 255, 255], [63, 255, -1]]])
    t = np.concatenate([rng.integers(-9, 12, (90, 3)), [[64, 256, 0], [255, 255, 259], [290, 290, 290]]])
    what = [f"t{i % 50}" for i in range(len(t))]
    points = spark.createDataFrame([(i, i % 2, *map(int, c)) for i, c in enumerate(p)] + [(900, 0, None, 1, 1), (901, 5, 1, 1, 1), (902, None, 1, 1, 1)], "who long, image_id long, z int, y int, x int")
    targets = spark.createDataFrame([(w, i, *map(int, c)) for i in (0, 1, None) for w, c in zip(what, t, strict=True)], "what string, image_id long, z long, y long, x long")
    asked, real = [], J._nearest_rows
    monkeypatch.setattr(J, "_nearest_rows", lambda todo, *a: asked.append(todo.count()) or real(todo, *a))
    for sampling, limit in (((1.0, 1.0, 1.0), None), ((2.0, 0.5, 1.0), None), ((1.0, 1.0, 1.0), 3.0), ((0.3, 0.1, 0.2), 2.0)):
        found = {r.who: (r.distance, r.what) for r in J.nearest_point(points, targets, ["who"], ["what"], sampling, max_dist=limit).collect()}
        for i, c in enumerate(p):
            d = np.sqrt((((t - c) * sampling) ** 2).sum(1))
            best = min(range(len(t)), key=lambda k: (round(d[k], 9), *t[k], what[k]))
            want = (d[best], what[best]) if limit is None or d[best] <= limit else (None, None)
            assert found[i][1] == want[1] and (found[i][0] == want[0] or abs(found[i][0] - want[0]) < 1e-12), (sampling, limit, i)
        assert found[900] == found[901] == found[902] == (None, None) and len(found) == len(p) + 3
    assert len(asked) == 3 and asked[0] < 60  # with a limit within the looks nobody else is asked


def test_no_copies_beyond_the_volumes(spark):
    """Copies go only to bricks that can hold voxels, rounds give the same; the least of repeated rows is found column by column."""
    vox = voxels(spark, [(c[0], c[1:]) for c in scene(60)])
    grid = Grid(vox, (3, 1, 4))
    ghosts = grid.with_neighbours(vox, inside=True).where("ghost")
    top = [max(r[c] for r in vox.collect()) for c in "zyx"]
    side = lambda v, n, most: {u // n for u in (v - 1, v, v + 1) if 0 <= u <= most}
    want = sum(len(side(r.z, 3, top[0])) * len(side(r.y, 1, top[1])) * len(side(r.x, 4, top[2])) - 1 for r in vox.collect())
    assert ghosts.count() == want < grid.with_neighbours(vox).where("ghost").count()
    rng = np.random.default_rng(1)
    row, given = np.append(np.arange(20), rng.integers(0, 20, 200)), [np.append(np.full(20, 2), rng.integers(0, 3, 200)) for _ in range(3)]
    want = [min(zip(*(x[row == k].tolist() for x in given), strict=True)) for k in range(20)]
    assert list(zip(*(x.tolist() for x in least(row, 20, given, [9, 9, 9])), strict=True)) == want
