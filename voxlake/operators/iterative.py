"""Iterative and neighbourhood operators (G1-G14), all images at once.

Voxels of a brick meet in one task, which settles them among themselves; only what crosses brick faces travels between rounds
(see bricks.py).  Rounds end when nothing changes; each is written to the shared folder (no lineage grows, a lost executor costs one step).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxlake.functions.scalar import gamma
from voxlake.operators.bricks import BRICK, Grid, Places, a_step_on, dealt, follow, keys, relax, whole
from voxlake.operators.dense import convolve, dense_map, mask_map, moved
from voxlake.operators.filters import gaussian, kernel
from voxlake.operators.graph import connected_components as components
from voxlake.operators.graph import roots
from voxlake.operators.joins import distance_to, nearest_point, neighbours, offsets, spread
from voxlake.operators.projections import VK
from voxlake.plans.scratch import discard, saved


def label_components(vox: DataFrame, connectivity: int = 26, brick: tuple[int, int, int] = BRICK, grid: Grid | None = None, carry: tuple[str, ...] = (), least: int = 1) -> DataFrame:
    """Instance labels 1, 2, ... of each image in raster order (of each image and time, below 80-connectivity).

    A task joins what touches inside its bricks.  Where every image is one brick that is all; else pairs across brick faces are found
    by an equi-join of face voxels, and the components of that (much smaller) graph of local roots give the labels.
    grid: sizes that are known to hold all voxels, of a table that lies in files; without it the voxels are written first.  carry: columns that
    stay with their voxels (of voxels that repeat, one row's).  least: smaller components get no label and no rows.
    """
    vox = vox.select(*VK, *carry)
    if grid is None:
        vox = saved(vox, "voxels")
        grid = Grid(vox, brick)
    extra = "".join(f", {c} {k}" for c, k in vox.dtypes if c in carry)
    half = [d for d in offsets(connectivity) if d > (0,) * len(d)]
    steps, by_time = grid.steps(half), connectivity != 80

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole(batches):
            key, once = np.unique(keys([t["image_id"].to_numpy()], grid.number(t), grid.volume), return_index=True)
            t = t.take(pa.array(once)).combine_chunks()
            place, image = grid.number(t), t["image_id"].to_numpy()
            first = me = np.arange(len(key))
            for step in steps.tolist():  # direction by direction: a table of all neighbours would be many times the brick
                src, dst = a_step_on(key, me, step)
                differ = first[src] != first[dst]
                nodes, low = roots(first[src[differ]], first[dst[differ]])
                if len(nodes):
                    now = me.copy()
                    now[nodes] = low
                    first = now[first]
            root = place[first]
            # labels for images of one brick: order of first voxels
            part = keys([image, t["t"].to_numpy()] if by_time else [image], np.zeros(len(key), np.int64), 1)
            names, which, size = np.unique(part * grid.volume + root, return_inverse=True, return_counts=True)
            large = size >= least if grid.alone else np.ones(len(size), bool)
            group, number = names // grid.volume, np.cumsum(large)
            first = np.searchsorted(group, group)
            rank = number - number[first] + large[first]
            t = t.select([*VK, *carry]).append_column("root", pa.array(root)).append_column("label", pa.array(rank[which]))
            yield from (t if large.all() else t.filter(pa.array(large[which])).combine_chunks()).to_batches()

    keyed = dealt(vox.withColumn("brick", grid.own())).mapInArrow(local, f"image_id long, t int, z int, y int, x int{extra}, root long, label long")
    if grid.alone:
        return keyed.select(*VK, *carry, "label")
    keyed = saved(keyed.drop("label"), "components")
    images = keyed.agg(F.min("image_id").alias("a"), F.max("image_id").alias("b")).first()
    if max(abs(images["a"] or 0), abs(images["b"] or 0)) * grid.volume < 1 << 62:
        node = F.col("image_id") * grid.volume
    else:  # one row an image
        numbers = keyed.select("image_id").distinct().withColumn("number", F.row_number().over(Window.orderBy("image_id")).cast("long"))
        keyed, node = saved(keyed.join(numbers, "image_id"), "components"), F.col("number") * grid.volume
    keyed = keyed.withColumn("root", node + F.col("root"))
    face = F.lit(False)
    for c, n in grid.brick.items():
        face |= (F.col(c) % n == 0) | (F.col(c) % n == n - 1)
    across = neighbours(keyed.where(face), connectivity, half=True, carry=("root",)).where("root <> n_root")
    parts = components(across, "root", "n_root").withColumnRenamed("node", "root")
    named = keyed.join(parts, "root", "left").select(*VK, *carry, F.coalesce("component", "root").alias("first"))
    by = ["image_id", "t"] if by_time else ["image_id"]
    ranks = named.groupBy(*by, "first").agg(F.count("*").alias("n")).where(F.col("n") >= least).drop("n").withColumn("label", F.row_number().over(Window.partitionBy(*by).orderBy("first")).cast("long"))
    return named.join(ranks, [*by, "first"]).select(*VK, *carry, "label")


def _flood(seeds: DataFrame, mask: DataFrame, connectivity: int, label: Column, brick: tuple[int, int, int]) -> DataFrame:
    """Breadth-first growth of all seeds at once inside a mask; of several that arrive at once the least label stays."""
    start = seeds.select(*VK, F.lit(0).alias("object"), label.cast("long").alias("label"), F.lit(0.0).alias("c"), F.lit(0).alias("hops"))
    field = mask.select(*VK, F.lit(0).alias("object"), F.lit(0.0).alias("cost"), F.lit(0.0).alias("level"))
    return relax(start, field, offsets(connectivity), lambda c, cost, level, s, d: c, brick)[0]


def grow_labels(seeds: DataFrame, mask: DataFrame, connectivity: int = 26, brick: tuple[int, int, int] = BRICK) -> DataFrame:
    """Labels grow through the mask; where several arrive at once the largest wins.  Returns seeds and grown voxels."""
    return _flood(seeds, mask, connectivity, -F.col("label"), brick).select(*VK, (-F.col("label")).alias("label"))


def ellipsoid(radii: tuple[float, float, float]) -> list[tuple[int, int, int]]:
    """Offsets inside an ellipsoid; a radius of 0 is flat."""
    reach = [int(r) for r in radii]
    return [d for d in product(*(range(-r, r + 1) for r in reach)) if sum((v / r) ** 2 for v, r in zip(d, radii, strict=True) if r > 0) <= 1]


def _reach(element: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    return tuple(max(abs(v) for v in axis) for axis in zip(*element, strict=True))


def dilate(vox: DataFrame, element: list[tuple[int, int, int]], shape: tuple[int, int, int] | None = None, times: int = 1) -> DataFrame:
    """Union of shifts, clipped to a shape."""
    out = vox.select(*VK) if times else vox.select(*VK).distinct()
    for _ in range(times):
        out = mask_map(out, _reach(element), lambda mask: reduce(np.logical_or, (moved(mask, d) for d in element)))
        if shape:
            out = out.where(F.col("z").between(0, shape[0] - 1) & F.col("y").between(0, shape[1] - 1) & F.col("x").between(0, shape[2] - 1))
    return out


def erode(vox: DataFrame, element: list[tuple[int, int, int]]) -> DataFrame:
    """Voxels under which the whole element lies; outside a volume is empty."""
    return mask_map(vox, _reach(element), lambda mask: reduce(np.logical_and, (moved(mask, tuple(-v for v in d)) for d in element)))


def shell_of(vox: DataFrame) -> DataFrame:
    """The empty cells that touch a voxel (26 neighbours), also beyond the volume."""

    def around(mask: np.ndarray) -> np.ndarray:
        wide = mask
        for axis in ((1, 0, 0), (0, 1, 0), (0, 0, 1)):
            wide = wide | moved(wide, axis) | moved(wide, tuple(-v for v in axis))
        return wide & ~mask

    return mask_map(vox, (1, 1, 1), around)


def inside_distance(vox: DataFrame, cap: int) -> DataFrame:
    """Distance of every voxel to the nearest empty one, up to a cap; cells around the object and beyond its volume are empty."""

    def depth(arrays: list[np.ndarray]) -> list[np.ndarray]:
        # a cell beyond the array is empty, or farther than the cap
        d2 = spread(np.where(np.pad(arrays[0], ((0, 0), (1, 1), (1, 1), (1, 1))) > 0, np.inf, 0.0), [cap] * 3, (1.0, 1.0, 1.0))
        return [np.sqrt(d2[:, 1:-1, 1:-1, 1:-1])]

    own = vox.select(*VK).distinct().withColumn("full", F.lit(1.0))
    found = dense_map(own, ["full"], VK, {"z": cap, "y": cap, "x": cap}, depth, ["distance"])
    return found.withColumn("distance", F.when(F.col("distance") <= cap, F.col("distance")))


def full_depth(vox: DataFrame) -> DataFrame:
    """inside_distance at every depth."""
    own = saved(vox.select(*VK).distinct(), "voxels")
    return distance_to(own, saved(shell_of(own), "shell"))


def seeds_from_distance(vox: DataFrame, frac: float = 0.1) -> DataFrame:
    """6-connected components of the voxels deeper than a share of their image's greatest depth."""
    deep = saved(full_depth(vox), "depth")
    top = deep.groupBy("image_id").agg(F.max("distance").alias("top"))
    return label_components(deep.join(top, "image_id").where(F.col("distance") > frac * F.col("top")), 6)


def seeded_split(mask: DataFrame, seeds: DataFrame, priority: str, connectivity: int = 26, brick: tuple[int, int, int] = BRICK) -> DataFrame:
    """Every mask voxel to the seed that floods it first: least highest priority on the way; of such ways (best up to every voxel of
    theirs) the one with fewest steps, then the smallest seed."""
    zero = F.lit(0).alias("object")
    seeds = saved(seeds.select(*VK, "label"), "seeds")
    start = seeds.select(*VK, zero, F.lit(0).alias("label"), F.lit(float("-1.7e308")).alias("c"), F.lit(0).alias("hops"))
    field = mask.select(*VK, zero, F.col(priority).cast("double").alias("cost"), F.lit(0.0).alias("level"))
    levels = relax(start, field, offsets(connectivity), lambda c, cost, level, s, d: np.maximum(c, cost[d]), brick)[0]
    field = levels.select(*VK, zero, F.coalesce("cost", F.col("c")).alias("cost"), F.col("c").alias("level"))
    start = seeds.select(*VK, zero, F.col("label"), F.lit(0.0).alias("c"), F.lit(0).alias("hops"))
    tight = lambda c, cost, level, s, d: np.where(np.maximum(level[s], cost[d]) == level[d], 0.0, np.inf)
    return relax(start, field, offsets(connectivity), tight, brick)[0].select(*VK, "label")


def geodesic_start(labelled: DataFrame) -> DataFrame:
    """The voxel of each component with least z + y + x; ties in raster order."""
    order = F.struct((F.col("z") + F.col("y") + F.col("x")).alias("s"), "z", "y", "x")
    return labelled.groupBy("image_id", "t", "label").agg(F.min_by(F.struct("z", "y", "x"), order).alias("p")).select("image_id", "t", "p.*")


def geodesic(labelled: DataFrame, start: DataFrame | None = None, brick: tuple[int, int, int] = BRICK) -> DataFrame:
    """Steps (6 neighbours) inside each component from its start."""
    if start is None:
        labelled = saved(labelled, "labelled")
    seeds = geodesic_start(labelled) if start is None else start
    return _flood(seeds, labelled, 6, F.lit(0), brick).select(*VK, F.col("hops").cast("int").alias("hops"))


def geodesic_to_objects(points: DataFrame, field: DataFrame, keys: list[str], res: float) -> DataFrame:
    """The geodesic value at the nearest field voxel of each point, times the resolution."""
    return nearest_point(points, field, keys, ["hops"]).withColumn("geodesic", F.col("hops") * res)


_CUBE = [d for d in product((-1, 0, 1), repeat=3) if any(d)]


#: Sides from which border voxels are taken, in this order.
_SIDES = [(0, -1, 0), (0, 1, 0), (0, 0, 1), (0, 0, -1), (1, 0, 0), (-1, 0, 0)]
_BEFORE = 13  # of _CUBE come before a voxel in raster order


def _masks() -> tuple[list[int], list[int], list[int], list[int]]:
    """Bits of _CUBE: of each step those that touch it; and those that share each face, edge and corner of the middle voxel."""
    near = [sum(1 << j for j, b in enumerate(_CUBE) if a != b and max(abs(p - q) for p, q in zip(a, b, strict=True)) == 1) for a in _CUBE]
    shared = lambda d: sum(1 << i for i, c in enumerate(_CUBE) if all(q in (0, p) for p, q in zip(d, c, strict=True)))
    parts = [[shared(d) for d in _CUBE if sum(map(abs, d)) == n] for n in (1, 2, 3)]
    return near, *parts


_NEAR, _FACES, _EDGES, _CORNERS = _masks()


def euler_kept(code: np.ndarray) -> np.ndarray:
    """Whether deleting a voxel with these neighbours (bit i: _CUBE[i]) keeps the Euler number of the union of closed voxels: what it alone has of
    corners - edges + faces must be 1."""
    alone = lambda masks: sum(((code & m) == 0).astype(np.int64) for m in masks)
    return alone(_CORNERS) - alone(_EDGES) + alone(_FACES) == 1


def in_one_piece(code: np.ndarray) -> np.ndarray:
    """Whether the neighbours touch each other in one piece (or there are none)."""
    reach = code & -code
    while True:
        more = reach.copy()
        for i, m in enumerate(_NEAR):
            more |= np.where(more >> i & 1, m & code, 0)
        if (more == reach).all():
            return reach == code
        reach = more


def _codes(alive: np.ndarray, near: np.ndarray) -> np.ndarray:
    return alive[near] @ (1 << np.arange(len(_CUBE)))


def _candidates(alive: np.ndarray, near: np.ndarray, side: int, mine: np.ndarray) -> np.ndarray:
    """Of some voxels those of a side's border that are no ends of lines and may go without a change of topology."""
    mine = mine[alive[mine] & ~alive[near[mine, side]]]
    code = _codes(alive, near[mine])
    ok = (code & (code - 1) != 0) & euler_kept(code)
    mine, code = mine[ok], code[ok]
    return mine[in_one_piece(code)]


def _recheck(alive: np.ndarray, near: np.ndarray, waiting: np.ndarray, open_: np.ndarray) -> None:
    """Candidates in raster order, each removed if its neighbours are in one piece by then; all whose earlier neighbours are decided go at once.

    waiting: which voxels are undecided, also those that others decide."""
    while len(open_):
        blocked = waiting[near[open_, :_BEFORE]].any(axis=1)
        ready = open_[~blocked]
        if not len(ready):
            return
        alive[ready[in_one_piece(_codes(alive, near[ready]))]] = False
        waiting[ready] = False
        open_ = open_[blocked]


def _neighbour_rows(key: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Rows of sorted keys a step on in each direction; len(key) where there is none."""
    near = np.empty((len(key), len(steps)), np.int32)
    for i, s in enumerate(steps.tolist()):
        at = np.minimum(np.searchsorted(key, key + s), len(key) - 1)
        near[:, i] = np.where(key[at] == key + s, at, len(key))
    return near


def thin(vox: DataFrame, brick: tuple[int, int, int] = BRICK) -> DataFrame:
    """One-voxel centrelines by six-sided thinning, as the usual 3-D skeleton: from one side after the other, border voxels that are no ends of lines and
    whose removal keeps the Euler number and the pieces around them are candidates; then candidates are checked again in raster order, each
    after those before it.  The end is a turn of all six sides without removal.

    Images of one brick are thinned in one job.  Else a side is a job that finds candidates and rounds that check them: a brick decides what
    does not wait for voxels of the bricks before it, and only bricks with candidates left go on.
    """
    now = saved(vox.select(*VK).distinct(), "thin")
    grid = Grid(now, brick)
    steps, sides = grid.steps(_CUBE), [_CUBE.index(d) for d in _SIDES]
    kept = "image_id long, t int, z int, y int, x int"

    def whole_images(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole(batches):
            key = keys([t["image_id"].to_numpy()], grid.number(t), grid.volume)
            order = np.argsort(key)
            near, alive = _neighbour_rows(key[order], steps), np.append(np.ones(len(key), bool), False)
            # voxels far from the last removals stay what they are: only those around changes are looked at again
            look, quiet = {s: np.arange(len(key)) for s in sides}, 0
            while quiet < 6:
                for s in sides:
                    found = _candidates(alive, near, s, look[s])
                    look[s] = np.empty(0, np.int64)
                    waiting = np.zeros(len(alive), bool)
                    waiting[found] = True
                    before = alive[found].copy()
                    _recheck(alive, near, waiting, found)
                    gone = found[before & ~alive[found]]
                    quiet = 0 if len(gone) else quiet + 1
                    if len(found) > len(gone):
                        look[s] = found[alive[found]]
                    if len(gone):
                        again = np.unique(near[gone])
                        again = again[again < len(key)]
                        look = {k: np.union1d(v, again) for k, v in look.items()}
            yield from t.select(VK).take(pa.array(order[alive[:-1]])).combine_chunks().to_batches(max_chunksize=100_000)

    if grid.alone:
        return dealt(now.withColumn("brick", grid.own())).mapInArrow(whole_images, kept)

    def one_side(batches: Iterator[pa.RecordBatch], side: int | None) -> Iterator[pa.RecordBatch]:
        """side: finds candidates (waiting); without one, decides them."""
        for t in whole(batches):
            key = keys([t["image_id"].to_numpy(), t["brick"].to_numpy()], grid.number(t), grid.volume)
            order = np.argsort(key)
            near, alive = _neighbour_rows(key[order], steps), np.append(np.ones(len(key), bool), False)
            own = ~t["ghost"].to_numpy()[order]
            waiting = np.append(t["waiting"].to_numpy()[order], False)
            if side is not None:
                waiting[:] = False
                waiting[_candidates(alive, near, side, np.flatnonzero(own))] = True
            else:
                _recheck(alive, near, waiting, np.flatnonzero(own & waiting[:-1]))
            mine = np.flatnonzero(own & alive[:-1])
            yield from t.select(["brick", *VK]).take(pa.array(order[mine])).append_column("waiting", pa.array(waiting[mine])).combine_chunks().to_batches(max_chunksize=100_000)

    def step(state: DataFrame, side: int | None) -> DataFrame:
        ghosts = grid.to_neighbours(state.select(*VK, "waiting")).withColumn("ghost", F.lit(True))
        rows = state.withColumn("ghost", F.lit(False))
        if side is None:  # bricks without candidates stay as they are
            open_ = state.where("waiting").select("brick").distinct()
            rest = state.join(open_, "brick", "left_anti")
            rows, ghosts = rows.join(open_, "brick", "left_semi"), ghosts.join(open_, "brick", "left_semi")
        found = dealt(rows.unionByName(ghosts)).mapInArrow(lambda b: one_side(b, side), "brick long, " + kept + ", waiting boolean")
        out = saved(found if side is not None else found.unionByName(rest), "thin")
        discard(state)
        return out

    state, quiet = saved(now.withColumn("brick", grid.own()).withColumn("waiting", F.lit(False)), "thin"), 0
    count = state.count()
    discard(now)
    while True:
        for s in sides:
            state = step(state, s)
            while not state.where("waiting").isEmpty():
                state = step(state, None)
            before, count = count, state.count()
            quiet = quiet + 1 if count == before else 0
            if quiet == 6:
                return state.select(*VK)


WHOLE = 1 << 19  # cells of images that are worked on whole; a task fills some fifteen arrays of so many at once
_BLUR, _SMOOTH = {"z": 0.25, "y": 10.0, "x": 10.0}, {"z": 0.5, "y": 0.5, "x": 0.5}


def _cost_arrays(arrays: list[np.ndarray]) -> list[np.ndarray]:
    """G10 on arrays (image, t, z, y, x): intensities, and counts of rows of the intensity, of the target and of the objects."""
    v, here, aim, own = arrays
    here, shape = here > 0, v.shape
    flat = (-1, *shape[2:])
    away = np.sqrt(spread(np.where(aim > 0, 0.0, np.inf).reshape(flat), [n - 1 for n in flat[1:]], (1.0, 1.0, 1.0))).reshape(shape)
    away[np.isinf(away)] = 1.0
    over = lambda a: np.where(here, a, -np.inf).max(axis=(1, 2, 3, 4), keepdims=True)
    top, far = over(v), over(away)
    share = np.divide(away, far, out=np.zeros(shape), where=here & (far > 0))
    g = np.divide(v, top, out=np.zeros(shape), where=here & (top != 0) & np.isfinite(top))
    g = np.where(here & ~(own > 0), np.clip(g, 0.0, 1.0) ** 0.4, 0.0)
    smooth = lambda a, sigma: reduce(lambda b, axis: convolve(b, kernel(sigma[axis]), "zyx".index(axis) + 1), "zyx", a.reshape(flat)).reshape(shape)
    return [smooth(np.where(here, share / (0.2 * g + 0.3 * smooth(g, _BLUR) + 1e-6), 0.0), _SMOOTH)]


def path_cost_field(objects: DataFrame, target: DataFrame, intensity: DataFrame, value: str) -> DataFrame:
    """Cost of every intensity voxel: distance to the target over its maximum, divided by 0.2 g + 0.3 blur(g) + 1e-6.

    g = (intensity / maximum) ** 0.4 outside the objects; blurred with sigma (0.25, 10, 10); the cost with sigma 0.5.  In an image
    without a target every voxel is as far as any.  Where every image fits into an array, one shuffle brings its rows together and a task does the rest.
    """
    flag = lambda on: F.lit(1.0 if on else None).cast("double")
    part = lambda df, v, *on: df.select(*VK, v.cast("double").alias("v"), *[flag(o).alias(n) for o, n in zip(on, ("here", "aim", "own"), strict=True)])
    rows = saved(part(intensity, F.col(value), True, False, False).unionByName(part(target, F.lit(None), False, True, False)).unionByName(part(objects, F.lit(None), False, False, True)), "cost-input")
    ends = rows.agg(*[f(c).alias(f"{n}{c}") for n, f in (("a", F.min), ("b", F.max)) for c in "tzyx"]).first()
    extent = {c: (ends[f"b{c}"] or 0) + 1 for c in "tzyx"}
    if min(ends[f"a{c}"] or 0 for c in "tzyx") >= 0 and max(extent[c] for c in "zyx") <= 256 and np.prod([float(n) for n in extent.values()]) <= WHOLE:
        rows = rows.withColumn("asked", F.col("here").isNotNull())
        return dense_map(rows, ["v", "here", "aim", "own"], VK, dict.fromkeys("tzyx", 0), _cost_arrays, ["cost"], block=extent, asked="asked", cells=WHOLE)
    discard(rows)
    away = saved(distance_to(intensity.select(*VK, value), target), "distance").withColumn("distance", F.coalesce("distance", F.lit(1.0)))
    top = away.groupBy("image_id").agg(F.max(value).alias("top"), F.max("distance").alias("far"))
    own = objects.select(*VK).distinct().withColumn("own", F.lit(True))
    g = away.join(top, "image_id").join(own, VK, "left").withColumn("g", F.when(F.col("own"), 0.0).otherwise(gamma(F.col(value), F.col("top"))))
    g = saved(g.select(*VK, "g", F.coalesce(F.try_divide(F.col("distance"), F.col("far")), F.lit(0.0)).alias("share")), "gamma")
    blur = gaussian(g, "g", _BLUR, VK).withColumnRenamed("g", "blur")
    raw = saved(g.join(blur, VK).select(*VK, (F.col("share") / (0.2 * F.col("g") + 0.3 * F.col("blur") + 1e-6)).alias("cost")), "cost")
    return gaussian(raw, "cost", _SMOOTH, VK)


def greedy_paths(cost: DataFrame, objects: DataFrame, target: DataFrame, steps: int = 200, most: float = 20.0, brick: tuple[int, int, int] = BRICK) -> DataFrame:
    """From each object's cheapest shell voxel, always to the cheapest of the 27 voxels around (a pure z step wins when no worse), until a
    voxel of the target's shell; stalled and unfinished paths are dropped, as are steps dearer than most.  Ties: smallest z, y, x.

    The next voxel depends on the place alone, so it is found once for every voxel, and all paths follow these pointers.  Costs, target and objects meet in one
    shuffle; images of one brick are done with there, else paths go on from brick to brick.
    """
    blank = {"cost": "double", "label": "long"}
    part = lambda df, kind, **given: df.select(*VK, F.lit(kind).alias("kind"), *[given.get(c, F.lit(None)).cast(k).alias(c) for c, k in blank.items()])
    parts = [part(cost, _COST, cost=F.round("cost", 9)), part(target, _AIM), part(objects, _BODY, label=F.col("label"))]
    table = saved(reduce(DataFrame.unionByName, parts), "paths-input")
    grid = Grid(table.where(F.col("kind") == _COST), brick)
    moves = [d for d in product((-1, 0, 1), repeat=3) if any(d)]
    around = list(zip(grid.steps(moves).tolist(), [d[1:] != (0, 0) for d in moves], strict=True))
    near = F.lit(True)  # target and objects farther than a step from all costs have no number, and touch none
    for c in "tzyx":
        near &= F.col(c).between(-1, grid.size[c] - 2)
    rows = table.where(near)
    rows = rows.withColumns({"brick": F.xxhash64("image_id"), "ghost": F.lit(False)}) if grid.alone else grid.with_neighbours(rows, inside=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole(batches):
            t, places, state = _pointers(t, grid, around)
            first, at = _path_starts(t, grid, around, places, state["body"])
            if grid.alone:
                yield from _walked(t, state, first, at, steps, most)
                continue
            mine = np.flatnonzero(~t["ghost"].to_numpy()[: len(state["next"])])
            onward = state["next"][mine]
            out = t.select([*VK, "cost"]).take(pa.array(np.append(mine, at)))
            nulls = lambda kind: pa.nulls(len(at), kind)
            for name, some, rest in (
                ("next", pa.array(grid.number(t)[np.maximum(onward, 0)], mask=onward < 0), nulls(pa.int64())),
                ("end", pa.array(state["end"][mine]), nulls(pa.bool_())),
                ("body", pa.array(state["body"][mine]), nulls(pa.bool_())),
                ("label", pa.nulls(len(mine), pa.int64()), first["label"].combine_chunks()),
            ):
                out = out.append_column(name, pa.concat_arrays([some, rest]))
            yield from out.combine_chunks().to_batches(max_chunksize=100_000)

    place = "image_id long, t int, z int, y int, x int, cost double"
    if grid.alone:
        return dealt(rows).mapInArrow(run, place + ", label long, step int").select(*VK, "label", "step", "cost")
    found = saved(dealt(rows).mapInArrow(run, place + ", next long, end boolean, body boolean, label long"), "pointers")
    discard(table)
    by = ["image_id", "t", "label"]
    first = found.where("label is not null").groupBy(*by).agg(F.min_by(F.struct("z", "y", "x"), F.struct("cost", "z", "y", "x")).alias("p")).select(*by, "p.*")
    none = F.lit(0).cast("long").alias("object")
    pointers = found.where("label is null").select(*VK, none, F.coalesce("next", F.lit(-1).cast("long")).alias("next"), "cost", "end", "body")
    every = saved(follow(grid, pointers, first.select(*VK, none, "label"), steps, ("cost", "end", "body")), "paths")
    every = every.join(every.where("end").select(*by).distinct(), by, "left_semi").where((F.col("cost") <= most) & ~F.col("body"))
    return every.select(*VK, "label", F.col("step").cast("int").alias("step"), "cost")


_COST, _AIM, _BODY = 0, 1, 2


def _pointers(t: pa.Table, grid: Grid, around: list[tuple[int, bool]]) -> tuple[pa.Table, Places, dict[str, np.ndarray]]:
    """Whole bricks with the rows of costs first, in the order of their keys (column key), then the others; where costs are; and of each cost's row whether it lies
    in an object (body), whether a path ends there (end), and the row of the next voxel (-1: none)."""
    key = keys([t["image_id"].to_numpy(), t["brick"].to_numpy()], grid.number(t), grid.volume)
    kind = t["kind"].to_numpy()
    order = np.lexsort((key, kind))
    t, key, kind = t.take(pa.array(order)).append_column("key", pa.array(key[order])).combine_chunks(), key[order], kind[order]
    n = int(np.searchsorted(kind, _AIM))
    names, value, place = key[:n], t["cost"].to_numpy()[:n], grid.number(t)[:n]
    places, aims = Places(names), np.unique(key[kind == _AIM])
    aim, end, body = np.zeros(n, bool), np.zeros(n, bool), np.zeros(n, bool)
    for out, some in ((aim, aims), (body, np.unique(key[kind == _BODY])), *((end, aims + s) for s, _ in around)):
        at = places.rows(some)
        out[at[at >= 0]] = True
    end &= ~aim
    best, turn, onward, row = np.where(aim, np.inf, value), np.ones(n, bool), place.copy(), np.full(n, -1)  # to stay is a stall
    for s, turns in around:
        at = places.rows(names + s)
        offer = np.where((at >= 0) & ~aim[at], value[at], np.inf) if n else value
        better = np.isfinite(offer) & _earlier(offer, turns, place + s, best, turn, onward)
        best, turn, onward, row = np.where(better, offer, best), np.where(better, turns, turn), np.where(better, place + s, onward), np.where(better, at, row)
    return t, places, {"body": body, "end": end, "next": np.where(end, -1, row)}


def _path_starts(t: pa.Table, grid: Grid, around: list[tuple[int, bool]], places: Places, body: np.ndarray) -> tuple[pa.Table, np.ndarray]:
    """The objects whose shells have costs here (image_id, t, label), and the row of the cheapest voxel of each shell; ties in raster order."""
    n = len(body)
    bodies = t.filter(pa.array(t["kind"].to_numpy() == _BODY)).combine_chunks()
    by = [bodies[c].to_numpy() for c in ("image_id", "t", "label")]
    key, open_ = bodies["key"].to_numpy(), ~t["ghost"].to_numpy()[:n] & ~body
    thing = keys([*by, bodies["brick"].to_numpy()], np.zeros(len(key), np.int64), 1)
    cost = t["cost"].fill_null(-np.inf).to_numpy()[:n]  # a cost that is null comes first, NaN last
    things, rows = [], []
    for s, _ in around:
        at = places.rows(key + s)
        use = np.flatnonzero((at >= 0) & open_[at]) if n else np.empty(0, np.int64)
        things.append(thing[use])
        rows.append(at[use])
        if sum(map(len, rows[1:])) > len(key):  # candidates are reduced before they are many
            things, rows = ([x] for x in _cheapest(np.concatenate(things), np.concatenate(rows), cost))
    which, at = _cheapest(np.concatenate(things), np.concatenate(rows), cost)
    head = np.unique(thing, return_index=True)
    return bodies.select(["image_id", "t", "label"]).take(pa.array(head[1][np.searchsorted(head[0], which)])), at


def _cheapest(thing: np.ndarray, row: np.ndarray, cost: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((row, cost[row], thing))  # rows are in raster order
    thing, row = thing[order], row[order]
    first = np.append(True, thing[1:] != thing[:-1])[: len(thing)]
    return thing[first], row[first]


def _walked(t: pa.Table, state: dict[str, np.ndarray], first: pa.Table, at: np.ndarray, steps: int, most: float) -> Iterator[pa.RecordBatch]:
    """The voxels of all paths that arrive, from their starts on: VK, cost, label, step."""
    who, rows, walks = np.arange(len(at)), [], []
    for step in range(steps):
        rows.append(at)
        walks.append((who, np.full(len(at), step, np.int32)))
        go = state["next"][at] >= 0
        who, at = who[go], state["next"][at[go]]
        if not len(at):
            break
    at, who, step = np.concatenate(rows), np.concatenate([w for w, _ in walks]), np.concatenate([s for _, s in walks])
    arrived = np.zeros(len(first), bool)
    arrived[who[state["end"][at]]] = True
    cost = t["cost"].to_numpy()[at]
    kept = np.flatnonzero(arrived[who] & (cost <= most) & ~state["body"][at])
    out = t.select([*VK, "cost"]).take(pa.array(at[kept])).append_column("label", first["label"].take(pa.array(who[kept]))).append_column("step", pa.array(step[kept]))
    yield from out.combine_chunks().to_batches(max_chunksize=100_000)


def _earlier(offer: np.ndarray, turn: bool, place: np.ndarray, best: np.ndarray, was: np.ndarray, there: np.ndarray) -> np.ndarray:
    """Cheaper; of equals a pure z step; of equals the smaller place."""
    return (offer < best) | (offer == best) & ((turn < was) | (turn == was) & (place < there))


def neck_generation(spines: DataFrame, necks: DataFrame | None, dendrites: DataFrame, intensity: DataFrame, value: str, steps: int = 200) -> DataFrame:
    """Necks of spines: (VK, label) without spine and dendrite voxels.

    With a neck class: spines grow through it; paths lead from what has grown to the dendrite or to neck voxels left over; both grow on
    through the left-over necks that they touch.  Without one (necks is None): paths from the spines to the dendrite.
    """
    spines, dendrites = saved(spines.select(*VK, "label"), "spines"), saved(dendrites.select(*VK).distinct(), "dendrites")
    if necks is None:
        cost = path_cost_field(spines, dendrites, intensity, value)
        return greedy_paths(cost, spines, dendrites, steps).select(*VK, "label")
    necks = saved(necks.select(*VK).distinct(), "necks")
    grown = saved(grow_labels(spines, necks), "grown")
    rest = saved(necks.join(grown.select(*VK), VK, "left_anti"), "left-necks")
    target = dendrites.unionByName(rest).distinct().join(grown.select(*VK), VK, "left_anti")
    cost = path_cost_field(grown, target, intensity, value)
    paths = greedy_paths(cost, grown, target, steps).select(*VK, "label")
    both = saved(grown.unionByName(paths.join(grown.select(*VK), VK, "left_anti")).groupBy(*VK).agg(F.max("label").alias("label")), "extended")
    return grow_labels(both, rest).join(spines.select(*VK), VK, "left_anti").join(dendrites, VK, "left_anti")


def least_cost_path(cost: DataFrame, starts: DataFrame, ends: DataFrame, brick: tuple[int, int, int] = BRICK) -> DataFrame:
    """The cheapest 26-path of each object through its own voxels from its start to its end: (image_id, t, label, step from the end, z, y, x).

    cost: VK, label, cost (not below 0; of each voxel entered); objects may touch or share voxels.  Ties: fewest steps, then the smaller place.
    """
    thing = F.col("label").cast("long").alias("object")
    field = cost.select(*VK, thing, "cost", F.lit(0.0).alias("level"))
    seeds = starts.select(*VK, thing, F.lit(0).alias("label"), F.lit(0.0).alias("c"), F.lit(0).alias("hops"))
    best, grid = relax(seeds, field, offsets(26), lambda c, cost, level, s, d: np.round(c + cost[d], 9), brick)
    back = best.select(*VK, "object", F.when(F.col("hops") > 0, F.col("par")).otherwise(-1).alias("next"))
    found = follow(grid, back, ends.select(*VK, thing, "label"))
    return found.select("image_id", "t", "label", F.col("step").cast("int").alias("step"), "z", "y", "x")


def midline_cost(vox: DataFrame, sigma: float = 3.0) -> tuple[DataFrame, DataFrame]:
    """G13's cost for midlines, and each object's deepest voxel, which attracts the path: (largest depth - depth) (1 - 2 g) + 0.1 g.

    g: a Gaussian of one at the deepest voxel.  vox: VK, label.
    """
    deep = saved(full_depth(vox).join(vox.select(*VK, "label"), VK), "depth")
    order = F.struct(-F.col("distance"), F.col("z"), F.col("y"), F.col("x"))
    by = ["image_id", "t", "label"]
    top = deep.groupBy(*by).agg(F.min_by(F.struct("z", "y", "x"), order).alias("p"), F.max("distance").alias("top")).select(*by, "top", *[F.col(f"p.{c}").alias(f"e{c}") for c in "zyx"])
    taps = F.create_map(*[F.lit(v) for k, w in kernel(sigma) for v in (k, w)])
    g = reduce(lambda a, b: a * b, (F.coalesce(taps[F.col(c) - F.col(f"e{c}")], F.lit(0.0)) for c in "zyx"))
    cost = deep.join(top, by).select(*VK, "label", ((F.col("top") - F.col("distance")) * (1 - 2 * g) + 0.1 * g).alias("cost"))
    return cost, top.select("image_id", "t", "label", *[F.col(f"e{c}").alias(c) for c in "zyx"])


def deepest_point(vox: DataFrame) -> DataFrame:
    """The voxel of each object with the greatest depth; ties: smallest z, y, x."""
    deep = full_depth(vox).join(vox.select(*VK, "label"), VK)
    order = F.struct(-F.col("distance"), F.col("z"), F.col("y"), F.col("x"))
    return deep.groupBy("image_id", "t", "label").agg(F.min_by(F.struct("z", "y", "x", "distance"), order).alias("p")).select("image_id", "t", "label", "p.*")
