"""Joins (J1-J18).  Spatial joins are equi-joins on derived cells; nothing compares all pairs."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxlake.operators import bricks
from voxlake.operators.bricks import dealt, whole
from voxlake.operators.dense import BLOCK, line_distance
from voxlake.operators.filters import axis_weights
from voxlake.operators.projections import VK
from voxlake.plans.scratch import discard, saved


def merge_measurements(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """Full outer join; shared columns left first; missing numbers 0."""
    shared = [c for c in b.columns if c in a.columns and c not in on]
    right = b.withColumnsRenamed({c: f"{c}__b" for c in shared})
    out = a.join(right, on, "full_outer").withColumns({c: F.coalesce(c, f"{c}__b") for c in shared}) if shared else a.join(right, on, "full_outer")
    return out.drop(*[f"{c}__b" for c in shared]).fillna(0)


def attach_columns(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """Property columns by key (row order is no key)."""
    return a.join(b, on, "left")


def sample_field(objects: DataFrame, field: DataFrame, value: str) -> DataFrame:
    """The field's value under every object voxel."""
    return objects.join(field.select(*VK, value), VK)


def map_lookup(df: DataFrame, lookup: DataFrame, on: str) -> DataFrame:
    """A left join; the engine broadcasts the lookup when it is small."""
    return df.join(lookup, on, "left")


def merge_areas(df: DataFrame, areas: DataFrame, on: list[str]) -> DataFrame:
    """J5."""
    return df.join(areas, on, "left")


def _distance(a: str, b: str, sampling: tuple[float, float, float]) -> Column:
    return F.sqrt(sum(((F.col(f"{a}{c}") - F.col(f"{b}{c}")) * s) ** 2 for c, s in zip("zyx", sampling, strict=True)))


def _ring(points: DataFrame, *columns: str) -> DataFrame:
    """The 27 cells around the cell gz, gy, gx of each row."""
    around = F.explode(F.array(*[F.struct(*[F.lit(d).alias(n) for d, n in zip(ds, ("dz", "dy", "dx"), strict=True)]) for ds in product((-1, 0, 1), repeat=3)])).alias("d")
    return points.select(*columns, "gz", "gy", "gx", around).select(*columns, *[(F.col(f"g{c}") + F.col(f"d.d{c}")).alias(f"g{c}") for c in "zyx"])


def _nearest_of(found: DataFrame, keys: list[str], by: list[str], payload: list[str], sampling: tuple[float, float, float]) -> DataFrame:
    """b: the nearest of the targets tz, ty, tx that each point pz, py, px met."""
    order = F.struct(F.round("distance", 9).alias("d"), F.col("tz"), F.col("ty"), F.col("tx"), *payload)
    found = found.withColumn("distance", _distance("p", "t", sampling))
    return found.groupBy(*keys, *by).agg(F.min_by(F.struct("distance", *payload), order).alias("b"))


def nearest_point(points: DataFrame, targets: DataFrame, keys: list[str], payload: list[str], sampling: tuple[float, float, float] = (1.0, 1.0, 1.0), cell: float = 4.0, max_dist: float | None = None, by: list[str] | None = None) -> DataFrame:
    """The nearest target of every point (ties, up to 1e-9: smallest z, y, x, then payload).

    points: keys, image_id, z, y, x; targets: image_id, z, y, x, payload.  Two rings of a grid (cells of `cell`, then of twice that) settle points whose
    match is nearer than the ring is wide; all others, at whatever distance, are settled in one pass over cells of their own size (_far_nearest).
    Whole coordinates are looked up in bricks before (_nearest_of_places).
    Points beyond max_dist, without place, or in an image without any target, get nulls.  by: what image_id stands for.
    """
    by = by or ["image_id"]
    asked = points.select(*keys, *by, "z", "y", "x")
    if all(dict(df.dtypes)[c] in ("tinyint", "smallint", "int", "bigint") for df in (points, targets) for c in "zyx"):
        return _nearest_of_places(asked, targets, keys, payload, sampling, cell, max_dist, by)
    return _nearest_rows(asked, targets, keys, payload, sampling, cell, max_dist, by)


WINDOW = 4  # steps an axis that points look around in their brick


def _looks(sampling: tuple[float, float, float], far: float) -> list[tuple[float, tuple[int, int, int]]]:
    """Steps to all places within a distance, nearest first; ties, up to 1e-9: smallest z, y, x."""
    reach = [int(far / s + 1e-9) for s in sampling]
    found = ((math.sqrt(sum((v * s) ** 2 for v, s in zip(d, sampling, strict=True))), d) for d in product(*(range(-r, r + 1) for r in reach)))
    return sorted((f for f in found if round(f[0], 9) <= round(far, 9)), key=lambda f: (round(f[0], 9), f[1]))


def _nearest_of_places(asked: DataFrame, targets: DataFrame, keys: list[str], payload: list[str], sampling: tuple[float, float, float], cell: float, max_dist: float | None, by: list[str]) -> DataFrame:
    """J6 on whole coordinates: many points and targets may share a place, so places are matched, each with its least payload.

    Places meet in bricks, where one that is asked for looks at one place around after the other, nearest first: no row is made for a pair.  Those with
    nothing within `cell` (and WINDOW steps) are searched for as rows."""
    names, there = [*by, "z", "y", "x"], [f"there_{c}" for c in "zyx"]
    placed = " and ".join(f"abs({c}) < 1e15" for c in "zyx") + "".join(f" and {c} is not null" for c in by)
    asked = saved(asked, "asked")
    least = targets.where(placed).select(*names, F.struct(*payload, F.lit(0).alias("none_")).alias("p")).groupBy(*names).agg(F.min("p").alias("p"))
    least = saved(least.select(*names, *[F.col(f"p.{c}").alias(c) for c in payload], *[F.col(c).alias(f"there_{c}") for c in "zyx"]), "places")
    far = max(0.0, min(cell, WINDOW * min(sampling), math.inf if max_dist is None else max_dist))
    looks = _looks(sampling, far)
    reach = {c: max(abs(d[i]) for _, d in looks) for i, c in enumerate("zyx")}
    worth = [f"v{i}" for i in range(len(payload) + 3)]
    ask = asked.where(placed).select(*names).distinct().withColumn("asks", F.lit(True))
    aim = least.select(*names, F.lit(False).alias("asks"), *[F.col(c).alias(v) for c, v in zip([*payload, *there], worth, strict=True)])
    both = ask.unionByName(aim, allowMissingColumns=True)
    for c, r in reach.items():  # a brick's own cells begin a reach before its multiple of the size
        low, high = F.col(c) + F.when(F.col("asks"), r).otherwise(0), F.col(c) + F.when(F.col("asks"), r).otherwise(2 * r)
        both = both.withColumn(f"brick_{c}", F.explode(F.sequence(F.floor(low / BLOCK[c]), F.floor(high / BLOCK[c]))))
    which = [*by, *[f"brick_{c}" for c in "zyx"]]
    kinds = dict(both.dtypes)
    schema = ", ".join([f"{c} {kinds[c]}" for c in names] + ["distance double"] + [f"{c} {kinds[c]}" for c in worth] + ["settled boolean"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole(batches):
            asks = t["asks"].to_numpy()
            space = [t[c].combine_chunks().dictionary_encode().indices.to_numpy() for c in which]
            # numbers of places have room for every look over the sides
            number, step = np.zeros(t.num_rows, np.int64), np.zeros(len(looks), np.int64)
            for i, c in enumerate("zyx"):
                at = t[c].to_numpy() - t[f"brick_{c}"].to_numpy() * BLOCK[c]
                n = int(at.max() - at.min()) + 1 + 2 * reach[c]
                number = number * n + (at - at.min() + reach[c])
                step = step * n + np.array([d[i] for _, d in looks])
            key = bricks.keys(space, number, int(number.max()) + int(np.abs(step).max()) + 1)
            rows = np.flatnonzero(~asks)
            rows = rows[np.argsort(key[rows])]
            places, want = bricks.Places(key[rows]), np.flatnonzero(asks)
            row, distance = np.full(len(want), -1), np.full(len(want), np.nan)
            todo = np.arange(len(want))
            for (d, _), s in zip(looks, step.tolist(), strict=True):
                at = places.rows(key[want[todo]] + s)
                hit = at >= 0
                row[todo[hit]], distance[todo[hit]] = rows[at[hit]], d
                todo = todo[~hit]
                if not len(todo):
                    break
            settled = row >= 0
            if max_dist is not None:
                row[distance > max_dist] = -1
            out, take = t.select(names).take(pa.array(want)).append_column("distance", pa.array(distance, mask=row < 0)), pa.array(row, mask=row < 0)
            for c in worth:
                out = out.append_column(c, t[c].combine_chunks().take(take))
            yield from out.append_column("settled", pa.array(settled)).combine_chunks().to_batches(max_chunksize=100_000)

    found = saved(dealt(both.withColumn("brick", F.xxhash64(*which))).mapInArrow(run, schema), "nearest")
    best = found.where("settled").select(*names, "distance", *[F.col(v).alias(c) for c, v in zip([*payload, *there], worth, strict=True)])
    left = found.where("not settled").select(*names)
    if (max_dist is None or max_dist > far) and not left.isEmpty():
        away = left.select(*by, *[F.col(c).alias(f"a{c}") for c in "zyx"], "z", "y", "x")
        rest = _nearest_rows(away, least, ["az", "ay", "ax"], [*payload, *there], sampling, cell, max_dist, by)
        best = best.unionByName(rest.select(*by, *[F.col(f"a{c}").alias(c) for c in "zyx"], "distance", *payload, *there))
    else:
        discard(least)
    order = F.struct(F.col("distance").isNull(), F.round("distance", 9), *there, *payload)  # of a key's rows at several places the nearest
    best = asked.join(best, names, "left").groupBy(*keys, *by).agg(F.min_by(F.struct("distance", *payload), order).alias("b"))
    return best.select(*keys, *by, "b.*")


def _nearest_rows(asked: DataFrame, targets: DataFrame, keys: list[str], payload: list[str], sampling: tuple[float, float, float], cell: float, max_dist: float | None, by: list[str]) -> DataFrame:
    found_all = []
    placed = " and ".join(f"abs({c}) < 1e15" for c in "zyx")  # neither null nor NaN
    targets = targets.where(placed).select(*by, *[F.col(c).alias(f"t{c}") for c in "zyx"], *payload)
    todo = asked.where(placed).join(targets.select(*by).distinct(), by, "left_semi").select(*keys, *by, *[F.col(c).alias(f"p{c}") for c in "zyx"])
    grid = lambda size, name: [F.floor(F.col(f"{name}{c}") * s / size).cast("long").alias(f"g{c}") for c, s in zip("zyx", sampling, strict=True)]
    for size in (cell, 2 * cell):
        near = _ring(todo.select("*", *grid(size, "p")), *keys, *by, "pz", "py", "px")
        best = _nearest_of(near.join(targets.select("*", *grid(size, "t")), [*by, "gz", "gy", "gx"]), keys, by, payload, sampling)
        if max_dist is not None and size >= max_dist:
            found_all.append(best.where((F.col("b.distance") <= size) & (F.col("b.distance") <= max_dist)))
            break
        sure = saved(best.where(F.col("b.distance") <= size), "nearest")
        found_all.append(sure if max_dist is None else sure.where(F.col("b.distance") <= max_dist))
        todo = saved(todo.join(sure.select(*keys, *by), [*keys, *by], "left_anti"), "unmatched")
        if todo.isEmpty():
            break
    else:
        best = _far_nearest(todo, targets, keys, by, payload, sampling, cell)
        found_all.append(best if max_dist is None else best.where(F.col("b.distance") <= max_dist))
    found = reduce(DataFrame.unionByName, found_all).select(*keys, *by, "b.*")
    return asked.select(*keys, *by).distinct().join(found, [*keys, *by], "left")


def _far_nearest(todo: DataFrame, targets: DataFrame, keys: list[str], by: list[str], payload: list[str], sampling: tuple[float, float, float], cell: float) -> DataFrame:
    """The nearest target of points at any distance, by cells of cell * 2^l of every level l: as many jobs for any distance.

    A point's level is the first whose 27 cells around hold a target, which is then less than four cells away.  So the ring two levels up
    holds the nearest; its occupied cells of the point's level are met first, then the quarter-size cells of those that can hold
    the nearest, then the targets of those that still can.
    """
    base = lambda name: [F.floor(F.col(f"{name}{c}") * s / (cell / 4)).cast("long").alias(f"o{c}") for c, s in zip("zyx", sampling, strict=True)]
    at = lambda level, name: [F.floor(F.col(f"o{c}") / F.pow(F.lit(2.0), level + 2)).cast("long").alias(f"{name}{c}") for c in "zyx"]
    todo, targets = todo.select("*", *base("p")), targets.select("*", *base("t"))
    cells = ["oz", "oy", "ox"]
    occupied = saved(targets.select(*by, *cells).distinct(), "cells-occupied")
    asking = saved(todo.select(*by, *cells).distinct(), "cells-asking")
    ends = asking.select(*cells).unionByName(occupied.select(*cells)).agg(*[f(c).alias(f"{n}{c}") for n, f in (("a", F.min), ("b", F.max)) for c in cells]).first()
    top = max(0, math.ceil(math.log2(max(1, *[ends[f"b{c}"] - ends[f"a{c}"] for c in cells]))) - 2)
    levels = lambda df, low, high: df.select("*", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("l"))
    held = levels(occupied, -2, top).select(*by, "l", *at(F.col("l"), "s")).distinct()
    held = saved(held.select("*", *[F.floor(F.col(f"s{c}") / 4).cast("long").alias(f"g{c}") for c in "zyx"]), "cells-held")  # g: two levels up
    ladder = levels(asking, 0, top).select("*", *at(F.col("l"), "h"))
    ring = _ring(ladder.select(*by, "l", "hz", "hy", "hx").distinct().withColumns({f"g{c}": F.col(f"h{c}") for c in "zyx"}), *by, "l", "hz", "hy", "hx")
    hit = ring.join(held.select(*by, "l", *[F.col(f"s{c}").alias(f"g{c}") for c in "zyx"]), [*by, "l", "gz", "gy", "gx"], "left_semi").select(*by, "l", "hz", "hy", "hx").distinct()
    level = saved(ladder.join(hit, [*by, "l", "hz", "hy", "hx"], "left_semi").groupBy(*by, *cells).agg(F.min("l").alias("l")), "cells-level")
    used = [r.l for r in level.select("l").distinct().collect()]  # at most one a doubling of the extent

    def possible(met: DataFrame, size: Column, name: str) -> DataFrame:
        """Of the cells sz, sy, sx that points met, those that can hold the nearest target."""
        spans = [(F.col(f"s{c}") * size, (F.col(f"s{c}") + 1) * size, F.col(f"p{c}") * s) for c, s in zip("zyx", sampling, strict=True)]
        least = F.sqrt(sum(F.greatest(a - p, p - b, F.lit(0.0)) ** 2 for a, b, p in spans))
        most = F.sqrt(sum(F.greatest(F.abs(a - p), F.abs(b - p)) ** 2 for a, b, p in spans))
        met = saved(met.select(*keys, *by, "pz", "py", "px", "l", "sz", "sy", "sx", least.alias("least"), most.alias("most")), name)
        bound = met.groupBy(*keys, *by).agg(F.min("most").alias("bound"))
        return met.join(bound, [*keys, *by]).where(F.col("least") <= F.col("bound") * (1 + 1e-9)).drop("least", "most", "bound")

    size = F.lit(float(cell)) * F.pow(F.lit(2.0), F.col("l"))
    points = todo.join(level, [*by, *cells]).select(*keys, *by, "pz", "py", "px", "l", *at(F.col("l") + 2, "g"))
    met = _ring(points, *keys, *by, "pz", "py", "px", "l").join(held, [*by, "l", "gz", "gy", "gx"])
    met = possible(met, size, "cells-met").withColumnsRenamed({f"s{c}": f"g{c}" for c in "zyx"})
    met = possible(met.join(held.withColumn("l", F.col("l") + 2), [*by, "l", "gz", "gy", "gx"]), size / 4, "cells-left")
    there = targets.select("*", F.explode(F.array(*map(F.lit, used or [0]))).alias("l")).select(*by, "l", *at(F.col("l") - 2, "s"), "tz", "ty", "tx", *payload)
    return _nearest_of(met.join(there, [*by, "l", "sz", "sy", "sx"]), keys, by, payload, sampling)


CUBE = (32, 128, 128)
CELLS = 1 << 24  # of a dense array that a task fills at once


def distance_to(vox: DataFrame, targets: DataFrame, cap: int | None = None, sampling: tuple[float, float, float] = (1.0, 1.0, 1.0), brick: tuple[int, int, int] = CUBE) -> DataFrame:
    """Exact Euclidean distance to the nearest target voxel of the image, in units of the sampling.

    Without a cap at any distance, by lower envelopes along whole lines (dense.line_distance); null only in images without a target.  With one,
    null beyond it: targets go to every brick that they reach; a task fills dense arrays of its bricks and takes the least
    squared distance along one axis after the other.
    """
    if cap is None:
        return line_distance(vox, targets, sampling)
    reach = [int(cap / s) for s in sampling]
    cells = targets.select(*VK).distinct()
    asked = vox.select(*VK).distinct()
    for c, n, r in zip("zyx", brick, reach, strict=True):
        cells = cells.withColumn(f"b{c}", F.explode(F.sequence(F.floor((F.col(c) - r) / n), F.floor((F.col(c) + r) / n))))
        asked = asked.withColumn(f"b{c}", F.floor(F.col(c) / n))
    place = ["image_id", "t", "bz", "by", "bx"]
    rows = asked.withColumn("asked", F.lit(True)).unionByName(cells.withColumn("asked", F.lit(False)))
    local = [(F.col(c) - F.col(f"b{c}") * n + r).cast("int").alias(f"l{c}") for c, n, r in zip("zyx", brick, reach, strict=True)]
    rows = rows.select(F.xxhash64(*place).alias("brick"), *place, *local, "asked")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole(batches):
            head = np.lexsort([t[c].to_numpy() for c in place])
            t = t.take(pa.array(head)).combine_chunks()
            ids = np.stack([t[c].to_numpy() for c in place])
            group = np.cumsum(np.append(True, (ids[:, 1:] != ids[:, :-1]).any(axis=0))) - 1
            use = np.flatnonzero(np.bincount(group, weights=t["asked"].to_numpy())[group] > 0)  # bricks with somebody who asks
            if not len(use):
                continue
            t, group = t.take(pa.array(use)).combine_chunks(), np.unique(group[use], return_inverse=True)[1]
            at, want = [t[f"l{c}"].to_numpy() for c in "zyx"], t["asked"].to_numpy()
            low, shape = [a.min() for a in at], [int(a.max() - a.min() + 1) for a in at]
            step = max(1, CELLS // int(np.prod(shape)))
            bounds = np.searchsorted(group, np.arange(0, group[-1] + 1 + step, step))
            for k, (i, j) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                if i == j:
                    continue
                where = (group[i:j] - k * step, *(a[i:j] - o for a, o in zip(at, low, strict=True)))
                d2 = np.full((int(where[0].max()) + 1, *shape), np.inf)
                d2[tuple(x[~want[i:j]] for x in where)] = 0.0
                d2 = spread(d2, reach, sampling)
                mine = np.flatnonzero(want[i:j])
                got = d2[tuple(x[mine] for x in where)]
                ok = got <= cap * cap
                out = t.slice(i, j - i).take(pa.array(mine[ok]))
                cols = [out["image_id"], out["t"], *(pa.array((out[f"b{c}"].to_numpy() * n + out[f"l{c}"].to_numpy() - r).astype(np.int32)) for c, n, r in zip("zyx", brick, reach, strict=True)), pa.array(np.sqrt(got[ok]))]
                yield from pa.table(cols, names=[*VK, "distance"]).combine_chunks().to_batches()

    found = dealt(rows).mapInArrow(run, "image_id long, t int, z int, y int, x int, distance double")
    return vox.join(found, VK, "left")


def spread(d2: np.ndarray, reach: list[int], sampling: tuple[float, float, float]) -> np.ndarray:
    """Least squared distances in dense arrays (group, z, y, x) that hold 0 at the targets, one axis after the other."""
    for axis, (r, s) in enumerate(zip(reach, sampling, strict=True), 1):
        out, n = d2.copy(), d2.shape[axis]
        for o in range(1, min(r, n - 1) + 1):
            a, b = [slice(None)] * 4, [slice(None)] * 4
            a[axis], b[axis] = slice(o, None), slice(None, n - o)
            np.minimum(out[tuple(a)], d2[tuple(b)] + (o * s) ** 2, out=out[tuple(a)])
            np.minimum(out[tuple(b)], d2[tuple(a)] + (o * s) ** 2, out=out[tuple(b)])
        d2 = out
    return d2


def coarse_scale(shape: tuple[int, int, int], threshold: int) -> float:
    """J8's factor for a volume of this shape: 1 up to the threshold, else twice the root of the excess in half steps."""
    scale = max(1.0, math.ceil(math.sqrt(math.prod(shape) / threshold) * 2) / 2)
    return scale if scale == 1 else scale * 2


def distance_coarse(vox: DataFrame, targets: DataFrame, shape: tuple[int, int, int], threshold: int = 20 * 2000 * 2000) -> DataFrame:
    """J7 on a grid made coarser by the volume's size, resized back linearly, times the factor and rounded; J7 itself up to the threshold.

    The coarse mask takes the nearest voxel.  Only the coarse voxels around voxels that are asked for are computed.  Targets that the coarse mask misses have no
    distance: null where an image has none left.
    """
    scale = coarse_scale(shape, threshold)
    if scale == 1:
        return distance_to(vox, targets)
    small = tuple(max(1, int(n / scale)) for n in shape)
    coarse, corners = targets.select(*VK).distinct(), vox.select(*VK).distinct().withColumn("w", F.lit(1.0))
    for c, n, m in zip("zyx", shape, small, strict=True):
        taken = F.create_map(*[F.lit(v) for o, i, _ in axis_weights(n, m, 0) for v in (i, o)])  # each coarse cell looks at one voxel
        coarse = coarse.withColumn(c, taken[F.col(c)]).where(F.col(c).isNotNull())
        at = (F.col(c) + 0.5) * m / n - 0.5
        low, part = F.floor(at).cast("int"), at - F.floor(at)
        pair = F.array(F.struct(low.alias("i"), (1 - part).alias("w")), F.struct((low + 1).alias("i"), part.alias("w")))
        corners = corners.withColumn(f"p{c}", F.explode(F.filter(pair, lambda p: p["w"] > 0)))
        corners = corners.withColumn("w", F.col("w") * F.col(f"p{c}.w")).withColumn(f"s{c}", F.greatest(F.lit(0), F.least(F.lit(m - 1), F.col(f"p{c}.i")))).drop(f"p{c}")
    corners = saved(corners, "corners")
    asked = corners.select("image_id", "t", *[F.col(f"s{c}").alias(c) for c in "zyx"]).distinct()
    known = distance_to(asked, coarse).select("image_id", "t", *[F.col(c).alias(f"s{c}") for c in "zyx"], "distance")
    found = corners.join(known, ["image_id", "t", "sz", "sy", "sx"]).groupBy(*VK).agg(F.rint(F.round(F.sum(F.col("w") * F.col("distance")) * scale, 9)).alias("distance"))
    return vox.join(found, VK, "left")


def contact_point(objects: DataFrame, targets: DataFrame, cap: int | None = None) -> DataFrame:
    """Each object's voxel nearest to the parent."""
    near = distance_to(objects, targets, cap).where(F.col("distance").isNotNull())
    return near.groupBy("image_id", "t", "label").agg(F.min_by(F.struct("z", "y", "x", "distance"), F.struct("distance", "z", "y", "x")).alias("b")).select("image_id", "t", "label", "b.*")


def offsets(connectivity: int) -> list[tuple[int, ...]]:
    """Steps of the 6-, 18- or 26-neighbourhood, or of the 80-neighbourhood with time (dt, dz, dy, dx)."""
    if connectivity == 80:
        return [d for d in product((-1, 0, 1), repeat=4) if any(d)]
    most = {6: 1, 18: 2, 26: 3}[connectivity]
    return [d for d in product((-1, 0, 1), repeat=3) if 0 < sum(map(abs, d)) <= most]


def neighbours(vox: DataFrame, connectivity: int = 26, half: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """Adjacent pairs (image_id, t, z, y, x, nt, nz, ny, nx, carry..., n_carry...): an equi-join on shifted coordinates."""
    steps = [(0, *d) if len(d) == 3 else d for d in offsets(connectivity)]
    if half:
        steps = [d for d in steps if d > (0, 0, 0, 0)]
    moves = F.explode(F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(d, ("t", "z", "y", "x"), strict=True)]) for d in steps])).alias("d")
    moved = vox.select(*VK, *carry, moves).select(*VK, *carry, *[(F.col(c) + F.col(f"d.{c}")).alias(f"n{c}") for c in "tzyx"])
    other = vox.select("image_id", *[F.col(c).alias(f"n{c}") for c in "tzyx"], *[F.col(c).alias(f"n_{c}") for c in carry])
    return moved.join(other, ["image_id", "nt", "nz", "ny", "nx"])


def range_join(points: DataFrame, boxes: DataFrame, brick: int) -> DataFrame:
    """Voxels inside boxes (z0..z1, y0..y1, x0..x1): an equi-join on bricks that each box meets, then the exact test."""
    cells = boxes
    for c in "zyx":
        cells = cells.withColumn(f"b{c}", F.explode(F.sequence(F.floor(F.col(f"{c}0") / brick), F.floor(F.col(f"{c}1") / brick))))
    keyed = points.withColumns({f"b{c}": F.floor(F.col(c) / brick) for c in "zyx"})
    inside = F.lit(True)
    for c in "zyx":
        inside &= F.col(c).between(F.col(f"{c}0"), F.col(f"{c}1"))
    return keyed.join(cells, ["image_id", "t", "bz", "by", "bx"]).where(inside).drop("bz", "by", "bx")


def crop_bbox(objects: DataFrame, field: DataFrame, pad: int, shape: tuple[int, int, int], brick: int = 8) -> DataFrame:
    """The field inside each object's padded, clipped box, in local coordinates."""
    boxes = objects.groupBy("image_id", "t", "label").agg(*[F.greatest(F.min(c) - pad, F.lit(0)).alias(f"{c}0") for c in "zyx"], *[F.least(F.max(c) + pad, F.lit(n - 1)).alias(f"{c}1") for c, n in zip("zyx", shape, strict=True)])
    found = range_join(field, boxes, brick)
    return found.withColumns({f"d{c}": F.col(c) - F.col(f"{c}0") for c in "zyx"}).drop(*[f"{c}{k}" for c in "zyx" for k in "01"])


def crop_roi(centroids: DataFrame, field: DataFrame, half: tuple[int, int, int], brick: int = 8) -> DataFrame:
    """A fixed box around every centroid, in local coordinates; rows outside the volume do not exist (zero)."""
    boxes = centroids.select("image_id", "t", F.col("label").alias("roi"), *[(F.col(c) - h).alias(f"{c}0") for c, h in zip("zyx", half, strict=True)], *[(F.col(c) + h).alias(f"{c}1") for c, h in zip("zyx", half, strict=True)])
    return range_join(field, boxes, brick).withColumns({f"d{c}": F.col(c) - F.col(f"{c}0") for c in "zyx"}).drop(*[f"{c}{k}" for c in "zyx" for k in "01"])


def overlay(base: DataFrame, patch: DataFrame) -> DataFrame:
    """The voxels of patched labels are replaced; labels that the patch lacks stay."""
    kept = base.join(patch.select("image_id", "t", "label").distinct(), ["image_id", "t", "label"], "left_anti")
    return kept.unionByName(patch.select(*base.columns))


def drop_border_objects(vox: DataFrame, shape: tuple[int, int, int]) -> DataFrame:
    """Objects that touch a border in y or x go."""
    edge = (F.col("y") == 0) | (F.col("y") == shape[1] - 1) | (F.col("x") == 0) | (F.col("x") == shape[2] - 1)
    return vox.join(vox.where(edge).select("image_id", "t", "label").distinct(), ["image_id", "t", "label"], "left_anti")


def link_nearest(frames: DataFrame, keys: str = "spine_id", time: str = "timepoint", cell: float = 8.0) -> DataFrame:
    """For every object, the nearest centroid of the next frame (many to one allowed)."""
    now = frames.select(F.col(keys).alias("source"), F.col(time).cast("long").alias("image_id"), "z", "y", "x")
    then = frames.select(F.col(keys).alias("target"), (F.col(time) - 1).cast("long").alias("image_id"), "z", "y", "x")
    return nearest_point(now, then, ["source"], ["target"], cell=cell).withColumnRenamed("image_id", time)


def assign_blocks(points: DataFrame, block: tuple[int, int, int], halo: int) -> DataFrame:
    """Half-open blocks of every point; core is false where it lies in a neighbour's halo."""
    out = points
    for c, n in zip("zyx", block, strict=True):
        out = out.withColumn(f"b{c}", F.explode(F.sequence(F.floor((F.col(c) - halo) / n), F.floor((F.col(c) + halo) / n))))
    core = F.lit(True)
    for c, n in zip("zyx", block, strict=True):
        core &= F.col(f"b{c}") == F.floor(F.col(c) / n)
    return out.withColumn("core", core).where((F.col("bz") >= 0) & (F.col("by") >= 0) & (F.col("bx") >= 0))


def parent_at(points: DataFrame, parents: DataFrame, keys: list[str], parent: str) -> DataFrame:
    """The parent whose voxel is nearest to a given point."""
    return nearest_point(points, parents, keys, [parent])


MOST_FRAMES = 100_000


def roi_time_montage(tracks: DataFrame, frames: DataFrame, size: int, ident: str = "spine_id", time: str = "timepoint") -> DataFrame:
    """Every object at every time point side by side (x offset time * size); value null where it is absent.

    The result has a row for each object and frame; frames are sent to all tasks while there are at most MOST_FRAMES."""
    few = frames.limit(MOST_FRAMES + 1).count() <= MOST_FRAMES
    grid = tracks.select(ident).distinct().crossJoin(F.broadcast(frames) if few else frames)
    return grid.join(tracks, [ident, time], "left").withColumn("x_offset", (F.col(time) * size).cast("int"))
