"""Convex hulls of voxel objects by hulls of their parts, in exact integers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlake.operators.bricks import BRICK, Grid, dealt, whole
from voxlake.operators.dense import grouped
from voxlake.plans.scratch import discard, saved

OBJECT = ["image_id", "t", "label"]
SHAPE, SHAPES = 32, 1 << 15  # points of shapes, and shapes, whose hulls a task remembers


def _faces(p: np.ndarray, tri: np.ndarray, inner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Triangles turned so that their normals point away from a point inside (four times its coordinates), normals and offsets."""
    a, b, c = p[tri[:, 0]], p[tri[:, 1]], p[tri[:, 2]]
    n = np.cross(b - a, c - a)
    flip = (n * (inner - 4 * a)).sum(1) > 0
    tri = np.where(flip[:, None], tri[:, [0, 2, 1]], tri)
    n = np.where(flip[:, None], -n, n)
    return tri, n, (n * a).sum(1)


def convex_hull(points: np.ndarray) -> tuple[np.ndarray, int]:
    """Rows of the hull's corners and six times its volume; points are distinct integers within 2^19 of each other that do not lie in one plane.

    Points outside wait at one face that sees them; the farthest of the fullest face joins, the faces that it sees are replaced by a fan over
    their rim.  Integers make "sees" exact, so points on faces never split one.
    """
    base = points.min(axis=0)
    p = (points - base).astype(np.int64)
    i0 = int(np.lexsort(p.T)[0])
    i1 = int(((p - p[i0]) ** 2).sum(1).argmax())
    i2 = int((np.cross(p[i1] - p[i0], p - p[i0]).astype(np.float64) ** 2).sum(1).argmax())
    i3 = int(np.abs((p - p[i0]) @ np.cross(p[i1] - p[i0], p[i2] - p[i0])).argmax())
    inner = p[[i0, i1, i2, i3]].sum(0)
    tri, normal, offset = _faces(p, np.array([[i0, i1, i2], [i0, i1, i3], [i0, i2, i3], [i1, i2, i3]]), inner)
    if not ((p[i3] - p[i0]) @ np.cross(p[i1] - p[i0], p[i2] - p[i0])):
        raise ValueError("all points lie in one plane")

    def wait(left: np.ndarray, normal: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The points of left that some face sees, and the first such face."""
        keep, face = [], []
        for a in range(0, len(left), max(1, (1 << 20) // max(len(normal), 1))):
            some = left[a : a + max(1, (1 << 20) // max(len(normal), 1))]
            sees = p[some] @ normal.T > offset
            any_ = sees.any(1)
            keep.append(some[any_])
            face.append(sees[any_].argmax(1))
        return (np.concatenate(keep), np.concatenate(face)) if keep else (left[:0], left[:0])

    point, face = wait(np.arange(len(p)), normal, offset)
    while len(point):
        busiest = np.bincount(face).argmax()
        mine = point[face == busiest]
        top = mine[(p[mine] @ normal[busiest]).argmax()]
        seen = normal @ p[top] > offset
        loops = tri[seen]
        rim = np.concatenate([loops[:, [0, 1]], loops[:, [1, 2]], loops[:, [2, 0]]])
        code = np.minimum(rim[:, 0], rim[:, 1]) * len(p) + np.maximum(rim[:, 0], rim[:, 1])
        _, first, times = np.unique(code, return_index=True, return_counts=True)
        rim = rim[first[times == 1]]
        new, n, o = _faces(p, np.column_stack([rim, np.full(len(rim), top)]), inner)
        moved = seen[face]
        again, where = wait(point[moved & (point != top)], n, o)
        number = np.cumsum(~seen) - 1
        kept = number[-1] + 1
        point, face = np.concatenate([point[~moved], again]), np.concatenate([number[face[~moved]], kept + where])
        tri, normal, offset = np.concatenate([tri[~seen], new]), np.concatenate([normal[~seen], n]), np.concatenate([offset[~seen], o])
    return np.unique(tri), int(sum(int(v) for v in (np.cross(p[tri[:, 0]], p[tri[:, 1]]) * p[tri[:, 2]]).sum(1)))


def hulls(vox: DataFrame, brick: tuple[int, int, int] = BRICK) -> DataFrame:
    """(object, six_vol): six times the volume of the hull of each object's voxel corners, an integer.

    A task takes the parts of objects in its bricks and hands on the corners of their hulls; bricks are then joined four by four along each axis, and the
    hulls of corners taken, until every object is one part.  Only corners of hulls travel between rounds, so no task needs an object.
    """
    ends = vox.groupBy(*OBJECT, "z", "y").agg(F.min("x").alias("a"), F.max("x").alias("b"))  # the rest of a row is inside
    ends = ends.select(*OBJECT, "z", "y", F.explode(F.array_distinct(F.array("a", "b"))).alias("x"))
    now = saved(ends, "hull-ends")
    grid = Grid(now, brick)
    size = dict(grid.brick)
    parts = now.withColumns({f"b{c}": F.floor(F.col(c) / n).cast("int") for c, n in size.items()})
    cubes = True

    def run(batches: Iterator[pa.RecordBatch], cubes: bool, last: bool) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, tuple[np.ndarray, int]] = {}  # small parts are alike but for their place
        for t in whole(batches, 1):
            t, group = grouped(t, [*OBJECT, "bz", "by", "bx", "z", "y", "x"])
            group = np.cumsum(np.append(True, (np.stack([t[c].to_numpy()[1:] != t[c].to_numpy()[:-1] for c in [*OBJECT, "bz", "by", "bx"]])).any(axis=0))) - 1
            points = np.stack([t[c].to_numpy() for c in "zyx"], 1).astype(np.int64)
            heads = np.flatnonzero(np.diff(group, prepend=-1))
            which, out, volumes = [], [], []
            for i, j in zip(heads.tolist(), np.append(heads[1:], len(group)).tolist(), strict=True):
                base = points[i:j].min(axis=0)
                part = points[i:j] - base
                name = part.tobytes() if len(part) <= SHAPE else None
                if name is None or name not in known:
                    if cubes:
                        part = np.unique((part[:, None] + np.array([[z, y, x] for z in (0, 1) for y in (0, 1) for x in (0, 1)])).reshape(-1, 3), axis=0)
                    at, volume = convex_hull(part)
                    hull = part[at], volume
                    if name is not None and len(known) < SHAPES:
                        known[name] = hull
                else:
                    hull = known[name]
                corners, volume = hull
                which.append(np.full(len(corners) if not last else 1, i))
                if not last:
                    out.append(corners + base)
                volumes.append(volume)
            some = t.select(OBJECT if last else [*OBJECT, "bz", "by", "bx"]).take(pa.array(np.concatenate(which)))
            if last:
                some = some.append_column("six_vol", pa.array(volumes, pa.int64()))
            else:
                for k, c in enumerate("zyx"):
                    some = some.append_column(c, pa.array(np.concatenate(out)[:, k].astype(np.int32)))
            yield from some.combine_chunks().to_batches(max_chunksize=100_000)

    while True:
        last = all(grid.size[c] - 2 <= size[c] for c in "zyx")
        kind = "image_id long, t int, label long, " + ("six_vol long" if last else "bz int, by int, bx int, z int, y int, x int")
        found = dealt(parts.withColumn("brick", F.xxhash64(*OBJECT, "bz", "by", "bx"))).mapInArrow(lambda b, c=cubes, k=last: run(b, c, k), kind)
        if last:
            return found
        found = saved(found, "hull-corners")
        discard(now)
        now, cubes, size = found, False, {c: 4 * n for c, n in size.items()}
        parts = found.withColumns({f"b{c}": F.floor(F.col(f"b{c}") / 4).cast("int") for c in "zyx"}).distinct()
