"""Translations between frames by what they show (W6): correlations of bricks by Fourier transforms, summed over bricks."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxlake.operators.bricks import dealt, whole
from voxlake.operators.dense import BLOCK, grouped
from voxlake.operators.projections import VK
from voxlake.plans.scratch import saved


def _smooth(n: int) -> int:
    """The next length of factors 2, 3 and 5, which transforms take quickly."""
    while True:
        k = n
        for p in (2, 3, 5):
            while k % p == 0:
                k //= p
        if k == 1:
            return n
        n += 1


def correlation(late: tuple[np.ndarray, np.ndarray], early: tuple[np.ndarray, np.ndarray], reach: tuple[int, int, int]) -> tuple[np.ndarray, np.ndarray]:
    """For every shift s within reach: the sum over places p of late(p) early(p + s), and how many pairs there are.  Each: (places, values)."""
    low, high = late[0].min(0), late[0].max(0)
    near = ((early[0] >= low - reach) & (early[0] <= high + reach)).all(1)
    shape = tuple(_smooth(int(n)) for n in high - low + 1 + 2 * np.array(reach))
    span = tuple(slice(0, 2 * r + 1) for r in reach)
    out = []
    for a, b in ((early[1][near], late[1]), (np.ones(near.sum()), np.ones(len(late[1])))):
        one, two = np.zeros(shape), np.zeros(shape)
        np.add.at(one, tuple((early[0][near] - (low - reach)).T), a)
        np.add.at(two, tuple((late[0] - low).T), b)
        out.append(np.fft.irfftn(np.fft.rfftn(one) * np.conj(np.fft.rfftn(two)), shape, axes=(0, 1, 2))[span])
    return out[0], np.rint(out[1])


def shift_scores(vox: DataFrame, value: str, reach: tuple[int, int, int], block: dict[str, int] = BLOCK) -> DataFrame:
    """(image_id, t, sz, scores, pairs): for every frame and shift along z, the scores of all shifts in y and x onto the frame before, as bytes of doubles.

    A task holds bricks of the later frame and what lies within reach of them in the earlier one; a transform costs little more for a far reach.
    """
    frame = ["image_id", "t"]
    mean = vox.groupBy(*frame).agg(F.avg(value).alias("mean"))
    rows = vox.join(mean, frame).select(*VK, (F.col(value) - F.col("mean")).alias("v")).where("v is not null")
    sizes = {c: max(block[c], r) for c, r in zip("zyx", reach, strict=True)}
    late = rows.select(*VK, "v", F.lit(True).alias("late"), *[F.floor(F.col(c) / n).cast("int").alias(f"b{c}") for c, n in sizes.items()])
    early = rows.withColumn("t", (F.col("t") + 1).cast("int")).withColumn("late", F.lit(False))
    for (c, n), r in zip(sizes.items(), reach, strict=True):
        early = early.withColumn(f"b{c}", F.explode(F.sequence(F.floor((F.col(c) - r) / n).cast("int"), F.floor((F.col(c) + r) / n).cast("int"))))
    names = [*frame, "bz", "by", "bx"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole(batches, 1):
            t, group = grouped(t, names)
            at, v, is_late = np.stack([t[c].to_numpy() for c in "zyx"], 1).astype(np.int64), t["v"].to_numpy(), t["late"].to_numpy()
            heads = np.flatnonzero(np.diff(group, prepend=-1))
            for i, j in zip(heads.tolist(), np.append(heads[1:], len(group)).tolist(), strict=True):
                mine = is_late[i:j]
                if not mine.any() or mine.all():
                    continue
                score, pairs = correlation((at[i:j][mine], v[i:j][mine]), (at[i:j][~mine], v[i:j][~mine]), reach)
                n = len(score)
                head = [pa.array([t[c][i].as_py()] * n, k) for c, k in zip(frame, (pa.int64(), pa.int32()), strict=True)]
                shifts = pa.array(np.arange(-reach[0], reach[0] + 1), pa.int32())
                yield pa.RecordBatch.from_arrays([*head, shifts, *(pa.array([np.ascontiguousarray(p).tobytes() for p in x], pa.binary()) for x in (score, pairs))], [*frame, "sz", "scores", "pairs"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole(batches, 1):
            t, group = grouped(t, [*frame, "sz"])
            heads = np.flatnonzero(np.diff(group, prepend=-1))
            sums = [[np.add.reduce([np.frombuffer(b.as_py(), np.float64) for b in t[c].slice(i, j - i)]).tobytes() for i, j in zip(heads.tolist(), np.append(heads[1:], len(group)).tolist(), strict=True)] for c in ("scores", "pairs")]
            out = t.select([*frame, "sz"]).take(pa.array(heads))
            for name, x in zip(("scores", "pairs"), sums, strict=True):
                out = out.append_column(name, pa.array(x, pa.binary()))
            yield from out.combine_chunks().to_batches(max_chunksize=256)

    kind = "image_id long, t int, sz int, scores binary, pairs binary"
    parts = dealt(late.unionByName(early).withColumn("brick", F.xxhash64(*names))).mapInArrow(run, kind)
    return dealt(parts.withColumn("brick", F.xxhash64(*frame, "sz"))).mapInArrow(total, kind)


def best_shifts(vox: DataFrame, value: str, reach: tuple[int, int, int], between: bool = False, block: dict[str, int] = BLOCK) -> DataFrame:
    """(image_id, t, sz, sy, sx): the shift of each frame with the largest score (to 0.01) of those with a pair of voxels; ties: the shortest, then the smallest.

    between: the top of the parabola through the score and those beside it is added along each axis (0 where a side is out of reach).
    """
    frame = ["image_id", "t"]
    scores = saved(shift_scores(vox, value, reach, block), "shift-scores")
    wide = (2 * reach[1] + 1, 2 * reach[2] + 1)

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        y, x = (a.ravel() for a in np.meshgrid(*(np.arange(-r, r + 1) for r in reach[1:]), indexing="ij"))
        for b in batches:
            rows = []
            for image, t, z, score, pairs in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                s = np.where(np.frombuffer(pairs) > 0.5, np.round(np.frombuffer(score), 2), -np.inf)
                k = np.lexsort((x, y, z * z + y * y + x * x, -s))[0]
                if np.isfinite(s[k]):
                    rows.append((image, t, z, int(y[k]), int(x[k]), float(s[k])))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64()), strict=True)], [*frame, "sz", "sy", "sx", "score"])

    found = scores.mapInArrow(tops, "image_id long, t int, sz int, sy int, sx int, score double")
    length = F.col("sz") * F.col("sz") + F.col("sy") * F.col("sy") + F.col("sx") * F.col("sx")
    best = found.groupBy(*frame).agg(F.min_by(F.struct("sz", "sy", "sx"), F.struct(-F.col("score"), length, "sz", "sy", "sx")).alias("s")).select(*frame, "s.*")
    if not between:
        return best
    best = saved(best, "best-shifts")
    near = best.select(*frame, F.col("sz").alias("z0"), "sy", "sx").join(scores, frame).where(F.abs(F.col("sz") - F.col("z0")) <= 1)

    def seven(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Scores at the top and beside it: axis, side, score."""
        for b in batches:
            rows = []
            for image, t, z0, y, x, z, score in zip(*(b.column(i).to_pylist() for i in range(7)), strict=True):
                s = np.frombuffer(score).reshape(wide)
                for axis, d in product(range(3), (-1, 0, 1)):
                    at = [y + reach[1] + d * (axis == 1), x + reach[2] + d * (axis == 2)]
                    if z - z0 == d * (axis == 0) and all(0 <= k < n for k, n in zip(at, wide, strict=True)):
                        rows.append((image, t, axis, d, float(s[at[0], at[1]])))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64()), strict=True)], [*frame, "axis", "side", "score"])

    sides = near.select(*frame, "z0", "sy", "sx", "sz", "scores").mapInArrow(seven, "image_id long, t int, axis int, side int, score double")
    beside = lambda a, d: F.max(F.when((F.col("axis") == a) & (F.col("side") == d), F.col("score")))
    top = sides.groupBy(*frame).agg(*[F.coalesce(F.try_divide(beside(a, -1) - beside(a, 1), 2 * (beside(a, -1) - 2 * beside(a, 0) + beside(a, 1))), F.lit(0.0)).alias(f"d{c}") for a, c in enumerate("zyx")])
    return best.join(top, frame).select(*frame, *[(F.col(f"s{c}") + F.col(f"d{c}")).alias(f"s{c}") for c in "zyx"])


def chain(frames: DataFrame, best: DataFrame) -> DataFrame:
    """Running sums of the shifts of an image's frames (a row a frame)."""
    steps = frames.select("image_id", "t").distinct().join(best, ["image_id", "t"], "left")
    run = Window.partitionBy("image_id").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    return steps.select("image_id", "t", *[F.sum(F.coalesce(F.col(f"s{c}"), F.lit(0))).over(run).alias(f"shift_{c}") for c in "zyx"])
