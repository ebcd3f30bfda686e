"""Geometric transforms of whole volumes by inverse mapping."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlake.operators.bricks import dealt, whole
from voxlake.operators.dense import grouped
from voxlake.operators.projections import VK

BLOCK = (32, 64, 64)


def _sources(inverse: np.ndarray, shift: np.ndarray, shape: tuple[int, int, int], block: tuple[int, int, int], reach: float) -> list[tuple[int, ...]]:
    """(block of the result, block of the source) wherever the transformed box of one meets the other: a few of each block of one volume."""
    out = []
    for b in product(*(range(-(-n // k)) for n, k in zip(shape, block, strict=True))):
        ends = [(i * k, min((i + 1) * k, n) - 1) for i, k, n in zip(b, block, shape, strict=True)]
        corners = (np.array(list(product(*ends))) - shift) @ inverse.T
        low, high = np.floor((corners.min(0) - reach) / block).astype(int), np.floor((corners.max(0) + reach) / block).astype(int)
        out += [(*b, *s) for s in product(*(range(i, j + 1) for i, j in zip(low.tolist(), high.tolist(), strict=True)))]
    return out


def warp_inverse(vox: DataFrame, value: str, matrix: list[list[float]], shift: list[float], shape: tuple[int, int, int], linear: bool = True, block: tuple[int, int, int] = BLOCK) -> DataFrame:
    """Volumes of a shape under source -> matrix source + shift, without holes: (VK, value as double).

    Every voxel of the result looks at its place in the source: linear takes the eight voxels around (missing ones count 0; voxels
    without any are no rows), else the nearest voxel (of equals the larger coordinate), as labels need.  Places are rounded to 1e-9.  Source voxels go
    to the blocks of the result that they can touch, a task gathers from a dense array of them; voxels that repeat count once, the largest value.
    """
    inverse, move = np.linalg.inv(np.array(matrix, float)), np.array(shift, float)
    pairs = _sources(inverse, move, shape, block, 1.0)
    names = ["tz", "ty", "tx"]
    table = vox.sparkSession.createDataFrame(pairs, ", ".join(f"{c} int" for c in [*names, "sz", "sy", "sx"]))  # rows: blocks of one volume
    rows = vox.select(*VK, F.col(value).cast("double").alias("v"), *[F.floor(F.col(c) / k).cast("int").alias(f"s{c}") for c, k in zip("zyx", block, strict=True)]).where("v is not null")
    rows = rows.join(table, ["sz", "sy", "sx"]).select(F.xxhash64("image_id", "t", *names).alias("brick"), *VK, *names, "v")

    def gather(at: np.ndarray, v: np.ndarray, corner: np.ndarray, size: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Places and values of a block of the result that begins at corner."""
        low, span = at.min(0), at.max(0) - at.min(0) + 1
        dense = np.full(tuple(span), np.nan)
        np.fmax.at(dense, tuple((at - low).T), v)
        q = np.stack(np.meshgrid(*(np.arange(c, c + n) for c, n in zip(corner, size, strict=True)), indexing="ij"), -1).reshape(-1, 3)
        p = np.round((q - move) @ inverse.T, 9) - low
        base = np.floor(p).astype(np.int64) if linear else np.floor(p + 0.5).astype(np.int64)
        total, met = np.zeros(len(q)), np.zeros(len(q), bool)
        for d in product((0, 1), repeat=3) if linear else [(0, 0, 0)]:
            k = base + d
            w = np.prod(np.where(np.array(d) == 1, p - base, 1 - (p - base)), 1) if linear else np.ones(len(q))
            inside = ((k >= 0) & (k < span)).all(1) & (w > 0)
            x = np.full(len(q), np.nan)
            x[inside] = dense[tuple(k[inside].T)]
            ok = ~np.isnan(x)
            total[ok] += w[ok] * x[ok]
            met |= ok
        return q[met], total[met]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole(batches, 1):
            t, group = grouped(t, ["image_id", "t", *names])
            at, v = np.stack([t[c].to_numpy() for c in "zyx"], 1).astype(np.int64), t["v"].to_numpy()
            heads = np.flatnonzero(np.diff(group, prepend=-1))
            for i, j in zip(heads.tolist(), np.append(heads[1:], len(group)).tolist(), strict=True):
                corner = [t[c][i].as_py() * k for c, k in zip(names, block, strict=True)]
                q, x = gather(at[i:j], v[i:j], np.array(corner), [min(k, n - c) for k, n, c in zip(block, shape, corner, strict=True)])
                head = [pa.array(np.full(len(q), t[c][i].as_py()), k) for c, k in (("image_id", pa.int64()), ("t", pa.int32()))]
                out = pa.RecordBatch.from_arrays([*head, *(pa.array(q[:, k].astype(np.int32)) for k in range(3)), pa.array(x)], [*VK, value])
                for a in range(0, len(q), 100_000):
                    yield out.slice(a, 100_000)

    return dealt(rows).mapInArrow(run, f"image_id long, t int, z int, y int, x int, {value} double")
