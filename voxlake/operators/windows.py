"""Windows (W1-W8), sorts (K1-K6) and set operations."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxlake.operators.filters import map_groups
from voxlake.operators.projections import VK
from voxlake.operators.registration import best_shifts, chain
from voxlake.operators.ranks import ranked


def sample_every(points: DataFrame, k: int, by: list[str]) -> DataFrame:
    """Every k-th point in raster order."""
    return ranked(points, by, ["z", "y", "x"]).where(F.col("place_") % k == 0).drop("place_", "size_")


def sample_grid(points: DataFrame, size: int, by: list[str]) -> DataFrame:
    """The first point of every grid cell, by a partial minimum instead of a sort."""
    rest = [c for c in points.columns if c not in by]
    cell = [F.floor(F.col(c) / size).alias(f"g{c}") for c in "zyx"]
    return points.groupBy(*by, *cell).agg(F.min_by(F.struct(*rest), F.struct("z", "y", "x")).alias("r")).select(*by, "r.*")


def polyline_length(points: DataFrame, by: list[str], order: list[str], sampling: tuple[float, float, float]) -> DataFrame:
    """Sum of step lengths along an ordered path."""
    w = Window.partitionBy(*by).orderBy(*order)
    step = F.sqrt(sum((((F.col(c) - F.lag(c).over(w)) * s) ** 2 for c, s in zip("zyx", sampling, strict=True)), F.lit(0.0)))
    return points.withColumn("step", step).groupBy(*by).agg(F.coalesce(F.sum("step"), F.lit(0.0)).alias("length"))


def tangents(points: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Unit vectors to the next point; the last point repeats the one before."""
    w = Window.partitionBy(*by).orderBy(*order)
    out = points.withColumns({f"t{c}": F.coalesce(F.lead(c).over(w) - F.col(c), F.col(c) - F.lag(c).over(w), F.lit(0)) for c in "zyx"})
    norm = F.sqrt(sum((F.col(f"t{c}") ** 2 for c in "zyx"), F.lit(0.0)))
    return out.withColumn("norm", norm).withColumns({f"t{c}": F.coalesce(F.try_divide(F.col(f"t{c}").cast("double"), F.col("norm")), F.lit(0.0)) for c in "zyx"}).drop("norm")


def gained_lost(tracks: DataFrame, baseline: str = "first", ident: str = "spine_id", time: str = "timepoint") -> DataFrame:
    """Per time point, identities new against, and missing from, the first (or previous) time point."""
    ids = tracks.select(ident, F.col(time).alias("t")).distinct()
    frames = ids.select("t").distinct()
    first = frames.agg(F.min("t").alias("base"))
    if baseline == "first":
        pairs = frames.crossJoin(F.broadcast(first))
    else:  # one row a time point
        pairs = frames.withColumn("base", F.coalesce(F.lag("t").over(Window.orderBy("t")), F.col("t")))
    base = ids.join(F.broadcast(pairs.withColumnRenamed("t", "now")), ids["t"] == F.col("base")).select(ident, F.col("now").alias("t"), F.lit(1).alias("b"))
    both = ids.withColumn("a", F.lit(1)).join(base, [ident, "t"], "full_outer")
    return both.groupBy(F.col("t").alias(time)).agg(F.count_if(F.col("b").isNull()).alias("new"), F.count_if(F.col("a").isNull()).alias("pruned"))


def chain_shift(centroids: DataFrame, time: str = "t") -> DataFrame:
    """Shift of each frame onto the first, as the running sum of shifts between neighbours (image_id, t, cz, cy, cx)."""
    w = Window.partitionBy("image_id").orderBy(time)
    step = {f"s{c}": F.coalesce(F.lag(f"c{c}").over(w) - F.col(f"c{c}"), F.lit(0.0)) for c in "zyx"}
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    return centroids.withColumns(step).withColumns({f"shift_{c}": F.sum(f"s{c}").over(run) for c in "zyx"}).drop("sz", "sy", "sx")


def chain_shift_by_content(vox: DataFrame, value: str, reach: tuple[int, int, int], between: bool = False) -> DataFrame:
    """The same from what the frames show (image_id, t, shift_z, shift_y, shift_x): translations within reach between neighbouring times
    that bring the values (less their frame's mean) to the largest sum of products, whole voxels or (between) parts of them; see registration.py."""
    return chain(vox, best_shifts(vox, value, reach, between))


def raster_label_order(vox: DataFrame) -> DataFrame:
    """Labels numbered by their first voxel in raster order, within each image."""
    first = vox.groupBy("image_id", "t", "label").agg(F.min(F.struct("z", "y", "x")).alias("first"))
    named = first.withColumn("new", F.row_number().over(Window.partitionBy("image_id", "t").orderBy("first")).cast("long"))
    return vox.join(named.select("image_id", "t", "label", "new"), ["image_id", "t", "label"]).drop("label").withColumnRenamed("new", "label")


def smooth_polyline(points: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Centred moving average of three points (the ends average two)."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(-1, 1)
    return points.withColumns({c: F.avg(c).over(w) for c in "zyx"})


def _spline(p: np.ndarray, n: int) -> np.ndarray:
    """n points, evenly spaced in chord length, of the cubic spline through p (third derivative continuous at the second and last but one)."""
    step = np.sqrt((np.diff(p, axis=0) ** 2).sum(axis=1))
    p = p[np.append(True, step > 0)]
    if len(p) < 4:
        return p
    u = np.append(0, np.cumsum(step[step > 0]))
    h, d = np.diff(u), np.diff(p, axis=0) / np.diff(u)[:, None]
    # second derivatives: the two end conditions put into the rows next to them leave three diagonals
    m = len(p) - 2
    low, mid, high = h[:-1].copy(), 2 * (h[:-1] + h[1:]), h[1:].copy()
    right = 6 * (d[1:] - d[:-1])
    mid[0] += h[0] * (h[0] + h[1]) / h[1]
    high[0] -= h[0] * h[0] / h[1]
    mid[-1] += h[-1] * (h[-1] + h[-2]) / h[-2]
    low[-1] -= h[-1] * h[-1] / h[-2]
    for i in range(1, m):
        f = low[i] / mid[i - 1]
        mid[i] -= f * high[i - 1]
        right[i] -= f * right[i - 1]
    s = np.zeros((len(p), p.shape[1]))
    s[m] = right[-1] / mid[-1]
    for i in range(m - 2, -1, -1):
        s[i + 1] = (right[i] - high[i] * s[i + 2]) / mid[i]
    s[0] = s[1] - h[0] * (s[2] - s[1]) / h[1]
    s[-1] = s[-2] + h[-1] * (s[-2] - s[-3]) / h[-2]
    x = np.linspace(0, u[-1], n)
    k = np.clip(np.searchsorted(u, x, "right") - 1, 0, len(h) - 1)
    a, b, w = ((u[k + 1] - x) / h[k])[:, None], ((x - u[k]) / h[k])[:, None], (h[k] ** 2 / 6)[:, None]
    return a * p[k] + b * p[k + 1] + ((a**3 - a) * s[k] + (b**3 - b) * s[k + 1]) * w


def resample_polyline(points: DataFrame, by: list[str], order: list[str], n: int = 50) -> DataFrame:
    """By, step, z, y, x: n points of the cubic spline through each ordered path; paths of fewer than four different points stay."""
    kinds = dict(points.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in by) + ", step int, z double, y double, x double"

    def run(who: tuple, part: pd.DataFrame) -> list[dict]:
        out = _spline(part.sort_values(order)[["z", "y", "x"]].to_numpy(float), n).tolist()
        head = dict(zip(by, who, strict=True))
        return [head | {"step": i, "z": z, "y": y, "x": x} for i, (z, y, x) in enumerate(out)]

    used = dict.fromkeys([*by, *order, "z", "y", "x"])
    return map_groups(points.select(*used), by, run, schema)


def sort_labels(df: DataFrame, label: str) -> DataFrame:
    """K1: numeric order of labels that may be strings."""
    return df.orderBy(F.try_to_number(F.col(label), F.lit("999999999999999")) if dict(df.dtypes)[label] == "string" else F.col(label))


def sorted_files(df: DataFrame, path: str) -> DataFrame:
    """K2."""
    return df.orderBy(path)


def best_candidate(df: DataFrame, by: list[str], order: list[Column], k: int = 1) -> DataFrame:
    """K3: the k lowest rows of each group."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k).drop("rank")


def every_nth_slice(vox: DataFrame, n: int) -> DataFrame:
    """K4."""
    return vox.where(F.col("z") % n == 0)


def random_sample(df: DataFrame, frac: float, by: list[str], key: list[str]) -> DataFrame:
    """K5: the share of each group with the lowest hashes, one at least: the same rows on every run."""
    found = ranked(df.withColumn("hash_", F.md5(F.concat_ws("/", *key))), by, ["hash_", *key])
    return found.where(F.col("place_") < F.greatest(F.lit(1), F.floor(F.col("size_") * frac))).drop("place_", "size_", "hash_")


def split(df: DataFrame, frac: float, key: list[str]) -> DataFrame:
    """K6: train or validation by a hash of the key."""
    bucket = F.conv(F.substring(F.md5(F.concat_ws("/", *key)), 1, 8), 16, 10).cast("long") % 100
    return df.withColumn("part", F.when(bucket < int(frac * 100), "train").otherwise("validation"))


def append(tables: list[DataFrame]) -> DataFrame:
    """Rows of all tables; columns that a table lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def mask_union(a: DataFrame, b: DataFrame) -> DataFrame:
    """U2."""
    return a.select(*VK).union(b.select(*VK)).distinct()


def mask_intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select(*VK).intersect(b.select(*VK))


def mask_subtract(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select(*VK).join(b.select(*VK), VK, "left_anti").distinct()


def mask_xor(a: DataFrame, b: DataFrame) -> DataFrame:
    return mask_subtract(a, b).union(mask_subtract(b, a))


def id_difference(a: DataFrame, b: DataFrame, ident: str) -> DataFrame:
    """Identities of a that b lacks."""
    return a.select(ident).subtract(b.select(ident))


def stack_time(frames: list[DataFrame] | DataFrame, time: str | None = None) -> DataFrame:
    """U4: frames as one table with their position as time t.  Frames that lie in one table are told apart by its column `time`: t is its rank."""
    if time is None:
        return reduce(DataFrame.unionByName, (f.withColumn("t", F.lit(i)) for i, f in enumerate(frames)))
    order = frames.select(time).distinct().withColumn("t", (F.row_number().over(Window.orderBy(time)) - 1).cast("int"))  # one row a frame
    return frames.join(order, time).drop(time)
