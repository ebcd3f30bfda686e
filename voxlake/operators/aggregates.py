"""Aggregations."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxlake.operators.bricks import BRICK, dealt, whole
from voxlake.operators.dense import convolve, dense_map, mask_map
from voxlake.operators.hulls import hulls
from voxlake.operators.projections import VK
from voxlake.operators.ranks import ranked, running
from voxlake.plans.scratch import saved

OK = ["image_id", "t", "label"]


def region_props(vox: DataFrame, value: str) -> DataFrame:
    """A1: count, centroid, and least, mean and largest value per label."""
    return vox.groupBy(*OK).agg(F.count("*").alias("area"), *[F.avg(c).alias(f"centroid_{c}") for c in "zyx"], F.min(value).alias("min_int"), F.avg(value).alias("mean_int"), F.max(value).alias("max_int"))


def channel_stats(vox: DataFrame, channels: list[str], regions: list[str]) -> DataFrame:
    """A2: mean and maximum per label, channel and region in wide columns."""
    wide = [f(F.when(F.col("region") == r, F.col(c))).alias(f"{r}_C{i + 1}_{n}") for r in regions for i, c in enumerate(channels) for f, n in ((F.avg, "mean_int"), (F.max, "max_int"))]
    return vox.groupBy(*OK).agg(*wide)


def bbox(vox: DataFrame) -> DataFrame:
    """A3: box, its volume and the share of it that the object fills."""
    own = vox.groupBy(*OK).agg(F.count("*").alias("area"), *[f(c).alias(f"{n}_{c}") for c in "zyx" for f, n in ((F.min, "min"), (F.max, "max"))])
    volume = math.prod
    size = [F.col(f"max_{c}") - F.col(f"min_{c}") + 1 for c in "zyx"]
    return own.withColumn("bbox_vol", volume(size).cast("long")).withColumn("extent", F.col("area") / F.col("bbox_vol"))


def _eigenvalues(m: dict[str, Column]) -> list[Column]:
    """Of a symmetric 3 x 3 matrix, ascending, in closed form; an angle within rounding of its ends is one of them."""
    q = (m["zz"] + m["yy"] + m["xx"]) / 3
    p1 = m["zy"] ** 2 + m["zx"] ** 2 + m["yx"] ** 2
    p = F.sqrt(((m["zz"] - q) ** 2 + (m["yy"] - q) ** 2 + (m["xx"] - q) ** 2 + 2 * p1) / 6)
    a, b, c = (m[k] - q for k in ("zz", "yy", "xx"))
    det = a * (b * c - m["yx"] ** 2) - m["zy"] * (m["zy"] * c - m["yx"] * m["zx"]) + m["zx"] * (m["zy"] * m["yx"] - b * m["zx"])
    r = F.when(p > 1e-12, det / (2 * p**3)).otherwise(F.lit(0.0))
    phi = F.when(r > 1 - 1e-13, 0.0).when(r < -1 + 1e-13, math.pi / 3).otherwise(F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), r))) / 3)
    top, low = q + 2 * p * F.cos(phi), q + 2 * p * F.cos(phi + 2 * math.pi / 3)
    return [low, 3 * q - top - low, top]


def inertia_axes(vox: DataFrame, sampling: tuple[float, float, float] = (1.0, 1.0, 1.0)) -> DataFrame:
    """A4: e0 to e2, axis_major and axis_minor: the ellipsoid with the object's second moments (each voxel's own extent, 1/12, included).

    axis_major_table and axis_minor_table are what usual tables carry: sqrt(6 m) and sqrt(10 m), where m is the smallest and the middle
    value of the inertia tensor less the largest, of the moments without extents: twice the least second moment.
    """
    s = dict(zip("zyx", sampling, strict=True))
    pairs = ("zz", "yy", "xx", "zy", "zx", "yx")
    own = vox.groupBy(*OK).agg(F.count("*").alias("area"), *[F.covar_pop(F.col(p[0]) * s[p[0]], F.col(p[1]) * s[p[1]]).alias(p) for p in pairs])
    e0, e1, e2 = _eigenvalues({p: F.col(p) + (s[p[0]] ** 2 / 12 if p[0] == p[1] else 0) for p in pairs})
    keep = own.withColumns({"e0": e0, "e1": e1, "e2": e2, "least": _eigenvalues({p: F.col(p) for p in pairs})[0]})
    zero = F.lit(0.0)
    major = 2 * F.sqrt(5 * F.greatest(zero, F.col("e2")))
    minor = 2 * F.sqrt(5 * F.greatest(zero, F.col("e0")))
    flat = F.greatest(zero, 2 * F.col("least"))
    return keep.select(*OK, "area", "e0", "e1", "e2", major.alias("axis_major"), minor.alias("axis_minor"), F.sqrt(6 * flat).alias("axis_major_table"), F.sqrt(10 * flat).alias("axis_minor_table"))


def drop_degenerate(vox: DataFrame, least: int, thin: float, flat: float, axes: int) -> DataFrame:
    """A5: labels with enough voxels, thickness (shortest over longest side), depth (singular ratio) and extended axes."""
    box = bbox(vox)
    side = [F.col(f"max_{c}") - F.col(f"min_{c}") + 1 for c in "zyx"]
    wide = sum(((s > 1).cast("int") for s in side), F.lit(0))
    ok = box.where((F.col("area") >= least) & (F.least(*side) / F.greatest(*side) >= thin) & (wide >= axes)).select(*OK)
    if flat > 0:
        ratio = inertia_axes(vox).where(F.sqrt(F.greatest(F.lit(0.0), F.col("e0") - 1 / 12) / F.greatest(F.lit(1e-12), F.col("e2") - 1 / 12)) >= flat)
        ok = ok.join(ratio.select(*OK), OK, "left_semi")
    return vox.join(ok, OK, "left_semi")


def hull_candidates(vox: DataFrame) -> DataFrame:
    """Only the first and last voxel of every row of an object can be a corner of its hull."""
    ends = vox.groupBy(*OK, "z", "y").agg(F.min("x").alias("a"), F.max("x").alias("b"))
    return ends.select(*OK, "z", "y", F.explode(F.array_distinct(F.array("a", "b"))).alias("x"))


def hull_volume(vox: DataFrame, brick: tuple[int, int, int] = BRICK) -> DataFrame:
    """Convex hull of each object's voxel corners, exactly (six_vol: six times its volume, an integer), and solidity."""
    volumes = hulls(vox, brick).withColumn("convex_vol", F.col("six_vol") / 6)
    return vox.groupBy(*OK).agg(F.count("*").alias("area")).join(volumes, OK).withColumn("solidity", F.try_divide(F.col("area").cast("double"), F.col("convex_vol")))


def _planar(points: np.ndarray, group: np.ndarray, plane: int, along: int, across: int) -> np.ndarray:
    """Which points can be corners of their group's hull, judged in the planes where one coordinate is fixed.

    Points on or inside the chord of their neighbours on a plane's outline are no corners; this is repeated until none is left."""
    keep = np.zeros(len(points), bool)
    for sign in (1, -1):
        order = np.lexsort((sign * points[:, across], points[:, along], points[:, plane], group))
        g, p = group[order], points[order]
        head = np.append(True, (g[1:] != g[:-1]) | (p[1:, plane] != p[:-1, plane]) | (p[1:, along] != p[:-1, along]))
        order, g, p = order[head], g[head], p[head]
        while len(order) > 2:
            line = np.append(False, (g[1:] == g[:-1]) & (p[1:, plane] == p[:-1, plane]))
            inner = np.flatnonzero(line[1:-1] & line[2:]) + 1
            a, b, c = p[inner - 1], p[inner], p[inner + 1]
            over = sign * ((b[:, across] - a[:, across]) * (c[:, along] - a[:, along]) - (c[:, across] - a[:, across]) * (b[:, along] - a[:, along])) >= 0
            if not over.any():
                break
            left = np.ones(len(order), bool)
            left[inner[over]] = False
            order, g, p = order[left], g[left], p[left]
        keep[order] = True
    return keep


def corners(points: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Indices of the points that can be corners of the convex hulls of their groups (integers; all true corners are among them)."""
    left = np.arange(len(points))
    for plane, along, across in ((0, 1, 2), (1, 0, 2), (2, 0, 1)):
        left = left[_planar(points[left], group[left], plane, along, across)]
    return left


def _diameter(p: np.ndarray) -> float:
    """Largest distance between points: pairs in tiles, farthest from the middle first, until no pair can be farther apart."""
    away = np.sqrt(((p - (p.min(axis=0) + p.max(axis=0)) / 2) ** 2).sum(axis=1))
    order = np.argsort(-away)
    p, away, best, tile = p[order], away[order], 0.0, 512
    for i in range(0, len(p), tile):
        for j in range(0, i + 1, tile):
            if away[i] + away[j] < best * (1 - 1e-12):
                break
            d2 = sum((p[i : i + tile, k, None] - p[None, j : j + tile, k]) ** 2 for k in range(3))
            best = max(best, float(np.sqrt(d2.max())))
        if away[i] + away[0] < best * (1 - 1e-12):
            break
    return best


def feret_max(vox: DataFrame, sampling: tuple[float, float, float] = (1.0, 1.0, 1.0)) -> DataFrame:
    """Largest distance between two points of an object.  Spark reduces objects to row ends, a task to the corners of their outlines."""
    rows = hull_candidates(vox).withColumn("brick", F.xxhash64(*OK))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole(batches):
            order = np.lexsort([t[c].to_numpy() for c in OK])
            names = np.stack([t[c].to_numpy()[order] for c in OK])
            head = np.append(True, (names[:, 1:] != names[:, :-1]).any(axis=0))
            group = np.cumsum(head) - 1
            points = np.stack([t[c].to_numpy()[order] for c in "zyx"], axis=1).astype(np.int64)
            left = corners(points, group)
            points, group = points[left] * np.array(sampling), group[left]
            size = np.bincount(group)
            start = np.cumsum(size) - size
            out = np.zeros(len(size))
            for most in (4, 16, 64):  # small objects together, padded with their first point
                some = np.flatnonzero((size <= most) & (size > most // 4))
                for i in range(0, len(some), max(1, (1 << 21) // (most * most))):
                    part = some[i : i + max(1, (1 << 21) // (most * most))]
                    at = start[part][:, None] + np.where(np.arange(most) < size[part][:, None], np.arange(most), 0)
                    p = points[at]
                    out[part] = np.sqrt(sum((p[:, :, None, k] - p[:, None, :, k]) ** 2 for k in range(3)).max(axis=(1, 2)))
            for g in np.flatnonzero(size > 64).tolist():
                out[g] = _diameter(points[start[g] : start[g] + size[g]])
            first = np.flatnonzero(head)
            yield pa.RecordBatch.from_arrays([*(pa.array(names[k][first].astype(d)) for k, d in enumerate((np.int64, np.int32, np.int64))), pa.array(out)], [*OK, "feret_max"])

    return dealt(rows).mapInArrow(run, "image_id long, t int, label long, feret_max double")


def mip(vox: DataFrame, value: str, axis: str = "z") -> DataFrame:
    """Maximum projection along an axis."""
    return vox.groupBy(*[c for c in VK if c != axis]).agg(F.max(value).alias(value))


def projected_area(vox: DataFrame, res: float) -> DataFrame:
    """Pixels of the projected object times the pixel area."""
    return vox.groupBy(*OK).agg((F.countDistinct("y", "x") * res**2).alias("mip_area"))


def dendrite_stats(skeleton: DataFrame, dendrites: DataFrame) -> DataFrame:
    """A10: skeleton voxels (length) and voxels (volume) of the labels on the skeleton."""
    length = skeleton.groupBy(*OK).agg(F.count("*").alias("dendrite_length"))
    return length.join(dendrites.groupBy(*OK).agg(F.count("*").alias("dendrite_volume")), OK)


def neuron_totals(skeleton: DataFrame, dendrites: DataFrame) -> DataFrame:
    """A11."""
    a = skeleton.groupBy("image_id").agg(F.count("*").alias("dendrite_length"))
    return a.join(dendrites.groupBy("image_id").agg(F.count("*").alias("dendrite_vol")), "image_id", "full_outer").fillna(0)


def neuron_summary(spines: DataFrame, totals: DataFrame, measures: list[str]) -> DataFrame:
    """Count, means, and densities per image."""
    means = spines.groupBy("image_id").agg(F.count("*").alias("total_spines"), *[F.avg(c).alias(f"avg_{c}") for c in measures])
    out = means.join(totals, "image_id")
    return out.withColumn("spines_per_um", F.try_divide(F.col("total_spines").cast("double"), F.col("length"))).withColumn("spines_per_um3", F.try_divide(F.col("total_spines").cast("double"), F.col("volume")))


def dendrite_summary(spines: DataFrame, stats: DataFrame, measures: list[str]) -> DataFrame:
    """The same per dendrite."""
    means = spines.groupBy("image_id", "dendrite_id").agg(F.count("*").alias("total_spines"), *[F.avg(c).alias(f"avg_{c}") for c in measures])
    out = means.join(stats, ["image_id", "dendrite_id"], "left")
    return out.withColumn("spines_per_um", F.try_divide(F.col("total_spines").cast("double"), F.col("length"))).withColumn("spines_per_um3", F.try_divide(F.col("total_spines").cast("double"), F.col("volume")))


def filter_components(labelled: DataFrame, least: int, relabel: bool = True) -> DataFrame:
    """Components with at least so many voxels, renumbered per image (or not)."""
    from voxlake.operators.projections import relabel_contiguous

    sizes = labelled.groupBy(*OK).count().where(F.col("count") >= least)
    kept = labelled.join(sizes.select(*OK), OK, "left_semi")
    return relabel_contiguous(kept) if relabel else kept


def distinct_labels(vox: DataFrame) -> DataFrame:
    """A15."""
    return vox.groupBy("image_id", "t").agg(F.countDistinct("label").alias("n_labels"))


def dedupe_tiles(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """The first row of each label by the given order (largest volume first)."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("rank = 1").drop("rank")


def track_matrix(tracks: DataFrame, value: str, times: list[int]) -> DataFrame:
    """Identities by time points."""
    return tracks.groupBy("spine_id").pivot("timepoint", times).agg(F.first(value)).withColumnsRenamed({str(t): f"t{t}" for t in times})


def iou(a: DataFrame, b: DataFrame) -> DataFrame:
    """Intersection over union of two masks per image."""
    both = a.select(*VK, F.lit(1).alias("a")).join(b.select(*VK, F.lit(1).alias("b")), VK, "full_outer")
    hit = (F.col("a").isNotNull() & F.col("b").isNotNull()).cast("long")
    return both.groupBy("image_id").agg(F.sum(hit).alias("intersection"), F.count("*").alias("union_")).withColumn("iou", F.col("intersection") / F.col("union_"))


def dice(vox: DataFrame, truth: str, guess: str, classes: list[int], size: int | None = None) -> DataFrame:
    """2 |A and B| / (|A| + |B|) per image and class; with a volume's size also for the background 0."""
    rows = vox.select("image_id", F.col(truth).alias("a"), F.col(guess).alias("b"))
    ids = F.explode(F.array(*[F.lit(c) for c in classes])).alias("cls")
    long = rows.select("image_id", "a", "b", ids).groupBy("image_id", "cls").agg(F.count_if(F.col("a") == F.col("cls")).alias("n_a"), F.count_if(F.col("b") == F.col("cls")).alias("n_b"), F.count_if((F.col("a") == F.col("cls")) & (F.col("b") == F.col("cls"))).alias("n_both"))
    if size is not None:
        back = rows.groupBy("image_id").agg((size - F.count_if(F.col("a") != 0)).alias("n_a"), (size - F.count_if(F.col("b") != 0)).alias("n_b"), (size - F.count_if((F.col("a") != 0) | (F.col("b") != 0))).alias("n_both")).withColumn("cls", F.lit(0))
        long = long.unionByName(back)
    return long.select("image_id", "cls", F.try_divide(2.0 * F.col("n_both"), (F.col("n_a") + F.col("n_b")).cast("double")).alias("dice"))


def dice_report(scores: DataFrame) -> DataFrame:
    """Means per image, per class and over all in one pass of grouping sets."""
    return scores.groupingSets([["image_id"], ["cls"], []], "image_id", "cls").agg(F.avg("dice").alias("dice"), F.grouping_id().alias("level"))


def object_match(truth: DataFrame, guess: DataFrame) -> DataFrame:
    """Per image, objects that the other volume covers by more (less) than half: true and false positives, misses, precision, recall."""

    def covered(a: DataFrame, b: DataFrame) -> DataFrame:
        flag = a.join(b.select(*VK).distinct().withColumn("hit", F.lit(1)), VK, "left")
        return flag.groupBy(*OK).agg(F.avg(F.coalesce("hit", F.lit(0))).alias("share"))

    a = covered(truth, guess).groupBy("image_id").agg(F.count_if(F.col("share") > 0.5).alias("tp"), F.count("*").alias("n_gt"))
    b = covered(guess, truth).groupBy("image_id").agg(F.count_if(F.col("share") < 0.5).alias("fp"), F.count("*").alias("n_out"))
    out = a.join(b, "image_id", "full_outer").fillna(0).withColumn("fn", F.col("n_gt") - F.col("tp"))
    return out.withColumn("precision", F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col("fp")).cast("double"))).withColumn("recall", F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col("fn")).cast("double")))


def validate(truth: DataFrame, guess: DataFrame) -> DataFrame:
    """One row per image: overlap, object scores, volumes and their difference."""
    volumes = truth.groupBy("image_id").agg(F.count("*").alias("gt_volume")).join(guess.groupBy("image_id").agg(F.count("*").alias("out_volume")), "image_id", "full_outer").fillna(0)
    out = object_match(truth, guess).join(iou(truth, guess), "image_id", "left").join(volumes, "image_id", "left")
    return out.withColumn("volume_difference", F.col("out_volume") - F.col("gt_volume"))


def majority_vote(votes: DataFrame) -> DataFrame:
    """The most voted class of every voxel; ties: the lowest class."""
    counted = votes.groupBy(*VK, "cls").agg(F.count("*").alias("n"))
    return counted.groupBy(*VK).agg(F.min_by("cls", F.struct(-F.col("n"), F.col("cls"))).alias("cls"))


#: Exposed faces by axis: the sides of a voxel that no voxel of its object covers.
FACES = {"z": ("y", "x"), "y": ("z", "x"), "x": ("z", "y")}


def _exposed(vox: DataFrame) -> DataFrame:
    """Voxels with f_z, f_y, f_x: sides without a neighbour of the same object; top: the first of a (y, x) line."""
    w = vox
    for axis, other in FACES.items():
        line = Window.partitionBy(*OK, *other).orderBy(axis)
        w = w.withColumn(f"f_{axis}", F.when(F.lag(axis).over(line) == F.col(axis) - 1, 0).otherwise(1) + F.when(F.lead(axis).over(line) == F.col(axis) + 1, 0).otherwise(1))
        if axis == "z":
            w = w.withColumn("top", F.lag(axis).over(line).isNull())
    return w


def _face_area(sampling: tuple[float, float, float]) -> Column:
    total = math.prod(sampling)
    return sum((F.sum(f"f_{axis}") * (total / s) for axis, s in zip("zyx", sampling, strict=True)), F.lit(0.0))


def surface_area(vox: DataFrame, sampling: tuple[float, float, float] = (1.0, 1.0, 1.0)) -> DataFrame:
    """A24, exposed faces: surface and volume of each object as a stack of voxels."""
    return _exposed(vox).groupBy(*OK).agg(_face_area(sampling).alias("surf_area"), (F.count("*") * math.prod(sampling)).alias("vol"))


_CORNERS = [(z, y, x) for z in (0, 1) for y in (0, 1) for x in (0, 1)]
_SIDES = [[c for c in _CORNERS if c[axis] == v] for axis in range(3) for v in (0, 1)]


def _loops(code: int) -> list[list[np.ndarray]]:
    """Outlines of the surface in a cell (bit k: corner k is inside), through the middles of crossed edges.

    On a face of the cell, segments cut off each inside corner whose two neighbours on the face are outside (so touching corners stay apart),
    else they part the inside corners from the outside ones.
    """
    inside = {c for k, c in enumerate(_CORNERS) if code >> k & 1}
    links: dict = {}
    for side in _SIDES:
        near = lambda c: [d for d in side if sum(p != q for p, q in zip(c, d, strict=True)) == 1]  # noqa: B023, E731
        crossed = [(c, d) for c in side for d in near(c) if c in inside and d not in inside]
        if len(crossed) == 4:
            pairs = [[(c, d) for d in near(c)] for c in side if c in inside]
        else:
            pairs = [crossed] if crossed else []
        for a, b in pairs:
            links.setdefault(a, []).append(b)
            links.setdefault(b, []).append(a)
    out = []
    while links:
        start = min(links)
        loop, now, before = [start], start, None
        while True:
            a, b = links[now]
            before, now = now, b if a == before else a
            if now == start:
                break
            loop.append(now)
        for e in loop:
            del links[e]
        out.append([(np.array(a, float) + np.array(b, float)) / 2 for a, b in loop])
        outward = np.array(loop[0][1], float) - np.array(loop[0][0], float)
        p = out[-1]
        normal = sum(np.cross(p[i], p[(i + 1) % len(p)]) for i in range(len(p)))
        if normal @ outward < 0:
            out[-1] = p[::-1]
    return out


def mesh_cells(sampling: tuple[float, float, float]) -> list[tuple[float, float, float, float, float]]:
    """By cell code: area, six times the signed volume under its triangles from the cell's first corner, and the sum of their (doubled) normals."""
    table, s = [], np.array(sampling)
    for code in range(256):
        area, volume, normal = 0.0, 0.0, np.zeros(3)
        for loop in _loops(code) if 0 < code < 255 else ():
            p = [v * s for v in loop]
            middle = sum(p) / len(p)
            for a, b in zip(p, p[1:] + p[:1], strict=True):
                n = np.cross(a - middle, b - middle)
                area += np.sqrt(n @ n) / 2
                volume += middle @ n
                normal += n
        table.append(tuple(round(float(v), 12) for v in (area, volume, *normal)))
    return table


def surface_mesh(vox: DataFrame, sampling: tuple[float, float, float] = (1.0, 1.0, 1.0)) -> DataFrame:
    """Area and enclosed volume of each object's iso-surface half-way between its voxels and the empty ones around them.

    Every cell of eight voxel centres has one of 256 codes; a table made by rule (mesh_cells) holds what each adds.
    """
    moves = F.explode(F.array(*[F.struct(*[F.lit(v).alias(f"d{c}") for v, c in zip(d, "zyx", strict=True)], F.lit(1 << k).alias("bit")) for k, d in enumerate(_CORNERS)])).alias("d")
    cells = vox.select(*OK, *VK[2:], moves).groupBy(*OK, *[(F.col(c) - F.col(f"d.d{c}")).alias(c) for c in "zyx"]).agg(F.bit_or("d.bit").alias("code"))
    table = vox.sparkSession.createDataFrame([(k, *r) for k, r in enumerate(mesh_cells(sampling))], "code int, area double, six double, nz double, ny double, nx double")
    under = F.col("six") + sum((F.col(c) * s * F.col(f"n{c}") for c, s in zip("zyx", sampling, strict=True)), F.lit(0.0))
    return cells.join(F.broadcast(table), "code").groupBy(*OK).agg(F.sum("area").alias("mesh_area"), (F.sum(under) / 6).alias("mesh_vol"))


def morphometrics(vox: DataFrame, sampling: tuple[float, float, float] = (1.0, 1.0, 1.0)) -> DataFrame:
    """One row per object: box, surface, volume, length, projected area."""
    vox = saved(vox.select(*OK, *VK[2:]).distinct(), "objects")
    own = _exposed(vox).groupBy(*OK).agg(F.count("*").alias("area"), *[f(c).alias(f"{n}_{c}") for c in "zyx" for f, n in ((F.min, "min"), (F.max, "max"))], _face_area(sampling).alias("surf_area"), (F.count("*") * math.prod(sampling)).alias("vol"), (F.count_if("top") * sampling[1] ** 2).alias("mip_area"))
    volume = math.prod([F.col(f"max_{c}") - F.col(f"min_{c}") + 1 for c in "zyx"]).cast("long")
    own = own.select(*OK, "area", volume.alias("bbox_vol"), (F.col("area") / volume).alias("extent"), "surf_area", "vol", "mip_area")
    return own.join(feret_max(vox, sampling).withColumnRenamed("feret_max", "length"), OK)


def box_length_width(points: DataFrame) -> DataFrame:
    """Longest side of the box; spread across the direction to the point farthest from the centroid, in (z, y)."""
    centre = points.groupBy(*OK).agg(*[F.avg(c).alias(f"c{c}") for c in "zyx"], F.greatest(*[F.max(c) - F.min(c) for c in "zyx"]).alias("length"))
    off = points.join(centre, OK)
    d2 = sum(((F.col(c) - F.col(f"c{c}")) ** 2 for c in "zyx"), F.lit(0.0))
    far = off.groupBy(*OK).agg(F.max_by(F.struct((F.col("z") - F.col("cz")).alias("uz"), (F.col("y") - F.col("cy")).alias("uy")), F.struct(d2, -F.col("z"), -F.col("y"), -F.col("x"))).alias("u"), F.first("length").alias("length"))
    norm = F.sqrt(F.col("u.uz") ** 2 + F.col("u.uy") ** 2)
    across = off.drop("length").join(far, OK).withColumn("s", F.when(norm > 0, (F.col("z") - F.col("cz")) * (-F.col("u.uy") / norm) + (F.col("y") - F.col("cy")) * (F.col("u.uz") / norm)).otherwise(0.0))
    return across.groupBy(*OK).agg(F.first("length").alias("length"), (F.max("s") - F.min("s")).alias("width"))


def axis_widths(midline: DataFrame, surface: DataFrame) -> DataFrame:
    """Twice the largest distance across the midline, per midline point; least, largest and mean per object.

    midline: OK, seq, y, x, ty, tx (unit tangent); surface: OK, y, x, seq of its nearest midline point.
    """
    pair = surface.select(*OK, "seq", F.col("y").alias("sy"), F.col("x").alias("sx")).join(midline, [*OK, "seq"])
    across = F.abs((F.col("sy") - F.col("y")) * -F.col("tx") + (F.col("sx") - F.col("x")) * F.col("ty"))
    each = pair.groupBy(*OK, "seq").agg((2 * F.max(across)).alias("w"))
    return each.groupBy(*OK).agg(F.min("w").alias("width_min"), F.max("w").alias("width_max"), F.avg("w").alias("width_mean"))


def percentiles(vox: DataFrame, value: str, low: float, high: float, by: list[str]) -> DataFrame:
    """Exact percentiles with linear interpolation: rows are ranked over range partitions, and only the two beside each are picked."""
    rows = ranked(vox.where(F.col(value).isNotNull()).select(*by, value), by, [value])
    out = []
    for name, share in (("p_low", low), ("p_high", high)):
        at = (F.col("size_") - 1) * share
        under, over = (F.max(F.when(F.col("place_") == f(at), F.col(value))) for f in (F.floor, F.ceil))
        part = F.max(at - F.floor(at))
        out.append((under + (over - under) * part).alias(name))
    return rows.groupBy(*by).agg(*out)


def contrast_stretch(vox: DataFrame, value: str, low: float, high: float, top: float, by: list[str]) -> DataFrame:
    """Values between two percentiles to 0...top, clipped."""
    scaled = F.coalesce(F.try_divide(F.col(value) - F.col("p_low"), F.col("p_high") - F.col("p_low")), F.lit(0.0))
    return vox.join(percentiles(vox, value, low, high, by), by).withColumn(value, F.least(F.lit(1.0), F.greatest(F.lit(0.0), scaled)) * top).drop("p_low", "p_high")


def minmax_normalise(vox: DataFrame, value: str, by: list[str], top: float = 1.0) -> DataFrame:
    """A29."""
    edge = vox.groupBy(*by).agg(F.min(value).alias("low"), F.max(value).alias("high"))
    return vox.join(edge, by).withColumn(value, F.coalesce(F.try_divide(F.col(value) - F.col("low"), F.col("high") - F.col("low")), F.lit(0.0)) * top).drop("low", "high")


def histogram(vox: DataFrame, value: str, bins: int, by: list[str]) -> DataFrame:
    """Counts in equal bins between each group's least and largest value."""
    edge = vox.groupBy(*by).agg(F.min(value).alias("low"), F.max(value).alias("high"))
    share = F.coalesce(F.try_divide(F.col(value) - F.col("low"), F.col("high") - F.col("low")), F.lit(0.0))
    return vox.join(edge, by).withColumn("bin", F.least(F.lit(bins - 1), F.floor(share * bins)).cast("int")).groupBy(*by, "low", "high", "bin").agg(F.count("*").alias("n"))


def otsu_threshold(vox: DataFrame, value: str, by: list[str], bins: int = 256) -> DataFrame:
    """The upper edge of the bin that parts two classes of largest between-class variance."""
    h = histogram(vox, value, bins, by).withColumn("m", F.col("n") * (F.col("bin") + 0.5))
    up = Window.partitionBy(*by).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*by)
    s = h.select("*", F.sum("n").over(up).alias("n0"), F.sum("m").over(up).alias("m0"), F.sum("n").over(whole).alias("nn"), F.sum("m").over(whole).alias("mm"))
    between = F.coalesce(F.try_divide((F.col("mm") * F.col("n0") - F.col("m0") * F.col("nn")) ** 2, (F.col("n0") * (F.col("nn") - F.col("n0"))).cast("double")), F.lit(0.0))
    best = s.withColumn("score", F.round(between, 3)).groupBy(*by).agg(F.min_by(F.struct("bin", "low", "high"), F.struct(-F.col("score"), F.col("bin"))).alias("b"))
    return best.select(*by, (F.col("b.low") + (F.col("b.high") - F.col("b.low")) * (F.col("b.bin") + 1) / bins).alias("threshold"))


def otsu_mask(vox: DataFrame, value: str, shape: tuple[int, int, int], dilate: int = 5, bins: int = 256) -> DataFrame:
    """Voxels above their image's threshold, and all within so many steps (6 neighbours) of them inside the volume's shape."""
    bright = vox.join(otsu_threshold(vox, value, ["image_id"], bins), "image_id").where(F.col(value) > F.col("threshold")).select(*VK)
    inside = reduce(lambda a, b: a & b, (F.col(c).between(0, n - 1) for c, n in zip("zyx", shape, strict=True)))

    def grown(mask: np.ndarray) -> np.ndarray:
        for _ in range(dilate):
            wide = mask.copy()
            for axis in (1, 2, 3):
                to, of = [slice(None)] * 4, [slice(None)] * 4
                to[axis], of[axis] = slice(1, None), slice(None, -1)
                wide[tuple(to)] |= mask[tuple(of)]
                wide[tuple(of)] |= mask[tuple(to)]
            mask = wide
        return mask

    return mask_map(bright, (dilate, dilate, dilate), grown).where(inside)


def histogram_match(vox: DataFrame, value: str, by: str, reference: int) -> DataFrame:
    """Each distinct value to the reference image's value at its quantile, linearly between neighbours.  Distinct values are summed up over range partitions."""
    counts = vox.where(F.col(value).isNotNull()).groupBy(by, value).agg(F.count("*").alias("n"))
    ranks = saved(running(counts, [by], value, "n").withColumn("q", F.col("upto_") / F.col("total_")), "quantiles")
    ref = ranks.where(F.col(by) == reference).select(F.col("q").alias("q1"), F.col(value).alias("v1_"), (F.col("before_upto_") / F.col("total_")).alias("q0"), F.col("before_value_").alias("v0_"))
    ranks = ranks.select(by, value, "q")
    cell = 256
    keyed = ref.withColumn("cell", F.explode(F.sequence(F.floor(F.coalesce("q0", F.lit(0.0)) * cell), F.floor(F.col("q1") * cell))))
    found = ranks.withColumn("cell", F.floor(F.col("q") * cell)).join(keyed, "cell").where((F.col("q") <= F.col("q1")) & (F.col("q0").isNull() | (F.col("q") > F.col("q0"))))
    slope = F.when(F.col("q0").isNull(), F.col("v1_")).otherwise(F.col("v0_") + (F.col("v1_") - F.col("v0_")) * (F.col("q") - F.col("q0")) / (F.col("q1") - F.col("q0")))
    return found.select(by, F.col(value).alias("before"), slope.alias("after"))


def tile_equalise(vox: DataFrame, value: str, tile: int, clip: float, bins: int = 64) -> DataFrame:
    """Per tile, a clipped cumulative histogram (clipped counts spread evenly) as lookup; a voxel blends the lookups of the tiles around it.

    Weights are linear between tile middles in y and x; beyond the outermost middles, and where a tile has no voxel, the other tiles count alone.
    """
    by = ["image_id", "ty", "tx"]
    top = vox.groupBy("image_id").agg(F.min(value).alias("low"), F.max(value).alias("high"))
    share = F.coalesce(F.try_divide(F.col(value) - F.col("low"), F.col("high") - F.col("low")), F.lit(0.0))
    rows = vox.join(top, "image_id").withColumn("bin", F.least(F.lit(bins - 1), F.floor(share * bins)).cast("int"))
    own = rows.groupBy("image_id", F.floor(F.col("y") / tile).alias("ty"), F.floor(F.col("x") / tile).alias("tx"), "bin").agg(F.count("*").alias("n"))
    every = own.select(*by).distinct().withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1)))).join(own, [*by, "bin"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    whole_ = Window.partitionBy(*by)
    limit = F.greatest(F.lit(1.0), clip * F.sum("n").over(whole_))
    h = every.withColumn("total", F.sum("n").over(whole_)).withColumn("kept", F.least(F.col("n").cast("double"), limit))
    h = h.withColumn("spare", (F.col("total") - F.sum("kept").over(whole_)) / bins)
    up = whole_.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    h = h.select(*by, "bin", ((F.sum("kept").over(up) + F.col("spare") * (F.col("bin") + 1)) / F.col("total")).alias("level"))
    for c in "yx":
        at = (F.col(c) + 0.5) / tile - 0.5
        pair = F.array(F.struct(F.floor(at).alias("i"), (1 - (at - F.floor(at))).alias("w")), F.struct((F.floor(at) + 1).alias("i"), (at - F.floor(at)).alias("w")))
        rows = rows.withColumn(c + "_", F.explode(pair)).where(F.col(f"{c}_.w") > 0)
    rows = rows.select(*[k for k in vox.columns], "bin", F.col("y_.i").alias("ty"), F.col("x_.i").alias("tx"), (F.col("y_.w") * F.col("x_.w")).alias("w"))
    found = rows.join(h, [*by, "bin"]).groupBy(*VK).agg((F.sum(F.col("w") * F.col("level")) / F.sum("w")).alias("equalised"))
    return vox.join(found, VK)


def ssim(pairs: DataFrame, a: str, b: str, win: int, size: int, span: float = 1.0, by: str = "image_id") -> DataFrame:
    """Mean structural similarity over a Gaussian window (sigma 1.5, K 0.01 and 0.03), valid region only: windows whose first voxel exists."""
    weights = np.exp(-((np.arange(win) - win // 2) ** 2) / (2 * 1.5**2))
    taps = list(zip(range(0, -win, -1), (weights / weights.sum()).tolist(), strict=True))  # windows by their first voxel

    def moments_of(arrays: list[np.ndarray]) -> list[np.ndarray]:
        x, y = arrays
        return [convolve(convolve(m, taps, 1), taps, 2) for m in (x, y, x * x, y * y, x * y)]

    names = ["m_a", "m_b", "m_aa", "m_bb", "m_ab"]
    moments = dense_map(pairs.select(by, "y", "x", F.col(a).alias("a"), F.col(b).alias("b")), ["a", "b"], [by, "y", "x"], {"y": win - 1, "x": win - 1}, moments_of, names)
    moments = moments.where(F.col("y").between(0, size - win) & F.col("x").between(0, size - win))
    c1, c2 = (0.01 * span) ** 2, (0.03 * span) ** 2
    va, vb, cov = (F.col(p) - F.col(q) * F.col(r) for p, q, r in (("m_aa", "m_a", "m_a"), ("m_bb", "m_b", "m_b"), ("m_ab", "m_a", "m_b")))
    contrast = (2 * cov + c2) / (va + vb + c2)
    value = contrast * (2 * F.col("m_a") * F.col("m_b") + c1) / (F.col("m_a") ** 2 + F.col("m_b") ** 2 + c1)
    return moments.groupBy(by).agg(F.avg(value).alias("ssim"), F.avg(contrast).alias("contrast"))


#: Exponents of the five scales.
SCALES = (0.0448, 0.2856, 0.3001, 0.2363, 0.1333)


def ms_ssim(pairs: DataFrame, a: str, b: str, win: int, size: int, weights: tuple[float, ...] = SCALES, span: float = 1.0, by: str = "image_id") -> DataFrame:
    """Product over scales (each halved by 2 x 2 means) of contrast terms, and of the similarity at the last, to their exponents.

    The size must leave room for a window at the last scale; negative terms count as 0.
    """
    if size >> (len(weights) - 1) < win:
        raise ValueError("too small for so many scales")
    out = None
    for i, w in enumerate(weights):
        last = i == len(weights) - 1
        term = ssim(pairs, a, b, win, size, span, by).select(by, F.pow(F.greatest(F.lit(0.0), F.col("ssim" if last else "contrast")), F.lit(w)).alias(f"s{i}"))
        out = term if out is None else out.join(term, by)
        pairs = pairs.groupBy(by, F.floor(F.col("y") / 2).cast("int").alias("y"), F.floor(F.col("x") / 2).cast("int").alias("x")).agg(F.avg(a).alias(a), F.avg(b).alias(b))
        size //= 2
    product = F.lit(1.0)
    for i in range(len(weights)):
        product *= F.col(f"s{i}")
    return out.select(by, product.alias("ms_ssim"))


def charbonnier(pairs: DataFrame, a: str, b: str, by: str = "image_id") -> DataFrame:
    """Mean of sqrt(difference^2 + 0.001)."""
    return pairs.groupBy(by).agg(F.avg(F.sqrt((F.col(a) - F.col(b)) ** 2 + 1e-3)).alias("loss"))


def volume_meta(vox: DataFrame, channels: list[str], large: int) -> DataFrame:
    """Shape, voxels, bytes at 16 bits, largest value, channels and a flag for large volumes."""
    own = vox.groupBy("image_id").agg(*[(F.max(c) + 1).alias(f"n{c}") for c in "zyx"], F.max(F.greatest(*channels)).alias("max_value"), F.count("*").alias("stored"))
    cells = F.col("nz").cast("long") * F.col("ny") * F.col("nx")
    return own.withColumn("voxels", cells).withColumn("bytes", cells * 2 * len(channels)).withColumn("channels", F.lit(len(channels))).withColumn("is_large", cells > large)
