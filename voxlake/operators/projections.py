"""Projections, filters and label bookkeeping.

Volumes are sparse voxel tables keyed (image_id, t, z, y, x); label volumes add label; class volumes add cls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

VK = ["image_id", "t", "z", "y", "x"]
#: Fixed values: (model type, class code, region).
CLASS_CODES = [(1, 1, "spine"), (1, 2, "dendrite"), (1, 3, "soma"), (2, 1, "dendrite"), (2, 2, "soma"), (3, 1, "spine"), (3, 2, "dendrite"), (3, 3, "soma"), (3, 4, "neck"), (4, 1, "dendrite"), (4, 2, "spine"), (4, 3, "spine"), (4, 4, "neck"), (4, 5, "soma"), (4, 6, "axon")]


def class_masks(labels: DataFrame, model_type: int = 1) -> DataFrame:
    """Class codes to regions; the spine of type 4 joins core and membrane."""
    codes = [(c, r) for m, c, r in CLASS_CODES if m == model_type]
    return labels.join(F.broadcast(labels.sparkSession.createDataFrame(codes, "cls int, region string")), "cls")


def um_to_voxels(df: DataFrame, volume: str, distance: str, xy: float, z: float) -> DataFrame:
    """Volumes in um3 to voxels and distances in um to pixels, rounding half to even."""
    return df.withColumn(f"{volume}_vox", F.bround(F.col(volume) / (xy * xy * z), 0)).withColumn(f"{distance}_px", F.bround(F.col(distance) / xy, 2))


def voxels_to_um(df: DataFrame, lengths: list[str], volumes: list[str], xy: float, z: float) -> DataFrame:
    """Lengths times the pixel size, volumes times the voxel volume."""
    return df.withColumns({c: F.col(c) * xy for c in lengths} | {c: F.col(c) * (xy * xy * z) for c in volumes})


def filter_by_volume(objects: DataFrame, low: float, high: float, col: str = "area") -> DataFrame:
    """Strictly between."""
    return objects.where((F.col(col) > low) & (F.col(col) < high))


def filter_by_distance(objects: DataFrame, limit: float, on: str = "min_dist") -> DataFrame:
    """P5: the minimum (or maximum) distance strictly below."""
    return objects.where(F.col(on) < limit)


def keep_labels(vox: DataFrame, objects: DataFrame, on: list[str]) -> DataFrame:
    """Only the voxels of labels that are still in the table."""
    return vox.join(objects.select(*on).distinct(), on, "left_semi")


def offset_labels(vox: DataFrame) -> DataFrame:
    """Labels made unique over images by the running sum of earlier images' maxima."""
    top = vox.groupBy("image_id").agg(F.max("label").alias("top"))
    base = top.withColumn("base", F.coalesce(F.sum("top").over(Window.orderBy("image_id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return vox.join(base.select("image_id", "base"), "image_id").withColumn("label", F.col("label") + F.col("base")).drop("base")


def relabel_contiguous(vox: DataFrame) -> DataFrame:
    """Labels of each image to 1, 2, ... in order."""
    names = vox.select("image_id", "label").distinct().withColumn("new", F.row_number().over(Window.partitionBy("image_id").orderBy("label")).cast("long"))
    return vox.join(names, ["image_id", "label"]).drop("label").withColumnRenamed("new", "label")


def drop_if_exists(df: DataFrame, cols: list[str]) -> DataFrame:
    """P9."""
    return df.drop(*[c for c in cols if c in df.columns])


def move_column(df: DataFrame, col: str, position: int) -> DataFrame:
    """P10."""
    rest = [c for c in df.columns if c != col]
    return df.select(*rest[:position], col, *rest[position:])


def reorder_columns(df: DataFrame, first: list[str], pattern: str, last: list[str]) -> DataFrame:
    """Known columns first, channel columns by (channel, region, stat), the rest, then the last ones."""
    import re

    found = sorted((int(m["channel"]), m["region"], m["stat"], c) for c in df.columns if (m := re.fullmatch(pattern, c)))
    known = [c for c in first if c in df.columns]
    channel = [f[-1] for f in found if f[-1] not in known]
    end = [c for c in last if c in df.columns]
    rest = [c for c in df.columns if c not in {*known, *channel, *end}]
    return df.select(*known, *channel, *rest, *end)


def backfill_columns(df: DataFrame, cols: list[str], voxel_volume: float) -> DataFrame:
    """A missing `x` from `x_vox` times the voxel volume, else null."""
    new = {c: F.col(f"{c}_vox") * voxel_volume if f"{c}_vox" in df.columns else F.lit(None).cast("double") for c in cols if c not in df.columns}
    return df.withColumns(new) if new else df


def integrated_density(df: DataFrame, volume: str, means: dict[str, str]) -> DataFrame:
    """Volume times mean, unless the column is there."""
    new = {out: F.col(volume) * F.col(mean) for out, mean in means.items() if out not in df.columns}
    return df.withColumns(new) if new else df


def to_uint16(c: Column) -> Column:
    """Truncated and clipped to 16 bits."""
    return F.least(F.lit(65535), F.greatest(F.lit(0), c.cast("int")))


def _shape(length: Column, head: Column, neck: Column) -> tuple[Column, Column, Column, Column]:
    """Ratios length/head and head/neck of floored inputs, and whether each is about one (20 %)."""
    one, h, n = (F.greatest(c, F.lit(1e-9)) for c in (length, head, neck))
    a, b = one / h, h / n
    return a, b, a.between(0.8, 1.2), b.between(0.8, 1.2)


def fine_type(length: Column, head: Column, neck: Column) -> Column:
    """long_thin, thin, stubby, mushroom, filopodia or other; the first rule that holds."""
    a, b, _, even = _shape(length, head, neck)
    level = _shape(length, head, neck)[2]
    return F.when((a > 2.0) & even, "filopodia").when((a > 2.0) & (b > 1.2), "long_thin").when((a > 1.2) & (b > 1.2), "thin").when(level & even, "stubby").when(b > 2.0, "mushroom").otherwise("other")


def classify_spine(length: Column, head: Column, neck: Column) -> Column:
    """The two types that tables carry."""
    return F.when(fine_type(length, head, neck) == "filopodia", "filopodia").otherwise("spine")


def hull_ratio(hull: Column, volume: Column) -> Column:
    """(hull - volume) / volume, null where undefined."""
    return F.try_divide(hull - volume, volume)


def clip_normalise(v: Column, low: float, high: float) -> Column:
    """P17."""
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), (v - low) / (high - low)))


def denormalise(v: Column, low: float, high: float) -> Column:
    """P17, the other way."""
    return v * (high - low) + low


def fill_zero_with_min(vox: DataFrame, col: str, by: list[str]) -> DataFrame:
    """Zeros become the smallest value above zero of their group."""
    low = vox.groupBy(*by).agg(F.min(F.when(F.col(col) > 0, F.col(col))).alias("low"))
    return vox.join(low, by).withColumn(col, F.when(F.col(col) == 0, F.coalesce("low", F.col(col))).otherwise(F.col(col))).drop("low")


def cut_outliers(vox: DataFrame, new: str, raw: str, factor: float, by: list[str]) -> DataFrame:
    """Values above factor times the raw maximum become the smallest raw value above zero."""
    edge = vox.groupBy(*by).agg(F.max(raw).alias("top"), F.min(F.when(F.col(raw) > 0, F.col(raw))).alias("low"))
    return vox.join(edge, by).withColumn(new, F.when(F.col(new) > factor * F.col("top"), F.col("low")).otherwise(F.col(new))).drop("top", "low")


def mask_multiply(intensity: DataFrame, mask: DataFrame) -> DataFrame:
    """P20: intensity where the mask has a voxel."""
    return intensity.join(mask.select(*VK), VK, "left_semi")


def labels_to_channels(labels: DataFrame, top: int) -> DataFrame:
    """One 255 mask per class, as rows (channel, value)."""
    return labels.withColumn("channel", F.explode(F.sequence(F.lit(1), F.lit(top)))).withColumn("value", F.when(F.col("cls") == F.col("channel"), 255).otherwise(0))


def channels_to_labels(channels: DataFrame, top: int) -> DataFrame:
    """A class survives only where the next channel is unset; the top channel always does."""
    wide = channels.groupBy(*VK).pivot("channel", list(range(1, top + 1))).agg(F.max(F.when(F.col("value") > 0, 1).otherwise(0)))
    label = sum((F.lit(j) * F.col(str(j)) * (1 - F.col(str(j + 1)) if j < top else F.lit(1)) for j in range(1, top + 1)), F.lit(0))
    return wide.select(*VK, label.cast("int").alias("cls"))


def pad_volume(vox: DataFrame, before: tuple[int, int, int]) -> DataFrame:
    """Constant padding of a sparse volume is a shift of coordinates."""
    return vox.withColumns({a: F.col(a) + n for a, n in zip(("z", "y", "x"), before, strict=True)})


def pad_reflect(vox: DataFrame, axis: str, size: int, multiple: int) -> DataFrame:
    """Padding at the end of an axis to a multiple, by reflection without the edge."""
    extra = -size % multiple
    mirrored = vox.withColumn(axis, 2 * (size - 1) - F.col(axis)).where(F.col(axis).between(size, size + extra - 1))
    return vox.unionByName(mirrored)


def pad_to_common(vox: DataFrame, by: list[str]) -> DataFrame:
    """Objects centred in the largest box of their group; adds the pads used."""
    own = vox.groupBy(*by, "label").agg(*[(F.max(a) - F.min(a) + 1).alias(f"size_{a}") for a in "zyx"], *[F.min(a).alias(f"low_{a}") for a in "zyx"])
    top = own.groupBy(*by).agg(*[F.max(f"size_{a}").alias(f"top_{a}") for a in "zyx"])
    pads = own.join(top, by).select(*by, "label", *[f"low_{a}" for a in "zyx"], *[F.ceil((F.col(f"top_{a}") - F.col(f"size_{a}")) / 2).cast("int").alias(f"pad_{a}") for a in "zyx"])
    return vox.join(pads, [*by, "label"]).withColumns({a: F.col(a) - F.col(f"low_{a}") + F.col(f"pad_{a}") for a in "zyx"}).drop(*[f"low_{a}" for a in "zyx"])


def dihedral_augment(patch: DataFrame, size: int) -> DataFrame:
    """P25: the eight flips and turns of a square patch, one per mode."""
    modes = [(m, a, b, c, d) for m, (a, b, c, d) in enumerate([(1, 0, 0, 1), (-1, 0, 0, 1), (1, 0, 0, -1), (-1, 0, 0, -1), (0, 1, 1, 0), (0, -1, 1, 0), (0, 1, -1, 0), (0, -1, -1, 0)])]
    table = patch.sparkSession.createDataFrame(modes, "mode int, a int, b int, c int, d int")
    y, x = F.col("y"), F.col("x")
    shift = lambda p, q: F.when(F.col(p) + F.col(q) < 0, size - 1).otherwise(0)
    moved = patch.crossJoin(F.broadcast(table)).select(*[c for c in patch.columns if c not in "yx"], "mode", (F.col("a") * y + F.col("b") * x + shift("a", "b")).alias("y"), (F.col("c") * y + F.col("d") * x + shift("c", "d")).alias("x"))
    return moved


def reslice(vox: DataFrame, plane: str) -> DataFrame:
    """Planes xy, xz or yz as (slice, row, col)."""
    order = {"xy": "zyx", "xz": "yzx", "yz": "xzy"}[plane]
    return vox.select("image_id", "t", *[F.col(a).alias(n) for a, n in zip(order, ("slice", "row", "col"), strict=True)], *[c for c in vox.columns if c not in {*VK}])


def fuse_views(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    """Integer mean of two aligned volumes."""
    return a.join(b.select(*VK, F.col(col).alias("other")), VK).select(*VK, (F.col(col) / 2 + F.col("other") / 2).cast("int").alias(col))


def intensity_scale(vox: DataFrame, col: str, factor: float, by: list[str]) -> DataFrame:
    """Stretched to 0...1, times factor, clipped."""
    edge = vox.groupBy(*by).agg(F.min(col).alias("low"), F.max(col).alias("top"))
    v = F.coalesce(F.try_divide(F.col(col) - F.col("low"), F.col("top") - F.col("low")), F.lit(0.0)) * factor
    return vox.join(edge, by).withColumn(col, F.least(F.lit(1.0), v)).drop("low", "top")


def quality_gate(vox: DataFrame) -> DataFrame:
    """Volumes with fewer than eight slices, or a number that eight does not divide."""
    depth = vox.groupBy("image_id").agg((F.max("z") + 1).alias("depth"))
    return depth.withColumn("shallow", F.col("depth") < 8).withColumn("ragged", F.col("depth") % 8 != 0)


def warp(vox: DataFrame, matrix: list[list[float]], shift: list[float]) -> DataFrame:
    """An affine transform to the nearest voxel; of voxels that meet, the largest (z, y, x) wins."""
    to = {a: F.floor(sum((F.col(b) * m for b, m in zip("zyx", row, strict=True)), F.lit(0.0)) + s + 0.5).cast("int") for a, row, s in zip(("nz", "ny", "nx"), matrix, shift, strict=True)}
    rest = [c for c in vox.columns if c not in VK]
    moved = vox.withColumns(to).groupBy("image_id", "t", "nz", "ny", "nx").agg(F.max_by(F.struct(*rest), F.struct("z", "y", "x")).alias("r"))
    return moved.select("image_id", "t", F.col("nz").alias("z"), F.col("ny").alias("y"), F.col("nx").alias("x"), "r.*")
