"""Sources and sinks (S1-S11).  Volumes are Parquet tables of voxels or bricks."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from voxlake.operators.projections import VK, to_uint16


def scan_volumes(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """Every table below a folder, with its path and the sub-folder that it lies in as batch."""
    df = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).parquet(root)
    path = F.col("_metadata.file_path")
    return df.select("*", path.alias("file_path"), F.element_at(F.split(path, "/"), -2).alias("batch"))


def pair_inputs(raw: DataFrame, labels: DataFrame, path: str = "path") -> DataFrame:
    """Files paired by stem; status says which side lacks one."""
    name = lambda c: F.regexp_replace(F.element_at(F.split(c, "/"), -1), r"\.[^.]*$", "")
    a = raw.select(name(F.col(path)).alias("stem"), F.col(path).alias("raw"))
    b = labels.select(name(F.col(path)).alias("stem"), F.col(path).alias("labels"))
    status = F.when(F.col("raw").isNull(), "no raw").when(F.col("labels").isNull(), "no labels").otherwise("paired")
    return a.join(b, "stem", "full_outer").withColumn("status", status)


def to_bricks(vox: DataFrame, value: str, shape: tuple[int, int, int]) -> DataFrame:
    """S3: bricks with their voxels as sorted arrays; ragged at the edges, nothing stored for background."""
    cells = {f"b{c}": F.floor(F.col(c) / n).cast("int") for c, n in zip("zyx", shape, strict=True)}
    rows = vox.withColumns(cells).groupBy("image_id", "t", "bz", "by", "bx").agg(F.array_sort(F.collect_list(F.struct("z", "y", "x", F.col(value).alias("v")))).alias("data"))
    return rows.withColumn("n", F.size("data"))


def from_bricks(bricks: DataFrame) -> DataFrame:
    """S3, the other way."""
    return bricks.select("image_id", "t", F.explode("data").alias("d")).select("image_id", "t", "d.*")


def channel_axis(shape: Column) -> Column:
    """The (1-based) axis of the channels: the smallest of four, none of three."""
    return F.when(F.size(shape) == 4, F.array_position(shape, F.array_min(shape)).cast("int"))


def normalise_axes(meta: DataFrame, shape: str = "shape") -> DataFrame:
    """Shape as (Z, C, Y, X); volumes of three axes get one channel."""
    s, c = F.col(shape), channel_axis(F.col(shape))
    rest = F.filter(F.transform(s, lambda v, i: F.struct(v.alias("v"), (i + 1).alias("i"))), lambda e: e["i"] != c)
    rest = F.transform(rest, lambda e: e["v"])
    four = F.concat(F.slice(rest, 1, 1), F.array(F.element_at(s, c)), F.slice(rest, 2, 2))
    three = F.concat(F.slice(s, 1, 1), F.array(F.lit(1)), F.slice(s, 2, 2))
    return meta.withColumn("channel_axis", c).withColumn("zcyx", F.when(F.size(s) == 4, four).otherwise(three))


def pending(inputs: DataFrame, manifest: DataFrame, on: list[str]) -> DataFrame:
    """Inputs that the manifest of finished work lacks."""
    return inputs.join(manifest.select(*on), on, "left_anti")


def stack_channels(fields: list[DataFrame], value: str) -> DataFrame:
    """Fields of equal shape as channels 1, 2, ... of one 16-bit volume."""
    out = None
    for i, f in enumerate(fields):
        one = f.select(*VK, F.lit(i + 1).alias("c"), to_uint16(F.col(value)).alias("v"))
        out = one if out is None else out.unionByName(one)
    return out


def write_tables(df: DataFrame, path: str, by: str = "image_id") -> None:
    """CSV with a header, one folder per image."""
    df.repartition(by).write.partitionBy(by).option("header", "true").mode("overwrite").csv(path)


def settings_table(given: DataFrame, defaults: dict[str, float]) -> DataFrame:
    """Parameters with defaults for missing or null ones."""
    have = set(given.columns)
    return given.select(*[c for c in given.columns if c not in defaults], *[F.coalesce(F.col(k), F.lit(v)).alias(k) if k in have else F.lit(v).alias(k) for k, v in defaults.items()])


def with_settings(df: DataFrame, settings: DataFrame) -> DataFrame:
    """One row of parameters beside every row."""
    return df.crossJoin(F.broadcast(settings.limit(1)))


def dataset_manifest(labels: DataFrame, case: str, cls: str) -> DataFrame:
    """A JSON manifest of a training set: number of cases and classes in order."""
    own = labels.agg(F.countDistinct(case).alias("numTraining"), F.array_sort(F.collect_set(cls)).alias("classes"))
    names = F.map_from_entries(F.transform("classes", lambda c: F.struct(F.concat(F.lit("class_"), c), c)))
    return own.select("numTraining", F.to_json(names).alias("labels"))


def slab_export(vox: DataFrame, path: str, slab: int, records: int = 1_000_000) -> None:
    """Parquet in z slabs, each sorted by image, z, y, x."""
    slabbed = vox.withColumn("slab", F.floor(F.col("z") / slab).cast("int"))
    slabbed.repartitionByRange("image_id", "slab").sortWithinPartitions("image_id", "z", "y", "x").write.option("maxRecordsPerFile", records).mode("overwrite").parquet(path)


@F.pandas_udf(StringType())
def four_decimals(values: pd.Series) -> pd.Series:
    """As C's printf: the exact binary value, halves to even (the JVM's format rounds the shortest decimal, halves up); null stays null."""
    return values.map(lambda v: None if pd.isna(v) else f"{v:.4f}")


def format_report(df: DataFrame, values: list[str]) -> DataFrame:
    """Numbers with four decimals."""
    return df.withColumns({c: four_decimals(F.col(c).cast("double")) for c in values})
