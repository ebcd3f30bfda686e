"""Voxel, track, patch and object views over the driver's tables, and the same as DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

V_SQL = """v AS (SELECT l_suppkey::BIGINT AS image_id, 0 AS t, (l_linenumber - 1)::INT AS z, CAST(l_quantity - 1 AS INT) % 10 AS y, CAST(l_partkey % 20 AS INT) AS x,
  MAX(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END)::INT AS cls, MAX(CASE l_linestatus WHEN 'F' THEN 1 ELSE 2 END)::INT AS cls_pred,
  MAX(l_extendedprice)::DOUBLE AS v1, MAX(l_discount::DOUBLE * 1000) AS v2 FROM lineitem GROUP BY 1, 2, 3, 4, 5)"""
OV_SQL = V_SQL + ", ov AS (SELECT *, ((y // 3) * 5 + x // 4 + 1)::BIGINT AS label FROM v WHERE cls = 1)"
T_SQL = """tr AS (SELECT user_id::BIGINT AS spine_id, CAST(EXTRACT(day FROM ts) AS INT) AS timepoint, SUM(value)::DOUBLE AS spine_vol, COUNT(*)::BIGINT AS n,
  (user_id % 7)::INT AS z, (user_id % 31)::INT AS y, CAST(user_id % 53 AS INT) AS x FROM events GROUP BY 1, 2, 5, 6, 7)"""
P_SQL = """p AS (SELECT vec_id::BIGINT AS image_id, label::INT AS cls, ((i - 1) // 8)::INT AS y, ((i - 1) % 8)::INT AS x, embedding[i]::DOUBLE AS v
  FROM embeddings, (SELECT unnest(range(1, 65)) AS i))"""
O_SQL = """o AS (SELECT l_suppkey::BIGINT AS image_id, l_orderkey::BIGINT AS label, (l_partkey % 50)::BIGINT AS dendrite_id, l_linenumber::INT AS line,
  l_quantity::DOUBLE AS area, l_extendedprice::DOUBLE AS price, l_discount::DOUBLE AS disc, l_tax::DOUBLE AS tax FROM lineitem)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def voxels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V: (image_id, t, z, y, x, cls, cls_pred, v1, v2), one row per voxel."""
    cell = (F.col("l_suppkey").cast("long").alias("image_id"), F.lit(0).alias("t"), (F.col("l_linenumber") - 1).cast("int").alias("z"), ((F.col("l_quantity") - 1).cast("int") % 10).alias("y"), (F.col("l_partkey") % 20).cast("int").alias("x"))
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    rows = table(spark, sf_dir, "lineitem").select(*cell, F.when(flag == "A", 1).when(flag == "N", 2).otherwise(3).alias("c"), F.when(status == "F", 1).otherwise(2).alias("s"), F.col("l_extendedprice").cast("double").alias("v1"), (F.col("l_discount").cast("double") * 1000).alias("v2"))
    return rows.groupBy("image_id", "t", "z", "y", "x").agg(F.max("c").alias("cls"), F.max("s").alias("cls_pred"), F.max("v1").alias("v1"), F.max("v2").alias("v2"))


def object_voxels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spine voxels with a label per 3 x 4 column of the grid: objects that plain SQL can name too."""
    label = (F.floor(F.col("y") / 3) * 5 + F.floor(F.col("x") / 4) + 1).cast("long")
    return voxels(spark, sf_dir).where("cls = 1").withColumn("label", label)


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T: (spine_id, timepoint, spine_vol, n, z, y, x)."""
    u = F.col("user_id")
    keys = (u.cast("long").alias("spine_id"), F.dayofmonth("ts").alias("timepoint"), (u % 7).cast("int").alias("z"), (u % 31).cast("int").alias("y"), (u % 53).cast("int").alias("x"))
    return table(spark, sf_dir, "events").groupBy(*keys).agg(F.sum(F.col("value").cast("double")).alias("spine_vol"), F.count("*").alias("n"))


def patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P: 8 x 8 patches (image_id, cls, y, x, v)."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("image_id"), F.col("label").cast("int").alias("cls"), F.posexplode("embedding").alias("i", "v"))
    return rows.select("image_id", "cls", F.floor(F.col("i") / 8).cast("int").alias("y"), (F.col("i") % 8).cast("int").alias("x"), F.col("v").cast("double").alias("v"))


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O: (image_id, label, dendrite_id, line, area, price, disc, tax), a plain object table."""
    c = F.col
    return table(spark, sf_dir, "lineitem").select(c("l_suppkey").cast("long").alias("image_id"), c("l_orderkey").cast("long").alias("label"), (c("l_partkey") % 50).cast("long").alias("dendrite_id"), c("l_linenumber").cast("int").alias("line"), c("l_quantity").cast("double").alias("area"), c("l_extendedprice").cast("double").alias("price"), c("l_discount").cast("double").alias("disc"), c("l_tax").cast("double").alias("tax"))
