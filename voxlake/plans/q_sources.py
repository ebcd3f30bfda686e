"""Registered queries: sources and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from voxlake.operators import aggregates as A
from voxlake.operators.projections import VK
from voxlake.plans.register import query, rounded
from voxlake.plans.scratch import scratch_dir
from voxlake.sources import tables as S
from voxlake.sources.fixtures import O_SQL, V_SQL, objects, table, voxels

VKS = "image_id, t, z, y, x"


def _folder(spark) -> str:
    return f"{scratch_dir(spark)}/export-{uuid.uuid4().hex}"


@query("s1_scan_volumes", f"WITH {V_SQL} SELECT (image_id % 4)::VARCHAR AS batch, count(*) AS n, round(sum(v1), 2) AS total FROM v GROUP BY 1")
def _(spark, d):
    path = _folder(spark)
    for k in range(4):
        voxels(spark, d).where(F.col("image_id") % 4 == k).write.parquet(f"{path}/{k}")
    return rounded(S.scan_volumes(spark, path).groupBy("batch").agg(F.count("*").alias("n"), F.sum("v1").alias("total")), 2)


@query("s2_pair_inputs", "WITH a AS (SELECT 'c' || c_custkey AS stem, 'raw/c' || c_custkey || '.tif' AS raw FROM customer WHERE c_acctbal > 0), b AS (SELECT 'c' || c_custkey AS stem, 'labels/c' || c_custkey || '.tiff' AS labels FROM customer WHERE c_mktsegment <> 'MACHINERY') SELECT coalesce(a.stem, b.stem) AS stem, raw, labels, CASE WHEN raw IS NULL THEN 'no raw' WHEN labels IS NULL THEN 'no labels' ELSE 'paired' END AS status FROM a FULL JOIN b ON a.stem = b.stem")
def _(spark, d):
    c = table(spark, d, "customer")
    raw = c.where("c_acctbal > 0").select(F.concat(F.lit("raw/c"), "c_custkey", F.lit(".tif")).alias("path"))
    return S.pair_inputs(raw, c.where("c_mktsegment <> 'MACHINERY'").select(F.concat(F.lit("labels/c"), "c_custkey", F.lit(".tiff")).alias("path")))


@query("s3_to_bricks", f"WITH {V_SQL} SELECT image_id, t, z // 4 AS bz, y // 5 AS by, x // 8 AS bx, count(*)::INT AS n FROM v GROUP BY ALL".replace("AS by", 'AS "by"'))
def _(spark, d):
    return S.to_bricks(voxels(spark, d), "v1", (4, 5, 8)).drop("data")


@query("s3_from_bricks", f"WITH {V_SQL} SELECT {VKS}, v1 AS v FROM v")
def _(spark, d):
    return S.from_bricks(S.to_bricks(voxels(spark, d), "v1", (4, 5, 8)))


@query("s4_normalise_axes", "SELECT p_partkey::BIGINT AS k, CASE WHEN p_partkey % 4 = 3 THEN NULL ELSE (p_partkey % 4 + 1) END::INT AS channel_axis, CASE WHEN p_partkey % 4 = 3 THEN '30,1,40,50' ELSE '30,' || (p_size % 4 + 1) || ',40,50' END AS zcyx FROM part")
def _(spark, d):
    k, c = F.col("p_partkey") % 4, (F.col("p_size") % 4 + 1).cast("int")
    shape = F.when(k == 3, F.array(F.lit(30), F.lit(40), F.lit(50))).when(k == 0, F.array(c, F.lit(30), F.lit(40), F.lit(50))).when(k == 1, F.array(F.lit(30), c, F.lit(40), F.lit(50))).otherwise(F.array(F.lit(30), F.lit(40), c, F.lit(50)))
    out = S.normalise_axes(table(spark, d, "part").select(F.col("p_partkey").cast("long").alias("k"), shape.alias("shape")))
    return out.select("k", "channel_axis", F.array_join("zcyx", ",").alias("zcyx"))


@query("s5_pending", "SELECT c_custkey::BIGINT AS k FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def _(spark, d):
    done = table(spark, d, "orders").select(F.col("o_custkey").cast("long").alias("k"))
    return S.pending(table(spark, d, "customer").select(F.col("c_custkey").cast("long").alias("k")), done, ["k"])


@query("s6_stack_channels", f"WITH {V_SQL} SELECT {VKS}, 1 AS c, least(65535, greatest(0, trunc(v1)))::INT AS v FROM v UNION ALL SELECT {VKS}, 2, least(65535, greatest(0, trunc(v2)))::INT FROM v")
def _(spark, d):
    vox = voxels(spark, d)
    return S.stack_channels([vox.select(*VK, F.col("v1").alias("f")), vox.select(*VK, F.col("v2").alias("f"))], "f")


@query("s7_write_tables", f"WITH {O_SQL} SELECT image_id, count(*) AS n, round(sum(area), 4) AS area FROM o GROUP BY image_id")
def _(spark, d):
    path = _folder(spark)
    S.write_tables(objects(spark, d).select("image_id", "label", "line", "area"), path)
    back = spark.read.option("header", "true").schema("label long, line int, area double, image_id long").csv(path)
    return rounded(back.groupBy("image_id").agg(F.count("*").alias("n"), F.sum("area").alias("area")), 4)


@query("s8_settings", f"WITH {O_SQL}, s AS (SELECT max(r_regionkey) * 0.1 AS xy FROM region) SELECT label, line, round(area * xy, 6) AS um, 1.0::DOUBLE AS z FROM o, s")
def _(spark, d):
    given = table(spark, d, "region").agg((F.max("r_regionkey") * 0.1).alias("xy"))
    settings = S.settings_table(given, {"xy": 0.102, "z": 1.0})
    return rounded(S.with_settings(objects(spark, d), settings).select("label", "line", (F.col("area") * F.col("xy")).alias("um"), "z"))


@query("s9_dataset_manifest", f"""WITH {V_SQL} SELECT count(DISTINCT image_id) AS "numTraining", '{{"class_1":1,"class_2":2,"class_3":3}}' AS labels FROM v""")
def _(spark, d):
    return S.dataset_manifest(voxels(spark, d), "image_id", "cls")


@query("s10_slab_export", f"WITH {V_SQL} SELECT image_id, (z // 3)::INT AS slab, count(*) AS n FROM v GROUP BY ALL")
def _(spark, d):
    path = _folder(spark)
    S.slab_export(voxels(spark, d), path, 3)
    return spark.read.parquet(path).groupBy("image_id", "slab").agg(F.count("*").alias("n"))


@query("s11_format_report", f"WITH {V_SQL} SELECT image_id, printf('%.4f', 2.0 * count(*) FILTER (cls = 1 AND cls_pred = 1) / (count(*) FILTER (cls = 1) + count(*) FILTER (cls_pred = 1))) AS dice FROM v GROUP BY image_id")
def _(spark, d):
    return S.format_report(A.dice(voxels(spark, d), "cls", "cls_pred", [1]).select("image_id", "dice"), ["dice"])
