"""Registered queries: projections, filters and scalar functions."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from voxlake.functions import scalar as S
from voxlake.operators import projections as P
from voxlake.operators.warps import warp_inverse
from voxlake.plans.register import query, rounded
from voxlake.sources.fixtures import O_SQL, OV_SQL, P_SQL, T_SQL, V_SQL, object_voxels, objects, patches, table, tracks, voxels

XY, Z = 0.102, 1.0
VKS = "image_id, t, z, y, x"


@query("p1_class_masks", f"WITH {V_SQL} SELECT image_id, z, y, x, cls, CASE cls WHEN 1 THEN 'spine' WHEN 2 THEN 'dendrite' WHEN 3 THEN 'soma' END AS region FROM v")
def _(spark, d):
    return P.class_masks(voxels(spark, d), 1).select("image_id", "z", "y", "x", "cls", "region")


@query("p2_um_to_voxels", f"WITH {O_SQL} SELECT label, line, area, price, round_even(area / ({XY} * {XY} * {Z}), 0) AS area_vox, round_even(price / {XY}, 2) AS price_px FROM o")
def _(spark, d):
    return P.um_to_voxels(objects(spark, d), "area", "price", XY, Z).select("label", "line", "area", "price", "area_vox", "price_px")


@query("p3_voxels_to_um", f"WITH {O_SQL} SELECT label, line, round(price * {XY}, 6) AS price, round(area * ({XY} * {XY} * {Z}), 6) AS area FROM o")
def _(spark, d):
    return rounded(P.voxels_to_um(objects(spark, d), ["price"], ["area"], XY, Z).select("label", "line", "price", "area"))


@query("p4_filter_by_volume", f"WITH {O_SQL} SELECT label, line, area FROM o WHERE area > 5 AND area < 40")
def _(spark, d):
    return P.filter_by_volume(objects(spark, d), 5, 40).select("label", "line", "area")


@query("p5_filter_by_distance", f"WITH {O_SQL} SELECT label, line, disc FROM o WHERE disc < 0.05")
def _(spark, d):
    return P.filter_by_distance(objects(spark, d), 0.05, "disc").select("label", "line", "disc")


@query("p6_keep_labels", f"WITH {OV_SQL} SELECT {VKS}, label FROM ov WHERE (image_id, label) IN (SELECT (image_id, label) FROM ov GROUP BY image_id, label HAVING count(*) >= 10)")
def _(spark, d):
    vox = object_voxels(spark, d)
    return P.keep_labels(vox, vox.groupBy("image_id", "label").count().where("count >= 10"), ["image_id", "label"]).select(*P.VK, "label")


@query("p7_offset_labels", f"WITH {OV_SQL}, m AS (SELECT image_id, coalesce(sum(max(label)) OVER (ORDER BY image_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base FROM ov GROUP BY image_id) SELECT {VKS}, (label + base)::BIGINT AS label FROM ov JOIN m USING (image_id)")
def _(spark, d):
    return P.offset_labels(object_voxels(spark, d)).select(*P.VK, "label")


@query("p8_relabel_contiguous", f"WITH {OV_SQL} SELECT {VKS}, dense_rank() OVER (PARTITION BY image_id ORDER BY label) AS label FROM ov")
def _(spark, d):
    return P.relabel_contiguous(object_voxels(spark, d)).select(*P.VK, "label")


@query("p9_drop_if_exists", f"WITH {O_SQL} SELECT image_id, label, line, area, price FROM o")
def _(spark, d):
    return P.drop_if_exists(objects(spark, d), ["disc", "tax", "dendrite_id", "absent"])


@query("p10_move_column", f"WITH {O_SQL} SELECT label, image_id, dendrite_id, line, area, price, disc, tax FROM o")
def _(spark, d):
    return P.move_column(objects(spark, d), "label", 0)


@query("p11_reorder_columns", f"WITH {O_SQL} SELECT label AS spine_id, area, price AS spine_C2_mean_int, disc AS head_C2_max_int, tax AS neck_C3_mean_int, line, 'spine' AS spine_type FROM o")
def _(spark, d):
    df = objects(spark, d).select(F.lit("spine").alias("spine_type"), F.col("tax").alias("neck_C3_mean_int"), "line", F.col("disc").alias("head_C2_max_int"), "area", F.col("price").alias("spine_C2_mean_int"), F.col("label").alias("spine_id"))
    return P.reorder_columns(df, ["spine_id", "x", "y", "area"], r"(?P<region>spine|head|neck)_C(?P<channel>\d+)_(?P<stat>mean|max)_int", ["spine_type"])


@query("p12_backfill_columns", f"WITH {O_SQL} SELECT label, line, area AS head_vol_vox, round(area * ({XY} * {XY} * {Z}), 6) AS head_vol, NULL::DOUBLE AS neck_vol FROM o")
def _(spark, d):
    df = objects(spark, d).select("label", "line", F.col("area").alias("head_vol_vox"))
    return rounded(P.backfill_columns(df, ["head_vol", "neck_vol"], XY * XY * Z)).withColumn("head_vol_vox", F.col("head_vol_vox"))


@query("p13_integrated_density", f"WITH {O_SQL} SELECT label, line, area, price, disc, round(area * price, 4) AS spine_C1_int_density, round(area * disc, 4) AS spine_C2_int_density FROM o")
def _(spark, d):
    df = P.integrated_density(objects(spark, d), "area", {"spine_C1_int_density": "price", "spine_C2_int_density": "disc", "price": "disc"})
    return rounded(df.select("label", "line", "area", "price", "disc", "spine_C1_int_density", "spine_C2_int_density"), 4)


@query("p14_to_uint16", f"WITH {V_SQL} SELECT {VKS}, least(65535, greatest(0, trunc(v1)))::INT AS v FROM v")
def _(spark, d):
    return voxels(spark, d).select(*P.VK, P.to_uint16(F.col("v1")).alias("v"))


_RATIO = "area AS l, disc * 100 AS h, tax * 100 AS n"
_TYPES = """CASE WHEN a > 2.0 AND b BETWEEN 0.8 AND 1.2 THEN 'filopodia' WHEN a > 2.0 AND b > 1.2 THEN 'long_thin' WHEN a > 1.2 AND b > 1.2 THEN 'thin'
  WHEN a BETWEEN 0.8 AND 1.2 AND b BETWEEN 0.8 AND 1.2 THEN 'stubby' WHEN b > 2.0 THEN 'mushroom' ELSE 'other' END"""


@query("p15_classify_spine", f"WITH {O_SQL}, r AS (SELECT label, line, greatest(area, 1e-9) / greatest(disc * 100, 1e-9) AS a, greatest(disc * 100, 1e-9) / greatest(tax * 100, 1e-9) AS b FROM o), f AS (SELECT label, line, {_TYPES} AS fine_type FROM r) SELECT label, line, fine_type, CASE WHEN fine_type = 'filopodia' THEN 'filopodia' ELSE 'spine' END AS spine_type FROM f")
def _(spark, d):
    args = (F.col("area"), F.col("disc") * 100, F.col("tax") * 100)
    return objects(spark, d).select("label", "line", P.fine_type(*args).alias("fine_type"), P.classify_spine(*args).alias("spine_type"))


@query("p16_hull_ratio", f"WITH {O_SQL} SELECT label, line, round((area - tax) / nullif(tax, 0), 6) AS hull_ratio FROM o")
def _(spark, d):
    return rounded(objects(spark, d).select("label", "line", P.hull_ratio(F.col("area"), F.col("tax")).alias("hull_ratio")))


@query("p17_clip_normalise", f"WITH {V_SQL}, c AS (SELECT {VKS}, least(1.0, greatest(0.0, (v1 - 1000) / 50000.0)) AS n FROM v) SELECT {VKS}, round(n, 6) AS n, round(n * 50000 + 1000, 4) AS back FROM c")
def _(spark, d):
    n = P.clip_normalise(F.col("v1"), 1000.0, 51000.0)
    return voxels(spark, d).select(*P.VK, F.round(n, 6).alias("n"), F.round(P.denormalise(n, 1000.0, 51000.0), 4).alias("back"))


@query("p18_fill_zero_with_min", f"WITH {V_SQL} SELECT {VKS}, round(CASE WHEN v2 = 0 THEN coalesce(min(CASE WHEN v2 > 0 THEN v2 END) OVER (PARTITION BY image_id), v2) ELSE v2 END, 6) AS v2 FROM v")
def _(spark, d):
    return rounded(P.fill_zero_with_min(voxels(spark, d), "v2", ["image_id"]).select(*P.VK, "v2"))


@query("p19_cut_outliers", f"WITH {V_SQL}, e AS (SELECT *, max(v2) OVER (PARTITION BY image_id) AS top, min(CASE WHEN v2 > 0 THEN v2 END) OVER (PARTITION BY image_id) AS low FROM v) SELECT {VKS}, round(CASE WHEN v1 / 400 > 1.2 * top THEN low ELSE v1 / 400 END, 6) AS v FROM e")
def _(spark, d):
    return rounded(P.cut_outliers(voxels(spark, d).withColumn("v", F.col("v1") / 400), "v", "v2", 1.2, ["image_id"]).select(*P.VK, "v"))


@query("p20_mask_multiply", f"WITH {V_SQL} SELECT {VKS}, v1 FROM v WHERE cls IN (2, 3)")
def _(spark, d):
    vox = voxels(spark, d)
    return P.mask_multiply(vox.select(*P.VK, "v1"), vox.where("cls in (2, 3)"))


@query("p21_labels_to_channels", f"WITH {V_SQL} SELECT {VKS}, channel::INT AS channel, CASE WHEN cls = channel THEN 255 ELSE 0 END AS value FROM v, (SELECT unnest([1, 2, 3]) AS channel)")
def _(spark, d):
    return P.labels_to_channels(voxels(spark, d), 3).select(*P.VK, "channel", "value")


@query("p22_channels_to_labels", f"WITH {V_SQL}, c AS (SELECT {VKS}, (cls = 1 OR z = 2)::INT AS c1, (cls = 2)::INT AS c2, (cls = 3 OR y = 4)::INT AS c3 FROM v) SELECT {VKS}, (c1 * (1 - c2) + 2 * c2 * (1 - c3) + 3 * c3)::INT AS cls FROM c")
def _(spark, d):
    vox = voxels(spark, d).withColumn("channel", F.explode(F.array(*map(F.lit, (1, 2, 3)))))
    on = (F.col("cls") == F.col("channel")) | (F.col("channel") == 1) & (F.col("z") == 2) | (F.col("channel") == 3) & (F.col("y") == 4)
    return P.channels_to_labels(vox.withColumn("value", F.when(on, 255).otherwise(0)), 3)


@query("p23_pad_volume", f"WITH {V_SQL} SELECT image_id, t, z + 2 AS z, y + 1 AS y, x + 1 AS x, v1, false AS mirrored FROM v UNION ALL SELECT image_id, t, z, y, x, v1, true FROM v UNION ALL SELECT image_id, t, 12 - z, y, x, v1, true FROM v WHERE 12 - z BETWEEN 7 AND 7")
def _(spark, d):
    vox = voxels(spark, d).select(*P.VK, "v1")
    return P.pad_volume(vox, (2, 1, 1)).withColumn("mirrored", F.lit(False)).unionByName(P.pad_reflect(vox, "z", 7, 8).withColumn("mirrored", F.lit(True)))


_PAD = ", ".join(f"max(max({c}) - min({c}) + 1) OVER (PARTITION BY image_id) - (max({c}) - min({c}) + 1) AS d{c}, min({c}) AS l{c}" for c in "zyx")


@query("p24_pad_to_common", f"WITH {OV_SQL}, b AS (SELECT image_id, label, {_PAD} FROM ov GROUP BY image_id, label) SELECT image_id, label, {', '.join(f'({c} - l{c} + ceil(d{c} / 2.0))::INT AS {c}' for c in 'zyx')}, v1 FROM ov JOIN b USING (image_id, label)")
def _(spark, d):
    return P.pad_to_common(object_voxels(spark, d), ["image_id"]).select("image_id", "label", "z", "y", "x", "v1")


@query("p25_dihedral_augment", f"WITH {P_SQL}, m(mode, a, b, c, d) AS (VALUES (0,1,0,0,1),(1,-1,0,0,1),(2,1,0,0,-1),(3,-1,0,0,-1),(4,0,1,1,0),(5,0,-1,1,0),(6,0,1,-1,0),(7,0,-1,-1,0)) SELECT image_id, mode, (a * y + b * x + CASE WHEN a + b < 0 THEN 7 ELSE 0 END)::INT AS y, (c * y + d * x + CASE WHEN c + d < 0 THEN 7 ELSE 0 END)::INT AS x, round(v, 6) AS v FROM p, m")
def _(spark, d):
    return rounded(P.dihedral_augment(patches(spark, d).select("image_id", "y", "x", "v"), 8))


@query("p26_reslice", f"WITH {V_SQL} SELECT image_id, t, 'xz' AS plane, y AS slice, z AS row, x AS col, v1 FROM v UNION ALL SELECT image_id, t, 'yz', x, z, y, v1 FROM v")
def _(spark, d):
    vox = voxels(spark, d).select(*P.VK, "v1")
    return P.reslice(vox, "xz").withColumn("plane", F.lit("xz")).unionByName(P.reslice(vox, "yz").withColumn("plane", F.lit("yz")))


@query("p27_fuse_views", f"WITH {V_SQL} SELECT {VKS}, trunc(a.v1 / 2 + b.v1 / 2)::INT AS v1 FROM (SELECT {VKS}, v1 FROM v) a JOIN (SELECT image_id, t, z, y, 19 - x AS x, v1 FROM v) b USING ({VKS})")
def _(spark, d):
    vox = voxels(spark, d).select(*P.VK, "v1")
    return P.fuse_views(vox, vox.withColumn("x", 19 - F.col("x")), "v1")


@query("p28_intensity_scale", f"WITH {V_SQL}, e AS (SELECT *, min(v1) OVER (PARTITION BY image_id) AS low, max(v1) OVER (PARTITION BY image_id) AS top FROM v) SELECT {VKS}, round(least(1.0, coalesce((v1 - low) / nullif(top - low, 0), 0) * 1.2), 6) AS v1 FROM e")
def _(spark, d):
    return rounded(P.intensity_scale(voxels(spark, d), "v1", 1.2, ["image_id"]).select(*P.VK, "v1"))


@query("p29_quality_gate", f"WITH {V_SQL} SELECT image_id, (max(z) + 1)::INT AS depth, max(z) + 1 < 8 AS shallow, (max(z) + 1) % 8 <> 0 AS ragged FROM v GROUP BY image_id")
def _(spark, d):
    return P.quality_gate(voxels(spark, d))


@query("p30_warp", f"WITH {V_SQL}, m AS (SELECT image_id, t, floor(z + 0.5)::INT AS nz, floor(0.5 * y + 0.25 * x + 1 + 0.5)::INT AS ny, floor(-0.25 * y + 0.5 * x + 3 + 0.5)::INT AS nx, z, y, x, cls, v1 FROM v) SELECT image_id, t, nz AS z, ny AS y, nx AS x, first(cls ORDER BY z DESC, y DESC, x DESC) AS cls, first(v1 ORDER BY z DESC, y DESC, x DESC) AS v1 FROM m GROUP BY image_id, t, nz, ny, nx")
def _(spark, d):
    return P.warp(voxels(spark, d).select(*P.VK, "cls", "v1"), [[1, 0, 0], [0, 0.5, 0.25], [0, -0.25, 0.5]], [0, 1, 3])


#: A turn of 30 degrees in y and x, and its inverse, as plain numbers.
_TURN = [[1.0, 0.0, 0.0], [0.0, math.cos(math.pi / 6), -math.sin(math.pi / 6)], [0.0, math.sin(math.pi / 6), math.cos(math.pi / 6)]]
_COS, _SIN = math.cos(math.pi / 6), math.sin(math.pi / 6)
_BACK = f"""im AS (SELECT DISTINCT image_id, t FROM v), q AS (SELECT image_id, t, z, y, x, round(z - 0.5, 9) AS pz, round({_COS!r}::DOUBLE * (y - 4.25) + {_SIN!r}::DOUBLE * (x + 2.0), 9) AS py, round({_COS!r}::DOUBLE * (x + 2.0) - {_SIN!r}::DOUBLE * (y - 4.25), 9) AS px
  FROM im, (SELECT unnest(range(9))::INT AS z), (SELECT unnest(range(24))::INT AS y), (SELECT unnest(range(26))::INT AS x))"""
_EIGHT = "(SELECT unnest([0, 1]) AS dz), (SELECT unnest([0, 1]) AS dy), (SELECT unnest([0, 1]) AS dx)"
_WEIGHT = " * ".join(f"(CASE d{c} WHEN 1 THEN p{c} - floor(p{c}) ELSE 1 - (p{c} - floor(p{c})) END)" for c in "zyx")


@query("p30_warp_linear", f"WITH {V_SQL}, {_BACK}, e AS (SELECT q.*, {_WEIGHT} AS w, (floor(pz) + dz)::INT AS sz, (floor(py) + dy)::INT AS sy, (floor(px) + dx)::INT AS sx FROM q, {_EIGHT}) SELECT e.image_id, e.t, e.z, e.y, e.x, round(sum(w * v.v1), 4) AS v1 FROM e JOIN v ON v.image_id = e.image_id AND v.t = e.t AND v.z = sz AND v.y = sy AND v.x = sx WHERE w > 0 GROUP BY ALL")
def _(spark, d):
    return rounded(warp_inverse(voxels(spark, d), "v1", _TURN, [0.5, 4.25, -2.0], (9, 24, 26), block=(4, 8, 8)), 4)


@query("p30_warp_labels", f"WITH {V_SQL}, {_BACK} SELECT q.image_id, q.t, q.z, q.y, q.x, v.cls::DOUBLE AS cls FROM q JOIN v ON v.image_id = q.image_id AND v.t = q.t AND v.z = floor(pz + 0.5) AND v.y = floor(py + 0.5) AND v.x = floor(px + 0.5)")
def _(spark, d):
    return warp_inverse(voxels(spark, d), "cls", _TURN, [0.5, 4.25, -2.0], (9, 24, 26), linear=False)


@query("f1_file_names", "SELECT c_custkey::BIGINT AS k, regexp_replace(c_name || '.tif', '\\.tif$', '') AS stem, ends_with(c_name || CASE c_custkey % 3 WHEN 0 THEN '.tif' WHEN 1 THEN '.czi' ELSE '.txt' END, '.tif') OR ends_with(c_name || CASE c_custkey % 3 WHEN 0 THEN '.tif' WHEN 1 THEN '.czi' ELSE '.txt' END, '.czi') AS is_image FROM customer")
def _(spark, d):
    c = table(spark, d, "customer")
    ending = F.when(F.col("c_custkey") % 3 == 0, ".tif").when(F.col("c_custkey") % 3 == 1, ".czi").otherwise(".txt")
    return c.select(F.col("c_custkey").cast("long").alias("k"), S.stem(F.concat("c_name", F.lit(".tif"))).alias("stem"), S.is_image(F.concat("c_name", ending)).alias("is_image"))


@query("f2_short_title", "SELECT p_partkey::BIGINT AS k, translate(substring(p_name || ' (1)-+.tif', 1, length(p_name || ' (1)-+.tif') - 4), '()-+ ', '_____') AS title FROM part")
def _(spark, d):
    return table(spark, d, "part").select(F.col("p_partkey").cast("long").alias("k"), S.short_title(F.concat("p_name", F.lit(" (1)-+.tif"))).alias("title"))


@query("f3_model_names", "SELECT p_partkey::BIGINT AS k, CASE WHEN ends_with(p_name, '_0000') THEN p_name ELSE p_name || '_0000' END AS model, printf('%s_patch%04d_0000.tif', p_name, (p_partkey % 1000)::INT) AS tile, substring(p_name || '_0000.tif', 1, length(p_name)) AS case_name FROM part")
def _(spark, d):
    n = F.col("p_name")
    return table(spark, d, "part").select(F.col("p_partkey").cast("long").alias("k"), S.model_name(n).alias("model"), S.tile_name(n, (F.col("p_partkey") % 1000).cast("int")).alias("tile"), S.case_name(F.concat(n, F.lit("_0000.tif"))).alias("case_name"))


@query("f4_dataset_id", "SELECT page_id::BIGINT AS page_id, nullif(regexp_extract(string_split(url, '/')[-1], '(\\d{3})', 1), '') AS dataset_id FROM pages")
def _(spark, d):
    return table(spark, d, "pages").select(F.col("page_id").cast("long").alias("page_id"), S.dataset_id(F.col("url")).alias("dataset_id"))


_NAME = "(CASE l_linenumber % 4 WHEN 0 THEN 'spine_C' WHEN 1 THEN 'head_C' WHEN 2 THEN 'neck_C' ELSE 'other_C' END || l_linenumber || CASE WHEN l_linenumber % 2 = 0 THEN '_mean_int' ELSE '_int_density' END)"


@query("f5_column_parts", f"WITH n AS (SELECT DISTINCT l_suppkey::BIGINT AS k, {_NAME} AS name FROM lineitem) SELECT k, name, nullif(regexp_extract(name, '^(spine|head|neck)_C(\\d+)_(mean_int|max_int|int_density)$', 1), '') AS region, try_cast(regexp_extract(name, '^(spine|head|neck)_C(\\d+)_(mean_int|max_int|int_density)$', 2) AS INT) AS channel, nullif(regexp_extract(name, '^(spine|head|neck)_C(\\d+)_(mean_int|max_int|int_density)$', 3), '') AS stat FROM n")
def _(spark, d):
    n = F.col("l_linenumber")
    name = F.concat(F.when(n % 4 == 0, "spine_C").when(n % 4 == 1, "head_C").when(n % 4 == 2, "neck_C").otherwise("other_C"), n, F.when(n % 2 == 0, "_mean_int").otherwise("_int_density"))
    rows = table(spark, d, "lineitem").select(F.col("l_suppkey").cast("long").alias("k"), name.alias("name")).distinct().withColumn("p", S.column_parts(F.col("name")))
    return rows.select("k", "name", "p.region", "p.channel", "p.stat")


@query("f6_progress", "SELECT l_orderkey::BIGINT AS k, l_linenumber::INT AS line, CASE WHEN l_linenumber = 1 THEN 'no progress' ELSE (l_quantity::INT) || '% [Time left: ' || '0' || l_linenumber || ':' || (10 + l_linenumber) || ']' END AS progress FROM lineitem")
def _(spark, d):
    n = F.col("l_linenumber")
    text = F.when(n == 1, "no progress").otherwise(F.concat(F.col("l_quantity").cast("int"), F.lit("%|### | 3/9 ["), F.lit(""), F.lit("")))
    text = F.when(n == 1, "no progress").otherwise(F.concat(F.col("l_quantity").cast("int"), F.lit("%|###| ["), F.lit("0"), n, F.lit(":"), n + 10, F.lit("<later]")))
    return table(spark, d, "lineitem").select(F.col("l_orderkey").cast("long").alias("k"), n.cast("int").alias("line"), S.progress(text).alias("progress"))


@query("f7_date_stamp", "SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY 1")
def _(spark, d):
    return table(spark, d, "events").groupBy(S.date_stamp(F.col("ts")).alias("day")).agg(F.count("*").alias("n"))


@query("f8_math", f"WITH {V_SQL} SELECT {VKS}, round(pow(least(1.0, greatest(0.0, v2 / 100)), 0.4), 6) AS gamma, round(sqrt(v1), 6) AS root, floor(v1 / 7)::BIGINT AS low, ceil(v1 / 7)::BIGINT AS high, round_even(v2 / 4, 0) AS even, sign(v2 - 40)::DOUBLE AS side, round(abs(v2 - 40), 6) AS gap FROM v")
def _(spark, d):
    a, b = F.col("v1"), F.col("v2")
    return voxels(spark, d).select(*P.VK, F.round(S.gamma(b, F.lit(100.0)), 6).alias("gamma"), F.round(F.sqrt(a), 6).alias("root"), F.floor(a / 7).alias("low"), F.ceil(a / 7).alias("high"), F.bround(b / 4, 0).alias("even"), F.signum(b - 40).alias("side"), F.round(F.abs(b - 40), 6).alias("gap"))


@query("f9_vectors", f"WITH {V_SQL} SELECT {VKS}, (y * 3 - x * 2) AS c0, (x * 1 - z * 3) AS c1, (z * 2 - y * 1) AS c2, (z * 1 + y * 2 + x * 3)::DOUBLE AS dot, round(sqrt(z * z + y * y + x * x), 6) AS norm FROM v")
def _(spark, d):
    a, b = [F.col(c) for c in "zyx"], [F.lit(k) for k in (1, 2, 3)]
    c = S.cross(a, b)
    return voxels(spark, d).select(*P.VK, *[c[i].alias(f"c{i}") for i in range(3)], S.dot(a, b).alias("dot"), F.round(S.norm(a), 6).alias("norm"))


@query("f10_safe_divide", f"WITH {O_SQL} SELECT label, line, round(area / nullif(disc, 0), 6) AS ratio, coalesce(round(tax / nullif(disc, 0), 6), 0) AS filled FROM o")
def _(spark, d):
    return objects(spark, d).select("label", "line", F.round(S.safe_divide(F.col("area"), F.col("disc")), 6).alias("ratio"), F.coalesce(F.round(S.safe_divide(F.col("tax"), F.col("disc")), 6), F.lit(0.0)).alias("filled"))


@query("f11_arrays", "SELECT vec_id::BIGINT AS vec_id, (list_position(embedding, list_max(embedding)) - 1)::INT AS top, (list_position(embedding, list_min(embedding)) - 1)::INT AS low, ((vec_id % 64) // 16)::INT AS z, ((vec_id % 64) // 4 % 4)::INT AS y, (vec_id % 4)::INT AS x, round(embedding[1]::DOUBLE + embedding[2]::DOUBLE, 6) AS added FROM embeddings")
def _(spark, d):
    e = F.col("embedding")
    z, y, x = S.unravel(F.col("vec_id") % 64, (4, 4, 4))
    added = F.zip_with(F.slice(e, 1, 1), F.slice(e, 2, 1), lambda p, q: p.cast("double") + q.cast("double"))[0]
    return table(spark, d, "embeddings").select(F.col("vec_id").cast("long").alias("vec_id"), S.argmax(e).alias("top"), S.argmin(e).alias("low"), z.alias("z"), y.alias("y"), x.alias("x"), F.round(added, 6).alias("added"))


@query("f12_map_json", "SELECT p_partkey::BIGINT AS k, CASE p_partkey % 3 WHEN 0 THEN 'spine' WHEN 1 THEN 'dendrite' END AS region, (p_partkey % 7)::INT AS nz, p_name AS base FROM part")
def _(spark, d):
    rows = table(spark, d, "part").select(F.col("p_partkey").cast("long").alias("k"), S.lookup([0, 1], ["spine", "dendrite"], (F.col("p_partkey") % 3).cast("int")).alias("region"), F.to_json(F.struct(F.col("p_name").alias("base"), (F.col("p_partkey") % 7).alias("nz"))).alias("map"))
    return rows.select("k", "region", F.from_json("map", "base string, nz int").alias("m")).select("k", "region", "m.nz", "m.base")


@query("f13_cast_labels", "SELECT c_custkey::BIGINT AS k, try_cast(CASE WHEN c_custkey % 5 = 0 THEN c_name ELSE c_custkey::VARCHAR END AS BIGINT) AS label FROM customer")
def _(spark, d):
    text = F.when(F.col("c_custkey") % 5 == 0, F.col("c_name")).otherwise(F.col("c_custkey").cast("string"))
    return table(spark, d, "customer").select(F.col("c_custkey").cast("long").alias("k"), S.as_label(text).alias("label"))
