"""Registered queries: object tables, windows, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxlake.operators import joins as J
from voxlake.operators import windows as W
from voxlake.operators.projections import VK
from voxlake.plans.register import query, rounded
from voxlake.sources.fixtures import O_SQL, OV_SQL, P_SQL, T_SQL, V_SQL, object_voxels, objects, patches, table, tracks, voxels

VKS = "image_id, t, z, y, x"


@query("j1_merge_measurements", f"WITH {O_SQL}, a AS (SELECT label, sum(area) AS area, round(sum(price), 4) AS price FROM o WHERE tax > 0.04 GROUP BY label), b AS (SELECT o_orderkey::BIGINT AS label, o_totalprice::DOUBLE AS price, o_custkey::DOUBLE AS cust FROM orders WHERE o_orderstatus = 'F') SELECT coalesce(a.label, b.label) AS label, coalesce(area, 0) AS area, coalesce(a.price, b.price, 0) AS price, coalesce(cust, 0) AS cust FROM a FULL JOIN b ON a.label = b.label")
def _(spark, d):
    a = objects(spark, d).where("tax > 0.04").groupBy("label").agg(F.sum("area").alias("area"), F.round(F.sum("price"), 4).alias("price"))
    b = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").cast("long").alias("label"), F.col("o_totalprice").cast("double").alias("price"), F.col("o_custkey").cast("double").alias("cust"))
    return J.merge_measurements(a, b, ["label"])


@query("j2_attach_columns", f"WITH {O_SQL} SELECT label, line, area, o_totalprice::DOUBLE AS total FROM o LEFT JOIN orders ON o_orderkey = label AND o_orderstatus = 'F'")
def _(spark, d):
    b = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").cast("long").alias("label"), F.col("o_totalprice").cast("double").alias("total"))
    return J.attach_columns(objects(spark, d).select("label", "line", "area"), b, ["label"])


@query("j4_map_lookup", f"WITH {O_SQL} SELECT label, line, s_acctbal::DOUBLE AS length FROM o LEFT JOIN supplier ON s_suppkey = image_id AND s_acctbal > 0")
def _(spark, d):
    lengths = table(spark, d, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").cast("long").alias("image_id"), F.col("s_acctbal").cast("double").alias("length"))
    return J.map_lookup(objects(spark, d), lengths, "image_id").select("label", "line", "length")


@query("w1_sample_every", f"WITH {V_SQL} SELECT {VKS} FROM v QUALIFY (row_number() OVER (PARTITION BY image_id ORDER BY z, y, x) - 1) % 4 = 0")
def _(spark, d):
    return W.sample_every(voxels(spark, d).select(*VK), 4, ["image_id"])


@query("w2_sample_grid", f"WITH {V_SQL} SELECT {VKS} FROM v QUALIFY row_number() OVER (PARTITION BY image_id, z // 2, y // 2, x // 2 ORDER BY z, y, x) = 1")
def _(spark, d):
    return W.sample_grid(voxels(spark, d).select(*VK), 2, ["image_id"]).select(*VK)


@query("w3_polyline_length", f"WITH {OV_SQL}, s AS (SELECT image_id, t, label, sqrt((z - lag(z) OVER w) ** 2 + ((y - lag(y) OVER w) * 0.102) ** 2 + ((x - lag(x) OVER w) * 0.102) ** 2) AS step FROM ov WINDOW w AS (PARTITION BY image_id, t, label ORDER BY z, y, x)) SELECT image_id, t, label, round(coalesce(sum(step), 0), 6) AS length FROM s GROUP BY ALL")
def _(spark, d):
    return rounded(W.polyline_length(object_voxels(spark, d), ["image_id", "t", "label"], ["z", "y", "x"], (1.0, 0.102, 0.102)))


_D = ", ".join(f"coalesce(lead({c}) OVER w - {c}, {c} - lag({c}) OVER w, 0) AS d{c}" for c in "zyx")


@query("w4_tangents", f"WITH {OV_SQL}, s AS (SELECT *, {_D} FROM ov WINDOW w AS (PARTITION BY image_id, t, label ORDER BY z, y, x)) SELECT {VKS}, label, {', '.join(f'coalesce(round(d{c} / nullif(sqrt(dz * dz + dy * dy + dx * dx), 0), 6), 0) AS t{c}' for c in 'zyx')} FROM s")
def _(spark, d):
    return rounded(W.tangents(object_voxels(spark, d), ["image_id", "t", "label"], ["z", "y", "x"]).select(*VK, "label", "tz", "ty", "tx"))


_W5 = "WITH {T}, i AS (SELECT DISTINCT spine_id, timepoint FROM tr), f AS (SELECT DISTINCT timepoint FROM i), b AS (SELECT timepoint, {base} AS base FROM f) SELECT timepoint, (SELECT count(*) FROM i WHERE i.timepoint = b.timepoint AND spine_id NOT IN (SELECT spine_id FROM i k WHERE k.timepoint = b.base)) AS new, (SELECT count(*) FROM i k WHERE k.timepoint = b.base AND spine_id NOT IN (SELECT spine_id FROM i WHERE i.timepoint = b.timepoint)) AS pruned FROM b"


@query("w5_gained_lost", _W5.format(T=T_SQL, base="(SELECT min(timepoint) FROM f)"))
def _(spark, d):
    return W.gained_lost(tracks(spark, d))


@query("w5_gained_lost_previous", _W5.format(T=T_SQL, base="coalesce(lag(timepoint) OVER (ORDER BY timepoint), timepoint)"))
def _(spark, d):
    return W.gained_lost(tracks(spark, d), "previous")


@query("w6_chain_shift", f"WITH {T_SQL}, c AS (SELECT (spine_id % 10) AS image_id, timepoint AS t, round(avg(z), 6) AS cz, round(avg(y), 6) AS cy, round(avg(x), 6) AS cx FROM tr GROUP BY ALL) SELECT image_id, t, cz, cy, cx, {', '.join(f'round(first(c{c}) OVER w - c{c}, 6) AS shift_{c}' for c in 'zyx')} FROM c WINDOW w AS (PARTITION BY image_id ORDER BY t)")
def _(spark, d):
    c = tracks(spark, d).groupBy((F.col("spine_id") % 10).alias("image_id"), F.col("timepoint").alias("t")).agg(*[F.round(F.avg(k), 6).alias(f"c{k}") for k in "zyx"])
    return rounded(W.chain_shift(c))


_W6 = f"""{V_SQL}, f AS (SELECT image_id // 5 AS image_id, (image_id % 5)::INT AS t, z, y, x, v1 FROM v WHERE cls = 1), m AS (SELECT image_id, t, z, y, x, v1 - avg(v1) OVER (PARTITION BY image_id, t) AS v FROM f),
  c AS (SELECT b.image_id, b.t, a.z - b.z AS sz, a.y - b.y AS sy, a.x - b.x AS sx, round(sum(a.v * b.v), 2) AS score FROM m a JOIN m b ON a.image_id = b.image_id AND b.t = a.t + 1 AND abs(a.z - b.z) <= 1 AND abs(a.y - b.y) <= 2 AND abs(a.x - b.x) <= 2 GROUP BY ALL),
  s AS (SELECT image_id, t, sz, sy, sx FROM c QUALIFY row_number() OVER (PARTITION BY image_id, t ORDER BY score DESC, sz * sz + sy * sy + sx * sx, sz, sy, sx) = 1)"""


@query("w6_chain_shift_by_content", f"WITH {_W6} SELECT image_id, t, {', '.join(f'(sum(coalesce(s{c}, 0)) OVER w)::BIGINT AS shift_{c}' for c in 'zyx')} FROM (SELECT DISTINCT image_id, t FROM f) LEFT JOIN s USING (image_id, t) WINDOW w AS (PARTITION BY image_id ORDER BY t)")
def _(spark, d):
    vox = voxels(spark, d).where("cls = 1")
    frames = vox.select(F.floor(F.col("image_id") / 5).alias("image_id"), (F.col("image_id") % 5).cast("int").alias("t"), "z", "y", "x", "v1")
    return W.chain_shift_by_content(frames, "v1", (1, 2, 2))


# the spline's own definition: one unknown second derivative a point, eliminated downwards and put in upwards, an axis at a time
_W8 = f"""{OV_SQL}, p AS (SELECT image_id, t, label, z::DOUBLE AS z, y::DOUBLE AS y, x::DOUBLE AS x, row_number() OVER g - 1 AS i, count(*) OVER (PARTITION BY image_id, t, label) AS m,
    sqrt((lead(z) OVER g - z) ** 2 + (lead(y) OVER g - y) ** 2 + (lead(x) OVER g - x) ** 2) AS h FROM ov WINDOW g AS (PARTITION BY image_id, t, label ORDER BY z, y, x)),
  q AS (SELECT *, coalesce(sum(h) OVER (PARTITION BY image_id, t, label ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS u FROM p),
  a AS (SELECT dense_rank() OVER (ORDER BY image_id, t, label) * 3 + axis AS o, image_id, t, label, axis, i, m, h, u, CASE axis WHEN 0 THEN z WHEN 1 THEN y ELSE x END AS v FROM q, (VALUES (0), (1), (2)) k(axis)),
  b AS (SELECT *, (lead(v) OVER w - v) / h AS d, lag(h) OVER w AS g FROM a WHERE m >= 4 WINDOW w AS (PARTITION BY o ORDER BY i)),
  c AS (SELECT o, i, m, g - CASE WHEN i = m - 2 THEN h * h / g ELSE 0 END AS low, 2 * (g + h) + CASE WHEN i = 1 THEN g * (g + h) / h ELSE 0 END + CASE WHEN i = m - 2 THEN h * (h + g) / g ELSE 0 END AS mid,
    h - CASE WHEN i = 1 THEN g * g / h ELSE 0 END AS high, 6 * (d - lag(d) OVER (PARTITION BY o ORDER BY i)) AS r FROM b QUALIFY i BETWEEN 1 AND m - 2),
  down AS (SELECT o, i, m, mid, high, r FROM c WHERE i = 1 UNION ALL
    SELECT c.o, c.i, c.m, c.mid - c.low / down.mid * down.high, c.high, c.r - c.low / down.mid * down.r FROM down JOIN c ON c.o = down.o AND c.i = down.i + 1),
  up AS (SELECT o, i, r / mid AS s FROM down WHERE i = m - 2 UNION ALL SELECT d.o, d.i, (d.r - d.high * up.s) / d.mid FROM up JOIN down d ON d.o = up.o AND d.i = up.i - 1),
  e AS (SELECT b.*, up.s FROM b LEFT JOIN up USING (o, i)),
  f AS (SELECT * REPLACE (CASE WHEN i = 0 THEN lead(s) OVER w - h * (lead(s, 2) OVER w - lead(s) OVER w) / lead(h) OVER w
      WHEN i = m - 1 THEN lag(s) OVER w + g * (lag(s) OVER w - lag(s, 2) OVER w) / lag(g) OVER w ELSE s END AS s) FROM e WINDOW w AS (PARTITION BY o ORDER BY i)),
  j AS (SELECT *, lead(v) OVER w AS v1, lead(s) OVER w AS s1, lead(u) OVER w AS u1, max(u) OVER (PARTITION BY o) / 49 AS part FROM f WINDOW w AS (PARTITION BY o ORDER BY i)),
  k AS (SELECT *, (u1 - step * part) / h AS a, (step * part - u) / h AS b FROM j, range(50) n(step) WHERE i < m - 1 AND (step * part >= u OR i = 0) AND (step * part < u1 OR i = m - 2)),
  l AS (SELECT image_id, t, label, step, axis, a * v + b * v1 + ((a ** 3 - a) * s + (b ** 3 - b) * s1) * h * h / 6 AS v FROM k UNION ALL SELECT image_id, t, label, i, axis, v FROM a WHERE m < 4)"""


@query("w8_resample_polyline", f"WITH RECURSIVE {_W8} SELECT image_id, t, label, step::INT AS step, {', '.join(f'round(max(v) FILTER (axis = {k}), 6) + 0.0 AS {c}' for k, c in enumerate('zyx'))} FROM l GROUP BY ALL")
def _(spark, d):
    return rounded(W.resample_polyline(object_voxels(spark, d), ["image_id", "t", "label"], ["z", "y", "x"]))


@query("w7_raster_label_order", f"WITH {OV_SQL}, f AS (SELECT image_id, label, min(z * 10000 + y * 100 + x) AS k FROM ov GROUP BY ALL), n AS (SELECT image_id, label, row_number() OVER (PARTITION BY image_id ORDER BY k) AS new FROM f) SELECT {VKS}, new AS label FROM ov JOIN n USING (image_id, label)")
def _(spark, d):
    return W.raster_label_order(object_voxels(spark, d)).select(*VK, "label")


@query("w8_smooth_polyline", f"WITH {OV_SQL} SELECT image_id, label, v1, {', '.join(f'round(avg({c}) OVER w, 6) AS {c}' for c in 'zyx')} FROM ov WINDOW w AS (PARTITION BY image_id, t, label ORDER BY z, y, x ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)")
def _(spark, d):
    return rounded(W.smooth_polyline(object_voxels(spark, d), ["image_id", "t", "label"], ["z", "y", "x"]).select("image_id", "label", "v1", "z", "y", "x"))


@query("k1_sort_labels", f"WITH {O_SQL} SELECT label::VARCHAR AS label, line FROM o ORDER BY o.label, line")
def _(spark, d):
    return objects(spark, d).select(F.col("label").cast("string").alias("label"), "line").orderBy(F.col("label").try_cast("long"), "line")


@query("k2_sorted_files", "SELECT page_id::BIGINT AS page_id, url FROM pages ORDER BY url, page_id")
def _(spark, d):
    return W.sorted_files(table(spark, d, "pages").select(F.col("page_id").cast("long").alias("page_id"), "url"), "url")


@query("k3_best_candidate", f"WITH {OV_SQL} SELECT {VKS}, label, v1 FROM ov QUALIFY row_number() OVER (PARTITION BY image_id, label ORDER BY v1, z, y, x) <= 2")
def _(spark, d):
    return W.best_candidate(object_voxels(spark, d).select(*VK, "label", "v1"), ["image_id", "label"], [F.col(c) for c in ("v1", "z", "y", "x")], 2)


@query("k4_every_nth_slice", f"WITH {V_SQL} SELECT {VKS}, v1 FROM v WHERE z % 3 = 0")
def _(spark, d):
    return W.every_nth_slice(voxels(spark, d).select(*VK, "v1"), 3)


@query("k5_random_sample", f"WITH {V_SQL} SELECT {VKS} FROM v QUALIFY row_number() OVER (PARTITION BY image_id ORDER BY md5(image_id || '/' || z || '/' || y || '/' || x), image_id, z, y, x) <= greatest(1, floor(count(*) OVER (PARTITION BY image_id) * 0.25))")
def _(spark, d):
    return W.random_sample(voxels(spark, d).select(*VK), 0.25, ["image_id"], ["image_id", "z", "y", "x"])


@query("k6_split", "SELECT vec_id::BIGINT AS image_id, CASE WHEN ('0x' || substr(md5(vec_id::VARCHAR), 1, 8))::BIGINT % 100 < 90 THEN 'train' ELSE 'validation' END AS part FROM embeddings")
def _(spark, d):
    return W.split(table(spark, d, "embeddings").select(F.col("vec_id").cast("long").alias("image_id")), 0.9, ["image_id"])


@query("u1_append_summaries", f"WITH {O_SQL} SELECT label, line, area, NULL::DOUBLE AS price FROM o UNION ALL SELECT o_orderkey::BIGINT, NULL, NULL, o_totalprice::DOUBLE FROM orders")
def _(spark, d):
    totals = table(spark, d, "orders").select(F.col("o_orderkey").cast("long").alias("label"), F.col("o_totalprice").cast("double").alias("price"))
    return W.append([objects(spark, d).select("label", "line", "area"), totals])


@query("u2_mask_algebra", f"WITH {V_SQL} SELECT {VKS}, op FROM v, (SELECT unnest(['union', 'intersect', 'subtract', 'xor']) AS op) WHERE CASE op WHEN 'union' THEN cls = 1 OR cls_pred = 1 WHEN 'intersect' THEN cls = 1 AND cls_pred = 1 WHEN 'subtract' THEN cls = 1 AND cls_pred <> 1 ELSE (cls = 1) <> (cls_pred = 1) END")
def _(spark, d):
    vox = voxels(spark, d)
    a, b = vox.where("cls = 1"), vox.where("cls_pred = 1")
    return W.append([f(a, b).withColumn("op", F.lit(n)) for n, f in (("union", W.mask_union), ("intersect", W.mask_intersect), ("subtract", W.mask_subtract), ("xor", W.mask_xor))])


@query("u3_id_difference", f"WITH {T_SQL} SELECT spine_id FROM tr WHERE timepoint = 1 EXCEPT SELECT spine_id FROM tr WHERE timepoint = 2")
def _(spark, d):
    t = tracks(spark, d)
    return W.id_difference(t.where("timepoint = 1"), t.where("timepoint = 2"), "spine_id")


@query("u4_stack_time", f"WITH {T_SQL} SELECT (dense_rank() OVER (ORDER BY timepoint) - 1)::INT AS t, spine_id, z, y, x FROM tr")
def _(spark, d):
    return W.stack_time(tracks(spark, d).select("timepoint", "spine_id", "z", "y", "x"), "timepoint")


@query("u4_stack_frames", f"WITH {T_SQL} SELECT (timepoint - 1)::INT AS t, spine_id, z, y, x FROM tr WHERE timepoint <= 3")
def _(spark, d):
    t = tracks(spark, d)
    return W.stack_time([t.where(F.col("timepoint") == i).select("spine_id", "z", "y", "x") for i in (1, 2, 3)])


@query("j15_link_nearest", f"WITH {T_SQL}, p AS (SELECT a.timepoint, a.spine_id AS source, b.spine_id AS target, sqrt((a.z - b.z) ** 2 + (a.y - b.y) ** 2 + (a.x - b.x) ** 2) AS distance, b.z, b.y, b.x FROM tr a JOIN tr b ON b.timepoint = a.timepoint + 1) SELECT timepoint::BIGINT AS timepoint, source, target, round(distance, 6) AS distance FROM p QUALIFY row_number() OVER (PARTITION BY timepoint, source ORDER BY round(distance, 9), z, y, x, target) = 1")
def _(spark, d):
    return rounded(J.link_nearest(tracks(spark, d)).where("distance is not null").select("timepoint", "source", "target", "distance"))


@query("j18_roi_time_montage", f"WITH {T_SQL}, g AS (SELECT spine_id, timepoint FROM (SELECT DISTINCT spine_id FROM tr), (SELECT DISTINCT timepoint FROM tr)) SELECT g.spine_id, g.timepoint, round(spine_vol, 4) AS spine_vol, (g.timepoint * 16)::INT AS x_offset FROM g LEFT JOIN tr USING (spine_id, timepoint)")
def _(spark, d):
    t = tracks(spark, d)
    return rounded(J.roi_time_montage(t, t.select("timepoint").distinct(), 16).select("spine_id", "timepoint", "spine_vol", "x_offset"), 4)
