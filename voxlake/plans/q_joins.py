"""Registered queries: spatial joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxlake.operators import joins as J
from voxlake.operators.projections import VK
from voxlake.plans.register import query, rounded
from voxlake.sources.fixtures import OV_SQL, T_SQL, V_SQL, object_voxels, voxels

VKS = "image_id, t, z, y, x"
OK = "image_id, t, label"
ON = " AND ".join(f"a.{c} = b.{c}" for c in VK)
SHAPE = (7, 10, 20)


@query("j3_sample_field", f"WITH {OV_SQL} SELECT {VKS}, ov.label, v.v2 AS field FROM ov JOIN v USING ({VKS})")
def _(spark, d):
    field = voxels(spark, d).withColumnRenamed("v2", "field")
    return J.sample_field(object_voxels(spark, d).select(*VK, "label"), field, "field")


@query("j5_merge_areas", f"WITH {OV_SQL}, a AS (SELECT image_id, label, count(DISTINCT (y, x)) AS mip FROM ov WHERE cls_pred = 1 GROUP BY ALL) SELECT DISTINCT image_id, label, mip FROM ov LEFT JOIN a USING (image_id, label)")
def _(spark, d):
    vox = object_voxels(spark, d)
    areas = vox.where("cls_pred = 1").groupBy("image_id", "label").agg(F.countDistinct("y", "x").alias("mip"))
    return J.merge_areas(vox.select("image_id", "label").distinct(), areas, ["image_id", "label"])


_CENTRE = f"c AS (SELECT image_id, label, round(avg(z), 4) AS z, round(avg(y), 4) AS y, round(avg(x), 4) AS x FROM ov GROUP BY ALL)"
_NEAREST = """SELECT c.image_id, c.label, round(sqrt((c.z - k.z) ** 2 + (c.y - k.y) ** 2 + (c.x - k.x) ** 2), 6) AS distance, {pick} FROM c JOIN k USING (image_id) {where}
  QUALIFY row_number() OVER (PARTITION BY c.image_id, c.label ORDER BY round(sqrt((c.z - k.z) ** 2 + (c.y - k.y) ** 2 + (c.x - k.x) ** 2), 9), k.z, k.y, k.x) = 1"""


def _centres(spark, d):
    return object_voxels(spark, d).groupBy("image_id", "label").agg(*[F.round(F.avg(c), 4).alias(c) for c in "zyx"])


@query("j6_nearest_point", f"WITH {OV_SQL}, {_CENTRE}, k AS (SELECT *, (y // 5 + 1)::BIGINT AS dendrite_id FROM v WHERE cls >= 2 AND x % 4 = 0) " + _NEAREST.format(pick="dendrite_id", where="WHERE (c.z - k.z) ** 2 + (c.y - k.y) ** 2 + (c.x - k.x) ** 2 <= 9"))
def _(spark, d):
    skeleton = voxels(spark, d).where("cls >= 2 and x % 4 = 0").withColumn("dendrite_id", (F.floor(F.col("y") / 5) + 1).cast("long"))
    return rounded(J.nearest_point(_centres(spark, d), skeleton, ["label"], ["dendrite_id"], cell=2.0, max_dist=3.0).where("distance is not null").select("image_id", "label", "distance", "dendrite_id"))


_DIST = "(SELECT min((a.z - b.z) ** 2 + (a.y - b.y) ** 2 + (a.x - b.x) ** 2) FROM v b WHERE b.image_id = a.image_id AND b.cls >= 2)"


@query("j7_distance_to", f"WITH {V_SQL}, q AS (SELECT {VKS}, {_DIST} AS d2 FROM v a WHERE cls = 1) SELECT {VKS}, CASE WHEN d2 <= 16 THEN round(sqrt(d2), 6) END AS distance FROM q")
def _(spark, d):
    vox = voxels(spark, d)
    return rounded(J.distance_to(vox.where("cls = 1").select(*VK), vox.where("cls >= 2"), 4))


@query("j7_distance_to_any", f"WITH {V_SQL}, q AS (SELECT {VKS}, {_DIST} AS d2 FROM v a WHERE cls = 1) SELECT {VKS}, round(sqrt(d2), 6) AS distance FROM q")
def _(spark, d):
    vox = voxels(spark, d)
    return rounded(J.distance_to(vox.where("cls = 1").select(*VK), vox.where("cls >= 2")))


#: Volumes of the images of one supplier's thousand side by side: wider than a tile of lines.
_WIDE = "w AS (SELECT image_id // 100 AS image_id, t, z, y, x + 20 * (image_id % 100) AS x, cls FROM v)"


@query("j7_distance_wide", f"WITH {V_SQL}, {_WIDE}, s AS (SELECT * FROM w WHERE cls = 2 AND x % 200 = 7), q AS (SELECT a.image_id, a.t, a.z, a.y, a.x, min((a.z - s.z) ** 2 * 9 + (a.y - s.y) ** 2 + (a.x - s.x) ** 2) AS d2 FROM w a LEFT JOIN s ON s.image_id = a.image_id WHERE a.cls = 1 GROUP BY ALL) SELECT {VKS}, round(sqrt(d2), 6) AS distance FROM q")
def _(spark, d):
    vox = voxels(spark, d)
    wide = vox.select(F.floor(F.col("image_id") / 100).alias("image_id"), "t", "z", "y", (F.col("x") + 20 * (F.col("image_id") % 100)).cast("int").alias("x"), "cls")
    return rounded(J.distance_to(wide.where("cls = 1").select(*VK), wide.where("cls = 2 and x % 200 = 7"), sampling=(3.0, 1.0, 1.0)))


def _coarse_sql(shape: tuple[int, int, int], small: tuple[int, int, int], scale: float) -> str:
    """J8 by its formula: nearest voxel of each coarse cell, then eight weighted corners of each voxel."""
    nearest = " AND ".join(f"v.{c} = least({n - 1}, greatest(0, floor((s.{c} + 0.5) * {n} / {m}::DOUBLE)::INT))" for c, n, m in zip("zyx", shape, small, strict=True))
    cells = ", ".join(f"(SELECT unnest(range({m}))::INT AS {c})" for c, m in zip("zyx", small, strict=True))
    axis = " ".join(f", c{c} AS (SELECT i AS {c}, least({m - 1}, greatest(0, floor(a)::INT + k)) AS s{c}, CASE k WHEN 0 THEN 1 - (a - floor(a)) ELSE a - floor(a) END AS w{c} FROM (SELECT i, (i + 0.5) * {m} / {n}::DOUBLE - 0.5 AS a FROM (SELECT unnest(range({n}))::INT AS i)), (SELECT unnest([0, 1]) AS k))" for c, n, m in zip("zyx", shape, small, strict=True))
    return f"""g AS (SELECT * FROM {cells}), aim AS (SELECT DISTINCT v.image_id, s.z, s.y, s.x FROM g s JOIN v ON {nearest} WHERE cls >= 2),
      dist AS (SELECT i.image_id, g.z, g.y, g.x, sqrt(min((g.z - aim.z) ** 2 + (g.y - aim.y) ** 2 + (g.x - aim.x) ** 2)) AS d FROM (SELECT DISTINCT image_id FROM v) i, g JOIN aim ON aim.image_id = i.image_id GROUP BY ALL){axis}
      SELECT v.image_id, v.t, v.z, v.y, v.x, round_even(round(sum(wz * wy * wx * d) * {scale}, 9), 0) AS distance FROM v JOIN cz USING (z) JOIN cy USING (y) JOIN cx USING (x) LEFT JOIN dist ON dist.image_id = v.image_id AND dist.z = sz AND dist.y = sy AND dist.x = sx WHERE cls = 1 GROUP BY ALL"""


@query("j8_distance_coarse", f"WITH {V_SQL}, {_coarse_sql(SHAPE, (2, 3, 6), 3.0)}")
def _(spark, d):
    vox = voxels(spark, d)
    return J.distance_coarse(vox.where("cls = 1").select(*VK), vox.where("cls >= 2"), SHAPE, 700)


@query("j9_contact_point", f"WITH {OV_SQL}, q AS (SELECT {VKS}, label, {_DIST} AS d2 FROM ov a) SELECT {VKS}, label, round(sqrt(d2), 6) AS distance FROM q WHERE d2 <= 16 QUALIFY row_number() OVER (PARTITION BY image_id, label ORDER BY d2, z, y, x) = 1")
def _(spark, d):
    return rounded(J.contact_point(object_voxels(spark, d).select(*VK, "label"), voxels(spark, d).where("cls >= 2"), 4))


@query("j10_neighbours", f"WITH {V_SQL}, s AS (SELECT * FROM v WHERE cls = 1) SELECT a.image_id, a.t, a.z, a.y, a.x, b.t AS nt, b.z AS nz, b.y AS ny, b.x AS nx FROM s a JOIN s b ON a.image_id = b.image_id AND abs(a.z - b.z) <= 1 AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1 AND (a.z, a.y, a.x) <> (b.z, b.y, b.x)")
def _(spark, d):
    return J.neighbours(voxels(spark, d).where("cls = 1").select(*VK), 26).select(*VK, "nt", "nz", "ny", "nx")


_CLIP = ", ".join(f"greatest(min({c}) - 1, 0) AS {c}0, least(max({c}) + 1, {n - 1}) AS {c}1" for c, n in zip("zyx", SHAPE, strict=True))


@query("j11_crop_bbox", f"WITH {OV_SQL}, b AS (SELECT image_id, label, {_CLIP} FROM ov GROUP BY ALL) SELECT {VKS}, label, v1, {', '.join(f'{c} - {c}0 AS d{c}' for c in 'zyx')} FROM v JOIN b USING (image_id) WHERE z BETWEEN z0 AND z1 AND y BETWEEN y0 AND y1 AND x BETWEEN x0 AND x1")
def _(spark, d):
    return J.crop_bbox(object_voxels(spark, d), voxels(spark, d).select(*VK, "v1"), 1, SHAPE, 4)


@query("j12_crop_roi", f"WITH {OV_SQL}, c AS (SELECT image_id, label AS roi, floor(avg(z))::INT AS cz, floor(avg(y))::INT AS cy, floor(avg(x))::INT AS cx FROM ov GROUP BY ALL) SELECT {VKS}, roi, v1, z - cz + 1 AS dz, y - cy + 2 AS dy, x - cx + 2 AS dx FROM v JOIN c USING (image_id) WHERE abs(z - cz) <= 1 AND abs(y - cy) <= 2 AND abs(x - cx) <= 2")
def _(spark, d):
    c = object_voxels(spark, d).groupBy("image_id", "t", "label").agg(*[F.floor(F.avg(k)).cast("int").alias(k) for k in "zyx"])
    return J.crop_roi(c, voxels(spark, d).select(*VK, "v1"), (1, 2, 2), 4)


@query("j13_overlay", f"WITH {OV_SQL}, p AS (SELECT {VKS}, label FROM ov WHERE cls_pred = 1) SELECT {VKS}, label FROM ov WHERE (image_id, label) NOT IN (SELECT (image_id, label) FROM p) UNION ALL SELECT {VKS}, label FROM p")
def _(spark, d):
    base = object_voxels(spark, d)
    return J.overlay(base.select(*VK, "label"), base.where("cls_pred = 1"))


@query("j14_drop_border_objects", f"WITH {OV_SQL} SELECT {VKS}, label FROM ov WHERE (image_id, label) NOT IN (SELECT (image_id, label) FROM ov WHERE y IN (0, 9) OR x IN (0, 19))")
def _(spark, d):
    return J.drop_border_objects(object_voxels(spark, d).select(*VK, "label"), SHAPE)


@query("j16_assign_blocks", f"""WITH {V_SQL}, b AS (SELECT {VKS}, unnest(range((z - 1 + 4) // 4 - 1, (z + 1) // 4 + 1)) AS bz FROM v), c AS (SELECT *, unnest(range((y - 1 + 5) // 5 - 1, (y + 1) // 5 + 1)) AS "by" FROM b), e AS (SELECT *, unnest(range((x - 1 + 8) // 8 - 1, (x + 1) // 8 + 1)) AS bx FROM c) SELECT {VKS}, bz::BIGINT AS bz, "by"::BIGINT AS "by", bx::BIGINT AS bx, bz = z // 4 AND "by" = y // 5 AND bx = x // 8 AS core FROM e WHERE bz >= 0 AND "by" >= 0 AND bx >= 0""")
def _(spark, d):
    return J.assign_blocks(voxels(spark, d).select(*VK), (4, 5, 8), 1)


@query("j17_parent_at", f"WITH {OV_SQL}, c AS (SELECT image_id, label, first(z ORDER BY z, y, x)::DOUBLE AS z, first(y ORDER BY z, y, x)::DOUBLE AS y, first(x ORDER BY z, y, x)::DOUBLE AS x FROM ov GROUP BY ALL), k AS (SELECT *, (y // 5 + 1)::BIGINT AS parent FROM v WHERE cls >= 2) " + _NEAREST.format(pick="parent", where=""))
def _(spark, d):
    first = object_voxels(spark, d).groupBy("image_id", "label").agg(F.min(F.struct("z", "y", "x")).alias("p")).select("image_id", "label", "p.*")
    parents = voxels(spark, d).where("cls >= 2").withColumn("parent", (F.floor(F.col("y") / 5) + 1).cast("long"))
    return rounded(J.parent_at(first, parents, ["label"], "parent").where("distance is not null").select("image_id", "label", "distance", "parent"))
