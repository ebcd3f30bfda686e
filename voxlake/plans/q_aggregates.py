"""Registered queries: aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxlake.operators import aggregates as A
from voxlake.operators import filters as L
from voxlake.operators.projections import VK
from voxlake.plans.register import query, rounded
from voxlake.sources.fixtures import O_SQL, OV_SQL, P_SQL, T_SQL, V_SQL, object_voxels, objects, patches, table, tracks, voxels

OK = "image_id, t, label"
VKS = "image_id, t, z, y, x"


@query("a1_region_props", f"WITH {OV_SQL} SELECT {OK}, count(*) AS area, round(avg(z), 6) AS centroid_z, round(avg(y), 6) AS centroid_y, round(avg(x), 6) AS centroid_x, round(min(v1), 6) AS min_int, round(avg(v1), 6) AS mean_int, round(max(v1), 6) AS max_int FROM ov GROUP BY ALL")
def _(spark, d):
    return rounded(A.region_props(object_voxels(spark, d), "v1"))


_REGIONS = [("head", 1), ("spine", 2), ("neck", 3)]
_A2 = ", ".join(f"round(avg(CASE WHEN cls = {k} THEN v{c} END), 6) AS {r}_C{c}_mean_int, round(max(CASE WHEN cls = {k} THEN v{c} END), 6) AS {r}_C{c}_max_int" for r, k in _REGIONS for c in (1, 2))


@query("a2_channel_stats", f"WITH {V_SQL} SELECT image_id, t, ((y // 3) * 5 + x // 4 + 1)::BIGINT AS label, {_A2} FROM v GROUP BY 1, 2, 3")
def _(spark, d):
    label = (F.floor(F.col("y") / 3) * 5 + F.floor(F.col("x") / 4) + 1).cast("long")
    region = F.when(F.col("cls") == 1, "head").when(F.col("cls") == 2, "spine").otherwise("neck")
    return rounded(A.channel_stats(voxels(spark, d).withColumn("label", label).withColumn("region", region), ["v1", "v2"], [r for r, _ in _REGIONS]))


_BOX = ", ".join(f"min({c}) AS min_{c}, max({c}) AS max_{c}" for c in "zyx")
_VOL = " * ".join(f"(max({c}) - min({c}) + 1)" for c in "zyx")


@query("a3_bbox", f"WITH {OV_SQL} SELECT {OK}, count(*) AS area, {_BOX}, ({_VOL})::BIGINT AS bbox_vol, round(count(*) / ({_VOL}), 6) AS extent FROM ov GROUP BY ALL")
def _(spark, d):
    return rounded(A.bbox(object_voxels(spark, d)))


def _eigen_sql(name: str, source: str, extent: tuple[float, float, float]) -> str:
    """CTEs up to name(OK, area, low, middle, top): eigenvalues of the second moments of source, with something added on the diagonal."""
    m = ", ".join(f"{k} + {e!r} AS {k}" for k, e in zip(("zz", "yy", "xx"), extent, strict=True))
    return f"""{name}a AS (SELECT {OK}, area, {m}, zy, zx, yx FROM {source}), {name}b AS (SELECT *, (zz + yy + xx) / 3 AS q FROM {name}a),
  {name}c AS (SELECT *, sqrt(((zz - q) ** 2 + (yy - q) ** 2 + (xx - q) ** 2 + 2 * (zy ** 2 + zx ** 2 + yx ** 2)) / 6) AS p FROM {name}b),
  {name}d AS (SELECT *, CASE WHEN p > 1e-12 THEN ((zz - q) * ((yy - q) * (xx - q) - yx ** 2) - zy * (zy * (xx - q) - yx * zx) + zx * (zy * yx - (yy - q) * zx)) / (2 * p ** 3) ELSE 0 END AS r FROM {name}c),
  {name}e AS (SELECT *, CASE WHEN r > 1 - 1e-13 THEN 0 WHEN r < -1 + 1e-13 THEN pi() / 3 ELSE acos(least(1, greatest(-1, r))) / 3 END AS phi FROM {name}d),
  {name} AS (SELECT {OK}, area, q + 2 * p * cos(phi + 2 * pi() / 3) AS low, q + 2 * p * cos(phi) AS top, 3 * q AS trace FROM {name}e)"""


_MOMENTS = ", ".join(f"covar_pop({a} * {s[a]!r}, {b} * {s[b]!r}) AS {a}{b}" for s in ({"z": 1.0, "y": 0.102, "x": 0.102},) for a, b in ("zz", "yy", "xx", "zy", "zx", "yx"))


@query("a4_inertia_axes", f"""WITH {OV_SQL}, mo AS (SELECT {OK}, count(*) AS area, {_MOMENTS} FROM ov GROUP BY ALL), {_eigen_sql('w', 'mo', (1 / 12, 0.102**2 / 12, 0.102**2 / 12))}, {_eigen_sql('n', 'mo', (0.0, 0.0, 0.0))}
  SELECT {OK}, w.area, round(w.low + 1e-9, 5) AS e0, round(w.trace - w.top - w.low + 1e-9, 5) AS e1, round(w.top + 1e-9, 5) AS e2, round(2 * sqrt(5 * greatest(0, w.top)) + 1e-9, 4) AS axis_major, round(2 * sqrt(5 * greatest(0, w.low)) + 1e-9, 4) AS axis_minor,
    round(sqrt(12 * greatest(0, n.low)) + 1e-9, 3) AS axis_major_table, round(sqrt(20 * greatest(0, n.low)) + 1e-9, 3) AS axis_minor_table FROM w JOIN n USING ({OK})""")
def _(spark, d):
    out = A.inertia_axes(object_voxels(spark, d), (1.0, 0.102, 0.102))
    places = {"e0": 5, "e1": 5, "e2": 5, "axis_major": 4, "axis_minor": 4, "axis_major_table": 3, "axis_minor_table": 3}
    return out.withColumns({c: F.round(F.col(c) + 1e-9, n) + 0.0 for c, n in places.items()})


_SIDES = ", ".join(f"max({c}) - min({c}) + 1 AS s{c}" for c in "zyx")


@query("a5_drop_degenerate", f"WITH {OV_SQL}, b AS (SELECT {OK}, count(*) AS n, {_SIDES} FROM ov GROUP BY ALL), ok AS (SELECT {OK} FROM b WHERE n >= 5 AND least(sz, sy, sx) / greatest(sz, sy, sx) >= 0.4 AND (sz > 1)::INT + (sy > 1)::INT + (sx > 1)::INT >= 3) SELECT {VKS}, label FROM ov SEMI JOIN ok USING ({OK})")
def _(spark, d):
    return A.drop_degenerate(object_voxels(spark, d), 5, 0.4, 0.0, 3).select(*VK, "label")


@query("a6_hull_volume")
def _(spark, d):
    return rounded(A.hull_volume(object_voxels(spark, d)))


#: Hulls by definition: supporting planes through three corners, each plane's rim, and a fan over it, in integers.
_SMALL = "ob AS (SELECT *, ((y // 2) * 10 + x // 2)::BIGINT * 3 + z // 3 AS label FROM v WHERE cls = 1)"
_HULL = f"""{V_SQL}, {_SMALL}, pt AS MATERIALIZED (SELECT DISTINCT image_id, t, label, z + dz AS z, y + dy AS y, x + dx AS x, ((z + dz) * 11 + y + dy) * 21 + x + dx AS id FROM ob, (SELECT unnest([0, 1]) AS dz), (SELECT unnest([0, 1]) AS dy), (SELECT unnest([0, 1]) AS dx)),
  tri AS (SELECT image_id, t, label, a.z AS z, a.y AS y, a.x AS x, (b.y - a.y) * (c.x - a.x) - (b.x - a.x) * (c.y - a.y) AS nz, (b.x - a.x) * (c.z - a.z) - (b.z - a.z) * (c.x - a.x) AS ny, (b.z - a.z) * (c.y - a.y) - (b.y - a.y) * (c.z - a.z) AS nx
    FROM pt a JOIN pt b USING (image_id, t, label) JOIN pt c USING (image_id, t, label) WHERE a.id < b.id AND b.id <> c.id AND a.id < c.id),
  pl AS (SELECT DISTINCT image_id, t, label, nz // g AS nz, ny // g AS ny, nx // g AS nx, (nz * z + ny * y + nx * x) // g AS d FROM (SELECT *, gcd(gcd(abs(nz), abs(ny)), abs(nx)) AS g FROM tri WHERE nz <> 0 OR ny <> 0 OR nx <> 0)),
  fa AS MATERIALIZED (SELECT pl.* FROM pl JOIN pt p USING (image_id, t, label) GROUP BY ALL HAVING max(nz * p.z + ny * p.y + nx * p.x) <= any_value(d)),
  fp AS MATERIALIZED (SELECT fa.*, p.z, p.y, p.x, p.id FROM fa JOIN pt p USING (image_id, t, label) WHERE nz * p.z + ny * p.y + nx * p.x = d),
  ed AS (SELECT image_id, t, label, nz, ny, nx, d, p.z AS pz, p.y AS py, p.x AS px, q.z AS qz, q.y AS qy, q.x AS qx FROM fp p JOIN fp q USING (image_id, t, label, nz, ny, nx, d) JOIN fp r USING (image_id, t, label, nz, ny, nx, d) WHERE p.id <> q.id
    GROUP BY ALL HAVING bool_and(nz * ((q.y - p.y) * (r.x - p.x) - (q.x - p.x) * (r.y - p.y)) + ny * ((q.x - p.x) * (r.z - p.z) - (q.z - p.z) * (r.x - p.x)) + nx * ((q.z - p.z) * (r.y - p.y) - (q.y - p.y) * (r.z - p.z)) > 0
      OR nz * ((q.y - p.y) * (r.x - p.x) - (q.x - p.x) * (r.y - p.y)) + ny * ((q.x - p.x) * (r.z - p.z) - (q.z - p.z) * (r.x - p.x)) + nx * ((q.z - p.z) * (r.y - p.y) - (q.y - p.y) * (r.z - p.z)) = 0 AND (r.z - p.z) * (r.z - q.z) + (r.y - p.y) * (r.y - q.y) + (r.x - p.x) * (r.x - q.x) <= 0)),
  ap AS (SELECT image_id, t, label, nz, ny, nx, d, first(z ORDER BY id) AS z, first(y ORDER BY id) AS y, first(x ORDER BY id) AS x FROM fp GROUP BY ALL),
  hu AS (SELECT image_id, t, label, sum(z * (py * qx - px * qy) + y * (px * qz - pz * qx) + x * (pz * qy - py * qz))::BIGINT AS six_vol FROM ed JOIN ap USING (image_id, t, label, nz, ny, nx, d) GROUP BY ALL)"""


@query("a6_hull_six_volumes", f"WITH {_HULL} SELECT image_id, t, label, n AS area, six_vol FROM hu JOIN (SELECT image_id, t, label, count(*) AS n FROM ob GROUP BY ALL) USING (image_id, t, label)")
def _(spark, d):
    label = ((F.floor(F.col("y") / 2) * 10 + F.floor(F.col("x") / 2)) * 3 + F.floor(F.col("z") / 3)).cast("long")
    return A.hull_volume(voxels(spark, d).where("cls = 1").withColumn("label", label), (2, 2, 2)).select("image_id", "t", "label", "area", "six_vol")


_FERET = f"SELECT a.image_id, a.t, a.label, round(sqrt(max((a.z - b.z) ** 2 + ((a.y - b.y) * 0.102) ** 2 + ((a.x - b.x) * 0.102) ** 2)), 6) AS feret_max FROM ov a JOIN ov b ON a.image_id = b.image_id AND a.t = b.t AND a.label = b.label GROUP BY ALL"


@query("a7_feret_max", f"WITH {OV_SQL} {_FERET}")
def _(spark, d):
    return rounded(A.feret_max(object_voxels(spark, d), (1.0, 0.102, 0.102)))


@query("a8_mip", f"WITH {V_SQL} SELECT image_id, t, y, x, max(v1) AS v1 FROM v GROUP BY ALL")
def _(spark, d):
    return A.mip(voxels(spark, d), "v1")


@query("a9_projected_area", f"WITH {OV_SQL} SELECT {OK}, round(count(DISTINCT (y, x)) * 0.102 ** 2, 6) AS mip_area FROM ov GROUP BY ALL")
def _(spark, d):
    return rounded(A.projected_area(object_voxels(spark, d), 0.102))


@query("a10_dendrite_stats", f"WITH {V_SQL}, l AS (SELECT *, (y // 5 + 1)::BIGINT AS label FROM v WHERE cls >= 2) SELECT {OK}, count(*) FILTER (x % 4 = 0) AS dendrite_length, count(*) AS dendrite_volume FROM l GROUP BY ALL HAVING count(*) FILTER (x % 4 = 0) > 0")
def _(spark, d):
    den = voxels(spark, d).where("cls >= 2").withColumn("label", (F.floor(F.col("y") / 5) + 1).cast("long"))
    return A.dendrite_stats(den.where("x % 4 = 0"), den)


@query("a11_neuron_totals", f"WITH {V_SQL} SELECT image_id, count(*) FILTER (cls >= 2 AND x % 4 = 0) AS dendrite_length, count(*) FILTER (cls >= 2) AS dendrite_vol FROM v GROUP BY image_id HAVING count(*) FILTER (cls >= 2) > 0")
def _(spark, d):
    den = voxels(spark, d).where("cls >= 2")
    return A.neuron_totals(den.where("x % 4 = 0"), den)


_MEANS = ", ".join(f"round(avg({c}), 6) AS avg_{c}" for c in ("area", "price", "disc"))


@query("a12_neuron_summary", f"WITH {O_SQL}, s AS (SELECT s_suppkey::BIGINT AS image_id, greatest(0, s_acctbal)::DOUBLE AS length, greatest(0, s_acctbal)::DOUBLE * 2 AS volume FROM supplier) SELECT image_id, count(*) AS total_spines, {_MEANS}, round(any_value(length), 6) AS length, round(any_value(volume), 6) AS volume, round(count(*) / nullif(any_value(length), 0), 6) AS spines_per_um, round(count(*) / nullif(any_value(volume), 0), 6) AS spines_per_um3 FROM o JOIN s USING (image_id) GROUP BY image_id")
def _(spark, d):
    length = F.greatest(F.lit(0.0), F.col("s_acctbal").cast("double"))
    totals = table(spark, d, "supplier").select(F.col("s_suppkey").cast("long").alias("image_id"), length.alias("length"), (length * 2).alias("volume"))
    return rounded(A.neuron_summary(objects(spark, d), totals, ["area", "price", "disc"]))


@query("a13_dendrite_summary", f"WITH {O_SQL}, s AS (SELECT p_partkey::BIGINT % 50 AS dendrite_id, max(p_retailprice)::DOUBLE AS length, sum(p_retailprice)::DOUBLE AS volume FROM part GROUP BY 1) SELECT image_id, dendrite_id, count(*) AS total_spines, {_MEANS}, round(any_value(length), 4) AS length, round(any_value(volume), 4) AS volume, round(count(*) / nullif(any_value(length), 0), 6) AS spines_per_um, round(count(*) / nullif(any_value(volume), 0), 6) AS spines_per_um3 FROM o LEFT JOIN s USING (dendrite_id) GROUP BY image_id, dendrite_id")
def _(spark, d):
    price = F.col("p_retailprice").cast("double")
    stats = table(spark, d, "part").groupBy((F.col("p_partkey") % 50).cast("long").alias("dendrite_id")).agg(F.max(price).alias("length"), F.sum(price).alias("volume"))
    spines = objects(spark, d)
    stats = spines.select("image_id", "dendrite_id").distinct().join(stats, "dendrite_id")
    out = rounded(A.dendrite_summary(spines, stats, ["area", "price", "disc"]))
    return out.withColumns({c: F.round(c, 4) for c in ("length", "volume")})


@query("a15_distinct_labels", f"WITH {OV_SQL} SELECT image_id, t, count(DISTINCT label) AS n_labels FROM ov GROUP BY ALL")
def _(spark, d):
    return A.distinct_labels(object_voxels(spark, d))


@query("a16_dedupe_tiles", f"WITH {O_SQL} SELECT label, line, price, area FROM o QUALIFY row_number() OVER (PARTITION BY label ORDER BY price DESC, line) = 1")
def _(spark, d):
    return A.dedupe_tiles(objects(spark, d), ["label"], [F.desc("price"), F.col("line")]).select("label", "line", "price", "area")


_TIMES = list(range(1, 32))


@query("a17_track_matrix", f"WITH {T_SQL} SELECT spine_id, {', '.join(f'round(max(CASE WHEN timepoint = {t} THEN spine_vol END), 4) AS t{t}' for t in _TIMES)} FROM tr GROUP BY spine_id")
def _(spark, d):
    return rounded(A.track_matrix(tracks(spark, d), "spine_vol", _TIMES), 4)


@query("a18_iou", f"WITH {V_SQL} SELECT image_id, count(*) FILTER (cls = 1 AND cls_pred = 1) AS intersection, count(*) AS union_, round(count(*) FILTER (cls = 1 AND cls_pred = 1) / count(*), 6) AS iou FROM v WHERE cls = 1 OR cls_pred = 1 GROUP BY image_id")
def _(spark, d):
    vox = voxels(spark, d)
    return rounded(A.iou(vox.where("cls = 1"), vox.where("cls_pred = 1")))


_DICE = f"""WITH {V_SQL}, s AS (SELECT image_id, c AS cls, 2.0 * count(*) FILTER (cls = c AND cls_pred = c) / nullif(count(*) FILTER (cls = c) + count(*) FILTER (cls_pred = c), 0) AS dice
  FROM v, (SELECT unnest([1, 2, 3]) AS c) GROUP BY ALL UNION ALL SELECT image_id, 0, 2.0 * (1400 - count(*)) / nullif(2 * (1400 - count(*)), 0) FROM v GROUP BY image_id)"""


@query("a19_dice", f"{_DICE} SELECT image_id, cls, round(dice, 6)::DOUBLE AS dice FROM s")
def _(spark, d):
    return rounded(A.dice(voxels(spark, d), "cls", "cls_pred", [1, 2, 3], 1400))


@query("a20_dice_report", f"{_DICE} SELECT image_id, cls, round(avg(dice), 6)::DOUBLE AS dice, grouping(image_id, cls)::BIGINT AS level FROM s GROUP BY GROUPING SETS ((image_id), (cls), ())")
def _(spark, d):
    return rounded(A.dice_report(A.dice(voxels(spark, d), "cls", "cls_pred", [1, 2, 3], 1400)))


_MATCH = f"""WITH {V_SQL}, l AS (SELECT *, ((y // 3) * 5 + x // 4 + 1)::BIGINT AS label FROM v),
  a AS (SELECT image_id, count(*) FILTER (share > 0.5) AS tp, count(*) AS n_gt FROM (SELECT image_id, label, avg((cls_pred = 1)::INT) AS share FROM l WHERE cls = 1 GROUP BY ALL) GROUP BY image_id),
  b AS (SELECT image_id, count(*) FILTER (share < 0.5) AS fp, count(*) AS n_out FROM (SELECT image_id, label, avg((cls = 1)::INT) AS share FROM l WHERE cls_pred = 1 GROUP BY ALL) GROUP BY image_id),
  m AS (SELECT image_id, coalesce(tp, 0) AS tp, coalesce(n_gt, 0) AS n_gt, coalesce(fp, 0) AS fp, coalesce(n_out, 0) AS n_out FROM a FULL JOIN b USING (image_id)),
  k AS (SELECT *, n_gt - tp AS fn, round(tp / nullif(tp + fp, 0), 6) AS precision, round(tp / nullif(n_gt, 0), 6) AS recall FROM m)"""


def _labelled(vox):
    return vox.withColumn("label", (F.floor(F.col("y") / 3) * 5 + F.floor(F.col("x") / 4) + 1).cast("long"))


@query("a21_object_match", f"{_MATCH} SELECT * FROM k")
def _(spark, d):
    vox = _labelled(voxels(spark, d))
    return rounded(A.object_match(vox.where("cls = 1"), vox.where("cls_pred = 1")))


@query("a22_validate", f"{_MATCH}, i AS (SELECT image_id, count(*) FILTER (cls = 1 AND cls_pred = 1) AS intersection, count(*) AS union_, round(count(*) FILTER (cls = 1 AND cls_pred = 1) / count(*), 6) AS iou, count(*) FILTER (cls = 1) AS gt_volume, count(*) FILTER (cls_pred = 1) AS out_volume, count(*) FILTER (cls_pred = 1) - count(*) FILTER (cls = 1) AS volume_difference FROM v WHERE cls = 1 OR cls_pred = 1 GROUP BY image_id) SELECT * FROM k JOIN i USING (image_id)")
def _(spark, d):
    vox = _labelled(voxels(spark, d))
    return rounded(A.validate(vox.where("cls = 1"), vox.where("cls_pred = 1")))


@query("a23_majority_vote", "WITH b AS (SELECT l_suppkey::BIGINT AS image_id, 0 AS t, (l_linenumber - 1)::INT AS z, CAST(l_quantity - 1 AS INT) % 10 AS y, (l_partkey % 20)::INT AS x, CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS cls FROM lineitem), n AS (SELECT *, count(*) AS n FROM b GROUP BY ALL) SELECT image_id, t, z, y, x, first(cls ORDER BY n DESC, cls) AS cls FROM n GROUP BY ALL")
def _(spark, d):
    flag = F.col("l_returnflag")
    votes = table(spark, d, "lineitem").select(F.col("l_suppkey").cast("long").alias("image_id"), F.lit(0).alias("t"), (F.col("l_linenumber") - 1).cast("int").alias("z"), ((F.col("l_quantity") - 1).cast("int") % 10).alias("y"), (F.col("l_partkey") % 20).cast("int").alias("x"), F.when(flag == "A", 1).when(flag == "N", 2).otherwise(3).alias("cls"))
    return A.majority_vote(votes)


_FACE = "".join(f" + {w} * (CASE WHEN EXISTS (SELECT 1 FROM ov b WHERE b.image_id = a.image_id AND b.label = a.label AND b.z = a.z + {dz} AND b.y = a.y + {dy} AND b.x = a.x + {dx}) THEN 0 ELSE 1 END)" for w, dz, dy, dx in ((0.102 * 0.102, 1, 0, 0), (0.102 * 0.102, -1, 0, 0), (0.102, 0, 1, 0), (0.102, 0, -1, 0), (0.102, 0, 0, 1), (0.102, 0, 0, -1)))
_SURFACE = f"SELECT a.image_id, a.t, a.label, round(sum(0{_FACE}), 6)::DOUBLE AS surf_area, round(count(*) * 0.102 * 0.102, 6)::DOUBLE AS vol FROM ov a GROUP BY ALL"


@query("a24_surface_area", f"WITH {OV_SQL} {_SURFACE}")
def _(spark, d):
    return rounded(A.surface_area(object_voxels(spark, d), (1.0, 0.102, 0.102)))


_MESH = f"""mk(dz, dy, dx, bit) AS (VALUES {', '.join(f'({z}, {y}, {x}, {1 << k})' for k, (z, y, x) in enumerate(A._CORNERS))}),
  mt(code, area, six, nz, ny, nx) AS (VALUES {', '.join(f"({k}, {', '.join(f'{v!r}::DOUBLE' for v in r)})" for k, r in enumerate(A.mesh_cells((1.0, 0.102, 0.102))))}),
  mc AS (SELECT {OK}, z - dz AS z, y - dy AS y, x - dx AS x, sum(bit) AS code FROM ov, mk GROUP BY ALL)"""


@query("a24_surface_mesh", f"WITH {OV_SQL}, {_MESH} SELECT {OK}, round(sum(area), 6) AS mesh_area, round(sum(six + z * nz + y * 0.102 * ny + x * 0.102 * nx) / 6, 6) AS mesh_vol FROM mc JOIN mt USING (code) GROUP BY ALL")
def _(spark, d):
    return rounded(A.surface_mesh(object_voxels(spark, d), (1.0, 0.102, 0.102)))


@query("a25_morphometrics", f"WITH {OV_SQL}, s AS ({_SURFACE}), f AS ({_FERET}), b AS (SELECT {OK}, count(*) AS area, ({_VOL})::BIGINT AS bbox_vol, round(count(*) / ({_VOL}), 6) AS extent, round(count(DISTINCT (y, x)) * 0.102 ** 2, 6) AS mip_area FROM ov GROUP BY ALL) SELECT {OK}, area, bbox_vol, extent, surf_area, vol, feret_max AS length, mip_area FROM b JOIN s USING ({OK}) JOIN f USING ({OK})")
def _(spark, d):
    return rounded(A.morphometrics(object_voxels(spark, d), (1.0, 0.102, 0.102)))


@query("a26_box_length_width", f"""WITH {OV_SQL}, c AS (SELECT {OK}, avg(z) AS cz, avg(y) AS cy, avg(x) AS cx, greatest(max(z) - min(z), max(y) - min(y), max(x) - min(x)) AS length FROM ov GROUP BY ALL),
  d AS (SELECT {OK}, z - cz AS uz, y - cy AS uy, (z - cz) ** 2 + (y - cy) ** 2 + (x - cx) ** 2 AS d2, z, y, x, length FROM ov JOIN c USING ({OK})),
  f AS (SELECT {OK}, first(uz ORDER BY d2 DESC, z, y, x) AS fz, first(uy ORDER BY d2 DESC, z, y, x) AS fy FROM d GROUP BY ALL),
  s AS (SELECT {OK}, length, CASE WHEN fz * fz + fy * fy > 0 THEN (uz * -fy + uy * fz) / sqrt(fz * fz + fy * fy) ELSE 0 END AS s FROM d JOIN f USING ({OK}))
  SELECT {OK}, any_value(length) AS length, round(max(s) - min(s), 6) AS width FROM s GROUP BY ALL""")
def _(spark, d):
    return rounded(A.box_length_width(object_voxels(spark, d)))


@query("a27_axis_widths", f"""WITH {OV_SQL}, m AS (SELECT {OK}, z AS seq, avg(y) AS y, avg(x) AS x FROM ov GROUP BY ALL),
  w AS (SELECT ov.image_id, ov.t, ov.label, seq, 2 * max(abs((ov.y - m.y) * -0.8 + (ov.x - m.x) * 0.6)) AS w FROM ov JOIN m ON ov.image_id = m.image_id AND ov.t = m.t AND ov.label = m.label AND ov.z = seq GROUP BY ALL)
  SELECT {OK}, round(min(w), 6) AS width_min, round(max(w), 6) AS width_max, round(avg(w), 6) AS width_mean FROM w GROUP BY ALL""")
def _(spark, d):
    vox = object_voxels(spark, d)
    mid = vox.groupBy(*A.OK, F.col("z").alias("seq")).agg(F.avg("y").alias("y"), F.avg("x").alias("x")).withColumn("ty", F.lit(0.6)).withColumn("tx", F.lit(0.8))
    return rounded(A.axis_widths(mid, vox.select(*A.OK, "y", "x", F.col("z").alias("seq"))))


@query("a28_percentiles", f"WITH {V_SQL}, q AS (SELECT image_id, quantile_cont(v1, 0.02) AS p_low, quantile_cont(v1, 0.99) AS p_high FROM v GROUP BY image_id) SELECT {VKS}, round(least(1, greatest(0, coalesce((v1 - p_low) / nullif(p_high - p_low, 0), 0))) * 60000, 4) AS v1 FROM v JOIN q USING (image_id)")
def _(spark, d):
    return rounded(A.contrast_stretch(voxels(spark, d), "v1", 0.02, 0.99, 60000.0, ["image_id"]).select(*VK, "v1"), 4)


@query("a29_minmax_normalise", f"WITH {V_SQL} SELECT {VKS}, round(coalesce((v1 - min(v1) OVER w) / nullif(max(v1) OVER w - min(v1) OVER w, 0), 0) * 65535, 4) AS v1 FROM v WINDOW w AS (PARTITION BY image_id)")
def _(spark, d):
    return rounded(A.minmax_normalise(voxels(spark, d), "v1", ["image_id"], 65535.0).select(*VK, "v1"), 4)


_OTSU = f"""{V_SQL}, e AS (SELECT image_id, v1, min(v1) OVER (PARTITION BY image_id) AS low, max(v1) OVER (PARTITION BY image_id) AS high FROM v),
  h AS (SELECT image_id, low, high, least(255, floor(coalesce((v1 - low) / nullif(high - low, 0), 0) * 256))::INT AS bin, count(*) AS n FROM e GROUP BY ALL),
  s AS (SELECT *, sum(n) OVER u AS n0, sum(n * (bin + 0.5)) OVER u AS m0, sum(n) OVER (PARTITION BY image_id) AS nn, sum(n * (bin + 0.5)) OVER (PARTITION BY image_id) AS mm FROM h WINDOW u AS (PARTITION BY image_id ORDER BY bin)),
  b AS (SELECT *, round(coalesce((mm::DOUBLE * n0 - m0::DOUBLE * nn) ** 2 / nullif(n0 * (nn - n0), 0), 0), 3) AS score FROM s),
  th AS (SELECT image_id, first(low ORDER BY score DESC, bin) + (first(high ORDER BY score DESC, bin) - first(low ORDER BY score DESC, bin)) * (first(bin ORDER BY score DESC, bin) + 1) / 256 AS threshold FROM b GROUP BY image_id)"""
_BALL = ", ".join(f"({z}, {y}, {x})" for z in range(-5, 6) for y in range(-5, 6) for x in range(-5, 6) if abs(z) + abs(y) + abs(x) <= 5)


@query("a30_otsu_mask", f"WITH {_OTSU}, k(dz, dy, dx) AS (VALUES {_BALL}) SELECT DISTINCT image_id, t, (z + dz)::INT AS z, (y + dy)::INT AS y, (x + dx)::INT AS x FROM v JOIN th USING (image_id), k WHERE v1 > threshold AND z + dz BETWEEN 0 AND 6 AND y + dy BETWEEN 0 AND 9 AND x + dx BETWEEN 0 AND 19")
def _(spark, d):
    return A.otsu_mask(voxels(spark, d), "v1", (7, 10, 20))


@query("a30_otsu", f"WITH {_OTSU} SELECT image_id, round(threshold, 4) AS threshold FROM th")
def _(spark, d):
    return rounded(A.otsu_threshold(voxels(spark, d), "v1", ["image_id"]), 4)


@query("a31_histogram_match", f"""WITH {V_SQL}, c AS (SELECT image_id, v1, count(*) AS n FROM v GROUP BY ALL),
  q AS (SELECT image_id, v1, sum(n) OVER (PARTITION BY image_id ORDER BY v1) / sum(n) OVER (PARTITION BY image_id) AS q FROM c),
  r AS (SELECT q AS q1, v1 AS a1, lag(q) OVER (ORDER BY q) AS q0, lag(v1) OVER (ORDER BY q) AS a0 FROM q WHERE image_id = 1)
  SELECT image_id, v1 AS before, round(CASE WHEN q0 IS NULL THEN a1 ELSE a0 + (a1 - a0) * (q - q0) / (q1 - q0) END, 4) AS after FROM q JOIN r ON q.q <= q1 AND (q0 IS NULL OR q.q > q0)""")
def _(spark, d):
    return rounded(A.histogram_match(voxels(spark, d), "v1", "image_id", 1), 4)


_A32 = f"""{V_SQL}, e AS (SELECT *, min(v1) OVER (PARTITION BY image_id) AS low, max(v1) OVER (PARTITION BY image_id) AS high FROM v),
  rw AS (SELECT {VKS}, least(63, floor(coalesce((v1 - low) / nullif(high - low, 0), 0) * 64))::INT AS bin FROM e), ow AS (SELECT image_id, y // 5 AS ty, x // 5 AS tx, bin, count(*) AS n FROM rw GROUP BY ALL),
  ev AS (SELECT d.image_id, d.ty, d.tx, b.bin, coalesce(n, 0) AS n FROM (SELECT DISTINCT image_id, ty, tx FROM ow) d CROSS JOIN (SELECT unnest(range(64))::INT AS bin) b LEFT JOIN ow ON ow.image_id = d.image_id AND ow.ty = d.ty AND ow.tx = d.tx AND ow.bin = b.bin),
  k AS (SELECT *, sum(n) OVER w AS total, least(n::DOUBLE, greatest(1.0, 0.03 * sum(n) OVER w)) AS kept FROM ev WINDOW w AS (PARTITION BY image_id, ty, tx)),
  lv AS (SELECT image_id, ty, tx, bin, (sum(kept) OVER (PARTITION BY image_id, ty, tx ORDER BY bin) + (total - sum(kept) OVER (PARTITION BY image_id, ty, tx)) / 64 * (bin + 1)) / total AS level FROM k),
  yy AS (SELECT *, unnest([floor((y + 0.5) / 5 - 0.5), floor((y + 0.5) / 5 - 0.5) + 1]) AS ty FROM rw), xx AS (SELECT *, unnest([floor((x + 0.5) / 5 - 0.5), floor((x + 0.5) / 5 - 0.5) + 1]) AS tx FROM yy),
  ww AS (SELECT *, (1 - abs((y + 0.5) / 5 - 0.5 - ty)) * (1 - abs((x + 0.5) / 5 - 0.5 - tx)) AS w FROM xx)"""


@query("a32_tile_equalise", f"WITH {_A32} SELECT {VKS}, round(sum(w * level) / sum(w) + 1e-9, 6) AS equalised FROM ww JOIN lv USING (image_id, ty, tx, bin) WHERE w > 0 GROUP BY ALL")
def _(spark, d):
    return rounded(A.tile_equalise(voxels(spark, d), "v1", 5, 0.03).select(*VK, (F.col("equalised") + 1e-9).alias("equalised")))


def _ssim_ctes(name: str, source: str, win: int, size: int, span: float = 1.0) -> str:
    """CTE name(image_id, ssim, contrast) over source(image_id, y, x, a, b)."""
    import math

    w = [math.exp(-((k - win // 2) ** 2) / (2 * 1.5**2)) for k in range(win)]
    taps = ", ".join(f"({k}, {v / sum(w)!r}::DOUBLE)" for k, v in enumerate(w))
    mom, c1, c2 = ["a", "b", "aa", "bb", "ab"], (0.01 * span) ** 2, (0.03 * span) ** 2
    cs = f"(2 * (ab - a * b) + {c2!r}) / (aa - a * a + bb - b * b + {c2!r})"
    return f"""{name}_k(k, w) AS (VALUES {taps}), {name}_m AS (SELECT image_id, y, x, a, b, a * a AS aa, b * b AS bb, a * b AS ab FROM {source}),
  {name}_r AS (SELECT image_id, y - k AS y, x, {', '.join(f'sum(w * {c}) AS {c}' for c in mom)} FROM {name}_m, {name}_k WHERE y - k BETWEEN 0 AND {size - win} GROUP BY 1, 2, 3),
  {name}_s AS (SELECT image_id, y, x - k AS x, {', '.join(f'sum(w * {c}) AS {c}' for c in mom)} FROM {name}_r, {name}_k WHERE x - k BETWEEN 0 AND {size - win} GROUP BY 1, 2, 3),
  {name} AS (SELECT image_id, avg({cs} * (2 * a * b + {c1!r}) / (a * a + b * b + {c1!r})) AS ssim, avg({cs}) AS contrast FROM {name}_s GROUP BY image_id)"""


_PAIRS = f"{P_SQL}, pr AS (SELECT a.image_id, a.y, a.x, a.v AS a, b.v AS b FROM p a JOIN p b ON b.image_id = a.image_id + 1 AND a.y = b.y AND a.x = b.x)"
_HALF = "ph AS (SELECT image_id, y // 2 AS y, x // 2 AS x, avg(a) AS a, avg(b) AS b FROM pr GROUP BY 1, 2, 3)"


def _pairs(spark, d):
    p = patches(spark, d).select("image_id", "y", "x", "v")
    return p.withColumnRenamed("v", "a").join(p.select((F.col("image_id") - 1).alias("image_id"), "y", "x", F.col("v").alias("b")), ["image_id", "y", "x"])


@query("a33_ssim", f"WITH {_PAIRS}, {_ssim_ctes('one', 'pr', 5, 8)} SELECT image_id, round(ssim, 5) AS ssim FROM one")
def _(spark, d):
    return rounded(A.ssim(_pairs(spark, d), "a", "b", 5, 8).select("image_id", "ssim"), 5)


@query("a33_ms_ssim", f"WITH {_PAIRS}, {_HALF}, {_ssim_ctes('one', 'pr', 3, 8)}, {_ssim_ctes('two', 'ph', 3, 4)} SELECT image_id, round(pow(greatest(0, one.contrast), 0.4) * pow(greatest(0, two.ssim), 0.6), 4) AS ms_ssim FROM one JOIN two USING (image_id)")
def _(spark, d):
    return rounded(A.ms_ssim(_pairs(spark, d), "a", "b", 3, 8, (0.4, 0.6)), 4)


@query("a34_charbonnier", f"WITH {P_SQL} SELECT a.image_id, round(avg(sqrt((a.v - b.v) ** 2 + 1e-3)), 6) AS loss FROM p a JOIN p b ON b.image_id = a.image_id + 1 AND a.y = b.y AND a.x = b.x GROUP BY a.image_id")
def _(spark, d):
    return rounded(A.charbonnier(_pairs(spark, d), "a", "b"))


@query("a35_volume_meta", f"WITH {V_SQL} SELECT image_id, (max(z) + 1)::INT AS nz, (max(y) + 1)::INT AS ny, (max(x) + 1)::INT AS nx, greatest(max(v1), max(v2)) AS max_value, count(*) AS stored, (max(z) + 1)::BIGINT * (max(y) + 1) * (max(x) + 1) AS voxels, (max(z) + 1)::BIGINT * (max(y) + 1) * (max(x) + 1) * 4 AS bytes, 2 AS channels, (max(z) + 1)::BIGINT * (max(y) + 1) * (max(x) + 1) > 1399 AS is_large FROM v GROUP BY image_id")
def _(spark, d):
    return A.volume_meta(voxels(spark, d), ["v1", "v2"], 1399)
