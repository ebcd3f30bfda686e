"""Registered queries: components, growth, geodesics and paths; and the flagship query."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxlake.operators import aggregates as A
from voxlake.operators import iterative as G
from voxlake.operators import joins as J
from voxlake.operators import projections as P
from voxlake.operators.filters import kernel
from voxlake.operators.projections import VK
from voxlake.plans.register import query, rounded
from voxlake.plans.scratch import saved
from voxlake.sources.fixtures import V_SQL, voxels

VKS = "image_id, t, z, y, x"
SMALL = (4, 5, 7)  # bricks: eighteen an image, so that rounds cross their faces


def _cc_sql(mask: str, connectivity: int, name: str) -> str:
    """CTEs: name(image_id, t, z, y, x, label) by transitive closure."""
    near = {6: "abs(a.z - b.z) + abs(a.y - b.y) + abs(a.x - b.x) = 1", 26: "abs(a.z - b.z) <= 1 AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1"}[connectivity]
    return f"""{name}_s AS (SELECT {VKS}, image_id * 1400 + z * 200 + y * 20 + x AS id FROM v WHERE {mask}),
  {name}_e AS (SELECT a.id AS a, b.id AS b FROM {name}_s a JOIN {name}_s b ON a.image_id = b.image_id AND {near}),
  {name}_r(a, b) AS (SELECT id, id FROM {name}_s UNION SELECT r.a, e.b FROM {name}_r r JOIN {name}_e e ON r.b = e.a),
  {name}_c AS (SELECT a AS id, min(b) AS first FROM {name}_r GROUP BY a),
  {name} AS (SELECT {VKS}, id, dense_rank() OVER (PARTITION BY image_id ORDER BY first) AS label FROM {name}_s JOIN {name}_c USING (id))"""


@query("g1_connected_components_26", f"WITH RECURSIVE {V_SQL}, {_cc_sql('cls = 1', 26, 's')} SELECT {VKS}, label FROM s")
def _(spark, d):
    return G.label_components(voxels(spark, d).where("cls = 1"), 26, (4, 5, 7))


@query("g1_connected_components_6", f"WITH RECURSIVE {V_SQL}, {_cc_sql('cls >= 2', 6, 's')} SELECT {VKS}, label FROM s")
def _(spark, d):
    return G.label_components(voxels(spark, d).where("cls >= 2"), 6)


_V4 = "w AS (SELECT image_id // 5 AS image_id, (image_id % 5)::INT AS t, z, y, x FROM v WHERE cls = 1)"


def _frames(spark, d):
    vox = voxels(spark, d).where("cls = 1")
    return vox.select(F.floor(F.col("image_id") / 5).alias("image_id"), (F.col("image_id") % 5).cast("int").alias("t"), "z", "y", "x")


@query("g2_connected_components_4d", f"""WITH RECURSIVE {V_SQL}, {_V4}, s AS (SELECT *, ((image_id * 5 + t) * 1400 + z * 200 + y * 20 + x) AS id FROM w),
  e AS (SELECT a.id AS a, b.id AS b FROM s a JOIN s b ON a.image_id = b.image_id AND abs(a.t - b.t) <= 1 AND abs(a.z - b.z) <= 1 AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1),
  r(id, low) USING KEY (id) AS (SELECT id, id FROM s UNION SELECT e.b, min(r.low) FROM r JOIN e ON r.id = e.a JOIN recurring.r k ON k.id = e.b WHERE r.low < k.low GROUP BY e.b)
  SELECT {VKS}, dense_rank() OVER (PARTITION BY image_id ORDER BY low) AS label FROM s JOIN r USING (id)""")
def _(spark, d):
    return G.label_components(_frames(spark, d), 80)


@query("a14_filter_components", f"WITH RECURSIVE {V_SQL}, {_cc_sql('cls >= 2', 6, 's')}, k AS (SELECT image_id, label FROM s GROUP BY ALL HAVING count(*) >= 3) SELECT {VKS}, dense_rank() OVER (PARTITION BY image_id ORDER BY label) AS label FROM s SEMI JOIN k USING (image_id, label)")
def _(spark, d):
    return A.filter_components(G.label_components(voxels(spark, d).where("cls >= 2"), 6), 3).select(*VK, "label")


_G3_SQL = f"""WITH RECURSIVE {V_SQL}, {_cc_sql('cls = 1', 26, 's')}, m AS (SELECT {VKS}, image_id * 1400 + z * 200 + y * 20 + x AS id FROM v WHERE cls = 2 AND y % 3 = 0),
  n AS (SELECT {VKS}, id FROM s UNION ALL SELECT {VKS}, id FROM m), e AS (SELECT a.id AS a, b.id AS b FROM n a JOIN m b ON a.image_id = b.image_id AND abs(a.z - b.z) <= 1 AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1),
  g(id, label) USING KEY (id) AS (SELECT id, label FROM s UNION SELECT e.b, max(g.label) FROM g JOIN e ON g.id = e.a LEFT JOIN recurring.g k ON k.id = e.b WHERE k.id IS NULL GROUP BY e.b)
  SELECT {VKS}, label FROM n JOIN g USING (id)"""


@query("g3_grow_labels", _G3_SQL)
def _(spark, d):
    vox = voxels(spark, d)
    return G.grow_labels(G.label_components(vox.where("cls = 1"), 26), vox.where("cls = 2 and y % 3 = 0")).select(*VK, "label")


@query("g3_grow_labels_bricks", _G3_SQL)
def _(spark, d):
    vox = voxels(spark, d)
    return G.grow_labels(G.label_components(vox.where("cls = 1"), 26), vox.where("cls = 2 and y % 3 = 0"), brick=SMALL).select(*VK, "label")


_CROSS = [(0, 0, 0), (1, 0, 0), (-1, 0, 0), (0, 1, 0), (0, -1, 0), (0, 0, 1), (0, 0, -1)]
_STEPS = ", ".join(str(d) for d in _CROSS)


@query("g4_dilate_erode", f"WITH {V_SQL}, k(dz, dy, dx) AS (VALUES {_STEPS}), d AS (SELECT DISTINCT image_id, t, z + dz AS z, y + dy AS y, x + dx AS x FROM v, k WHERE cls = 1 AND z + dz BETWEEN 0 AND 6 AND y + dy BETWEEN 0 AND 9 AND x + dx BETWEEN 0 AND 19), e AS (SELECT image_id, t, z - dz AS z, y - dy AS y, x - dx AS x FROM d, k GROUP BY ALL HAVING count(*) = 7) SELECT *, 'dilated' AS op FROM d UNION ALL SELECT *, 'closed' FROM e")
def _(spark, d):
    big = G.dilate(voxels(spark, d).where("cls = 1"), _CROSS, (7, 10, 20))
    return big.withColumn("op", F.lit("dilated")).unionByName(G.erode(big, _CROSS).withColumn("op", F.lit("closed")))


_DEPTH = "dp AS (SELECT a.image_id, a.t, a.z, a.y, a.x, min((a.z - o.z) ** 2 + (a.y - o.y) ** 2 + (a.x - o.x) ** 2) AS d2 FROM w a JOIN sh o USING (image_id) GROUP BY ALL)"
_SHELL = "w AS (SELECT {vk} FROM v WHERE cls >= 2), sh AS (SELECT DISTINCT image_id, z + dz AS z, y + dy AS y, x + dx AS x FROM w, (SELECT unnest([-1, 0, 1]) AS dz), (SELECT unnest([-1, 0, 1]) AS dy), (SELECT unnest([-1, 0, 1]) AS dx) WHERE (image_id, z + dz, y + dy, x + dx) NOT IN (SELECT (image_id, z, y, x) FROM w))".format(vk=VKS)


@query("g5_seeds_from_distance", f"WITH RECURSIVE {V_SQL}, {_SHELL}, {_DEPTH}, v2 AS (SELECT *, max(d2) OVER (PARTITION BY image_id) AS top FROM dp), {_cc_sql('sqrt(d2) > 0.7 * sqrt(top)', 6, 's').replace('FROM v WHERE', 'FROM v2 WHERE')} SELECT {VKS}, label FROM s")
def _(spark, d):
    return G.seeds_from_distance(voxels(spark, d).where("cls >= 2"), 0.7)


_G6 = f"""{V_SQL}, {_SHELL}, {_DEPTH}, v3 AS (SELECT *, -least(sqrt(d2), 4.0) AS pri, image_id * 1400 + z * 200 + y * 20 + x AS id FROM dp), {_cc_sql('x % 4 = 0 AND z % 2 = 0', 6, 's').replace('FROM v WHERE', 'FROM v3 WHERE')},
  ed AS (SELECT a.id AS a, b.id AS b, b.pri FROM v3 a JOIN v3 b ON a.image_id = b.image_id AND abs(a.z - b.z) + abs(a.y - b.y) + abs(a.x - b.x) = 1),
  mm(id, c) USING KEY (id) AS (SELECT id, -1e300::DOUBLE FROM s UNION SELECT ed.b, min(greatest(mm.c, ed.pri)) FROM mm JOIN ed ON mm.id = ed.a LEFT JOIN recurring.mm k ON k.id = ed.b WHERE k.id IS NULL OR greatest(mm.c, ed.pri) < k.c GROUP BY ed.b),
  ti AS (SELECT ed.a, ed.b FROM ed JOIN mm p ON p.id = ed.a JOIN mm q ON q.id = ed.b WHERE greatest(p.c, ed.pri) = q.c),
  fl(id, label) USING KEY (id) AS (SELECT id, label FROM s UNION SELECT ti.b, min(fl.label) FROM fl JOIN ti ON fl.id = ti.a LEFT JOIN recurring.fl k ON k.id = ti.b WHERE k.id IS NULL GROUP BY ti.b)"""


_G6_SQL = f"WITH RECURSIVE {_G6} SELECT {VKS}, label FROM v3 JOIN fl USING (id)"


@query("g6_seeded_split", _G6_SQL)
def _(spark, d):
    mask = voxels(spark, d).where("cls >= 2")
    deep = saved(G.inside_distance(mask, 4).withColumn("priority", -F.coalesce("distance", F.lit(4.0))), "depth")
    seeds = G.label_components(deep.where("x % 4 = 0 and z % 2 = 0"), 6)
    return G.seeded_split(deep, seeds, "priority", 6)


@query("g6_seeded_split_bricks", _G6_SQL)
def _(spark, d):
    mask = voxels(spark, d).where("cls >= 2")
    deep = saved(G.inside_distance(mask, 4).withColumn("priority", -F.coalesce("distance", F.lit(4.0))), "depth")
    seeds = G.label_components(deep.where("x % 4 = 0 and z % 2 = 0"), 6)
    return G.seeded_split(deep, seeds, "priority", 6, SMALL)


_G7 = f"""{V_SQL}, {_cc_sql('cls >= 2', 6, 's')}, f AS (SELECT id FROM s QUALIFY row_number() OVER (PARTITION BY image_id, label ORDER BY z + y + x, z, y, x) = 1),
  g(id, hops) USING KEY (id) AS (SELECT id, 0 FROM f UNION SELECT e.b, min(g.hops + 1) FROM g JOIN s_e e ON g.id = e.a LEFT JOIN recurring.g k ON k.id = e.b WHERE k.id IS NULL GROUP BY e.b)"""


_G7_SQL = f"WITH RECURSIVE {_G7} SELECT {VKS}, hops FROM s JOIN g USING (id)"


@query("g7_geodesic", _G7_SQL)
def _(spark, d):
    return G.geodesic(G.label_components(voxels(spark, d).where("cls >= 2"), 6))


@query("g7_geodesic_bricks", _G7_SQL)
def _(spark, d):
    return G.geodesic(G.label_components(voxels(spark, d).where("cls >= 2"), 6), brick=SMALL)


@query("g8_geodesic_to_objects", f"""WITH RECURSIVE {_G7}, k AS (SELECT image_id, z, y, x, hops FROM s JOIN g USING (id)), c AS (SELECT image_id, (z * 200 + y * 20 + x)::INT AS label, z, y, x FROM v WHERE cls = 1)
  SELECT c.label, c.image_id, round(sqrt((c.z - k.z) ** 2 + (c.y - k.y) ** 2 + (c.x - k.x) ** 2), 6) AS distance, hops, round(hops * 0.102::DOUBLE, 6) AS geodesic FROM c LEFT JOIN k USING (image_id)
  QUALIFY row_number() OVER (PARTITION BY c.image_id, c.label ORDER BY (c.z - k.z) ** 2 + (c.y - k.y) ** 2 + (c.x - k.x) ** 2, k.z, k.y, k.x) = 1""")
def _(spark, d):
    vox = voxels(spark, d)
    field = G.geodesic(G.label_components(vox.where("cls >= 2"), 6))
    return rounded(G.geodesic_to_objects(vox.where("cls = 1").select("image_id", (F.col("z") * 200 + F.col("y") * 20 + F.col("x")).alias("label"), "z", "y", "x"), field, ["label"], 0.102))


@query("g9_thin")
def _(spark, d):
    return G.thin(voxels(spark, d).where("cls >= 2"))


def _blur_sql(source: str, name: str, value: str, sigma: tuple[float, float, float]) -> str:
    """CTEs up to name(VKS, value): the separable Gaussian at the voxels of source."""
    out, before = [], source
    for axis, n, s in zip("zyx", (7, 10, 20), sigma, strict=True):
        taps = ", ".join(f"({k}, {w!r}::DOUBLE)" for k, w in kernel(s))
        rest = ", ".join(c if c != axis else f"{axis} + k AS {axis}" for c in ("image_id", "t", "z", "y", "x"))
        out.append(f"{name}k{axis}(k, w) AS (VALUES {taps}), {name}{axis} AS (SELECT {rest}, sum({value} * w) AS {value} FROM {before}, {name}k{axis} WHERE {axis} + k BETWEEN 0 AND {n - 1} GROUP BY ALL)")
        before = f"{name}{axis}"
    return ", ".join(out) + f", {name} AS (SELECT {VKS}, b.{value} FROM (SELECT {VKS} FROM {source}) JOIN {before} b USING ({VKS}))"


def _cost_sql(name: str, target: str, own: str) -> str:
    """CTEs up to name(VKS, cost): G10 over v, towards the voxels of target, outside those of own."""
    return f"""{name}d AS (SELECT a.image_id, a.t, a.z, a.y, a.x, a.v1, coalesce(sqrt(min((a.z - b.z) ** 2 + (a.y - b.y) ** 2 + (a.x - b.x) ** 2)), 8.0) AS distance FROM v a LEFT JOIN {target} b ON a.image_id = b.image_id GROUP BY ALL),
  {name}g AS (SELECT {VKS}, CASE WHEN o.image_id IS NOT NULL THEN 0.0 ELSE pow(v1 / nullif(max(v1) OVER (PARTITION BY image_id), 0), 0.4) END AS g, coalesce(distance / nullif(max(distance) OVER (PARTITION BY image_id), 0), 0) AS share FROM {name}d LEFT JOIN (SELECT DISTINCT {VKS} FROM {own}) o USING ({VKS})),
  {_blur_sql(f'{name}g', f'{name}b', 'g', (0.25, 10.0, 10.0))}, {name}r AS (SELECT {VKS}, share / (0.2 * a.g + 0.3 * b.g + 1e-6) AS cost FROM {name}g a JOIN {name}b b USING ({VKS})),
  {_blur_sql(f'{name}r', name, 'cost', (0.5, 0.5, 0.5))}"""


@query("g10_path_cost_field", f"WITH {V_SQL}, ow AS (SELECT {VKS} FROM v WHERE cls = 1), tg AS (SELECT {VKS} FROM v WHERE cls = 3), {_cost_sql('c', 'tg', 'ow')} SELECT {VKS}, round(cost, 4) AS cost FROM c")
def _(spark, d):
    vox = saved(voxels(spark, d), "v")
    return rounded(G.path_cost_field(vox.where("cls = 1"), vox.where("cls = 3"), vox, "v1"), 4)


_CUBE27 = "(SELECT dz, dy, dx FROM (SELECT unnest([-1, 0, 1]) AS dz), (SELECT unnest([-1, 0, 1]) AS dy), (SELECT unnest([-1, 0, 1]) AS dx))"


def _paths_sql(name: str, cost: str, body: str, target: str) -> str:
    """CTEs up to name(image_id, t, label, step, z, y, x, cost): G11 from the objects of body(VKS, label) to target."""
    number = "image_id * 1400 + z * 200 + y * 20 + x"
    around = f"{_CUBE27} JOIN {name}c c ON c.image_id = a.image_id AND c.z = a.z + dz AND c.y = a.y + dy AND c.x = a.x + dx"
    return f"""{name}c AS MATERIALIZED (SELECT {VKS}, round(cost, 9) AS cost, {number} AS id FROM {cost}), {name}t AS MATERIALIZED (SELECT DISTINCT image_id, z, y, x, {number} AS id FROM {target}), {name}w AS MATERIALIZED (SELECT DISTINCT {number} AS id FROM {body}),
  {name}e AS MATERIALIZED (SELECT DISTINCT c.id FROM {name}t a, {around} WHERE c.id NOT IN (SELECT id FROM {name}t)),
  {name}n AS MATERIALIZED (SELECT a.id AS was, c.id AS onward FROM {name}c a, {around} WHERE c.id NOT IN (SELECT id FROM {name}t)
    QUALIFY row_number() OVER (PARTITION BY a.id ORDER BY c.cost, CASE WHEN dy = 0 AND dx = 0 AND dz <> 0 THEN 0 ELSE 1 END, c.z, c.y, c.x) = 1),
  {name}f AS MATERIALIZED (SELECT a.image_id * 1000000 + a.label AS who, c.id FROM {body} a, {around} WHERE c.id NOT IN (SELECT id FROM {name}w) QUALIFY row_number() OVER (PARTITION BY a.image_id, a.label ORDER BY c.cost, c.z, c.y, c.x) = 1),
  {name}o AS MATERIALIZED (SELECT was, onward FROM {name}n WHERE onward <> was AND was NOT IN (SELECT id FROM {name}e)),
  {name}q(who, step, id) AS (SELECT who, 0, id FROM {name}f UNION ALL SELECT who, step + 1, onward FROM {name}q JOIN {name}o ON was = id WHERE step < 199),
  {name} AS (SELECT c.image_id, c.t, who % 1000000 AS label, step, c.z, c.y, c.x, c.cost FROM {name}q JOIN {name}c c USING (id) WHERE c.cost <= 20 AND who IN (SELECT who FROM {name}q WHERE id IN (SELECT id FROM {name}e)) AND id NOT IN (SELECT id FROM {name}w))"""


_G11_SQL = f"WITH RECURSIVE {V_SQL}, {_cc_sql('cls = 1', 26, 's')}, tg AS (SELECT {VKS} FROM v WHERE cls = 3), {_cost_sql('co', 'tg', 's')}, {_paths_sql('gp', 'co', 's', 'tg')} SELECT {VKS}, label, step, round(cost, 4) AS cost FROM gp"


@query("g11_greedy_paths", _G11_SQL)
def _(spark, d):
    vox = saved(voxels(spark, d), "v")
    spines = saved(G.label_components(vox.where("cls = 1"), 26), "spines")
    cost = G.path_cost_field(spines, vox.where("cls = 3"), vox, "v1")
    return rounded(G.greedy_paths(cost, spines, vox.where("cls = 3")).select(*VK, "label", "step", "cost"), 4)


@query("g11_greedy_paths_bricks", _G11_SQL)
def _(spark, d):
    vox = saved(voxels(spark, d), "v")
    spines = saved(G.label_components(vox.where("cls = 1"), 26), "spines")
    cost = G.path_cost_field(spines, vox.where("cls = 3"), vox, "v1")
    return rounded(G.greedy_paths(cost, spines, vox.where("cls = 3"), brick=SMALL).select(*VK, "label", "step", "cost"), 4)


def _grow_sql(name: str, seeds: str, mask: str) -> str:
    """CTEs up to name(VKS, label): G3 of seeds(VKS, label) through mask."""
    number = "image_id * 1400 + z * 200 + y * 20 + x"
    return f"""{name}s AS (SELECT {VKS}, label, {number} AS id FROM {seeds}), {name}m AS (SELECT {VKS}, {number} AS id FROM {mask}), {name}n AS (SELECT {VKS}, id FROM {name}s UNION SELECT {VKS}, id FROM {name}m),
  {name}e AS (SELECT a.id AS a, b.id AS b FROM {name}n a JOIN {name}m b ON a.image_id = b.image_id AND abs(a.z - b.z) <= 1 AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1),
  {name}g(id, label) USING KEY (id) AS (SELECT id, label FROM {name}s UNION SELECT e.b, max(g.label) FROM {name}g g JOIN {name}e e ON g.id = e.a LEFT JOIN recurring.{name}g k ON k.id = e.b WHERE k.id IS NULL GROUP BY e.b),
  {name} AS (SELECT {VKS}, label FROM {name}n JOIN {name}g USING (id))"""


_ID = "image_id * 1400 + z * 200 + y * 20 + x"
_G12 = f"""{V_SQL}, {_cc_sql('cls = 1', 26, 's')}, nk AS (SELECT {VKS} FROM v WHERE cls = 2 AND y % 3 = 0), de AS (SELECT {VKS} FROM v WHERE cls = 3), {_grow_sql('gr', 's', 'nk')}, gi AS MATERIALIZED (SELECT {_ID} AS id FROM gr),
  rest AS (SELECT {VKS} FROM nk WHERE {_ID} NOT IN (SELECT id FROM gi)), tg AS (SELECT {VKS} FROM (FROM de UNION FROM rest) WHERE {_ID} NOT IN (SELECT id FROM gi)), {_cost_sql('co', 'tg', 'gr')}, {_paths_sql('gp', 'co', 'gr', 'tg')},
  ex AS (SELECT {VKS}, max(label) AS label FROM (SELECT {VKS}, label FROM gr UNION ALL SELECT {VKS}, label FROM gp) GROUP BY ALL), {_grow_sql('ga', 'ex', 'rest')}"""


@query("g12_neck_generation", f"WITH RECURSIVE {_G12} SELECT {VKS}, label FROM ga WHERE {_ID} NOT IN (SELECT id FROM s) AND {_ID} NOT IN (SELECT {_ID} FROM de)")
def _(spark, d):
    vox = saved(voxels(spark, d), "v")
    return G.neck_generation(G.label_components(vox.where("cls = 1"), 26), vox.where("cls = 2 and y % 3 = 0"), vox.where("cls = 3"), vox, "v1")


_ADJACENT = "a.image_id = b.image_id AND a.label = b.label AND abs(a.z - b.z) <= 1 AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1 AND a.id <> b.id"
#: CTEs up to wk(label, step, id): the walks from st.b back to st.a over l(VKS, label, cost, id, place).
_WALK = f"""ed AS MATERIALIZED (SELECT a.id AS a, b.id AS b, b.cost, a.place FROM l a JOIN l b ON {_ADJACENT}),
  bf(id, c, hops, par) USING KEY (id) AS (SELECT a, 0.0::DOUBLE, 0, -1 FROM st UNION SELECT id, first(c ORDER BY c, hops, par), first(hops ORDER BY c, hops, par), first(par ORDER BY c, hops, par) FROM (SELECT ed.b AS id, round(bf.c + ed.cost, 9) AS c, bf.hops + 1 AS hops, ed.a AS par, k.id AS known, k.c AS kc, k.hops AS kh, k.par AS kp FROM bf JOIN ed ON bf.id = ed.a LEFT JOIN recurring.bf k ON k.id = ed.b)
    WHERE known IS NULL OR (c, hops, par) < (kc, kh, kp) GROUP BY id),
  wk(label, step, id) AS (SELECT label, 0, b FROM st WHERE b IN (SELECT id FROM bf) UNION ALL SELECT wk.label, step + 1, bf.par FROM wk JOIN bf USING (id) WHERE bf.hops > 0)"""
_G13 = f"""{V_SQL}, l AS MATERIALIZED (SELECT {VKS}, ((y // 5) * 4 + x // 5 + 1)::BIGINT AS label, 1.0::DOUBLE + (z * 7 + y * 3 + x) % 5 AS cost, image_id * 1400 + z * 200 + y * 20 + x AS id, z * 200 + y * 20 + x AS place FROM v WHERE cls >= 2),
  st AS MATERIALIZED (SELECT image_id, label, min(id) AS a, max(id) AS b FROM l GROUP BY ALL), {_WALK}"""
_PULL = " * ".join(f"coalesce((SELECT w FROM gk WHERE k = {c} - e{c}), 0)" for c in "zyx")
_MIDLINE = f"""{V_SQL}, {_SHELL}, {_DEPTH}, {_cc_sql('cls >= 2', 6, 's')}, gk(k, w) AS (VALUES {', '.join(f'({k}, {w!r}::DOUBLE)' for k, w in kernel(3.0))}),
  de AS MATERIALIZED (SELECT {VKS}, s.id, label, sqrt(d2) AS d FROM s JOIN dp USING ({VKS})), tp AS MATERIALIZED (SELECT image_id, label, first(z ORDER BY d DESC, id) AS ez, first(y ORDER BY d DESC, id) AS ey, first(x ORDER BY d DESC, id) AS ex, max(d) AS top, min(id) AS a, first(id ORDER BY d DESC, id) AS b FROM de GROUP BY ALL),
  pu AS (SELECT {VKS}, label, id, top - d AS rest, {_PULL} AS g FROM de JOIN tp USING (image_id, label)),
  l AS MATERIALIZED (SELECT {VKS}, label, rest * (1 - 2 * g) + 0.1 * g AS cost, id, z * 200 + y * 20 + x AS place FROM pu), st AS MATERIALIZED (SELECT image_id, label, a, b FROM tp), {_WALK}"""


_G13_SQL = f"WITH RECURSIVE {_G13} SELECT l.image_id, l.t, l.label, step, l.z, l.y, l.x FROM wk JOIN l USING (id)"


@query("g13_least_cost_path", _G13_SQL)
def _(spark, d):
    label = (F.floor(F.col("y") / 5) * 4 + F.floor(F.col("x") / 5) + 1).cast("long")  # objects that touch
    vox = saved(voxels(spark, d).where("cls >= 2").withColumn("label", label).withColumn("cost", 1.0 + (F.col("z") * 7 + F.col("y") * 3 + F.col("x")) % 5), "objects")
    by = ["image_id", "t", "label"]
    ends = [vox.groupBy(*by).agg(f(F.struct("z", "y", "x")).alias("p")).select(*by, "p.*") for f in (F.min, F.max)]
    return G.least_cost_path(vox, *ends)


@query("g13_least_cost_path_bricks", _G13_SQL)
def _(spark, d):
    label = (F.floor(F.col("y") / 5) * 4 + F.floor(F.col("x") / 5) + 1).cast("long")  # objects that touch
    vox = saved(voxels(spark, d).where("cls >= 2").withColumn("label", label).withColumn("cost", 1.0 + (F.col("z") * 7 + F.col("y") * 3 + F.col("x")) % 5), "objects")
    by = ["image_id", "t", "label"]
    ends = [vox.groupBy(*by).agg(f(F.struct("z", "y", "x")).alias("p")).select(*by, "p.*") for f in (F.min, F.max)]
    return G.least_cost_path(vox, *ends, SMALL)


@query("g13_midline", f"WITH RECURSIVE {_MIDLINE} SELECT l.image_id, l.t, l.label, step, l.z, l.y, l.x FROM wk JOIN l USING (id)")
def _(spark, d):
    vox = saved(G.label_components(voxels(spark, d).where("cls >= 2"), 6), "objects")
    cost, deepest = G.midline_cost(vox)
    first = vox.groupBy("image_id", "t", "label").agg(F.min(F.struct("z", "y", "x")).alias("p")).select("image_id", "t", "label", "p.*")
    return G.least_cost_path(cost, first, deepest)


@query("g14_deepest_point", f"WITH {V_SQL}, {_SHELL}, {_DEPTH}, l AS (SELECT *, (y // 5 + 1)::BIGINT AS label FROM dp) SELECT {VKS}, label, round(sqrt(d2), 6) AS distance FROM l QUALIFY row_number() OVER (PARTITION BY image_id, label ORDER BY d2 DESC, z, y, x) = 1")
def _(spark, d):
    return rounded(G.deepest_point(voxels(spark, d).where("cls >= 2").withColumn("label", (F.floor(F.col("y") / 5) + 1).cast("long"))))


_DENSITY = f"""WITH RECURSIVE {V_SQL}, {_cc_sql('cls >= 2', 6, 'e')}, {_cc_sql('cls = 1', 26, 's')},
  dl AS (SELECT image_id, label FROM e GROUP BY ALL HAVING count(*) >= 3), dn AS (SELECT {VKS}, dense_rank() OVER (PARTITION BY image_id ORDER BY label) AS dendrite_id FROM e SEMI JOIN dl USING (image_id, label)),
  st AS (SELECT image_id, dendrite_id, count(*) FILTER (x % 2 = 0) AS length, count(*) AS volume FROM dn GROUP BY ALL),
  sp AS (SELECT image_id, label, count(*) AS area, round(avg(z), 4) AS z, round(avg(y), 4) AS y, round(avg(x), 4) AS x, round(avg(v1), 4) AS mean_int FROM s JOIN v USING ({VKS}) GROUP BY image_id, label HAVING count(*) > 1 AND count(*) < 60),
  nr AS (SELECT sp.*, dendrite_id FROM sp JOIN dn k USING (image_id) WHERE (sp.z - k.z) ** 2 + (sp.y - k.y) ** 2 + (sp.x - k.x) ** 2 <= 16 QUALIFY row_number() OVER (PARTITION BY image_id, sp.label ORDER BY round(sqrt((sp.z - k.z) ** 2 + (sp.y - k.y) ** 2 + (sp.x - k.x) ** 2), 9), k.z, k.y, k.x) = 1)
  SELECT image_id, dendrite_id, count(*) AS total_spines, round(avg(area), 6) AS avg_area, round(avg(mean_int) + 1e-7, 2) AS avg_mean_int, any_value(length) AS length, any_value(volume) AS volume, round(count(*) / nullif(any_value(length), 0), 6) AS spines_per_um, round(count(*) / any_value(volume), 6) AS spines_per_um3
  FROM nr JOIN st USING (image_id, dendrite_id) GROUP BY image_id, dendrite_id"""


@query("spine_density_per_dendrite", _DENSITY)
def spine_density(spark, d):
    """The flagship: components, filters, measures, nearest dendrite, summary."""
    vox = saved(voxels(spark, d), "v")
    grid = G.Grid(vox)
    spines = G.label_components(vox.where("cls = 1"), 26, grid=grid, carry=("v1",))
    dendrites = G.label_components(vox.where("cls >= 2"), 6, grid=grid, least=3)
    dendrites = saved(dendrites.withColumnRenamed("label", "dendrite_id"), "dendrites")
    props = A.region_props(spines, "v1")
    kept = saved(P.filter_by_volume(props, 1, 60).select("image_id", "label", "area", *[F.round(f"centroid_{c}", 4).alias(c) for c in "zyx"], F.round("mean_int", 4).alias("mean_int")), "kept-spines")
    near = J.nearest_point(kept, dendrites, ["label"], ["dendrite_id"], max_dist=4.0).where("distance is not null")
    stats = dendrites.groupBy("image_id", "dendrite_id").agg(F.count_if(F.col("x") % 2 == 0).alias("length"), F.count("*").alias("volume"))
    table = kept.join(near.select("image_id", "label", "dendrite_id"), ["image_id", "label"])
    out = A.dendrite_summary(table, stats.withColumns({c: F.col(c).cast("double") for c in ("length", "volume")}), ["area", "mean_int"])
    out = out.withColumn("avg_mean_int", F.round(F.col("avg_mean_int") + 1e-7, 2))
    return rounded(out).withColumns({c: F.col(c).cast("long") for c in ("length", "volume")})
