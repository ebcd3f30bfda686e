"""Registered queries: filters, resampling, patches and extension points."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from voxlake.operators import filters as L
from voxlake.operators.projections import VK
from voxlake.plans.register import query, rounded
from voxlake.sources.fixtures import OV_SQL, P_SQL, V_SQL, object_voxels, patches, voxels

PK = ["image_id", "y", "x"]
VKS = "image_id, t, z, y, x"


def _taps(name: str, rows) -> str:
    return f"{name}(k, w) AS (VALUES {', '.join(f'({k}, {w!r}::DOUBLE)' for k, w in rows)})"


def _plane(d_spark, d):
    return patches(d_spark, d).select(*PK, "v")


_K = _taps("k", L.kernel(0.8))
_BLUR = "gy AS (SELECT image_id, y + k AS y, x, sum(v * w) AS v FROM p, k GROUP BY 1, 2, 3), gx AS (SELECT image_id, y, x + k AS x, sum(v * w) AS v FROM gy, k GROUP BY 1, 2, 3)"


@query("l1_gaussian", f"WITH {P_SQL}, {_K}, {_BLUR} SELECT p.image_id, p.y, p.x, round(gx.v, 6) AS v FROM p JOIN gx USING (image_id, y, x)")
def _(spark, d):
    return rounded(L.gaussian(_plane(spark, d), "v", {"y": 0.8, "x": 0.8}, PK))


def _weights(name, n_in, n_out, order=1):
    return f"{name}(o, i, w) AS (VALUES {', '.join(f'({o}, {i}, {w!r}::DOUBLE)' for o, i, w in L.axis_weights(n_in, n_out, order))})"


@query("l2_resample", f"WITH {P_SQL}, {_weights('a', 8, 12)}, {_weights('b', 8, 5)}, r AS (SELECT image_id, o AS y, x, sum(w * v) AS v FROM p JOIN a ON p.y = i GROUP BY 1, 2, 3) SELECT image_id, y, o AS x, round(sum(w * v), 6) AS v FROM r JOIN b ON r.x = i GROUP BY 1, 2, 3")
def _(spark, d):
    return rounded(L.resample(_plane(spark, d), "v", {"y": (8, 12), "x": (8, 5)}, PK))


def _table(name, rows):
    return f"{name}(o, i, w) AS (VALUES {', '.join(f'({o}, {i}, {w!r}::DOUBLE)' for o, i, w in rows)})"


@query("l2_resample_cubic", f"WITH {P_SQL}, {_table('a', L.axis_weights(8, 12, 3, True))}, {_table('b', L.axis_weights(8, 3, 3, True))}, r AS (SELECT image_id, o AS y, x, sum(w * v) AS v FROM p JOIN a ON p.y = i GROUP BY 1, 2, 3) SELECT image_id, y, o AS x, round(sum(w * v), 6) AS v FROM r JOIN b ON r.x = i GROUP BY 1, 2, 3")
def _(spark, d):
    return rounded(L.resample(_plane(spark, d), "v", {"y": (8, 12), "x": (8, 3)}, PK, 3, True))


@query("l2_resample_nearest", f"WITH {V_SQL} SELECT image_id, t, z, y, x2::INT AS x, cls::DOUBLE AS cls FROM v, (SELECT unnest(range(40)) AS x2) WHERE x = x2 // 2")
def _(spark, d):
    return L.resample(voxels(spark, d).select(*VK, F.col("cls").cast("double").alias("cls")), "cls", {"x": (20, 40)}, VK, 0)


@query("l3_unsharp", f"WITH {P_SQL}, {_K}, {_BLUR}, s AS (SELECT p.image_id, p.y, p.x, least(1.0, greatest(0.0, p.v + 1.5 * (p.v - gx.v))) AS v FROM p JOIN gx USING (image_id, y, x)) SELECT image_id, y, x, round(coalesce((v - min(v) OVER w) / nullif(max(v) OVER w - min(v) OVER w, 0), 0), 5) AS v FROM s WINDOW w AS (PARTITION BY image_id)")
def _(spark, d):
    return rounded(L.unsharp(_plane(spark, d), "v", {"y": 0.8, "x": 0.8}, 1.5, PK, ["image_id"]), 5)


_AROUND = "(SELECT unnest([-1, 0, 1])::INT AS k)"
_OPEN = ", ".join(f"{name} AS (SELECT image_id, y + {'k' if axis == 'y' else '0'} AS y, x + {'k' if axis == 'x' else '0'} AS x, {f}(v) AS v FROM {source}, {_AROUND} WHERE {axis} + k BETWEEN 0 AND 7 GROUP BY 1, 2, 3)" for name, source, f, axis in (("lo1", "p", "min", "y"), ("lo2", "lo1", "min", "x"), ("hi1", "lo2", "max", "y"), ("hi2", "hi1", "max", "x")))


@query("l4_subtract_background", f"WITH {P_SQL}, {_OPEN} SELECT p.image_id, p.y, p.x, round(p.v - hi2.v, 6) AS v FROM p JOIN hi2 USING (image_id, y, x)")
def _(spark, d):
    return rounded(L.subtract_background(_plane(spark, d), "v", 1, PK))


_BALL = ", ".join(f"({i - half}, {j - half}, {float(h)!r}::DOUBLE)" for cap, half in (L.ball(3),) for (i, j), h in np.ndenumerate(cap) if np.isfinite(h))


@query("l4_rolling_ball", f"WITH {P_SQL}, b(dy, dx, h) AS (VALUES {_BALL}), e AS (SELECT image_id, y - dy AS y, x - dx AS x, min(v - h) AS top FROM p, b GROUP BY ALL), o AS (SELECT image_id, y + dy AS y, x + dx AS x, max(top + h) AS top FROM e, b GROUP BY ALL) SELECT p.image_id, p.y, p.x, round(p.v - o.top, 6) AS v FROM p JOIN o USING (image_id, y, x)")
def _(spark, d):
    return rounded(L.subtract_background(_plane(spark, d), "v", 3, PK, "ball"))


@query("l5_degrade", f"WITH {P_SQL}, {_weights('a', 8, 4)}, {_weights('b', 4, 8)}, r AS (SELECT image_id, y, o AS x, sum(w * v) AS v FROM p JOIN a ON p.x = i GROUP BY 1, 2, 3) SELECT image_id, y, o AS x, round(sum(w * v), 6) AS v FROM r JOIN b ON r.x = i GROUP BY 1, 2, 3")
def _(spark, d):
    return rounded(L.degrade(_plane(spark, d), "v", "x", 8, 2, PK))


_TILES = "g AS (SELECT iz, iy, ix FROM (SELECT unnest([0, 1]) AS iz), (SELECT unnest([0, 1]) AS iy), (SELECT unnest([0, 1, 2, 3]) AS ix))"


@query("l6_extract_tiles", f"WITH {V_SQL}, {_TILES} SELECT {VKS}, v1, ((iz * 2 + iy) * 4 + ix)::INT AS tile, z - iz * 3 AS dz, y - iy * 4 AS dy, x - ix * 5 AS dx FROM v, g WHERE z - iz * 3 BETWEEN 0 AND 3 AND y - iy * 4 BETWEEN 0 AND 5 AND x - ix * 5 BETWEEN 0 AND 4")
def _(spark, d):
    return L.extract_tiles(voxels(spark, d).select(*VK, "v1"), (7, 10, 20), (4, 6, 5), (3, 4, 5))


@query("l7_signal_patches", f"WITH {V_SQL} SELECT {VKS}, v1, y // 5 AS py, x // 5 AS px FROM v QUALIFY max(v1) OVER (PARTITION BY image_id, z, y // 5, x // 5) >= 60000")
def _(spark, d):
    return L.signal_patches(voxels(spark, d).select(*VK, "v1"), "v1", 5, 60000.0)


@query("l8_foreground_patches", f"WITH {V_SQL}, q AS (SELECT image_id, quantile_cont(v1, 0.999) AS q FROM v GROUP BY 1), p AS (SELECT image_id, t, z, y // 5 AS py, x // 5 AS px, max(v1) AS top FROM v GROUP BY ALL) SELECT image_id, t, z, py, px, top FROM p JOIN q USING (image_id) WHERE top > 0.4 * q QUALIFY row_number() OVER (PARTITION BY image_id ORDER BY md5(image_id || '/' || t || '/' || z || '/' || py || '/' || px)) <= 8")
def _(spark, d):
    return L.foreground_patches(voxels(spark, d), "v1", 5, 8)


_L9 = """r AS (SELECT *, greatest(v * 100, 0) AS rate, ('0x' || substr(md5('7/' || image_id || '/' || y || '/' || x || '/1'), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS u FROM p),
  s AS (SELECT *, unnest(range(0, CAST(floor(rate + 12 * sqrt(rate) + 20) AS BIGINT))) AS k FROM r),
  c AS (SELECT image_id, y, x, u, k, sum(CASE WHEN k = 0 THEN exp(-rate) WHEN rate > 0 THEN exp(k * ln(rate) - rate - lgamma(k + 1)) ELSE 0 END) OVER (PARTITION BY image_id, y, x ORDER BY k) AS cdf FROM s)"""


@query("l9_poisson_noise", f"WITH {P_SQL}, {_L9} SELECT image_id, y, x, count(*) FILTER (cdf < u)::DOUBLE / 100 AS v FROM c GROUP BY ALL")
def _(spark, d):
    return L.poisson_noise(_plane(spark, d), "v", 100.0, 7)


#: The same stream of numbers; the first try that holds.
_MANY = """r AS (SELECT image_id, t, z, y, x, v1 AS mu, 0.931 + 2.53 * sqrt(v1) AS b FROM v WHERE v1 > 128),
  h AS (SELECT *, md5('7/' || image_id || '/' || t || '/' || z || '/' || y || '/' || x || '/' || k) AS m FROM r, (SELECT unnest(range(1, 25)) AS k)),
  w AS (SELECT *, ('0x' || substr(m, 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 - 0.5 AS u, greatest(('0x' || substr(m, 14, 13))::BIGINT::DOUBLE / 4503599627370496.0, 1e-300) AS vv, -0.059 + 0.02483 * b AS a FROM h),
  g AS (SELECT *, greatest(0.5 - abs(u), 1e-16) AS us, floor((2 * a / greatest(0.5 - abs(u), 1e-16) + b) * u + mu + 0.43) AS n FROM w),
  o AS (SELECT *, row_number() OVER (PARTITION BY image_id, t, z, y, x ORDER BY k) AS place FROM g WHERE us >= 0.07 AND vv <= 0.9277 - 3.6224 / (b - 2)
    OR n >= 0 AND NOT (us < 0.013 AND vv > us) AND ln(vv * (1.1239 + 1.1328 / (b - 3.4)) / (a / (us * us) + b)) <= n * ln(mu) - mu - lgamma(CASE WHEN n >= 0 THEN n + 1 ELSE 1 END))"""


@query("l9_poisson_large", f"WITH {V_SQL}, {_MANY} SELECT {VKS}, n AS v1 FROM o WHERE place = 1")
def _(spark, d):
    return L.poisson_noise(voxels(spark, d).where("v1 > 128").select(*VK, "v1"), "v1", 1.0, 7)


def _axis(source: str, name: str, weights: str, axis: str) -> str:
    rest = ", ".join(c for c in ("image_id", "t", "z", "y", "x") if c != axis)
    return f"{name} AS (SELECT {rest}, o AS {axis}, sum(w * v1) AS v1 FROM {source} JOIN {weights} ON {axis} = i GROUP BY {rest}, o)"


_KINDS = " UNION ALL ".join(f"SELECT image_id, t, '{kind}' AS kind, {a} AS slice, {b} AS row, {c} AS col, round(v1 + 1e-6, 3) AS v1 FROM {source}" for kind, source, a, b, c in (("xy", "v", "z", "y", "x"), ("xy_degraded", "du", "z", "y", "x"), ("xz", "tz", "y", "z", "x"), ("yz", "tz", "x", "z", "y")))


@query("l10_training_slices", f"WITH {V_SQL}, {_weights('wt', 7, 14)}, {_weights('wd', 20, 10)}, {_weights('wu', 10, 20)}, {_axis('v', 'tz', 'wt', 'z')}, {_axis('v', 'dd', 'wd', 'x')}, {_axis('dd', 'du', 'wu', 'x')} {_KINDS}")
def _(spark, d):
    return rounded(L.training_slices(voxels(spark, d), "v1", (7, 10, 20), 2).withColumn("v1", F.col("v1") + 1e-6), 3)


@query("x1_x5_expressions", f"WITH {V_SQL} SELECT {VKS}, round(sqrt(z * z + y * y + x * x) * v2 / 3, 6) AS w FROM v")
def _(spark, d):
    return rounded(voxels(spark, d).select(*VK, (F.sqrt(F.col("z") ** 2 + F.col("y") ** 2 + F.col("x") ** 2) * F.col("v2") / 3).alias("w")))


@query("x2_map_blocks", f"WITH {V_SQL} SELECT image_id, t, count(*) AS n, round(sum(v1), 2) AS total FROM v GROUP BY ALL")
def _(spark, d):
    def f(part):
        return part.groupby(["image_id", "t"], as_index=False).agg(n=("v1", "size"), total=("v1", "sum"))

    return rounded(L.map_blocks(voxels(spark, d).select(*VK, "v1"), ["image_id", "t"], f, "image_id long, t int, n long, total double"), 2)


@query("x3_map_overlap", f"WITH {V_SQL} SELECT a.image_id, a.z, a.y, a.x, count(*) AS around FROM v a JOIN v b ON a.image_id = b.image_id AND abs(a.z - b.z) + abs(a.y - b.y) + abs(a.x - b.x) <= 1 GROUP BY ALL")
def _(spark, d):
    def f(part):
        at = {(z, y, x) for z, y, x in zip(part.z, part.y, part.x, strict=True)}
        own = part[part.core].copy()
        own["around"] = [sum((z + a, y + b, x + c) in at for a, b, c in ((0, 0, 0), (1, 0, 0), (-1, 0, 0), (0, 1, 0), (0, -1, 0), (0, 0, 1), (0, 0, -1))) for z, y, x in zip(own.z, own.y, own.x, strict=True)]
        return own[["image_id", "z", "y", "x", "around"]]

    return L.map_overlap(voxels(spark, d).select(*VK), (4, 5, 10), 1, f, "image_id long, z int, y int, x int, around long")


_X4 = f"WITH {OV_SQL} SELECT image_id, t, label, CASE WHEN count(*) >= 4 THEN count(*)::DOUBLE END AS size, CASE WHEN count(*) >= 4 THEN round(max(v1) - min(v1), 6) END AS span, CASE WHEN count(*) < 4 THEN 'ValueError' END AS error FROM ov GROUP BY ALL"


@query("x4_map_objects", _X4)
def _(spark, d):
    def f(part):
        if len(part) < 4:
            raise ValueError("too few voxels")
        return {"size": float(len(part)), "span": float(part.v1.max() - part.v1.min())}

    return rounded(L.map_objects(object_voxels(spark, d).select(*VK, "label", "v1"), f, ["size", "span"]))


@query("x4_map_objects_in_parts", _X4)
def _(spark, d):
    def part(rows):
        return {"n": len(rows), "low": float(rows.v1.min()), "high": float(rows.v1.max())}

    def merge(states):
        return {"n": int(states.n.sum()), "low": float(states.low.min()), "high": float(states.high.max())}

    def finish(state):
        if state["n"] < 4:
            raise ValueError("too few voxels")
        return {"size": float(state["n"]), "span": state["high"] - state["low"]}

    vox = object_voxels(spark, d).select(*VK, "label", "v1")
    return rounded(L.map_objects_in_parts(vox, part, merge, finish, "n long, low double, high double", ["size", "span"], (4, 3, 4), fan=2))


@query("x6_blocks_to_rows", f"WITH {P_SQL} SELECT image_id, 0 AS t, 0 AS z, y, x, round(v, 6) AS v FROM p WHERE v <> 0")
def _(spark, d):
    from voxlake.sources.fixtures import table

    data = table(spark, d, "embeddings").select(F.col("vec_id").cast("long").alias("image_id"), F.lit(0).alias("t"), F.lit(0).alias("z0"), F.lit(0).alias("y0"), F.lit(0).alias("x0"), F.lit(8).alias("ny"), F.lit(8).alias("nx"), F.col("embedding").cast("array<double>").alias("data"))
    return rounded(L.blocks_to_rows(data))
