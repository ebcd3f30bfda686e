"""Filtering, resampling and patches."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxlake.operators.bricks import dealt
from voxlake.operators.dense import convolve, dense_map, running_least
from voxlake.operators.projections import VK
from voxlake.plans.scratch import discard, saved


def kernel(sigma: float, truncate: float = 4.0) -> list[tuple[int, float]]:
    """(offset, weight) of a normalised Gaussian."""
    r = max(1, int(truncate * sigma + 0.5))
    k = np.arange(-r, r + 1)
    w = np.exp(-(k**2) / (2 * sigma**2))
    return list(zip(k.tolist(), (w / w.sum()).tolist(), strict=True))


def gaussian(vox: DataFrame, value: str, sigma: dict[str, float], keys: list[str]) -> DataFrame:
    """L1: separable Gaussian of a sparse field (missing voxels are 0), at the voxels that exist; keys: the coordinates and image.

    Bricks with a halo as wide as the kernel become arrays; one line pass an axis.
    """
    taps = {axis: kernel(s) for axis, s in sigma.items()}

    def blur(arrays: list[np.ndarray]) -> list[np.ndarray]:
        for i, t in enumerate(taps.values(), 1):
            arrays = [convolve(a, t, i) for a in arrays]
        return arrays

    return dense_map(vox, [value], keys, {axis: t[-1][0] for axis, t in taps.items()}, blur, [value])


def _mirror(i: np.ndarray, n: int) -> np.ndarray:
    i = np.mod(i, 2 * n)
    return np.where(i < n, i, 2 * n - 1 - i)


#: Coefficients of the cubic B-spline through values: the inverse of the taps 1/6, 4/6, 1/6 decays by its pole at every step, so 28 on each side are exact to 1e-15.
_POLE = math.sqrt(3) - 2
_SPLINE = [(k, -6 * _POLE / (1 - _POLE**2) * _POLE ** abs(k)) for k in range(-28, 29)]


def _spread_taps(out: np.ndarray, source: np.ndarray, w: np.ndarray, taps: list[tuple[int, float]], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights (out, source, w) after a symmetric filter of the source, mirrored about its edges; as many per line as the taps reach."""
    k, v = (np.array(x) for x in zip(*taps, strict=True))
    place = (out[:, None] * n + _mirror(source[:, None] + k, n)).ravel()
    names, which = np.unique(place, return_inverse=True)
    return names // n, names % n, np.bincount(which, weights=(w[:, None] * v).ravel())


def axis_weights(n_in: int, n_out: int, order: int, anti_alias: bool = False) -> list[tuple[int, int, float]]:
    """(out, in, weight) of nearest (0), linear (1) or cubic B-spline (3) resampling with centres aligned and mirrored edges.

    anti_alias: a Gaussian of sigma (n_in / n_out - 1) / 2 goes first when an axis shrinks.
    """
    rows = []
    if order == 3 or anti_alias and n_out < n_in:
        at = (np.arange(n_out) + 0.5) * n_in / n_out - 0.5
        low, k = np.floor(at).astype(int)[:, None], np.array([-1, 0, 1, 2])
        d = np.abs(at[:, None] - (low + k))
        cubic = np.where(d < 1, 2 / 3 - d**2 + d**3 / 2, np.maximum(2 - d, 0) ** 3 / 6)
        w = cubic if order == 3 else np.maximum(0.0, 1 - d) if order == 1 else (np.floor(at[:, None] + 0.5) == low + k).astype(float)
        out, source = np.repeat(np.arange(n_out), 4), _mirror(low + k, n_in).ravel()
        out, source, w = out[w.ravel() != 0], source[w.ravel() != 0], w.ravel()[w.ravel() != 0]
        if order == 3:
            out, source, w = _spread_taps(out, source, w, _SPLINE, n_in)
        if anti_alias and n_out < n_in:
            out, source, w = _spread_taps(out, source, w, kernel((n_in / n_out - 1) / 2), n_in)
        keep = np.abs(w) > 1e-12
        return list(zip(out[keep].tolist(), source[keep].tolist(), w[keep].tolist(), strict=True))
    for o in range(n_out):
        at = (o + 0.5) * n_in / n_out - 0.5
        if order == 0:
            rows.append((o, min(n_in - 1, max(0, math.floor(at + 0.5))), 1.0))
            continue
        low = math.floor(at)
        for i, w in ((low, 1 - (at - low)), (low + 1, at - low)):
            if w > 0:
                rows.append((o, min(n_in - 1, max(0, i)), w))
    return rows


def resample(vox: DataFrame, value: str, sizes: dict[str, tuple[int, int]], keys: list[str], order: int = 1, anti_alias: bool = False) -> DataFrame:
    """L2: each axis by a small weight table (order 0, 1 or 3); missing voxels are 0."""
    out = vox.select(*keys, F.col(value).alias("v"))
    for axis, (n_in, n_out) in sizes.items():
        table = out.sparkSession.createDataFrame(axis_weights(n_in, n_out, order, anti_alias), "o int, i int, w double")
        rest = [c for c in keys if c != axis]
        out = out.join(F.broadcast(table), F.col(axis) == F.col("i")).groupBy(*rest, F.col("o").alias(axis)).agg(F.sum(F.col("w") * F.col("v")).alias("v"))
    return out.select(*keys, F.col("v").alias(value))


def unsharp(vox: DataFrame, value: str, sigma: dict[str, float], amount: float, keys: list[str], by: list[str]) -> DataFrame:
    """L3: v + amount (v - blur), clipped to 0...1 and stretched to the range of its group."""
    from voxlake.operators.aggregates import minmax_normalise

    blur = gaussian(vox, value, sigma, keys).withColumnRenamed(value, "blur")
    sharp = vox.join(blur, keys).withColumn(value, F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col(value) + amount * (F.col(value) - F.col("blur"))))).drop("blur")
    return minmax_normalise(sharp, value, by)


def ball(radius: float, trim: float = 0.24) -> tuple[np.ndarray, int]:
    """Heights of the cap of a ball over a square of pixels, its rim (a share `trim` of the radius) left out, and the square's half width; -inf outside the ball."""
    half = max(1, round(radius - int(trim * radius)))
    d = np.arange(-half, half + 1)
    rest = radius**2 - d[:, None] ** 2 - d[None, :] ** 2
    return np.where(rest > 0, np.sqrt(np.maximum(rest, 0)), -np.inf), half


def _rolled(a: np.ndarray, cap: np.ndarray, half: int) -> np.ndarray:
    """Grey opening of planes (brick, y, x) by a ball's cap: how high the ball gets from below; empty cells (infinity) neither hold nor carry it."""
    ny, nx = a.shape[1:]
    top = np.full((len(a), ny + 2 * half, nx + 2 * half), np.inf)
    steps = [(i, j, h) for (i, j), h in np.ndenumerate(cap) if np.isfinite(h)]
    for i, j, h in steps:  # the ball's middle, also beyond the edges
        into = top[:, 2 * half - i : 2 * half - i + ny, 2 * half - j : 2 * half - j + nx]
        np.minimum(into, a - h, out=into)
    out = np.full_like(a, -np.inf)
    for i, j, h in steps:
        np.maximum(out, top[:, 2 * half - i : 2 * half - i + ny, 2 * half - j : 2 * half - j + nx] + h, out=out)
    return out


def subtract_background(vox: DataFrame, value: str, radius: int, keys: list[str], shape: str = "flat") -> DataFrame:
    """L4: value minus its background within planes of y and x (radius 0: unchanged).

    flat: grey opening over a square window of existing voxels, by running minima (the same work for every radius).  ball: a ball of that radius rolls below
    the surface.  Large balls roll over the least values of squares of `shrink` pixels, by a ball as much smaller, and the
    background is linear between the squares' middles, so the ball is at most some 20 squares wide whatever its radius.
    """
    if not radius:
        return vox.select(*keys, value)
    if shape == "flat":

        def opened(arrays: list[np.ndarray]) -> list[np.ndarray]:
            low = running_least(running_least(arrays[0], radius, 1), radius, 2)
            low = np.where(np.isfinite(arrays[0]), -low, np.inf)
            return [-running_least(running_least(low, radius, 1), radius, 2)]

        floor = dense_map(vox, [value], keys, {"y": 2 * radius, "x": 2 * radius}, opened, ["floor"], np.inf)
    else:
        floor = _ball_floor(vox, value, radius, keys)
    return vox.select(*keys, value).join(floor, keys).withColumn(value, F.col(value) - F.col("floor")).drop("floor")


def ball_shrink(radius: int) -> int:
    """Side of the squares over which a ball rolls: it keeps a radius of about 10 squares."""
    return max(1, radius // 10)


def _ball_floor(vox: DataFrame, value: str, radius: int, keys: list[str]) -> DataFrame:
    rest, n = [c for c in keys if c not in ("y", "x")], ball_shrink(radius)
    cap, half = ball(radius / n)
    small = vox.groupBy(*rest, *[F.floor(F.col(c) / n).cast("int").alias(c) for c in "yx"]).agg(F.min(value).alias("floor"))
    small = dense_map(small, ["floor"], keys, {"y": 2 * half, "x": 2 * half}, lambda a: [_rolled(a[0], cap, half)], ["floor"], np.inf)
    if n == 1:
        return small
    rows = vox.select(*keys)
    for c in "yx":
        at = (F.col(c) + 0.5) / n - 0.5
        rows = rows.withColumn(f"p{c}", F.explode(F.array(F.struct(F.floor(at).cast("int").alias("i"), (1 - (at - F.floor(at))).alias("w")), F.struct((F.floor(at) + 1).cast("int").alias("i"), (at - F.floor(at)).alias("w"))))).where(F.col(f"p{c}.w") > 0)
    near = small.select(*rest, F.col("y").alias("sy"), F.col("x").alias("sx"), "floor")
    rows = rows.select(*keys, F.col("py.i").alias("sy"), F.col("px.i").alias("sx"), (F.col("py.w") * F.col("px.w")).alias("w")).join(near, [*rest, "sy", "sx"])  # squares that do not exist have no weight
    return rows.groupBy(*keys).agg((F.sum(F.col("w") * F.col("floor")) / F.sum("w")).alias("floor"))


def degrade(vox: DataFrame, value: str, axis: str, size: int, scale: int, keys: list[str]) -> DataFrame:
    """An axis down and up again."""
    small = max(1, size // scale)
    return resample(resample(vox, value, {axis: (size, small)}, keys), value, {axis: (small, size)}, keys)


def extract_tiles(vox: DataFrame, shape: tuple[int, int, int], size: tuple[int, int, int], stride: tuple[int, int, int]) -> DataFrame:
    """Every voxel once per tile that covers it; a tail shorter than one stride is not covered."""
    out, counts = vox, []
    for c, n, s, d in zip("zyx", shape, size, stride, strict=True):
        s, d = min(s, n), min(d, n)
        most = (n - s) // d
        counts.append(most + 1)
        first = F.greatest(F.lit(0), F.ceil((F.col(c) - s + 1) / d)).cast("int")
        last = F.least(F.lit(most), F.floor(F.col(c) / d)).cast("int")
        out = out.withColumn(f"i{c}", F.explode(F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))))
    strides = [min(d, n) for n, d in zip(shape, stride, strict=True)]
    index = (F.col("iz") * counts[1] + F.col("iy")) * counts[2] + F.col("ix")
    return out.withColumn("tile", index).withColumns({f"d{c}": F.col(c) - F.col(f"i{c}") * d for c, d in zip("zyx", strides, strict=True)}).drop("iz", "iy", "ix")


def signal_patches(vox: DataFrame, value: str, size: int, threshold: float) -> DataFrame:
    """Voxels of the patches with a value of at least the threshold."""
    keyed = vox.withColumns({"py": F.floor(F.col("y") / size).cast("int"), "px": F.floor(F.col("x") / size).cast("int")})
    keys = ["image_id", "t", "z", "py", "px"]
    return keyed.join(keyed.groupBy(*keys).agg(F.max(value).alias("m")).where(F.col("m") >= threshold).select(*keys), keys, "left_semi")


def foreground_patches(vox: DataFrame, value: str, size: int, n: int, share: float = 0.4, top: float = 0.999) -> DataFrame:
    """N patches per image, by hash, among those whose maximum exceeds a share of the image's high percentile."""
    from voxlake.operators.aggregates import percentiles

    level = percentiles(vox, value, top, top, ["image_id"]).select("image_id", F.col("p_high").alias("p"))
    patch = vox.groupBy("image_id", "t", "z", F.floor(F.col("y") / size).cast("int").alias("py"), F.floor(F.col("x") / size).cast("int").alias("px")).agg(F.max(value).alias("top"))
    good = patch.join(level, "image_id").where(F.col("top") > share * F.col("p"))
    order = F.md5(F.concat_ws("/", "image_id", "t", "z", "py", "px"))
    return good.withColumn("r", F.row_number().over(Window.partitionBy("image_id").orderBy(order))).where(F.col("r") <= n).select("image_id", "t", "z", "py", "px", "top")


SMALL = 128.0  # rates up to here are drawn by steps of the distribution function, 284 at most
TRIES = 24  # of the rejection; each fails for fewer than one draw in six


def log_factorial(k: Column) -> Column:
    """ln k! of whole doubles: a table up to 15, then four terms of Stirling's series (below 1e-12 off)."""
    table = F.array(*[F.lit(math.lgamma(i + 1)) for i in range(16)])
    n = F.greatest(k, F.lit(16.0))
    series = (n + 0.5) * F.log(n) - n + 0.5 * math.log(2 * math.pi) + 1 / (12 * n) - 1 / (360 * n**3) + 1 / (1260 * n**5) - 1 / (1680 * n**7)
    return F.when(k < 16, table[F.least(F.greatest(k, F.lit(0.0)), F.lit(15.0)).cast("int")]).otherwise(series)


def poisson_noise(vox: DataFrame, value: str, scale: float, seed: int) -> DataFrame:
    """Poisson counts around value * scale, divided by scale; each voxel's draw depends on its place and the seed alone.

    Uniform numbers are 52 bits each of md5(seed / place / number of the try).  Rates up to SMALL count the steps of the distribution function below one
    number; larger ones take the first try of a transformed rejection that holds, so the work does not grow with the rate (after
    TRIES failures, fewer than one voxel in 10^18, the rounded rate).  Null and negative values have rate 0.
    """
    rate = F.greatest(F.coalesce(F.col(value) * scale, F.lit(0.0)), F.lit(0.0))
    name = F.concat_ws("/", F.lit(seed), *[c for c in VK if c in vox.columns])
    mu = F.col("rate_")
    uniform = lambda k, at: F.conv(F.substring(F.md5(F.concat_ws("/", name, k)), at, 13), 16, 10).cast("double") / float(1 << 52)
    most = (mu + 12 * F.sqrt(mu) + 20).cast("int")
    zero = F.struct(F.exp(-mu).alias("p"), F.exp(-mu).alias("cdf"), F.lit(0).alias("n"))

    def step(s: Column, i: Column) -> Column:
        p = s["p"] * mu / i
        return F.struct(p.alias("p"), (s["cdf"] + p).alias("cdf"), F.when(s["cdf"] < F.col("u_"), i).otherwise(s["n"]).alias("n"))

    few = F.aggregate(F.sequence(F.lit(1), most), zero, step, lambda s: s["n"].cast("double"))
    b = 0.931 + 2.53 * F.sqrt(mu)
    a = -0.059 + 0.02483 * b

    def attempt(found: Column, k: Column) -> Column:
        u, v = uniform(k, 1) - 0.5, F.greatest(uniform(k, 14), F.lit(1e-300))
        us = F.greatest(0.5 - F.abs(u), F.lit(1e-16))
        n = F.floor((2 * a / us + b) * u + mu + 0.43).cast("double")
        sure = (us >= 0.07) & (v <= 0.9277 - 3.6224 / (b - 2))
        hold = (n >= 0) & ~((us < 0.013) & (v > us)) & (F.log(v * (1.1239 + 1.1328 / (b - 3.4)) / (a / (us * us) + b)) <= n * F.log(mu) - mu - log_factorial(n))
        return F.when(found >= 0, found).when(sure | hold, n).otherwise(F.lit(-1.0))

    many = F.aggregate(F.sequence(F.lit(1), F.lit(TRIES)), F.lit(-1.0), attempt, lambda n: F.when(n >= 0, n).otherwise(F.rint(mu)))
    rows = vox.withColumn("rate_", rate).withColumn("u_", uniform(F.lit(1), 1))
    return rows.withColumn(value, F.when(mu <= SMALL, few).otherwise(many) / scale).drop("rate_", "u_")


def training_slices(vox: DataFrame, value: str, sizes: tuple[int, int, int], scale: int) -> DataFrame:
    """Xy slices, degraded xy slices, and xz and yz slices stretched along z, as (kind, slice, row, col)."""
    nz, ny, nx = sizes
    base = vox.select(*VK, value)
    tall = resample(base, value, {"z": (nz, nz * scale)}, VK)

    def named(df: DataFrame, kind: str, order: str) -> DataFrame:
        return df.select("image_id", "t", F.lit(kind).alias("kind"), *[F.col(c).alias(n) for c, n in zip(order, ("slice", "row", "col"), strict=True)], value)

    return named(base, "xy", "zyx").unionByName(named(degrade(base, value, "x", nx, scale, VK), "xy_degraded", "zyx")).unionByName(named(tall, "xz", "yzx")).unionByName(named(tall, "yz", "xzy"))


GROUPED = 1 << 15  # rows that a task gathers before it works on their groups, whole groups at least


def map_groups(df: DataFrame, keys: list[str], f, schema: str, given: list[str] | None = None) -> DataFrame:
    """f(keys of a group, pandas frame of its columns `given`) -> list of row dicts, or a frame, for every group: a task takes many groups at once, so small ones cost no hand-over each."""

    given = given or df.columns

    def gathered(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for part in parts:
            if part.empty:
                continue
            held, n = [*held, part], n + len(part)
            if n >= GROUPED and held[0]["brick"].iloc[0] != (last := part["brick"].iloc[-1]):
                every = pd.concat(held, ignore_index=True)
                cut = int((every["brick"] == last).to_numpy().argmax())
                yield every.iloc[:cut]
                held, n = [every.iloc[cut:]], len(every) - cut
        if held:
            yield pd.concat(held, ignore_index=True)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some in gathered(parts):
            rows, frames = [], []
            for who, part in some.groupby(keys, sort=False, dropna=False)[given]:
                part.index = pd.RangeIndex(len(part))
                found = f(who, part)
                if isinstance(found, pd.DataFrame):
                    frames.append(found)
                else:
                    rows += found
            if frames:
                yield pd.concat(frames, ignore_index=True)
            if rows:
                yield pd.DataFrame(rows, dtype=object)

    return dealt(df.select(F.xxhash64(*keys).alias("brick"), "*")).mapInPandas(run, schema)


def map_blocks(vox: DataFrame, keys: list[str], f, schema: str) -> DataFrame:
    """f(pandas frame of one block) -> rows, for every block."""
    return vox.groupBy(*keys).applyInPandas(f, schema)


def map_overlap(vox: DataFrame, block: tuple[int, int, int], halo: int, f, schema: str) -> DataFrame:
    """f(pandas frame of one block with its halo; column core tells whose rows to return) -> rows."""
    from voxlake.operators.joins import assign_blocks

    return map_groups(assign_blocks(vox, block, halo), ["image_id", "t", "bz", "by", "bx"], lambda _, part: f(part), schema)


def map_objects(vox: DataFrame, f, columns: list[str]) -> DataFrame:
    """f(pandas frame of one object) -> dict of numbers; an object that fails gets nulls and its error."""
    schema = "image_id long, t int, label long, " + ", ".join(f"{c} double" for c in columns) + ", error string"

    def run(who: tuple, part: pd.DataFrame) -> list[dict]:
        head = dict(zip(("image_id", "t", "label"), who, strict=True))
        try:
            return [head | f(part) | {"error": None}]
        except (ValueError, ArithmeticError, LookupError, np.linalg.LinAlgError) as e:
            return [head | dict.fromkeys(columns) | {"error": type(e).__name__}]

    return map_groups(vox, ["image_id", "t", "label"], run, schema)


def map_objects_in_parts(vox: DataFrame, part, merge, finish, state: str, columns: list[str], brick: tuple[int, int, int] = (64, 256, 256), fan: int = 16) -> DataFrame:
    """X4 for objects of any size: no task sees more of an object than a brick of it, or `fan` states.

    part(pandas frame of an object's voxels in one brick) -> dict of state columns (a schema); merge(pandas frame of up to fan states) -> dict of
    the same; finish(dict of the last state) -> dict of numbers.  merge must not depend on which parts meet first.  An object that fails
    anywhere gets nulls and its first error (by name).
    """
    names = [c.strip().split()[0] for c in state.split(",")]
    keys = ["image_id", "t", "label"]
    schema = f"image_id long, t int, label long, part long, {state}, error string"

    def step(f, number):
        def run(who: tuple, rows: pd.DataFrame) -> list[dict]:
            head = dict(zip(keys, who)) | {"part": number(rows)}  # noqa: B905  more may follow
            try:
                if "error" in rows and rows["error"].notna().any():
                    return [head | dict.fromkeys(names) | {"error": rows["error"].dropna().min()}]
                return [head | f(rows) | {"error": None}]
            except (ValueError, ArithmeticError, LookupError, np.linalg.LinAlgError) as e:
                return [head | dict.fromkeys(names) | {"error": type(e).__name__}]

        return run

    cells = vox.withColumns({f"b{c}": F.floor(F.col(c) / n) for c, n in zip("zyx", brick, strict=True)})
    states = map_groups(cells, [*keys, "bz", "by", "bx"], step(part, lambda rows: 0), schema, vox.columns)
    states = saved(states.drop("part").withColumn("part", F.monotonically_increasing_id()), "object-parts")
    while True:
        many = states.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        if many <= 1:
            break
        spread = states.withColumn("lane", F.pmod(F.hash("part"), F.lit(1 << 10))) if many > fan << 10 else states.withColumn("lane", F.lit(0))
        order = Window.partitionBy(*keys, "lane").orderBy("part")
        numbered = spread.withColumn("meets", F.floor((F.row_number().over(order) - 1) / fan))
        numbered = numbered.withColumn("met", F.count("*").over(Window.partitionBy(*keys, "lane", "meets")))
        alone = numbered.where("met = 1").select(*states.columns)  # nothing to merge with
        merged = map_groups(numbered.where("met > 1").drop("met"), [*keys, "lane", "meets"], step(lambda rows: merge(rows[names]), lambda rows: int(rows["part"].iloc[0])), schema)
        merged = saved(merged.select(*states.columns).unionByName(alone), "object-parts")
        discard(states)
        states = merged
    out = f"image_id long, t int, label long, {', '.join(f'{c} double' for c in columns)}, error string"

    def last(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in parts:
            done = []
            for r in rows.to_dict("records"):
                head = {k: r[k] for k in keys}
                try:
                    done.append(head | (dict.fromkeys(columns) | {"error": r["error"]} if r["error"] is not None else finish({n: r[n] for n in names}) | {"error": None}))
                except (ValueError, ArithmeticError, LookupError, np.linalg.LinAlgError) as e:
                    done.append(head | dict.fromkeys(columns) | {"error": type(e).__name__})
            yield pd.DataFrame(done, columns=[*keys, *columns, "error"])

    return states.mapInPandas(last, out)


def blocks_to_rows(bricks: DataFrame) -> DataFrame:
    """Bricks (image_id, t, z0, y0, x0, ny, nx, data) to voxels, without background."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for r in part.itertuples():
                data = np.asarray(r.data)
                at = np.flatnonzero(data)
                yield pd.DataFrame({"image_id": r.image_id, "t": r.t, "z": r.z0 + at // (r.ny * r.nx), "y": r.y0 + at // r.nx % r.ny, "x": r.x0 + at % r.nx, "v": data[at]})

    return bricks.mapInPandas(run, "image_id long, t int, z int, y int, x int, v double")
