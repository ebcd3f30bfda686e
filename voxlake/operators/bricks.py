"""Graph work inside bricks: a task takes whole bricks, and only what crosses a brick's face travels between rounds.

A voxel's place is its raster number within its image (time first), so image ids may be any longs.  Bricks are dealt by a hash;
bricks whose hashes meet only share a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxlake.operators.projections import VK
from voxlake.plans.scratch import discard, saved

BRICK = (64, 256, 256)
MOST = 1 << 18  # rows that a task gathers before it works on them, whole bricks at least: some 100 MB in the widest of the works
FAR = np.iinfo(np.int64).max


class Grid:
    """Sizes of all volumes of a table together, bricks, and raster numbers with room for one step over every side."""

    def __init__(self, vox: DataFrame, brick: tuple[int, int, int] = BRICK):
        r = vox.agg(*[F.max(c).alias(f"max_{c}") for c in "tzyx"], *[F.min(c).alias(f"min_{c}") for c in "tzyx"]).first()
        self.empty, self.brick = r["max_z"] is None, dict(zip("zyx", brick, strict=True))
        if not self.empty and min(r[f"min_{c}"] for c in "tzyx") < 0:
            raise ValueError("coordinates start at 0")
        self.size = {c: (0 if self.empty else r[f"max_{c}"]) + 3 for c in "tzyx"}
        self.volume = int(np.prod([np.float64(n) for n in self.size.values()]))
        if self.volume >= 1 << 40:
            raise OverflowError("an image of more than 2^40 voxels: cut it into several")
        self.alone = all(self.size[c] - 2 <= n for c, n in self.brick.items())  # every image is one brick

    def place(self) -> Column:
        out = F.lit(0).cast("long")
        for c in "tzyx":
            out = out * self.size[c] + F.col(c) + 1
        return out

    def number(self, t: pa.Table) -> np.ndarray:
        out = np.zeros(t.num_rows, np.int64)
        for c in "tzyx":
            out = out * self.size[c] + t[c].to_numpy() + 1
        return out

    def back(self, place: str) -> dict[str, Column]:
        """Coordinates of a raster number."""
        out, rest = {}, F.col(place)
        for c in "xyzt":
            out[c] = (F.pmod(rest, F.lit(self.size[c])) - 1).cast("int")
            rest = F.floor(rest / self.size[c])
        return out

    def steps(self, moves: list[tuple[int, ...]]) -> np.ndarray:
        out = []
        for d in moves:
            n = 0
            for c, v in zip("tzyx", d if len(d) == 4 else (0, *d), strict=True):
                n = n * self.size[c] + v
            out.append(n)
        return np.array(out, np.int64)

    def _brick(self, c: str) -> Column:
        return F.floor(F.col(c) / self.brick[c])

    def own(self) -> Column:
        return F.xxhash64("image_id", *[self._brick(c) for c in "zyx"])

    def with_neighbours(self, df: DataFrame, copied: Column | None = None, inside: bool = False) -> DataFrame:
        """Rows in their own brick (ghost false), and those to be copied that lie at faces in every other brick that they touch (ghost true).

        inside: none beyond the sides of all volumes, where nobody is."""
        copied = F.lit(True) if copied is None else copied
        for c, n in self.brick.items():
            b, low, high = self._brick(c), copied & (F.pmod(c, F.lit(n)) == 0), copied & (F.pmod(c, F.lit(n)) == n - 1)
            if inside:
                low, high = low & (F.col(c) > 0), high & (F.col(c) < self.size[c] - 3)
            side = F.when(low & high, F.array(b, b - 1, b + 1)).when(low, F.array(b, b - 1)).when(high, F.array(b, b + 1)).otherwise(F.array(b))
            df = df.withColumn(f"b{c}", F.explode(side))
        home = (F.col("bz") == self._brick("z")) & (F.col("by") == self._brick("y")) & (F.col("bx") == self._brick("x"))
        return df.withColumn("ghost", ~home).withColumn("brick", F.xxhash64("image_id", "bz", "by", "bx")).drop("bz", "by", "bx")

    def to_neighbours(self, df: DataFrame) -> DataFrame:
        """Rows at brick faces, copied to every other brick that they touch (column brick)."""
        if self.alone:
            return df.where("false").withColumn("brick", F.lit(0).cast("long"))
        return self.with_neighbours(df).where("ghost").drop("ghost")


def dealt(df: DataFrame) -> DataFrame:
    """Rows by brick, each brick in one task and together; the brick comes first."""
    return df.select("brick", *[c for c in df.columns if c != "brick"]).repartition("brick").sortWithinPartitions("brick")


def whole(batches: Iterator[pa.RecordBatch], most: int = MOST) -> Iterator[pa.Table]:
    """Tables of whole bricks of rows that come sorted by their first column."""
    done, tail, last = [], [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        b = batch.column(0).to_numpy()
        cut = np.flatnonzero(b[1:] != b[:-1])
        k = int(cut[-1]) + 1 if len(cut) else 0
        if k or last is not None and b[0] != last:
            done += [*tail, batch.slice(0, k)]
            tail = []
            if sum(d.num_rows for d in done) >= most:
                yield pa.Table.from_batches(done).combine_chunks()
                done = []
        tail.append(batch.slice(k))
        last = b[-1]
    if done or tail:
        yield pa.Table.from_batches([*done, *tail]).combine_chunks()


def _ranks(s: np.ndarray) -> np.ndarray:
    """The rank of each value among the distinct ones; rows of a brick lie together, so runs of equal values are sorted as one."""
    head = np.flatnonzero(np.append(True, s[1:] != s[:-1])[: len(s)])
    return np.repeat(np.unique(s[head], return_inverse=True)[1], np.diff(np.append(head, len(s))))


def keys(space: list[np.ndarray], place: np.ndarray, volume: int) -> np.ndarray:
    """One number per voxel of a table: images (and objects) apart, raster numbers within."""
    number = np.zeros(len(place), np.int64)
    for s in space:
        number = _ranks(number * (len(place) + 1) + _ranks(s))
    return number * volume + place


class Places:
    """Rows of sorted distinct keys: by a table of all numbers between them where that is not much longer than they are many, else by search."""

    MOST = 32  # numbers a key in a table

    def __init__(self, key: np.ndarray):
        self.key, self.low, self.span = key, int(key[0]) if len(key) else 0, int(key[-1] - key[0]) + 1 if len(key) else 0
        self.table = None
        if 0 < self.span <= self.MOST * len(key):
            self.table = np.full(self.span + 1, -1, np.int32)
            self.table[key - self.low] = np.arange(len(key), dtype=np.int32)

    def rows(self, want: np.ndarray) -> np.ndarray:
        """The row of each number; -1 where there is none."""
        if not self.span:
            return np.full(len(want), -1)
        if self.table is not None:
            at = want - self.low
            return self.table[np.where((at >= 0) & (at < self.span), at, self.span)]
        at = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
        return np.where(self.key[at] == want, at, -1)

    def hold(self, want: np.ndarray) -> np.ndarray:
        return self.rows(want) >= 0


def a_step_on(key: np.ndarray, rows: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Of some rows of sorted distinct keys those that have a row a step on, and that row."""
    want = key[rows] + step
    at = np.minimum(np.searchsorted(key, want), len(key) - 1)
    hit = np.flatnonzero(key[at] == want)
    return rows[hit], at[hit]


Combine = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]
STATE = ("c", "hops", "label", "par")


def _less(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...]) -> np.ndarray:
    out, same = np.zeros(len(a[0]), bool), np.ones(len(a[0]), bool)
    for x, y in zip(a, b, strict=True):
        out |= same & (x < y)
        same &= x == y
    return out


def least(row: np.ndarray, n: int, given: list[np.ndarray], blank: list[float]) -> list[np.ndarray]:
    """Of the rows of each of n numbers the least in the order of the columns, without sorting them: column by column, rows that are not least drop out."""
    out, left = [], np.arange(len(row))
    for x, far in zip(given, blank, strict=True):
        low = np.full(n, far, x.dtype)
        np.minimum.at(low, row[left], x[left])
        left = left[x[left] == low[row[left]]]
        out.append(low)
    return out


def settle(key: np.ndarray, steps: np.ndarray, state: list[np.ndarray], cost: np.ndarray, level: np.ndarray, place: np.ndarray, combine: Combine) -> None:
    """Least state (c, hops, label, predecessor) of every row (sorted distinct keys) over all paths; rows whose cost is NaN are not entered.

    Each wave looks at the voxels that got better, direction by direction: neither a table of neighbours nor the offers of all directions are held."""
    places = Places(key)
    front = np.flatnonzero(np.isfinite(state[0]))
    while len(front):
        was = [x[front] for x in state[:3]]  # as the wave begins
        changed = np.zeros(len(key), bool)
        for step in steps.tolist():
            at = places.rows(key[front] + step)
            hit = np.flatnonzero(at >= 0)
            s, d = front[hit], at[hit]
            offer = (combine(was[0][hit], cost, level, s, d), was[1][hit] + 1, was[2][hit], place[s])
            better = _less(offer, tuple(x[d] for x in state)) & ~np.isnan(cost[d]) & np.isfinite(offer[0])
            d = d[better]
            for x, y in zip(state, offer, strict=True):
                x[d] = y[better]
            changed[d] = True
        front = np.flatnonzero(changed)


SENT = 100_000  # numbers of bricks that are sent to all tasks at most


class Versions:
    """Rows of bricks over rounds: a round writes only the bricks that changed, and a small manifest (a row a changed brick) says which version of a brick counts.

    own: which rows of a table are state; a round's table may hold others for the round after it."""

    MOST = 8  # versions, then they are written as one

    def __init__(self, df: DataFrame, name: str, own: Column | None = None):
        self.name, self.tables, self.manifest, self.own = name, [saved(df, name)], None, F.lit(True) if own is None else own

    def every(self, bricks: DataFrame | None = None) -> DataFrame:
        """All versions of all or some bricks (column version)."""
        out = None
        for v, t in enumerate(self.tables):
            t = t.where(self.own).withColumn("version", F.lit(v))
            out = t if out is None else out.unionByName(t)
        return out if bricks is None else out.join(bricks, "brick", "left_semi")

    def rows(self, bricks: DataFrame | None = None) -> DataFrame:
        """The latest rows of all, or of some bricks."""
        out = self.every(bricks)
        if self.manifest is not None:
            out = out.join(self.manifest, "brick", "left").where(F.col("version") == F.coalesce("latest", F.lit(0))).drop("latest")
        return out.drop("version")

    def add(self, df: DataFrame, bricks: DataFrame) -> None:
        """New rows of some bricks."""
        new = saved(df, self.name)
        self.tables.append(new)
        changed = bricks.select("brick", F.lit(len(self.tables) - 1).alias("latest"))
        changed = changed if self.manifest is None else changed.unionByName(self.manifest).groupBy("brick").agg(F.max("latest").alias("latest"))
        before, self.manifest = self.manifest, saved(changed, f"{self.name}-manifest")
        old = [] if before is None else [before]
        if len(self.tables) > self.MOST:
            old += [*self.tables[:-1], self.manifest]
            # the last version stays by itself: its rows are the ones that are new
            rest = saved(self.rows().join(bricks, "brick", "left_anti"), self.name)
            self.tables = [rest, new]
            self.manifest = saved(bricks.select("brick", F.lit(1).alias("latest")), f"{self.name}-manifest")
        for t in old:
            discard(t)


def latest(t: pa.Table) -> pa.Table:
    """Of whole bricks, one after the other, the rows of the last version and the ghosts; bricks without ghosts go."""
    brick, version, ghost = (t[c].to_numpy() for c in ("brick", "version", "ghost"))
    head = np.flatnonzero(np.append(True, brick[1:] != brick[:-1]))
    size = np.diff(np.append(head, len(brick)))
    last, open_ = np.maximum.reduceat(version, head), np.logical_or.reduceat(ghost, head)
    return t.filter(pa.array(np.repeat(open_, size) & (ghost | (version == np.repeat(last, size))))).combine_chunks()


ROWS = "brick long, image_id long, t int, z int, y int, x int, object long, cost double, level double, c double, hops long, label long, par long, ghost boolean"


def relax(seeds: DataFrame, field: DataFrame, moves: list[tuple[int, ...]], combine: Combine, brick: tuple[int, int, int] = BRICK) -> tuple[DataFrame, Grid]:
    """The least (c, hops, label) of every voxel over all paths from the seeds: (VK, object, c, hops, label, par) of voxels that a path reaches,
    and the grid that numbers them.

    seeds: VK, object, label, c, hops; field: VK, object, cost, level.  Paths stay within one image and object, leave seeds and enter voxels of the
    field; combine(c of the voxel left, costs, levels, voxels left, voxels entered) gives the next c (infinity: no way).  par: raster
    number of the voxel before, least of equals.  Rounds end when no face voxel changes; each is written.
    """
    none = lambda kind: F.lit(None).cast(kind)
    thing = F.col("object").cast("long").alias("object")
    real = field.select(*VK, thing, F.col("cost").cast("double").alias("cost"), F.col("level").cast("double").alias("level"), none("double").alias("c"), none("long").alias("hops"), none("long").alias("label"), none("long").alias("par"))
    first = seeds.select(*VK, thing, none("double").alias("cost"), none("double").alias("level"), F.col("c").cast("double").alias("c"), F.col("hops").cast("long").alias("hops"), F.col("label").cast("long").alias("label"), F.lit(-1).cast("long").alias("par"))
    table = saved(real.unionByName(first), "relax-input")
    grid = Grid(table, brick)
    rows = table.withColumn("ghost", F.lit(False)).withColumn("brick", grid.own())
    steps = grid.steps(moves)

    def run(batches: Iterator[pa.RecordBatch], start: bool) -> Iterator[pa.RecordBatch]:
        for t in whole(batches):
            t = t if start else latest(t)
            if not t.num_rows:
                continue
            place = grid.number(t)
            key = keys([t["image_id"].to_numpy(), t["object"].to_numpy()], place, grid.volume)
            names, at, row = np.unique(key, return_index=True, return_inverse=True)
            n = len(names)
            cost, level = np.full(n, np.nan), np.full(n, np.nan)
            for name, out in (("cost", cost), ("level", level)):
                np.fmax.at(out, row, t[name].to_numpy())
            blank = {"c": np.inf, "hops": FAR, "label": FAR, "par": FAR}
            given = [t[c].fill_null(v).to_numpy() for c, v in blank.items()]
            state = least(row, n, given, list(blank.values()))
            real = np.zeros(n, bool)
            real[row[~t["ghost"].to_numpy()]] = True
            own = np.full(n, -1)
            own[row[~t["ghost"].to_numpy()]] = np.flatnonzero(~t["ghost"].to_numpy())
            was = [x.copy() for x in state]
            settle(names, steps, state, cost, level, place[at], combine)
            fresh = np.isfinite(state[0]) if start else _less(tuple(state), tuple(was))
            kept = np.flatnonzero(real)
            out = t.take(pa.array(own[kept])).select(["brick", *VK, "object"])
            found = [pa.array(x[kept], mask=~np.isfinite(state[0][kept])) for x in state]
            cols = [pa.array(cost[kept], mask=np.isnan(cost[kept])), pa.array(level[kept], mask=np.isnan(level[kept])), *found, pa.array(np.zeros(len(kept), bool)), pa.array(fresh[kept])]
            for name, col in zip(("cost", "level", *STATE, "ghost", "fresh"), cols, strict=True):
                out = out.append_column(name, col)
            yield from out.combine_chunks().to_batches(max_chunksize=100_000)

    def round_of(df: DataFrame, start: bool) -> DataFrame:
        """Settled bricks, and beside them the copies of what got better for the bricks around (ghost)."""
        out = dealt(df).mapInArrow(lambda b: run(b, start), ROWS + ", fresh boolean")
        return out if grid.alone else grid.with_neighbours(out, F.col("fresh"), inside=True).withColumn("cost", F.when(~F.col("ghost"), F.col("cost")))

    own = ~F.col("ghost")
    state = Versions(round_of(rows, True), "relax", own)
    discard(table)
    while not grid.alone:
        ghosts = state.tables[-1].where(~own)
        touched = saved(ghosts.select("brick").distinct(), "relax-bricks")
        n = touched.count()
        if not n:
            discard(touched)
            break
        # all versions and the copies meet in one shuffle, where bricks drop what is old; only where few bricks go on the others stay behind
        again = state.every(F.broadcast(touched) if n <= SENT else None).unionByName(ghosts.withColumn("version", F.lit(-1))).drop("fresh")
        state.add(round_of(again, False), touched)
        discard(touched)
    return state.rows().where("c is not null").select(*VK, "object", "c", "hops", "label", "par", "cost"), grid


def follow(grid: Grid, pointers: DataFrame, starts: DataFrame, steps: int | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """The voxels that pointers lead through: (VK, object, label, step, carry) from each start on, until a voxel without a pointer or `steps` voxels.

    pointers: VK, object, next (raster number by the grid, below 0: an end) and columns to carry; starts: VK, object, label.  A task follows all
    paths through its bricks; a path that leaves them goes on in the next round.  A path ends at a voxel that has no row.
    """
    thing = F.col("object").cast("long").alias("object")
    kinds = [(c, k) for c, k in pointers.dtypes if c in carry]
    blank = [F.lit(None).cast(k).alias(c) for c, k in kinds]
    table = pointers.select(*VK, thing, "next", F.lit(None).cast("long").alias("label"), F.lit(None).cast("long").alias("step"), *carry).withColumn("brick", grid.own())
    open_ = starts.select(*VK, thing, F.lit(None).cast("long").alias("next"), F.col("label").cast("long").alias("label"), F.lit(0).cast("long").alias("step"), *blank)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole(batches):
            place = grid.number(t)
            image, thing = t["image_id"].to_numpy(), t["object"].to_numpy()
            key = keys([image, thing], place, grid.volume)
            entry = np.flatnonzero(t["label"].is_valid().to_numpy())
            known = np.flatnonzero(t["next"].is_valid().to_numpy())
            if not len(entry) or not len(known):
                continue
            by = known[np.argsort(key[known], kind="stable")]
            names, onward = Places(key[by]), t["next"].fill_null(-1).to_numpy()[by]
            at, label, step = key[entry], t["label"].fill_null(0).to_numpy()[entry], t["step"].fill_null(0).to_numpy()[entry]
            image, thing = image[entry], thing[entry]
            base = at - place[entry]
            first = True
            while len(at):
                k = names.rows(at)
                here = k >= 0
                for mine in (here, ~here):
                    # a path that steps on a voxel of another brick is handed on; one that starts there has none
                    if mine.any() and (mine is here or not first):
                        w = np.flatnonzero(mine)
                        row = pa.array(by[k[w]], mask=~here[w])
                        cols = [pa.array(x[w]) for x in (image, thing, label, step, at - base)] + [pa.array(np.full(len(w), mine is not here))]
                        yield pa.RecordBatch.from_arrays(cols + [t[c].combine_chunks().take(row) for c, _ in kinds], ["image_id", "object", "label", "step", "place", "left", *(c for c, _ in kinds)])
                go = here & (onward[k] >= 0) & ((step + 1 < steps) if steps else True)
                image, thing, label, step, base, at = image[go], thing[go], label[go], step[go] + 1, base[go], (base + onward[k])[go]
                first = False

    out = None
    while True:
        entries = open_.withColumn("brick", grid.own())
        rows = (table if grid.alone else table.join(entries.select("brick").distinct(), "brick", "left_semi")).unionByName(entries)
        walked = saved(dealt(rows).mapInArrow(run, "image_id long, object long, label long, step long, place long, left boolean" + "".join(f", {c} {k}" for c, k in kinds)).withColumns(grid.back("place")), "walk")
        mine = walked.where("not left").select(*VK, "object", "label", "step", *carry)
        out = mine if out is None else out.unionByName(mine)
        open_ = walked.where("left").select(*VK, "object", F.lit(None).cast("long").alias("next"), "label", "step", *blank)
        if grid.alone or open_.isEmpty():
            return out
