"""Operator 2: embedding near-dedup by a subspace pigeonhole join.

Unit vectors link when their cosine is at least `cosine`, so their squared distance is at most 2 - 2 cosine.  A seeded
rotation spreads the variance over all axes; the rotated vector is split into blocks of `width` axes, and at least one block
holds no more than its proportional share of the squared distance.  Each block is range-joined on a grid over its leading
axes (as many as the label's own size needs): a vector is at home in one cell and a guest in every other cell that its ball
meets.  Inside a cell both sides are halved into boxes of a few dozen vectors (k-d trees over all of the block's axes), and boxes
farther apart than the budget are never compared.  A pair counts in the first block whose budget it meets, so candidates need no removal of duplicates.  A first pass
carries only the block's coordinates and keeps the members of a cell that have a partner there; only these are joined to
their whole vectors, and the cosine of the given vectors is computed in double precision.

Dense groups leave the grid first.  Centres of groups that a bounded sample shows take every vector within half the link
angle, so all pairs of such a cluster link and are counted, not compared.  A vector outside is counted with a whole cluster, or
left out, where the triangle inequality of angles decides; only the rest is compared.  The sample changes the work, never the result.

Equal vectors of a label are one row with a multiplicity.  Cells above WHOLE * LIMIT rows, and clusters above a sixteenth of
LIMIT, are dealt into chunks that are compared chunk by chunk, each in a task of its own.  A task sends one row per vector and a spanning forest, never pairs.

Vectors that are null, empty, zero or hold null or non-finite components, and rows with a null label, link with nothing
and are returned.  Vectors of different lengths do not link.  Rows without vec_id are dropped; rows that repeat a vec_id are
one vector (the smallest by label, then components).  Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlake.operators.graph import connected_components, roots
from voxlake.plans.scratch import saved

COSINE = 0.98
WIDTH = 8
CELL = 1 << 15  # homes of a cell that the grid aims at
LIMIT = 4096  # homes of a group whose whole vectors are compared
WHOLE = 32  # times as many rows, of coordinates only, make a chunk of a cell
LEAF = 32
TILE = 512
SAMPLE = 4096  # vectors that are searched for centres of dense groups
DENSE = 8  # of these, at least so many make a cluster
SLACK = 1e-6
DEALT = 1 << 16  # added to the block of chunks whose homes meet only their guests


def rotation(dim: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(7).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, by their largest component first so that no square overflows."""
    x = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _budget(cosine: float, dim: int, width: int) -> np.ndarray:
    """Each block's share of the squared distance; turned coordinates are kept in single precision."""
    sizes = np.array([min(width, dim - i) for i in range(0, dim, width)])
    return (2 - 2 * cosine) * sizes / dim * (1 + 1e-6) + SLACK


def _angle(cosines: np.ndarray) -> np.ndarray:
    return 2 * np.arcsin(np.sqrt(np.clip((1 - cosines) / 2, 0, 1)))


def _lists(rows: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]), pa.array(rows.ravel()))


def _matrix(column: pa.ChunkedArray | pa.Array, rows: np.ndarray) -> np.ndarray:
    """Some rows of a column of equally long lists."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy()
    return flat.reshape(len(column), -1)[rows]


def _by_size(lists: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix) of the lists of each length."""
    sizes = np.diff(lists.offsets.to_numpy())
    flat, ends = lists.flatten().to_numpy(), np.cumsum(sizes)
    for dim in np.unique(sizes):
        who = np.flatnonzero(sizes == dim)
        yield who, flat[(ends[who] - dim)[:, None] + np.arange(dim)]


def centres(rows: list, cosine: float) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
    """By label and length: numbers and directions of the centres of dense groups among some (label, v) rows."""
    angle, out, n = float(_angle(np.array(cosine))), {}, 0
    groups: dict[tuple[int, int], list] = {}
    for label, v in rows:
        groups.setdefault((label, len(v)), []).append(v)
    for key, vectors in sorted(groups.items()):
        u, found = _unit(np.array(vectors)), []
        linked = u @ u.T >= cosine
        left, links = np.ones(len(u), bool), linked.sum(axis=1)
        while links.max() >= DENSE:
            near = linked[links.argmax()] & left
            inside = _angle(u @ _unit(u[near].mean(axis=0)[None])[0]) <= angle / 2
            if (inside & left).sum() >= DENSE:
                centre = _unit(u[inside & left].mean(axis=0)[None])[0]
                found.append(centre)
                near |= (_angle(u @ centre) <= angle / 2) & left
            left &= ~near
            links = np.where(left, links - linked[:, near].sum(axis=1), 0)
        if found:
            out[key] = (np.arange(n, n + len(found)), np.array(found))
            n += len(found)
    return out


def _placed(cosine: float, pivots: dict):
    """Task: vectors with their turned coordinates, their cluster (-1: none), its angle, and other clusters within reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        angle = float(_angle(np.array(cosine)))
        for batch in batches:
            label = batch.column(0).to_numpy()
            for who, v in _by_size(batch.column(1)):
                u = _unit(v)
                cluster, own = np.full(len(who), -1, np.int32), np.zeros(len(who))
                rivals: list = [[] for _ in who]
                for lab in np.unique(label[who]) if pivots else ():
                    if (lab, v.shape[1]) in pivots:
                        ids, centre = pivots[lab, v.shape[1]]
                        mine = np.flatnonzero(label[who] == lab)
                        away = _angle(u[mine] @ centre.T)
                        first = away.argmin(axis=1)
                        least = away[np.arange(len(mine)), first]
                        inside = least <= angle / 2 - SLACK
                        cluster[mine[inside]], own[mine[inside]] = ids[first[inside]], least[inside]
                        reach = away <= 1.5 * angle + SLACK
                        reach[np.flatnonzero(inside), first[inside]] = False
                        for i, k in zip(*np.nonzero(reach), strict=True):
                            rivals[mine[i]].append({"rival": int(ids[k]), "away": float(away[i, k])})
                where = pa.array(who)
                columns = [batch.column(k).take(where) for k in range(4)] + [_lists((u @ rotation(v.shape[1])).astype(np.float32)), pa.array(cluster), pa.array(own)]
                columns.append(pa.array(rivals, pa.list_(pa.struct([("rival", pa.int32()), ("away", pa.float64())]))))
                yield pa.RecordBatch.from_arrays(columns, ["label", "v", "rep", "n", "w", "cluster", "own", "rivals"])

    return run


PLACED = "label long, v array<double>, rep long, n long, w array<float>, cluster int, own double, rivals array<struct<rival:int,away:double>>"


def _mixed(*parts: np.ndarray | int) -> np.ndarray:
    """A 64-bit number of some equally long columns."""
    h = np.uint64(0x9E3779B97F4A7C15)
    for p in parts:
        h = (h ^ np.asarray(p).astype(np.int64).view(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        h = h ^ (h >> np.uint64(29))
    return np.asarray(h).view(np.int64)


def _cells(cosine: float, width: int, counts: bool):
    """Task over (rep, label, axes, w): home cell and guest cells of every vector in each block; or only how many rows each cell has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rep, label, axes = (batch.column(i).to_numpy() for i in (0, 1, 2))
            for who, turned in _by_size(batch.column(3)):
                for k in np.unique(axes[who]):
                    some = np.flatnonzero(axes[who] == k)
                    yield from cells(rep[who[some]], label[who[some]], int(k), turned[some])

    def cells(rep: np.ndarray, label: np.ndarray, axes: int, turned: np.ndarray) -> Iterator[pa.RecordBatch]:
        dim = turned.shape[1]
        for b, budget in enumerate(_budget(cosine, dim, width)):
            radius = np.sqrt(budget) * (1 + 1e-6)
            step = 4 * radius
            x = turned[:, b * width : b * width + width]
            part = x[:, :axes].astype(np.float64)
            home = np.floor(part / step).astype(np.int64)
            low, high = part - home * step, (home + 1) * step - part
            side, gap = np.where(low < high, -1, 1), np.minimum(low, high) ** 2  # a cell is four radii wide: one side is in reach
            for shift in product((0, 1), repeat=part.shape[1]):
                s = np.array(shift, np.int64)
                rows = np.flatnonzero(gap @ s <= radius * radius) if any(shift) else np.arange(len(rep))
                if not len(rows):
                    continue
                at = home[rows] + side[rows] * s
                key = _mixed(label[rows], dim * 4096 + b, *at.T)
                if counts:
                    names, n = np.unique(key, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(n)], ["cell", "n"])
                else:
                    fixed = [pa.array(np.full(len(rows), v, np.int32)) for v in (dim, b)]
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(label[rows]), *fixed, pa.array(np.full(len(rows), any(shift))), pa.array(rep[rows]), _lists(x[rows])], ["cell", "label", "dim", "block", "guest", "rep", "x"])

    return run


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    """(table, homes, guests) of each key, label, length and block of rows that come sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        names = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(4)])
        cuts = np.flatnonzero((names[:, 1:] != names[:, :-1]).any(axis=0)) + 1
        bounds = [0, *cuts.tolist(), batch.num_rows]
        if held and last != names[:, 0].tolist():
            yield from _sides(held)
            held = []
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            held.append(batch.slice(a, b - a))
            if b < batch.num_rows:
                yield from _sides(held)
                held = []
        last = names[:, -1].tolist()
    if held:
        yield from _sides(held)


def _sides(parts: list[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    if sum(p.num_rows for p in parts) > 1:
        t = pa.Table.from_batches(parts).combine_chunks()
        guest = t["guest"].to_numpy()
        if not guest.all():
            yield t, np.flatnonzero(~guest), np.flatnonzero(guest)


def boxes(x: np.ndarray, rows: np.ndarray, size: int) -> list[np.ndarray]:
    """The rows in groups of at most size, by halving at the median of the widest axis (a k-d tree's leaves, neighbours in a row)."""
    todo, out = [rows], []
    while todo:
        r = todo.pop()
        if len(r) <= size:
            out.append(r)
            continue
        part = x[r]
        order = np.argpartition(part[:, np.ptp(part, axis=0).argmax()], len(r) // 2)
        todo += [r[order[len(r) // 2 :]], r[order[: len(r) // 2]]]
    return out


def _apart(low: np.ndarray, high: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
    """Squared distances of a box to some boxes."""
    gap = np.maximum(np.maximum(lows - high, low - highs), 0)
    return np.einsum("ij,ij->i", gap, gap)


class Reach:
    """What lies near a box: some rows of x in boxes of their own, the far ones of which are passed over whole."""

    def __init__(self, x: np.ndarray, rows: np.ndarray, budget: float) -> None:
        parts = boxes(x, rows, LEAF)
        self.x, self.budget, self.rows, self.sizes = x, budget, np.concatenate(parts), np.array([len(p) for p in parts])
        starts = np.cumsum(self.sizes) - self.sizes
        self.low, self.high = (f.reduceat(x[self.rows], starts, axis=0) for f in (np.minimum, np.maximum))

    def of(self, box: np.ndarray) -> np.ndarray:
        """Rows whose distance to the box of these rows is within the budget."""
        low, high = self.x[box].min(axis=0), self.x[box].max(axis=0)
        q = self.rows[np.repeat(_apart(low, high, self.low, self.high) <= self.budget, self.sizes)]
        return q[_apart(low, high, self.x[q], self.x[q]) <= self.budget]


def _near(cosine: float, width: int, limit: int):
    """Task over cells: the rows that have a partner within the block's budget, without their coordinates.

    The cell's homes are halved into nodes of at most `limit`, each with those of the cell that have a partner in it, dealt again above
    2 * limit: these are the groups whose whole vectors are compared.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, homes, guests in _groups(batches):
            key, block = t["key"].to_numpy()[:1], t["block"][0].as_py()
            budget = np.float32(_budget(cosine, t["dim"][0].as_py(), width)[block % DEALT] + 4 * SLACK)
            rep, x = t["rep"].to_numpy(), _matrix(t["x"], np.arange(t.num_rows))
            half = np.einsum("ij,ij->i", x, x) / 2
            reach = Reach(x, guests if block >= DEALT else np.concatenate([homes, guests]), budget)
            for i, node in enumerate(boxes(x, homes, limit)):
                home, other = np.zeros(t.num_rows, bool), np.zeros(t.num_rows, bool)
                for a in boxes(x, node, LEAF):
                    b = reach.of(a)
                    # |a - b|^2 <= budget, halved
                    p, q = np.nonzero(x[a] @ x[b].T >= (half[a] - budget / 2)[:, None] + half[b])
                    ok = rep[a[p]] != rep[b[q]]
                    home[a[p[ok]]] = other[b[q[ok]]] = True
                mine, theirs = np.flatnonzero(home), np.flatnonzero(other)
                alone = block < DEALT and len(theirs) <= 2 * limit
                theirs = np.flatnonzero(other & ~home) if alone else theirs
                for j in range(0, max(1, len(theirs)) if len(mine) else 0, 2 * limit):
                    rows = np.concatenate([mine, theirs[j : j + 2 * limit]])
                    fixed = [np.full(len(rows), block % DEALT + (0 if alone else DEALT), np.int32), np.arange(len(rows)) >= len(mine)]
                    name = np.repeat(_mixed(key, np.array([i]), np.array([j])), len(rows))
                    same = [t[c].combine_chunks().take(pa.array(rows)) for c in ("label", "dim")]
                    yield pa.RecordBatch.from_arrays([pa.array(name), *same, *map(pa.array, fixed), pa.array(rep[rows])], ["key", "label", "dim", "block", "guest", "rep"])

    return run


def _cosine_at_least(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray, cosine: float) -> np.ndarray:
    norm = lambda m: np.sqrt(np.einsum("ij,ij->i", m, m))
    p, q = x / np.abs(x).max(1, keepdims=True), y / np.abs(y).max(1, keepdims=True)
    return np.einsum("ij,ij->i", p[i], q[j]) / (norm(p)[i] * norm(q)[j]) >= cosine


def _linked(x: np.ndarray, y: np.ndarray, w: np.ndarray, z: np.ndarray, block: int, cosine: float, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of x and y (turned: w and z) that link; with a block, only those that meet its budget and none before."""
    a, b = _unit(x), _unit(y)
    i, j = np.nonzero(a @ b.T >= cosine - SLACK)
    if block >= 0:
        budget = _budget(cosine, x.shape[1], width)
        within = np.zeros((len(i), block + 1), bool)
        for k in range(block + 1):  # the same sum, whichever of the two is at home
            part = slice(k * width, k * width + width)
            within[:, k] = ((w[i, part].astype(np.float64) - z[j, part]) ** 2).sum(axis=1) <= budget[k]
        first = within[:, block] & ~within[:, :block].any(axis=1)
        i, j = i[first], j[first]
    ok = _cosine_at_least(x, y, i, j, cosine)
    return i[ok], j[ok]


def _join(cosine: float, width: int):
    """Task over chunks with whole vectors: (rep, number of linked vectors, root) for every linked vector at home, and (rep, 0, root) for its guests.

    Rows of block -1 are a cluster's members and the vectors that contest it: no two of a side are compared, and both sides are counted.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, homes, guests in _groups(batches):
            block = t["block"][0].as_py()
            rep, n = t["rep"].to_numpy(), t["n"].to_numpy()
            v = _matrix(t["v"], np.arange(t.num_rows))
            w = _matrix(t["w"], np.arange(t.num_rows)) if block >= 0 else v
            others = np.concatenate([homes, guests]) if 0 <= block < DEALT else guests
            degree, a, b = np.zeros(t.num_rows, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
            for s in range(0, len(homes), TILE):
                for e in range(0, len(others), TILE):
                    p, q = homes[s : s + TILE], others[e : e + TILE]
                    i, j = _linked(v[p], v[q], w[p], w[q], block % DEALT if block >= 0 else -1, cosine, width)
                    i, j = p[i], q[j]
                    keep = rep[i] != rep[j]
                    i, j = i[keep], j[keep]
                    np.add.at(degree, i, n[j])
                    if block < 0:
                        np.add.at(degree, j, n[i])
                    a, b = roots(np.concatenate([a, rep[i]]), np.concatenate([b, rep[j]]))
            hit = np.flatnonzero(degree)
            yield pa.RecordBatch.from_arrays([pa.array(rep[hit]), pa.array(degree[hit]), pa.array(b[np.searchsorted(a, rep[hit])])], ["rep", "links", "root"])
            rest = ~np.isin(a, rep[hit]) & (a != b)  # guests: their links are counted at home, where the root may be another
            yield pa.RecordBatch.from_arrays([pa.array(a[rest]), pa.array(np.zeros(rest.sum(), np.int64)), pa.array(b[rest])], ["rep", "links", "root"])

    return run


LINKS = "rep long, links long, root long"
KEYS = ("key", "label", "dim", "block")


def _chunks(rows: DataFrame, mine: str, other: str, *key: str) -> DataFrame:
    """Rows dealt by rep into `mine` chunks and copied for each of the `other` side's; key: of the pair of chunks."""
    here, there = F.pmod(F.xxhash64("rep"), F.col(mine)).cast("int"), F.explode(F.sequence(F.lit(0), F.col(other) - 1))
    rows = rows.withColumn("here", here).withColumn("there", there)
    pair = [F.when(F.col("guest"), F.col(a)).otherwise(F.col(b)) for a, b in (("there", "here"), ("here", "there"))]
    return rows.withColumn("key", F.xxhash64(*key, *pair)).drop("here", "there", mine, other)


def _sorted(rows: DataFrame) -> DataFrame:
    return rows.repartition(*KEYS).sortWithinPartitions(*KEYS)


def _grid_links(rows: DataFrame, cosine: float, width: int, limit: int, cell: int, axes: int | None) -> DataFrame:
    """Links among the vectors of no cluster: the pigeonhole join."""
    chunk = WHOLE * limit
    if axes is None:  # an axis leaves a cell at most about half its homes
        most = rows.groupBy("label").agg(F.count("*").alias("size"))
        need = F.least(F.greatest(F.ceil(F.log2(F.col("size") / cell)), F.lit(0)), F.lit(width)).cast("int")
        rows = rows.join(most.select("label", need.alias("axes")), "label")
    else:
        rows = rows.withColumn("axes", F.lit(axes))
    asked = rows.select("rep", "label", "axes", "w")
    cells = asked.mapInArrow(_cells(cosine, width, False), "cell long, label long, dim int, block int, guest boolean, rep long, x array<float>")
    counts = asked.mapInArrow(_cells(cosine, width, True), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    parts = counts.where(F.col("n") > chunk).select("cell", F.ceil(F.col("n") / chunk).cast("int").alias("parts"))
    cells = cells.join(parts, "cell", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    alone = cells.where("parts = 1").withColumn("key", F.col("cell")).select(*KEYS, "guest", "rep", "x")
    # of a large cell, every chunk of homes meets every chunk of all its rows
    many = cells.where("parts > 1").withColumns({"again": F.col("parts"), "block": F.col("block") + DEALT})
    many = many.where("not guest").unionByName(many.withColumn("guest", F.lit(True)))
    dealt = _chunks(many, "parts", "again", "cell").select(*KEYS, "guest", "rep", "x")
    near = saved(_sorted(alone.unionByName(dealt)).mapInArrow(_near(cosine, width, limit), "key long, label long, dim int, block int, guest boolean, rep long"), "vector-partners")
    whole = near.join(rows.select("rep", "n", "v", "w"), "rep").select(*KEYS, "guest", "rep", "n", "v", "w")
    return _sorted(whole).mapInArrow(_join(cosine, width), LINKS)


def _cluster_links(rows: DataFrame, cosine: float, width: int, limit: int) -> DataFrame:
    """Links inside clusters, and between them and everything else; chunks are small, since all their pairs of whole vectors are compared."""
    limit, angle = max(1, limit // 16), float(_angle(np.array(cosine)))
    members = rows.where("cluster >= 0")
    about = saved(members.groupBy("cluster").agg(F.sum("n").alias("all"), F.count("*").alias("size"), F.min("rep").alias("first"), F.max("own").alias("radius")), "clusters")
    about = F.broadcast(about)  # one row a centre: at most SAMPLE / DENSE
    inside = members.join(about, "cluster").select("rep", (F.col("all") - F.col("n")).alias("links"), F.col("first").alias("root"))
    contests = rows.select("rep", "n", "label", "v", "cluster", F.explode("rivals").alias("r")).where("cluster < r.rival")
    contests = contests.select("rep", "n", "label", "v", F.col("r.rival").alias("cluster"), F.col("r.away").alias("away")).join(about, "cluster")
    sure = F.col("away") + F.col("radius") <= angle - SLACK
    whole = contests.where(sure).select("rep", F.col("all").alias("links"), F.col("first").alias("root"))
    back = F.broadcast(contests.where(sure).groupBy("cluster").agg(F.sum("n").alias("links"), F.first("first").alias("root")))
    back = members.select("rep", "cluster").join(back, "cluster").select("rep", "links", "root")
    open_ = contests.where(~sure & (F.col("away") - F.col("radius") <= angle + SLACK))
    sizes = F.broadcast(open_.groupBy("cluster").agg(F.ceil(F.count("*") / limit).cast("int").alias("theirs"), F.ceil(F.first("size") / limit).cast("int").alias("ours")))
    columns = ["cluster", "label", "rep", "n", "v", "ours", "theirs"]
    ours = _chunks(members.join(sizes, "cluster").select(*columns, F.lit(False).alias("guest")), "ours", "theirs", "cluster")
    theirs = _chunks(open_.join(sizes, "cluster").select(*columns, F.lit(True).alias("guest")), "theirs", "ours", "cluster")
    pairs = ours.unionByName(theirs).select("key", "label", F.size("v").alias("dim"), F.lit(-1).alias("block"), "guest", "rep", "n", "v", F.lit(None).cast("array<float>").alias("w"))
    return inside.unionAll(whole).unionAll(back).unionAll(_sorted(pairs).mapInArrow(_join(cosine, width), LINKS))


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, width: int = WIDTH, limit: int = LIMIT, cell: int = CELL, axes: int | None = None, sample: int = SAMPLE, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept): the links of each vector with all others of its label.

    limit, cell, axes and sample (chunk and cell sizes, grid axes, vectors searched for dense groups) change the work, not the result.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.struct(F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("v")).alias("x"))
    rows = rows.where("vec_id is not null").groupBy("vec_id").agg(F.min("x").alias("x")).select("vec_id", "x.label", "x.v")
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))) | ~F.exists("v", lambda c: c != 0)
    rows = saved(rows.withColumn("usable", F.coalesce(F.col("label").isNotNull() & ~bad, F.lit(False))), "vectors")
    good = rows.where("usable")
    distinct = good.groupBy("label", "v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"))
    share = min(1.0, sample / max(1, good.count())) if cosine > 0.5 else 0.0
    shown = good.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < int(share * (1 << 20))).select("label", "v").collect()  # about `sample` rows
    pivots = centres([(r.label, r.v) for r in shown], cosine)
    distinct = saved(distinct.select("label", "v", "rep", "n").mapInArrow(_placed(cosine, pivots), PLACED), "vectors-distinct")
    found = _grid_links(distinct.where("cluster < 0") if pivots else distinct, cosine, width, limit, cell, axes)
    if pivots:
        found = found.unionAll(_cluster_links(distinct, cosine, width, limit))
    found = saved(found, "vector-links")
    degree = found.groupBy("rep").agg(F.sum("links").alias("links"))
    part = connected_components(found, "rep", "root").withColumnRenamed("node", "rep")
    reps = distinct.select("label", "v", "rep", "n").join(degree, "rep", "left").join(part, "rep", "left")
    reps = reps.select("label", "v", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    linked = good.join(reps, ["label", "v"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionAll(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))
