"""Connected components of an edge table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlake.plans.scratch import saved
from voxlake.plans.workers import lean

MAX_ROUNDS = 60


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of edges between integers: the nodes, and the smallest node that each reaches."""
    nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = index[: len(a)], index[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        while (again := new[new]).tobytes() != new.tobytes():
            new = again
        if (new == label).all():
            return nodes, nodes[label]
        label = new


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            node, root = roots(*(batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)))
            keep = node != root
            yield pa.RecordBatch.from_arrays([pa.array(node[keep]), pa.array(root[keep])], ["src", "dst"])


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component) for every node of an edge; component is the smallest node reachable.  Nodes are longs.

    Alternating large-star and small-star rounds; each round pre-aggregates the minimum before its shuffle and joins it
    back, so a hub with millions of edges is split by the skew join instead of landing in one task.  Every task first
    contracts its own edges to stars.  Rounds end when no edge changes; the edge table is written between rounds.
    Null ends and loops are ignored; an empty table gives no rows.
    """
    e = edges.select(F.col(src).cast("long").alias("src"), F.col(dst).cast("long").alias("dst"))
    e = e.where("src is not null and dst is not null and src <> dst").mapInArrow(lean(_contract), "src long, dst long")
    e = saved(e.distinct(), "edges")
    mark = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)")).alias("h")).first()
    for _ in range(MAX_ROUNDS):
        if not mark["n"]:
            break
        both = e.unionAll(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        low = both.groupBy("src").agg(F.min("dst").alias("low"))
        large = both.where("dst > src").join(low, "src").select(F.col("dst").alias("src"), F.least("src", "low").alias("dst"))
        large = large.unionAll(low.where("low < src").select("src", F.col("low").alias("dst"))).distinct()
        least = large.groupBy("src").agg(F.min("dst").alias("low"))
        small = large.join(least, "src").where("dst <> low").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
        new = saved(small.unionAll(least.select("src", F.col("low").alias("dst"))).distinct(), "edges")
        now = new.agg(F.count("*").alias("n"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)")).alias("h")).first()
        e, mark, before = new, now, mark
        if now == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return e.select(F.col("src").alias("node"), F.col("dst").alias("component")).unionAll(e.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct())
