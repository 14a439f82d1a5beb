"""Connected components by alternating large-star and small-star steps.

Edges never reach the driver.  Every step is a map-side combined ``min`` and a
join of two plain shuffles, which adaptive execution may split where a hub
gathers many neighbours.  The step tables are written to the shared folder.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch


HELD = 1 << 19  # nodes of a partition's forest in memory


def local_stars(batches):
    """Replace the edges of one partition by stars of its local components, of
    at most about ``HELD`` nodes at a time; further edges start a new forest."""
    parent: dict[int, int] = {}

    def find(x):
        root = x
        while parent.setdefault(root, root) != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    def stars():
        rows = [(x, r) for x in list(parent) if (r := find(x)) != x]
        for i in range(0, len(rows), 50_000):
            u, v = zip(*rows[i : i + 50_000])
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    for b in batches:
        for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            u, v = find(u), find(v)
            if u != v:
                parent[max(u, v)] = min(u, v)
        if len(parent) > HELD:
            yield from stars()
            parent.clear()
    yield from stars()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``edges`` has two long columns; returns (node, component), one row for
    each node of an edge, component being the smallest node reachable.

    Null ends and loops are ignored; repeated edges do not matter; no edges
    give no rows.
    """
    a, b = edges.columns
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v")
    e = scratch.cut(e.mapInArrow(local_stars, "u long, v long").distinct().mapInArrow(local_stars, "u long, v long").distinct(), "edges")
    seen = _sign(e)
    while seen[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = scratch.cut(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("v"), F.least("u", "m").alias("m")), "low")
        large = scratch.cut(e.join(low, "v").select("u", F.col("m").alias("v")).where("u <> v").distinct(), "large")
        least = scratch.cut(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        hung = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        new = scratch.cut(hung.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        scratch.drop(e, low, large, least)
        e, before, seen = new, seen, _sign(new)
        if seen == before:
            break
    roots = e.select(F.col("v").alias("node")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))


def _sign(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
