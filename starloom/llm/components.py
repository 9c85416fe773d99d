"""Connected components of a link table, as joins and aggregations.

Rounds of large-star and small-star: every node's links are redirected to the
smallest neighbour known so far, until each component is a star around its
smallest node. A round is two grouped minima and two joins over the links;
nothing about single nodes reaches the driver, only the count and checksum
that show whether a round changed anything. Each round's links are written to
the shared folder, so the plan stays short and a lost executor costs one round.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import materialize


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): the smallest node reachable from each node of ``links``
    whose component has more than one node. Self-links, repeated links and
    links with a null end change nothing."""
    ends = links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
    e = materialize(ends.where("hi <> lo").distinct(), "components")
    before = _stats(e)
    while before[0]:
        low = e.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("m"))
        large = e.join(low, F.col("lo") == F.col("node"), "left").select("hi", F.coalesce("m", "lo").alias("lo")).distinct()
        least = large.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("m"))
        moved = large.join(least, F.col("hi") == F.col("node")).where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        e = materialize(moved.unionByName(least.select(F.col("node").alias("hi"), F.col("m").alias("lo"))).distinct(), "components")
        after = _stats(e)
        if after == before:
            break
        before = after
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(
        e.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    )


def _stats(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable index of each of n nodes under links a[i]-b[i]."""
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        low = np.minimum(ra, rb)
        np.minimum.at(root, ra, low)  # ra and rb are roots here: only whole trees are hooked
        np.minimum.at(root, rb, low)
        while (root[root] != root).any():
            root = root[root]
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    return root
