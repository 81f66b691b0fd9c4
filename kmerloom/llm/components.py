"""Connected components of a link table, by repeated contraction in Spark."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (u, v)``: nodes have one root exactly if links join them.

    Each round hangs every node on the smallest of its neighbours and itself, then links what they hang on instead. Two
    rounds compare ids, the third compares hashes of ids, so that chains in id order shrink as well and the number of
    rounds grows with the logarithm of the nodes. Links are pre-aggregated before each shuffle, and no group is gathered:
    a node with very many links is a running minimum, and joins on it are plain joins that Spark may split.
    """
    links = edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    links, hangs = written(links, "links"), []
    while not links.isEmpty():
        by_hash = len(hangs) % 3 == 2

        def rank(c: str, by_hash: bool = by_hash, salt: int = len(hangs)):
            return F.struct((F.xxhash64(F.lit(salt), F.col(c)) if by_hash else F.lit(0)).alias("h"), F.col(c).alias("n"))

        both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("node")).agg(F.min(rank("v")).alias("best"))
        hang = written(least.select("node", F.least("best", rank("node"))["n"].alias("root")), "hangs")
        hangs.append(hang)
        moved = links.join(hang.withColumnsRenamed({"node": "u", "root": "ru"}), "u").join(hang.withColumnsRenamed({"node": "v", "root": "rv"}), "v")
        links = written(moved.where("ru <> rv").select(F.least("ru", "rv").alias("u"), F.greatest("ru", "rv").alias("v")).distinct(), "links")
    if not hangs:
        return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    found = hangs[0]
    for hang in hangs[1:]:
        found = found.join(hang.select(F.col("node").alias("root"), F.col("root").alias("higher")), "root", "left").select("node", F.coalesce("higher", "root").alias("root"))
    return found


def forest(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` rows the smallest row that the links ``u - v`` join it with."""
    label = np.arange(n)
    while len(u):
        low = np.minimum(label[u], label[v])
        before = label.copy()
        np.minimum.at(label, u, low)
        np.minimum.at(label, v, low)
        label = label[label]
        if (label == before).all():
            break
        open_ = label[u] != label[v]
        u, v = u[open_], v[open_]
    while not (label[label] == label).all():
        label = label[label]
    return label
