"""Hard-negative mining by cover trees over norm-augmented candidates.

Scores are integer inner products of vectors times ``SCALE``, rounded down. Candidates are dealt by hash into blocks of about
``BLOCK_ROWS`` rows. A block becomes a forest, one cover tree for each label with enough rows and one for the others:

* every candidate gets one more component, which brings all to the norm of the longest. Distances to an anchor of that norm
  then order candidates as inner products do;
* a node covers its rows within its radius; its children's centres lie further apart than the next level's radius and
  cover the rows within it. Each node keeps the radius that its own rows really have;
* by the triangle inequality, a node's radius bounds the inner products of an anchor with all its rows from both sides.

An anchor goes to every block and descends best bound first: for its positives, until no open node can beat those found;
for the negatives of its positives' score windows, past nodes that lie outside of every window or cannot beat what a window
has. Rows of the nodes that remain are verified exactly, and each block hands on the first few rows only. Bounds only save
work: every row that may be among the first is scored in full.

Defined cases: rows with a null label, a null vector, or a null or non-finite component take no part; vectors of different
lengths have no score with each other; a row with a null vec_id is never an anchor and comes last among ties; rows that
repeat vec_id, label and vector are rows of their own, each with its results; scores stop at the ends of a long; vectors
of any length are compared whole; columns other than vec_id, label and embedding are not read, whatever their names; an
empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
#: The window of negatives, in percent of the positive's score.
LOW, HIGH = 50, 95
BLOCK_ROWS = 8192
ANCHOR_ROWS = 2048
BASE = 1.6
LEAF = 32
SMALL = 8
OWN_TREE = 64
SLACK = 1e-6
EXACT = float(1 << 53)
TOP = (1 << 63) - 1


@dataclass(frozen=True)
class Forest:
    """Cover trees over the vectors ``x`` of one length, which stand in the order of the nodes' own rows.

    Node k has its centre ``x[center[k]]``, its radius, its own rows ``rows[k]:rows[k + 1]`` and its children
    ``kids[child[k]:child[k + 1]]``. Tree t starts at node ``root[t]``, and has rows of one label only if ``pure[t]``.
    """

    x: np.ndarray
    uid: np.ndarray
    vec_id: np.ndarray
    no_id: np.ndarray
    label: np.ndarray
    center: np.ndarray
    radius: np.ndarray
    rows: np.ndarray
    child: np.ndarray
    kids: np.ndarray
    root: np.ndarray
    pure: np.ndarray
    norm: np.ndarray

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **self.__dict__)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> Forest:
        with np.load(io.BytesIO(data)) as z:
            return cls(**{k: z[k] for k in z.files})


def cover(points: np.ndarray, norm: float) -> Iterator[tuple[int, int, float, np.ndarray]]:
    """Nodes ``(parent, centre, radius, own rows)`` of a cover tree over points of one norm, parents first."""
    stack, n = [(np.arange(len(points)), 0, -1)], 0
    while stack:
        rows, c, parent = stack.pop()
        far = np.sqrt(np.maximum(0, 2 * norm * norm - 2 * (points[rows] @ points[c])))
        radius = float(far.max())
        if len(rows) <= LEAF or radius <= SLACK * norm:
            yield parent, c, radius, rows
            n += 1
            continue
        # The next level below this radius.
        reach = BASE ** (np.ceil(np.log(radius) / np.log(BASE)) - 1)
        near = far <= reach
        parts, rest = [(c, rows[near])], rows[~near]
        while len(rest):
            batch = rest[:64]
            within = 2 * norm * norm - 2 * (points[rest] @ points[batch].T) <= reach * reach
            within[np.arange(len(batch)), np.arange(len(batch))] = True
            chosen, done = [], np.zeros(len(batch), bool)
            for j in range(len(batch)):
                if not done[j]:
                    chosen.append(j)
                    done |= within[: len(batch), j]
            own = within[:, chosen]
            hit, first = own.any(1), own.argmax(1)
            members = rest[hit]
            order = np.argsort(first[hit], kind="stable")
            bounds = np.searchsorted(first[hit][order], np.arange(len(chosen) + 1))
            parts += [(int(batch[j]), members[order[bounds[k] : bounds[k + 1]]]) for k, j in enumerate(chosen)]
            rest = rest[~hit]
        # The rows of small children are rows of this node.
        small = [p for _, p in parts if len(p) <= SMALL]
        yield parent, c, radius, np.concatenate(small) if small else rows[:0]
        stack += [(p, q, n) for q, p in parts if len(p) > SMALL]
        n += 1


def build_forest(x: np.ndarray, uid: np.ndarray, vec_id: np.ndarray, no_id: np.ndarray, label: np.ndarray, first: int) -> Forest:
    """A forest over rows; of rows equal in label and vector the ``first`` by vec_id stand for all, as no other can come first."""
    order = np.lexsort((vec_id, no_id))
    same = np.unique(np.c_[label[order].astype(float), x[order]], axis=0, return_inverse=True)[1].ravel()
    by = np.argsort(same, kind="stable")
    start = np.flatnonzero(np.r_[True, np.diff(same[by]) != 0])
    place = np.arange(len(by)) - np.repeat(start, np.diff(np.r_[start, len(by)]))
    keep = np.sort(order[by[place < first]])
    x, uid, vec_id, no_id, label = (c[keep] for c in (x, uid, vec_id, no_id, label))
    square = (x * x).sum(1)
    norm = float(np.sqrt(square.max(initial=0)))
    points = np.c_[x, np.sqrt(np.maximum(0, norm * norm - square))]
    names, code, size = np.unique(label, return_inverse=True, return_counts=True)
    large = size >= OWN_TREE
    groups = [np.flatnonzero(code == k) for k in np.flatnonzero(large)]
    pure = [True] * len(groups)
    if (mixed := np.flatnonzero(~large[code])).size:
        groups.append(mixed)
        pure.append(len(np.unique(label[mixed])) == 1)
    parents, centers, radii, own, roots = [], [], [], [], []
    for rows in groups:
        base = len(parents)
        roots.append(base)
        for parent, c, radius, members in cover(points[rows], norm):
            parents.append(parent + base if parent >= 0 else -1)
            centers.append(rows[c])
            radii.append(radius)
            own.append(rows[members])
    order = np.concatenate(own)
    parents = np.array(parents)
    kids = np.argsort(parents, kind="stable")
    child = np.searchsorted(parents[kids], np.arange(len(parents) + 1))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    rows = np.cumsum([0, *map(len, own)])
    return Forest(x[order], uid[order], vec_id[order], no_id[order], label[order], place[np.array(centers)], np.array(radii), rows, child, kids, np.array(roots), np.array(pure), np.array(norm))


class Search:
    """One anchor's way through a forest."""

    def __init__(self, forest: Forest, q: np.ndarray) -> None:
        self.f, self.q = forest, q
        self.length, self.norm = float(np.sqrt(q @ q)), float(forest.norm)
        self.slack = SLACK * self.length * self.norm + SLACK
        largest = np.abs(forest.x).max(initial=0)
        self.exact = len(q) * largest * np.abs(q).max(initial=0) < EXACT

    def scores(self, rows: slice | np.ndarray) -> np.ndarray:
        """Exact inner products."""
        x = self.f.x[rows]
        if self.exact:
            return (x @ self.q).astype(np.int64)
        whole = [sum(int(a) * int(b) for a, b in zip(r, self.q, strict=True)) for r in x]
        return np.array([max(-TOP, min(TOP, s)) for s in whole], np.int64)

    def bounds(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and the largest inner product that rows below each node can have."""
        if not self.length or not self.norm:
            return np.full(len(nodes), -self.slack), np.full(len(nodes), self.slack)
        turned = (self.f.x[self.f.center[nodes]] @ self.q) * (self.norm / self.length)
        square = self.norm * self.norm
        d, r = np.sqrt(np.maximum(0, 2 * square - 2 * turned)), self.f.radius[nodes] + SLACK * self.norm
        back = self.length / self.norm
        return (square - (d + r) ** 2 / 2) * back - self.slack, (square - np.maximum(0, d - r) ** 2 / 2) * back + self.slack

    def roots(self, label: int, same: bool) -> np.ndarray:
        """Trees that may have rows of the label, or of others."""
        f = self.f
        own = f.label[f.center[f.root]] == label
        return f.root[~f.pure | (own == same)]

    def firsts(self, k: int, label: int, uid: int) -> np.ndarray:
        """The first ``k`` rows of the anchor's label, itself left out once."""
        f, found, best = self.f, np.zeros(0, np.int64), np.zeros(0, np.int64)
        nodes = self.roots(label, True)
        heap = [(-hi, n) for hi, n in zip(self.bounds(nodes)[1].tolist(), nodes.tolist(), strict=True)]
        heapq.heapify(heap)
        left_out = False
        while heap:
            hi, node = heapq.heappop(heap)
            if len(found) == k and -hi < best[-1]:
                break
            a, b = f.rows[node], f.rows[node + 1]
            if b > a:
                s = self.scores(slice(a, b))
                ok = f.label[a:b] == label
                if len(found) == k:
                    ok &= s >= best[-1]
                own = np.flatnonzero(ok & (f.uid[a:b] == uid))
                if len(own) and not left_out:
                    ok[own[0]] = False
                    left_out = True
                found, best = self.merged(found, best, np.flatnonzero(ok) + a, s[ok], k)
            kids = f.kids[f.child[node] : f.child[node + 1]]
            if len(kids):
                for bound, kid in zip(self.bounds(kids)[1].tolist(), kids.tolist(), strict=True):
                    if len(found) < k or bound >= best[-1]:
                        heapq.heappush(heap, (-bound, kid))
        return found

    def windows(self, k: int, label: int, low: list[int], high: list[int]) -> list[np.ndarray]:
        """For each window of scores, the first ``k`` rows in it that have another label."""
        f, n = self.f, len(low)
        found, best = [np.zeros(0, np.int64)] * n, [np.zeros(0, np.int64)] * n
        least = list(low)

        def useful(lo: float, hi: float) -> bool:
            return any(hi >= x and lo <= y for x, y in zip(least, high, strict=True))

        nodes = self.roots(label, False)
        lo, hi = self.bounds(nodes)
        heap = [(-h, x, m) for h, x, m in zip(hi.tolist(), lo.tolist(), nodes.tolist(), strict=True)]
        heapq.heapify(heap)
        top = max(high)
        while heap:
            hi, lo, node = heapq.heappop(heap)
            if not useful(lo, -hi):
                continue
            a, b = f.rows[node], f.rows[node + 1]
            if b > a:
                s = self.scores(slice(a, b))
                ok = np.flatnonzero((s >= min(least)) & (s <= top) & (f.label[a:b] != label))
                if len(ok):
                    s = s[ok]
                    for w in range(n):
                        own = (s >= least[w]) & (s <= high[w])
                        if own.any():
                            found[w], best[w] = self.merged(found[w], best[w], ok[own] + a, s[own], k)
                            if len(found[w]) == k:
                                least[w] = max(low[w], int(best[w][-1]))
            kids = f.kids[f.child[node] : f.child[node + 1]]
            if len(kids):
                for x, y, kid in zip(*(c.tolist() for c in (*self.bounds(kids), kids)), strict=True):
                    if useful(x, y):
                        heapq.heappush(heap, (-y, x, kid))
        return found

    def merged(self, found: np.ndarray, best: np.ndarray, more: np.ndarray, s: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The first ``k`` of rows and more rows: higher scores, then smaller vec_ids, come first."""
        if len(more) > 4 * k:
            cut = np.partition(s, len(s) - k)[len(s) - k]
            more, s = more[s >= cut], s[s >= cut]
        found, best = np.r_[found, more], np.r_[best, s]
        order = np.lexsort((self.f.vec_id[found], self.f.no_id[found], -best))[:k]
        return found[order], best[order]


def _scaled(vectors: pd.Series) -> np.ndarray:
    return np.floor(SCALE * np.array(vectors.tolist(), float).reshape(len(vectors), -1))


def _build(first: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.loc[pdf.index.repeat(np.minimum(pdf["n"], first))]
        no_id = pdf["vec_id"].isna().to_numpy()
        vec_id = pdf["vec_id"].fillna(0).to_numpy(np.int64)
        forest = build_forest(_scaled(pdf["embedding"]), pdf["uid"].to_numpy(np.int64), vec_id, no_id, pdf["label"].to_numpy(np.int64), first)
        return pd.DataFrame({"block": [key[0]], "dim": [key[1]], "forest": [forest.to_bytes()]})

    return run


def _met(forests: DataFrame, anchors: DataFrame, n_blocks: int, n_parts: int):
    """Every part of the anchors beside every block with vectors of their length."""
    left = forests.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1))))
    right = anchors.withColumn("part", F.pmod(F.xxhash64("uid"), F.lit(n_parts)).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    return left.groupBy("block", "dim", "part").cogroup(right.groupBy("block", "dim", "part"))


def _first(found: DataFrame, keys: list[str], k: int, name: str) -> DataFrame:
    """The first ``k`` rows of each key, numbered from 1."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn(name, F.row_number().over(order)).where(F.col(name) <= k)


def hard_negatives(vectors: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, block_rows: int = BLOCK_ROWS, anchor_rows: int = ANCHOR_ROWS) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` for the rows of ``vectors`` that ``anchor`` names.

    ``vectors (vec_id, label, embedding)``; a negative's score is from ``low`` to ``high`` percent of its positive's.
    """
    spark = vectors.sparkSession
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding")
    rows = rows.groupBy("vec_id", "label", "embedding").agg(F.count("*").alias("n"))
    rows = common.written(rows.withColumns({"uid": F.monotonically_increasing_id(), "dim": F.size("embedding")}), "rows")
    total = rows.count()
    n_blocks = max(1, -(-total // block_rows), min(2 * spark.sparkContext.defaultParallelism, -(-total // 256)))
    first = max(positives + 1, negatives)
    blocks = rows.withColumn("block", F.pmod(F.xxhash64("uid"), F.lit(n_blocks)).cast("int"))
    forests = common.written(blocks.groupBy("block", "dim").applyInPandas(_build(first), "block int, dim int, forest binary"), "forests")
    anchors = rows.where(anchor)
    n_parts = max(1, -(-anchors.count() // anchor_rows))

    def forest_of(own: pd.DataFrame) -> Forest | None:
        return Forest.from_bytes(own["forest"].iloc[0]) if len(own) else None

    def best(own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out, forest = [], forest_of(own)
        if forest is not None and len(asked):
            for uid, label, q in zip(asked["uid"], asked["label"], _scaled(asked["embedding"]), strict=True):
                search = Search(forest, q)
                at = search.firsts(positives, label, uid)
                out += [(uid, s, None if no else i) for s, no, i in zip(search.scores(at).tolist(), forest.no_id[at], forest.vec_id[at].tolist(), strict=True)]
        return pd.DataFrame(out, columns=["uid", "score", "vec_id"]).astype({"uid": "int64", "score": "int64", "vec_id": "Int64"})

    found = _met(forests, anchors.select("uid", "label", "embedding", "dim"), n_blocks, n_parts).applyInPandas(best, "uid long, score long, vec_id long")
    near = common.written(_first(found, ["uid"], positives, "slot"), "positives")
    asked = near.groupBy("uid").agg(F.collect_list(F.struct("slot", "score")).alias("asked"))

    def mine(own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out, forest = [], forest_of(own)
        if forest is not None and len(asked):
            for uid, label, pairs, q in zip(asked["uid"], asked["label"], asked["asked"], _scaled(asked["embedding"]), strict=True):
                scores = [int(p["score"]) for p in pairs]
                search = Search(forest, q)
                rows = search.windows(negatives, label, [-(-low * s // 100) for s in scores], [high * s // 100 for s in scores])
                for p, at in zip(pairs, rows, strict=True):
                    out += [(uid, int(p["slot"]), s, None if no else i) for s, no, i in zip(search.scores(at).tolist(), forest.no_id[at], forest.vec_id[at].tolist(), strict=True)]
        return pd.DataFrame(out, columns=["uid", "slot", "score", "vec_id"]).astype({"uid": "int64", "slot": "int32", "score": "int64", "vec_id": "Int64"})

    windows = anchors.select("uid", "label", "embedding", "dim").join(asked, "uid")
    mined = _met(forests, windows, n_blocks, n_parts).applyInPandas(mine, "uid long, slot int, score long, vec_id long")
    ranked = _first(mined, ["uid", "slot"], negatives, "rank").select("uid", "slot", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    known = near.select("uid", "slot", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = ranked.join(known, ["uid", "slot"]).join(anchors.select("uid", F.col("vec_id").alias("anchor_id"), "n"), "uid")
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of each fiftieth vector, under labels of which each seventh is changed."""
    vectors = common.read_table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.select("vec_id", label.alias("label"), "embedding"), F.col("vec_id") % 50 == 0)
