"""Embedding near-duplicates by PCA-ordered tiled comparison.

Vectors are rotated onto the principal axes of all vectors and dealt into blocks by a tree of median cuts along the leading
axes. Blocks whose ranges on these axes are too far apart are never paired. A task compares two blocks in tiles, which
such cuts make compact: tiles whose ranges on the axes are too far apart are left out; of others it accumulates the
leading axes of all products first, bounds what the other axes can add by the product of suffix norms, and drops a pair,
or the tile, as soon as the cosine cannot reach the threshold. The bounds only save work: every pair that can reach the
threshold is computed in full, in double precision.

Blocks have at most about ``BLOCK_BYTES``, and are as large as that once there are enough block pairs for all cores: a
vector is copied once for each block near its own, so that fewer, larger blocks mean fewer copies. The tree is cut on a
sample of at most ``SAMPLE`` vectors, which decides how even blocks are and nothing else.

Equal vectors are compared once, as one class with a count. Each comparison returns one row per linked class, with its
number of linked vectors and one class that the block pair's links join it with, so that a large group of near copies
costs no list of pairs.

Defined cases: vectors that are null, zero, or hold null or non-finite components link with nothing, and so do vectors
of different lengths; very large and very small components are scaled by powers of two before they are squared; rows that
repeat a vec_id are vectors of their own; vectors of any length are compared whole; columns other than vec_id and
embedding are not read, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common
from .components import connected_components, forest

THRESHOLD = 0.95
BLOCK_BYTES = 16 << 20
SAMPLE = 32_768
LEADING = 12
MAX_DEPTH = 12
TILE = 512
SLACK = 1e-9


def usable(vector: str = "embedding") -> F.Column:
    """True for vectors that can link."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two, which changes no digit, so that squares neither overflow nor vanish."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at length one."""
    x = scaled(x)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def principal_axes(vectors: DataFrame, dim: int) -> np.ndarray:
    """Orthonormal axes (columns) by decreasing second moment of all unit vectors: one sum per axis pair in Spark."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((dim, dim))
        for pdf in batches:
            if len(pdf):
                x = unit(np.array(pdf["embedding"].tolist(), float))
                total += x.T @ x
        i, j = np.indices((dim, dim)).reshape(2, -1)
        yield pd.DataFrame({"i": i, "j": j, "s": total.ravel()})

    sums = vectors.select("embedding").mapInPandas(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).toPandas()
    moment = np.zeros((dim, dim))
    moment[sums["i"], sums["j"]] = sums["s"]
    _, axes = np.linalg.eigh((moment + moment.T) / 2)
    return np.ascontiguousarray(axes[:, ::-1])


def tile_order(r: np.ndarray, size: int = TILE) -> tuple[np.ndarray, np.ndarray]:
    """An order of the rows by median cuts along the axis with the widest range, and the ends of its tiles."""
    parts, out = [np.arange(len(r))], []
    while parts:
        rows = parts.pop()
        if len(rows) <= size:
            out.append(rows)
            continue
        own = r[rows]
        axis = int((own.max(0) - own.min(0)).argmax())
        rows = rows[np.argpartition(own[:, axis], len(rows) // 2)]
        parts += [rows[len(rows) // 2 :], rows[: len(rows) // 2]]
    return np.concatenate(out), np.cumsum([len(x) for x in out])


def gaps(low: np.ndarray, high: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
    """The least distance that points of one box can have from points of each of others."""
    apart = np.maximum(0, np.maximum(lows - high, low - highs))
    return np.sqrt((apart * apart).sum(-1))


def reach_of(threshold: float) -> float:
    """The distance of unit vectors at the threshold, and a little more."""
    return float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-6


def tile_pairs(a: np.ndarray, b: np.ndarray, axes: np.ndarray, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers ``(i, j)`` of pairs with cosine >= ``threshold``, tile by tile; ``same``: a is b, and each pair once."""
    ra = unit(a) @ axes
    oa, ea = tile_order(ra)
    ra = ra[oa]
    rb, ob, eb = (ra, oa, ea) if same else (unit(b) @ axes, None, None)
    if not same:
        ob, eb = tile_order(rb)
        rb = rb[ob]
    dim = a.shape[1]
    cuts = sorted({max(1, dim * k // 4) for k in (1, 2, 3)} | {dim})
    suffix = [(np.sqrt((ra[:, c:] ** 2).sum(1)), np.sqrt((rb[:, c:] ** 2).sum(1))) for c in cuts]
    starts = np.r_[0, eb[:-1]]
    lows, highs = np.minimum.reduceat(rb, starts), np.maximum.reduceat(rb, starts)
    low, reach = threshold - SLACK, reach_of(threshold)
    for ta, i1 in enumerate(ea):
        i0 = ea[ta - 1] if ta else 0
        near = gaps(ra[i0:i1].min(0), ra[i0:i1].max(0), lows, highs) <= reach
        for tb in np.flatnonzero(near):
            if same and tb < ta:
                continue
            j0 = starts[tb]
            left, right = slice(i0, i1), slice(j0, eb[tb])
            i = j = None
            product, done = None, 0
            for c, (sa, sb) in zip(cuts, suffix, strict=True):
                if i is None:
                    part = ra[left, done:c] @ rb[right, done:c].T
                    product = part if product is None else product + part
                    live = product >= low - np.outer(sa[left], sb[right])
                    n = np.count_nonzero(live)
                    if n * 16 < live.size or c == dim:
                        i, j = np.nonzero(live)
                        product, i, j = product[i, j], i + i0, j + j0
                else:
                    product = product + np.einsum("ij,ij->i", ra[i, done:c], rb[j, done:c])
                    live = product >= low - sa[i] * sb[j]
                    product, i, j = product[live], i[live], j[live]
                done = c
                if i is not None and not len(i):
                    break
            if same:
                keep = i < j
                i, j, product = i[keep], j[keep], product[keep]
            close = np.abs(product - threshold) <= SLACK
            ok = product >= threshold
            if close.any():
                x, y = scaled(a[oa[i[close]]]), scaled(b[ob[j[close]]])
                ok[close] = (x * y).sum(1) / np.sqrt((x * x).sum(1) * (y * y).sum(1)) >= threshold
            if ok.any():
                yield oa[i[ok]], ob[j[ok]]


def compare_blocks(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, axes: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """For each row of a, then of b: its number of linked vectors in the other block, and the first row links join it with.

    ``same``: a is b; only the rows of a are returned.
    """
    n = len(a) if same else len(a) + len(b)
    counts, label = np.zeros(n, np.int64), np.arange(n)
    for i, j in tile_pairs(a, b, axes, threshold, same):
        k = j if same else j + len(a)
        counts[: len(a)] += np.bincount(i, weights=nb[j], minlength=len(a)).astype(np.int64)
        back = np.bincount(j, weights=na[i], minlength=len(b)).astype(np.int64)
        counts[0 if same else len(a) :] += back
        # Tiles are joined as they come: what is kept is one label per row.
        u, v = label[i], label[k]
        rows, code = np.unique(np.concatenate((u, v)), return_inverse=True)
        joined = rows[forest(code[: len(u)], code[len(u) :], len(rows))]
        moved = np.arange(n)
        moved[rows] = joined
        label = moved[label]
    return counts, label


def cut_tree(points: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Axis and value of each cut of a full tree of median cuts, level by level."""
    axis, value = np.zeros((1 << depth) - 1, np.int64), np.zeros((1 << depth) - 1)
    own = [points]
    for k in range(len(axis)):
        p = own[k]
        if len(p):
            axis[k] = int(p.var(0).argmax())
            value[k] = float(np.median(p[:, axis[k]]))
        right = p[:, axis[k]] >= value[k]
        own += [p[~right], p[right]]
        own[k] = p[:0]
    return axis, value


def leaf_of(points: np.ndarray, axis: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The leaf of each point, from 0 in the order of the tree."""
    at, rows = np.zeros(len(points), np.int64), np.arange(len(points))
    for _ in range((len(axis) + 1).bit_length() - 1):
        at = 2 * at + 1 + (points[rows, axis[at]] >= value[at])
    return at - len(axis)


def _links(reps: DataFrame, dim: int, threshold: float, block_bytes: int) -> DataFrame:
    """``(u, v, n)`` for the classes ``(class, embedding, n)`` of one vector length."""
    spark = reps.sparkSession
    kind = "<f4" if isinstance(reps.schema["embedding"].dataType.elementType, T.FloatType) else "<f8"
    total = reps.count()
    axes = principal_axes(reps, dim)
    leading = axes[:, :LEADING].copy()
    # Enough block pairs for all cores, and blocks within their bytes.
    cores = spark.sparkContext.defaultParallelism
    n_blocks = max(1, min(-(-total // TILE), max(int(np.ceil(np.sqrt(6 * cores))), -(-total * dim * int(kind[2]) // block_bytes))))
    depth = min(MAX_DEPTH, max(0, (4 * n_blocks - 1).bit_length()) if n_blocks > 1 else 0)

    @F.pandas_udf("array<double>")
    def lead(vectors: pd.Series) -> pd.Series:
        return pd.Series(list(unit(np.array(vectors.tolist(), float).reshape(-1, dim)) @ leading))

    points = np.zeros((0, leading.shape[1]))
    if depth:
        # Places on the leading axes only, of a bounded sample.
        every = max(1, 2 * total // SAMPLE)
        rows = reps.where(F.pmod(F.xxhash64("class"), F.lit(every)) == 0).limit(SAMPLE).select(lead("embedding").alias("at")).toPandas()
        points = np.array(rows["at"].tolist(), float).reshape(-1, leading.shape[1])
    axis, value = cut_tree(points, depth)

    @F.pandas_udf("leaf int, at array<double>")
    def place(vectors: pd.Series) -> pd.DataFrame:
        p = unit(np.array(vectors.tolist(), float).reshape(-1, dim)) @ leading
        return pd.DataFrame({"leaf": leaf_of(p, axis, value), "at": list(p)})

    found = reps.withColumn("place", place("embedding"))
    placed = common.written(found.select("class", "n", "embedding", "place.leaf", "place.at"), "placed")
    bounds = [f(F.get("at", F.lit(k))).alias(f"{name}{k}") for name, f in (("lo", F.min), ("hi", F.max)) for k in range(leading.shape[1])]
    # One row per leaf, at most 4,096: its size and its ranges on the leading axes.
    leaves = placed.groupBy("leaf").agg(F.count("*").alias("size"), *bounds).toPandas().sort_values("leaf")
    wide = leading.shape[1]
    box = leaves.iloc[:, 2:].to_numpy(float)
    # Neighbouring leaves are joined to blocks of about one size; a leaf too large for one is split by hash.
    room = -(-total // n_blocks)
    parts = np.maximum(1, -(-leaves["size"].to_numpy() // (2 * room)))
    base, lows, highs, at, held = {}, [], [], -1, 2 * room
    for leaf, size, n_parts, b in zip(leaves["leaf"], leaves["size"], parts, box, strict=True):
        if n_parts > 1 or held + size > 1.5 * room:
            at, held = at + 1, 0
            lows += [b[:wide]] * n_parts
            highs += [b[wide:]] * n_parts
            base[leaf] = at
            at, held = at + n_parts - 1, size if n_parts == 1 else 2 * room
        else:
            held += size
            lows[at], highs[at] = np.minimum(lows[at], b[:wide]), np.maximum(highs[at], b[wide:])
            base[leaf] = at
    split = dict(zip(leaves["leaf"], parts, strict=True))
    lows, highs, reach = np.array(lows).reshape(-1, wide), np.array(highs).reshape(-1, wide), reach_of(threshold)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            block = pdf["leaf"].map(base) + (pdf["class"] % pdf["leaf"].map(split))
            for b, g in pdf.groupby(block):
                near = np.flatnonzero(gaps(lows[b], highs[b], lows, highs) <= reach)
                x = np.array(g["embedding"].tolist(), kind)
                yield pd.DataFrame({"block": [int(b)], "near": [near.astype(np.int32)], "ids": [g["class"].to_numpy("<i8").tobytes()], "ns": [g["n"].to_numpy("<i8").tobytes()], "x": [x.tobytes()]})

    packed = placed.select("class", "n", "leaf", "embedding").mapInPandas(pack, "block int, near array<int>, ids binary, ns binary, x binary")
    pairs = packed.withColumn("other", F.explode("near"))
    pairs = pairs.select(F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "block", "ids", "ns", "x")

    def compare(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = key

        def side(block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            own = pdf[pdf["block"] == block]
            return tuple(np.frombuffer(b"".join(own[c]), t) for c, t in (("ids", "<i8"), ("ns", "<i8"), ("x", kind)))

        ids, ns, x = side(a)
        ids2, ns2, y = (ids, ns, x) if a == b else side(b)
        x, y = x.reshape(-1, dim).astype(float), y.reshape(-1, dim).astype(float)
        if not len(x) or not len(y):
            return pd.DataFrame({"u": [], "v": [], "n": []}, dtype="int64")
        counts, label = compare_blocks(x, y, ns, ns2, axes, threshold, a == b)
        every = ids if a == b else np.concatenate((ids, ids2))
        hit = np.flatnonzero(counts)
        return pd.DataFrame({"u": every[hit], "v": every[label[hit]], "n": counts[hit]})

    return pairs.groupBy("a", "b").applyInPandas(compare, "u long, v long, n long")


def embedding_components(vectors: DataFrame, threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(vec_id, n_links, component_id)`` for every row of ``vectors (vec_id, embedding)``."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    classes = rows.where(usable()).groupBy("embedding").agg(F.min("vec_id").alias("first"), F.count("*").alias("n"))
    classes = common.written(classes.withColumn("class", F.monotonically_increasing_id()), "classes")
    lengths = sorted(r["d"] for r in classes.select(F.size("embedding").alias("d")).distinct().collect())
    found = [_links(classes.where(F.size("embedding") == d).select("class", "embedding", "n"), d, threshold, block_bytes) for d in lengths]
    if not found:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    links = found[0]
    for more in found[1:]:
        links = links.union(more)
    links = common.written(links, "links")
    counts = links.groupBy("u").agg(F.sum("n").alias("linked"))
    roots = connected_components(links.select("u", "v"))
    known = classes.join(counts, F.col("class") == F.col("u"), "left").join(roots, F.col("class") == F.col("node"), "left")
    known = known.select("embedding", "first", (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), F.coalesce("root", "class").alias("root"))
    least = known.groupBy("root").agg(F.min("first").alias("component_id"))
    known = known.join(least, "root").select(F.col("embedding").alias("known"), "n_links", "component_id")
    joined = rows.join(known, F.col("embedding") == F.col("known"), "left")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("known").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and verdict of every vector."""
    found = embedding_components(common.read_table(spark, sf_dir, "embeddings"))
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
