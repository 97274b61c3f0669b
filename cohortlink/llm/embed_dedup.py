"""Operator 1: embedding near-duplicates by int8 tile products with error bounds.

Every distinct vector is scaled to unit length and quantised to int8 with a
scale s and the exact error e = |x - s q|.  For two unit vectors

    x . y  <=  s_x s_y (q_x . q_y) + (1 + e_x) e_y + e_x ,

so a pair whose int8 product stays below the threshold minus that bound cannot
be a link.  Blocks of vectors meet in tiles (one task per pair of blocks); the
int8 products run as one exact float32 matrix product per sub-tile, and only
the pairs possibly above the threshold are recomputed in double precision.

A tile returns, per vector, its number of links and one link to a smaller
vector of the same tile-local component, so a group of near copies is never
expanded to rows for all its pairs.  Equal vectors are one row with a
multiplicity.  The work is quadratic in the number of distinct vectors (an
exact search without an index); the rows moved are vectors times blocks.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components link with nothing; vectors of different lengths do not link; rows
with a null id keep their row, link with nothing and are kept.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlink.llm.common import materialise, prepare
from cohortlink.llm.graph import components

THRESHOLD = 0.95
#: vectors of a block; a tile holds two
BLOCK = 8192
#: rows of a sub-tile, pairs recomputed at a time
STRIP, PAIRS = 512, 1 << 16
#: rounding of the double-precision bound arithmetic, far above what it can lose
SLACK = 1e-9


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit rows -> int8 rows (as float32, exact), scales, errors."""
    scale = np.abs(x).max(axis=1) / 127
    q = np.rint(x / scale[:, None])
    return q.astype(np.float32), scale, np.linalg.norm(x - scale[:, None] * q, axis=1)


def candidates(qa, sa, ea, qb, sb, eb, threshold: float):
    """Pairs (i, j) of a sub-tile whose bound reaches the threshold."""
    need = threshold - SLACK - (1 + ea) * eb.max() - ea
    # int8 products stay below 2**24 for up to 1040 components; longer vectors are summed in double
    dots = qa @ qb.T if qa.shape[1] <= 1040 else qa.astype(np.float64) @ qb.T.astype(np.float64)
    # a negative `need` (very coarse quantisation) lets every pair through
    least = np.where(need > 0, need / (sa * sb.max()), -np.inf)
    i, j = np.nonzero(dots >= least[:, None].astype(dots.dtype) * (1 - 1e-6 * (least[:, None] > 0)).astype(dots.dtype))
    ok = sa[i] * sb[j] * dots[i, j] + (1 + ea[i]) * eb[j] + ea[i] >= threshold - SLACK
    return i[ok], j[ok]


def tile_links(ids: np.ndarray, mult: np.ndarray, x: np.ndarray, first: int, same: bool, threshold: float):
    """Links per row and tile-local component of the rows of a tile.

    Rows up to ``first`` are one block, the rest the other; ``same``: one block with itself.
    """
    norm = np.sqrt((x * x).sum(axis=1))
    q, s, e = quantise(x / norm[:, None])
    links, label = np.zeros(len(ids), np.int64), np.arange(len(ids))
    base = 0 if same else first
    for k in range(0, first, STRIP):
        a = slice(k, min(k + STRIP, first))
        b = slice(k, len(ids)) if same else slice(base, len(ids))
        if b.start >= b.stop:
            break
        i, j = candidates(q[a], s[a], e[a], q[b], s[b], e[b], threshold)
        i, j = i + a.start, j + b.start
        if same:
            i, j = i[i < j], j[i < j]
        for p in range(0, len(i), PAIRS):
            u, v = i[p:p + PAIRS], j[p:p + PAIRS]
            ok = np.einsum("ij,ij->i", x[u], x[v]) >= threshold * (norm[u] * norm[v])
            u, v = u[ok], v[ok]
            np.add.at(links, u, mult[v])
            np.add.at(links, v, mult[u])
            _join(label, u, v)
    return links, label


def _join(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Gives linked rows one label, the smallest row."""
    while len(u):
        lu, lv = label[u], label[v]
        far = lu != lv
        u, v, lu, lv = u[far], v[far], lu[far], lv[far]
        np.minimum.at(label, np.maximum(lu, lv), np.minimum(lu, lv))
        while not np.array_equal(label, up := label[label]):
            label[:] = up


def compare_tile(pdf: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Rows of one tile -> rep, links, root (the smallest id of its tile-local component)."""
    out = []
    same = bool((pdf["i"] == pdf["j"]).iloc[0])
    for _, g in pdf.groupby("dim"):
        g = g.sort_values(["side", "rep"])
        ids, first = g["rep"].to_numpy(), len(g) if same else int((g["side"] == 0).sum())
        links, label = tile_links(ids, g["mult"].to_numpy(), np.stack(g["x"].to_numpy()).astype(np.float64),
                                  first, same, threshold)
        root = pd.Series(ids).groupby(label).transform("min").to_numpy()
        keep = links > 0
        out.append(pd.DataFrame({"rep": ids[keep], "links": links[keep], "root": root[keep]}))
    return pd.concat(out)


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per vector."""
    prepare(vectors.sparkSession)
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("x"))
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    ok = F.col("vec_id").isNotNull() & F.coalesce(finite & F.exists("x", lambda c: c != 0), F.lit(False))
    v = v.withColumn("x", F.when(ok, F.col("x")))
    classes = materialise(v.where("x is not null").groupBy("x").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("mult")), "vectors")
    blocks = max(1, math.ceil(classes.count() / block))
    mine = F.pmod(F.xxhash64("rep"), F.lit(blocks)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    tiles = classes.withColumn("mine", mine).withColumn("other", other).select(
        F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
        (F.col("mine") > F.col("other")).cast("int").alias("side"), "rep", "mult", F.size("x").alias("dim"), "x")
    found = tiles.repartition(blocks * (blocks + 1) // 2, "i", "j").groupBy("i", "j").applyInPandas(
        lambda pdf: compare_tile(pdf, threshold), "rep long, links long, root long")
    found = materialise(found, "tile_links")
    label = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    known = classes.join(counts, "rep", "left").join(label.withColumnRenamed("node", "rep"), "rep", "left").select(
        "x", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n"), F.coalesce("component", "rep").alias("c"))
    comp = F.coalesce("c", "vec_id")
    return v.join(known, "x", "left").select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), comp.alias("component_id"),
        F.coalesce(F.col("vec_id") == comp, F.lit(True)).alias("kept"))
