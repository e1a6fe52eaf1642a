"""Embedding near-duplicates: tiles in the order of principal components, compared dimension block by block."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bannerloom.llm.common import classes, stage

#: Vectors that the principal components are fitted on. They only decide how early a pair is dropped.
BASIS_ROWS = 4_096
#: Rows of a tile; a cell with more is cut into several.
TILE_ROWS = 1_024
#: Leading dimensions taken before each test of the bound.
BLOCK = 16
LINKS = "cid long, links long, root long"


def comparable(vector: Column) -> Column:
    """Not null, no null or non-finite component, not all zero."""
    fine = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def fit_basis(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Principal components by dimension, of a bounded sample of different vectors, in hash order."""
    sample = vectors.select("e").orderBy(F.xxhash64("e"), "e").limit(BASIS_ROWS).toPandas()["e"]
    found: dict[int, list[np.ndarray]] = {}
    for v in sample:
        found.setdefault(len(v), []).append(unit(np.asarray(v, float)[None, :])[0])
    return {d: np.linalg.svd(np.array(vs).T @ np.array(vs))[0] for d, vs in found.items()}


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def linked(a: np.ndarray, b: np.ndarray, basis: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows of ``a`` and ``b`` (unit vectors) have a cosine of ``threshold`` or more.

    Leading components are accumulated first. What the others can still add is at most
    the product of their norms; pairs that cannot reach the threshold with it are left.
    Those that stay are decided by the cosine of the vectors themselves.
    """
    za, zb = a @ basis, b @ basis
    d = za.shape[1]
    rows, cols, partial = None, None, np.zeros((len(a), len(b)))
    for at in range(0, d, BLOCK):
        to = min(at + BLOCK, d)
        ra, rb = (np.sqrt(np.maximum(0, (z[:, to:] ** 2).sum(axis=1))) for z in (za, zb))
        if rows is None:
            partial += za[:, at:to] @ zb[:, at:to].T
            alive = partial + ra[:, None] * rb[None, :] >= threshold - 1e-9
            if alive.sum() * 8 > alive.size and to < d:
                continue  # many are alive: go on with whole blocks
            rows, cols = np.nonzero(alive)
            partial = partial[rows, cols]
        else:
            partial = partial + np.einsum("ij,ij->i", za[rows, at:to], zb[cols, at:to])
            alive = partial + ra[rows] * rb[cols] >= threshold - 1e-9
            rows, cols, partial = rows[alive], cols[alive], partial[alive]
        if not len(rows):
            break
    out = np.zeros((len(a), len(b)), bool)
    for at in range(0, len(rows), 200_000):
        r, c = rows[at : at + 200_000], cols[at : at + 200_000]
        out[r, c] = np.einsum("ij,ij->i", a[r], b[c]) >= threshold
    return out


def near(vectors: DataFrame, threshold: float) -> DataFrame:
    """Links of the different vectors (cid, part, e, n): (cid, links, root), summed over tiles and without own copies.

    ``root`` ties a vector to the smallest cid it is connected with in one pair of tiles,
    so the rows grow with the vectors in each tile and not with the pairs.
    """
    spark = vectors.sparkSession
    basis = spark.sparkContext.broadcast(fit_basis(vectors))
    width = float(np.sqrt(2 - 2 * threshold)) + 1e-6  # unit vectors that link are nowhere further apart

    @F.pandas_udf("array<int>")
    def cell(es: pd.Series) -> pd.Series:
        out = []
        for e in es:
            v = unit(np.asarray(e, float)[None, :])[0]
            z = v @ basis.value[len(v)][:, :2] if len(v) in basis.value else v[:2]
            out.append(np.floor(np.append(z, [0.0, 0.0])[:2] / width).astype(np.int32))
        return pd.Series(out, dtype=object)

    celled = stage(vectors.withColumn("c", cell("e")).select("cid", "n", "e", "part", F.col("c")[0].alias("c1"), F.col("c")[1].alias("c2")), "cells")
    # a cell is cut by hash into tiles of about TILE_ROWS, so no task gets a large cell whole
    cut = celled.groupBy("part", "c1", "c2").agg(F.ceil(F.count("*") / TILE_ROWS).cast("int").alias("cuts"))
    tiles = stage(cut, "tiles")
    tiled = celled.join(tiles, ["part", "c1", "c2"]).withColumn("cut", F.pmod(F.xxhash64("cid"), F.col("cuts")).cast("int"))
    steps = [(0, 0), (0, 1), (1, -1), (1, 0), (1, 1)]
    step = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in steps])
    own = tiles.select("part", "c1", "c2", "cuts", F.explode(step).alias("s"))
    other = tiles.select("part", F.col("c1").alias("d1"), F.col("c2").alias("d2"), F.col("cuts").alias("dcuts"))
    pairs = (
        own.withColumns({"d1": F.col("c1") + F.col("s.x"), "d2": F.col("c2") + F.col("s.y")})
        .join(other, ["part", "d1", "d2"])
        .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
        .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("dcuts") - 1)))
        .where("c1 <> d1 or c2 <> d2 or i <= j")
        .withColumn("pair", F.xxhash64("part", "c1", "c2", "i", "d1", "d2", "j"))
        .withColumn("same", F.expr("c1 = d1 and c2 = d2 and i = j"))
    )
    pairs = stage(pairs.select("part", "c1", "c2", "i", "d1", "d2", "j", "pair", "same"), "pairs")
    left = tiled.join(pairs.withColumnRenamed("i", "cut"), ["part", "c1", "c2", "cut"]).select(*[F.col(c).alias(c) for c in ("pair", "same", "cid", "n", "e")])
    right = (
        tiled.withColumnsRenamed({"c1": "d1", "c2": "d2", "cut": "j"})
        .join(pairs.where("not same"), ["part", "d1", "d2", "j"])
        .select(*[F.col(c).alias(c) for c in ("pair", "same", "cid", "n", "e")])
    )

    def compare(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or (not len(b) and not a["same"].iloc[0]):
            return pd.DataFrame({"cid": [], "links": [], "root": []})
        same = bool(a["same"].iloc[0])
        b = a if same else b
        xa, xb = (unit(np.array(x["e"].tolist(), float)) for x in (a, b))
        space = basis.value.get(xa.shape[1], np.eye(xa.shape[1]))
        ca, cb, na, nb = a["cid"].to_numpy(), b["cid"].to_numpy(), a["n"].to_numpy(), b["n"].to_numpy()
        counts, parts, edges = [], [], []
        for at in range(0, len(xa), 2 * TILE_ROWS):
            for to in range(0, len(xb), 2 * TILE_ROWS):
                mask = linked(xa[at : at + 2 * TILE_ROWS], xb[to : to + 2 * TILE_ROWS], space, threshold)
                if same:
                    mask &= ca[at : at + 2 * TILE_ROWS, None] != cb[None, to : to + 2 * TILE_ROWS]
                if not mask.any():
                    continue
                la, lb = ca[at : at + 2 * TILE_ROWS].copy(), cb[to : to + 2 * TILE_ROWS].copy()
                counts.append(pd.DataFrame({"cid": la.copy(), "links": mask @ nb[to : to + 2 * TILE_ROWS]}))
                if not same:
                    counts.append(pd.DataFrame({"cid": lb.copy(), "links": mask.T @ na[at : at + 2 * TILE_ROWS]}))
                top = np.iinfo(np.int64).max
                r, c = mask.any(axis=1), mask.any(axis=0)
                small = mask[np.ix_(r, c)]
                ids_a, ids_b = la[r], lb[c]
                ra, rb = ids_a.copy(), ids_b.copy()
                while True:
                    ra2 = np.minimum(ra, np.where(small, rb[None, :], top).min(axis=1))
                    rb2 = np.minimum(rb, np.where(small, ra2[:, None], top).min(axis=0))
                    if (ra2 == ra).all() and (rb2 == rb).all():
                        break
                    ra, rb = ra2, rb2
                edges += [pd.DataFrame({"cid": ids_a, "root": ra}), pd.DataFrame({"cid": ids_b, "root": rb})]
        if not counts:
            return pd.DataFrame({"cid": [], "links": [], "root": []})
        total = pd.concat(counts).groupby("cid", as_index=False)["links"].sum()
        total = total[total["links"] > 0].assign(root=total["cid"])
        tie = pd.concat(edges).drop_duplicates()
        return pd.concat([total, tie[tie["cid"] != tie["root"]].assign(links=0)])[["cid", "links", "root"]]

    return left.groupBy("pair").cogroup(right.groupBy("pair")).applyInPandas(compare, LINKS)


def dedup(vectors: DataFrame, threshold: float = 0.93, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """One row for each vector: its id, ``n_links``, ``component_id``, ``kept``.

    Vectors link when label and dimension are equal and the cosine (double precision) is
    at least ``threshold``. Null, zero and non-finite vectors, vectors with a null
    component and those without a label link with nothing: no links, their own component,
    kept. Equal vectors of a label are compared once and counted as often as they occur,
    so a group of copies of any size costs one row; they link with each other. A repeated
    id is one row for each vector; a null id has a null component unless it links, and is
    kept if it links with no smaller id. An empty table gives an empty one; other columns
    are not read.
    """
    rows = vectors.select(
        F.col(vec_id).alias("vec_id"),
        F.when(F.col(label).isNotNull() & comparable(F.col(embedding)), F.col(embedding).cast("array<double>")).alias("e"),
        F.col(label).alias("label"),
    )
    usable = rows.where("e is not null").select("vec_id", F.transform("e", lambda x: x + F.lit(0.0)).alias("e"), "label")
    distinct = usable.groupBy("label", "e").agg(F.min("vec_id").alias("first"), F.count("*").alias("n"))
    distinct = stage(distinct.withColumn("cid", F.monotonically_increasing_id()), "vectors")
    part = distinct.select("cid", "n", "e", F.struct("label", F.size("e").alias("d")).alias("part"))
    found = stage(near(part, threshold), "near")
    roots = stage(classes(vectors.sparkSession, found.where("cid <> root").select(F.col("cid").alias("a"), F.col("root").alias("b"))), "roots")
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    known = (
        distinct.join(links, "cid", "left")
        .join(roots, distinct["cid"] == roots["node"], "left")
        .select("label", "e", "first", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "cid").alias("root"))
    )
    known = stage(known, "known")
    smallest = known.groupBy("root").agg(F.min("first").alias("component_id"))
    verdicts = stage(known.join(smallest, "root").select("label", "e", "n_links", "component_id"), "verdicts")
    joined = usable.join(verdicts, ["label", "e"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("e is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return joined.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
