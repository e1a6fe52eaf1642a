"""Whitening of embeddings with exact covariances by polarisation.

Of every dimension and of the sum of every two dimensions the squared centred values are
summed exactly, in integers. Cov(i, j) = (Var(i + j) - Var(i) - Var(j)) / 2 then gives all
covariances without an error, and the eigenvectors of that matrix are the components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bannerloom.llm.common import stage

#: An entry c is counted as floor(SCALE * c) + SHIFT, at most LARGEST away from 0 before the shift.
SCALE, SHIFT, LARGEST = 1024, 100_000, 1 << 50
#: Entries that a task takes at a time.
ENTRIES = 1 << 20
#: A component is given if its eigenvalue is more than this part of the largest.
LEAST_PART = 1e-10
WHOLE = pa.decimal128(38, 0)


class Space(NamedTuple):
    """What is known of the vectors of one length."""

    n: int
    centre: list[int]  # integer part of each dimension's mean
    rest: list[int]  # sum of the entries less n times the centre, from 0 to n - 1
    axes: np.ndarray | None = None  # a component in each column
    values: np.ndarray | None = None  # their eigenvalues
    trace: float = 0.0


def usable(vector: Column) -> Column:
    """Neither null nor with null or non-finite entries."""
    return F.coalesce(vector.isNotNull() & F.forall(vector, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))), F.lit(False))


def counted(vector: Column) -> Column:
    """The entries as whole numbers."""

    def whole(c: Column) -> Column:
        bound = F.lit(float(LARGEST))
        return (F.floor(F.least(F.greatest(F.lit(float(SCALE)) * c, -bound), bound)) + SHIFT).cast("long")

    return F.transform(vector.cast("array<double>"), whole)


def by_length(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Parts of the batches with vectors (the last column) of one length, and these as a matrix."""
    for batch in batches:
        vectors = batch.column(batch.num_columns - 1)
        lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
        for d in np.unique(lengths[lengths > 0]).tolist():
            rows = np.flatnonzero(lengths == d)
            step = max(1, ENTRIES // d)
            for at in range(0, len(rows), step):
                part = batch.take(pa.array(rows[at : at + step]))
                yield part, part.column(batch.num_columns - 1).flatten().to_numpy().reshape(-1, d)


def column_sums(x: np.ndarray, power: int = 1) -> list[int]:
    """Exact sums of each column, or of its squares."""
    most = int(np.abs(x).max(initial=0))
    if most**power * max(1, len(x)) >= 1 << 62:
        x = x.astype(object)
    return [int(s) for s in (x**power).sum(axis=0)]


def sums(rows: DataFrame, partial: Callable[[np.ndarray], list], kind: T.DataType) -> dict[int, list]:
    """For each length of vectors the sums of what ``partial`` gives for parts of their rows, first the number of rows.

    Each task adds up its own rows; what reaches the driver depends on the lengths alone.
    """
    arrow = WHOLE if isinstance(kind, T.DecimalType) else pa.float64()
    give = Decimal if isinstance(kind, T.DecimalType) else float
    schema = T.StructType([T.StructField("d", T.LongType()), T.StructField("sums", T.ArrayType(kind))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have: dict[int, list] = {}
        for _, x in by_length(batches):
            got = [len(x), *partial(x)]
            d = x.shape[1]
            have[d] = [a + b for a, b in zip(have[d], got)] if d in have else got
        if have:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(have), pa.int64()), pa.array([[give(v) for v in s] for s in have.values()], pa.list_(arrow))], ["d", "sums"]
            )

    each = rows.mapInArrow(run, schema).select("d", F.posexplode("sums").alias("at", "part"))
    out: dict[int, list] = {}
    for d, _, total in each.groupBy("d", "at").agg(F.sum(F.col("part")).alias("total")).orderBy("d", "at").collect():
        out.setdefault(d, []).append(int(total) if give is Decimal else total)
    return out


def pair_squares(x: np.ndarray) -> list[int]:
    """Exact sums of the squares of each dimension and of each two dimensions' sum: (0, 0), (0, 1), ..., (1, 1), ..."""
    out = []
    for i in range(x.shape[1]):
        out += column_sums(x[:, i : i + 1], 2)
        out += column_sums(x[:, i : i + 1] + x[:, i + 1 :], 2)
    return out


def fit(rows: DataFrame, components: int) -> dict[int, Space]:
    """The spaces of all ``rows`` (one column ``x`` of whole numbers), by the length of the vectors."""
    exact = T.DecimalType(38, 0)
    spaces = {}
    for d, (n, *total) in sums(rows, column_sums, exact).items():
        spaces[d] = Space(n, [s // n for s in total], [s % n for s in total])

    def centred_squares(x: np.ndarray) -> list[int]:
        return pair_squares(x - np.array(spaces[x.shape[1]].centre))

    for d, (_, *squares) in sums(rows, centred_squares, exact).items():
        n, _, rest, *_ = spaces[d]
        variance = np.zeros((d, d), object)  # of n times the entries, times n
        at = iter(squares)
        for i in range(d):
            for j in range(i, d):
                z = rest[i] if i == j else rest[i] + rest[j]
                variance[i, j] = n * n * next(at) - n * z * z
        covariance = np.zeros((d, d))
        for i in range(d):
            covariance[i, i] = variance[i, i] / n**3
            for j in range(i + 1, d):
                covariance[i, j] = covariance[j, i] = (variance[i, j] - variance[i, i] - variance[j, j]) / (2 * n**3)
        values, axes = np.linalg.eigh(covariance)
        values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
        signs = np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])])
        spaces[d] = spaces[d]._replace(axes=axes * signs, values=values, trace=float(np.trace(covariance)))
    return spaces


def given(space: Space) -> np.ndarray:
    """Which components have an eigenvalue that can be divided by."""
    return space.values > max(LEAST_PART * space.values[0], 0.0)


def project(rows: DataFrame, key: str, spaces: dict[int, Space]) -> DataFrame:
    """(key, d, deviation, whitened) of every row (key, x)."""
    schema = T.StructType(
        [rows.schema[key], T.StructField("d", T.LongType()), T.StructField("deviation", T.DecimalType(38, 0)), T.StructField("whitened", T.ArrayType(T.DoubleType()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in by_length(batches):
            d, k = x.shape[1], len(x)
            space = spaces[d]
            y = x - np.array(space.centre)
            rest = np.array(space.rest)
            if int(np.abs(y).max(initial=0)) * max(space.n, int(np.abs(y).max(initial=0))) * d >= 1 << 62:
                whole, remainders = y.astype(object), rest.astype(object)
            else:
                whole, remainders = y, rest
            # sum of (n y - r)^2 = n^2 sum y^2 - 2 n sum y r + sum r^2
            last = sum(r * r for r in space.rest)
            deviation = [
                Decimal(space.n * space.n * int(a) - 2 * space.n * int(b) + last)
                for a, b in zip((whole * whole).sum(axis=1), (whole * remainders).sum(axis=1))
            ]
            has = given(space)
            scores = np.zeros((k, len(has)))
            scores[:, has] = (y - rest / space.n) @ space.axes[:, has] / np.sqrt(space.values[has])
            flat = pa.array(scores.ravel(), mask=np.tile(~has, k))
            ends = pa.array(np.arange(k + 1, dtype=np.int32) * len(has))
            columns = [part.column(0), pa.array(np.full(k, d)), pa.array(deviation, WHOLE), pa.ListArray.from_arrays(ends, flat)]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return rows.select(key, "x").mapInArrow(run, schema)


def identity_error(projected: DataFrame, spaces: dict[int, Space]) -> float:
    """Largest absolute entry of the covariance of the whitened rows less the identity; 0 where nothing is whitened."""
    most = 0.0
    for d in sorted(spaces):
        has = np.flatnonzero(given(spaces[d])).tolist()
        if not has:
            continue
        rows = projected.where(F.col("d") == d).select(F.array(*[F.col("whitened")[c] for c in has]).alias("x"))
        k = len(has)
        (n, *mean) = sums(rows, lambda x: x.sum(axis=0).tolist(), T.DoubleType())[k]
        middle = np.array(mean) / n
        (_, *products) = sums(rows, lambda x: ((x - middle).T @ (x - middle)).ravel().tolist(), T.DoubleType())[k]
        most = max(most, float(np.abs(np.array(products).reshape(k, k) / n - np.eye(k)).max()))
    return most


def whiten(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", components: int = 8) -> DataFrame:
    """(key, n, deviation, whitened, explained, identity_error): a row for each vector that can be used.

    ``whitened`` has the vector's coordinates along the first ``components`` principal
    components (fewer, if it is shorter), each with variance 1 over all vectors, and
    ``explained`` the part of the whole variance that lies along each. ``deviation`` is the
    exact sum over the dimensions of (n * entry - sum of the entries)^2. Entries are taken
    as floor(1024 c) + 100000; those beyond 2^50 in size count as 2^50.

    Null vectors and those with null or non-finite entries are left out, and so are empty
    ones, which have no component. Vectors of different lengths are whitened apart: ``n``
    counts those of the same length. Repeated rows and null or repeated keys are rows of
    their own. A component without variance has null in ``whitened``; if nothing varies,
    ``explained`` is null too. Components of equal variance come in any order, the same for
    all rows. An empty table gives an empty one. Only the two columns are read, so others
    may have any names. Sums of a task are arrays of d (d + 1) / 2 numbers for length d.
    """
    usable_rows = vectors.where(usable(F.col(column))).select(F.col(key), counted(F.col(column)).alias("x"))
    spaces = fit(usable_rows.select("x"), components)
    projected = stage(project(usable_rows, key, spaces), "whitened")
    spark = vectors.sparkSession
    about = spark.createDataFrame(
        [(d, s.n, [float(v / s.trace) if s.trace > 0 else None for v in np.maximum(s.values, 0.0)]) for d, s in spaces.items()],
        "d long, n long, explained array<double>",
    )
    error = identity_error(projected, spaces)
    # one row for each length that occurs
    return projected.join(F.broadcast(about), "d").select(key, "n", "deviation", "whitened", "explained", F.lit(error).alias("identity_error"))
