"""Sharding: a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bannerloom.llm.common import numbered, stage, with_rank


def ring(shards: int, nodes: int, seed: str) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all virtual nodes in order, and the shard of each."""
    at = sorted((xxhash.xxh64_intdigest(f"{seed}|{s}|{v}"), s) for s in range(shards) for v in range(nodes))
    return np.array([p for p, _ in at], np.uint64), np.array([s for _, s in at], np.int64)


def fill(counts: dict[int, int], owners: np.ndarray, room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(arc, first rank, end rank, shard, first slot): where the keys of each arc go.

    Arcs are taken clockwise. The keys of an arc go to the shard of its node; what
    finds it full goes on to the next node clockwise, and so on. Each step ends an arc
    or fills a shard, so there are at most as many pieces as arcs and shards.
    """
    left, used, out = list(room), [0] * len(room), []
    for arc in range(len(owners)):
        lo, node = 0, arc
        while lo < counts.get(arc, 0):
            s = int(owners[node % len(owners)])
            take = min(left[s], counts[arc] - lo)
            if take:
                out.append((arc, lo, lo + take, s, used[s]))
                left[s], used[s], lo = left[s] - take, used[s] + take, lo + take
            node += 1
    return out


def place(docs: DataFrame, key: str, shards: int = 8, nodes: int = 128, slack: float = 0.0, seed: str = "ring") -> DataFrame:
    """``docs`` and ``shard`` and ``slot`` (gapless from 0 in each shard).

    A shard takes at most (1 + slack) of its equal share of the rows, rounded so that
    without slack the counts are at most one apart. Only counts by arc (shards x nodes
    numbers) reach the driver. Rows with equal or null keys share a ring position and are
    told apart by their rank in the arc, so one key may hold any part of the rows. Input
    columns named ``shard`` or ``slot`` are replaced; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    points, owners = ring(shards, nodes, seed)
    docs = docs.drop("shard", "slot")
    rows = docs.withColumn("__arc", F.xxhash64(F.lit(seed), F.col(key)))

    def arcs(batches):
        for batch in batches:
            at = batch.column(batch.num_columns - 1).to_numpy().view(np.uint64)
            arc = pa.array(np.searchsorted(points, at).astype(np.int64) % len(points))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], arc], batch.schema.names)

    table = stage(numbered(rows.mapInArrow(arcs, rows.schema), "__arc"), "ring")
    counts = {r[0]: r[1] for r in table.groupBy("__arc").count().collect()}
    total = sum(counts.values())
    room = [(total + shards - 1 - s) // shards for s in range(shards)]
    room = [n + int(n * slack) for n in room]
    pieces = spark.createDataFrame(
        pd.DataFrame(fill(counts, owners, room), columns=["__arc", "__lo", "__hi", "shard", "__slot"], dtype="int64"),
        T.StructType([T.StructField(c, T.LongType()) for c in ("__arc", "__lo", "__hi", "shard", "__slot")]),
    )
    ranked = with_rank(table, "__arc")
    return ranked.join(
        F.broadcast(pieces),
        (ranked["__arc"] == pieces["__arc"]) & (F.col("__rank") >= F.col("__lo")) & (F.col("__rank") < F.col("__hi")),
    ).select(
        *docs.columns, F.col("shard").cast("int").alias("shard"), (F.col("__slot") + F.col("__rank") - F.col("__lo")).alias("slot")
    )
