"""What several operators share: words, folds, scratch tables, row ranks, links to classes."""

from __future__ import annotations

import ctypes
import gc
import sys
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from itertools import repeat
from weakref import WeakKeyDictionary

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from bannerloom.session import scratch_dir

# fixed values of the text contracts
WHITE = " \t\n\x0b\x0c\r"
WORD_GAP = "[\\x20\\x09-\\x0D]+"
#: Keys that a Memory holds (twice as many at most), and their greatest length.
REMEMBERED, REMEMBERED_LENGTH = 200_000, 48
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Memory(dict):
    """Remembers a function's results for short keys: when full, only what is asked for again stays."""

    def __init__(self, compute):
        self.compute, self.old = compute, {}

    def __missing__(self, key: str | bytes) -> bytes:
        got = self.old.pop(key, None)
        if got is None:
            got = self.compute(key)
        if len(key) <= REMEMBERED_LENGTH:
            if len(self) >= REMEMBERED:
                self.old = dict(self)
                self.clear()
            self[key] = got
        return got


#: Functions whose results a Python worker keeps from task to task.
_kept: list[Callable] = []


def kept(cached: Callable) -> Callable:
    """Registers a function with an ``lru_cache``, so that tasks of other operators can empty it."""
    _kept.append(cached)
    return cached


def let_go(but: Callable | None = None) -> None:
    """Empties what earlier tasks have left in this Python worker, which outlives them, ``but`` one function's.

    What Arrow and the C library keep of freed memory goes back to the system.
    """
    for cached in _kept:
        if cached is not but:
            cached.cache_clear()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux" and (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)):  # not all C libraries have it
        trim(0)


#: Bytes of rows that Spark sends to Python at once.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Has Spark send Python at most about ``BATCH_BYTES`` at once, or one longer row.

    Each task holds a batch several times over, in the JVM beside its heap and in the worker.
    It stays so for the session, as what operators return is computed later; less stays less.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
    if not 0 < now <= BATCH_BYTES:
        spark.conf.set(key, f"{BATCH_BYTES}b")


def words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased (``bytes`` methods touch ASCII only)."""
    return (text or "").encode().lower().split()


def hashed(found: list[bytes]) -> np.ndarray:
    """64-bit hashes of words. Each is hashed whenever it is met: to look words up takes more time and memory,
    as a corpus has more different ones than a task can remember."""
    return np.frombuffer(b"".join(map(xxhash.xxh64_digest, found, repeat(17))), ">u8").astype(np.uint64)


def distinct(numbers: np.ndarray) -> np.ndarray:
    """In order, each once: sorted, as ``np.unique`` alone puts them into a hash table, which is slow for many."""
    ordered = np.sort(numbers)
    return ordered[np.append(True, ordered[1:] != ordered[:-1])[: len(ordered)]]


def fold(column: Column, folds: int) -> Column:
    """crc32 of the value as text, modulo ``folds``; null for a null value."""
    return F.crc32(column.cast("string").cast("binary")) % folds


#: Bytes of deleted tables after which the shuffles behind them are worth looking for.
LARGE = 4 << 20
#: Paths of staged tables that are still there, by the DataFrame that reads each.
_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
#: For each scope that is open, the paths staged in it.
_scopes: list[list[tuple[SparkSession, str]]] = []


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again: cuts lineage, fixes generated ids."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    if _scopes:
        _scopes[-1].append((spark, path))
    table = spark.read.schema(df.schema).parquet(path)
    _paths[table] = path
    return table


def _folder(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _let_shuffles_go(spark: SparkSession) -> None:
    """Has Spark remove the files of shuffles that nothing refers to any more.

    It does so when Python and the driver's JVM have collected their garbage; plans that
    have just ended are let go a moment later, so that is done twice.
    """
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.5)


def _delete(spark: SparkSession, paths: list[str]) -> None:
    size = 0
    for path in paths:
        place, files = _folder(spark, path)
        if files.exists(place):
            size += files.getContentSummary(place).getLength()
            files.delete(place, True)
    if size >= LARGE:
        _let_shuffles_go(spark)


def settle(table: DataFrame) -> None:
    """After a staged table, if it is large: lets go what was shuffled so far."""
    place, files = _folder(table.sparkSession, _paths[table])
    if files.getContentSummary(place).getLength() >= LARGE:
        _let_shuffles_go(table.sparkSession)


def free(*tables: DataFrame) -> None:
    """Deletes staged tables that nothing that is still to be computed reads."""
    if tables:
        _delete(tables[0].sparkSession, [p for p in (_paths.pop(t, None) for t in tables) if p])


@contextmanager
def scope() -> Iterator[list[tuple[SparkSession, str]]]:
    """Collects what is staged inside it, for ``release``; what is still there at its end belongs to the scope around it."""
    made: list[tuple[SparkSession, str]] = []
    _scopes.append(made)
    try:
        yield made
    finally:
        _scopes.pop()
        if _scopes:
            _scopes[-1].extend(made)


def release(made: list[tuple[SparkSession, str]], *still_read: DataFrame) -> None:
    """Deletes the tables of a scope but those whose files ``still_read`` reads."""
    files = [f for df in still_read for f in df.inputFiles()]
    gone = [(spark, path) for spark, path in made if not any(f"/{path.rsplit('/', 1)[-1]}/" in f for f in files)]
    made[:] = [x for x in made if x not in gone]
    if gone:
        _delete(gone[0][0], [path for _, path in gone])


def staged_result(df: DataFrame, name: str, made: list[tuple[SparkSession, str]]) -> DataFrame:
    """``df`` staged, and the other tables of the scope it was made in deleted."""
    table = stage(df, name)
    release(made, table)
    return table


def numbered(df: DataFrame, key: str) -> DataFrame:
    """Adds ``__part`` and ``__idx``: the task's number and the row's place among its ``key`` there.

    The numbers are only fixed once the result is written (``stage``). The number of
    different keys has to be bounded, as each task keeps a counter for each.
    """
    return df.mapInArrow(lambda batches: number(batches, key), T.StructType([*df.schema.fields, *NUMBERS]))


NUMBERS = [T.StructField("__part", T.LongType()), T.StructField("__idx", T.LongType())]


def number(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """What ``numbered`` does in a task, for functions that make the rows there: another step would take a second Python worker."""
    part, seen = TaskContext.get().partitionId(), {}
    for batch in batches:
        keys = pd.Series(batch.column(key).to_numpy(zero_copy_only=False))
        idx = keys.groupby(keys).cumcount() + keys.map(seen).fillna(0).astype("int64")
        for k, n in keys.value_counts().items():
            seen[k] = seen.get(k, 0) + n
        more = [pa.array(np.full(len(keys), part, np.int64)), pa.array(idx.to_numpy(np.int64))]
        yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, *(f.name for f in NUMBERS)])


def with_rank(table: DataFrame, key: str) -> DataFrame:
    """``__rank``: the row's place among all rows of its ``key``, from 0, in a staged ``numbered`` table.

    No key is gathered or sorted: counts by (key, task) give each task its offset.
    """
    counts = table.groupBy(key, "__part").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(key).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(key, "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    return table.join(offsets, [key, "__part"]).withColumn("__rank", F.col("__before") + F.col("__idx"))


def classes(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, root): the smallest node that links (a, b) lead to, for every node that has a link.

    Alternating large and small stars on written tables: every round ties each node to the
    smallest known neighbour, so long chains shorten geometrically. Only smallest
    neighbours are aggregated, never lists, and the two sides of the join back are plain
    tables, so that a node with very many links is split by adaptive execution.
    """
    now = stage(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
        large = stage(
            both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct(),
            "large",
        )
        low = stage(large.groupBy("a").agg(F.min("b").alias("m")), "low")
        small = large.join(low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        after = stage(small.where("a <> b").distinct(), "links")
        # a forest of stars: no node is both an end and a root, and no end has two roots
        ends = stage(after.groupBy("a").agg(F.count("*").alias("n")), "ends")
        done = after.join(ends.withColumnRenamed("a", "b"), "b", "left_semi").isEmpty() and ends.where("n > 1").isEmpty()
        free(now, least, large, low, ends)
        if done:
            roots = after.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
        now = after
