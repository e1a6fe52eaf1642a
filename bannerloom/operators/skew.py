"""Window and fold primitives that keep working when one key is very large.

A plain ``Window.partitionBy(key)`` or ``collect_list`` puts every row of a key
into one task. The functions below look for large keys first (a row count, and
for a large table a sample of the key columns). Usually there is none and the
plain window is returned. Otherwise only the large keys are cut into ordered pieces,
the pieces are worked on in parallel, and what earlier pieces contribute is
added. Results are the same as those of the plain window.

``hot_keys`` lists every key that SUPPORT sampled rows speak for, so at most
SAMPLE_ROWS / SUPPORT keys whatever the input size: the driver can hold them and they
can be broadcast. A key outside that list holds about HOT_ROWS rows or less than
SUPPORT / SAMPLE_ROWS of the table, which is a task's share of a table that large.

The inputs are read more than once: pass tables, or write an expensive plan
first.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from bannerloom.session import scratch_dir

HOT_ROWS = 1_000_000
SAMPLE_ROWS = 2_000_000
FOLD_ROWS = 100_000  # rows of one key that may be gathered in an array
SUPPORT = 20  # sampled rows of a key below which the sample says nothing about it
# Spark bounds row_number() <= k before the shuffle only up to this k
# (spark.sql.optimizer.windowGroupLimitThreshold).
GROUP_LIMIT_MAX = 1_000

Order = Sequence[tuple[str, bool]]  # (column, ascending)


def sort_columns(order: Order) -> list[Column]:
    """Nulls first when ascending, last when descending."""
    return [F.col(c).asc_nulls_first() if asc else F.col(c).desc_nulls_last() for c, asc in order]


def follows(row: dict[str, Column], mark: dict[str, Column], order: Order, or_equal: bool) -> Column:
    """Does ``row`` come after ``mark`` in the order? Null-safe, lexicographic."""
    result = F.lit(or_equal)
    for name, asc in reversed(list(order)):
        r, m = row[name], mark[name]
        strictly = (
            (m.isNull() & r.isNotNull()) | F.coalesce(r > m, F.lit(False))
            if asc
            else (m.isNotNull() & r.isNull()) | F.coalesce(r < m, F.lit(False))
        )
        result = strictly | (r.eqNullSafe(m) & result)
    return result


def hot_keys(df: DataFrame, keys: Sequence[str], min_rows: int | None = None) -> DataFrame | None:
    """Keys with about ``min_rows`` rows or more and that number ``_n``, or None.

    A table with fewer rows has no such key. In a larger one than SAMPLE_ROWS
    the keys are found in a sample: it only decides which keys are cut, and a key
    with a noticeable share of the rows cannot be missed. At least SUPPORT sampled
    rows are asked for, so noise is not taken for a large key.
    """
    min_rows = HOT_ROWS if min_rows is None else min_rows
    total = df.count()
    if total < min_rows:
        return None
    share = min(1.0, SAMPLE_ROWS / total)
    some = df.select(*keys) if share == 1.0 else df.select(*keys).sample(share, seed=0)
    largest = (
        some.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_some"))
        .withColumn("_n", F.ceil(F.col("_some") / share))
        .where((F.col("_n") >= min_rows) if share == 1.0 else (F.col("_n") >= min_rows // 2) & (F.col("_some") >= SUPPORT))
        .drop("_some")
    )
    rows = largest.collect()
    return df.sparkSession.createDataFrame(rows, largest.schema) if rows else None


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows of the largest key."""
    return df.groupBy(*keys).count().agg(F.max("count").alias("n")).first()["n"] or 0


def join_unique(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left", min_rows: int | None = None
) -> DataFrame:
    """Left or inner join with a right side that has one row per key.

    Adaptive skew splitting does not reach a join whose side is an aggregate or
    a window. Here the left rows of large keys are joined to the few right rows
    of those keys, which are broadcast, and the rest
    as usual. A stream is joined as usual.
    """
    hot = None if left.isStreaming else hot_keys(left, keys, min_rows)
    if hot is None:
        return left.join(right, list(keys), how)
    marks = F.broadcast(hot.select(*keys, F.lit(True).alias("_hot")))
    marked = _attach(left, marks, keys, small=True)
    few = F.broadcast(right.join(F.broadcast(hot.select(*keys)), list(keys), "left_semi"))
    usual = marked.where(F.col("_hot").isNull()).drop("_hot").join(right, list(keys), how)
    large = marked.where(F.col("_hot")).drop("_hot").join(few, list(keys), how)
    return usual.unionByName(large)


def _attach(left: DataFrame, right: DataFrame, keys: Sequence[str], small: bool) -> DataFrame:
    """Left join on null-safe keys, keeping the key columns of ``left``."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys])
    return left.join(F.broadcast(renamed) if small else renamed, cond, "left").drop(*[f"_r_{k}" for k in keys])


def _parted(df: DataFrame, keys: Sequence[str], min_rows: int | None) -> tuple[DataFrame, DataFrame | None]:
    """The rows of usual keys and those of large ones (None if there are none)."""
    hot = hot_keys(df, keys, min_rows)
    if hot is None:
        return df, None
    marked = _attach(df, hot.select(*keys, F.lit(True).alias("_hot")), keys, small=True)
    return marked.where(F.col("_hot").isNull()).drop("_hot"), marked.where(F.col("_hot")).drop("_hot")


def _in_pieces(df: DataFrame, keys: Sequence[str], order: Order) -> DataFrame:
    """Range partitions by key and order, written, with ``_piece`` and ``_id``, which grows along both.

    The rows are written as their partitions must not change afterwards. A key fills as
    many pieces as its rows need, whatever values the order has.
    """
    sort = [*[F.col(k).asc_nulls_first() for k in keys], *sort_columns(order)]
    ranged = df.repartitionByRange(*sort).sortWithinPartitions(*sort).withColumn("_id", F.monotonically_increasing_id())
    path = scratch_dir(df.sparkSession, "pieces")
    ranged.withColumn("_piece", F.shiftright("_id", 33)).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _scanned(
    df: DataFrame,
    keys: Sequence[str],
    order: Order,
    own: Callable[[WindowSpec], Column],
    summary: Column,
    carry: Callable[[Column, WindowSpec], Column],
    both: Callable[[Column, Column], Column],
    out: str,
) -> DataFrame:
    """A prefix scan in parallel: what a window gives in each piece, and what the pieces before pass on.

    ``own`` is computed in each piece, ``summary`` aggregates a piece's rows of a key, ``carry``
    scans the summaries of a key's pieces, and ``both`` puts a row's own value and what is
    carried into its piece together. There are at most as many summaries as large keys
    and pieces, so they are broadcast.
    """
    cut = _in_pieces(df, keys, order)
    parts = cut.groupBy(*keys, "_piece").agg(summary.alias("_s"))
    passed = parts.withColumn("_carry", carry(F.col("_s"), Window.partitionBy(*keys).orderBy("_piece"))).drop("_s")
    inside = cut.withColumn("_own", own(Window.partitionBy(*keys, "_piece").orderBy("_id")))
    joined = _attach(inside, passed, [*keys, "_piece"], small=True)
    return joined.select(*df.columns, both(F.col("_own"), F.col("_carry")).alias(out))


def running_max(df: DataFrame, keys: Sequence[str], order: Order, value: Column, out: str, min_rows: int | None = None) -> DataFrame:
    """max(value) over all rows of the key up to the current one; ``order`` must be total within a key."""
    before_and_here = (Window.unboundedPreceding, Window.currentRow)
    usual, large = _parted(df, keys, min_rows)
    done = usual.withColumn(out, F.max(value).over(Window.partitionBy(*keys).orderBy(*sort_columns(order)).rowsBetween(*before_and_here)))
    if large is None:
        return done
    return done.unionByName(
        _scanned(
            large, keys, order,
            own=lambda w: F.max(value).over(w.rowsBetween(*before_and_here)),
            summary=F.max(value),
            carry=lambda s, w: F.max(s).over(w.rowsBetween(Window.unboundedPreceding, -1)),
            both=F.greatest,  # passes over NULLs
            out=out,
        )
    )


def previous_row(df: DataFrame, keys: Sequence[str], order: Order, columns: dict[str, str], min_rows: int | None = None) -> DataFrame:
    """lag() of several columns per key: ``columns`` maps source to output name; ``order`` must be total within a key."""
    packed = F.struct(*[F.col(c) for c in columns])
    usual, large = _parted(df, keys, min_rows)
    done = usual.withColumn("_p", F.lag(packed).over(Window.partitionBy(*keys).orderBy(*sort_columns(order))))
    if large is not None:
        done = done.unionByName(
            _scanned(
                large, keys, order,
                own=lambda w: F.lag(packed).over(w),
                summary=F.max_by(packed, F.col("_id")),
                carry=lambda s, w: F.lag(s).over(w),
                both=F.coalesce,
                out="_p",
            )
        )
    return done.withColumns({new: F.col("_p")[c] for c, new in columns.items()}).drop("_p")


def row_numbers(
    df: DataFrame,
    keys: Sequence[str],
    order: Order,
    out: str,
    min_rows: int | None = None,
) -> DataFrame:
    """row_number() per key, or over the whole table when ``keys`` is empty.

    ``order`` must be total within a key (end it with a unique column). Rows of large
    keys (of a large table, if there is no key) are range-partitioned by key and order:
    however many rows a key has, they fill as many tasks as they need.
    """
    if not keys:
        if df.count() < (HOT_ROWS if min_rows is None else min_rows):
            return df.withColumn(out, F.row_number().over(Window.orderBy(*sort_columns(order))).cast("long"))
        return _ranged_numbers(df, [], order, out)
    usual = F.row_number().over(Window.partitionBy(*keys).orderBy(*sort_columns(order))).cast("long")
    hot = hot_keys(df, keys, min_rows)
    if hot is None:
        return df.withColumn(out, usual)
    marked = _attach(df, hot.select(*keys, F.lit(True).alias("_hot")), keys, small=True)
    rest = marked.where(F.col("_hot").isNull()).drop("_hot").withColumn(out, usual)
    return rest.unionByName(_ranged_numbers(marked.where(F.col("_hot")).drop("_hot"), keys, order, out))


def _ranged_numbers(df: DataFrame, keys: Sequence[str], order: Order, out: str) -> DataFrame:
    """Pieces in order, numbered inside, plus what lies in the pieces before.

    In a piece the rows of a key follow each other, so a row's number there is its
    distance from the key's first row.
    """
    cut = _in_pieces(df, keys, order)
    before = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    # a row for each key and piece
    offsets = (
        cut.groupBy(*keys, "_piece")
        .agg(F.count(F.lit(1)).alias("_c"), F.min("_id").alias("_first"))
        .withColumn("_off", F.coalesce(F.sum("_c").over(before), F.lit(0)))
        .drop("_c")
    )
    joined = _attach(cut, offsets, [*keys, "_piece"], small=False)
    return joined.withColumn(out, F.col("_id") - F.col("_first") + F.col("_off") + 1).select(*df.columns, out)


def top_rows(df: DataFrame, keys: Sequence[str], order: Order, depth: int, out: str) -> DataFrame:
    """The first ``depth`` rows of every key with their number.

    The literal bound lets Spark drop rows beyond it before the shuffle, so a
    task receives at most ``depth`` rows of a key from each input partition.
    """
    if depth > GROUP_LIMIT_MAX:
        return row_numbers(df, keys, order, out).where(F.col(out) <= depth)
    w = Window.partitionBy(*keys).orderBy(*sort_columns(order))
    return df.withColumn(out, F.row_number().over(w)).where(F.col(out) <= depth)


def ordered_fold(
    df: DataFrame,
    keys: Sequence[str],
    seq: str | Sequence[str],
    element: Column,
    merge: Callable[[Column, Column], Column],
    out: str,
    chunk: int | None = None,
) -> DataFrame:
    """Combine ``element`` over each key in the order of ``seq`` with an associative merge.

    ``seq`` names one or more columns that together are unique in a key. When every key
    has fewer than FOLD_ROWS rows they are folded in one step. Otherwise the rows of a
    key are numbered and folded in runs of about the square root of the largest key's
    rows (or ``chunk``), then over the runs: whatever values ``seq`` has, no array is
    longer than that. ``merge`` must be exact, so that the cut does not matter.
    """
    by_seq = [seq] if isinstance(seq, str) else list(seq)

    def folded(rows: DataFrame, by: Sequence[str], to: str) -> DataFrame:
        items = F.array_sort(F.col("_l"))
        rest = F.slice(items, F.lit(2), F.size(items))
        result = F.aggregate(rest, items[0]["e"], lambda acc, x: merge(acc, x["e"]))
        gathered = F.collect_list(F.struct(F.col("_q").alias("q"), F.col("_e").alias("e")))
        return rows.groupBy(*by).agg(gathered.alias("_l")).select(*by, result.alias(to))

    names = [f"_q{i}" for i in range(len(by_seq))]
    lifted = df.select(*keys, *[F.col(c).alias(n) for c, n in zip(by_seq, names)], element.alias("_e"))
    largest = largest_group(lifted, keys) if chunk is None else 0
    if chunk is None and largest < FOLD_ROWS:
        return folded(lifted.withColumn("_q", F.struct(*names)), keys, out)
    numbered = row_numbers(lifted, keys, [(n, True) for n in names], "_q").drop(*names)
    ranged = numbered.withColumn("_range", F.floor((F.col("_q") - 1) / (chunk or max(1, math.isqrt(largest)))))
    parts = folded(ranged, [*keys, "_range"], "_e")
    return folded(parts.withColumnRenamed("_range", "_q"), keys, out)
