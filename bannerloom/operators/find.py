"""Reads by users of a table: filters, ranges, order, pages, counts."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bannerloom.operators import skew
from bannerloom.session import scratch_dir
from bannerloom.sources.tables import write_out

# rows that one task may skip, rows of a sample, and splits that are made of them
PAGE_ROWS, SPLIT_SAMPLE, SPLITS = 1_000_000, 4_000, 32

# collation of each comparison strength: letters, letters and accents, and case as well
COLLATIONS = {1: "UNICODE_CI_AI", 2: "UNICODE_CI", 3: "UNICODE"}


def project(df: DataFrame, include: Sequence[str] | None = None, exclude: Sequence[str] | None = None) -> DataFrame:
    """Keep the named columns, or all but the named ones. Dots reach into structs, which keep their shape."""
    if include is not None and exclude is not None:
        raise ValueError("either include or exclude")
    if include is not None:
        tree: dict[str, dict] = {}
        for name in include:
            node = tree
            for part in name.split("."):
                node = node.setdefault(part, {})

        def keep(column: Column, node: dict[str, dict], name: str) -> Column:
            if not node:
                return column.alias(name)
            inner = F.struct(*[keep(column[k], v, k) for k, v in node.items()])
            return F.when(column.isNotNull(), inner).alias(name)

        return df.select(*[keep(F.col(k), v, k) for k, v in tree.items()])
    result = df
    for name in exclude or []:
        outer, _, inner = name.partition(".")
        result = result.withColumn(outer, F.col(outer).dropFields(inner)) if inner else result.drop(name)
    return result


def key_range(
    df: DataFrame,
    keys: Sequence[str],
    lower: Sequence[object] | None = None,
    upper: Sequence[object] | None = None,
) -> DataFrame:
    """Rows with lower <= keys < upper, compared key by key.

    NULL sorts first, in rows and in bounds. The bounds on the first key are added
    as plain comparisons so that they reach the scan.
    """
    order: skew.Order = [(k, True) for k in keys]
    row = {k: F.col(k) for k in keys}
    if lower is not None:
        mark = {k: F.lit(x) for k, x in zip(keys, lower, strict=True)}
        first = F.lit(True) if lower[0] is None else F.col(keys[0]) >= F.lit(lower[0])
        df = df.where(first).where(skew.follows(row, mark, order, True))
    if upper is not None:
        mark = {k: F.lit(x) for k, x in zip(keys, upper, strict=True)}
        first = F.col(keys[0]).isNull() if upper[0] is None else F.col(keys[0]).isNull() | (F.col(keys[0]) <= F.lit(upper[0]))
        df = df.where(first).where(~skew.follows(row, mark, order, True))
    return df


def where_python(df: DataFrame, predicate: Callable[..., pd.Series], *columns: str) -> DataFrame:
    """Filter by user code over column batches. Prefer a column expression where one exists."""
    return df.where(F.pandas_udf(predicate, "boolean")(*columns))


def collation_name(strength: int = 2, locale: str | None = None) -> str:
    """The collation of a strength, in the order of a locale (``de``, ``sv_SWE``, ...) if one is given."""
    name = COLLATIONS[strength]
    return name if locale is None else name.replace("UNICODE", locale)


def collated(c: Column, strength: int = 2, locale: str | None = None) -> Column:
    """Text compared by the given strength, in a locale's order. Equality, sorts, ranges and groups follow it."""
    return F.collate(c, collation_name(strength, locale))


def without_punctuation(c: Column) -> Column:
    """Text without white space and punctuation, for comparisons that pass over them."""
    return F.regexp_replace(c, r"[\s\p{Punct}\p{IsPunctuation}]+", "")


def collated_keys(
    column: str, locale: str | None = None, strength: int = 3, upper_first: bool = False, shifted: bool = False
) -> dict[str, Column]:
    """Sort keys, most important first, for a locale's order of a text column.

    ``upper_first`` puts capitals before small letters where texts differ in nothing else,
    ``shifted`` passes over white space and punctuation.
    """
    text = without_punctuation(F.col(column)) if shifted else F.col(column)
    keys = {"_letters": collated(text, min(strength, 2), locale)}
    if strength > 2:
        # where case alone is left: capitals are smaller code points
        keys["_case"] = text if upper_first else collated(text, strength, locale)
    return keys


def collated_sort(df: DataFrame, column: str, then: skew.Order = (), position: str | None = None, **how: object) -> DataFrame:
    """All rows in the order of ``collated_keys(column, **how)``, NULL first; ``then`` orders equal ones.

    The keys are ordinary sort keys, so rows are range-partitioned by them as in any sort.
    With ``position`` the rows are not sorted but get their place in the order, from 1.
    """
    keys = collated_keys(column, **how)
    order = [*[(k, True) for k in keys], *then]
    keyed = df.withColumns(keys)
    return (with_position(keyed, order, position) if position else sort_rows(keyed, order)).drop(*keys)


def numeric_key(c: Column) -> Column:
    """Sort key under which runs of digits order by value, whatever their length.

    Each run loses its leading zeros and is led by its length in ten digits, so longer
    numbers come later. Other text stays as it is.
    """
    runs = F.regexp_extract_all(c, F.lit(r"(\D*)(\d*)"), 0)

    def key(run: Column) -> Column:
        number = F.regexp_replace(F.regexp_extract(run, r"(\d*)$", 1), r"^0+(?=\d)", "")
        text = F.regexp_extract(run, r"^(\D*)", 1)
        return F.when(number == "", text).otherwise(F.concat(text, F.lpad(F.length(number).cast("string"), 10, "0"), number))

    return F.when(c.isNotNull(), F.concat_ws("", F.transform(runs, key)))


def retain(df: DataFrame, ts: str, as_of: Column, seconds: int) -> DataFrame:
    """Rows not older than ``seconds`` at ``as_of``; rows without a timestamp do not age."""
    return df.where(F.col(ts).isNull() | (F.col(ts) >= as_of - F.make_dt_interval(secs=F.lit(seconds))))


def oid_time(oid: Column) -> Column:
    """Generation time held in the first eight hex digits."""
    return F.timestamp_seconds(F.conv(F.substring(oid, 1, 8), 16, 10).cast("long"))


def oid_between(df: DataFrame, oid: str, start_seconds: int, end_seconds: int) -> DataFrame:
    """Ids generated in [start, end): a range on the text itself, so it reaches the scan."""
    return df.where((F.col(oid) >= f"{start_seconds:08x}") & (F.col(oid) < f"{end_seconds:08x}"))


def sort_rows(df: DataFrame, order: skew.Order) -> DataFrame:
    if not order:
        raise ValueError("the sort needs at least one key")
    return df.orderBy(*skew.sort_columns(order))


def with_position(df: DataFrame, order: skew.Order, out: str = "position") -> DataFrame:
    """Every row with its place (from 1) in the total order, numbered in parallel."""
    if not order:
        raise ValueError("the sort needs at least one key")
    return skew.row_numbers(df, [], order, out)


def page(df: DataFrame, order: skew.Order, skip: int = 0, limit: int = 0, in_one_task: int = PAGE_ROWS) -> DataFrame:
    """Rows skip+1 .. skip+limit of the order; limit 0 means no limit.

    Up to ``in_one_task`` rows are skipped in one task; for a deeper page ``narrowed`` looks
    for the part of the table that has it, and only that part is sorted.
    """
    if skip < 0 or limit < 0:
        raise ValueError("skip and limit must not be negative")
    if limit:
        some, before = narrowed(df, order, skip, limit, in_one_task) if skip > in_one_task else (df, 0)
        return sort_rows(some, order).offset(skip - before).limit(limit)
    if skip == 0:
        return sort_rows(df, order)
    # offset() without a limit would bring the rest of the table into one task
    return sort_rows(with_position(df, order, "_pos").where(F.col("_pos") > skip).drop("_pos"), order)


def narrowed(df: DataFrame, order: skew.Order, skip: int, limit: int, enough: int) -> tuple[DataFrame, int]:
    """(rows, before): a range of the order that has the rows skip+1 .. skip+limit, and how many rows lie before it.

    Selection without a sort: some rows of a sample split the range, one pass counts what lies
    up to each of them, and the range between the two nearest ones is split again, until it
    has at most ``enough`` rows (besides ``limit``) or cannot be split, because its rows are equal.
    """
    if not order:
        raise ValueError("the sort needs at least one key")
    names = [c for c, _ in order]
    row = {c: F.col(c) for c in names}

    def up_to(split: Row) -> Column:
        return ~skew.follows(row, {c: F.lit(split[c]).cast(df.schema[c].dataType) for c in names}, order, False)

    part, before, n = df, 0, df.count()
    while n > enough + limit and skip < before + n:
        sampled = sort_rows(part.select(*names).sample(min(1.0, SPLIT_SAMPLE / n), seed=n), order).collect()
        splits = [sampled[len(sampled) * i // SPLITS] for i in range(SPLITS)] if sampled else []
        splits = [s for i, s in enumerate(splits) if not i or s != splits[i - 1]]
        if not splits:
            break
        counts = part.agg(*[F.count_if(up_to(s)).alias(f"c{i}") for i, s in enumerate(splits)]).first()
        below = [i for i, c in enumerate(counts) if before + c <= skip]
        above = [i for i, c in enumerate(counts) if before + c >= skip + limit]
        low, high = below[-1] if below else None, above[0] if above else None
        inside = part if low is None else part.where(~up_to(splits[low]))
        inside = inside if high is None else inside.where(up_to(splits[high]))
        first, last = counts[low] if low is not None else 0, counts[high] if high is not None else n
        if last - first == n:
            break
        part, before, n = inside, before + first, last - first
    return part, before


def find_one(df: DataFrame, condition: Column, order: skew.Order) -> DataFrame:
    return sort_rows(df.where(condition), order).limit(1)


def count_page(df: DataFrame, skip: int = 0, limit: int = 0) -> DataFrame:
    """How many rows the page (skip, limit) of the table has."""
    if skip < 0 or limit < 0:
        raise ValueError("skip and limit must not be negative")
    left = F.greatest(F.count(F.lit(1)) - skip, F.lit(0).cast("long"))
    return df.agg((F.least(left, F.lit(limit).cast("long")) if limit else left).alias("n"))


def distinct_values(df: DataFrame, column: str, condition: Column | None = None) -> DataFrame:
    """Distinct values of a column; of its elements when it is an array."""
    rows = df if condition is None else df.where(condition)
    is_array = dict(df.dtypes)[column].startswith("array")
    return rows.select(F.explode(column).alias(column) if is_array else F.col(column)).distinct()


def update_elements(
    array: Column, matches: Callable[[Column], Column], change: Callable[[Column], Column]
) -> Column:
    """The array with ``change`` applied to the matching elements."""
    return F.transform(array, lambda x: F.when(matches(x), change(x)).otherwise(x))


def group_aggregate(
    df: DataFrame,
    keys: Sequence[str],
    condition: Column | None,
    reduce: Mapping[str, Column],
    finalize: Mapping[str, Column],
) -> DataFrame:
    """Group by built-in aggregates, then finish with expressions over them."""
    rows = df if condition is None else df.where(condition)
    return rows.groupBy(*keys).agg(*[c.alias(n) for n, c in reduce.items()]).select(
        *keys, *[c.alias(n) for n, c in finalize.items()]
    )


def group_fold(
    df: DataFrame,
    keys: Sequence[str],
    condition: Column | None,
    seq: str,
    element: Column,
    merge: Callable[[Column, Column], Column],
    finalize: Mapping[str, Callable[[Column], Column]],
) -> DataFrame:
    """Group by a user-defined associative fold in ``seq`` order.

    ``element`` lifts a row to an accumulator, ``merge`` joins the accumulators
    of two neighbouring runs of rows. Groups of any size are folded in parts.
    """
    rows = df if condition is None else df.where(condition)
    folded = skew.ordered_fold(rows, keys, seq, element, merge, "_acc")
    return folded.select(*keys, *[f(F.col("_acc")).alias(n) for n, f in finalize.items()])


def map_reduce(
    df: DataFrame,
    emit: Column,
    reduce: Callable[[str], Column],
    into: DataFrame | None = None,
    mode: str = "replace",
) -> DataFrame:
    """(key, value) rows from ``emit``, an array of struct(key, value) per row.

    ``reduce`` makes an aggregate from a column name. With a target table the
    mode decides what happens to its rows: ``replace`` drops them, ``merge``
    keeps those without a new value, ``reduce`` reduces old and new together.
    """
    pairs = df.select(F.explode(emit).alias("_p")).select("_p.key", "_p.value")
    result = pairs.groupBy("key").agg(reduce("value").alias("value"))
    if into is None or mode == "replace":
        return result
    if mode == "merge":
        return result.unionByName(into.join(result, "key", "left_anti"))
    if mode == "reduce":
        return result.unionByName(into).groupBy("key").agg(reduce("value").alias("value"))
    raise ValueError(mode)


#: Different keys that a task reduces before it passes values on, and rows that one call of a reduce function gets at most.
REDUCED_KEYS, REDUCED_ROWS = 100_000, 10_000


def map_reduce_python(
    df: DataFrame,
    emit: Callable[[pd.DataFrame], pd.DataFrame],
    reduce: Callable[[object, pd.Series], object],
    schema: T.StructType,
    condition: Column | None = None,
    order: skew.Order = (),
    limit: int = 0,
    finalize: Callable[[pd.DataFrame], pd.Series] | None = None,
    result: str | None = None,
) -> DataFrame:
    """(key, value) by user code: ``emit`` gives keys and values for batches of rows, ``reduce`` one value for values of a key.

    ``schema`` has the types of key and value. ``condition``, ``order`` and ``limit`` choose the rows that
    are mapped. ``reduce`` must give the same whatever parts a key's values come in and may
    get its own results: tasks reduce what they emit batch by batch, so the shuffle has a
    value for each key and task or so, and what has come together is reduced in parts of
    REDUCED_ROWS, in rounds, until each key has one value. So no call gets all values of a
    frequent key. ``finalize`` makes the ``result`` (a type) of keys and reduced values, in batches.
    """
    rows = df if condition is None else df.where(condition)
    rows = sort_rows(rows, order) if order else rows
    rows = rows.limit(limit) if limit else rows

    def reduced(pairs: pd.DataFrame) -> pd.DataFrame:
        out = [(k, reduce(k, g)) for k, g in pairs.groupby("key", sort=False, dropna=False)["value"]]
        return pd.DataFrame(out, columns=["key", "value"])

    def mapped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        have = None
        for batch in batches:
            new = reduced(emit(batch)[["key", "value"]])
            have = new if have is None else reduced(pd.concat([have, new]))
            if len(have) >= REDUCED_KEYS:
                yield have
                have = None
        if have is not None:
            yield have

    pairs = write_out(rows.mapInPandas(mapped, schema), scratch_dir(df.sparkSession, "pairs"))
    while True:
        most = skew.largest_group(pairs, ["key"])
        # a part is a random share of a key's values, and a call gets the parts of many keys
        parts = max(1, -(-most // REDUCED_ROWS))
        by = [
            F.pmod(F.xxhash64("key"), F.lit(1 + pairs.count() // REDUCED_ROWS)).alias("_some"),
            F.pmod(F.monotonically_increasing_id(), F.lit(parts)).alias("_part"),
        ]
        done = pairs.select("*", *by).groupBy("_some", "_part").applyInPandas(lambda g: reduced(g[["key", "value"]]), schema)
        if parts == 1:
            break
        pairs = write_out(done, scratch_dir(df.sparkSession, "pairs"))
    if finalize is None:
        return done
    if result is None:
        raise ValueError("finalize needs the type of its result")
    final = F.pandas_udf(lambda k, v: finalize(pd.DataFrame({"key": k, "value": v})), result)
    return done.select("key", final("key", "value").alias("value"))
