"""Following references between tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bannerloom.session import scratch_dir
from bannerloom.sources.tables import write_out


def dereference(
    refs: DataFrame, targets: Mapping[str, tuple[DataFrame, str]], columns: Mapping[str, str], database: str = "main"
) -> DataFrame:
    """refs(..., ref struct(collection, id, database)) with columns of the row referred to.

    ``targets`` maps a collection to its table and key; ``columns`` maps an
    output name to an expression over the target. A dangling reference gives
    NULLs, a reference into another database is an error.
    """
    ref = F.col("ref")
    foreign = ref["database"].isNotNull() & (ref["database"] != database)
    message = F.concat(F.lit("reference into another database: "), ref["database"])
    # a filter, so that the check is made for every row, whatever columns are read later
    fine = F.when(foreign, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    checked = refs.where(fine).withColumn("_id", ref["id"])

    def one(collection: str, table: DataFrame, key: str) -> DataFrame:
        target = table.select(F.col(key).alias("_id"), *[F.expr(e).alias(n) for n, e in columns.items()])
        # unique on the right; a very popular target is cut by adaptive skew splitting
        return checked.where(ref["collection"] == collection).join(target, "_id", "left").drop("_id")

    known = [one(c, t, k) for c, (t, k) in targets.items()]
    types = dict(known[0].dtypes)
    unknown = checked.where(ref["collection"].isNull() | ~ref["collection"].isin(*targets)).drop("_id")
    dangling = unknown.withColumns({n: F.lit(None).cast(types[n]) for n in columns})
    return reduce(DataFrame.unionByName, [*known, dangling])


def dereference_array(
    df: DataFrame, row_key: str, array: str, target: DataFrame, target_key: str, expression: str, out: str
) -> DataFrame:
    """(row_key, out): the array of ids with every id replaced by a value of its target row.

    The rows gathered again for one key are those of its own array.
    """
    ids = df.select(row_key, F.posexplode_outer(array).alias("_pos", "_id"))
    found = ids.join(target.select(F.col(target_key).alias("_id"), F.expr(expression).alias("_v")), "_id", "left")
    items = F.array_sort(F.collect_list(F.when(F.col("_pos").isNotNull(), F.struct("_pos", "_v"))))
    return found.groupBy(row_key).agg(F.transform(items, lambda x: x["_v"]).alias(out))


def dereference_recursive(
    starts: DataFrame, table: DataFrame, key: str, links: str, columns: Mapping[str, str], max_depth: int | None = None
) -> DataFrame:
    """(root, depth, path, id, found, cycle, columns...): the rows that ``starts``(root, id) refer to, at any depth.

    ``links`` names the array column of ``table`` with the keys that a row refers to, ``columns``
    maps output names to expressions over it. ``path`` holds the keys from the first reference to
    this one. A reference to a row of its own path is returned with ``cycle`` and not followed;
    one without a row has ``found`` false and NULLs; NULL references are dangling ones. With
    ``max_depth`` references below that depth are not followed.

    References are followed level by level: each level is one join of what the level before
    has found, written, so that a lost executor costs one level. The table is read once for
    each level and shuffled to it, never broadcast: a broadcast for each level would bring the
    table to the driver as often as there are levels.
    """
    spark = starts.sparkSession
    target = table.select(
        F.col(key).alias("_key"), F.col(links).alias("_links"), F.lit(True).alias("_found"), *[F.expr(e).alias(n) for n, e in columns.items()]
    )
    types = dict(table.dtypes)
    frontier = starts.select("root", F.col("id").cast(types[key]).alias("id"), F.array().cast(f"array<{types[key]}>").alias("_before"))
    out: list[DataFrame] = []
    while max_depth is None or len(out) < max_depth:
        rows = frontier.withColumn("cycle", F.coalesce(F.array_contains("_before", F.col("id")), F.lit(False)))
        level = rows.join(target.hint("merge"), F.col("id") == F.col("_key"), "left").select(
            "root", F.lit(len(out) + 1).alias("depth"), F.array_append("_before", F.col("id")).alias("path"), "id",
            F.coalesce("_found", F.lit(False)).alias("found"), "cycle", *columns, F.when(~F.col("cycle"), F.col("_links")).alias("_links"),
        )
        level = write_out(level, scratch_dir(spark, "level"))
        out.append(level.drop("_links"))
        frontier = level.select("root", F.explode("_links").alias("id"), F.col("path").alias("_before"))
        if frontier.isEmpty():
            break
    return reduce(DataFrame.unionByName, out)
