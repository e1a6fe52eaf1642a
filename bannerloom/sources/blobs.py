"""Large contents as fixed-size chunks, and their reassembly with integrity checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_SIZE = 255 * 1024  # fixed value: default chunk size in bytes
MAX_CELL = (1 << 31) - 64  # bytes that a cell can hold at most


def describe(blobs: DataFrame, chunk_size: int = CHUNK_SIZE) -> DataFrame:
    """files(file_id, length, chunk_size, md5) of blobs(file_id, content)."""
    data = F.col("content").cast("binary")
    return blobs.select(
        "file_id",
        F.octet_length(data).cast("long").alias("length"),
        F.lit(chunk_size).alias("chunk_size"),
        F.md5(data).alias("md5"),
    )


def split(blobs: DataFrame, chunk_size: int = CHUNK_SIZE) -> DataFrame:
    """chunks(file_id, n, data): an empty content has no chunk.

    Chunks are cut inside the row, and the content is dropped before they become rows.
    """
    data = F.col("content").cast("binary")
    count = F.ceil(F.octet_length(data) / chunk_size).cast("int")
    numbers = F.when(count > 0, F.sequence(F.lit(0), count - 1))
    pieces = F.transform(
        numbers, lambda i: F.struct(i.alias("n"), F.substring(data, i * chunk_size + 1, F.lit(chunk_size)).alias("data"))
    )
    return blobs.select("file_id", F.explode(pieces).alias("_c")).select("file_id", "_c.n", "_c.data")


def verify(files: DataFrame, chunks: DataFrame) -> DataFrame:
    """files with ``status``: ok, missing, repeated, truncated, overlong or extra.

    Only chunk numbers and lengths are aggregated, never contents. A chunk behind the
    end is an error unless it is empty, one with a negative number always is.
    """
    spec = files.withColumn("_count", F.ceil(F.col("length") / F.col("chunk_size")))
    # one row per file against many chunk rows; the few numbers travel, not the data
    measured = chunks.select("file_id", "n", F.octet_length("data").alias("_len")).join(
        spec.select("file_id", "length", "chunk_size", "_count"), "file_id"
    )
    inside = (F.col("n") >= 0) & (F.col("n") < F.col("_count"))
    expected = F.least(F.col("chunk_size").cast("long"), F.col("length") - F.col("n") * F.col("chunk_size"))
    # a row for each chunk number, so that no file's numbers are gathered in one place
    numbers = measured.groupBy("file_id", "n").agg(
        F.count_if(inside).alias("_times"),
        F.count_if(inside & (F.col("_len") < expected)).alias("_short"),
        F.count_if(inside & (F.col("_len") > expected)).alias("_long"),
        F.count_if(F.coalesce(~inside & ((F.col("_len") > 0) | (F.col("n") < 0)), F.lit(True))).alias("_extra"),
    )
    found = numbers.groupBy("file_id").agg(
        F.count_if(F.col("_times") > 0).alias("_inside"),
        F.count_if(F.col("_times") > 1).alias("_repeated"),
        *[F.sum(c).alias(c) for c in ("_short", "_long", "_extra")],
    )
    return (
        spec.join(found, "file_id", "left")
        .withColumn(
            "status",
            F.when(F.coalesce("_inside", F.lit(0)) < F.col("_count"), "missing")
            .when(F.col("_repeated") > 0, "repeated")
            .when(F.col("_short") > 0, "truncated")
            .when(F.col("_long") > 0, "overlong")
            .when(F.col("_extra") > 0, "extra")
            .otherwise("ok"),
        )
        .drop("_count", "_inside", "_repeated", "_short", "_long", "_extra")
    )


def assemble(files: DataFrame, chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(files with ``status``, the chunk rows of the sound files in file and chunk order).

    The same for contents of any size: nothing is put into one cell.
    """
    checked = verify(files, chunks)
    sound = checked.where(F.col("status") == "ok").select("file_id", F.col("length").alias("_length"), "chunk_size")
    within = chunks.join(sound, "file_id").where(F.col("n") * F.col("chunk_size") < F.col("_length"))
    return checked, within.select(*chunks.columns).orderBy("file_id", "n")


def contents(files: DataFrame, chunks: DataFrame) -> DataFrame:
    """files with ``status`` and ``content`` in one cell; content is NULL unless the file is sound.

    With an ``md5`` column in files a content that does not have it gets status
    ``corrupt``. A sound file that no cell can hold (MAX_CELL bytes) is an error: read it
    with ``assemble``.
    """
    checked, parts = assemble(files, chunks)
    large = F.when((F.col("status") == "ok") & (F.col("length") > MAX_CELL), F.raise_error(F.lit("a content is too large for a cell")).cast("boolean"))
    checked = checked.where(F.coalesce(large, F.lit(True)))
    joined = parts.groupBy("file_id").agg(F.expr("listagg(data) WITHIN GROUP (ORDER BY n)").alias("content"))
    whole = checked.join(joined, "file_id", "left")
    empty = (F.col("status") == "ok") & (F.col("length") == 0)
    whole = whole.withColumn("content", F.when(empty, F.lit(b"").cast("binary")).otherwise(F.col("content")))
    if "md5" not in files.columns:
        return whole
    corrupt = F.col("content").isNotNull() & (F.md5("content") != F.col("md5"))
    return whole.withColumns(
        {"status": F.when(corrupt, "corrupt").otherwise(F.col("status")), "content": F.when(~F.coalesce(corrupt, F.lit(False)), F.col("content"))}
    )
