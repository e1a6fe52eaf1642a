"""Line dedup with levelled sorted runs of line hashes, in DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bannerloom.llm.common import LOWER, UPPER, WHITE, stage

#: Batches a whole table is taken in, and runs of one level that are merged into the next.
BATCHES, FAN_OUT = 4, 2


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(WHITE)), UPPER, LOWER)


def line_hash(line: Column) -> Column:
    """128 bits of a line's key; null for keys without a code point."""
    key = line_key(line)
    return F.when(key != "", F.unhex(F.md5(key.cast("binary"))))


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


class Runs:
    """Line hashes and in how many documents each was found.

    A batch is merged against the settled hashes (those found often enough already, whose
    counts no longer matter) by an anti join, and what is left becomes a new sorted run of
    level 0. ``FAN_OUT`` runs of a level are merged into one of the next; hashes that
    reach ``least`` documents by that become settled.
    """

    def __init__(self, spark: SparkSession, least: int, fan_out: int = FAN_OUT):
        self.least, self.fan_out = least, fan_out
        # not of Python rows, for which each executor would start Python workers of their own
        empty = spark.range(1).select(F.lit(None).cast("binary").alias("hash"), F.lit(None).cast("bigint").alias("docs")).where(F.lit(False))
        self.empty, self.settled, self.levels = empty, [], []

    @staticmethod
    def _merged(runs: list[DataFrame]) -> DataFrame:
        return reduce(DataFrame.unionByName, runs).groupBy("hash").agg(F.sum("docs").alias("docs"))

    def frequent(self) -> DataFrame:
        """All settled hashes, each once."""
        return reduce(DataFrame.unionByName, self.settled, self.empty).select("hash")

    def add(self, batch: DataFrame) -> None:
        """Adds a batch of (hash, docs) with each hash once."""
        new = batch.select("hash", "docs")
        if self.settled:
            new = new.join(self.frequent(), "hash", "left_anti")
        run = stage(new.sortWithinPartitions("hash"), "run")
        level = 0
        while True:
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(run)
            if len(self.levels[level]) < self.fan_out:
                return
            run = self._compact(self.levels[level])
            self.levels[level] = []
            level += 1

    def _compact(self, runs: list[DataFrame]) -> DataFrame:
        merged = stage(self._merged(runs).sortWithinPartitions("hash"), "run")
        if self.settled:  # a hash settled by another level since then is left out
            merged = merged.join(self.frequent(), "hash", "left_anti")
        self.settled.append(stage(merged.where(F.col("docs") >= self.least), "settled"))
        return merged.where(F.col("docs") < self.least)

    def finish(self) -> DataFrame:
        """Merges all levels and gives the settled hashes."""
        runs = [run for level in self.levels for run in level]
        if runs:
            self._compact(runs)
            self.levels = []
        return self.frequent()


def batch_counts(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """(batch, hash, docs): in how many documents (rows) of each batch a line's hash occurs."""
    keys = F.array_distinct(F.transform(lines(F.col("text")), line_key))
    each = docs.select(
        F.pmod(F.xxhash64("text"), F.lit(batches)).cast("int").alias("batch"), F.explode(keys).alias("key")
    ).where("key <> ''")
    return each.groupBy("batch", F.unhex(F.md5(F.col("key").cast("binary"))).alias("hash")).agg(F.count("*").alias("docs"))


def frequent_lines(docs: DataFrame, least: int, batches: int = BATCHES) -> DataFrame:
    """Hashes of the lines found in at least ``least`` documents, batch after batch through the runs."""
    runs = Runs(docs.sparkSession, least)
    counted = stage(batch_counts(docs.select("text"), batches), "batches")
    for i in range(batches):
        runs.add(counted.where(F.col("batch") == i))
    return runs.finish()


def drop_lines(docs: DataFrame, hashes: DataFrame) -> DataFrame:
    """``docs`` without the lines whose hash is in ``hashes``; adds ``n_lines`` and ``n_dropped``.

    What a text loses depends on the text alone, so the places are found once for each
    different text (by its hash) and joined back. Both sides of each join are plain
    tables, which adaptive execution can split where one line or text is very frequent.
    """
    text_hash = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    each = docs.select(F.unhex(text_hash).alias("__text"), F.posexplode(F.transform(lines(F.col("text")), line_hash)).alias("place", "hash"))
    places = each.where("hash is not null").join(hashes, "hash").groupBy("__text").agg(F.collect_set("place").alias("__places"))
    places = stage(places, "places")
    kept = docs.drop("n_lines", "n_dropped").withColumn("__text", F.unhex(text_hash)).join(places, "__text", "left")
    split = kept.withColumn("__lines", lines(F.col("text")))
    n = F.size("__lines")
    stay = F.array_except(F.sequence(F.lit(0), n - 1), F.col("__places"))
    rest = F.when(F.col("__places").isNull(), F.coalesce("text", F.lit(""))).otherwise(
        F.concat_ws("\n", F.transform(stay, lambda i: F.get(F.col("__lines"), i)))
    )
    out = [rest.alias("text") if c == "text" else F.col(c) for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return split.select(*out, n.cast("long").alias("n_lines"), F.coalesce(F.size("__places"), F.lit(0)).cast("long").alias("n_dropped"))


def dedup_lines(docs: DataFrame, least: int = 10, batches: int = BATCHES) -> DataFrame:
    """``docs`` without the lines whose key is found in ``least`` documents or more.

    Each row counts as one document, repeated rows included; a line repeated in one
    document counts once. Lines without a code point in their key always stay. Null texts
    become empty: one empty line. Other columns stay as they are, except that ``n_lines``
    and ``n_dropped`` are replaced. An empty table stays empty.
    """
    return drop_lines(docs, frequent_lines(docs, least, batches))
