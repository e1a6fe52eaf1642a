"""Dataset folders: discovery, CSV reading, fingerprints.

Layout: ``<root>/<n>/<kind>_<n>.csv``; a CSV may be one file or a folder of part
files.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bannerloom.schemas import INPUTS

PATH_PARTS = r"/([^/]+)/([a-z]+)_\d+\.csv(?:/[^/]*)?$"


def csv_path(root: str, dataset_id: int, kind: str) -> str:
    return f"{root}/{dataset_id}/{kind}_{dataset_id}.csv"


def write_csv(df: DataFrame, root: str, dataset_id: int, kind: str) -> None:
    columns = INPUTS[kind].fieldNames()
    df.select(*columns).write.mode("overwrite").option("header", True).csv(csv_path(root, dataset_id, kind))


def read_csv(spark: SparkSession, root: str, dataset_id: int, kind: str) -> DataFrame:
    """All columns as text, checked against the header."""
    return (
        spark.read.schema(INPUTS[kind])
        .option("header", True)
        .option("enforceSchema", False)
        .csv(csv_path(root, dataset_id, kind))
    )


def dataset_of(path: Column) -> Column:
    """Folder number of a file path, NULL when the folder is not a number."""
    return F.regexp_extract(path, PATH_PARTS, 1).try_cast("int")


def kind_of(path: Column) -> Column:
    """File kind: the file name up to its first underscore."""
    return F.regexp_extract(path, PATH_PARTS, 2)


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """(dataset_id, kind, path, length) of every CSV file; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", True)
        .load(root)
        .select(dataset_of(F.col("path")).alias("dataset_id"), kind_of(F.col("path")).alias("kind"), "path", "length")
    )


def complete(spark: SparkSession, root: str, dataset_id: int) -> bool:
    """Whether all kinds are there, each as one file or as a folder that its writer has finished.

    A folder of part files counts when it has the ``_SUCCESS`` marker: a part file that
    comes later comes before the marker, so none is missed.
    """
    found = list_files(spark, f"{root}/{dataset_id}")
    in_folder = F.col("path").rlike(r"\.csv/[^/]*$")
    folders = found.where(in_folder).select("kind", F.regexp_replace("path", r"/[^/]*$", "").alias("folder")).distinct()
    # names that start with an underscore are hidden from Spark's readers, so the marker is asked for by its path
    kinds = {r.kind for r in found.where(~in_folder).select("kind").distinct().collect()}
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for r in folders.collect():  # three at most
        mark = path(f"{r.folder}/_SUCCESS")
        if mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark):
            kinds.add(r.kind)
    return kinds >= set(INPUTS)


def discover(spark: SparkSession, root: str) -> DataFrame:
    """Dataset numbers in numeric order; other folders are skipped."""
    return (
        list_files(spark, root)
        .where(F.col("dataset_id").isNotNull())
        .select("dataset_id")
        .distinct()
        .orderBy("dataset_id")
    )


def digest(columns: list[str]) -> Column:
    """Aggregate: a fingerprint of the rows, independent of their order and files.

    Count, sum and xor of row hashes combine before the shuffle, so a dataset of
    any size is fingerprinted without reading a file in one piece. Each field is led by
    its length, NULL is marked, and the column names come first, so different rows have
    different texts; all 128 bits of a row's hash count.
    """
    texts = [F.col(c).cast("string") for c in columns]
    fields = [F.when(t.isNull(), "-").otherwise(F.concat(F.length(t).cast("string"), F.lit(":"), t)) for t in texts]
    row = F.md5(F.concat(F.lit(",".join(columns) + ";"), *fields))
    parts: list[Column] = [F.count(F.lit(1))]
    for at in (1, 9, 17, 25):
        h = F.conv(F.substring(row, at, 8), 16, 10).cast("long")
        parts += [F.sum(h.cast("decimal(20,0)")), F.bit_xor(h)]
    return F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))


def file_fingerprints(spark: SparkSession, root: str, dataset_id: int) -> DataFrame:
    """(dataset_id, kind, fingerprint) of one dataset's files."""
    each = [
        read_csv(spark, root, dataset_id, kind)
        .agg(digest(INPUTS[kind].fieldNames()).alias("fingerprint"))
        .select(F.lit(dataset_id).alias("dataset_id"), F.lit(kind).alias("kind"), "fingerprint")
        for kind in INPUTS
    ]
    return reduce(DataFrame.unionByName, each)


def file_checksums(spark: SparkSession, root: str) -> DataFrame:
    """(dataset_id, kind, path, checksum) of every single file, from its lines.

    Files are read in splits and reduced before the shuffle, whatever their size.
    """
    lines = (
        spark.read.option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", True)
        .text(root)
        .select(F.col("_metadata.file_path").alias("path"), "value")
    )
    each = lines.groupBy("path").agg(digest(["value"]).alias("checksum"))
    return each.select(dataset_of(F.col("path")).alias("dataset_id"), kind_of(F.col("path")).alias("kind"), "path", "checksum")
