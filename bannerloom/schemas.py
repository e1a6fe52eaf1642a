"""Declared schemas and the schema contract check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# the CSV edge is untyped: every column is read as text
IMPRESSIONS = _strings("banner_id", "campaign_id")
CLICKS = _strings("click_id", "banner_id", "campaign_id")
CONVERSIONS = _strings("conversion_id", "click_id", "revenue")

INPUTS = {"impressions": IMPRESSIONS, "clicks": CLICKS, "conversions": CONVERSIONS}

PERFORMANCE = T.StructType(
    [
        T.StructField("revenue_total", T.DoubleType()),
        T.StructField("impression_count", T.LongType()),
        T.StructField("campaign_id", T.IntegerType()),
        T.StructField("banner_id", T.IntegerType()),
        T.StructField("click_count", T.IntegerType()),
    ]
)

HISTORY = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("order", T.IntegerType()),
        T.StructField("state", T.StringType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("end_time", T.TimestampType()),
        T.StructField("fingerprints", T.MapType(T.StringType(), T.StringType())),
    ]
)


def schema_contract(table: str, df: DataFrame, declared: T.StructType) -> DataFrame:
    """One row per declared or present column: expected and found type, rows, filled rows."""
    expected = {f.name: f.dataType.simpleString() for f in declared.fields}
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}

    def entry(name: str) -> Column:
        e, a = expected.get(name), found.get(name)
        filled = F.col(f"filled_{name}") if name in found else F.lit(0).cast("long")
        return F.struct(
            F.lit(table).alias("table_name"),
            F.lit(name).alias("column_name"),
            F.lit(e).cast("string").alias("expected"),
            F.lit(a).cast("string").alias("found"),
            F.lit(e == a).alias("ok"),
            F.col("rows"),
            filled.alias("filled"),
        )

    names = [*expected, *[n for n in found if n not in expected]]
    counted = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(n).alias(f"filled_{n}") for n in found])
    return counted.select(F.inline(F.array(*[entry(n) for n in names])))
