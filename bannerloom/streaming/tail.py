"""Reading append-only tables and change feeds as streams."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


#: For queries with keyed state: batches without data would go on forever, and state with
#: an expiry time lives in the store that keeps it on disk, which checkpoints its changes only.
STATEFUL = {
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def stateful_settings(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep the settings of STATEFUL; timeouts are handled together with the next data."""
    before = {k: spark.conf.get(k, None) for k in STATEFUL}
    for k, v in STATEFUL.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def tail(spark: SparkSession, path: str, schema: T.StructType, **options: str) -> DataFrame:
    """New rows of an append-only Parquet folder. Filters and projections follow as usual.

    ``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` bound a micro-batch, and with
    it what one user's visits can bring into one task.
    """
    return spark.readStream.schema(schema).options(**options).parquet(path)


def drain(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append what has arrived since the checkpoint to ``out``, then stop.

    The checkpoint is the resume token: started again with it, the next run
    continues behind the last row delivered.
    """
    writer = (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
    )
    with stateful_settings(stream.sparkSession):
        return writer.start()


def follow(stream: DataFrame, out: str, checkpoint: str, every: str = "10 seconds") -> StreamingQuery:
    """Like drain, but waits for more rows until it is stopped."""
    return (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(processingTime=every)
        .start()
    )


def with_tokens(changes: DataFrame, token: Column) -> DataFrame:
    """Adds the resume token; a change without one cannot be resumed from and is an error."""
    checked = F.when(token.isNull(), F.raise_error(F.lit("a change has no resume token"))).otherwise(token)
    return changes.withColumn("token", checked)


def resume_after(changes: DataFrame, token: object) -> DataFrame:
    """Changes behind the given token."""
    return changes.where(F.col("token") > F.lit(token))
