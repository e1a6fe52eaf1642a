"""Answering a stream of requests, with and without remembered lists."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.streaming.stateful_processor import TimerValues

from bannerloom.functions.requests import COOKIE_DAYS
from bannerloom.operators import requests as requests_op
from bannerloom.operators import serving, skew

DAY_MS = 24 * 3600 * 1000


def serve_stream(
    requests: DataFrame, ready: requests_op.Serving, out: str, checkpoint: str
) -> StreamingQuery:
    """Responses to all requests that have arrived, under ``out``, then stop.

    Each micro-batch replaces its own folder, so a repeated one adds nothing twice.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        requests_op.respond(batch, ready).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (
        requests.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_responses(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(out).drop("batch")


def remembered(responses: DataFrame, min_rows: int | None = None) -> DataFrame:
    """Batch form: what each request of a log finds in its user's cookie.

    responses(request_id, user_key, ts, picks) gains ``seen``: the list of the
    user's previous response, empty after COOKIE_DAYS days or for the first one.
    """
    before = skew.previous_row(
        responses,
        ["user_key"],
        [("ts", True), ("request_id", True)],
        {"picks": "_ids", "ts": "_at"},
        min_rows,
    )
    alive = F.col("user_key").isNotNull() & (F.col("ts") - F.col("_at") <= F.make_dt_interval(F.lit(COOKIE_DAYS)))
    empty = F.array().cast("array<int>")
    return before.withColumn("seen", F.when(alive, F.col("_ids")).otherwise(empty)).drop("_ids", "_at")


#: Visits that are answered in one frame.
ANSWERED = 10_000
NO_CAMPAIGN = -(1 << 62)  # stands for NULL
LAST = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("at", T.LongType())])
VISIT_OUT = "user_key long, request_id long, campaign_id int, seen array<int>, picks array<int>"


class RememberedLists(StatefulProcessor):
    """One user's visits in time order; the served list is remembered for the next one.

    The list is keyed state that expires COOKIE_DAYS days after it was written. Of the
    visits of a micro-batch only times, numbers and campaigns are kept, 24 bytes for
    each, and the lists once for each campaign; they come in chunks and are answered in
    chunks, in the order of time, so no frame of all of them is made.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", LAST, ttlDurationMs=COOKIE_DAYS * DAY_MS)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        lists: dict[int, tuple[list[int] | None, list[int]]] = {}
        parts: list[tuple[np.ndarray, ...]] = []
        for chunk in rows:
            ts = chunk["ts"].to_numpy("datetime64[us]")
            campaigns = chunk["campaign_id"].astype("Int64").fillna(NO_CAMPAIGN).to_numpy(np.int64)
            parts.append((np.isnat(ts), ts.astype(np.int64), chunk["request_id"].to_numpy(np.int64), campaigns))
            first = np.unique(campaigns, return_index=True)[1]
            for c, pool, fixed in zip(campaigns[first].tolist(), chunk["pool"].iloc[first], chunk["fixed"].iloc[first]):
                lists[c] = (None if pool is None else [int(b) for b in pool], [] if fixed is None else [int(b) for b in fixed])
        none, at, ids, campaigns = (np.concatenate(p) for p in zip(*parts))
        state = self.last.get()  # None at first and after it has expired
        last, since = ([int(b) for b in state[0]], int(state[1])) if state else ([], None)
        order = np.lexsort((ids, at, none))
        for begin in range(0, len(order), ANSWERED):
            some = order[begin : begin + ANSWERED]
            out = []
            for i in some.tolist():
                now = int(at[i]) // 1000
                seen = last if since is not None and now - since <= COOKIE_DAYS * DAY_MS else []
                campaign = int(campaigns[i])
                pool, picks = lists[campaign]
                if pool is not None:
                    known = set(seen)
                    picks = sorted(pool, key=known.__contains__)[: serving.TOP_TIER]  # stable: rank order within each part
                out.append((key[0], ids[i], None if campaign == NO_CAMPAIGN else campaign, seen, picks))
                last, since = picks, now
            yield pd.DataFrame(out, columns=["user_key", "request_id", "campaign_id", "seen", "picks"]).astype({"campaign_id": "Int32"})
        self.last.update((last, since))

    def close(self) -> None:
        pass


def serve_with_memory(visits: DataFrame, ready: requests_op.Serving) -> DataFrame:
    """Streaming form: visits(user_key, request_id, ts, campaign_id) answered from the
    user's last served list, which is kept as state for COOKIE_DAYS days.

    A served list has at most TOP_TIER banners, so the pool of a campaign is long
    enough. Visits without a user have nothing to remember and stay out of the
    state, where they would all share one key.
    """
    joined = serving.with_lists(visits, ready.lists, ready.around, ready.ring_size, ready.seed)
    kept = (
        joined.where(F.col("user_key").isNotNull())
        .groupBy("user_key")
        .transformWithStateInPandas(RememberedLists(), VISIT_OUT, "Append", "ProcessingTime")
    )
    nothing = F.array().cast("array<int>")
    first = F.coalesce(F.slice("pool", 1, serving.TOP_TIER), "fixed")
    anonymous = joined.where(F.col("user_key").isNull()).select(
        F.col("user_key").cast("long").alias("user_key"), "request_id", "campaign_id", nothing.alias("seen"), first.alias("picks")
    )
    return kept.unionByName(anonymous)
