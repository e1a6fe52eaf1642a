"""Which banners a campaign shows: stats, tiers, ranking, back-fill, seen lists.

All campaigns are answered in one plan. ``perf`` is a performance table with
one row per (campaign_id, banner_id).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bannerloom.operators import skew

# fixed values of the tier rule
TOP_TIER = 10
MIDDLE_TIER = 5
LOW_LIMIT = 5

# revenue, then clicks; the banner id settles ties
RANKING: skew.Order = [("revenue_total", False), ("click_count", False), ("banner_id", True)]

# seen lists up to this length are answered from the campaign's own array,
# longer ones by an exact join (see answer_long)
SEEN_IN_POOL = 50

# hash prefix digits used to place banners on the back-fill ring: 16^4 groups
RING_DIGITS = 4


def seeded_order(seed: str, *columns: Column | str) -> Column:
    """A repeatable random sort key."""
    return F.md5(F.concat_ws("|", F.lit(seed), *columns))


def campaign_stats(perf: DataFrame, campaign_id: int | None = None) -> DataFrame:
    """Rows, rows with revenue and rows with clicks, per campaign or for one.

    For one campaign the answer is always one row, zeros if it is unknown.
    """
    measures = [
        F.count(F.lit(1)).alias("banner_rows"),
        F.coalesce(F.count_if(F.col("revenue_total") > 0), F.lit(0)).alias("revenue_count"),
        F.coalesce(F.count_if(F.col("click_count") > 0), F.lit(0)).alias("click_count"),
    ]
    if campaign_id is not None:
        return perf.where(F.col("campaign_id") == campaign_id).agg(*measures)
    return perf.groupBy("campaign_id").agg(*measures)


def tier_limit(revenue_count: Column) -> Column:
    return (
        F.when(revenue_count >= TOP_TIER, F.lit(TOP_TIER).cast("long"))
        .when(revenue_count >= MIDDLE_TIER, revenue_count)
        .otherwise(F.lit(LOW_LIMIT).cast("long"))
    )


def rank_banners(perf: DataFrame, min_rows: int | None = None) -> DataFrame:
    """Full ranking of every campaign; a very large campaign is ranked in pieces."""
    return skew.row_numbers(perf, ["campaign_id"], RANKING, "banner_rank", min_rows)


def topk_campaign(perf: DataFrame, campaign_id: int, limit: int) -> DataFrame:
    return perf.where(F.col("campaign_id") == campaign_id).orderBy(*skew.sort_columns(RANKING)).limit(limit)


def serve_campaigns(perf: DataFrame) -> DataFrame:
    """Tiered top-k: the banners of every campaign that its tier allows."""
    stats = campaign_stats(perf).select("campaign_id", tier_limit(F.col("revenue_count")).alias("limit_n"))
    # no tier allows more than TOP_TIER rows, so that bound prunes before the shuffle
    top = skew.top_rows(perf, ["campaign_id"], RANKING, TOP_TIER, "banner_rank")
    return (
        top.join(stats, "campaign_id")
        .where(F.col("banner_rank") <= F.col("limit_n"))
        .select("campaign_id", "banner_id", "banner_rank", "limit_n")
    )


def distinct_banners(perf: DataFrame, without: Sequence[int] = ()) -> DataFrame:
    """Distinct banners of the table, optionally without a short list."""
    pool = perf.where(~F.col("banner_id").isin(list(without))) if without else perf
    return pool.select("banner_id").distinct()


def banner_ring(perf: DataFrame, seed: str) -> DataFrame:
    """Every distinct banner with a position 0..n-1 in a seeded random order.

    Numbering goes through the groups of a hash prefix: equal-sized groups are
    numbered in parallel and shifted by the sizes of the groups before.
    """
    drawn = distinct_banners(perf).withColumn("_h", seeded_order(seed, "banner_id"))
    drawn = drawn.withColumn("_p", F.substring("_h", 1, RING_DIGITS))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    # at most 16^RING_DIGITS rows: small enough for one window and a broadcast
    offsets = (
        drawn.groupBy("_p")
        .agg(F.count(F.lit(1)).alias("_c"))
        .select("_p", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"))
    )
    local = drawn.withColumn("_k", F.row_number().over(Window.partitionBy("_p").orderBy("_h", "banner_id")))
    return local.join(F.broadcast(offsets), "_p").select(
        "banner_id", (F.col("_k") + F.col("_off") - 1).alias("ring_pos")
    )


def short_campaigns(perf: DataFrame, campaigns: DataFrame | None = None) -> DataFrame:
    """Campaigns with fewer than LOW_LIMIT rows as (campaign_id, have).

    ``campaigns`` adds ids that may be absent from ``perf``; those have 0.
    """
    own = perf.groupBy("campaign_id").agg(F.count(F.lit(1)).alias("have"))
    if campaigns is not None:
        asked = campaigns.select("campaign_id").distinct().withColumn("have", F.lit(0).cast("long"))
        own = own.unionByName(asked).groupBy("campaign_id").agg(F.max("have").alias("have"))
    return own.where(F.col("have") < LOW_LIMIT)


def ring_start(seed: str, campaign: Column | str) -> Column:
    """A campaign's random number; modulo the ring size it is a ring position."""
    return F.conv(F.substring(seeded_order(seed, campaign), 1, 8), 16, 10).cast("long")


def ring_steps(size: Column) -> Column:
    """0 .. LOW_LIMIT - 1, fewer on a smaller ring."""
    return F.explode(F.sequence(F.lit(0).cast("long"), F.least(F.lit(LOW_LIMIT).cast("long"), size) - 1))


def draw(short: DataFrame, ring: DataFrame, seed: str) -> DataFrame:
    """The next LOW_LIMIT ring banners from each campaign's own random start."""
    slots = (
        short.withColumn("_size", ring.agg(F.count(F.lit(1))).scalar())
        .where(F.col("_size") > 0)
        .withColumn("step", ring_steps(F.col("_size")))
        .withColumn("ring_pos", (ring_start(seed, "campaign_id") + F.col("step")) % F.col("_size"))
    )
    return slots.join(ring, "ring_pos").select("campaign_id", "have", "banner_id", "step")


def ring_lists(ring: DataFrame) -> DataFrame:
    """For every ring position the LOW_LIMIT banners from there on: (ring_pos, ring_ids)."""
    passed = (
        ring.withColumn("_size", ring.agg(F.count(F.lit(1))).scalar())
        .withColumn("step", ring_steps(F.col("_size")))
        .withColumn("ring_pos", (F.col("ring_pos") - F.col("step") + F.col("_size")) % F.col("_size"))
    )
    items = F.array_sort(F.collect_list(F.struct("step", "banner_id")))
    return passed.groupBy("ring_pos").agg(F.transform(items, lambda x: x["banner_id"]).alias("ring_ids"))


def backfill_candidates(
    perf: DataFrame, seed: str, campaigns: DataFrame | None = None, ring: DataFrame | None = None
) -> DataFrame:
    """Random banners of the whole table for campaigns with fewer than LOW_LIMIT rows.

    A campaign starts at a random ring position and looks at the next LOW_LIMIT
    banners. It owns fewer than LOW_LIMIT, so what is left after removing its
    own always fills the gap (as far as the table has that many banners), and no
    campaign is paired with the whole banner list.
    """
    drawn = draw(short_campaigns(perf, campaigns), banner_ring(perf, seed) if ring is None else ring, seed)
    picked = perf.select("campaign_id", "banner_id")
    return drawn.join(picked, ["campaign_id", "banner_id"], "left_anti")


def serve_with_backfill(
    perf: DataFrame, seed: str, campaigns: DataFrame | None = None, ring: DataFrame | None = None
) -> DataFrame:
    """Tiered top-k, filled up from the ring where a campaign has too few banners."""
    served = serve_campaigns(perf).select(
        "campaign_id", "banner_id", F.col("banner_rank").cast("long").alias("pos"), F.lit(False).alias("is_backfill")
    )
    candidates = backfill_candidates(perf, seed, campaigns, ring)
    extra = skew.top_rows(candidates, ["campaign_id"], [("step", True)], LOW_LIMIT, "draw")
    filled = extra.where(F.col("draw") <= LOW_LIMIT - F.col("have")).select(
        "campaign_id", "banner_id", (F.col("have") + F.col("draw")).alias("pos"), F.lit(True).alias("is_backfill")
    )
    return served.unionByName(filled)


def shuffled_order(served: DataFrame, seed: str) -> DataFrame:
    """Final random order inside each served list (lists have at most TOP_TIER rows)."""
    w = Window.partitionBy("campaign_id").orderBy(seeded_order(seed, "campaign_id", "banner_id"), "banner_id")
    return served.withColumn("show_pos", F.row_number().over(w))


def served_arrays(served: DataFrame, position: str = "pos") -> DataFrame:
    """One row per campaign: the banner ids in position order (at most TOP_TIER)."""
    items = F.array_sort(F.collect_list(F.struct(F.col(position).alias("p"), F.col("banner_id").alias("b"))))
    return (
        served.groupBy("campaign_id")
        .agg(items.alias("_items"))
        .select("campaign_id", F.transform("_items", lambda x: x["b"]).alias("banner_ids"))
    )


def prefer_unseen(pool: Column, seen: Column, limit: int) -> Column:
    """Unseen banners in pool order, then seen ones, up to the limit."""
    unseen_first = F.concat(F.array_except(pool, seen), F.array_intersect(pool, seen))
    return F.slice(unseen_first, 1, limit)


def shuffled_array(ids: Column, seed: str, campaign: Column) -> Column:
    """Array form of ``shuffled_order``."""
    keyed = F.transform(ids, lambda b: F.struct(seeded_order(seed, campaign, b).alias("h"), b.alias("b")))
    return F.transform(F.array_sort(keyed), lambda x: x["b"])


def serving_lists(perf: DataFrame, seed: str, ring: DataFrame | None = None) -> DataFrame:
    """One row per campaign of the table with everything needed to answer a request.

    ``fixed`` is the list of the lower tiers; ``pool`` holds the top banners of
    a top-tier campaign, enough for seen lists up to SEEN_IN_POOL entries.
    """
    stats = campaign_stats(perf).select("campaign_id", "revenue_count")
    top = skew.top_rows(perf, ["campaign_id"], RANKING, TOP_TIER + SEEN_IN_POOL, "pos")
    pool = served_arrays(top).withColumnRenamed("banner_ids", "pool")
    fixed = served_arrays(serve_with_backfill(perf, seed, ring=ring)).withColumnRenamed("banner_ids", "fixed")
    return (
        fixed.join(stats, "campaign_id")
        .join(pool, "campaign_id")
        .select("campaign_id", "fixed", F.when(F.col("revenue_count") >= TOP_TIER, F.col("pool")).alias("pool"))
    )


def answer(visits: DataFrame, lists: DataFrame, around: DataFrame, ring_size: int, seed: str) -> DataFrame:
    """Adds ``picks`` to visits(campaign_id, seen): the unshuffled served ids.

    Right for seen lists up to SEEN_IN_POOL distinct entries. Without any banner the
    list is empty.
    """
    known = with_lists(visits, lists, around, ring_size, seed)
    picks = F.when(F.col("pool").isNotNull(), prefer_unseen(F.col("pool"), F.col("seen"), TOP_TIER)).otherwise(
        F.col("fixed")
    )
    return known.withColumn("picks", F.coalesce(picks, F.array().cast("array<int>")))


def with_lists(visits: DataFrame, lists: DataFrame, around: DataFrame, ring_size: int, seed: str) -> DataFrame:
    """Visits with ``fixed`` and ``pool`` of their campaign.

    A campaign that the table does not have gets the random banners at its ring
    position. Requests pile up on popular campaigns; both list tables are written
    tables with one row per key, so adaptive skew splitting applies.
    """
    position = ring_start(seed, "campaign_id") % max(ring_size, 1)
    return (
        visits.join(lists, "campaign_id", "left")
        .withColumn("ring_pos", position)
        .join(around, "ring_pos", "left")
        .withColumn("fixed", F.coalesce("fixed", "ring_ids"))
        .drop("ring_pos", "ring_ids")
    )


def seen_size(seen: Column) -> Column:
    return F.size(F.array_distinct(seen))


def answer_long(visits: DataFrame, perf: DataFrame, key: str) -> DataFrame:
    """Picks for top-tier visits with long seen lists: (key, picks).

    A visit with s seen banners needs the first TOP_TIER + s ranks of its
    campaign and no more, so the work is linear in the length of the lists.
    """
    top = campaign_stats(perf).where(F.col("revenue_count") >= TOP_TIER).select("campaign_id")
    wanted = (
        visits.join(top, "campaign_id", "left_semi")
        .withColumn("seen", F.array_distinct("seen"))
        .select(key, "campaign_id", "seen")
    )
    ranks = wanted.select(
        key, "campaign_id", F.explode(F.sequence(F.lit(1), F.size("seen") + TOP_TIER)).alias("banner_rank")
    )
    ranked = rank_banners(perf).select("campaign_id", F.col("banner_rank").cast("int").alias("banner_rank"), "banner_id")
    candidates = skew.join_unique(ranks, ranked, ["campaign_id", "banner_rank"], "inner")
    seen = wanted.select(key, F.explode("seen").alias("banner_id"), F.lit(1).alias("is_seen"))
    ordered = candidates.join(seen, [key, "banner_id"], "left").na.fill({"is_seen": 0})
    first = skew.top_rows(ordered, [key], [("is_seen", True), ("banner_rank", True)], TOP_TIER, "pos")
    items = F.array_sort(F.collect_list(F.struct("pos", "banner_id")))
    return first.groupBy(key).agg(F.transform(items, lambda x: x["banner_id"]).alias("long_picks"))
