"""Input views over the given tables, for Spark and as SQL text.

``Views`` derives the advertising tables from ``events`` and friends with the
DataFrame API. ``SQL`` holds the same definitions as text, used only to state
the expected results of the queries independently.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bannerloom.operators import skew
from bannerloom.operators.performance import banner_performance
from bannerloom.operators.requests import Serving, publish
from bannerloom.session import scratch_dir
from bannerloom.sources import tables

SEED = "s1"
HISTORY_DAYS = 20  # day folders up to this one count as processed


class Views:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        k = F.get_json_object("props", "$.k").cast("int")
        return self.table("events").withColumns(
            {
                "k": k,
                "banner_id": k % 20,
                "campaign_id": F.when(F.col("user_id") % 3 == 0, F.lit(100000) + F.col("user_id") % 5).otherwise(
                    F.col("user_id")
                ),
                "period": F.least(F.lit(3), F.floor((F.dayofmonth("ts") - 1) / 10).cast("int") + 1),
            }
        )

    def _of_type(self, event_type: str) -> DataFrame:
        return self.events.where(F.col("event_type") == event_type)

    @cached_property
    def impressions(self) -> DataFrame:
        return self._of_type("view").select("banner_id", "campaign_id", "period", "ts")

    @cached_property
    def clicks(self) -> DataFrame:
        return self._of_type("click").select(
            F.col("event_id").alias("click_id"), "banner_id", "campaign_id", "period", "ts"
        )

    @cached_property
    def conversions(self) -> DataFrame:
        """A purchase converts the greatest click id so far of the same user."""
        relevant = self.events.where(F.col("event_type").isin("click", "purchase")).select(
            "user_id", "ts", "event_id", "event_type", "value", "period"
        )
        with_click = skew.running_max(
            relevant,
            ["user_id"],
            [("ts", True), ("event_id", True)],
            F.when(F.col("event_type") == "click", F.col("event_id")),
            "click_id",
        )
        return with_click.where(
            (F.col("event_type") == "purchase") & F.col("click_id").isNotNull() & (F.col("user_id") % 7 != 1)
        ).select(F.col("event_id").alias("conversion_id"), "click_id", F.col("value").alias("revenue"), "period", "ts")

    @cached_property
    def perf(self) -> DataFrame:
        """Performance table with revenue in whole cents, as the serving queries read it."""
        raw = banner_performance(self.clicks, self.impressions, self.conversions)
        return raw.withColumn("revenue_total", F.round("revenue_total", 2))

    @cached_property
    def perf_table(self) -> DataFrame:
        """``perf`` as a written table, for queries that read it several times."""
        return tables.write_out(tables.clustered(self.perf), scratch_dir(self.spark, "perf"))

    @cached_property
    def ready(self) -> Serving:
        """What requests are answered from, published from ``perf_table``."""
        return publish(self.perf_table, SEED, scratch_dir(self.spark, "serving"))

    @cached_property
    def requests(self) -> DataFrame:
        e = F.col("event_id")
        k = F.col("k")
        return self._of_type("signup").select(
            e.alias("request_id"),
            "ts",
            F.col("user_id").alias("user_key"),
            F.when(e % 10 == 0, "POST").otherwise("GET").alias("method"),
            F.when(e % 11 == 0, "hi")
            .when(e % 13 == 0, F.lit(None).cast("string"))
            .otherwise(F.col("campaign_id").cast("string"))
            .alias("campaign_id"),
            F.when(e % 3 == 0, F.format_string("other=[1, 2]; seen_banners_cookie=[%d, %d]", k % 20, (k + 3) % 20))
            .otherwise("bla bla bla")
            .alias("cookie"),
        )

    @cached_property
    def ops(self) -> DataFrame:
        t = F.col("event_type")
        op = (
            F.when(t == "signup", "upsert")
            .when(t == "view", "set")
            .when(t == "purchase", "inc")
            .when(t == "error", "delete")
            .otherwise("insert")
        )
        return self.events.select(
            F.col("event_id").alias("seq"),
            (F.col("user_id") * 120 + F.col("k")).alias("o_orderkey"),
            op.alias("op"),
            F.col("value").alias("amount"),
        )

    @cached_property
    def files(self) -> DataFrame:
        name = F.concat(F.lit("f"), (F.col("user_id") % 50).cast("string"))
        return self.events.select(F.col("event_id").alias("file_id"), name.alias("filename"), F.col("ts").alias("upload_date"))

    @cached_property
    def blobs(self) -> DataFrame:
        return self.table("documents").select(F.col("doc_id").alias("file_id"), F.col("text").alias("content"))

    @cached_property
    def refs(self) -> DataFrame:
        return self.table("orders").select("o_orderkey", (F.col("o_custkey") + 100).alias("ref_id"))

    @cached_property
    def oids(self) -> DataFrame:
        def hexed(c: Column, width: int) -> Column:
            return F.lower(F.lpad(F.hex(c), width, "0"))

        seconds = F.unix_timestamp(F.col("ts").cast("timestamp"))
        return self.events.select(
            "event_id", F.concat(hexed(seconds, 8), hexed(F.col("event_id"), 16)).alias("oid")
        )


# The same views as SQL text: name -> (views it reads, definition).
SQL: dict[str, tuple[list[str], str]] = {
    "ev": (
        [],
        """SELECT *,
  CAST(json_extract_string(props,'$.k') AS INTEGER) AS k,
  CAST(json_extract_string(props,'$.k') AS INTEGER) % 20 AS banner_id,
  CASE WHEN user_id % 3 = 0 THEN 100000 + user_id % 5 ELSE user_id END AS campaign_id,
  LEAST(3, CAST(FLOOR((EXTRACT(day FROM ts) - 1) / 10) AS INTEGER) + 1) AS period
FROM events""",
    ),
    "imp": (["ev"], "SELECT banner_id, campaign_id, period, ts FROM ev WHERE event_type = 'view'"),
    "clk": (
        ["ev"],
        "SELECT event_id AS click_id, banner_id, campaign_id, period, ts FROM ev WHERE event_type = 'click'",
    ),
    "conv": (
        ["ev"],
        """SELECT conversion_id, click_id, revenue, period, ts FROM (
  SELECT event_id AS conversion_id, user_id, event_type, value AS revenue, period, ts,
         MAX(CASE WHEN event_type = 'click' THEN event_id END)
           OVER (PARTITION BY user_id ORDER BY ts, event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS click_id
  FROM ev) t
WHERE event_type = 'purchase' AND click_id IS NOT NULL AND user_id % 7 <> 1""",
    ),
    "perf": (
        ["imp", "clk", "conv"],
        """SELECT
  ROUND(SUM(COALESCE(v.revenue, 0)), 2) AS revenue_total,
  CAST(SUM(i.impression_count) AS BIGINT) AS impression_count,
  CAST(c.campaign_id AS INTEGER) AS campaign_id,
  CAST(c.banner_id AS INTEGER) AS banner_id,
  CAST(COUNT(c.click_id) AS INTEGER) AS click_count
FROM clk c
LEFT JOIN (SELECT campaign_id, banner_id, COUNT(*) AS impression_count FROM imp GROUP BY 1, 2) i
  ON c.campaign_id = i.campaign_id AND c.banner_id = i.banner_id
LEFT JOIN conv v ON c.click_id = v.click_id
GROUP BY c.campaign_id, c.banner_id""",
    ),
    "period_perf": (
        ["imp", "clk", "conv"],
        """SELECT c.period AS dataset_id,
  ROUND(SUM(COALESCE(v.revenue, 0)), 2) AS revenue_total,
  CAST(SUM(i.impression_count) AS BIGINT) AS impression_count,
  CAST(c.campaign_id AS INTEGER) AS campaign_id,
  CAST(c.banner_id AS INTEGER) AS banner_id,
  CAST(COUNT(c.click_id) AS INTEGER) AS click_count
FROM clk c
LEFT JOIN (SELECT period, campaign_id, banner_id, COUNT(*) AS impression_count FROM imp GROUP BY 1, 2, 3) i
  ON c.campaign_id = i.campaign_id AND c.banner_id = i.banner_id AND c.period = i.period
LEFT JOIN conv v ON c.click_id = v.click_id AND c.period = v.period
GROUP BY c.period, c.campaign_id, c.banner_id""",
    ),
    "requests": (
        ["ev"],
        """SELECT event_id AS request_id, ts, user_id AS user_key,
  CASE WHEN event_id % 10 = 0 THEN 'POST' ELSE 'GET' END AS method,
  CASE WHEN event_id % 11 = 0 THEN 'hi' WHEN event_id % 13 = 0 THEN NULL
       ELSE CAST(campaign_id AS VARCHAR) END AS campaign_id,
  CASE WHEN event_id % 3 = 0
       THEN 'other=[1, 2]; seen_banners_cookie=[' || k % 20 || ', ' || (k + 3) % 20 || ']'
       ELSE 'bla bla bla' END AS cookie
FROM ev WHERE event_type = 'signup'""",
    ),
    "ops": (
        ["ev"],
        """SELECT event_id AS seq, user_id * 120 + k AS o_orderkey,
  CASE event_type WHEN 'signup' THEN 'upsert' WHEN 'view' THEN 'set'
                  WHEN 'purchase' THEN 'inc' WHEN 'error' THEN 'delete' ELSE 'insert' END AS op,
  value AS amount
FROM ev""",
    ),
    "files": (["ev"], "SELECT event_id AS file_id, 'f' || (user_id % 50) AS filename, ts AS upload_date FROM ev"),
    "blobs": ([], "SELECT doc_id AS file_id, text AS content FROM documents"),
    "refs": ([], "SELECT o_orderkey, o_custkey + 100 AS ref_id FROM orders"),
    "oids": (
        ["ev"],
        """SELECT event_id,
  LOWER(LPAD(TO_HEX(CAST(FLOOR(EPOCH(ts)) AS BIGINT)), 8, '0')) || LOWER(LPAD(TO_HEX(event_id), 16, '0')) AS oid
FROM ev""",
    ),
    # serving rules
    "stats": (
        ["perf"],
        """SELECT campaign_id, COUNT(*) AS banner_rows,
  CAST(SUM(CASE WHEN revenue_total > 0 THEN 1 ELSE 0 END) AS BIGINT) AS revenue_count,
  CAST(SUM(CASE WHEN click_count > 0 THEN 1 ELSE 0 END) AS BIGINT) AS click_count
FROM perf GROUP BY campaign_id""",
    ),
    "ranked": (
        ["perf"],
        """SELECT *, ROW_NUMBER() OVER (PARTITION BY campaign_id
  ORDER BY revenue_total DESC NULLS LAST, click_count DESC NULLS LAST, banner_id) AS banner_rank FROM perf""",
    ),
    "served": (
        ["ranked", "stats"],
        """SELECT campaign_id, banner_id, banner_rank, limit_n FROM ranked
JOIN (SELECT campaign_id, CASE WHEN revenue_count >= 10 THEN 10 WHEN revenue_count >= 5 THEN revenue_count
      ELSE 5 END AS limit_n FROM stats) t USING (campaign_id)
WHERE banner_rank <= limit_n""",
    ),
    "ring": (
        ["perf"],
        """SELECT banner_id, ROW_NUMBER() OVER (ORDER BY md5('SEED|' || banner_id), banner_id) - 1 AS ring_pos
FROM (SELECT DISTINCT banner_id FROM perf)""",
    ),
    "asked": (
        ["requests"],
        """SELECT DISTINCT TRY_CAST(campaign_id AS INTEGER) AS campaign_id FROM requests
WHERE method = 'GET' AND TRY_CAST(campaign_id AS INTEGER) IS NOT NULL""",
    ),
    "known": (["perf"], "SELECT DISTINCT campaign_id FROM perf"),
    "known_or_asked": (
        ["known", "asked"],
        "SELECT campaign_id FROM known UNION SELECT campaign_id FROM asked",
    ),
    "backfill": (
        ["perf", "ring", "CAMPAIGNS"],
        """SELECT s.campaign_id, have, banner_id, step FROM (
  SELECT c.campaign_id, COALESCE(n, 0) AS have FROM CAMPAIGNS c
  LEFT JOIN (SELECT campaign_id, COUNT(*) AS n FROM perf GROUP BY 1) p USING (campaign_id)
  WHERE COALESCE(n, 0) < 5) s,
  UNNEST([0, 1, 2, 3, 4]) AS u(step),
  ring r
WHERE r.ring_pos = (('0x' || SUBSTR(md5('SEED|' || s.campaign_id), 1, 8))::BIGINT + step)
      % (SELECT COUNT(*) FROM ring)
  AND step < (SELECT COUNT(*) FROM ring)
  AND (s.campaign_id, banner_id) NOT IN (SELECT (campaign_id, banner_id) FROM perf)""",
    ),
    "filled": (
        ["served", "backfill"],
        """SELECT campaign_id, banner_id, banner_rank AS pos, FALSE AS is_backfill FROM served
UNION ALL
SELECT campaign_id, banner_id, have + draw, TRUE FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY campaign_id ORDER BY step) AS draw FROM backfill) b
WHERE draw <= 5 - have""",
    ),
    "visits": (
        ["requests"],
        """SELECT request_id, ts, user_key, TRY_CAST(campaign_id AS INTEGER) AS campaign_id,
  CASE WHEN cookie LIKE '%seen_banners_cookie=%'
       THEN CAST(string_split(regexp_extract(cookie, 'seen_banners_cookie=\\[([^\\]]*)\\]', 1), ', ') AS INTEGER[])
       ELSE CAST([] AS INTEGER[]) END AS seen
FROM requests WHERE method = 'GET' AND TRY_CAST(campaign_id AS INTEGER) IS NOT NULL""",
    ),
    "picks": (
        ["visits", "ranked", "stats", "filled"],
        """SELECT request_id, ts, user_key, campaign_id, banner_id, pos FROM (
  SELECT v.request_id, v.ts, v.user_key, v.campaign_id, r.banner_id, ROW_NUMBER() OVER (
    PARTITION BY request_id ORDER BY list_contains(v.seen, r.banner_id), banner_rank) AS pos
  FROM visits v JOIN stats s ON s.campaign_id = v.campaign_id AND revenue_count >= 10
  JOIN ranked r ON r.campaign_id = v.campaign_id) WHERE pos <= 10
UNION ALL
SELECT v.request_id, v.ts, v.user_key, v.campaign_id, f.banner_id, f.pos
FROM visits v JOIN filled f ON f.campaign_id = v.campaign_id
LEFT JOIN stats s ON s.campaign_id = v.campaign_id WHERE COALESCE(revenue_count, 0) < 10""",
    ),
}


def with_views(body: str, *names: str, seed: str = SEED, campaigns: str = "known", recursive: bool = False) -> str:
    """A statement with the named views, and those they read, as CTEs in front."""
    ordered: list[str] = []

    def add(name: str) -> None:
        name = campaigns if name == "CAMPAIGNS" else name
        if name in ordered:
            return
        for parent in SQL[name][0]:
            add(parent)
        ordered.append(name)

    for name in names:
        add(name)
    ctes = ",\n".join(
        f"{n} AS ({SQL[n][1]})".replace("SEED", seed).replace("CAMPAIGNS", campaigns) for n in ordered
    )
    return f"WITH {'RECURSIVE ' if recursive else ''}{ctes}\n{body}"
