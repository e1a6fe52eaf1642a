"""User-level reads, references, folds and table modification."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bannerloom.operators import find, modify, references
from bannerloom.plans.registry import query
from bannerloom.plans.views import Views, with_views

ORDER = [("o_orderpriority", True), ("o_totalprice", False), ("o_orderkey", True)]
ORDER_SQL = "o_orderpriority, o_totalprice DESC NULLS LAST, o_orderkey"


@query("project_include", "SELECT o_orderkey, o_totalprice FROM orders")
def _(v: Views) -> DataFrame:
    return find.project(v.table("orders"), include=["o_orderkey", "o_totalprice"])


@query(
    "project_include_exclude",
    """SELECT o_orderkey, o_totalprice AS order_price, o_orderstatus AS order_status FROM orders""",
)
def _(v: Views) -> DataFrame:
    o = v.table("orders")
    nested = o.select(
        "o_orderkey",
        "o_custkey",
        F.struct(
            F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("date")
        ).alias("order"),
    )
    slim = find.project(nested, exclude=["o_custkey", "order.date"])
    kept = find.project(slim, include=["o_orderkey", "order.price", "order.status"])
    return kept.select("o_orderkey", F.col("order.price").alias("order_price"), F.col("order.status").alias("order_status"))


@query(
    "key_range_scan",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem
WHERE (l_orderkey > 100 OR (l_orderkey = 100 AND l_linenumber >= 3))
  AND (l_orderkey < 900 OR (l_orderkey = 900 AND l_linenumber < 5))""",
)
def _(v: Views) -> DataFrame:
    lines = v.table("lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return find.key_range(lines, ["l_orderkey", "l_linenumber"], (100, 3), (900, 5))


def odd_parity(keys: pd.Series) -> pd.Series:
    """True where the number has an odd count of one bits."""
    x = keys.to_numpy(dtype=np.uint64)
    for shift in (32, 16, 8, 4, 2, 1):
        x = x ^ (x >> np.uint64(shift))
    return pd.Series((x & np.uint64(1)).astype(bool))


@query("predicate_udf", "SELECT o_orderkey, o_totalprice FROM orders WHERE bit_count(o_orderkey) % 2 = 1")
def _(v: Views) -> DataFrame:
    return find.where_python(v.table("orders").select("o_orderkey", "o_totalprice"), odd_parity, "o_orderkey")


@query(
    "collated_filter_sort",
    """SELECT p_partkey, p_brand, p_type, ROW_NUMBER() OVER (
  ORDER BY CAST(substr(p_brand, 7) AS INTEGER), p_partkey) AS position
FROM part WHERE lower(p_type) = lower('economy')""",
)
def _(v: Views) -> DataFrame:
    parts = v.table("part").select("p_partkey", "p_brand", "p_type")
    some = parts.where(find.collated(F.col("p_type"), 2) == find.collated(F.lit("economy"), 2))
    keyed = some.withColumn("_k", find.numeric_key(F.col("p_brand")))
    return find.with_position(keyed, [("_k", True), ("p_partkey", True)]).drop("_k").withColumn(
        "position", F.col("position").cast("long")
    )


@query(
    "collated_strengths",
    """SELECT lang, COUNT(*) FILTER (lower(strip_accents(split_part(text, ' ', 1))) = lower(strip_accents('éeau'))) AS letters,
  COUNT(*) FILTER (lower(split_part(text, ' ', 1)) = 'éeau') AS accents,
  COUNT(*) FILTER (split_part(text, ' ', 1) = 'Éeau') AS cased
FROM documents GROUP BY lang""",
)
def _(v: Views) -> DataFrame:
    word = F.split_part("text", F.lit(" "), F.lit(1))
    docs = v.table("documents").select("lang", word.alias("w"))

    def equal(strength: int, text: str) -> Column:
        return F.count_if(find.collated(F.col("w"), strength) == find.collated(F.lit(text), strength))

    return docs.groupBy("lang").agg(
        equal(1, "éeau").alias("letters"), equal(2, "éeau").alias("accents"), equal(3, "Éeau").alias("cased")
    )


@query(
    "retention_filter",
    """SELECT event_id, ts, user_id FROM events
WHERE ts >= (SELECT MAX(ts) FROM events) - INTERVAL 604800 SECOND""",
)
def _(v: Views) -> DataFrame:
    e = v.table("events").select("event_id", "ts", "user_id")
    return find.retain(e, "ts", e.agg(F.max("ts")).scalar(), 7 * 24 * 3600)


JAN_10, JAN_20 = 1704844800, 1705708800  # 2024-01-10 and 2024-01-20, seconds


@query(
    "oid_time_range",
    with_views(
        f"""SELECT event_id, oid, CAST(EPOCH(date_trunc('second', ts)) AS BIGINT) AS generated FROM oids JOIN events USING (event_id)
WHERE FLOOR(EPOCH(ts)) >= {JAN_10} AND FLOOR(EPOCH(ts)) < {JAN_20}""",
        "oids",
    ),
)
def _(v: Views) -> DataFrame:
    found = find.oid_between(v.oids, "oid", JAN_10, JAN_20)
    return found.withColumn("generated", F.unix_timestamp(find.oid_time(F.col("oid"))))


@query("sort_multi", f"SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY {ORDER_SQL}) AS position FROM orders")
def _(v: Views) -> DataFrame:
    placed = find.with_position(v.table("orders").select("o_orderkey", "o_orderpriority", "o_totalprice"), ORDER)
    return placed.select("o_orderkey", F.col("position").cast("long").alias("position"))


@query("skip_limit_page", f"SELECT o_orderkey, o_totalprice FROM orders ORDER BY {ORDER_SQL} LIMIT 50 OFFSET 100")
def _(v: Views) -> DataFrame:
    return find.page(v.table("orders"), ORDER, 100, 50).select("o_orderkey", "o_totalprice")


@query("skip_all_page", f"SELECT o_orderkey, o_totalprice FROM orders ORDER BY {ORDER_SQL} OFFSET 1000")
def _(v: Views) -> DataFrame:
    return find.page(v.table("orders"), ORDER, 1000).select("o_orderkey", "o_totalprice")


DEEP = [("l_extendedprice", False), ("l_orderkey", True), ("l_linenumber", True)]


@query(
    "skip_deep_page",
    """SELECT l_orderkey, l_linenumber, l_extendedprice FROM (SELECT *, ROW_NUMBER() OVER (
  ORDER BY l_extendedprice DESC NULLS LAST, l_orderkey, l_linenumber) AS i FROM lineitem), (SELECT COUNT(*) // 2 AS half FROM lineitem)
WHERE i > half AND i <= half + 200""",
)
def _(v: Views) -> DataFrame:
    """A page from the middle of the table, found without sorting what lies before."""
    items = v.table("lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return find.page(items, DEEP, items.count() // 2, 200, in_one_task=5_000)


FIRST_WORDS = "(SELECT doc_id, split_part(replace(text, chr(10), ' '), ' ', 1) AS word FROM documents)"


def _first_words(v: Views) -> DataFrame:
    return v.table("documents").select("doc_id", F.split_part(F.replace(F.col("text"), F.lit("\n"), F.lit(" ")), F.lit(" "), F.lit(1)).alias("word"))


@query(
    "collated_sort_de",
    f"SELECT doc_id, word, ROW_NUMBER() OVER (ORDER BY word COLLATE de NULLS FIRST, doc_id) AS position FROM {FIRST_WORDS}",
)
def _(v: Views) -> DataFrame:
    return find.collated_sort(_first_words(v), "word", [("doc_id", True)], "position", locale="de")


@query(
    "collated_sort_sv",
    f"SELECT doc_id, word, ROW_NUMBER() OVER (ORDER BY word COLLATE sv NULLS FIRST, doc_id) AS position FROM {FIRST_WORDS}",
)
def _(v: Views) -> DataFrame:
    return find.collated_sort(_first_words(v), "word", [("doc_id", True)], "position", locale="sv")


@query("find_one", f"SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 100000 ORDER BY {ORDER_SQL} LIMIT 1")
def _(v: Views) -> DataFrame:
    return find.find_one(v.table("orders"), F.col("o_totalprice") > 100000, ORDER).select("o_orderkey", "o_totalprice")


@query(
    "count_skip_limit",
    """SELECT CAST(GREATEST(0, LEAST(500, COUNT(*) - 10)) AS BIGINT) AS n FROM orders WHERE o_orderstatus = 'F'""",
)
def _(v: Views) -> DataFrame:
    return find.count_page(v.table("orders").where(F.col("o_orderstatus") == "F"), 10, 500)


@query("distinct_filtered", "SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice > 200000")
def _(v: Views) -> DataFrame:
    return find.distinct_values(v.table("orders"), "o_custkey", F.col("o_totalprice") > 200000)


@query(
    "distinct_array_elements",
    "SELECT DISTINCT unnest(string_split(text, ' ')) AS words FROM documents WHERE lang = 'fr'",
)
def _(v: Views) -> DataFrame:
    docs = v.table("documents").select("lang", F.split("text", " ", -1).alias("words"))
    return find.distinct_values(docs, "words", F.col("lang") == "fr")


@query(
    "array_filtered_update",
    """SELECT doc_id, array_to_string(list_transform(string_split(text, ' '),
  lambda w: CASE WHEN length(w) > 7 THEN '<' || w || '>' ELSE w END), ' ') AS marked FROM documents""",
)
def _(v: Views) -> DataFrame:
    words = F.split("text", " ", -1)
    marked = find.update_elements(words, lambda w: F.length(w) > 7, lambda w: F.concat(F.lit("<"), w, F.lit(">")))
    return v.table("documents").select("doc_id", F.array_join(marked, " ").alias("marked"))


@query(
    "group_builtin",
    """SELECT o_orderstatus, COUNT(*) AS n, ROUND(SUM(o_totalprice) / COUNT(*), 2) AS mean
FROM orders WHERE o_totalprice > 50000 GROUP BY o_orderstatus""",
)
def _(v: Views) -> DataFrame:
    return find.group_aggregate(
        v.table("orders"),
        ["o_orderstatus"],
        F.col("o_totalprice") > 50000,
        {"count": F.count(F.lit(1)), "total": F.sum("o_totalprice")},
        {"n": F.col("count"), "mean": F.round(F.col("total") / F.col("count"), 2)},
    )


def _joined_runs(a: Column, b: Column) -> Column:
    rise = F.when(b["first"] > a["last"], 1).otherwise(0)
    return F.struct(
        a["first"].alias("first"), b["last"].alias("last"), (a["rises"] + b["rises"] + rise).alias("rises")
    )


# a fold that depends on the order: first value, last value, number of rises
@query(
    "group_fold",
    """SELECT o_orderstatus, MIN_BY(o_totalprice, o_orderkey) AS first_price, MAX_BY(o_totalprice, o_orderkey) AS last_price,
  CAST(SUM(CASE WHEN o_totalprice > before THEN 1 ELSE 0 END) AS BIGINT) AS rises FROM (
  SELECT *, LAG(o_totalprice) OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS before FROM orders)
GROUP BY o_orderstatus""",
)
def _(v: Views) -> DataFrame:
    price = F.col("o_totalprice")
    return find.group_fold(
        v.table("orders"),
        ["o_orderstatus"],
        None,
        "o_orderkey",
        F.struct(price.alias("first"), price.alias("last"), F.lit(0).cast("long").alias("rises")),
        _joined_runs,
        {"first_price": lambda a: a["first"], "last_price": lambda a: a["last"], "rises": lambda a: a["rises"]},
    )


def _words(docs: DataFrame) -> Column:
    return F.transform(F.split("text", " ", -1), lambda w: F.struct(w.alias("key"), F.lit(1).cast("long").alias("value")))


WORDS_SQL = "SELECT unnest(string_split(text, ' ')) AS key FROM documents"


@query("map_reduce", f"SELECT key, COUNT(*) AS value FROM ({WORDS_SQL}) GROUP BY key")
def _(v: Views) -> DataFrame:
    docs = v.table("documents").select("text")
    return find.map_reduce(docs, _words(docs), F.sum)


@query(
    "map_reduce_merge",
    f"""WITH old AS (SELECT key, COUNT(*) AS value FROM ({WORDS_SQL} WHERE doc_id % 2 = 0) GROUP BY key),
new AS (SELECT key, COUNT(*) AS value FROM ({WORDS_SQL} WHERE doc_id % 2 = 1) GROUP BY key)
SELECT * FROM new UNION ALL SELECT * FROM old WHERE key NOT IN (SELECT key FROM new)""",
)
def _(v: Views) -> DataFrame:
    docs = v.table("documents").select("doc_id", "text")
    old = find.map_reduce(docs.where("doc_id % 2 = 0"), _words(docs), F.sum)
    return find.map_reduce(docs.where("doc_id % 2 = 1"), _words(docs), F.sum, old, "merge")


@query("map_reduce_reduce", f"SELECT key, COUNT(*) AS value FROM ({WORDS_SQL}) GROUP BY key")
def _(v: Views) -> DataFrame:
    docs = v.table("documents").select("doc_id", "text")
    old = find.map_reduce(docs.where("doc_id % 2 = 0"), _words(docs), F.sum)
    return find.map_reduce(docs.where("doc_id % 2 = 1"), _words(docs), F.sum, old, "reduce")


@query(
    "dereference",
    with_views(
        """SELECT o_orderkey, ref_id, 'customer' AS collection, c_name AS name FROM refs LEFT JOIN customer ON ref_id = c_custkey
WHERE o_orderkey % 3 > 0
UNION ALL
SELECT o_orderkey, ref_id, 'supplier', s_name FROM refs LEFT JOIN supplier ON ref_id = s_suppkey WHERE o_orderkey % 3 = 0""",
        "refs",
    ),
)
def _(v: Views) -> DataFrame:
    collection = F.when(F.col("o_orderkey") % 3 == 0, "supplier").otherwise("customer")
    refs = v.refs.select(
        "o_orderkey",
        F.struct(collection.alias("collection"), F.col("ref_id").alias("id"), F.lit("main").alias("database")).alias("ref"),
    )
    customers = v.table("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("label"))
    suppliers = v.table("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("label"))
    followed = references.dereference(
        refs, {"customer": (customers, "id"), "supplier": (suppliers, "id")}, {"name": "label"}
    )
    return followed.select("o_orderkey", F.col("ref.id").alias("ref_id"), F.col("ref.collection").alias("collection"), "name")


@query(
    "dereference_nested",
    with_views(
        """SELECT request_id, COALESCE(string_agg(COALESCE(p_name, '?'), ',' ORDER BY pos), '') AS names FROM (
  SELECT request_id, unnest(seen) AS id, generate_subscripts(seen, 1) AS pos FROM visits) s
LEFT JOIN part ON p_partkey = id * 150 GROUP BY request_id
UNION ALL SELECT request_id, '' FROM visits WHERE len(seen) = 0""",
        "visits",
    ),
)
def _(v: Views) -> DataFrame:
    from bannerloom.operators.requests import visits_of

    visits = visits_of(v.requests).select("request_id", F.transform("seen", lambda x: x * 150).alias("parts"))
    named = references.dereference_array(visits, "request_id", "parts", v.table("part"), "p_partkey", "p_name", "names")
    return named.select("request_id", F.array_join("names", ",", "?").alias("names"))


@query(
    "dereference_recursive",
    """WITH RECURSIVE c AS (SELECT c_custkey AS k, c_name AS name, CASE
    WHEN c_custkey // 10 % 2 = 0 THEN [CASE WHEN c_custkey % 10 = 9 THEN c_custkey - 9 ELSE c_custkey + 1 END]
    WHEN c_custkey % 10 = 0 THEN [c_custkey + 1, c_custkey + 5] WHEN c_custkey % 10 < 9 THEN [c_custkey + 1] ELSE [] END AS refs FROM customer),
run AS (
  SELECT k AS root, 1 AS depth, [k] AS path, k AS id, TRUE AS found, FALSE AS cycle, name, refs FROM c
  UNION ALL
  SELECT root, depth + 1, list_append(path, u.id), u.id, c.k IS NOT NULL, list_contains(path, u.id), c.name,
    CASE WHEN NOT list_contains(path, u.id) THEN c.refs END
  FROM (SELECT root, depth, path, UNNEST(refs) AS id FROM run) u LEFT JOIN c ON c.k = u.id
)
SELECT root, depth, array_to_string(path, ',') AS path, id, found, cycle, name FROM run""",
)
def _(v: Views) -> DataFrame:
    """Every second ten of customers is a circle of references, the others are chains with a short cut."""
    k, digit = F.col("c_custkey"), F.col("c_custkey") % 10
    circle = F.array(F.when(digit == 9, k - 9).otherwise(k + 1))
    chain = F.when(digit == 0, F.array(k + 1, k + 5)).when(digit < 9, F.array(k + 1)).otherwise(F.array().cast("array<bigint>"))
    refs = F.when(F.floor(k / 10) % 2 == 0, circle).otherwise(chain).cast("array<bigint>")
    table = v.table("customer").select(k.cast("bigint").alias("k"), "c_name", refs.alias("refs"))
    found = references.dereference_recursive(table.select(F.col("k").alias("root"), F.col("k").alias("id")), table, "k", "refs", {"name": "c_name"})
    return found.withColumn("path", F.array_join(F.col("path").cast("array<string>"), ","))


@query(
    "map_reduce_finalize",
    f"""SELECT key, key || ':' || COUNT(*) AS value FROM ({WORDS_SQL}
  WHERE doc_id IN (SELECT doc_id FROM documents WHERE lang <> 'de' ORDER BY n_chars DESC, doc_id LIMIT 300)) GROUP BY key""",
)
def _(v: Views) -> DataFrame:
    """User code over the 300 longest documents that are not German."""

    def emit(docs: pd.DataFrame) -> pd.DataFrame:
        words = docs["text"].fillna("").str.split(" ").explode()
        return pd.DataFrame({"key": words[words != ""], "value": 1})

    return find.map_reduce_python(
        v.table("documents").select("doc_id", "lang", "n_chars", "text"),
        emit,
        lambda key, values: int(values.sum()),
        T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.LongType())]),
        condition=F.col("lang") != "de",
        order=[("n_chars", False), ("doc_id", True)],
        limit=300,
        finalize=lambda done: done["key"] + ":" + done["value"].astype(str),
        result="string",
    )


@query(
    "update_many",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
  ROUND(CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 10 ELSE o_totalprice END, 2) AS o_totalprice FROM orders""",
)
def _(v: Views) -> DataFrame:
    orders = v.table("orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    changes = {"o_orderstatus": F.lit("X"), "o_totalprice": F.col("o_totalprice") + 10}
    return modify.update_many(orders, F.col("o_orderstatus") == "F", changes).withColumn(
        "o_totalprice", F.round("o_totalprice", 2)
    )


@query("delete_many", "SELECT o_orderkey, o_totalprice FROM orders WHERE NOT o_totalprice < 100000")
def _(v: Views) -> DataFrame:
    return modify.delete_many(v.table("orders").select("o_orderkey", "o_totalprice"), F.col("o_totalprice") < 100000)


def _settings(v: Views) -> DataFrame:
    """The last set operation of every order key."""
    sets = v.ops.where(F.col("op") == "set").select("seq", "o_orderkey", F.col("amount").alias("o_totalprice"))
    return modify.last_per_key(sets, "o_orderkey", "seq")


LAST_SET = "last_set AS (SELECT o_orderkey, MAX_BY(amount, seq) AS amount FROM ops WHERE op = 'set' GROUP BY 1)"


def _with_last_set(body: str) -> str:
    return with_views("@", "ops").replace("\n@", f",\n{LAST_SET}\n{body}")


@query(
    "replace_by_key",
    _with_last_set(
        """SELECT o.o_orderkey, COALESCE(amount, o_totalprice) AS o_totalprice,
  CASE WHEN l.o_orderkey IS NULL THEN o_orderstatus END AS o_orderstatus
FROM orders o LEFT JOIN last_set l USING (o_orderkey)"""
    ),
)
def _(v: Views) -> DataFrame:
    orders = v.table("orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    # a replacement is a whole row: its status is NULL
    replacements = _settings(v).withColumn("o_orderstatus", F.lit(None).cast("string"))
    return modify.replace_by_key(orders, replacements, "o_orderkey")


@query(
    "upsert_merge",
    _with_last_set(
        """SELECT o_orderkey, COALESCE(amount, o_totalprice) AS o_totalprice, o_orderstatus
FROM orders FULL JOIN last_set USING (o_orderkey)"""
    ),
)
def _(v: Views) -> DataFrame:
    return modify.upsert(v.table("orders").select("o_orderkey", "o_totalprice", "o_orderstatus"), _settings(v), "o_orderkey")


@query(
    "upsert_counts",
    _with_last_set(
        """SELECT COUNT(o.o_orderkey) AS matched, COUNT(*) FILTER (amount <> o_totalprice) AS modified,
  COUNT(*) FILTER (o.o_orderkey IS NULL) AS upserted
FROM last_set l LEFT JOIN orders o USING (o_orderkey)"""
    ),
)
def _(v: Views) -> DataFrame:
    return modify.upsert_counts(v.table("orders"), _settings(v), "o_orderkey")


def _bulk_sql(order: str, result: str) -> str:
    """Operations applied one after the other per key by recursion."""
    body = f""",
queue AS (SELECT seq, o_orderkey, op, CAST(amount AS DECIMAL(38,9)) AS amount, ROW_NUMBER() OVER (PARTITION BY o_orderkey ORDER BY {order}) AS i FROM ops),
run AS (
  SELECT k.o_orderkey, CAST(0 AS BIGINT) AS i, o.o_orderkey IS NOT NULL AS present, CAST(o_totalprice AS DECIMAL(38,9)) AS price,
    CAST(NULL AS VARCHAR) AS did, FALSE AS changed, o_orderstatus AS status
  FROM (SELECT o_orderkey FROM orders UNION SELECT o_orderkey FROM ops) k LEFT JOIN orders o USING (o_orderkey)
  UNION ALL
  SELECT r.o_orderkey, q.i,
    CASE WHEN op = 'delete' THEN FALSE WHEN op IN ('insert', 'upsert') THEN TRUE ELSE present END,
    CASE WHEN op = 'delete' THEN NULL WHEN op = 'upsert' THEN amount WHEN op = 'insert' AND NOT present THEN amount
         WHEN op = 'set' AND present THEN amount WHEN op = 'inc' AND present THEN CAST(price + amount AS DECIMAL(38,9)) ELSE price END,
    CASE WHEN op = 'insert' THEN CASE WHEN present THEN 'rejected' ELSE 'inserted' END
         WHEN op = 'delete' THEN CASE WHEN present THEN 'removed' END
         WHEN present THEN 'matched' WHEN op = 'upsert' THEN 'upserted' END,
    COALESCE(present AND op IN ('set', 'upsert', 'inc')
      AND CASE WHEN op = 'inc' THEN amount <> 0 ELSE amount <> price END, FALSE),
    CASE WHEN op = 'delete' THEN NULL ELSE status END
  FROM run r JOIN queue q ON q.o_orderkey = r.o_orderkey AND q.i = r.i + 1
)
{result}"""
    return with_views("@", "ops", recursive=True).replace("\n@", body)


FINAL_ROWS = """SELECT o_orderkey, ROUND(CAST(s.b AS DOUBLE), 2) AS o_totalprice, s.c AS o_orderstatus
FROM (SELECT o_orderkey, ARG_MAX(struct_pack(a := present, b := price, c := status), i) AS s FROM run GROUP BY 1) m
WHERE s.a"""
COUNT_ROW = "SELECT " + ", ".join(
    f"COUNT(*) FILTER ({'changed' if c == 'modified' else f'did = {c!r}'}) AS {c}" for c in modify.COUNTS
) + " FROM run"
UNORDERED = "CASE op WHEN 'insert' THEN 0 WHEN 'delete' THEN 2 ELSE 1 END, seq"


def _orders(v: Views) -> DataFrame:
    return v.table("orders").select("o_orderkey", "o_totalprice", "o_orderstatus")


def _cents(df: DataFrame) -> DataFrame:
    return df.withColumn("o_totalprice", F.round("o_totalprice", 2))


@query("bulk_ordered", _bulk_sql("seq", FINAL_ROWS))
def _(v: Views) -> DataFrame:
    return _cents(modify.bulk_write(_orders(v), v.ops, "o_orderkey", "o_totalprice"))


@query("bulk_unordered", _bulk_sql(UNORDERED, FINAL_ROWS))
def _(v: Views) -> DataFrame:
    return _cents(modify.bulk_write(_orders(v), v.ops, "o_orderkey", "o_totalprice", ordered=False))


@query("bulk_counts", _bulk_sql("seq", COUNT_ROW))
def _(v: Views) -> DataFrame:
    return modify.bulk_counts(_orders(v), v.ops, "o_orderkey", "o_totalprice")


@query("bulk_counts_unordered", _bulk_sql(UNORDERED, COUNT_ROW))
def _(v: Views) -> DataFrame:
    return modify.bulk_counts(_orders(v), v.ops, "o_orderkey", "o_totalprice", ordered=False)


def _orders_with_null(v: Views) -> DataFrame:
    """Orders, of which the first has a NULL key."""
    first = F.when(F.col("o_orderkey") != 1, F.col("o_orderkey"))
    return _orders(v).withColumn("o_orderkey", first)


# every 50th operation goes to the NULL key; an operation gives the price, the status or both
WHOLE_ROWS = with_views("@", "ops", "ev", recursive=True).replace(
    "\n@",
    """,
base AS (SELECT NULLIF(o_orderkey, 1) AS o_orderkey, o_totalprice, o_orderstatus FROM orders),
given AS (SELECT seq, CASE WHEN seq % 50 <> 0 THEN o_orderkey END AS o_orderkey, op, amount, seq % 3 <> 1 AS has_price,
  UPPER(event_type[1]) AS status, seq % 3 <> 2 AS has_status FROM ops JOIN ev ON event_id = seq),
queue AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_orderkey ORDER BY seq) AS i FROM given),
run AS (
  SELECT k.o_orderkey, CAST(0 AS BIGINT) AS i, b.o_orderstatus IS NOT NULL AS present, CAST(o_totalprice AS DECIMAL(38,9)) AS price, o_orderstatus AS status
  FROM (SELECT o_orderkey FROM base UNION SELECT o_orderkey FROM given) k LEFT JOIN base b ON b.o_orderkey IS NOT DISTINCT FROM k.o_orderkey
  UNION ALL
  SELECT r.o_orderkey, q.i,
    CASE WHEN op = 'delete' THEN FALSE WHEN op IN ('insert', 'upsert') THEN TRUE ELSE present END,
    CASE WHEN op = 'delete' THEN NULL
         WHEN NOT present THEN CASE WHEN op IN ('insert', 'upsert') AND has_price THEN CAST(amount AS DECIMAL(38,9)) END
         WHEN has_price AND op IN ('set', 'upsert') THEN CAST(amount AS DECIMAL(38,9))
         WHEN has_price AND op = 'inc' THEN CAST(price + CAST(amount AS DECIMAL(38,9)) AS DECIMAL(38,9)) ELSE price END,
    CASE WHEN op = 'delete' THEN NULL
         WHEN NOT present THEN CASE WHEN op IN ('insert', 'upsert') AND has_status THEN q.status END
         WHEN has_status AND op IN ('set', 'upsert') THEN q.status ELSE r.status END
  FROM run r JOIN queue q ON q.o_orderkey IS NOT DISTINCT FROM r.o_orderkey AND q.i = r.i + 1
)
SELECT o_orderkey, ROUND(CAST(s.b AS DOUBLE), 2) AS o_totalprice, s.c AS o_orderstatus
FROM (SELECT o_orderkey, ARG_MAX(struct_pack(a := present, b := price, c := status), i) AS s FROM run GROUP BY 1) m WHERE s.a""",
)


@query("bulk_whole_rows", WHOLE_ROWS)
def _(v: Views) -> DataFrame:
    seq, status = F.col("seq"), F.upper(F.substring("event_type", 1, 1))
    ops = v.ops.join(v.events.select(F.col("event_id").alias("seq"), "event_type"), "seq").select(
        "seq",
        F.when(seq % 50 != 0, F.col("o_orderkey")).alias("o_orderkey"),
        "op",
        F.col("amount").alias("o_totalprice"),
        status.alias("o_orderstatus"),
        F.array_compact(F.array(F.when(seq % 3 != 1, F.lit("o_totalprice")), F.when(seq % 3 != 2, F.lit("o_orderstatus")))).alias("given"),
    )
    return _cents(modify.bulk_rows(_orders_with_null(v), ops, "o_orderkey", ["o_totalprice", "o_orderstatus"], "given"))


@query(
    "replace_upsert",
    _with_last_set(
        """SELECT CASE WHEN l.seen THEN l.o_orderkey ELSE o.o_orderkey END AS o_orderkey,
  CASE WHEN l.seen THEN amount ELSE o_totalprice END AS o_totalprice, CASE WHEN l.seen THEN 'N' ELSE o_orderstatus END AS o_orderstatus
FROM (SELECT NULLIF(o_orderkey, 1) AS o_orderkey, o_totalprice, o_orderstatus FROM orders) o
FULL JOIN (SELECT NULLIF(o_orderkey, 240) AS o_orderkey, amount, TRUE AS seen FROM last_set) l
  ON o.o_orderkey IS NOT DISTINCT FROM l.o_orderkey"""
    ),
)
def _(v: Views) -> DataFrame:
    """Whole rows, of which one has a NULL key, replace orders and are new ones where there is none."""
    key = F.when(F.col("o_orderkey") != 240, F.col("o_orderkey"))
    rows = _settings(v).withColumn("o_orderkey", key).withColumn("o_orderstatus", F.lit("N"))
    return modify.replace_by_key(_orders_with_null(v), rows, "o_orderkey", upsert=True)


def feed(v: Views) -> DataFrame:
    """Changes of orders after the last set of every key and the removal of cheap rows."""
    before = _orders(v)
    after = modify.delete_many(modify.upsert(before, _settings(v), "o_orderkey"), F.col("o_totalprice") < 20)
    return modify.change_feed(before, after, "o_orderkey")


def feed_text(changes: DataFrame) -> DataFrame:
    return changes.select(
        "o_orderkey",
        "op",
        F.array_join("updated", ",").alias("updated"),
        F.col("before.o_totalprice").alias("old_price"),
        F.col("after.o_totalprice").alias("new_price"),
        F.col("after.o_orderstatus").alias("new_status"),
    )


FEED_SQL = _with_last_set(
    """SELECT o_orderkey, op, CASE WHEN op = 'update' THEN 'o_totalprice' END AS updated, old_price,
  CASE WHEN op <> 'delete' THEN new_price END AS new_price, CASE WHEN op <> 'delete' THEN o_orderstatus END AS new_status
FROM (
  SELECT o_orderkey, o_totalprice AS old_price, o_orderstatus, COALESCE(amount, o_totalprice) AS new_price,
    CASE WHEN o.o_orderstatus IS NULL THEN CASE WHEN amount >= 20 THEN 'insert' END
         WHEN COALESCE(amount, o_totalprice) < 20 THEN 'delete'
         WHEN amount <> o_totalprice THEN 'update' END AS op
  FROM orders o FULL JOIN last_set l USING (o_orderkey))
WHERE op IS NOT NULL"""
)


@query("change_feed", FEED_SQL)
def _(v: Views) -> DataFrame:
    return feed_text(feed(v))


@query("change_feed_filtered", f"SELECT o_orderkey, old_price FROM ({FEED_SQL}) WHERE op = 'delete'")
def _(v: Views) -> DataFrame:
    return feed(v).where(F.col("op") == "delete").select("o_orderkey", F.col("before.o_totalprice").alias("old_price"))
