"""Reads: ranges, order, pages, collation, references, blobs, revisions."""

import random
from datetime import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bannerloom.operators import find, references
from bannerloom.sources import blobs, tables


@pytest.fixture(scope="module")
def grid(spark):
    return spark.createDataFrame([(a, b) for a in range(5) for b in [None, 0, 1, 2]], "a int, b int")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_key_range(grid):
    got = rows(find.key_range(grid, ["a", "b"], (1, 1), (3, 1)))
    assert got == [(1, 1), (1, 2), (2, 0), (2, 1), (2, 2), (2, None), (3, 0), (3, None)]
    assert find.key_range(grid, ["a", "b"], upper=(0, 0)).collect() == [(0, None)]


def test_key_range_reaches_the_scan(spark, grid, folder):
    grid.write.parquet(f"{folder}/g")
    plan = find.key_range(spark.read.parquet(f"{folder}/g"), ["a", "b"], (1, 1), (3, 1))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(a,1)" in text and "LessThanOrEqual(a,3)" in text


def test_order_and_pages(grid):
    order = [("b", True), ("a", False)]
    ordered = [tuple(r) for r in find.sort_rows(grid, order).collect()]
    assert ordered[0] == (4, None)  # nulls first
    assert [tuple(r) for r in find.page(grid, order, 3, 4).collect()] == ordered[3:7]
    assert [tuple(r) for r in find.page(grid, order, 3).collect()] == ordered[3:]
    assert [tuple(r) for r in find.page(grid, order).collect()] == ordered
    assert find.sort_rows(grid, [("b", False), ("a", True)]).collect()[-1] == (4, None)  # nulls last
    for bad in (lambda: find.page(grid, order, -1), lambda: find.page(grid, order, 0, -2), lambda: find.sort_rows(grid, [])):
        with pytest.raises(ValueError):
            bad()


def test_counts(grid):
    counts = [find.count_page(grid, s, n).first().n for s, n in ((0, 0), (5, 0), (5, 10), (15, 10), (50, 10))]
    assert counts == [20, 15, 10, 5, 0]


def test_find_one(grid):
    assert find.find_one(grid, F.col("a") > 2, [("a", True), ("b", False)]).collect() == [(3, 2)]
    assert find.find_one(grid, F.col("a") > 9, [("a", True)]).collect() == []


def test_projection(spark):
    df = spark.sql("SELECT 1 AS x, named_struct('p', 2, 'q', 3) AS s, 4 AS y")
    assert find.project(df, include=["s.p", "y"]).columns == ["s", "y"]
    assert find.project(df, exclude=["x", "s.q"]).first().asDict(True) == {"s": {"p": 2}, "y": 4}
    with pytest.raises(ValueError):
        find.project(df, ["x"], ["y"])


def test_python_predicate(grid):
    def even(a: pd.Series) -> pd.Series:
        return a % 2 == 0

    assert find.where_python(grid, even, "a").count() == 12


def test_collation(spark):
    df = spark.createDataFrame([(w,) for w in ["resume", "Resume", "résumé", "RÉSUMÉ", "other"]], "w string")

    def equal(strength):
        return df.where(find.collated(F.col("w"), strength) == find.collated(F.lit("resume"), strength)).count()

    assert [equal(s) for s in (1, 2, 3)] == [4, 2, 1]


def test_numeric_order(spark):
    names = ["a2", "a10", "a1b20", "a1b3", "b", "a100000000000000000000000000", "a99"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r.n for r in df.orderBy(find.numeric_key(F.col("n"))).collect()]
    assert got == ["a1b3", "a1b20", "a2", "a10", "a99", "a100000000000000000000000000", "b"]


def test_object_id_times(spark):
    df = spark.createDataFrame([("659ed280" + "0" * 16,), ("65abb880" + "f" * 16,)], "oid string")
    got = [r[0] for r in df.select(find.oid_time(F.col("oid"))).collect()]
    assert [t.strftime("%Y-%m-%d") for t in got] == ["2024-01-10", "2024-01-20"]
    assert find.oid_between(df, "oid", 0x659ED280, 0x65ABB880).count() == 1


def test_retention(spark):
    df = spark.createDataFrame([(datetime(2024, 1, d),) for d in range(1, 11)], "ts timestamp_ntz")
    kept = find.retain(df, "ts", F.lit(datetime(2024, 1, 10)).cast("timestamp_ntz"), 3 * 86400)
    assert kept.count() == 4


def test_update_elements(spark):
    df = spark.createDataFrame([([1, 5, 9],)], "xs array<int>")
    changed = find.update_elements(F.col("xs"), lambda x: x > 4, lambda x: x * 10)
    assert df.select(changed).first()[0] == [1, 50, 90]


def test_distinct_values(spark):
    df = spark.createDataFrame([(1, [1, 2]), (2, [2, 3])], "a int, xs array<int>")
    assert rows(find.distinct_values(df, "xs")) == [(1,), (2,), (3,)]
    assert rows(find.distinct_values(df, "a", F.col("a") > 1)) == [(2,)]


REF = "i int, ref struct<collection: string, id: long, database: string>"


def test_references(spark):
    users = spark.createDataFrame([(1, "ann")], "id long, name string")
    refs = spark.createDataFrame(
        [(1, ("users", 1, "main")), (2, ("users", 5, None)), (3, ("gone", 1, "main")), (4, None)], REF
    )
    got = references.dereference(refs, {"users": (users, "id")}, {"name": "name"})
    assert rows(got.select("i", "name")) == [(1, "ann"), (2, None), (3, None), (4, None)]
    foreign = spark.createDataFrame([(1, ("users", 1, "elsewhere"))], REF)
    with pytest.raises(Exception, match="another database"):
        references.dereference(foreign, {"users": (users, "id")}, {"name": "name"}).collect()


def test_nested_references(spark):
    users = spark.createDataFrame([(1, "ann"), (2, "bob")], "id long, name string")
    docs = spark.createDataFrame([(1, [2, 9, 1, 2]), (2, []), (3, None)], "d int, ids array<long>")
    got = references.dereference_array(docs, "d", "ids", users, "id", "name", "names")
    assert {r.d: r.names for r in got.collect()} == {1: ["bob", None, "ann", "bob"], 2: [], 3: []}


# --- blobs


CONTENT = {1: "", 2: "abc", 3: "é" * 10, 4: "0123456789", 5: "x" * 30}


@pytest.fixture(scope="module")
def stored(spark):
    df = spark.createDataFrame(list(CONTENT.items()), "file_id long, content string")
    return blobs.describe(df, 7).cache(), blobs.split(df, 7).cache()


def test_chunks(stored):
    files, chunks = stored
    sizes = {}
    for r in chunks.orderBy("file_id", "n").collect():
        sizes.setdefault(r.file_id, []).append(len(r.data))
    assert sizes == {2: [3], 3: [7, 7, 6], 4: [7, 3], 5: [7, 7, 7, 7, 2]}


def test_round_trip(stored):
    got = {r.file_id: (r.status, bytes(r.content).decode()) for r in blobs.contents(*stored).collect()}
    assert got == {k: ("ok", v) for k, v in CONTENT.items()}


def test_large_contents_stay_chunks(stored):
    files, chunks = blobs.assemble(*stored)
    assert {r.status for r in files.collect()} == {"ok"}
    text = b"".join(bytes(r.data) for r in chunks.where("file_id = 5").collect())
    assert text.decode() == CONTENT[5]


def test_a_content_no_cell_can_hold_is_an_error(stored, monkeypatch):
    monkeypatch.setattr(blobs, "MAX_CELL", 25)
    with pytest.raises(Exception, match="too large for a cell"):
        blobs.contents(*stored).collect()


def test_corrupt_content(stored):
    files, chunks = stored
    other = chunks.withColumn("data", F.expr("if(n = 1 and file_id = 5, cast('ABCDEFG' as binary), data)"))
    got = {r.file_id: (r.status, r.content) for r in blobs.contents(files, other).collect()}
    assert got[5] == ("corrupt", None) and got[4][0] == "ok"


@pytest.mark.parametrize(
    "change, status",
    [
        (lambda c: c.where("n <> 1"), "missing"),
        (lambda c: c.withColumn("data", F.expr("if(n = 0, substring(data, 1, 4), data)")), "truncated"),
        (lambda c: c.withColumn("n", F.expr("n")).unionByName(c.where("n = 0").withColumn("n", F.lit(50))), "extra"),
        (
            lambda c: c.unionByName(c.where("n = 0").withColumn("n", F.lit(50)).withColumn("data", F.lit(b""))),
            "ok",
        ),
        (lambda c: c.where("n <> 1").unionByName(c.where("n = 0")), "missing"),
        (lambda c: c.unionByName(c.where("n = 0")), "repeated"),
        (lambda c: c.withColumn("data", F.expr("if(n = 0, concat(data, cast('x' as binary)), data)")), "overlong"),
        (lambda c: c.unionByName(c.where("n = 0").withColumn("n", F.lit(-1))), "extra"),
    ],
)
def test_damage(stored, change, status):
    files, chunks = stored
    got = {r.file_id: r.status for r in blobs.assemble(files, change(chunks))[0].collect()}
    assert got[5] == status and got[1] == "ok"


def test_revisions(spark):
    files = spark.createDataFrame(
        [(i, f"f{i % 2}" if i < 9 else None, datetime(2024, 1, 1 + i // 3)) for i in range(10)],
        "file_id long, filename string, upload_date timestamp_ntz",
    )
    got = {n: sorted(r.file_id for r in tables.nth_revision(files, n).where("filename = 'f0'").collect()) for n in (0, 1, -1, -2, 9)}
    assert got == {0: [0], 1: [2], -1: [8], -2: [6], 9: []}
    assert rows(tables.list_names(files)) == [("f0",), ("f1",)]


def test_null_keys_and_times(spark):
    df = spark.createDataFrame([(None,), (1,), (5,)], "k int")
    assert rows(find.key_range(df, ["k"], upper=[5])) == [(1,), (None,)]
    assert rows(find.key_range(df, ["k"], lower=[None])) == [(1,), (5,), (None,)]
    assert rows(find.key_range(df, ["k"], lower=[1])) == [(1,), (5,)]
    existing = spark.createDataFrame([(None, "a")], "k int, v string")
    batch = spark.createDataFrame([(None, 1), (3, 2), (None, 3)], "k int, seq int")
    accepted, rejected = tables.insert_unique(existing, batch, ["k"], "seq")
    assert rows(accepted.select("k", "seq")) == [(3, 2)] and rejected.count() == 2
    old = spark.sql("SELECT timestamp'2024-01-01 00:00:00' AS ts UNION ALL SELECT NULL")
    assert rows(find.retain(old, "ts", F.lit("2024-02-01").cast("timestamp"), 60)) == [(None,)]


def test_numbers_of_any_length_order_by_value(spark):
    texts = ["a2", "a" + "9" * 41, "a10", "a" + "1" * 60, "a002", "b", "a", "", "1x2", "1x10"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("k", find.numeric_key(F.col("t")))
    got = [r.t for r in df.orderBy("k", "t").collect()]
    assert got.index("a2") < got.index("a10") < got.index("a" + "9" * 41) < got.index("a" + "1" * 60)
    assert got.index("1x2") < got.index("1x10") and got[0] == "" and got[-1] == "b"
    assert len({r.k for r in df.where("t in ('a2', 'a002')").collect()}) == 1


def test_nested_include_keeps_the_struct(spark):
    df = spark.sql("SELECT 1 AS id, named_struct('x', 2, 'y', 3) AS s UNION ALL SELECT 2, NULL")
    got = find.project(df, include=["id", "s.x"])
    assert got.schema.simpleString() == "struct<id:int,s:struct<x:int>>"
    assert sorted((r.id, r.s and r.s.x) for r in got.collect()) == [(1, 2), (2, None)]


@pytest.mark.parametrize("skip, limit", [(0, 5), (700, 40), (1500, 10), (2990, 50), (4000, 5), (1499, 1)])
def test_deep_page(spark, skip, limit):
    r = random.Random(3)
    rows = [(i, r.choice([None, 1, 2, 2, 2, r.randrange(50)]), r.choice("abc")) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, a int, s string").repartition(5)
    order = [("a", False), ("s", True), ("id", True)]
    want = sorted(rows, key=lambda x: (x[1] is None, -(x[1] or 0), x[2], x[0]))[skip : skip + limit]
    assert [tuple(x) for x in find.page(df, order, skip, limit, in_one_task=100).collect()] == want


def test_deep_page_sorts_only_a_part(spark):
    df = spark.range(200_000).withColumn("h", F.xxhash64("id"))
    order = [("h", True), ("id", True)]
    part, before = find.narrowed(df, order, 150_000, 20, 3_000)
    assert before <= 150_000 and part.count() <= 3_020 and before + part.count() >= 150_020
    plan = find.page(df, order, 150_000, 20, in_one_task=3_000)._jdf.queryExecution().optimizedPlan().toString()
    assert "150000" not in plan and "150020" not in plan  # no task takes the skipped rows


def test_deep_page_of_equal_rows(spark):
    df = spark.createDataFrame([(1,)] * 500, "a int")
    assert find.page(df, [("a", True)], 300, 250, in_one_task=10).count() == 200


def test_collated_order(spark):
    words = ["zebra", "Äpfel", "apfel", "ähre", "Zoo", "o z", "öz", "Oz", "oz", None, "a-b", "ab", "ac"]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, w string")
    order = lambda **how: [r.w for r in find.collated_sort(df, "w", [("i", True)], **how).collect()]
    assert order(locale="sv")[-3:] == ["ähre", "Äpfel", "öz"]  # behind z in Swedish
    assert order(locale="de")[-2:] == ["zebra", "Zoo"]
    assert order(locale="de").index("Äpfel") < order(locale="de").index("oz")
    assert order(locale="de").index("oz") < order(locale="de").index("Oz")
    assert order(locale="de", upper_first=True).index("Oz") < order(locale="de", upper_first=True).index("oz")
    shifted = order(locale="de", shifted=True)
    assert shifted.index("a-b") + 1 == shifted.index("ab") and shifted[0] is None
    placed = find.collated_sort(df, "w", [("i", True)], "at", locale="sv").orderBy("at").collect()
    assert [r.w for r in placed] == order(locale="sv") and placed[0].at == 1
    assert df.where(find.collated(F.col("w"), 1, "de") == "OZ").count() == 3


def test_recursive_references(spark):
    table = spark.createDataFrame([(1, "a", [2, 3]), (2, "b", [3]), (3, "c", [1, 9, None]), (4, "d", []), (5, "e", None), (6, "f", [6])], "k long, name string, refs array<long>")
    starts = spark.createDataFrame([("x", 1), ("y", 4), ("z", 5), ("w", 6), ("v", 99)], "root string, id long")
    got = references.dereference_recursive(starts, table, "k", "refs", {"label": "upper(name)"})
    assert got.columns == ["root", "depth", "path", "id", "found", "cycle", "label"]

    def expand(root, key, path):
        names, links = ({1: "A", 2: "B", 3: "C", 4: "D", 5: "E", 6: "F"}, {1: [2, 3], 2: [3], 3: [1, 9, None], 6: [6]})
        here = [*path, key]
        yield (root, len(here), here, key, key in names, key in path, names.get(key))
        if key not in path:
            for n in links.get(key, []):
                yield from expand(root, n, here)

    want = [x for root, key in [("x", 1), ("y", 4), ("z", 5), ("w", 6), ("v", 99)] for x in expand(root, key, [])]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert references.dereference_recursive(starts, table, "k", "refs", {"label": "name"}, max_depth=2).agg(F.max("depth")).first()[0] == 2


def test_recursive_references_do_not_gather_the_table(spark, monkeypatch):
    plans, write = [], references.write_out
    monkeypatch.setattr(references, "write_out", lambda df, path: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df, path))
    table = spark.createDataFrame([(1, "a", [2]), (2, "b", [3]), (3, "c", [])], "k long, name string, refs array<long>")
    got = references.dereference_recursive(table.selectExpr("k AS root", "k AS id"), table, "k", "refs", {"label": "name"})
    assert sorted((r.root, r.id, r.label) for r in got.collect()) == [(1, 1, "a"), (1, 2, "b"), (1, 3, "c"), (2, 2, "b"), (2, 3, "c"), (3, 3, "c")]
    assert len(plans) == 3 and not any("BroadcastExchange" in p for p in plans)


@pytest.mark.parametrize("rows_a_call", [10_000, 7])
def test_map_reduce_with_user_code(spark, monkeypatch, rows_a_call):
    monkeypatch.setattr(find, "REDUCED_ROWS", rows_a_call)
    monkeypatch.setattr(find, "REDUCED_KEYS", 20)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 50)
    try:
        df = spark.range(2000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("key")).repartition(6)
        schema = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.LongType())])
        got = find.map_reduce_python(
            df, lambda b: pd.DataFrame({"key": b["key"], "value": b["id"]}), lambda key, values: int(values.max()), schema,
            condition=F.col("id") >= 10, order=[("id", False)], limit=1500, finalize=lambda d: d["key"] + "/" + d["value"].astype(str), result="string",
        )
        want = {}
        for i in range(1999, 499, -1):
            k = "hot" if i % 3 == 0 else f"k{i % 40}"
            want[k] = max(want.get(k, 0), i)
        assert {r.key: r.value for r in got.collect()} == {k: f"{k}/{v}" for k, v in want.items()}
        none = find.map_reduce_python(df.limit(0), lambda b: pd.DataFrame({"key": b["key"], "value": b["id"]}), lambda key, values: int(values.max()), schema)
        assert none.collect() == []
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
