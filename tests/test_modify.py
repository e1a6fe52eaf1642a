"""Bulk writes against a plain loop; upserts, replacements, change feeds."""

import random

import pytest
from pyspark.sql import functions as F

from bannerloom.operators import find, modify, skew
from bannerloom.sources import tables

OPS = "seq long, k long, op string, amount double"


def run_loop(base, ops):
    """The documented meaning of the operations, one after the other."""
    rows, counts = dict(base), dict.fromkeys(modify.COUNTS, 0)
    for _, k, op, amount in ops:
        there = k in rows
        if op == "insert":
            counts["rejected" if there else "inserted"] += 1
            rows.setdefault(k, amount)
        elif op == "delete":
            counts["removed"] += there
            rows.pop(k, None)
        elif there or op == "upsert":
            new = rows[k] + amount if op == "inc" and there else amount
            counts["matched" if there else "upserted"] += 1
            counts["modified"] += there and rows[k] != new
            rows[k] = new
    return rows, counts


def random_ops(seed, n, keys):
    rnd = random.Random(seed)
    kinds = ["insert", "upsert", "set", "inc", "delete"]
    # one key has a third of all operations; small whole amounts make equal values common
    return [
        (i, 0 if rnd.random() < 0.33 else rnd.randrange(keys), rnd.choice(kinds), float(rnd.randrange(3)))
        for i in range(n)
    ]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("ordered", [True, False])
def test_bulk(spark, seed, ordered, monkeypatch):
    if seed % 2:
        monkeypatch.setattr(skew, "FOLD_ROWS", 10)  # fold in ranges
    ops = random_ops(seed, 600, 40)
    base = {k: float(k % 3) for k in range(0, 40, 2)}
    order = ops if ordered else sorted(ops, key=lambda o: (modify.UNORDERED_RANK[o[2]], o[0]))
    rows, counts = run_loop(base, order)
    b = spark.createDataFrame([(k, v, f"n{k}") for k, v in base.items()], "k long, v double, name string")
    o = spark.createDataFrame(random.Random(seed).sample(ops, len(ops)), OPS)
    got = modify.bulk_write(b, o, "k", "v", ordered).collect()
    assert {r.k: r.v for r in got} == rows
    got_counts = modify.bulk_counts(b, o, "k", "v", ordered).first().asDict()
    assert got_counts == counts


@pytest.mark.parametrize("counted", [True, False])
@pytest.mark.parametrize("chunk", [1, 5, 1000])
def test_runs_merge_the_same_however_they_are_cut(spark, chunk, counted):
    ops = spark.createDataFrame(random_ops(9, 300, 20), OPS)
    element = modify._operation(F.col("op"), F.col("amount"), counted)
    merge = modify._merge_counted if counted else modify._merge
    whole = skew.ordered_fold(ops, ["k"], "seq", element, merge, "f", 10**6).collect()
    cut = skew.ordered_fold(ops, ["k"], "seq", element, merge, "f", chunk).collect()
    assert {r.k: r.f for r in whole} == {r.k: r.f for r in cut}


def test_a_created_row_has_nothing_of_the_deleted_one(spark):
    base = spark.createDataFrame([(1, 0.1, "OLD"), (2, 1.0, "KEPT")], "k long, v double, name string")
    ops = spark.createDataFrame([(1, 1, "delete", None), (2, 1, "insert", 5.0), (3, 2, "insert", 9.0)], OPS)
    assert rows(modify.bulk_write(base, ops, "k", "v")) == [(1, 5.0, None), (2, 1.0, "KEPT")]


def test_unordered_bulk_with_negative_numbers(spark):
    base = spark.createDataFrame([(1, 1.0)], "k long, v double")
    ops = spark.createDataFrame([(-5, 1, "delete", None), (-4, 1, "insert", 2.0)], OPS)
    assert modify.bulk_write(base, ops, "k", "v", ordered=False).count() == 0


def test_counts_add_up_exactly(spark):
    base = spark.createDataFrame([(1, 0.1)], "k long, v double")
    ops = spark.createDataFrame([(1, 1, "inc", 0.2), (2, 1, "inc", 0.3), (3, 1, "set", 0.6)], OPS)
    assert modify.bulk_counts(base, ops, "k", "v").first().modified == 2


def test_no_operations(spark):
    b = spark.createDataFrame([(1, 2.0)], "k long, v double")
    none = spark.createDataFrame([], OPS)
    assert [tuple(r) for r in modify.bulk_write(b, none, "k", "v").collect()] == [(1, 2.0)]
    assert set(modify.bulk_counts(b, none, "k", "v").first().asDict().values()) == {0}


@pytest.fixture(scope="module")
def base(spark):
    return spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (3, "c", 3.0)], "k long, s string, v double")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_upsert(spark, base):
    changes = spark.createDataFrame([(2, 5.0), (3, None), (9, 9.0)], "k long, v double")
    assert rows(modify.upsert(base, changes, "k")) == [(1, "a", 1.0), (2, "b", 5.0), (3, "c", None), (9, None, 9.0)]
    assert modify.upsert_counts(base, changes, "k").first().asDict() == {"matched": 2, "modified": 2, "upserted": 1}
    same = spark.createDataFrame([(1, 1.0), (2, None)], "k long, v double")
    assert modify.upsert_counts(base, same, "k").first().asDict() == {"matched": 2, "modified": 0, "upserted": 0}


def test_replace_takes_the_whole_row(spark, base):
    new = spark.createDataFrame([(1, None, 7.0), (8, "x", 1.0)], "k long, s string, v double")
    assert rows(modify.replace_by_key(base, new, "k")) == [(1, None, 7.0), (2, "b", None), (3, "c", 3.0)]


def test_update_and_delete_leave_unknown_rows(base):
    updated = modify.update_many(base, F.col("v") > 2, {"s": F.lit("big"), "v": F.col("v") * 2})
    assert rows(updated) == [(1, "a", 1.0), (2, "b", None), (3, "big", 6.0)]
    assert rows(modify.delete_many(base, F.col("v") > 2)) == [(1, "a", 1.0), (2, "b", None)]


def test_change_feed(spark, base):
    after = spark.createDataFrame([(2, "b", None), (3, "c", 4.0), (4, "d", 1.0)], base.schema)
    got = {r.k: (r.op, r.updated) for r in modify.change_feed(base, after, "k").collect()}
    assert got == {1: ("delete", None), 3: ("update", ["v"]), 4: ("insert", None)}
    null = spark.createDataFrame([(None, "n", 1.0)], base.schema)
    assert modify.change_feed(null, null, "k").count() == 0


def test_insert_unique(spark, base):
    batch = spark.createDataFrame(
        [(0, 1, "x"), (1, 7, "first"), (2, 7, "again"), (3, 8, "y")] + [(i, 5, "z") for i in range(10, 60)],
        "seq long, k long, s string",
    )
    accepted, rejected = tables.insert_unique(base, batch, ["k"], "seq")
    assert rows(accepted) == [(1, 7, "first"), (10, 5, "z"), (3, 8, "y")]
    assert accepted.count() + rejected.count() == batch.count()


def test_map_reduce_modes(spark):
    def counts(words):
        return spark.createDataFrame([(w,) for w in words], "w string")

    emit = F.array(F.struct(F.col("w").alias("key"), F.lit(1).cast("long").alias("value")))
    old = find.map_reduce(counts("aab"), emit, F.sum)
    assert rows(find.map_reduce(counts("bbc"), emit, F.sum, old)) == [("b", 2), ("c", 1)]
    assert rows(find.map_reduce(counts("bbc"), emit, F.sum, old, "merge")) == [("a", 2), ("b", 2), ("c", 1)]
    assert rows(find.map_reduce(counts("bbc"), emit, F.sum, old, "reduce")) == [("a", 2), ("b", 3), ("c", 1)]
    with pytest.raises(ValueError):
        find.map_reduce(counts("b"), emit, F.sum, old, "other")


def test_null_is_a_key(spark):
    base = spark.createDataFrame([(None, "a", 1.0), (1, "b", 2.0)], "k long, s string, v double")
    change = spark.createDataFrame([(None, 9.0)], "k long, v double")
    assert rows(modify.upsert(base, change, "k")) == [(1, "b", 2.0), (None, "a", 9.0)]
    assert modify.upsert_counts(base, change, "k").first().asDict() == {"matched": 1, "modified": 1, "upserted": 0}
    new = spark.createDataFrame([(None, None, 5.0), (7, "x", None)], "k long, s string, v double")
    assert rows(modify.replace_by_key(base, new, "k")) == [(1, "b", 2.0), (None, None, 5.0)]
    assert rows(modify.replace_by_key(base, new, "k", upsert=True)) == [(1, "b", 2.0), (7, "x", None), (None, None, 5.0)]
    assert modify.replace_counts(base, new, "k", upsert=True).first().asDict() == {"matched": 1, "modified": 1, "upserted": 1}
    assert modify.replace_counts(base, base, "k").first().asDict() == {"matched": 2, "modified": 0, "upserted": 0}
    ops = spark.createDataFrame([(1, None, "inc", 2.0), (2, 8, "insert", 1.0), (3, None, "set", 3.0)], OPS)
    assert rows(modify.bulk_write(base, ops, "k", "v")) == [(1, "b", 2.0), (8, None, 1.0), (None, "a", 3.0)]
    assert modify.bulk_counts(base, ops, "k", "v").first().asDict() == {
        "inserted": 1, "matched": 2, "modified": 1, "upserted": 0, "removed": 0, "rejected": 0}


@pytest.mark.parametrize("chunk", [2, 10**6])
def test_small_and_large_numbers_keep_their_digits(spark, chunk, monkeypatch):
    monkeypatch.setattr(skew, "FOLD_ROWS", chunk)
    base = spark.createDataFrame([(1, 0.0), (2, 1e30), (3, 0.0), (4, 1.0), (5, 1e308)], "k long, v double")
    ops = [(1, 1, "inc", 1e-9), (2, 1, "inc", 1e-9), (3, 2, "inc", 1e-9), (4, 2, "inc", -1e30), (5, 3, "set", 1e-10), (6, 4, "inc", 1e30),
           (7, 4, "inc", 1e-10), (8, 4, "inc", -1e30), (9, 5, "inc", 1e308), (10, 5, "inc", 1.0), (11, 6, "insert", 1e30)]
    made = spark.createDataFrame(ops, OPS)
    got = dict(rows(modify.bulk_write(base, made, "k", "v")))
    assert got == {1: 2e-9, 2: 1e-9, 3: 1e-10, 4: 1.0000000001, 5: float("inf"), 6: 1e30}
    assert modify.bulk_counts(base, made, "k", "v").first().asDict() == {
        "inserted": 1, "matched": 10, "modified": 10, "upserted": 0, "removed": 0, "rejected": 0}


def test_whole_numbers_and_decimals_stay_exact(spark):
    big = 9_007_199_254_740_993
    base = spark.sql(f"SELECT 1L AS k, {big}L AS n, CAST('12345678901234567890.12' AS DECIMAL(30,2)) AS d")
    ops = spark.sql("SELECT 1L AS seq, 1L AS k, 'inc' AS op, 2L AS n, CAST('0.01' AS DECIMAL(30,2)) AS d")
    r = modify.bulk_rows(base, ops, "k", ["n", "d"]).first()
    assert r.n == big + 2 and str(r.d) == "12345678901234567890.13"


def run_rows(base, ops, fields):
    """Whole-row operations one after the other; (seq, key, op, values, touched)."""
    table = {k: dict(r) for k, r in base.items()}
    for _, k, op, values, touched in ops:
        given = {c: values[c] for c in fields if c in touched}
        if op == "delete":
            table.pop(k, None)
        elif k not in table:
            if op in ("insert", "upsert"):
                table[k] = {**dict.fromkeys(fields), "kept": None, **given}
        elif op in ("set", "upsert"):
            table[k].update(given)
        elif op == "inc":
            for c, x in given.items():
                if c != "s":
                    table[k][c] = None if table[k][c] is None or x is None else table[k][c] + x
    return table


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("ordered", [True, False])
def test_bulk_of_whole_rows(spark, seed, ordered, monkeypatch):
    if seed:
        monkeypatch.setattr(skew, "FOLD_ROWS", 10)
    r, fields = random.Random(seed), ["s", "v", "n"]
    some = lambda: {"s": r.choice(["a", "b", None]), "v": r.choice([0.0, 1.0, None]), "n": r.randrange(3)}
    base = {k: {**some(), "kept": f"k{k}"} for k in [None, *range(0, 20, 2)]}
    ops = [(i, 0 if r.random() < 0.3 else r.choice([None, *range(20)]), r.choice(["insert", "upsert", "set", "inc", "delete"]), some(),
            r.sample(fields, r.randrange(4))) for i in range(300)]
    want = run_rows(base, ops if ordered else sorted(ops, key=lambda o: (modify.UNORDERED_RANK[o[2]], o[0])), fields)
    b = spark.createDataFrame([(k, x["s"], x["v"], x["n"], x["kept"]) for k, x in base.items()], "k long, s string, v double, n int, kept string")
    o = spark.createDataFrame([(i, k, op, x["s"], x["v"], x["n"], t) for i, k, op, x, t in ops],
                              "seq long, k long, op string, s string, v double, n int, given array<string>")
    got = modify.bulk_rows(b, o, "k", fields, "given", ordered).collect()
    assert {x.k: {c: x[c] for c in [*fields, "kept"]} for x in got} == want
