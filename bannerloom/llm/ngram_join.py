"""Jaccard join of documents on word shingles with PartEnum signatures.

Sets are put into bands of like size. In a band, linked sets differ in at most k
shingles. The shingle domain is cut into groups of three parts, more than k / 2 of
them, so in some group two linked sets differ in one part at most and agree in the two
others: they share the signature of those two parts. Most linked sets agree in more groups
than one. Of a set that shares m signatures or more with all that it links with, the m - 1
most frequent signatures are not needed, and so frequent ones seldom bring sets together.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache, reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from bannerloom.llm.common import classes, distinct, free, hashed, let_go, scope, settle, stage, staged_result, words
from bannerloom.llm.lm_score import mix

#: A band is this many times as wide as the sizes that can link with one size.
WIDTH = 3
#: Keys of candidates that are broadcast at most (about 60 bytes each); more are joined by a shuffle.
BROADCAST_KEYS = 1_000_000
#: Sets that a task remembers so as not to give a copy's signatures again.
REMEMBERED = 1_000_000
#: Sets, and shingles in them, that a tile or a block holds at about most.
TILE_SETS, TILE_SHINGLES = 256, 500_000
#: Shingles of all sets that one task compares at once, about (8 bytes each).
CELL_SHINGLES = 2_000_000
#: Parts in which the signatures are looked at, one after the other.
SHARES = 4
PAIRS = ((0, 1), (0, 2), (1, 2))


def shingles(text: str | None, n: int) -> np.ndarray:
    """Sorted hashes of the distinct word n-grams; fewer words count as one, no words as none."""
    found = words(text)
    if not found:
        return np.zeros(0, np.uint64)
    ids = hashed(found)
    width = min(n, len(ids))
    with np.errstate(over="ignore"):
        out = np.full(len(ids) - width + 1, np.uint64(width))
        for k in range(width):
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + ids[k : len(ids) - width + 1 + k])
    return distinct(out)


class Space(NamedTuple):
    number: int
    groups: int
    spare: int  # groups beyond those needed, so that as many may be empty
    last: int  # size of the largest sets


@lru_cache(maxsize=None)
def bands(percent: int, most: int) -> tuple[list[int], list[int]]:
    """First and last size of each band, up to a band that holds ``most``."""
    lo, hi, first = [], [], 1
    while first <= most:
        last = max(first, math.floor(first * (100 / percent) ** WIDTH))
        lo.append(first)
        hi.append(last)
        first = last + 1
    return lo, hi


@lru_cache(maxsize=None)
def spaces(percent: int, size: int) -> tuple[Space, ...]:
    """Where a set of this size gives signatures: its band, and the next if it can link with a set of that."""
    lo, hi = bands(percent, 1 << max(4, math.ceil(math.log2(size * 100 / percent + 2)) + 2))
    j = int(np.searchsorted(hi, size))
    out = []
    for band in (j, j + 1):
        if band > j and size * 100 // percent < lo[band]:
            break
        k = (100 - percent) * 2 * hi[band] // (100 + percent)
        smallest = lo[band] if band == 0 else -(-lo[band] * percent // 100)
        need = k // 2 + 1
        empty = 3 * math.exp(-2 * smallest / (3 * need)) * need
        spare = math.ceil(empty + 3 * math.sqrt(empty)) if empty > 0.01 and k else 0
        out.append(Space(band, need + spare if k else 0, spare, hi[band]))
    return tuple(out)


def signatures(found: np.ndarray, percent: int) -> np.ndarray:
    """All signatures of a set of sorted hashes."""
    return enumerated(found, percent)[0]


def enumerated(found: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """All signatures of a set of sorted hashes, and how many of them it shares with any set it links with, at least.

    The size of a set bounds what it differs in from one that it links with, and it takes
    two differences for a group not to agree. A signature without any shingle would be
    shared by unrelated sets, so such ones are only given for sets that may agree in
    groups with two empty parts alone. Any other set shares one signature or more for each
    group in which it agrees at least, without those that may be empty.
    """
    out, least = [], []
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(found ^ np.uint64(0x8CB92BA72F3D8DD7)))])
        for space in spaces(percent, len(found)):
            seed = np.uint64(space.number + 1) * np.uint64(0xA24BAED4963EE407)
            if not space.groups:  # only equal sets link
                out.append(mix(sums[-1:] + seed))
                least.append(1)
                continue
            parts = 3 * space.groups
            # part = high half of the hash x parts / 2^32: hashes are sorted, so parts are ranges
            ends = np.searchsorted((found >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32), np.arange(parts + 1).astype(np.uint64))
            content = (sums[ends[1:]] - sums[ends[:-1]]).reshape(-1, 3)
            size = np.diff(ends).reshape(-1, 3)
            group = np.arange(space.groups, dtype=np.uint64) * np.uint64(3)
            empty = int(((size == 0).sum(axis=1) >= 2).sum())
            differ = (100 - percent) * (len(found) + min(space.last, len(found) * 100 // percent)) // (100 + percent)
            sure = space.groups - differ // 2 - empty
            bad = sure < 1
            least.append(max(1, sure))
            for which, (a, b) in enumerate(PAIRS):
                got = mix(content[:, a] + mix(content[:, b] + seed + group + np.uint64(which)))
                out.append(got if bad else got[(size[:, a] > 0) | (size[:, b] > 0)])
    return np.concatenate(out), min(least)


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")))


def signed(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(doc_id, key of the text, row, size, two hashes of the set, signatures, how many linked sets share); a row for each document.

    Of copies in one task only the first carries signatures.
    """
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("key", T.BinaryType()), T.StructField("row", T.LongType()), T.StructField("n", T.LongType()),
         T.StructField("k1", T.LongType()), T.StructField("k2", T.LongType()), T.StructField("sigs", T.ArrayType(T.LongType())), T.StructField("least", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        row, seen = TaskContext.get().partitionId() << 33, set()
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                sizes, k1, k2, sigs, least = [], [], [], [], []
                for text in batch.column(2).to_pylist():
                    found = shingles(text, n)
                    with np.errstate(over="ignore"):
                        one, two = (int(mix(found ^ np.uint64(c)).sum(dtype=np.uint64)) for c in (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25))
                    new = len(found) and (one, two) not in seen
                    if new:
                        if len(seen) >= REMEMBERED:
                            seen.clear()
                        seen.add((one, two))
                    sizes.append(len(found))
                    k1.append(one)
                    k2.append(two)
                    own, shares = enumerated(found, percent) if new else (np.zeros(0, np.uint64), 1)
                    sigs.append(distinct(own).view(np.int64))
                    least.append(shares)
                ends = pa.array(np.concatenate([[0], np.cumsum([len(s) for s in sigs])]).astype(np.int32))
                numbers = [np.array(x, np.uint64).view(np.int64) for x in (k1, k2)]
                columns = [*batch.columns[:2], pa.array(row + np.arange(len(sizes))), pa.array(sizes, pa.int64()), *map(pa.array, numbers),
                           pa.ListArray.from_arrays(ends, pa.array(np.concatenate(sigs))), pa.array(least, pa.int64())]
                row += len(sizes)
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.select(F.col("doc_id").cast("long"), text_key(F.col("text")), F.col("text").cast("string")).mapInArrow(run, schema)


def sets_of(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(cid, set) for the classes in ``wanted`` (cid, doc_id, key), from the whole texts of one document of each."""
    bounded = wanted.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    right = wanted.withColumnsRenamed({"doc_id": "__id", "key": "__key"})
    left = docs.select(F.col("doc_id").cast("long").alias("__doc"), text_key(F.col("text")).alias("__text_key"), F.col("text").cast("string").alias("text"))
    rows = left.join(F.broadcast(right) if bounded else right, (F.col("__text_key") == F.col("__key")) & F.col("__doc").eqNullSafe(F.col("__id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                found = [shingles(t, n).view(np.int64) for t in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["cid", "set"])

    return rows.select("cid", "text").mapInArrow(run, "cid long, set array<long>")


def verified(pairs: DataFrame, docs: DataFrame, members: DataFrame, n: int, percent: int) -> DataFrame:
    """Of the pairs (a, b) those that link, by their whole sets."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct()
    sets = stage(sets_of(docs, members.join(ends, "cid", "left_semi"), n), "sets")
    both = pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    return both.where(100 * shared >= percent * (F.size("sa") + F.size("sb") - shared)).select("a", "b").distinct()


def linked(a: pd.DataFrame, b: pd.DataFrame, percent: int) -> Iterator[tuple[int, int]]:
    """A forest of the links between two blocks (cid, root, n, set) that tie different roots."""
    na, nb = a["n"].to_numpy(), b["n"].to_numpy()
    may = (a["root"].to_numpy()[:, None] != b["root"].to_numpy()[None, :]) & (
        100 * np.minimum(na[:, None], nb[None, :]) >= percent * np.maximum(na[:, None], nb[None, :])
    )
    if not may.any():
        return
    flat = [np.concatenate(x["set"].tolist()) for x in (a, b)]
    common = np.intersect1d(*flat)
    entries = []
    for found, side in zip(flat, (a, b)):  # (number of the shingle, row) of the common shingles, by number
        at = np.minimum(np.searchsorted(common, found), max(0, len(common) - 1))
        both = np.flatnonzero(common[at] == found) if len(common) else np.zeros(0, np.int64)
        owner = np.repeat(np.arange(len(side)), side["set"].map(len).to_numpy())
        order = both[np.argsort(at[both], kind="stable")]
        entries.append((at[order], owner[order]))
    shared = np.zeros(may.shape, np.float32)
    for at in range(0, len(common), 4096):  # counts of common shingles as products of 0/1 matrices
        sides = []
        for (number, owner), rows in zip(entries, may.shape):
            lo, hi = np.searchsorted(number, [at, at + 4096])
            flags = np.zeros((rows, min(4096, len(common) - at)), np.float32)
            flags[owner[lo:hi], number[lo:hi] - at] = 1
            sides.append(flags)
        shared += sides[0] @ sides[1].T
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    hit = may & (100 * shared >= percent * (na[:, None] + nb[None, :] - shared))
    ids, others = a["cid"].tolist(), b["cid"].tolist()
    of_a, of_b = a["root"].tolist(), b["root"].tolist()
    for i, j in zip(*np.nonzero(hit)):
        x, y = root(of_a[i]), root(of_b[j])
        if x != y:
            up[max(x, y)] = min(x, y)
            yield ids[i], others[j]


def tied(owner: np.ndarray, sig: np.ndarray, rows: int) -> np.ndarray:
    """For each of ``rows`` classes the smallest that shared buckets (entries of owner and bucket) lead to."""
    label = np.arange(rows)
    while True:
        least = np.full(sig.max() + 1 if len(sig) else 0, rows)
        np.minimum.at(least, sig, label[owner])
        after = label.copy()
        np.minimum.at(after, owner, least[sig])
        after = after[after]
        if (after == label).all():
            return label
        label = after


def compare_cell(cell: pd.DataFrame, percent: int) -> Iterator[tuple[int, int]]:
    """Links between the classes (cid, root, n, side, sigs, set) of two sides, or within one, that share a bucket.

    Classes that buckets tie together are cut into blocks of bounded size; two blocks are
    compared if they share a bucket, by their classes in such buckets.
    """
    cell = cell.sort_values("cid", ignore_index=True)
    roots, sides = cell["root"].to_numpy(), cell["side"].to_numpy()
    owner = np.repeat(np.arange(len(cell)), cell["sigs"].map(len).to_numpy())
    sig = np.unique(np.concatenate(cell["sigs"].tolist()), return_inverse=True)[1]

    def several(values: np.ndarray) -> np.ndarray:
        """By entry, whether its bucket has different values."""
        lo, hi = np.full(sig.max() + 1, np.iinfo(np.int64).max), np.full(sig.max() + 1, np.iinfo(np.int64).min)
        np.minimum.at(lo, sig, values[owner])
        np.maximum.at(hi, sig, values[owner])
        return (lo < hi)[sig]

    two = cell["ca"].iloc[0] != cell["cb"].iloc[0]
    open_ = several(roots) & several(sides) if two else several(roots)
    owner, sig = owner[open_], sig[open_]
    label = tied(owner, sig, len(cell))
    sizes = cell["n"].to_numpy()
    starts = np.searchsorted(owner, np.arange(len(cell) + 1))  # owners are in order
    sigs = [sig[lo:hi] for lo, hi in zip(starts[:-1], starts[1:])]

    def blocks(members: np.ndarray) -> list[np.ndarray]:
        full = np.maximum(np.arange(len(members)) // TILE_SETS, np.cumsum(sizes[members]) // TILE_SHINGLES)
        return np.split(members, np.flatnonzero(np.diff(full)) + 1)

    order = np.lexsort((sides, label))
    for members in np.split(order, np.flatnonzero(np.diff(label[order])) + 1):
        if len(members) < 2:
            continue
        if two:
            here = sides[members] == sides[members[0]]
            pairs = [(x, y) for x in blocks(members[here]) for y in blocks(members[~here])]
        else:
            own = blocks(members)
            pairs = [(x, y) for i, x in enumerate(own) for y in own[i:]]
        for x, y in pairs:
            if x is not y:
                of_x, of_y = (np.concatenate([sigs[i] for i in z]) for z in (x, y))
                common = np.intersect1d(of_x, of_y)
                x, y = (z[[bool(np.isin(sigs[i], common).any()) for i in z]] for z in (x, y))
            if len(x) and len(y):
                yield from linked(cell.iloc[x], cell.iloc[y], percent)


def compared(left: DataFrame, leads: DataFrame, docs: DataFrame, members: DataFrame, n: int, percent: int) -> DataFrame:
    """Links (a, b) that tie classes of different roots sharing a bucket, enough of them for the components.

    ``left`` has (sig, cid, n, root) of all buckets with several roots. Classes that
    leads tie into one tree lie in one tile, or in several of bounded size with the
    classes of a lead together. Tiles are dealt into so many sides of a square that the
    sets of two sides fit a task; the classes of two sides that share a bucket meet in
    the cell of the two. So neither pairs of classes nor pairs of tiles are rows: a
    class has a row for each bucket, and one for each cell.
    """
    nodes = left.select("cid", "n", "root").distinct().join(leads, "cid", "left").withColumn("b", F.coalesce("b", "cid"))
    nodes = stage(nodes, "nodes")
    trees = classes(left.sparkSession, nodes.select(F.col("cid").alias("a"), "b")).withColumnRenamed("root", "root_")
    nodes = stage(nodes.join(trees, nodes["cid"] == trees["node"], "left").select("cid", "n", "root", "b", F.coalesce("root_", "cid").alias("tree")), "trees")

    def cut(rows: DataFrame, by: list[str], key: str, out: str) -> DataFrame:
        """Numbers ``out`` that cut each group of ``by`` into bounded parts, rows of one ``key`` together."""
        pieces = rows.groupBy(*by).agg(F.ceil(F.greatest(F.count("*") / TILE_SETS, F.sum("n") / TILE_SHINGLES)).cast("int").alias("pieces"))
        return rows.join(stage(pieces, "pieces"), by).withColumn(out, F.pmod(F.xxhash64(key), F.col("pieces"))).drop("pieces")

    parts = cut(cut(nodes, ["tree"], "b", "part"), ["tree", "part"], "cid", "piece")
    shingles_of_all = nodes.agg(F.sum("n")).first()[0] or 0
    edge = max(1, math.ceil(2 * shingles_of_all / CELL_SHINGLES))
    tiles = stage(parts.select("cid", "n", "root", F.pmod(F.xxhash64("tree", "part", "piece"), F.lit(edge)).cast("int").alias("side")), "tiles")
    at = stage(left.select("sig", "cid", "root").join(tiles.select("cid", "side"), "cid"), "at")
    there = at.groupBy("sig", "side").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
    met = stage(there.groupBy("sig").agg(F.collect_list(F.struct("side", "lo", "hi")).alias("met")), "met")  # at most ``edge`` of them
    # of the sides of a bucket, a class meets those with another root than its own
    others = F.filter("met", lambda x: (x["lo"] != F.col("root")) | (x["hi"] != F.col("root")))
    own = at.join(met, "sig").select("cid", "sig", F.transform(others, lambda x: x["side"]).alias("others"))
    own = own.groupBy("cid").agg(F.collect_list("sig").alias("sigs"), F.array_distinct(F.flatten(F.collect_set("others"))).alias("others"))
    own = stage(own, "wanted")
    free(nodes, at, met)
    # joined and made unique by one shuffle of the sets
    sets = sets_of(docs, members.join(own.select("cid"), "cid", "left_semi"), n)
    full = stage(tiles.join(own, "cid").join(sets, "cid").dropDuplicates(["cid"]), "full")
    settle(full)

    def compare(cell: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(list(compare_cell(cell, percent)), columns=["a", "b"], dtype="int64")

    # cells are done in shares, so that the sets sent for one share are gone before the next
    sent = full.withColumn("other", F.explode("others")).drop("others")
    sent = sent.select(F.least("side", "other").alias("ca"), F.greatest("side", "other").alias("cb"), "cid", "n", "root", "side", "sigs", "set")
    forests = []
    for share in range(SHARES):
        cells = sent.where(F.pmod(F.xxhash64("ca", "cb"), F.lit(SHARES)) == share)
        forests.append(stage(cells.groupBy("ca", "cb").applyInPandas(compare, "a long, b long"), "forest"))
        settle(full)
    return reduce(DataFrame.unionByName, forests)


def components(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(doc_id, key, n_shingles, cid, component): a row for each document.

    ``cid`` is the class of equal sets, ``component`` the class that stands for all
    that links lead to; both null for documents without words. Links of Jaccard
    ``percent`` / 100 or more are decided on whole sets, and every pair of classes that
    shares a signature is either decided or already in one component: first each class
    with the class that leads most of its buckets, then, in tiles, what is left between
    different components. So a large group of near copies gives rows for its members and
    not for its pairs.
    """
    spark = docs.sparkSession
    rows = stage(signed(docs, n, percent), "signed")
    some = rows.where("n > 0")
    sets = stage(
        some.groupBy("k1", "k2", "n").agg(F.min("row").alias("cid"), F.min(F.struct("doc_id", "key")).alias("one")).select(
            "k1", "k2", "n", "cid", F.col("one.doc_id").alias("doc_id"), F.col("one.key").alias("key")
        ),
        "sets",
    )
    known = stage(some.drop("sigs").join(sets.select("k1", "k2", "cid"), ["k1", "k2"]).select("row", "doc_id", "key", "n", "cid", "least"), "classes")
    none = stage(rows.where("n = 0").select("doc_id", "key", "n"), "none")
    members = sets.select("cid", "doc_id", "key")

    # signatures that are met twice are found by sums of parts, and only they are kept, by a
    # join of plain tables: a signature that very many sets share is never in one task.
    # All signatures are looked at, a share of their hashes at a time, so that what is
    # shuffled for one share is gone before the next.
    each = some.select("row", F.explode("sigs").alias("sig"))
    found = []
    for share in range(SHARES):
        own = each.where(F.pmod("sig", F.lit(SHARES)) == share)
        twice = stage(own.groupBy("sig").agg(F.count("*").alias("sets")).where("sets > 1"), "twice")
        found.append(stage(own.join(twice, "sig").select("sig", "row", "sets"), "shared"))
        free(twice)
        settle(rows)  # what was shuffled for the share grows with the signatures
    shared = reduce(DataFrame.unionByName, found)
    free(rows)
    # all sets order signatures alike, the most frequent first: of those that two linked sets
    # share, the last one stands behind the ``least`` - 1 first ones of either. Rows become
    # classes; copies of one class in a bucket become one
    place = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("sets"), "sig"))
    ranked = shared.join(known.select("row", "cid", "n", "least"), "row").withColumn("place", place)
    buckets = stage(ranked.where("place >= least").select("sig", "cid", "n").distinct(), "buckets")
    free(*found)

    # the class in most buckets leads each of its buckets: of near copies, the one least changed
    times = stage(buckets.groupBy("cid").agg(F.count("*").alias("often")), "times")
    lead = buckets.join(times, "cid").groupBy("sig").agg(F.max(F.struct("often", F.col("cid").alias("b"), F.col("n").alias("m"))).alias("lead"))
    leads = stage(lead.select("sig", "lead.b", "lead.m"), "leads")
    best = buckets.join(leads, "sig").where("cid <> b").groupBy("cid", "n", "b", "m").count()
    best = best.groupBy("cid", "n").agg(F.max_by(F.struct("b", "m"), F.struct("count", "b")).alias("best"))
    best = stage(best.select("cid", "n", "best.b", "best.m"), "best")
    free(times, leads)
    pairs = stage(best.where(100 * F.least("n", "m") >= percent * F.greatest("n", "m")).select(F.col("cid").alias("a"), "b"), "pairs")
    with scope() as made:
        links = staged_result(verified(pairs, docs, members, n, percent), "links", made)
    with scope() as made:
        roots = staged_result(classes(spark, links), "roots", made)
    named = stage(
        buckets.join(roots, buckets["cid"] == roots["node"], "left").select("sig", "cid", "n", F.coalesce("root", "cid").alias("root")), "named"
    )
    free(buckets, roots, pairs)
    open_ = stage(named.groupBy("sig").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("sig"), "open_sigs")
    left = stage(named.join(open_, "sig", "left_semi"), "open")
    free(named, open_)
    with scope() as made:
        more = staged_result(compared(left, best.select("cid", "b"), docs, members, n, percent), "links", made)
    with scope() as made:
        roots = staged_result(classes(spark, links.unionByName(more)), "roots", made)
    free(left, best, links, more)

    placed = known.join(roots, known["cid"] == roots["node"], "left").select(
        "doc_id", "key", F.col("n").alias("n_shingles"), "cid", F.coalesce("root", "cid").alias("component")
    )
    alone = none.select("doc_id", "key", F.col("n").alias("n_shingles"), *[F.lit(None).cast("long").alias(c) for c in ("cid", "component")])
    return placed.unionByName(alone)


def join(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id): the smallest doc_id that links lead to.

    Documents are compared by the distinct ``n``-word shingles of their whole texts. Null
    and empty texts and texts without words have no shingles and link with nothing:
    their own id. Repeated rows and ids are documents of their own; a null id counts as
    larger than all others, so it has a null component only among null ids. Very long
    texts give signatures in proportion to their length. Only ``doc_id`` and ``text``
    are read; an empty table gives an empty one.
    """
    with scope() as made:
        placed = staged_result(components(docs, n, percent), "components", made)
    smallest = stage(placed.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("component_id")), "smallest")
    joined = placed.join(smallest, "component", "left")
    return joined.select("doc_id", "n_shingles", F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component: that of the smallest id, null ids last.

    Documents without words stay. Of rows with one id and one text, that one stays whose
    other columns, as JSON, come first. All columns stay as they are.
    """
    with scope() as made:
        placed = staged_result(components(docs, n, percent), "components", made)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    chosen = placed.where("component is not null").groupBy("component").agg(F.min(order).alias("one")).select("one.doc_id", "one.key")
    alone = placed.where("component is null").select("doc_id", "key").distinct()
    # rows with one id and one text are few, and only they are sent to be compared
    often = placed.groupBy("doc_id", "key").agg((F.count("*") > 1).alias("__often")).toDF("__of", "__of_key", "__often")
    both = chosen.unionByName(alone).toDF("__id", "__key")
    same = (F.col("__key") == F.col("__of_key")) & F.col("__id").eqNullSafe(F.col("__of"))
    keep = stage(both.join(often, same).select("__id", "__key", "__often"), "keep")
    keyed = docs.withColumn("__text_key", text_key(F.col("text")))
    kept = keyed.join(keep, (F.col("__text_key") == F.col("__key")) & F.col("doc_id").cast("long").eqNullSafe(F.col("__id")))
    others = [F.col(c) for c in docs.columns if c not in ("doc_id", "text")]
    first = F.min_by(F.struct(*docs.columns), F.to_json(F.struct(*others, F.lit(0).alias("__none"))))
    repeated = kept.where("__often").groupBy("__id", "__text_key").agg(first.alias("__row")).select("__row.*")
    return kept.where("not __often").select(*docs.columns).unionByName(repeated)
