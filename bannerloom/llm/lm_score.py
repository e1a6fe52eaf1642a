"""Language-model scores from a log-frequency Bloom filter of quantised n-gram counts."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard as zstd
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bannerloom.llm.common import distinct, free, hashed, settle, stage, words

#: A count c is kept as the level 1 + floor(log_BASE c).
BASE = 1.5
#: Bits of the filter for each stored level, probes for each, and the largest filter that is broadcast:
#: n-grams are shuffled to the blocks of a larger one.
BITS, PROBES, MAX_FILTER_BYTES = 10, 4, 8 << 20
#: Parts in which parcels are sent to the blocks, one after the other.
SHARES = 4
#: Bytes of text for each hash range; a range is counted by one task and has a block of the filter.
RANGE_BYTES = 8 << 20
#: Exact counts of at most so many frequent words are broadcast (16 bytes each); the others are joined.
FREQUENT = 1_000_000
#: Tokens that a task counts, sends to a filter in blocks and scores at a time.
COUNTED, SENT, SCORED = 1_500_000, 800_000, 400_000
#: Levels are below this.
LEVELS = 120
#: Weights of the bigram counts that are tried for each level of the context.
WEIGHTS = np.linspace(0.0, 0.95, 20)
# hashes of the end and of the start of a text; words are hashed with another seed
END, START = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)


def mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(30))


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hashes of the bigrams (a, b)."""
    with np.errstate(over="ignore"):
        return mix(a * np.uint64(0x9E3779B97F4A7C15) + mix(b))


def squeezed(numbers: np.ndarray) -> bytes:
    """Compressed, the bytes of equal weight side by side."""
    return zstd.compress(numbers.view(np.uint8).reshape(-1, numbers.itemsize).T.tobytes(), 1)


def unsqueezed(data: bytes, kind: type) -> np.ndarray:
    flat = np.frombuffer(zstd.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(flat.T).view(kind).ravel()


def squeezed_steps(numbers: np.ndarray) -> bytes:
    """For sorted 64-bit numbers, whose steps have fewer bytes."""
    return squeezed(np.diff(numbers, prepend=numbers.dtype.type(0)))


def unsqueezed_steps(data: bytes) -> np.ndarray:
    return np.cumsum(unsqueezed(data, np.uint64), dtype=np.uint64)


def token_blocks(texts: Iterator[tuple[int, str | None]], size: int) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """(rows, tokens, tokens of each row) for about ``size`` tokens at a time; a row's end is a token."""
    rows, parts, counts, n = [], [], [], 0
    for row, text in texts:
        found = words(text)
        parts += [hashed(found), END[None]]
        rows.append(row)
        counts.append(len(found) + 1)
        n += len(found) + 1
        if n >= size:
            yield rows, np.concatenate(parts), np.array(counts)
            rows, parts, counts, n = [], [], [], 0
    if rows:
        yield rows, np.concatenate(parts), np.array(counts)


def contexts(tokens: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The token before each, START at the start of a text."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[np.cumsum(counts) - counts] = START
    return before


def range_of(grams: np.ndarray, ranges: int) -> np.ndarray:
    return ((grams >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def counted(texts: DataFrame, ranges: int) -> DataFrame:
    """(kind, range, hashes, counts): every n-gram of the corpus once, packed by hash range.

    Kind 1: tokens (and START, as often as it is a context), kind 2: bigrams. Tasks count
    what they hold before anything is shuffled, so a frequent n-gram is one entry for
    each block of tokens.
    """

    def packed(kind: int, grams: np.ndarray):
        found, n = np.unique(grams, return_counts=True)
        cuts = np.searchsorted(range_of(found, ranges), np.arange(ranges + 1))
        for r, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])):
            if lo < hi:
                yield kind, r, squeezed_steps(found[lo:hi]), squeezed(n[lo:hi].astype(np.uint32))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, tokens, counts in token_blocks(((0, t.as_py()) for b in batches for t in b.column(0)), COUNTED):
            grams = packed(2, pair(contexts(tokens, counts), tokens))
            for rows in (packed(1, np.concatenate([tokens, np.full(len(counts), START)])), grams):
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), pa.int64(), pa.binary(), pa.binary()))]
                yield pa.RecordBatch.from_arrays(columns, ["kind", "range", "hashes", "counts"])

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        hashes = np.concatenate([unsqueezed_steps(x) for x in group["hashes"]])
        counts = np.concatenate([unsqueezed(x, np.uint32) for x in group["counts"]])
        found, where = np.unique(hashes, return_inverse=True)
        total = np.bincount(where, weights=counts, minlength=len(found)).astype(np.int64)
        return pd.DataFrame({"kind": [group["kind"].iloc[0]], "range": [group["range"].iloc[0]], "hashes": [squeezed_steps(found)], "counts": [squeezed(total)]})

    schema = "kind int, range long, hashes binary, counts binary"
    return stage(texts.mapInArrow(count, schema).groupBy("kind", "range").applyInPandas(merge, schema), "ngrams")


def levels(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(counts) / math.log(BASE) + 1e-9).astype(np.int64)


def level_counts(most: int = LEVELS) -> np.ndarray:
    """By level, the mean of the counts that have it; 0 for level 0."""
    edges = [math.ceil(BASE**k - 1e-9) for k in range(most + 1)]
    return np.array([0.0] + [(a + max(a, b - 1)) / 2 for a, b in zip(edges, edges[1:])])


def probes(grams: np.ndarray, level: int, bits: int) -> np.ndarray:
    """Bit numbers below ``bits`` for (n-gram, level): a row for each probe."""
    with np.errstate(over="ignore"):
        h = mix(grams + np.uint64(level) * np.uint64(0xA0761D6478BD642F))
        step = mix(h) | np.uint64(1)
        return np.stack([(h + np.uint64(i) * step) % np.uint64(bits) for i in range(PROBES)])


class Model(NamedTuple):
    """Everything but the filter, which is broadcast once by itself."""

    bits: int  # of a block; the filter has a block for each hash range
    ranges: int
    tokens: int  # of the corpus
    different: int
    weights: list[float]  # of the bigrams, by the level of their context


def found_levels(block: np.ndarray, bits: int, grams: np.ndarray, base: np.ndarray) -> np.ndarray:
    """The level of each n-gram, whose block starts at bit ``base``: probes go on from level 1 until one is absent."""
    got, alive, level = np.zeros(len(grams), np.int64), np.arange(len(grams)), 1
    while len(alive) and level < LEVELS:
        bit = probes(grams[alive], level, bits) + base[alive]
        hit = ((block[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1).all(axis=0)
        alive = alive[hit]
        got[alive] = level
        level += 1
    return got


def stored_levels(model: Model, bits: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """The level of each n-gram in the whole filter."""
    found, where = np.unique(grams, return_inverse=True)
    base = range_of(found, model.ranges).astype(np.uint64) * np.uint64(model.bits)
    return found_levels(bits, model.bits, found, base)[where]


def build(ngrams: DataFrame, ranges: int, tokens: int, different: int) -> tuple[Model, DataFrame]:
    """The filter's blocks (range, bits), one or two to be united for each hash range.

    It has BITS for every stored level, so it grows with the corpus, and a block with
    the share of one range in it.
    """

    def sizes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for counts in pdf["counts"]:
                n = np.bincount(levels(unsqueezed(counts, np.int64)))
                yield pd.DataFrame({"level": np.arange(len(n)), "n": n})

    by_level = ngrams.select("counts").mapInPandas(sizes, "level int, n long").groupBy("level").agg(F.sum("n")).collect()
    bits = 8 * math.ceil((BITS * sum(level * n for level, n in by_level) / ranges + 64) / 8)

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at, hashes, counts in zip(pdf["range"], pdf["hashes"], pdf["counts"]):
                grams, top = unsqueezed_steps(hashes), levels(unsqueezed(counts, np.int64))
                block, level = np.zeros(bits, bool), 1
                while len(grams := grams[top >= level]):
                    top = top[top >= level]
                    block[probes(grams, level, bits).ravel().astype(np.int64)] = True
                    level += 1
                yield pd.DataFrame({"range": [at], "bits": [np.packbits(block, bitorder="little").tobytes()]})

    made = stage(ngrams.mapInPandas(blocks, "range long, bits binary"), "blocks")
    return Model(bits, ranges, tokens, different, [0.0] * LEVELS), made


def gathered(model: Model, blocks: DataFrame) -> np.ndarray:
    """The filter in one piece of at most MAX_FILTER_BYTES: the driver puts the blocks side by side."""
    whole = np.zeros(model.ranges * model.bits // 8, np.uint8)
    for r in blocks.toLocalIterator(prefetchPartitions=True):  # MAX_FILTER_BYTES for each kind, a few blocks at a time
        whole[r[0] * model.bits // 8 : (r[0] + 1) * model.bits // 8] |= np.frombuffer(r[1], np.uint8)
    return whole


def coded(context: np.ndarray, both: np.ndarray, single: np.ndarray) -> np.ndarray:
    """The levels of a context, the bigram and the token as one number."""
    return (context * LEVELS + both) * LEVELS + single


def parts(model: Model, codes: np.ndarray, out: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(level of the context, share of the bigram in it, smoothed share of the token); ``out`` is taken from each count."""
    values = level_counts()
    context, both, single = codes // (LEVELS * LEVELS), codes // LEVELS % LEVELS, codes % LEVELS
    share = np.minimum(1.0, np.maximum(0.0, values[both] - out) / np.maximum(1.0, values[context] - out))
    return context, share, (np.maximum(0.0, values[single] - out) + 0.1) / (model.tokens + 0.1 * (model.different + 1))


def log_shares(model: Model, codes: np.ndarray) -> np.ndarray:
    level, share, one = parts(model, codes, 0)
    w = np.array(model.weights)[level]
    return np.log10(w * share + (1 - w) * one)


def filter_codes(model: Model, bits: np.ndarray, before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    context, single = stored_levels(model, bits, before), stored_levels(model, bits, tokens)
    return coded(context, stored_levels(model, bits, pair(before, tokens)), single)


def text_codes(texts: DataFrame, model: Model, filter_: Broadcast) -> DataFrame:
    """(code, n): how often the tokens of ``texts`` have a code, in parts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, tokens, counts in token_blocks(((0, t.as_py()) for b in batches for t in b.column(0)), SCORED):
            code, n = np.unique(filter_codes(model, filter_.value, contexts(tokens, counts), tokens), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(n)], ["code", "n"])

    return texts.mapInArrow(count, "code long, n long")


def fit_weights(model: Model, codes: DataFrame) -> Model:
    """For each level of the context the weight under which its tokens, each left out of the counts, are likeliest."""
    rows = codes.groupBy("code").agg(F.sum("n")).collect()  # by levels: thousands, whatever the corpus
    code, n = (np.array(x, np.int64) for x in zip(*sorted(map(tuple, rows)))) if rows else (np.zeros(0, np.int64),) * 2
    level, share, one = parts(model, code, 1)
    total = np.stack([np.bincount(level, weights=n * np.log(w * share + (1 - w) * one), minlength=LEVELS) for w in WEIGHTS], axis=1)
    best = len(WEIGHTS) - 1 - total[:, ::-1].argmax(axis=1)  # the last of equal ones
    seen = np.bincount(level, minlength=LEVELS) > 0
    return model._replace(weights=[float(WEIGHTS[k]) if s else 0.0 for k, s in zip(best, seen)])


class Parcel(NamedTuple):
    """The tokens of some rows as a row of a table: different tokens, their places (compressed), tokens and use of each row."""

    vocabulary: bytes
    places: bytes
    counts: bytes
    learn: bytes


PARCEL = T.StructType([T.StructField(n, T.BinaryType()) for n in Parcel._fields])


def parcel(found: np.ndarray, where: np.ndarray, counts: np.ndarray, learn: np.ndarray) -> Parcel:
    """``found`` are the different tokens, ``where`` the place of each token there."""
    order = np.argsort(-np.bincount(where, minlength=len(found)), kind="stable")  # frequent tokens have small numbers, whose bytes lie together
    number = np.empty(len(found), np.uint32)
    number[order] = np.arange(len(found), dtype=np.uint32)
    return Parcel(found[order].tobytes(), squeezed(number[where]), counts.astype(np.int64).tobytes(), learn.astype(bool).tobytes())


def opened(p: Parcel) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(different tokens, place of each token there, bigrams, tokens of each row)."""
    vocabulary, counts = np.frombuffer(p.vocabulary, np.uint64), np.frombuffer(p.counts, np.int64)
    places = unsqueezed(p.places, np.uint32)
    tokens = vocabulary[places]
    return vocabulary, places, pair(contexts(tokens, counts), tokens), counts


def shuffled_codes(parcels: DataFrame, model: Model, blocks: DataFrame) -> DataFrame:
    """(first, learn, keys, times) for parcels (first row, parcel) by a filter of any size: codes by row, see row_codes.

    The different n-grams of a parcel go to the blocks of their hash ranges and their
    levels come back, so no task needs more than a block and what is asked of it. Hash
    order is range order, so answers in the order of the ranges are in that of the n-grams.
    Parcels go in shares, so that what is sent for one share is gone before the next.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, p in zip(batch.column(0).to_pylist(), batch.column(1)):
                vocabulary, _, grams, _ = opened(Parcel(**p.as_py()))
                found = distinct(np.concatenate([START[None], vocabulary, grams]))
                cuts = np.searchsorted(range_of(found, model.ranges), np.arange(model.ranges + 1))
                rows = [(first, r, squeezed_steps(found[lo:hi])) for r, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])) if lo < hi]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary()))]
                yield pa.RecordBatch.from_arrays(columns, ["first", "range", "hashes"])

    def answer(asked: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        whole = np.zeros(model.bits // 8, np.uint8)
        for x in block["bits"]:
            whole |= np.frombuffer(x, np.uint8)
        got = [found_levels(whole, model.bits, g, np.zeros(len(g), np.uint64)) for g in map(unsqueezed_steps, asked["hashes"])]
        return pd.DataFrame({"first": asked["first"], "range": asked["range"], "levels": [squeezed(x.astype(np.uint8)) for x in got]})

    def read(answers: pd.DataFrame, parcels: pd.DataFrame) -> pd.DataFrame:
        p = Parcel(**parcels["parcel"].iloc[0])
        vocabulary, places, grams, counts = opened(p)
        where = np.unique(np.concatenate([START[None], vocabulary, grams]), return_inverse=True)[1]
        level = np.concatenate([unsqueezed(x, np.uint8) for x in answers.sort_values("range")["levels"]])[where].astype(np.int64)
        single, both = level[1 : len(vocabulary) + 1][places], level[len(vocabulary) + 1 :]
        before = np.append(0, single[:-1])
        before[np.cumsum(counts) - counts] = level[0]
        keys, times = np.unique(np.repeat(np.arange(len(counts)), counts) * LEVELS**3 + coded(before, both, single), return_counts=True)
        return pd.DataFrame({"first": parcels["first"], "learn": [p.learn], "keys": [squeezed_steps(keys)], "times": [squeezed(times.astype(np.uint32))]})

    done = []
    for share in range(SHARES):
        own = parcels.where(F.pmod(F.xxhash64("first"), F.lit(SHARES)) == share)
        asked = own.mapInArrow(ask, "first long, range long, hashes binary")
        answers = asked.groupBy("range").cogroup(blocks.groupBy("range")).applyInPandas(answer, "first long, range long, levels binary")
        answers = stage(answers, "answers")
        settle(blocks)  # the n-grams sent for the share
        coded_rows = answers.groupBy("first").cogroup(own.groupBy("first")).applyInPandas(read, "first long, learn binary, keys binary, times binary")
        done.append(stage(coded_rows, "codes"))
        free(answers)
    free(blocks)
    return reduce(DataFrame.unionByName, done)


def row_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, use of each row, then by row and code: place of the row, code, times) of each parcel."""
    for batch in batches:
        for first, learn, keys, times in zip(*(batch.column(k) for k in ("first", "learn", "keys", "times"))):
            found = unsqueezed_steps(keys.as_py()).astype(np.int64)
            yield first.as_py(), np.frombuffer(learn.as_py(), bool), found // LEVELS**3, found % LEVELS**3, unsqueezed(times.as_py(), np.uint32)


def sum_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, learn, owner, codes, times in row_codes(batches):
        used = learn[owner]
        code, where = np.unique(codes[used], return_inverse=True)
        n = np.bincount(where, weights=times[used], minlength=len(code)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(n)], ["code", "n"])


def score(docs: DataFrame, learn: Column, text: str = "text") -> DataFrame:
    """The columns of ``docs`` but the text, and ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Learns from the rows where ``learn`` is true (null: not). A text's tokens are its
    words and an end. ``base_score`` is the sum of the log10 shares of exact counts,
    ``score`` that of the model: bigram shares interpolated with token shares, both from
    the filter. Null and empty texts are an end alone; repeated rows count each; columns
    named like a result are replaced. An empty table gives an empty one, and without
    rows to learn from all shares are those of unseen tokens.

    Exact counts of FREQUENT words are broadcast, those of the others are joined by
    Spark, so that neither the vocabulary nor a frequent word meets in one task. A filter
    of more than MAX_FILTER_BYTES stays in its blocks; scores are the same either way.
    """
    names = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    spark = docs.sparkSession
    docs = docs.drop(*names)
    texts = docs.where(learn).select(F.col(text).cast("string").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = 4 + size // RANGE_BYTES
    ngrams = counted(texts, ranges)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for hashes, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                h, c = unsqueezed_steps(hashes), unsqueezed(counts, np.int64)
                real = h != START
                yield pa.RecordBatch.from_arrays([pa.array(h[real].view(np.int64)), pa.array(c[real])], ["hash", "count"])

    words_only = ngrams.where("kind = 1").select("hashes", "counts")
    counts = stage(words_only.mapInArrow(unpack, "hash long, count long"), "counts")
    tokens, different = counts.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count("*")).first()
    # the least power of two that at most FREQUENT words reach
    log = F.floor(F.log2("count")).cast("int")
    left, least = FREQUENT, 1 << 62
    for power, n in sorted(counts.groupBy(log.alias("p")).count().collect(), reverse=True):
        left -= n
        if left < 0:
            break
        least = 1 << power

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [pa.array([batch.column(k).to_numpy().astype(np.int64).tobytes()], pa.binary()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(packed, ["hash", "count"])

    # 16 bytes for each of the frequent words, and no row of its own in the driver
    hot = counts.where(F.col("count") >= least).select("hash", "count").mapInArrow(pack, "hash binary, count binary").collect()
    hashes, times = (np.frombuffer(b"".join(bytes(r[k]) for r in hot), np.int64) for k in (0, 1))
    order = np.argsort(hashes)
    frequent = spark.sparkContext.broadcast((hashes[order], times[order]))
    del hot, hashes, times
    model, blocks = build(ngrams, ranges, tokens, different)
    free(ngrams)
    wide = model.ranges * model.bits > 8 * MAX_FILTER_BYTES
    filter_ = None if wide else spark.sparkContext.broadcast(gathered(model, blocks))
    if not wide:
        model = fit_weights(model, text_codes(texts, model, filter_))
    floor = tokens + 0.1 * (different + 1)

    kept = docs.drop(text)
    more = {"__row": T.LongType(), "n_tokens": T.LongType(), "__known": T.LongType(), "__base": T.DoubleType(), "score": T.DoubleType(),
            "__rare": T.ArrayType(T.LongType()), "__times": T.ArrayType(T.LongType()), "__parcel": PARCEL}
    schema = T.StructType([*kept.schema.fields, *[T.StructField(n, k) for n, k in more.items()]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        known, times = frequent.value
        for batch in batches:
            learns = batch.column(batch.num_columns - 2).to_numpy(zero_copy_only=False)
            for rows, tokens, n in token_blocks(enumerate(batch.column(batch.num_columns - 1).to_pylist()), SENT if wide else SCORED):
                owner = np.repeat(np.arange(len(n)), n)
                logs, parcels = np.zeros(len(n)), [None] * len(n)
                found, place = np.unique(tokens, return_inverse=True)
                if wide:
                    parcels[0] = parcel(found, place, n, learns[rows])._asdict()
                else:
                    codes = filter_codes(model, filter_.value, contexts(tokens, n), tokens)
                    logs = np.bincount(owner, weights=log_shares(model, codes), minlength=len(n))
                signed = found.view(np.int64)  # each different token is looked up once
                at = np.minimum(np.searchsorted(known, signed), max(0, len(known) - 1))
                hot_word = known[at] == signed if len(known) else np.zeros(len(signed), bool)
                share = np.log10((times[at] + 0.1) / floor) if len(known) else np.zeros(len(signed))
                is_hot = hot_word[place]
                base = np.bincount(owner[is_hot], weights=share[place[is_hot]], minlength=len(n)).astype(float)  # ints if none
                seen = np.bincount(owner[is_hot], minlength=len(n))
                rare, where = signed[place[~is_hot]], owner[~is_hot]
                order = np.lexsort((rare, where))
                rare, where = rare[order], where[order]
                new = np.append(True, (rare[1:] != rare[:-1]) | (where[1:] != where[:-1]))[: len(rare)]
                first = np.flatnonzero(new)
                repeat = np.diff(np.append(first, len(rare)))
                offsets = pa.array(np.searchsorted(where[first], np.arange(len(n) + 1)).astype(np.int32))
                values_of = [pa.array(row + np.arange(len(n))), pa.array(n.astype(np.int64)), pa.array(seen.astype(np.int64)), pa.array(base), pa.array(logs),
                             pa.ListArray.from_arrays(offsets, pa.array(rare[first])), pa.ListArray.from_arrays(offsets, pa.array(repeat.astype(np.int64))),
                             pa.array(parcels, pa.struct([(k, pa.binary()) for k in Parcel._fields]))]
                row += len(n)
                mine = [c.slice(rows[0], len(rows)) for c in batch.columns[:-2]]
                yield pa.RecordBatch.from_arrays([*mine, *values_of], schema.names)

    use = F.coalesce(learn, F.lit(False)).alias("__learn")
    done = stage(docs.select(*kept.columns, use, F.col(text).cast("string").alias("__text")).mapInArrow(run, schema), "scored")
    rare = done.select("__row", F.explode(F.arrays_zip("__rare", "__times")).alias("x")).select("__row", F.col("x.__rare").alias("hash"), F.col("x.__times").alias("times"))
    c = F.coalesce("count", F.lit(0))
    found = rare.join(counts.where(F.col("count") < least), "hash", "left").groupBy("__row").agg(
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("__more"), F.sum(F.col("times") * F.log10((c + 0.1) / F.lit(floor))).alias("__rest")
    )
    joined = done.drop("__parcel").join(found, "__row", "left")
    if wide:
        codes = shuffled_codes(done.where("__parcel is not null").select(F.col("__row").alias("first"), F.col("__parcel").alias("parcel")), model, blocks)
        model = fit_weights(model, codes.mapInArrow(sum_codes, "code long, n long"))

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for first, learn, owner, code, n in row_codes(batches):
                logs = np.bincount(owner, weights=n * log_shares(model, code), minlength=len(learn))
                yield pa.RecordBatch.from_arrays([pa.array(first + np.arange(len(learn))), pa.array(logs)], ["__row", "score"])

        scores = codes.mapInArrow(add, "__row long, score double")
        joined = joined.drop("score").join(scores, "__row", "left")
    return joined.select(
        *kept.columns,
        "n_tokens",
        (F.col("__known") + F.coalesce("__more", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("__base") + F.coalesce("__rest", F.lit(0.0))).alias("base_score"),
        "score",
    )
