"""Compression classifier: zstandard dictionaries of good and of bad text, compared on every chunk."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import zstandard as zstd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bannerloom.llm.common import let_go, stage

#: Labelled documents that dictionaries and calibration are fitted on, for each label and use.
SAMPLE_ROWS = 1_500
#: Characters of one document that a dictionary learns from, and of the pieces that a longer
#: one gives, evenly spread over the whole text.
LEARNT, PIECE = 4_096, 512
DICTIONARY_BYTES = 65_536
CHUNK = 2_048


class Model(NamedTuple):
    good: bytes
    bad: bytes
    center: list[float]
    weights: list[float]  # the last is the constant


def chunks(data: bytes) -> list[bytes]:
    return [data[i : i + CHUNK] for i in range(0, len(data), CHUNK)]


def compressors(good: bytes, bad: bytes) -> list:
    """With the good, the bad, and no dictionary."""
    return [zstd.ZstdCompressor(level=3, dict_data=zstd.ZstdCompressionDict(d) if d else None) for d in (good, bad, b"")]


def features(data: bytes, by: list) -> tuple[float, float]:
    """(difference of the sizes by bad and good dictionary over their sum, size without dictionary over length).

    The second tells repetitive text, which every dictionary suits, and does not change
    where a document itself is in a dictionary.
    """
    if not data:
        return 0.0, 0.0
    good, bad, plain = (sum(len(c.compress(x)) for x in chunks(data)) for c in by)
    return (bad - good) / (bad + good), plain / len(data)


def vector(pairs: np.ndarray) -> np.ndarray:
    """The difference, the size, and the square and product, as columns."""
    d, r = pairs[:, 0], pairs[:, 1]
    return np.stack([d, r, d * r, r * r], axis=1)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 100) -> np.ndarray:
    """Weights, the constant last, by Newton steps; the two labels weigh equally."""
    x = np.hstack([x, np.ones((len(x), 1))])
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (share * (y - p)) - ridge * len(y) * w
        step = np.linalg.solve((x * (share * p * (1 - p))[:, None]).T @ x + ridge * len(y) * np.eye(len(w)), gradient)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


def sampled(docs: DataFrame, labels: DataFrame, allowed: Column) -> DataFrame:
    """(doc_id, text, __label, __use) of at most SAMPLE_ROWS documents for each label and use, by hash order.

    Only ``labels`` is ordered; the chosen ids are few (4 x SAMPLE_ROWS) and are broadcast.
    Of the rows of an id only the one whose text has the least hash is taken. Documents
    with contradictory or null labels, and those that are not ``allowed``, are left out.
    """
    one = labels.where(F.col("doc_id").isNotNull() & allowed).groupBy("doc_id").agg(F.min("quality").alias("lo"), F.max("quality").alias("hi"))
    one = one.where("lo = hi and lo in (0, 1)").select("doc_id", F.col("lo").cast("int").alias("__label"), F.xxhash64("doc_id").alias("__h"))
    ids = None
    for label in (0, 1):
        part = one.where(F.col("__label") == label).orderBy("__h", "doc_id").limit(2 * SAMPLE_ROWS)
        ids = part if ids is None else ids.unionByName(part)
    # a document's use follows from another part of its hash, so both uses get about half of the rows
    ids = ids.select("doc_id", "__label", F.pmod(F.shiftright("__h", 7), F.lit(2)).cast("int").alias("__use"))
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(ids), "doc_id")
    first = F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("one")
    return stage(rows.groupBy("doc_id", "__label", "__use").agg(first).select("doc_id", "one.text", "__label", "__use"), "sample")


def spread(text: Column) -> Column:
    """Texts of up to LEARNT characters whole, of longer ones LEARNT characters in pieces, evenly spread from start to end."""
    pieces = LEARNT // PIECE
    start = lambda i: F.floor((F.length(text) - PIECE) * i / (pieces - 1)).cast("int") + 1
    some = F.transform(F.sequence(F.lit(0), F.lit(pieces - 1)), lambda i: F.substring(text, start(i), F.lit(PIECE)))
    return F.when(F.length(text) <= LEARNT, F.array(text)).otherwise(some)


def measured(docs: DataFrame, by: tuple[bytes, bytes], text: str) -> Column:
    """(difference, size) of each whole text by the dictionaries, see ``features``."""
    shared = docs.sparkSession.sparkContext.broadcast(by)

    @F.pandas_udf("d double, r double")
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        let_go()
        with_dictionary = compressors(*shared.value)
        for texts in batches:
            yield pd.DataFrame([features((t or "").encode(), with_dictionary) for t in texts], columns=["d", "r"], dtype="float64")

    return apply(F.col(text))


def fit(docs: DataFrame, labels: DataFrame, allowed: Column) -> Model:
    """Dictionaries from one half of a bounded sample of labelled documents, calibration on the other.

    The dictionaries learn from LEARNT characters of a document at most, as only these
    come to the driver; the calibration documents are measured whole, in tasks. Without
    both labels in the sample every score is the constant's.
    """
    rows = sampled(docs, labels, allowed)
    learnt = rows.where("__use = 0").orderBy("doc_id").select("__label", spread(F.col("text")).alias("pieces")).collect()
    dictionaries = []
    for label in (1, 0):
        pieces = [c for r in learnt if r[0] == label for x in r[1] for c in chunks(x.encode())]
        try:
            trained = zstd.train_dictionary(DICTIONARY_BYTES, pieces, level=3).as_bytes()
        except (zstd.ZstdError, ValueError):  # too little text: the text itself
            trained = b"".join(pieces)[:DICTIONARY_BYTES]
        dictionaries.append(trained if len(trained) >= 8 else b"")
    rest = rows.where("__use = 1")
    rest = rows if rest.isEmpty() else rest
    got = rest.select("doc_id", "__label", measured(rest, tuple(dictionaries), "text").alias("m")).orderBy("doc_id").select("__label", "m.d", "m.r").collect()
    y = np.array([r[0] for r in got], float)
    if not len(y) or y.min() == y.max():
        return Model(*dictionaries, [0.0] * 8, [0.0] * 4 + [4.0 if len(y) and y.max() else 0.0])
    x = vector(np.array([[r[1], r[2]] for r in got]))
    center, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    return Model(*dictionaries, [*center, *scale], logistic((x - center) / scale, y).tolist())


def score(docs: DataFrame, model: Model, out: str = "score", text: str = "text") -> DataFrame:
    """``docs`` and the calibrated score in ``out`` (0 to 1, higher: label 1 likelier).

    Every chunk of the whole text is compressed with both dictionaries. Null and empty
    texts get the score of a zero difference and size. A column of that name is replaced,
    an empty table stays empty, equal texts get equal scores.
    """
    docs = docs.drop(out)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        let_go()
        m = shared.value
        by = compressors(m.good, m.bad)
        center, w = np.array(m.center), np.array(m.weights)
        for texts in batches:
            x = vector(np.array([features((t or "").encode(), by) for t in texts]).reshape(-1, 2))
            z = ((x - center[:4]) / (center[4:] + (center[4:] == 0))) @ w[:-1] + w[-1]
            yield pd.Series(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    return docs.withColumn(out, apply(F.col(text)))
