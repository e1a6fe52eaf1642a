"""Grouping of spelling variants: an asymmetric join of chunks with positional grams.

Of two words that differ by one edit the longer one (either, if they are equally long)
gives chunks, the other one grams at the places where such chunks can be found. A word is
cut into two disjoint chunks; one edit leaves one of them as it is, in its place or one
letter before it. A short chunk can be shared by a large part of all words, so its key is
made longer by the same rule: the rest of the word, which has the edit, is cut into two
disjoint chunks, one of which is left as it is, and so on until two letters are left. The
key is all that is left as it is. So no key has more words than there are fillings of two
letters, whatever the vocabulary. (Of words with over 64 letters a 32nd part is left, so
that the keys of a word grow with its length and not with its square.)
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bannerloom.llm.common import stage
from bannerloom.llm.lm_score import mix

#: Letters of a run, A-Z lower-cased.
LETTERS = "[a-zÀ-ÿ]"
#: Letters in which two words of one key may differ, and the most keys of a long word.
HOLE, MOST_KEYS = 2, 32
#: Different words that a task counts before it passes its counts on, and letters it takes at a time.
COUNTED, TAKEN = 300_000, 4_000_000


def runs(docs: DataFrame, noise: int, least: int) -> DataFrame:
    """(word, n): the words of all texts with ``least`` letters or more, with counts of parts of the rows.

    Every ``noise``-th run, by the crc32 of ``<doc_id>:<run>``, loses a letter (none if 0).
    """
    wanted = re.compile(f"{LETTERS}{{{least},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have: Counter[str] = Counter()

        def counts() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(have), pa.string()), pa.array(list(have.values()), pa.int64())], ["word", "n"])
            have.clear()
            return out

        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                found = Counter(wanted.findall((text.as_py() or "").encode().lower().decode()))
                start = zlib.crc32(f"{doc.as_py() or ''}:".encode())
                for word, n in found.items():
                    if noise:
                        h = zlib.crc32(word.encode(), start)
                        if h % noise == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < least:
                                continue
                    have[word] += n
                if len(have) >= COUNTED:
                    yield counts()
        if have:
            yield counts()

    return docs.select(F.col("doc_id").cast("string"), F.col("text").cast("string")).mapInArrow(run, "word string, n long")


def keys(words: np.ndarray, longer: int) -> Iterator[tuple[int, np.ndarray]]:
    """(place, key) for words of one length, a row of code points each, ``longer`` letters shorter than their partners.

    What stands before the place is at the same place in the partner, what stands behind it
    ``longer`` letters further on.
    """
    k, m = words.shape
    n = m + longer
    with np.errstate(over="ignore"):
        letters = mix(words.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        powers = np.full(n, np.uint64(0x9FB21C651E98DF25)).cumprod(dtype=np.uint64)
        none = np.zeros((k, 1), np.uint64)
        before = np.hstack([none, np.cumsum(letters * powers[:m], axis=1, dtype=np.uint64)])
        behind = np.hstack([none, np.cumsum(letters[:, ::-1] * powers[:m], axis=1, dtype=np.uint64)])
        step = max(HOLE, -(-n // MOST_KEYS))
        for lo in range(0, n, step):
            hi = min(lo + step, n)
            place = mix(np.array([n * 0x1_0000_0001 + lo], np.uint64))
            yield lo, mix(before[:, lo] + mix(behind[:, n - hi] + place)).view(np.int64)


def keyed(words: DataFrame, shorter: list[int]) -> DataFrame:
    """(key, place, word, n) for (word, n): the keys with partners longer by each of ``shorter`` letters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = pc.utf8_length(batch.column(0)).to_numpy(zero_copy_only=False)
            for m in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == m)
                size = max(1, TAKEN // (m * min(m, MOST_KEYS)))
                for at in range(0, len(rows), size):
                    part = batch.take(pa.array(rows[at : at + size]))
                    letters = np.frombuffer("".join(part.column(0).to_pylist()).encode("utf-32-le"), np.uint32).reshape(-1, m)
                    for longer in shorter:
                        places, found = zip(*keys(letters, longer))
                        again = part.take(pa.array(np.tile(np.arange(len(letters)), len(places))))
                        columns = [pa.array(np.concatenate(found)), pa.array(np.repeat(np.array(places, np.int32), len(letters))), *again.columns]
                        yield pa.RecordBatch.from_arrays(columns, ["key", "place", "word", "n"])

    return words.mapInArrow(run, "key long, place int, word string, n long")


def near(words: DataFrame) -> DataFrame:
    """(word, other, other_n): all words that differ by exactly one inserted, deleted or replaced letter, both ways."""
    chunks = keyed(words, [0]).toDF("key", "place", "a", "a_n")
    grams = keyed(words, [0, 1]).toDF("key", "gram_place", "b", "b_n")
    # a letter of a run of equal letters can be missing at several places: only the first counts
    earlier = F.expr("length(a) > length(b) AND place > 0 AND concat(substring(a, 1, place - 1), substring(a, place + 1)) = b")
    pairs = chunks.join(
        grams,
        (chunks["key"] == grams["key"]) & (F.col("place") == F.col("gram_place")) & (F.levenshtein("a", "b", 1) == 1) & ~earlier,
    )
    both = F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")),
                   F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("other_n")))
    one = F.array(both[0])
    # equally long words meet twice, as chunks of either
    return pairs.select(F.explode(F.when(F.expr("length(a) = length(b)"), one).otherwise(both)).alias("x")).select("x.*")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last word that the forms (word, form) lead to. A form is far more frequent than its word, so none leads back."""
    now = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        nexts = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = stage(now.join(nexts, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if after.where("moved").isEmpty():
            return after.select("word", "root")
        now = after.select("word", "root")


def variants(docs: DataFrame, noise: int = 0, least: int = 7, twice: int = 2, times: int = 10) -> DataFrame:
    """(word, n, n_near, form, form_n, root): a row for each word of ``least`` letters or more found ``twice`` or more.

    Words are the longest runs of A-Z, a-z and U+00C0 to U+00FF in the whole texts, A-Z
    lower-cased; ``noise`` takes a letter from every ``noise``-th run (see ``runs``).
    ``n_near`` words are one inserted, deleted or replaced letter away. ``form`` is the most
    frequent of them (of equally frequent ones the first in the order of code points) if it
    is found ``times`` times as often as the word or more, else null, and ``root`` the last
    that forms lead to, the word itself without a form. ``times`` is 2 or more.

    Null and empty texts have no words; a null doc_id counts as an empty one in the crc32.
    Repeated rows and ids count as often as they occur. Words of any length are compared
    whole, in proportion to their length. Only ``doc_id`` and ``text`` are read, so other
    columns may have any names; an empty table gives an empty one.
    """
    words = stage(runs(docs, noise, least).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= twice), "words")
    order = F.struct((-F.col("other_n")).alias("rank"), F.col("other"))
    best = near(words).groupBy("word").agg(F.count("*").alias("n_near"), F.min(order).alias("best"))
    rows = words.join(best, "word", "left")
    is_form = -F.col("best.rank") >= times * F.col("n")
    named = stage(
        rows.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(is_form, F.col("best.other")).alias("form"), F.when(is_form, -F.col("best.rank")).alias("form_n"),
        ),
        "forms",
    )
    last = roots(named.where("form is not null"))
    return named.join(last, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
