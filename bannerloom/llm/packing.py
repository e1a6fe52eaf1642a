"""Packing: repeat counts of window-filling length combinations by non-negative least squares."""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from bannerloom.llm.common import NUMBERS, Memory, kept, let_go, number, small_batches, stage, with_rank

#: Combining diacritical marks.
MARKS = re.compile("[\u0300-\u036f\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff\ufe20-\ufe2f]")
#: Small letters of ASCII and Latin-1, and words of these and other printable ASCII but capitals: no normalisation changes them.
LETTERS = "a-zß-öø-ÿ"
PLAIN = re.compile(f"[!-@\\[-`{{-~{LETTERS}]+").fullmatch
PIECE = ["start", "length", "ids", "doc_tokens", "sequence_id", "offset"]


def piece_pattern(tokenizer: str) -> str | None:
    """The pattern that splits ``PLAIN`` words into pieces, if each is encoded for itself by byte-level BPE; None if that is not sure.

    ``tokenizer`` is its JSON. Classes of letters and digits become those of plain words.
    """
    about = json.loads(tokenizer)
    normal = about["normalizer"] or {"type": "Sequence", "normalizers": []}
    harmless = normal["type"] == "Sequence" and all(
        n["type"] in ("NFC", "Lowercase") or (n["type"] == "Replace" and n["pattern"] == {"Regex": "\\s+"}) for n in normal["normalizers"]
    )
    steps = (about["pre_tokenizer"] or {}).get("pretokenizers", [])
    if not harmless or [s["type"] for s in steps] != ["Split", "ByteLevel"] or about["model"]["type"] != "BPE":
        return None
    split, by_bytes = steps
    alone = split["behavior"] == "Removed" and split["invert"] and not by_bytes["add_prefix_space"] and not by_bytes["use_regex"]
    pattern = split["pattern"].get("Regex", "\\p").replace("\\p{L}", LETTERS).replace("\\p{N}", "0-9")
    return pattern if alone and "\\p" not in pattern else None


def byte_letters() -> dict[int, int]:
    """For byte-level BPE, the letter of each byte that is not printable in Latin-1: those from 256 on, in turn."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    return {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in shown)}


@kept
@lru_cache(maxsize=1)
def word_encoder(path: str):
    """(text, end) -> the ids as 16-bit numbers, or 32-bit ones for a vocabulary beyond that, and their type.

    White space ends every token of this tokenizer, so words are encoded once and
    remembered, and so are the pieces that its pattern cuts plain words into. It
    lower-cases, so A-Z is lower-cased before, but not in texts where that may make a
    difference: those with combining marks, with which capitals and small letters may
    compose otherwise, and with the start of a special token's name, as such names are
    found before. A worker keeps its memory from task to task (110 MB), until one calls ``let_go``.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    code = "H" if tokenizer.get_vocab_size() <= 1 << 16 else "I"
    starts = {t.content[:2] for t in tokenizer.get_added_tokens_decoder().values()}
    pattern = piece_pattern(tokenizer.to_str())
    split = re.compile(pattern).findall if pattern else None
    tokens, shown = tokenizer.model.tokenize, byte_letters()

    def alone(data: bytes) -> bytes:
        return array(code, tokenizer.encode(data.decode(), add_special_tokens=False).ids).tobytes()

    def plain_piece(text: str) -> bytes:
        letters = text if text.isascii() else text.encode().decode("latin-1").translate(shown)
        return array(code, [t.id for t in tokens(letters)]).tobytes()

    piece = Memory(plain_piece).__getitem__

    def whole(data: bytes) -> bytes:
        word = data.decode()
        if not (split and PLAIN(word)):
            return alone(data)
        parts = split(word)
        return b"".join(map(piece, parts)) if len(parts) > 1 else b"".join(map(plain_piece, parts))  # remembered once, as a word

    lowered, as_is = Memory(whole).__getitem__, Memory(alone).__getitem__

    def encode(text: str, end: int) -> bytes:
        data = text.encode()
        exact = any(s in text for s in starts) or (not text.isascii() and MARKS.search(text))
        found = map(as_is, data.split()) if exact else map(lowered, data.lower().split())
        return b"".join([*found, array(code, [end]).tobytes()])

    return encode, np.dtype(code)


def tokenize(docs: DataFrame, path: str, window: int, end: int) -> DataFrame:
    """All columns but ``text``, and the ids as numbers of 16 or 32 bits, their count, the
    whole windows in them, those of the task's rows before, and the rest, ``numbered`` by it."""
    rest = docs.drop("text")
    made = T.StructType(
        [*rest.schema.fields, T.StructField("__ids", T.BinaryType()), T.StructField("doc_tokens", T.LongType()),
         T.StructField("__full", T.LongType()), T.StructField("__full_at", T.LongType()), T.StructField("__rest", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go(but=word_encoder)
        (encode, kind), done = word_encoder(path), 0
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                ids = [encode(t or "", end) for t in batch.column(batch.num_columns - 1).to_pylist()]
                n = np.array([len(x) // kind.itemsize for x in ids], np.int64)
                full = n // window
                at_full = done + np.cumsum(full) - full
                done += int(full.sum())
                more = [pa.array(ids, pa.binary()), *map(pa.array, (n, full, at_full, n % window))]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *more], made.names)

    schema = T.StructType([*made.fields, *NUMBERS])
    return docs.select(*rest.columns, F.col("text").cast("string").alias("__text")).mapInArrow(lambda batches: number(run(batches), "__rest"), schema)


def combinations(window: int) -> np.ndarray:
    """Shallow combinations of lengths that fill a window: pairs, and triples of an equal or a halved pair.

    Three lengths a row, 0 where there are two. About 2 x ``window`` rows.
    """
    a = np.arange(1, window // 2 + 1)
    pairs = np.stack([a, window - a, 0 * a], axis=1)
    b = np.arange(1, (window - 1) // 2 + 1)
    equal = np.stack([b, b, window - 2 * b], axis=1)
    c = np.arange(1, window - 1)
    halved = np.stack([c, (window - c) // 2, window - c - (window - c) // 2], axis=1)
    return np.unique(np.sort(np.concatenate([pairs, equal, halved]), axis=1), axis=0)


def solve(combos: np.ndarray, histogram: np.ndarray, steps: int = 300) -> np.ndarray:
    """x >= 0 that nearly minimises |A x - histogram|, A the lengths' counts in each combination.

    Multiplicative steps keep x non-negative and only ever lower the error.
    """

    def up(x: np.ndarray) -> np.ndarray:  # A x
        out = np.zeros(len(histogram))
        for k in range(3):
            out += np.bincount(combos[:, k], weights=x, minlength=len(histogram))
        out[0] = 0.0
        return out

    def down(y: np.ndarray) -> np.ndarray:  # A' y
        return sum(np.where(combos[:, k] > 0, y[combos[:, k]], 0.0) for k in range(3))

    x, goal = np.ones(len(combos)), down(histogram)
    for _ in range(steps):
        x *= goal / np.maximum(down(up(x)), 1e-12)
    return x


def filling(left: np.ndarray, window: int, longest: int) -> list[int] | None:
    """Lengths that are left and fill the window, ``longest`` first.

    Greedy: one or two lengths that fill the gap, else the longest one that fits, and so on.
    """
    left, parts, gap = left.copy(), [longest], window - longest
    left[longest] -= 1
    while True:
        if left[gap]:
            return [*parts, gap]
        b = np.arange(1, gap // 2 + 1)
        often = np.minimum(left[b], left[gap - b])
        if gap % 2 == 0 and len(b):
            often[-1] = left[gap // 2] // 2
        if often.max(initial=0):
            return [*parts, int(b[often.argmax()]), int(gap - b[often.argmax()])]
        fits = np.flatnonzero(left[:gap])
        if not len(fits):
            return None
        parts.append(int(fits[-1]))
        left[parts[-1]] -= 1
        gap -= parts[-1]


def plan(counts: dict[int, int], window: int) -> tuple[list[tuple[int, int, int, int, int]], list[tuple[int, int, int]], int]:
    """Where the rests of each length go, from their histogram.

    The rounded solution of the least squares problem comes first; the residuals are packed
    greedily, the longest first.
    Returns slots (length, first rank, end rank, first sequence, offset), leftovers
    (length, first rank, place of the first on the line of leftovers), and the number of
    sequences of the slots. Both lists are bounded by the window, not by the input.
    """
    left = np.zeros(window + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    total, slots, sequence = left.copy(), [], 0
    combos = combinations(window)
    combos = combos[((combos == 0) | (left[combos] > 0)).all(axis=1)]

    def take(parts: list[int], n: int) -> None:
        """``n`` sequences of these lengths."""
        nonlocal sequence
        offset = 0
        for length in parts:
            lo = int(total[length] - left[length])
            slots.append((length, lo, lo + n, sequence, offset))
            left[length] -= n
            offset += length
        sequence += n

    def possible(parts: list[int]) -> int:
        return min(int(left[p]) // parts.count(p) for p in parts)

    if len(combos):
        x = solve(combos, left.astype(float))
        for k in np.argsort(-x, kind="stable"):
            parts = combos[k][combos[k] > 0].tolist()
            if n := min(int(x[k] + 0.5), possible(parts)):
                take(parts, n)
    # greedily what is left, from the longest rest on
    for length in range(window - 1, 0, -1):
        while left[length] and (parts := filling(left, window, length)):
            take(parts, possible(parts))
    rest, place = [], 0
    for length in range(window, 0, -1):  # longest first
        if left[length]:
            rest.append((length, int(total[length] - left[length]), place))
            place += length * int(left[length])
    return slots, rest, sequence


def rows(spark, values: Sequence[tuple], names: str) -> DataFrame:
    """By Arrow: rows of Python objects would have each executor start Python workers of their own."""
    columns = np.array(values, np.int64).reshape(-1, len(names.split())).T
    return spark.createDataFrame(pa.table([pa.array(c, pa.int64()) for c in columns], names.split()))


def pack(docs: DataFrame, tokenizer: str, window: int = 2048, end: int = 1) -> DataFrame:
    """One row for each piece: the columns of ``docs`` but ``text``, and ``PIECE``.

    A text becomes its ids and ``end``. Whole windows are sequences of their own. The
    rests are packed by the plan: combinations that fill a window without padding, solved
    for and then greedy; the few that no combination is left for lie end to end, longest
    first, cut where a window is full. Only the very last
    sequence is not full. ``ids`` holds little-endian 32-bit numbers. Only the histogram
    of the rests (as many numbers as the window is long) reaches the driver.

    Null and empty texts have one id, ``end``. Repeated rows and null ids are documents
    of their own. Other columns stay, those named like a piece's are replaced. An empty
    table gives no pieces. The session gets ``small_batches``.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.drop(*PIECE)
    table = stage(tokenize(docs, tokenizer, window, end), "tokens")
    counts = {r[0]: r[1] for r in table.where("__rest > 0").groupBy("__rest").count().collect()}
    slots, leftovers, sequences = plan(counts, window)
    taken = sum(length * (counts[length] - lo) for length, lo, _ in leftovers)
    first_full = sequences + -(-taken // window)

    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each task
    parts = table.groupBy("__part").agg(F.sum("__full").alias("__n"))
    parts = parts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__full_before"))
    slot = rows(spark, slots, "__len __lo __hi __sequence __offset")
    rest = rows(spark, leftovers, "__rlen __rlo __place")
    ranked = with_rank(table, "__rest").join(parts, "__part")
    placed = ranked.join(
        F.broadcast(slot), (F.col("__rest") == F.col("__len")) & (F.col("__rank") >= F.col("__lo")) & (F.col("__rank") < F.col("__hi")), "left"
    ).join(F.broadcast(rest), (F.col("__rest") == F.col("__rlen")) & (F.col("__rank") >= F.col("__rlo")), "left")
    kept = [c for c in docs.columns if c != "text"]
    # multiplied here: as literals the two would be numbers of 32 bits, and so would their product
    line = F.lit(sequences * window) + F.col("__place") + (F.col("__rank") - F.col("__rlo")) * F.col("__rest")
    at = F.coalesce((F.col("__sequence") + F.col("__rank") - F.col("__lo")) * window + F.col("__offset"), line, F.lit(0))
    full = F.lit(first_full) + F.col("__full_before") + F.col("__full_at")
    return cut(placed.select(*kept, "__ids", "doc_tokens", full.alias("__first"), at.alias("__at")), kept, window)


def cut(placed: DataFrame, kept: list[str], window: int) -> DataFrame:
    """The pieces of each document: its whole windows from sequence ``__first`` on, the rest at ``__at``."""
    kinds = {"start": T.LongType(), "length": T.LongType(), "ids": T.BinaryType(), "doc_tokens": T.LongType(),
             "sequence_id": T.LongType(), "offset": T.LongType()}
    schema = T.StructType([*[placed.schema[c] for c in kept], *[T.StructField(c, kinds[c]) for c in PIECE]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()  # the ids are made
        for whole in batches:
            for begin in range(0, whole.num_rows, 500):
                batch = whole.slice(begin, 500)
                ids, n, first, at = (batch.column(len(kept) + k).to_pylist() for k in range(4))
                of, out = [], []
                for i in range(batch.num_rows):
                    full, rest = divmod(n[i], window)
                    spans = [(k * window, window, (first[i] + k) * window) for k in range(full)]
                    if rest:
                        head = min(rest, window - at[i] % window)
                        spans.append((full * window, head, at[i]))
                        if head < rest:
                            spans.append((full * window + head, rest - head, at[i] + head))
                    of += [i] * len(spans)
                    kind = np.dtype(f"u{len(ids[i]) // n[i]}")
                    own = np.frombuffer(ids[i], kind).astype("<u4")
                    out += [(s, k, own[s : s + k].tobytes(), n[i], p // window, p % window) for s, k, p in spans]
                columns = [c.take(pa.array(of, pa.int64())) for c in batch.columns[: len(kept)]]
                values = zip(*out) if out else [()] * len(PIECE)
                columns += [pa.array(v, pa.binary() if name == "ids" else pa.int64()) for name, v in zip(PIECE, values)]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return placed.mapInArrow(run, schema)
