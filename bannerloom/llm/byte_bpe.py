"""Byte-level BPE: whole pre-tokens by a minimal perfect hash, the others by a heap over linked bytes."""

from __future__ import annotations

import base64
import heapq
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest as digest

from bannerloom.llm.common import Memory

#: Rows whose ids a task holds at a time.
ROWS = 200
CHUNK = re.compile(r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
OTHER_WHITE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
def read_ranks(path: str) -> list[bytes]:
    """Tokens by rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as file:
        pairs = [line.split() for line in file if line.strip()]
    tokens = {int(rank): base64.b64decode(token) for token, rank in pairs}
    return [tokens[i] for i in range(len(tokens))]


class PerfectHash:
    """Token -> rank without collisions or free slots: each bucket of keys has the hash seed that spreads it, largest first."""

    def __init__(self, tokens: list[bytes], per_bucket: int = 2):
        n = max(1, len(tokens))
        self.tokens, self.n, self.buckets = tokens, n, max(1, n // per_bucket)
        self.seed = [0] * self.buckets
        self.rank = [-1] * n
        groups: dict[int, list[int]] = {}
        for i, token in enumerate(tokens):
            groups.setdefault(digest(token) % self.buckets, []).append(i)
        spare = iter(())
        for bucket, keys in sorted(groups.items(), key=lambda x: -len(x[1])):
            if len(keys) > 1:
                seed = 0
                while True:
                    seed += 1
                    slots = {digest(tokens[i], seed) % n for i in keys}
                    if len(slots) == len(keys) and all(self.rank[s] < 0 for s in slots):
                        break
                for i in keys:
                    self.rank[digest(tokens[i], seed) % n] = i
                self.seed[bucket] = seed
                continue
            slot = next(spare, None)  # one key takes any free slot, written as a negative seed
            if slot is None:
                spare = iter([s for s, r in enumerate(self.rank) if r < 0])
                slot = next(spare)
            self.seed[bucket], self.rank[slot] = -1 - slot, keys[0]

    def find(self, token: bytes) -> int:
        """The rank, or -1."""
        seed = self.seed[digest(token) % self.buckets]
        rank = self.rank[-1 - seed if seed < 0 else digest(token, seed) % self.n]
        return rank if rank >= 0 and self.tokens[rank] == token else -1


class Codec:
    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens = tokens
        self.table = PerfectHash(tokens)
        self.ranks = {token: i for i, token in enumerate(tokens)}  # of the pairs that merges try
        self.pattern = pattern
        self._encode = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_encode": None}

    def merge(self, token: bytes) -> list[int]:
        """Ids of a pre-token that is no token: neighbours merge by lowest rank, then from the left.

        The pieces are a linked list over the bytes. The heap has a number for each pair:
        its rank, where it starts and where it ends.
        """
        rank = self.ranks.get
        n = len(token)
        width = n.bit_length()
        mask = (1 << width) - 1
        end = list(range(1, n + 1))  # of the piece that starts at i; 0 when merged into the one before
        before = list(range(-1, n))
        heap = [
            r << 2 * width | i << width | i + 2 for i in range(n - 1) if (r := rank(token[i : i + 2])) is not None
        ]
        heapq.heapify(heap)
        while heap:
            pair = heapq.heappop(heap)
            i, stop = pair >> width & mask, pair & mask
            mid = end[i]
            if not mid or mid >= n or end[mid] != stop:
                continue  # one of the two has changed since
            end[i], end[mid] = stop, 0
            if stop < n:
                before[stop] = i
                if (r := rank(token[i : end[stop]])) is not None:
                    heapq.heappush(heap, r << 2 * width | i << width | end[stop])
            if (j := before[i]) >= 0 and (r := rank(token[j:stop])) is not None:
                heapq.heappush(heap, r << 2 * width | j << width | stop)
        out, i = [], 0
        while i < n:
            out.append(rank(token[i : end[i]]))
            i = end[i]
        return out

    def pretoken(self, text: str) -> bytes:
        token = text.encode()
        rank = self.table.find(token)
        return array("i", [rank] if rank >= 0 else self.merge(token)).tobytes()

    def encoder(self):
        """A function text -> ids that remembers frequent chunks and pre-tokens, one for each worker.

        A chunk is white space and what follows up to the next white space: no
        pre-token goes across its end. That holds for the ASCII white space of
        ``CHUNK``; a text with other white space is split by the pattern at once.
        """
        if self._encode:
            return self._encode
        split = regex.compile(self.pattern).findall
        piece = Memory(self.pretoken).__getitem__
        chunk = Memory(lambda text: b"".join(map(piece, split(text)))).__getitem__

        def encode(text: str) -> np.ndarray:
            if not text.isascii() and OTHER_WHITE.search(text):
                return np.frombuffer(b"".join(map(piece, split(text))), np.int32)
            return np.frombuffer(b"".join(map(chunk, CHUNK.findall(text))), np.int32)

        self._encode = encode
        return encode


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids", keep_text: bool = True) -> DataFrame:
    """``docs`` (without ``text`` if not ``keep_text``) and the token ids of the whole text in ``ids``.

    Null texts count as empty and get no ids, empty tables stay empty, a column of the
    same name is replaced, very long pre-tokens take n log n steps. The vocabulary (a
    file of bounded size) is broadcast; texts never leave their task, which holds a few
    hundred rows' ids at a time.
    """
    docs = docs.drop(ids)
    kept = [c for c in docs.columns if keep_text or c != text]
    codec = docs.sparkSession.sparkContext.broadcast(Codec(read_ranks(ranks_path), pattern))
    schema = T.StructType([*[docs.schema[c] for c in kept], T.StructField(ids, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = codec.value.encoder()
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                found = [apply(t or "") for t in batch.column(batch.num_columns - 1).to_pylist()]
                ends = pa.array(np.cumsum([0, *map(len, found)]).astype(np.int32))
                rows = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(found)))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], rows], schema.names)

    return docs.select(*kept, F.col(text).cast("string").alias("__text")).mapInArrow(run, schema)


def decode(docs: DataFrame, ranks_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the bytes of ``ids`` in the column ``out``; null ids give empty bytes."""
    docs = docs.drop(out)
    tokens = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pa.array(tokens.value, pa.binary())
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                rows = batch.column(batch.schema.get_field_index(ids))
                first, end = rows.offsets[0].as_py(), rows.offsets[-1].as_py()
                found = pa.ListArray.from_arrays(pc.subtract(rows.offsets, first), vocabulary.take(rows.values.slice(first, end - first)))
                data = pc.binary_join(found, b"")
                yield pa.RecordBatch.from_arrays([*batch.columns, pc.fill_null(data, b"")], schema.names)

    return docs.mapInArrow(run, schema)
