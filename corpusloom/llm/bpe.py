"""Byte-level BPE over a whole corpus with a public vocabulary.

Defined results: null and empty texts have no ids; text that looks like a special token is ordinary text. Repeated
rows are encoded each for itself. A column named as the output column is replaced.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: How many pre-tokens a worker remembers before it starts afresh; bounds its memory, not the result.
CACHE = 400_000


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


class RankQueue:
    """A queue of small integers with a position list each; the least is found by find-first-set over three bitmaps."""

    def __init__(self, size: int) -> None:
        self.low = [0] * ((size >> 6) + 1)
        self.mid = [0] * ((size >> 12) + 1)
        self.top = 0
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, position: int) -> None:
        held = self.buckets.get(rank)
        if held is not None:
            held.append(position)
            return
        self.buckets[rank] = [position]
        a, b = rank >> 6, rank >> 12
        self.low[a] |= 1 << (rank & 63)
        self.mid[b] |= 1 << (a & 63)
        self.top |= 1 << b

    def pop(self) -> tuple[int, list[int]] | None:
        """The least rank and its positions from left to right."""
        top = self.top
        if not top:
            return None
        b = (top & -top).bit_length() - 1
        word = self.mid[b]
        a = (b << 6) | ((word & -word).bit_length() - 1)
        bits = self.low[a]
        lowest = bits & -bits
        rank = (a << 6) | (lowest.bit_length() - 1)
        self.low[a] = bits = bits ^ lowest
        if not bits:
            self.mid[b] = word = word & (word - 1)
            if not word:
                self.top = top & (top - 1)
        held = self.buckets.pop(rank)
        if len(held) > 1:
            held.sort()
        return rank, held


class Encoder:
    """Encodes texts; one per Python worker."""

    def __init__(self, path: str, split: str) -> None:
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        size = max(self.ranks.values()) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token
        self.single = [self.ranks[bytes([b])] for b in range(256)]
        self.queue = RankQueue(size)
        self.find = regex.compile(split).findall
        # A space with white space on both sides is the one place where cutting before a space could differ.
        self.unsafe = regex.compile(r"[\s\x1c-\x1f\x85] [\s\x1c-\x1f\x85]").search
        self.known: dict[str, list[int]] = {}
        self.pairs: dict[int, int] = {}

    def _pair(self, a: int, b: int) -> int:
        key = a << 17 | b
        rank = self.pairs.get(key)
        if rank is None:
            if len(self.pairs) > 4 * CACHE:
                self.pairs.clear()
            rank = self.pairs[key] = self.ranks.get(self.bytes_of[a] + self.bytes_of[b], -1)
        return rank

    def merge(self, raw: bytes) -> list[int]:
        """Ids of one pre-token. Every pair waits in the bucket of its rank; entries that a merge made stale are skipped."""
        whole = self.ranks.get(raw)
        if whole is not None:
            return [whole]
        single, pair, queue = self.single, self._pair, self.queue
        ids = [single[b] for b in raw]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        for i in range(n - 1):
            rank = pair(ids[i], ids[i + 1])
            if rank >= 0:
                queue.push(rank, i)
        while (least := queue.pop()) is not None:
            rank, positions = least
            for i in positions:
                j = after[i]
                if ids[i] < 0 or j >= n or pair(ids[i], ids[j]) != rank:
                    continue
                ids[i], ids[j] = rank, -1
                k = after[i] = after[j]
                if k < n:
                    before[k] = i
                    if (r := pair(rank, ids[k])) >= 0:
                        queue.push(r, i)
                h = before[i]
                if h >= 0 and (r := pair(ids[h], rank)) >= 0:
                    queue.push(r, h)
        return [x for x in ids if x >= 0]

    def _word(self, word: str) -> list[int]:
        ids: list[int] = []
        for piece in self.find(word):
            ids += self.merge(piece.encode("utf-8"))
        if len(self.known) >= CACHE:
            self.known.clear()
        if len(word) <= 64:
            self.known[word] = ids
        return ids

    def parts(self, text: str | None) -> list[list[int]]:
        """The ids of a text, in parts."""
        if not text:
            return []
        known, word = self.known, self._word
        # " word" is remembered with its space. Cutting before a space agrees with the split pattern but for the unsafe place.
        if self.unsafe(text):
            words = self.find(text)
        else:
            words = text.replace(" ", "\0 ").split("\0") if "\0" not in text else self.find(text)
        get = known.get
        out = [get(w) for w in words]
        if None in out:
            out = [word(w) if x is None else x for w, x in zip(words, out)]
        return out

    def encode(self, text: str | None) -> list[int]:
        return list(chain.from_iterable(self.parts(text)))

    def count(self, text: str | None) -> int:
        return sum(map(len, self.parts(text)))


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, split: str) -> Encoder:
    if (path, split) not in _encoders:
        _encoders[path, split] = Encoder(path, split)
    return _encoders[path, split]


def _replace(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    keep = [k for k, c in enumerate(batch.schema.names) if c != name]
    fields = [batch.schema.field(k) for k in keep] + [pa.field(name, values.type)]
    return pa.RecordBatch.from_arrays([batch.column(k) for k in keep] + [values], schema=pa.schema(fields))


def _schema(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*(f for f in df.schema.fields if f.name != name), T.StructField(name, kind)])


def encode(df: DataFrame, text_col: str = "text", out: str = "ids", path: str | None = None, split: str | None = None) -> DataFrame:
    """All columns of `df` and `out`: the ids of `text_col`, without special tokens. No shuffle; batches stream through Arrow."""
    path, split = path or vocabulary_path(), split or pattern()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, split)
        for batch in batches:
            flat, offsets = array("i"), [0]
            for text in batch.column(text_col).to_pylist():
                flat.extend(chain.from_iterable(enc.parts(text)))
                offsets.append(len(flat))
            ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(flat, np.int32) if flat else [], pa.int32()))
            yield _replace(batch, out, ids)

    return df.mapInArrow(run, _schema(df, out, T.ArrayType(T.IntegerType())))


def count_tokens(df: DataFrame, text_col: str = "text", out: str = "n_tokens", path: str | None = None, split: str | None = None) -> DataFrame:
    """All columns of `df` and `out`: how many ids `encode` gives; 0 for null and empty texts."""
    path, split = path or vocabulary_path(), split or pattern()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, split)
        for batch in batches:
            yield _replace(batch, out, pa.array(list(map(enc.count, batch.column(text_col).to_pylist())), pa.int64()))

    return df.mapInArrow(run, _schema(df, out, T.LongType()))
