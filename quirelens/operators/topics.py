"""Which of many topics stand in a text: all topics at once, in one pass over the text's bytes.

A topic is hit when its part before the first slash is in the text (the whole topic then need not be looked for:
its part is in it).  Of each part one eight-byte gram is the anchor, the rarest in what a task reads first.  The text's
grams, one a byte, are looked up in a bitmap and then among the sorted anchors, and only where an anchor stands
are the part's bytes compared, eight at a time.  Parts of less than eight bytes have anchors of four, those of up to
three bytes are anchors by themselves.  The time of a text grows with its length and with its hits, hardly with the
number of topics.

Null and empty texts have no hits; topics with an empty part hit every other text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Bytes of topics in one broadcast; more of them are several broadcasts, one after the other.
BLOCK_BYTES = 32 << 20
_SLICE = 4 << 20
_BITS = 22


def _words(data: np.ndarray, size: int) -> np.ndarray:
    """The little-endian number of `size` bytes at every place; data has 8 spare bytes."""
    kind = {1: "<u1", 2: "<u2", 4: "<u4", 8: "<u8"}[size]
    return np.ndarray((len(data) - 7,), dtype=kind, buffer=data.data, strides=(1,))


class Matcher:
    """Parts of topics as bytes, and their anchors.  `first` is the number of the first topic."""

    def __init__(self, topics: list[str], first: int = 0) -> None:
        parts: dict[bytes, list[int]] = {}
        for i, t in enumerate(topics, first):
            parts.setdefault(t.partition("/")[0].encode("utf-8", "surrogatepass"), []).append(i)
        self.always = parts.pop(b"", [])
        self.parts = list(parts)
        self.topics = [np.array(v, dtype=np.int32) for v in parts.values()]
        self.sizes = np.array([len(p) for p in self.parts], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(self.parts) + bytes(8), dtype=np.uint8)
        self.tables: list[tuple] | None = None

    def learn(self, text: np.ndarray) -> None:
        """Chooses the anchors: of each part the gram that is rarest in `text`, which has 8 spare bytes (ties: the first)."""
        self.tables = []
        for size in (1, 2, 3):
            own = np.flatnonzero(self.sizes == size)
            if len(own):
                self.tables.append(self._table(self._grams(self.data, size)[self.starts[own]], own, np.zeros(len(own), np.int64), size))
        for size, own in ((4, np.flatnonzero((self.sizes >= 4) & (self.sizes < 8))), (8, np.flatnonzero(self.sizes >= 8))):
            if len(own):
                places = self.sizes[own] - size + 1
                part = np.repeat(np.arange(len(own)), places)
                offset = np.arange(len(part)) - np.repeat(np.cumsum(places) - places, places)
                gram = self._grams(self.data, size)[self.starts[own][part] + offset]
                keys, at = np.unique(gram, return_inverse=True)
                there = self._grams(text, size)
                found = np.minimum(np.searchsorted(keys, there), len(keys) - 1)
                seen = np.bincount(found[keys[found] == there], minlength=len(keys))
                order = np.lexsort((offset, seen[at], part))
                best = order[np.concatenate([[True], np.diff(part[order]) != 0])]
                self.tables.append(self._table(gram[best], own, offset[best], size))

    @staticmethod
    def _grams(data: np.ndarray, size: int) -> np.ndarray:
        grams = _words(data, 4 if size == 3 else size)
        return grams & np.uint32(0xFFFFFF) if size == 3 else grams

    @staticmethod
    def _slot(gram: np.ndarray) -> np.ndarray:
        if gram.dtype.itemsize == 8:
            return (gram * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _BITS)
        return (gram.astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(32 - _BITS)

    def _table(self, gram: np.ndarray, part: np.ndarray, offset: np.ndarray, size: int) -> tuple:
        order = np.argsort(gram, kind="stable")
        keys, first = np.unique(gram[order], return_index=True)
        bitmap = np.zeros(1 << _BITS, dtype=bool)
        bitmap[self._slot(keys)] = True
        return size, keys, np.append(first, len(gram)), part[order], offset[order], bitmap

    def hits(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, part) of all parts in the rows data[bounds[i] : bounds[i + 1]], each once; data has 8 spare bytes."""
        rows, found = [], []
        long_words, own_words = _words(data, 8), _words(self.data, 8)
        for size, keys, first, parts, offsets, bitmap in self.tables:
            gram = self._grams(data, size)[: bounds[-1]]
            at = np.flatnonzero(bitmap[self._slot(gram)])
            key = np.minimum(np.searchsorted(keys, gram[at]), len(keys) - 1)
            real = keys[key] == gram[at]
            at, key = at[real], key[real]
            n = first[key + 1] - first[key]
            entry = np.arange(n.sum()) + np.repeat(first[key] - np.cumsum(n) + n, n)
            part, start = parts[entry], np.repeat(at, n) - offsets[entry]
            row = np.searchsorted(bounds, np.repeat(at, n), "right") - 1
            inside = (start >= bounds[row]) & (start + self.sizes[part] <= bounds[row + 1])
            part, start, row = part[inside], start[inside], row[inside]
            # one place of a part in a row is enough, but any of them may be a false one: compare bytes first
            for k in range(0, int(self.sizes[part].max(initial=0)), 8):
                left = np.clip(self.sizes[part] - k, 0, 8).astype(np.uint64)
                mask = np.where(left >= 8, np.uint64(2**64 - 1), (np.uint64(1) << (np.uint64(8) * (left % np.uint64(8)))) - np.uint64(1))
                where = np.minimum(start + k, len(long_words) - 1)
                same = ((long_words[where] ^ own_words[np.minimum(self.starts[part] + k, len(own_words) - 1)]) & mask) == 0
                part, start, row = part[same], start[same], row[same]
            pair = np.unique(row * len(self.parts) + part)
            rows.append(pair // len(self.parts))
            found.append(pair % len(self.parts))
        if not rows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(rows), np.concatenate(found)

    def match(self, texts: pa.Array) -> list[list[int]]:
        """Numbers of the topics in each text, in order."""
        texts = texts.cast(pa.large_string())
        out: list[list[int]] = [[] for _ in range(len(texts))]
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        whole = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
        first = 0
        while first < len(texts):
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + _SLICE, "right")) - 1)
            bounds = offsets[first : last + 1] - offsets[first]
            data = np.concatenate([whole[offsets[first] : offsets[last]], np.zeros(8, np.uint8)])
            if self.tables is None:
                self.learn(data)
            for row, part in zip(*self.hits(data, bounds), strict=True):
                out[first + row] += self.topics[part].tolist()
            first = last
        for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
            if b > a and texts[i].is_valid:
                out[i] = sorted(out[i] + self.always)
            else:
                out[i] = []
        return out


def blocks(topics: list[str], most: int | None = None) -> list[tuple[int, int]]:
    """Runs of topics of `most` bytes or so."""
    most = BLOCK_BYTES if most is None else most
    out, first, size = [], 0, 0
    for i, t in enumerate(topics):
        if size > most:
            out.append((first, i))
            first, size = i, 0
        size += len(t.encode("utf-8", "surrogatepass")) + 16
    return [*out, (first, len(topics))]


def numbers_in(spark: SparkSession, text: Column, topics: list[str]) -> Column:
    """The numbers (from 0) of the topics in a text, as a sorted array."""

    def column(first: int, last: int) -> Column:
        shared = spark.sparkContext.broadcast(Matcher(topics[first:last], first))

        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            own = shared.value
            for batch in batches:
                yield pa.array(own.match(batch), type=pa.list_(pa.int32()))

        run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
        return F.arrow_udf(run, "array<int>")(text)

    found = [column(a, b) for a, b in blocks(topics)]
    return found[0] if len(found) == 1 else F.concat(*found)


def topics_in(spark: SparkSession, text: Column, topics: list[str]) -> Column:
    """The topics in a text, in the order of `topics`."""
    names = spark.sparkContext.broadcast(np.array(topics, dtype=object))

    def name(numbers: pa.Array) -> pa.Array:
        own = names.value
        return pa.array([None if x is None else own[x].tolist() for x in numbers.to_pylist()], type=pa.list_(pa.string()))

    name.__annotations__ = {"numbers": pa.Array, "return": pa.Array}
    return F.arrow_udf(name, "array<string>")(numbers_in(spark, text, topics))
