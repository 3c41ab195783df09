"""Best-fit-decreasing packing of token pieces into sequences, exact at any size.

Pieces have integer lengths of at most `capacity`, so the histogram of lengths says all that best
fit needs: at most `capacity` numbers whatever the corpus.  The plan walks lengths downwards; a
segment tree over remaining capacities finds the tightest open bins in logarithmic time, and runs of
equal pieces fill runs of equal bins at once, just as placing them one by one would.  The plan, a
few rows per length, says for the i-th piece of a length its bin and place.  Pieces get their i by
ranks inside salted groups, as many for a length as its count asks for, so that a length which a
third of all rows share is ranked by many tasks.

Null and empty texts: the closing id alone.  Repeated rows and ties of length: any order, each piece
placed once.  Very long texts: cut into pieces of `capacity`; a text's ids are held by one task.  An
empty table: no pieces.  Extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, record

END_ID = 1
#: tie: a number that tells repeated rows of one task apart.
PIECE = "doc_id long, piece int, start long, length int, ids_crc32 long, tie long"
_PIECE = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()), ("ids_crc32", pa.int64()), ("tie", pa.int64())])

# Fixed: the pre-tokenizer's pattern, as in the tokenizer's own file, written for plain Latin text.
_PLAIN_PIECES = r"[A-Za-zªµºÀ-ÖØ-öø-ɏ]+|'s|'t|'re|'ve|'m|'ll|'d|[\d²³¹¼½¾]|(?:[^\w\s]|_)+"
# What is not plain, looked for in lower-cased text: some letters lower to ones outside the plain range.
_NOT_PLAIN = re.compile("[^\t-\r -\x7e\x80-\x84\x86-\u024f]")


def byte_letters() -> list[str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for letters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


class _Words(dict):
    """Word to its ids' bytes; a word that is missing is encoded by the model and kept."""

    def __init__(self, model) -> None:
        self.model, self.letters = model, byte_letters()

    def __missing__(self, word: str) -> bytes:
        spelled = word if word.isascii() else "".join([self.letters[b] for b in word.encode()])
        out = self[word] = array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()
        return out


class Encoder:
    """Token ids of whole texts.  Words are encoded once and kept, `keep` of them at most; texts beyond
    plain Latin script, or that spell a special token, go to the tokenizer whole."""

    def __init__(self, path: str, keep: int = 600_000) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.keep, self.known = keep, _Words(self.tokenizer.model)
        self.pieces = re.compile(_PLAIN_PIECES).findall

    def encode(self, text: str) -> np.ndarray:
        low = text.lower()
        if "<|" in text or _NOT_PLAIN.search(low):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")
        if len(self.known) > self.keep:
            self.known.clear()
        return np.frombuffer(b"".join(map(self.known.__getitem__, self.pieces(low))), dtype="<u4")


def _encoder(path: str) -> Encoder:
    """One encoder per worker process, whichever tasks it runs: kept in a module of its own, for functions travel by value."""
    import sys
    import types

    kept = sys.modules.setdefault("_quirelens_worker", types.ModuleType("_quirelens_worker")).__dict__.setdefault("encoders", {})
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


def _cut(path: str, capacity: int, rows: int = 200):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        own = _encoder(path)
        end = np.array([END_ID], dtype="<u4")
        tie = 0
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                cols: list[list] = [[] for _ in _PIECE]
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    ids = np.concatenate([own.encode(text or ""), end])
                    for k, start in enumerate(range(0, len(ids), capacity)):
                        own_ids = ids[start : start + capacity]
                        for c, v in zip(cols, (doc_id, k, start, len(own_ids), zlib.crc32(own_ids.tobytes()), tie), strict=True):
                            c.append(v)
                        tie += 1
                yield record(_PIECE, cols)

    return run


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 4096) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, tie of every piece of every text."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_cut(tokenizer_path, capacity), PIECE)


class SegmentTree:
    """How many open bins have each remaining capacity; finds the least one that fits."""

    def __init__(self, capacity: int) -> None:
        self.size = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.size)

    def add(self, at: int, n: int) -> None:
        at += self.size
        while at:
            self.tree[at] += n
            at >>= 1

    def first_at_least(self, least: int) -> int:
        """The least capacity >= `least` with an open bin, or -1."""
        at = least + self.size
        if self.tree[at]:
            return least
        while at > 1:
            if not at & 1 and self.tree[at + 1]:
                at += 1
                break
            at >>= 1
        else:
            return -1
        while at < self.size:
            at = 2 * at if self.tree[2 * at] else 2 * at + 1
        return at - self.size


def best_fit_plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first, stop, bin, per_bin, offset): pieces first <= i < stop of a length go to bin
    + (i - first) // per_bin at offset + (i - first) % per_bin * length."""
    tree, open_bins, plan, bins = SegmentTree(capacity), {}, [], 0

    def put(room: int, first: int, n: int) -> None:
        if n and room:
            open_bins.setdefault(room, []).append((first, n))
            tree.add(room, n)

    for length in sorted((x for x, n in counts.items() if n), reverse=True):
        left, at = counts[length], 0
        while left:
            room = tree.first_at_least(length)
            if room < 0:
                room = capacity
                first, n = bins, -(-left // (capacity // length))
                bins += n
            else:
                first, n = open_bins[room].pop()
                tree.add(room, -n)
            per = room // length
            full = min(n, left // per)
            if full:
                plan.append((length, at, at + full * per, first, per, capacity - room))
                put(room - per * length, first, full)
                at, left = at + full * per, left - full * per
            rest = n - full
            if left and rest:  # the last pieces go into one bin, tightest still
                plan.append((length, at, at + left, first + full, per, capacity - room))
                put(room - left * length, first + full, 1)
                full, rest, at, left = full + 1, rest - 1, at + left, 0
            put(room, first + full, rest)
    return plan


def pack(parts: DataFrame, capacity: int = 4096, salt_rows: int = 2_000) -> DataFrame:
    """parts (a written table of `pieces`) with sequence_id and offset."""
    spark = parts.sparkSession
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    plan = best_fit_plan(counts, capacity)
    salts = F.broadcast(spark.createDataFrame([(k, -(-n // salt_rows)) for k, n in counts.items()], "length int, salts long"))  # capacity rows at most
    salted = parts.join(salts, "length").withColumn("salt", F.expr("pmod(xxhash64(doc_id, piece, ids_crc32, tie), salts)")).drop("salts")
    sizes = materialize(salted.groupBy("length", "salt").agg(F.count("*").alias("n")), "sizes")
    before = F.expr("coalesce(sum(n) over (partition by length order by salt rows between unbounded preceding and 1 preceding), 0)")
    base = sizes.select("length", "salt", before.alias("base"))
    rank = F.expr("row_number() over (partition by length, salt order by doc_id, piece, tie)") - 1
    # base has the window's own keys; it grows with the rows, so how it is joined is left to its size
    ranked = salted.withColumn("i", rank).join(base, ["length", "salt"]).withColumn("i", F.col("i") + F.col("base"))
    # the plan: one row per length, a few steps in each (27 at most seen), filtered one after another
    steps = spark.createDataFrame(plan, "length int, first long, stop long, bin long, per long, place long")
    steps = steps.groupBy("length").agg(F.array_sort(F.collect_list(F.struct("first", "stop", "bin", "per", "place"))).alias("steps"))
    placed = ranked.join(F.broadcast(steps), "length")  # capacity rows at most
    step = F.get(F.filter("steps", lambda s: (s["first"] <= F.col("i")) & (F.col("i") < s["stop"])), F.lit(0))
    placed = placed.withColumn("s", step).withColumn("k", F.col("i") - F.col("s.first"))
    return placed.select(
        *parts.columns,
        (F.col("s.bin") + F.expr("k div s.per")).alias("sequence_id"),
        (F.col("s.place") + F.expr("k % s.per") * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 4096) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every text."""
    return pack(materialize(pieces(docs, tokenizer_path, capacity), "pieces"), capacity).select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset")
