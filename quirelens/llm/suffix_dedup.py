"""Exact removal of repeated passages (byte strings of 200 and more) by bucket-pointer refinement.

A corpus of suffixes is never sorted as a whole.  Buckets start as q-grams and are refined, by the
bucket identifiers of later offsets, only where a bucket still holds more than one text:

1. Every window of `length` bytes has one anchor: its least q-gram (q = length/4 rounded up, leftmost on ties by
   hash).  Equal windows have equal anchors at equal offsets, so q-gram buckets of anchors hold all
   that can repeat.  About one byte in 75 is an anchor.  Buckets of one anchor go.
2. First pass, over all partitions: buckets are sorted on the identifiers of the q-gram buckets at
   the offsets that make up the anchor's context (all windows of the anchor).  Identifiers are those
   of the one scan: the depth doubles by joining two of them, and twice the depth reuses what the
   step before has made.  Contexts that stay together are equal as a whole and go on as one.
3. Second pass: buckets are sorted on the identifiers of the 3/8 length before, and after, the
   anchor; every window holds one of the two.  Buckets of one go again, and those of copies alone.
4. Buckets too large for one task are refined further by the same means, again over all partitions:
   the range of places that a window's anchor can have is halved, what all windows of a half share
   is longer, and its identifier splits the bucket, down to single windows, which bytes decide.
5. Other buckets are sorted inside a task (`refine`): positions start in 8-gram buckets and each
   bucket is re-sorted on the bucket pointers of later offsets, pointers that the same pass has
   already renewed included, so depth at least doubles per pass.  Neighbours in the resulting order
   are compared byte by byte.

Contexts count as equal by identifiers of 159 bits at least; everything else is decided on bytes.

Null and empty texts have no bytes and lose none; texts under `length` bytes lose none.  Very long
texts: about ten times their bytes in the one task that scans them.  Repeated rows repeat each
other; ties have no order to decide.  Overlapping repeats count.  Strings are judged on the input.
An empty table: no rows.  Extra columns: ignored by `span_digest`, kept by `remove_repeats`,
whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blobs, forget, free_names, hot_lookup, longs, materialize, record, row_key, steady_memory
from .hashing import mix, prefix_sums, range_hash

CHUNK_BYTES = 1 << 20
#: Buckets of more contexts are refined over all partitions before a task takes them.
TASK_CONTEXTS = 4_000
#: No name: names have 31 bits and are never negative.
NO_NAME = -1


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    size, now = 1, values
    while size * 2 <= width:
        now = np.minimum(now[:-size], now[size:])
        size *= 2
    return np.minimum(now[: len(values) - width + 1], now[width - size :]) if size < width else now


def quarter(length: int) -> int:
    return -(-length // 4)


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Identifier of a bucket refined by the identifier at a later offset."""
    with np.errstate(over="ignore"):
        return mix(a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93))


def names(grams: np.ndarray, at: np.ndarray, depth: int, q: int) -> np.ndarray:
    """Identifiers of `depth` bytes (2q to 4q) at `at`, from those of q-grams: joined at q, and joined again."""
    later = at + depth - 2 * q
    return joined(joined(grams[at], grams[at + q]), joined(grams[later], grams[later + q]))


def name31(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(33)).astype(np.int32)


def gram_names(data: np.ndarray, q: int) -> np.ndarray:
    at = np.arange(len(data) - q + 1)
    return range_hash(prefix_sums(data), at, at + q)


def anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, ...] | None:
    """Anchor position, bytes before it and windows after the first of its run, names of its q-gram, of its context, of its left and right side."""
    n = len(data)
    if n < length:
        return None
    q, side = quarter(length), length * 3 // 8
    grams = gram_names(data, q)
    best = sliding_min((grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64), length - q + 1)
    chosen = (best & np.uint64(0xFFFFFFFF)).astype(np.int64)
    lo = np.concatenate([[0], np.flatnonzero(np.diff(chosen)) + 1])
    hi = np.concatenate([lo[1:], [len(chosen)]]) - 1
    m = chosen[lo]
    left, span = m - lo, hi - lo
    shape = mix((left.astype(np.uint64) << np.uint64(32)) | span.astype(np.uint64))
    context = joined(joined(names(grams, lo, length, q), names(grams, hi, length, q)), shape)
    sides = []
    for has, at in ((left >= side, np.maximum(m - side, 0)), (m - hi < side, np.minimum(m, n - q - side))):
        sides.append(np.where(has, name31(names(grams, at, q + side, q)), NO_NAME).astype(np.int32))
    return m, left, span, grams[m], context, *sides


def _scan(length: int, rows: int = 2000):
    fields = [("key0", pa.int64()), ("key1", pa.int64()), ("m", pa.int32()), ("before", pa.int16()), ("span", pa.int16()), ("h", pa.int64()), ("ctx", pa.int64()), ("hl", pa.int32()), ("hr", pa.int32())]
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steady_memory()
        for batch in (b.slice(a, rows) for b in batches for a in range(0, b.num_rows, rows)):
            keys = [batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2)]
            cols: list[list] = [[] for _ in fields]
            for i, data in enumerate(blobs(batch.column(0))):
                found = anchors(data, length)
                if found is None:
                    continue
                m, left, span, gram, context, hl, hr = found
                k = len(m)
                for c, v in zip(cols, (np.full(k, keys[0][i]), np.full(k, keys[1][i]), m.astype(np.int32), left.astype(np.int16), span.astype(np.int16), longs(gram), longs(context), hl, hr), strict=True):
                    c.append(v)
            if cols[0]:
                yield record(schema, [np.concatenate(c) for c in cols])

    kinds = {"int64": "long", "int32": "int", "int16": "short"}
    return run, ", ".join(f"{n} {kinds[str(t)]}" for n, t in fields)


def grams8(data: np.ndarray) -> np.ndarray:
    """The eight bytes at each position as one number (zeros after the end)."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    gram = np.zeros(n, dtype=np.uint64)
    for k in range(8):
        gram <<= np.uint64(8)
        gram |= padded[k : k + n]
    return gram


def refine(gram: np.ndarray, depth: int, blocks: int = 4) -> np.ndarray:
    """Positions of a text, given as its 8-grams, by their first `depth` bytes at least (ties: equal that far).

    pointer[p] is the last place of p's bucket; a bucket is refined by the pointers at p + h, which
    may already have been renewed in this pass."""
    n, q = len(gram), 8
    kind = np.int32 if n + depth < 1 << 31 else np.int64
    order = np.argsort(gram).astype(kind)
    ranked = gram[order]
    ends = np.flatnonzero(np.concatenate([ranked[1:] != ranked[:-1], [True]]))
    del ranked
    pointer = np.full(n + depth + q + 1, -1, dtype=kind)
    pointer[order] = np.repeat(ends, np.diff(np.concatenate([[-1], ends])))
    place = np.arange(n, dtype=kind)
    h = q
    while h < depth:
        own = pointer[order]
        open_ = own != place  # in a bucket of two and more: not its last place, or behind another of it
        open_[1:] |= own[1:] == own[:-1]
        places = place[open_]
        if not len(places):
            break
        groups = own[open_]
        del own, open_
        starts = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
        cuts = np.unique(starts[np.linspace(0, len(starts), blocks + 1)[1:-1].astype(np.int64).clip(0, len(starts) - 1)])
        for part in np.split(places, cuts):
            if not len(part):
                continue
            p = order[part]
            own, later = pointer[p], pointer[p + h]
            inner = np.argsort(own.astype(np.int64) * (n + 1) + later + 1)
            p, own, later = p[inner], own[inner], later[inner]
            order[part] = p
            last = np.concatenate([(own[1:] != own[:-1]) | (later[1:] != later[:-1]), [True]])
            end = np.flatnonzero(last)
            pointer[p] = np.repeat(part[end], np.diff(np.concatenate([[-1], end])))
        h *= 2
    return order


def repeated_starts(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Which of `starts` (sorted) begin `length` bytes that begin at another of them too."""
    valid = np.zeros(len(data), dtype=bool)
    valid[starts] = True
    gram = grams8(data)
    order = refine(gram, length)
    order = order[valid[order]]
    same = np.zeros(len(order), dtype=bool)
    left, right = order[:-1], order[1:]
    live = np.arange(len(left))
    for k in [*range(0, length - 8, 8), length - 8]:  # all bytes, eight at a time, only where all before were equal
        live = live[gram[left[live] + k] == gram[right[live] + k]]
    same[live] = True
    same[live + 1] = True
    out = np.zeros(len(data), dtype=bool)
    out[order[same]] = True
    return out[starts]


def runs_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of True."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


_SPAN = pa.schema([("key0", pa.int64()), ("key1", pa.int64()), ("start", pa.int32()), ("stop", pa.int32())])
_SPAN_KIND = "key0 long, key1 long, start int, stop int"


# A context: the windows of one anchor whose anchor stands `a` to `b` bytes after their start, n equal
# ones in all.  top: bytes of the context before the anchor.
_CONTEXT = pa.schema([("h", pa.int64()), ("a", pa.int32()), ("b", pa.int32()), ("sub", pa.int64()), ("n", pa.int64()), ("key0", pa.int64()), ("key1", pa.int64()), ("lo", pa.int32()), ("top", pa.int32()), ("context", pa.binary())])
_CONTEXT_KIND = "h long, a int, b int, sub long, n long, key0 long, key1 long, lo int, top int, context binary"
BUCKET = ["h", "a", "b", "sub"]


def _contexts(length: int):
    """(packed, key0, key1, wanted: [(m, before, span, h, a, b, sub, n)]) to one row per wanted context, with its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data = zlib.decompress(batch.column(0)[i].as_py())
                k0, k1 = batch.column(1)[i].as_py(), batch.column(2)[i].as_py()
                rows = []
                for w in batch.column(3)[i].as_py():
                    first = w["m"] - w["before"]
                    lo, hi = max(first, w["m"] - w["b"]), min(first + w["span"], w["m"] - w["a"])
                    rows.append((w["h"], w["a"], w["b"], w["sub"], w["n"], k0, k1, lo, w["m"] - lo, data[lo : hi + length]))
                yield record(_CONTEXT, [list(c) for c in zip(*rows, strict=True)])

    return run


def _halve(length: int):
    """Contexts to those of both halves of their range, each with the name of what all windows of the half share."""
    q = quarter(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for h, a, b, n, k0, k1, lo, top, context in zip(*(batch.column(c).to_pylist() for c in ("h", "a", "b", "n", "key0", "key1", "lo", "top", "context")), strict=True):
                grams = gram_names(np.frombuffer(context, dtype=np.uint8), q)
                least = top - (len(context) - length)  # the least place of the anchor in a window here
                for x, y in ((a, (a + b) // 2), ((a + b) // 2 + 1, b)):
                    x1, y1 = max(x, least), min(y, top)
                    if x1 > y1:
                        continue
                    sub = names(grams, np.array([top - x]), length - (y - x), q)
                    rows.append((h, x, y, int(longs(sub)[0]), n, k0, k1, lo + top - y1, y1, context[top - y1 : top - x1 + length]))
            yield record(_CONTEXT, [list(c) for c in zip(*rows, strict=True)] if rows else [[] for _ in _CONTEXT])

    return run


def _refined(length: int):
    """Rows sorted by bucket; buckets are gathered to chunks and refined."""

    def solve(chunk: dict) -> pa.RecordBatch:
        keys = list(chunk)
        parts = [np.frombuffer(chunk[k][0], dtype=np.uint8) for k in keys]
        sizes = np.array([len(p) for p in parts])
        offsets = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        data = np.concatenate(parts)
        counts = sizes - length + 1
        starts = np.repeat(offsets, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        flags = repeated_starts(data, starts, length)
        cols: list[list] = [[], [], [], []]
        for k, own in zip(keys, np.split(flags, np.cumsum(counts)[:-1]), strict=True):
            if chunk[k][1] == 1 and own.any():
                for a, b in zip(*runs_of(own), strict=True):
                    for c, v in zip(cols, (k[0], k[1], k[2] + int(a), k[2] + int(b) + length), strict=True):
                        c.append(v)
        return record(_SPAN, cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steady_memory()
        chunk: dict = {}
        size, bucket = 0, None
        for batch in batches:
            for h, a, b, sub, n, k0, k1, lo, context in zip(*(batch.column(c).to_pylist() for c in (*BUCKET, "n", "key0", "key1", "lo", "context")), strict=True):
                if (h, a, b, sub) != bucket:
                    bucket = (h, a, b, sub)
                    if size > CHUNK_BYTES:
                        yield solve(chunk)
                        chunk, size = {}, 0
                if (k0, k1, lo) not in chunk:  # repeated rows bring it more than once
                    chunk[k0, k1, lo] = (context, n)
                    size += len(context)
        if chunk:
            yield solve(chunk)

    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compressed texts; of rows with one key, one in each task."""
    schema = pa.schema([("packed", pa.binary()), ("key0", pa.int64()), ("key1", pa.int64())])
    seen: set = set()
    for batch in batches:
        fresh = []
        for key in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            fresh.append(key not in seen)
            seen.add(key)
        part = batch.filter(pa.array(fresh, pa.bool_()))
        yield record(schema, [[zlib.compress(d.tobytes(), 1) for d in blobs(part.column(0))], part.column(1), part.column(2)])


def _open(rows: DataFrame) -> DataFrame:
    """Buckets of two contexts or more, one of which stands alone."""
    return rows.groupBy(*BUCKET).agg(F.count("*").alias("k"), F.min("n").alias("least")).filter("k > 1 and least = 1").select(*BUCKET, "k")


def repeated_spans(docs: DataFrame, length: int = 200) -> DataFrame:
    """key0, key1 (row_key of the row), spans: array of start and stop bytes, to be united.  A written table."""
    data = docs.select(F.col("text").cast("binary").alias("data"), *row_key()).filter(F.octet_length("data") >= length)
    fn, kind = _scan(length)
    seen = materialize(data.mapInArrow(fn, kind), "seen")
    often = materialize(seen.groupBy("h").agg(F.count("*").alias("k")).filter("k > 1"), "often")
    # in each join, keys that very many rows have are looked up without a shuffle
    found = materialize(hot_lookup(seen, often, ["h"], "k").filter("k is not null").drop("k"), "anchors")
    forget(seen, often)
    same = ["h", "ctx", "hl", "hr"]
    rep = [F.first(c).alias(c) for c in ("key0", "key1", "m", "before", "span")]  # all of one row, whichever: its context is the others' too
    classes = materialize(found.groupBy(*same).agg(F.count("*").alias("n"), *rep), "classes")

    side = length * 3 // 8
    halves = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(c).cast("long").alias("sub")) for a, b, c in ((side, length - quarter(length), "hl"), (0, side - 1, "hr"))])
    halves = classes.select("*", F.explode(halves).alias("x")).select("h", "n", "key0", "key1", "m", "before", "span", "x.*").filter(F.col("sub") != NO_NAME)
    open_ = materialize(_open(halves), "open")
    wanted = hot_lookup(halves, open_, BUCKET, "k").filter("k is not null")
    lists = wanted.groupBy("key0", "key1").agg(F.collect_list(F.struct("m", "before", "span", *BUCKET, "n")).alias("wanted"))
    packed = data.mapInArrow(_pack, "packed binary, key0 long, key1 long")
    contexts = packed.join(lists, ["key0", "key1"]).select("packed", "key0", "key1", "wanted").mapInArrow(_contexts(length), _CONTEXT_KIND)
    contexts = materialize(contexts, "bytes")

    large = open_.filter(F.col("k") > TASK_CONTEXTS).select(*BUCKET)
    ready, spans, tables = contexts, [], [contexts, open_]
    if large.limit(1).count():
        ready = contexts.join(large, BUCKET, "left_anti")
        rest = contexts.join(large, BUCKET, "left_semi").dropDuplicates([*BUCKET, "key0", "key1", "lo"])
        while True:  # eight times at most: the range of 76 places is halved down to one
            split = materialize(rest.mapInArrow(_halve(length), _CONTEXT_KIND), "halves")
            now = materialize(_open(split), "open")
            tables += [split, now]
            small = now.filter((F.col("k") <= TASK_CONTEXTS) & (F.col("a") < F.col("b"))).select(*BUCKET)
            ready = ready.unionByName(split.join(small, BUCKET, "left_semi"))
            single = split.filter("a = b").join(now.select(*BUCKET), BUCKET, "left_semi")
            twice = single.groupBy("h", "a", "context").agg(F.count("*").alias("k")).filter("k > 1").drop("k")
            spans.append(single.filter("n = 1").join(twice, ["h", "a", "context"], "left_semi").select("key0", "key1", F.col("lo").alias("start"), (F.col("lo") + length).alias("stop")))
            left = now.filter((F.col("k") > TASK_CONTEXTS) & (F.col("a") < F.col("b"))).select(*BUCKET)
            if not left.limit(1).count():
                break
            rest = split.join(left, BUCKET, "left_semi")
    spans.append(ready.repartition(*BUCKET).sortWithinPartitions(*BUCKET).mapInArrow(_refined(length), _SPAN_KIND))
    many = materialize(classes.filter("n > 1").select(*same, "n"), "many")
    first = F.col("m") - F.col("before")
    spans.append(hot_lookup(found, many, same, "n").filter("n is not null").select("key0", "key1", first.cast("int").alias("start"), (first + F.col("span") + length).cast("int").alias("stop")))
    all_spans = reduce(DataFrame.unionByName, spans)
    out = materialize(all_spans.groupBy("key0", "key1").agg(F.collect_set(F.struct("start", "stop")).alias("spans")), "spans")
    forget(found, classes, many, *tables)
    return out


def united(spans: list) -> list[tuple[int, int]]:
    """Maximal runs of bytes under the spans."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((s["start"], s["stop"]) for s in spans or ()):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def cut(data: bytes, spans: list) -> tuple[bytes, list[tuple[int, int]]]:
    runs = united(spans)
    kept, at = [], 0
    for a, b in runs:
        kept.append(data[at:a])
        at = b
    kept.append(data[at:])
    return b"".join(kept), runs


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])
    for batch in batches:
        cols: list[list] = [[], [], [], []]
        for i in range(batch.num_rows):
            data = zlib.decompress(batch.column("packed")[i].as_py())
            kept, runs = cut(data, batch.column("spans")[i].as_py())
            for c, v in zip(cols, (len(data), len(data) - len(kept), len(runs), hashlib.sha256(kept).hexdigest()), strict=True):
                c.append(v)
        yield record(schema, [batch.column("doc_id"), *cols])


def _pack_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("key0", pa.int64()), ("key1", pa.int64()), ("packed", pa.binary())])
    for batch in batches:
        yield record(schema, [batch.column(1), batch.column(2), batch.column(3), [zlib.compress(d.tobytes(), 1) for d in blobs(batch.column(0))]])


def span_digest(docs: DataFrame, length: int = 200) -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    spans = repeated_spans(docs, length)
    rows = docs.select(F.col("text").cast("binary").alias("data"), F.col("doc_id").cast("long").alias("doc_id"), *row_key())
    rows = rows.mapInArrow(_pack_all, "doc_id long, key0 long, key1 long, packed binary")
    return rows.join(spans, ["key0", "key1"], "left").select("doc_id", "packed", "spans").mapInArrow(_digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, length: int = 200) -> DataFrame:
    """Rows and columns of docs, texts without their repeated spans (characters cut in two go whole), n_chars renewed if there is one."""
    @F.pandas_udf("string")
    def kept(text: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([t if t is None or s is None else cut(t.encode(), list(s))[0].decode("utf-8", "ignore") for t, s in zip(text, spans, strict=True)], dtype=object)

    k0, k1, own = free_names(docs, 3)
    spans = repeated_spans(docs, length).select(F.col("key0").alias(k0), F.col("key1").alias(k1), F.col("spans").alias(own))
    rows = docs.select("*", *[k.alias(n) for k, n in zip(row_key(), (k0, k1), strict=True)]).join(spans, [k0, k1], "left")
    rows = rows.withColumn("text", F.when(F.col(own).isNull(), F.col("text")).otherwise(kept("text", own)))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(F.col(own).isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return rows.select(*docs.columns)
