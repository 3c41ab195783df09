"""N-gram Jaccard self-join with adaptive multi-match prefixes.

Documents are sets of word shingles.  All shingles are put in one order, rarest first by a
frequency sketch of fixed size; any order is right, the sketch only makes prefixes selective.
The l-prefix of a document of n shingles that must share o = ceil(t * n) with a partner holds its
n - o + l first ones, and linked documents share at least l shingles of their l-prefixes.  Each
document takes the l whose estimated cost is least: postings to read, plus candidates to verify,
of which there are at most (postings read) / l.  A pair is verified only when it shares
l = min(l_a, l_b) shingles in places below n - o + l of both, with the o that this pair needs.

Equal sets are one node.  Copies in large groups are not expanded into pairs: first each node
is verified against the one pivot it shares most with; after that only pairs across different
components are made, and of them only those whose 256-bit parities do not rule a link out, so no
link between components is lost.

Posting lists of over BLOCK entries are found by an exact count (of the shingles that the sketch,
which never counts too little, doesn't clear).  They are never gathered: their pivots come from an
aggregate, and only where two components meet in one is it split into pairs of blocks, nodes of
the component that has most of it against the others and the others among themselves.

Sets are of 64-bit shingle names; two given shingles share one by chance once in 2^64 (words of over 256 bytes, of
which a polynomial could be made to collide, are named by blake2b).  Nodes have 128-bit names: 64 bits stand for them, and names that two sets share are replaced by the other half.

Null and empty texts: an empty set, linked with nothing, alone in their component.
Repeated rows: one node; each row is returned.  Ties (equal counts, equal sizes): by shingle and node
name, which changes no result.  Very long texts: their sets are held by the one task that reads them
and by those that verify them.  An empty table: no rows.  Extra columns are ignored by
`component_table` and kept by `keep_first`, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blobs, forget, free_names, hot_lookup, longs, materialize, record, release, row_key, steady_memory
from .components import components
from .hashing import IS_SPACE, LOWER, mix, window_hashes, word_hashes

LEVELS = 6
VERIFY_COST = 40.0
#: Longer posting lists are never gathered.
BLOCK = 512


def needed(n: np.ndarray | int, num: int, den: int):
    """Least overlap with any partner of a set of n: ceil(n * num / den)."""
    return -((-n * num) // den)


def text_set(data: np.ndarray, width: int) -> np.ndarray:
    words = word_hashes(LOWER[data], IS_SPACE)
    return np.unique(window_hashes(words, min(width, len(words)))) if len(words) else np.zeros(0, np.uint64)


def set_names(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit names of a set: the node's, and the one it takes where another set has the first one too."""
    with np.errstate(over="ignore"):
        a = mix(s ^ np.uint64(0x1234567)).sum(dtype=np.uint64) + np.uint64(len(s))
        b = mix(s * np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64)
        return tuple(int(x) for x in longs(mix(np.array([a, b], dtype=np.uint64))))


def node_of(s: np.ndarray, shared: frozenset) -> int:
    first, second = set_names(s)
    return second if first in shared else first


def parity(s: np.ndarray) -> np.ndarray:
    """256 bits as four longs, each bit the parity of how many shingles fall on it.  Two sets differ in at least
    as many shingles as their parities differ in bits, whatever the hash."""
    return np.packbits(np.bincount((s & np.uint64(255)).astype(np.int64), minlength=256) & 1).view(np.int64)


PARITY = ["p0", "p1", "p2", "p3"]


def _members(width: int, bits: int):
    schema = pa.schema([("doc_id", pa.int64()), ("key1", pa.int64()), ("n", pa.int64()), ("node", pa.int64()), ("second", pa.int64()), *[(p, pa.int64()) for p in PARITY], ("chunk", pa.int32()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steady_memory()
        counts = np.zeros(1 << bits, dtype=np.int32)
        for batch in batches:
            sizes, nodes, parities = [], [], []
            for data in blobs(batch.column(1)):
                s = text_set(data, width)
                np.add.at(counts, (s >> np.uint64(64 - bits)).astype(np.int64), 1)
                sizes.append(len(s))
                nodes.append(set_names(s))
                parities.append(parity(s))
            k = len(sizes)
            if k:
                yield record(schema, [batch.column(0), batch.column(2), sizes, *np.array(nodes, dtype=np.int64).T, *np.array(parities).T, pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())])
        step = 1 << max(0, bits - 6)
        for c in range(0, len(counts), step):
            part = counts[c : c + step]
            if part.any():
                small = np.minimum(part, 2**31 - 1).astype("<i4").tobytes()
                yield record(schema, [*[[None]] * (5 + len(PARITY)), [c // step], [zlib.compress(small, 1)]])

    return run, f"doc_id long, key1 long, n long, node long, second long, {', '.join(f'{p} long' for p in PARITY)}, chunk int, counts binary"


def _fold(add):
    """Rows sorted by chunk; the values of each chunk, one held at a time, put together by `add`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("chunk", pa.int32()), ("value", pa.binary())])
        at, total = None, None
        for batch in batches:
            for chunk, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if chunk == at:
                    total = add(total, zlib.decompress(raw))
                    continue
                if at is not None:
                    yield record(schema, [[at], [zlib.compress(total, 1)]])
                at, total = chunk, zlib.decompress(raw)
        if at is not None:
            yield record(schema, [[at], [zlib.compress(total, 1)]])

    return run


def fold_chunks(rows: DataFrame, add, salts: int = 256) -> list:
    """rows: chunk, value.  One row per chunk, of which there are few, each of a fixed size.  What all tasks have
    made is put together in salted groups first, so that no task reads the chunks of all of them."""
    kind = "chunk int, value binary"
    some = rows.withColumn("salt", F.expr(f"pmod(xxhash64(value), {salts})")).repartition("chunk", "salt").sortWithinPartitions("chunk").select("chunk", "value").mapInArrow(_fold(add), kind)
    return some.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(_fold(add), kind).collect()


def _add_counts(a: bytes, b: bytes) -> bytes:
    total = np.frombuffer(a, "<i4").astype(np.int64) + np.frombuffer(b, "<i4")
    return np.minimum(total, 2**31 - 1).astype("<i4").tobytes()


def _either(a: bytes, b: bytes) -> bytes:
    return (np.frombuffer(a, np.uint8) | np.frombuffer(b, np.uint8)).tobytes()


def load_sketch(rows: list, bits: int) -> np.ndarray:
    step = 1 << max(0, bits - 6)
    out = np.zeros(1 << bits, dtype=np.int32)
    for r in rows:
        part = np.frombuffer(zlib.decompress(r["value"]), dtype="<i4")
        out[r["chunk"] * step : r["chunk"] * step + len(part)] = part
    return out


def choose_level(df: np.ndarray, n: int, num: int, den: int) -> tuple[int, int]:
    """df: estimated document frequencies in prefix order.  Returns level and prefix length."""
    base = n - int(needed(n, num, den)) + 1
    most = min(LEVELS, n - base + 1, int(needed(n, num, den)))
    sums = np.cumsum(df[: base + most - 1])
    levels = np.arange(1, most + 1)
    at = sums[base - 1 : base - 1 + most]
    best = int(np.argmin(at + VERIFY_COST * at / levels))
    return int(levels[best]), base + best


POSTING = "bucket long, node long, n int, pos int, level short"


def _postings(width: int, bits: int, shared: frozenset, sketch, num: int, den: int, block: int):
    """big: the sketch does not rule out that the shingle is in over `block` texts."""
    schema = pa.schema([("bucket", pa.int64()), ("node", pa.int64()), ("n", pa.int32()), ("pos", pa.int32()), ("level", pa.int16()), ("big", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steady_memory()
        counts = sketch.value
        noise = float(np.median(counts))
        done: set[int] = set()  # copies in one partition are listed once
        cols: list[list] = [[] for _ in schema]
        rows = 0
        for batch in batches:
            for data in blobs(batch.column(0)):
                s = text_set(data, width)
                n = len(s)
                if not n:
                    continue
                node = node_of(s, shared)
                if node in done:
                    continue
                done.add(node)
                est = counts[(s >> np.uint64(64 - bits)).astype(np.int64)]
                order = np.lexsort((s, est))
                df = np.maximum(est[order].astype(np.float64) - noise, 1.0)
                level, length = choose_level(df, n, num, den)
                own = order[:length]
                for c, v in zip(cols, (longs(s[own]), np.full(length, node), np.full(length, n, np.int32), np.arange(length, dtype=np.int32), np.full(length, level, np.int16), est[own] > block), strict=True):
                    c.append(v)
                rows += length
                if rows > 200_000:
                    yield record(schema, [np.concatenate(c) for c in cols])
                    cols, rows = [[] for _ in schema], 0
        if rows:
            yield record(schema, [np.concatenate(c) for c in cols])

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket, rank and node: those of buckets with two nodes or more, each node once, with
    the bucket's first node and its size (`pivot`, `m`)."""
    bucket = last = pivot = size = None
    known = False  # the open bucket has two nodes
    waiting = None  # its only row so far
    for batch in batches:
        buckets, nodes = batch.column("bucket").to_numpy(), batch.column("node").to_numpy()
        n = len(buckets)
        if not n:
            continue
        goes_on = bucket is not None and buckets[0] == bucket
        start = np.concatenate([[not goes_on], buckets[1:] != buckets[:-1]])
        fresh = start | np.concatenate([[not goes_on or nodes[0] != last], nodes[1:] != nodes[:-1]])
        group = np.cumsum(start) - start[0]
        firsts = np.flatnonzero(start)
        sizes = batch.column("n").to_numpy()
        pivots = nodes[firsts] if start[0] else np.concatenate([[pivot], nodes[firsts]])
        pivot_sizes = sizes[firsts] if start[0] else np.concatenate([[size], sizes[firsts]])
        many = np.zeros(len(pivots), dtype=bool)
        many[group[fresh & ~start]] = True
        if goes_on:
            many[0] |= known
            if many[0] and waiting is not None:
                yield waiting
        keep = fresh & many[group]
        own = batch.append_column("pivot", pa.array(pivots[group], pa.int64())).append_column("m", pa.array(pivot_sizes[group], pa.int32()))
        yield own.filter(pa.array(keep))
        at = group[-1]
        if many[at]:
            waiting = None
        elif start[0] or at:
            waiting = own.slice(int(firsts[-1]), 1)
        bucket, last, pivot, size, known = buckets[-1], nodes[-1], pivots[at], pivot_sizes[at], bool(many[at])


def _bits(bits: int):
    """A fixed-size bitmap of the values seen, in 16 chunks."""
    schema = pa.schema([("chunk", pa.int32()), ("value", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << bits, dtype=bool)
        for batch in batches:
            seen[batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - bits)] = True
        for c, part in enumerate(np.split(seen, 16)):
            if part.any():
                yield record(schema, [[c], [zlib.compress(np.packbits(part).tobytes(), 1)]])

    return run


def _texts(bits: int, bitmap):
    schema = pa.schema([("key0", pa.int64()), ("key1", pa.int64()), ("packed", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(bitmap.value)
        for batch in batches:
            own = wanted[batch.column(2).to_numpy().view(np.uint64) >> np.uint64(64 - bits)] > 0
            part = batch.filter(pa.array(own))
            yield record(schema, [part.column(1), part.column(2), [zlib.compress(d.tobytes(), 1) for d in blobs(part.column(0))]])

    return run


def texts_of(docs: DataFrame, wanted: DataFrame, bits: int = 24) -> DataFrame:
    """node, packed (compressed text) for each row of wanted (node, key0, key1).  A bitmap of fixed size
    keeps most other texts out of the shuffle; the join is exact whatever the bitmap lets through."""
    rows = fold_chunks(wanted.select("key1").mapInArrow(_bits(bits), "chunk int, value binary"), _either)  # 16 rows at most
    full = np.zeros((1 << bits) // 8, dtype=np.uint8)
    for r in rows:
        full[r["chunk"] * (len(full) // 16) :][: len(full) // 16] = np.frombuffer(zlib.decompress(r["value"]), dtype=np.uint8)
    bitmap = docs.sparkSession.sparkContext.broadcast(full)
    packed = docs.select(F.col("text").cast("binary").alias("data"), *row_key()).mapInArrow(_texts(bits, bitmap), "key0 long, key1 long, packed binary")
    return packed.join(wanted, ["key0", "key1"]).groupBy("node").agg(F.min("packed").alias("packed"))


def _verify(width: int, num: int, den: int):
    """Rows sorted by (b, salt, a): the centre's own row has a null `a` and comes first."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steady_memory()
        centre, mine = None, None
        for batch in batches:
            out_a, out_b = [], []
            packed = batch.column("packed")
            for i, (b, salt, a) in enumerate(zip(batch.column("b").to_pylist(), batch.column("salt").to_pylist(), batch.column("a").to_pylist(), strict=True)):
                s = text_set(np.frombuffer(zlib.decompress(packed[i].as_py()), dtype=np.uint8), width)
                if a is None:
                    centre, mine = (b, salt), s
                    continue
                assert centre == (b, salt), "a pair without its centre"
                small = len(np.intersect1d(mine, s, assume_unique=True))
                if den * small >= num * (len(mine) + len(s) - small):
                    out_a.append(a)
                    out_b.append(b)
            yield record(schema, [out_a, out_b])

    return run


def verify(pairs: DataFrame, texts: DataFrame, width: int, num: int, den: int, salt_rows: int = 250) -> DataFrame:
    """pairs: a, b (distinct).  Returns those whose sets link.  A centre with many partners is split."""
    degree = pairs.groupBy("b").agg(F.count("*").alias("deg")).withColumn("salts", F.ceil(F.col("deg") / salt_rows).cast("int"))
    degree = materialize(degree, "degrees")
    centres = texts.join(degree, texts["node"] == degree["b"]).select("b", F.explode(F.expr("sequence(0, salts - 1)")).alias("salt"), F.lit(None).cast("long").alias("a"), "packed")
    sides = pairs.join(degree, "b").select("b", F.expr("cast(pmod(xxhash64(a), salts) as int)").alias("salt"), "a")
    sides = sides.join(texts, sides["a"] == texts["node"]).select("b", "salt", "a", "packed")
    rows = centres.unionByName(sides).repartition("b", "salt").sortWithinPartitions("b", "salt", F.col("a").asc_nulls_first())
    return rows.mapInArrow(_verify(width, num, den), "a long, b long")


def _candidates(num: int, den: int):
    """Of each posting list (rows sorted by bucket), the pairs across components that can be long enough."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("need", pa.int16())])

    def pairs_of(v: np.ndarray) -> Iterator[tuple]:
        v = v[np.argsort(v["n"], kind="stable")]
        n, root, block, pos, level, bits = v["n"].astype(np.int64), v["root"], v["block"], v["pos"].astype(np.int64), v["level"], v["parity"]
        whole = not block.any()
        roots, at, k = np.unique(root, return_inverse=True, return_counts=True)
        main = at == k.argmax()  # no pairs inside the component that has most of the list
        for i in np.flatnonzero(~main):
            j0, j1 = np.searchsorted(n, -(-n[i] * num // den)), np.searchsorted(n, n[i] * den // num, "right")
            j = np.arange(j0, j1)
            j = j[main[j] | (j < i)]
            need = np.minimum(level[j], level[i])
            overlap = -((-(n[j] + n[i]) * num) // (num + den))  # what this pair must share
            ok = (root[j] != root[i]) & (pos[j] < n[j] - overlap + need) & (pos[i] < n[i] - overlap + need)
            if not whole:
                ok &= block[j] != block[i]
            ok[ok] = np.bitwise_count(bits[j[ok]] ^ bits[i]).sum(axis=1) <= (n[j] + n[i] - 2 * overlap)[ok]
            j = j[ok]
            if len(j):
                yield np.minimum(v["node"][j], v["node"][i]), np.maximum(v["node"][j], v["node"][i]), need[ok]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        kinds = [("bucket", np.int64), ("block", np.int32), ("node", np.int64), ("n", np.int32), ("pos", np.int32), ("level", np.int16), ("root", np.int64), ("parity", np.uint64, 4)]

        def flush(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
            cut = np.flatnonzero(np.diff(rows["bucket"])) + 1
            out, size = [], 0
            for part in np.split(rows, cut):
                if len(part) > 1 and (part["root"] != part["root"][0]).any():
                    for x in pairs_of(part):
                        out.append(x)
                        size += len(x[0])
                        if size > 200_000:
                            yield record(schema, [np.concatenate(c) for c in zip(*out, strict=True)])
                            out, size = [], 0
            if out:
                yield record(schema, [np.concatenate(c) for c in zip(*out, strict=True)])

        for batch in batches:
            rows = np.empty(batch.num_rows, dtype=kinds)
            for name in rows.dtype.names[:-1]:
                rows[name] = batch.column(name).to_numpy(zero_copy_only=False)
            for k, name in enumerate(PARITY):
                rows["parity"][:, k] = batch.column(name).to_numpy().view(np.uint64)
            if not len(rows):
                continue
            held.append(rows)
            if rows["bucket"][0] == rows["bucket"][-1] and held[0]["bucket"][0] == rows["bucket"][-1]:
                continue
            all_rows = np.concatenate(held)
            last = int(np.searchsorted(all_rows["bucket"], all_rows["bucket"][-1]))
            yield from flush(all_rows[:last])
            held = [all_rows[last:]]
        if held:
            yield from flush(np.concatenate(held))

    return run, "a long, b long, need short"


def name_nodes(seen: DataFrame, most: int = 1_000_000) -> tuple[DataFrame, frozenset]:
    """(members with nodes that differ where sets do, first names that sets share).

    Of n sets about n * n / 2^65 pairs share a first name: 70 of 5 * 10^10 sets.  Those alone come to the driver."""
    shared: frozenset = frozenset()
    for _ in range(4):
        members = seen
        if shared:
            own = F.broadcast(seen.sparkSession.createDataFrame([(x,) for x in sorted(shared)], "node long").withColumn("renamed", F.lit(True)))
            members = seen.join(own, "node", "left").withColumn("node", F.when(F.col("renamed"), F.col("second")).otherwise(F.col("node"))).drop("renamed")
        clash = members.groupBy("node").agg(F.min("second").alias("a"), F.max("second").alias("b")).filter("a <> b").select("node").limit(most + 1).collect()
        if not clash:
            return members, shared
        if len(clash) > most:
            break
        shared |= {r[0] for r in clash}
    raise ValueError("names of sets clash again and again")


def posting_lists(postings: DataFrame, block: int) -> DataFrame:
    """postings (a written table) of shingles that two nodes or more have, each node once: bucket, node, n, pos, level,
    pivot, m (the list's first node and its size), k (entries of a list of over `block`, else 0)."""
    # the node with the fewest rarer shingles, which among near copies is the one most others are made from, comes first
    rank = F.expr("1000L * pos div n")
    hot = materialize(postings.filter("big").groupBy("bucket").agg(F.count("*").alias("k")).filter(F.col("k") > block), "hot")
    n_hot = hot.count()
    own = postings.drop("big")

    def small(df: DataFrame) -> DataFrame:
        """Broadcast while hot lists are few; beyond that a plain join, in which Spark splits large keys."""
        return F.broadcast(df) if n_hot <= 200_000 else df

    cold = own.join(small(hot), "bucket", "left_anti") if n_hot else own
    lists = cold.repartition("bucket").sortWithinPartitions("bucket", rank, "node").mapInArrow(_shared, POSTING + ", pivot long, m int").withColumn("k", F.lit(0).cast("long"))
    if n_hot:
        rows = own.join(small(hot), "bucket").distinct()
        first = rows.groupBy("bucket").agg(F.min(F.struct(rank.alias("r"), "node", "n")).alias("f")).select("bucket", F.col("f.node").alias("pivot"), F.col("f.n").alias("m"))
        lists = lists.unionByName(rows.join(small(first), "bucket").select(*lists.columns))
    return materialize(lists, "lists")


def blocks_of(rows: DataFrame, block: int) -> DataFrame:
    """Entries of large lists (bucket, node, root, ...) whose lists two components meet in, dealt to lists of blocks.

    The nodes of the component that has most of a list are in one block each; all others are copied to each of
    these, and to pairs of blocks among themselves.  Pairs count across blocks (1 and 2), in blocks of 0 all of them."""
    per = rows.groupBy("bucket", "root").agg(F.count("*").alias("c")).groupBy("bucket").agg(F.max(F.struct("c", "root")).alias("top"), F.sum("c").alias("all"), F.count("*").alias("roots"))
    per = per.filter("roots > 1").select("bucket", "all", F.col("top.root").alias("most"), F.ceil(F.col("top.c") / block).alias("rb"), F.ceil((F.col("all") - F.col("top.c")) / block).alias("ob"))
    own = hot_lookup(rows, per.withColumn("entries", F.col("all")).drop("all"), ["bucket"], "entries").filter("most is not null").drop("entries")
    mine = F.expr("pmod(xxhash64(node), if(root = most, rb, ob))")
    single = F.expr("array(named_struct('name', xxhash64(bucket, 1, mine), 'block', 1))")
    toward = F.expr("transform(sequence(0L, rb - 1), x -> named_struct('name', xxhash64(bucket, 1, x), 'block', 2))")
    among = F.expr("transform(sequence(0L, ob - 1), x -> named_struct('name', xxhash64(bucket, 2, least(mine, x), greatest(mine, x)), 'block', if(x = mine, 0, if(x > mine, 1, 2))))")
    dealt = own.withColumn("mine", mine).withColumn("x", F.explode(F.when(F.col("root") == F.col("most"), single).otherwise(F.concat(toward, among))))
    return dealt.withColumn("bucket", F.col("x.name")).withColumn("block", F.col("x.block"))


def link_components(docs: DataFrame, width: int = 4, num: int = 85, den: int = 100, sketch_bits: int = 22) -> tuple[DataFrame, DataFrame]:
    """(members: doc_id, key1 (row_key), n, node; roots: node, root), roots only for nodes with a link to another set.

    docs needs doc_id (long) and text.  Two sets link when den * intersection >= num * union."""
    spark = docs.sparkSession
    data = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("data"), row_key()[1])
    fn, kind = _members(width, sketch_bits)
    seen = materialize(data.mapInArrow(fn, kind), "members")
    members, shared = name_nodes(seen.filter("chunk is null").drop("chunk", "counts"))
    rows = fold_chunks(seen.filter("chunk is not null").select("chunk", F.col("counts").alias("value")), _add_counts)  # 64 rows: the sketch's fixed size
    sketch = spark.sparkContext.broadcast(load_sketch(rows, sketch_bits))

    postings = materialize(data.select("data").mapInArrow(_postings(width, sketch_bits, shared, sketch, num, den, BLOCK), POSTING + ", big boolean"), "postings")
    lists = posting_lists(postings, BLOCK)
    # one row per node before anything is joined: a text that very many rows have is one of them
    one = [F.first(c).alias(c) for c in ("key0", "key1", "n", *PARITY)]
    per_node = members.filter("n > 0").withColumn("key0", F.coalesce("doc_id", F.lit(0))).groupBy("node").agg(*one)
    wanted = materialize(per_node.join(lists.select("node").distinct(), "node", "left_semi"), "wanted")
    tables = [postings, lists, wanted]

    def linked(pairs: DataFrame) -> DataFrame:
        """The pairs that link; only texts of their nodes are moved."""
        ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        own = materialize(wanted.select("node", "key0", "key1").join(ends, "node", "left_semi"), "ends")
        texts = materialize(texts_of(docs, own), "texts")
        links = materialize(verify(pairs, texts, width, num, den), "links")
        forget(own, texts)
        release(spark)
        return links

    # first each node against the pivot it shares most postings with, if sizes and parities let them link
    near = lists.filter("node <> pivot").filter(f"least(n, m) * {den}L >= greatest(n, m) * {num}L")
    counted = near.groupBy("node", "n", "pivot", "m").agg(F.count("*").alias("shared"))
    counted = counted.groupBy("node", "n").agg(F.max(F.struct("shared", "pivot", "m")).alias("best")).select("node", "n", "best.*")
    bits = wanted.select("node", *PARITY)
    counted = counted.join(bits, "node").join(bits.select(F.col("node").alias("pivot"), *[F.col(p).alias(f"o{p}") for p in PARITY]), "pivot")
    apart = " + ".join(f"bit_count({p} ^ o{p})" for p in PARITY)
    counted = counted.filter(f"{apart} <= n + m - 2 * (((n + m) * {num}L + {num + den - 1}) div {num + den})")
    pairs = materialize(counted.select(F.greatest("node", "pivot").alias("a"), F.least("node", "pivot").alias("b")).distinct(), "pairs")
    links = linked(pairs)
    # then all that can link across what that has joined
    joined = components(links)
    nodes = materialize(wanted.select("node", *PARITY).join(joined, "node", "left").withColumn("root", F.coalesce("root", "node")), "nodes")
    cross = lists.drop("pivot", "m").join(nodes, "node")
    columns = ["bucket", "block", "node", "n", "pos", "level", "root", *PARITY]
    rows = cross.filter("k = 0").withColumn("block", F.lit(0)).select(*columns)
    if lists.filter("k > 0").limit(1).count():
        rows = rows.unionByName(blocks_of(cross.filter("k > 0"), BLOCK).select(*columns))
    fn, kind = _candidates(num, den)
    found = rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(fn, kind)
    more = materialize(found.groupBy("a", "b").agg(F.count("*").alias("k"), F.max("need").alias("need")).filter("k >= need").select(F.col("b").alias("a"), F.col("a").alias("b")), "pairs")
    others = linked(more)
    roots = materialize(components(links.unionByName(others)), "roots")
    forget(*tables, pairs, more, links, others, nodes)
    release(spark)
    return members.select("doc_id", "key1", "n", "node"), roots


def component_rows(docs: DataFrame, width: int = 4, num: int = 85, den: int = 100, **options) -> DataFrame:
    """One row per row of docs: doc_id, key1, n_shingles, component_id, and keep (the row key of the component's first document)."""
    members, roots = link_components(docs, width, num, den, **options)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("doc_id"), F.col("key1").alias("key1"))).alias("first")
    groups = members.filter("n > 0").groupBy("node").agg(first, F.count("*").alias("k"))
    linked = groups.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = linked.groupBy("root").agg(F.min("first").alias("least"), F.count("*").alias("nodes"))
    # a root that very many nodes have is looked up without a shuffle
    named = materialize(hot_lookup(linked, least, ["root"], "nodes").select("node", "k", F.col("least.doc_id").alias("component_id"), F.col("least.key1").alias("keep")), "component")
    full = hot_lookup(members.filter("n > 0"), named, ["node"], "k").select("doc_id", "key1", F.col("n").alias("n_shingles"), "component_id", "keep")
    bare = members.filter("n = 0").select("doc_id", "key1", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.col("key1").alias("keep"))
    return full.unionByName(bare)


def component_table(docs: DataFrame, width: int = 4, num: int = 85, den: int = 100, **options) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id (least doc_id reachable by links)."""
    return component_rows(docs, width, num, den, **options).select("doc_id", "n_shingles", "component_id")


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """Rows of docs, one of each component: that with the least doc_id.  Texts without words all stay;
    of rows that are equal in doc_id and text, one stays."""
    found = component_rows(docs, **options)
    k0, k1, rank = free_names(docs, 3)
    stay = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("key1") == F.col("keep")))
    stay = stay.select(F.coalesce("doc_id", F.lit(0)).alias(k0), F.col("key1").alias(k1)).distinct()
    kept = docs.select("*", *[k.alias(n) for k, n in zip(row_key(), (k0, k1), strict=True)]).join(stay, [k0, k1], "left_semi")
    # of repeated rows each task passes on one (Spark limits the groups of such a window before it shuffles them)
    kept = kept.withColumn(rank, F.expr(f"row_number() over (partition by {k0}, {k1} order by {k1})"))
    return kept.filter(F.col(rank) == 1).select(*docs.columns)
