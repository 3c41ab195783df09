"""Nearest neighbours by inner product from balanced posting lists.

Vectors get one more component that makes all of one length, so that the largest inner product is the least
distance.  Centroids come from a bounded sample, halved again and again along the line between two centres, so
that lists are of equal size.  A graph joins each centroid with its nearest ones and its neighbours in the
order of halving; lists are found by walking it from a few entries.  A vector near a boundary is put in
several lists: in those of up to `MOST_COPIES` centroids that are hardly farther than the nearest and nearer to it than
to each other.  A query reads the lists whose distance is at most a ratio of its nearest list's.

The ratio is calibrated, not given: for a bounded, documented number of queries the true neighbours among all
rows are found by brute force, and the ratio is the least that reaches `recall` of them.  Fitting and calibration look
at samples of fixed size; every row is indexed, and every query asked.

Lists are dealt to shards of bounded size in the order of halving; a list larger than a shard is split by a hash
of its vectors.  Each shard is the group of one task, which reads its vectors and then streams the queries that read
any of its lists.  Equal vectors are one entry with its k + 1 least ids (no more of them can be among the k nearest),
so that a vector that very many rows have is neither a long list nor many queries.

Null vectors, vectors with null or non-finite components, zero and empty vectors take no part; neither do rows
without an id.  Repeated rows: of rows of one id that with the least vector counts.  Ties: the smaller id first.
Shorter vectors count as filled up with zeros.  Fewer rows than k: all others.  An empty table: no
rows.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import forget, hot_lookup, materialize, record
from .vectors import best, finite, lists_of, matrix, one_per_id

#: Vectors that centroids are fitted on, and queries that the ratio is calibrated with, at most (by a hash of ids).
FIT_ROWS, CALIBRATE_QUERIES = 32_768, 256
LIST_ROWS, MOST_LISTS = 256, 4096
SHARD_ROWS = 16_384
#: How much farther than the nearest a list may be to get a copy of a vector, and the most lists of a vector.
CLOSE, MOST_COPIES = 1.02, 4
DEGREE, ENTRIES, BREADTH = 24, 16, 16


class Index:
    """Centroids in the order of halving, and the graph among them.  `top` is the largest component of all vectors, `length` the longest vector's by it."""

    def __init__(self, sample: np.ndarray, lists: int, top: float, length: float) -> None:
        self.top, self.length = top, length
        x = self.lifted(sample)
        self.centres = np.array([x[part].mean(axis=0) for part in halves(x, lists)]) if len(x) else np.zeros((1, x.shape[1]))
        n = len(self.centres)
        self.near = np.zeros((n, min(DEGREE, n - 1) + 2), dtype=np.int64)
        self.near[:, 0], self.near[:, 1] = np.maximum(np.arange(n) - 1, 0), np.minimum(np.arange(n) + 1, n - 1)
        for at in range(0, n, 512):
            d = self.distances(self.centres[at : at + 512], self.centres)
            d[np.arange(len(d)), np.arange(at, at + len(d))] = np.inf
            self.near[at : at + 512, 2:] = np.argsort(d, axis=1, kind="stable")[:, : self.near.shape[1] - 2]
        self.entries = np.unique(np.linspace(0, n - 1, min(ENTRIES, n)).astype(np.int64))

    def lifted(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """Vectors by the longest one, with the component that makes up for what they are shorter (0 in queries)."""
        x = x / self.top / self.length
        more = np.zeros(len(x)) if query else np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", x, x)))
        return np.column_stack([x, more])

    @staticmethod
    def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, np.einsum("ij,ij->i", a, a)[:, None] - 2 * a @ b.T + np.einsum("ij,ij->i", b, b)))

    def walk(self, x: np.ndarray, ratio: float, breadth: int = BREADTH) -> np.ndarray:
        """Distances of lifted vectors to the centroids that the graph leads to, infinity elsewhere.

        From the entries on, the neighbours of every centroid are looked at that is among the `breadth` nearest so far or
        within ratio times the nearest distance (see `reach`)."""
        n, c = len(x), len(self.centres)
        k = min(breadth, c)
        dist = np.full((n, c), np.inf)
        done = np.zeros((n, c), dtype=bool)
        rows, cols = np.repeat(np.arange(n), len(self.entries)), np.tile(self.entries, n)
        while len(rows):
            for at in range(0, len(rows), 50_000):
                r, t = rows[at : at + 50_000], cols[at : at + 50_000]
                d = x[r] - self.centres[t]
                dist[r, t] = np.sqrt(np.einsum("ij,ij->i", d, d))
            edge = np.partition(dist, k - 1, axis=1)[:, k - 1]
            now = (dist <= np.maximum(edge, reach(dist.min(axis=1), ratio))[:, None]) & ~done & np.isfinite(dist)
            done |= now
            r, t = np.nonzero(now)
            fresh = np.zeros((n, c), dtype=bool)
            fresh[np.repeat(r, self.near.shape[1]), self.near[t].ravel()] = True
            rows, cols = np.nonzero(fresh & ~np.isfinite(dist))
        return dist

    def lists(self, x: np.ndarray) -> np.ndarray:
        """The lists of each vector, nearest first, -1 where there are fewer than MOST_COPIES."""
        x = self.lifted(x)
        dist = self.walk(x, 1.0)
        k = min(MOST_COPIES, dist.shape[1])
        out = np.argsort(dist, axis=1, kind="stable")[:, :k]
        d = np.take_along_axis(dist, out, axis=1)
        chosen = d <= CLOSE * d[:, :1]
        for j in range(1, k):
            for i in range(j):  # a list nearer to a chosen one than to the vector adds little
                apart = np.linalg.norm(self.centres[out[:, i]] - self.centres[out[:, j]], axis=1)
                chosen[:, j] &= ~chosen[:, i] | (apart >= d[:, j])
        full = np.full((len(x), MOST_COPIES), -1)
        full[:, :k] = np.where(chosen, out, -1)
        return full


def reach(nearest: np.ndarray, ratio: float) -> np.ndarray:
    """How far a list may be; a nearest distance of about nothing counts as a thousandth."""
    return ratio * np.maximum(nearest, 1e-3)


def halves(x: np.ndarray, parts: int) -> list[np.ndarray]:
    """Rows of x in `parts` groups of about equal size, near ones in neighbouring groups."""
    rng = np.random.RandomState(12)
    out, stack = [], [(np.arange(len(x)), min(parts, len(x)))]
    while stack:
        own, k = stack.pop()
        if k <= 1:
            out.append(own)
            continue
        p = x[own]
        centre = p[rng.choice(len(own), 2, replace=False)]
        cut = len(own) * (k // 2) // k
        for _ in range(6):
            along = p @ (centre[1] - centre[0])
            order = np.argsort(along, kind="stable")
            a, b = order[:cut], order[cut:]
            centre = np.stack([p[a].mean(axis=0), p[b].mean(axis=0)])
        stack += [(own[b], k - k // 2), (own[a], k // 2)]
    return out


# --- tasks ----------------------------------------------------------------------------------------

_LISTED = pa.schema([("rep", pa.int64()), ("ids", pa.list_(pa.int64())), ("vec", pa.list_(pa.float64())), ("lists", pa.list_(pa.int32()))])
LISTED = "rep long, ids array<long>, vec array<double>, lists array<int>"


def _list(index, dim: int):
    """rep, ids, vec with the lists of each vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                x = matrix(part.column(2), dim)
                own = [[v for v in row if v >= 0] for row in index.value.lists(x).tolist()]
                yield record(_LISTED, [part.column(0), part.column(1), lists_of(x), own])

    return run


_TRUE = pa.schema([("query", pa.int32()), ("score", pa.float64()), ("rep", pa.int64()), ("ids", pa.list_(pa.int64())), ("lists", pa.list_(pa.int32()))])
TRUE = "query int, score double, rep long, ids array<long>, lists array<int>"


def _brute(queries, dim: int, k: int):
    """Of each of a few queries the k best vectors that this task reads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reps, q = queries.value
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                x, own = matrix(part.column(2), dim), part.column(0).to_numpy()
                i, j, score = top_pairs(q, x, own, k)
                take = pa.array(j)
                yield record(_TRUE, [i, score, own[j], part.column(1).take(take), part.column(3).take(take)])

    return run


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of pairs of rows, added up in one order wherever a pair stands."""
    with np.errstate(all="ignore"):
        return np.add.reduce(a * b, axis=1)


def top_pairs(q: np.ndarray, x: np.ndarray, idents: np.ndarray, k: int, allowed: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of the k best rows of x for each query, all that tie for the last place considered."""
    with np.errstate(all="ignore"):
        s = q @ x.T
    s[np.isnan(s)] = -np.inf
    if allowed is not None:
        s[~allowed] = -np.inf
    if x.shape[0] > k:
        last = np.partition(s, x.shape[0] - k, axis=1)[:, x.shape[0] - k]
        with np.errstate(all="ignore"):
            least = last - 1e-9 * np.abs(last) - 1e-300
        least[np.isnan(least)] = -np.inf
        i, j = np.nonzero((s >= least[:, None]) & ((s > -np.inf) if allowed is None else allowed))
    else:
        i, j = np.nonzero(np.ones_like(s, dtype=bool) if allowed is None else allowed)
    score = exact(q[i], x[j])
    own = best(k, i, score, idents[j])
    return i[own], j[own], score[own]


_ASKED = pa.schema([("shard", pa.int32()), ("rep", pa.int64()), ("lists", pa.list_(pa.int32())), ("vec", pa.list_(pa.float64()))])
ASKED = "shard int, rep long, lists array<int>, vec array<double>"


def _ask(index, shards, dim: int, ratio: float, least: int):
    """rep, vec of queries: a row for each shard with lists that the query reads: those within the ratio, and the nearest
    ones until they hold `least` entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix, (first, parts, sizes) = index.value, shards.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                x = matrix(part.column(1), dim)
                dist = ix.walk(ix.lifted(x, True), ratio)
                order = np.argsort(dist, axis=1, kind="stable")
                near = np.take_along_axis(dist, order, axis=1)
                if (np.where(np.isfinite(near), sizes[order], 0).sum(axis=1) < least).any():
                    dist = ix.distances(ix.lifted(x, True), ix.centres)
                    order = np.argsort(dist, axis=1, kind="stable")
                    near = np.take_along_axis(dist, order, axis=1)
                before = np.cumsum(sizes[order], axis=1) - sizes[order]
                chosen = ((near <= reach(near[:, 0], ratio)[:, None]) | (before < least)) & np.isfinite(near) & (sizes[order] > 0)
                i, j = np.nonzero(chosen)
                lists = order[i, j]
                copies = parts[lists]
                row, own = np.repeat(i, copies), np.repeat(lists, copies)
                shard = np.repeat(first[lists], copies) + np.arange(len(own)) - np.repeat(np.cumsum(copies) - copies, copies)
                by = np.lexsort((own, shard, row))
                row, own, shard = row[by], own[by], shard[by]
                if not len(row):
                    continue
                start = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (shard[1:] != shard[:-1])]))
                groups = pa.ListArray.from_arrays(pa.array(np.append(start, len(row)).astype(np.int32)), pa.array(own.astype(np.int32)))
                yield record(_ASKED, [shard[start].astype(np.int32), part.column(0).take(pa.array(row[start])), groups, lists_of(x[row[start]])])

    return run


_MET = pa.schema([("query", pa.int64()), ("rep", pa.int64()), ("score", pa.float64()), ("ids", pa.list_(pa.int64()))])
MET = "query long, rep long, score double, ids array<long>"


def _search(dim: int, k: int):
    """Rows by shard, its vectors (`ids` not null, one list each) before the queries that read it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, parts, held = None, [], None

        def close() -> tuple:
            table = pa.Table.from_batches(parts).combine_chunks()
            where = {}
            lists = table.column("lists").combine_chunks()
            own, rep = lists.flatten().to_numpy(), table.column("rep").to_numpy()
            # an entry that is in two lists of the shard stands once, with both
            ids, at, again = np.unique(rep, return_index=True, return_inverse=True)
            names = np.unique(own)
            member = np.zeros((len(names), len(ids)), dtype=bool)
            member[np.searchsorted(names, own), again] = True
            where["names"], where["member"], where["reps"] = names, member, ids
            where["x"] = matrix(table.column("vec"), dim)[at]
            where["ids"] = table.column("ids").combine_chunks().take(pa.array(at))
            return where

        for batch in batches:
            shards = batch.column("shard").to_numpy()
            entry = np.asarray(batch.column("ids").is_valid())
            cut = np.flatnonzero((shards[1:] != shards[:-1]) | (entry[1:] != entry[:-1])) + 1
            for a, b in zip([0, *cut], [*cut, batch.num_rows], strict=True):
                if a == b:
                    continue
                if shards[a] != shard:
                    shard, parts, held = shards[a], [], None
                if entry[a]:
                    parts.append(batch.slice(a, b - a))
                    continue
                if not parts:
                    continue
                if held is None:
                    held, one = close(), parts[:1]
                    parts = one  # the rest is in `held`
                for first in range(a, b, 128):
                    part = batch.slice(first, min(128, b - first))
                    wanted = part.column("lists")
                    query = np.repeat(np.arange(part.num_rows), np.diff(wanted.offsets.to_numpy()))
                    at = np.searchsorted(held["names"], wanted.flatten().to_numpy())
                    at = np.minimum(at, len(held["names"]) - 1)
                    real = held["names"][at] == wanted.flatten().to_numpy()
                    reads = np.zeros((part.num_rows, len(held["names"])), dtype=np.float32)
                    reads[query[real], at[real]] = 1
                    allowed = reads @ held["member"].astype(np.float32) > 0
                    i, j, score = top_pairs(matrix(part.column("vec"), dim), held["x"], held["reps"], k, allowed)
                    yield record(_MET, [part.column("rep").take(pa.array(i)), held["reps"][j], score, held["ids"].take(pa.array(j))])

    return run


# --- jobs -----------------------------------------------------------------------------------------


def distinct_vectors(rows: DataFrame, queries: Column, k: int) -> DataFrame:
    """A written table of one row per vector: vec, rep (its least id), ids (its k + 1 least ids), asked (how many of its rows are queries)."""
    first = rows.withColumn("_place", F.expr("row_number() over (partition by vec order by vec_id)")).filter(F.col("_place") <= k + 1)
    groups = first.groupBy("vec").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    asked = rows.filter(queries).groupBy("vec").agg(F.count("*").alias("asked"))
    return materialize(groups.join(asked, "vec", "left").select(F.col("ids")[0].alias("rep"), "ids", "vec", F.coalesce("asked", F.lit(0)).alias("asked")), "distinct")


def fit(vectors: DataFrame, n: int, dim: int) -> Index:
    """Centroids of a sample: all rows up to FIT_ROWS, beyond it those with the least hashes."""
    top, length = 1.0, 1.0
    size = vectors.agg(F.max(F.array_max(F.transform("vec", F.abs)))).first()[0]
    if size:
        top = float(size)
        length = float(vectors.agg(F.max(F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, v: a + (v / top) * (v / top))))).first()[0])
    share = min(1.0, FIT_ROWS / max(1, n))
    drawn = vectors.filter(F.expr(f"pmod(xxhash64(rep), {1 << 40})") < int(share * (1 << 40))).select("rep", "vec").orderBy("rep").limit(2 * FIT_ROWS)
    sample = np.zeros((0, dim))
    got = drawn.toArrow()
    if got.num_rows:
        sample = matrix(got.column("vec"), dim)
    lists = max(1, min(MOST_LISTS, -(-n // LIST_ROWS), len(sample) // 8))
    return Index(sample, lists, top, length)


def calibrate(listed: DataFrame, queries: DataFrame, index: Index, dim: int, k: int, recall: float) -> float:
    """The least ratio with which a sample of queries (rep, vec) reads lists that hold `recall` of their true neighbours."""
    spark = listed.sparkSession
    some = queries.orderBy(F.xxhash64("rep"), "rep").limit(CALIBRATE_QUERIES).collect()
    q = np.zeros((len(some), dim))
    for i, r in enumerate(some):
        q[i, : len(r["vec"])] = r["vec"]
    shared = spark.sparkContext.broadcast((None, q))
    true = listed.mapInArrow(_brute(shared, dim, k + 1), TRUE)
    true = true.withColumn("_place", F.expr("row_number() over (partition by query order by score desc, rep)")).filter(F.col("_place") <= k + 1).collect()  # k + 1 rows a query
    shared.unpersist()
    dist = index.distances(index.lifted(q, True), index.centres) if len(q) else np.zeros((0, 1))
    own = {i: r["rep"] for i, r in enumerate(some)}
    need = [min(dist[r["query"], c] for c in r["lists"]) / max(dist[r["query"]].min(), 1e-3) for r in true if r["rep"] != own[r["query"]]]
    return float(max(1.0, np.quantile(need, recall))) * (1 + 1e-9) if need else 1.0


def deal(sizes: np.ndarray, rows: int = SHARD_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """(first shard, number of shards) of each list: runs of lists that hold about `rows` together, large lists by themselves."""
    first, parts = np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64)
    shard, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if n > rows:
            shard += held > 0
            first[i], parts[i] = shard, -(-n // rows)
            shard, held = shard + int(parts[i]), 0
            continue
        if held and held + n > rows:
            shard, held = shard + 1, 0
        first[i] = shard
        held += n
    return first, parts


def nearest(rows: DataFrame, queries: Column, k: int = 20, recall: float = 0.95, ratio: float | None = None) -> DataFrame:
    """rows: vec_id, vec.  queries: condition on vec_id.  query_id, rank, vec_id, score of each query's k nearest found."""
    spark = rows.sparkSession
    vec = F.col("vec")
    own = rows.filter(finite(vec) & F.exists(vec, lambda x: x != 0)).select(F.col("vec_id").cast("long").alias("vec_id"), vec.cast("array<double>").alias("vec"))
    own = materialize(one_per_id(own, "vec"), "vectors")
    vectors = distinct_vectors(own, queries, k)
    size = vectors.agg(F.count("*").alias("n"), F.max(F.size("vec")).alias("dim")).first()
    dim = size["dim"] or 1
    index = fit(vectors, size["n"], dim)
    shared = spark.sparkContext.broadcast(index)
    listed = materialize(vectors.select("rep", "ids", "vec").mapInArrow(_list(shared, dim), LISTED), "lists")
    asking = vectors.filter("asked > 0").select("rep", "vec")
    if ratio is None:
        ratio = calibrate(listed, asking, index, dim, k, recall)
    sizes = np.zeros(len(index.centres), np.int64)
    for r in listed.select(F.explode("lists").alias("list")).groupBy("list").agg(F.count("*").alias("n")).collect():  # MOST_LISTS at most
        sizes[r["list"]] = r["n"]
    first, parts = deal(sizes)
    table = F.broadcast(spark.createDataFrame([(i, int(a), int(b)) for i, (a, b) in enumerate(zip(first, parts, strict=True))], "list int, first int, parts int"))
    entries = listed.select("rep", "ids", "vec", F.explode("lists").alias("list")).join(table, "list")
    entries = entries.select((F.col("first") + F.expr("pmod(xxhash64(rep), parts)")).cast("int").alias("shard"), "rep", F.array("list").alias("lists"), "vec", "ids")
    dealt = spark.sparkContext.broadcast((first, parts, sizes))
    asked = asking.mapInArrow(_ask(shared, dealt, dim, ratio, MOST_COPIES * (k + 2)), ASKED).withColumn("ids", F.lit(None).cast("array<long>"))
    both = entries.unionByName(asked).repartition("shard").sortWithinPartitions("shard", F.col("ids").isNull())
    met = both.mapInArrow(_search(dim, k + 1), MET).groupBy("query", "rep").agg(F.max("score").alias("score"), F.first("ids").alias("ids"))
    met = met.withColumn("_place", F.expr("row_number() over (partition by query order by score desc, rep)")).filter(F.col("_place") <= k + 1)
    ids = met.select("query", "score", F.explode("ids").alias("vec_id")).withColumn("_place", F.expr("row_number() over (partition by query order by score desc, vec_id)")).filter(F.col("_place") <= k + 1)
    found = ids.groupBy("query").agg(F.transform(F.array_sort(F.collect_list(F.struct("_place", "vec_id", "score"))), lambda x: F.struct(x["vec_id"].alias("vec_id"), x["score"].alias("score"))).alias("found"))
    named = vectors.filter("asked > 0").select("rep", "asked", "vec").join(found, F.col("rep") == F.col("query")).select("vec", "asked", "found")
    named = materialize(named, "found")
    each = hot_lookup(own.filter(queries), named, ["vec"], "asked").filter(F.col("found").isNotNull())
    others = F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("vec_id")), 1, k)
    out = each.select(F.col("vec_id").alias("query_id"), F.posexplode(others).alias("rank", "x"))
    out = materialize(out.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score")), "nearest")
    forget(own, vectors, listed, named)
    return out
