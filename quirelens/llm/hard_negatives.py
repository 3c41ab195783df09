"""Hard negatives for contrastive training, by a full sort of each anchor's scores.

Components are floored to whole numbers, so scores are exact integers.  Anchors are taken in blocks of
bounded bytes; for each block all rows are read twice, in parallel.  First every task keeps an anchor's best
rows of its own label, and a window makes its positives of what the tasks kept.  Then every task sorts an
anchor's scores against the rows it reads by score and id, finds with a binary search where a positive's
upper limit begins, and reads the next different-label rows down to the lower limit; a window keeps
the first of what the tasks read.  The first k of a union are among the first k of its parts, so the result is
that of one sort of all scores, but no task ever holds all scores of an anchor.

Rows with a null label, a null vector or a component that is null or not finite take no part; neither do rows
without an id.  Repeated rows: of rows of one id that with the least label, then the least vector, counts.
Ties of scores: the smaller id first.  Shorter vectors count as filled up with zeros; empty ones score 0.
Scores beyond 63 bits are held at the limits of a long.  An anchor without positives, and a positive
without negatives inside its limits, give no rows; nor does an empty table.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import extend, forget, materialize, record
from .vectors import best, finite, matrix, one_per_id

#: Bytes of a block of anchors, which goes to every task.
BLOCK_BYTES = 16 << 20
_LONG = 2**63 - 1
_WIDE = 2.0**1000


def scaled(x: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x), as whole doubles."""
    with np.errstate(over="ignore"):
        return np.floor(np.clip(scale * x, -_WIDE, _WIDE))


def scores(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers: by doubles where these hold them, else by integers of any size."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, a.shape[1])
    if most < 2**53:
        return (a @ x.T).astype(np.int64)
    wide = np.array([[int(v) for v in row] for row in a], dtype=object).reshape(a.shape) @ np.array([[int(v) for v in row] for row in x], dtype=object).reshape(x.shape).T
    return np.array([[max(-_LONG, min(_LONG, v)) for v in row] for row in wide], dtype=np.int64).reshape(len(a), len(x))


def limits(score: int, low: int, high: int) -> tuple[int, int]:
    """Least and greatest whole number n with low * score <= 100 * n <= high * score."""
    return -((-low * score) // 100), (high * score) // 100


class Block:
    """Anchors as arrays: ids, labels, scaled vectors; with their positives, also ids, scores and limits of these."""

    def __init__(self, rows: list, dim: int, scale: float) -> None:
        self.ids = np.array([r["vec_id"] for r in rows], dtype=np.int64)
        self.labels = np.array([r["label"] for r in rows], dtype=np.int64)
        x = np.zeros((len(rows), dim))
        for i, r in enumerate(rows):
            x[i, : len(r["vec"])] = r["vec"]
        self.x = scaled(x, scale)

    def add_positives(self, found: list, k: int, low: int, high: int) -> None:
        """found: anchor (its place), vec_id, score.  Places that stay free have limits that nothing meets."""
        n = len(self.ids)
        self.positive, self.score = np.zeros((n, k), np.int64), np.zeros((n, k), np.int64)
        self.least, self.most = np.full((n, k), _LONG), np.full((n, k), -_LONG)
        used = np.zeros(n, np.int64)
        for r in found:
            i = r["anchor"]
            j = used[i]
            self.positive[i, j], self.score[i, j] = r["vec_id"], r["score"]
            self.least[i, j], self.most[i, j] = limits(r["score"], low, high)
            used[i] += 1


def _parts(batch: pa.RecordBatch, dim: int, scale: float, rows: int = 2048) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """ids, labels and scaled vectors of slices of a batch, each in order of id."""
    for at in range(0, batch.num_rows, rows):
        part = batch.slice(at, rows)
        ids = part.column(0).to_numpy()
        order = np.argsort(ids, kind="stable")
        yield ids[order], part.column(1).to_numpy()[order], scaled(matrix(part.column(2), dim), scale)[order]


class _Kept:
    """The first k entries of each group so far; what is added is cut down whenever it has grown large."""

    def __init__(self, k: int) -> None:
        self.k, self.parts, self.size, self.cut = k, [], 0, 1 << 18

    def add(self, group: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        self.parts.append((group, score, ident))
        self.size += len(group)
        if self.size > self.cut:
            self.parts = [self.first()]
            self.size = len(self.parts[0][0])
            self.cut = max(1 << 18, 2 * self.size)

    def first(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            return tuple(np.zeros(0, np.int64) for _ in range(3))
        group, score, ident = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        own = best(self.k, group, score, ident)
        return group[own], score[own], ident[own]


_FOUND = pa.schema([("anchor", pa.int32()), ("place", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])
FOUND = "anchor int, place int, vec_id long, score long"


def _positives(block, dim: int, scale: float, k: int):
    """Of each anchor the first k rows of its label that this task reads, itself left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = block.value
        of = {label: np.flatnonzero(b.labels == label) for label in np.unique(b.labels)}
        kept = _Kept(k)
        for batch in batches:
            for ids, labels, x in _parts(batch, dim, scale):
                for label in np.unique(labels):
                    anchors = of.get(label)
                    if anchors is None:
                        continue
                    own = np.flatnonzero(labels == label)
                    s = scores(b.x[anchors], x[own])
                    others = ids[own][None, :] != b.ids[anchors][:, None]
                    order = np.argsort(np.where(others, -s, _LONG), axis=1, kind="stable")[:, : k + 1]
                    i, j = np.nonzero(np.take_along_axis(others, order, axis=1))
                    at = order[i, j]
                    kept.add(anchors[i], s[i, at], ids[own][at])
        group, score, ident = kept.first()
        yield record(_FOUND, [group, np.zeros(len(group), np.int32), ident, score])

    return run


def _negatives(block, dim: int, scale: float, k: int, anchors_at_once: int = 256):
    """Of each anchor's positives the first k different-label rows inside the limits that this task reads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = block.value
        wide = b.positive.shape[1]
        kept = _Kept(k)
        steps = np.arange(1, k + 1)
        for batch in batches:
            for ids, labels, x in _parts(batch, dim, scale):
                for first in range(0, len(b.ids), anchors_at_once):
                    s = scores(b.x[first : first + anchors_at_once], x)
                    order = np.argsort(-s, axis=1, kind="stable")  # rows are in order of id
                    s = np.take_along_axis(s, order, axis=1)
                    upto = np.cumsum(labels[order] != b.labels[first : first + len(s), None], axis=1)
                    for i in range(len(s)):
                        a = first + i
                        start = np.searchsorted(-s[i], -b.most[a], "left")
                        before = np.where(start > 0, upto[i][start - 1], 0)
                        at = np.searchsorted(upto[i], before[:, None] + steps)  # the next different-label entries
                        inside = np.minimum(at, len(ids) - 1)
                        j, c = np.nonzero((at < len(ids)) & (s[i][inside] >= b.least[a][:, None]))
                        if len(j):
                            own = at[j, c]
                            kept.add(a * wide + j, s[i][own], ids[order[i][own]])
        group, score, ident = kept.first()
        yield record(_FOUND, [group // wide, group % wide, ident, score])

    return run


def _first(found: DataFrame, k: int) -> DataFrame:
    place = "row_number() over (partition by anchor, place order by score desc, vec_id)"
    return found.withColumn("rank", F.expr(place)).filter(F.col("rank") <= k)


def mine(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: float = 256.0) -> DataFrame:
    """rows: vec_id, label, vec.  anchors: condition on vec_id and label.  One row per anchor, positive and negative.

    An anchor's positives are its `positives` best other rows of its label; a positive's negatives the `negatives`
    best rows of other labels with low % to high % of its score.  Blocks of anchors are jobs of their own."""
    spark = rows.sparkSession
    own = rows.filter(F.col("label").isNotNull() & finite(F.col("vec"))).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("vec").cast("array<double>").alias("vec"))
    own = materialize(one_per_id(own, "label", "vec"), "vectors")
    size = own.agg(F.max(F.size("vec")).alias("dim"), F.count_if(anchors).alias("n")).first()
    dim = max(1, size["dim"] or 1)
    blocks = max(1, -(-size["n"] * dim * 8 // BLOCK_BYTES))
    chosen = materialize(own.filter(anchors).withColumn("block", F.expr(f"pmod(xxhash64(vec_id), {blocks})")), "anchors")
    kind = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    out = materialize(spark.createDataFrame([], kind), "negatives")
    for number in range(blocks if size["n"] else 0):
        block = Block(chosen.filter(F.col("block") == number).orderBy("vec_id").collect(), dim, scale)  # BLOCK_BYTES or so
        shared = spark.sparkContext.broadcast(block)
        near = own.mapInArrow(_positives(shared, dim, scale, positives), FOUND)
        block.add_positives(_first(near, positives).orderBy("anchor", "rank").collect(), positives, low, high)  # `positives` rows an anchor
        full = spark.sparkContext.broadcast(block)
        names = [(i, j, int(block.ids[i]), int(block.positive[i, j]), int(block.score[i, j])) for i, j in zip(*np.nonzero(block.least <= block.most), strict=True)]
        names = [(int(i), int(j), a, p, s) for i, j, a, p, s in names]
        if names:
            named = F.broadcast(spark.createDataFrame(names, "anchor int, place int, anchor_id long, positive_id long, positive_score long"))
            read = _first(own.mapInArrow(_negatives(full, dim, scale, negatives), FOUND), negatives).join(named, ["anchor", "place"])
            extend(out, read.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
        shared.unpersist()
        full.unpersist()
    forget(own, chosen)
    return spark.read.schema(kind).parquet(out._written)
