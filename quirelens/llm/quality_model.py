"""Quality scores by histogram gradient-boosted trees over document statistics.

Statistics are binned once by quantiles; each tree is grown from histograms of gradients; the whole
forest is flattened into five arrays and all trees are walked at once in numpy.  Labels, languages,
sources and ids are no inputs.  Scoring is one pass over whole texts, no shuffle.

Null and empty texts: statistics of an empty text, a score like any other.  Very long texts: read
whole, in memory of their words.  Repeated rows: each is returned.  Ties among splits: the first
statistic and the least threshold.  Without labels of both classes every score is their mean (0.5 if
there are none).  An empty table: no rows.  Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, record
from .labelled import sample

STATISTICS = (
    "log_words", "mean_word", "long_words", "upper", "digits", "pipes", "marks", "symbols", "punctuation", "not_ascii", "spaces",
    "line_words", "repeated_lines", "distinct_words", "top_word", "same_word_next", "repeated_triples", "capital_words", "end_marks", "short_words",
)


def statistics(text: str | None) -> list[float]:
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    words = (text or "").split()
    n, size = len(words), len(data)
    if not n:
        return [0.0] * len(STATISTICS)
    b = np.bincount(data, minlength=256)
    lines = [x for x in text.split("\n") if x.strip()]
    counts = Counter(words)
    triples = Counter(zip(words, words[1:], words[2:], strict=False)) if n > 2 else Counter()
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    return [
        float(np.log1p(n)),
        float(lengths.mean()),
        float((lengths > 14).mean()),
        b[65:91].sum() / size,
        b[48:58].sum() / size,
        b[124] / n,
        (b[33] + b[63]) / n,
        b[[35, 36, 37, 38, 42, 60, 62]].sum() / n,
        b[[44, 46, 58, 59]].sum() / n,
        b[128:].sum() / size,
        b[[32, 9, 10, 13]].sum() / size,
        n / max(1, len(lines)),
        1 - len(set(lines)) / max(1, len(lines)),
        len(counts) / n,
        max(counts.values()) / n,
        sum(map(str.__eq__, words, words[1:])) / n,
        1 - len(triples) / max(1, n - 2),
        sum(map(str.isupper, words)) / n,
        sum(w.endswith((".", "!", "?")) for w in words) / n,
        float((lengths <= 3).mean()),
    ]


class Forest:
    """Flattened trees: feature (-1: leaf), threshold, left, right, value; roots; and the base margin."""

    def __init__(self, base: float) -> None:
        self.base = base
        self.feature, self.threshold, self.left, self.right, self.value, self.roots = [], [], [], [], [], []
        self.depth = 0

    def freeze(self) -> Forest:
        self.feature = np.array(self.feature, dtype=np.int32)
        self.threshold = np.array(self.threshold, dtype=np.float64)
        self.left, self.right, self.roots = (np.array(v, dtype=np.int32) for v in (self.left, self.right, self.roots))
        self.value = np.array(self.value, dtype=np.float64)
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        if not len(self.roots) or not len(x):
            return np.full(len(x), 1 / (1 + np.exp(-self.base)))
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            f = self.feature[at]
            go_left = x[rows, np.maximum(f, 0)] <= self.threshold[at]
            at = np.where(f < 0, at, np.where(go_left, self.left[at], self.right[at]))
        return 1 / (1 + np.exp(-(self.base + self.value[at].sum(axis=1))))


def fit_forest(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.1, bins: int = 32, least: int = 12, l2: float = 2.0) -> Forest:
    mean = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    forest = Forest(float(np.log(mean / (1 - mean))))
    if not len(y) or y.min() == y.max():
        return forest.freeze()
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    margin = np.full(len(y), forest.base)
    forest.depth = depth

    def leaf(value: float) -> int:
        for v, c in ((forest.feature, -1), (forest.threshold, 0.0), (forest.left, 0), (forest.right, 0), (forest.value, value)):
            v.append(c)
        return len(forest.feature) - 1

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, level: int) -> int:
        gs, hs = g[rows].sum(), h[rows].sum()
        best = (1e-3, -1, -1)
        if level < depth and len(rows) >= 2 * least:
            for j, e in enumerate(edges):
                if not len(e):
                    continue
                k = len(e) + 1
                col = binned[rows, j]
                gl, hl, nl = (np.cumsum(np.bincount(col, weights=v, minlength=k))[:-1] for v in (g[rows], h[rows], np.ones(len(rows))))
                gain = gl**2 / (hl + l2) + (gs - gl) ** 2 / (hs - hl + l2) - gs**2 / (hs + l2)
                gain[(nl < least) | (len(rows) - nl < least)] = -1
                top = int(gain.argmax())
                if gain[top] > best[0]:
                    best = (float(gain[top]), j, top)
        if best[1] < 0:
            at = leaf(float(-rate * gs / (hs + l2)))
            margin[rows] += forest.value[at]
            return at
        at = leaf(0.0)
        go = binned[rows, best[1]] <= best[2]
        forest.feature[at], forest.threshold[at] = best[1], float(edges[best[1]][best[2]])
        forest.left[at] = grow(rows[go], g, h, level + 1)
        forest.right[at] = grow(rows[~go], g, h, level + 1)
        return at

    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        forest.roots.append(grow(np.arange(len(y)), p - y, p * (1 - p), 0))
    return forest.freeze()


HELD_OUT = "crc32(cast(cast(doc_id as string) as binary)) % 4 = 2"


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """o, doc_id, text, y to o, doc_id, y and the statistics."""
    schema = pa.schema([("o", pa.int64()), ("doc_id", pa.int64()), ("y", pa.int32()), ("x", pa.list_(pa.float64()))])
    for batch in batches:
        yield record(schema, [batch.column("o"), batch.column("doc_id"), batch.column("y"), [statistics(t.as_py()) for t in batch.column("text")]])


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", **bounds) -> Forest:
    """Fits on labelled rows that are not held out."""
    got = sample(docs, labels, label, where=~F.expr(HELD_OUT), **bounds)
    rows = sorted((r["o"], r["doc_id"], r["y"], r["x"]) for r in got.mapInArrow(_statistics, "o long, doc_id long, y int, x array<double>").collect())  # MAX_ROWS at most
    forget(got)
    x = np.array([r[3] for r in rows], dtype=np.float64).reshape(len(rows), len(STATISTICS))
    return fit_forest(x, np.array([r[2] for r in rows], dtype=np.float64))


def _score(forest: Forest, slice_rows: int = 512):
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, slice_rows):
                part = batch.slice(at, slice_rows)
                x = np.array([statistics(t) for t in part.column(1).to_pylist()], dtype=np.float64)
                yield record(schema, [part.column(0), forest.predict(x)])

    return run, "doc_id long, score double"


def score(docs: DataFrame, forest: Forest, threshold: float = 0.7) -> DataFrame:
    """One row per row of docs: doc_id, held_out, score, predicted."""
    fn, kind = _score(forest)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(fn, kind)
    return rows.select("doc_id", F.coalesce(F.expr(HELD_OUT), F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
