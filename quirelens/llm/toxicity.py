"""Toxicity by a classifier chain of linear models.

Categories are predicted in order, each by a logistic model that is also given the probabilities of
the categories before it.  The labels know one category (toxic), so two others are made from it and
from the words that it sets apart, and come first: `abuse` (a toxic text with a listed word) and
`severe` (with at least one in forty words).  They are predicted from the beginnings of words alone,
so that they speak of words that no list has yet; the last model sees listed words, beginnings, and
what the two have said.  For fitting, what they say is out-of-fold, and so are the lists: words and
beginnings are chosen anew from the other folds, so that a later model meets earlier ones as they
will be at scoring time.

Words are chosen by how far their document frequencies differ between labelled texts.  Scoring is
one pass over whole texts, no shuffle.

Null and empty texts: no words; their probabilities are those of an empty text, never toxic.  Very
long texts: read whole, in memory of their words.  Repeated rows: each is returned.  Ties among words
to choose: by spelling.  No usable labels, or of one class alone: all probabilities are 0.  An empty
table: no rows.  Extra columns: ignored by `score`, kept by `drop_toxic`, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, record, release
from .labelled import sample

CATEGORIES = ("abuse", "severe", "toxic")
_WORDS = re.compile(r"[^\W\d_]+")
#: Lengths of beginnings.
STARTS = (3, 4, 5)
LEAST_DOCS = 3
MOST = 300


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1.0, steps: int = 25, rows: int = 1000) -> np.ndarray:
    """Weights of a ridge logistic model, intercept last (not penalised).  Newton's steps, `rows` rows of x at a time."""
    size = x.shape[1] + 1
    w = np.zeros(size)
    penalty = np.full(size, l2)
    penalty[-1] = 1e-6
    for _ in range(steps):
        h, g = np.diag(penalty) + 1e-9 * np.eye(size), -penalty * w
        for a in range(0, len(y), rows):
            part = np.ones((len(y[a : a + rows]), size))
            part[:, :-1] = x[a : a + rows]
            p = sigmoid(part @ w)
            h += (part.T * (p * (1 - p))) @ part
            g += part.T @ (y[a : a + rows] - p)
        step = np.linalg.solve(h, g)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def predict_one(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return sigmoid(x @ w[:-1] + w[-1])


def words_of(text: str | None) -> list[str]:
    return _WORDS.findall((text or "").lower())


def starts_of(words: set[str]) -> set[str]:
    """Beginnings (with a dash) of words that are longer."""
    return {w[:k] + "-" for w in words for k in STARTS if len(w) > k}


def counts_in(text: str | None, at: list[dict[str, int]]) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Words of a text, listed words, how often each comes, listed beginnings."""
    words = words_of(text)
    cols, times = np.unique(np.array([at[0][w] for w in words if w in at[0]], dtype=np.int32), return_counts=True)
    own = {w for w in words if len(w) > STARTS[0]}
    return len(words), cols, times.astype(np.int32), np.array(sorted(at[1][s] for s in starts_of(own) if s in at[1]), dtype=np.int32)


def ones_like(arrays: list[np.ndarray]) -> list[np.ndarray]:
    return [np.ones(len(x), np.int32) for x in arrays]


class Table:
    """Which of some words, and of some beginnings, labelled texts have, and how often they have a word.

    Only what LEAST_DOCS toxic texts have can be chosen; nothing else is kept."""

    def __init__(self, names: list[list[str]], words: np.ndarray, cells: list[tuple[list[np.ndarray], list[np.ndarray]]]) -> None:
        """words: how many each text has.  cells: for words and for beginnings, the listed ones of every text and how often they come."""
        self.names, self.words, self.cells = names, words.astype(float), []
        none = [np.zeros(0, np.int32)]
        for cols, times in cells:
            row = np.repeat(np.arange(len(cols)), [len(x) for x in cols])
            self.cells.append((row, np.concatenate(cols or none), np.concatenate(times or none)))

    @staticmethod
    def of_texts(texts: list[str], toxic: np.ndarray) -> Table:
        often: list[Counter] = [Counter(), Counter()]
        for t, y in zip(texts, toxic, strict=True):
            if y:
                own = set(words_of(t))
                often[0].update(own)
                often[1].update(starts_of(own))
        names = [sorted(k for k, n in c.items() if n >= LEAST_DOCS) for c in often]
        at = [{t: i for i, t in enumerate(n)} for n in names]
        n, cols, times, starts = (list(c) for c in zip(*(counts_in(t, at) for t in texts), strict=True)) if texts else ([], [], [], [])
        return Table(names, np.array(n), [(cols, times), (starts, ones_like(starts))])

    @staticmethod
    def of_rows(got: DataFrame) -> tuple[Table, np.ndarray]:
        """The table and labels of rows (o, doc_id, text, y), in order of o; texts stay on the executors."""

        def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            schema = pa.schema([("kind", pa.int32()), ("term", pa.string())])
            for batch in batches:
                for text in batch.column("text"):
                    own = set(words_of(text.as_py()))
                    both = [sorted(own), sorted(starts_of(own))]
                    yield record(schema, [[0] * len(both[0]) + [1] * len(both[1]), both[0] + both[1]])

        often = got.filter("y = 1").mapInArrow(terms, "kind int, term string").groupBy("kind", "term").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_DOCS)
        found = often.select("kind", "term").collect()  # grows with the sample's bounded rows alone
        names = [sorted(r["term"] for r in found if r["kind"] == k) for k in (0, 1)]
        at = [{t: i for i, t in enumerate(n)} for n in names]

        def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            schema = pa.schema([("o", pa.int64()), ("doc_id", pa.int64()), ("y", pa.int32()), ("n", pa.int32()), *[(c, pa.binary()) for c in ("words", "times", "starts")]])
            for batch in batches:
                rows = [counts_in(t.as_py(), at) for t in batch.column("text")]
                yield record(schema, [batch.column("o"), batch.column("doc_id"), batch.column("y"), [r[0] for r in rows], *[[r[i].tobytes() for r in rows] for i in (1, 2, 3)]])

        kind = "o long, doc_id long, y int, n int, words binary, times binary, starts binary"
        rows = sorted(got.mapInArrow(cells, kind).collect(), key=lambda r: (r["o"], r["doc_id"]))  # MAX_ROWS at most
        toxic = np.array([r["y"] for r in rows], dtype=int)
        cols, times, starts = ([np.frombuffer(r[c], np.int32) for r in rows] for c in ("words", "times", "starts"))
        return Table(names, np.array([r["n"] for r in rows]), [(cols, times), (starts, ones_like(starts))]), toxic

    def choose(self, kind: int, rows: np.ndarray, toxic: np.ndarray) -> np.ndarray:
        """At most MOST columns found far more often in toxic ones of `rows` (a mask), by smoothed log odds over their standard error."""
        row, col, _ = self.cells[kind]
        size = len(self.names[kind])
        own = rows[row]
        pos, neg = (np.bincount(col[own & (toxic[row] == y)], minlength=size) for y in (1, 0))
        n1, n0 = max(1, int((rows & (toxic == 1)).sum())), max(1, int((rows & (toxic == 0)).sum()))
        odds = np.log((pos + 0.5) / (n1 + 1)) - np.log((neg + 0.5) / (n0 + 1))
        score = odds / np.sqrt(1 / (pos + 0.5) + 1 / (neg + 0.5))
        good = np.flatnonzero((pos >= LEAST_DOCS) & (odds > 2.0) & (score > 2.0))
        return good[np.lexsort((good, -score[good]))][:MOST]

    def dense(self, kind: int, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Presence of the columns in every text, and how often each text has one of them."""
        row, col, k = self.cells[kind]
        place = np.full(len(self.names[kind]) + 1, -1)
        place[columns] = np.arange(len(columns))
        at = place[col]
        out = np.zeros((len(self.words), len(columns)), dtype=np.float32)
        out[row[at >= 0], at[at >= 0]] = 1
        return out, np.bincount(row[at >= 0], weights=k[at >= 0], minlength=len(self.words))


def density(n: np.ndarray, present: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Log count of listed words, their share (1: one in twenty), log number of different ones."""
    return np.stack([np.log1p(n), np.minimum(1.0, 20 * n / np.maximum(20, words)), np.log1p(present.sum(axis=1))], axis=1)


class Chain:
    """Listed words and beginnings, and one weight vector per category."""

    def __init__(self, words: list[str], starts: list[str], weights: list[np.ndarray]) -> None:
        self.words, self.starts = ({t: i for i, t in enumerate(v)} for v in (words, starts))
        self.heads = {t[: STARTS[0]] for t in starts}
        self.weights = weights

    def features(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Listed words with their density; beginnings; how many listed words a text has."""
        x, s = np.zeros((len(texts), len(self.words))), np.zeros((len(texts), len(self.starts)))
        n, size = np.zeros(len(texts)), np.zeros(len(texts))
        for i, text in enumerate(texts):
            words = words_of(text)
            size[i] = len(words)
            hits = [self.words[w] for w in words if w in self.words]
            n[i] = len(hits)
            x[i, hits] = 1
            likely = {w for w in words if w[: STARTS[0]] in self.heads}
            s[i, [self.starts[b] for b in starts_of(likely) if b in self.starts]] = 1
        return np.hstack([x, density(n, x, size)]), s, n

    def predict(self, x: np.ndarray, s: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), len(CATEGORIES)))
        for k, w in enumerate(self.weights):
            out[:, k] = predict_one(np.hstack([s, out[:, :k]] if k < 2 else [x, s, out[:, :k]]), w)
        return out


def fit_chain(texts: list[str], toxic: np.ndarray, folds: int = 5) -> Chain:
    """Texts must come in an order that their labels do not know: folds are taken in turn."""
    return fit_table(Table.of_texts(texts, toxic), toxic, folds)


def fit_table(table: Table, toxic: np.ndarray, folds: int = 5) -> Chain:
    if not len(toxic) or toxic.min() == toxic.max():
        return Chain([], [], [])
    size = len(toxic)
    every = np.ones(size, dtype=bool)
    words, starts = table.choose(0, every, toxic), table.choose(1, every, toxic)
    x, n = table.dense(0, words)
    x = np.hstack([x, density(n, x, table.words).astype(np.float32)])
    s = table.dense(1, starts)[0]
    y = np.stack([toxic * (n > 0), toxic * (x[:, -2] >= 0.5), toxic], axis=1).astype(float)
    part = np.arange(size) % folds
    held, weights = np.zeros((size, 0), dtype=np.float32), []
    for k in range(2):
        own = np.zeros(size, dtype=np.float32)
        for f in range(folds):
            now = np.hstack([table.dense(1, table.choose(1, part != f, toxic))[0], held])
            own[part == f] = predict_one(now[part == f], fit_logistic(now[part != f], y[part != f, k]))
        weights.append(fit_logistic(np.hstack([s, held]), y[:, k]))
        held = np.hstack([held, own[:, None]])
    weights.append(fit_logistic(np.hstack([x, s, held]), y[:, 2]))
    return Chain([table.names[0][i] for i in words], [table.names[1][i] for i in starts], weights)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", **bounds) -> Chain:
    got = sample(docs, labels, label, **bounds)
    table, toxic = Table.of_rows(got)
    forget(got)
    chain = fit_table(table, toxic)
    del table
    release(docs.sparkSession)
    return chain


def _score(chain: Chain, slice_rows: int = 256):
    schema = pa.schema([("doc_id", pa.int64()), ("n_terms", pa.int64()), *[(f"p_{c}", pa.float64()) for c in CATEGORIES]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, slice_rows):
                part = batch.slice(at, slice_rows)
                x, s, n = chain.features(part.column(1).to_pylist())
                p = chain.predict(x, s)
                yield record(schema, [part.column(0), n.astype(np.int64), *[p[:, k] for k in range(len(CATEGORIES))]])

    return run, "doc_id long, n_terms long, " + ", ".join(f"p_{c} double" for c in CATEGORIES)


def score(docs: DataFrame, chain: Chain, threshold: float = 0.5) -> DataFrame:
    """One row per row of docs: doc_id, n_terms (listed words), p_abuse, p_severe, p_toxic, toxic."""
    fn, kind = _score(chain)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(fn, kind).withColumn("toxic", F.col("p_toxic") >= threshold)


def drop_toxic(docs: DataFrame, chain: Chain, threshold: float = 0.5) -> DataFrame:
    """Rows of docs that are not predicted toxic; all columns.  Judged in the row: no shuffle."""
    @F.pandas_udf("double")
    def p_toxic(text: pd.Series) -> pd.Series:
        parts = [chain.predict(*chain.features(list(text.iloc[a : a + 256]))[:2])[:, -1] for a in range(0, len(text), 256)]
        return pd.Series(np.concatenate(parts) if parts else [], dtype=float)

    return docs.filter(p_toxic(F.col("text")) < threshold)
