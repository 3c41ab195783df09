"""Bounded, reproducible samples of labelled texts for fitting classifiers.

Only rows are bounded, not texts: features are made of whole texts on the executors, and the driver
gets numbers alone, so that its memory grows with MAX_ROWS and with nothing else."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: Most rows of a sample (all rows are scored).
MAX_ROWS = 6000


def sample(docs: DataFrame, labels: DataFrame, label: str, where: Column | None = None, rows: int = MAX_ROWS) -> DataFrame:
    """o (a fixed pseudo-random order), doc_id, text, y: a written table of at most `rows` labelled documents.

    Texts of every length are drawn, whole.  Labels of one document that disagree, null ids, null labels and
    null texts are not drawn; of texts with one id, the least is taken."""
    own = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    if where is not None:
        own = own.filter(where)
    own = own.groupBy("doc_id").agg(F.min(label).alias("y"), F.max(label).alias("y2")).filter("y = y2")
    drawn = own.select("doc_id", F.col("y").cast("int").alias("y"), F.xxhash64("doc_id").alias("o")).orderBy("o", "doc_id").limit(rows)
    texts = docs.filter(F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("_d"), F.col("text").cast("string").alias("text"))
    found = texts.join(F.broadcast(drawn), F.col("_d") == F.col("doc_id")).groupBy("doc_id").agg(F.first("y").alias("y"), F.min("text").alias("text"), F.first("o").alias("o"))
    return materialize(found.select("o", F.col("doc_id").cast("long").alias("doc_id"), "text", "y"), "labelled")
