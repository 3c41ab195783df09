"""Training-corpus pipeline: toxicity, n-gram Jaccard join, suffix-array dedup, benchmark decontamination, best-fit packing.

Each stage takes (spark, docs, sf_dir), works on all rows it gets, and is written and reread before
the next.  All but the last return the columns of documents; the last returns packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quirelens.llm import decontaminate, ngram_join, packing, suffix_dedup, toxicity
from quirelens.llm.common import forget, materialize, table
from quirelens.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain predicts toxic go."""
    return toxicity.drop_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by shingle Jaccard similarity, that with the least id stays (five words, 0.8)."""
    return ngram_join.keep_first(docs, width=5, num=80, den=100)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes under strings of 200 that stand elsewhere too are cut out of the texts."""
    return suffix_dedup.remove_repeats(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining texts, packed into sequences of at most 4096 tokens."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("ngram_join", keep_one_of_each_group),
    ("suffix_dedup", cut_repeats),
    ("decontaminate", drop_contaminated),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, name)
            if before is not None:
                forget(before)
            before = docs
    return docs


#: The first stage is a fitted classifier, which SQL cannot express; tests/llm holds run() against brute force.
ORACLE_SQL = None
