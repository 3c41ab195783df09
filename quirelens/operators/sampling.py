"""Balanced, seeded question sets: strata, round robin, quotas, behaviours, templates, topics, numbering.

Every draw is a hash of seed, purpose and key, so that no draw depends on another or on the order
of work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import choose, constraints, draw, uniform, weighted
from ..schema import BEHAVIOUR_MIX
from .matching import with_choice
from .selection import by_rank
from .stressors import sampling_stressors, signature
from .topics import numbers_in

SEED = 20260204


def strata(ann: DataFrame) -> DataFrame:
    return ann.withColumn("stressors", sampling_stressors()).withColumn("sig", signature(F.col("stressors"))).withColumn("file_type", F.lower("file_type"))


def ranked(rows: DataFrame, seed: int = SEED) -> DataFrame:
    """r: place inside (file_type, sig) in shuffled order, from 1; hs: shuffled order of the buckets."""
    rows = rows.withColumn("_h", draw(seed, "doc", F.col("file_type"), F.col("doc_id"))).withColumn("hs", draw(seed, "sig", F.col("file_type"), F.col("sig")))
    return rows.withColumn("r", F.expr("row_number() over (partition by file_type, sig order by _h, ordinal)")).drop("_h")


def round_robin(rows: DataFrame, target: int, seed: int = SEED) -> DataFrame:
    """The first `target` rows per file_type when buckets take turns; pick: 1, 2, ...

    Only the first `target` of a bucket can be taken, so each bucket is cut to them before the rows of
    a file_type meet."""
    own = ranked(rows, seed).filter(F.col("r") <= target)
    return own.withColumn("pick", F.expr("row_number() over (partition by file_type order by r, hs, sig)")).filter(F.col("pick") <= target)


def round_robin_replacement(rows: DataFrame, target: int, seed: int = SEED) -> DataFrame:
    """As round_robin, but each bucket gives a row in every round: its r-th, then drawn ones again.

    Only the ranks that are picked are looked for (see `selection.by_rank`): no bucket is sorted whole."""
    own = rows.withColumn("_h", draw(seed, "doc", F.col("file_type"), F.col("doc_id")))
    sizes = own.groupBy("file_type", "sig").agg(F.count("*").alias("n")).withColumn("hs", draw(seed, "sig", F.col("file_type"), F.col("sig")))
    sizes = sizes.withColumn("rounds", F.expr(f"cast(ceil({target} / count(*) over (partition by file_type)) as int)"))
    turns = sizes.select("file_type", "sig", "hs", "n", F.explode(F.expr("sequence(1, rounds)")).alias("turn"))
    again = F.try_mod(draw(seed, "again", F.col("file_type"), F.col("sig"), F.col("turn")), F.col("n")) + 1
    turns = turns.withColumn("r", F.when(F.col("turn") <= F.col("n"), F.col("turn")).otherwise(again).cast("long"))
    picked = turns.withColumn("pick", F.expr("row_number() over (partition by file_type order by turn, hs, sig)")).filter(F.col("pick") <= target)
    picked = picked.select("file_type", "sig", "r", "turn", "pick")
    return picked.join(by_rank(own, picked, ["file_type", "sig"], "_h", ["ordinal"]).drop("_h"), ["file_type", "sig", "r"])


def question_set(ann: DataFrame, templates: DataFrame, topics: list[str], per_file_type: int = 50, queries_per_doc: int = 2, seed: int = SEED, replacement: bool = False, mix: dict[str, float] | None = None, text: str | None = None, title: str | None = None, domain: str = "hr") -> DataFrame:
    """id, query, domain, expected_behavior, chunk lists, answer_constraints, doc_id, file_type, stressors, generation.

    text and title name columns of ann that ground topics and titles; without them titles are doc_ids."""
    target = max(1, -(-per_file_type // queries_per_doc))
    rows = strata(ann)
    picked = (round_robin_replacement if replacement else round_robin)(rows, target, seed)
    items = picked.withColumn("k", F.explode(F.expr(f"sequence(1, {queries_per_doc})")))
    items = items.withColumn("_place", (F.col("pick") - 1) * queries_per_doc + F.col("k")).filter(F.col("_place") <= per_file_type)
    key = (F.col("file_type"), F.col("pick"), F.col("k"))
    items = items.withColumn("expected_behavior", weighted(uniform(draw(seed, "behaviour", *key)), mix or BEHAVIOUR_MIX))
    items = with_choice(items, templates, draw(seed, "template", *key))
    every = rows.sparkSession.createDataFrame(list(enumerate(topics)), "_topic long, topic string")
    own = draw(seed, "topic", *key)
    if text:
        hits = numbers_in(rows.sparkSession, F.col(text), topics)
        items = items.withColumn("_hits", hits).withColumn("_topic", F.coalesce(choose(F.col("_hits"), own).cast("long"), F.try_mod(own, F.lit(len(topics)))))
    else:
        items = items.withColumn("_topic", F.try_mod(own, F.lit(len(topics))))
    items = items.join(every, "_topic", "left")
    name = F.coalesce(F.col(title), F.col("doc_id").cast("string")) if title else F.col("doc_id").cast("string")
    query = F.replace(F.replace(F.replace(F.col("query"), F.lit("{topic}"), F.col("topic")), F.lit("{doc_title}"), name), F.lit("{doc_id}"), F.col("doc_id").cast("string"))
    none = F.array().cast("array<string>")
    numbered = items.withColumn("_n", F.expr("row_number() over (order by file_type, pick, k)"))  # bounded: types x per_file_type rows
    return numbered.select(
        F.format_string("q_%06d", F.col("_n")).alias("id"),
        query.alias("query"),
        F.lit(domain).alias("domain"),
        "expected_behavior",
        none.alias("required_chunks"),
        none.alias("optional_chunks"),
        none.alias("forbidden_chunks"),
        constraints(F.col("expected_behavior")).alias("answer_constraints"),
        F.struct("doc_id", "file_type", "profile").alias("doc_annotation"),
        "stressors",
        F.struct("template_id", F.col("file_type").alias("category_key"), F.col("sig").alias("stressor_signature"), F.lit(seed).cast("bigint").alias("seed"), F.lit(bool(text)).alias("ground_with_content")).alias("generation"),
        "tier",
    )


def question_stats(questions: DataFrame) -> DataFrame:
    """kind, key, n of a question set: by type, by behaviour, 20 signatures, 30 stressors."""

    def by(kind: str, key: Column, k: int | None = None) -> DataFrame:
        rows = questions.groupBy(key.alias("key")).agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "key", "n")
        return rows.orderBy(F.desc("n"), "key").limit(k) if k else rows

    out = by("file_type", F.col("doc_annotation.file_type")).unionByName(by("expected_behavior", F.col("expected_behavior")))
    out = out.unionByName(by("signature", F.col("generation.stressor_signature"), 20))
    each = questions.select(F.explode("stressors").alias("key")).groupBy("key").agg(F.count("*").alias("n")).select(F.lit("stressor").alias("kind"), "key", "n")
    return out.unionByName(each.orderBy(F.desc("n"), "key").limit(30))
