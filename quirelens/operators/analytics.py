"""Distributions, combinations, buckets, gaps and advice over annotations, each one aggregate.

`by` puts grouping columns first, so that every analysis also runs per folder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import EXPECTED_TYPES, TAGS
from .stressors import analysis_stressors, tag


def _rows(c: str = "n") -> Column:
    return F.count("*").alias(c)


def counts(ann: DataFrame, key: str, by: Sequence[str] = ()) -> DataFrame:
    """key, n, first_ordinal, share; ties of n are in order of first appearance."""
    per = ann.groupBy(*by, key).agg(_rows(), F.min("ordinal").alias("first_ordinal"))
    total = F.sum("n").over(Window.partitionBy(*by)) if by else F.sum("n").over(Window.partitionBy(F.lit(0)))
    return per.withColumn("share", F.col("n") / total)


def grouped_counts(ann: DataFrame) -> DataFrame:
    """Totals, by type and by folder in one pass: kind, key, n."""
    rows = ann.groupingSets([["file_type"], ["folder"], []], "file_type", "folder").agg(_rows(), F.grouping_id().alias("g"))
    kind = F.when(F.col("g") == 1, "file_type").when(F.col("g") == 2, "folder").otherwise("total")
    return rows.select(kind.alias("kind"), F.when(F.col("g") == 1, F.col("file_type")).when(F.col("g") == 2, F.col("folder")).alias("key"), "n")


def tag_distribution(ann: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """tag, n_true, n_false, n_na, true_rate (over rows with a value) of every tag, in one aggregate."""
    sums = [F.count_if(test(tag(t))).alias(f"{k}{i}") for i, t in enumerate(TAGS) for k, test in (("t", lambda c: c), ("f", lambda c: ~c), ("n", lambda c: c.isNull()))]
    one = ann.groupBy(*by).agg(*sums) if by else ann.agg(*sums)
    stack = ", ".join(f"'{t}', t{i}, f{i}, n{i}" for i, t in enumerate(TAGS))
    rows = one.selectExpr(*by, f"stack({len(TAGS)}, {stack}) as (tag, n_true, n_false, n_na)")
    return rows.withColumn("true_rate", F.try_divide(F.col("n_true").cast("double"), (F.col("n_true") + F.col("n_false")).cast("double")))


FLAGS = ("has_image", "has_table", "has_image_table", "has_complex_table", "has_formula", "has_chart")


def flag_totals(ann: DataFrame) -> DataFrame:
    """One row: how many documents have each of the six flags."""
    return ann.agg(*[F.count_if(F.coalesce(F.col(f"profile.{f}"), F.lit(False))).alias(f) for f in FLAGS])


def layout_distribution(ann: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    named = ann.withColumn("layout", F.coalesce("profile.layout", F.lit("unknown")))
    return named.groupBy(*by, "layout").agg(_rows(), F.min("ordinal").alias("first_ordinal"))


def with_stressors(ann: DataFrame) -> DataFrame:
    return ann.withColumn("stressors", analysis_stressors()).withColumn("stressor_count", F.size("stressors"))


def stressor_histogram(ann: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return with_stressors(ann).groupBy(*by, "stressor_count").agg(_rows())


def stressor_counts(ann: DataFrame) -> DataFrame:
    return with_stressors(ann).select("ordinal", F.explode("stressors").alias("stressor")).groupBy("stressor").agg(_rows(), F.min("ordinal").alias("first_ordinal"))


def combinations(ann: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Each sorted combination of stressors (none left out): combo, n, first_ordinal."""
    rows = with_stressors(ann).filter("stressor_count > 0").withColumn("combo", F.array_sort("stressors"))
    return rows.groupBy(*by, "combo").agg(_rows(), F.min("ordinal").alias("first_ordinal"))


def top_combinations(ann: DataFrame, k: int = 20) -> DataFrame:
    return combinations(ann).orderBy(F.desc("n"), "first_ordinal").limit(k)


def rare_combinations(ann: DataFrame, most: int = 2, k: int = 20) -> DataFrame:
    return combinations(ann).filter(F.col("n") <= most).orderBy("first_ordinal").limit(k)


def high_complexity(ann: DataFrame, threshold: int = 3, by: Sequence[str] = ()) -> DataFrame:
    """doc_id, file_type (of the first row with that id), stressor_count, stressors, ordinal."""
    first = ann.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min_by("file_type", "ordinal").alias("first_type"))
    rows = with_stressors(ann).filter(F.col("stressor_count") >= threshold)
    kind = F.coalesce("first_type", F.lit("unknown"))
    named = rows.join(first, "doc_id", "left").select(*by, "ordinal", "doc_id", kind.alias("file_type"), "stressor_count", "stressors")
    return named.orderBy(F.desc("stressor_count"), "ordinal")


def bucket_level1(ann: DataFrame) -> DataFrame:
    """file_type, n, first_ordinal; who is in it: `bucket_members`."""
    return ann.groupBy("file_type").agg(_rows(), F.min("ordinal").alias("first_ordinal"))


def bucket_key() -> Column:
    p = "profile."
    parts = [F.concat(F.lit("layout="), F.coalesce(p + "layout", F.lit("single")))]
    parts += [F.when(F.col(p + n), n.split(".")[-1]) for n in ("has_table", "has_chart", "has_image", "table_profile.cross_page_table", "table_profile.long_table")]
    return F.array_join(F.array_sort(F.filter(F.array(*parts), lambda x: x.isNotNull())), " | ")


def _level2(ann: DataFrame, file_type: str) -> DataFrame:
    return ann.filter(F.col("file_type") == file_type).withColumn("bucket", bucket_key())


def bucket_level2(ann: DataFrame, file_type: str = "pdf") -> DataFrame:
    return _level2(ann, file_type).groupBy("bucket").agg(_rows(), F.min("ordinal").alias("first_ordinal"))


def bucket_members(ann: DataFrame, file_type: str = "pdf") -> DataFrame:
    """level, bucket, ordinal, doc_id: one row per document and bucket, so that no bucket is ever one row's list."""
    one = ann.select(F.lit(1).alias("level"), F.col("file_type").alias("bucket"), "ordinal", "doc_id")
    return one.unionByName(_level2(ann, file_type).select(F.lit(2).alias("level"), "bucket", "ordinal", "doc_id"))


def sparse_buckets(ann: DataFrame, threshold: int = 3) -> DataFrame:
    """Buckets of both levels with fewer than threshold rows: bucket, n, threshold."""
    one = bucket_level1(ann).select(F.concat(F.lit("file_type="), F.col("file_type")).alias("bucket"), "n")
    two = bucket_level2(ann).select(F.concat(F.lit("pdf/"), F.col("bucket")).alias("bucket"), "n")
    return one.unionByName(two).filter(F.col("n") < threshold).withColumn("threshold", F.lit(threshold))


def missing_features(ann: DataFrame) -> DataFrame:
    return tag_distribution(ann).filter("n_true = 0").select("tag")


def file_type_gaps(ann: DataFrame, expected: Sequence[str] = EXPECTED_TYPES) -> DataFrame:
    """Expected types that no annotation has."""
    spark = ann.sparkSession
    return spark.createDataFrame([(t,) for t in expected], "file_type string").join(ann.select("file_type").distinct(), "file_type", "left_anti")


def gap_report(ann: DataFrame, threshold: int = 3) -> DataFrame:
    """All gaps as rows: kind, key, n, threshold."""
    none = F.lit(None).cast("bigint")
    a = missing_features(ann).select(F.lit("missing_feature").alias("kind"), F.col("tag").alias("key"), none.alias("n"), none.alias("threshold"))
    b = file_type_gaps(ann).select(F.lit("file_type_gap").alias("kind"), F.col("file_type").alias("key"), none.alias("n"), none.alias("threshold"))
    c = sparse_buckets(ann, threshold).select(F.lit("sparse_bucket").alias("kind"), F.col("bucket").alias("key"), "n", F.col("threshold").cast("bigint").alias("threshold"))
    return a.unionByName(b).unionByName(c)


def needs_replacement(ann: DataFrame, least: int = 5) -> DataFrame:
    return ann.groupBy("file_type").agg(_rows()).filter(F.col("n") < least)


def sampling_advice(ann: DataFrame, threshold: int = 3, complexity: int = 3) -> DataFrame:
    """One row: per_file_type, queries_per_doc, needs_replacement, sparse, priority_docs, priority_docs_count."""
    per = ann.groupBy("file_type").agg(_rows(), F.min("ordinal").alias("o"))
    low = F.min("n")
    types = per.agg(
        F.when(low > 0, F.least(low * 2, F.lit(50))).otherwise(10).alias("per_file_type"),
        F.transform(F.array_sort(F.collect_list(F.when(F.col("n") < 5, F.struct("o", "file_type")))), lambda x: x["file_type"]).alias("needs_replacement"),
    )
    high = with_stressors(ann).filter(F.col("stressor_count") >= complexity)
    top = high.orderBy(F.desc("stressor_count"), "ordinal").limit(20).agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("stressor_count")).alias("k"), "ordinal", "doc_id"))), lambda x: x["doc_id"]).alias("priority_docs"))
    n = high.agg(F.count("*").alias("priority_docs_count"))
    sparse = sparse_buckets(ann, threshold).agg(F.array_sort(F.collect_list("bucket")).alias("sparse"))
    # four frames of one row each
    out = types.crossJoin(sparse).crossJoin(top).crossJoin(n)
    return out.withColumn("queries_per_doc", F.lit(2)).withColumn("allow_replacement", F.size("needs_replacement") > 0)


def full_analysis(ann: DataFrame, threshold: int = 3, complexity: int = 3) -> dict[str, DataFrame]:
    """All analyses over one persisted frame; call unpersist() on the result's `ann` when done."""
    own = ann.persist()
    return {
        "ann": own,
        "file_types": counts(own, "file_type"),
        "folders": counts(own, "folder"),
        "tags": tag_distribution(own),
        "layouts": layout_distribution(own),
        "histogram": stressor_histogram(own),
        "combinations": combinations(own),
        "top_combinations": top_combinations(own),
        "rare_combinations": rare_combinations(own),
        "high_complexity": high_complexity(own, complexity),
        "level1": bucket_level1(own),
        "level2": bucket_level2(own),
        "members1": own.select("file_type", "ordinal", "doc_id"),
        "members2": _level2(own, "pdf").select("bucket", "ordinal", "doc_id"),
        "gaps": gap_report(own, threshold),
        "advice": sampling_advice(own, threshold, complexity),
    }

