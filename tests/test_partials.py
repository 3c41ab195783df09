"""Merged partial counts against a recount of all annotations."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from quirelens.operators import analytics as A
from quirelens.operators import partials
from quirelens.plans.tables import annotations
from quirelens.sources import files

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def ann(spark):
    """With missing types, folders and layouts; files are named by the path."""
    rows = annotations(spark, SF).withColumn("file_type", F.when(F.col("doc_id") % 10 != 3, F.col("file_type"))).withColumn("folder", F.when(F.col("doc_id") % 7 != 2, F.col("folder")))
    return rows.withColumn("source_file", F.concat(F.lit("f"), F.col("doc_id"))).persist()


def bag(df):
    return Counter(tuple(str(x) for x in r) for r in df.collect())


def test_any_split_merges_to_the_whole(ann):
    whole = bag(partials.state(partials.facts(ann)))
    for by in (F.col("doc_id") % 5, F.floor(F.col("doc_id") / 40) % 3):
        parts = [partials.state(partials.facts(ann.filter(by == i))) for i in range(5)]
        assert bag(partials.merge(*parts)) == whole


def test_sections_equal_reports(ann):
    merged = partials.state(partials.facts(ann)).persist()
    for name, want in (
        ("file_type", A.bucket_level1(ann)),
        ("layout", A.layout_distribution(ann)),
        ("level2", A.bucket_level2(ann)),
        ("stressor", A.stressor_counts(ann)),
        ("combo", A.combinations(ann).withColumn("combo", F.array_join("combo", "|"))),
    ):
        assert bag(partials.section(merged, name)) == bag(want), name
    assert bag(partials.section(merged, "stressor_count", ["folder"]).drop("first_ordinal")) == bag(A.stressor_histogram(ann, ["folder"]))
    assert bag(partials.section(merged, "file_type", ["folder"])) == bag(A.counts(ann, "file_type", ["folder"]).drop("share"))
    assert bag(partials.tag_rates(merged)) == bag(A.tag_distribution(ann))
    assert bag(partials.tag_rates(merged, ["folder"])) == bag(A.tag_distribution(ann, ["folder"]))


def test_batches_and_files_annotated_again(spark, ann, tmp_path, monkeypatch):
    store = partials.Partials(spark, str(tmp_path))
    assert store.merged().count() == 0
    n = F.col("doc_id")
    older = ann.withColumn("file_type", F.lit("txt")).withColumn("ordinal", F.lit(-1).cast("long"))
    assert store.add(older.filter("doc_id % 3 = 0"), "a") == []
    assert store.add(ann.filter("doc_id % 3 = 1"), "b") == []
    assert store.add(ann.filter("doc_id % 3 = 0").filter(n % 2 == 0), "c") == ["a"]
    # a batch that stops before its record is written leaves what was there
    before = bag(store.merged())
    with monkeypatch.context() as m:
        m.setattr(partials, "write_bytes", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            store.add(ann.filter("doc_id % 3 = 2"), "d")
    assert bag(store.merged()) == before
    # a batch repeated under its name is there once
    for _ in range(2):
        assert store.add(ann.filter("doc_id % 3 = 2"), "d") == []
    assert store.add(ann.filter("doc_id % 6 = 3"), "e") == ["a"]
    assert bag(store.merged()) == bag(partials.state(partials.facts(ann)))


def test_one_more_batch_reads_states_alone(spark, ann, tmp_path):
    """What is merged comes from the states' files; no facts are read for batches that share no file."""
    store = partials.Partials(spark, str(tmp_path))
    store.add(ann.filter("doc_id % 2 = 0"), "a")
    store.add(ann.filter("doc_id % 2 = 1"), "b")
    assert {f.split("/")[-3] for f in store.merged().inputFiles() if f.endswith("parquet")} == {"state"}
    assert files.exists(spark, f"{tmp_path}/_versions/000000002.json")
    assert store.add(ann.limit(0), "empty") == [] and bag(store.merged()) == bag(partials.state(partials.facts(ann)))
