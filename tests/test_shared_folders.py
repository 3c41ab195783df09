"""Queries that write files of their own on a cluster whose checkpoint folder is mounted on all machines, without a scheme of its own."""

import re
import uuid
from collections import Counter

import pytest

from quirelens import catalog
from quirelens.operators import partials
from quirelens.plans.tables import annotations
from quirelens.sources import files

SF = "/root/testdata/sf0.001"


@pytest.fixture
def cluster(spark, tmp_path, monkeypatch):
    """The session as a standalone master would have it; its executors are here, so they see the folder (that of the session's own settings, if it has one)."""
    at = tmp_path / "shared"
    at.mkdir()
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    monkeypatch.setattr(spark.sparkContext, "getCheckpointDir", lambda: f"file://{at}")
    return spark


@pytest.fixture
def mounted(spark, tmp_path, monkeypatch):
    """The session with a checkpoint folder behind a mount table, which only Spark's file systems know."""
    at = tmp_path / "behind"
    at.mkdir()
    table = f"t{uuid.uuid4().hex}"
    spark._jsc.hadoopConfiguration().set(f"fs.viewfs.mounttable.{table}.link./shared", f"file://{at}")
    monkeypatch.setattr(files, "_checkpoint_dir", lambda _: f"viewfs://{table}/shared")
    return spark


def bag(df):
    return Counter(tuple(str(x) for x in r) for r in df.collect())


def test_annotate_stream(cluster):
    assert bag(catalog.QUERIES["annotate_stream"](cluster, SF)) == bag(catalog.QUERIES["annotate_documents"](cluster, SF))


def test_annotation_files(cluster):
    assert bag(catalog.QUERIES["annotation_files"](cluster, SF)) == bag(catalog.QUERIES["annotate_documents"](cluster, SF))


def test_incremental_counts(cluster):
    whole = partials.state(partials.facts(annotations(cluster, SF), "doc_id"))
    assert bag(catalog.QUERIES["incremental_counts"](cluster, SF)) == bag(whole)


def test_annotation_files_behind_a_mount_table(mounted):
    assert bag(catalog.QUERIES["annotation_files"](mounted, SF)) == bag(catalog.QUERIES["annotate_documents"](mounted, SF))


def test_incremental_counts_behind_a_mount_table(mounted):
    whole = partials.state(partials.facts(annotations(mounted, SF), "doc_id"))
    assert bag(catalog.QUERIES["incremental_counts"](mounted, SF)) == bag(whole)


def test_folders_of_one_machine_stay_refused(cluster, tmp_path):
    own = files.scratch(cluster)
    base = re.sub("^file:/+", "/", own.rpartition("/")[0])
    for path in (own, f"{base}/a", f"file://{base}/a", f"file:{base}", f"{base}/b/../a/"):
        assert files.qualified(cluster, path).startswith("file:/")
    for path in (f"{tmp_path}/other", f"{base}2/a", f"{base}/../other"):
        with pytest.raises(ValueError, match="folder of one machine"):
            files.qualified(cluster, path)
