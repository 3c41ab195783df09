"""Whole reports and ordered files against values made on the driver."""

import csv
import io
import json

import pytest
from pyspark.sql import functions as F

from quirelens.operators import sinks
from quirelens.operators.ordered import csv_line, write_ordered
from quirelens.plans.tables import annotations

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def ann(spark):
    rows = annotations(spark, SF).withColumn("doc_id", F.when(F.col("doc_id") % 50 == 7, None).when(F.col("doc_id") % 9 == 0, F.concat(F.lit('a "b", \\ é/'), F.col("doc_id"))).otherwise(F.col("doc_id").cast("string")))
    return rows.persist()


def test_ordered_file_is_all_pieces_in_order(spark, tmp_path):
    df = spark.range(0, 5000, numPartitions=7).select(F.col("id"), F.concat(F.lit("é"), F.repeat(F.lit("x"), (F.col("id") % 30).cast("int")), F.lit("\n")).alias("text"))
    want = "".join(f"é{'x' * (i % 30)}\n" for i in range(4999, -1, -1))
    for _ in range(2):  # the second time over the first
        assert write_ordered(df.repartition(5), [F.col("id").desc()], str(tmp_path / "d" / "f.txt"), b"head\n") == 5000
        assert (tmp_path / "d" / "f.txt").read_bytes() == b"head\n" + want.encode()
    assert write_ordered(df.filter("id < 0"), ["id"], str(tmp_path / "empty"), b"h") == 0 and (tmp_path / "empty").read_bytes() == b"h"
    assert sorted(p.name for p in tmp_path.iterdir()) == ["d", "empty"] and len(list((tmp_path / "d").iterdir())) == 1


def test_csv_lines_are_those_of_a_writer(spark):
    rows = [("a", 'b"c', None), ("x,y", "l\nm", ""), ("\r", " z ", "'"), ("", "", "é")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    for r, line in df.select("*", csv_line([F.col(c) for c in "abc"]).alias("line")).select(F.struct("a", "b", "c"), "line").collect():
        out = io.StringIO()
        csv.writer(out).writerow(["" if v is None else v for v in r])
        assert line == out.getvalue()


def test_flat_file_is_that_of_a_writer(ann, tmp_path):
    n = sinks.write_flat_file(ann, str(tmp_path / "f.csv"))
    rows = sinks.flat(ann.orderBy("ordinal"))
    with open(tmp_path / "want.csv", "w", encoding="utf-8-sig", newline="") as f:
        w = csv.writer(f)
        w.writerow(rows.columns)
        w.writerows(rows.collect())
    assert n == ann.count() and (tmp_path / "f.csv").read_bytes() == (tmp_path / "want.csv").read_bytes()


def test_reports_hold_whole_lists(spark, ann, tmp_path):
    full = sinks.all_reports(ann, str(tmp_path), "in", ("json", "csv"), named=2)
    whole = sinks.summary(ann, "in", named=10**6)
    for name, value in (("buckets", whole["buckets"]), ("stressor_combos", whole["stressor_combinations"]), ("gaps", whole["gaps"]), ("sampling_advice", whole["sampling_advice"])):
        assert (tmp_path / f"{name}.json").read_text() == json.dumps(value, ensure_ascii=False, indent=2, default=str)
    saved = json.loads((tmp_path / "summary.json").read_text())
    want = json.loads(json.dumps(whole, default=str))
    assert {k: v for k, v in saved.items() if k != "metadata"} == {k: v for k, v in want.items() if k != "metadata"}
    assert len(full["stressor_combinations"]["high_complexity_docs"]) == 2
    with open(tmp_path / "high_complexity_docs.csv", encoding="utf-8-sig", newline="") as f:
        lines = list(csv.reader(f))
    docs = whole["stressor_combinations"]["high_complexity_docs"]
    assert len(docs) > 20 and lines[1:] == [[d["doc_id"], d["file_type"], str(d["stressor_count"]), ", ".join(d["stressors"])] for d in docs]


def test_report_by_folder(spark, ann, tmp_path):
    sinks.folder_report(ann, str(tmp_path / "by_folder.json"))
    text = (tmp_path / "by_folder.json").read_text()
    saved = json.loads(text)
    assert text == json.dumps(saved, ensure_ascii=False, indent=2)
    order = [r["folder"] for r in ann.groupBy("folder").agg(F.min("ordinal").alias("o")).orderBy("o").collect()]
    assert list(saved) == order
    for folder in order[:3]:
        own = ann.filter(F.col("folder") == folder)
        alone = sinks.summary(own, named=10**6)
        assert saved[folder] == {k: json.loads(json.dumps(alone[k])) for k in ("basic_stats", "tag_distribution", "stressor_combinations")}
    sinks.folder_report(ann.limit(0), str(tmp_path / "none.json"))
    assert json.loads((tmp_path / "none.json").read_text()) == {}


def test_very_many_folders(spark, tmp_path):
    """Of folders, too, the driver sees none."""
    rows = annotations(spark, SF).limit(50)
    many = spark.range(0, 3000).select(F.col("id").alias("_k")).crossJoin(F.broadcast(rows.filter("doc_id = 3").limit(1))).withColumn("folder", F.concat(F.lit("f"), "_k")).withColumn("ordinal", F.col("_k"))
    sinks.folder_report(many, str(tmp_path / "f.json"))
    saved = json.loads((tmp_path / "f.json").read_text())
    assert len(saved) == 3000 and list(saved)[:2] == ["f0", "f1"] and all(v["basic_stats"]["total_files"] == 1 for v in saved.values())
