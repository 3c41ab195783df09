"""The pipeline's stages one after another against brute force on a small corpus."""

import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    random.seed(11)
    sf = "/root/testdata/sf0.001"
    at = tmp_path_factory.mktemp("corpus")
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(120)
    words = [f"{a}{b}" for a in ("lor", "ips", "dol", "sit") for b in ("em", "um", "or", "amet", "ine", "est")]
    say = lambda n: " ".join(random.choice(words) + str(random.randrange(40)) for _ in range(n))
    base, passage = say(200), say(60)
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    leak = bench.first()["text"]
    extra = [base, base, base.replace("lorem1", "zz", 1), say(50) + " " + passage + " " + say(50), say(60) + " " + passage + " " + say(40), say(30) + " " + leak + " " + say(30), "you idiot you stupid moron " + say(20), None, ""]
    rows = [(10_000 + i, t, "en", "x", None if t is None else len(t)) for i, t in enumerate(extra)]
    docs.unionByName(spark.createDataFrame(rows, docs.schema)).write.parquet(f"{at}/documents.parquet")
    spark.read.parquet("/root/testdata/sf0.01/labels.parquet").write.parquet(f"{at}/labels.parquet")
    bench.write.parquet(f"{at}/benchmark.parquet")
    return str(at)


def test_stages(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, corpus).persist()
        if name != "packing":
            assert out.columns == columns
        seen[name] = (docs, out)
        docs = out
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    own = {k: ids(v[1]) for k, v in seen.items()}
    assert 10_007 in own["decontaminate"] and 10_008 in own["decontaminate"]
    assert {10_000} == own["ngram_join"] & {10_000, 10_001, 10_002}
    before = {r["doc_id"]: r["text"] for r in seen["suffix_dedup"][0].collect()}
    after = {r["doc_id"]: r["text"] for r in seen["suffix_dedup"][1].collect()}
    assert all(len(after[i]) < len(before[i]) for i in (10_003, 10_004))
    count = {}
    for t in before.values():
        b = (t or "").encode()
        for i in range(len(b) - 199):
            count[b[i : i + 200]] = count.get(b[i : i + 200], 0) + 1
    for i, t in before.items():
        b = (t or "").encode()
        gone = set()
        for k in range(len(b) - 199):
            if count[b[k : k + 200]] > 1:
                gone.update(range(k, k + 200))
        want = None if t is None else bytes(x for k, x in enumerate(b) if k not in gone).decode("utf-8", "ignore")
        assert after[i] == want
    assert 10_005 not in own["decontaminate"] and own["decontaminate"] <= own["suffix_dedup"]
    assert own["packing"] == own["decontaminate"]


def test_run_is_the_stages_and_registered(spark, corpus):
    import __spark_entry__ as e

    assert e.queries()["pipeline"] is corpus_pipeline.run
    assert {f"op{n}" for n in range(1, 14)} == {m[1] for k in e.queries() if (m := re.match(r"(op\d+)_", k))}
    assert corpus_pipeline.run(spark, corpus).count() > 100


def test_stages_of_nothing_and_of_odd_columns(spark, corpus, tmp_path):
    """Empty tables give empty ones; columns that stages might use for themselves come through."""
    odd = ("_0", "_1", "_n", "_q0", "_Q1", "_spans", "key0", "node", "keep", "h", "th", "words", "salt")
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    for c in odd:
        docs = docs.withColumn(c, F.concat(F.lit(f"{c}:"), "doc_id"))
    columns = docs.columns
    docs.filter("doc_id >= 9990 or doc_id < 20").unionByName(docs.filter("doc_id = 10007")).write.parquet(f"{tmp_path}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{corpus}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    rows = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, rows, str(tmp_path)).persist()
        assert rows.columns == columns, name
        assert all(r[c] == f"{c}:{r['doc_id']}" for r in rows.collect() for c in odd), name
    assert rows.filter("doc_id = 10007").count() == 1 and corpus_pipeline.STAGES[-1][1](spark, rows, str(tmp_path)).count() >= rows.count()
    none = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, str(tmp_path)).count() == 0, name
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{corpus}/{t}.parquet").limit(0).write.mode("overwrite").parquet(f"{tmp_path}/none/{t}.parquet")
    some = docs.filter("doc_id < 5")
    assert corpus_pipeline.drop_toxic(spark, some, f"{tmp_path}/none").count() == corpus_pipeline.drop_contaminated(spark, some, f"{tmp_path}/none").count() == some.count()
