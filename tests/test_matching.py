"""Topics, templates, ranks, boxes and file names against brute force."""

import random
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quirelens import catalog
from quirelens.operators import elements, matching, sampling, selection, spatial
from quirelens.operators.topics import Matcher, blocks, numbers_in, topics_in
from quirelens.sources.documents import dot_prefixes, resolve

SF = "/root/testdata/sf0.01"
TEMPLATES = "ord int, id string, query string, expected_behavior string, stressors_any array<string>, file_types_any array<string>"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- topics -----------------------------------------------------------------------------------------


def contained(topics, text):
    return [i for i, t in enumerate(topics) if text and (t.split("/")[0] in text or t in text)]


def test_topics_against_contains():
    rng = random.Random(1)
    for trial in range(200):
        letters = ("ab", "abé中 /", "a")[trial % 3]
        topics = ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 20))) for _ in range(rng.randrange(1, 30))]
        texts = [None if rng.random() < 0.1 else "".join(rng.choice(letters) for _ in range(rng.randrange(0, 60))) for _ in range(30)]
        assert Matcher(topics).match(pa.array(texts, pa.string())) == [contained(topics, t) for t in texts]


def test_topics_as_columns(spark, monkeypatch):
    topics = ["b/x", "", "a", "/y", "long topic of many bytes", "ß", "a"]
    texts = ["a b", None, "", "ß", "a long topic of many bytes"] * 3
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k int, text string").repartition(3)
    got = {r["k"]: (r["n"], r["t"]) for r in df.select("k", numbers_in(spark, F.col("text"), topics).alias("n"), topics_in(spark, F.col("text"), topics).alias("t")).collect()}
    assert got == {i: (contained(topics, t), [topics[x] for x in contained(topics, t)]) for i, t in enumerate(texts)}
    monkeypatch.setattr("quirelens.operators.topics.BLOCK_BYTES", 20)
    assert len(blocks(topics)) > 2
    again = {r["k"]: r["n"] for r in df.select("k", numbers_in(spark, F.col("text"), topics).alias("n")).collect()}
    assert again == {k: n for k, (n, _) in got.items()}


def test_fifty_thousand_topics(spark):
    texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect() if r["text"]]
    rng = random.Random(3)
    words = " ".join(texts[:300])
    few = [words[p : p + rng.randrange(6, 20)] for p in (rng.randrange(len(words)) for _ in range(100))]
    many = few + ["#" + "".join(rng.choice("abcdefghij") for _ in range(12)) for _ in range(49_900)]
    column = pa.array(texts, pa.string())
    took = []
    for topics in (few, many):
        began = time.time()
        got = Matcher(topics).match(column)
        took.append(time.time() - began)
        assert got == [contained(few, t) for t in texts]  # none of the others is in any text
    assert took[1] < 10 * took[0] + 2  # 500 times the topics
    plan = plan_of(spark.createDataFrame([("a",)], "text string").select(numbers_in(spark, F.col("text"), many)))
    assert "NestedLoop" not in plan and "Cartesian" not in plan and len(plan) < 5000


# --- templates --------------------------------------------------------------------------------------


def brute_options(item, templates):
    kind, stressors, behaviour = item
    fits = [t for t in templates if t[3] == behaviour and (not t[5] or kind in t[5]) and (not t[4] or set(t[4]) & set(stressors))]
    for tier, found in ((1, [t for t in fits if t[4] or t[5]]), (2, fits), (3, [t for t in templates if t[3] == behaviour and not t[4] and not t[5]]), (4, [t for t in templates if t[3] == "answer"])):
        if found:
            return tier, [t[1] for t in found], [t[1] for t in fits]


def library(n, rng):
    kinds, names, behaviours = ["pdf", "doc", "*", "="], [f"s{i}" for i in range(12)] + ["*"], ["answer", "partial", "refuse", "other"]
    rows = []
    for i in range(n):
        s = rng.sample(names, rng.choice((0, 1, 1, 2)))
        f = rng.sample(kinds, rng.choice((0, 0, 1, 2)))
        rows.append((i, f"t{i}", "q {topic}", rng.choice(behaviours[:3]), s, f if rng.random() < 0.9 else f * 2))
    return rows


@pytest.mark.parametrize("size", [5, 60, 10_000])
def test_templates_against_brute_force(spark, size):
    rng = random.Random(size)
    rows = [(0, "t0", "q", "answer", ["s1"], ["pdf"]), *[(o + 1, *r) for o, *r in library(size, rng)]]
    templates = spark.createDataFrame(rows, TEMPLATES)
    items = [(i, rng.choice(["pdf", "doc", "xls", "*"]), sorted(rng.sample([f"s{i}" for i in range(14)] + ["*"], rng.randrange(0, 4))), rng.choice(["answer", "partial", "refuse", "other", "none"])) for i in range(40 if size > 100 else 300)]
    df = spark.createDataFrame([(*x, "p", 1) for x in items], "k int, file_type string, stressors array<string>, expected_behavior string, profile string, n int")
    want = {i: brute_options(x, rows) for i, *x in items}
    got = {r["k"]: (r["tier"], r["options"]) for r in matching.with_options(df, templates).collect()}
    assert got == {k: w[:2] for k, w in want.items()}
    pairs = sorted((r["k"], r["template_id"]) for r in matching.matches(df, templates).select("k", "template_id").collect())
    assert pairs == sorted((k, t) for k, w in want.items() for t in w[2])
    chosen = matching.with_choice(df, templates, F.col("k").cast("long") * 7).collect()
    assert {r["k"]: r["template_id"] for r in chosen} == {k: w[1][k * 7 % len(w[1])] for k, w in want.items()}
    assert all(r["profile"] == "p" and r["n"] == 1 for r in chosen)


def test_a_profile_of_most_items_is_dealt_to_many_tasks(spark):
    templates = spark.createDataFrame([(0, "t0", "q", "answer", [], []), (1, "t1", "q", "answer", ["s"], [])], TEMPLATES)
    items = spark.range(0, 60_000, numPartitions=8).select("id", F.when(F.col("id") % 10 == 0, F.concat(F.lit("f"), F.col("id") % 900)).otherwise("pdf").alias("file_type"), F.array(F.lit("s")).alias("stressors"), F.lit("answer").alias("expected_behavior"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        done = matching.with_options(items, templates)
        per_task = [r["n"] for r in done.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(per_task) == 60_000 and max(per_task) < 6_000  # 54,000 rows have one profile, in parts of 1,000 or so


# --- ranks ------------------------------------------------------------------------------------------


@pytest.mark.parametrize("cell_rows", [4096, 7])
def test_ranks_against_a_sort(spark, monkeypatch, cell_rows):
    monkeypatch.setattr(selection, "CELL_ROWS", cell_rows)
    rng = random.Random(6)
    rows = [(rng.choice("aaaaaaab"), rng.choice(["x", None]), rng.randrange(1 << 60) if i % 5 else 1 << 59, i) for i in range(2000)]  # ties of hashes, null keys
    groups = {}
    for a, b, h, i in rows:
        groups.setdefault((a, b), []).append((h, i))
    asked = [(a, b, rng.randrange(1, len(v) + 3)) for (a, b), v in groups.items() for _ in range(60) if b is not None]
    want = sorted((a, b, r, sorted(groups[a, b])[r - 1][1]) for a, b, r in set(asked) if r <= len(groups[a, b]))
    df, wanted = spark.createDataFrame(rows, "a string, b string, h long, i int").repartition(5), spark.createDataFrame(asked, "a string, b string, r long")
    got = selection.by_rank(df, wanted, ["a", "b"], "h", ["i"])
    assert sorted((r["a"], r["b"], r["r"], r["i"]) for r in got.collect()) == want


def test_replacement_sorts_no_stratum_whole(spark, monkeypatch):
    """One stratum has nine of ten rows; the rows that any key of the ranking window brings together are under a hundredth."""
    monkeypatch.setattr(selection, "CELL_ROWS", 128)
    profile = F.struct(*[F.lit(None).cast("string" if n == "layout" else "boolean").alias(n) for n in ("layout", "has_image", "has_table", "has_formula", "has_chart", "image_text_mixed", "reading_order_sensitive")], F.struct(*[F.lit(None).cast("boolean").alias(n) for n in ("long_table", "cross_page_table", "table_dominant")]).alias("table_profile"), F.struct(F.lit(None).cast("boolean").alias("cross_page_chart")).alias("chart_profile"))
    ann = spark.range(0, 40_000, numPartitions=4).select(F.col("id").alias("ordinal"), F.col("id").alias("doc_id"), F.when(F.col("id") % 10 == 0, "doc").otherwise("pdf").alias("file_type"), profile.alias("profile"))
    rows = sampling.strata(ann)
    got = sorted(tuple(r) for r in sampling.round_robin_replacement(rows, 50).select("file_type", "pick", "doc_id", "turn").collect())
    ranked = sampling.ranked(rows)
    first = {(r["file_type"], r["r"]): r["doc_id"] for r in ranked.filter("r <= 50").collect()}
    assert [(t, p, d) for t, p, d, _ in got] == sorted((t, r, d) for (t, r), d in first.items())
    cells = rows.withColumn("_h", sampling.draw(sampling.SEED, "doc", F.col("file_type"), F.col("doc_id"))).groupBy("file_type", F.shiftright("_h", 60 - 9)).count()
    assert cells.agg(F.max("count")).first()[0] < 400
    assert len(sampling.round_robin_replacement(rows.limit(7), 20).collect()) >= 20


# --- boxes ------------------------------------------------------------------------------------------


@pytest.mark.parametrize("most", [0.5, 0.3, 0.8, 0.15])
def test_overlap_against_all_pairs(spark, most):
    rng = random.Random(int(most * 100))

    def box():
        x, y = rng.uniform(-50, 50), rng.choice((0.0, 8.0, rng.uniform(-9, 60)))
        w, h = rng.choice((0.0, 1.0, 8.0, 40.0, rng.uniform(-1, 30))), rng.choice((8.0, rng.uniform(0.1, 30), 300.0))
        return None if rng.random() < 0.05 else [x, y, x + w, y + h]

    images = [(rng.choice("ab"), rng.randrange(3), box(), i) for i in range(250)]
    tables = [(rng.choice("ab"), rng.randrange(3), box(), i) for i in range(60)]
    kind = "doc_id string, page int, bbox array<double>, k int"
    a, b = spark.createDataFrame(images + images[:9], kind), spark.createDataFrame(tables, kind)
    kept = elements.without_overlap(a, b, most=most)

    def share(x, y):
        w, h, area = min(x[2], y[2]) - max(x[0], y[0]), min(x[3], y[3]) - max(x[1], y[1]), (x[2] - x[0]) * (x[3] - x[1])
        return w * h / area if w > 0 and h > 0 and area > 0 else 0

    hidden = {i for d, p, x, i in images if x and any(y and (d, p) == (e, q) and share(x, y) > most for e, q, y, _ in tables)}
    assert sorted(r["k"] for r in kept.collect()) == sorted(i for _, _, _, i in images + images[:9] if i not in hidden)
    assert hidden and kept.columns == a.columns
    assert elements.without_overlap(a, b.limit(0)).count() == a.count()


def test_a_page_of_very_many_boxes(spark):
    boxes = spark.range(0, 100_000, numPartitions=8).select(F.lit("d").alias("doc_id"), F.lit(1).alias("page"), F.expr("array(cast(id % 400 as double), cast(id div 400 as double), id % 400 + 0.9D, id div 400 + 0.9D)").alias("bbox"))
    tables = boxes.filter("bbox[0] % 2 = 0").withColumn("bbox", F.expr("array(bbox[0], bbox[1], bbox[0] + 0.6D, bbox[3])"))
    began = time.time()
    assert elements.without_overlap(boxes, tables).count() == 50_000
    assert time.time() - began < 60  # 5 * 10^9 pairs would take far longer
    assert "NestedLoop" not in plan_of(spatial.covered(boxes.withColumn("page", F.lit(2)), tables, ["doc_id", "page"]).drop("bbox")).replace("BroadcastNestedLoopJoin BuildRight, Cross", "")


# --- file names -------------------------------------------------------------------------------------


def test_files_are_found_by_any_dotted_beginning(spark):
    names = spark.createDataFrame([("a.b.c",), ("a",), (".x.y",), ("a.",), ("..",), ("",)], "n string").select("n", dot_prefixes(F.col("n")).alias("p"))
    assert {r["n"]: r["p"] for r in names.collect()} == {"a.b.c": ["a", "a.b"], "a": [], ".x.y": [".x"], "a.": ["a"], "..": ["."], "": []}
    files = spark.createDataFrame([("/d-1/report.v2.pdf",), ("/d/report.txt",), ("/d/report.v2.docx",), ("/d/x",), ("/own.pdf",)], "path string")
    ann = spark.createDataFrame([("report", None), ("report.v2", "/gone"), ("x", None), ("report", "/own.pdf"), (None, None), ("", None)], "doc_id string, file_path string")
    got = [(r["doc_id"], r["file_path"], r["found"]) for r in resolve(ann, files).collect()]
    assert sorted(got, key=repr) == sorted([("report", None, "/d/report.txt"), ("report.v2", "/gone", "/d/report.v2.docx"), ("x", None, None), ("report", "/own.pdf", "/own.pdf"), (None, None, None), ("", None, None)], key=repr)


def test_library_of_topics_finds_what_contains_finds(spark):
    topics = catalog._library_topics(spark, SF)
    texts = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r["topic"]: r["n_docs"] for r in catalog.topic_hits_library(spark, SF).collect()}
    assert got == {t: sum(bool(contained([t], r["text"])) for r in texts) for t in topics}
