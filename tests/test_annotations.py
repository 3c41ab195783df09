"""Readers, quirks, reports and question sets on small annotation folders."""

import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from quirelens.functions import scalar as X
from quirelens.operators import analytics as A
from quirelens.operators import incremental as I2
from quirelens.operators import layout as L
from quirelens.operators import plugins, sampling, sinks
from quirelens.operators.stressors import analysis_stressors, sampling_stressors, signature
from quirelens.plans.pipeline import AnnotationService, Pipeline
from quirelens.sources import annotations as S
from quirelens.sources import documents as D

PDF1 = {"doc_id": "p1", "file_type": "pdf", "file_path": "", "pdf_profile": {"layout": "single", "has_image": False, "has_table": True, "table_profile": {"long_table": False, "cross_page_table": True}}}
PDF2 = {"doc_id": "p2", "file_type": "pdf", "file_path": "", "pdf_profile": {"layout": "mixed", "has_image": True, "has_table": False, "has_chart": True, "reading_order_sensitive": True, "chart_profile": {"cross_page_chart": True}}}
XLS1 = {"doc_id": "x1", "file_type": "excel", "file_path": ""}


@pytest.fixture()
def folder(tmp_path):
    for name, value in (("a", PDF1), ("b", PDF2), ("c", XLS1)):
        (tmp_path / f"{name}.json").write_text(json.dumps(value))
    return tmp_path


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_scan_and_vocabularies(spark, folder):
    ann = S.scan(spark, str(folder))
    rows = by_id(ann.withColumn("a", analysis_stressors()).withColumn("g", sampling_stressors()).withColumn("s", signature(sampling_stressors())))
    assert rows["p1"]["folder"] == "_root"
    assert rows["p1"]["g"] == ["cross_page_table", "file_type:pdf", "has_table", "layout:single"]
    assert rows["p1"]["s"] == "cross_page_table|has_table|layout:single"
    assert rows["p2"]["a"] == ["has_image", "has_chart", "reading_order_sensitive", "chart_profile.cross_page_chart", "layout=mixed"]
    assert rows["x1"]["g"] == ["file_type:excel"] and rows["x1"]["s"] == "none"


def test_quirks_of_profiles_and_files(spark, tmp_path):
    sub = tmp_path / "ä +1 中"
    sub.mkdir()
    (sub / "a b.json").write_text(json.dumps({"doc_id": "d", "file_type": None, "doc_profile": {}, "pdf_profile": {"layout": "double", "has_table": "true", "has_image": True}}))
    (sub / "bad.json").write_text("{nope")
    (sub / "failed_files.json").write_text(json.dumps([{"file": "x", "error": "y"}]))
    (tmp_path / "list.json").write_text(json.dumps([PDF1, XLS1]))
    rows = by_id(S.with_defaults(S.scan(spark, str(tmp_path))))
    assert set(rows) == {"d", "p1", "x1"}
    d = rows["d"]
    assert d["folder"] == "ä +1 中" and d["file_type"] == "unknown"
    assert d["profile"]["layout"] == "double" and d["profile"]["has_image"] is True and d["profile"]["has_table"] is None
    assert [r[0].endswith("bad.json") for r in S.rejects(spark, str(tmp_path)).collect()] == [True]
    with pytest.raises(Exception, match="(?i)malformed|corrupt|json"):
        S.scan(spark, str(tmp_path), "strict").collect()


def test_reports(spark, folder, tmp_path):
    full = sinks.all_reports(S.scan(spark, str(folder)), str(tmp_path / "out"), str(folder))
    assert full["basic_stats"] == {"total_files": 3, "file_types": {"pdf": 2, "excel": 1}, "file_type_rates": {"pdf": "66.7%", "excel": "33.3%"}, "folders": {"_root": 3}}
    assert sorted(g["file_type"] for g in full["gaps"]["file_type_gaps"]) == ["doc", "ppt", "xlsx"]
    assert full["sampling_advice"]["recommended_per_file_type"] == 2
    assert sorted(full["sampling_advice"]["needs_replacement_sampling"]) == ["excel", "pdf"]
    assert full["stressor_combinations"]["high_complexity_docs"][0]["doc_id"] == "p2"
    names = {p.name for p in (tmp_path / "out").iterdir()}
    assert {"summary.json", "by_folder.json", "buckets.json", "stressor_combos.json", "gaps.json", "sampling_advice.json", "tag_distribution.csv", "bucket_distribution.csv", "high_complexity_docs.csv", "report.md"} <= names
    assert (tmp_path / "out" / "tag_distribution.csv").read_bytes().startswith(b"\xef\xbb\xbf")


def test_files_name_all_documents_and_values_the_first(spark, folder, tmp_path):
    ann = S.scan(spark, str(folder))
    out = tmp_path / "out"
    full = sinks.all_reports(ann, str(out), str(folder), named=1)
    level1 = full["buckets"]["level1_buckets"]
    assert {k: (v["count"], len(v["doc_ids"])) for k, v in level1.items()} == {"pdf": (2, 1), "excel": (1, 1)}
    assert full["stressor_combinations"]["high_complexity_count"] == 1 and full["metadata"]["sparse_threshold"] == 3
    saved = {n: json.loads((out / f"{n}.json").read_text()) for n in ("summary", "buckets", "stressor_combos", "gaps", "sampling_advice", "by_folder")}
    whole = sinks.summary(ann, str(folder), named=100)
    assert saved["buckets"] == whole["buckets"] == saved["summary"]["buckets"] and saved["buckets"]["level1_buckets"]["pdf"]["doc_ids"] == ["p1", "p2"]
    assert saved["stressor_combos"] == json.loads(json.dumps(whole["stressor_combinations"])) == saved["summary"]["stressor_combinations"]
    text = (out / "buckets.json").read_text()
    assert text == json.dumps(whole["buckets"], ensure_ascii=False, indent=2)
    by_folder = saved["by_folder"]["_root"]
    assert by_folder["basic_stats"]["file_type_rates"] == {"pdf": "66.7%", "excel": "33.3%"} and by_folder["tag_distribution"]["layout_distribution"] == {"single": 1, "mixed": 1, "unknown": 1}
    combos = by_folder["stressor_combinations"]
    assert combos["total_unique_combinations"] == 2 and combos["high_complexity_count"] == 1 and combos["high_complexity_docs"][0]["doc_id"] == "p2" and len(combos["rare_combinations"]) == 2
    assert full["gaps"]["missing_features"][0]["message"] and "**has_formula**" in (out / "report.md").read_text()
    assert not [p for p in out.iterdir() if p.suffix in (".parts", ".whole")]


def test_template_library_and_questions(spark, folder, tmp_path):
    path = tmp_path / "t" / "templates.json"
    path.parent.mkdir()
    path.write_text(json.dumps({"templates": [{"id": "a", "query": "{topic} {doc_id}", "expected_behavior": "answer"}, {"id": "b", "query": "{topic}", "expected_behavior": "answer", "stressors_any": ["has_table"]}], "topics_seed": ["x/y", "z"]}))
    t, topics = S.templates(spark, str(path))
    ann = S.scan(spark, str(folder), profile_keys=("pdf_profile",))
    q = sampling.question_set(ann, t, topics, per_file_type=4)
    rows = q.orderBy("id").collect()
    assert [r["id"] for r in rows] == [f"q_{i:06d}" for i in range(1, len(rows) + 1)] and len(rows) == 6
    again = sampling.question_set(ann, t, topics, per_file_type=4).orderBy("id").collect()
    assert rows == again
    assert all(r["generation"]["template_id"] == "b" for r in rows if r["doc_annotation"]["doc_id"] == "p1" and r["expected_behavior"] == "answer")
    full = sampling.question_set(ann, t, topics, per_file_type=10, replacement=True)
    assert full.count() == 20
    m = sinks.manifest(q, 1, {}, {}, {})
    assert len(m["outputs"]["hash16"]) == 16
    assert sinks.stats(q)["total"] == 6
    with pytest.raises(ValueError, match="answer"):
        sampling.question_set(ann, t.filter("false"), topics)


def office(files):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in files.items():
            z.writestr(name, text)
    return out.getvalue()


W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'


def word_table(rows, cols):
    return "<w:tbl>" + ("<w:tr>" + "<w:tc><w:p/></w:tc>" * cols + "</w:tr>") * rows + "</w:tbl>"


def test_documents_to_annotations(spark, tmp_path):
    paragraphs = "".join(f"<w:p><w:r><w:t>line {i}</w:t></w:r></w:p>" for i in range(5))
    (tmp_path / "one.docx").write_bytes(office({"word/document.xml": f"<w:document {W}><w:body>{paragraphs}{word_table(50, 4)}{word_table(10, 3)}</w:body></w:document>"}))
    (tmp_path / "broken.docx").write_bytes(b"no zip")
    (tmp_path / "n.TXT").write_bytes("\n".join(["行"] * 120).encode("gbk"))
    (tmp_path / "h.html").write_text("<p>a &amp; b</p><script>x</script>")
    (tmp_path / "noext").write_text("t")
    content = D.contents(D.listing(spark, str(tmp_path)))
    rows = by_id(content)
    assert rows["one"]["page_count"] == 2 and rows["one"]["metadata"]["table_count"] == 2
    assert not rows["broken"]["success"] and rows["broken"]["errors"]
    assert rows["n"]["page_count"] == 2 and rows["n"]["text"].startswith("行")
    assert rows["h"]["text"] == "a & b" and rows["noext"]["file_type"] == "txt"
    good, bad = I2.route(content)
    ann = by_id(L.annotate(good))
    t = ann["one"]["doc_profile"]["table_profile"]
    assert (t["cross_page_table"], t["long_table"], t["table_dominant"]) == (False, False, True)
    assert ann["one"]["doc_profile"]["layout"] == "single" and ann["h"]["doc_profile"]["table_profile"] is None
    assert [r["file"].endswith("broken.docx") for r in bad.collect()] == [True]
    service = AnnotationService(spark)
    assert service.annotate(str(tmp_path / "one.docx"))["doc_id"] == "one"
    with pytest.raises(ValueError, match="broken"):
        service.annotate(str(tmp_path / "broken.docx"))
    done, _ = service.batch(str(tmp_path))
    assert set(by_id(done)) == {"one"}


def docx(tables):
    return office({"word/document.xml": f"<w:document {W}><w:body><w:p><w:r><w:t>text</w:t></w:r></w:p>{''.join(word_table(*t) for t in tables)}</w:body></w:document>"})


def test_files_of_one_name_have_nothing_to_do_with_each_other(spark, tmp_path):
    for name, tables in (("x/a", [(200, 12)]), ("y/a", [(2, 2)]), ("x/b", [(2, 2)])):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / f"{name}.docx").write_bytes(docx(tables))
    service = AnnotationService(spark)
    plan = service.pipeline().run(D.listing(spark, str(tmp_path)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInPandas") == 1 and plan.count("BinaryFile") + plan.count("binaryFile") >= 1 and plan.count("Scan ") == 1 and "Exchange" not in plan
    done, failed = service.batch(str(tmp_path))
    rows = {r["file_path"].removeprefix(f"{tmp_path}/"): r["doc_profile"] for r in done.collect()}
    assert set(rows) == {"x/a.docx", "y/a.docx", "x/b.docx"} and failed.count() == 0
    assert rows["x/a.docx"]["table_profile"]["long_table"] and rows["x/a.docx"]["has_complex_table"] and rows["x/a.docx"]["layout"] == "mixed"
    assert rows["y/a.docx"] == rows["x/b.docx"] and not rows["y/a.docx"]["table_profile"]["cross_page_table"] and rows["y/a.docx"]["layout"] == "single"


def test_service_writes_and_reads(spark, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"
    (source / "sub").mkdir(parents=True)
    (source / "sub" / "a.docx").write_bytes(docx([(60, 2)]))
    (source / "broken.pptx").write_bytes(b"no zip")
    service = AnnotationService(spark, config={"feature_extractor": {"check_cross_page": False}})
    good, bad = service.batch(str(source))
    for form in ("json", "yaml"):
        service.save(good, str(source), str(target), form)
    import yaml

    a, b = json.loads((target / "sub" / "a.json").read_text()), yaml.safe_load((target / "sub" / "a.yaml").read_text())
    assert a == b and a["doc_profile"]["table_profile"]["cross_page_table"] is False and "chart_profile" not in a["doc_profile"]
    assert [r["file"].endswith("broken.pptx") for r in bad.collect()] == [True]
    sinks.write_failures(bad, str(tmp_path / "failed"))
    assert spark.read.json(str(tmp_path / "failed")).first()["error"]
    assert [x["doc_id"] for x in service.annotate_batch([str(source / "sub" / "a.docx"), str(source / "broken.pptx")])] == ["a"]
    with pytest.raises(ValueError, match="section"):
        AnnotationService(spark, config={"nope": {}})
    with pytest.raises(ValueError, match="backend"):
        AnnotationService(spark, "other")


def test_layout_model_parser(spark, tmp_path, monkeypatch):
    from types import SimpleNamespace as Item

    from quirelens.sources import backends as B

    place = Item(page_no=3, bbox=(1, 2, 3, 4))
    doc = Item(tables=[Item(prov=[Item(page_no=1), place], num_rows=101, num_cols=2), Item(prov=None, data=Item(grid=[["a"] * 4] * 2))], pictures=[], equations=[Item(text="x", prov=[])], figures=[Item(caption="Ein Plot", prov=[]), Item(caption="photo")], metadata={"page_count": 9})
    got = B.model_content(doc)
    assert got["page_count"] == 9 and got["text"] == "" and got["metadata"]["chart_count"] == 1 and got["metadata"]["has_formula"] and got["metadata"]["has_complex_table"] and not got["metadata"]["has_image_table"]
    assert got["metadata"]["tables_detail"] == [{"page": 3, "bbox": [1.0, 2.0, 3.0, 4.0], "rows": 101, "cols": 2}, {"page": None, "bbox": None, "rows": 2, "cols": 4}]
    monkeypatch.setattr(D, "_parsers", dict(D._parsers))

    def factory():
        def convert(path):
            with open(path, "rb") as f:
                if f.read() == b"bad":
                    raise ValueError("cannot")
            return Item(document=Item(pages=[1, 2], pictures=[Item(prov=[Item(page=1)])], export_to_markdown=lambda: "# text"))

        return Item(convert=convert)

    B.install_model(factory)
    (tmp_path / "a.pdf").write_bytes(b"good")
    (tmp_path / "b.pdf").write_bytes(b"bad")
    rows = by_id(D.contents(D.listing(spark, str(tmp_path)), "docling"))
    assert rows["a"]["text"] == "# text" and rows["a"]["page_count"] == 2 and rows["a"]["metadata"]["has_image_table"] and not rows["b"]["success"]
    assert not by_id(D.contents(D.listing(spark, str(tmp_path)), "legacy"))["a"]["success"]
    assert not by_id(D.contents(D.listing(spark, str(tmp_path)), "docling", extract_images=False))["a"]["metadata"]["has_image"]
    from quirelens import compare_backends

    seen = {(r["file_path"][-5:], r["backend"]): r for r in compare_backends(spark, str(tmp_path)).collect()}
    assert seen["a.pdf", "docling"]["success"] and "no parser" in seen["a.pdf", "legacy"]["error"] and json.loads(seen["a.pdf", "docling"]["annotation"])["doc_id"] == "a"


def test_detectors_stand_in_where_parsers_say_nothing(spark):
    from quirelens.schema import CONTENT

    rows = [("a", "pdf", "/a", 2, "t" * 200, None, True, []), ("b", "doc", "/b", 1, "", None, True, [])]
    pages = spark.createDataFrame([("/a", 0, b"x"), ("/a", 1, b"y"), ("/b", 0, b"x")], "file_path string, page int, image binary")
    factory = lambda: lambda image: [{"kind": "table", "confidence": 0.9, "rows": 4}, {"kind": "image", "confidence": 0.4 if image == b"x" else 0.6}]
    found = plugins.detect(pages, factory, "file_path")
    got = by_id(L.annotate(spark.createDataFrame(rows, CONTENT), found))
    a = got["a"]["doc_profile"]
    assert a["has_table"] and a["has_image"] and a["image_text_mixed"] and a["table_profile"]["cross_page_table"] and a["layout"] == "mixed"
    assert not got["b"]["doc_profile"]["has_table"]
    only = by_id(L.annotate(spark.createDataFrame(rows, CONTENT), found, kinds=("image",), threshold=0.3))["a"]["doc_profile"]
    assert only["has_image"] and not only["has_table"]


def test_logger(tmp_path, capsys):
    from quirelens import log

    log.close_logger()
    logger = log.get_logger(20, str(tmp_path / "logs"))
    assert log.get_logger() is logger and len(logger.handlers) == 2
    logger.info("seen")
    logger.debug("not seen")
    log.set_log_level(10)
    logger.debug("now seen")
    text = open(log.log_path(), encoding="utf-8").read()
    log.close_logger()
    assert "[INFO] seen" in text and "now seen" in text and "not seen" not in text and "seen" in capsys.readouterr().out


def test_counters(spark):
    from quirelens.log import counted

    rows, seen = counted(spark.createDataFrame([(True,), (False,), (None,)], "success boolean"))
    rows.collect()
    assert seen.get == {"total": 3, "success": 1, "failed": 2}


def test_command_lines(spark, tmp_path, capsys):
    from quirelens.cli import main

    source, target, reports = tmp_path / "in", tmp_path / "ann", tmp_path / "reports"
    (source / "sub").mkdir(parents=True)
    (source / "sub" / "a.docx").write_bytes(docx([(60, 2)]))
    (source / "bad.docx").write_bytes(b"no")
    (source / "known.docx").write_bytes(b"no")
    (source / "parsing_failed_files.json").write_text(json.dumps({"parsing_failed_files": ["known.docx"]}))
    assert main(["annotate", "--input", str(source), "--output", str(target), "--use-mock", "--log-to-file", "--log-dir", str(tmp_path / "logs")], spark) == 0
    assert "processed 2, success 1, failed 1" in capsys.readouterr().out and (target / "sub" / "a.json").exists() and list((tmp_path / "logs").iterdir())
    assert main(["annotate", "--input", str(source), "--output", str(target), "--use-mock"], spark) == 0
    assert "processed 1, success 0, failed 1" in capsys.readouterr().out
    assert main(["one", str(source / "sub" / "a.docx"), "-q"], spark) == 0
    assert json.loads(capsys.readouterr().out)["doc_id"] == "a"
    assert main(["one", str(source / "bad.docx"), "-q"], spark) == 1 and main(["one", str(source / "none"), "-q"], spark) == 1
    assert main(["analyze", "-i", str(target), "-o", str(reports)], spark) == 0 and {"report.md", "by_folder.json", "tag_distribution.csv"} <= {p.name for p in reports.iterdir()}
    assert main(["analyze", "-i", str(target), "-o", str(reports), "-f", "sub", "--json-only", "-q"], spark) == 0 and {p.suffix for p in (reports / "sub").iterdir()} == {".json"}
    assert main(["analyze", "-i", str(tmp_path / "none")], spark) == 1
    assert main(["export", "-i", str(target), "-o", str(reports / "files.csv")], spark) == 0
    assert (reports / "files.csv").read_text(encoding="utf-8-sig").splitlines()[1].startswith("sub,a,doc,")
    library = tmp_path / "library.json"
    library.write_text(json.dumps({"templates": [{"id": "t", "query": "{topic} in {doc_title}", "expected_behavior": "answer"}], "topics_seed": ["text", "z"]}))
    config = tmp_path / "config.json"
    config.write_text(json.dumps({"per_file_type": 3, "domain": "law", "behavior_mix": {"answer": 1.0}, "paths": {"out_dir": str(tmp_path / "q")}}))
    assert main(["generate", "--annotations_dir", str(target), "--docs_dir", str(source), "--templates_path", str(library), "--config", str(config), "--ground_with_content", "--allow_sample_with_replacement"], spark) == 0
    lines = [json.loads(x) for x in (tmp_path / "q" / "queries.jsonl").read_text().splitlines()]
    assert [x["id"] for x in lines] == ["q_000001", "q_000002", "q_000003"] and all(x["query"] == "text in text" and x["domain"] == "law" for x in lines)
    import hashlib

    manifest = json.loads((tmp_path / "q" / "manifest.json").read_text())
    assert manifest["outputs"]["hash16"] == hashlib.sha256((tmp_path / "q" / "queries.jsonl").read_bytes()).hexdigest()[:16]
    assert json.loads((tmp_path / "q" / "stats.json").read_text())["total"] == 3
    assert main(["compare", str(source), "-o", str(tmp_path / "cmp")], spark) == 0 and spark.read.json(str(tmp_path / "cmp")).count() == 6
    with pytest.raises(SystemExit):
        main(["nothing"], spark)


def test_pptx_and_xlsx():
    p = 'xmlns:p="http://schemas.openxmlformats.org/presentationml/2006/main" xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    table = lambda r, c: f'<p:graphicFrame><a:graphic><a:graphicData uri="t/table"><a:tbl><a:tblGrid>{"<a:gridCol/>" * c}</a:tblGrid>{"<a:tr/>" * r}</a:tbl></a:graphicData></a:graphic></p:graphicFrame>'
    slide = lambda x: f"<p:sld {p}><p:cSld><p:spTree>{x}</p:spTree></p:cSld></p:sld>"
    rel = "".join(f'<Relationship Id="r{i}" Type="t/slide" Target="slides/slide{i}.xml"/>' for i in (1, 2, 3))
    data = office({
        "ppt/presentation.xml": f'<p:presentation {p}><p:sldIdLst><p:sldId r:id="r1"/><p:sldId r:id="r2"/><p:sldId r:id="r3"/></p:sldIdLst></p:presentation>',
        "ppt/_rels/presentation.xml.rels": f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{rel}</Relationships>',
        "ppt/slides/slide1.xml": slide("<p:sp><p:txBody><a:p><a:r><a:t>Title</a:t></a:r></a:p></p:txBody></p:sp>"),
        "ppt/slides/slide2.xml": slide(table(5, 4)),
        "ppt/slides/slide3.xml": slide(table(3, 3)),
    })
    got = D.parse_pptx(data)
    assert got["page_count"] == 3 and got["text"] == "Title" and got["metadata"]["table_pages"] == [1, 2]
    s = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    data = office({
        "xl/workbook.xml": f'<workbook {s}><sheets><sheet name="a" r:id="r1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="t/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f'<worksheet {s}><sheetData><row><c><v>1</v></c><c t="s"><v>0</v></c></row><row/><row><c><f>A1+1</f><v>2</v></c></row></sheetData></worksheet>',
        "xl/sharedStrings.xml": f"<sst {s}><si><t>one</t></si></sst>",
    })
    got = D.parse_xlsx(data)
    assert got["text"] == "1 one\n=A1+1" and got["metadata"]["has_formula"] and got["metadata"]["has_table"] and got["page_count"] == 1


def test_scalars_and_plugins(spark):
    one = spark.range(1)
    row = one.select(
        X.title(F.lit("  \n## Head \nx"), F.lit("f")).alias("title"),
        X.title(F.lit(" \n#"), F.lit("f")).alias("none"),
        X.output_path(F.lit("/in/a/b.c.docx"), "/in", "/out").alias("out"),
        X.overlap(F.expr("array(0D,0D,10D,10D)"), F.expr("array(0D,0D,10D,6D)")).alias("o"),
        X.weighted(F.lit(0.8), {"a": 0.75, "b": 0.25}).alias("w"),
        X.polygon_box(F.expr("array(array(1D,2D),array(5D,1D))")).alias("box"),
    ).first()
    assert (row["title"], row["none"], row["out"], row["o"], row["w"]) == ("Head", "f", "/out/a/b.c.json", 0.6, "b")
    assert row["box"] == [1, 1, 5, 2]
    pages = spark.createDataFrame([("d", 0, b"x"), ("d", 1, b"bad")], "doc_id string, page int, image binary")

    def factory():
        def run(image):
            if image == b"bad":
                raise ValueError
            return [{"kind": "table", "bbox": [0, 0, 1, 1], "confidence": 0.9}]

        return run

    assert [r["page"] for r in plugins.detect(pages, factory).collect()] == [0]
    assert plugins.detect(pages, plugins.no_detector).count() == 0
    got = one.select(plugins.classify(F.lit("q"), ["single", "double"], lambda: lambda p: "it is double").alias("x")).first()["x"]
    assert (got["label"], got["confidence"], got["reasoning"]) == ("double", 0.7, "it is double")


def test_models(spark):
    one = spark.range(1)

    def said(answer):
        return one.select(plugins.classify(F.lit("q"), ["single", "double"], lambda: answer).alias("x")).first()["x"]

    def fails(prompt):
        raise OSError

    assert tuple(said(lambda p: '{"label": "other", "confidence": 0.9}')) == ("other", 0.9, "")
    assert tuple(said(lambda p: '{"reasoning": "none"}')) == ("single", 0.8, "none")
    assert tuple(said(lambda p: "no idea"))[:2] == ("single", 0.5) and said(fails) is None
    schema = {"a": "bool", "b": "an int", "c": "float", "d": "text"}
    got = one.select(plugins.extract(F.lit("q"), schema, lambda: lambda p: '{"a": true, "b": 3, "d": "x"}').alias("x"), plugins.extract(F.lit("q"), schema, lambda: fails).alias("y"), plugins.mock_object(schema).alias("z"), plugins.mock_label([]).alias("m")).first()
    assert tuple(got["x"]) == (True, 3, None, "x") and got["y"] is None and json.loads(got["z"]) == {"a": False, "b": 0, "c": 0.0, "d": ""} and got["m"] == "unknown"
    pages = spark.createDataFrame([("d", 0, b"x")], "doc_id string, page int, image binary")
    assert plugins.page_texts(pages, plugins.no_reader).first()["text"] == "" and plugins.page_texts(pages, lambda: fails).first()["text"] is None


def test_http_model(spark):
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    class Answers(BaseHTTPRequestHandler):
        def do_POST(self):
            asked = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            message = {"function_call": {"arguments": '{"label": "double"}'}} if "functions" in asked else {"content": "mixed, I think"}
            out = json.dumps({"choices": [{"message": message}]}).encode()
            self.send_response(200)
            self.send_header("Content-Length", str(len(out)))
            self.end_headers()
            self.wfile.write(out)

        def log_message(self, *a):
            pass

    server = HTTPServer(("127.0.0.1", 0), Answers)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        url = f"http://127.0.0.1:{server.server_port}/v1/chat"
        ask = lambda **k: spark.range(1).select(plugins.classify(F.lit("q"), ["single", "double", "mixed"], plugins.http_model(url, "m", **k), 0.8).alias("x")).first()["x"]
        assert tuple(ask(functions=True)) == ("double", 0.8, "") and tuple(ask()) == ("mixed", 0.8, "mixed, I think")
        dead = plugins.http_model("http://127.0.0.1:1/", "m")
        assert spark.range(1).select(plugins.classify(F.lit("q"), ["a"], dead).alias("x")).first()["x"] is None
    finally:
        server.shutdown()


def test_pipeline_builder(spark):
    p = Pipeline().add("a", lambda d: d.withColumn("x", F.lit(1))).add("b", lambda d: d.withColumn("x", F.col("x") + 1)).insert(0, "c", lambda d: d)
    assert len(p) == 3 and p.run(spark.range(1)).first()["x"] == 2
    assert [d.count() for d in p.run_batch([spark.range(1), spark.range(2)])] == [1, 2]
    assert repr(p.remove("b")) == "Pipeline(c -> a)" and len(p.clear()) == 0
    from quirelens import StageError

    with pytest.raises(StageError, match="stage 1 .bad.") as e:
        Pipeline().add("good", lambda d: d).add("bad", lambda d: d.select("nothing")).run(spark.range(1))
    assert (e.value.index, e.value.name) == (1, "bad")


def test_stream_takes_new_files_once(spark, tmp_path):
    from quirelens.streaming import incremental as N

    (tmp_path / "in").mkdir()
    run = lambda: N.annotate_new(spark, str(tmp_path / "in"), lambda df: L.annotate(D.contents(df)), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    done = lambda: sorted(r["doc_id"] for r in N.committed(spark, str(tmp_path / "out"), "doc_id string").collect())
    assert done() == []
    (tmp_path / "in" / "a.txt").write_text("a")
    run()
    (tmp_path / "in" / "b.txt").write_text("b")
    run()
    assert done() == ["a", "b"] and len(N.batches(spark, str(tmp_path / "out"))) == 2


def test_a_batch_that_dies_after_its_write_counts_once(spark, tmp_path, monkeypatch):
    from quirelens.streaming import incremental as N

    (tmp_path / "in").mkdir()
    run = lambda: N.annotate_new(spark, str(tmp_path / "in"), lambda df: L.annotate(D.contents(df)), str(tmp_path / "out"), str(tmp_path / "cp"), 1).awaitTermination()
    done = lambda: sorted(r["doc_id"] for r in N.committed(spark, str(tmp_path / "out"), "doc_id string").collect())
    for name in "abc":
        (tmp_path / "in" / f"{name}.txt").write_text(name)
    real, calls = N.commit, []

    def die(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("killed between the write and the commit")
        real(*args)

    monkeypatch.setattr(N, "commit", die)
    with pytest.raises(Exception, match="killed"):
        run()
    assert len(done()) == 1 and len(list((tmp_path / "out").glob("stream=*/batch=*"))) == 2  # written, but no one sees it
    run()
    assert done() == ["a", "b", "c"]
    real(spark, str(tmp_path / "out"), N.batches(spark, str(tmp_path / "out"))[0])  # a commit that is repeated
    run()
    assert done() == ["a", "b", "c"]


def test_duplicate_ids_take_first_type(spark):
    from quirelens.schema import PROFILE

    rows = [(1, "d", "f", "pdf"), (2, "d", "g", "doc")]
    prof = {n: True for n in ("has_image", "has_table", "has_chart")}
    df = spark.createDataFrame([(*r, prof) for r in rows], f"ordinal int, doc_id string, folder string, file_type string, profile {PROFILE.simpleString()}")
    assert [r["file_type"] for r in A.high_complexity(df).collect()] == ["pdf", "pdf"]
