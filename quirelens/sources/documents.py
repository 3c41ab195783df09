"""Document readers: a directory of files to rows of schema.CONTENT.

Listing, type detection, text and HTML are built-in expressions.  OOXML is read by zipfile and
ElementTree in Arrow batches; PDF and other backends are functions registered by name.  A file that
cannot be read gives a row with success = false, never an exception."""

from __future__ import annotations

import io
import posixpath
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.markup import visible_text
from ..functions.scalar import file_type, page_estimate, stem, strip
from ..schema import CONTENT

# Fixed by the formats: XML names.
W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
A = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
P = "{http://schemas.openxmlformats.org/presentationml/2006/main}"
S = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
RELS = "{http://schemas.openxmlformats.org/package/2006/relationships}"
PIC = "{http://schemas.openxmlformats.org/drawingml/2006/picture}"
WP = "{http://schemas.openxmlformats.org/drawingml/2006/wordprocessingDrawing}"
MATH = "http://schemas.openxmlformats.org/officeDocument/2006/math"

Parsed = dict  # page_count, text, metadata
_parsers: dict[str, Callable[[bytes], Parsed]] = {}


def register(name: str, parser: Callable[[bytes], Parsed]) -> None:
    """A parser of file bytes for a type (pdf, doc, ppt, excel) or `backend:type`."""
    _parsers[name] = parser


def available(name: str) -> bool:
    return name in _parsers


def listing(spark: SparkSession, root: str) -> DataFrame:
    """path, length of every file below root; contents are read only where they are selected."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)


def _complex(tables: list[dict]) -> bool:
    return any(t["cols"] > 10 or t["rows"] > 100 or t["cols"] >= 7 and t["rows"] > 20 for t in tables)


def _rels(z: zipfile.ZipFile, part: str) -> list[tuple[str, str, str]]:
    """(id, kind, target) of a part's relationships."""
    folder, name = posixpath.split(part)
    path = f"{folder}/_rels/{name}.rels"
    if path not in z.namelist():
        return []
    root = ElementTree.fromstring(z.read(path))
    return [(r.get("Id"), r.get("Type", ""), posixpath.normpath(posixpath.join(folder, r.get("Target", ""))) if not r.get("Target", "").startswith("/") else r.get("Target")[1:]) for r in root.iter(f"{RELS}Relationship")]


def _flags(**given) -> dict:
    names = ("has_image", "has_table", "has_image_table", "has_complex_table", "has_formula", "has_chart")
    return {n: False for n in names} | given


def parse_docx(data: bytes, math_by_namespace: bool = False) -> Parsed:
    """Paragraphs, tables in body order with their page, inline pictures or image relations, charts.

    math_by_namespace also reports formulas, which the default leaves false."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        raw = z.read("word/document.xml")
        body = ElementTree.fromstring(raw).find(f"{W}body")
        rels = _rels(z, "word/document.xml")
    page = breaks = table_rows = 0
    lines, tables = [], []
    for child in body:
        if child.tag == f"{W}p":
            own = sum(b.get(f"{W}type") == "page" for b in child.iter(f"{W}br"))
            before = next(child.iter(f"{W}pageBreakBefore"), None) is not None
            breaks += own + before
            page += bool(own) + before
            lines.append("".join(_run_text(child)))
        elif child.tag == f"{W}tbl":
            rows = list(child.iter(f"{W}tr"))
            cols = len(list(rows[0].iter(f"{W}tc"))) if rows else 0
            tables.append({"page": page, "bbox": None, "rows": len(rows), "cols": cols})
            table_rows += len(rows)
    images = sum(1 for i in body.iter(f"{WP}inline") if next(i.iter(f"{PIC}pic"), None) is not None)
    images = images or sum("image" in kind for _, kind, _ in rels)
    charts = sum("chart" in kind for _, kind, _ in rels)
    pages = max(breaks + 1, (sum(bool(x.strip()) for x in lines) + table_rows) // 50 + 1)
    meta = _flags(has_image=images > 0, has_table=bool(tables), has_image_table=images > 0 and not tables, has_complex_table=_complex(tables), has_formula=math_by_namespace and MATH.encode() in raw, has_chart=charts > 0)
    meta |= {"table_count": len(tables), "image_count": images, "chart_count": charts, "table_pages": sorted({t["page"] for t in tables}), "tables_detail": tables}
    return {"page_count": pages, "text": "\n".join(lines), "metadata": meta}


def _run_text(paragraph) -> Iterator[str]:
    for x in paragraph.iter():
        if x.tag == f"{W}t":
            yield x.text or ""
        elif x.tag == f"{W}tab":
            yield "\t"
        elif x.tag in (f"{W}br", f"{W}cr"):
            yield "\n"


def parse_xlsx(data: bytes) -> Parsed:
    """Rows of cells joined by a space (blank rows dropped); pictures, charts and formulas of all sheets."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = set(z.namelist())
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in si.iter(f"{S}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{S}si")]
        targets = {i: t for i, _, t in _rels(z, "xl/workbook.xml")}
        sheets = [targets[s.get(f"{R}id")] for s in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{S}sheet")]
        lines, formulas, images, charts = [], 0, 0, 0
        for part in sheets:
            for row in ElementTree.fromstring(z.read(part)).iter(f"{S}row"):
                cells = []
                for c in row.iter(f"{S}c"):
                    f, v = c.find(f"{S}f"), c.find(f"{S}v")
                    formulas += f is not None
                    if f is not None:
                        cells.append("=" + (f.text or ""))
                    elif c.get("t") == "inlineStr":
                        cells.append("".join(t.text or "" for t in c.iter(f"{S}t")))
                    elif v is not None and v.text is not None:
                        cells.append(shared[int(v.text)] if c.get("t") == "s" else {"1": "True", "0": "False"}.get(v.text, v.text) if c.get("t") == "b" else v.text)
                if " ".join(cells).strip():
                    lines.append(" ".join(cells))
            for _, kind, drawing in _rels(z, part):
                if kind.endswith("/drawing"):
                    own = [k for _, k, _ in _rels(z, drawing)]
                    images += sum(k.endswith("/image") for k in own)
                    charts += sum(k.endswith("/chart") for k in own)
    meta = _flags(has_image=images > 0, has_table=True, has_formula=formulas > 0, has_chart=charts > 0) | {"image_count": images, "chart_count": charts}
    return {"page_count": len(sheets), "text": "\n".join(lines), "metadata": meta}


def parse_pptx(data: bytes) -> Parsed:
    """Shape texts; pictures, tables and charts by slide; control objects count as formulas."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        targets = {i: t for i, _, t in _rels(z, "ppt/presentation.xml")}
        order = [targets[s.get(f"{R}id")] for s in ElementTree.fromstring(z.read("ppt/presentation.xml")).iter(f"{P}sldId")]
        slides = [ElementTree.fromstring(z.read(p)) for p in order]
    texts, tables, pictures, image_pages, charts, controls = [], [], 0, set(), 0, False
    for n, slide in enumerate(slides):
        tree = next(slide.iter(f"{P}spTree"))
        for shape in tree:
            if shape.tag == f"{P}sp":
                paragraphs = ["".join((x.text or "") if x.tag == f"{A}t" else "\v" if x.tag == f"{A}br" else "" for x in p.iter()) for p in shape.iter(f"{A}p")]
                if any(paragraphs):
                    texts.append("\n".join(paragraphs))
            elif shape.tag == f"{P}pic":
                pictures += 1
                image_pages.add(n)
            elif shape.tag == f"{P}graphicFrame":
                table = next(shape.iter(f"{A}tbl"), None)
                if table is not None:
                    tables.append({"page": n, "bbox": None, "rows": len(table.findall(f"{A}tr")), "cols": len(list(table.iter(f"{A}gridCol")))})
                charts += any((d.get("uri") or "").endswith("/chart") for d in shape.iter(f"{A}graphicData"))
        controls |= next(slide.iter(f"{P}control"), None) is not None
    meta = _flags(has_image=pictures > 0, has_table=bool(tables), has_image_table=pictures > 0 and not tables, has_complex_table=_complex(tables), has_formula=controls, has_chart=charts > 0)
    meta |= {"table_count": len(tables), "image_count": pictures, "chart_count": charts, "table_pages": sorted({t["page"] for t in tables}), "image_pages": sorted(image_pages), "tables_detail": tables}
    return {"page_count": len(slides), "text": "\n".join(texts), "metadata": meta}


register("doc", parse_docx)
register("excel", parse_xlsx)
register("ppt", parse_pptx)


def decode_text(data: bytes) -> str:
    for name in ("utf-8", "gbk", "gb2312", "latin-1"):
        try:
            return data.decode(name)
        except UnicodeDecodeError:
            continue
    return ""


def _parse(parsers: dict[str, Callable[[bytes], Parsed]]):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for doc_id, kind, path, text, pages, content in zip(*(pdf[c] for c in ("doc_id", "file_type", "file_path", "text", "page_count", "content")), strict=True):
                row = {"doc_id": doc_id, "file_type": kind, "file_path": path, "page_count": None, "text": None, "metadata": None, "success": True, "errors": []}
                try:
                    if kind in PLAIN:
                        if content is None:
                            row |= {"text": text, "page_count": int(pages)}
                        else:
                            text = decode_text(bytes(content))
                            row |= {"text": text, "page_count": max(1, (text.count("\n") + 1) // 50)}
                    elif kind not in parsers:
                        raise ValueError(f"no parser for {kind}")
                    else:
                        row |= parsers[kind](bytes(content))
                except Exception as e:  # noqa: BLE001  one broken file must not stop the others
                    row |= {"success": False, "errors": [f"{type(e).__name__}: {e}"]}
                if row["metadata"] is not None:
                    row["metadata"] = {f.name: row["metadata"].get(f.name) for f in CONTENT["metadata"].dataType}
                rows.append(row)
            yield pd.DataFrame(rows, columns=CONTENT.fieldNames())

    return run


PLAIN = ("txt", "md", "html")
OFFICE = ("pdf", "doc", "excel", "ppt")
BACKENDS = ("auto", "docling", "legacy")


def parsers_of(backend: str = "auto", extract_images: bool = True) -> dict[str, Callable[[bytes], Parsed]]:
    """Type to parser.  auto takes the layout model's parser where one is registered and the plain one elsewhere, docling
    the model's alone, legacy the plain one alone.  Without extract_images pictures are not reported."""
    if backend not in BACKENDS:
        raise ValueError(f"no such backend: {backend}")
    out = {}
    for kind in OFFICE:
        model, plain = _parsers.get(f"docling:{kind}"), _parsers.get(kind)
        found = model if backend == "docling" else plain if backend == "legacy" else model or plain
        if found is not None:
            out[kind] = found if extract_images else _without_images(found)
    return out


def _without_images(parser: Callable[[bytes], Parsed]) -> Callable[[bytes], Parsed]:
    def run(data: bytes) -> Parsed:
        got = parser(data)
        return got | {"metadata": got["metadata"] | {"has_image": False, "has_image_table": False, "image_count": 0, "image_pages": [], "images_detail": []}}

    return run


def contents(files: DataFrame, backend: str = "auto", extract_images: bool = True) -> DataFrame:
    """files (path, content) to schema.CONTENT: one scan, and each file parsed once.

    Text and HTML are read by built-in expressions; only office files and text in other encodings reach Python as bytes."""
    path = F.regexp_replace("path", r"^file:/+", "/")
    rows = files.select(path.alias("file_path"), "content").withColumn("file_type", file_type(F.col("file_path"))).withColumn("doc_id", stem(F.col("file_path")))
    kind, raw = F.col("file_type"), F.col("content").cast("string")
    plain = kind.isin("txt", "md")
    text = F.when(plain & F.is_valid_utf8(raw), raw).when(kind == "html", strip(visible_text(F.expr("make_valid_utf8(cast(content as string))"))))
    rows = rows.withColumn("text", text)
    pages = F.when(kind == "html", F.lit(1)).when(plain, page_estimate(F.col("text")))
    content = F.when(kind.isin(*OFFICE) | plain & F.col("text").isNull(), F.col("content"))
    return rows.select("doc_id", "file_type", "file_path", "text", pages.cast("int").alias("page_count"), content.alias("content")).mapInPandas(_parse(parsers_of(backend, extract_images)), CONTENT)


def dot_prefixes(name: Column) -> Column:
    """The beginnings of a file name that end before a dot, without the empty one."""
    pieces = F.split(name, r"\.")
    return F.filter(F.transform(F.sequence(F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(1))), lambda k: F.when(F.size(pieces) > 1, F.array_join(F.slice(pieces, 1, k), "."))), lambda x: F.coalesce(x, F.lit("")) != "")


def resolve(ann: DataFrame, files: DataFrame) -> DataFrame:
    """ann (doc_id, file_path) with `found`: its own path if a file stands there, else the first file named `doc_id.*`.

    Files are indexed by every beginning of their names that ends before a dot; the first is that of the least path, folder by folder."""
    paths = files.select("path").distinct()
    own = paths.select(F.col("path").alias("own_path"))
    parts = F.split("path", "/")
    index = paths.select(parts.alias("_parts"), F.explode(dot_prefixes(F.element_at(parts, -1))).alias("_prefix"))
    index = index.groupBy("_prefix").agg(F.array_join(F.min("_parts"), "/").alias("prefix_path"))
    rows = ann.join(own, ann["file_path"] == own["own_path"], "left").join(index, ann["doc_id"] == index["_prefix"], "left")
    return rows.withColumn("found", F.coalesce("own_path", "prefix_path")).drop("own_path", "prefix_path", "_prefix")
