"""Optional backends, used where their libraries are installed: PDF by pdfplumber or pypdf, and layout-model
documents (tables, pictures, equations, figures with provenance).  Each yields what the readers yield."""

from __future__ import annotations

import importlib.util
import io

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import documents

# What captions of charts say.
CHART_WORDS = ("chart", "graph", "plot", "图表", "柱状图", "饼图", "折线图")


def pdf_pages(data: bytes) -> dict:
    """Text per page; tables with distinct cell tops and lefts; image and shape counts."""
    import pdfplumber

    texts, tables, images, shapes = [], [], {}, {"rect_count": 0, "line_count": 0, "curve_count": 0}
    scanned = False
    with pdfplumber.open(io.BytesIO(data)) as pdf:
        for n, page in enumerate(pdf.pages):
            texts.append(page.extract_text() or "")
            found = page.find_tables()
            for t in found:
                tables.append({"page": n, "bbox": [float(x) for x in t.bbox], "rows": len({c[1] for c in t.cells}), "cols": len({c[0] for c in t.cells})})
            boxes = [(i["x0"], i["top"], i["x1"], i["bottom"]) for i in page.images]
            area = float(page.width * page.height) or 1.0
            scanned |= not found and any((b[2] - b[0]) * (b[3] - b[1]) / area > 0.5 for b in boxes)
            own = [b for b in boxes if not any(_share(b, t.bbox) > 0.5 for t in found)]
            if own:
                images[n] = len(own)
            for k in shapes:
                shapes[k] += len(getattr(page, k.removesuffix("_count") + "s"))
    pages, curves, rects = len(texts), shapes["curve_count"], shapes["rect_count"]
    chart = curves > 5 or pages > 0 and (rects - 10 * len(tables)) / pages > 5 or not tables and rects > 10
    meta = documents._flags(has_image=bool(images), has_table=bool(tables), has_image_table=scanned, has_complex_table=documents._complex(tables), has_chart=chart)
    meta |= shapes | {"table_count": len(tables), "image_count": sum(images.values()), "chart_count": int(chart), "table_pages": sorted({t["page"] for t in tables}), "image_pages": sorted(images), "tables_detail": tables}
    return {"page_count": pages, "text": "\n".join(texts), "metadata": meta}


def _share(a, b) -> float:
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    area = (a[2] - a[0]) * (a[3] - a[1])
    return w * h / area if w > 0 and h > 0 and area > 0 else 0.0


def pdf_text(data: bytes) -> dict:
    """Text and page count alone, all flags false."""
    import pypdf

    reader = pypdf.PdfReader(io.BytesIO(data))
    return {"page_count": len(reader.pages), "text": "\n".join(p.extract_text() or "" for p in reader.pages), "metadata": documents._flags()}


def install() -> list[str]:
    """Registers the parsers whose libraries are there; returns the names of what was found."""
    found = [m for m in ("pdfplumber", "pypdf") if importlib.util.find_spec(m)]
    if found:
        documents.register("pdf", {"pdfplumber": pdf_pages, "pypdf": pdf_text}[found[0]])
    if importlib.util.find_spec("docling"):
        found.append("docling")
        install_model(converter)
    return found


def converter():
    """The layout model's converter, built on first use in each worker."""
    from docling.document_converter import DocumentConverter

    return DocumentConverter()


#: The layout-model parser for each suffix that it takes.
MODEL_SUFFIX = {"pdf": ".pdf", "doc": ".docx", "excel": ".xlsx", "ppt": ".pptx"}


def install_model(factory) -> None:
    """Registers `docling:` parsers on a converter's factory (see `model_parser`)."""
    for kind, suffix in MODEL_SUFFIX.items():
        documents.register(f"docling:{kind}", model_parser(factory, suffix))


def model_parser(factory, suffix: str):
    """Parser of bytes by a layout model: factory gives a converter, whose convert(path).document is read by `model_content`."""

    def run(data: bytes) -> dict:
        import os
        import sys
        import tempfile
        import types

        kept = sys.modules.setdefault("_quirelens_worker", types.ModuleType("_quirelens_worker")).__dict__
        if kept.get("factory") is not factory:
            kept.update(factory=factory, converter=factory())
        with tempfile.TemporaryDirectory() as folder:  # the model reads files: a copy for the time of the call
            path = os.path.join(folder, f"file{suffix}")
            with open(path, "wb") as f:
                f.write(data)
            return model_content(kept["converter"].convert(path).document)

    return run


def _place(item) -> tuple[int | None, list[float] | None]:
    """Page and box of an item: what the last of its provenances says."""
    page = box = None
    for p in getattr(item, "prov", None) or ():
        page = getattr(p, "page_no", getattr(p, "page", page))
        own = getattr(p, "bbox", None)
        box = [float(x) for x in own] if own else None
    return page, box


def _size(table) -> tuple[int, int]:
    if hasattr(table, "num_rows"):
        return table.num_rows, getattr(table, "num_cols", 0)
    data = getattr(table, "data", None)
    grid = getattr(data, "grid", data if isinstance(data, (list, tuple)) else None) or []
    return len(grid), len(grid[0]) if grid and hasattr(grid[0], "__len__") else 0


def model_content(doc) -> dict:
    """A layout model's document as page_count, text and metadata; what a document lacks counts as none of it."""
    try:
        text = doc.export_to_markdown()
    except Exception:  # noqa: BLE001  elements still count where the text cannot be exported
        text = ""
    tables = []
    for t in getattr(doc, "tables", None) or ():
        (page, box), (rows, cols) = _place(t), _size(t)
        tables.append({"page": page, "bbox": box, "rows": rows, "cols": cols})
    images = [{"index": i, "page": page, "bbox": box} for i, (page, box) in enumerate(map(_place, getattr(doc, "pictures", None) or ()))]
    formulas = len(list(getattr(doc, "equations", None) or ()))
    charts = sum(any(w in str(getattr(f, "caption", None) or "").lower() for w in CHART_WORDS) for f in getattr(doc, "figures", None) or ())
    pages = len(getattr(doc, "pages", None) or ()) or (getattr(doc, "metadata", None) or {}).get("page_count", 1)
    meta = documents._flags(has_image=bool(images), has_table=bool(tables), has_image_table=bool(images) and not tables, has_complex_table=documents._complex(tables), has_formula=formulas > 0, has_chart=charts > 0)
    own_pages = lambda v: sorted({x["page"] for x in v if x["page"] is not None})
    meta |= {"image_count": len(images), "table_count": len(tables), "formula_count": formulas, "chart_count": charts, "table_pages": own_pages(tables), "image_pages": own_pages(images), "tables_detail": tables, "images_detail": images}
    return {"page_count": pages, "text": text, "metadata": meta}


# Layout-model documents as rows: tables, pictures and equations are arrays of structs with
# provenance arrays (page, bbox); figures have captions.


def model_tables(docs: DataFrame) -> DataFrame:
    """doc_id, page, bbox, rows, cols per table; the last provenance counts; rows and cols by number, else by grid."""
    t = docs.select("doc_id", F.explode("tables").alias("t"))
    last = F.try_element_at("t.prov", F.lit(-1))
    rows = F.coalesce("t.num_rows", F.size("t.grid"), F.lit(0))
    cols = F.coalesce("t.num_cols", F.size(F.get("t.grid", F.lit(0))), F.lit(0))
    return t.select("doc_id", last["page"].alias("page"), last["bbox"].alias("bbox"), rows.alias("rows"), cols.alias("cols"))


def model_images(docs: DataFrame) -> DataFrame:
    p = docs.select("doc_id", F.posexplode("pictures").alias("index", "p"))
    last = F.try_element_at("p.prov", F.lit(-1))
    return p.select("doc_id", "index", last["page"].alias("page"), last["bbox"].alias("bbox"))


def model_formulas(docs: DataFrame) -> DataFrame:
    e = docs.select("doc_id", F.explode("equations").alias("e"))
    return e.select("doc_id", "e.latex", F.try_element_at("e.prov", F.lit(-1))["page"].alias("page"))


def model_charts(docs: DataFrame) -> DataFrame:
    """Figures whose caption speaks of a chart."""
    f = docs.select("doc_id", F.explode("figures").alias("f"))
    words = F.array(*map(F.lit, CHART_WORDS))
    return f.filter(F.exists(words, lambda w: F.contains(F.lower("f.caption"), w))).select("doc_id", "f.caption", F.try_element_at("f.prov", F.lit(-1))["page"].alias("page"))


def model_page_count(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce(F.nullif(F.size("pages"), F.lit(0)), F.col("page_count"), F.lit(1)).alias("page_count"))
