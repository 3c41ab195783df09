"""Data model of document annotations: types, enumerations and vocabularies."""

from __future__ import annotations

from pyspark.sql import types as T

FILE_TYPES = ("pdf", "doc", "excel", "ppt", "html", "txt", "md")
LAYOUTS = ("single", "double", "mixed")
# Extension to file type.
EXTENSION_TYPES = {".pdf": "pdf", ".doc": "doc", ".docx": "doc", ".xls": "excel", ".xlsx": "excel", ".ppt": "ppt", ".pptx": "ppt", ".html": "html", ".htm": "html", ".txt": "txt", ".md": "md"}
ELIGIBLE_EXTENSIONS = (".pdf", ".doc", ".docx", ".xls", ".xlsx", ".ppt", ".pptx")
#: A gap report expects these types ("xlsx" is no type that annotations have, so it is always a gap).
EXPECTED_TYPES = ("pdf", "doc", "ppt", "xlsx")

# Tags of all documents, tags of paged documents, and tags that make documents hard.
COMMON_TAGS = ("layout", "has_image", "has_table", "has_formula", "has_chart", "image_text_mixed")
PAGED_TAGS = ("reading_order_sensitive", "table_profile.long_table", "table_profile.cross_page_table", "table_profile.table_dominant", "chart_profile.cross_page_chart")
STRESSOR_TAGS = COMMON_TAGS[1:] + PAGED_TAGS
TAGS = COMMON_TAGS + PAGED_TAGS

TABLE_PROFILE = T.StructType([T.StructField(n, T.BooleanType()) for n in ("long_table", "cross_page_table", "table_dominant")])
CHART_PROFILE = T.StructType([T.StructField("cross_page_chart", T.BooleanType())])
PROFILE = T.StructType(
    [T.StructField("layout", T.StringType())]
    + [T.StructField(n, T.BooleanType()) for n in ("has_image", "has_table", "has_image_table", "has_complex_table", "has_formula", "has_chart", "image_text_mixed", "reading_order_sensitive")]
    + [T.StructField("table_profile", TABLE_PROFILE), T.StructField("chart_profile", CHART_PROFILE)]
)
ANNOTATION = T.StructType([T.StructField("doc_id", T.StringType()), T.StructField("file_type", T.StringType()), T.StructField("file_path", T.StringType()), T.StructField("doc_profile", PROFILE), T.StructField("pdf_profile", PROFILE)])

TABLE_DETAIL = T.StructType([T.StructField("page", T.IntegerType()), T.StructField("bbox", T.ArrayType(T.DoubleType())), T.StructField("rows", T.IntegerType()), T.StructField("cols", T.IntegerType())])
IMAGE_DETAIL = T.StructType([T.StructField("index", T.IntegerType()), T.StructField("page", T.IntegerType()), T.StructField("bbox", T.ArrayType(T.DoubleType()))])
METADATA = T.StructType(
    [T.StructField(n, T.BooleanType()) for n in ("has_image", "has_table", "has_image_table", "has_complex_table", "has_formula", "has_chart")]
    + [T.StructField(n, T.IntegerType()) for n in ("table_count", "image_count", "chart_count", "formula_count", "rect_count", "line_count", "curve_count")]
    + [T.StructField("table_pages", T.ArrayType(T.IntegerType())), T.StructField("image_pages", T.ArrayType(T.IntegerType())), T.StructField("tables_detail", T.ArrayType(TABLE_DETAIL)), T.StructField("images_detail", T.ArrayType(IMAGE_DETAIL))]
)
CONTENT = T.StructType(
    [T.StructField("doc_id", T.StringType()), T.StructField("file_type", T.StringType()), T.StructField("file_path", T.StringType()), T.StructField("page_count", T.IntegerType()), T.StructField("text", T.StringType())]
    + [T.StructField("metadata", METADATA), T.StructField("success", T.BooleanType()), T.StructField("errors", T.ArrayType(T.StringType()))]
)
#: Columns of an element after its key.
ELEMENT = "kind string, ord int, bbox array<double>, page int, confidence double, rows int, cols int"

# What answers must and must not mention, by expected behaviour.
ANSWER_CONSTRAINTS = {
    "answer": (["例外情况", "版本限制"], ["身份证号", "银行卡号"]),
    "partial": (["例外情况"], ["编造", "我猜测"]),
    "refuse": (["无法提供", "隐私"], ["身份证号", "家庭住址", "联系方式"]),
    "ask_clarification": (["请确认", "具体"], []),
}
# Shares of expected behaviours.
BEHAVIOUR_MIX = {"answer": 0.75, "partial": 0.10, "refuse": 0.10, "ask_clarification": 0.05}
