"""Annotations and elements derived from the plain tables, in Spark and as SQL text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import WHITE, page_estimate
from ..operators.layout import is_mixed
from ..schema import METADATA


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def annotations(spark: SparkSession, sf_dir: str, documents: DataFrame | None = None) -> DataFrame:
    """ordinal, doc_id, folder, file_type, file_path, profile, text, page_count, n_lines of documents (all, or those given) with their labels."""
    d = read(spark, sf_dir, "documents") if documents is None else documents
    labels = read(spark, sf_dir, "labels").select(F.col("doc_id").alias("_l"), "quality", "toxic")
    rows = d.join(labels, d["doc_id"] == labels["_l"], "left").drop("_l")
    m = F.col("doc_id") % 10
    kind = F.when(m <= 3, "pdf").when(m <= 5, "doc").when(m == 6, "excel").when(m == 7, "ppt").when(m == 8, "html").otherwise("txt")
    n = F.col("n_chars")
    layout = F.when(n % 11 == 0, None).when(n % 5 == 0, "double").when(n % 5 == 1, "mixed").otherwise("single")
    pdf, image, table, chart = kind == "pdf", n % 3 == 0, F.contains(F.col("text"), F.lit("|")) | (n % 4 == 0), F.col("quality") == 1
    lines = F.size(F.split("text", "\n"))
    profile = F.struct(
        layout.alias("layout"),
        image.alias("has_image"),
        table.alias("has_table"),
        F.lit(None).cast("boolean").alias("has_image_table"),
        F.lit(None).cast("boolean").alias("has_complex_table"),
        (n % 13 == 0).alias("has_formula"),
        chart.alias("has_chart"),
        is_mixed(image, F.col("text")).alias("image_text_mixed"),
        F.when(pdf, F.col("toxic") == 1).alias("reading_order_sensitive"),
        F.when(pdf & table, F.struct((lines >= 60).alias("long_table"), (lines > 50).alias("cross_page_table"), (n % 6 == 0).alias("table_dominant"))).alias("table_profile"),
        F.when(pdf & chart, F.struct((n % 7 == 0).alias("cross_page_chart"))).alias("chart_profile"),
    )
    return rows.select(F.col("doc_id").alias("ordinal"), "doc_id", F.col("source").alias("folder"), kind.alias("file_type"), F.lit("").alias("file_path"), profile.alias("profile"), "text", page_estimate(F.col("text")).alias("page_count"), lines.alias("n_lines"))


def metadata(**given: Column) -> Column:
    """A parser's metadata with the fields given, null elsewhere."""
    return F.struct(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in METADATA])


def contents(spark: SparkSession, sf_dir: str, documents: DataFrame | None = None) -> DataFrame:
    """schema.CONTENT of documents, as parsers would give it; fifty stems for all of them, so that only paths tell files apart."""
    rows, p, n = annotations(spark, sf_dir, documents), "profile.", F.length("text")
    first = F.struct(F.lit(0).alias("page"), F.lit(None).cast("array<double>").alias("bbox"), F.col("n_lines").alias("rows"), F.lit(4).alias("cols"))
    last = F.struct((F.col("page_count") - 1).alias("page"), F.lit(None).cast("array<double>").alias("bbox"), F.lit(2).alias("rows"), F.lit(2).alias("cols"))
    every = F.expr("sequence(0, page_count - 1)")
    meta = metadata(
        has_image=F.col(p + "has_image"), has_table=F.col(p + "has_table"), has_image_table=n % 17 == 0, has_complex_table=n % 19 == 0, has_formula=F.col(p + "has_formula"), has_chart=F.coalesce(p + "has_chart", F.lit(False)),
        image_count=F.lit(2), table_count=F.lit(3), chart_count=F.lit(2), image_pages=every, table_pages=every, tables_detail=F.when(n % 4 == 0, F.array(first, last)).otherwise(F.array()),
    )
    name = F.concat(F.lit("d"), n % 50)
    path = F.concat_ws("/", F.lit("/corpus"), "folder", "doc_id", name)
    return rows.select(name.alias("doc_id"), "file_type", path.alias("file_path"), "page_count", "text", meta.alias("metadata"), F.lit(True).alias("success"), F.array().cast("array<string>").alias("errors"))


def failing(rows: DataFrame) -> DataFrame:
    """Contents of which a parser could not read some."""
    bad = F.length("text") % 23 == 0
    return rows.withColumn("success", ~bad).withColumn("errors", F.when(bad, F.array(F.lit("broken"), F.lit("twice"))).otherwise(F.array().cast("array<string>")))


def model_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a layout model's documents: doc_id, tables, pictures, equations, figures, pages, page_count."""
    def place(at: str) -> str:
        return f"named_struct('page', {at}, 'bbox', cast(null as array<double>))"

    prov = f"if(l_linenumber % 2 = 0, array({place('l_linenumber')}, {place('l_linenumber + 1')}), array({place('l_linenumber')}))"
    grid = "if(l_partkey % 3 = 0, array_repeat(array('a', 'b'), 5), cast(null as array<array<string>>))"
    table = f"named_struct('prov', {prov}, 'num_rows', if(l_partkey % 3 = 0, null, cast(l_quantity as int)), 'num_cols', if(l_partkey % 3 = 0, null, l_linenumber), 'grid', {grid})"
    figure = f"named_struct('prov', {prov}, 'caption', if(l_suppkey % 5 = 0, 'A Chart of it', 'A photo'))"
    li = read(spark, sf_dir, "lineitem")

    def some(flag: str, value: str):
        return F.collect_list(F.expr(f"case when l_returnflag = '{flag}' then {value} end"))

    rows = li.groupBy(F.col("l_orderkey").alias("doc_id")).agg(
        some("A", table).alias("tables"), some("N", f"named_struct('prov', {prov})").alias("pictures"), some("R", f"named_struct('prov', {prov}, 'latex', 'x')").alias("equations"),
        F.collect_list(F.expr(figure)).alias("figures"), F.count("*").cast("int").alias("n"), F.min(F.col("l_linenumber") + F.col("l_suppkey")).alias("k"),
    )
    pages = F.when(F.col("k") % 2 == 0, F.array_repeat(F.lit("page"), F.col("n"))).otherwise(F.array().cast("array<string>"))
    return rows.withColumn("pages", pages).withColumn("page_count", F.when(F.col("k") % 3 == 0, F.lit(7))).drop("n", "k")


_STRIP = "'" + "".join(c for c in WHITE if c in " ") + "' || " + " || ".join(f"chr({ord(c)})" for c in WHITE if c != " ")

ANN = f"""
ann0 AS (SELECT d.doc_id, d.doc_id AS ordinal, d.source AS folder, d.text, d.n_chars AS n, len(string_split(d.text, chr(10))) AS n_lines, l.quality, l.toxic,
  CASE WHEN d.doc_id % 10 <= 3 THEN 'pdf' WHEN d.doc_id % 10 <= 5 THEN 'doc' WHEN d.doc_id % 10 = 6 THEN 'excel' WHEN d.doc_id % 10 = 7 THEN 'ppt' WHEN d.doc_id % 10 = 8 THEN 'html' ELSE 'txt' END AS file_type
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
ann1 AS (SELECT *, greatest(1, n_lines // 50) AS page_count, CASE WHEN n % 11 = 0 THEN NULL WHEN n % 5 = 0 THEN 'double' WHEN n % 5 = 1 THEN 'mixed' ELSE 'single' END AS layout,
  n % 3 = 0 AS has_image, contains(text, '|') OR n % 4 = 0 AS has_table, n % 13 = 0 AS has_formula, quality = 1 AS has_chart,
  n % 3 = 0 AND length(trim(text, {_STRIP})) > 100 AS image_text_mixed,
  CASE WHEN file_type = 'pdf' THEN toxic = 1 END AS reading_order_sensitive FROM ann0),
ann AS (SELECT *, CASE WHEN file_type = 'pdf' AND has_table THEN n_lines >= 60 END AS long_table, CASE WHEN file_type = 'pdf' AND has_table THEN n_lines > 50 END AS cross_page_table,
  CASE WHEN file_type = 'pdf' AND has_table THEN n % 6 = 0 END AS table_dominant, CASE WHEN file_type = 'pdf' AND has_chart THEN n % 7 = 0 END AS cross_page_chart FROM ann1)"""

_NAMED = [("has_image", "has_image"), ("has_table", "has_table"), ("has_formula", "has_formula"), ("has_chart", "has_chart"), ("image_text_mixed", "image_text_mixed"), ("reading_order_sensitive", "reading_order_sensitive"), ("table_profile.long_table", "long_table"), ("table_profile.cross_page_table", "cross_page_table"), ("table_profile.table_dominant", "table_dominant"), ("chart_profile.cross_page_chart", "cross_page_chart")]
TAG_VALUES = [("layout", "CAST(NULL AS BOOLEAN)"), *_NAMED]
#: ann with analysis stressors (st) and their number (k).
STRESSED = f"""{ANN},
st AS (SELECT *, len(st) AS k FROM (SELECT *, list_filter([{', '.join(f"CASE WHEN {c} THEN '{t}' END" for t, c in _NAMED)}, CASE WHEN layout IN ('double', 'mixed') THEN 'layout=' || layout END], lambda x: x IS NOT NULL) AS st FROM ann))"""
_SAMPLED = [x for x in _NAMED if x[0] != "image_text_mixed"]
#: ann with sampling stressors (gs) and signature (sig).
SAMPLED = f"""{ANN},
gs0 AS (SELECT *, list_sort(list_distinct(list_filter(['file_type:' || file_type, 'layout:' || layout, {', '.join(f"CASE WHEN {c} THEN '{t.split('.')[-1]}' END" for t, c in _SAMPLED)}], lambda x: x IS NOT NULL))) AS gs FROM ann),
gs AS (SELECT *, CASE WHEN len(core) = 0 THEN 'none' ELSE array_to_string(core, '|') END AS sig FROM (SELECT *, list_filter(gs, lambda x: NOT starts_with(x, 'file_type:')) AS core FROM gs0))"""


def table_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, page, rows, cols: one table per line item that was not returned."""
    li = read(spark, sf_dir, "lineitem").filter("l_returnflag <> 'A'")
    return li.select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("page"), (4 * F.col("l_quantity").cast("int")).alias("rows"), (1 + F.col("l_partkey") % 12).cast("int").alias("cols"))


def boxes(spark: SparkSession, sf_dir: str, status: str) -> DataFrame:
    """doc_id, page, bbox, id: a box per line item of a status."""
    li = read(spark, sf_dir, "lineitem").filter(F.col("l_linestatus") == status)
    x, y = (F.col("l_partkey") % 60).cast("double"), (F.col("l_suppkey") % 60).cast("double")
    box = F.array(x, y, x + 10 + F.col("l_quantity"), y + 20)
    return li.select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("page"), box.alias("bbox"))


def page_boxes(spark: SparkSession, sf_dir: str, status: str) -> DataFrame:
    """doc_id, page, bbox: many boxes a page, four pages a supplier."""
    li = read(spark, sf_dir, "lineitem").filter(F.col("l_linestatus") == status)
    x, y = (F.col("l_orderkey") * 7 % 400).cast("double"), (F.col("l_partkey") * 13 % 500).cast("double")
    w, h = 10 + F.col("l_quantity").cast("double") * (1 + F.col("l_linenumber") % 3), 20.0 + 11 * (F.col("l_orderkey") % 9)
    return li.select(F.col("l_suppkey").alias("doc_id"), (F.col("l_partkey") % 4).alias("page"), F.array(x, y, x + w, y + h).alias("bbox"))


PAGE_BOXES = """pb AS (SELECT doc_id, page, status, x0, y0, x0 + w AS x1, y0 + h AS y1 FROM (SELECT l_suppkey AS doc_id, l_partkey % 4 AS page, l_linestatus AS status, CAST(l_orderkey * 7 % 400 AS DOUBLE) AS x0, CAST(l_partkey * 13 % 500 AS DOUBLE) AS y0,
  10 + CAST(l_quantity AS DOUBLE) * (1 + l_linenumber % 3) AS w, CAST(20 + 11 * (l_orderkey % 9) AS DOUBLE) AS h FROM lineitem))"""
ELEMENTS = "el AS (SELECT l_orderkey AS doc_id, l_linenumber AS page, 4 * CAST(l_quantity AS INT) AS rows, 1 + l_partkey % 12 AS cols FROM lineitem WHERE l_returnflag <> 'A')"
BOXES = "bx AS (SELECT l_orderkey AS doc_id, l_linenumber AS page, l_linestatus AS status, CAST(l_partkey % 60 AS DOUBLE) AS x0, CAST(l_suppkey % 60 AS DOUBLE) AS y0, l_partkey % 60 + 10 + l_quantity AS x1, CAST(l_suppkey % 60 + 20 AS DOUBLE) AS y1 FROM lineitem)"
