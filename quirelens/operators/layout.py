"""Layout rules and the assembly of annotations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import strip
from ..schema import LAYOUTS
from . import elements as E
from . import features as X
from .plugins import classify, extract

PROFILED = ("pdf", "doc", "ppt")


def layout_by_rules(file_type: Column, wide: Column, flowing: Column) -> Column:
    """wide: long or cross-page tables or charts; flowing: images or any text."""
    return F.when(~file_type.isin(*PROFILED), "single").when(wide & flowing, "mixed").when(wide, "double").otherwise("single")


def is_mixed(has_image: Column, text: Column, least: int = 100) -> Column:
    return has_image & (F.length(strip(F.coalesce(text, F.lit("")))) > least)


# Fixed: what models are asked.
DOMINANT_AND_ORDER = {"table_dominant": "boolean", "reading_order_sensitive": "boolean"}


def _facts(*more: tuple[str, Column]) -> Column:
    lines = [("pages", F.col("page_count")), *[(k, F.col(f"n_{k}")) for k in E.KINDS], *more, ("text", F.substring(F.coalesce("text", F.lit("")), 1, 500))]
    return F.concat_ws("\n", *[F.concat(F.lit(f"{k}: "), F.coalesce(c.cast("string"), F.lit(""))) for k, c in lines])


def features(contents: DataFrame, detected: DataFrame | None = None, kinds: tuple[str, ...] = E.KINDS, threshold: float = 0.5, **options) -> DataFrame:
    """contents with elements, n_image, n_table, n_formula, n_chart, table features and cross_page_chart.

    All of it is read from the row: files of one name in two folders have nothing to do with each other."""
    rows = E.with_elements(contents, detected, kinds=kinds, threshold=threshold)
    rows = rows.withColumns({f"n_{k}": F.size(E.of_kind(k)) for k in E.KINDS})

    def of(kind: str, field: str) -> Column:
        return F.transform(E.of_kind(kind), lambda e: F.coalesce(e[field], F.lit(0)))

    rows = rows.withColumns({"_rows": of("table", "rows"), "_pages": F.array_sort(F.array_distinct(of("table", "page"))), "_charts": F.array_sort(F.array_distinct(of("chart", "page")))})
    total = F.aggregate("_rows", F.lit(0).cast("bigint"), lambda a, x: a + x)
    rules = X.table_rules(F.col("n_table"), F.coalesce(F.array_max("_rows"), F.lit(0)), total, F.size("_pages"), X.longest_run(F.col("_pages")), F.coalesce("page_count", F.lit(0)), **options)
    has = F.col("n_table") > 0
    rows = rows.withColumns({k: F.when(has, c) for k, c in rules.items()})
    crossed = F.lit(options.get("check_cross_page", True)) & (X.longest_run(F.col("_charts")) >= 2)
    return rows.withColumn("cross_page_chart", crossed).drop("_rows", "_pages", "_charts")


def annotate(contents: DataFrame, detected: DataFrame | None = None, llm: Callable | None = None, use_llm_layout: bool = True, keep: tuple[str, ...] = (), **options) -> DataFrame:
    """contents (schema.CONTENT) to annotations: doc_id, file_type, file_path, doc_profile, and the columns to keep.

    One row in, one row out, without a join unless detectors' elements are given.  llm: factory of a model
    (prompt to response); where it fails, or says nothing usable, the rules stand.  options: see `features`."""
    rows = features(contents, detected, **options)

    def has(kind: str) -> Column:
        return F.col(f"n_{kind}") > 0

    def flag(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(False))

    text = F.coalesce("text", F.lit(""))
    wide = flag("long_table") | flag("cross_page_table") | flag("cross_page_chart")
    layout = layout_by_rules(F.col("file_type"), wide, has("image") | (strip(text) != ""))
    dominant, order = F.col("table_dominant"), F.lit(None).cast("boolean")
    if llm is not None:
        rows = rows.withColumn("_said", extract(F.concat(F.lit("Are tables the main content? Must the text be read in one order?\n"), _facts()), DOMINANT_AND_ORDER, llm))
        dominant, order = F.coalesce(dominant, "_said.table_dominant"), F.col("_said.reading_order_sensitive")
        if use_llm_layout:
            ask = F.concat(F.lit("Layout: single, double (content runs across pages) or mixed?\n"), _facts(("cross-page table", F.col("cross_page_table")), ("long table", F.col("long_table"))))
            rows = rows.withColumn("_layout", classify(ask, list(LAYOUTS), llm))
            said = F.when(F.col("_layout.label").isin(*LAYOUTS), F.col("_layout.label"))
            layout = F.when(F.col("file_type") == "pdf", F.coalesce(said, layout)).otherwise(layout)
    paged = F.col("file_type").isin(*PROFILED)
    profile = F.struct(
        layout.alias("layout"),
        has("image").alias("has_image"),
        has("table").alias("has_table"),
        F.coalesce("metadata.has_image_table", F.lit(False)).alias("has_image_table"),
        F.coalesce("metadata.has_complex_table", F.lit(False)).alias("has_complex_table"),
        has("formula").alias("has_formula"),
        has("chart").alias("has_chart"),
        is_mixed(has("image"), text).alias("image_text_mixed"),
        F.when(paged, order).alias("reading_order_sensitive"),
        F.when(paged & has("table"), F.struct(flag("long_table").alias("long_table"), flag("cross_page_table").alias("cross_page_table"), dominant.alias("table_dominant"))).alias("table_profile"),
        F.when(paged & has("chart"), F.struct(flag("cross_page_chart").alias("cross_page_chart"))).alias("chart_profile"),
    )
    return rows.select("doc_id", "file_type", "file_path", profile.alias("doc_profile"), *keep)
