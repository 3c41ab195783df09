"""Which files to work on: eligibility, known failures, finished outputs; and comparison of two runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import extension, file_name, output_path
from ..schema import ELIGIBLE_EXTENSIONS


def eligible(files: DataFrame, failed: DataFrame | None = None, outputs: DataFrame | None = None, source: str = "", target: str = "", skip_existing: bool = True) -> DataFrame:
    """files (path) with a supported extension, whose name is not in failed (name) and whose output is not in outputs (path).

    Runs before any content is read: only paths are scanned and joined."""
    rows = files.filter(extension(F.col("path")).isin(*ELIGIBLE_EXTENSIONS))
    if failed is not None:
        rows = rows.join(failed.select(F.col("name").alias("_n")).distinct(), file_name(rows["path"]) == F.col("_n"), "left_anti")
    if outputs is not None and skip_existing:
        rows = rows.join(outputs.select(F.col("path").alias("_p")), output_path(rows["path"], source, target) == F.col("_p"), "left_anti")
    return rows


def in_folder(ann: DataFrame, name: str, root: str | None = None) -> DataFrame:
    """Annotations of one folder: by `folder`, or with a root those whose source_file is below root/name."""
    if root is None:
        return ann.filter(F.col("folder") == name)
    return ann.filter(F.startswith(F.col("source_file"), F.lit(f"{root.rstrip('/')}/{name.strip('/')}/")))


def collisions(files: DataFrame, source: str, target: str) -> DataFrame:
    """Output paths that more than one file maps to, and the file that is kept (last by path)."""
    rows = files.select(output_path(F.col("path"), source, target).alias("out"), "path")
    return rows.groupBy("out").agg(F.count("*").alias("n"), F.max("path").alias("kept")).filter("n > 1")


def route(results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that succeeded, and (file, error) of those that did not."""
    bad = results.filter(~F.coalesce("success", F.lit(False)))
    return results.filter("success"), bad.select(F.col("file_path").alias("file"), F.array_join("errors", "; ").alias("error"))


def run_counters(results: DataFrame) -> DataFrame:
    return results.agg(F.count("*").alias("total"), F.count_if("success").alias("success"), F.count_if(~F.coalesce("success", F.lit(False))).alias("failed"))


def compare(a: DataFrame, b: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Long form of two runs, joined in full: key, field, a, b, differs (values missing on a side never differ)."""

    def long(df: DataFrame, name: str) -> DataFrame:
        cells = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias(name)) for f in fields])
        return df.select(F.col(key), F.explode(cells).alias("x")).select(key, "x.field", f"x.{name}")

    both = long(a, "a").join(long(b, "b"), [key, "field"], "full_outer")
    return both.withColumn("differs", F.coalesce(F.col("a") != F.col("b"), F.lit(False)))


def success_totals(results: DataFrame, backend: Column) -> DataFrame:
    return results.groupBy(backend.alias("backend")).agg(F.count_if("success").alias("n_success"), F.count("*").alias("n"))
