"""Builder of ordered stages, and the annotation service on top of it."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import output_path
from ..log import get_logger
from ..operators.elements import KINDS
from ..operators.incremental import eligible, route
from ..operators.layout import annotate
from ..operators.plugins import detect
from ..operators.sinks import canonical, write_one_per_document
from ..sources import annotations, documents
from ..sources.files import for_tasks

Stage = Callable[[DataFrame], DataFrame]


class StageError(RuntimeError):
    """A stage could not be put into the plan: its place and name."""

    def __init__(self, index: int, name: str, cause: Exception) -> None:
        super().__init__(f"stage {index} ({name}): {cause}")
        self.index, self.name = index, name


class Pipeline:
    """An ordered list of DataFrame functions; running it only composes a lazy plan.

    Stages may set `success` to false and add to `errors` in rows that they cannot work on.  With `track` the
    first stage that does so is kept in the row (`failed_at_step`, `failed_stage`), and later stages do not see it."""

    def __init__(self, stages: list[tuple[str, Stage]] | None = None) -> None:
        self.stages = list(stages or [])

    def add(self, name: str, stage: Stage) -> Pipeline:
        self.stages.append((name, stage))
        return self

    def insert(self, index: int, name: str, stage: Stage) -> Pipeline:
        self.stages.insert(index, (name, stage))
        return self

    def remove(self, name: str) -> Pipeline:
        self.stages = [s for s in self.stages if s[0] != name]
        return self

    def clear(self) -> Pipeline:
        self.stages = []
        return self

    def run(self, df: DataFrame) -> DataFrame:
        for i, (name, stage) in enumerate(self.stages):
            try:
                df = df.transform(stage)
            except Exception as e:
                raise StageError(i, name, e) from e
        return df

    def run_batch(self, frames: Sequence[DataFrame]) -> list[DataFrame]:
        return [self.run(f) for f in frames]

    def track(self, df: DataFrame) -> DataFrame:
        """As run, for stages that keep success and errors: all rows, each with the stage at which it failed, if it did.

        Every stage's failures are split off its own result, so the result is a union: persist it if stages are dear."""
        parts = []
        for i, (name, stage) in enumerate(self.stages):
            try:
                df = df.transform(stage)
            except Exception as e:
                raise StageError(i, name, e) from e
            good = F.coalesce("success", F.lit(False))
            parts.append(df.filter(~good).withColumns({"failed_at_step": F.lit(i), "failed_stage": F.lit(name)}))
            df = df.filter(good)
        none = {"failed_at_step": F.lit(None).cast("int"), "failed_stage": F.lit(None).cast("string")}
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts, df.withColumns(none))

    def __len__(self) -> int:
        return len(self.stages)

    def __repr__(self) -> str:
        return f"Pipeline({' -> '.join(n for n, _ in self.stages)})"


# Fixed: sections and keys of a service's configuration, and the values that stand where one is missing.
DEFAULTS = {
    "doc_parser": {"extract_images": True, "ocr_enabled": True, "table_structure": True},
    "element_detector": {"enabled_detectors": list(KINDS), "confidence_threshold": 0.5},
    "feature_extractor": {"long_table_threshold": 3, "check_cross_page": True, "table_dominant_ratio": 0.6},
    "layout_classifier": {"use_llm": True, "fallback_rule": "single"},
}


def configured(given: dict | None = None) -> dict:
    """DEFAULTS with what is given in their place; sections and keys that there are none of raise, as does a fallback that is no layout."""
    out = {k: dict(v) for k, v in DEFAULTS.items()}
    for section, values in (given or {}).items():
        if section not in out:
            raise ValueError(f"no such section: {section}")
        unknown = set(values) - set(out[section]) - {"supported_formats"}
        if unknown:
            raise ValueError(f"{section} has no {', '.join(sorted(unknown))}")
        out[section] |= values
    if out["layout_classifier"]["fallback_rule"] not in ("single", "double", "mixed"):
        raise ValueError("fallback_rule must be single, double or mixed")
    return out


class AnnotationService:
    """Documents to annotations.

    detector: factory of a page detector, for files whose parser says nothing of elements and gives page images
    (`pages`: file_path, page, image).  llm: factory of a model.  config: see DEFAULTS.  backend: auto, docling or legacy."""

    def __init__(self, spark: SparkSession, backend: str = "auto", config: dict | None = None, detector: Callable | None = None, llm: Callable | None = None, log_level: int = logging.INFO) -> None:
        documents.parsers_of(backend)
        self.spark, self.backend, self.config, self.detector, self.llm = spark, backend, configured(config), detector, llm
        self.log = get_logger(log_level)

    @staticmethod
    def load_config(path: str) -> dict:
        return annotations.config(path)

    def _parse(self, files: DataFrame) -> DataFrame:
        return documents.contents(files, self.backend, self.config["doc_parser"]["extract_images"])

    def _annotate(self, contents: DataFrame, keep: tuple[str, ...] = (), pages: DataFrame | None = None) -> DataFrame:
        detector, feature, layout = (self.config[k] for k in ("element_detector", "feature_extractor", "layout_classifier"))
        found = detect(pages, self.detector, "file_path") if self.detector and pages is not None else None
        return annotate(
            contents, found, self.llm, layout["use_llm"], keep, kinds=tuple(detector["enabled_detectors"]), threshold=detector["confidence_threshold"],
            long_pages=feature["long_table_threshold"], dominant=feature["table_dominant_ratio"], check_cross_page=feature["check_cross_page"],
        )

    def pipeline(self) -> Pipeline:
        return Pipeline([("parse", self._parse), ("annotate", lambda c: self._annotate(c, ("success", "errors")))])

    def annotate(self, path: str) -> dict:
        """One file's annotation as a dict; raises on failure.  The file is parsed once."""
        began = time.time()
        self.log.info("start: %s", path)
        row = self.pipeline().run(documents.listing(self.spark, path)).first()
        if row is None or not row["success"]:
            self.log.error("failed: %s", path)
            raise ValueError(f"{path}: {'; '.join(row['errors']) if row else 'no such file'}")
        self.log.info("done: %s (%.0f ms)", path, 1000 * (time.time() - began))
        out = row.asDict(recursive=True)
        return {k: v for k, v in out.items() if k not in ("success", "errors")}

    def annotate_batch(self, paths: Sequence[str]) -> list[dict]:
        """Annotations of the files given by name; failures are logged and left out."""
        rows = self.pipeline().run(self.spark.read.format("binaryFile").load(list(paths))).collect()
        for r in rows:
            if not r["success"]:
                self.log.error("%s: %s", r["file_path"], "; ".join(r["errors"]))
        return [{k: v for k, v in r.asDict(recursive=True).items() if k not in ("success", "errors")} for r in rows if r["success"]]

    def batch(self, root: str, failed: DataFrame | None = None, outputs: DataFrame | None = None, target: str = "", skip_existing: bool = True) -> tuple[DataFrame, DataFrame]:
        """(annotations, failures) of the eligible files below root; names are joined before contents are read.

        Both come from one persisted frame of annotations, so that every file is parsed once; texts are not kept."""
        files = documents.listing(self.spark, root).withColumn("path", F.regexp_replace("path", r"^file:/+", "/"))
        done = self.pipeline().run(eligible(files, failed, outputs, root, target, skip_existing)).persist()
        good, bad = route(done)
        return good.drop("success", "errors"), bad

    def save(self, annotated: DataFrame, root: str, target: str, form: str = "json") -> None:
        """One file per annotation below target, in the folders that its document has below root."""
        base = for_tasks(self.spark, target)
        rows = canonical(annotated).withColumn("out_path", output_path(F.col("file_path"), root, base))
        write_one_per_document(rows if form == "json" else rows.withColumn("out_path", F.regexp_replace("out_path", r"\.json$", f".{form}")), form)


def compare_backends(spark: SparkSession, root: str, backends: Sequence[str] = ("docling", "legacy"), config: dict | None = None) -> DataFrame:
    """Long rows of what every backend makes of the eligible files below root: file_path, backend, success, error, annotation (JSON)."""
    out = []
    for b in backends:
        service = AnnotationService(spark, b, config, log_level=logging.WARNING)
        files = eligible(documents.listing(spark, root).withColumn("path", F.regexp_replace("path", r"^file:/+", "/")))
        rows = service.pipeline().run(files)
        value = F.to_json(F.struct("doc_id", "file_type", "file_path", "doc_profile"))
        out.append(rows.select("file_path", F.lit(b).alias("backend"), "success", F.array_join("errors", "; ").alias("error"), F.when(F.col("success"), value).alias("annotation")))
    return reduce(DataFrame.unionByName, out)
