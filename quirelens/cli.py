"""Command lines: `python -m quirelens analyze | export | generate | annotate | one | compare`.

Thin entries for spark-submit or a local session; everything is done by the library.  Exit code 1 on errors."""

from __future__ import annotations

import argparse
import json
import logging
import os
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .functions.scalar import title
from .log import close_logger, get_logger, log_path
from .operators import sampling, sinks
from .operators.plugins import http_model, mock_model, paddle_detector
from .plans.pipeline import AnnotationService, compare_backends
from .sources import annotations, backends, documents
from .sources.files import exists, qualified


class Refused(Exception):
    """What a user has asked for cannot be done; the message says why."""


def _session() -> SparkSession:
    return SparkSession.builder.appName("quirelens").config("spark.ui.showConsoleProgress", "false").getOrCreate()


def _folder(spark: SparkSession, path: str) -> str:
    if not exists(spark, path):
        raise Refused(f"no such folder: {path}")
    return path


def _scan(spark: SparkSession, path: str, mode: str = "warn", **how):
    return annotations.scan(spark, os.path.abspath(path) if "://" not in path else path, mode, **how)


def analyze(spark: SparkSession, args: argparse.Namespace) -> None:
    out = os.path.join(args.output, args.folder) if args.folder else args.output
    source = _folder(spark, os.path.join(args.input, args.folder) if args.folder else args.input)
    ann = annotations.with_defaults(_scan(spark, source))
    if not ann.limit(1).count():
        raise Refused(f"no annotations in {source}")
    kinds = tuple(k for k in ("json", "csv", "md") if getattr(args, f"{k}_only")) or ("json", "csv", "md")
    full = sinks.all_reports(ann, out, source, kinds, args.sparse_threshold, args.complexity_threshold)
    if not args.quiet:
        basic, advice, gaps = full["basic_stats"], full["sampling_advice"], full["gaps"]
        print(f"reports in {out}: {', '.join(sorted(os.listdir(out)))}")
        print(f"files: {basic['total_files']} ({', '.join(f'{k} {n}' for k, n in basic['file_types'].items())})")
        print(f"documents of high complexity: {advice['priority_docs_count']}; per_file_type: {advice['recommended_per_file_type']}")
        if gaps["sparse_buckets"] or gaps["missing_features"]:
            print("there are gaps: see report.md")


def export(spark: SparkSession, args: argparse.Namespace) -> None:
    ann = _scan(spark, _folder(spark, args.input))
    if not ann.limit(1).count():
        raise Refused(f"no annotations in {args.input}")
    n = sinks.write_flat_file(ann, args.output)
    print(f"{n} files in {args.output}")


def generate(spark: SparkSession, args: argparse.Namespace) -> None:
    own = vars(args) | {k: v for k, v in _config(args.config).items() if v is not None}
    templates, topics = annotations.templates(spark, _folder(spark, own["templates_path"]))
    ann = _scan(spark, _folder(spark, own["annotations_dir"]), "strict", profile_keys=("pdf_profile",) if args.legacy_profiles else ("doc_profile", "pdf_profile"))
    text = name = None
    if own["ground_with_content"]:
        if own["docs_dir"]:
            files = documents.listing(spark, own["docs_dir"])
            found = documents.resolve(ann, files.select(F.regexp_replace("path", r"^file:/+", "/").alias("path")))
            texts = documents.contents(files).filter("success").select(F.col("file_path").alias("_p"), F.col("text").alias("_text"))
            ann = found.join(texts, found["found"] == F.col("_p"), "left").drop("_p", "found")
        else:
            ann = ann.withColumn("_text", F.lit(None).cast("string"))
        ann = ann.withColumn("_text", F.coalesce("_text", F.lit(""))).withColumn("_title", title(F.col("_text"), F.col("doc_id").cast("string")))
        text, name = "_text", "_title"
    params = {k: own[k] for k in ("per_file_type", "queries_per_doc", "ground_with_content", "allow_sample_with_replacement")}
    questions = sampling.question_set(ann, templates, topics, own["per_file_type"], own["queries_per_doc"], own["seed"], own["allow_sample_with_replacement"], own.get("behavior_mix"), text, name, own.get("domain") or "hr").persist()
    try:
        out = own["out_dir"]
        os.makedirs(out, exist_ok=True)
        paths = {k: f"{out}/{n}" for k, n in (("queries", "queries.jsonl"), ("stats", "stats.json"), ("manifest", "manifest.json"))}
        n = sinks.write_questions_file(questions, paths["queries"])
        stats = sinks.stats(questions)
        inputs = {"annotations_dir": own["annotations_dir"], "docs_dir": own["docs_dir"], "templates_path": own["templates_path"]}
        manifest = sinks.manifest(questions, own["seed"], inputs, params, {k: paths[k] for k in ("queries", "stats")})
        for key, value in (("stats", stats), ("manifest", manifest)):
            with open(paths[key], "w", encoding="utf-8") as f:
                json.dump(value, f, ensure_ascii=False, indent=2)
        print(f"{n} questions in {paths['queries']}")
    finally:
        questions.unpersist()


def _config(path: str | None) -> dict:
    """Keys of a configuration file that a question set takes; paths are put beside the others."""
    if not path:
        return {}
    got = annotations.config(path)
    known = {"domain", "seed", "per_file_type", "queries_per_doc", "allow_sample_with_replacement", "balance_keys", "behavior_mix", "paths"}
    if set(got) - known:
        raise Refused(f"{path}: unknown keys {', '.join(sorted(set(got) - known))}")
    out = {k: got.get(k) for k in known - {"paths", "balance_keys"}}
    return out | {k: v for k, v in (got.get("paths") or {}).items() if k in ("annotations_dir", "docs_dir", "out_dir", "templates_path")}


def _service(spark: SparkSession, args: argparse.Namespace, mock: bool, level: int = logging.INFO) -> AnnotationService:
    backends.install()
    log = get_logger(level)
    llm = detector = None
    if mock:
        llm = mock_model
    else:
        url = os.environ.get("QUIRELENS_MODEL_URL")
        if url:
            llm = http_model(url, os.environ.get("QUIRELENS_MODEL", "default"), "QUIRELENS_MODEL_KEY" if "QUIRELENS_MODEL_KEY" in os.environ else None, functions=True)
        else:
            log.warning("no model: QUIRELENS_MODEL_URL is not set; rules stand")
            llm = mock_model
        import importlib.util

        if not getattr(args, "no_ocr", False) and importlib.util.find_spec("paddleocr"):
            detector = paddle_detector(lang="ch")
    config = annotations.config(args.config) if args.config else None
    return AnnotationService(spark, args.parser, config, detector, llm, level)


def annotate(spark: SparkSession, args: argparse.Namespace) -> None:
    began = time.time()
    source = os.path.abspath(_folder(spark, args.input)) if "://" not in args.input else _folder(spark, args.input)
    target = os.path.abspath(args.output) if "://" not in args.output else args.output
    if args.log_to_file:
        get_logger(log_dir=args.log_dir)
        print(f"log: {log_path()}")
    service = _service(spark, args, args.use_mock)
    failed = annotations.known_failures(spark, source)
    outputs = None
    if not args.no_skip_existing and exists(spark, target):
        outputs = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(target).select(F.regexp_replace("path", r"^file:/+", "/").alias("path"))
    good, bad = service.batch(source, failed, outputs, target, not args.no_skip_existing)
    service.save(good, source, target)
    n_bad = bad.count()
    n_good = good.count()
    if n_bad:
        # beside the annotations, not among them
        report = target.rstrip("/") + "_failed_files"
        sinks.write_failures(bad, report)
        print(f"failures: {report}")
    for r in bad.toLocalIterator() if args.verbose else ():  # a partition at a time
        print(f"failed: {r['file']}: {r['error']}")
    print(f"processed {n_good + n_bad}, success {n_good}, failed {n_bad}, {time.time() - began:.2f} s, output {qualified(spark, target)}")


def one(spark: SparkSession, args: argparse.Namespace) -> None:
    level = logging.DEBUG if args.verbose else logging.WARNING if args.quiet else logging.INFO
    if not exists(spark, args.file_path):
        raise Refused(f"no such file: {args.file_path}")
    service = _service(spark, args, True, level)
    print(json.dumps({k: v for k, v in service.annotate(args.file_path).items() if v is not None}, ensure_ascii=False, indent=2))


def compare(spark: SparkSession, args: argparse.Namespace) -> None:
    backends.install()
    rows = compare_backends(spark, _folder(spark, args.path)).persist()
    try:
        if args.output:
            sinks.write_comparison(rows, args.output)
            print(f"comparison in {args.output}")
        for r in rows.groupBy("backend").agg(F.count_if("success").alias("good"), F.count("*").alias("n")).orderBy("backend").collect():
            print(f"{r['backend']}: {r['good']} of {r['n']}")
    finally:
        rows.unpersist()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="quirelens")
    sub = top.add_subparsers(dest="command", required=True)

    def command(fn, text: str) -> argparse.ArgumentParser:
        p = sub.add_parser(fn.__name__, help=text)
        p.set_defaults(run=fn)
        return p

    p = command(analyze, "reports on annotations")
    p.add_argument("--input", "-i", default="annotations")
    p.add_argument("--output", "-o", default="reports")
    p.add_argument("--folder", "-f")
    p.add_argument("--sparse-threshold", type=int, default=3)
    p.add_argument("--complexity-threshold", type=int, default=3)
    for k in ("json", "csv", "md"):
        p.add_argument(f"--{k}-only", action="store_true")
    p.add_argument("--quiet", "-q", action="store_true")

    p = command(export, "one CSV row per annotation")
    p.add_argument("--input", "-i", default="annotations")
    p.add_argument("--output", "-o", default="reports/files.csv")

    p = command(generate, "a question set")
    p.add_argument("--annotations_dir", default="annotations")
    p.add_argument("--docs_dir", default="")
    p.add_argument("--out_dir", default="queries")
    p.add_argument("--templates_path", default="templates.json")
    p.add_argument("--per_file_type", type=int, default=50)
    p.add_argument("--queries_per_doc", type=int, default=2)
    p.add_argument("--seed", type=int, default=sampling.SEED)
    p.add_argument("--ground_with_content", action="store_true")
    p.add_argument("--allow_sample_with_replacement", action="store_true")
    p.add_argument("--legacy_profiles", action="store_true", help="read pdf_profile alone, as older sets did")
    p.add_argument("--config", help="JSON or YAML whose keys go before the options")

    p = command(annotate, "annotations of all documents below a folder")
    p.add_argument("--input", default="documents")
    p.add_argument("--output", default="annotations")
    p.add_argument("--use-mock", action="store_true")
    p.add_argument("--no-skip-existing", action="store_true")
    p.add_argument("-v", "--verbose", action="store_true")
    p.add_argument("--parser", choices=documents.BACKENDS, default="auto")
    p.add_argument("--log-to-file", action="store_true")
    p.add_argument("--log-dir", default="logs")
    p.add_argument("--config")

    p = command(one, "one file's annotation")
    p.add_argument("file_path")
    p.add_argument("-v", "--verbose", action="store_true")
    p.add_argument("-q", "--quiet", action="store_true")
    p.add_argument("--parser", choices=documents.BACKENDS, default="auto")
    p.add_argument("--no-ocr", action="store_true")
    p.add_argument("--config")

    p = command(compare, "what the parsers make of the same files")
    p.add_argument("path")
    p.add_argument("--batch", action="store_true", help="accepted for folders, which are taken whole anyway")
    p.add_argument("--output", "-o")
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    try:
        args.run(spark or _session(), args)
        return 0
    except (Refused, ValueError, FileNotFoundError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 1
    finally:
        close_logger()
