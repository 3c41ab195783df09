"""Mergeable partial counts, so that reports over a growing set of annotations read each annotation once.

A state has one row per section, folder and key: how many annotations have it and the first of them.  States of any split
of the rows merge into the state of all: counts add up, the first is the least.  A store keeps, per batch, the facts of its
annotations (small rows) and their state; one more batch reads that batch and, if it annotates files again, the facts of the
batches that had them, whose states are counted anew without these files (a first cannot be subtracted)."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import TAGS
from ..sources.files import exists, qualified, write_bytes
from .analytics import bucket_key, with_stressors
from .stressors import tag

STATE = ("section", "folder", "key")


def facts(ann: DataFrame, source: str = "source_file") -> DataFrame:
    """source, ordinal, folder, facts (section, key) of each annotation; null keys are keys of their own."""

    def fact(section: str, key: Column) -> Column:
        return F.struct(F.lit(section).alias("section"), key.cast("string").alias("key"))

    some = [fact("file_type", F.col("file_type")), fact("layout", F.coalesce("profile.layout", F.lit("unknown"))), fact("stressor_count", F.col("stressor_count"))]
    some += [fact("tag", F.concat(F.lit(f"{t}="), F.coalesce(tag(t).cast("string"), F.lit("na")))) for t in TAGS]
    some += [F.when(F.col("stressor_count") > 0, fact("combo", F.array_join(F.array_sort("stressors"), "|"))), F.when(F.col("file_type") == "pdf", fact("level2", bucket_key()))]
    each = F.concat(F.array_compact(F.array(*some)), F.transform("stressors", lambda s: fact("stressor", s)))
    return with_stressors(ann).select(F.col(source).alias("source"), "ordinal", "folder", each.alias("facts"))


def state(rows: DataFrame) -> DataFrame:
    """section, folder, key, n, first_ordinal of rows of `facts`, in one aggregate."""
    return rows.select("folder", "ordinal", F.inline("facts")).groupBy(*STATE).agg(F.count("*").alias("n"), F.min("ordinal").alias("first_ordinal"))


def merge(*states: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, states).groupBy(*STATE).agg(F.sum("n").alias("n"), F.min("first_ordinal").alias("first_ordinal"))


def section(merged: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
    """*by, key, n, first_ordinal of one section: over all folders, or with by=("folder",) of each."""
    return merged.filter(F.col("section") == name).groupBy(*by, "key").agg(F.sum("n").alias("n"), F.min("first_ordinal").alias("first_ordinal"))


def tag_rates(merged: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """*by, tag, n_true, n_false, n_na, true_rate, as a recount gives them."""
    rows = merged.filter("section = 'tag'").select(*by, F.substring_index("key", "=", 1).alias("tag"), F.substring_index("key", "=", -1).alias("v"), "n")
    own = rows.groupBy(*by, "tag").agg(*[F.coalesce(F.sum(F.when(F.col("v") == v, F.col("n"))), F.lit(0)).alias(c) for v, c in (("true", "n_true"), ("false", "n_false"), ("na", "n_na"))])
    return own.withColumn("true_rate", F.try_divide(F.col("n_true").cast("double"), (F.col("n_true") + F.col("n_false")).cast("double")))


class Partials:
    """Batches of annotations below a folder.  What counts is what the last record of `_versions` names, so that a batch is seen
    whole or not at all; a batch added again, under its name, takes the place of its first form.  One writer at a time."""

    def __init__(self, spark: SparkSession, root: str, ordinal: str = "bigint", source: str = "string") -> None:
        self.spark, self.root = spark, qualified(spark, root)
        self._facts = f"source {source}, ordinal {ordinal}, folder string, facts array<struct<section string, key string>>"
        self._state = f"section string, folder string, key string, n bigint, first_ordinal {ordinal}"

    def _current(self) -> tuple[int, dict[str, dict[str, str]]]:
        """Number of the last version, and the folders of each batch, oldest first: {name: {facts, state}}."""
        at = f"{self.root}/_versions"
        if not exists(self.spark, at):
            return 0, {}
        last = self.spark.read.text(at, wholetext=True).select(F.max(F.struct(F.get_json_object("value", "$.version").cast("int"), "value")).alias("m")).first()["m"]
        record = json.loads(last["value"]) if last else {"version": 0, "batches": {}}
        return record["version"], record["batches"]

    def _put(self, rows: DataFrame, kind: str) -> str:
        at = f"{self.root}/{kind}/{uuid.uuid4().hex}"
        rows.write.parquet(at)
        return at

    def _read(self, paths: list[str], schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def add(self, ann: DataFrame, name: str, source: str = "source_file") -> list[str]:
        """Adds a batch; files that earlier batches had are taken out of these.  Returns the names of the batches counted anew."""
        version, have = self._current()
        have = {k: v for k, v in have.items() if k != name}
        at = self._put(facts(ann, source), "facts")
        own = self._read([at], self._facts)
        again, new = [], own.select("source").distinct()
        for batch, where in have.items():
            old = self._read([where["facts"]], self._facts)
            if old.select("source").join(new, "source").limit(1).count():
                kept = self._put(old.join(new, "source", "left_anti").select(*old.columns), "facts")
                have[batch] = {"facts": kept, "state": self._put(state(self._read([kept], self._facts)), "state")}
                again.append(batch)
        have[name] = {"facts": at, "state": self._put(state(own), "state")}
        write_bytes(f"{self.root}/_versions/{version + 1:09d}.json", json.dumps({"version": version + 1, "batches": have}).encode(), self.spark)
        return again

    def merged(self) -> DataFrame:
        """The state of all batches; reads states alone."""
        return merge(self._read([x["state"] for x in self._current()[1].values()], self._state))
