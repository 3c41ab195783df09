"""Feature lists of a document in the two vocabularies, and signatures.

Annotations have: ordinal, doc_id, folder, file_type, profile (schema.PROFILE)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import STRESSOR_TAGS


def tag(name: str) -> Column:
    """Tri-state value of a tag; layout is listed as a tag but has no truth value."""
    return F.lit(None).cast("boolean") if name == "layout" else F.col(f"profile.{name}")


def _present(pairs: list[tuple[Column, Column]]) -> Column:
    return F.filter(F.array(*[F.when(c, v) for c, v in pairs]), lambda x: x.isNotNull())


def analysis_stressors() -> Column:
    """Dotted tag names that are true, in list order, then layout=double or layout=mixed."""
    layout = F.col("profile.layout")
    return _present([(tag(t), F.lit(t)) for t in STRESSOR_TAGS] + [(layout.isin("double", "mixed"), F.concat(F.lit("layout="), layout))])


def sampling_stressors() -> Column:
    """file_type:x, layout:x and undotted names; sorted and distinct."""
    p = "profile."
    names = [t for t in STRESSOR_TAGS if t != "image_text_mixed"]
    layout = F.col("profile.layout")
    pairs = [(F.lit(True), F.concat(F.lit("file_type:"), F.lower(F.coalesce("file_type", F.lit("")))))]
    pairs += [(layout != "", F.concat(F.lit("layout:"), layout))] + [(F.col(p + n), F.lit(n.split(".")[-1])) for n in names]
    return F.array_sort(F.array_distinct(_present(pairs)))


def signature(stressors: Column) -> Column:
    core = F.filter(stressors, lambda s: ~F.startswith(s, F.lit("file_type:")))
    return F.when(F.size(core) == 0, F.lit("none")).otherwise(F.array_join(core, "|"))
