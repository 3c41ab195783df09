"""Templates for items, by an inverted index.

An item (file_type, stressors, expected_behavior) fits a template of its behaviour that names its file type or none
and one of its stressors or none.  The index has a posting for every behaviour, file type (or any) and stressor (or
any) of a template.  It is probed not by items but by their profiles, the distinct combinations of the three:
these are counted first, so that the number of pairs doesn't grow with the items, and a profile that very many items have is one.

Templates: id, query, expected_behavior, stressors_any, file_types_any, ord (file order)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.files import stored
from .skew import spread_join

ANY = "*"


def _named(c: Column) -> Column:
    return F.concat(F.lit("="), c)


def _axis(names: Column) -> Column:
    """Keys of a template on one axis: its names, or any."""
    own = F.array_distinct(F.filter(F.coalesce(names, F.array().cast("array<string>")), lambda x: x.isNotNull()))
    return F.when(F.size(F.coalesce(names, F.array().cast("array<string>"))) == 0, F.array(F.lit(ANY))).otherwise(F.transform(own, _named))


def postings(templates: DataFrame) -> DataFrame:
    """b, f, s (the key), ord, template_id, query of templates that name a file type or a stressor."""
    rows = templates.select(F.col("expected_behavior").alias("b"), "ord", F.col("id").alias("template_id"), "query", _axis(F.col("file_types_any")).alias("fs"), _axis(F.col("stressors_any")).alias("ss"))
    rows = rows.filter(~((F.array_contains("fs", ANY)) & (F.array_contains("ss", ANY))))
    return rows.withColumn("f", F.explode("fs")).withColumn("s", F.explode("ss")).select("b", "f", "s", "ord", "template_id", "query")


def profile() -> Column:
    """The name of an item's combination."""
    return F.to_json(F.struct("expected_behavior", "file_type", "stressors"))


def profiles(items: DataFrame) -> DataFrame:
    """A stored table: _profile, expected_behavior, file_type, stressors, _items (how many)."""
    return stored(items.groupBy(profile().alias("_profile")).agg(F.first("expected_behavior").alias("expected_behavior"), F.first("file_type").alias("file_type"), F.first("stressors").alias("stressors"), F.count("*").alias("_items")))


def specific(found: DataFrame, templates: DataFrame) -> DataFrame:
    """_profile, ord, template_id, query of templates that fit a profile and name a file type or a stressor, each once."""
    keys = found.select("_profile", F.col("expected_behavior").alias("b"), F.array(F.lit(ANY), _named(F.col("file_type"))).alias("fs"), F.concat(F.array(F.lit(ANY)), F.transform(F.coalesce("stressors", F.array().cast("array<string>")), _named)).alias("ss"))
    probes = keys.withColumn("f", F.explode("fs")).withColumn("s", F.explode("ss")).drop("fs", "ss")
    return probes.join(postings(templates), ["b", "f", "s"]).groupBy("_profile", "ord").agg(F.first("template_id").alias("template_id"), F.first("query").alias("query"))


def generic(templates: DataFrame) -> DataFrame:
    """b, ord, template_id, query of templates that name neither."""
    none = F.array().cast("array<string>")
    bare = (F.size(F.coalesce("stressors_any", none)) == 0) & (F.size(F.coalesce("file_types_any", none)) == 0)
    return templates.filter(bare).select(F.col("expected_behavior").alias("b"), "ord", F.col("id").alias("template_id"), "query")


def matches(items: DataFrame, templates: DataFrame) -> DataFrame:
    """Items with every template that fits: template_id, query, ord."""
    found = profiles(items)
    bare = found.select("_profile", F.col("expected_behavior").alias("b")).join(generic(templates), "b").drop("b")
    pairs = specific(found, templates).unionByName(bare)
    return spread_join(items.withColumn("_profile", profile()), pairs, ["_profile"], found.select("_profile", "_items"), "_items").drop("_profile")


def options(found: DataFrame, templates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(tiers: _profile, tier, _list, _n; lists: _list, _place from 0, template_id, query, in file order).

    Tier 1: templates that fit and name something; 2: those that fit and name nothing; 4: any of behaviour answer.  The lists
    of 2 and 4 are shared by all profiles of a behaviour and by all.  (Templates of the behaviour that name nothing always fit,
    so a tier of them after 2 would stay empty.)"""
    if templates.filter("expected_behavior = 'answer'").limit(1).count() == 0:
        raise ValueError("the template library has no template with expected_behavior answer to fall back on")
    own = specific(found, templates).withColumn("_list", F.concat(F.lit("1 "), "_profile")).drop("_profile")
    bare = generic(templates).withColumn("_list", F.concat(F.lit("2 "), "b")).drop("b")
    rest = templates.filter("expected_behavior = 'answer'").select("ord", F.col("id").alias("template_id"), "query", F.lit("4").alias("_list"))
    lists = own.unionByName(bare).unionByName(rest)
    sizes = lists.groupBy("_list").agg(F.count("*").alias("_n"))
    named = found.select("_profile", F.explode(F.array(F.struct(F.lit(1).alias("tier"), F.concat(F.lit("1 "), "_profile").alias("_list")), F.struct(F.lit(2).alias("tier"), F.concat(F.lit("2 "), "expected_behavior").alias("_list")), F.struct(F.lit(4).alias("tier"), F.lit("4").alias("_list")))).alias("x"))
    tiers = named.select("_profile", "x.*").join(sizes, "_list").groupBy("_profile").agg(F.min(F.struct("tier", "_list", "_n")).alias("x")).select("_profile", "x.*")
    placed = lists.withColumn("_place", F.expr("row_number() over (partition by _list order by ord)") - 1)
    return tiers, placed.select("_list", "_place", "template_id", "query")


def with_options(items: DataFrame, templates: DataFrame) -> DataFrame:
    """Items with `tier` and `options`, the ids of the best tier's templates in file order."""
    found = profiles(items)
    tiers, lists = options(found, templates)
    whole = lists.groupBy("_list").agg(F.transform(F.array_sort(F.collect_list(F.struct("_place", "template_id"))), lambda x: x["template_id"]).alias("options"))
    own = tiers.join(whole, "_list").select("_profile", "tier", "options")
    return spread_join(items.withColumn("_profile", profile()), own, ["_profile"], found.select("_profile", "_items"), "_items").drop("_profile")


def with_choice(items: DataFrame, templates: DataFrame, draw: Column) -> DataFrame:
    """Items with `tier`, `template_id` and `query` of one of the best tier's templates, by a draw (a long).

    Items are a question set's, as many as its quotas allow."""
    tiers, lists = options(profiles(items), templates)
    own = items.withColumn("_profile", profile()).join(tiers, "_profile")
    return own.withColumn("_place", F.try_mod(draw, F.col("_n")).cast("int")).join(lists, ["_list", "_place"]).drop("_profile", "_n", "_list", "_place")
