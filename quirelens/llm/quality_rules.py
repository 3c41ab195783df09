"""Quality rules by distribution divergence, with DataFrame functions alone.

Each text's histogram of character classes and its histogram of common words are compared with the
references of its language by Jensen-Shannon distance (base 2).  References are sums over all texts
of the language that pass the base rules; languages without a word list share one pooled reference.
So a verdict depends on the corpus.  A language whose reference has under `min_reference` words says
nothing of its texts, least of all of those it is made of: their characters are compared with the sum
over all languages, their words not at all.  Texts under a minimum length are not judged by divergence.
One scan computes counts per text, in the row, without a shuffle; the second step reads the thin table
of counts.

Null and empty texts: no words, base_failed.  Repeated rows: each row is returned.  Null languages:
pooled reference.  Ties need no rule.  Very long texts: all work is linear or n log n in the words.
An empty table: no rows.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

# The most common function words by language.
COMMON_WORDS = {
    "en": "the of and to in is that it was for with on as by at be this from or an are not have which".split(),
    "fr": "de la le et les des en un une du dans est que qui pour par sur au pas ce plus avec son ne".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden".split(),
    "es": "de la que el en y a los del se las por un para con no una su al lo como más pero sus".split(),
}
POOLED = "und"
#: Fixed: ASCII white space as a Java pattern.
SPACES = r"[\x20\x09-\x0D]+"
CLASSES = ("upper", "digit", "punctuation", "symbol", "space", "other")


def _words(lang: str) -> list[str]:
    return COMMON_WORDS.get(lang) or sorted({w for ws in COMMON_WORDS.values() for w in ws[:6]})


def text_counts(docs: DataFrame) -> DataFrame:
    """doc_id, lang (that has a reference), base counts, chars (by class) and common (by word, then all others)."""
    lang = F.when(F.col("lang").isin(*COMMON_WORDS), F.col("lang")).otherwise(POOLED) if "lang" in docs.columns else F.lit(POOLED)
    text = F.coalesce(F.col("text"), F.lit(""))
    every = sorted({w for k in [*COMMON_WORDS, POOLED] for w in _words(k)})
    lists = F.create_map(*[x for k in [*COMMON_WORDS, POOLED] for x in (F.lit(k), F.array(*map(F.lit, _words(k))))])

    def count(pattern: str) -> Column:
        return F.length(F.regexp_replace("text", pattern, "")).cast("long")

    rows = docs.select("doc_id", lang.alias("lang"), text.alias("text"), F.array_remove(F.split(text, SPACES), "").alias("words"), F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    n = F.size("words")
    gram = F.transform(F.expr("sequence(0, size(words) - 3)"), lambda i: F.struct(F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)).alias("h"), i.alias("i")))
    nothing = F.array().cast("array<struct<h:bigint,i:int>>")
    rows = rows.select(
        "doc_id",
        "lang",
        n.cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length("text").cast("long").alias("length"),
        count(r"[^#*$%&|<>]+").alias("n_symbols"),
        count(r"\P{Lu}+").alias("upper"),
        count(r"[^0-9]+").alias("digit"),
        count(r"""[^.,;:!?'"()\-]+""").alias("punctuation"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(n >= 3, F.sort_array(gram)).otherwise(nothing).alias("grams"),
        F.filter(F.transform("words", lambda w: F.lower(F.rtrim(w, F.lit(".,;:!?")))), lambda w: w.isin(*every)).alias("found"),
    )
    # the same hash before or after it in sorted order: the window is there twice
    twice = F.filter("grams", lambda x, j: (x["h"] == F.get("grams", j - 1)["h"]) | (x["h"] == F.get("grams", j + 1)["h"]))
    rows = rows.withColumn("repeats", F.sort_array(F.transform(twice, lambda x: x["i"]))).drop("grams")
    steps = F.aggregate(F.expr("sequence(1, size(repeats) - 1)"), F.lit(0).cast("long"), lambda acc, j: acc + F.least(F.lit(3), F.get("repeats", j) - F.get("repeats", j - 1)))
    repeat = F.when(F.size("repeats") == 0, F.lit(0)).when(F.size("repeats") == 1, F.lit(3)).otherwise(steps + 3).cast("long")
    per_word = F.transform(F.element_at(lists, F.col("lang")), lambda w: (F.size("found") - F.size(F.array_remove("found", w))).cast("long"))
    rows = rows.withColumn("n_repeat_words", repeat).withColumn("common", per_word)
    rows = rows.withColumn("common", F.concat("common", F.array(F.col("n_words") - F.aggregate("common", F.lit(0).cast("long"), lambda a, x: a + x))))
    space = F.col("length") - F.col("word_chars")
    other = F.col("length") - F.col("upper") - F.col("digit") - F.col("punctuation") - F.col("n_symbols") - space
    rows = rows.withColumn("chars", F.array("upper", "digit", "punctuation", "n_symbols", space, other))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.select("doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), "chars", "common")


def references(counts: DataFrame) -> DataFrame:
    """Sums over all texts by language (five rows at most): lang, ref_words, ref_chars, ref_common."""
    widths = {"chars": len(CLASSES), "common": 1 + max(len(_words(k)) for k in [*COMMON_WORDS, POOLED])}
    sums = [F.sum(F.coalesce(F.get(c, F.lit(i)), F.lit(0))).alias(f"{c}{i}") for c, w in widths.items() for i in range(w)]
    per = counts.filter(~F.col("base_failed")).groupBy("lang").agg(*sums, F.sum("n_words").alias("ref_words"))
    return per.select("lang", "ref_words", *[F.array(*[F.col(f"{c}{i}") for i in range(w)]).alias(f"ref_{c}") for c, w in widths.items()])


def js_distance(p: str, q: str) -> Column:
    """Jensen-Shannon distance (base 2) of two histograms; null if either is empty."""

    def total(c: str) -> Column:
        return F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x).cast("double")

    def part(x: Column, n: Column, y: Column, m: Column) -> Column:
        a, b = x / n, y / m
        return F.when(x > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)

    a, b = F.col(p), F.col(q)
    both = F.transform(F.arrays_zip(a.alias("x"), b.alias("y")), lambda z: F.struct(z["x"].cast("double").alias("x"), F.coalesce(z["y"], F.lit(0)).cast("double").alias("y")))
    n, m = F.col(f"_n_{p}"), F.col(f"_n_{q}")
    sum_ = F.aggregate(both, F.lit(0.0), lambda acc, z: acc + F.when(z["x"].isNull(), 0.0).otherwise(part(z["x"], n, z["y"], m) + part(z["y"], m, z["x"], n)))
    return F.when((n > 0) & (m > 0), F.sqrt(F.greatest(sum_ / 2, F.lit(0.0))))


def judge(docs: DataFrame, min_words: int = 60, min_reference: int = 2_000, max_chars: tuple[float, float] = (0.15, 0.5), max_common: tuple[float, float] = (0.1, 2.0)) -> DataFrame:
    """Limits are a + b / sqrt(n_words): the distance of a sample from its own source falls like that.

    One row per row of docs: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, js_chars, js_common."""
    counts = materialize(text_counts(docs), "counts")
    by_lang = references(counts)
    enough = F.col("ref_words") >= min_reference
    every = by_lang.agg(F.array(*[F.sum(F.col("ref_chars")[i]) for i in range(len(CLASSES))]).alias("all_chars"))
    refs = by_lang.crossJoin(every)  # five rows at most, and one
    refs = refs.select("lang", F.when(enough, F.col("ref_chars")).otherwise(F.col("all_chars")).alias("ref_chars"), F.when(enough, F.col("ref_common")).alias("ref_common"))
    rows = counts.join(F.broadcast(refs), "lang", "left")
    for c in ("chars", "common", "ref_chars", "ref_common"):
        rows = rows.withColumn(f"_n_{c}", F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x).cast("double"))
    rows = rows.withColumn("js_chars", js_distance("chars", "ref_chars")).withColumn("js_common", js_distance("common", "ref_common"))
    chars, common = (a + b / F.sqrt(F.greatest(F.col("n_words"), F.lit(1)).cast("double")) for a, b in (max_chars, max_common))
    like = (F.col("n_words") < min_words) | ((F.coalesce("js_chars", F.lit(0.0)) <= chars) & (F.coalesce("js_common", F.lit(0.0)) <= common))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & like).alias("kept"), "js_chars", "js_common")
