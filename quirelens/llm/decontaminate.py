"""Benchmark decontamination with DataFrame functions alone.

The benchmark's distinct windows of `width` words (an item with fewer words is one window) get ids and
are written once as a table, and so are (window id, item) as rows: which items have a window is joined
to hits only, and a window of very many items is dealt to several tasks, never one row.  Each document's words are scanned once, in one codegen span: explode with position,
hash the next words, probe a broadcast hash table, and verify a hit on the words themselves.

While there are at most `table_rows` windows of at most `table_bytes` of words, the broadcast table
holds their words and decides at once.  Beyond that it holds their 64-bit hashes alone, `hash_rows` of them at a time (each such pass is
a job of its own, whose hits are written before the next table is sent), and the few positions that it
lets through are joined with the windows by a shuffle.  Memory is bounded whatever the benchmark's size.

Null texts and texts without words: no words, no hits, not contaminated.  Null items have no windows.
Very long texts: one row a word inside the scan, never gathered again; only hits leave it.  Repeated
rows and rows without id: each is returned; their equal hits are dropped before they meet.  Ties need
no rule.  An empty table of documents: no rows; of items: nothing is contaminated.  Extra columns:
ignored by `contamination`, kept by `drop_contaminated`, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import spread_join
from .common import ascii_lower, forget, free_names, hot_lookup, materialize

#: Fixed: what separates words, as a Java pattern.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Lower-cased words of a text in order (null: none)."""
    return F.coalesce(F.array_remove(F.split(ascii_lower(text), SEPARATORS), ""), F.array().cast("array<string>"))


def window_tables(items: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """Written tables of the distinct windows (wid, len, window, h, n_items) and of who has them (wid, item)."""
    words = items.select(F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("words")).filter("size(words) > 0")
    starts = F.expr(f"sequence(0, greatest(size(words) - {width}, 0))")
    windows = words.select("item", F.explode(starts).alias("at"), "words").select("item", F.expr(f"slice(words, at + 1, {width})").alias("window"))
    held = materialize(windows.distinct(), "held")
    h = F.xxhash64(*[F.get("window", F.lit(i)) for i in range(width)]).alias("h")
    # the table is written, so that its numbers are drawn once
    own = materialize(held.groupBy("window").agg(F.count("*").alias("n_items")).select(F.monotonically_increasing_id().alias("wid"), F.size("window").alias("len"), "window", h, "n_items"), "windows")
    who = materialize(hot_lookup(held, own.select("window", "wid", "n_items"), ["window"], "n_items").select("wid", "item"), "items")
    forget(held)
    return own, who


def _scanned(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id"), F.xxhash64("text").alias("th"), words_of(F.col("text")).alias("words")).select("doc_id", "th", "words", F.posexplode("words").alias("pos", "word"))


def _key(length: int) -> Column:
    return F.xxhash64(*[F.get("words", F.col("pos") + i) for i in range(length)])


def _words_at(length: int) -> Column:
    return F.slice("words", F.col("pos") + 1, F.lit(length))


def _hits_at_once(docs: DataFrame, table: DataFrame, lengths: list[int]) -> DataFrame:
    rows, stops, found = _scanned(docs), [], []
    for n in lengths:
        part = table.filter(F.col("len") == n).select(F.col("h").alias(f"h{n}"), F.col("window").alias(f"w{n}"), F.col("wid").alias(f"i{n}"))
        rows = rows.join(F.broadcast(part), (_key(n) == F.col(f"h{n}")) & F.coalesce(_words_at(n) == F.col(f"w{n}"), F.lit(False)), "left")
        stops.append(F.when(F.col(f"h{n}").isNotNull(), F.col("pos") + n))
        found.append(F.col(f"i{n}"))
    rows = rows.withColumn("stop", F.greatest(*stops, F.lit(None)).cast("int")).filter(F.col("stop").isNotNull())
    return rows.select("doc_id", "th", "pos", "stop", F.array_compact(F.array(*found)).alias("wids"))


def _hits_by_hash(docs: DataFrame, table: DataFrame, sizes: dict[int, int], hash_rows: int) -> DataFrame:
    out = []
    for n, rows in sizes.items():
        blocks = -(-rows // hash_rows)
        for block in range(blocks):
            hashes = table.filter((F.col("len") == n) & (F.pmod(F.xxhash64(F.lit(7), "h"), F.lit(blocks)) == block)).select(F.col("h").alias("wh")).distinct()
            near = _scanned(docs).join(F.broadcast(hashes), _key(n) == F.col("wh"))
            out.append(materialize(near.select("doc_id", "th", "pos", F.col("wh").alias("h"), _words_at(n).alias("window"), F.lit(n).alias("n")).filter(F.size("window") == n), "near"))
    near = reduce(DataFrame.unionByName, out)
    # plain exchanges on both sides: a window that very many documents hold is split at run time
    found = near.join(table.select("h", F.col("window").alias("own"), "wid"), "h").filter("window = own")
    return found.select("doc_id", "th", "pos", (F.col("pos") + F.col("n")).alias("stop"), F.array("wid").alias("wids"))


def hits(docs: DataFrame, table: DataFrame, width: int = 10, table_rows: int = 200_000, hash_rows: int = 4_000_000, table_bytes: int = 64 << 20) -> DataFrame:
    """One row per document word at which a window of `table` occurs: doc_id, th (the text's hash), pos, stop (end of the longest window here), wids (at most `width`).

    A written table: what reads it twice scans the texts once."""
    size = F.aggregate("window", F.lit(0).cast("long"), lambda a, w: a + F.octet_length(w) + 16)
    sizes = {r["len"]: (r["n"], r["b"]) for r in table.groupBy("len").agg(F.count("*").alias("n"), F.sum(size).alias("b")).collect()}  # width rows at most
    if not sizes:
        return _hits_at_once(docs.limit(0), table, [width])
    if sum(n for n, _ in sizes.values()) <= table_rows and sum(b for _, b in sizes.values()) <= table_bytes:
        return materialize(_hits_at_once(docs, table, sorted(sizes, reverse=True)), "hits")
    return materialize(_hits_by_hash(docs, table, {k: n for k, (n, _) in sizes.items()}, hash_rows), "hits")


def _items_of(found: DataFrame, who: DataFrame) -> DataFrame:
    """doc_id, th, item of all hits, once each; windows with a large share of all (hit, window) rows are dealt to several tasks."""
    seen = materialize(found.select("doc_id", "th", F.explode("wids").alias("wid")).distinct(), "seen")
    counts = materialize(seen.groupBy("wid").agg(F.count("*").alias("n_seen")), "seen-counts")
    return spread_join(seen, who, ["wid"], counts, "n_seen").select("doc_id", "th", "item").distinct()


def contamination(docs: DataFrame, items: DataFrame, width: int = 10, **how) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_hit, n_items, items_sha256, contaminated (and th, the text's hash)."""
    table, who = window_tables(items, width)
    found = hits(docs, table, width, **how)
    # equal hits of repeated rows and of rows without id become one, in each task before the shuffle
    spots = found.groupBy("doc_id", "th", "pos").agg(F.max("stop").alias("stop"))
    reach = F.expr("coalesce(max(stop) over (partition by doc_id, th order by pos rows between unbounded preceding and 1 preceding), 0)")
    covered = spots.withColumn("covered", F.greatest(F.col("stop") - F.greatest("pos", reach), F.lit(0))).groupBy("doc_id", "th").agg(F.sum("covered").alias("n_hit"))
    named = _items_of(found, who).groupBy("doc_id", "th").agg(F.array_sort(F.collect_list("item")).alias("items"))
    a, b = covered.alias("a"), named.alias("b")
    per = a.join(b, F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.th") == F.col("b.th"))).select(F.col("a.doc_id").alias("_d"), F.col("a.th").alias("_t"), "n_hit", "items")
    rows = docs.select("doc_id", F.xxhash64("text").alias("th"), F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    rows = rows.join(per, rows["doc_id"].eqNullSafe(per["_d"]) & (rows["th"] == per["_t"]), "left")
    n_hit, own = F.coalesce("n_hit", F.lit(0)).cast("long"), F.coalesce("items", F.array().cast("array<string>"))
    return rows.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(own).cast("long").alias("n_items"), F.sha2(F.array_join(own, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), "th")


def drop_contaminated(docs: DataFrame, items: DataFrame, width: int = 10, **how) -> DataFrame:
    """Rows of docs whose text holds no window of an item; all columns."""
    d, t = free_names(docs, 2)
    table, who = window_tables(items, width)
    forget(who)
    bad = hits(docs, table, width, **how).select(F.col("doc_id").alias(d), F.col("th").alias(t)).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad[d]) & (F.xxhash64(docs["text"]) == bad[t]), "left_anti")


CONTAMINATION_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
g AS (
  SELECT DISTINCT item_id, least(10, len(words)) AS l, array_to_string(words[s : s + 9], ' ') AS g
  FROM (SELECT item_id, words, unnest(generate_series(1, greatest(len(words) - 9, 1))) AS s FROM i WHERE len(words) > 0)),
d AS (
  SELECT doc_id, p, l, array_to_string(words[p : p + l - 1], ' ') AS g
  FROM (SELECT doc_id, words, unnest(generate_series(1, len(words))) AS p FROM w), (SELECT DISTINCT l FROM g) WHERE p + l - 1 <= len(words)),
h AS (SELECT d.doc_id, d.p, d.l, g.item_id FROM d JOIN g ON d.g = g.g AND d.l = g.l),
c AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(generate_series(p, p + l - 1)) AS x FROM (SELECT DISTINCT doc_id, p, l FROM h)) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""
