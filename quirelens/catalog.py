"""Named queries over a directory of tables, and the SQL that says the same.

Every query runs its operator over whole tables; limits stand only where a top-k is what is asked."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from html.entities import html5

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import scalar as X
from .functions.markup import visible_text
from .operators import analytics as A
from .operators import elements as E
from .operators import features as S
from .operators import incremental as I
from .operators import layout as L
from .operators import plugins as P
from .operators import sampling as Q
from .operators import sinks as K
from .operators.matching import matches, with_options
from .operators.partials import Partials
from .operators.stressors import sampling_stressors, signature
from .operators.topics import numbers_in, topics_in
from .plans.pipeline import Pipeline
from .plans.tables import ANN, BOXES, ELEMENTS, PAGE_BOXES, SAMPLED, STRESSED, TAG_VALUES, annotations, boxes, contents, failing, metadata, model_documents, page_boxes, read, table_elements
from .schema import ANSWER_CONSTRAINTS, BEHAVIOUR_MIX, EXPECTED_TYPES
from .sources import backends as B
from .sources.annotations import scan
from .sources.documents import resolve
from .sources.files import for_tasks, qualified, scratch
from .streaming.incremental import annotate_rows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql.strip()
        return fn

    return add


TEMPLATES = [
    ("policy", "What does {topic} say in {doc_title}?", "answer", [], []),
    ("table", "List the limits for {topic} in the table of {doc_id}.", "answer", ["has_table"], []),
    ("long_table", "Bring together all rows on {topic} across pages.", "answer", ["cross_page_table", "long_table"], []),
    ("order", "Give the steps of {topic} in order.", "answer", ["reading_order_sensitive"], []),
    ("chart", "What trend does the chart on {topic} show?", "partial", ["has_chart"], []),
    ("formula", "Write the formula for {topic}.", "answer", ["has_formula"], []),
    ("sheet", "Which columns hold {topic}?", "answer", [], ["excel"]),
    ("slides", "Which slides speak of {topic}?", "answer", [], ["ppt"]),
    ("section", "Which heading covers {topic}?", "answer", [], ["html"]),
    ("private", "Give the home address of one employee.", "refuse", [], []),
    ("vague", "What about {topic}?", "ask_clarification", [], []),
]
TOPICS = ["leave/rules", "overtime", "travel", "the/and", "tion", "training"]


def templates(spark: SparkSession) -> DataFrame:
    rows = [(i, *t) for i, t in enumerate(TEMPLATES)]
    return spark.createDataFrame(rows, "ord int, id string, query string, expected_behavior string, stressors_any array<string>, file_types_any array<string>")


def _list(values: list[str]) -> str:
    return "CAST([" + ", ".join(f"'{v}'" for v in values) + "] AS VARCHAR[])"


_TPL = "tpl AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, '{t[0]}', '{t[1]}', '{t[2]}', {_list(t[3])}, {_list(t[4])})" for i, t in enumerate(TEMPLATES)) + ") v(ord, id, query, b, s, f))"


def _h(purpose: str, *key: str) -> str:
    return f"CAST('0x' || substr(md5(concat_ws('|', '{Q.SEED}', '{purpose}', {', '.join(key)})), 1, 15) AS BIGINT)"


# --- distributions -----------------------------------------------------------------------------

_TAGS = f"(SELECT *, unnest([{', '.join(repr(t) for t, _ in TAG_VALUES)}]) AS tag, unnest([{', '.join(c for _, c in TAG_VALUES)}]) AS v FROM ann)"
_TAG_COUNTS = "count(*) FILTER (v) AS n_true, count(*) FILTER (NOT v) AS n_false, count(*) FILTER (v IS NULL) AS n_na, CASE WHEN count(v) > 0 THEN count(*) FILTER (v) / count(v) END AS true_rate"


@query(f"WITH {ANN} SELECT tag, {_TAG_COUNTS} FROM {_TAGS} GROUP BY tag")
def tag_distribution(spark, sf):
    return A.tag_distribution(annotations(spark, sf))


@query(f"WITH {ANN} SELECT folder, tag, {_TAG_COUNTS} FROM {_TAGS} GROUP BY folder, tag")
def folder_tag_distribution(spark, sf):
    return A.tag_distribution(annotations(spark, sf), ["folder"])


@query(f"WITH {ANN} SELECT coalesce(layout, 'unknown') AS layout, count(*) AS n, min(ordinal) AS first_ordinal FROM ann GROUP BY 1")
def layout_distribution(spark, sf):
    return A.layout_distribution(annotations(spark, sf))


@query(f"WITH {ANN} SELECT file_type, count(*) AS n, min(ordinal) AS first_ordinal, count(*) / sum(count(*)) OVER () AS share FROM ann GROUP BY 1")
def file_type_stats(spark, sf):
    return A.counts(annotations(spark, sf), "file_type")


@query(f"WITH {ANN} SELECT folder, count(*) AS n, min(ordinal) AS first_ordinal, count(*) / sum(count(*)) OVER () AS share FROM ann GROUP BY 1")
def folder_stats(spark, sf):
    return A.counts(annotations(spark, sf), "folder")


@query(f"WITH {ANN} SELECT folder, file_type, count(*) AS n, min(ordinal) AS first_ordinal, count(*) / sum(count(*)) OVER (PARTITION BY folder) AS share FROM ann GROUP BY 1, 2")
def folder_type_stats(spark, sf):
    return A.counts(annotations(spark, sf), "file_type", ["folder"])


@query(f"WITH {ANN} SELECT CASE WHEN g = 1 THEN 'file_type' WHEN g = 2 THEN 'folder' ELSE 'total' END AS kind, CASE WHEN g = 1 THEN file_type WHEN g = 2 THEN folder END AS key, n FROM (SELECT file_type, folder, grouping(file_type, folder) AS g, count(*) AS n FROM ann GROUP BY GROUPING SETS ((file_type), (folder), ()))")
def stats_grouping_sets(spark, sf):
    return A.grouped_counts(annotations(spark, sf))


@query(f"WITH {STRESSED} SELECT s AS stressor, count(*) AS n, min(ordinal) AS first_ordinal FROM (SELECT ordinal, unnest(st) AS s FROM st) GROUP BY 1")
def stressor_explode_counts(spark, sf):
    return A.stressor_counts(annotations(spark, sf))


@query(f"WITH {STRESSED} SELECT CAST(k AS INT) AS stressor_count, count(*) AS n FROM st GROUP BY 1")
def stressor_histogram(spark, sf):
    return A.stressor_histogram(annotations(spark, sf))


_COMBO = f"WITH {STRESSED}, c AS (SELECT array_to_string(list_sort(st), ', ') AS combo, count(*) AS n, min(ordinal) AS first_ordinal FROM st WHERE k > 0 GROUP BY 1)"


def _joined(df: DataFrame) -> DataFrame:
    return df.withColumn("combo", F.array_join("combo", ", "))


@query(f"{_COMBO} SELECT * FROM c ORDER BY n DESC, first_ordinal LIMIT 20")
def combo_top20(spark, sf):
    return _joined(A.top_combinations(annotations(spark, sf)))


@query(f"{_COMBO} SELECT * FROM c WHERE n <= 2 ORDER BY first_ordinal LIMIT 20")
def combo_rare(spark, sf):
    return _joined(A.rare_combinations(annotations(spark, sf)))


@query(f"{_COMBO} SELECT count(*) AS n_combinations, CAST(sum(n) AS BIGINT) AS n_docs FROM c")
def combo_distinct(spark, sf):
    return A.combinations(annotations(spark, sf)).agg(F.count("*").alias("n_combinations"), F.sum("n").alias("n_docs"))


@query(f"WITH {STRESSED} SELECT folder, array_to_string(list_sort(st), ', ') AS combo, count(*) AS n, min(ordinal) AS first_ordinal FROM st WHERE k > 0 GROUP BY 1, 2")
def folder_combo_stats(spark, sf):
    return _joined(A.combinations(annotations(spark, sf), ["folder"]))


@query(f"WITH {STRESSED}, f AS (SELECT doc_id, min_by(file_type, ordinal) AS t FROM ann GROUP BY doc_id) SELECT st.ordinal, st.doc_id, coalesce(f.t, 'unknown') AS file_type, CAST(k AS INT) AS stressor_count, array_to_string(st, ', ') AS stressors FROM st LEFT JOIN f ON f.doc_id = st.doc_id WHERE k >= 3")
def high_complexity_docs(spark, sf):
    return A.high_complexity(annotations(spark, sf)).withColumn("stressors", F.array_join("stressors", ", "))


# --- buckets, gaps, advice ---------------------------------------------------------------------

_BUCKET = "array_to_string(list_sort(list_filter(['layout=' || coalesce(layout, 'single'), CASE WHEN has_table THEN 'has_table' END, CASE WHEN has_chart THEN 'has_chart' END, CASE WHEN has_image THEN 'has_image' END, CASE WHEN cross_page_table THEN 'cross_page_table' END, CASE WHEN long_table THEN 'long_table' END], lambda x: x IS NOT NULL)), ' | ')"
_SPARSE = f"sp AS (SELECT 'file_type=' || file_type AS bucket, count(*) AS n FROM ann GROUP BY 1 HAVING count(*) < 3 UNION ALL SELECT 'pdf/' || b AS bucket, count(*) AS n FROM (SELECT {_BUCKET} AS b FROM ann WHERE file_type = 'pdf') GROUP BY 1 HAVING count(*) < 3)"


@query(f"WITH {ANN} SELECT file_type, count(*) AS n, min(ordinal) AS first_ordinal FROM ann GROUP BY 1")
def bucket_level1(spark, sf):
    return A.bucket_level1(annotations(spark, sf))


@query(f"WITH {ANN} SELECT bucket, count(*) AS n, min(ordinal) AS first_ordinal FROM (SELECT *, {_BUCKET} AS bucket FROM ann WHERE file_type = 'pdf') GROUP BY 1")
def bucket_level2_pdf(spark, sf):
    return A.bucket_level2(annotations(spark, sf))


@query(f"WITH {ANN} SELECT 1 AS level, file_type AS bucket, ordinal, doc_id FROM ann UNION ALL SELECT 2, {_BUCKET}, ordinal, doc_id FROM ann WHERE file_type = 'pdf'")
def bucket_members(spark, sf):
    return A.bucket_members(annotations(spark, sf))


@query(f"""WITH {STRESSED}, f AS (
  SELECT 'file_type' AS section, folder, file_type AS key, ordinal FROM st
  UNION ALL SELECT 'layout', folder, coalesce(layout, 'unknown'), ordinal FROM st
  UNION ALL SELECT 'stressor_count', folder, CAST(k AS VARCHAR), ordinal FROM st
  UNION ALL SELECT 'tag', folder, tag || '=' || CASE WHEN v THEN 'true' WHEN NOT v THEN 'false' ELSE 'na' END, ordinal FROM {_TAGS}
  UNION ALL SELECT 'combo', folder, array_to_string(list_sort(st), '|'), ordinal FROM st WHERE k > 0
  UNION ALL SELECT 'level2', folder, {_BUCKET}, ordinal FROM ann WHERE file_type = 'pdf'
  UNION ALL SELECT 'stressor', folder, unnest(st), ordinal FROM st)
SELECT section, folder, key, count(*) AS n, min(ordinal) AS first_ordinal FROM f GROUP BY 1, 2, 3""")
def incremental_counts(spark, sf):
    """Counts of all annotations from merged states: two batches hold them all, every ninth in an older form, and a third annotates these again."""
    rows, again, first = annotations(spark, sf), F.col("doc_id") % 9 == 0, F.col("doc_id").bitwiseAND(1).eqNullSafe(0)
    older = rows.withColumn("file_type", F.when(again, "txt").otherwise(F.col("file_type"))).withColumn("profile", F.when(~again | again.isNull(), F.col("profile")))
    store = Partials(spark, scratch(spark), source="bigint")
    for name, batch in (("first", older.filter(first)), ("second", older.filter(~first)), ("again", rows.filter(again))):
        store.add(batch, name, source="doc_id")
    return store.merged()


@query(f"WITH {ANN}, {_SPARSE} SELECT bucket, n, 3 AS threshold FROM sp")
def sparse_buckets(spark, sf):
    return A.sparse_buckets(annotations(spark, sf))


@query(f"WITH {ANN} SELECT tag FROM {_TAGS} GROUP BY tag HAVING count(*) FILTER (v) = 0")
def missing_features(spark, sf):
    return A.missing_features(annotations(spark, sf))


@query(f"WITH {ANN} SELECT e AS file_type FROM (SELECT unnest({_list(list(EXPECTED_TYPES))}) AS e) WHERE e NOT IN (SELECT file_type FROM ann)")
def file_type_gaps(spark, sf):
    return A.file_type_gaps(annotations(spark, sf))


@query(f"""WITH {ANN}, {_SPARSE}
SELECT 'missing_feature' AS kind, tag AS key, CAST(NULL AS BIGINT) AS n, CAST(NULL AS BIGINT) AS threshold FROM {_TAGS} GROUP BY tag HAVING count(*) FILTER (v) = 0
UNION ALL SELECT 'file_type_gap', e, NULL, NULL FROM (SELECT unnest({_list(list(EXPECTED_TYPES))}) AS e) WHERE e NOT IN (SELECT file_type FROM ann)
UNION ALL SELECT 'sparse_bucket', bucket, n, 3 FROM sp""")
def gap_report(spark, sf):
    return A.gap_report(annotations(spark, sf))


@query(f"WITH {SAMPLED} SELECT file_type || '|' || sig AS file_type, count(*) AS n FROM gs GROUP BY 1 HAVING count(*) < 5")
def needs_replacement(spark, sf):
    rows = annotations(spark, sf)
    return A.needs_replacement(rows.withColumn("file_type", F.concat_ws("|", "file_type", signature(sampling_stressors()))))


@query(f"""WITH {STRESSED}, {_SPARSE}, p AS (SELECT file_type, count(*) AS n, min(ordinal) AS o FROM ann GROUP BY 1),
h AS (SELECT *, row_number() OVER (ORDER BY k DESC, ordinal) AS r FROM st WHERE k >= 3)
SELECT CAST(CASE WHEN min(n) > 0 THEN least(2 * min(n), 50) ELSE 10 END AS BIGINT) AS per_file_type, coalesce(string_agg(CASE WHEN n < 5 THEN file_type END, ',' ORDER BY o), '') AS needs_replacement,
  (SELECT coalesce(string_agg(bucket, ',' ORDER BY bucket), '') FROM sp) AS sparse, (SELECT coalesce(string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY r), '') FROM h WHERE r <= 20) AS priority_docs,
  (SELECT count(*) FROM h) AS priority_docs_count, 2 AS queries_per_doc, coalesce(bool_or(n < 5), false) AS allow_replacement FROM p""")
def sampling_advice(spark, sf):
    rows = A.sampling_advice(annotations(spark, sf))
    for c in ("needs_replacement", "sparse", "priority_docs"):
        rows = rows.withColumn(c, F.array_join(c, ","))
    return rows.withColumn("per_file_type", F.col("per_file_type").cast("bigint"))


def _text(c: str) -> str:
    return f"CASE WHEN {c} THEN 'True' WHEN NOT {c} THEN 'False' ELSE '' END"


@query(f"""WITH {ANN} SELECT folder, CAST(doc_id AS VARCHAR) AS doc_id, file_type, '' AS file_path, coalesce(layout, '') AS layout, {_text('has_image')} AS has_image, {_text('has_table')} AS has_table, {_text('has_formula')} AS has_formula,
{_text('has_chart')} AS has_chart, {_text('image_text_mixed')} AS image_text_mixed, {_text('reading_order_sensitive')} AS reading_order_sensitive, {_text('long_table')} AS "table_profile.long_table",
{_text('cross_page_table')} AS "table_profile.cross_page_table", {_text('table_dominant')} AS "table_profile.table_dominant", {_text('cross_page_chart')} AS "chart_profile.cross_page_chart" FROM ann""")
def flat_export(spark, sf):
    return K.flat(annotations(spark, sf))


# --- elements and features ---------------------------------------------------------------------

_RUNS = f"""{ELEMENTS}, pg AS (SELECT DISTINCT doc_id, page FROM el), il AS (SELECT doc_id, page, page - row_number() OVER (PARTITION BY doc_id ORDER BY page) AS g FROM pg),
rn AS (SELECT doc_id, min(page) AS first_page, count(*) AS n_pages FROM il GROUP BY doc_id, g)"""
_FEATURES = f"""{_RUNS}, pc AS (SELECT l_orderkey AS doc_id, CAST(max(l_linenumber) AS INT) AS page_count FROM lineitem GROUP BY 1),
tf AS (SELECT e.*, pc.page_count, lr.longest_run, CASE WHEN max_rows > 0 THEN greatest(1, max_rows // 50) ELSE 0 END AS single, CASE WHEN sum_rows > 0 THEN greatest(1, sum_rows // 50) ELSE 0 END AS est
  FROM (SELECT doc_id, count(*) AS n_tables, max(rows) AS max_rows, sum(rows) AS sum_rows, count(DISTINCT page) AS n_table_pages FROM el GROUP BY doc_id) e
  JOIN pc USING (doc_id) JOIN (SELECT doc_id, max(n_pages) AS longest_run FROM rn GROUP BY doc_id) lr USING (doc_id)),
ft AS (SELECT doc_id, n_tables, max_rows, CAST(sum_rows AS BIGINT) AS sum_rows, CAST(n_table_pages AS INT) AS n_table_pages, CAST(longest_run AS INT) AS longest_run, longest_run >= 2 OR max_rows > 50 AS cross_page_table,
  (n_table_pages > 1 AND longest_run >= 3) OR single >= 3 AS long_table, n_table_pages / page_count >= 0.6 OR est / page_count >= 0.6 OR n_table_pages = page_count OR n_tables >= page_count AS table_dominant FROM tf)"""


def _page_counts(spark, sf):
    return read(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("doc_id")).agg(F.max("l_linenumber").alias("page_count"))


@query(f"WITH {_FEATURES} SELECT * FROM ft")
def table_features(spark, sf):
    return S.table_features(table_elements(spark, sf), _page_counts(spark, sf))


@query(f"WITH {_RUNS} SELECT n_pages, count(*) AS n FROM rn GROUP BY 1")
def table_runs(spark, sf):
    return S.page_runs(table_elements(spark, sf)).groupBy("n_pages").agg(F.count("*").alias("n"))


@query(f"WITH {_RUNS} SELECT doc_id, max(n_pages) >= 2 AS cross_page_chart FROM rn GROUP BY 1")
def cross_page_tables(spark, sf):
    return S.cross_page_charts(table_elements(spark, sf))


@query("WITH p AS (SELECT DISTINCT l_orderkey AS doc_id, l_linenumber AS page FROM lineitem WHERE l_linestatus = 'O'), r AS (SELECT doc_id, page - row_number() OVER (PARTITION BY doc_id ORDER BY page) AS g FROM p), c AS (SELECT doc_id, g, count(*) AS n FROM r GROUP BY 1, 2) SELECT doc_id, max(n) >= 2 AS cross_page_chart FROM c GROUP BY 1")
def cross_page_charts(spark, sf):
    return S.cross_page_charts(boxes(spark, sf, "O"))


@query(f"WITH {ELEMENTS} SELECT doc_id, bool_or(cols > 10 OR rows > 100 OR (cols >= 7 AND rows > 20)) AS has_complex_table FROM el GROUP BY 1")
def complex_tables(spark, sf):
    return S.complex_tables(table_elements(spark, sf))


_COUNTS = "oc AS (SELECT l_orderkey AS doc_id, count(*) FILTER (l_returnflag = 'N') AS curves, count(*) FILTER (l_linestatus = 'F') * 4 AS rects, count(*) FILTER (l_quantity > 45) AS tables, max(l_linenumber) AS pages FROM lineitem GROUP BY 1)"


@query(f"WITH {_COUNTS} SELECT doc_id, curves > 5 OR (pages > 0 AND (rects - 10 * tables) / pages > 5) OR (tables = 0 AND rects > 10) AS has_chart FROM oc")
def chart_presence(spark, sf):
    li = read(spark, sf, "lineitem")
    per = li.groupBy(F.col("l_orderkey").alias("doc_id")).agg(F.count_if(F.col("l_returnflag") == "N").alias("curves"), (F.count_if(F.col("l_linestatus") == "F") * 4).alias("rects"), F.count_if(F.col("l_quantity") > 45).alias("tables"), F.max("l_linenumber").alias("pages"))
    return per.select("doc_id", S.has_chart(F.col("curves"), F.col("rects"), F.col("tables"), F.col("pages")).alias("has_chart"))


_OVER = "(least(i.x1, t.x1) - greatest(i.x0, t.x0)) > 0 AND (least(i.y1, t.y1) - greatest(i.y0, t.y0)) > 0 AND (least(i.x1, t.x1) - greatest(i.x0, t.x0)) * (least(i.y1, t.y1) - greatest(i.y0, t.y0)) / ((i.x1 - i.x0) * (i.y1 - i.y0)) > 0.5"


@query(f"WITH {PAGE_BOXES} SELECT doc_id, page, x0, y0, x1, y1 FROM pb i WHERE status = 'O' AND NOT EXISTS (SELECT 1 FROM pb t WHERE t.status = 'F' AND t.doc_id = i.doc_id AND t.page = i.page AND {_OVER})")
def image_table_overlap_anti(spark, sf):
    """Images of a page that no table of that page covers by more than a half."""
    kept = E.without_overlap(page_boxes(spark, sf, "O"), page_boxes(spark, sf, "F"))
    return kept.select("doc_id", "page", *[F.col("bbox")[i].alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))])


@query(f"WITH {BOXES} SELECT DISTINCT doc_id, page FROM bx i WHERE status = 'O' AND (x1 - x0) * (y1 - y0) / 2000.0 > 0.5 AND NOT EXISTS (SELECT 1 FROM bx t WHERE t.status = 'F' AND t.doc_id = i.doc_id AND t.page = i.page)")
def scanned_table_pages(spark, sf):
    return E.scanned_pages(boxes(spark, sf, "O"), boxes(spark, sf, "F"), 2000.0)


@query(f"""WITH {_FEATURES}, {ANN} SELECT a.doc_id, CASE WHEN a.file_type NOT IN ('pdf', 'doc', 'ppt') THEN 'single' WHEN w AND fl THEN 'mixed' WHEN w THEN 'double' ELSE 'single' END AS layout
FROM (SELECT ann.doc_id, file_type, coalesce(ft.long_table, false) OR coalesce(ft.cross_page_table, false) AS w, has_image AS fl FROM ann LEFT JOIN ft ON ft.doc_id = ann.doc_id) a""")
def layout_rules(spark, sf):
    f = S.table_features(table_elements(spark, sf), _page_counts(spark, sf)).select("doc_id", "long_table", "cross_page_table")
    rows = annotations(spark, sf).join(f, "doc_id", "left")
    wide = F.coalesce("long_table", F.lit(False)) | F.coalesce("cross_page_table", F.lit(False))
    return rows.select("doc_id", L.layout_by_rules(F.col("file_type"), wide, F.col("profile.has_image")).alias("layout"))


@query(f"""WITH {ANN}, m AS (SELECT doc_id, has_image, has_table, has_formula, coalesce(has_chart, false) AS has_chart, range(0, page_count) AS pages FROM ann),
x AS (SELECT doc_id, 'image' AS kind, CAST(unnest(pages[1:2]) AS INT) AS page FROM m WHERE has_image UNION ALL SELECT doc_id, 'table', CAST(unnest(pages[1:3]) AS INT) FROM m WHERE has_table
  UNION ALL SELECT doc_id, 'formula', 0 FROM m WHERE has_formula UNION ALL SELECT doc_id, 'chart', 0 FROM m, range(2) WHERE has_chart)
SELECT doc_id, kind, page, count(*) AS n FROM x GROUP BY ALL""")
def elements_from_metadata(spark, sf):
    p = "profile."
    meta = F.struct(
        F.col(p + "has_image").alias("has_image"), F.col(p + "has_table").alias("has_table"), F.col(p + "has_formula").alias("has_formula"), F.coalesce(p + "has_chart", F.lit(False)).alias("has_chart"),
        F.lit(2).alias("image_count"), F.lit(3).alias("table_count"), F.lit(2).alias("chart_count"),
        F.expr("sequence(0, page_count - 1)").alias("image_pages"), F.expr("sequence(0, page_count - 1)").alias("table_pages"),
        F.expr("cast(array() as array<struct<page:int,bbox:array<double>,rows:int,cols:int>>)").alias("tables_detail"),
        F.expr("cast(array() as array<struct<index:int,page:int,bbox:array<double>>>)").alias("images_detail"),
    )
    rows = annotations(spark, sf).select("doc_id", meta.alias("metadata"))
    return E.from_metadata(rows).groupBy("doc_id", "kind", "page").agg(F.count("*").alias("n"))


@query("SELECT event_type AS kind, count(*) AS n FROM events WHERE event_type IN ('click', 'view', 'purchase') AND coalesce(value / 100, 0) >= 0.5 GROUP BY 1")
def confidence_filter(spark, sf):
    rows = read(spark, sf, "events").select(F.col("event_type").alias("kind"), (F.col("value") / 100).alias("confidence"))
    return E.confident(rows, 0.5, ("click", "view", "purchase")).groupBy("kind").agg(F.count("*").alias("n"))


@query("SELECT doc_id, CAST(greatest(1, len(string_split(text, chr(10))) // 50) AS INT) AS page_count FROM documents")
def page_estimate(spark, sf):
    return read(spark, sf, "documents").select("doc_id", X.page_estimate(F.col("text")).alias("page_count"))


@query("SELECT doc_id, greatest(len(string_split(text, '|')), (len(string_split(text, chr(10))) + doc_id % 40) // 50 + 1) AS pages FROM documents")
def docx_page_estimate(spark, sf):
    d = read(spark, sf, "documents")
    pages = S.docx_pages(F.size(F.split("text", r"\|")) - 1, F.size(F.split("text", "\n")), F.col("doc_id") % 40)
    return d.select("doc_id", pages.cast("bigint").alias("pages"))


@query("SELECT conv_id, turn, CAST(sum(CASE WHEN role = 'system' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS BIGINT) AS page FROM conversations")
def running_page_number(spark, sf):
    return S.running_page(read(spark, sf, "conversations").select("conv_id", "turn", "role"), "conv_id", "turn", F.col("role") == "system").select("conv_id", "turn", "page")


@query("WITH c AS (SELECT l_orderkey, l_linestatus, l_suppkey % 7 AS t, l_partkey % 5 AS l FROM lineitem) SELECT l_orderkey, l_linestatus, count(DISTINCT t) AS rows, count(DISTINCT l) AS cols FROM c GROUP BY 1, 2")
def table_cell_counts(spark, sf):
    c = read(spark, sf, "lineitem").select("l_orderkey", "l_linestatus", (F.col("l_suppkey") % 7).alias("top"), (F.col("l_partkey") % 5).alias("left"))
    return S.distinct_cells(c, ["l_orderkey", "l_linestatus"])


# --- files ---------------------------------------------------------------------------------------

_PATH = "'/in/' || source || '/doc' || doc_id || CASE doc_id % 6 WHEN 0 THEN '.PDF' WHEN 1 THEN '.docx' WHEN 2 THEN '.txt' WHEN 3 THEN '.pptx' WHEN 4 THEN '.xlsx' ELSE '.md' END"


def _files(spark, sf):
    ext = F.element_at(F.array(*map(F.lit, (".PDF", ".docx", ".txt", ".pptx", ".xlsx", ".md"))), (F.col("doc_id") % 6 + 1).cast("int"))
    return read(spark, sf, "documents").select("doc_id", F.concat(F.lit("/in/"), "source", F.lit("/doc"), F.col("doc_id").cast("string"), ext).alias("path"))


@query(f"SELECT doc_id, p AS path FROM (SELECT doc_id, {_PATH} AS p FROM documents) WHERE doc_id % 6 NOT IN (2, 5)")
def eligible_files(spark, sf):
    return I.eligible(_files(spark, sf)).select("doc_id", "path")


@query(f"SELECT doc_id, p AS path FROM (SELECT doc_id, {_PATH} AS p FROM documents) WHERE doc_id % 6 NOT IN (2, 5) AND doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def failed_files_anti(spark, sf):
    files = _files(spark, sf)
    failed = files.join(read(spark, sf, "labels").filter("toxic = 1").select("doc_id"), "doc_id", "left_semi").select(X.file_name(F.col("path")).alias("name"))
    return I.eligible(files, failed).select("doc_id", "path")


@query(f"SELECT doc_id, p AS path FROM (SELECT doc_id, {_PATH} AS p FROM documents) WHERE doc_id % 6 NOT IN (2, 5) AND doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)")
def incremental_anti(spark, sf):
    files = _files(spark, sf)
    done = files.join(read(spark, sf, "labels").filter("quality = 1").select("doc_id"), "doc_id", "left_semi").select(X.output_path(F.col("path"), "/in", "/out").alias("path"))
    return I.eligible(files, outputs=done, source="/in", target="/out").select("doc_id", "path")


@query("WITH f AS (SELECT regexp_extract(regexp_replace(url, '[?#].*$', ''), '[^/]*$') AS name, page_id FROM pages) SELECT page_id, name, CASE WHEN lower(name) LIKE '_%.html' OR lower(name) LIKE '_%.htm' THEN 'html' ELSE 'txt' END AS file_type, regexp_replace(name, '^(.+)\\.[^.]*$', '\\1') AS stem FROM f")
def ext_type_lookup(spark, sf):
    p = read(spark, sf, "pages").withColumn("name", X.file_name(F.regexp_replace("url", r"[?#].*$", "")))
    return p.select("page_id", "name", X.file_type(F.col("name")).alias("file_type"), X.stem(F.col("name")).alias("stem"))


_WHITE = "' ' || " + " || ".join(f"chr({ord(c)})" for c in X.WHITE if c != " ")
_RUNS_OF_TEXT = "html"
for _p in (r"(?is)<script\b[^>]*>.*?</script\s*>", r"(?is)<style\b[^>]*>.*?</style\s*>", r"(?s)<!--.*?-->", "<[a-zA-Z/!?](?:[^>\"\'\']|\"[^\"]*\"|\'\'[^\'\']*\'\')*>"):
    _RUNS_OF_TEXT = f"regexp_replace({_RUNS_OF_TEXT}, '{_p}', chr(1), 'g')"
_NAMES = "MAP {" + ", ".join(f"'&{k}': {' || '.join(f'chr({ord(c)})' for c in v)}" for k, v in html5.items()) + "}"
_BARE_NAMES = _list(sorted((f"&{k}" for k in html5 if not k.endswith(";")), key=lambda k: (-len(k), k)))
_DECODED = """list_aggregate(list_transform(regexp_extract_all(run, '&#[0-9]+;|&#[xX][0-9a-fA-F]+;|&[a-zA-Z0-9]+;?|[^&]+|&'), lambda r: CASE WHEN r[:3] IN ('&#x', '&#X') THEN chr(CAST('0x' || r[4:-2] AS INT)) WHEN r[:2] = '&#' THEN chr(CAST(r[3:-2] AS INT))
  WHEN r[:1] = '&' THEN coalesce(names[r], names[list_filter(bare, lambda b: starts_with(r, b))[1]] || r[1 + length(list_filter(bare, lambda b: starts_with(r, b))[1]):], r) ELSE r END), 'string_agg', '')"""


@query(f"""WITH r AS (SELECT page_id, unnest(string_split({_RUNS_OF_TEXT}, chr(1))) AS run, generate_subscripts(string_split({_RUNS_OF_TEXT}, chr(1)), 1) AS i FROM pages),
t AS (SELECT page_id, i, trim({_DECODED}, {_WHITE}) AS run FROM r, (SELECT {_NAMES} AS names, {_BARE_NAMES} AS bare) WHERE run <> '')
SELECT p.page_id, coalesce(x.text, CASE WHEN p.html IS NOT NULL THEN '' END) AS text FROM pages p LEFT JOIN (SELECT page_id, string_agg(run, chr(10) ORDER BY i) AS text FROM t WHERE run <> '' GROUP BY page_id) x USING (page_id)""")
def html_text(spark, sf):
    return read(spark, sf, "pages").select("page_id", visible_text(F.col("html")).alias("text"))


_TITLE_LINES = "list_filter(list_transform(string_split_regex(text, '\\r\\n|[\\n\\r]'), lambda x: substr(trim(ltrim(trim(x), '#')), 1, 60)), lambda x: x <> '')"


@query(f"SELECT doc_id, coalesce({_TITLE_LINES}[1], CAST(doc_id AS VARCHAR)) AS title FROM documents")
def title_extract(spark, sf):
    return read(spark, sf, "documents").select("doc_id", X.title(F.col("text"), F.col("doc_id").cast("string")).alias("title"))


_HITS = f"list_filter({_list(TOPICS)}, lambda t: contains(text, string_split(t, '/')[1]) OR contains(text, t))"


@query(f"SELECT doc_id, array_to_string({_HITS}, ',') AS topics FROM documents")
def topic_hits(spark, sf):
    return read(spark, sf, "documents").select("doc_id", F.array_join(topics_in(spark, F.col("text"), TOPICS), ",").alias("topics"))


_LIBRARY = "(SELECT DISTINCT substr(text, 1 + CAST(n % 40 AS INT), 5 + CAST(n % 11 AS INT)) AS topic FROM (SELECT text, length(text) AS n FROM benchmark))"


def _library_topics(spark, sf):
    """A library of topics from the benchmark's items: a piece of each; those with a slash count by what stands before it."""
    n = F.length("text")
    return [r[0] for r in read(spark, sf, "benchmark").select(F.substring(F.col("text"), 1 + n % 40, 5 + n % 11).alias("topic")).distinct().orderBy("topic").collect()]


@query(f"WITH t AS {_LIBRARY} SELECT t.topic, count(d.doc_id) AS n_docs, min(d.doc_id) AS first_doc FROM t LEFT JOIN documents d ON d.text <> '' AND (contains(d.text, string_split(t.topic, '/')[1]) OR contains(d.text, t.topic)) GROUP BY t.topic")
def topic_hits_library(spark, sf):
    """How many documents each topic of a large library hits, and the first of them."""
    topics = _library_topics(spark, sf)
    names = spark.createDataFrame(list(enumerate(topics)), "number int, topic string")
    hits = read(spark, sf, "documents").select("doc_id", F.explode(numbers_in(spark, F.col("text"), topics)).alias("number"))
    counts = hits.groupBy("number").agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("first_doc"))
    return names.join(counts, "number", "left").select("topic", F.coalesce("n_docs", F.lit(0)).alias("n_docs"), "first_doc")


# --- sampling ----------------------------------------------------------------------------------

_BEHAVIOUR = "CASE {u} % 4 WHEN 0 THEN 'answer' WHEN 1 THEN 'partial' WHEN 2 THEN 'refuse' ELSE 'ask_clarification' END"
_FITS = "(len(f) = 0 OR list_contains(f, file_type)) AND (len(s) = 0 OR list_has_any(s, gs))"


def _with_behaviour(spark, sf):
    names = F.array(*map(F.lit, ("answer", "partial", "refuse", "ask_clarification")))
    rows = annotations(spark, sf).withColumn("stressors", sampling_stressors()).withColumn("expected_behavior", F.get(names, (F.col("doc_id") % 4).cast("int")))
    return rows.select("doc_id", "file_type", "stressors", "expected_behavior")


@query(f"WITH {SAMPLED}, {_TPL} SELECT doc_id, id AS template_id FROM (SELECT *, {_BEHAVIOUR.format(u='doc_id')} AS eb FROM gs) JOIN tpl ON b = eb AND {_FITS}")
def template_match(spark, sf):
    return matches(_with_behaviour(spark, sf), templates(spark)).select("doc_id", "template_id")


_TIERED = """ti AS (SELECT r.*, CASE WHEN len(t1) > 0 THEN 1 WHEN len(t2) > 0 THEN 2 WHEN len(t3) > 0 THEN 3 ELSE 4 END AS tier, CASE WHEN len(t1) > 0 THEN t1 WHEN len(t2) > 0 THEN t2 WHEN len(t3) > 0 THEN t3 ELSE t4 END AS options
  FROM (SELECT {key}, list(id ORDER BY ord) FILTER (b = eb AND {fits} AND len(s) + len(f) > 0) AS t1, list(id ORDER BY ord) FILTER (b = eb AND {fits}) AS t2, list(id ORDER BY ord) FILTER (b = eb AND len(s) + len(f) = 0) AS t3, list(id ORDER BY ord) FILTER (b = 'answer') AS t4
    FROM {source} CROSS JOIN tpl GROUP BY {key}) r)"""


@query(f"WITH {SAMPLED}, {_TPL}, be AS (SELECT *, {_BEHAVIOUR.format(u='doc_id')} AS eb FROM gs), {_TIERED.format(key='doc_id', fits=_FITS, source='be')} SELECT doc_id, tier, array_to_string(options, ',') AS options FROM ti")
def template_fallback_tier(spark, sf):
    return with_options(_with_behaviour(spark, sf), templates(spark)).select("doc_id", "tier", F.array_join("options", ",").alias("options"))


_RANKED = f"""rk AS (SELECT *, row_number() OVER (PARTITION BY file_type, sig ORDER BY hd, ordinal) AS r FROM (SELECT *, {_h('doc', 'file_type', 'CAST(doc_id AS VARCHAR)')} AS hd, {_h('sig', 'file_type', 'sig')} AS hs FROM gs))"""
_PICKED = f"{_RANKED}, pk AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY file_type ORDER BY r, hs, sig) AS pick FROM rk) WHERE pick <= 25)"


@query(f"WITH {SAMPLED}, {_PICKED} SELECT file_type, CAST(pick AS INT) AS pick, doc_id, sig FROM pk")
def stratified_round_robin(spark, sf):
    return Q.round_robin(Q.strata(annotations(spark, sf)), 25).select("file_type", "pick", "doc_id", "sig")


@query(f"""WITH {SAMPLED}, {_RANKED}, z AS (SELECT file_type, sig, hs, count(*) AS n FROM rk GROUP BY ALL), y AS (SELECT *, CAST(ceil(500 / count(*) OVER (PARTITION BY file_type)) AS INT) AS rounds FROM z),
t AS (SELECT *, unnest(generate_series(1, rounds)) AS turn FROM y), u AS (SELECT *, CASE WHEN turn <= n THEN turn ELSE {_h('again', 'file_type', 'sig', 'CAST(turn AS VARCHAR)')} % n + 1 END AS rr FROM t),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY file_type ORDER BY turn, hs, sig) AS pick FROM u) WHERE pick <= 500)
SELECT p.file_type, CAST(p.pick AS INT) AS pick, rk.doc_id, p.sig FROM p JOIN rk ON rk.file_type = p.file_type AND rk.sig = p.sig AND rk.r = p.rr""")
def round_robin_replacement(spark, sf):
    return Q.round_robin_replacement(Q.strata(annotations(spark, sf)), 500).select("file_type", "pick", "doc_id", "sig")


_KEY = ("file_type", "CAST(pick AS VARCHAR)", "CAST(k AS VARCHAR)")
_CUT, _upto = [], 0.0
for _name, _weight in BEHAVIOUR_MIX.items():
    _upto += _weight
    _CUT.append(f"WHEN u * {sum(BEHAVIOUR_MIX.values())!r}::DOUBLE <= {_upto!r}::DOUBLE THEN '{_name}'")
_QUESTIONS = f"""WITH {SAMPLED}, {_PICKED}, {_TPL}, it0 AS (SELECT *, unnest([1, 2]) AS k FROM pk), it1 AS (SELECT *, CAST({_h('behaviour', *_KEY)} AS DOUBLE) / {float(1 << 60)!r}::DOUBLE AS u FROM it0),
it AS (SELECT *, CASE {' '.join(_CUT)} ELSE '{list(BEHAVIOUR_MIX)[-1]}' END AS eb FROM it1), {_TIERED.format(key='file_type, pick, k, doc_id, sig, eb, gs', fits=_FITS, source='it')},
qs0 AS (SELECT *, options[{_h('template', *_KEY)} % len(options) + 1] AS tid, {_list(TOPICS)}[{_h('topic', *_KEY)} % {len(TOPICS)} + 1] AS topic FROM ti),
qs AS (SELECT format('q_{{:06d}}', row_number() OVER (ORDER BY file_type, pick, k)) AS id, replace(replace(replace(tpl.query, '{{topic}}', topic), '{{doc_title}}', CAST(doc_id AS VARCHAR)), '{{doc_id}}', CAST(doc_id AS VARCHAR)) AS query,
  eb AS expected_behavior, doc_id, file_type, tid AS template_id, sig, tier, gs FROM qs0 JOIN tpl ON tpl.id = tid)"""


def _questions(spark, sf):
    return Q.question_set(annotations(spark, sf), templates(spark), TOPICS)


@query(f"{_QUESTIONS} SELECT id, query, expected_behavior, doc_id, file_type, template_id, sig, tier FROM qs")
def question_set(spark, sf):
    g = "generation."
    return _questions(spark, sf).select("id", "query", "expected_behavior", F.col("doc_annotation.doc_id").alias("doc_id"), F.col("doc_annotation.file_type").alias("file_type"), F.col(g + "template_id").alias("template_id"), F.col(g + "stressor_signature").alias("sig"), "tier")


@query(f"""{_QUESTIONS}, ks AS (SELECT 'file_type' AS kind, file_type AS key, count(*) AS n FROM qs GROUP BY 2 UNION ALL SELECT 'expected_behavior', expected_behavior, count(*) FROM qs GROUP BY 2
UNION ALL (SELECT 'signature', sig, count(*) AS n FROM qs GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 20) UNION ALL (SELECT 'stressor', g, count(*) AS n FROM (SELECT unnest(gs) AS g FROM qs) GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 30)) SELECT * FROM ks""")
def question_set_stats(spark, sf):
    return Q.question_stats(_questions(spark, sf))


@query(f"WITH {SAMPLED} SELECT file_type, sig, count(*) AS n FROM gs GROUP BY ALL")
def signature_counts(spark, sf):
    rows = annotations(spark, sf).withColumn("sig", signature(sampling_stressors()))
    return rows.groupBy("file_type", "sig").agg(F.count("*").alias("n"))


_MUST = " ".join(f"WHEN '{b}' THEN '{'/'.join(y)}'" for b, (y, _) in ANSWER_CONSTRAINTS.items())
_MUST_NOT = " ".join(f"WHEN '{b}' THEN '{'/'.join(n)}'" for b, (_, n) in ANSWER_CONSTRAINTS.items())


@query(f"SELECT conv_id, turn, CASE b {_MUST} ELSE '' END AS must, CASE b {_MUST_NOT} ELSE '' END AS must_not FROM (SELECT conv_id, turn, CASE role WHEN 'assistant' THEN 'answer' WHEN 'user' THEN 'refuse' ELSE 'partial' END AS b FROM conversations)")
def constraints_lookup(spark, sf):
    b = F.when(F.col("role") == "assistant", "answer").when(F.col("role") == "user", "refuse").otherwise("partial")
    c = X.constraints(b)
    return read(spark, sf, "conversations").select("conv_id", "turn", F.array_join(c["must_mention"], "/").alias("must"), F.array_join(c["must_not_mention"], "/").alias("must_not"))


@query(f"""WITH {ANN}, x AS (SELECT doc_id, unnest(['file_type', 'layout', 'has_image']) AS field, unnest([file_type, layout, CAST(has_image AS VARCHAR)]) AS v FROM ann WHERE has_image),
y AS (SELECT doc_id, unnest(['file_type', 'layout', 'has_image']) AS field, unnest([file_type, CASE WHEN doc_id % 3 = 0 THEN 'double' ELSE layout END, CAST(has_image OR doc_id % 5 = 0 AS VARCHAR)]) AS v FROM ann WHERE NOT has_image OR has_table)
SELECT coalesce(x.doc_id, y.doc_id) AS doc_id, coalesce(x.field, y.field) AS field, x.v AS a, y.v AS b, coalesce(x.v <> y.v, false) AS differs FROM x FULL OUTER JOIN y ON x.doc_id = y.doc_id AND x.field = y.field""")
def parser_comparison(spark, sf):
    ann = annotations(spark, sf).select("doc_id", "file_type", F.col("profile.layout").alias("layout"), F.col("profile.has_image").alias("has_image"), F.col("profile.has_image").alias("_i"), F.col("profile.has_table").alias("_t"))
    other = ann.withColumn("layout", F.when(F.col("doc_id") % 3 == 0, "double").otherwise(F.col("layout"))).withColumn("has_image", F.col("has_image") | (F.col("doc_id") % 5 == 0))
    return I.compare(ann.filter("_i"), other.filter("not _i or _t"), "doc_id", ["file_type", "layout", "has_image"])


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, try_cast(json_extract_string(props, '$.page') AS BIGINT) AS page FROM events")
def json_props_extract(spark, sf):
    return read(spark, sf, "events").select("event_id", X.json_field(F.col("props"), "$.k").alias("k"), X.json_field(F.col("props"), "$.page", "bigint").alias("page"))


@query(f"{_QUESTIONS} SELECT substr(sha256(string_agg(id || '|' || query || '|' || expected_behavior || chr(10), '' ORDER BY id)), 1, 16) AS hash16 FROM qs")
def manifest_hash(spark, sf):
    lines = _questions(spark, sf).select("id", F.concat_ws("|", "id", "query", "expected_behavior").alias("line"))
    return K.content_hash(lines)


@query(f"WITH {STRESSED} SELECT count(*) AS total, count(*) FILTER (k >= 1) AS success, count(*) FILTER (k < 1) AS failed FROM st")
def run_counters(spark, sf):
    return I.run_counters(A.with_stressors(annotations(spark, sf)).withColumn("success", F.col("stressor_count") >= 1))


# --- annotation of documents -------------------------------------------------------------------

_TABLES = """CASE WHEN n % 4 = 0 THEN 2 WHEN has_table THEN least(page_count, 3) ELSE 0 END AS nt, CASE WHEN n % 4 = 0 THEN n_lines ELSE 0 END AS max_rows, CASE WHEN n % 4 = 0 THEN n_lines + 2 ELSE 0 END AS sum_rows,
  CASE WHEN n % 4 = 0 THEN least(page_count, 2) ELSE least(page_count, 3) END AS np, CASE WHEN n % 4 = 0 THEN CASE WHEN page_count = 2 THEN 2 ELSE 1 END ELSE least(page_count, 3) END AS run"""
_DONE = f"""{ANN}, a1 AS (SELECT *, {_TABLES} FROM ann), a2 AS (SELECT *, nt > 0 AS tables, nt > 0 AND (run >= 2 OR max_rows > 50) AS cross_page, CASE WHEN max_rows > 0 THEN greatest(1, max_rows // 50) ELSE 0 END AS single,
  CASE WHEN sum_rows > 0 THEN greatest(1, sum_rows // 50) ELSE 0 END AS est FROM a1),
a3 AS (SELECT *, nt > 0 AND ((np > 1 AND run >= 3) OR single >= 3) AS long_one, nt > 0 AND (np / page_count >= 0.6 OR est / page_count >= 0.6 OR np = page_count OR nt >= page_count) AS main_one, file_type IN ('pdf', 'doc', 'ppt') AS paged FROM a2),
done AS (SELECT doc_id AS number, '/corpus/' || folder || '/' || doc_id || '/d' || (n % 50) AS file_path, 'd' || (n % 50) AS doc_id, file_type, folder, text, has_image, tables, n % 17 = 0 AS has_image_table, n % 19 = 0 AS has_complex_table, has_formula, coalesce(has_chart, false) AS has_chart, image_text_mixed,
  CASE WHEN NOT paged THEN 'single' WHEN (cross_page OR long_one) AND (has_image OR length(trim(text, {_WHITE})) > 0) THEN 'mixed' WHEN cross_page OR long_one THEN 'double' ELSE 'single' END AS layout,
  CASE WHEN paged AND tables THEN long_one END AS long_table, CASE WHEN paged AND tables THEN cross_page END AS cross_page_table, CASE WHEN paged AND tables THEN main_one END AS table_dominant,
  CASE WHEN paged AND has_chart THEN false END AS cross_page_chart, nt, n, page_count FROM a3)"""
_DONE_COLUMNS = "file_path, doc_id, file_type, layout, has_image, tables AS has_table, has_image_table, has_complex_table, has_formula, has_chart, image_text_mixed, long_table, cross_page_table, table_dominant, cross_page_chart"


def _flat_profile(rows: DataFrame, profile: str = "doc_profile") -> DataFrame:
    p = f"{profile}."
    names = ("layout", "has_image", "has_table", "has_image_table", "has_complex_table", "has_formula", "has_chart", "image_text_mixed", "table_profile.long_table", "table_profile.cross_page_table", "table_profile.table_dominant", "chart_profile.cross_page_chart")
    return rows.select("file_path", "doc_id", "file_type", *[F.col(p + n).alias(n.split(".")[-1]) for n in names])


@query(f"WITH {_DONE} SELECT {_DONE_COLUMNS} FROM done")
def annotate_documents(spark, sf):
    """Many files share a stem: fifty doc_ids for all documents."""
    return _flat_profile(L.annotate(contents(spark, sf)))


@query(f"WITH {_DONE} SELECT {_DONE_COLUMNS} FROM done")
def annotation_files(spark, sf):
    """One JSON file per document, written and scanned again."""
    at = for_tasks(spark, f"{scratch(spark)}/annotations")
    rows = L.annotate(contents(spark, sf))
    K.write_one_per_document(K.canonical(rows).withColumn("out_path", F.concat(F.lit(at), "file_path", F.lit(".json"))))
    return _flat_profile(scan(spark, at, "strict"), "profile")


@query(f"WITH {_DONE} SELECT {_DONE_COLUMNS} FROM done")
def annotate_stream(spark, sf):
    """Documents annotated as a stream, file by file, into committed batches."""
    at = qualified(spark, scratch(spark))
    rows = annotate_rows(spark, f"{sf}/documents.parquet", lambda df: L.annotate(contents(spark, sf, df)), L.annotate(contents(spark, sf)).schema, f"{at}/batches", f"{at}/checkpoint")
    return _flat_profile(rows)


@query(f"WITH {_DONE} SELECT file_path, CASE WHEN file_type = 'pdf' THEN 'single' ELSE layout END AS layout, CAST(NULL AS BOOLEAN) AS reading_order_sensitive, table_dominant FROM done")
def annotate_with_model(spark, sf):
    """A model without opinion: its first option is the layout of PDF files, and rules stand elsewhere."""
    rows = L.annotate(contents(spark, sf), llm=P.mock_model)
    return rows.select("file_path", "doc_profile.layout", "doc_profile.reading_order_sensitive", F.col("doc_profile.table_profile.table_dominant").alias("table_dominant"))


@query(f"WITH {_DONE} SELECT count(*) FILTER (has_image) AS has_image, count(*) FILTER (tables) AS has_table, count(*) FILTER (has_image_table) AS has_image_table, count(*) FILTER (has_complex_table) AS has_complex_table, count(*) FILTER (has_formula) AS has_formula, count(*) FILTER (has_chart) AS has_chart FROM done")
def flag_totals(spark, sf):
    return A.flag_totals(L.annotate(contents(spark, sf)).withColumnRenamed("doc_profile", "profile"))


@query(f"WITH {_DONE} SELECT file_path AS file, 'broken; twice' AS error FROM done WHERE n % 23 = 0")
def failed_report(spark, sf):
    return I.route(failing(contents(spark, sf)))[1]


@query(f"WITH {_DONE} SELECT file_path, CASE WHEN n % 23 = 0 THEN 0 WHEN n % 3 = 0 AND n % 2 = 0 THEN 1 END AS failed_at_step, CASE WHEN n % 23 = 0 THEN 'parse' WHEN n % 3 = 0 AND n % 2 = 0 THEN 'check' END AS failed_stage FROM done")
def failed_stages(spark, sf):
    """The first of two stages that could not work on a row."""
    check = lambda df: df.withColumn("success", ~(F.coalesce("metadata.has_image", F.lit(False)) & (F.length("text") % 2 == 0)))
    return Pipeline([("parse", failing), ("check", check)]).track(contents(spark, sf)).select("file_path", "failed_at_step", "failed_stage")


@query(f"WITH {_DONE} SELECT folder AS backend, count(*) FILTER (n % 23 <> 0) AS n_success, count(*) AS n FROM done GROUP BY 1")
def success_totals(spark, sf):
    return I.success_totals(failing(contents(spark, sf)), F.element_at(F.split("file_path", "/"), 3))


@query(f"WITH {ANN} SELECT tag, {_TAG_COUNTS} FROM (SELECT * FROM {_TAGS} WHERE folder = 'src3') GROUP BY tag")
def folder_restricted_tags(spark, sf):
    return A.tag_distribution(I.in_folder(annotations(spark, sf), "src3"))


_DETECTED = "dt AS (SELECT l_orderkey AS file_path, CASE WHEN l_linenumber % 2 = 0 THEN 'image' ELSE 'table' END AS kind, l_discount * 10 AS confidence FROM lineitem)"


@query(f"""WITH {_DETECTED}, f AS (SELECT file_path, count(*) FILTER (kind = 'image') AS ni, count(*) FILTER (kind = 'table') AS nt FROM dt WHERE confidence >= 0.5 GROUP BY 1)
SELECT o_orderkey AS file_path, CAST(CASE WHEN o_orderstatus = 'O' THEN 2 WHEN o_orderstatus = 'F' THEN coalesce(ni, 0) ELSE 0 END AS INT) AS n_image, CAST(CASE WHEN o_orderstatus = 'O' THEN 0 WHEN o_orderstatus = 'F' THEN coalesce(nt, 0) ELSE 0 END AS INT) AS n_table
FROM orders LEFT JOIN f ON f.file_path = o_orderkey""")
def routed_elements(spark, sf):
    """Elements from metadata where a parser gave any, else from detectors (PDF), else none."""
    li, o = read(spark, sf, "lineitem"), read(spark, sf, "orders")
    kind = F.when(F.col("l_linenumber") % 2 == 0, "image").otherwise("table")
    found = li.select(F.col("l_orderkey").alias("file_path"), kind.alias("kind"), F.col("l_linenumber").alias("ord"), F.lit(None).cast("array<double>").alias("bbox"), F.col("l_linenumber").alias("page"), (F.col("l_discount") * 10).alias("confidence"), F.lit(None).cast("int").alias("rows"), F.lit(None).cast("int").alias("cols"))
    meta = metadata(has_image=F.lit(True), has_table=F.lit(False), image_count=F.lit(2), image_pages=F.expr("array(0, 1, 2)"))
    rows = o.select(F.col("o_orderkey").alias("file_path"), F.when(F.col("o_orderstatus") == "P", "doc").otherwise("pdf").alias("file_type"), F.when(F.col("o_orderstatus") == "O", meta).alias("metadata"))
    rows = E.with_elements(rows, found)
    return rows.select("file_path", *[F.size(E.of_kind(k)).alias(f"n_{k}") for k in ("image", "table")])


@query("""SELECT doc_id, CASE WHEN contains(lower(text), 'über') THEN 'über' WHEN contains(lower(text), 'the ') THEN 'the ' ELSE 'über' END AS label,
  CASE WHEN contains(lower(text), 'über') OR contains(lower(text), 'the ') THEN CAST(0.7 AS DOUBLE) ELSE 0.5 END AS confidence, substr(text, 1, 100) AS reasoning FROM documents""")
def label_fallback(spark, sf):
    """Labels from answers that are no JSON."""
    rows = read(spark, sf, "documents").select("doc_id", P.label_from(F.col("text"), ["über", "the "]).alias("x"))
    return rows.select("doc_id", "x.label", "x.confidence", "x.reasoning")


@query("SELECT event_id, event_type AS label, CAST(0.8 AS DOUBLE) AS confidence FROM events")
def label_from_json(spark, sf):
    """Labels from JSON answers without a confidence."""
    said = F.to_json(F.struct(F.col("event_type").alias("label")))
    return read(spark, sf, "events").select("event_id", P.label_from(said, ["a", "b"]).alias("x")).select("event_id", "x.label", "x.confidence")


_PROV = "CASE WHEN l_linenumber % 2 = 0 THEN l_linenumber + 1 ELSE l_linenumber END"


@query(f"""SELECT l_orderkey AS doc_id, 'table' AS kind, {_PROV} AS page, CAST(CASE WHEN l_partkey % 3 = 0 THEN 5 ELSE l_quantity END AS INT) AS rows, CAST(CASE WHEN l_partkey % 3 = 0 THEN 2 ELSE l_linenumber END AS INT) AS cols FROM lineitem WHERE l_returnflag = 'A'
UNION ALL SELECT l_orderkey, 'image', {_PROV}, NULL, NULL FROM lineitem WHERE l_returnflag = 'N'
UNION ALL SELECT l_orderkey, 'formula', {_PROV}, NULL, NULL FROM lineitem WHERE l_returnflag = 'R'
UNION ALL SELECT l_orderkey, 'chart', {_PROV}, NULL, NULL FROM lineitem WHERE l_suppkey % 5 = 0""")
def model_elements(spark, sf):
    """Tables, pictures, equations and captioned figures of a layout model's documents."""
    docs = model_documents(spark, sf)
    none = F.lit(None).cast("int")
    parts = [B.model_tables(docs).select("doc_id", F.lit("table").alias("kind"), "page", "rows", "cols")]
    for kind, fn in (("image", B.model_images), ("formula", B.model_formulas), ("chart", B.model_charts)):
        parts.append(fn(docs).select("doc_id", F.lit(kind).alias("kind"), "page", none.alias("rows"), none.alias("cols")))
    return reduce(DataFrame.unionByName, parts)


@query("SELECT l_orderkey AS doc_id, CAST(CASE WHEN min(l_linenumber + l_suppkey) % 2 = 0 THEN count(*) WHEN min(l_linenumber + l_suppkey) % 3 = 0 THEN 7 ELSE 1 END AS INT) AS page_count FROM lineitem GROUP BY 1")
def model_page_counts(spark, sf):
    return B.model_page_count(model_documents(spark, sf))


_NAMED = "CASE WHEN n_chars % 7 = 0 THEN 'r.' || (doc_id // 2) ELSE 'r.' || doc_id || '.v' || (n_chars % 3) END"


@query(f"""WITH f AS (SELECT '/d/' || doc_id || '.pdf' AS path FROM documents WHERE n_chars % 4 = 0 UNION ALL SELECT '/e-1/' || doc_id || unnest(['.docx', '.txt']) FROM documents WHERE n_chars % 3 = 0
  UNION ALL SELECT CASE WHEN doc_id % 2 = 0 THEN '/e/x/' ELSE '/e/' END || 'r.' || doc_id || '.v' || (n_chars % 3) || '.tar.gz' FROM documents),
n AS (SELECT path, list_last(string_split(path, '/')) AS name, string_split(path, '/') AS parts FROM f),
a AS (SELECT doc_id AS number, CASE WHEN n_chars % 5 = 0 THEN {_NAMED} ELSE CAST(doc_id AS VARCHAR) END AS doc_id, CASE WHEN n_chars % 2 = 0 THEN '/d/' || doc_id || '.pdf' END AS file_path FROM documents),
g AS (SELECT a.doc_id, arg_min(n.path, n.parts) AS path FROM (SELECT DISTINCT doc_id FROM a) a JOIN n ON starts_with(n.name, a.doc_id || '.') GROUP BY a.doc_id)
SELECT number AS doc_id, coalesce(f.path, g.path) AS found FROM a LEFT JOIN (SELECT DISTINCT path FROM f) f ON f.path = a.file_path LEFT JOIN g ON g.doc_id = a.doc_id""")
def resolved_files(spark, sf):
    """The file of each annotation: its own path, else the first `doc_id.*`; names and ids with several dots among them."""
    d = read(spark, sf, "documents")
    own, n = F.col("doc_id").cast("string"), F.col("n_chars")
    pdf, version = F.concat(F.lit("/d/"), own, F.lit(".pdf")), F.concat(F.lit("r."), own, F.lit(".v"), (n % 3).cast("string"))
    files = d.filter(n % 4 == 0).select(pdf.alias("path")).unionByName(d.filter(n % 3 == 0).select(F.explode(F.array(*[F.concat(F.lit("/e-1/"), own, F.lit(x)) for x in (".docx", ".txt")])).alias("path")))
    files = files.unionByName(d.select(F.concat(F.when(F.col("doc_id") % 2 == 0, "/e/x/").otherwise("/e/"), version, F.lit(".tar.gz")).alias("path")))
    named = F.when(n % 7 == 0, F.concat(F.lit("r."), F.expr("cast(doc_id div 2 as string)"))).otherwise(version)
    ann = d.select(F.when(n % 5 == 0, named).otherwise(own).alias("doc_id"), F.when(n % 2 == 0, pdf).alias("file_path"), F.col("doc_id").alias("number"))
    return resolve(ann, files).select(F.col("number").alias("doc_id"), "found")


@query("SELECT l_orderkey, l_linenumber, CAST(least(l_partkey % 50, l_suppkey % 50) AS DOUBLE) AS x0, CAST(least(l_partkey % 7, l_suppkey % 9) AS DOUBLE) AS y0, CAST(greatest(l_partkey % 50, l_suppkey % 50) AS DOUBLE) AS x1, CAST(greatest(l_partkey % 7, l_suppkey % 9) AS DOUBLE) AS y1, l_partkey % 50 + l_quantity AS right_edge FROM lineitem")
def box_forms(spark, sf):
    """Boxes from polygons, and from corner and size."""
    points = F.expr("array(array(cast(l_partkey % 50 as double), cast(l_suppkey % 9 as double)), array(cast(l_suppkey % 50 as double), cast(l_partkey % 7 as double)))")
    sized = X.sized_box(F.col("l_partkey") % 50, F.lit(0), F.col("l_quantity"), F.lit(1))
    rows = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", X.polygon_box(points).alias("b"), sized.alias("s"))
    return rows.select("l_orderkey", "l_linenumber", *[F.col("b")[i].alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))], F.col("s")[2].alias("right_edge"))
