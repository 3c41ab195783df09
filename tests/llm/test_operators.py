"""Corpus operators against brute force on small fixtures: nulls, empty and long texts, ties, repeated rows, empty tables, extra columns."""

import hashlib
import html
import random
import re
import tracemalloc
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from quirelens.llm import chat, decontaminate, html_text, labelled, ngram_join, packing, quality_model, quality_rules, suffix_dedup, toxicity, warc
from quirelens.llm.common import materialize
from quirelens.llm.queries import tokenizer_path

DOC = "doc_id long, text string, lang string, source string, n_chars long, key0 string, node string"
WORDS = "the of and thion ering étion straße x1 9 to-day it's café naïve A B | ### !! ing".split()


def rows_of(texts, first=0):
    return [(first + i, t, random.choice(["en", "de", None]), "s", None if t is None else len(t), "clash", "clash") for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def texts():
    random.seed(5)
    say = lambda n: " ".join(random.choice(WORDS) + random.choice(["", "", ".", "\n"]) for _ in range(n))
    base = [say(n) for n in (0, 1, 3, 4, 60, 60, 120, 300, 2000)]
    near = [" ".join(w if random.random() > 0.02 else "zz" for w in base[7].split(" ")) for _ in range(12)]
    shared = say(70)
    with_passage = [say(40) + " " + shared + " " + say(40) for _ in range(4)]
    return [None, "", " \n", *base, base[6], base[7], *near, *with_passage, "ab" * 400, "🙂é" * 300, *[shared] * 3]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([*rows_of(texts), rows_of(texts)[8], (None, "null id", "en", None, 7, "", "")], DOC).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOC)


EXTRA = ("_0", "_1", "_n", "_spans", "_hot", "_cold", "_q0", "_Q1", "_copy", "_d", "_t", "th", "salt", "i", "h", "key1", "component_id", "keep", "n", "words", "bucket", "data", "packed", "p_toxic", "score")


def clashing(docs):
    """docs with columns named as operators might name theirs."""
    return docs.select("*", *[F.concat(F.lit(f"{c}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(c) for c in EXTRA])


def same_extras(out, docs):
    """Rows of `out` are rows of docs, by the extra columns."""
    a, b = (Counter(tuple(r[c] for c in ("doc_id", *EXTRA)) for r in x.collect()) for x in (out, docs))
    return a == b or all(n <= b[k] for k, n in a.items()) and sum(a.values()) == out.count()


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


@pytest.mark.parametrize(("table_rows", "hash_rows"), [(200_000, 4_000_000), (3, 4_000_000), (3, 20)])
def test_decontamination(spark, docs, none, texts, table_rows, hash_rows):
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    items = [(1, texts[-1]), (10, "The  OF"), (2, None), (3, ""), (4, texts[10][:200]), (5, texts[-1]), (6, "never said here at all")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = defaultdict(set)
    for i, t in items:
        w = find(t)
        for a in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[a : a + 10])].add(str(i))
    want = Counter()
    for r in docs.collect():
        w = find(r["text"])
        hit, own = set(), set()
        for n in {len(x) for x in windows}:
            for a in range(len(w) - n + 1):
                found = windows.get(tuple(w[a : a + n]))
                if found:
                    hit.update(range(a, a + n))
                    own |= found
        want[(r["doc_id"], len(w), len(hit), len(own), hashlib.sha256(",".join(sorted(own)).encode()).hexdigest(), bool(hit))] += 1
    got = decontaminate.contamination(docs, bench, table_rows=table_rows, hash_rows=hash_rows).drop("th")
    assert Counter(tuple(r) for r in got.collect()) == want
    if table_rows == 3 and hash_rows > 20:
        by_bytes = decontaminate.contamination(docs, bench, table_bytes=1).drop("th")
        assert Counter(tuple(r) for r in by_bytes.collect()) == want
    clash = clashing(docs)
    kept = decontaminate.drop_contaminated(clash, bench, table_rows=table_rows, hash_rows=hash_rows)
    assert kept.columns == clash.columns and same_extras(kept, clash) and kept.count() == sum(n for k, n in want.items() if not k[-1])
    assert decontaminate.contamination(none, bench).count() == 0
    assert not decontaminate.contamination(docs, bench.limit(0)).filter("contaminated").count()
    assert decontaminate.drop_contaminated(docs, bench.limit(0)).count() == docs.count()


def test_decontamination_holds_one_table_at_a_time(spark, docs, monkeypatch):
    """A large benchmark's hashes are sent block by block: every written pass has one broadcast, the last join none of windows."""
    bench = spark.createDataFrame([(i, " ".join(f"b{i}w{k}" for k in range(30))) for i in range(20)], "item_id long, text string")
    plans, true = [], decontaminate.materialize

    def kept(df, name, *more):
        if name == "near":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return true(df, name, *more)

    monkeypatch.setattr(decontaminate, "materialize", kept)
    decontaminate.contamination(docs, bench, table_rows=10, hash_rows=100).count()
    assert len(plans) == 5 and all(p.count("BroadcastExchange") == 1 for p in plans)


@pytest.mark.parametrize(("most", "length"), [(10_000, 200), (4, 200), (1, 200), (10_000, 123), (2, 123)])
def test_suffix_dedup(docs, none, monkeypatch, most, length):
    monkeypatch.setattr(suffix_dedup, "TASK_CONTEXTS", most)
    all_rows = docs.collect()
    seen = Counter()
    for r in all_rows:
        b = (r["text"] or "").encode()
        seen.update(b[i : i + length] for i in range(len(b) - length + 1))
    want = Counter()
    for r in all_rows:
        b = (r["text"] or "").encode()
        m = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                m[i : i + length] = True
        spans = int((np.diff(np.concatenate([[0], m.astype(int)])) == 1).sum())
        want[(r["doc_id"], len(b), int(m.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~m].tobytes()).hexdigest())] += 1
    assert Counter(tuple(r) for r in suffix_dedup.span_digest(docs, length).collect()) == want
    if most != 10_000 or length != 200:
        return
    clash = clashing(docs)
    cut = suffix_dedup.remove_repeats(clash)
    assert cut.columns == clash.columns and same_extras(cut, clash)
    assert suffix_dedup.span_digest(none).count() == 0 and suffix_dedup.remove_repeats(none).count() == 0


def test_suffix_dedup_without_refinement_finds_less(docs, monkeypatch):
    """Whole contexts alone are not the result: sorting by bucket pointers adds to it."""
    full = suffix_dedup.span_digest(docs).agg(F.sum("n_removed")).first()[0]
    monkeypatch.setattr(suffix_dedup, "refine", lambda gram, depth: np.arange(len(gram)))
    assert suffix_dedup.span_digest(docs).agg(F.sum("n_removed")).first()[0] < full


def test_refinement_orders_suffixes():
    random.seed(1)
    for _ in range(30):
        data = np.frombuffer(bytes(random.choice(b"ab") for _ in range(random.randint(1, 300))), np.uint8)
        order = suffix_dedup.refine(suffix_dedup.grams8(data), 64)
        keys = [data[i : i + 64].tobytes().ljust(64, b"\0") for i in order]
        assert sorted(order) == list(range(len(data))) and keys == sorted(keys)


def components_of(rows, width, num, den):
    sets = []
    for r in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(r["text"]))
        k = min(width, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(i)
    return sets, groups


@pytest.mark.parametrize(("width", "num"), [(4, 85), (5, 80)])
def test_ngram_join(docs, none, width, num):
    rows = docs.collect()
    sets, groups = components_of(rows, width, num, 100)
    want = Counter()
    for own in groups.values():
        ids = [rows[i]["doc_id"] for i in own if rows[i]["doc_id"] is not None]
        for i in own:
            want[(rows[i]["doc_id"], len(sets[i]), min(ids, default=None))] += 1
    assert Counter(tuple(r) for r in ngram_join.component_table(docs, width, num, 100, sketch_bits=12).collect()) == want
    clash = clashing(docs)
    kept = ngram_join.keep_first(clash, width=width, num=num, den=100, sketch_bits=12)
    assert kept.columns == clash.columns and same_extras(kept, clash)
    assert kept.count() == len(groups)
    assert ngram_join.component_table(none, sketch_bits=12).count() == 0 and ngram_join.keep_first(none, sketch_bits=12).count() == 0


@pytest.fixture(scope="module")
def families(spark):
    """Several groups of near copies that also share a long phrase, so that large lists hold several components."""
    random.seed(3)
    rows = []
    for f in range(4):
        base = [f"c{i}" for i in range(12)] + [f"w{f}x{i}" for i in range(50)]
        for k in range(30 if f else 60):
            w = list(base)
            for _ in range(random.choice([0, 1, 1, 2, 3])):
                w[random.randrange(len(w))] = f"u{random.randrange(10**6)}"
            rows.append((1000 * f + k, " ".join(w)))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(5)


@pytest.mark.parametrize("block", [512, 8, 2])
def test_ngram_join_splits_hot_lists(families, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = families.collect()
    sets, groups = components_of(rows, 4, 85, 100)
    want = {rows[i]["doc_id"]: min(rows[k]["doc_id"] for k in g) for g in groups.values() for i in g}
    assert {r["doc_id"]: r["component_id"] for r in ngram_join.component_table(families, sketch_bits=12).collect()} == want


def test_ngram_join_lists_do_not_grow_with_noise(families, monkeypatch):
    """Entries are split by exact counts: a sketch of 16 cells, all of them overfull, makes no more lists than a wide one."""
    monkeypatch.setattr(ngram_join, "BLOCK", 64)
    made = []
    true = ngram_join.posting_lists
    monkeypatch.setattr(ngram_join, "posting_lists", lambda p, b: made.append((p.count(), true(p, b))) or made[-1][1])
    for bits in (22, 6):
        ngram_join.component_table(families, sketch_bits=bits)
    assert made[1][0] <= 1.5 * made[0][0]
    texts = {r["doc_id"]: r["text"].split() for r in families.collect()}
    df = Counter(g for w in texts.values() for g in {tuple(w[i : i + 4]) for i in range(len(w) - 3)})
    assert max(df.values()) > 64


def test_ngram_join_tells_nodes_with_one_first_name_apart(families, monkeypatch):
    true = ngram_join.set_names
    monkeypatch.setattr(ngram_join, "set_names", lambda s: (true(s)[0] % 5, true(s)[1]))
    rows = families.collect()
    sets, groups = components_of(rows, 4, 85, 100)
    want = {rows[i]["doc_id"]: min(rows[k]["doc_id"] for k in g) for g in groups.values() for i in g}
    assert {r["doc_id"]: r["component_id"] for r in ngram_join.component_table(families, sketch_bits=12).collect()} == want


def test_parities_bound_differences():
    rng = np.random.default_rng(4)
    for _ in range(50):
        a, b = (np.unique(rng.integers(0, 400, rng.integers(1, 300)).astype(np.uint64)) for _ in range(2))
        apart = np.bitwise_count((ngram_join.parity(a) ^ ngram_join.parity(b)).view(np.uint64)).sum()
        assert apart <= len(np.setxor1d(a, b))


def base_counts(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    c = Counter(zip(w, w[1:], w[2:], strict=False))
    again = {k for i in range(len(w) - 2) if c[tuple(w[i : i + 3])] > 1 for k in range(i, i + 3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return w, (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(again), len(w) < 50 or 100 * len(again) > 50 * len(w))


def histograms(t, w, lang):
    upper, digit = sum(unicodedata.category(c) == "Lu" for c in t), sum(c in "0123456789" for c in t)
    marks, symbols, space = sum(c in ".,;:!?'\"()-" for c in t), sum(c in "#*$%&|<>" for c in t), len(t) - sum(map(len, w))
    words = Counter(x.rstrip(".,;:!?").lower() for x in w)
    common = [words[x] for x in quality_rules._words(lang)]
    return [upper, digit, marks, symbols, space, len(t) - upper - digit - marks - symbols - space], [*common, len(w) - sum(common)]


def distance(p, q):
    if not sum(p) or not sum(q):
        return None
    p, q = np.array(p) / sum(p), np.array(q) / sum(q)
    m = (p + q) / 2
    part = lambda x: sum(a * np.log2(a / b) for a, b in zip(x, m, strict=True) if a > 0)
    return float(np.sqrt(max(0.0, (part(p) + part(q)) / 2)))


@pytest.fixture(scope="module")
def odd_docs(spark):
    """Plain texts of three languages (one of them rare) and texts of other characters and words."""
    random.seed(8)
    words = {"en": "the of and to in is that it was house garden water".split(), "de": "der die und in den von zu haus wasser garten".split(), "fr": ["de", "la", "le"]}
    say = lambda lang, n: " ".join(random.choice(words[lang]) + random.choice(["", "", str(random.randrange(500)), ","]) for _ in range(n))
    rows = [(i, say("en", 150), "en") for i in range(60)] + [(100 + i, say("de", 150), "de") for i in range(60)] + [(200, say("fr", 90), "fr"), (201, say("en", 200).upper(), "en"), (202, say("en", 200), "de")]
    rows += [(203, " ".join(f"{random.randrange(10**6)}" for _ in range(300)), "en"), (204, say("en", 80), None), (205, say("en", 55), "en"), (206, None, "en"), (207, "", None), (208, say("en", 9000), "en"), (208, "twice " + say("en", 70), "en")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)


@pytest.mark.parametrize("least", [2_000, 500_000])
def test_quality_rules(odd_docs, docs, none, least):
    """Base counts, both distances, references and verdicts by brute force."""
    own = [(r["doc_id"], r["text"] or "", r["lang"] if r["lang"] in quality_rules.COMMON_WORDS else quality_rules.POOLED) for r in odd_docs.collect()]
    seen = [(i, *base_counts(t), *histograms(t, base_counts(t)[0], lang), lang) for i, t, lang in own]
    refs = {}
    for _, _, base, chars, common, lang in seen:
        if not base[-1]:
            r = refs.setdefault(lang, [0, np.zeros(len(chars)), np.zeros(len(common))])
            r[0] += base[0]
            r[1] += chars
            r[2] += common
    every = sum(r[1] for r in refs.values())
    want = {}
    for i, _, base, chars, common, lang in seen:
        ref = refs.get(lang)
        large = ref and ref[0] >= least
        js = (distance(chars, ref[1] if large else every) if ref else None, distance(common, ref[2]) if large else None)
        room = [a + b / max(1, base[0]) ** 0.5 for a, b in ((0.15, 0.5), (0.1, 2.0))]
        kept = not base[-1] and (base[0] < 60 or all((d or 0) <= x for d, x in zip(js, room, strict=True)))
        want[i, base[0]] = (*base, kept, *[None if d is None else round(d, 9) for d in js])
    got = quality_rules.judge(odd_docs, min_reference=least).collect()
    assert len(got) == len(want)
    for r in got:
        assert (*tuple(r)[1:8], *[None if d is None else round(d, 9) for d in tuple(r)[8:]]) == want[r["doc_id"], r["n_words"]]
    if least == 2_000:
        kept = {r["doc_id"]: r["kept"] for r in got}
        assert not any(kept[i] for i in (201, 202, 203, 206, 207)) and all(kept[i] for i in [*range(60), *range(100, 160), 204, 205])
        assert not {"fr"} & {k for k, r in refs.items() if r[0] >= least}
    for r in quality_rules.judge(clashing(docs)).join(docs.select("doc_id", "text"), "doc_id").dropDuplicates(["doc_id"]).collect():
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) == base_counts(r["text"] or "")[1]
    assert quality_rules.judge(docs).count() == docs.count() and quality_rules.judge(none).count() == 0


def test_warc_round_trip(spark, tmp_path):
    rows = [(1, "u", "<p>a</p>"), (2, None, "<p>a</p>"), (3, " v\r\nw\t", None), (4, "é", ""), (5, "x", "ü" * 5000), (6, "u", "<p>a</p>"), (None, "n", "<p>a</p>"), (6, "u", "<p>a</p>"), (7, "", "long " * 200_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    pages = pages.withColumn("record_id", F.lit("clash")).withColumn("sha", F.lit("clash")).withColumn("_q0", F.lit(1))
    got = warc.round_trip(pages).collect()
    by = {(r["page_id"], r["url"]): r for r in got}
    assert len(got) == len(rows)
    assert by[6, "u"]["record_type"] == "response" and by[1, "u"]["refers_to"] == 6 and by[None, "n"]["refers_to"] == 6 and by[3, " v\r\nw\t"]["refers_to"] == 4
    assert by[5, "x"]["payload_bytes"] == 10000 and by[5, "x"]["payload_digest"] == warc.digest_of(("ü" * 5000).encode())
    index = warc.write_archives(pages, str(tmp_path / "w"), min_payload=9, max_bytes=400)
    assert index.filter("record_type = 'revisit'").count() == 0 and index.select("file").distinct().count() > 2
    some = index.filter("record_id in (1, 5)")
    back = {r["record_id"]: r["payload"] for r in warc.read_records(spark, str(tmp_path / "w"), some, max_range=100, max_gap=0).collect()}
    assert bytes(back[5]) == ("ü" * 5000).encode() and bytes(back[1]) == b"<p>a</p>"
    assert by[7, ""]["payload_bytes"] == 1_000_000
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_warc_reading_tasks(spark, tmp_path):
    assert [warc.reading_tasks(n, 6) for n in (0, 1, 30 << 20, 1 << 40)] == [1, 1, 4, 8192]
    rows = [(i, f"u{i}", hashlib.sha256(str(i).encode()).hexdigest() * 4000) for i in range(100)]
    index = warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2), str(tmp_path / "w"))
    size = index.agg(F.sum("length")).first()[0]
    back = warc.read_records(spark, str(tmp_path / "w"), index)
    assert back.rdd.getNumPartitions() == warc.reading_tasks(size, spark.sparkContext.defaultParallelism)
    assert {r["record_id"]: bytes(r["payload"]).decode() for r in back.collect()} == {i: t for i, _, t in rows}


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain  text", "plain text"),
        ("<body><nav><a>Menu</a></nav><article><h1>T &amp; U</h1><p>One <b>two</b>three.<br>Four,\n five.<p>Six<script>var x='<p>no</p>'</script></article><footer>f</footer></body>", "T & U One twothree. Four, five. Six"),
        ("<article><p>Long text, with words.</p><div class='comments'><p>reader</p></div><aside>side</aside><form>f</form></article>", "Long text, with words."),
        ("<div id=header>head</div><div class=content><p>A first paragraph, with some text.</p><p>A second one, also long.</p></div><div class='sidebar'>x</div><div class='cookie-notice'>y</div>", "A first paragraph, with some text. A second one, also long."),
        ("<article><p>cut off <b>here", "cut off here"),
        ("<style>p{}</style><!-- c --><article><p title='a>b'>x&lt;y &copy; 1 < 2</article>", "x<y © 1 < 2"),
    ],
)
def test_html_text(page, text):
    assert html_text.main_text(page) == text


LONG = "A long paragraph of the article, with many words, and marks; it says a lot."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<div class=content><h1>T</h1><p>An intro, short.</p><div class=body>{f'<p>{LONG}</p>' * 9}</div></div>", f"T An intro, short. {' '.join([LONG] * 9)}"),
        (f"<div id=top>Site</div><div class=x><h2>Part</h2><div class=b>{f'<p>{LONG}</p>' * 4}</div></div><div class=footer>f</div><ul><li><a href=x>more</a></ul>", f"Part {' '.join([LONG] * 4)}"),
        (f"<main><h1>T</h1><p>Lead.</p><article><p>{LONG}</p></article></main><footer>f</footer>", f"T Lead. {LONG}"),
        (f"<main><article><p>One: {LONG}</p></article><article><p>Two: {LONG}</p></article><article class=comment><p>{LONG}</p></article></main>", f"One: {LONG} Two: {LONG}"),
        (f"<body><nav>n</nav><div><h1>T</h1><article><p>One: {LONG}</p></article><article><p>Two.</p></article></div></body>", f"T One: {LONG} Two."),
        (f"<body><article><p>Teaser.</p></article><div class=text>{f'<p>{LONG}</p>' * 5}</div></body>", f"Teaser. {' '.join([LONG] * 5)}"),
        (f"<body><div>Site</div><article><p>{LONG}</p><p>{LONG}</p></article><div>Made here</div></body>", f"{LONG} {LONG}"),
    ],
)
def test_html_text_keeps_all_containers(page, text):
    assert html_text.main_text(page) == text


PAGES = [
    f"<body><nav><a href=x>Menu</a> and more text here.</nav><div class=ad>Buy, now.</div><article><h1>T</h1>{f'<p>{LONG}</p>' * 3}<p>Short.</p></article><footer>Made, here.</footer></body>",
    f"<body><div>Site name</div><div><h2>Part</h2>{f'<p>{LONG} <b>bold, too</b></p>' * 4}<ul><li>One, item.<li>Two</ul></div><div>Tiny</div></body>",
    f"<div><span>a</span><div><p>{LONG}<p>{LONG}</div><table><tr><td>1, 2<td>3</table></div><ul><li><a href=y>other</a></ul>",
]


def test_html_text_ratios_by_brute_force():
    """Ratios by whole path strings, smoothing and fusion written out."""
    for page in PAGES:
        _, texts = html_text.parse(page)

        def whole(n):
            return (whole(n.parent) if n.parent else ()) + (n.key,)

        def level(n):
            return 0 if {"nav", "footer"} & set(whole(n)) else 1e-4 if "div.ad" in whole(n) else 1

        per = defaultdict(list)
        for n, t, _ in texts:
            if t.strip():
                per[whole(n)].append((len(t.strip()) * (0.2 if "a" in whole(n) else 1), sum(c in ".,;:!?" for c in t)))
        raw = [tuple(sum(x[k] for x in per[whole(n)]) / len(per[whole(n)]) for k in (0, 1)) if per.get(whole(n)) else (0, 0) for n, _, _ in texts]
        assert np.allclose(html_text.path_ratios(texts), raw)
        want = []
        for i, (n, _, _) in enumerate(texts):
            near = [(2.0 ** -abs(i - k) * level(texts[k][0]), raw[k]) for k in range(len(texts)) if abs(i - k) <= 2]
            size, marks = (sum(w * r[j] for w, r in near) / (sum(w for w, _ in near) or 1) for j in (0, 1))
            factor = level(n) * (20 if {"article", "main"} & {x.split(".")[0] for x in whole(n)} else 1)
            want.append((factor * size * (1 + marks), factor * raw[i][0] * (1 + raw[i][1])))
        assert np.allclose(html_text.path_scores(texts, raw), want)


def test_html_text_is_decided_by_ratios(monkeypatch):
    """With all marks kept, constant ratios change the text of pages with and without an article; ratios turned round change it where no article is marked."""
    want = [html_text.main_text(p) for p in PAGES]
    assert want[0] == f"T {' '.join([LONG] * 3)} Short." and "Site" not in want[1] and "Tiny" not in want[1] and want[1].startswith("Part") and "Two" in want[1]
    true = html_text.path_ratios
    for other, changed in ((lambda t: [(1.0, 1.0)] * len(t), [True, True]), (lambda t: [(1 / (1 + a), 1 / (1 + b)) for a, b in true(t)], [False, True])):
        monkeypatch.setattr(html_text, "path_ratios", other)
        assert [html_text.main_text(p) != w for p, w in zip(PAGES[:2], want, strict=False)] == changed


BODY = f"<h1>T</h1><p>{LONG}</p><p>{LONG}</p>"
ARTICLE, TEXT = f"<article>{BODY}</article>", f"T {LONG} {LONG}"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f'<body><form id="aspnetForm"><nav><a>m</a></nav>{ARTICLE}</form></body>', TEXT),
        (f'<body><form id="aspnetForm">{BODY}</form></body>', TEXT),
        (f'<body><div class="has-sidebar">{BODY}</div></body>', TEXT),
        (f'<div class="no-sidebar">{ARTICLE}</div>', TEXT),
        (f'<div class="post comments-open">{BODY}</div>', TEXT),
        (f'<div class="sidebar">{ARTICLE}</div>', TEXT),
        (f"<nav><ul><li><a>x</a>{ARTICLE}", TEXT),
        (f'<article><h1>T</h1><section id="discussion"><p>{LONG}</p><p>{LONG}</p></section></article>', TEXT),
        (f'<article><h1>T</h1><div class="social-history"><p>{LONG}</p><p>{LONG}</p></div></article>', TEXT),
        (f'<article>{BODY}<div class="social-history"><p>{LONG}</p></div><p>{LONG}</p></article>', f"{TEXT} {LONG} {LONG}"),
        (f'<article>{BODY}<p hidden>Hidden.</p><p style="display:none" aria-hidden=true>Too.</p></article>', f"{TEXT} Hidden. Too."),
        (f"<article>{BODY}<div class=comments>{f'<p>{LONG}</p>' * 8}</div></article>", TEXT),
        (f'<article>{BODY}</article><section class="comments"><article class="comment"><p>{LONG}</p></article></section>', TEXT),
        (f'<article>{BODY}<div class="share"><a>Tweet</a> now</div></article>', TEXT),
        (f"<main>{BODY}</main><aside><article><p>{LONG}</p></article></aside>", TEXT),
        (f"<div class=ad>{LONG}</div><article><p>Is.</p></article><footer>{LONG}</footer>", "Is."),
        ("<div class=ad>Is, it.</div><article><h1>Is, it.</h1><p>Is, it.</p></article><footer>Made here</footer>", "Is, it. Is, it."),
        ("<div class=ad>Buy, this now.</div><article><h1></h1></article><footer>x</footer>", ""),
    ],
)
def test_html_text_marks_are_evidence(page, text):
    assert html_text.main_text(page) == text


def test_html_text_of_a_table_by_brute_force():
    """Every page of the small table: what patterns cut out of its article."""
    pages = pq.read_table("/root/testdata/sf0.01/pages.parquet").column("html").to_pylist()
    for page in pages:
        body = re.sub(r"<!--.*?-->|<(script|style)[^>]*>.*?</\1>", "", re.search(r"<article>(.*?)</article>", page, re.S)[1], flags=re.S)
        body = re.sub(r"</?[a-z]+\b[^>]*>", "", re.sub(r"</?(?:p|h[1-6]|br|div|li|ul|ol|table|tr|td|th|figure|figcaption|blockquote|section)\b[^>]*>", " ", body))
        assert html_text.main_text(page) == " ".join(html.unescape(body).split())


@pytest.mark.parametrize("page", ["<div>" * 40_000 + "deep text, here." + "</div>" * 20_000 + "<p>x", "<b>" * 40_000 + "<p>word, more." * 5000, "<p>" + "<i>a" * 50_000, "<table>" + "<tr><td>x, y" * 20_000, "<p>" + "word, and more; " * 60_000])
def test_html_text_of_deep_and_long_pages(page):
    tracemalloc.start()
    text = html_text.main_text(page)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert text and most < 300 * len(page)


def test_html_text_table(spark):
    rows = [(1, "u", PAGES[0], "clash"), (2, None, None, "clash"), (None, "v", "", None), (1, "u", PAGES[0], "clash")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string").withColumn("n_chars", F.lit("clash"))
    got = html_text.extract(pages).collect()
    assert Counter(tuple(r) for r in got) == Counter((i, u, html_text.main_text(h), len(html_text.main_text(h))) for i, u, h, _ in rows)
    assert html_text.extract(pages.limit(0)).count() == 0


def test_packing(spark, docs, none):
    random.seed(2)
    for _ in range(100):
        cap = random.choice([7, 16, 50])
        sizes = [random.randint(1, cap) for _ in range(random.randint(0, 60))]
        plan = packing.best_fit_plan(Counter(sizes), cap)
        bins = defaultdict(list)
        for length, first, stop, b, per, place in plan:
            for i in range(stop - first):
                bins[b + i // per].append((place + i % per * length, length))
        for v in bins.values():
            v.sort()
            assert [p for p, _ in v] == [sum(n for _, n in v[:k]) for k in range(len(v))] and sum(n for _, n in v) <= cap
        naive = []
        for n in sorted(sizes, reverse=True):
            room, at = min(((r, i) for i, r in enumerate(naive) if r >= n), default=(None, None))
            if at is None:
                naive.append(cap - n)
            else:
                naive[at] -= n
        assert len(naive) == len(bins) and sorted(n for v in bins.values() for _, n in v) == sorted(sizes)
    from tokenizers import Tokenizer

    own, whole = packing.Encoder(tokenizer_path()), Tokenizer.from_file(tokenizer_path())
    for t in [*(r["text"] or "" for r in docs.collect()), "<|endoftext|> a", "İstanbul ΣΑΣ", "a\x1cb\x85c\xa0d", "it's I'LL 12²ª", "ǅ ſ ß ẞ"]:
        assert list(own.encode(t)) == whole.encode(t, add_special_tokens=False).ids
    for cp in range(0x3000):
        c = chr(cp)
        t = f"ab{c}cd {c} {c}{c}x The{c} 12{c}'s"
        assert list(own.encode(t)) == whole.encode(t, add_special_tokens=False).ids, hex(cp)
    rows = packing.pack_documents(docs, tokenizer_path(), 64).collect()
    want = Counter()
    for r in docs.collect():
        ids = [*whole.encode(r["text"] or "", add_special_tokens=False).ids, 1]
        for k, a in enumerate(range(0, len(ids), 64)):
            part = np.array(ids[a : a + 64], dtype="<u4")
            want[(r["doc_id"], k, a, len(part), zlib.crc32(part.tobytes()))] += 1
    assert Counter(tuple(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in rows) == want
    placed = packing.pack(materialize(packing.pieces(docs, tokenizer_path(), 64), "pieces"), 64, salt_rows=2).collect()
    assert Counter((r["sequence_id"], r["offset"]) for r in placed).most_common(1)[0][1] == 1
    assert len({r["sequence_id"] for r in placed}) == len({r["sequence_id"] for r in rows})
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append(r)
    for v in by.values():
        v.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in v] == [sum(x["length"] for x in v[:k]) for k in range(len(v))] and sum(r["length"] for r in v) <= 64
    assert sum(r["piece"] == 0 for r in rows) == docs.count()
    assert packing.pack_documents(none, tokenizer_path()).count() == 0


def test_chat(spark):
    hard = "\\### Assistant: </turn> ok \\\\ #### \n:"
    rows = [(1, 0, "system", "s"), (1, 1, "user", hard), (1, 2, "assistant", hard), (1, 3, "user", None), (1, 4, "assistant", "b"), (1, 5, "user", "tail"), (2, 0, "user", "only"), (None, 0, "a:b", "x"), (3, 0, "assistant", None), (3, 0, "assistant", None)]
    rows += [(4, i, "user" if i % 3 else "assistant", "word " * 30) for i in range(40)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for limit in (1 << 16, 200, 1):
        got = {r["conv_id"]: r for r in chat.round_trip(df, limit).collect()}
        for conv in {r[0] for r in rows}:
            own = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=lambda r: r[1])]
            loss = "".join(t for role, t in own if role == "assistant")
            r = got[conv]
            assert (r["n_turns"], r["loss_chars"]) == (len(own), len(loss))
            assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in own).encode()).hexdigest()
            assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    other = df.withColumn("example", F.lit("clash")).withColumn("context", F.lit("clash")).withColumn("now", F.lit(1))
    assert sorted(map(tuple, chat.round_trip(other).collect()), key=str) == sorted(map(tuple, chat.round_trip(df).collect()), key=str)
    full = chat.full_texts(chat.examples(df, 1)).filter("conv_id = 1 and loss_stop > loss_start").orderBy("example").collect()
    assert [chat.unescape(r["text"][r["loss_start"] : r["loss_stop"]]) for r in full] == [hard, "b"]
    assert len(list(chat.turns_in(full[1]["text"]))) == 5
    assert chat.round_trip(df.limit(0)).count() == 0


def test_chat_examples_hold_whole_prefixes(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", f"turn {i} " + "word:# " * 900) for i in range(24)]
    rows += [(2, 0, "user", "x" * 70_000), (2, 1, "assistant", "a"), (2, 2, "user", "y"), (2, 3, "assistant", "b"), (2, 4, "user", "tail")]
    rows += [(3, i, "user", "no reply " * 20) for i in range(9)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    want = {}
    for conv in (1, 2, 3):
        own = [(r[2], r[3]) for r in rows if r[0] == conv]
        upto = ["".join(f"### {a}: {b}</turn>\n" for a, b in own[: k + 1]) for k in range(len(own))]
        want[conv] = [upto[k] for k, (role, _) in enumerate(own) if role == "assistant" or k == len(own) - 1]
    for made, back in ((chat.examples(df), chat.round_trip(df)), (chat.examples(df, 1), chat.round_trip(df, 1))):
        got = defaultdict(list)
        for r in made.orderBy("conv_id", "example").collect():
            got[r["conv_id"]].append(r["text"])
        assert got == want
        assert {r["conv_id"]: r["formatted_chars"] for r in back.collect()} == {k: sum(map(len, v)) for k, v in want.items()}
    other = chat.examples(df).withColumn("text", F.when(F.expr("conv_id = 1 and example = 3"), F.overlay("text", F.lit("?"), F.lit(9))).otherwise(F.col("text")))
    with pytest.raises(Exception, match="does not continue"):
        chat.read_back(other).collect()


def test_classifiers(spark, docs, none):
    sf = "/root/testdata/sf0.01"
    all_docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    chain = toxicity.train(all_docs, labels)
    seen = toxicity.score(all_docs, chain).withColumnRenamed("toxic", "said").join(labels, "doc_id").toPandas()
    assert (seen["said"] == (seen["toxic"] == 1)).mean() > 0.95
    assert not toxicity.score(docs, chain).filter("toxic and n_terms = 0").count()
    clash = clashing(docs)
    kept = toxicity.drop_toxic(clash, chain)
    assert kept.columns == clash.columns and same_extras(kept, clash)
    assert toxicity.score(none, chain).count() == 0 and toxicity.drop_toxic(none, chain).count() == 0
    assert toxicity.score(docs, toxicity.fit_chain([], np.array([], dtype=int))).filter("toxic").count() == 0
    forest = quality_model.train(all_docs, labels)
    held = quality_model.score(all_docs, forest).join(labels, "doc_id").filter("held_out").toPandas()
    assert (held["predicted"] == held["quality"]).mean() > 0.93
    scores = quality_model.score(docs, forest).collect()
    assert len(scores) == docs.count() and all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in scores)
    assert quality_model.score(none, forest).count() == 0


@pytest.fixture(scope="module")
def labelled_texts():
    import pyarrow.parquet as pq

    sf = "/root/testdata/sf0.1"
    docs, labels = (pq.read_table(f"{sf}/{t}.parquet").to_pandas() for t in ("documents", "labels"))
    rows = docs.merge(labels, on="doc_id").sample(frac=1, random_state=1)
    return list(rows["text"]), rows["toxic"].to_numpy()


def test_toxicity_chain_gains(labelled_texts):
    """On held-out texts of four splits the chain's probabilities are better than those of one model of the same features."""
    texts, toxic = labelled_texts
    loss = lambda p, y: -np.mean(np.log(np.clip(np.where(y == 1, p, 1 - p), 1e-6, 1)))
    seen = []
    for split in range(4):
        order = np.random.default_rng(split).permutation(len(texts))
        own, rest = order[:500], order[500:1500]
        chain = toxicity.fit_chain([texts[i] for i in own], toxic[own])
        x, s, _ = chain.features([texts[i] for i in own])
        one = toxicity.fit_logistic(np.hstack([x, s]), toxic[own])
        zx, zs, _ = chain.features([texts[i] for i in rest])
        p, q, y = chain.predict(zx, zs), toxicity.predict_one(np.hstack([zx, zs]), one), toxic[rest]
        seen.append((loss(p[:, 2], y), loss(q, y), (p[:, 2] >= 0.5)[y == 1].mean(), (q >= 0.5)[y == 1].mean(), ((p[:, 2] >= 0.5) == y).mean()))
        assert np.abs(chain.weights[2][-3:-1]).max() > 0.1  # earlier categories count
        assert len(chain.weights[1]) == len(chain.weights[0]) + 1 and not np.allclose(p[:, 0], p[:, 2])
    with_chain, without, found, found_without, right = np.mean(seen, axis=0)
    assert with_chain < without and found >= found_without and right > 0.95


def test_toxicity_lists_come_from_the_other_folds():
    """A word that only one fold's toxic texts have is not chosen for that fold's out-of-fold predictions."""
    toxic = np.array([1, 0] * 100)
    texts = [f"plain words here {'vile' if y else 'kind'} {'onlyhere' if y and i % 10 == 0 else ''}" for i, y in enumerate(toxic)]
    table = toxicity.Table.of_texts(texts, toxic)
    part = np.arange(len(texts)) % 5
    chosen = lambda rows: {table.names[0][i] for i in table.choose(0, rows, toxic)}
    assert chosen(np.ones(len(texts), bool)) == {"vile", "onlyhere"} and chosen(part != 0) == {"vile"}
    x, n = table.dense(0, table.choose(0, part != 0, toxic))
    assert x.sum() == n.sum() == 100


def exhaustive_split(x, g, h, least, l2):
    """Best gain over every feature and every threshold between two values."""
    best = (1e-3, -1, 0.0)
    for j in range(x.shape[1]):
        for cut in np.unique(x[:, j])[:-1]:
            go = x[:, j] <= cut
            if least <= go.sum() <= len(x) - least:
                gain = sum(g[m].sum() ** 2 / (h[m].sum() + l2) for m in (go, ~go)) - g.sum() ** 2 / (h.sum() + l2)
                if gain > best[0] + 1e-12:
                    best = (gain, j, cut)
    return best


def test_forest_splits_and_walk():
    rng = np.random.default_rng(6)
    x = rng.integers(0, 12, (300, 4)).astype(float)  # fewer values than bins: histograms see every threshold
    y = ((x[:, 1] > 6) ^ (rng.random(300) < 0.15)).astype(float)
    forest = quality_model.fit_forest(x, y, trees=25, depth=3, least=10)
    p = 1 / (1 + np.exp(-forest.base))
    gain, j, cut = exhaustive_split(x, p - y, np.full(300, p * (1 - p)), 10, 2.0)
    root = forest.roots[0]
    assert forest.feature[root] == j and np.array_equal(x[:, j] <= forest.threshold[root], x[:, j] <= cut)

    def walk(at, row):
        if forest.feature[at] < 0:
            return forest.value[at]
        return walk(forest.left[at] if row[forest.feature[at]] <= forest.threshold[at] else forest.right[at], row)

    new = np.vstack([rng.normal(6, 5, (200, 4)), x[:50], np.full((1, 4), np.nan)])
    want = [1 / (1 + np.exp(-(forest.base + sum(walk(r, row) for r in forest.roots)))) for row in new]
    assert np.allclose(forest.predict(new), want) and len(forest.predict(new[:0])) == 0
    assert np.allclose(quality_model.fit_forest(x, np.ones(300)).predict(new), 0.999) and quality_model.fit_forest(x[:0], y[:0]).predict(new)[0] == 0.5
    assert quality_model.statistics(None) == quality_model.statistics("") == [0.0] * len(quality_model.STATISTICS)
    assert all(np.isfinite(quality_model.statistics("word " * 300_000)))


def test_samples_draw_long_texts(spark):
    docs = spark.createDataFrame([(i, "ab " * (10_000 if i % 3 == 0 else 5)) for i in range(30)] + [(3, "a"), (None, "x"), (40, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)] + [(7, 0), (None, 1), (40, 1), (41, 1), (9, None)], "doc_id long, toxic int")
    rows = labelled.sample(docs, labels, "toxic").collect()
    assert sorted((r["doc_id"], len(r["text"]), r["y"]) for r in rows) == [(i, 1 if i == 3 else 30_000 if i % 3 == 0 else 15, i % 2) for i in range(30) if i != 7]
    assert labelled.MAX_ROWS == 6000 and labelled.sample(docs, labels, "toxic", rows=4).count() == 4
    assert labelled.sample(docs.limit(0), labels, "toxic").count() == 0


def test_toxicity_features_are_the_same_on_executors(spark):
    texts = ["a bad bad word here", "badly worded, worse", "bad things worse", "bad and worse wordings", "", "kind words"] * 3
    toxic = np.array([1, 1, 1, 1, 0, 0] * 3)
    rows = spark.createDataFrame([(k, k, t, int(y)) for k, (t, y) in enumerate(zip(texts, toxic, strict=True))], "o long, doc_id long, text string, y int").repartition(4)
    table, y = toxicity.Table.of_rows(rows)
    own = toxicity.Table.of_texts(texts, toxic)
    assert list(y) == list(toxic) and table.names == own.names and list(table.words) == list(own.words)
    for kind in (0, 1):
        cols = np.arange(len(own.names[kind]))
        assert all(np.array_equal(a, b) for a, b in zip(table.dense(kind, cols), own.dense(kind, cols), strict=True))
