"""Hard negatives, nearest neighbours and conversation repair against brute force."""

import hashlib
import heapq
import os
import random
import zlib

import duckdb
import numpy as np
import pytest

from quirelens.llm import conversation_repair as R
from quirelens.llm import hard_negatives as H
from quirelens.llm import neighbours as N
from quirelens.llm import queries

SF = "/root/testdata/sf0.01"
VECTORS = "vec_id long, label int, vec array<double>, VEC_ID2 string, anchor int, rank string"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op13_conversation_repair"])
def test_query_matches_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    q = duck.execute(queries.ORACLE[name])
    at = [[d[0] for d in q.description].index(c) for c in cols]
    assert rows_of(df.select(*cols)) == sorted((tuple(r[i] for i in at) for r in q.fetchall()), key=repr)


# --- hard negatives -------------------------------------------------------------------------------


def brute_negatives(rows, stride, k, m, low, high, scale):
    one = {}
    for i, label, vec in rows:
        if i is None or label is None or vec is None or any(v is None or not np.isfinite(v) for v in vec):
            continue
        key = (label, vec)
        if i not in one or key < one[i]:
            one[i] = key
    whole = {i: (label, [int(np.floor(scale * v)) for v in vec]) for i, (label, vec) in one.items()}
    out = []
    for a, (label, x) in whole.items():
        if a % stride:
            continue
        s = sorted(((-sum(p * q for p, q in zip(x, y)), i, other) for i, (other, y) in whole.items() if i != a))
        for p, i, _ in [t for t in s if t[2] == label][:k]:
            inside = [t for t in s if t[2] != label and low * -p <= 100 * -t[0] <= high * -p]
            out += [(a, i, r, t[1], -p, -t[0]) for r, t in enumerate(inside[:m], 1)]
    return sorted(out, key=repr)


def test_hard_negatives_against_brute_force(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(i, rng.randrange(3), [rng.choice((-0.5, 0.0, 0.25, 0.5, 1.0)) for _ in range(4)]) for i in range(240)]  # many ties
    rows += [(5, 9, [1.0] * 4), (5, 0, [9.0] * 4), (7, 0, [9.0] * 4)]  # repeated ids
    rows += [(300, None, [1.0] * 4), (310, 1, None), (320, 1, [1.0, None, 1.0, 1.0]), (330, 1, [1.0, float("nan"), 1.0, 1.0]), (340, 1, [float("inf")] * 4), (None, 1, [1.0] * 4)]
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], VECTORS).repartition(5)
    from pyspark.sql import functions as F

    want = brute_negatives(rows, 10, 5, 3, 50, 95, 256)
    assert len(want) > 100
    assert rows_of(H.mine(df, F.col("vec_id") % 10 == 0)) == want
    monkeypatch.setattr(H, "BLOCK_BYTES", 32 * 5)  # several blocks of anchors
    assert rows_of(H.mine(df, F.col("vec_id") % 10 == 0)) == want
    assert rows_of(H.mine(df, F.col("vec_id") % 10 == 0, positives=1, negatives=50, low=-200, high=200, scale=3.0)) == brute_negatives(rows, 10, 1, 50, -200, 200, 3.0)


def test_hard_negatives_of_odd_vectors(spark):
    from pyspark.sql import functions as F

    every = F.lit(True)
    empty = spark.createDataFrame([], VECTORS)
    assert H.mine(empty, every).count() == 0
    assert H.mine(spark.createDataFrame([(1, 1, [1.0], "", 0, ""), (2, 1, [1.0], "", 0, "")], VECTORS), every).count() == 0  # no other label
    ragged = spark.createDataFrame([(1, 1, [1.0, 1.0], "", 0, ""), (2, 1, [2.0], "", 0, ""), (3, 2, [1.0], "", 0, ""), (4, 2, [], "", 0, "")], VECTORS)
    assert (1, 2, 1, 3, 512 * 256, 256 * 256) in rows_of(H.mine(ragged, every))
    huge = [(1, 1, [1e300]), (2, 1, [1e300]), (3, 2, [1e16]), (4, 2, [1.0])]
    got = rows_of(H.mine(spark.createDataFrame([(*r, "", 0, "") for r in huge], VECTORS), every, low=0, high=100))
    assert (1, 2, 1, 3, 2**63 - 1, 2**63 - 1) in got  # held at the limits of a long


def test_limits_are_exact():
    for p in range(-300, 300):
        least, most = H.limits(p, 50, 95)
        assert [n for n in range(-400, 400) if 50 * p <= 100 * n <= 95 * p] == [n for n in range(-400, 400) if least <= n <= most]


# --- nearest neighbours ---------------------------------------------------------------------------


def brute_nearest(rows, stride, k):
    one = {}
    for i, vec in rows:
        if i is not None and vec is not None and all(v is not None and np.isfinite(v) for v in vec) and any(vec):
            one[i] = min(vec, one.get(i, vec))
    dim = max((len(v) for v in one.values()), default=1)
    ids = sorted(one)
    x = np.array([list(one[i]) + [0.0] * (dim - len(one[i])) for i in ids]).reshape(len(ids), dim)
    out = []
    for a, i in enumerate(ids):
        if i % stride == 0:
            s = np.add.reduce(x * x[a], axis=1)
            order = [b for b in np.lexsort((ids, -s)) if b != a][:k]
            out += [(i, r, ids[b], float(s[b])) for r, b in enumerate(order, 1)]
    return sorted(out, key=repr)


def nearest(spark, rows, stride, k, **options):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(*r, "x", 2.0, [1]) for r in rows], "vec_id long, vec array<double>, rep string, SCORE double, ids array<int>").repartition(4)
    return rows_of(N.nearest(df, F.col("vec_id") % stride == 0, k, **options))


def test_nearest_is_exact_when_all_lists_are_read(spark, monkeypatch):
    monkeypatch.setattr(N, "LIST_ROWS", 8)
    monkeypatch.setattr(N, "SHARD_ROWS", 50)
    rng = random.Random(8)
    rows = [(i, [float(rng.randrange(-2, 3)) for _ in range(3)]) for i in range(500)]  # many equal vectors and ties
    rows += [(1000 + i, [2.0, 2.0, 1.0]) for i in range(400)]  # one vector of very many rows, queries among them
    rows += [(2000, None), (2005, [1.0, None, 1.0]), (2010, [0.0, 0.0, 0.0]), (2015, []), (2020, [float("nan")] * 3), (None, [1.0] * 3), (5, [-9.0, 9.0, 9.0]), (2025, [3.0])]
    assert nearest(spark, rows, 5, 7, ratio=1e9) == brute_nearest(rows, 5, 7)


def test_nearest_of_few_rows(spark):
    rows = [(10, [1.0, 0.0]), (20, [1.0, 0.0]), (21, [0.0, 1.0])]
    assert nearest(spark, rows, 10, 20) == [(10, 1, 20, 1.0), (10, 2, 21, 0.0), (20, 1, 10, 1.0), (20, 2, 21, 0.0)]
    assert nearest(spark, rows[:1], 10, 20) == [] and nearest(spark, [], 10, 20) == []


def test_nearest_recall_and_scores(spark, monkeypatch):
    """Clustered vectors of different lengths: few lists are read, and at least 0.9 of the true neighbours found."""
    monkeypatch.setattr(N, "LIST_ROWS", 64)
    rng = np.random.RandomState(3)
    centres = rng.randn(40, 16)
    rows = [(i, [float(v) for v in (centres[i % 40] + 0.3 * rng.randn(16)) * (0.5 + rng.rand())]) for i in range(4000)]
    got, want = nearest(spark, rows, 20, 20), brute_nearest(rows, 20, 20)
    assert len(got) == len(want)
    score = {(q, x): s for q, _, x, s in got}
    found = sum((q, x) in score for q, _, x, _ in want) / len(want)
    assert found >= 0.9
    assert all(score[q, x] == s for q, _, x, s in want if (q, x) in score)
    by = {}
    for q, r, x, s in got:
        by.setdefault(q, []).append((r, -s, x))
    assert all([r for r, _, _ in sorted(v)] == list(range(1, 21)) and [t[1:] for t in sorted(v)] == sorted(t[1:] for t in v) for v in by.values())


def test_walk_reaches_all_near_centres():
    rng = np.random.RandomState(5)
    x = rng.randn(3000, 12)
    index = N.Index(x, 100, float(np.abs(x).max()), float(np.linalg.norm(x / np.abs(x).max(), axis=1).max()))
    assert len(index.centres) == 100
    assert {len(p) for p in N.halves(x, 100)} <= {29, 30, 31}
    q = index.lifted(x[:200], True)
    d = index.distances(q, index.centres)
    walked = index.walk(q, 1.2)
    near = d <= N.reach(d.min(axis=1), 1.2)[:, None]
    assert np.isfinite(walked[near]).mean() > 0.99
    assert np.allclose(walked[np.isfinite(walked)], d[np.isfinite(walked)])


def test_shards_hold_bounded_rows():
    sizes = np.array([10, 20, 500, 5, 90, 90, 0, 30])
    first, parts = N.deal(sizes, 100)
    assert parts.tolist() == [1, 1, 5, 1, 1, 1, 1, 1] and first.tolist() == [0, 0, 1, 6, 6, 7, 7, 8]


# --- conversation repair --------------------------------------------------------------------------


def brute_repair(initials, gone, cut):
    """Cheapest edits, ASCII-least among them, by a search over all prefixes in order of cost."""
    queue, best = [(0, "", 0, R.START)], None
    seen = set()
    while queue:
        cost, audit, i, state = heapq.heappop(queue)
        if best is not None and cost > best[0]:
            break
        if i == len(initials) and state in (R.START, R.AFTER_A):
            best = min(best or (cost, audit), (cost, audit))
        if (audit, i, state) in seen or len(audit) > 2 * len(initials) + 4:
            continue
        seen.add((audit, i, state))
        other = R.AFTER_A if state == R.AFTER_U else R.AFTER_U
        heapq.heappush(queue, (cost + 5, audit + "I", i, other))
        if i < len(initials):
            heapq.heappush(queue, (cost + 2, audit + "D", i + 1, state))
            if not gone[i]:
                more = 5 if cut[i] else 0
                heapq.heappush(queue, (cost + 1 + more, audit + "R", i + 1, other))
                kept = R.step(state, initials[i])
                if kept is not None:
                    heapq.heappush(queue, (cost + more, audit + "K", i + 1, kept))
    return best


def test_repair_against_search():
    rng = random.Random(2)
    for _ in range(400):
        n = rng.randrange(0, 6)
        initials = "".join(rng.choice("suuaa?") for _ in range(n))
        gone = bytes(rng.random() < 0.2 for _ in range(n))
        cut = bytes(not g and rng.random() < 0.3 for g in gone)
        assert R.repair(initials, gone, cut) == brute_repair(initials, gone, cut), (initials, gone, cut)


def viterbi(initials, gone, cut):
    """Least (cost, audit) of each state, row by row, without layers."""
    none = (10**9, "")
    now = [(0, ""), none, none, none]

    def inserted(v):
        v = list(v)
        v[2] = min(v[2], *[(v[s][0] + 5, v[s][1] + "I") for s in (0, 1, 3)])
        v[3] = min(v[3], (v[2][0] + 5, v[2][1] + "I"))
        return v

    now = inserted(now)
    for i, x in enumerate(initials):
        new = [(c + 2, a + "D") for c, a in now]
        if not gone[i]:
            more = 5 if cut[i] else 0
            for s, (c, a) in enumerate(now):
                to = R.AFTER_A if s == R.AFTER_U else R.AFTER_U
                new[to] = min(new[to], (c + 1 + more, a + "R"))
                kept = R.step(s, x)
                if kept is not None:
                    new[kept] = min(new[kept], (c + more, a + "K"))
        now = inserted(new)
    return min(now[0], now[3])


def test_repair_of_long_conversations():
    rng = random.Random(7)
    for n, letters in ((3000, "ua"), (3000, "s"), (2000, "suua?"), (1500, "a")):
        initials = "".join(rng.choice(letters) for _ in range(n))
        gone = bytes(rng.random() < 0.1 for _ in range(n))
        cut = bytes(not g and rng.random() < 0.3 for g in gone)
        assert R.repair(initials, gone, cut) == viterbi(initials, gone, cut)


def brute_table(rows, damaged):
    convs = {}
    for conv, turn, role, text in rows:
        own = convs.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damaged else 9
        if k == 1:
            text = ""
        if k == 2:
            text = "".join(c for c in text if c not in ".!?")
        if k == 4:
            role = "user"
        if k:
            own += [(turn, role, text)] * (2 if k == 3 else 1)
    out = []
    for conv, own in convs.items():
        digest = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(r)))
        seen, faults = set(), []
        for _, role, text in own:
            rest = text.rstrip(R.WHITE)
            faults.append("blank" if not rest else "duplicate" if (role, text) in seen else "" if rest[-1] in ".!?" else "truncated")
            seen.add((role, text))
        initials = "".join(r[1][:1] if r[1][:1] in ("s", "u", "a") else "?" for r in own)
        cost, audit = viterbi(initials, [f in ("blank", "duplicate") for f in faults], [f == "truncated" for f in faults])
        text, i, state = [], 0, R.START
        for e in audit:
            role = "assistant" if state == R.AFTER_U else "user"
            if e == "I":
                text.append(f"{role}:")
            else:
                if e != "D":
                    role = own[i][1] if e == "K" else role
                    text.append(f"{role}:{own[i][2]}")
                i += 1
            if e != "D":
                state = R.step(state, role[:1])
        turns = {r[0] for r in own} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        out.append((conv, gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256("\n".join(text).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("damaged", [True, False])
def test_repair_of_odd_tables(spark, damaged):
    rng = random.Random(1)
    texts = [None, "", " \t\x0b", "Yes.", "no", "What? ", "Ünlü metin…", "a.b", "x .", "end!\r\n", "z" * 5000 + "."]
    roles = ["user", "assistant", "system", None, "", "tool", "User"]
    rows = [(rng.choice([None, -3, *range(25)]), rng.choice([None, *range(-2, 12)]), rng.choice(roles), rng.choice(texts)) for _ in range(400)]
    rows += rows[:40]
    rows += [(900, t, "user" if t % 2 == 0 else "assistant", f"{t % 50}.") for t in range(1500)]  # one long conversation
    df = spark.createDataFrame([(*r, "x", 1, b"y") for r in rows], "conv_id long, turn long, role string, text string, AUDIT string, copy int, digest binary").repartition(5)
    made = R.damage(df) if damaged else R.as_is(df)
    assert rows_of(R.repaired(made)) == brute_table(rows, damaged)
    assert R.repaired(R.damage(df.limit(0))).count() == 0


def test_conversations_that_lose_all_rows(spark):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(conv, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    assert rows_of(R.repaired(R.damage(df))) == [(conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


# --- names of long words, hot nodes ----------------------------------------------------------------


def thue_morse(n, swap):
    return "".join("ab"[(bin(i).count("1") + swap) % 2] for i in range(n))


def test_words_made_to_collide_are_not_linked(spark):
    from quirelens.llm import ngram_join

    rows = [(1, thue_morse(1024, 0)), (2, thue_morse(1024, 1)), (3, thue_morse(4096, 0)), (4, thue_morse(4096, 1)), (5, thue_morse(4096, 1))]
    got = ngram_join.component_table(spark.createDataFrame(rows, "doc_id long, text string"))
    assert rows_of(got) == [(1, 1, 1), (2, 1, 2), (3, 1, 3), (4, 1, 4), (5, 1, 4)]


def test_centre_of_a_large_star(spark, monkeypatch):
    from quirelens.llm import components

    monkeypatch.setattr(components, "MANY", 10)
    edges = [(0, i) for i in range(1, 3000)] + [(i, i + 1) for i in range(5000, 5020)] + [(7, 7), (None, 4)]
    got = dict(rows_of(components.components(spark.createDataFrame(edges, "a long, b long"))))
    assert got == {i: 0 for i in range(3000)} | {i: 5000 for i in range(5000, 5021)}
