r"""Structure repair of conversations: the cheapest edits after which roles read `(s?(ua)+)?`, and which edits these are.

A row's first fault counts: blank (nothing but space, tab, \n, \v, \f, \r), duplicate (role and text stand earlier
in the conversation), truncated (its last other character is not one of `.!?`).  Edits of rows are Keep (0), Rerole to
user or assistant (1) and Delete (2, the only one for blank and duplicate rows); Insert puts an empty user or
assistant row anywhere (5); a truncated row that stays costs 5 more.

Cost layers: before each row stands a set of grammar states for every cost from which the rest can be
accepted at just that cost, four bits a layer and all layers in one integer, so that an edit moves all
states of all layers by a mask and a shift.  Layers are made from the last row back; the first that holds the start state
is the cost.  From there a trace takes, edit by edit, the ASCII-least one whose target bit is set: that
is the least audit of all cheapest ones.  Of any two states one is at most 12 dearer than the other (two inserts, or an insert and
deletes, lead from each to what the other can do), so 13 layers above the cheapest hold all that a trace
can reach, and a row takes one number, however long the conversation is.

A conversation's rows are streamed twice, in order: without texts, for faults and layers, by the task that has the
conversation (one number and one digest a row; the audit, one letter a row, is one value of the result anyway), then
with texts, of which one batch at a time is held, for the digest of what the edits leave.

Null texts and roles are one space; in the key of the damage null ids and turns are, too.  Null turns come first.
Ties of turns: by role, then by a digest of the text.  Repeated rows: the later ones are duplicates.  Very long
texts: each is held by itself.  A conversation without rows, or with none left: zeros, an empty audit, the digest of the
empty string.  A null conv_id is a conversation of its own.  An empty table: no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import record

WHITE = " \t\n\x0b\x0c\r"

# Grammar states: at the start, after s, after u, after a; bits of a layer.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
LAYERS = 13
_ALL = (1 << 4 * (LAYERS + 12)) - 1
_OF = [sum(1 << 4 * c + q for c in range(LAYERS + 12)) for q in range(4)]
_HELD = (1 << 4 * LAYERS) - 1

KEEP, REROLE, DELETE, INSERT = 0, 1, 2, 5
CUT = 5


def step(state: int, role: str) -> int | None:
    """State after a row of that role initial; None if the grammar has no such row there."""
    if role == "u":
        return AFTER_U if state != AFTER_U else None
    if role == "a":
        return AFTER_A if state == AFTER_U else None
    return AFTER_S if role == "s" and state == START else None


def _before(layers: int, role: str) -> int:
    """Sets of states that a row of that role leads to `layers`."""
    if role == "u":
        at = layers & _OF[AFTER_U]
        return at >> 2 | at >> 1 | at << 1
    if role == "a":
        return (layers & _OF[AFTER_A]) >> 1
    return (layers & _OF[AFTER_S]) >> 1 if role == "s" else 0


def _either(layers: int) -> int:
    """Before a row that can be a user's or an assistant's."""
    return _before(layers, "u") | _before(layers, "a")


def _inserted(layers: int) -> int:
    """With one or two inserted rows before; a third is of no use."""
    once = layers | _either(layers) << 4 * INSERT
    return once | _either(once) << 4 * INSERT


def repair(initials: str, gone: bytes, cut: bytes) -> tuple[int, str]:
    """(cost, audit) of rows with these role initials (any other letter: `?`); gone: must be deleted; cut: truncated."""
    n = len(initials)
    layers, base = array("Q", bytes(8 * (n + 1))), array("q", bytes(8 * (n + 1)))
    now, low = _inserted(1 << START | 1 << AFTER_A) & _HELD, 0
    layers[n], base[n] = now, low
    for i in range(n - 1, -1, -1):
        after, now = now, now << 4 * DELETE
        if not gone[i]:
            more = 4 * (CUT if cut[i] else 0)
            now |= _before(after, initials[i]) << more | _either(after) << more + 4 * REROLE
        now = _inserted(now & _ALL)
        empty = ((now & -now).bit_length() - 1) // 4
        now = now >> 4 * empty & _HELD
        low += empty
        layers[i], base[i] = now, low

    def reaches(i: int, state: int, cost: int) -> bool:
        c = cost - base[i]
        return 0 <= c < LAYERS and bool(layers[i] >> 4 * c + state & 1)

    state, i, audit = START, 0, []
    left = cost = base[0] + next(c for c in range(LAYERS) if layers[0] >> 4 * c + START & 1)
    while i < n or left:
        if i < n and reaches(i + 1, state, left - DELETE):
            audit.append("D")
            i, left = i + 1, left - DELETE
            continue
        other = AFTER_A if state == AFTER_U else AFTER_U
        if reaches(i, other, left - INSERT):
            audit.append("I")
            state, left = other, left - INSERT
            continue
        more = CUT if cut[i] else 0
        kept = step(state, initials[i])
        if kept is not None and reaches(i + 1, kept, left - more):
            audit.append("K")
            state, i, left = kept, i + 1, left - more
        else:
            audit.append("R")
            state, i, left = other, i + 1, left - more - REROLE
    return cost, "".join(audit)


# --- damage and faults, as expressions ------------------------------------------------------------


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copy, lost: the rows with one of five faults in each 20th, by the CRC of `conv_id:turn`.

    Rows that the damage drops stay as `lost`, so that their conversations are known."""
    space = F.lit(" ")
    kind = F.crc32(F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")]).cast("binary")) % 20
    own = rows.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), space).alias("role"), F.coalesce(F.col("text").cast("string"), space).alias("text"), kind.alias("k"))
    own = own.withColumn("text", F.when(F.col("k") == 1, "").when(F.col("k") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    own = own.withColumn("role", F.when(F.col("k") == 4, "user").otherwise(F.col("role")))
    copies = F.when(F.col("k") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return own.withColumn("copy", F.explode(copies)).withColumn("lost", F.col("k") == 0).drop("k")


def as_is(rows: DataFrame) -> DataFrame:
    """The same columns of rows that are to be repaired as they are."""
    space = F.lit(" ")
    return rows.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), space).alias("role"), F.coalesce(F.col("text").cast("string"), space).alias("text"), F.lit(0).alias("copy"), F.lit(False).alias("lost"))


def _rest(text: Column) -> Column:
    return F.rtrim(text, F.lit(WHITE))


def _order(*first: Column) -> list:
    """conv_id, then `first`, then the order of a conversation's rows."""
    return [F.col("conv_id").asc_nulls_first(), *first, F.col("turn").asc_nulls_first(), "role", "digest", "copy"]


def _keyed(rows: DataFrame) -> DataFrame:
    """With the digest of role and text that duplicates and the order of equal turns go by."""
    text = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text", "copy", "lost", F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"))


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_PLAN = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in COUNTS], ("audit", pa.string())])
PLAN = f"conv_id long, {', '.join(f'{c} long' for c in COUNTS)}, audit string"


class _Conversation:
    """What one stream of rows tells of a conversation, without its texts."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id = conv_id
        self.initials, self.gone, self.cut = bytearray(), bytearray(), bytearray()
        self.seen: set[bytes] = set()
        self.counts = dict.fromkeys(COUNTS, 0)
        self.first: int | None = None
        self.last: int | None = None
        self.turns = 0

    def add(self, turn: int | None, initial: str, blank: bool, cut: bool, digest: bytes) -> None:
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.turns = turn, self.turns + 1
        fault = "blank" if blank else "duplicate" if digest in self.seen else "truncated" if cut else ""
        self.seen.add(digest)
        if fault:
            self.counts[fault] += 1
        own = initial if initial in ("s", "u", "a") else "?"
        if self.initials:
            self.counts["illegal"] += chr(self.initials[-1]) + own not in ("su", "ua", "au")
        self.initials.append(ord(own))
        self.gone.append(fault in ("blank", "duplicate"))
        self.cut.append(fault == "truncated")

    def plan(self) -> list:
        if self.turns:
            self.counts["gaps"] = self.last - self.first + 1 - self.turns
        self.counts["cost"], audit = repair(self.initials.decode(), bytes(self.gone), bytes(self.cut))
        return [self.conv_id, *self.counts.values(), audit]


def _plans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own: _Conversation | None = None
    for batch in batches:
        out = []
        for conv, turn, initial, blank, cut, lost, digest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if own is None or conv != own.conv_id:
                if own is not None:
                    out.append(own.plan())
                own = _Conversation(conv)
            if not lost:
                own.add(turn, initial, blank, cut, digest)
        if out:
            yield record(_PLAN, list(zip(*out, strict=True)))
    if own is not None:
        yield record(_PLAN, [[v] for v in own.plan()])


class _Output:
    """The digest of a repaired conversation, fed row by row."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state, self.hash, self.empty = audit, 0, START, hashlib.sha256(), True

    def put(self, role: str, text: str) -> None:
        self.hash.update(("" if self.empty else "\n").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
        self.empty = False
        self.state = step(self.state, role[:1])

    def needed(self) -> str:
        return "assistant" if self.state == AFTER_U else "user"

    def inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.put(self.needed(), "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            self.put(role if edit == "K" else self.needed(), text)


_DONE = pa.schema([*_PLAN, ("repaired_sha256", pa.string())])
DONE = f"{PLAN}, repaired_sha256 string"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order, each conversation's plan (whose audit is not null) before its rows."""
    head, own = None, None

    def close() -> pa.RecordBatch:
        own.inserts()
        return record(_DONE, [[v] for v in (*head, own.hash.hexdigest())])

    for batch in batches:
        names = batch.schema.names
        role, text = batch.column(names.index("role")), batch.column(names.index("text"))
        plan = [batch.column(names.index(f.name)) for f in _PLAN]
        for i, audit in enumerate(plan[-1].to_pylist()):
            if audit is not None:
                if own is not None:
                    yield close()
                head, own = [c[i].as_py() for c in plan], _Output(audit)
            else:
                own.row(role[i].as_py(), text[i].as_py())
    if own is not None:
        yield close()


def plans(rows: DataFrame) -> DataFrame:
    """rows of `damage` or `as_is`.  One row per conversation: conv_id, COUNTS, audit."""
    first, rest = F.substring("role", 1, 1), _rest(F.col("text"))
    small = _keyed(rows).select("conv_id", "turn", first.alias("initial"), (rest == "").alias("blank"), (~F.right(rest, F.lit(1)).isin(".", "!", "?")).alias("cut"), "lost", "digest", "role", "copy")
    columns = ["conv_id", "turn", "initial", "blank", "cut", "lost", "digest"]
    return small.repartition("conv_id").sortWithinPartitions(*_order(F.col("lost").asc())).select(*columns).mapInArrow(_plans, PLAN)


def repaired(rows: DataFrame) -> DataFrame:
    """rows of `damage` or `as_is`.  One row per conversation: conv_id, COUNTS, audit, repaired_sha256."""
    heads = plans(rows).select("*", *[F.lit(None).cast(t).alias(c) for c, t in (("turn", "long"), ("role", "string"), ("text", "string"), ("copy", "int"), ("digest", "binary"))], F.lit(False).alias("lost"))
    body = _keyed(rows.filter(~F.col("lost"))).select("conv_id", *[F.lit(None).cast("long").alias(c) for c in COUNTS], F.lit(None).cast("string").alias("audit"), "turn", "role", "text", "copy", "digest", "lost")
    both = heads.unionByName(body).repartition("conv_id").sortWithinPartitions(*_order(F.col("audit").isNull()))
    return both.select("conv_id", *COUNTS, "audit", "role", "text").mapInArrow(_digests, DONE)


# --- the same in SQL: the cheapest way to each grammar state, row by row ---------------------------


def _way(state: int, cost: str, letter: str, role: str | None = None, text: str = "text") -> str:
    """A way out of a state, by an edit; role: of the row that it leaves."""
    more = "" if role is None else f" || {repr('') if state == START else 'chr(10)'} || {role} || ':' || {text}"
    return f"{{'c': s{state}.c + {cost}, 'a': s{state}.a || '{letter}', 't': s{state}.t{more}}}"


def _to(state: int) -> str:
    """The cheapest way to a state by an edit of the next row."""
    ways = [_way(state, "2", "D")]
    if state == AFTER_S:
        ways.append(f"CASE WHEN NOT gone AND ini = 's' THEN {_way(START, 'more', 'K', 'role')} END")
    if state in (AFTER_U, AFTER_A):
        for before in (AFTER_U,) if state == AFTER_A else (START, AFTER_S, AFTER_A):
            own = "assistant" if state == AFTER_A else "user"
            ways.append(f"CASE WHEN NOT gone AND ini = '{own[0]}' THEN {_way(before, 'more', 'K', 'role')} END")
            ways.append(f"CASE WHEN NOT gone THEN {_way(before, 'more + 1', 'R', repr(own))} END")
    return f"list_min([{', '.join(ways)}])"


def _inserts(source: str) -> str:
    """source: s0 to s3 and other columns; with inserted rows."""
    user = ", ".join(_way(x, "5", "I", "'user'", "''") for x in (START, AFTER_S, AFTER_A))
    once = f"SELECT * REPLACE (list_min([s2, {user}]) AS s2) FROM ({source})"
    return f"SELECT * REPLACE (list_min([s3, {_way(AFTER_U, '5', 'I', chr(39) + 'assistant' + chr(39), repr(''))}]) AS s3) FROM ({once})"


_WHITE_CLASS = r"\x20\x09-\x0D"
REPAIR_SQL = rf"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS tab),
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
    lambda c: CAST(ord(c) AS BIGINT))), lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS k FROM conversations, crc),
d AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role, CASE WHEN k = 1 THEN '' WHEN k = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN k = 3 THEN [0, 1] ELSE [0] END) AS copy FROM k WHERE k <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM d),
f AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again, NOT regexp_matches(text, '[^{_WHITE_CLASS}]') AS blank, NOT regexp_matches(text, '[.!?][{_WHITE_CLASS}]*\z') AS cut,
  substr(role, 1, 1) AS ini, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS was FROM o),
g AS (SELECT *, blank OR again AS gone, CASE WHEN cut AND NOT blank AND NOT again THEN 5 ELSE 0 END AS more FROM f),
z AS (SELECT conv_id, CASE WHEN count(turn) > 0 THEN max(turn) - min(turn) + 1 - count(DISTINCT turn) ELSE 0 END AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate,
  count(*) FILTER (more = 5) AS truncated, count(*) FILTER (i > 1 AND was || ini NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM g GROUP BY conv_id),
w AS ({_inserts("SELECT conv_id, CAST(0 AS BIGINT) AS i, {'c': 0, 'a': '', 't': ''} AS s0, {'c': 1000000000, 'a': '', 't': ''} AS s1, {'c': 1000000000, 'a': '', 't': ''} AS s2, {'c': 1000000000, 'a': '', 't': ''} AS s3 FROM z")}
  UNION ALL {_inserts(f"SELECT w.conv_id, g.i, {_to(0)} AS s0, {_to(1)} AS s1, {_to(2)} AS s2, {_to(3)} AS s3 FROM w JOIN g ON g.conv_id IS NOT DISTINCT FROM w.conv_id AND g.i = w.i + 1")}),
e AS (SELECT z.*, list_min([w.s0, w.s3]) AS x FROM z JOIN w ON w.conv_id IS NOT DISTINCT FROM z.conv_id AND w.i = z.n)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(coalesce(x.c, 0) AS BIGINT) AS cost, coalesce(x.a, '') AS audit, sha256(coalesce(x.t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""
