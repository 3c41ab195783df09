"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context, only its text
is trainable.  Turns after the last reply come as an example without a target, so that nothing is
lost.  Texts are escaped, so that what looks like a marker inside a text is read back as text.

An example's text is the whole prefix and the reply, at every size; of it, the first `context` code
points are the text of the example before.  The examples of a conversation thus grow with its length
times its replies; they are compressed on disk, and reading back moves only what is new in each.
A conversation is streamed in turn order by one task, in memory of its formatted text.

Null texts and roles: empty.  Null ids: one conversation.  Rows of one turn number (ties, repeated
rows): ordered by role and text, each a turn.  Null turns come first.  Very long texts: like any
other, in the memory of the task that has their conversation.  An empty table: no examples.  Extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, record

# Fixed: the template.  A turn is MARK role COLON text END.
MARK, COLON, END = "### ", ": ", "</turn>\n"
TRAINED = "assistant"
_ESCAPED = re.compile(r"\\(\\|###|</turn>|:)", re.S)
_PLAIN = re.compile(r"(?:[^\\<:]|\\(?:\\|###|</turn>|:)|<(?!/turn>))*+", re.S)
_BODY = re.compile(r"(?:[^\\<]|\\(?:\\|###|</turn>|:)|<(?!/turn>))*+", re.S)


def escape(text: str, role: bool = False) -> str:
    out = text.replace("\\", "\\\\").replace("###", "\\###").replace("</turn>", "\\</turn>")
    return out.replace(":", "\\:") if role else out


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def turns_in(text: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of a formatted text."""
    at = 0
    while at < len(text):
        if not text.startswith(MARK, at):
            raise ValueError(f"no turn at {at}")
        role = _PLAIN.match(text, at + len(MARK))
        if not text.startswith(COLON, role.end()):
            raise ValueError(f"no role at {at}")
        body = _BODY.match(text, role.end() + len(COLON))
        if not text.startswith(END, body.end()):
            raise ValueError(f"open turn at {at}")
        yield unescape(role[0]), unescape(body[0])
        at = body.end() + len(END)


EXAMPLE = "conv_id long, example int, context long, text string, loss_start long, loss_stop long"
_EXAMPLE = pa.schema([("conv_id", pa.int64()), ("example", pa.int32()), ("context", pa.int64()), ("text", pa.string()), ("loss_start", pa.int64()), ("loss_stop", pa.int64())])
# Small row groups: a reader holds up to 4096 texts of one at once.
_STORED = {"compression": "zstd", "parquet.block.size": str(4 << 20), "parquet.page.size.row.check.min": "10"}


def _format(batch_chars: int, out_rows: int = 500):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0
        now: object = object()
        prefix, new, example, fresh = "", [], 0, 0

        def close(start: int, stop: int) -> None:
            nonlocal prefix, new, example, size, fresh
            context = len(prefix)
            prefix += "".join(new)
            rows.append((now, example, context, prefix, context + start, context + stop))
            size += len(prefix)
            example += 1
            new, fresh = [], 0

        def flush() -> pa.RecordBatch:
            nonlocal rows, size
            out = record(_EXAMPLE, [list(c) for c in zip(*rows, strict=True)])
            rows, size = [], 0
            return out

        for batch in batches:
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                if conv != now:
                    if new:
                        close(0, 0)
                    now, prefix, new, example, fresh = conv, "", [], 0, 0
                role, body = role or "", escape(text or "")
                head = MARK + escape(role, True) + COLON
                before = fresh + len(head)
                turn = head + body + END
                new.append(turn)
                fresh += len(turn)
                if role == TRAINED:
                    close(before, before + len(body))
                if len(rows) >= out_rows or size > batch_chars:
                    yield flush()
        if new:
            close(0, 0)
        if rows:
            yield flush()

    return run


def examples(conversations: DataFrame, batch_chars: int = 1 << 24) -> DataFrame:
    """conv_id, example, context, text, loss_start and loss_stop (code points of text under the loss mask).

    Rows leave a task once `batch_chars` of text wait; that bounds memory and changes no row."""
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(_format(batch_chars), EXAMPLE)


def _new_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each example what is new in it, with digests of its context and of all its text."""
    schema = pa.schema([("conv_id", pa.int64()), ("example", pa.int32()), ("chars", pa.int64()), ("fresh", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("before", pa.binary()), ("after", pa.binary())])
    for batch in batches:
        for at in range(0, batch.num_rows, 100):
            rows = []
            for conv, example, context, text, start, stop in zip(*(batch.slice(at, 100).column(c).to_pylist() for c in _EXAMPLE.names), strict=True):
                fresh = text[context:]
                digest = hashlib.sha256(text[:context].encode("utf-8"))
                before = digest.digest()
                digest.update(fresh.encode("utf-8"))
                rows.append((conv, example, len(text), fresh, start - context, stop - context, before, digest.digest()))
            yield record(schema, [list(c) for c in zip(*rows, strict=True)])


_NEW = "conv_id long, example int, chars long, fresh string, start long, stop long, before binary, after binary"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    state: list | None = None
    now: object = object()

    def done() -> tuple:
        return now, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]

    for batch in batches:
        rows = []
        for conv, example, chars, fresh, start, stop, before, after in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if state is None or conv != now:
                if state is not None:
                    rows.append(done())
                now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, hashlib.sha256().digest(), -1]
            if example != state[6] + 1 or before != state[5]:
                raise ValueError(f"example {example} of {conv} does not continue the one before it")
            for role, body in turns_in(fresh):
                state[0] += 1
                state[1].update(f"{role}\n{body}\n".encode("utf-8", "surrogatepass"))
            target = unescape(fresh[start:stop])
            state[2] += len(target)
            state[3].update(target.encode("utf-8", "surrogatepass"))
            state[4] += chars
            state[5], state[6] = after, example
        if rows:
            yield record(schema, [list(c) for c in zip(*rows, strict=True)])
    if state is not None:
        yield record(schema, [[x] for x in done()])


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, from examples alone: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars (of all its examples).

    Every example must begin with the whole text of the one before it."""
    rows = formatted.mapInArrow(_new_parts, _NEW).repartition("conv_id").sortWithinPartitions("conv_id", "example")
    return rows.mapInArrow(_read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def full_texts(formatted: DataFrame) -> DataFrame:
    """The examples with all of their context, which they hold already."""
    return formatted


def round_trip(conversations: DataFrame, batch_chars: int = 1 << 24) -> DataFrame:
    return read_back(materialize(examples(conversations, batch_chars), "examples", _STORED))
