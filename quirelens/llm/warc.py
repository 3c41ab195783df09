"""WARC archives: index first, then coalesced byte-range reads of the selected records.

Writing gives one index row per record (file, offset, length, url, digest, type); every record is a
gzip member of its own, so any byte range that starts at an offset can be read alone.  A retried
task writes another file: only files in the written index count.  Reading sorts the selected index
rows by file and offset, merges neighbours with small gaps into ranges of bounded size, and reads
each range with one request through pyarrow's file systems (file, hdfs, s3, gs by URI).

Of records with equal payloads, the one with the largest id holds the payload (response), the others
revisit it.  Null html: an empty payload.  Null urls: no target URI.  Urls that a header cannot hold
as they are (line ends, blanks at their ends) come back whole from a header of our own.  Null ids
take part as the smallest.  Rows that repeat the largest id (ties) are all responses.  Very long
pages: a record of its own range.  An empty table: no files, no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blobs, hot_lookup, materialize, record, shared_dir

# Fixed by the format.
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_FORM = "<urn:quirelens:record:{}>"
#: Header of our own for urls that a target URI cannot hold: base64 of their UTF-8.
WHOLE_URL = "X-Whole-URL"

INDEX = "file string, offset long, length long, record_id long, url string, digest string, record_type string"
_INDEX = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("record_id", pa.int64()), ("url", pa.string()), ("digest", pa.string()), ("record_type", pa.string())])


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def encode_record(record_id: int | None, url: str | None, payload: bytes, refers_to: int | None, digest: str, date: str) -> bytes:
    """One WARC record (not compressed): a response, or a revisit if refers_to is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if refers_to is not None else http + payload
    name = "null" if record_id is None else record_id
    uri = re.sub(r"[\r\n]", "", url or "").strip()
    head = [
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {ID_FORM.format(name)}",
        f"WARC-Date: {date}",
        *([f"WARC-Target-URI: {uri}"] if url is not None else []),
        *([f"{WHOLE_URL}: {base64.b64encode(url.encode('utf-8', 'surrogatepass')).decode()}"] if url is not None and uri != url else []),
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {ID_FORM.format(refers_to)}"]
    return VERSION + "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + body + b"\r\n\r\n"


def decode_record(raw: bytes) -> dict:
    """Headers (by lower-cased name), payload (None for revisits) and payload_bytes of one record."""
    if not raw.startswith(b"WARC/1."):
        raise ValueError("not a WARC record")
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = {k.strip().lower().decode(): v.strip().decode("utf-8", "surrogatepass") for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")[1:])}
    body = rest[: int(fields["content-length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    inner = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in http.split(b"\r\n")[1:])}
    size = int(inner[b"content-length"])
    if fields["warc-type"] == "response" and (len(payload) != size or f"sha1:{digest_of(payload)}" != fields["warc-payload-digest"]):
        raise ValueError(f"record {fields['warc-record-id']} is damaged")
    return {"fields": fields, "payload": payload if fields["warc-type"] == "response" else None, "payload_bytes": size}


def url_of(fields: dict[str, str]) -> str | None:
    whole = fields.get(WHOLE_URL.lower())
    return fields.get("warc-target-uri") if whole is None else base64.b64decode(whole).decode("utf-8", "surrogatepass")


def _id(urn: str | None) -> int | None:
    name = (urn or "").rpartition(":")[2].rstrip(">")
    return int(name) if name and name != "null" else None


def _filesystem(uri: str):
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri if "://" in uri else uri.replace("file:", "file://", 1))


def _writer(folder: str, max_bytes: int, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _filesystem(folder)
        out, name, at = None, None, 0
        try:
            for batch in batches:
                rows: list[tuple] = []
                ids, urls, refs, shas = (batch.column(c).to_pylist() for c in ("id", "url", "refers_to", "sha"))
                digests = [base64.b32encode(bytes.fromhex(x)).decode() for x in shas]
                for i, data in enumerate(blobs(batch.column("payload"))):
                    raw = gzip.compress(encode_record(ids[i], urls[i], data.tobytes(), refs[i], digests[i], date), 6, mtime=0)
                    if out is None or at + len(raw) > max_bytes:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = system.open_output_stream(f"{path}/{name}", compression=None)
                    out.write(raw)
                    rows.append((name, at, len(raw), ids[i], urls[i], digests[i], "response" if refs[i] is None else "revisit"))
                    at += len(raw)
                if rows:
                    yield record(_INDEX, [list(c) for c in zip(*rows, strict=True)])
        finally:
            if out is not None:
                out.close()

    return run


def write_archives(pages: DataFrame, folder: str, min_payload: int = 0, max_bytes: int = 1 << 28, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Writes a record per row of pages (page_id, url, html) under folder; returns the index, itself a written table.

    Payloads of fewer than min_payload bytes are always responses."""
    spark = pages.sparkSession
    system, path = _filesystem(folder)
    system.create_dir(path, recursive=True)
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    thin = pages.select(F.col("page_id").cast("long").alias("id"), payload.alias("payload")).select("id", F.sha1("payload").alias("sha"), F.octet_length("payload").alias("size"))
    groups = thin.filter(F.col("size") >= min_payload).groupBy("sha").agg(F.max("id").alias("holder"), F.count("*").alias("k"))
    groups = materialize(groups.filter("k > 1"), "payloads")
    rows = pages.select(F.col("page_id").cast("long").alias("id"), F.col("url").cast("string").alias("url"), payload.alias("payload")).withColumn("sha", F.sha1("payload"))
    rows = hot_lookup(rows, groups, ["sha"], "k")
    refers = F.when(~F.col("id").eqNullSafe(F.col("holder")), F.col("holder"))
    rows = rows.select("id", "url", "payload", refers.alias("refers_to"), "sha")
    index = rows.mapInArrow(_writer(folder, max_bytes, date), INDEX)
    at = f"{shared_dir(spark)}/quirelens-index-{uuid.uuid4().hex}"
    index.write.parquet(at)
    return spark.read.schema(INDEX).parquet(at)


def ranges(index: DataFrame, max_range: int = 8 << 20, max_gap: int = 1 << 16) -> DataFrame:
    """Selected records, neighbours merged: file, start, stop, records (offset and length each, sorted)."""
    order = "partition by file order by offset"
    far = F.expr(f"offset - lag(offset + length) over ({order}) > {max_gap}")
    rows = index.select("file", "offset", "length").withColumn("jump", F.coalesce(far, F.lit(False)).cast("int"))
    rows = rows.withColumn("island", F.expr(f"sum(jump) over ({order})")).withColumn("base", F.expr("min(offset) over (partition by file, island)"))
    part = F.expr(f"(offset - base) div {max_range}")
    return rows.groupBy("file", "island", part.alias("part")).agg(F.min("offset").alias("start"), F.max(F.col("offset") + F.col("length")).alias("stop"), F.array_sort(F.collect_list(F.struct("offset", "length"))).alias("records")).select("file", "start", "stop", "records")


RECORD = "record_id long, url string, digest string, record_type string, refers_to long, payload_bytes long, payload binary"
_RECORD = pa.schema([("record_id", pa.int64()), ("url", pa.string()), ("digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])


def _reader(folder: str, with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _filesystem(folder)
        for batch in batches:
            for file, start, stop, records in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "stop", "records")), strict=True):
                with system.open_input_file(f"{path}/{file}") as source:
                    block = source.read_at(stop - start, start)
                rows = []
                for r in records:
                    raw = block[r["offset"] - start : r["offset"] - start + r["length"]]
                    x = decode_record(zlib.decompress(raw, 31))
                    f = x["fields"]
                    rows.append((_id(f["warc-record-id"]), url_of(f), f["warc-payload-digest"].removeprefix("sha1:"), f["warc-type"], _id(f.get("warc-refers-to")), x["payload_bytes"], x["payload"] if with_payload else None))
                yield record(_RECORD, [list(c) for c in zip(*rows, strict=True)])

    return run


def reading_tasks(size: int, cores: int, range_bytes: int = 8 << 20, task_bytes: int = 128 << 20) -> int:
    """Tasks for `size` bytes of compressed records: enough for all cores, of `task_bytes` at most.  A count given to
    repartition is not merged at run time, as tiny range rows would be, which say nothing of the bytes behind them."""
    return max(1, -(-size // task_bytes), min(-(-size // range_bytes), 2 * cores))


def read_records(spark: SparkSession, folder: str, index: DataFrame, with_payload: bool = True, **how) -> DataFrame:
    """The records of the (selected) index rows, read by merged byte ranges; as many tasks as their bytes ask for."""
    size = index.agg(F.sum("length")).first()[0] or 0
    return ranges(index, **how).repartition(reading_tasks(size, spark.sparkContext.defaultParallelism), "file", "start").mapInArrow(_reader(folder, with_payload), RECORD)


def round_trip(pages: DataFrame, min_payload: int = 0) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, url of every record read back."""
    spark = pages.sparkSession
    folder = f"{shared_dir(spark)}/quirelens-warc-{uuid.uuid4().hex}"
    index = write_archives(pages, folder, min_payload)
    back = read_records(spark, folder, index, with_payload=False)
    return back.select(F.col("record_id").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to", "url")
