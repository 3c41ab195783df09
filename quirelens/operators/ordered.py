"""One file from ordered pieces of text, written by all tasks.

Pieces are range-partitioned by their order; each task writes its own part, and tells its bytes.  Sums of
these are the parts' places in the file, at which tasks copy them (a file system of paths), or the file system joins the parts
itself.  The driver sees the parts' sizes alone; only where a file system can do neither does it pass bytes
on, a buffer at a time."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.files import delete, opened, qualified, remove, settle

_PART = pa.schema([("part", pa.int32()), ("bytes", pa.int64()), ("pieces", pa.int64())])


def _write_part(base: str):
    """The pieces of a partition as one file below base, whole or not at all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        size = pieces = 0
        out = None
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if out is None:
                    out = opened(f"{base}/{part:09d}")
                data = text.encode("utf-8", "surrogatepass")
                out.write(data)
                size += len(data)
                pieces += 1
        if out is not None:
            out.close()
            settle(out)
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([size]), pa.array([pieces])], schema=_PART)

    return run


def _copy_parts(base: str, target: str):
    """Parts to their places in a file that is there already."""

    def run(rows) -> None:
        for r in rows:
            with open(f"{base}/{r['part']:09d}", "rb") as source, open(target, "r+b") as out:
                out.seek(r["at"])
                while data := source.read(1 << 20):
                    out.write(data)

    return run


def write_ordered(pieces: DataFrame, order: list[Column | str], path: str, head: bytes = b"", text: str = "text") -> int:
    """The column `text` of pieces, one after the other in this order, as one file, after `head`.  Returns the number of pieces."""
    spark = pieces.sparkSession
    uri = qualified(spark, path)
    base = f"{uri}.parts"
    rows = pieces.filter(F.col(text).isNotNull()).repartitionByRange(*order).sortWithinPartitions(*order).select(F.col(text).cast("string"))
    parts = sorted((r["part"], r["bytes"], r["pieces"]) for r in rows.mapInArrow(_write_part(base), "part int, bytes long, pieces long").collect())  # a row a partition
    if uri.startswith("file:"):
        own = "/" + uri.removeprefix("file:").lstrip("/")
        os.makedirs(os.path.dirname(own), exist_ok=True)
        whole, at, placed = f"{own}.whole", len(head), []
        for part, size, _ in parts:
            placed.append((part, at))
            at += size
        with open(whole, "wb") as f:
            f.write(head)
            f.truncate(at)
        if placed:
            spark.createDataFrame(placed, "part int, at long").repartition(len(placed)).foreachPartition(_copy_parts("/" + base.removeprefix("file:").lstrip("/"), whole))
        os.replace(whole, own)
    else:
        _join(spark, uri, base, [p for p, _, _ in parts], head)
    remove(spark, base)
    return sum(n for _, _, n in parts)


def _join(spark, uri: str, base: str, parts: list[int], head: bytes) -> None:
    """Parts of another file system: joined by it, or, where it can't, passed on buffer by buffer."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    target = path(uri)
    system = target.getFileSystem(conf)
    delete(spark, uri)
    out = system.create(target, True)
    out.write(bytearray(head))
    names = [path(f"{base}/{p:09d}") for p in parts]
    try:
        out.close()
        if names:
            array = spark.sparkContext._gateway.new_array(path, len(names))
            for i, n in enumerate(names):
                array[i] = n
            system.concat(target, array)
    except Exception:  # noqa: BLE001  most file systems have no concat
        out = system.create(target, True)
        out.write(bytearray(head))
        for n in names:
            source = system.open(n)
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, 1 << 20, False)
            source.close()
        out.close()


def csv_line(columns: list[Column]) -> Column:
    """A line of CSV: fields with a comma, a quote or a line break in quotes."""

    def cell(c: Column) -> Column:
        own = F.coalesce(c.cast("string"), F.lit(""))
        return F.when(F.rlike(own, F.lit('[,"\r\n]')), F.concat(F.lit('"'), F.replace(own, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(own)

    return F.concat(F.concat_ws(",", *map(cell, columns)), F.lit("\r\n"))
