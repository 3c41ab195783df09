"""Shared plumbing of the corpus operators: durable intermediate tables, Arrow mapping, skew-safe lookups."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or a local one where it is unset and Spark is local (tests)."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="quirelens-")
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def materialize(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """Cut the lineage with a Parquet table in the shared folder; lost executors cannot lose it."""
    path = f"{shared_dir(df.sparkSession)}/quirelens-{name}-{uuid.uuid4().hex}"
    df.write.options(**(options or {})).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written = path
    return out


def extend(table: DataFrame, df: DataFrame) -> None:
    """Appends rows to a table of `materialize`; who reads it afterwards reads its folder anew."""
    df.select(*table.columns).write.mode("append").parquet(table._written)


def forget(*tables: DataFrame) -> None:
    """Deletes tables of `materialize` that nothing reads any more."""
    for t in tables:
        jvm, conf = t.sparkSession._jvm, t.sparkSession._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(t._written)
        path.getFileSystem(conf).delete(path, True)


def release(spark: SparkSession) -> None:
    """What steps before have left goes now: garbage of the driver, and with it shuffle files and broadcasts that nothing refers to,
    which else stay until the driver happens to collect.  For steps of very many jobs, between these."""
    steady_memory()
    gc.collect()
    spark._jvm.System.gc()


def free_names(df: DataFrame, n: int) -> list[str]:
    """n column names that df does not have, whatever the case of its own."""
    have, out, k = {c.lower() for c in df.columns}, [], 0
    while len(out) < n:
        if f"_q{k}" not in have:
            out.append(f"_q{k}")
        k += 1
    return out


#: Most rows of an Arrow batch: of whole texts, the default of 10,000 is tens of megabytes on both sides of each worker.
BATCH_ROWS = 2000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of a directory.  Also holds the session's Arrow batches to BATCH_ROWS, whatever larger size was set."""
    if not 0 < int(spark.conf.get(_BATCH)) <= BATCH_ROWS:
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """Two longs that name a row by its content, nulls included, the same in every scan."""
    return [
        F.coalesce(F.col(doc_id).cast("long"), F.lit(0)).alias("key0"),
        F.xxhash64(F.col(doc_id), F.col(doc_id).isNull(), F.col(text), F.col(text).isNull()).alias("key1"),
    ]


def steady_memory() -> None:
    """Large arrays of a worker, Arrow's own included, go back to the system as soon as they are freed, so that neither one
    long text nor what an earlier stage held stays in the worker's size.  Where the C library has no such switch, nothing happens."""
    import ctypes

    try:
        libc = ctypes.CDLL(None)
        libc.mallopt(-3, 2 << 20)  # M_MMAP_THRESHOLD
        pa.set_memory_pool(pa.system_memory_pool())
        libc.malloc_trim(0)
    except (OSError, AttributeError):
        return


def blobs(column: pa.Array) -> Iterator[np.ndarray]:
    """Each value of a binary column as bytes (null: empty), without copying."""
    large = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    if not (large or pa.types.is_binary(column.type) or pa.types.is_string(column.type)):
        raise TypeError(f"binary expected, not {column.type}")
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return
    at = np.frombuffer(offsets, dtype=np.int64 if large else np.int32)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    valid = np.asarray(column.is_valid()) if column.null_count else None
    empty = raw[:0]
    for i in range(n):
        yield empty if valid is not None and not valid[i] else raw[at[i] : at[i + 1]]


def longs(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values).view(np.int64)


def record(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def hot_lookup(big: DataFrame, small: DataFrame, keys: list[str], count: str, hot_share: float = 0.001) -> DataFrame:
    """Left join of `big` with `small`, whose keys are unique and whose `count` says how many rows of
    `big` have them.  Keys with over `hot_share` of all rows (1/hot_share of them at most: that bounds
    the broadcast) are looked up without a shuffle, all others in a shuffled join."""
    total = small.agg(F.sum(count)).first()[0] or 0
    least = max(1000.0, total * hot_share)
    payload = [c for c in small.columns if c not in keys]
    h, c = free_names(big, 2)
    hot = small.filter(F.col(count) > least).select(*keys, F.struct(*payload).alias(h))
    cold = small.filter(F.col(count) <= least).select(*keys, F.struct(*payload).alias(c))
    marked = big.join(F.broadcast(hot), keys, "left")
    done = marked.filter(F.col(h).isNotNull()).withColumn(c, F.lit(None).cast(cold.schema[c].dataType))
    rest = marked.filter(F.col(h).isNull()).join(cold, keys, "left")
    both = done.unionByName(rest)
    return both.select(*big.columns, *[F.coalesce(f"{h}.{x}", f"{c}.{x}").alias(x) for x in payload])


_NO_UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def ascii_lower(col: Column) -> Column:
    """Lower-cases A-Z and nothing else; texts of ASCII alone take the fast way."""
    upper = "".join(chr(c) for c in range(65, 91))
    return F.when(F.octet_length(col) == F.length(col), F.lower(col)).otherwise(F.translate(col, upper, upper.lower()))
