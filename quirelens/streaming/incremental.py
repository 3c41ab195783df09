"""Incremental annotation as a stream over a directory: each run takes the files that came since the last.

Every batch is a folder of its own, written whole, and counts once a file of the manifest names it.  A batch that is
repeated after a failure has the same number, so it is written over what was left of it; readers go by the manifest, so
they see a batch whole or not at all, and never twice."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sources.files import exists, qualified, write_bytes

FILES = "path string, modificationTime timestamp, length bigint, content binary"
MANIFEST = "_batches"


def commit(spark: SparkSession, target: str, name: str) -> None:
    write_bytes(qualified(spark, f"{target}/{MANIFEST}/{name.replace('/', '-')}"), name.encode())


def batches(spark: SparkSession, target: str) -> list[str]:
    """Folders below target that the manifest names, in order."""
    if not exists(spark, f"{target}/{MANIFEST}"):
        return []
    return sorted(r["value"] for r in spark.read.text(f"{target}/{MANIFEST}").distinct().collect())


def committed(spark: SparkSession, target: str, schema) -> DataFrame:
    """All rows of committed batches, whatever else lies below target."""
    names = batches(spark, target)
    return spark.read.schema(schema).json([f"{target}/{n}" for n in names]) if names else spark.createDataFrame([], schema)


def write_batches(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], target: str, checkpoint: str) -> StreamingQuery:
    """Runs transform over what a stream has now, batch by batch, into committed folders of JSON; the checkpoint remembers what is done."""

    def put(df: DataFrame, epoch: int) -> None:
        spark = df.sparkSession
        own = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]  # another checkpoint is another stream, with numbers of its own
        name = f"stream={own}/batch={epoch:09d}"
        transform(df).write.mode("overwrite").json(f"{target}/{name}")
        commit(spark, target, name)

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def annotate_new(spark: SparkSession, root: str, transform: Callable[[DataFrame], DataFrame], target: str, checkpoint: str, max_files: int = 1000) -> StreamingQuery:
    """Runs transform over the files below root that came since the last run; read the results with `committed`."""
    files = spark.readStream.format("binaryFile").schema(FILES).option("recursiveFileLookup", True).option("maxFilesPerTrigger", max_files).load(root)
    return write_batches(files, transform, target, checkpoint)


def annotate_rows(spark: SparkSession, source: str, transform: Callable[[DataFrame], DataFrame], schema, target: str, checkpoint: str) -> DataFrame:
    """Runs transform over the new files of a Parquet table, one at a time, and returns all rows that are committed by then."""
    # a pattern, for a table may also be one file
    rows = spark.readStream.schema(spark.read.parquet(source).schema).option("maxFilesPerTrigger", 1).parquet(f"{source[:-1]}[{source[-1]}]")
    write_batches(rows, transform, target, checkpoint).awaitTermination()
    return committed(spark, target, schema)
