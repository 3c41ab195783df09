"""Rows of given ranks inside groups of any size, without sorting the groups."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows that a cell of the largest group has, about.
CELL_ROWS = 4096
HASH_BITS = 60


def by_rank(rows: DataFrame, wanted: DataFrame, keys: list[str], hash_: str, ties: list[str]) -> DataFrame:
    """rows whose rank r (from 1, by the 60-bit `hash_`, then ties) inside their keys is in wanted (keys, r), with r.

    The hash's first bits make cells; a histogram of rows by keys and cell tells in which cell a wanted rank is and how many
    rows stand before it, and only rows of those cells are moved and ranked."""
    n = rows.count()
    bits = min(24, max(0, math.ceil(math.log2(max(1, n / CELL_ROWS)))))
    own = rows.withColumn("_cell", F.shiftright(F.col(hash_), HASH_BITS - bits) if bits else F.lit(0).cast("long"))
    part = ", ".join(keys)
    cells = own.groupBy(*keys, "_cell").agg(F.count("*").alias("_n"))
    cells = cells.withColumn("_before", F.expr(f"coalesce(sum(_n) over (partition by {part} order by _cell rows between unbounded preceding and 1 preceding), 0)"))
    asked = wanted.select(*keys, "r").distinct()
    # ranks and beginnings of cells in one order: a rank's cell is the last that began before it
    line = cells.select(*keys, F.col("_before").alias("_at"), F.lit(0).alias("_kind"), F.lit(None).cast("long").alias("r"), F.struct("_cell", "_before").alias("_c"))
    line = line.unionByName(asked.select(*keys, (F.col("r") - 1).cast("long").alias("_at"), F.lit(1).alias("_kind"), F.col("r").cast("long").alias("r"), F.lit(None).cast(line.schema["_c"].dataType).alias("_c")))
    placed = line.withColumn("_c", F.expr(f"last(_c, true) over (partition by {part} order by _at, _kind rows between unbounded preceding and current row)")).filter("_kind = 1")
    wanted_cells = placed.select(*keys, "_c._cell", "_c._before").distinct()
    near = own.join(wanted_cells, [*keys, "_cell"])
    ranked = near.withColumn("r", F.expr(f"_before + row_number() over (partition by {part}, _cell order by {hash_}, {', '.join(ties)})"))
    return ranked.join(asked.withColumn("r", F.col("r").cast("long")), [*keys, "r"]).drop("_cell", "_before")
