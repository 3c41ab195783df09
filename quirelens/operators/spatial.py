"""Boxes covered by other boxes of one page, by cells instead of pairs of all boxes.

A box that covers more than a share of another holds one of the other's probe points: with k points a side, evenly
laid, any run of over 1 / (k + 1) of the side has one in it, so for a half the middle is enough.  Covering boxes
lie in cells of a grid as wide as themselves, of which each touches four at most; grids are of widths that are powers of two,
and a probe point is looked up in its cell of every grid in use.  So a page with very many boxes is many keys, and no
box, however large, lies in many cells."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import overlap


def _side(level: Column) -> Column:
    return F.pow(F.lit(2.0), level)


def covered(boxes: DataFrame, covers: DataFrame, keys: list[str], most: float = 0.5) -> DataFrame:
    """Distinct (keys, bbox) of boxes of which one of covers with the same keys covers more than `most`.

    Null, empty and inside-out boxes neither cover nor are covered."""
    if not 0 < most < 1:
        raise ValueError("most must lie between 0 and 1")
    b = F.col("bbox")
    real = (F.size(b) == 4) & (b[2] > b[0]) & (b[3] > b[1])
    grid = covers.filter(real).select(*keys, F.col("bbox").alias("_c")).distinct()
    c = F.col("_c")
    grid = grid.withColumn("_level", F.ceil(F.log2(F.greatest(c[2] - c[0], c[3] - c[1]))).cast("int"))
    near = 1e-9  # of a cell: points at a box's very edge

    def cells(low: int) -> Column:
        side = _side(F.col("_level"))
        return F.sequence(F.floor(c[low] / side - near), F.floor(c[low + 2] / side + near))

    grid = grid.withColumn("_x", F.explode(cells(0))).withColumn("_y", F.explode(cells(1)))
    levels = grid.agg(F.collect_set("_level").alias("_levels"))  # one row: the widths in use, as many as numbers have exponents
    points = math.ceil(1 / most - 1e-9) - 1
    steps = F.array(*[F.lit((i + 1) / (points + 1)) for i in range(points)])
    probes = boxes.filter(real).select(*keys, "bbox").distinct().crossJoin(F.broadcast(levels)).withColumn("_level", F.explode("_levels")).drop("_levels")
    probes = probes.withColumn("_u", F.explode(steps)).withColumn("_v", F.explode(steps))
    side = _side(F.col("_level"))
    probes = probes.select(*keys, "bbox", "_level", F.floor((b[0] + (b[2] - b[0]) * F.col("_u")) / side).alias("_x"), F.floor((b[1] + (b[3] - b[1]) * F.col("_v")) / side).alias("_y"))
    met = probes.join(grid, [*keys, "_level", "_x", "_y"]).filter(overlap(b, c) > most)
    return met.select(*keys, "bbox").distinct()
