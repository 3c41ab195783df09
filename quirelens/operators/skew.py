"""Joins with keys that very many rows share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread_join(big: DataFrame, small: DataFrame, keys: list[str], counts: DataFrame, count: str, share: float = 0.001) -> DataFrame:
    """Inner join of big with small on keys; counts (keys, count: how many rows of big have them) is a stored table.

    Keys with over `share` of all rows are dealt to several tasks: their rows of big by a hash of the row, their rows
    of small to each.  Which keys these are is broadcast: 1 / share of them at most."""
    total = counts.agg(F.sum(count)).first()[0] or 0
    each = max(1000, int(total * share))
    hot = counts.filter(F.col(count) > each).select(*keys, F.ceil(F.col(count) / each).cast("int").alias("_salts"))
    if not hot.limit(1).count():
        return big.join(small, keys)
    dealt = big.join(F.broadcast(hot), keys, "left").withColumn("_salt", F.coalesce(F.expr("pmod(xxhash64(*), _salts)"), F.lit(0)).cast("int")).drop("_salts")
    copies = small.join(F.broadcast(hot), keys, "left").withColumn("_salt", F.explode(F.expr("sequence(0, coalesce(_salts, 1) - 1)"))).drop("_salts")
    return dealt.join(copies, [*keys, "_salt"]).drop("_salt")
