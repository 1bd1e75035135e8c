"""Keep one row per key, first or last by an explicit order.

``row_number() = 1`` lets Spark keep at most one candidate per key and map task before the
shuffle, so a key with very many copies never travels whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_one(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: str = "first"
) -> DataFrame:
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    ordering = [F.col(c).asc() if keep == "first" else F.col(c).desc() for c in order]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*ordering))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def others(df: DataFrame, keys: Sequence[str]) -> list[str]:
    """All columns but the keys: an order that leaves no tie between rows that differ."""
    return [c for c in df.columns if c not in keys] or list(keys)
