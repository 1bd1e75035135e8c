"""Joins on key columns where a null key equals a null key, so that no series is lost for lack of a name."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Like ``left.join(right, keys, how)`` for inner, left, semi and anti joins."""
    keys = list(keys)
    if not keys:
        return join_on(
            left.withColumn("_all", F.lit(0)), right.withColumn("_all", F.lit(0)), ["_all"], how
        ).drop("_all")
    renamed = right.withColumnsRenamed({k: f"_on_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_on_{k}")) for k in keys]
    joined = left.join(renamed, reduce(lambda a, b: a & b, same), how)
    return joined.drop(*[f"_on_{k}" for k in keys])
