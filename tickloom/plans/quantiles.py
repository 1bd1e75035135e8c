"""Exact quantiles without gathering a group into one task.

The built-in exact percentile keeps every distinct value of a group in one buffer. Here the
values are counted per (series, value), ranked through a chunked running total, and only the
two rows around each wanted rank survive.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.plans.chunked import CHUNK, running_sums
from tickloom.plans.joins import join_on

# Distinct whole numbers per chunk: the bound on one window partition.
VALUES_PER_CHUNK = 65_536


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, wanted: dict[str, float]
) -> DataFrame:
    """Linear-interpolated quantiles of a BIGINT column, one row per series."""
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn(CHUNK, F.floor(F.col(value) / F.lit(VALUES_PER_CHUNK)))
    )
    sizes = counts.groupBy(*keys).agg(F.sum("_n").alias("_size"))
    ranked = join_on(running_sums(counts, keys, [value], {"_upto": F.col("_n")}), sizes, keys)
    aggregates = []
    for name, share in wanted.items():
        place = F.lit(share) * (F.col("_size") - 1)
        for side, rank in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            holds = (F.col("_upto") > rank) & (F.col("_upto") - F.col("_n") <= rank)
            aggregates.append(F.max(F.when(holds, F.col(value))).alias(f"_{side}_{name}"))
        aggregates.append(F.max(place - F.floor(place)).alias(f"_part_{name}"))
    bounds = ranked.groupBy(*keys).agg(*aggregates)
    return bounds.select(
        *keys,
        *[
            (
                F.col(f"_lo_{n}")
                + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_part_{n}")
            ).alias(n)
            for n in wanted
        ],
    )
