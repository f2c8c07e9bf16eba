"""Bounded hash samples that stay whole at any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sample(rows: DataFrame, n: int, group: str, *keys: str) -> DataFrame:
    """``n`` expected rows of each value of ``group``, by the hash of ``keys``; all of a value with no more rows.

    The 64-bit hash is compared with a share of its whole range, which is above
    0 for any count. Only values with more than ``n`` rows need a threshold:
    fewer than count / n, so they are broadcast. A null group isn't sampled but lost.
    """
    many = rows.groupBy(group).agg(F.count("*").alias("c")).where(F.col("c") > n)
    many = many.select(F.col(group).alias("sampled"), ((F.lit(float(n)) / F.col("c") - 0.5) * 2.0**64).alias("below"))
    met = rows.where(F.col(group).isNotNull()).join(F.broadcast(many), F.col(group) == F.col("sampled"), "left")
    return met.where(F.col("below").isNull() | (F.xxhash64(*keys).cast("double") < F.col("below"))).select(*rows.columns)


def in_share(*keys: str, share: float) -> Column:
    """True for about ``share`` of the rows, by the hash of ``keys``; for all, if it is 1 or more."""
    return F.lit(True) if share >= 1 else F.xxhash64(*keys).cast("double") < (share - 0.5) * 2.0**64
