"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The row with the greatest ``order`` values per key, NULLs ranking last.

    ``order`` has to be total within a key for the result not to depend on arrival. The row-number filter is what lets
    Spark place a group limit before the shuffle, so a key holding a third of all rows sends one row per map task.
    """
    ranked = [(F.col(c) if isinstance(c, str) else c).desc_nulls_last() for c in order]
    return _first(df, keys, ranked)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The row with the least ``order`` values per key, NULLs ranking last."""
    ranked = [(F.col(c) if isinstance(c, str) else c).asc_nulls_last() for c in order]
    return _first(df, keys, ranked)


def keep_top(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, position: str) -> DataFrame:
    """The ``k`` best rows per key with their 1-based rank in ``position``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(position, F.row_number().over(w)).where(F.col(position) <= k)


def _first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return keep_top(df, keys, order, 1, "_rn").drop("_rn")


def representative(df: DataFrame, key: str | Sequence[str], attributes: Sequence[str], any_true: Sequence[str] = ()) -> DataFrame:
    """One row per non-null key with ``max`` of each attribute and ``bool_or`` of each flag.

    Rows are first counted per distinct combination, an aggregate whose buffer is a number and so stays in the hash path; the
    maxima of texts, which Spark takes by sorting, then see the few combinations only.
    """
    keys = [key] if isinstance(key, str) else list(key)
    present = df.where(F.col(keys[0]).isNotNull())
    combined = present.groupBy(*keys, *[c for c in [*attributes, *any_true] if c not in keys]).agg(F.count(F.lit(1)).alias("_n"))
    aggs = [F.max(c).alias(c) for c in attributes] + [F.bool_or(c).alias(c) for c in any_true]
    return combined.groupBy(*keys).agg(*aggs, F.sum("_n").alias("_n")).where(F.col("_n") > 0).drop("_n")
