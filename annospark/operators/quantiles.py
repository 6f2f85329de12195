"""Exact order statistics per group, without a group in one task."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annospark.operators.split import running_weight


def elements(rows: DataFrame, keys: list[str], value: str, positions: dict[str, Column]) -> DataFrame:
    """(keys, n, a column per position) of each group: the elements at these places, from 0, of its sorted values. Positions are columns over
    ``n``, the group's number of values; nulls don't count, and a group without values has no row. A place outside gives null.

    Equal values are folded before all groups are sorted together by range; sums of the counts ahead tell which value holds a place.
    """
    counted = rows.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    placed = running_weight(counted, "_n", *keys, value)
    groups = placed.groupBy(*keys).agg(F.min("before").alias("_first"), F.sum("_n").alias("n"))
    same = functools.reduce(Column.__and__, [F.col(f"g.{k}").eqNullSafe(F.col(f"p.{k}")) for k in keys]) if keys else F.lit(True)
    both = placed.alias("p").join(groups.alias("g"), same) if keys else placed.alias("p").withColumn("_k", F.lit(0)).join(groups.withColumn("_k", F.lit(0)).alias("g"), "_k")
    low = F.col("before") - F.col("_first")
    wanted = {name: (low <= at) & (at < low + F.col("_n")) for name, at in positions.items()}
    found = both.filter(functools.reduce(Column.__or__, [*wanted.values(), low == 0]))
    return found.groupBy(*[F.col(f"p.{k}").alias(k) for k in keys]).agg(F.max("n").alias("n"), *[F.max(F.when(c, F.col(value))).alias(name) for name, c in wanted.items()])


def quantiles(rows: DataFrame, keys: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """(keys, n, a column per share): quantiles between the elements around share * (n - 1), as ``percentile`` has them."""
    at = {k: F.lit(float(q)) * (F.col("n") - 1) for k, q in shares.items()}
    ends = {f"_{k}_{side}": f(p).cast("long") for k, p in at.items() for side, f in (("low", F.floor), ("high", F.ceil))}
    found = elements(rows, keys, value, ends)
    between = lambda k: F.col(f"_{k}_low") + (F.col(f"_{k}_high") - F.col(f"_{k}_low")) * (at[k] - F.floor(at[k]))
    return found.select(*keys, "n", *[between(k).alias(k) for k in shares])
