"""Partitions whose number grows with the input, so that what a task holds doesn't."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of the largest table read that a partition stands for, about, and partitions at most.
EACH, MOST = 4 << 20, 20_000


def partitions(rows: DataFrame) -> int:
    """Partitions for what ``rows`` reads: one per ``EACH`` bytes of its largest table (so that frames over the same table agree), and
    the session's number at least."""
    leaves = rows._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    known = [s for s in sizes if s < 1 << 60]
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(MOST, -(-max(known, default=0) // EACH)))


def spread(rows: DataFrame, *keys: Column | str) -> DataFrame:
    """``rows`` by hash of ``keys``, in more partitions than the session's if the input wants that; else as they are."""
    n = partitions(rows)
    return rows.repartition(n, *keys) if n > int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) else rows


def small(rows: DataFrame) -> bool:
    """Whether Spark will broadcast ``rows`` in a join."""
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size <= int(rows.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def spread_for_join(rows: DataFrame, other: DataFrame, *keys: Column | str) -> DataFrame:
    """``spread`` unless Spark will broadcast ``other``, to which ``rows`` are joined by ``keys``."""
    return rows if small(other) else spread(rows, *keys)


def by_range(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` in ranges of this order, each sorted, in as many partitions as the input wants."""
    n = partitions(rows)
    more = [n] if n > int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) else []
    return rows.repartitionByRange(*more, *[F.col(c) for c in order]).sortWithinPartitions(*order)


def once(rows: DataFrame, **columns: Column) -> DataFrame:
    """``rows`` with these columns, each computed once: what is built on them above (filters, other columns) doesn't repeat their work."""
    kept = [c for c in rows.columns if c not in columns]
    return rows.select(*kept, F.inline(F.array(F.struct(*[value.alias(name) for name, value in columns.items()]))))
