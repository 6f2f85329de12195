"""Names that don't collide when files of many folders land in one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annospark.operators.split import group_rank

#: An extension: the last dot and what follows, unless nothing stands before the dot.
_EXT = r"(?<=[^/])(\.[^./]+)$"


def extension(name: Column) -> Column:
    return F.regexp_extract(name, _EXT, 1)


def numbered_name(name: Column, number: Column) -> Column:
    """``a/b.txt`` and 2 as ``a/b_2.txt``."""
    return F.concat(F.regexp_replace(name, _EXT, ""), F.lit("_"), number.cast("string"), extension(name))


def free_names(rows: DataFrame, name: str, *order: str, taken: DataFrame | None = None, target: str = "target") -> DataFrame:
    """``rows`` with a ``target`` of its own for each, made from column ``name``.

    The first row of a name, by ``order``, keeps it, unless ``taken`` (a table with a column of that name) has it. The others get ``_1``,
    ``_2``, ... before the extension, in that order, without the numbers for which that name is itself another row's name or taken. So no
    two targets are equal: a numbered target has one root and number, and it is nobody's own name. A null name stays null.

    Names are ranked together by range sorts, so a name that a third of all rows share is spread over tasks: rows by name; the
    numbers that stand in names, by root; and both merged, since the j-th row of a root that needs a number comes after the taken
    numbers k_1 < k_2 < ... with k_i - i < j, and its place in that order is its number.
    """
    ranked = group_rank(rows.filter(F.col(name).isNotNull()).withColumn("_name", F.col(name)), ["_name"], *order).drop("n")
    there = F.lit(False)
    own = ranked.filter("rank = 0").select("_name")
    if taken is not None:
        held = taken.select(F.col(name).alias("_name")).filter("_name is not null").distinct()
        own = own.unionAll(held).distinct()
        ranked = ranked.join(held.withColumn("_there", F.lit(True)), "_name", "left")
        there = F.coalesce("_there", F.lit(False))
    first = (F.col("rank") == 0) & ~there
    later = ranked.filter(~first).withColumn("_at", F.col("rank") + F.when(there, 1).otherwise(0)).drop("rank", "_there")
    stem = F.regexp_replace("_name", _EXT, "")
    number = F.regexp_extract(stem, r"_([1-9][0-9]{0,17})$", 1)
    parsed = own.select(F.concat(F.regexp_replace(stem, r"_[1-9][0-9]{0,17}$", ""), extension(F.col("_name"))).alias("_name"), number.alias("k")).filter("k <> ''")
    used = group_rank(parsed.select("_name", F.col("k").cast("long").alias("k")).join(later.select("_name").distinct(), "_name", "left_semi"), ["_name"], "k")
    slots = used.select("_name", (F.col("k") - F.col("rank")).alias("_at"), F.lit(0).alias("_kind"))
    both = group_rank(later.withColumn("_kind", F.lit(1)).unionByName(slots, allowMissingColumns=True), ["_name"], "_at", "_kind").filter("_kind = 1")
    kept = ranked.filter(first).withColumn(target, F.col(name)).drop("rank", "_there", "_name")
    moved = both.withColumn(target, numbered_name(F.col("_name"), F.col("rank") + 1)).drop("rank", "n", "_at", "_kind", "_name")
    none = rows.filter(F.col(name).isNull()).withColumn(target, F.lit(None).cast("string"))
    return kept.unionByName(moved).unionByName(none)
