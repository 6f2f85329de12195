"""Class-balanced sampling with repetition where a class is short."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sample_images(counts: DataFrame, n: int, file: str = "image_id") -> DataFrame:
    """``n`` images per label, those with most labels (of all kinds) first, again from the first when there are fewer.

    Columns: label, pos (0 to n-1), file, duplicate. Each task sends the first ``n`` files of a label at most.
    """
    total = counts.groupBy(file).agg(F.sum("cnt").alias("total"))
    w = Window.partitionBy("label").orderBy(F.desc("total"), file)
    first = counts.join(total, file).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
    few = first.join(counts.groupBy("label").agg(F.count("*").alias("m")), "label")
    copies = F.sequence(F.col("rank") - 1, F.lit(n - 1), F.col("m"))
    return few.select("label", file, "m", F.explode(copies).alias("pos")).select("label", F.col("pos").cast("int").alias("pos"), file, (F.col("pos") >= F.col("m")).alias("duplicate"))


def sample_labels(counts: DataFrame, n: int, file: str = "image_id") -> DataFrame:
    """Images per label until its labels add up to ``n`` or more, again from the first when short: (label, pass, file, before)."""
    total = counts.groupBy(file).agg(F.sum("cnt").alias("total"))
    w = Window.partitionBy("label").orderBy(F.desc("total"), file)
    first = counts.join(total, file).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)  # a file has one label at least
    ranked = first.withColumn("before", F.coalesce(F.sum("cnt").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    ranked = ranked.filter(F.col("before") < n).join(counts.groupBy("label").agg(F.sum("cnt").alias("all")), "label")
    passes = ranked.withColumn("pass", F.explode(F.sequence(F.lit(0), (F.ceil(F.lit(n) / F.col("all")) - 1).cast("int"))))
    return passes.filter(F.col("pass") * F.col("all") + F.col("before") < n).select("label", "pass", file, (F.col("pass") * F.col("all") + F.col("before")).alias("before"))


def selection_totals(selected: DataFrame, file: str = "image_id") -> DataFrame:
    """Per label: rows, distinct files, repeats."""
    per = selected.groupBy("label").agg(F.count("*").alias("rows"), F.countDistinct(file).alias("files"))
    return per.withColumn("repeats", F.col("rows") - F.col("files"))
