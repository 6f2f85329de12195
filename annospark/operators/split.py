"""Train, validation and test splits at image level, and their statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annospark.operators.spread import by_range
from annospark.sources.shared import written

SPLITS = ("train", "val", "test")


def parse_ratio(text: str) -> tuple[float, float, float]:
    """"8:1:1" as shares that add up to 1."""
    try:
        parts = [float(p) for p in text.split(":")]
    except ValueError:
        raise ValueError(f"ratio is no numbers: {text}") from None
    if len(parts) != 3:
        raise ValueError(f"ratio needs three parts: {text}")
    if min(parts) < 0 or sum(parts) <= 0:
        raise ValueError(f"ratio must be positive: {text}")
    return tuple(p / sum(parts) for p in parts)


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``rank``, the place in their present order from 0 without gaps. ``rows`` is read twice and must give the same
    order again, as a stored table does. The driver gets one count per partition."""
    marked = rows.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
    sizes = {r["_part"]: r["count"] for r in marked.groupBy("_part").count().collect()}
    before, start = [], 0
    for part in sorted(sizes):
        before.append((part, start))
        start += sizes[part]
    starts = rows.sparkSession.createDataFrame(before, "_part int, _before long")
    place = F.col("_before") + (F.col("_at") - F.shiftleft(F.col("_part").cast("long"), 33))
    return marked.join(F.broadcast(starts), "_part").withColumn("rank", place).drop("_part", "_at", "_before")  # a row per partition


def global_rank(df: DataFrame, *order: str) -> DataFrame:
    """``df`` in this order with ``rank`` from 0 and no gap: a range sort, whose partitions are written once to the shared folder, and
    a rank in each. No task sees more than its range."""
    rows = by_range(df, *order)
    marked = written(rows.withColumns({"_p": F.spark_partition_id(), "_i": F.monotonically_increasing_id()}), "ranked")
    sizes = {r["_p"]: r["count"] for r in marked.groupBy("_p").count().collect()}
    starts, start = [], 0
    for part in sorted(sizes):
        starts.append((part, start - (part << 33)))
        start += sizes[part]
    offsets = df.sparkSession.createDataFrame(starts, "_p int, _before long")
    return marked.join(F.broadcast(offsets), "_p").withColumn("rank", F.col("_i") + F.col("_before")).drop("_p", "_i", "_before")  # a row per partition


def group_rank(df: DataFrame, group: list[str], *order: str) -> DataFrame:
    """``df`` with ``rank`` within each group, from 0, and ``n``, the group's size. All groups are sorted together by range, so that
    a group that holds a third of all rows is spread over tasks."""
    ranked = global_rank(df, *group, *order)
    first = ranked.groupBy(*group).agg(F.min("rank").alias("_first"), F.count("*").alias("n"))
    return ranked.join(first, group).withColumn("rank", F.col("rank") - F.col("_first")).drop("_first")


def running_weight(df: DataFrame, weight: str, *order: str) -> DataFrame:
    """``df`` in this order with ``before``, the sum of column ``weight`` (whole numbers) over all rows ahead: a range sort, written once
    to the shared folder, a running sum in each range, and one sum per range on the driver. No task sees more than its range."""
    rows = by_range(df, *order)
    marked = written(rows.withColumns({"_p": F.spark_partition_id(), "_i": F.monotonically_increasing_id()}), "weighed")
    sums = {r["_p"]: r["w"] for r in marked.groupBy("_p").agg(F.sum(weight).alias("w")).collect()}
    starts, start = [], 0
    for part in sorted(sums):
        starts.append((part, start))
        start += sums[part] or 0
    offsets = df.sparkSession.createDataFrame(starts, "_p int, _start long")
    ahead = F.sum(weight).over(Window.partitionBy("_p").orderBy("_i").rowsBetween(Window.unboundedPreceding, -1))
    found = marked.join(F.broadcast(offsets), "_p")  # a row per range
    return found.withColumn("before", F.col("_start") + F.coalesce(ahead, F.lit(0))).drop("_p", "_i", "_start")


def split_images(keys: DataFrame, ratio: str = "8:1:1", order: Column | None = None, key: str = "image_key") -> DataFrame:
    """(key, split) by position in the order of ``order`` (the key itself, a seeded hash, ...): the first floor(n * train), the next
    floor(n * val), the rest test; without a test share, the rest is val."""
    train, val, test = parse_ratio(ratio)
    ranked = global_rank(keys.select(key).distinct().withColumn("_o", F.col(key) if order is None else order), "_o", key)
    n = ranked.count()
    a, b = int(n * train), int(n * train) + int(n * val)
    name = F.when(F.col("rank") < a, "train").when((F.col("rank") < b) if test > 0 else F.lit(True), "val").otherwise("test")
    return ranked.select(key, name.alias("split"))


def stratified_split(labels: DataFrame, ratio: str = "8:1:1", order: Column | None = None, key: str = "image_key") -> DataFrame:
    """(key, stratum, split): each image goes with its scarcest label, and each stratum is split by itself.

    ``labels`` has (key, label). Strata under 9 images go to train. Otherwise train gets the first max(3, floor(n * train)), val
    and test the next max(1, floor(n * share)) if their share is above 0, and train the remainder.
    """
    train, val, test = parse_ratio(ratio)
    totals = labels.groupBy("label").agg(F.count("*").alias("total"))
    strata = labels.select(key, "label").join(totals, "label").groupBy(key).agg(F.min(F.struct("total", "label")).alias("s")).select(key, F.col("s.label").alias("stratum"))
    strata = strata.withColumn("_o", F.col(key) if order is None else order)
    rows = group_rank(strata, ["stratum"], "_o", key).withColumnRenamed("rank", "r")
    most = lambda share, least: F.greatest(F.lit(least), F.floor(F.col("n") * share)) if share > 0 else F.lit(0)
    a = F.greatest(F.lit(3), F.floor(F.col("n") * train))
    b = a + most(val, 1)
    c = b + most(test, 1)
    name = F.when(F.col("n") < 9, "train").when(F.col("r") < a, "train").when(F.col("r") < b, "val").when(F.col("r") < c, "test").otherwise("train")
    return rows.select(key, "stratum", name.alias("split"))


def split_stats(records: DataFrame) -> DataFrame:
    """Per split: records, distinct images, objects. With columns image_path and images, images are the distinct paths of both."""
    if "images" not in records.columns:
        return records.groupBy("split").agg(F.count("*").alias("records"), F.countDistinct("image_key").alias("images"), F.sum("num_objects").alias("objects"))
    rows = records.groupBy("split").agg(F.count("*").alias("records"), F.sum("num_objects").alias("objects"))
    paths = records.select("split", F.explode(F.array_union(F.array("image_path"), F.coalesce("images", F.array().cast("array<string>")))).alias("image"))
    images = paths.filter("image is not null").distinct().groupBy("split").agg(F.count("*").alias("images"))
    return rows.join(images, "split", "left").select("split", "records", F.coalesce("images", F.lit(0)).alias("images"), "objects")


def label_records(records: DataFrame) -> DataFrame:
    """(split, label, records): how many records of a split have a label."""
    return records.select("split", F.explode(F.array_distinct("labels")).alias("label")).groupBy("split", "label").agg(F.count("*").alias("records"))


def class_matrix(labels: DataFrame) -> DataFrame:
    """(label, train, val, test, total): objects of each class in each split."""
    n = [F.count_if(F.col("split") == s).alias(s) for s in SPLITS]
    return labels.groupBy("label").agg(*n, F.count("*").alias("total"))


def audit(matrix: DataFrame, ratio: str = "8:1:1") -> DataFrame:
    """(label, issue): a class missing in train, or in val or test with 9 objects or more, or a train share off by over 0.15."""
    train, val, test = parse_ratio(ratio)
    issues = F.array_compact(
        F.array(
            F.when(F.col("train") == 0, "missing_train"),
            F.when((F.col("val") == 0) & (F.col("total") >= 9) & F.lit(val > 0), "missing_val"),
            F.when((F.col("test") == 0) & (F.col("total") >= 9) & F.lit(test > 0), "missing_test"),
            F.when((F.col("total") >= 9) & (F.abs(F.col("train") / F.col("total") - train) > 0.15), "train_share"),
        )
    )
    return matrix.select("label", F.explode(issues).alias("issue"))
