"""Detection scoring, model comparison and analysis of metric differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annospark.functions import overlaps
from annospark.operators.quantiles import quantiles
from annospark.operators.validate import normalized_label

METRICS = ("precision", "recall", "f1", "num_det", "num_gt", "num_match", "mean_match_iou")
SPLITS = ("train", "valid", "test")


def greedy_match(dets: Column, gts: Column, threshold: float = 0.5, same_label: bool = True) -> Column:
    """IoUs of matched pairs: each detection in turn takes the free ground-truth box with the largest IoU, of at least
    ``threshold``; of equal ones the first. dets and gts: array<struct<bbox, label>>; null counts as empty. Only boxes that share an area
    are looked at (``overlaps``), so an image of n boxes costs about n log n and its overlaps."""
    return overlaps.greedy_ious(_side(dets), _side(gts), threshold, same_label)


def _side(boxes: Column, *more: str) -> Column:
    return F.transform(boxes, lambda b: F.struct(b["bbox"].alias("bbox"), normalized_label(b["label"]).alias("label"), *[b[c].alias(c) for c in more]))


def sample_metrics(samples: DataFrame, threshold: float = 0.5, dialect: str = "distributed") -> DataFrame:
    """``samples`` (keys, dets, gts) with precision, recall, f1, num_det, num_gt, num_match, mean_match_iou and det_success.

    Dialects: ``distributed`` matches equal labels and gives precision 0 without detections; ``notebook`` matches any label
    and gives 1. Without ground truth and detections all are 1; with detections only, precision 0, recall 1, F1 0.
    """
    _known(dialect)
    rows = samples.withColumn("_m", greedy_match(F.col("dets"), F.col("gts"), threshold, dialect == "distributed"))
    return _scored(rows.withColumns({"num_det": F.size("dets"), "num_gt": F.size("gts")}).drop("dets", "gts"), dialect)


def _known(dialect: str) -> None:
    if dialect not in ("distributed", "notebook"):
        raise ValueError(f"unknown dialect: {dialect}")


def _scored(rows: DataFrame, dialect: str) -> DataFrame:
    """Metrics of num_det, num_gt and the IoUs ``_m`` of matched pairs."""
    none = F.lit(1.0 if dialect == "notebook" else 0.0)
    rows = rows.withColumn("num_match", F.size("_m"))
    d, n, k = F.col("num_det"), F.col("num_gt"), F.col("num_match")
    precision = F.when((n == 0) & (d == 0), 1.0).when(n == 0, 0.0).when(d == 0, none).otherwise(k / d)
    recall = F.when(n == 0, 1.0).otherwise(k / n)
    rows = rows.withColumns({"precision": precision, "recall": recall})
    p, r = F.col("precision"), F.col("recall")
    f1 = F.when((n == 0) & (d > 0), 0.0).when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0)
    mean = F.when(k > 0, F.aggregate("_m", F.lit(0.0), lambda a, x: a + x) / k).otherwise(F.when((n == 0) & (d == 0), 1.0).otherwise(0.0))
    return rows.withColumns({"f1": f1, "mean_match_iou": mean}).withColumn("det_success", F.when(n == 0, d == 0).otherwise(k > 0)).drop("_m")


def aggregate_metrics(metrics: DataFrame, *keys: str) -> DataFrame:
    """Mean and population deviation of each metric, samples and success rate per group."""
    aggs = [f(m).alias(f"{m}_{name}") for m in METRICS for f, name in ((F.avg, "mean"), (F.stddev_pop, "std"))]
    return metrics.groupBy(*keys).agg(*[F.round(a, 6).alias(n) for a, n in zip(aggs, [f"{m}_{s}" for m in METRICS for s in ("mean", "std")])], F.count("*").alias("samples"), F.round(F.avg(F.col("det_success").cast("double")), 6).alias("success_rate"))


def threshold_sweep(samples: DataFrame, thresholds=(0.5, 0.7, 0.85, 0.95)) -> DataFrame:
    """``samples`` once per confidence threshold, with the detections that reach it (missing confidence counts as 0)."""
    rows = samples.withColumn("threshold", F.explode(F.array(*[F.lit(float(t)) for t in thresholds])))
    return rows.withColumn("dets", F.filter("dets", lambda d: F.coalesce(d["confidence"], F.lit(0.0)) >= F.col("threshold")))


def sweep_metrics(samples: DataFrame, thresholds=(0.5, 0.7, 0.85, 0.95), threshold: float = 0.5, dialect: str = "distributed") -> DataFrame:
    """``sample_metrics`` of ``threshold_sweep``: each sample once per confidence threshold, but its boxes are compared once."""
    _known(dialect)
    found = overlaps.sweep_ious(_side(F.col("dets"), "confidence"), _side(F.col("gts")), tuple(float(t) for t in thresholds), threshold, dialect == "distributed")
    rows = samples.withColumns({"_s": found, "num_gt": F.size("gts"), "_d": F.col("dets").isNotNull()}).drop("dets", "gts")
    rows = rows.select("*", F.inline("_s")).withColumn("num_det", F.when(F.col("_d"), F.col("num_det"))).withColumnRenamed("ious", "_m")
    return _scored(rows.drop("_s", "_d"), dialect)


def cross_iou(pairs: DataFrame) -> DataFrame:
    """(keys, label, v) of each detection of ``d1``: its best IoU with any of ``d2``, if above 0."""
    keys = [c for c in pairs.columns if c not in ("d1", "d2")]
    rows = pairs.withColumn("x", F.explode(F.arrays_zip(F.col("d1.label").alias("label"), overlaps.best_ious(F.col("d1"), F.col("d2")).alias("v"))))
    return rows.filter("x.v > 0").select(*keys, "x.label", "x.v")


def cross_iou_summary(overlaps: DataFrame, *keys: str) -> DataFrame:
    """Mean, largest and least best IoU and the number of detections that have one, per ``keys`` of ``cross_iou``."""
    v = "v"
    return overlaps.groupBy(*keys).agg(F.round(F.avg(v), 6).alias("mean_iou"), F.round(F.max(v), 6).alias("max_iou"), F.round(F.min(v), 6).alias("min_iou"), F.count("*").alias("pairs"))


def iou_distribution(metrics: DataFrame, *keys: str) -> DataFrame:
    """Least, quartiles and largest mean matched IoU per group, of samples that have a match."""
    shares = {"low": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "high": 1.0}
    found = quantiles(metrics.filter("mean_match_iou > 0"), list(keys), "mean_match_iou", shares)
    return found.select(*keys, "n", *[F.round(k, 6).alias(k) for k in shares])


def join_occurrences(records: DataFrame, first: DataFrame, second: DataFrame, key: list[str], order: str) -> DataFrame:
    """The k-th record of a key with the k-th result of each model; ``found`` tells which sides have one: both, first, second,
    none, or leftover for results beyond a key's records."""

    def numbered(df: DataFrame) -> DataFrame:
        return df.withColumn("_k", F.row_number().over(Window.partitionBy(*key).orderBy(order)))

    a = numbered(first).withColumnRenamed(order, "first_at").withColumn("_a", F.lit(True))
    b = numbered(second).withColumnRenamed(order, "second_at").withColumn("_b", F.lit(True))
    rows = numbered(records).withColumn("_r", F.lit(True)).join(a, [*key, "_k"], "full").join(b, [*key, "_k"], "full")
    found = F.when(F.col("_r").isNull(), "leftover").when(F.col("_a") & F.col("_b"), "both").when(F.col("_a"), "first").when(F.col("_b"), "second").otherwise("none")
    return rows.withColumn("found", found).withColumnRenamed("_k", "occurrence").drop("_a", "_b", "_r")


def join_positions(base: DataFrame, tuned: DataFrame, columns: list[str]) -> DataFrame:
    """Each sample of the base model with the tuned model's of the same split and index: ``columns`` as base_* and tuned_*."""
    named = lambda df, side: df.select("split", "index", *[F.col(c).alias(f"{side}_{c}") for c in columns])
    return named(base, "base").join(named(tuned, "tuned"), ["split", "index"], "left")


def with_summary(table: DataFrame, summary: DataFrame | None, metrics: list[str]) -> DataFrame:
    """``table`` (model, split, metrics) with the values of a stored summary where that has one."""
    if summary is None:
        return table
    stored = summary.select("model", "split", *[F.col(m).alias(f"_{m}") for m in metrics if m in summary.columns])
    rows = table.join(stored, ["model", "split"], "left")
    return rows.withColumns({m: F.coalesce(f"_{m}", m) for m in metrics if m in summary.columns}).select(table.columns)


def comparison_table(table: DataFrame, models: tuple[str, ...]) -> DataFrame:
    """Rows of an aggregate table by split (train, valid, test, then others by name) and by the order of ``models``."""
    place = lambda c, names: F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(n) for n in names]), F.col(c)), F.lit(0)), F.lit(len(names) + 1)).cast("int")
    return table.withColumns({"split_rank": place("split", SPLITS), "model_rank": place("model", models)}).orderBy("split_rank", "split", "model_rank", "model")


def compare(table: DataFrame, base: str, tuned: str, metrics=("precision", "recall", "f1", "mean_match_iou", "success_rate"), flat: float = 0.01) -> DataFrame:
    """(split, metric, base, tuned, diff, verdict): improved, degraded or flat between two models of an aggregate table."""
    long = table.unpivot(["split", "model"], [F.col(m) for m in metrics], "metric", "value")
    rows = long.groupBy("split", "metric").agg(F.max(F.when(F.col("model") == base, F.col("value"))).alias("base"), F.max(F.when(F.col("model") == tuned, F.col("value"))).alias("tuned"))
    rows = rows.withColumn("diff", F.round(F.col("tuned") - F.col("base"), 6))
    return rows.withColumn("verdict", F.when(F.col("diff") > flat, "improved").when(F.col("diff") < -flat, "degraded").otherwise("flat"))


def generalisation(table: DataFrame, base: str, tuned: str, metric: str = "f1") -> DataFrame:
    """One row: a metric of both models on train and test (and the tuned one's on valid), their gaps between train and test, and a
    verdict on the tuned model against the base model: smaller_gap (it generalises better), larger_gap (it may overfit), or
    similar. A gap is 0 where one of its values is 0 or missing."""
    at = lambda model, split: F.coalesce(F.max(F.when((F.col("model") == model) & (F.col("split") == split), F.col(metric))), F.lit(0.0))
    rows = table.agg(
        at(base, "train").alias("base_train"), at(base, "test").alias("base_test"),
        at(tuned, "train").alias("tuned_train"), at(tuned, "valid").alias("tuned_valid"), at(tuned, "test").alias("tuned_test"),
    )
    gap = lambda m: F.when((F.col(f"{m}_train") != 0) & (F.col(f"{m}_test") != 0), F.round(F.col(f"{m}_train") - F.col(f"{m}_test"), 6)).otherwise(0.0)
    rows = rows.withColumns({"base_gap": gap("base"), "tuned_gap": gap("tuned")})
    return rows.withColumn("verdict", F.when(F.col("tuned_gap") < F.col("base_gap"), "smaller_gap").when(F.col("tuned_gap") > F.col("base_gap"), "larger_gap").otherwise("similar"))


def largest_changes(diffs: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` largest improvements and degradations."""
    best = diffs.filter("verdict = 'improved'").orderBy(F.desc("diff"), "split", "metric").limit(n)
    worst = diffs.filter("verdict = 'degraded'").orderBy("diff", "split", "metric").limit(n)
    return best.unionByName(worst)
