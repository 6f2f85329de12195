"""GPU logs, step times and comparison of training runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annospark.operators.quantiles import elements


def unpivot_gpus(wide: DataFrame) -> DataFrame:
    """(timestamp, step, gpu, metric columns) of a log with columns gpu{i}_{metric}; each GPU's metrics side by side."""
    found = sorted({c.split("_", 1)[0] for c in wide.columns if c.startswith("gpu")}, key=lambda c: int(c[3:]))
    metrics = sorted({c.split("_", 1)[1] for c in wide.columns if c.startswith("gpu")})
    gpus = F.array(*[F.struct(F.lit(int(g[3:])).alias("gpu"), *[F.col(f"{g}_{m}").cast("double").alias(m) if f"{g}_{m}" in wide.columns else F.lit(None).cast("double").alias(m) for m in metrics]) for g in found])
    return wide.select("timestamp", "step", F.explode(gpus).alias("x")).select("timestamp", "step", "x.*")


def gpu_summary(log: DataFrame, capacity_gb: float = 48.0) -> DataFrame:
    """Mean, largest and least of each metric per GPU, and the share of memory used."""
    aggs = [F.round(f(m), 6).alias(f"{m}_{n}") for m in ("alloc_gb", "util_pct") for f, n in ((F.avg, "mean"), (F.max, "max"), (F.min, "min"))]
    return log.groupBy("gpu").agg(*aggs, F.round(F.max("alloc_gb") / capacity_gb * 100, 4).alias("memory_pct"))


def utilisation(summary: DataFrame) -> DataFrame:
    """One row over all GPUs."""
    return summary.agg(F.round(F.avg("util_pct_mean"), 3).alias("mean_util"), F.max("util_pct_max").alias("max_util"))


def step_times(steps: DataFrame) -> DataFrame:
    """Per run (run, step, seconds): first, mean, median, p95 (the element at min(n - 1, floor(0.95 n)) of the sorted list), and the
    mean of the last five steps. A run of any length is spread over tasks: order statistics by ``quantiles``, and five rows per run and task
    for the last steps."""
    steps = steps.select("run", "step", "seconds")
    n = F.col("n")
    at = {"_low": F.floor((n - 1) / 2), "_high": F.ceil((n - 1) / 2), "p95": F.least(n - 1, F.floor(n * 0.95))}
    order = elements(steps, ["run"], "seconds", at).select("run", F.round((F.col("_low") + F.col("_high")) / 2, 6).alias("median"), "p95")
    back = steps.withColumn("_back", F.row_number().over(Window.partitionBy("run").orderBy(F.desc("step")))).filter("_back <= 5")
    last = back.groupBy("run").agg(F.round(F.avg("seconds"), 6).alias("last_five"))
    whole = steps.groupBy("run").agg(F.min_by("seconds", "step").alias("first"), F.round(F.avg("seconds"), 6).alias("mean"))
    return whole.join(order, "run", "left").join(last, "run", "left").select("run", "first", "mean", "median", "p95", "last_five")


def latest(artefacts: DataFrame, key: str, name: str, payload: str) -> DataFrame:
    """The payload of each key's last artefact by name."""
    return artefacts.groupBy(key).agg(F.max(name).alias(name), F.max_by(payload, name).alias(payload))


def with_gpu_summary(results: DataFrame, summaries: DataFrame, fields: list[str], key: str = "run") -> DataFrame:
    """``results`` with fields that are null filled from the run's summary."""
    filled = summaries.select(key, *[F.col(f).alias(f"_{f}") for f in fields])
    return results.join(filled, key, "left").withColumns({f: F.coalesce(f, f"_{f}") for f in fields}).drop(*[f"_{f}" for f in fields])


def before_after(before: DataFrame, after: DataFrame, metrics: list[str]) -> DataFrame:
    """(metric, before, after, delta) of two one-row tables; delta with four places where both have the metric."""
    long = lambda df, n: df.unpivot([], [F.col(m).cast("double").alias(m) for m in metrics if m in df.columns], "metric", n)
    rows = long(before, "before").join(long(after, "after"), "metric", "full")
    return rows.withColumn("delta", F.bround(F.col("after") - F.col("before"), 4))


def against_baseline(runs: DataFrame, baseline: Column) -> DataFrame:
    """Each run against its group's baseline run: speed-up, time saved, throughput ratio, loss difference."""
    w = Window.partitionBy("grp")
    base = lambda c: F.max(F.when(baseline, F.col(c))).over(w)
    rows = runs.withColumns({"_s": base("seconds"), "_t": base("throughput"), "_l": base("loss")})
    return rows.select(
        "grp", "run",
        F.round(F.try_divide(F.col("_s"), F.col("seconds")), 6).alias("speedup"),
        F.round((1 - F.try_divide(F.col("seconds"), F.col("_s"))) * 100, 4).alias("saved_pct"),
        F.round(F.try_divide(F.col("throughput"), F.col("_t")), 6).alias("throughput_ratio"),
        F.round(F.col("loss") - F.col("_l"), 6).alias("loss_diff"),
    )


def effective_batch(per_device: Column, devices: Column, steps: Column) -> Column:
    return per_device * devices * steps


def scaled_rate(rate: Column, devices: Column, scaling: str = "none") -> Column:
    """A learning rate by the number of devices: none, linear or sqrt."""
    if scaling not in ("none", "linear", "sqrt"):
        raise ValueError(f"unknown scaling: {scaling}")
    return {"none": rate, "linear": rate * devices, "sqrt": rate * F.sqrt(devices)}[scaling]
