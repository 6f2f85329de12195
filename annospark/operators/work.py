"""Work partitioning, batch plans, and reports on workers and tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annospark.operators.split import global_rank

STATUSES = ("pending", "claimed", "done", "failed")


def complexity(megabytes: Column, query: Column, n_gt: Column) -> Column:
    """1 + min(MB, 20) + min(query length / 128, 4) + min(boxes / 2, 4), three places."""
    return F.bround(1 + F.least(megabytes, F.lit(20.0)) + F.least(F.length(query) / 128, F.lit(4.0)) + F.least(n_gt * 0.5, F.lit(4.0)), 3)


def contiguous(rank: Column, n: Column, workers: int) -> Column:
    """The worker of a rank (from 0) of ``n``: equal runs, the first ones a row longer."""
    size, extra = F.floor(n / workers), n % workers
    edge = extra * (size + 1)
    return F.when(rank < edge, F.floor(rank / (size + 1))).otherwise(extra + F.floor((rank - edge) / F.greatest(size, F.lit(1)))).cast("int")


def round_robin(rank: Column, workers: int) -> Column:
    return (rank % workers).cast("int")


def assign_workers(tasks: DataFrame, workers: int, order: str = "sample_index", strategy: str = "contiguous") -> DataFrame:
    """``tasks`` with rank (by ``order``) and worker."""
    ranked = global_rank(tasks, order)
    n = F.lit(ranked.count())
    return ranked.withColumn("worker", contiguous(F.col("rank"), n, workers) if strategy == "contiguous" else round_robin(F.col("rank"), workers))


def batch_plan(tasks: DataFrame, batch: int, cost: str = "cost", order: str = "sample_index") -> DataFrame:
    """``tasks`` by falling cost in batches of ``batch``, none in two: rank and batch number."""
    ranked = global_rank(tasks.withColumn("_cost", -F.col(cost)), "_cost", order).drop("_cost")
    return ranked.withColumn("batch", F.floor(F.col("rank") / batch))


def progress(tasks: DataFrame) -> DataFrame:
    """One row: total, completed, processed, failed, pending, claimed, remaining."""
    n = {s: F.count_if(F.col("status") == s) for s in STATUSES}
    return tasks.agg(F.count("*").alias("total"), (n["done"] + n["failed"]).alias("completed"), n["done"].alias("processed"), n["failed"].alias("failed"), n["pending"].alias("pending"), n["claimed"].alias("claimed"), (n["pending"] + n["claimed"]).alias("remaining"))


def status_counts(tasks: DataFrame, statuses=STATUSES) -> DataFrame:
    """One row: a count per status, 0 where none."""
    return tasks.agg(*[F.count_if(F.col("status") == s).alias(s) for s in statuses])


def completion_issues(tasks: DataFrame) -> DataFrame:
    """(worker, issue) of workers that have tasks in flight or pending."""
    rows = tasks.groupBy("worker").agg(F.count_if(F.col("status") == "claimed").alias("claimed"), F.count_if(F.col("status") == "pending").alias("pending"))
    return rows.select("worker", F.explode(F.array_compact(F.array(F.when(F.col("claimed") > 0, "in_flight"), F.when(F.col("pending") > 0, "not_started")))).alias("issue"))


class IncompleteWork(RuntimeError):
    """Tasks are in flight or not started; ``counts`` has the numbers."""

    def __init__(self, counts: dict[str, int]):
        super().__init__(f"work is not complete: {counts}")
        self.counts = counts


def check_completion(tasks: DataFrame) -> dict[str, int]:
    """total, done, in_flight, not_started and workers; raises ``IncompleteWork`` unless every task is done or failed."""
    p = tasks.agg(F.count("*").alias("total"), F.count_if(F.col("status").isin("done", "failed")).alias("done"), F.count_if(F.col("status") == "claimed").alias("in_flight"), F.count_if(F.col("status") == "pending").alias("not_started"), F.countDistinct("worker").alias("workers"))
    counts = p.first().asDict()
    if counts["done"] < counts["total"]:
        raise IncompleteWork(counts)
    return counts


def worker_maps(tasks: DataFrame) -> DataFrame:
    """One row: busy seconds and samples by worker, as maps in the workers' order, and the mean utilisation where ``tasks`` has one."""
    rows = worker_load(tasks)
    by = lambda c: F.map_from_entries(F.sort_array(F.collect_list(F.struct("worker", c))))  # noqa: E731  an entry per worker
    found = rows.agg(by("busy_seconds").alias("busy"), by("samples").alias("samples"))
    if "utilization_pct" not in tasks.columns:
        return found
    mean = tasks.groupBy("worker").agg(F.avg("utilization_pct").alias("u")).agg(F.round(F.avg("u"), 4).alias("mean_utilization"))
    return found.withColumn("_1", F.lit(1)).join(mean.withColumn("_1", F.lit(1)), "_1").drop("_1")


def worker_load(tasks: DataFrame) -> DataFrame:
    """Per worker: samples, busy seconds, throughput."""
    rows = tasks.groupBy("worker").agg(F.count("*").alias("samples"), F.round(F.sum("cost"), 4).alias("busy_seconds"))
    return rows.withColumn("per_second", F.round(F.try_divide(F.col("samples"), F.col("busy_seconds")), 6))


def load_report(tasks: DataFrame) -> DataFrame:
    """One row: makespan, mean busy share of it, and the gaps between workers in seconds and samples."""
    rows = worker_load(tasks)
    found = rows.agg(F.max("busy_seconds").alias("makespan"), F.avg("busy_seconds").alias("_mean"), F.min("busy_seconds").alias("_least"), F.max("samples").alias("_most"), F.min("samples").alias("_few"), F.count("*").alias("workers"))
    return found.select("workers", "makespan", F.round(F.try_divide(F.col("_mean"), F.col("makespan")) * 100, 4).alias("busy_pct"), F.round(F.col("makespan") - F.col("_least"), 4).alias("gap_seconds"), (F.col("_most") - F.col("_few")).alias("gap_samples"))


def layout_report(tasks: DataFrame, workers: int, order: str = "sample_index") -> DataFrame:
    """The load report of observed costs under each static layout, and its improvement on the observed assignment."""
    observed = load_report(tasks).select(F.lit("observed").alias("layout"), "*")
    ranked = global_rank(tasks.drop("worker"), order)
    n = F.lit(ranked.count())
    rows = observed
    for name, worker in (("contiguous", contiguous(F.col("rank"), n, workers)), ("round_robin", round_robin(F.col("rank"), workers))):
        rows = rows.unionByName(load_report(ranked.withColumn("worker", worker)).select(F.lit(name).alias("layout"), "*"))
    return rows


def partial_completeness(parts: DataFrame, expected_ranks: int, expected_rows: int) -> DataFrame:
    """One row: whether partial results of all ranks, and all rows, are there."""
    return parts.agg(F.countDistinct("worker").alias("ranks"), F.count("*").alias("rows")).withColumn("complete", (F.col("ranks") == expected_ranks) & (F.col("rows") == expected_rows))
