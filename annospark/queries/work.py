"""Queries on work plans, load and runs, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from annospark import fixtures as fx
from annospark.operators import runs as r
from annospark.operators import work as w


def _log(spark, sf):
    return fx.worker_log(spark, sf)


def task_progress(spark, sf):
    return w.progress(_log(spark, sf))


def status_counts(spark, sf):
    return w.status_counts(_log(spark, sf))


def completion_issues(spark, sf):
    """All tasks; those of worker 3 count as done, so that it has no issue."""
    return w.completion_issues(_log(spark, sf).withColumn("status", F.when(F.col("worker") == 3, "done").otherwise(F.col("status"))))


def worker_load(spark, sf):
    return w.worker_load(_log(spark, sf))


def load_report(spark, sf):
    return w.load_report(_log(spark, sf))


def worker_maps(spark, sf):
    """Samples by worker as one JSON map, and the mean of the workers' mean utilisation."""
    found = w.worker_maps(_log(spark, sf).withColumn("utilization_pct", F.col("sample_index") % 100 + 0.5))
    return found.select(F.to_json("samples").alias("samples"), F.size("busy").alias("workers"), "mean_utilization")


def layout_report(spark, sf):
    return w.layout_report(_log(spark, sf), 7)


def assign_contiguous(spark, sf):
    return w.assign_workers(_log(spark, sf).drop("worker"), 7).select("sample_index", "rank", "worker")


def assign_round_robin(spark, sf):
    return w.assign_workers(_log(spark, sf).drop("worker"), 7, strategy="round_robin").select("sample_index", "worker")


def batch_plan(spark, sf):
    return w.batch_plan(_log(spark, sf), 16).select("sample_index", "rank", "batch")


def complexity(spark, sf):
    d = fx.table(spark, sf, "documents")
    return d.select("doc_id", w.complexity(F.length("text") / 1024, F.col("source"), F.col("doc_id") % 12).alias("score"))


def partial_completeness(spark, sf):
    return w.partial_completeness(_log(spark, sf).filter("status = 'done'"), 8, 1000)


def gpu_summary(spark, sf):
    return r.gpu_summary(r.unpivot_gpus(fx.gpu_log(spark, sf)))


def gpu_utilisation(spark, sf):
    return r.utilisation(gpu_summary(spark, sf))


def _steps(spark, sf):
    e = fx.table(spark, sf, "events")
    return e.select((F.col("user_id") % 50).alias("run"), F.col("event_id").alias("step"), F.col("value").alias("seconds"))


def step_times(spark, sf):
    return r.step_times(_steps(spark, sf))


def latest_artefact(spark, sf):
    o = fx.table(spark, sf, "orders").select(F.col("o_custkey").alias("run"), F.concat(F.lit("gpu_"), F.lpad(F.col("o_orderkey").cast("string"), 10, "0")).alias("name"), F.col("o_totalprice").alias("payload"))
    return r.latest(o, "run", "name", "payload")


def _runs(spark, sf):
    e = fx.table(spark, sf, "events")
    rows = e.groupBy((F.col("user_id") % 20).alias("grp"), (F.col("event_id") % 5).alias("run"))
    return rows.agg(F.round(F.sum("value"), 4).alias("seconds"), F.count("*").cast("double").alias("n"), F.round(F.max("value"), 4).alias("loss")).withColumn("throughput", F.round(F.col("n") / F.col("seconds"), 8))


def run_comparison(spark, sf):
    return r.against_baseline(_runs(spark, sf), F.col("run") == 0)


def filled_results(spark, sf):
    """Results without a loss take it from the run's summary."""
    rows = _runs(spark, sf).filter("run = 1").select(F.col("grp").alias("run"), "seconds", F.when(F.col("grp") % 3 != 0, F.col("loss")).alias("loss"))
    other = _runs(spark, sf).filter("run = 2").select(F.col("grp").alias("run"), "loss")
    return r.with_gpu_summary(rows, other, ["loss"])


def before_after(spark, sf):
    one = lambda k: _runs(spark, sf).filter(f"run = {k}").agg(*[F.round(F.avg(c), 4).alias(c) for c in ("seconds", "loss", "n")])
    return r.before_after(one(0), one(1).drop("n"), ["seconds", "loss", "n"])


def learning_rates(spark, sf):
    o = fx.table(spark, sf, "orders")
    n = F.col("o_orderkey") % 8 + 1
    return o.select("o_orderkey", r.effective_batch(F.lit(4), n, F.lit(2)).alias("batch"), *[F.round(r.scaled_rate(F.lit(0.001), n, s), 9).alias(s) for s in ("none", "linear", "sqrt")])


QUERIES = {f.__name__: f for f in (task_progress, status_counts, completion_issues, worker_load, load_report, worker_maps, layout_report, assign_contiguous, assign_round_robin, batch_plan, complexity, partial_completeness, gpu_summary, gpu_utilisation, step_times, latest_artefact, run_comparison, filled_results, before_after, learning_rates)}

_W = "WITH " + fx.WORKER_LOG_SQL
_N = ", ".join(f"count(*) FILTER (status = '{s}') AS {s}" for s in w.STATUSES)
_LOAD = "SELECT worker, count(*) AS samples, round(sum(cost), 4) AS busy_seconds FROM {0} GROUP BY worker"
_REPORT = "SELECT '{1}' AS layout, count(*) AS workers, max(busy_seconds) AS makespan, round(avg(busy_seconds) / max(busy_seconds) * 100, 4) AS busy_pct, round(max(busy_seconds) - min(busy_seconds), 4) AS gap_seconds, max(samples) - min(samples) AS gap_samples FROM (" + _LOAD + ")"
_RANK = _W + """, k AS (SELECT sample_index, cost, row_number() OVER (ORDER BY sample_index) - 1 AS rank, count(*) OVER () AS n FROM worker_log),
  a AS (SELECT sample_index, cost, rank, (CASE WHEN rank < (n % 7) * (n // 7 + 1) THEN rank // (n // 7 + 1) ELSE n % 7 + (rank - (n % 7) * (n // 7 + 1)) // (n // 7) END)::INT AS worker FROM k),
  b AS (SELECT sample_index, cost, (rank % 7)::INT AS worker FROM k)"""
_GPU = """WITH g AS (SELECT event_id // 4 AS step, event_id % 4 AS gpu, max(round(value * 0.1, 4)) AS alloc_gb, max(round(value * 0.5, 4)) AS util_pct FROM events GROUP BY ALL),
  s AS (SELECT gpu::INT AS gpu, """ + ", ".join(f"round({f}({m}), 6) AS {m}_{n}" for m in ("alloc_gb", "util_pct") for f, n in (("avg", "mean"), ("max", "max"), ("min", "min"))) + ", round(max(alloc_gb) / 48 * 100, 4) AS memory_pct FROM g GROUP BY gpu)"
_RUNS = "WITH q AS (SELECT user_id % 20 AS grp, event_id % 5 AS run, round(sum(value), 4) AS seconds, count(*)::DOUBLE AS n, round(max(value), 4) AS loss FROM events GROUP BY ALL), u AS (SELECT *, round(n / seconds, 8) AS throughput FROM q)"
ORACLE_SQL = {
    "task_progress": f"{_W} SELECT count(*) AS total, count(*) FILTER (status IN ('done', 'failed')) AS completed, count(*) FILTER (status = 'done') AS processed, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'pending') AS pending, count(*) FILTER (status = 'claimed') AS claimed, count(*) FILTER (status IN ('pending', 'claimed')) AS remaining FROM worker_log",
    "status_counts": f"{_W} SELECT {_N} FROM worker_log",
    "completion_issues": f"{_W}, x AS (SELECT DISTINCT worker, status FROM worker_log WHERE worker <> 3) SELECT worker, CASE status WHEN 'claimed' THEN 'in_flight' ELSE 'not_started' END AS issue FROM x WHERE status IN ('claimed', 'pending')",
    "worker_load": f"{_W}, x AS ({_LOAD.format('worker_log')}) SELECT *, round(samples / busy_seconds, 6) AS per_second FROM x",
    "load_report": f"{_W} {_REPORT.format('worker_log', 'x').replace(chr(39) + 'x' + chr(39) + ' AS layout, ', '')}",
    "worker_maps": f"""{_W}, m AS (SELECT worker, count(*) AS n, avg(sample_index % 100 + 0.5) AS u FROM worker_log GROUP BY 1)
      SELECT '{{' || string_agg('"' || worker || '":' || n, ',' ORDER BY worker) || '}}' AS samples, count(*)::INT AS workers, round(avg(u), 4)::DOUBLE AS mean_utilization FROM m""",
    "layout_report": f"{_RANK} {_REPORT.format('worker_log', 'observed')} UNION ALL {_REPORT.format('a', 'contiguous')} UNION ALL {_REPORT.format('b', 'round_robin')}",
    "assign_contiguous": f"{_RANK} SELECT sample_index, rank, worker FROM a",
    "assign_round_robin": f"{_RANK} SELECT sample_index, worker FROM b",
    "batch_plan": f"{_W}, k AS (SELECT sample_index, row_number() OVER (ORDER BY cost DESC, sample_index) - 1 AS rank FROM worker_log) SELECT *, rank // 16 AS batch FROM k",
    "complexity": "SELECT doc_id, round_even(1 + least(length(text) / 1024, 20.0) + least(length(source) / 128, 4.0) + least((doc_id % 12) * 0.5, 4.0), 3) AS score FROM documents",
    "partial_completeness": f"{_W} SELECT count(DISTINCT worker) AS ranks, count(*) AS rows, count(DISTINCT worker) = 8 AND count(*) = 1000 AS complete FROM worker_log WHERE status = 'done'",
    "gpu_summary": f"{_GPU} SELECT * FROM s",
    "gpu_utilisation": f"{_GPU} SELECT round(avg(util_pct_mean), 3) AS mean_util, max(util_pct_max) AS max_util FROM s",
    "step_times": """WITH s AS (SELECT user_id % 50 AS run, event_id AS step, value AS seconds, row_number() OVER (PARTITION BY user_id % 50 ORDER BY value, event_id) - 1 AS r, row_number() OVER (PARTITION BY user_id % 50 ORDER BY event_id DESC) AS back, count(*) OVER (PARTITION BY user_id % 50) AS n FROM events)
      SELECT run, arg_min(seconds, step) AS first, round(avg(seconds), 6) AS mean, round(quantile_cont(seconds, 0.5), 6) AS median, max(seconds) FILTER (r = least(n - 1, floor(n * 0.95))) AS p95, round(avg(seconds) FILTER (back <= 5), 6) AS last_five FROM s GROUP BY run""",
    "latest_artefact": "SELECT o_custkey AS run, 'gpu_' || lpad(max(o_orderkey)::VARCHAR, 10, '0') AS name, arg_max(o_totalprice, o_orderkey) AS payload FROM orders GROUP BY 1",
    "run_comparison": f"{_RUNS} SELECT u.grp, u.run, round(b.seconds / u.seconds, 6) AS speedup, round((1 - u.seconds / b.seconds) * 100, 4) AS saved_pct, round(u.throughput / b.throughput, 6) AS throughput_ratio, round(u.loss - b.loss, 6) AS loss_diff FROM u LEFT JOIN (SELECT * FROM u WHERE run = 0) b ON u.grp = b.grp",
    "filled_results": f"{_RUNS} SELECT a.grp AS run, a.seconds, coalesce(CASE WHEN a.grp % 3 <> 0 THEN a.loss END, b.loss) AS loss FROM u a LEFT JOIN (SELECT * FROM u WHERE run = 2) b ON a.grp = b.grp WHERE a.run = 1",
    "before_after": f"""{_RUNS}, m AS (SELECT run, round(avg(seconds), 4) AS seconds, round(avg(loss), 4) AS loss, round(avg(n), 4) AS n FROM u WHERE run < 2 GROUP BY 1),
      l AS (SELECT run, 'seconds' AS metric, seconds AS v FROM m UNION ALL SELECT run, 'loss', loss FROM m UNION ALL SELECT run, 'n', n FROM m WHERE run = 0)
      SELECT metric, max(v) FILTER (run = 0) AS before, max(v) FILTER (run = 1) AS after, round_even(max(v) FILTER (run = 1) - max(v) FILTER (run = 0), 4) AS delta FROM l GROUP BY metric""",
    "learning_rates": "SELECT o_orderkey, 4 * (o_orderkey % 8 + 1) * 2 AS batch, 0.001::DOUBLE AS none, round(0.001::DOUBLE * (o_orderkey % 8 + 1), 9) AS linear, round(0.001::DOUBLE * sqrt(o_orderkey % 8 + 1), 9) AS sqrt FROM orders",
}
