"""The streaming forms over the events table: each runs all available input through Structured Streaming, then its result is read.

The stream's state and result live in the shared folder (``spark.checkpoint.dir`` where set).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annospark.sources.shared import shared_folder
from annospark.streaming import stream as s


def _events(spark, sf, worker="user_id % 8"):
    rows = spark.readStream.schema(spark.read.parquet(f"{sf}/events.parquet").schema).parquet(f"{sf}/events.parque[t]")
    status = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "view", "pending").when(F.col("event_type") == "click", "claimed").otherwise("done")
    return rows.select(F.col("event_id").alias("sample_index"), F.expr(worker).cast("int").alias("worker"), status.alias("status"), (F.col("event_id") % 4).cast("int").alias("gpu"), (F.col("value") * 0.5).alias("util_pct"), F.col("ts").cast("timestamp").alias("ts"))


def _run(spark, df: DataFrame, mode: str, keys: list[str]) -> DataFrame:
    """Run the stream to its end; each batch's rows are written with its number, and the last of each key counts."""
    folder = shared_folder(spark, "stream")
    schema = df.schema

    def keep(batch: DataFrame, number: int) -> None:
        batch.withColumn("_batch", F.lit(number).cast("long")).write.mode("append").parquet(f"{folder}/rows")

    query = df.writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).foreachBatch(keep).start()
    query.awaitTermination()
    rows = spark.read.parquet(f"{folder}/rows")
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in schema.names if c not in keys]), "_batch").alias("x"))
    return last.select(*keys, "x.*")


def stream_progress(spark, sf):
    return _run(spark, s.running_progress(_events(spark, sf)), "complete", ["status"])


def stream_worker_status(spark, sf):
    return _run(spark, s.latest_worker_status(_events(spark, sf)), "update", ["worker"]).select("worker", "status")


def stream_lost_workers(spark, sf):
    """Workers by user, of whom many fall silent: those whose last event is over six hours before the watermark are lost. The input is one
    batch, so each worker has its last status, and then a row ``lost`` if the watermark passes."""
    events = _events(spark, sf, worker="user_id").withColumn("sample_index", F.col("sample_index").cast("long"))
    return _run(spark, s.worker_states(events, "6 hours", "1 hour"), "append", ["worker"]).select("worker", "status", "sample_index")


def stream_gpu_windows(spark, sf):
    """Hourly summaries; rows after the last closed window stay open and are not shown."""
    rows = _run(spark, s.gpu_windows(_events(spark, sf)), "update", ["start", "gpu"])
    return rows.select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "gpu", F.round(F.col("util_mean") * F.col("n"), 3).alias("util_sum"), F.round("util_max", 4).alias("util_max"), "n")


QUERIES = {f.__name__: f for f in (stream_progress, stream_worker_status, stream_lost_workers, stream_gpu_windows)}
_STATUS = "CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'pending' WHEN 'click' THEN 'claimed' ELSE 'done' END"
ORACLE_SQL = {
    "stream_progress": f"SELECT {_STATUS} AS status, count(*) AS n FROM events GROUP BY 1",
    "stream_worker_status": f"SELECT (user_id % 8)::INT AS worker, arg_max({_STATUS}, (ts, event_id)) AS status FROM events GROUP BY 1",
    "stream_lost_workers": f"""WITH w AS (SELECT user_id::INT AS worker, max(ts) AS ts, arg_max(event_id, (ts, event_id)) AS sample_index, arg_max({_STATUS}, (ts, event_id)) AS status FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL GROUP BY 1)
      SELECT worker, CASE WHEN epoch_ms(ts) + 6 * 3600000 < (SELECT epoch_ms(max(ts)) FROM w) - 3600000 THEN 'lost' ELSE status END AS status, sample_index FROM w""",
    "stream_gpu_windows": "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS start, (event_id % 4)::INT AS gpu, round(sum(value * 0.5), 3) AS util_sum, round(max(value * 0.5), 4) AS util_max, count(*) AS n FROM events GROUP BY 1, 2",
}
