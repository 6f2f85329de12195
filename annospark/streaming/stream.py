"""Incremental forms of the bookkeeping: annotation ingest, progress, worker status and GPU summaries as streams."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from annospark.operators import validate as v


def annotation_stream(spark: SparkSession, folder: str, max_files: int = 1000) -> DataFrame:
    """New annotation files of a folder: value (the text), status, shapes."""
    lines = spark.readStream.option("wholetext", True).option("maxFilesPerTrigger", max_files).option("recursiveFileLookup", "true").text(folder)
    return lines.select("value", v.structure_status(F.col("value")).alias("status"), F.when(v.is_object(F.col("value")), v.parse(F.col("value")))["shapes"].alias("shapes"))


def running_label_counts(annotations: DataFrame) -> DataFrame:
    """Labels of valid files so far (update mode)."""
    labels = annotations.filter("status = 'valid'").select(F.explode("shapes.label").alias("label"))
    return labels.filter(F.trim("label") != "").groupBy("label").agg(F.count("*").alias("n"))


def running_progress(tasks: DataFrame) -> DataFrame:
    """Tasks by status so far (complete mode)."""
    return tasks.groupBy("status").agg(F.count("*").alias("n"))


def latest_worker_status(events: DataFrame) -> DataFrame:
    """Each worker's last status by time (update mode)."""
    return events.groupBy("worker").agg(F.max_by("status", F.struct("ts", "sample_index")).alias("status"), F.max("ts").alias("ts"))


def worker_states(events: DataFrame, silence: str = "5 minutes", late: str = "1 minute", ended: tuple[str, ...] = ()) -> DataFrame:
    """Changes of each worker's status (worker, status, ts, sample_index), by state that ends (append mode).

    ``events``: worker, status, ts, sample_index. The state of a worker is its last event by (ts, sample_index); a batch that brings a
    later one gives a row. When the watermark, ``late`` behind the latest event of all, is past ``silence`` after a worker's last event, it
    gives a row ``lost`` with that event's time and index, and its state goes; the same without a row after a status in ``ended``. A worker that
    comes back begins anew. So state is held for workers of the last ``silence`` and ``late`` only. Events behind the watermark, without
    worker or without time are left out; a null status is kept as it is, a null index comes before all others, and of events that tie in both the
    greatest status counts.
    """
    gap, least = int(pd.Timedelta(silence).total_seconds() * 1000), -(1 << 63)
    order = lambda event: (event[1], event[2], event[0] or "")

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        row = lambda status, micros, index: pd.DataFrame({"worker": [key[0]], "status": [status], "micros": [micros], "sample_index": [index]})
        if state.hasTimedOut:
            _, micros, index = state.get
            state.remove()
            yield row("lost", micros, index)
            return
        before = last = tuple(state.get) if state.exists else None
        for frame in frames:  # a group's rows come in several frames, and only the last event is held
            top = frame.sort_values(["micros", "sample_index", "status"], na_position="first", kind="stable").iloc[-1]
            event = (None if pd.isna(top["status"]) else top["status"], int(top["micros"]), int(top["sample_index"]))
            last = event if last is None or order(event) > order(last) else last
        if last != before:
            yield row(*last)
        if last[0] in ended:
            state.remove()
            return
        state.update(last)
        state.setTimeoutTimestamp(max(last[1] // 1000 + gap, state.getCurrentWatermarkMs() + 1))

    kind = events.schema["worker"].dataType.simpleString()
    rows = events.filter("worker is not null and ts is not null").withWatermark("ts", late)
    rows = rows.select("worker", "status", "ts", F.unix_micros("ts").alias("micros"), F.coalesce(F.col("sample_index").cast("long"), F.lit(least)).alias("sample_index"))
    found = rows.groupBy("worker").applyInPandasWithState(
        run, f"worker {kind}, status string, micros long, sample_index long", "status string, micros long, sample_index long", "append", GroupStateTimeout.EventTimeTimeout
    )
    return found.select("worker", "status", F.timestamp_micros("micros").alias("ts"), F.nullif("sample_index", F.lit(least)).alias("sample_index"))


def gpu_windows(log: DataFrame, length: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Tumbling summaries per GPU; rows later than the watermark are left out (append mode)."""
    w = F.window("ts", length)
    rows = log.withWatermark("ts", late).groupBy(w.alias("w"), "gpu").agg(F.avg("util_pct").alias("util_mean"), F.max("util_pct").alias("util_max"), F.count("*").alias("n"))
    return rows.select(F.col("w.start").alias("start"), "gpu", F.round("util_mean", 6).alias("util_mean"), "util_max", "n")
