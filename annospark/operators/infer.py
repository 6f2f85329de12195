"""Batch inference with a caller's predictor, and evaluation of two models."""

from __future__ import annotations

import functools
import time
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annospark.functions import text as t
from annospark.operators import evaluate as e
from annospark.operators import predictors  # by module: a pool named in a task's function would be sent as a copy
from annospark.sources import files
from annospark.sources.shared import written

#: (image path, query) pairs to response texts.
Predictor = Callable[[list[tuple[str, str]]], list[str]]


def predict(records: DataFrame, make: Callable[[], Predictor], batch: int = 8, partitions: int | None = None, key: str | None = None, most: int = 1, gpus: float = 1.0) -> DataFrame:
    """``records`` (index, image_path, query, ...) with raw_response, success, error and seconds.

    ``make`` builds the predictor once per Python worker, which keeps it from task to task, and for all calls with the same ``key``.
    A worker holds ``most`` predictors; one that another needs the place of is let go, after its ``close()`` if it has one. Where executors
    have GPUs, each task holds ``gpus`` of them. A batch that fails is tried row by row; a row that fails is kept with its error,
    as is one without image or query, which no predictor sees. Rows are dealt over ``partitions`` by index; Spark's task retry stands for
    a worker's restart. All other columns go along.
    """
    call = key or uuid.uuid4().hex

    def answers(model: Predictor, part: list[tuple[str, str]]) -> list[tuple[str | None, bool, str | None]]:
        try:
            found = model(part)
            if len(found) != len(part):
                raise ValueError("the predictor gave another number of answers")
            return [(a, True, None) for a in found]
        except Exception:
            single = []
            for pair in part:
                try:
                    single.append((model([pair])[0], True, None))
                except Exception as x:  # kept with the row
                    single.append((None, False, str(x)))
            return single

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = predictors.POOL.get(call, make, most)
        for rows in batches:
            pairs = list(zip(rows.column("image_path").to_pylist(), rows.column("query").to_pylist()))
            fit = [k for k, (image, query) in enumerate(pairs) if image is not None and query]
            found, seconds = [(None, False, "no image or no query")] * len(pairs), [0.0] * len(pairs)
            for at in range(0, len(fit), batch):
                part, began = fit[at : at + batch], time.perf_counter()
                given = answers(model, [pairs[k] for k in part])
                each = (time.perf_counter() - began) / len(part)
                for k, answer in zip(part, given):
                    found[k], seconds[k] = answer, each
            columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.string(), pa.bool_(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*rows.columns, *columns, pa.array(seconds, pa.float64())], [*rows.schema.names, "raw_response", "success", "error", "seconds"])

    records = records.drop("raw_response", "success", "error", "seconds")
    more = T.StructType().add("raw_response", "string").add("success", "boolean").add("error", "string").add("seconds", "double")
    dealt = records.repartition(partitions, "index") if partitions else records
    return dealt.mapInArrow(run, T.StructType([*records.schema.fields, *more.fields]), profile=predictors.session_profile(records.sparkSession, gpus))


def with_detections(results: DataFrame, width: Column, height: Column, **options) -> DataFrame:
    """Detections of the responses; failed rows have none, and are still scored."""
    found = t.parse_detections(F.col("raw_response"), width, height, clamp=True, default_confidence=0.85, **options)
    return results.withColumn("dets", F.when(F.col("success"), found).otherwise(F.array().cast(t.DETECTIONS)))


def evaluate_models(records: DataFrame, models: dict[str, Callable[[], Predictor]], width: Column, height: Column, threshold: float = 0.5, store: str | None = None) -> dict[str, DataFrame]:
    """Several models over the same records (index, split, image_path, query, gts): ``samples`` (their detections), ``metrics``,
    ``aggregates``, and with two models ``cross_iou`` (per split, of the first one's detections with the second one's).

    With ``store``, a folder of results by model and split, a model's split that is there is not inferred again. Models run one after the
    other, and a Python worker makes one once for all its splits and closes it before the next.
    """
    spark, rows = records.sparkSession, []
    for name, make in models.items():
        key = f"{name}-{uuid.uuid4().hex}"
        infer = lambda part, make=make, key=key: with_detections(predict(part, make, key=key), width, height).select("index", "split", "dets", "gts")
        if store is None:
            rows.append(written(infer(records), "samples").withColumn("model", F.lit(name)))
            continue
        for split in [r["split"] for r in records.select("split").distinct().collect()]:  # a few names
            part = records.filter(F.col("split") == split)
            rows.append(files.load_or_compute(spark, store, name, split, lambda part=part, infer=infer: infer(part)))
    samples = functools.reduce(DataFrame.unionByName, rows)
    metrics = e.sample_metrics(samples, threshold)
    found = {"samples": samples, "metrics": metrics, "aggregates": e.aggregate_metrics(metrics, "model", "split")}
    if len(models) == 2:
        a, b = (samples.filter(F.col("model") == name).select("split", "index", F.col("dets").alias(f"d{k}")) for k, name in enumerate(models, 1))
        found["cross_iou"] = e.cross_iou_summary(e.cross_iou(a.join(b, ["split", "index"])), "split")
    return found


def shard_stats(results: DataFrame) -> DataFrame:
    """Per worker of a round of inference (worker, image_path, query, success, seconds): samples, without image or query, failed,
    processed, seconds, and samples per second."""
    unfit = F.col("image_path").isNull() | (F.coalesce("query", F.lit("")) == "")
    n = results.groupBy("worker").agg(
        F.count("*").alias("samples"), F.count_if(unfit).alias("unprepared"), F.count_if(~F.col("success") & ~unfit).alias("failed"), F.count_if("success").alias("processed"), F.round(F.sum("seconds"), 4).alias("seconds")
    )
    return n.withColumn("per_second", F.round(F.try_divide(F.col("processed"), F.col("seconds")), 4))
