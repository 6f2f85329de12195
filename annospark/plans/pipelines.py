"""Whole pipelines, each a composition of the operators; results are DataFrames, and sinks are written by Spark."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annospark.operators import evaluate as ev
from annospark.operators import infer, records, runs, sample, split, stats, validate, work
from annospark.operators.spread import small, spread
from annospark.sources import files
from annospark.sources.shared import written

STATUSES = ("valid", "invalid_json", "missing_shapes", "empty_shapes", "invalid_image_path", "missing_image", "duplicate_annotation")


def clean(spark: SparkSession, source: str, target: str, mapping: dict[str, str] | None = None, strict: bool = True, keep_structure: bool = True) -> dict[str, DataFrame]:
    """Validate, look images up, keep one annotation per image, plan the copies, standardise, check, and count.

    Returns tables: status (a row per file), copies, standard, integrity, labels, distributions, set, summary, report. The parsed files
    are written once to the shared folder; ``target`` gets the report as text: counts, then each invalid file by status, then images
    with several annotations.
    """
    images = files.scan(spark, source).filter(F.col("ext").isin(*validate.IMAGE_EXTENSIONS))
    parsed = files.read_annotations(spark, source).withColumn("status", validate.structure_status(F.col("raw")))
    parsed = written(parsed, "parsed")
    valid = parsed.filter("status = 'valid'").withColumn("image_path", F.col("a.imagePath"))
    located = validate.find_images(valid.select("path", "dir", "stem", "image_path", "a"), images, strict)
    ranked = validate.primary_annotation(located.filter("image is not null").withColumn("shapes_count", F.size("a.shapes")))
    final = parsed.select("path", F.col("status").alias("_s")).join(located.select("path", "image"), "path", "left").join(ranked.select("path", F.col("status").alias("_d")), "path", "left")
    status = F.when(F.col("_s") != "valid", F.col("_s")).when(F.col("image").isNull(), "missing_image").when(F.col("_d") == "duplicate_annotation", F.col("_d")).otherwise("valid")
    final = final.select("path", "image", status.alias("status"))
    kept = ranked.filter("status = 'primary'").withColumn("mapped", validate.map_labels(F.col("a.shapes"), mapping or {}))
    sizes = images.select(F.col("path").alias("image"), "length")
    check = kept.join(sizes, "image", "left").select("path", validate.integrity(F.col("a"), F.col("length")).alias("i")).select("path", "i.status", "i.issues")
    labels = stats.label_summary(stats.label_counts(kept.select("path", F.explode("mapped.label").alias("label")), "path"))
    summary = stats.status_summary(final, STATUSES)
    report = cleaning_report(final, summary, stats.duplicates_per_image(ranked))
    report.orderBy("section", "line").select("line").coalesce(1).write.mode("overwrite").text(f"{target.rstrip('/')}/report")
    shapes = kept.select(F.explode("a.shapes").alias("s")).select("s.label", F.coalesce("s.shape_type", "s.type").alias("shape_type"))
    return {
        "report": report,
        "distributions": stats.distributions(shapes),
        "set": stats.clean_set(kept.join(parsed.select("path", "length"), "path").withColumn("ok", F.col("a").isNotNull())),
        "status": final,
        "copies": files.copy_plan(kept, source, target, keep_structure),
        "standard": validate.standardize(kept),
        "integrity": check,
        "labels": labels,
        "summary": summary,
    }


def cleaning_report(status: DataFrame, summary: DataFrame, duplicates: DataFrame) -> DataFrame:
    """(section, line) of a report: 1 the counts, 2 each file that is not valid with its status, 3 each image with several
    annotations, the primary one and the others."""
    counts = summary.select(F.explode(F.from_json(F.to_json(F.struct("*")), "map<string,string>")).alias("k", "v")).select(F.lit(1).alias("section"), F.concat_ws(": ", "k", "v").alias("line"))
    invalid = status.filter("status <> 'valid'").select(F.lit(2), F.concat_ws(": ", "status", "path"))
    several = duplicates.select(F.lit(3), F.concat(F.col("image"), F.lit(": "), F.col("primary"), F.lit(" before "), F.array_join("duplicates", ", ")))
    return counts.unionAll(invalid).unionAll(several)


def label_statistics(spark: SparkSession, source: str) -> dict[str, DataFrame]:
    """Counts per file, their histogram, summary and ordered export, of files that name an image."""
    parsed = files.read_annotations(spark, source).filter(F.col("a").isNotNull()).filter(validate.has_image(F.col("a")))
    counts = stats.label_counts(parsed.select("path", F.explode("a.shapes.label").alias("label")), "path")
    counts = written(counts, "counts")
    return {"counts": counts, "histogram": stats.label_histogram(counts, "path"), "summary": stats.label_summary(counts), "export": stats.structured_export(counts, "path")}


def filter_copy(spark: SparkSession, statistics: str, folder: str) -> DataFrame:
    """(file, status) of the files that a statistics file lists."""
    return files.filter_copy_plan(files.read_statistics(spark, statistics), files.scan(spark, folder))


def balanced_sample(spark: SparkSession, source: str, n: int, mode: str = "images") -> dict[str, DataFrame]:
    """A selection per label by images or by labels, and its totals."""
    counts = label_statistics(spark, source)["counts"]
    selected = sample.sample_images(counts, n, "path") if mode == "images" else sample.sample_labels(counts, n, "path")
    return {"selected": selected, "totals": sample.selection_totals(selected, "path")}


def convert(annotations: DataFrame, target: str, ratio: str = "8:1:1", order: Column | None = None, stratified: bool = True, strategy: str = "all_in_one", schema: str = "openai", shared_split: bool = False, **options) -> DataFrame:
    """Records of annotations, split by image without leaks, written as JSON lines; the records with their split and strategy.

    ``both`` makes the records of both strategies, each written to a folder of its own with its own ``dataset_info``. Usable boxes
    are found and written once, with their texts. Records of both strategies have the same images and labels, so an image has the same
    split in both, which is made once too, with and without ``shared_split``.
    """
    made = {k: options.pop(k) for k in ("lang", "style", "custom", "prompt", "output") if k in options}
    asked = {k: options[k] for k in ("norm", "layout") if k in options}
    boxes = written(records.with_boxes(annotations, items=made.get("output", "json") == "json", **options), "boxes")
    labels = boxes.select("image_key", F.explode("labels").alias("label"))
    parts = split.stratified_split(labels, ratio, order).select("image_key", "split") if stratified else split.split_images(boxes, ratio, order)
    placed = written(_placed(boxes, written(parts, "splits")), "placed")
    done = None
    for name in ("all_in_one", "per_class") if strategy == "both" else (strategy,):
        one = records.from_boxes(placed, name, **made, **asked).withColumn("strategy", F.lit(name))
        folder = f"{target.rstrip('/')}/{name}" if strategy == "both" else target.rstrip("/")
        files.write_splits(one.select("split", "record_id", "messages", "labels"), f"{folder}/data", schema)
        files.write_dataset_info(one, one.select("split", F.explode("labels").alias("label")), f"{folder}/dataset_info")
        done = one if done is None else done.unionByName(one)
    return done


def _placed(boxes: DataFrame, parts: DataFrame) -> DataFrame:
    """``boxes`` with the split of their image, train without one. An image has one row in ``parts``, whose share of a partition is hashed
    rather than both sides sorted."""
    if small(parts):
        found = boxes.join(parts, "image_key", "left")
    else:
        found = spread(boxes, "image_key").join(parts.hint("shuffle_hash"), "image_key", "left")
    return found.withColumn("split", F.coalesce("split", F.lit("train")))


def convert_directory(spark: SparkSession, source: str, target: str, sizes: DataFrame | None = None) -> DataFrame:
    """Box lists of a folder's annotation files, written under ``target``; the counts of files converted and failed."""
    found = written(records.convert_directory(files.read_annotations(spark, source, recursive=False), sizes), "boxes")
    files.write_keyed(found.select("file", F.col("boxes").alias("payload")), target)
    return records.directory_counts(found)


def prescan(spark: SparkSession, source: str) -> dict[str, DataFrame]:
    parsed = files.read_annotations(spark, source).withColumn("ok", F.col("a").isNotNull())
    return {"files": stats.prescan(parsed), "labels": stats.prescan_labels(parsed)}


def verify_format(spark: SparkSession, path: str, n: int = 3) -> DataFrame:
    """One row on the first ``n`` records of a JSON lines file: checked, valid, passed, and the first errors."""
    return validate.verify_records(files.indexed_lines(spark, path), n)


def compare_models(metrics: DataFrame, base: str, tuned: str) -> dict[str, DataFrame]:
    """Aggregates in order, differences, largest changes and the gaps between train and test of sample metrics (model, split, ...)."""
    table = written(ev.aggregate_metrics(metrics, "model", "split"), "aggregates")
    short = table.select("model", "split", *[F.col(f"{k}_mean").alias(k) for k in ("precision", "recall", "f1", "mean_match_iou")], "success_rate")
    diffs = ev.compare(short, base, tuned)
    return {"table": ev.comparison_table(table, (base, tuned)), "diffs": diffs, "changes": ev.largest_changes(diffs), "gap": ev.generalisation(short, base, tuned)}


def sharded_inference(rows: DataFrame, models: dict[str, Callable[[], infer.Predictor]], workers: int, width: Column, height: Column, target: str) -> dict[str, DataFrame]:
    """Predict with each model over ``workers`` partitions, score, store by model and split, report the load and each worker's
    counts, and merge the results by index for export.

    ``rows``: index, split, image_path, query, gts. Stored results are read back, so that scores don't run the models again.
    """
    for name, make in models.items():  # a round each, so that a worker holds one model at a time
        found = infer.with_detections(infer.predict(rows, make, partitions=workers), width, height).withColumn("model", F.lit(name))
        files.write_results(found.withColumn("worker", work.round_robin(F.col("index"), workers)), target)
    stored = files.read_results(rows.sparkSession, target)
    scored = ev.sample_metrics(stored.select("model", "split", "index", "dets", "gts"))
    load = work.load_report(stored.select("worker", F.col("seconds").alias("cost")))
    exported = records.export_payload(stored.select("index", "image_path", width.alias("width"), height.alias("height"), F.col("dets").alias("detections"), F.col("model").alias("model_type"), F.col("success").alias("inference_success"), F.col("error").alias("inference_error"), "query", "raw_response"))
    return {
        "results": stored,
        "merged": files.by_index(stored),
        "metrics": scored,
        "aggregates": ev.aggregate_metrics(scored, "model", "split"),
        "load": load,
        "workers": infer.shard_stats(stored),
        "exported": exported,
    }


def compare_runs(results: DataFrame, summaries: DataFrame, fields: list[str], baseline: Column) -> DataFrame:
    """Runs with their GPU summaries, each against the baseline of its group."""
    return runs.against_baseline(runs.with_gpu_summary(results, summaries, fields), baseline)
