"""Label statistics, cleaning summaries and dataset counters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annospark.operators.split import group_rank
from annospark.operators.validate import has_image, map_labels, ratio


def label_counts(shapes: DataFrame, file: str = "image_id") -> DataFrame:
    """(file, label, cnt): labels per file; null and blank labels are left out."""
    return shapes.filter(F.trim("label") != "").groupBy(file, "label").agg(F.count("*").alias("cnt"))


def label_histogram(counts: DataFrame, file: str = "image_id") -> DataFrame:
    """(label, cnt, n_files): how many files have a label so many times."""
    return counts.groupBy("label", "cnt").agg(F.count(file).alias("n_files"))


def label_summary(counts: DataFrame) -> DataFrame:
    """Per label: files, instances, and the most and least in a file."""
    return counts.groupBy("label").agg(F.count("*").alias("files"), F.sum("cnt").alias("instances"), F.max("cnt").alias("max_per_file"), F.min("cnt").alias("min_per_file"))


def structured_export(counts: DataFrame, file: str = "image_id", most: int = 100_000) -> DataFrame:
    """One row per label, count and chunk, its files sorted; in order of label (without case), count and chunk. A row holds ``most``
    files at most."""
    ranked = group_rank(counts.withColumn("_l", F.lower("label")), ["_l", "label", "cnt"], file)
    found = ranked.groupBy("_l", "label", "cnt", F.floor(F.col("rank") / most).alias("chunk")).agg(F.sort_array(F.collect_list(file)).alias("files"))
    return found.orderBy("_l", "label", "cnt", "chunk").drop("_l")


def statistics_json(counts: DataFrame, source_dir: str, file: str = "image_id", most: int = 100_000) -> DataFrame:
    """(value): label statistics as JSON texts, each with ``most`` files of a label at most, so that no row grows with the data."""
    ranked = group_rank(counts.select("label", "cnt", F.col(file).cast("string").alias("_f")), ["label"], "cnt", "_f")
    per = ranked.groupBy("label", F.floor(F.col("rank") / most).alias("c"), "cnt").agg(F.sort_array(F.collect_list("_f")).alias("f"))
    one = per.groupBy("label", "c").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col("cnt").cast("string").alias("k"), "f")))).alias("m"))
    return one.select(F.to_json(F.struct(F.lit("").alias("source_dir"), F.struct(F.lit(source_dir).alias("source_dir")).alias("statistics_info"), F.create_map("label", "m").alias("label_counts"))).alias("value"))


def totals(annotations: DataFrame) -> DataFrame:
    """One row: files processed, skipped for want of shapes, distinct labels and label instances."""
    rows = annotations.select("image_id", F.size("shapes").alias("n"), F.filter("shapes.label", lambda x: F.trim(x) != "").alias("l"))
    labels = rows.select(F.explode("l").alias("label")).distinct().agg(F.count("*").alias("labels"))
    counts = rows.agg(F.count("*").alias("scanned"), F.count_if(F.col("n") > 0).alias("processed"), F.count_if(F.col("n") <= 0).alias("skipped_no_shapes"), F.coalesce(F.sum(F.size("l")), F.lit(0)).alias("instances"))
    return _beside(counts, labels).select("scanned", "processed", "skipped_no_shapes", "labels", "instances")


def _beside(*tables: DataFrame) -> DataFrame:
    """One-row tables side by side."""
    found = tables[0].withColumn("_1", F.lit(1))
    for table in tables[1:]:
        found = found.join(table.withColumn("_1", F.lit(1)), "_1")
    return found.drop("_1")


def statistics_totals(parsed: DataFrame) -> DataFrame:
    """One row over files (ok: a JSON object, a): processed, skipped for each reason (the first that holds), labels, instances."""
    labels = F.filter(F.coalesce("a.shapes.label", F.array().cast("array<string>")), lambda x: F.trim(x) != "")
    reason = F.when(~F.col("ok"), "parse_error").when(~has_image(F.col("a")), "no_image_ref").when(F.size("l") == 0, "no_shapes").otherwise("processed")
    rows = parsed.withColumn("l", labels).withColumn("reason", reason)
    n = lambda name: F.count_if(F.col("reason") == name)
    counts = rows.agg(
        n("processed").alias("processed"), n("parse_error").alias("skipped_parse_error"), n("no_image_ref").alias("skipped_no_image_ref"), n("no_shapes").alias("skipped_no_shapes"),
        F.coalesce(F.sum(F.when(F.col("reason") == "processed", F.size("l"))), F.lit(0)).alias("instances"),
    )
    return _beside(counts, rows.filter("reason = 'processed'").select(F.explode("l").alias("label")).distinct().agg(F.count("*").alias("labels")))


def clean_set(parsed: DataFrame) -> DataFrame:
    """One row over files (ok, a, length): files, processed, failed, annotations in all, on average, most and least (a failed file counts
    as 0), bytes in all and on average, and the sorted labels (a missing one is ``unknown``)."""
    n = F.when(F.col("ok"), F.coalesce(F.size("a.shapes"), F.lit(0))).otherwise(0)
    n = F.greatest(n, F.lit(0))
    counts = parsed.agg(
        F.count("*").alias("files"), F.count_if("ok").alias("processed"), F.count_if(~F.col("ok")).alias("failed"),
        F.coalesce(F.sum(n), F.lit(0)).alias("annotations"), F.round(F.avg(n), 6).alias("mean"), F.max(n).alias("most"), F.min(n).alias("least"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"), F.round(F.avg("length"), 6).alias("mean_bytes"),
    )
    labels = prescan_labels(parsed).agg(F.sort_array(F.collect_list("label")).alias("label_list"))  # a row per label
    return _beside(counts, labels).withColumn("labels", F.size("label_list"))


def integrity_counters(found: DataFrame) -> DataFrame:
    """One row over integrity results (status): files, passed (no failure), failed, with warnings, and the share passed."""
    n = found.agg(F.count("*").alias("files"), F.count_if(F.col("status") != "fail").alias("passed"), F.count_if(F.col("status") == "fail").alias("failed"), F.count_if(F.col("status") == "warning").alias("warnings"))
    return n.withColumn("pass_pct", F.round(ratio(F.col("passed"), F.col("files")), 4))


def format_counters(files: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """One row over files (ok, a, image): converted, failed, labels mapped, with a remote URL, with an image to link to and without,
    and the share converted."""
    mapped = F.size(F.filter(map_labels(F.col("a.shapes"), mapping), lambda s: s["label_mapped"]))
    url = F.coalesce("a.imageUrl", F.lit("")) != ""
    ok = F.col("ok")
    n = files.agg(
        F.count("*").alias("files"), F.count_if(ok).alias("converted"), F.count_if(~ok).alias("failed"),
        F.coalesce(F.sum(F.when(ok & F.col("a.shapes").isNotNull(), mapped)), F.lit(0)).alias("labels_mapped"), F.count_if(ok & url).alias("urls"),
        F.count_if(ok & F.col("image").isNotNull()).alias("links"), F.count_if(ok & F.col("image").isNull()).alias("links_failed"),
    )
    return n.withColumn("success_pct", F.round(ratio(F.col("converted"), F.col("files")), 4))


def first_rows(rows: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows in this order, as a report shows missing files or errors; each task sends ``n`` at most."""
    return rows.orderBy(*order).limit(n)


def distributions(shapes: DataFrame) -> DataFrame:
    """Counts by label, by shape type and over all, in one pass."""
    return shapes.groupingSets([[F.col("label")], [F.col("shape_type")], []], "label", "shape_type").agg(F.count("*").alias("n"))


def per_file(annotations: DataFrame) -> DataFrame:
    """One row: total, mean, most and least annotations in a file."""
    n = F.size("shapes")
    return annotations.agg(F.count("*").alias("files"), F.sum(n).cast("long").alias("annotations"), F.round(F.avg(n), 6).alias("mean"), F.max(n).alias("most"), F.min(n).alias("least"))


def status_summary(statuses: DataFrame, values: tuple[str, ...]) -> DataFrame:
    """One row: a count for each status, 0 where none, and their total and percentage valid."""
    counts = [F.count_if(F.col("status") == v).alias(v) for v in values]
    found = statuses.agg(F.count("*").alias("total"), *counts)
    return found.withColumn("valid_pct", F.round(F.try_divide(F.col(values[0]), F.col("total")) * 100, 4))


def duplicates_per_image(ranked: DataFrame) -> DataFrame:
    """Images with several annotations: the primary one and the others in rank order."""
    rows = ranked.groupBy("image").agg(F.sort_array(F.collect_list(F.struct("rank", "path"))).alias("r")).filter(F.size("r") > 1)
    return rows.select("image", F.get("r.path", 0).alias("primary"), F.slice("r.path", 2, F.size("r") - 1).alias("duplicates"))


def prescan(parsed: DataFrame) -> DataFrame:
    """One row: files scanned and skipped (no JSON), with a remote URL, with a local path only."""
    url, path = F.coalesce(F.col("a.imageUrl"), F.lit("")) != "", F.coalesce(F.col("a.imagePath"), F.lit("")) != ""
    ok = F.col("ok")
    return parsed.agg(F.count_if(ok).alias("scanned"), F.count_if(~ok).alias("skipped"), F.count_if(ok & url).alias("url"), F.count_if(ok & ~url & path).alias("local"))


def prescan_labels(parsed: DataFrame) -> DataFrame:
    """Label counts, most common first; a missing label counts as ``unknown``."""
    labels = parsed.filter("ok").select(F.explode("a.shapes").alias("s")).select(F.coalesce("s.label", F.lit("unknown")).alias("label"))
    return labels.groupBy("label").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label")


def dataset_stats(records: DataFrame) -> DataFrame:
    """One row: samples, with and without images, image references, distinct paths."""
    n = F.greatest(F.size("images"), F.lit(0))
    counts = records.agg(F.count("*").alias("samples"), F.count_if(n > 0).alias("with_images"), F.count_if(n == 0).alias("without_images"), F.coalesce(F.sum(n), F.lit(0)).alias("image_refs"))
    return _beside(counts, records.select(F.explode("images").alias("image")).distinct().agg(F.count("image").alias("distinct_images")))
