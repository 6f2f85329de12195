"""Sources and sinks: annotation JSON, JSONL, archives, manifests, logs and result stores, through Spark's readers and writers."""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annospark.operators import evaluate as ev
from annospark.operators import validate as v
from annospark.operators.names import free_names
from annospark.operators.records import strip_answers
from annospark.operators.runs import unpivot_gpus
from annospark.operators.split import class_matrix, numbered, split_stats
from annospark.sources import snapshots
from annospark.sources.json_ranges import ANY, EACH, json_values
from annospark.sources.keyed_files import KeyedFiles, filesystem, read_report
from annospark.sources.listing import scan
from annospark.sources.shared import shared_folder

#: Bytes of files that a task holds together, and files that a task reads by name, about.
HELD, NAMES = 8 << 20, 20_000
MESSAGES = "array<struct<role:string,content:array<struct<type:string,text:string>>>>"
RESULT = "struct<gpu_id:int,model_type:string,index:bigint,image_path:string,image_width:int,image_height:int,query:string,detections:array<struct<bbox:array<int>,label:string,confidence:double>>,raw_response:string,inference_success:boolean,inference_error:string,sample_wall_time_seconds:double>"


@F.pandas_udf(T.StringType())
def _gbk(content: pd.Series) -> pd.Series:
    return content.map(lambda b: None if b is None else bytes(b).decode("gbk", "replace"))


def decode_text(content: Column) -> Column:
    """UTF-8, else GBK, as text. Only contents that are no UTF-8 go to Python."""
    text = content.cast("string")
    return F.when(F.is_valid_utf8(text), text).otherwise(_gbk(F.when(~F.is_valid_utf8(text), content)))


def read_annotations(spark: SparkSession, folder: str, recursive: bool = True, gbk: bool = True) -> DataFrame:
    """JSON files of a folder: path, dir, stem, length, raw text and parsed annotation ``a`` (null where it is no JSON object). Text that
    is no UTF-8 is read as GBK, or without ``gbk`` has its bad bytes replaced."""
    files = scan(spark, folder, "*.json", recursive, content=True)
    raw = decode_text(F.col("content")) if gbk else F.make_valid_utf8(F.col("content").cast("string"))
    rows = files.select("path", "dir", "name", "stem", "length", raw.alias("raw"))
    return rows.withColumn("a", F.when(v.is_object(F.col("raw")), v.parse(F.col("raw"))))


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of JSON lines; blank lines and lines that are no JSON objects are left out. ``schema``: a struct type."""
    lines = spark.read.text(path).filter(F.trim("value") != "").filter(v.is_object(F.col("value")))
    return lines.select(F.from_json("value", schema).alias("r")).select("r.*")


def with_index(records: DataFrame) -> DataFrame:
    """``records`` with ``index``: the place in load order, from 0 without gaps."""
    return numbered(records).withColumnRenamed("rank", "index")


def indexed_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, index) of the lines of text files, blank ones too."""
    return with_index(spark.read.text(path))


def jsonl_preflight(spark: SparkSession, path: str, n: int = 5) -> DataFrame:
    """(ok, bad) among the first ``n`` lines that are not blank."""
    first = spark.read.text(path).filter(F.trim("value") != "").limit(n)
    ok = v.is_object(F.col("value"))
    return first.agg(F.count_if(ok).alias("ok"), F.count_if(~ok).alias("bad"))


def read_statistics(spark: SparkSession, path: str) -> DataFrame:
    """(source_dir, label, cnt, file) of label statistics files; a missing or broken file has no rows. The source folder falls
    back to that of ``statistics_info``. A file is read by ranges, however large it is."""
    found = json_values(spark, path, ["source_dir"], ["statistics_info", "source_dir"], ["label_counts", ANY, ANY, EACH])
    text = F.get(F.from_json(F.concat(F.lit("["), "value", F.lit("]")), "array<string>"), 0)
    sources = found.filter("place < 2").withColumn("_s", F.nullif(text, F.lit(""))).filter("_s is not null")
    sources = sources.groupBy("path").agg(F.min_by("_s", F.struct("place", -F.col("start"))).alias("source_dir"))  # a row per file
    rows = found.filter("place = 2").join(sources, "path", "left")
    return rows.select("source_dir", F.get("keys", 0).alias("label"), F.get("keys", 1).cast("int").alias("cnt"), text.alias("file"))


def read_partial_results(spark: SparkSession, pattern: str) -> DataFrame:
    """Results of all workers' files ({"results": [...]}), which are read by ranges; ``by_index`` orders them where that is wanted."""
    rows = json_values(spark, pattern, ["results", EACH])
    return rows.select(F.from_json("value", RESULT).alias("r")).select("r.*")


def by_index(results: DataFrame) -> DataFrame:
    """Merged results in the order of their index: a range sort, for a sink."""
    return results.orderBy("index")


def read_gpu_log(spark: SparkSession, path: str) -> DataFrame:
    wide = spark.read.option("header", True).csv(path)
    return unpivot_gpus(wide.withColumns({"timestamp": F.col("timestamp").cast("timestamp"), "step": F.col("step").cast("int")}))


def write_json(df: DataFrame, path: str, pretty: bool = False) -> None:
    """One JSON object per row."""
    options = {"pretty": "true"} if pretty else {}
    df.select(F.to_json(F.struct("*"), options).alias("value")).write.mode("overwrite").text(path)


def write_splits(records: DataFrame, path: str, schema: str = "openai") -> None:
    """JSON lines in a folder per split; ``val`` is written as ``valid``. Records with messages lose their answers in splits for
    testing (``records.strip_answers``)."""
    if "messages" in records.columns:
        records = strip_answers(records, schema)
    name = F.when(F.col("split") == "val", "valid").otherwise(F.col("split"))
    body = F.to_json(F.struct(*[c for c in records.columns if c != "split"]))
    records.select(name.alias("split"), body.alias("value")).write.mode("overwrite").partitionBy("split").text(path)


def write_dataset_info(records: DataFrame, labels: DataFrame, path: str) -> None:
    """A one-row JSON of split statistics and the class matrix."""
    splits = split_stats(records).agg(F.collect_list(F.struct("*")).alias("splits"))
    classes = class_matrix(labels).agg(F.sort_array(F.collect_list(F.struct("*"))).alias("classes"))
    both = splits.withColumn("_k", F.lit(0)).join(classes.withColumn("_k", F.lit(0)), "_k").drop("_k")  # one row each
    both.select(F.to_json(F.struct("*")).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def copy_plan(rows: DataFrame, base: str, target: str, keep_structure: bool = True) -> DataFrame:
    """(src, dst, kind) of annotation and image copies; an image lands beside its annotation."""
    below = v.relative_path(F.col("path"), base) if keep_structure else F.regexp_extract("path", r"([^/]*)$", 1)
    dst = F.concat(F.lit(target.rstrip("/") + "/"), below)
    beside = F.concat(F.regexp_extract(dst, r"^(.*/)[^/]*$", 1), F.regexp_extract("image", r"([^/]*)$", 1))
    pairs = F.array(F.struct(F.col("path").alias("src"), dst.alias("dst"), F.lit("annotation").alias("kind")), F.struct(F.col("image").alias("src"), beside.alias("dst"), F.lit("image").alias("kind")))
    return rows.select(F.explode(pairs).alias("c")).select("c.*").filter("src is not null")


def filter_copy_plan(listed: DataFrame, manifest: DataFrame) -> DataFrame:
    """(file, status): files of a statistics table that exist are copied, others missing."""
    files = listed.select("file").distinct()
    return files.join(manifest.select(F.col("path").alias("file"), F.lit(True).alias("_there")), "file", "left").select("file", F.when(F.col("_there"), "copied").otherwise("missing").alias("status"))


def filter_copies(plan: DataFrame, target: str, images: DataFrame | None = None) -> DataFrame:
    """(src, dst, kind) of the plan's files that are there, and with ``images`` (file, image) of their images, under flat names in
    ``target``. Of equal names the first source keeps it, and others get free ones (``names.free_names``)."""
    there = plan.filter("status = 'copied'").select("file")
    rows = there.select(F.col("file").alias("src"), F.lit("annotation").alias("kind"))
    if images is not None:
        found = there.join(images.filter("image is not null"), "file").select(F.col("image").alias("src"), F.lit("image").alias("kind")).distinct()
        rows = rows.unionAll(found)
    rows = free_names(rows.withColumn("name", F.regexp_extract("src", r"([^/]*)$", 1)), "name", "src", "kind")
    return rows.select("src", F.concat(F.lit(target.rstrip("/") + "/"), "target").alias("dst"), "kind")


def write_keyed(exported: DataFrame, path: str, names: str | None = None) -> DataFrame:
    """Write each payload of (file, payload) to ``path/<file>``; returns one row of the counts written and failed, from the tasks' own
    messages. A row with a null payload or name fails and doesn't stop the others; a task that fails leaves no file. The names written
    go to a new folder ``names``, if given, as a table that ``read_keyed`` takes."""
    spark = exported.sparkSession
    spark.dataSource.register(KeyedFiles)
    report = f"{shared_folder(spark, 'report')}/counts.json"
    options = {"path": path, "report": report} | ({"names": names} if names else {})
    exported.select("file", "payload").write.format("keyed_files").mode("append").options(**options).save()
    counts = read_report(report)
    return spark.createDataFrame([(counts["written"], counts["failed"])], "written long, failed long")


def _contents(path: str) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """(file, payload) of named files below ``path``, about ``HELD`` bytes at a time."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = filesystem(path.rstrip("/"))
        rows, held = [], 0
        for frame in frames:
            for name in frame["file"]:
                with store.open_input_file(f"{base}/{name}") as found:
                    body = found.read()
                if body:
                    rows.append((name, body))
                held += len(body)
                if held >= HELD:
                    yield pd.DataFrame(rows, columns=["file", "payload"])
                    rows, held = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=["file", "payload"])

    return run


def read_keyed(spark: SparkSession, path: str, names: str | None = None) -> DataFrame:
    """(file, payload) of the files of a folder, as ``write_keyed`` wrote them. Spark's readers pass over empty files. With ``names``, the
    folder of names that ``write_keyed`` left, tasks open those files by name and nothing is listed on the driver."""
    if names:
        listed = spark.read.schema("file string").parquet(names)
        parts = min(20_000, max(spark.sparkContext.defaultParallelism, listed.count() // NAMES + 1))
        found = listed.repartition(parts, "file").dropDuplicates(["file"]).mapInPandas(_contents(path), "file string, payload binary")
        return found.select("file", F.col("payload").cast("string").alias("payload"))
    rows = scan(spark, path, recursive=True, content=True)
    return rows.select(v.relative_path(F.col("path"), re.sub("^file:/+", "/", path)).alias("file"), F.col("content").cast("string").alias("payload"))


def export_messages(records: DataFrame, path: str) -> None:
    """The messages of records, without metadata, as Parquet."""
    records.select("messages").write.mode("overwrite").parquet(path)


def fetch_plan(urls: DataFrame) -> DataFrame:
    """(url, local_name): the stem, eight digits of the URL's MD5, and an extension of at most five characters before any "?", else .jpg."""
    clean = F.regexp_extract("url", r"^([^?#]*)", 1)
    name = F.regexp_extract(clean, r"([^/]*)$", 1)
    ext = F.regexp_extract(name, r"(\.[A-Za-z0-9]{1,4})$", 1)
    stem = F.when(ext != "", F.expr("substring(_n, 1, length(_n) - length(_e))")).otherwise(F.col("_n"))
    return urls.withColumns({"_n": name, "_e": ext}).select("url", F.concat(stem, F.lit("_"), F.substring(F.md5("url"), 1, 8), F.when(F.col("_e") == "", ".jpg").otherwise(F.col("_e"))).alias("local_name"))


def fetch(urls: DataFrame, get: Callable[[str], bytes], least: int = 100) -> DataFrame:
    """``urls`` with content and error, by a caller's function; payloads under ``least`` bytes are errors."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for url, name in zip(frame["url"], frame["local_name"]):
                try:
                    body = get(url)
                    rows.append((url, name, body if len(body) >= least else None, None if len(body) >= least else "too small"))
                except Exception as e:  # a failing URL doesn't stop the job
                    rows.append((url, name, None, str(e)))
            yield pd.DataFrame(rows, columns=["url", "local_name", "content", "error"])

    return fetch_plan(urls).mapInPandas(run, "url string, local_name string, content binary, error string")


def prefer_split(files: DataFrame, order=("test", "valid", "val"), by: str | None = None) -> DataFrame:
    """The one evaluation file (path, stem) that comes first in this order, or per value of column ``by`` (a folder); where none of
    the names is there, the first file by path stands for itself."""
    rank = F.array_position(F.array(*[F.lit(s) for s in order]), F.col("stem"))
    place = F.when(rank > 0, rank).otherwise(len(order) + 1)
    return files.groupBy(*([by] if by else [])).agg(F.min_by(F.struct("path", "stem"), F.struct(place, F.col("path"))).alias("f")).filter("f is not null").select(*([by] if by else []), "f.*")


def write_results(samples: DataFrame, path: str) -> None:
    """Per-sample results by model and split; a model's split that is written again replaces its old rows only. Readers see all of it or
    nothing: a failed write leaves the old rows."""
    snapshots.write(samples, path, "model", "split")


def read_results(spark: SparkSession, path: str, model: str | None = None, split: str | None = None) -> DataFrame | None:
    """Stored results, or None where there are none yet; filters reach the partition folders."""
    rows = snapshots.read(spark, path)
    for column, value in (("model", model), ("split", split)):
        rows = rows.filter(F.col(column) == value) if rows is not None and value else rows
    return rows


def _wanted(model: str | None, split: str | None) -> Callable[[dict[str, str]], bool]:
    return lambda values: (not model or values["model"] == model) and (not split or values["split"] == split)


def has_results(spark: SparkSession, path: str, model: str | None = None, split: str | None = None) -> bool:
    """Whether rows are stored: any, a model's, a split's, or a model's split. Only the manifest is read."""
    return any(_wanted(model, split)(snapshots.values(f)) for f in snapshots.current(spark, path).folders)


def clear_results(spark: SparkSession, path: str, model: str | None = None, split: str | None = None) -> None:
    """Delete stored results: all of them, a model's, a split's of all models, or a model's split. Readers that have begun may fail."""
    if has_results(spark, path, model, split):
        snapshots.remove(spark, path, _wanted(model, split))
        snapshots.vacuum(spark, path, keep=1)


def load_or_compute(spark: SparkSession, path: str, model: str, split: str, compute: Callable[[], DataFrame]) -> DataFrame:
    """A model's results of a split: the stored ones where there are any, else those of ``compute``, which are stored."""
    if has_results(spark, path, model, split):
        return read_results(spark, path, model, split)
    computed = compute().withColumns({"model": F.lit(model), "split": F.lit(split)})
    write_results(computed, path)
    found = read_results(spark, path, model, split)
    return computed.limit(0) if found is None else found


def comparison_outputs(spark: SparkSession, path: str, base: str, tuned: str, summary: DataFrame | None = None) -> dict[str, DataFrame]:
    """Stored metrics of two models: ``base``, ``tuned`` and their aggregate ``table``, whose values are the summary's where it has
    them. A model without stored results raises FileNotFoundError."""
    found = {side: read_results(spark, path, model) for side, model in (("base", base), ("tuned", tuned))}
    missing = [m for m in (base, tuned) if not has_results(spark, path, m)]
    if missing:
        raise FileNotFoundError(f"no stored results of {missing} in {path}")
    table = ev.aggregate_metrics(read_results(spark, path).filter(F.col("model").isin(base, tuned)), "model", "split")
    return found | {"table": ev.with_summary(table, summary, [c for c in table.columns if c not in ("model", "split")])}


def image_sizes(files: DataFrame) -> DataFrame:
    """(path, width, height) from the headers of PNG, GIF, BMP and JPEG files (path, content); null where unknown. A JPEG is
    walked through to its size marker, however much metadata stands before it."""

    def size(b: bytes) -> tuple[int, int] | None:
        if b[:8] == b"\x89PNG\r\n\x1a\n":
            return struct.unpack(">II", b[16:24])
        if b[:3] == b"GIF":
            return struct.unpack("<HH", b[6:10])
        if b[:2] == b"BM":
            w, h = struct.unpack("<ii", b[18:26])
            return w, abs(h)
        at = 2
        while b[:2] == b"\xff\xd8" and at + 9 < len(b):
            marker, length = b[at + 1], struct.unpack(">H", b[at + 2 : at + 4])[0]
            if 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
                h, w = struct.unpack(">HH", b[at + 5 : at + 9])
                return w, h
            at += 2 + length
        return None

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [size(bytes(b)) or (None, None) for b in frame["content"]]
            yield pd.DataFrame({"path": frame["path"], "width": pd.array([w for w, _ in found], dtype="Int32"), "height": pd.array([h for _, h in found], dtype="Int32")})

    jpeg = F.hex(F.substring("content", 1, 2)) == "FFD8"
    head = F.when(jpeg, F.col("content")).otherwise(F.substring("content", 1, 64))
    return files.select("path", head.alias("content")).mapInPandas(run, "path string, width int, height int")


def load_templates(path_text: str) -> dict[str, str]:
    """Custom prompt templates of a JSON text: keys like all_in_one_en."""
    found = json.loads(path_text)
    bad = [k for k in found if not re.fullmatch(r"(all_in_one|per_class)_(en|zh)", k)]
    if bad:
        raise ValueError(f"unknown template keys: {bad}")
    return found
