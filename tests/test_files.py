"""Sources, sinks and pipelines over a temporary folder."""

import io
import json
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from annospark.operators import infer
from annospark.plans import pipelines
from annospark.sources import files
from annospark.streaming import stream


def annotation(image, *labels):
    return json.dumps({"imagePath": image, "imageWidth": 640, "imageHeight": 480, "shapes": [{"label": x, "shape_type": "rectangle", "points": [[10, 20], [110, 220]]} for x in labels]})


def folder(tmp_path):
    src = tmp_path / "src"
    (src / "sub").mkdir(parents=True)
    for k in range(5):
        (src / f"img_{k}.json").write_text(annotation(f"img_{k}.jpg", "cat", "dog"))
        (src / f"img_{k}.jpg").write_bytes(b"x" * 200)
    (src / "sub" / "bad.json").write_text("{bad")
    (src / "sub" / "gone.json").write_text(annotation("gone.jpg", "cat"))
    return str(src)


def test_scan_and_clean(spark, tmp_path):
    src = folder(tmp_path)
    assert files.scan(spark, src, "*.json").count() == 7
    assert files.scan(spark, src, "*.json", recursive=False).count() == 5
    assert files.scan(spark, f"{src}/none").count() == 0
    out = pipelines.clean(spark, src, str(tmp_path / "out"), {"cat": "feline"})
    s = out["summary"].first()
    assert (s.total, s.valid, s.invalid_json, s.missing_image) == (7, 5, 1, 1)
    assert out["copies"].count() == 10
    assert {r.status for r in out["integrity"].collect()} == {"pass"}
    assert {(r.label, r.files) for r in out["labels"].collect()} == {("feline", 5), ("dog", 5)}
    report = [r.value for r in spark.read.text(str(tmp_path / "out/report")).collect()]
    assert "total: 7" in report and any(line.startswith("invalid_json: ") and line.endswith("bad.json") for line in report) and any(line.startswith("missing_image: ") for line in report)
    c = out["set"].first()
    assert (c.files, c.annotations, c.most, c.label_list) == (5, 10, 2, ["cat", "dog"])
    row = out["standard"].first()
    assert row.cleaning_status == "cleaned" and len(row.cleaned_at) == 19 and row.source_path == row.path


def test_statistics_sampling_and_prescan(spark, tmp_path):
    src = folder(tmp_path)
    found = pipelines.label_statistics(spark, src)
    assert {(r.label, r.files, r.instances) for r in found["summary"].collect()} == {("cat", 6, 6), ("dog", 5, 5)}
    assert pipelines.balanced_sample(spark, src, 8)["selected"].count() == 16
    p = pipelines.prescan(spark, src)["files"].first()
    assert (p.scanned, p.skipped, p.url, p.local) == (6, 1, 0, 6)
    stat = tmp_path / "stat.json"
    stat.write_text(json.dumps({"statistics_info": {"source_dir": src}, "label_counts": {"cat": {"1": [f"{src}/img_0.json", f"{src}/none.json"]}}}))
    assert {r.status for r in pipelines.filter_copy(spark, str(stat), src).collect()} == {"copied", "missing"}
    assert files.read_statistics(spark, str(tmp_path / "nothing.json")).count() == 0


def test_jsonl(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    path.write_text('{"a": 1}\n\nnot json\n{"a": 2}\n')
    rows = files.with_index(files.read_jsonl(spark, str(path), "struct<a:int>")).collect()
    assert [(r.a, r["index"]) for r in rows] == [(1, 0), (2, 1)]
    r = files.jsonl_preflight(spark, str(path)).first()
    assert (r.ok, r.bad) == (2, 1)


def test_gbk(spark, tmp_path):
    (tmp_path / "g.json").write_bytes('{"imagePath":"图像文件.jpg","shapes":[]}'.encode("gbk"))
    (tmp_path / "u.json").write_text('{"imagePath":"图.jpg","shapes":[]}', encoding="utf-8")
    rows = {r.stem: r.a.imagePath for r in files.read_annotations(spark, str(tmp_path)).collect()}
    assert rows == {"g": "图像文件.jpg", "u": "图.jpg"}
    assert "图" not in (files.read_annotations(spark, str(tmp_path), gbk=False).filter("stem = 'g'").first().raw or "")


def test_headers(spark):
    png = b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + struct.pack(">II", 64, 48) + b"\0" * 20
    sizes = {r.path: (r.width, r.height) for r in files.image_sizes(spark.createDataFrame([("a", png), ("b", b"??")], "path string, content binary")).collect()}
    assert sizes == {"a": (64, 48), "b": (None, None)}


def test_fetch(spark):
    urls = spark.createDataFrame([("http://h/a.png?x=1",), ("http://h/b",), ("http://h/fail.jpg",)], "url string")

    def get(url):
        if "fail" in url:
            raise OSError("down")
        return b"y" * (200 if "a.png" in url else 5)

    rows = {r.url: r for r in files.fetch(urls, get).collect()}
    assert rows["http://h/a.png?x=1"].local_name.endswith(".png") and rows["http://h/a.png?x=1"].error is None
    assert rows["http://h/b"].local_name.endswith(".jpg") and rows["http://h/b"].error == "too small"
    assert rows["http://h/fail.jpg"].error == "down"


def test_results_store_and_inference(spark, tmp_path):
    rows = spark.range(10).select(F.col("id").alias("index"), F.when(F.col("id") < 5, "train").otherwise("test").alias("split"), F.concat(F.lit("i"), F.col("id").cast("string")).alias("image_path"), F.lit("q").alias("query"), F.from_json(F.lit('[{"bbox":[0,0,10,10],"label":"a"}]'), "array<struct<bbox:array<int>,label:string>>").alias("gts"))

    def good():
        def model(pairs):
            if len(pairs) > 1 and any(p == "i3" for p, _ in pairs):
                raise RuntimeError("batch failed")
            if pairs[0][0] == "i3":
                raise RuntimeError("row failed")
            return ['[{"bbox":[0,0,10,10],"label":"a"}]'] * len(pairs)

        return model

    out = pipelines.sharded_inference(rows, {"m": good}, 2, F.lit(100), F.lit(100), str(tmp_path / "store"))
    assert {r["index"]: r.success for r in out["results"].collect()}[3] is False
    assert [r["index"] for r in out["merged"].collect()] == list(range(10))
    assert sum(r.samples for r in out["workers"].collect()) == 10 and sum(r.failed for r in out["workers"].collect()) == 1
    assert out["exported"].filter("payload is not null").count() == 10
    agg = {r.split: r.success_rate for r in out["aggregates"].collect()}
    assert agg == {"train": 0.8, "test": 1.0}
    assert files.read_results(spark, str(tmp_path / "none")) is None
    assert infer.predict(rows.limit(0), good).count() == 0


def test_convert_writes_splits(spark, tmp_path):
    from annospark import fixtures

    notes = fixtures.annotations(spark, "/root/testdata/sf0.001").limit(300)
    done = pipelines.convert(notes, str(tmp_path / "set"))
    assert done.groupBy("image_key").agg(F.countDistinct("split").alias("n")).filter("n > 1").count() == 0
    lines = spark.read.text(str(tmp_path / "set/data"))
    assert lines.count() == done.count() and "valid" in {r.split for r in lines.select("split").distinct().collect()}


def test_annotation_stream(spark, tmp_path):
    src = folder(tmp_path)
    counts = stream.running_label_counts(stream.annotation_stream(spark, src))
    q = counts.writeStream.format("memory").queryName("labels").outputMode("complete").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert {(r.label, r.n) for r in spark.table("labels").collect()} == {("cat", 6), ("dog", 5)}


def test_size_of_a_jpeg_behind_much_metadata(spark):
    segment = b"\xff\xe2" + struct.pack(">H", 60002) + b"\x00" * 60000
    frame = b"\xff\xc0" + struct.pack(">HBHHB", 17, 8, 480, 640, 3) + b"\x00" * 9
    rows = [(str(n), b"\xff\xd8" + segment * n + frame + b"\xff\xd9") for n in (0, 1, 2, 5)] + [("cut", b"\xff\xd8" + segment * 2)]
    found = {r.path: (r.width, r.height) for r in files.image_sizes(spark.createDataFrame(rows, "path string, content binary")).collect()}
    assert found == {"0": (640, 480), "1": (640, 480), "2": (640, 480), "5": (640, 480), "cut": (None, None)}


def inference_records(spark):
    return spark.range(6).select(F.col("id").alias("index"), F.when(F.col("id") < 3, "train").otherwise("test").alias("split"), F.concat(F.lit("i"), F.col("id").cast("string")).alias("image_path"), F.lit("q").alias("query"), F.from_json(F.lit('[{"bbox":[0,0,10,10],"label":"a"}]'), "array<struct<bbox:array<int>,label:string>>").alias("gts"))


def test_two_models_are_compared_and_not_inferred_again(spark, tmp_path):
    calls = str(tmp_path / "calls")

    def make(box):
        def build():
            def model(pairs):
                with open(calls, "a") as f:
                    f.write("x" * len(pairs))
                return [f'[{{"bbox":[{box}],"label":"a"}}]'] * len(pairs)

            return model

        return build

    models = {"base": make("0,0,10,5"), "tuned": make("0,0,10,10")}
    for _ in range(2):
        out = infer.evaluate_models(inference_records(spark), models, F.lit(100), F.lit(100), store=str(tmp_path / "store"))
        assert {(r.model, r.split): r.mean_match_iou_mean for r in out["aggregates"].collect()} == {("base", "train"): 0.5, ("base", "test"): 0.5, ("tuned", "train"): 1.0, ("tuned", "test"): 1.0}
        assert {r.split: r.mean_iou for r in out["cross_iou"].collect()} == {"train": 0.5, "test": 0.5}
    assert len(open(calls).read()) == 12
    changes = pipelines.compare_models(out["metrics"], "base", "tuned")
    assert changes["gap"].first().verdict == "similar" and {r.metric for r in changes["changes"].collect()} == {"mean_match_iou"}
    assert [(r.split, r.model) for r in changes["table"].collect()] == [("train", "base"), ("train", "tuned"), ("test", "base"), ("test", "tuned")]


def test_stored_results(spark, tmp_path):
    path, made = str(tmp_path / "r"), []
    metrics = spark.createDataFrame([(1, 0.5, 0.5, 0.5, 1, 1, 1, 0.5, True)], "index long, precision double, recall double, f1 double, num_det int, num_gt int, num_match int, mean_match_iou double, det_success boolean")
    compute = lambda: made.append(1) or metrics
    for model, split in (("a", "train"), ("a", "train"), ("a", "test"), ("b", "train")):
        assert files.load_or_compute(spark, path, model, split, compute).count() == 1
    assert len(made) == 3
    summary = spark.createDataFrame([("a", "train", 0.75)], "model string, split string, f1_mean double")
    found = files.comparison_outputs(spark, path, "b", "a", summary)
    assert {(r.model, r.split): r.f1_mean for r in found["table"].collect()} == {("a", "train"): 0.75, ("a", "test"): 0.5, ("b", "train"): 0.5}
    files.clear_results(spark, path, "a", "train")
    assert {(r.model, r.split) for r in files.read_results(spark, path).select("model", "split").collect()} == {("a", "test"), ("b", "train")}
    files.clear_results(spark, path, "b")
    with pytest.raises(FileNotFoundError):
        files.comparison_outputs(spark, path, "b", "a")
    files.clear_results(spark, path)
    assert files.read_results(spark, path) is None


def test_both_strategies_are_split_and_written_apart(spark, tmp_path):
    from annospark import fixtures

    notes = fixtures.annotations(spark, "/root/testdata/sf0.001").limit(200)
    done = pipelines.convert(notes, str(tmp_path / "set"), strategy="both", shared_split=True, schema="sharegpt")
    assert done.groupBy("image_key").agg(F.countDistinct("split").alias("n")).filter("n > 1").count() == 0
    for name in ("all_in_one", "per_class"):
        lines = spark.read.text(str(tmp_path / f"set/{name}/data")).select("split", F.from_json("value", f"struct<messages:{files.MESSAGES}>").alias("r"))
        assert {(r.split, r.n) for r in lines.select("split", F.size("r.messages").alias("n")).distinct().collect()} == {("train", 2), ("valid", 1), ("test", 1)}
        assert lines.count() == done.filter(F.col("strategy") == name).count()
        assert json.loads(spark.read.text(str(tmp_path / f"set/{name}/dataset_info")).first().value)["classes"]


def test_directory_conversion_and_format_check(spark, tmp_path):
    src = folder(tmp_path)
    (tmp_path / "src" / "broken.json").write_text("{bad")
    counts = pipelines.convert_directory(spark, src, str(tmp_path / "boxes")).first()
    assert (counts.total_files, counts.converted, counts.failed) == (6, 5, 1)
    first = files.read_keyed(spark, str(tmp_path / "boxes")).filter("file = 'img_0_boxes.json'").withColumnRenamed("payload", "value").first()
    assert json.loads(first.value)[0] == {"box_2d": [42, 16, 458, 172], "label": "cat"}
    path = tmp_path / "r.jsonl"
    path.write_text('{"messages":[{"role":"user"}],"images":[]}\n\n{"messages":[],"images":[]}\n')
    assert pipelines.verify_format(spark, str(path), 1).first().passed
    assert pipelines.verify_format(spark, str(path)).first().errors == "1:not_json; 2:no_messages"


def test_runs_with_their_summaries(spark):
    rows = spark.createDataFrame([("g", "one", 10.0, None, 5.0), ("g", "two", 5.0, 0.5, 10.0)], "grp string, run string, seconds double, loss double, throughput double")
    found = {r.run: r for r in pipelines.compare_runs(rows, spark.createDataFrame([("one", 0.75)], "run string, loss double"), ["loss"], F.col("run") == "one").collect()}
    assert (found["two"].speedup, found["two"].loss_diff, found["one"].saved_pct) == (2.0, -0.25, 0.0)
