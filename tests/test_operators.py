"""Small fixtures with known results."""

import json
import math

import pytest
from pyspark.sql import functions as F

from annospark.functions import geometry as g
from annospark.functions import text as t
from annospark.operators import evaluate, sample, split, stats, validate, work


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "raw, status",
    [
        ('{"version": 5, ', "invalid_json"),
        ('{"imagePath": "k7.png", "version": 5}', "missing_shapes"),
        ('{"imagePath": "k7.png", "shapes": "two"}', "missing_shapes"),
        ('{"imagePath": "k7.png", "shapes": null}', "missing_shapes"),
        ('{"shapes": [], "imagePath": "k7.png"}', "empty_shapes"),
        ('{"shapes": [{"label": "mast"}, {}], "imagePath": ""}', "invalid_image_path"),
        ('{"shapes": [{}], "imagePath": "k7.png"}', "valid"),
        ('"shapes"', "invalid_json"),
        (None, "invalid_json"),
    ],
)
def test_structure_status(spark, raw, status):
    assert one(spark, validate.structure_status(F.lit(raw).cast("string"))) == status


def box(a, b, c, d):
    return g.box(*[F.lit(float(v)) for v in (a, b, c, d)])


def test_normalisation_rounds_half_to_even(spark):
    b = box(333, 30, 50, 257)  # corners in another order
    assert tuple(one(spark, g.normalize(b, F.lit(800), F.lit(400), "norm_1"))) == (0.0625, 0.075, 0.4162, 0.6425)
    assert tuple(one(spark, g.normalize(b, F.lit(800), F.lit(400), "norm_1000"))) == (62, 75, 416, 642)
    assert tuple(one(spark, g.normalize(b, F.lit(800), F.lit(400), "norm_100"))) == (6, 8, 42, 64)
    assert one(spark, g.normalize(b, F.lit(-1), F.lit(400))) is None
    with pytest.raises(ValueError):
        g.normalize(b, F.lit(1), F.lit(1), "norm_7")


def test_layouts(spark):
    b = box(30, 12, 50, 92)
    expected = {"xyxy": [30, 12, 50, 92], "yxyx": [12, 30, 92, 50], "xywh": [30, 12, 20, 80], "cxcywh": [40, 52, 20, 80]}
    for kind, numbers in expected.items():
        assert one(spark, g.layout(b, kind)) == numbers
        assert tuple(one(spark, g.from_layout(F.array(*[F.lit(float(v)) for v in numbers]), kind))) == (30, 12, 50, 92)
    assert one(spark, g.coords_text(F.array(F.lit(0.5), F.lit(0.33339), F.lit(1.0), F.lit(0.0)), "norm_1")) == "[0.5000, 0.3334, 1.0000, 0.0000]"


def parsed(spark, text, **options):
    found = one(spark, t.parse_detections(F.lit(text), F.lit(200), F.lit(1000), **options))
    return [(list(d.bbox), d.label, d.confidence) for d in found]


def test_parse_detections(spark):
    good = '[{"label":"mast","box_2d":[0.25,0.04,0.75,0.9],"confidence":0.6}]'
    assert parsed(spark, good) == [([50, 40, 150, 900], "mast", 0.6)]
    assert parsed(spark, f"Sure:\n```json\n{good}\n```\nAnything else?") == [([50, 40, 150, 900], "mast", 0.6)]
    for bad in ("none seen", '[{"name":"mast"}]', '[{"box_2d":[7,8]}]', '[{"box_2d":[7,8,9,10,11]}]', '[{"box_2d":["7","8","9","10"]}]', "[7, 8]", "[]", ""):
        assert parsed(spark, bad) == []
    loose = '{"box_2d":[50,40,150,900],"label":"buoy"}'
    assert parsed(spark, f"One is {loose}, the other {loose}") == [([50, 40, 150, 900], "buoy", 1.0)] * 2
    for given, confidence in (("17", 1.0), ("-3", 0.0), ('"sure"', 1.0)):
        assert parsed(spark, '[{"box_2d":[7,8,9,10],"confidence":%s}]' % given)[0][1:] == ("object", confidence)
    assert parsed(spark, '[{"box_2d":[250,40,750,900]}]', auto_tiers=True)[0][0] == [50, 40, 150, 900]
    assert parsed(spark, '[{"box_2d":[50,40,150,900]}]', out_layout="xywh")[0][0] == [50, 40, 100, 860]
    assert parsed(spark, '[{"box_2d":[9,9,3,9]}]', clamp=True) == []


def test_response_round_trip(spark):
    boxes = F.array(F.struct(F.array(*[F.lit(float(v)) for v in (10, 20, 30, 40)]).alias("coords"), F.lit('a "q" b').alias("label")))
    text = one(spark, t.json_response(boxes))
    assert text == '[{"box_2d": [10, 20, 30, 40], "label": "a \\"q\\" b", "coord_format": "xyxy", "coord_norm": "norm_1000"}]'
    assert json.loads(text)[0]["label"] == 'a "q" b'


def samples(spark, dets, gts):
    schema = "dets array<struct<bbox:array<int>,label:string>>, gts array<struct<bbox:array<int>,label:string>>"
    return spark.createDataFrame([(dets, gts)], schema)


@pytest.mark.parametrize(
    "dets, gts, dialect, expected",
    [
        ([], [], "notebook", (1, 1, 1, True)),
        ([], [], "distributed", (1, 1, 1, True)),
        ([([0, 0, 10, 10], "a")], [], "notebook", (0, 1, 0, False)),
        ([], [([0, 0, 10, 10], "a")], "notebook", (1, 0, 0, False)),
        ([], [([0, 0, 10, 10], "a")], "distributed", (0, 0, 0, False)),
        ([([0, 0, 10, 10], "dog")], [([0, 0, 10, 10], "cat")], "notebook", (1, 1, 1, True)),
        ([([0, 0, 10, 10], "dog")], [([0, 0, 10, 10], "cat")], "distributed", (0, 0, 0, False)),
        ([([0, 0, 10, 10], " Dog")], [([0, 0, 10, 10], "dog")], "distributed", (1, 1, 1, True)),
    ],
)
def test_metrics(spark, dets, gts, dialect, expected):
    r = evaluate.sample_metrics(samples(spark, dets, gts), dialect=dialect).first()
    assert (r.precision, r.recall, r.f1, r.det_success) == expected


def test_greedy_match_takes_each_box_once(spark):
    d = [([0, 0, 10, 10], "a"), ([0, 0, 10, 10], "a"), ([0, 1, 10, 11], "a")]
    r = evaluate.sample_metrics(samples(spark, d, [([0, 0, 10, 10], "a"), ([0, 1, 10, 11], "a")])).first()
    assert (r.num_match, r.num_det, r.num_gt) == (2, 3, 2)
    assert math.isclose(r.mean_match_iou, (1 + 90 / 110) / 2)


def counts(spark, images, each=1):
    return spark.createDataFrame([("cat", i, each) for i in range(images)], "label string, image_id int, cnt int")


def test_sampling(spark):
    rows = sample.sample_images(counts(spark, 3), 10).collect()
    assert len(rows) == 10 and sum(r.duplicate for r in rows) == 7
    assert sample.sample_images(counts(spark, 10), 5).filter("duplicate").count() == 0
    assert sample.sample_labels(counts(spark, 10, 5), 20).count() == 4
    assert sample.sample_labels(counts(spark, 3, 2), 10).count() == 5
    assert sample.sample_images(counts(spark, 3).limit(0), 5).count() == 0


def test_label_summary(spark):
    rows = spark.createDataFrame([("a", "cat", 3), ("b", "cat", 3), ("c", "cat", 1)], "image_id string, label string, cnt int")
    assert tuple(stats.label_summary(rows).first()) == ("cat", 3, 7, 3, 1)


def test_split_is_a_partition_of_images(spark):
    keys = spark.range(103).select(F.col("id").alias("image_key"), F.when(F.col("id") < 5, "rare").otherwise("common").alias("label"))
    keys = keys.unionAll(keys.filter("image_key < 5").withColumn("label", F.lit("common")))
    rows = split.stratified_split(keys).collect()
    assert len({r.image_key for r in rows}) == len(rows) == 103
    assert {r.split for r in rows if r.stratum == "rare"} == {"train"}
    n = {s: sum(r.split == s and r.stratum == "common" for r in rows) for s in split.SPLITS}
    assert n == {"train": 98 - 9 - 9, "val": 9, "test": 9}
    seq = {r.image_key: r.split for r in split.split_images(keys, "7:3:0").collect()}
    assert [seq[k] for k in (0, 71, 72, 102)] == ["train", "train", "val", "val"]
    for bad in ("8:1", "a:b:c", "0:0:0"):
        with pytest.raises(ValueError):
            split.parse_ratio(bad)


def raised(kind, call):
    try:
        call()
    except kind as x:
        return [x]
    return []


def test_work_reports(spark):
    tasks = spark.createDataFrame([(0, 0, 10.0, "done"), (1, 0, 9.0, "failed"), (2, 1, 1.0, "pending"), (3, 1, 1.0, "done"), (4, 1, 1.0, "done"), (5, 1, 1.0, "done")], "sample_index long, worker int, cost double, status string")
    p = work.progress(tasks).first()
    assert (p.total, p.completed, p.processed, p.failed, p.pending, p.claimed, p.remaining) == (6, 5, 4, 1, 1, 0, 1)
    assert [c.counts["in_flight"] for c in raised(work.IncompleteWork, lambda: work.check_completion(tasks))] == [0]
    assert work.check_completion(tasks.filter("status <> 'pending'"))["done"] == 5
    layouts = {r.layout: r.makespan for r in work.layout_report(tasks, 2).collect()}
    assert layouts["contiguous"] == 20.0
    plan = {r.sample_index: r.batch for r in work.batch_plan(tasks.withColumn("cost", F.lit(1.0)), 2).collect()}
    assert [plan[i] for i in range(5)] == [0, 0, 1, 1, 2]


def test_image_lookup(spark):
    m = spark.createDataFrame([("/d/test_image.jpg", "/d", "test_image.jpg", "test_image", ".jpg"), ("/d/other_name.jpg", "/d", "other_name.jpg", "other_name", ".jpg")], "path string, dir string, name string, stem string, ext string")
    a = spark.createDataFrame([("/d/test_image.json", "/d", "test_image", "other_name.jpg"), ("/d/unique.json", "/d", "unique", "other_name.jpg"), ("/d/x.json", "/d", "x", "/nowhere/x.jpg")], "path string, dir string, stem string, image_path string")
    strict = {r.stem: r.image for r in validate.find_images(a, m).collect()}
    assert strict == {"test_image": "/d/test_image.jpg", "unique": None, "x": None}
    assert {r.stem: r.image for r in validate.find_images(a, m, strict=False).collect()}["unique"] == "/d/other_name.jpg"


def test_ranks_within_groups(spark):
    rows = spark.createDataFrame([("hot", k % 7, k) for k in range(300)] + [("cold", 1, 5), ("cold", 0, 9), (None, 3, 3)], "g string, a int, b int")
    found = {(r.g, r.b): (r["rank"], r["n"]) for r in split.group_rank(rows, ["g"], "a", "b").filter("g is not null").collect()}
    for place, (_, b) in enumerate(sorted((k % 7, k) for k in range(300))):
        assert found["hot", b] == (place, 300)
    assert found["cold", 9] == (0, 2) and found["cold", 5] == (1, 2)
    assert split.group_rank(rows.limit(0), ["g"], "a").count() == 0


def test_record_faults(spark):
    cases = {
        "[]": "not_json", "{": "not_json", '{"text": 1}': "unknown_schema", '{"conversations": null}': "no_turns", '{"conversations": 4, "messages": []}': "no_turns",
        '{"conversations": [{"from": "gpt"}]}': "first_not_human", '{"conversations": [{"from": "human"}, {"from": "human"}]}': "second_not_gpt",
        '{"conversations": [{"from": "human"}, {"from": "human"}, {}], "id": 1, "image": "x"}': None, '{"conversations": [{"from": "human"}], "id": 1}': "no_image",
        '{"messages": [{"role": "user"}]}': "no_images", '{"messages": {}, "images": []}': "no_messages", '{"messages": [{}], "images": []}': "first_not_user", '{"messages": [{"role": "user"}], "images": []}': None,
    }
    rows = spark.createDataFrame(list(enumerate(cases)), "index long, value string")
    assert {r.value: r.e for r in rows.select("value", validate.record_error(F.col("value")).alias("e")).collect()} == cases
    r = validate.verify_records(rows, 4).first()
    assert (r.checked, r.valid, r.passed, r.errors) == (4, 0, False, "0:not_json; 1:not_json; 2:unknown_schema")
    assert validate.verify_records(rows.filter("index = 12"), 100).first().passed


def test_generalisation_compares_the_two_gaps(spark):
    rows = lambda *values: spark.createDataFrame([("b", "train", values[0]), ("b", "test", values[1]), ("t", "train", values[2]), ("t", "test", values[3])], "model string, split string, f1 double")
    for values, verdict in (((0.8, 0.5, 0.9, 0.7), "smaller_gap"), ((0.6, 0.5, 0.9, 0.7), "larger_gap"), ((0.5, 0.25, 0.75, 0.5), "similar"), ((0.9, 0.0, 0.9, 0.8), "larger_gap")):
        assert evaluate.generalisation(rows(*values), "b", "t").first().verdict == verdict


def test_answers_and_prompts_of_odd_labels(spark):
    boxes = F.array(*[F.struct(F.array(*[F.lit(float(v)) for v in (1, 2, 3, 4)]).alias("coords"), F.lit(x).alias("label")) for x in ('a "b"\\\n', "c")])
    for text in (t.json_response(boxes), t.legacy_response(boxes)):
        assert [b["label"] for b in json.loads(one(spark, text))] == ['a "b"\\\n', "c"]
    labels = F.array(F.lit("z"), F.lit("y"), F.lit("z"))
    assert one(spark, t.detection_prompt(labels, custom={"all_in_one_en": "<{class_list}>"})) == "<y, z>"
    assert one(spark, t.detection_prompt(labels, "per_class", "fr")) == "Detect: y, z"
    assert len({one(spark, t.detection_prompt(labels, s, lang, style=k)) for s in ("all_in_one", "per_class") for lang in ("en", "zh") for k in t.STYLES}) == 12
    assert one(spark, t.list_response(F.slice(boxes, 2, 1), "per_class", category=F.lit("c"))) == "1 of class c:\n- [1, 2, 3, 4]"
