"""The conversion with both strategies: boxes and splits are made once, and records come out as each strategy by itself makes them."""

import pytest
from pyspark.sql import functions as F

from annospark import fixtures
from annospark.functions import geometry
from annospark.operators import records, split
from annospark.plans import pipelines

SF = "/root/testdata/sf0.001"


def test_boxes_and_splits_of_both_strategies_are_made_once(spark, tmp_path, monkeypatch):
    order = (F.col("image_key") * 7919) % 10007
    notes, seen, splits, real, cut = fixtures.annotations(spark, SF), [], [], records.usable_boxes, split.stratified_split
    monkeypatch.setattr(records, "usable_boxes", lambda *a, **k: seen.append(1) or real(*a, **k))
    monkeypatch.setattr(split, "stratified_split", lambda *a, **k: splits.append(1) or cut(*a, **k))
    done = pipelines.convert(notes, str(tmp_path / "set"), order=order, strategy="both")
    assert (len(seen), len(splits)) == (1, 1)
    columns = ("record_id", "image_id", "image_key", "stem", "width", "height", "outcome", "labels", "num_objects", "n_invalid", "messages")
    for name in ("all_in_one", "per_class"):
        own = records.convert(notes, name)
        parts = cut(own.select("image_key", F.explode("labels").alias("label")), "8:1:1", order).select("image_key", "split")
        want = own.join(parts, "image_key", "left").select(*columns, F.coalesce("split", F.lit("train")).alias("split"))
        assert sorted(map(str, done.filter(F.col("strategy") == name).select(*columns, "split").collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("options", [{"output": "list", "lang": "zh"}, {"keep_empty": True, "norm": "norm_1", "layout": "cxcywh"}, {"norm": "raw", "allow": ["RARE"], "style": "cot"}])
def test_options_reach_boxes_and_texts(spark, tmp_path, options):
    notes = fixtures.annotations(spark, SF).limit(200)
    done = pipelines.convert(notes, str(tmp_path / "set"), strategy="both", **options)
    for name in ("all_in_one", "per_class"):
        want = records.convert(notes, name, **options).select("record_id", "messages")
        assert sorted(map(str, done.filter(F.col("strategy") == name).select("record_id", "messages").collect())) == sorted(map(str, want.collect()))


def test_whole_units_round_as_decimals_do(spark):
    values = [(v, s) for v in (-0.3, -0.5, 0.0, 0.5, 1.5, 2.5, 187.5, 320.0, 1e300, 333.3333333333333) for s in (1.0, 3.0, 640.0, 1000.0, 0.0)]
    rows = spark.createDataFrame(values, "v double, s double")
    b = F.struct(*[F.col("v").alias(k) for k in ("x_min", "y_min", "x_max", "y_max")])
    for norm, times in (("norm_100", 100), ("norm_1000", 1000)):
        got = rows.select("v", "s", geometry.normalize(b, F.col("s"), F.col("s"), norm)["x_min"].alias("x"), F.when(F.col("s") > 0, F.bround(F.try_divide("v", "s") * times, 0)).alias("y")).collect()
        assert [tuple(r) for r in got if str(r.x) != str(r.y)] == []
