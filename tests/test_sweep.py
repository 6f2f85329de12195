"""Matching of an image's boxes: read once, compared once for all confidences, few pairs directly and many by the grid."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from annospark import registry
from annospark.functions import overlaps
from annospark.operators import evaluate as e

SF = "/root/testdata/sf0.001"
BOX = "array<struct<bbox:array<int>,label:string,confidence:double>>"


def _image(rng, n, confidence=True):
    rows = []
    for _ in range(n):
        x, y = rng.randrange(30), rng.randrange(30)
        row = {"bbox": [x, y, x + rng.randrange(-1, 20), y + rng.randrange(20)], "label": rng.choice(["a", "b", " A", None])}
        rows.append(row | ({"confidence": rng.choice([None, 0.2, 0.5, 0.7, 0.9, float("nan")])} if confidence else {}))
    return rows


def _table(spark, sizes):
    rng = random.Random(3)
    rows = [(i, None if n is None else _image(rng, n), None if m is None else _image(rng, m, False)) for i, (n, m) in enumerate(sizes)]
    return spark.createDataFrame(rows, f"k int, dets {BOX}, gts array<struct<bbox:array<int>,label:string>>")


SIZES = [(0, 0), (None, 3), (3, None), (None, None), (0, 4), (4, 0), (40, 40), *[(i % 7, i % 5) for i in range(60)], (1, 300)]


@pytest.mark.parametrize("dialect", ["distributed", "notebook"])
def test_a_sweep_is_the_metrics_of_each_confidence(spark, dialect):
    table = _table(spark, SIZES)
    row = lambda df: sorted(tuple(map(str, r)) for r in df.select("k", "threshold", "num_det", "num_gt", "num_match", "precision", "recall", "f1", "mean_match_iou", "det_success").collect())
    once = row(e.sweep_metrics(table, (0.5, 0.0, 0.95), 0.3, dialect))
    assert once == row(e.sample_metrics(e.threshold_sweep(table, (0.5, 0.0, 0.95)), 0.3, dialect)) and len(once) == 3 * len(SIZES)
    assert e.sweep_metrics(table.limit(0)).count() == 0


def _one_by_one(dets, gts, threshold):
    used, out = set(), []
    for d in dets:
        best, at = 0.0, None
        for j, g in enumerate(gts):
            (a, b, c, f), (p, q, r, s) = d["bbox"], g["bbox"]
            w, h = min(c, r) - max(a, p), min(f, s) - max(b, q)
            if j in used or d["label"] != g["label"] or w <= 0 or h <= 0:
                continue
            v = w * h / ((c - a) * (f - b) + (r - p) * (s - q) - w * h)
            if v >= threshold and v > best:
                best, at = v, j
        if at is not None:
            used.add(at)
            out.append(best)
    return out


def test_few_pairs_and_the_grid_match_alike(monkeypatch):
    rng = random.Random(5)
    rows = [(_image(rng, n or 0), _image(rng, m or 0, False)) for n, m in SIZES]
    kind = [("bbox", pa.list_(pa.int32())), ("label", pa.string())]
    dets, gts = pa.array([r[0] for r in rows], pa.list_(pa.struct([*kind, ("confidence", pa.float64())]))), pa.array([r[1] for r in rows], pa.list_(pa.struct(kind)))
    for few in (0, 20, 1 << 40):
        monkeypatch.setattr(overlaps, "_FEW", few)
        got = overlaps._greedy(dets, gts, 0.1, True).to_pylist()
        assert all(g == pytest.approx(_one_by_one(d, t, 0.1)) for g, (d, t) in zip(got, rows, strict=True))


@pytest.mark.parametrize("name", ["sample_metrics", "threshold_sweep", "cross_iou_by_class"])
def test_line_items_are_read_once(spark, name):
    leaves = registry.QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().collectLeaves()
    read = [leaves.apply(i).toString() for i in range(leaves.size())]
    assert sum("l_orderkey" in r for r in read) <= (2 if name.startswith("cross") else 1)


def test_images_without_shapes_have_samples(spark):
    rows = registry.QUERIES["sample_metrics"](spark, SF)
    assert rows.count() == 2 * spark.read.parquet(f"{SF}/orders.parquet").count()
    assert rows.filter("num_gt = 0 and num_det = 0 and f1 = 1.0 or num_gt is null").filter(F.col("num_gt").isNull()).count() == 0


def test_boxes_from_one_read_are_the_detections(spark):
    from annospark import fixtures

    found = fixtures.detections(spark, SF).groupBy("image_id", "model").agg(F.count("*").alias("n"))
    want = {(r.image_id, r.model): r.n for r in found.collect()}
    got = {(r.image_id, r.model): r.num_det for r in registry.QUERIES["sample_metrics"](spark, SF).filter("num_det > 0").collect()}
    assert got == want
