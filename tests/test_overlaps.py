"""Grid candidates against all pairs of boxes."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from annospark.functions import geometry as g
from annospark.functions import overlaps as o
from annospark.operators import evaluate as e


def boxes(rng, n, spread, sizes):
    xy = rng.integers(-spread, spread, (n, 2))
    wh = rng.choice(sizes, (n, 2))
    return np.concatenate([xy, xy + wh], axis=1).astype(float)


@pytest.mark.parametrize("sizes", [[0, 1, 2, 3], [5, 64, 64, 65], [1, 3, 1000, 4096], [0.25, 0.5, 7.5]])
def test_pairs_are_all_that_share_an_area(sizes):
    rng = np.random.default_rng(len(sizes) + int(sizes[-1]))
    a, b = boxes(rng, 400, 40, sizes), boxes(rng, 300, 40, sizes)
    a[5], b[7] = [3, 3, 1, 1], np.nan
    image_a, image_b = rng.integers(0, 6, 400), rng.integers(0, 6, 300)
    x, y = o.overlapping(image_a, a, image_b, b)
    width = np.minimum(a[:, None, 2:], b[None, :, 2:]) - np.maximum(a[:, None, :2], b[None, :, :2])
    solid = lambda q: (q[:, 2] > q[:, 0]) & (q[:, 3] > q[:, 1])
    want = (width > 0).all(axis=2) & (image_a[:, None] == image_b[None, :]) & solid(a)[:, None] & solid(b)[None, :]
    assert len(set(zip(x.tolist(), y.tolist()))) == len(x)
    assert set(zip(x.tolist(), y.tolist())) == set(zip(*(k.tolist() for k in np.nonzero(want))))


def fold(dets, gts, threshold, same_label):
    """One detection after the other over all boxes."""

    def iou(p, q):
        if p is None or q is None or len(p) < 4 or len(q) < 4 or None in p[:4] or None in q[:4]:
            return 0.0
        w, h = min(p[2], q[2]) - max(p[0], q[0]), min(p[3], q[3]) - max(p[1], q[1])
        inter = float(max(w, 0) * max(h, 0))
        union = (p[2] - p[0]) * (p[3] - p[1]) + (q[2] - q[0]) * (q[3] - q[1]) - inter
        return inter / union if inter > 0 and union > 0 else 0.0

    norm = lambda s: (s or "").strip(" ").lower()
    used, found = set(), []
    for box, label in dets:
        best = max(((iou(box, q), -j) for j, (q, other) in enumerate(gts) if j not in used and (not same_label or norm(label) == norm(other))), default=(0, 0))
        if best[0] > 0 and best[0] >= threshold:
            used.add(-best[1])
            found.append(best[0])
    return found


def test_matches_equal_a_plain_fold(spark):
    rng = np.random.default_rng(3)
    rows = []
    for k in range(120):
        sides = []
        for _ in range(2):
            n = int(rng.integers(0, 9))
            sides.append([([int(v) for v in box], [None, "a", " A", "b"][int(rng.integers(4))]) for box in boxes(rng, n, 12, [0, 5, 9, 20])])
        rows.append((k, *sides))
    rows += [(500, None, [([0, 0, 5, 5], "a")]), (501, [([0, 0, 5, 5], "a")], None), (502, [(None, "a"), ([1, 2], "a"), ([0, 0, None, 5], "a"), ([0, 0, 5, 5], "a")], [([0, 0, 5, 5], "A")])]
    box = "array<struct<bbox:array<int>,label:string>>"
    table = spark.createDataFrame(rows, f"k int, dets {box}, gts {box}").repartition(3)
    for threshold, same in ((0.5, True), (0.3, False), (0.0, True)):
        got = {r.k: r.m for r in table.select("k", e.greedy_match(F.col("dets"), F.col("gts"), threshold, same).alias("m")).collect()}
        for k, dets, gts in rows:
            assert got[k] == pytest.approx(fold(dets or [], gts or [], threshold, same), abs=0), k
    pairs = table.withColumnsRenamed({"dets": "d1", "gts": "d2"}).filter("k < 500")
    plain = F.transform("d1", lambda a: F.array_max(F.transform("d2", lambda b: g.iou(a["bbox"], b["bbox"]))))
    want = sorted((r.k, r.v) for r in pairs.select("k", F.explode(plain).alias("v")).filter("v > 0").collect())
    assert sorted((r.k, r.v) for r in e.cross_iou(pairs).collect()) == want


def test_many_boxes_in_an_image_take_seconds(spark):
    n = 20_000
    rng = np.random.default_rng(4)
    a = boxes(rng, n, 3000, [8, 20, 300])
    side = [([int(v) for v in box], "a") for box in a]
    box = "array<struct<bbox:array<int>,label:string>>"
    table = spark.createDataFrame([(side, side[::-1])], f"dets {box}, gts {box}")
    began = time.perf_counter()
    row = e.sample_metrics(table).first()
    assert row.num_match > 0.99 * n and time.perf_counter() - began < 30
