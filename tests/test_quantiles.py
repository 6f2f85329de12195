"""Order statistics against sorted lists."""

import math
import random
from statistics import median

import numpy as np
from pyspark.sql import functions as F

from annospark.operators import quantiles, runs, stats


def test_elements_and_quantiles_are_those_of_sorted_lists(spark):
    rng = random.Random(2)
    groups = {("hot", 1): 900, ("b", 1): 7, ("b", None): 1, (None, 2): 2}
    values = {k: [rng.choice([0.5, 1.5, rng.random()]) for _ in range(n)] for k, n in groups.items()}
    rows = [(a, b, v) for (a, b), vs in values.items() for v in vs] + [("b", 1, None), ("none", 0, None)]
    table = spark.createDataFrame(rows, "a string, b int, v double").repartition(6)
    n = F.col("n")
    got = {(r.a, r.b): r for r in quantiles.elements(table, ["a", "b"], "v", {"first": F.lit(0), "mid": F.floor(n / 2), "beyond": n}).collect()}
    assert {k: (r.n, r.first, r.mid, r.beyond) for k, r in got.items()} == {k: (len(v), min(v), sorted(v)[len(v) // 2], None) for k, v in values.items()}
    shares = {"low": 0.0, "q": 0.3, "high": 1.0}
    for r in quantiles.quantiles(table, ["a", "b"], "v", shares).collect():
        assert np.allclose([r[k] for k in shares], np.quantile(values[r.a, r.b], list(shares.values())))
    whole = quantiles.quantiles(table, [], "v", {"m": 0.5}).first()
    assert math.isclose(whole.m, median(v for vs in values.values() for v in vs))
    assert quantiles.quantiles(table.limit(0), ["a"], "v", {"m": 0.5}).count() == 0


def test_step_times_of_a_run(spark):
    rng = random.Random(5)
    steps = [("x", k, rng.choice([1.0, 2.0, rng.random()])) for k in range(101)] + [("y", 3, 0.25)]
    rows = {r.run: r for r in runs.step_times(spark.createDataFrame(steps, "run string, step int, seconds double").repartition(5)).collect()}
    s = sorted(v for r, _, v in steps if r == "x")
    x = rows["x"]
    assert (x.first, x.p95) == (steps[0][2], s[95]) and math.isclose(x.median, median(s), abs_tol=1e-6) and math.isclose(x.last_five, sum(v for _, _, v in steps[96:101]) / 5, abs_tol=1e-6)
    assert (rows["y"].p95, rows["y"].median, rows["y"].last_five) == (0.25, 0.25, 0.25)


def test_statistics_texts_hold_a_bounded_number_of_files(spark):
    counts = spark.createDataFrame([("a", 1 + k % 3, f"f{k}") for k in range(25)] + [("b", 1, "g")], "label string, cnt int, file string")
    parsed = stats.statistics_json(counts, "/d", "file", most=10).select(F.from_json("value", "label_counts map<string,map<string,array<string>>>")["label_counts"].alias("m")).collect()
    sizes = [sum(len(f) for m in r.m.values() for f in m.values()) for r in parsed]
    assert sorted(sizes) == [1, 5, 10, 10]
    assert sorted((label, int(c), f) for r in parsed for label, m in r.m.items() for c, fs in m.items() for f in fs) == sorted(map(tuple, counts.collect()))
