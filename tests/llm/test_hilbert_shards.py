"""Shards along a Hilbert curve against its definition and plain counting."""

import zlib
from bisect import bisect_right
from collections import Counter
from itertools import pairwise, product

import pytest
from pyspark.sql import functions as F

from annospark.llm import hilbert_shards as h

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, slot int, row int, size_ int, _shard int, before int, d0 string"
LONG = "é" * 200_000


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, 0, "a", 1, 2, 3, 4, 5, "z") for i, t, lang, s in rows], SCHEMA)


@pytest.mark.parametrize(("axes", "bits"), [(2, 3), (3, 2), (3, 3), (4, 2), (5, 1)])
def test_neighbours_on_the_curve_differ_by_one_step(spark, axes, bits):
    names = [f"a{k}" for k in range(axes)]
    cells = spark.createDataFrame(list(product(range(1 << bits), repeat=axes)), ", ".join(f"{n} int" for n in names))
    rows = sorted(cells.withColumn("curve", h.hilbert_index([F.col(n) for n in names], bits)).filter("curve >= 0").collect(), key=lambda r: r.curve)
    assert [r.curve for r in rows] == list(range(1 << (axes * bits)))
    for a, b in pairwise(rows):
        assert sum(abs(a[n] - b[n]) for n in names) == 1


def plain_cells(values, bits):
    n, count = len(values), Counter(values)
    before, cell = 0, {}
    for v in sorted(count):
        cell[v] = before * (1 << bits) // n
        before += count[v]
    return cell


ROWS = [(i, t, lang, s) for i, (t, lang, s) in enumerate(
    [(None, None, None), ("", "", ""), (LONG, "en", "hot"), ("same", "en", "hot"), ("same", "en", "hot"), ("same", "de", "b"), ("x\x00y", "日本", "é")] + [(f"text {k % 7} " * (k % 11), ("en", "de", "fr")[k % 3], "hot" if k % 3 else f"s{k % 13}") for k in range(60)]
)] + [(5, "same", "en", "hot"), (5, "same", "en", "hot"), (None, "no id", "en", "hot")]


def test_runs_of_the_curve_have_equal_counts(spark):
    found = h.shard(docs(spark, ROWS)).collect()
    size = lambda t: len((t or "").encode()) + 1
    want = Counter((i, size(t), zlib.crc32((t or "").encode())) for i, t, _, _ in ROWS)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == want
    order = sorted(found, key=lambda r: (r.shard, r.slot))
    count = Counter(r.shard for r in found)
    assert set(count) == set(range(8)) and max(count.values()) - min(count.values()) <= 1
    for k, n in count.items():
        assert sorted(r.slot for r in found if r.shard == k) == list(range(n))
    key = lambda r: (r.curve, r.text_crc32, -1 if r.doc_id is None else r.doc_id)
    assert [key(r) for r in order] == sorted(map(key, found))
    cells = [plain_cells(v, h.BITS) for v in ([lang or "" for _, _, lang, _ in ROWS], [s or "" for _, _, _, s in ROWS], [size(t) for _, t, _, _ in ROWS])]
    names = ["a", "b", "c"]
    frame = spark.createDataFrame([(r.doc_id, r.curve, *(cells[i][r[f"d{i}"]] for i in range(3))) for r in found], "doc_id long, curve long, a int, b int, c int")
    assert frame.filter(h.hilbert_index([F.col(n) for n in names], h.BITS) != F.col("curve")).count() == 0


def test_runs_by_bytes_end_where_their_share_ends(spark):
    found = sorted(h.shard(docs(spark, ROWS), shards=4, law="bytes").collect(), key=lambda r: (r.shard, r.slot))
    total, before = sum(r.size for r in found), 0
    for r in found:
        assert r.shard == before * 4 // total
        before += r.size
    for k in {r.shard for r in found}:
        assert [r.slot for r in found if r.shard == k] == list(range(sum(r.shard == k for r in found)))


def test_quantisers_split_by_counts_of_all_rows(spark):
    values = [3] * 40 + list(range(100, 160)) + [-5]
    table = spark.createDataFrame([(v, str(v)) for v in values], "v long, s string").repartition(3)
    bounds = h.quantisers(table, ["v", "s"], 3)
    for name, keys in (("v", values), ("s", [str(v) for v in values])):
        cell, least = plain_cells(keys, 3), [b for _, b in bounds[name]]
        assert all(bounds[name][bisect_right(least, v) - 1][0] == cell[v] for v in keys)
        rows = table.select(name, h.cell_of(F.col(name), bounds[name]).alias("c")).distinct().collect()
        assert {r[name]: r.c for r in rows} == cell


def test_empty_and_few_rows(spark):
    assert h.shard(docs(spark, [])).count() == 0
    assert sorted((r.shard, r.slot) for r in h.shard(docs(spark, ROWS[:3])).collect()) == [(0, 0), (2, 0), (5, 0)]
    with pytest.raises(ValueError):
        h.shard(docs(spark, []), law="other")
    with pytest.raises(TypeError):
        h.shard(docs(spark, []).withColumn("x", F.lit(0.5)), dimensions=("x", "lang"))


def test_written_files_hold_all_rows_and_span_little(spark, tmp_path):
    table = docs(spark, ROWS).withColumn("day", F.expr("date_add(date'2020-01-01', cast(doc_id as int))"))
    spans = h.write_shards(table, f"{tmp_path}/out", shards=6, dimensions=("source", "day")).collect()
    back = spark.read.parquet(f"{tmp_path}/out")
    kept = [c for c in table.columns if c != "_shard"]
    assert Counter(back.select(kept).collect()) == Counter(table.select(kept).collect())
    per = {r["_shard"]: r for r in back.groupBy("_shard").agg(F.count("*").alias("n"), F.min(F.coalesce("source", F.lit(""))).alias("a"), F.max(F.coalesce("source", F.lit(""))).alias("b")).collect()}
    assert {r.shard: (r.rows, r.d0_least, r.d0_most) for r in spans} == {k: (r.n, r.a, r.b) for k, r in per.items()}
    assert max(r.rows for r in spans) - min(r.rows for r in spans) <= 1
