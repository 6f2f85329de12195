"""Cases of the third round's findings: keyed files by name, files of one stretch, exports beyond a chunk, partitions by input."""

import json

import pytest
from pyspark.sql import functions as F

from annospark import fixtures, registry
from annospark.operators import split, spread, validate
from annospark.queries import sources, stats, validation
from annospark.sources import files, json_ranges, listing


def _tables(spark, folder, orders: int, lines):
    """Tables of ``orders`` images, with a line item for each of ``lines`` (orderkey, partkey, number)."""
    spark.range(orders).select(F.col("id").alias("o_orderkey"), (F.col("id") % 7).alias("o_custkey")).write.parquet(f"{folder}/orders.parquet")
    spark.range(50).select(F.col("id").alias("p_partkey"), F.lit("SMALL").alias("p_type")).write.parquet(f"{folder}/part.parquet")
    rows = lines.select(
        F.col("o").alias("l_orderkey"), F.col("p").alias("l_partkey"), (F.col("o") % 40).alias("l_suppkey"), F.col("k").cast("int").alias("l_linenumber"),
        F.lit(5.0).alias("l_quantity"), F.lit(0.05).alias("l_discount"), F.lit(0.01).alias("l_tax"),
    )
    rows.write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def test_keyed_files_are_read_by_name_without_a_listing(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(f"s{i % 3}/f{i}.json", f"é{i}" * (i % 5)) for i in range(200)] + [(None, "x")], "file string, payload string")
    path, names = str(tmp_path / "out"), str(tmp_path / "names")
    assert tuple(files.write_keyed(rows, path, names).first()) == (200, 1)
    (tmp_path / "out" / "other.json").write_text("not written here")
    monkeypatch.setattr(files, "scan", lambda *a, **k: pytest.fail("listed"))
    found = {r.file: r.payload for r in files.read_keyed(spark, path, names).collect()}
    assert found == {r.file: r.payload for r in rows.collect() if r.file and r.payload}


def test_partial_results_files_are_whole_and_few(spark, tmp_path, monkeypatch):
    sf = _tables(spark, tmp_path / "t", 2000, spark.range(4000).select((F.col("id") % 2000).alias("o"), (F.col("id") % 50).alias("p"), (F.col("id") % 3 + 2).alias("k")))
    monkeypatch.setattr(sources, "shared_folder", lambda s, name: str(tmp_path / name))
    rows = sources.partial_results(spark, sf).collect()
    paths = [r.path for r in listing.scan(spark, str(tmp_path / "partial"), "part-*").collect()]
    assert len(paths) == 8
    stored = [x["index"] for p in paths for x in json.load(open(p))["results"]]
    assert sorted(stored) == sorted(r["index"] for r in rows) and len(set(stored)) == len(stored) > 1000


def test_broken_files_of_one_stretch_have_no_values(spark, tmp_path):
    for name, text in (("a", '{"r": [1, 2]}'), ("b", '{"r": [1, 2]'), ("c", '{"r": [1]}]'), ("d", '{"r": ["x]}'), ("e", '{"r": []}\n{"r": [3]}')):
        (tmp_path / f"{name}.json").write_text(text)
    found = json_ranges.json_values(spark, str(tmp_path), ["r", json_ranges.EACH]).collect()
    assert sorted((r.path[-6:-5], r.value) for r in found) == [("a", "1"), ("a", "2"), ("e", "3")]


def test_an_export_row_holds_all_files_of_its_count(spark, tmp_path):
    n = 100_003
    sf = _tables(spark, tmp_path / "t", n, spark.range(n).select(F.col("id").alias("o"), (F.col("id") % 49 + 1).alias("p"), F.lit(2).alias("k")))
    rows = stats.structured_export(spark, sf).collect()
    assert [(r.label, r.cnt, r.n) for r in rows] == [("SMALL", 1, n)]
    assert rows[0].files == ",".join(map(str, range(n)))


SF = "/root/testdata/sf0.001"


def _sorted(frame):
    return sorted(tuple(map(str, r)) for r in frame.collect())


def _shuffles(frame) -> list[str]:
    frame.collect()
    return [line for line in frame._jdf.queryExecution().explainString(frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")).split("\n") if "hashpartitioning" in line or "rangepartitioning" in line]


@pytest.mark.parametrize("name", ["per_file", "conversion_counters", "selection_totals", "sample_labels", "integrity", "duplicates_per_image", "sample_metrics"])
def test_partitions_grow_with_the_input(spark, monkeypatch, name):
    query = registry.QUERIES[name]
    few = _sorted(query(spark, SF))
    monkeypatch.setattr(spread, "EACH", 20_000)
    n = spread.partitions(fixtures.shapes(spark, SF))
    assert n > int(spark.conf.get("spark.sql.shuffle.partitions"))
    many = query(spark, SF)
    assert _sorted(many) == few
    assert any(f", {n})" in line or f", {n}," in line for line in _shuffles(many))


def test_ranges_grow_with_the_input(spark, monkeypatch):
    rows = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_orderkey", "l_partkey")
    monkeypatch.setattr(spread, "EACH", 20_000)
    ranked = spread.by_range(rows, "l_orderkey", "l_partkey")
    assert ranked.rdd.getNumPartitions() > int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_checked_files_are_joined_without_their_shapes(spark, monkeypatch):
    carried = []
    monkeypatch.setattr(validation.v, "find_images", lambda rows, *a: carried.append(rows) or rows.withColumn("image", F.lit(None).cast("string")))
    validation.integrity(spark, SF)
    assert "points" not in carried[0].schema.simpleString()


def test_a_text_is_made_once(spark):
    plan = validation.primary_annotation(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_parse_json") + plan.count("parseJson") <= 1


def test_objects_begin_with_a_brace(spark):
    texts = ["{}", ' \n{"shapes": []}', "[1]", "[{}]", '"{}"', "{", "{} x", "", " ", "3", "null", '{"shapes": null}', '{"shapes": {}}', '{"shapes": [], "imagePath": ""}', '{"shapes": [1], "imagePath": "a"}', None]
    rows = spark.createDataFrame([(t,) for t in texts], "raw string")
    v = F.try_parse_json("raw")
    kind = F.schema_of_variant(F.try_variant_get(v, "$.shapes", "variant"))
    whole = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    found = rows.select("raw", validate.is_object(F.col("raw")).alias("o"), validate.structure_status(F.col("raw")).alias("s"), whole.alias("o2"), F.coalesce(kind.startswith("ARRAY"), F.lit(False)).alias("list")).collect()
    assert [r.raw for r in found if r.o != r.o2] == []
    assert [r.raw for r in found if (r.s == "invalid_json") != (not r.o2) or (r.s == "missing_shapes") != (r.o2 and not r.list)] == []
    assert {r.s for r in found} == {"invalid_json", "missing_shapes", "empty_shapes", "valid"}


def test_records_of_splits_are_made_once(spark, monkeypatch):
    seen, real = [], split.stratified_split
    monkeypatch.setattr(split, "stratified_split", lambda labels, *a: seen.append(labels.inputFiles()) or real(labels, *a))
    rows = sources.split_files(spark, SF).collect()
    assert sum(r.records for r in rows) > 100
    assert seen[0] and all("/records-" in f for f in seen[0])
