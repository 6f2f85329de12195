"""Values of large JSON documents by byte ranges, against the parsed document."""

import json
import random

import pytest
from pyspark.sql import functions as F

from annospark.sources import files, json_ranges
from annospark.sources.json_ranges import ANY, EACH


def some(rng, depth):
    kind = rng.randrange(7 if depth else 5)
    if kind == 0:
        return rng.choice([0, -12.5e3, 123456789012345678, True, False, None])
    if kind < 5:
        return "".join(rng.choice('ab"\\{}[],: \n\té日😀/u') for _ in range(rng.randrange(12)))
    if kind == 5:
        return [some(rng, depth - 1) for _ in range(rng.randrange(4))]
    return {some_key(rng): some(rng, depth - 1) for _ in range(rng.randrange(4))}


def some_key(rng):
    return rng.choice(["results", "a", 'q"\\', "é", "", "[]", "k:", "label_counts"])


def at(value, place):
    """(keys, value) in a place of a parsed document."""
    if not place:
        return [([], value)]
    step, rest = place[0], place[1:]
    if step == EACH:
        return [x for v in value for x in at(v, rest)] if isinstance(value, list) else []
    if not isinstance(value, dict):
        return []
    if step == ANY:
        return [([k, *keys], x) for k, v in value.items() for keys, x in at(v, rest)]
    return at(value[step], rest) if step in value else []


PLACES = [["results", EACH], [ANY, EACH], ["label_counts", ANY, ANY, EACH], ["a"], [ANY, "a"], [EACH, EACH], []]


@pytest.mark.parametrize("size", [7, 61, 1 << 20])
def test_values_are_those_of_the_parsed_document(spark, tmp_path, monkeypatch, size):
    monkeypatch.setattr(json_ranges, "RANGE", size)
    rng = random.Random(size)
    docs = [{"results": [some(rng, 3) for _ in range(4)], "label_counts": {some_key(rng): {"1": ["x", 'y"\\\\'], "2": [some(rng, 1)]}}, "a": some(rng, 2)} for _ in range(1 if size < 10 else 6)]
    docs += [[[1, 2], ["\\"]], "alone", 7, {}, [], {"results": {"a": 1}}]
    for k, doc in enumerate(docs):
        body = json.dumps(doc, indent=rng.choice([None, 1]), ensure_ascii=rng.random() < 0.5)
        (tmp_path / f"d{k:03d}.json").write_text(body + rng.choice(["", "\n"]))
    found = json_ranges.json_values(spark, str(tmp_path), *PLACES).collect()
    for k, doc in enumerate(docs):
        rows = sorted((r for r in found if r.path.endswith(f"d{k:03d}.json")), key=lambda r: r.start)
        for n, place in enumerate(PLACES):
            got = [(list(r["keys"]), json.loads(r.value)) for r in rows if r.place == n]
            assert sorted(map(repr, got)) == sorted(map(repr, at(doc, place))), (k, place)
            assert [x for _, x in got] == [x for _, x in at(doc, place)]


def test_broken_files_have_no_values(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(json_ranges, "RANGE", 5)
    for k, body in enumerate(['{"results": [1, 2', '{"results": [1, "a]}', '{"results": [1]}}', '{"results": [1, 2]}']):
        (tmp_path / f"d{k}.json").write_text(body)
    found = json_ranges.json_values(spark, str(tmp_path), ["results", EACH]).collect()
    assert sorted((r.path[-7:], r.value) for r in found) == [("d3.json", "1"), ("d3.json", "2")]
    assert json_ranges.json_values(spark, str(tmp_path / "nothing"), ["a"]).count() == 0


def test_results_and_statistics_of_one_large_file(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(json_ranges, "RANGE", 40_000)
    rows = [{"index": i, "model_type": "m", "image_path": f"/i/{i}]}}.png", "detections": [{"bbox": [1, 2, 3, i], "label": 'a"', "confidence": 0.5}]} for i in range(5000)]
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "part_0.json").write_text(json.dumps({"gpu_id": 3, "results": rows[:4000]}, indent=1))
    (tmp_path / "r" / "part_1.json").write_text(json.dumps({"results": rows[4000:]}))
    (tmp_path / "r" / "part_2.json").write_text('{"results": [')
    back = files.by_index(files.read_partial_results(spark, str(tmp_path / "r")))
    assert [(r["index"], r.image_path, r.detections[0].bbox[3]) for r in back.collect()] == [(i, f"/i/{i}]}}.png", i) for i in range(5000)]
    counts = {"label_counts": {'ca"t': {"2": [f"/d/{i}.json" for i in range(9000)]}, "dog": {"1": ["/d/é.json"], "11": []}}, "statistics_info": {"source_dir": "/d"}, "source_dir": ""}
    (tmp_path / "s.json").write_text(json.dumps(counts))
    found = files.read_statistics(spark, str(tmp_path / "s.json"))
    assert found.groupBy("source_dir", "label", "cnt").agg(F.count("*").alias("n"), F.countDistinct("file").alias("d")).orderBy("label").collect() == [("/d", 'ca"t', 2, 9000, 9000), ("/d", "dog", 1, 1, 1)]
    assert found.filter("label = 'dog'").first().file == "/d/é.json"
