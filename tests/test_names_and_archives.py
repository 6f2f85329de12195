"""Free names, files by key, and archives by member."""

import io
import json
import random
import re
import tarfile
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from annospark.operators import names
from annospark.sources import archives, files, keyed_files


def plain_names(rows, taken=()):
    """Targets one after the other: own names first, then the numbers that are left."""
    split = lambda n: (re.sub(r"(?<=[^/])\.[^./]+$", "", n), (re.search(r"(?<=[^/])\.[^./]+$", n) or [""])[0])
    own = {n for n, _ in rows} | set(taken)
    seen, used, out = set(taken), set(own), []
    for name, order in sorted(rows):
        if name not in seen:
            seen.add(name)
            out.append((name, order, name))
            continue
        stem, ext = split(name)
        k = 1
        while f"{stem}_{k}{ext}" in used:
            k += 1
        used.add(f"{stem}_{k}{ext}")
        out.append((name, order, f"{stem}_{k}{ext}"))
    return sorted(out)


@pytest.mark.parametrize("taken", [(), ("x", "x_2.txt", "x_3.txt", "new.txt")])
def test_targets_are_free_whatever_the_names(spark, taken):
    rng = random.Random(4)
    some = ["x", "x_1", "x_1_1", "x_01", "x_0", "x.txt", "x_1.txt", "x_2.txt", "x_7.txt", "a.b/x", "a.b/x.txt", ".x", ".x_1", "x.", "é_1.é", "_1", ""]
    rows = [(rng.choice(some[:3] if rng.random() < 0.5 else some), i) for i in range(300)] + [("x_1_1_1", 1000), ("x_999999999999999999", 1001)]
    table = spark.createDataFrame(rows + [(None, 5000), (None, 5001)], "name string, src long").withColumns({"rank": F.lit(7), "n": F.lit(8)}).drop("rank", "n").repartition(5)
    held = spark.createDataFrame([(t,) for t in taken], "name string") if taken else None
    found = names.free_names(table, "name", "src", taken=held).collect()
    assert sorted((r.name, r.src, r.target) for r in found if r.name is not None) == plain_names(rows, taken)
    assert [r.target for r in found if r.name is None] == [None, None]
    targets = [r.target for r in found if r.name is not None] + list(taken)
    assert len(set(targets)) == len(targets)


def test_copies_of_three_folders_land_apart(spark):
    rows = spark.createDataFrame([("/a/x.json", "copied"), ("/b/x.json", "copied"), ("/c/x_1.json", "copied"), ("/d/x.json", "missing")], "file string, status string")
    found = {r.src: r.dst for r in files.filter_copies(rows, "/out/").collect()}
    assert found == {"/a/x.json": "/out/x.json", "/b/x.json": "/out/x_2.json", "/c/x_1.json": "/out/x_1.json"}
    assert files.filter_copies(rows.limit(0), "/out").count() == 0


def test_payloads_become_files_of_their_names(spark, tmp_path):
    rows = [(f"{i:06d}_b.json", json.dumps({"i": i, "t": "é\n"})) for i in range(50)] + [("sub/c.json", ""), (None, "x"), ("d.json", None), ("../e.json", "x"), ("/f.json", "x")]
    table = spark.createDataFrame(rows, "file string, payload string").repartition(4)
    counts = files.write_keyed(table, str(tmp_path / "out")).first()
    assert (counts.written, counts.failed) == (51, 4)
    want = {f: p for f, p in rows if f and p is not None and not f.startswith(("/", ".."))}
    there = {str(p.relative_to(tmp_path / "out")): p.read_text() for p in (tmp_path / "out").rglob("*") if p.is_file() and not p.name.endswith(".crc")}
    assert there == want
    assert {r.file: r.payload for r in files.read_keyed(spark, str(tmp_path / "out")).collect()} == {f: p for f, p in want.items() if p}
    again = spark.createDataFrame([("000000_b.json", "new")], "file string, payload string")
    assert files.write_keyed(again, str(tmp_path / "out")).first().written == 1
    assert (tmp_path / "out" / "000000_b.json").read_text() == "new" and len(list((tmp_path / "out").rglob("*.json"))) == 51
    assert tuple(files.write_keyed(table.limit(0), str(tmp_path / "none")).first()) == (0, 0)


def test_a_failing_task_leaves_no_file(tmp_path):
    writer = keyed_files.KeyedFileWriter(str(tmp_path / "out"), str(tmp_path / "report" / "r.json"), ["file", "payload"])

    def rows():
        yield ("a.json", "1")
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        writer.write(rows())
    assert not list((tmp_path / "out").glob("*.json"))
    messages = [writer.write(iter([("a.json", "1"), (None, "2")])), writer.write(iter([("b.json", b"3")])), None]
    writer.commit(messages)
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["a.json", "b.json"]
    assert keyed_files.read_report(str(tmp_path / "report" / "r.json")) == {"written": 2, "failed": 1, "failures": [[None, "no name"]]}
    other = keyed_files.KeyedFileWriter(str(tmp_path / "two"), None, ["payload", "file"])
    with pytest.raises(RuntimeError):
        other.write(iter([("1", "a.json")]) if False else rows_swapped())
    other.abort([])
    assert not list((tmp_path / "two").iterdir())


def rows_swapped():
    yield ("1", "a.json")
    raise RuntimeError("lost")


def tar_of(entries, mode):
    body = io.BytesIO()
    with tarfile.open(fileobj=body, mode=mode) as t:
        for name, raw in entries:
            info = tarfile.TarInfo(name)
            info.size = len(raw)
            t.addfile(info, io.BytesIO(raw))
    return body.getvalue()


def zip_of(entries, kind=zipfile.ZIP_DEFLATED):
    body = io.BytesIO()
    with zipfile.ZipFile(body, "w", kind) as z:
        for name, raw in entries:
            z.writestr(name, raw)
    return body.getvalue()


def test_members_of_all_kinds_are_read_by_place(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archives, "PIECE", 1000)
    monkeypatch.setattr(archives, "CHUNK", 3000)
    rng = random.Random(8)
    body = lambda n: bytes(rng.randrange(4) for _ in range(n))
    entries = [("top/a.txt", b"1"), ("top/sub/b.bin", body(5000)), ("top/empty", b""), ("top/c.txt", body(999))]
    made = {
        "one.zip": (zip_of(entries), entries), "stored.zip": (zip_of(entries, zipfile.ZIP_STORED), entries), "bz.zip": (zip_of(entries, zipfile.ZIP_BZIP2), entries),
        "plain.tar": (tar_of(entries, "w:"), entries), "packed.tar.gz": (tar_of(entries, "w:gz"), entries), "packed.tar.bz2": (tar_of(entries, "w:bz2"), entries), "none.zip": (zip_of([]), []),
    }
    for name, (raw, _) in made.items():
        (tmp_path / name).write_bytes(raw)
    (tmp_path / "broken.zip").write_bytes(b"PK\x03\x04 no")
    (tmp_path / "lzma.zip").write_bytes(zip_of([("x", b"y")], zipfile.ZIP_LZMA))
    (tmp_path / "evil.tar").write_bytes(tar_of([("../up", b"z"), ("fine", b"ok")], "w:"))
    cut = zip_of([("whole", b"w"), ("cut", bytes(range(256)) * 40)], zipfile.ZIP_STORED)
    listed = archives.members(spark, str(tmp_path))
    by_archive = {r.archive.rsplit("/", 1)[1]: r for r in archives.report(listed).collect()}
    assert by_archive["broken.zip"].error and by_archive["lzma.zip"].failed == 1 and by_archive["evil.tar"].failed == 1 and "none.zip" not in by_archive
    rows = archives.read_members(listed).collect()
    assert all(r.error is None for r in rows)
    found = {}
    for r in sorted(rows, key=lambda r: (r.archive, r.no, r.piece)):
        key = (r.archive.rsplit("/", 1)[1], r.no)
        assert len(r.content) <= 1000 and r.piece == found.get(key, (0, b""))[0]
        found[key] = (r.piece + 1, found.get(key, (0, b""))[1] + bytes(r.content))
    want = {(name, k): raw for name, (_, e) in made.items() for k, (_, raw) in enumerate(e)} | {("evil.tar", 1): b"ok"}
    assert {k: b for k, (_, b) in found.items()} == want
    done = archives.extract(listed, str(tmp_path / "out")).collect()
    assert len(done) == len(want) and all(r.error is None for r in done)
    for r in done:
        assert (tmp_path / "out" / r.target).read_bytes() == want[r.archive.rsplit("/", 1)[1], r.no]
    assert (tmp_path / "out" / "packed/top/sub/b.bin").exists() and (tmp_path / "out" / "packed/top/sub/b_1.bin").exists()
    (tmp_path / "bad").mkdir()
    at = cut.index(b"cut") + 3
    (tmp_path / "bad" / "cut.zip").write_bytes(cut)
    bad = archives.members(spark, str(tmp_path / "bad")).withColumn("packed", F.when(F.col("member") == "cut", F.lit(len(cut) - at + 500)).otherwise(F.col("packed")))
    broken = {r.target: r.error for r in archives.extract(bad, str(tmp_path / "out2")).collect()}
    assert broken["cut/whole"] is None and broken["cut/cut"] and sorted(p.name for p in (tmp_path / "out2" / "cut").iterdir() if p.suffix != ".crc") == ["whole"]


def test_a_folder_called_like_its_archive_is_dropped(spark, tmp_path):
    entries = [("my_set/a.txt", b"1"), ("my_set/b.txt", b"2")]
    (tmp_path / "my set.zip").write_bytes(zip_of(entries))
    (tmp_path / "My_Set.zip").write_bytes(zip_of(entries))
    (tmp_path / "broken.zip").write_bytes(b"no")
    flat = archives.members(spark, str(tmp_path), nested=False).collect()
    assert sorted(r.target for r in flat if r.target) == ["a.txt", "a_1.txt", "b.txt", "b_1.txt"]
    assert [r.archive.rsplit("/", 1)[1] for r in flat if r.error] == ["broken.zip"]
    taken = spark.createDataFrame([("my set/a.txt",)], "target string")
    assert sorted(r.target for r in archives.members(spark, str(tmp_path), taken=taken).collect() if r.target) == ["My_Set/a.txt", "My_Set/b.txt", "my set/a_1.txt", "my set/b.txt"]
    assert archives.members(spark, str(tmp_path / "nowhere")).count() == 0


def test_a_large_member_is_streamed(spark, tmp_path):
    size = 60 << 20
    with zipfile.ZipFile(tmp_path / "big.zip", "w", zipfile.ZIP_DEFLATED) as z, z.open("big/zeros", "w") as out:
        for _ in range(60):
            out.write(bytes(1 << 20))
    rows = archives.read_members(archives.members(spark, str(tmp_path))).select("piece", F.length("content").alias("n"), F.crc32("content").alias("c")).collect()
    assert sum(r.n for r in rows) == size and len(rows) == -(-size // archives.PIECE)
    assert {r.c for r in rows if r.n == archives.PIECE} == {zlib.crc32(bytes(archives.PIECE))}
