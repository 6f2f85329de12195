"""Members of zip and tar archives, listed without their contents and read by place, so that neither an archive nor a large member
has to fit in memory."""

from __future__ import annotations

import bz2
import struct
import tarfile
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from contextlib import closing

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annospark.operators.names import free_names
from annospark.operators.split import running_weight
from annospark.sources.keyed_files import filesystem
from annospark.sources.listing import scan
from annospark.sources.shared import written

#: Bytes of a piece of a member, and of members that a task reads, about.
PIECE, CHUNK = 8 << 20, 64 << 20
_MEMBER = "archive string, no long, member string, kind string, start long, packed long, size long, error string"
_PATTERN = "*.{zip,tar,tgz,tar.gz,tar.bz2,tar.xz,gz,bz2,xz}"


class _Seekable:
    """An open file that refuses places before its start by OSError, as ``zipfile`` expects of files."""

    def __init__(self, path: str):
        store, inner = filesystem(path)
        self.file = store.open_input_file(inner)
        self.read, self.tell, self.close = self.file.read, self.file.tell, self.file.close

    def seekable(self) -> bool:
        return True

    def seek(self, at: int, whence: int = 0) -> int:
        try:
            return self.file.seek(at, whence)
        except ValueError as e:
            raise OSError(str(e)) from None


def _listed(path: str) -> Iterator[tuple]:
    """(no, member, kind, start, packed, size, error) of an archive's files. A zip's directory and a plain tar's headers are read and
    nothing else; a compressed tar has no directory and is streamed through."""
    with closing(_Seekable(path)) as f:
        magic = f.read(6)
        f.seek(0)
        if magic[:4] in (b"PK\x03\x04", b"PK\x05\x06"):
            with zipfile.ZipFile(f) as z:
                for no, i in enumerate(m for m in z.infolist() if not m.is_dir()):
                    known = {0: "stored", 8: "deflated", 12: "bzip2"}.get(i.compress_type)
                    error = "encrypted" if i.flag_bits & 1 else None if known else f"compression {i.compress_type}"
                    yield no, i.filename, known, i.header_offset, i.compress_size, i.file_size, error
            return
        packed = magic[:2] == b"\x1f\x8b" or magic[:3] == b"BZh" or magic == b"\xfd7zXZ\x00"
        with tarfile.open(fileobj=f, mode="r|*" if packed else "r:") as t:
            no = 0
            for m in t:
                if m.isfile():
                    yield no, m.name, "stream" if packed else "plain", m.offset_data, m.size, m.size, None
                    no += 1


def members(spark: SparkSession, folder: str, pattern: str = _PATTERN, nested: bool = True, taken: DataFrame | None = None) -> DataFrame:
    """(archive, no, member, kind, start, packed, size, error, target) of all files in the archives of a folder.

    A target is the member's path under its archive's stem (with ``nested``), without a single top folder that is called like the archive,
    blanks, underscores and case aside. Equal targets get free names in the order of archive and member (``names.free_names``; ``taken``: a
    table of targets that are there). An archive that can't be read is one row with its error and without a member, one that is
    empty has none; members that are encrypted, compressed in unknown ways or whose path leads out of the folder have an error and no target.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in _MEMBER.split(", ")]
        for frame in frames:
            for path in frame["path"]:
                rows: list[tuple] = []
                try:
                    for found in _listed(path):
                        rows.append((path, *found))
                        if len(rows) == 10_000:
                            yield pd.DataFrame(rows, columns=names)
                            rows = []
                except Exception as e:  # a broken archive is listed, not fatal
                    rows.append((path, None, None, None, None, None, None, str(e) or type(e).__name__))
                if rows:
                    yield pd.DataFrame(rows, columns=names).astype({c: "Int64" for c in ("no", "start", "packed", "size")})

    found = scan(spark, folder, pattern).select("path")
    rows = written(found.repartition(max(1, min(found.count(), 4096))).mapInPandas(run, _MEMBER), "members")
    out = F.col("member").startswith("/") | F.exists(F.split("member", "/"), lambda p: p == "..")
    rows = rows.withColumn("error", F.coalesce("error", F.when(out, "leads out of the folder")))
    stem = F.regexp_replace(F.regexp_extract("archive", r"([^/]*)$", 1), r"(\.tar)?\.[^.]*$", "")
    same = lambda c: F.lower(F.regexp_replace(c, "[_ ]", ""))
    good = rows.filter("error is null").withColumn("_top", F.split_part("member", F.lit("/"), F.lit(1)))
    tops = good.groupBy("archive").agg(F.min("_top").alias("_one"), F.max("_top").alias("_other"), F.bool_and(F.contains("member", F.lit("/"))).alias("_below"))  # a row per archive
    doubled = F.col("_below") & (F.col("_one") == F.col("_other")) & (same("_one") == same(stem))
    inner = F.when(doubled, F.expr("substring(member, length(_top) + 2)")).otherwise(F.col("member"))
    good = good.join(tops, "archive").withColumn("wanted", F.concat(stem, F.lit("/"), inner) if nested else inner).drop("_top", "_one", "_other", "_below")
    held = None if taken is None else taken.select(F.col("target").alias("wanted"))
    return free_names(good, "wanted", "archive", "no", taken=held).drop("wanted").unionByName(rows.filter("error is not null").withColumn("target", F.lit(None).cast("string")))


def report(listed: DataFrame) -> DataFrame:
    """(archive, members, failed, error) per archive: its files, those that can't be read, and why the archive itself can't."""
    return listed.groupBy("archive").agg(F.count("member").alias("members"), F.count_if(F.col("member").isNotNull() & F.col("error").isNotNull()).alias("failed"), F.max(F.when(F.col("member").isNull(), F.col("error"))).alias("error"))


def _bytes_of(f, row) -> Iterator[bytes]:
    """A member's contents in pieces, from its place in an open archive."""
    at = row.start
    if row.kind != "plain":
        f.seek(at)
        name, extra = struct.unpack("<HH", f.read(30)[26:30])
        at += 30 + name + extra
    f.seek(at)
    open_ = {"deflated": lambda: zlib.decompressobj(-15), "bzip2": bz2.BZ2Decompressor}.get(row.kind)
    left, unpack = int(row.packed), open_() if open_ else None
    while left > 0:
        raw = f.read(min(left, PIECE))
        if not raw:
            raise EOFError("the archive ends inside a member")
        left -= len(raw)
        if unpack is None:
            yield raw
        elif row.kind == "bzip2":
            yield unpack.decompress(raw)
        else:
            while raw:
                yield unpack.decompress(raw, PIECE)
                raw = unpack.unconsumed_tail
    if row.kind == "deflated":
        yield unpack.flush()


def _contents(frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """(row, its pieces) of listed members in the order of archive and number; archives are opened once, compressed tars go by once."""
    path, f, stream = None, None, None
    try:
        for frame in frames:
            for row in frame.itertuples(index=False):
                if row.archive != path:
                    for old in (stream and stream[0], f):
                        if old:
                            old.close()
                    path, f, stream = row.archive, _Seekable(row.archive), None
                if row.kind != "stream":
                    yield row, _bytes_of(f, row)
                    continue
                if stream is None:
                    t = tarfile.open(fileobj=f, mode="r|*")
                    stream = (t, ((n, m) for n, m in enumerate(m for m in t if m.isfile())))
                member = next(m for n, m in stream[1] if n == row.no)
                body = stream[0].extractfile(member)
                yield row, iter(lambda body=body: body.read(PIECE), b"")
    finally:
        for old in (stream and stream[0], f):
            if old:
                old.close()


def _dealt(listed: DataFrame) -> DataFrame:
    """Readable members, about ``CHUNK`` bytes of them together, in order; those of a compressed tar all together."""
    good = listed.filter("error is null").select("archive", "no", "kind", "start", "packed", "size", "target")
    placed = running_weight(good, "size", "archive", "no")
    chunk = F.when(F.col("kind") == "stream", F.col("archive")).otherwise(F.floor(F.col("before") / CHUNK).cast("string"))
    total = good.agg(F.sum("size")).first()[0] or 0
    return placed.repartition(max(1, min(20_000, 2 * (total // CHUNK) + 8)), chunk).sortWithinPartitions("archive", "no").drop("before")


def read_members(listed: DataFrame) -> DataFrame:
    """(archive, no, target, piece, content, error): the contents of members that ``members`` listed. Members over ``PIECE`` bytes come in
    several pieces, numbered from 0; an empty one is one empty piece. One that can't be read has its error in place of what is left."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        size = 0
        columns = ["archive", "no", "target", "piece", "content", "error"]
        for row, pieces in _contents(frames):
            k, rest = 0, b""
            key = (row.archive, row.no, row.target)
            try:
                for raw in pieces:
                    rest += raw
                    while len(rest) >= PIECE:
                        held.append((*key, k, rest[:PIECE], None))
                        k, rest, size = k + 1, rest[PIECE:], size + PIECE
                        if size >= PIECE:
                            yield pd.DataFrame(held, columns=columns)
                            held, size = [], 0
                if rest or not k:
                    held.append((*key, k, rest, None))
                    size += len(rest)
            except Exception as e:
                held.append((*key, k, None, str(e) or type(e).__name__))
            if size >= PIECE or len(held) >= 5_000:
                yield pd.DataFrame(held, columns=columns)
                held, size = [], 0
        if held:
            yield pd.DataFrame(held, columns=columns)

    return _dealt(listed).mapInPandas(run, "archive string, no long, target string, piece int, content binary, error string")


def extract(listed: DataFrame, folder: str) -> DataFrame:
    """Write the listed members under their targets in ``folder``: (archive, no, target, bytes, error) of each, once it is there. A member is
    streamed into a hidden file that takes its name when it is whole, so a failing one leaves none."""
    base = folder.rstrip("/")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, inner = filesystem(base)
        made: set[str] = set()
        held: list[tuple] = []
        for row, pieces in _contents(frames):
            target = f"{inner}/{row.target}"
            parent = target.rsplit("/", 1)[0]
            if parent not in made:
                store.create_dir(parent, recursive=True)
                made.add(parent)
            hidden, n = f"{parent}/.writing-{uuid.uuid4().hex}", 0
            try:
                with store.open_output_stream(hidden) as out:
                    for raw in pieces:
                        out.write(raw)
                        n += len(raw)
                store.move(hidden, target)
                held.append((row.archive, row.no, row.target, n, None))
            except Exception as e:
                store.delete_file(hidden)
                held.append((row.archive, row.no, row.target, None, str(e) or type(e).__name__))
            if len(held) >= 5_000:
                yield _extracted(held)
                held = []
        if held:
            yield _extracted(held)

    return written(_dealt(listed).mapInPandas(run, "archive string, no long, target string, bytes long, error string"), "extracted")


def _extracted(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["archive", "no", "target", "bytes", "error"]).astype({"bytes": "Int64"})
