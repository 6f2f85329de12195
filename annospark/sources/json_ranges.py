"""Values inside large JSON documents, found by byte ranges, so that a document doesn't have to fit in memory or in one task."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from annospark.sources.keyed_files import filesystem
from annospark.sources.listing import scan
from annospark.sources.shared import written

#: Bytes that a task looks at together.
RANGE = 16 << 20
#: Elements of arrays, and any key, in a place.
EACH, ANY = "[]", "*"
_TOKEN = re.compile(rb'"(?:[^"\\]+|\\.)*"|[{}\[\],:]|[^\s{}\[\],:"]+|"', re.S)
_REST_OF_STRING = re.compile(rb'(?:[^"\\]+|\\.)*"', re.S)
_REST_OF_SCALAR = re.compile(rb'[^\s{}\[\],:"]*')
_BETWEEN = b' \t\r\n{}[],:"'


class _Range:
    """A stretch of a file: its tokens are those that start in it, also where they end beyond it."""

    def __init__(self, f, start: int, end: int, length: int):
        self.f, self.start, self.end, self.length = f, start, end, length
        f.seek(start)
        self.raw = f.read(end - start)

    def escaped(self) -> bool:
        """Whether an odd number of backslashes stands right before the stretch."""
        n, at = 0, self.start
        while at:
            low = max(0, at - 4096)
            self.f.seek(low)
            before = self.f.read(at - low)
            run = len(before) - len(before.rstrip(b"\\"))
            n, at = n + run, low
            if run < len(before):
                break
        return n % 2 == 1

    def quotes(self) -> int:
        raw = self.raw[1:] if self.escaped() else self.raw
        return re.sub(rb"\\.", b"", raw, flags=re.S).count(b'"') if b"\\" in raw else raw.count(b'"')

    def more(self) -> bool:
        """Read on beyond the end; False where the file has ended."""
        at = self.start + len(self.raw)
        self.f.seek(at)
        found = self.f.read(min(self.length - at, max(1 << 16, len(self.raw))))
        self.raw += found
        return bool(found)

    def tokens(self, inside: bool) -> Iterator[tuple[int, int]]:
        """(start, end) of each token in ``raw``; after the last one that starts in the stretch, those that follow, for as long as they
        are asked for."""
        at = 0
        if inside:
            at = 1 if self.escaped() else 0
            while (found := _REST_OF_STRING.match(self.raw, at)) is None:
                if len(self.raw) >= self.end - self.start or not self.more():
                    return  # the string goes on beyond this stretch: nothing starts here
            at = found.end()
        elif self.start:
            self.f.seek(self.start - 1)
            if self.f.read(1) not in _BETWEEN:
                at = _REST_OF_SCALAR.match(self.raw).end()
        while True:
            found = _TOKEN.search(self.raw, at)
            open_ = found is not None and (found.group() == b'"' or (found.end() == len(self.raw) and self.raw[found.start()] not in b'{}[],:"'))
            if (found is None or open_) and self.start + len(self.raw) < self.length:
                at = found.start() if found else len(self.raw)
                self.more()
                continue
            if found is None or found.group() == b'"':
                return
            yield found.start(), found.end()
            at = found.end()


def _text(raw: bytes) -> str:
    return json.loads(raw) if b"\\" in raw else raw[1:-1].decode("utf-8", "replace")


def _wanted(stack: list[list], place: list[str]) -> list[str] | None:
    """The keys at which ``place`` allows any, if a value with these frames (kind, key) around it stands there."""
    if len(stack) != len(place):
        return None
    for (kind, key), step in zip(stack, place):
        if kind != ("[" if step == EACH else "{") or (step not in (EACH, ANY) and key != step):
            return None
    return [key for (_, key), step in zip(stack, place) if step == ANY]


def _walk(part: _Range, inside: bool, stack: list[list], places: list[list[str]], found: list[tuple]) -> tuple[int, str | None]:
    """Go through the tokens that start in a stretch, with the frames (kind, key) that are open in ``stack``, and put (start, place, keys,
    text) of each value in a wanted place into ``found``. Without places, ``stack`` may lack frames from before the stretch: returned are how
    many of those are closed, and the key that the innermost one left is at, if it moves there."""
    closed, moved = 0, None
    pending: tuple[int, int] | None = None  # a string that may turn out to be a key
    items: list[tuple] = []  # wanted objects and arrays that are open, and how many frames are around each

    def value(a: int, b: int) -> None:
        if part.start + a < part.end:
            for k, place in enumerate(places):
                if (keys := _wanted(stack, place)) is not None:
                    found.append((part.start + a, k, keys, part.raw[a:b].decode("utf-8", "replace")))

    for a, b in part.tokens(inside):
        beyond = part.start + a >= part.end
        first = part.raw[a]
        if pending is not None:
            if first == 0x3A:
                name = _text(part.raw[slice(*pending)])
                pending = None
                if stack:
                    stack[-1][1] = name
                else:
                    moved = name
                continue
            value(*pending)
            pending = None
        if beyond and not items:
            break
        if first == 0x22:
            pending = (a, b)
        elif first in b"{[":
            for k, place in enumerate([] if beyond else places):
                if (keys := _wanted(stack, place)) is not None:
                    items.append((len(stack), a, k, keys))
            stack.append([chr(first), None])
        elif first in b"}]":
            if stack:
                stack.pop()
            else:
                closed, moved = closed + 1, None
            while items and items[-1][0] == len(stack):
                _, start, k, keys = items.pop()
                found.append((part.start + start, k, keys, part.raw[start:b].decode("utf-8", "replace")))
        elif first not in b",:":
            value(a, b)
    if pending is not None:
        value(*pending)
    return closed, moved


def _stretches(frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """(row, its stretch of the file)."""
    path, f = None, None
    for frame in frames:
        for row in frame.itertuples(index=False):
            if row.path != path:
                if f is not None:
                    f.close()
                store, inner = filesystem(row.path)
                path, f = row.path, store.open_input_file(inner)
            yield row, _Range(f, row.start, row.end, row.length)
    if f is not None:
        f.close()


def _framed(rows: Iterator[tuple], columns: list[str]) -> Iterator[pd.DataFrame]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == 10_000:
            yield pd.DataFrame(held, columns=columns)
            held = []
    if held:
        yield pd.DataFrame(held, columns=columns)


def _quotes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    return _framed(((*row, part.quotes()) for row, part in _stretches(frames)), ["path", "start", "end", "length", "quotes"])


def _effects(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def rows() -> Iterator[tuple]:
        for row, part in _stretches(frames):
            opened: list[list] = []
            closed, moved = _walk(part, row.inside, opened, [], [])
            yield (*row, closed, moved, json.dumps(opened))

    return _framed(rows(), ["path", "start", "end", "length", "inside", "odd", "closed", "moved", "opened"])


def _composed(rows: pd.DataFrame) -> pd.DataFrame:
    """What is open where each stretch of a file begins, and whether all is closed at its end: a row per stretch."""
    rows = rows.sort_values("start")
    stack: list[list] = []
    before, fine = [], not bool(rows["odd"].iloc[-1])
    for closed, moved, opened in zip(rows["closed"], rows["moved"], rows["opened"]):
        before.append(json.dumps(stack))
        fine = fine and closed <= len(stack)
        stack = stack[: len(stack) - closed] if closed else stack
        if moved is not None and stack:
            stack = [*stack[:-1], [stack[-1][0], moved]]
        stack = stack + json.loads(opened)
    rows = rows[["path", "start", "end", "length", "inside"]].assign(stack=before, fine=fine and not stack)
    return rows


def json_values(spark: SparkSession, path: str, *places: list[str]) -> DataFrame:
    """(path, start, place, keys, value): the texts of the values in these places of each JSON document under ``path``, with the byte at which
    each starts, the number of its place, and the keys at which the place allows any.

    A place is a list of keys, ``ANY`` for any key and ``EACH`` for the elements of an array: ``["label_counts", ANY, ANY, EACH]``. Files are
    looked at in stretches of ``RANGE`` bytes, whichever task has them, in three passes: quotes per stretch tell which begin inside a string; the
    brackets that each stretch leaves open or closes tell what is open where it begins; and then each finds the values that start in it, reading
    on where one ends beyond. A file of one stretch needs the last pass only. A task holds one stretch and the value at its end. A file whose brackets or strings don't close has no values; a
    missing path has none. Several documents in a file count as one after the other.
    """
    listed = scan(spark, path).select("path", "length")
    each = listed.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(RANGE).cast("long"))).alias("start"))
    each = each.select("path", "start", F.least(F.col("start") + RANGE, F.col("length")).alias("end"), "length")
    size = each.agg(F.count("*").alias("n"), F.sum(F.col("end") - F.col("start")).alias("bytes")).first()
    parts = max(1, min(size["n"], 20_000, (size["bytes"] or 0) // RANGE + spark.sparkContext.defaultParallelism))
    schema = "path string, start long, end long, length long"
    alone = (F.col("start") == 0) & (F.col("end") == F.col("length"))
    whole = each.filter(alone).withColumns({"inside": F.lit(False), "stack": F.lit(None).cast("string")})
    quoted = written(each.filter(~alone).repartition(parts).mapInPandas(_quotes, f"{schema}, quotes long"), "quotes")
    ahead = Window.partitionBy("path").orderBy("start")  # the stretches of one file: a row for each
    inside = F.coalesce(F.sum("quotes").over(ahead.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2 == 1
    known = quoted.select("path", "start", "end", "length", inside.alias("inside"), (F.sum("quotes").over(ahead) % 2 == 1).alias("odd"))
    effects = known.repartition(parts).mapInPandas(_effects, f"{schema}, inside boolean, odd boolean, closed int, moved string, opened string")
    effects = written(effects, "effects")
    cut = effects.groupBy("path").applyInPandas(_composed, f"{schema}, inside boolean, stack string, fine boolean")
    begun = whole.unionByName(written(cut, "stretches").filter("fine").drop("fine"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows() -> Iterator[tuple]:
            for row, part in _stretches(frames):
                found: list[tuple] = []
                whole = pd.isna(row.stack)  # a file of one stretch
                stack = [] if whole else json.loads(row.stack)
                closed, _ = _walk(part, row.inside, stack, [list(p) for p in places], found)
                if whole and (closed or stack or part.quotes() % 2):
                    continue  # its brackets or strings don't close
                yield from ((row.path, *f) for f in found)

        return _framed(rows(), ["path", "start", "place", "keys", "value"])

    return begun.repartition(parts).mapInPandas(run, "path string, start long, place int, keys array<string>, value string")
