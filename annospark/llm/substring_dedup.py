"""Sub-document de-duplication: repeated lines, paragraphs, sentences and passages go, the earliest ranked occurrence stays."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annospark.llm.common import ROW, bit_set, bounds, byte_texts, may_hold, row_keyed, staged, text_slices

#: Units: a line with its end; a paragraph with the empty lines behind it; a sentence, which is a run of characters up to full
#: stops, question marks and line ends, with the blanks behind them.
UNITS = {"line": rb"[^\n]*\n|[^\n]+", "paragraph": rb"(?s).+?(?:\n[ \t\r]*\n[ \t-\r]*|\Z)", "sentence": rb"[^.?\n]+[.?\n ]*|[.?\n ]+"}
#: A unit of fewer words is compared together with its neighbours.
MIN_WORDS = 8
#: Passages: runs of so many words are compared wherever they start. Of any ``WINDOW`` neighbouring runs one at least is
#: picked, by its hash, so that a repeated passage of ``RUN + WINDOW - 1`` words is always found.
RUN = WINDOW = 10
#: The same for scripts without blanks (Thai to Khmer, CJK with its stops), where each code point counts like a word.
POINT_RUN = POINT_WINDOW = 20
_POINTS = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3001-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff00-\uffef\U00020000-\U0003ffff"
_POINT = re.compile(f"[{_POINTS}]")
_TOKEN = re.compile(f"[{_POINTS}]|[^ \t-\r{_POINTS}]+")
_BLANK = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))
_MAX_WORDS = 300_000


def _patterns(unit: str | Sequence[str]) -> list[re.Pattern]:
    return [re.compile(UNITS[name]) for name in ([unit] if isinstance(unit, str) else unit)]


def _keys(text: bytes, min_words: int, levels: list[re.Pattern]) -> list[tuple[int, int, int, bytes]]:
    """(first byte of its words, level, number, normalised text) of each compared unit, by place: A-Z in lower case, white
    space as one blank."""
    text = text.lower()
    found = []
    for level, pattern in enumerate(levels):
        raw = pattern.findall(text)
        words = [u.split() for u in raw]
        plain = [b" ".join(w) for w in words]
        for i, (w, end) in enumerate(zip(words, accumulate(map(len, raw)))):
            start = end - len(raw[i].lstrip())
            if len(w) >= min_words:
                found.append((start, level, i, plain[i]))
            elif w:
                before, behind = slice(i - 1, i) if i else slice(0), slice(i + 1, i + 2)
                if len(w) + sum(map(len, words[before])) + sum(map(len, words[behind])) >= min_words:
                    found.append((start, level, i, b"\n".join([b"".join(plain[before]), plain[i], b"".join(plain[behind])])))
    return sorted(found) if len(levels) > 1 else found


class _Hashes(dict):
    """The hash of each word, computed once."""

    def __missing__(self, word):
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def _sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` over each ``width`` neighbouring values."""
    have = 1
    while have < width:
        step = min(have, width - have)
        values, have = pick(values[:-step], values[step:]), have + step
    return values


def _picked_runs(texts: list[list], hashes: _Hashes, run: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word, 64-bit hash and ``again`` of the picked runs of ``run`` words. A run counts as ``again`` if the
    first equal one of its text ends before it."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    n = int(lengths.sum())
    if n < run:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64), np.zeros(0, bool))
    if len(hashes) > _MAX_WORDS:
        hashes.clear()
    word = np.fromiter(map(hashes.__getitem__, chain.from_iterable(texts)), np.uint64, n)
    h = np.zeros(n - run + 1, np.uint64)
    for k in range(run):
        h = h * np.uint64(0x9E3779B97F4A7C15) + word[k : len(h) + k]
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    owner = np.repeat(np.arange(len(texts)), lengths)
    whole = owner[: len(h)] == owner[run - 1 :]
    most = np.iinfo(np.uint64).max
    edge = np.full(window - 1, most)
    least = _sliding(np.concatenate([edge, np.where(whole, h, most), edge]), window, np.minimum)
    at = np.flatnonzero(whole & (h == _sliding(least, window, np.maximum)))
    own, first, h = owner[at], at - bounds(lengths)[owner[at]], h[at]
    order = np.lexsort((first, h, own))
    own, first, h = own[order], first[order], h[order]
    new = np.append(True, (own[1:] != own[:-1]) | (h[1:] != h[:-1]))[: len(h)]
    again = first >= first[np.flatnonzero(new)][np.cumsum(new) - 1] + run
    return own, first, h, again


def _words(texts: list[bytes]) -> list[list[bytes]]:
    return [t.lower().split() for t in texts]


def _tokens(texts: list[bytes]) -> list[list[str]]:
    """Code points of scripts without blanks and the words between them; none for texts without such scripts."""
    decoded = ["" if t.isascii() else t.lower().decode() for t in texts]
    return [_TOKEN.findall(t) if _POINT.search(t) else [] for t in decoded]


def unit_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, passages: bool = False, unit: str | Sequence[str] = "sentence", among: Broadcast | None = None) -> DataFrame:
    """One row per compared unit: doc_id, unit (its number in the text), a 128-bit digest in two halves, and ``again`` if
    the same digest stands earlier in that text. A short unit's digest spans its neighbours, so that it counts as repeated
    only where they repeat with it. With several kinds of units (coarse ones first) all of them give rows, unit k of the j-th of m kinds as
    m k + j; where a coarse unit has no words but those of one finer unit, only the coarse one does.

    With ``passages`` also one row per picked run of words: unit is -1 - 2 w for the run from word w, -2 - 2 w in texts of
    scripts without blanks, hi its 64-bit hash and lo the kind (0 or 1).

    With ``among``, bits of ``bit_set``, only rows that may have one of those digests, and all with ``again``."""

    def wanted(hi: np.ndarray, again: np.ndarray) -> np.ndarray:
        if among is None:
            return np.ones(len(hi), bool)
        return again | may_hold(among.value, hi)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, levels = _Hashes(), _patterns(unit)
        for batch in batches:
            for part in text_slices(batch):
                units, digests, again, per_text = [], [], [], []
                texts = byte_texts(part)
                for text in texts:
                    seen, before = {}, len(units)
                    for start, level, i, key in _keys(text, min_words, levels):
                        digest = xxhash.xxh3_128_digest(key)
                        if seen.get(digest) != start:
                            units.append(len(levels) * i + level)
                            digests.append(digest)
                            again.append(digest in seen)
                            seen[digest] = start
                    per_text.append(len(units) - before)
                hi, lo = np.ascontiguousarray(np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2).T)
                again = np.array(again, bool)
                keep = wanted(hi, again)
                ids = part.column("doc_id").take(pa.array(np.repeat(np.arange(len(per_text)), per_text)[keep]))
                yield pa.RecordBatch.from_arrays([ids, pa.array(np.array(units, np.int32)[keep]), pa.array(hi[keep]), pa.array(lo[keep]), pa.array(again[keep])], names)
                for kind, cut, size, window in kinds:
                    own, first, h, repeated = _picked_runs(cut(texts), hashes, size, window)
                    keep = wanted(h, repeated)
                    own, first, h, repeated = own[keep], first[keep], h[keep], repeated[keep]
                    ids = part.column("doc_id").take(pa.array(own))
                    yield pa.RecordBatch.from_arrays([ids, pa.array(-1 - kind - 2 * first).cast(pa.int32()), pa.array(h.view(np.int64)), pa.array(np.full(len(h), kind)), pa.array(repeated)], names)

    names = ["doc_id", "unit", "hi", "lo", "again"]
    kinds = [(0, _words, RUN, WINDOW), (1, _tokens, POINT_RUN, POINT_WINDOW)] if passages else []
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, unit int, hi long, lo long, again boolean")


def repeated_units(docs: DataFrame, id_col: str, text_col: str, *options) -> DataFrame:
    """(doc_id, units): the units of each document that stand elsewhere in an earlier ranked place, sorted.

    Digests are counted with map-side aggregation. Only rows that may have a digest of several documents are then joined with
    those digests; the others don't leave their task. Spark splits the partitions of very common digests.
    """
    units = unit_digests(docs, id_col, text_col, *options)
    first = units.filter("not again").groupBy("hi", "lo").agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("n")).filter("n > 1")
    first = staged(first.select("hi", "lo", "first_doc"), "digests")
    units = unit_digests(docs, id_col, text_col, *options, docs.sparkSession.sparkContext.broadcast(bit_set(first, "hi")))
    gone = units.join(first, ["hi", "lo"], "left").filter(F.col("again") | (F.col("doc_id") > F.col("first_doc")))
    return gone.groupBy("doc_id").agg(F.sort_array(F.collect_list("unit")).alias("units"))


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, passages: bool = True, unit: str | Sequence[str] = "sentence") -> DataFrame:
    """``docs`` with repeated units taken out of the text, and ``removed``: array of (start, end) in code points of the
    original text, adjacent units joined. ``unit`` is one of ``UNITS``, or several, coarse ones first: then what repeats as a unit of
    any kind goes, a line also where it stands elsewhere as a paragraph.

    With ``passages`` also repeated runs of words that start or end inside a unit, runs of short units, and runs of code
    points of scripts without blanks: all of ``RUN + WINDOW - 1`` words (``POINT_RUN + POINT_WINDOW - 1`` code points) are
    found, but for less than a window at either end. Of a unit cut by the end of a passage a part of up to ``RUN`` words
    stays, and so does a unit under ``MIN_WORDS`` words there.

    Of equal units the one in the smallest doc_id stays, and in that document the first; null ids rank last. Rows that
    repeat an id, or have none, are documents of their own, in the order in which they are read. Null texts stay null, and they
    and empty ones have nothing removed. All other columns are kept; a column named ``removed`` is replaced.
    """
    docs = docs.drop("removed") if id_col != "removed" and text_col != "removed" else docs
    names = docs.columns
    docs, _ = row_keyed(docs, id_col)
    plan = repeated_units(docs, ROW, text_col, min_words, passages, unit).withColumnsRenamed({"doc_id": ROW, "units": "__units"})
    joined = docs.join(plan, ROW, "left").select(*names, "__units")
    docs = docs.select(names)
    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    schema = T.StructType([*docs.schema.fields, T.StructField("removed", span)])
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = _patterns(unit)
        for batch in batches:
            for part in text_slices(batch, text_col):
                texts, spans = [], []
                for text, units in zip(part.column(text_col).cast(pa.binary()).to_pylist(), part.column("__units").to_pylist()):
                    kept, gone = _cut(text, units, levels) if text and units else (text, [])
                    texts.append(kept)
                    spans.append(gone)
                at = part.schema.get_field_index(text_col)
                columns = [*part.columns[:at], pa.array(texts, pa.binary()).cast(pa.string()), *part.columns[at + 1 : -1], pa.array(spans, kind)]
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names[:-1], "removed"])

    return joined.mapInArrow(run, schema)


def _starts(text: bytes, kind: int) -> np.ndarray:
    """First byte of each word or token, and the end of the text."""
    if kind:
        first = np.fromiter((m.start() for m in _TOKEN.finditer(text.decode())), np.int64)
        return np.append(np.flatnonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)[first], len(text))
    blank = _BLANK[np.frombuffer(text, np.uint8)]
    return np.append(np.flatnonzero(~blank & np.append(True, blank[:-1])), len(text))


def _parts(starts: np.ndarray, edges: np.ndarray, whole: np.ndarray, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last byte of what goes of the words in ``runs``: a part of a unit if it is more than one run, a whole unit
    of ``MIN_WORDS`` words, and a shorter one if both neighbours are in runs or in the units ``whole`` too."""
    unit = np.searchsorted(edges, starts[:-1], "right") - 1
    marks = np.zeros(len(starts) + RUN, np.int64)
    np.add.at(marks, runs, 1)
    np.add.at(marks, runs + RUN, -1)
    gone = (np.cumsum(marks)[: len(unit)] > 0) | np.isin(unit, whole)
    n = len(edges) - 1
    full = np.bincount(unit, minlength=n) > 0
    full &= np.bincount(unit, gone, n) == np.bincount(unit, minlength=n)
    inside = full & np.append(False, full[:-1]) & np.append(full[1:], False)
    at = np.flatnonzero(gone)
    new = np.append(True, (np.diff(at) > 1) | (np.diff(unit[at]) > 0))
    first, behind = at[new], at[np.append(new[1:], True)] + 1
    goes = (behind - first > RUN) | (full[unit[first]] & (behind - first >= MIN_WORDS)) | inside[unit[first]]
    return starts[first[goes]], starts[behind[goes]]


def _cut(text: bytes, units: list[int], levels: list[re.Pattern]) -> tuple[bytes, list[tuple[int, int]]]:
    """The text without these units and runs, and their spans in code points."""
    found = np.array(units)
    first, last = [], []
    for level, pattern in enumerate(levels):
        edges = np.array([0, *(m.end() for m in pattern.finditer(text))])
        own = found[(found >= 0) & (found % len(levels) == level)] // len(levels)
        first.append(edges[own])
        last.append(edges[own + 1])
    for kind in (0, 1):
        if len(runs := (-1 - kind - found[(found < 0) & ((-1 - found) % 2 == kind)]) // 2):
            starts = _starts(text, kind)
            a, b = (starts[runs], starts[runs + POINT_RUN]) if kind else _parts(starts, edges, own, runs)
            first.append(a)
            last.append(b)
    first, last = np.concatenate(first), np.concatenate(last)
    if not len(first):
        return text, []
    order = np.argsort(first, kind="stable")
    first, last = first[order], np.maximum.accumulate(last[order])
    new = np.append(True, first[1:] > last[:-1])
    first, last = first[new], last[np.append(new[1:], True)]
    kept = b"".join(text[a:b] for a, b in zip([0, *last.tolist()], [*first.tolist(), len(text)]))
    points = np.append(0, np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))
    return kept, list(zip(points[first].tolist(), points[last].tolist()))


#: The units of the query.
LEVELS = ("paragraph", "line", "sentence")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without repeated paragraphs, lines and sentences, as ``OP2_SQL`` has them, and what was removed."""
    found = substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), passages=False, unit=LEVELS)
    return found.select("doc_id", "text", F.size("removed").cast("long").alias("n_removed"), F.to_json("removed").alias("removed"))


def _units_sql(level: int, name: str) -> str:
    pattern = UNITS[name].decode().replace("\\Z", "\\z")
    return f"""
  SELECT {level} AS level, doc_id, unnest(l) AS raw, generate_subscripts(l, 1) AS unit
  FROM (SELECT doc_id, regexp_extract_all(text, '{pattern}') AS l FROM documents)"""


OP2_SQL = f"""
WITH u AS ({" UNION ALL ".join(_units_sql(*named) for named in enumerate(LEVELS))}
), p AS (
  SELECT level, doc_id, unit, raw, regexp_extract_all(translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM u
), q AS (
  SELECT level, doc_id, raw, len(w) AS n, array_to_string(w, ' ') AS t,
         sum(length(raw)) OVER d AS stop,
         coalesce(lag(len(w)) OVER d, 0) + len(w) + coalesce(lead(len(w)) OVER d, 0) AS near,
         coalesce(lag(array_to_string(w, ' ')) OVER d, '') || chr(10) || array_to_string(w, ' ') || chr(10) || coalesce(lead(array_to_string(w, ' ')) OVER d, '') AS with_near
  FROM p WINDOW d AS (PARTITION BY level, doc_id ORDER BY unit)
), k AS (
  SELECT level, doc_id, stop - length(raw) AS a, stop AS b,
         stop - length(regexp_replace(raw, '^[\\x20\\x09-\\x0D]+', '')) AS place,
         CASE WHEN n >= {MIN_WORDS} THEN t WHEN n > 0 AND near >= {MIN_WORDS} THEN with_near END AS key
  FROM q
), c AS (
  SELECT * FROM k WHERE key IS NOT NULL QUALIFY row_number() OVER (PARTITION BY key, doc_id, place ORDER BY level) = 1
), g AS (
  SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY key ORDER BY doc_id, place) > 1
), e AS (
  SELECT doc_id, a, b, coalesce(a > max(b) OVER (PARTITION BY doc_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS new FROM g
), s AS (
  SELECT doc_id, a, b, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY a, b) AS block FROM e
), r AS (
  SELECT doc_id, min(a)::BIGINT AS a, max(b)::BIGINT AS b FROM s GROUP BY doc_id, block
), f AS (
  SELECT r.*, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS kept FROM r
), j AS (
  SELECT doc_id, count(*) AS n_removed, '[' || string_agg('{{"start":' || a || ',"end":' || b || '}}', ',' ORDER BY a) || ']' AS removed,
         string_agg(substr(d.text, kept + 1, a - kept), '' ORDER BY a) || substr(any_value(d.text), max(b) + 1) AS text
  FROM f JOIN documents d USING (doc_id) GROUP BY doc_id
)
SELECT d.doc_id, coalesce(j.text, d.text) AS text, coalesce(n_removed, 0) AS n_removed, coalesce(removed, '[]') AS removed
FROM documents d LEFT JOIN j USING (doc_id)
"""
