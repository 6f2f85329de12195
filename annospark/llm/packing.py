"""Packing token sequences by best-fit decreasing."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annospark.llm.bpe import BYTE_BPE
from annospark.llm.common import bounds, list_array
from annospark.llm.word_table import encoded, tokenizer

#: Pieces, and ids, that are packed together at most; bounds a task's memory.
BLOCK, BLOCK_IDS = 1 << 17, 1 << 24
#: Pieces in an Arrow batch.
_ROWS = 1 << 12
_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids array<int>"


class OpenWindows:
    """Open windows by remaining capacity: a segment tree over capacities counts the windows below each node."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _change(self, room: int, by: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, window: int, room: int) -> None:
        if room:
            self.windows[room].append(window)
            self._change(room, 1)

    def tightest(self, need: int) -> tuple[int, int] | None:
        """Take out the window with the least room that is at least ``need``: (window, room)."""
        node = need + self.leaves
        if not self.count[node]:
            while node & 1 or not self.count[node + 1]:  # up, until a right sibling has windows
                node >>= 1
                if node <= 1:
                    return None
            node += 1
            while node < self.leaves:  # down to its leftmost
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._change(room, -1)
        return self.windows[room].pop(), room


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The window and the offset in it of each piece (of 1 to ``window`` tokens), longest first."""
    at, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    tree, opened = OpenWindows(window), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        found = tree.tightest(need)
        if found is None:
            found, opened = (opened, window), opened + 1
        at[i], offset[i] = found[0], window - found[1]
        tree.put(found[0], found[1] - need)
    return at, offset


def pieces(docs: DataFrame, path: str = BYTE_BPE, window: int = 1024, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, doc_tokens, ids) of each document's full windows and of what remains of it; ids as little-endian unsigned
    integers of 16 bits, or 32 where the vocabulary is larger."""
    kind = "<u4" if _wide(path, end_id) else "<u2"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, ids, counts in encoded(batches, path):
            total = counts + 1
            ends = np.cumsum(total)
            flat = np.full(int(ends[-1]), end_id, np.int32)
            keep = np.ones(len(flat), bool)
            keep[ends - 1] = False
            flat[keep] = ids
            per_doc = -(-total // window)
            doc = np.repeat(np.arange(len(total)), per_doc)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)) * window
            length = np.minimum(window, total[doc] - start)
            raw = flat.astype(kind)
            edges = bounds(length * raw.itemsize)
            for a in range(0, len(doc), _ROWS):
                at = slice(a, a + _ROWS)
                own = raw.view(np.uint8)[edges[at][0] : edges[a : a + _ROWS + 1][-1]]
                lists = pa.BinaryArray.from_buffers(pa.binary(), len(doc[at]), [None, pa.py_buffer((edges[a : a + _ROWS + 1] - edges[a]).astype(np.int32).tobytes()), pa.py_buffer(own.tobytes())])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(doc[at])), pa.array(start[at]), pa.array(total[doc[at]]), lists], ["doc_id", "start", "doc_tokens", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, start long, doc_tokens long, ids binary")


def _wide(path: str, end_id: int) -> bool:
    return tokenizer(path).get_vocab_size() > 1 << 16 or end_id >= 1 << 16


def pack(docs: DataFrame, path: str = BYTE_BPE, window: int = 1024, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of documents in sequences of at most ``window`` tokens.

    A document's tokens are its text's ids and ``end_id``; null and empty texts have that one. A longer document is
    first cut into full windows, each a sequence of its own; what remains of it, and shorter documents, are packed by
    best-fit decreasing. Columns: doc_id, start (its document's tokens before the piece), length, ids_crc32,
    doc_tokens, sequence_id, offset (in the sequence, without gaps from 0), and the piece's ids.

    Pieces are dealt out anew, evenly and in partitions of about the advised size, so that how full the sequences get does not
    depend on how the input is cut up; each partition packs blocks of at most ``BLOCK`` pieces and ``BLOCK_IDS`` ids by itself.
    ``sequence_id`` is unique, not without gaps. A null id stays null and repeated rows are packed each. An empty input gives
    no rows.
    """
    kind = "<u4" if _wide(path, end_id) else "<u2"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        held: list[pa.RecordBatch] = []
        n_held = ids_held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal base, held, n_held, ids_held
            if held:
                length = np.concatenate([_lengths(b, kind) for b in held])
                at, offset = best_fit_decreasing(length, window)
                a = 0
                for rows in held:
                    b = a + rows.num_rows
                    yield packed_rows(rows, length[a:b], base + at[a:b], offset[a:b])
                    a = b
                base += int(at.max()) + 1
            held, n_held, ids_held = [], 0, 0

        def packed_rows(rows: pa.RecordBatch, length: np.ndarray, sequence: np.ndarray, offset: np.ndarray) -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(rows.column("ids").to_pylist()), kind)
            edges = (4 * bounds(length)).tolist()
            raw = ids.astype("<u4").tobytes()
            crc = np.fromiter((zlib.crc32(raw[a:b]) for a, b in zip(edges, edges[1:])), np.int64, len(length))
            numbers = [pa.array(x, pa.int64()) for x in (length, crc, rows.column("doc_tokens"), sequence, offset)]
            return pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("start"), *numbers, list_array(ids.astype(np.int32), length, pa.int32())], names)

        for batch in batches:
            for a in range(0, batch.num_rows, _ROWS):
                rows = batch.slice(a, _ROWS)
                full = _lengths(rows, kind) == window
                if full.any():
                    own = rows.filter(pa.array(full))
                    n = own.num_rows
                    yield packed_rows(own, np.full(n, window), base + np.arange(n), np.zeros(n, np.int64))
                    base += n
                if not full.all():
                    held.append(rows.filter(pa.array(~full)))
                    n_held += held[-1].num_rows
                    ids_held += int(_lengths(held[-1], kind).sum())
                if n_held >= BLOCK or ids_held >= BLOCK_IDS:
                    yield from flush()
        yield from flush()

    names = [field.split()[0] for field in _PIECE.split(", ")]
    return pieces(docs, path, window, end_id, id_col, text_col).hint("rebalance").mapInArrow(run, _PIECE)


def _lengths(rows: pa.RecordBatch, kind: str) -> np.ndarray:
    return pc.binary_length(rows.column("ids")).to_numpy(zero_copy_only=False).astype(np.int64) // np.dtype(kind).itemsize


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every document's pieces lie, and the checksums of their ids."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("ids")
