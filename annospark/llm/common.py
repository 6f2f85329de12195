"""Small helpers shared by the text operators: the shared folder, staged tables, Arrow batch slicing."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a Python task works on at a time.
SLICE_BYTES = 1 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` where the session has it.

    Only in a local session (as in tests), where neither that setting nor a checkpoint directory exists, is a temporary
    folder set; on a cluster that fails, since executors would write to their own disks.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="annospark-")
        sc.setCheckpointDir(path)
    return path


def staged_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/annospark-{uuid.uuid4().hex}/{name}"


def staged(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = staged_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unstage(*tables: DataFrame) -> None:
    """Delete staged tables that no later step reads."""
    for table in tables:
        spark = table.sparkSession
        jvm = spark._jvm
        for file in table.inputFiles()[:1]:
            folder = jvm.org.apache.hadoop.fs.Path(file).getParent()
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


#: Bits of ``bit_set`` at most (64 MB), and of a stretch that is put together in one place.
MAX_BITS = 1 << 29
_STRETCH = 1 << 16
#: The column of ``row_keyed``.
ROW = "__row"


def row_keyed(docs: DataFrame, id_col: str = "doc_id", nulls_last: bool = True) -> tuple[DataFrame, bool]:
    """``docs`` with ``ROW``, a long that tells rows apart and is in the order of the ids; and whether it is no id.

    That is the id itself where no id repeats or is null. Else the rows are written once, in the order of their ids (null
    ids last or first, equal ids as read), with their numbers.
    """
    id_ = F.col(id_col).cast("long")
    odd = docs.groupBy(id_.alias("id")).count().filter("count > 1 or id is null").limit(1).count()
    if not odd:
        return docs.withColumn(ROW, id_), False
    ordered = docs.orderBy(id_.asc_nulls_last() if nulls_last else id_.asc_nulls_first(), F.monotonically_increasing_id())
    return staged(ordered.withColumn(ROW, F.monotonically_increasing_id()), "rows"), True


def stored(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` if its plan reads without a shuffle, so that a second reading gives the same rows in the same order; else a staged
    copy."""
    plan = docs._jdf.queryExecution().executedPlan().toString()
    return staged(docs, name) if "Exchange" in plan else docs


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def partitions_for(docs: DataFrame, each: int = 16 << 20, most: int = 20_000) -> int:
    """Shuffle partitions for what ``docs`` reads: the session's number, or more where a partition would stand for over ``each``
    bytes of input (as Spark's plan estimates it, where it can), up to ``most``."""
    size = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    known = size < 1 << 60
    return max(shuffle_partitions(docs.sparkSession), min(most, -(-size // each)) if known else 1)


def crc_bucket(doc_id: Column | str, modulus: int) -> Column:
    """``crc32(doc_id as text) mod modulus``; null ids give null."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary") if isinstance(doc_id, str) else doc_id.cast("string").cast("binary")) % modulus


def text_slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``limit`` bytes of text; a longer text stands alone."""
    n = batch.num_rows
    if not n:
        return
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), n]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def byte_texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts as UTF-8 bytes; null counts as empty."""
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenate ``flat[s : s + n]`` over all pairs of ``starts`` and ``lengths``."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(total, dtype=np.int64)]


def bounds(lengths: np.ndarray) -> np.ndarray:
    """0 and the running sums."""
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def list_array(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds(lengths).astype(np.int32)), pa.array(values, type=kind))


def packed(values: np.ndarray) -> bytes:
    """Numbers below 2^32 in few bytes: the lowest bytes of all of them, then the next ones, compressed."""
    return zstandard.compress(values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def unpacked(raw: bytes) -> np.ndarray:
    """The numbers that ``packed`` was given."""
    planes = np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def _places(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each 64-bit hash."""
    h, mask = h.view(np.uint64), np.uint64(bits - 1)
    return (h & mask).astype(np.int64), ((h >> np.uint64(32)) & mask).astype(np.int64)


def may_hold(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether each of these hashes may be one that ``bits`` (of ``bit_set``) were set for; of those it never says no."""
    a, b = _places(h, 8 * len(bits))
    return ((bits[a >> 3] >> (a & 7)) & (bits[b >> 3] >> (b & 7)) & 1).astype(bool)


def bit_set(rows: DataFrame, column: str) -> np.ndarray:
    """Two bits for each of the hashes (longs) of a column, about 16 bits in all per hash and ``MAX_BITS`` at most: however many there
    are, a broadcast has that bound. With more hashes than that it lets more others through, never fewer of its own.

    Each stretch of bits is put together in one place, and the driver joins the stretches."""
    bits = min(MAX_BITS, max(1 << 16, 1 << (16 * rows.count()).bit_length()))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.concatenate(_places(batch.column(0).to_numpy(), bits))
            yield pa.RecordBatch.from_arrays([pa.array((at // _STRETCH).astype(np.int32)), pa.array((at % _STRETCH).astype(np.int32))], ["stretch", "place"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            stretch, place = batch.column("stretch").to_numpy(), batch.column("place").to_numpy()
            for k in np.unique(stretch).tolist():
                found.setdefault(k, np.zeros(_STRETCH, np.uint8))[place[stretch == k]] = 1
        if found:
            packed_bits = [np.packbits(x, bitorder="little").tobytes() for x in found.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array(packed_bits, pa.binary())], ["stretch", "bits"])

    spread = rows.select(column).mapInArrow(places, "stretch int, place int").repartition(min(64, bits // _STRETCH), "stretch")
    found = np.zeros(bits // 8, np.uint8)
    for row in spread.mapInArrow(joined, "stretch int, bits binary").collect():
        found[row.stretch * _STRETCH // 8 : (row.stretch + 1) * _STRETCH // 8] = np.frombuffer(row.bits, np.uint8)
    return found


def likely_rows(docs: DataFrame, bits: Broadcast) -> DataFrame:
    """The rows of ``docs`` (doc_id, text) whose id may be one that ``bits`` (of ``id_bits``) were set for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.select(["doc_id", "text"]).filter(pa.array(may_hold(bits.value, batch.column("h").to_numpy())))

    return docs.select("doc_id", "text", F.xxhash64("doc_id").alias("h")).mapInArrow(run, "doc_id long, text string")


def id_bits(ids: DataFrame) -> Broadcast:
    """``bit_set`` of ``ids`` (doc_id), a stored table."""
    return ids.sparkSession.sparkContext.broadcast(bit_set(ids.select(F.xxhash64("doc_id").alias("h")), "h"))


def only_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc_id, text) whose id is in ``ids`` (doc_id). Rows whose id surely isn't don't leave their task. The
    join is a merge at every size, since ``ids`` grows with the input."""
    wanted = staged(ids.select("doc_id"), "ids")
    return likely_rows(docs, id_bits(wanted)).join(wanted.hint("merge"), "doc_id", "left_semi")
