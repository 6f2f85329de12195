"""Token-id files: a concatenated id array with Elias-Fano coded document boundaries."""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate, chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annospark.llm.common import bounds, partitions_for, staged_path
from annospark.llm.word_table import encoded, tokenizer

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
#: Ids after which a shard is closed. A document lies whole in one shard.
SHARD_IDS = 1 << 18
#: One select sample for so many values.
SAMPLE = 64
_SHARD = "part int, seq int, before long, n_docs long, n_ids long, id_bytes int, doc_ids binary, null_ids binary, ends binary, ids binary"


@dataclass
class EliasFano:
    """A sorted array of n integers below u in about n * (2 + log2(u / n)) bits.

    The low bits of each value are packed; the high parts are unary in a bit vector, the i-th value's 1 standing at
    high + i. Samples of every 64th 1's place let ``select`` read one value without a table of 64-bit offsets.
    """

    n: int
    base: int
    low_bits: int
    low: np.ndarray
    high: np.ndarray
    samples: np.ndarray

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        n, base = len(values), int(values[0]) if len(values) else 0
        up = (values - base).astype(np.uint64)  # modulo 2^64: the span of signed 64-bit integers fits
        span = int(up[-1]) if n else 0
        low_bits = max(0, (span // max(n, 1)).bit_length() - 1)
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits(((up[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        places = (up >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
        bits[places] = 1
        return cls(n, base, low_bits, low, np.packbits(bits, bitorder="little"), places[::SAMPLE].astype("<u4"))

    def _low(self, i: int) -> int:
        a, b = i * self.low_bits, (i + 1) * self.low_bits
        return (int.from_bytes(self.low[a // 8 : -(-b // 8)].tobytes(), "little") >> a % 8) & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """The i-th value, from the sample before it and the bits that follow."""
        place, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte, skip = place // 8, place % 8
        while True:
            ones = np.flatnonzero(np.unpackbits(self.high[byte : byte + 64], bitorder="little")[skip:])
            if left < len(ones):
                return self.base + (((byte * 8 + skip + int(ones[left]) - i) << self.low_bits) | self._low(i))
            left, byte, skip = left - len(ones), byte + 64, 0

    def values(self) -> np.ndarray:
        """All values."""
        places = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        low = np.unpackbits(self.low, bitorder="little")[: self.n * self.low_bits].reshape(self.n, self.low_bits).astype(np.uint64)
        low = (low << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        high = (places - np.arange(self.n)).astype(np.uint64)
        return ((high << np.uint64(self.low_bits)) | low).astype(np.int64) + np.int64(self.base)

    def to_bytes(self) -> bytes:
        head = np.array([self.n, self.base, self.low_bits, len(self.low), len(self.high), len(self.samples)], "<i8")
        return head.tobytes() + self.low.tobytes() + self.high.tobytes() + self.samples.tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> EliasFano:
        n, base, low_bits, a, b, c = np.frombuffer(raw, "<i8", 6).tolist()
        byte = lambda at, size: np.frombuffer(raw, np.uint8, size, at)
        return cls(n, base, low_bits, byte(48, a), byte(48 + a, b), np.frombuffer(raw, "<u4", c, 48 + a + b))


def write_token_files(docs: DataFrame, path: str, vocabulary: str = WORD_BPE, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None) -> None:
    """Write each document's ids and ``end_id`` under ``path``, in ascending id order (null ids first).

    ``path/shards`` holds one row per shard: its number, the ids before it in its partition, an array of ids (16 bits
    each where the vocabulary allows), the document ids and the document ends, both Elias-Fano coded. ``path/parts``
    holds the ids before each partition. Null and empty texts have the end id alone; repeated rows are written each. An
    empty input writes no shard. Two range-partitioned documents of one id may lie in any order.
    """
    wide = tokenizer(vocabulary).get_vocab_size() > 1 << 16 or end_id >= 1 << 16

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        names: list[pa.Array] = []
        runs: list[np.ndarray] = []
        sizes: list[np.ndarray] = []

        def shard() -> pa.RecordBatch:
            nonlocal seq, before, names, runs, sizes
            name, ids, size = pa.concat_arrays(names), np.concatenate(runs), np.concatenate(sizes)
            null = np.packbits(name.is_null().to_numpy(zero_copy_only=False), bitorder="little").tobytes() if name.null_count else b""
            known = name.drop_null().to_numpy()
            row = {
                "part": part, "seq": seq, "before": before, "n_docs": len(size), "n_ids": len(ids), "id_bytes": 4 if wide else 2,
                "doc_ids": EliasFano.of(known).to_bytes(), "null_ids": null, "ends": EliasFano.of(np.cumsum(size)).to_bytes(), "ids": ids.astype("<u4" if wide else "<u2").tobytes(),
            }
            seq, before, names, runs, sizes = seq + 1, before + len(ids), [], [], []
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), *[pa.binary()] * 4]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row.values(), kinds)], list(row))

        held = 0
        for rows, ids, counts in encoded(batches, vocabulary):
            total = counts + 1
            ends = np.cumsum(total)
            flat = np.full(int(ends[-1]), end_id, np.int32)
            keep = np.ones(len(flat), bool)
            keep[ends - 1] = False
            flat[keep] = ids
            a = 0
            for b in [*(np.flatnonzero(np.diff((held + ends) // SHARD_IDS)) + 1).tolist(), len(total)]:
                names.append(rows.column("doc_id").slice(a, b - a))
                sizes.append(total[a:b])
                runs.append(flat[ends[a] - total[a] : ends[b - 1]])
                held += int(ends[b - 1] - ends[a] + total[a])
                a = b
                if held >= SHARD_IDS:
                    yield shard()
                    held = 0
        if names:
            yield shard()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.repartitionByRange(partitions or partitions_for(rows), "doc_id").sortWithinPartitions("doc_id")
    shards = rows.mapInArrow(run, _SHARD)
    shards.write.option("compression", "zstd").option("parquet.block.size", 16 << 20).parquet(f"{path}/shards")
    spark = docs.sparkSession
    written = spark.read.schema(_SHARD).parquet(f"{path}/shards")
    sums = written.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()  # a row per partition
    before = accumulate([r.n for r in sums], initial=0)
    spark.createDataFrame([(r.part, b) for r, b in zip(sums, before)], "part int, part_before long").coalesce(1).write.parquet(f"{path}/parts")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), ids. Where a document lies in its shard, the
    select structure of the shard's ends tells."""
    shards = spark.read.schema(_SHARD).parquet(f"{path}/shards")
    parts = spark.read.schema("part int, part_before long").parquet(f"{path}/parts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                ids = np.frombuffer(row["ids"], "<u4" if row["id_bytes"] == 4 else "<u2")
                ends = EliasFano.from_bytes(row["ends"])
                names = np.zeros(ends.n, np.int64)
                null = np.unpackbits(np.frombuffer(row["null_ids"], np.uint8), bitorder="little")[: ends.n].astype(bool) if row["null_ids"] else np.zeros(ends.n, bool)
                names[~null] = EliasFano.from_bytes(row["doc_ids"]).values()
                edge = np.fromiter(chain([0], map(ends.select, range(ends.n))), np.int64, ends.n + 1)
                lists = pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([pa.array(names, mask=null), pa.array(row["before"] + row["part_before"] + edge[:-1], pa.int64()), lists], ["doc_id", "start", "ids"])

    placed = shards.join(F.broadcast(parts), "part")  # a row per partition of the writer
    return placed.mapInArrow(run, "doc_id long, start long, ids array<int>")


def read_documents(spark: SparkSession, path: str, doc_ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, start, ids) of the documents of these ids alone: shards of other id ranges are skipped, and of the rest only
    these documents' ids are cut out, at the places that ``select`` gives. Ids without a document have no row; an id's
    repeated documents come each. Of ``doc_ids``, null ids and repeats don't count."""
    shards = spark.read.schema(_SHARD).parquet(f"{path}/shards")
    parts = spark.read.schema("part int, part_before long").parquet(f"{path}/parts")

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [EliasFano.from_bytes(raw) for raw in batch.column("doc_ids").to_pylist()]
            first, last = ([ef.select(k) if ef.n else None for ef, k in ((ef, k % max(ef.n, 1)) for ef in found)] for k in (0, -1))
            yield pa.RecordBatch.from_arrays([batch.column("part"), batch.column("seq"), pa.array(first, pa.int64()), pa.array(last, pa.int64())], ["part", "seq", "first", "last"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                known, ends = EliasFano.from_bytes(row["doc_ids"]), EliasFano.from_bytes(row["ends"])
                ids = np.frombuffer(row["ids"], "<u4" if row["id_bytes"] == 4 else "<u2")
                nulls = ends.n - known.n  # null ids come first
                names, starts, parts_ = [], [], []
                for want in row["wanted"]:
                    k = bisect_left(range(known.n), want, key=known.select)
                    while k < known.n and known.select(k) == want:
                        a, b = (ends.select(nulls + k - 1) if nulls + k else 0), ends.select(nulls + k)
                        names.append(want)
                        starts.append(row["before"] + row["part_before"] + a)
                        parts_.append(ids[a:b].astype(np.int32))
                        k += 1
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(starts, pa.int64()), pa.array(parts_, pa.list_(pa.int32()))], ["doc_id", "start", "ids"])

    ranges = shards.select("part", "seq", "doc_ids").mapInArrow(spans, "part int, seq int, first long, last long")
    wanted = doc_ids.select(F.col(id_col).cast("long").alias("want")).filter("want is not null").distinct()
    hits = wanted.join(F.broadcast(ranges), F.col("want").between(F.col("first"), F.col("last")))  # one small row per shard
    hits = hits.groupBy("part", "seq").agg(F.sort_array(F.collect_list("want")).alias("wanted"))
    placed = shards.join(hits, ["part", "seq"]).join(F.broadcast(parts), "part")
    return placed.mapInArrow(cut, "doc_id long, start long, ids array<int>")


def with_ids_crc32(rows: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): CRC-32 of each row's ids as little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            counts = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            raw, ends = lists.flatten().to_numpy().astype("<u4").tobytes(), (4 * bounds(counts)).tolist()
            sums = [zlib.crc32(raw[a:b]) for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), pa.array(counts, pa.int64()), pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the ids of every document to files in the shared folder, and read them back."""
    path = staged_path(spark, "token_files")
    write_token_files(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    return with_ids_crc32(read_token_files(spark, path))
