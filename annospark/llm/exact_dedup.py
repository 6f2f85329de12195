"""Exact de-duplication by a tree merge of sorted digest runs."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annospark.llm.common import ROW, byte_texts, partitions_for, row_keyed, shuffle_partitions, staged

#: Bits of the digest that one merge round resolves at most: 2^4 partitions exchange runs in a round.
ROUND_BITS = 4
_NO_ID = -(1 << 63)
_RUN = "digest binary, n_bytes long, rank long, row_no long, n long, at int"


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefer: str = "largest") -> DataFrame:
    """One row per document row: id, SHA-256 and byte length of the text with A-Z lower-cased, its rank and a row number.

    Null text counts as empty. The smallest rank stays: that of the largest id (``prefer="largest"``) or of the
    smallest; a null id ranks last.
    """
    id_ = F.col(id_col).cast("long")
    order = F.bitwise_not(F.coalesce(id_, F.lit(_NO_ID))) if prefer == "largest" else F.coalesce(id_, F.lit((1 << 63) - 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.lower() for t in byte_texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
                    pa.array([len(t) for t in texts], pa.int64()),
                    batch.column("rank"),
                    batch.column("row_no"),
                ],
                ["doc_id", "digest", "n_bytes", "rank", "row_no"],
            )

    rows = docs.select(id_.alias("doc_id"), F.col(text_col).alias("text"), order.alias("rank"), F.monotonically_increasing_id().alias("row_no"))
    return rows.mapInArrow(run, "doc_id long, digest binary, n_bytes long, rank long, row_no long")


def _merge_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fold sorted rows: the first row of each (digest, n_bytes) stays, with the group's count."""
    held: pa.RecordBatch | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        batch = pa.RecordBatch.from_arrays(batch.columns, batch.schema.names)
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        key = np.frombuffer(b"".join(batch.column("digest").to_pylist()), dtype="<u8").reshape(-1, 4)
        size = batch.column("n_bytes").to_numpy()
        new = np.ones(len(size), bool)
        new[1:] = (key[1:] != key[:-1]).any(axis=1) | (size[1:] != size[:-1])
        first = np.flatnonzero(new)
        count = np.add.reduceat(batch.column("n").to_numpy(), first)
        out = batch.take(pa.array(first))
        out = out.set_column(out.schema.get_field_index("n"), "n", pa.array(count, pa.int64()))
        held = out.slice(out.num_rows - 1)  # its group may go on in the next batch
        if out.num_rows > 1:
            yield out.slice(0, out.num_rows - 1)
    if held is not None:
        yield held


def merge_tree(rows: DataFrame, partitions: int | None = None, round_bits: int = ROUND_BITS) -> DataFrame:
    """Groups of equal digests: (digest, n_bytes, rank, row_no, n).

    Each partition sorts its rows into a run and folds it. In every round up to 2^``round_bits`` partitions whose numbers
    differ in the same bits exchange parts of their runs (there are two rounds at least), so that afterwards those bits of a row's partition number
    equal those of its digest; each merges the runs it got (Spark's external sort) and folds again. The bits of all rounds
    together name one partition for each digest. A group has one row per partition from the first fold on, whatever its
    size, and no partition ever holds more than its share of the distinct digests.
    """
    bits = max(1, ((partitions or shuffle_partitions(rows.sparkSession)) - 1).bit_length())
    mine = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long").bitwiseAND((1 << bits) - 1).cast("int")
    round_bits = max(1, min(round_bits, -(-bits // 2)))
    runs = rows.select("digest", "n_bytes", "rank", "row_no", F.lit(1).cast("long").alias("n"), F.spark_partition_id().alias("at"))
    order = ("digest", "n_bytes", "rank", "row_no")
    runs = runs.sortWithinPartitions(*order).mapInArrow(_merge_runs, _RUN)
    for low in range(0, bits, round_bits):
        mask = ((1 << min(round_bits, bits - low)) - 1) << low
        runs = runs.withColumn("at", F.col("at").bitwiseAND((1 << bits) - 1 - mask).bitwiseOR(mine.bitwiseAND(mask)))
        runs = runs.repartitionById(1 << bits, "at").sortWithinPartitions(*order).mapInArrow(_merge_runs, _RUN)
    return runs.drop("at")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefer: str = "largest") -> DataFrame:
    """A verdict for each row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, row_no.

    Texts are equal when identical after lower-casing A-Z; SHA-256 and length must both agree. Null text counts as
    empty, so null and empty texts form one group. Of equal texts the row of the preferred id stays; among rows that
    repeat that id, the first read. ``group_size`` counts rows. A null id is kept only if its group has no other.
    An empty input gives no rows. Other columns of ``docs`` are never read.
    """
    rows = staged(digests(docs, id_col, text_col, prefer), "digests")
    groups = merge_tree(rows, partitions_for(rows)).filter("n > 1").select("digest", "n_bytes", F.col("row_no").alias("keep_row"), F.col("rank").alias("keep_rank"), "n")
    keep = F.bitwise_not("keep_rank") if prefer == "largest" else F.col("keep_rank")
    lost = _NO_ID if prefer == "largest" else (1 << 63) - 1
    return rows.join(groups, ["digest", "n_bytes"], "left").select(
        "doc_id",
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.nullif(keep, F.lit(lost))).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("row_no") == F.col("keep_row"), F.lit(True)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "row_no",
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefer: str = "largest") -> DataFrame:
    """One row of each group of equal texts, all columns kept: that of the preferred id. Of rows that repeat that id the last read
    stays (with ``prefer="smallest"`` the first), and a null id stays only if its group has no other."""
    keyed, _ = row_keyed(docs, id_col, nulls_last=prefer != "largest")
    gone = exact_dedup(keyed, ROW, text_col, prefer).filter("not kept").select(F.col("doc_id").alias(ROW))
    return keyed.join(gone, ROW, "left_anti").select(docs.columns)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("row_no")


OP4_SQL = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), h AS (SELECT doc_id, sha256(t) AS text_sha256 FROM d)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM h WINDOW w AS (PARTITION BY text_sha256)
"""
