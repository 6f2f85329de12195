"""BPE encoding through distinct-word tables and decoding through an id-to-piece table."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annospark.llm.common import bounds, gather, list_array, packed, partitions_for, shuffle_partitions, stored, text_slices, unpacked
from annospark.llm.word_table import WordTable, byte_of, tokenizer, vocabulary

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


#: Bytes of text that share one list of distinct words.
BLOCK_BYTES = 12 << 20
#: Words that are put back, and ids that are decoded, at a time.
PLACES = DECODE_IDS = 1 << 18


def _blocks(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple[bytes, pa.RecordBatch, dict[str, int], list[np.ndarray]]]:
    """Per block of rows: its key, the rows, its distinct words numbered as they come, and each text's words as such numbers.

    The key is a digest of ids and texts: a second reading of the same rows finds the same key, and equal blocks have equal words.
    """
    split = vocabulary(path).split
    for batch in batches:
        for rows in text_slices(batch, limit=BLOCK_BYTES):
            words: defaultdict[str, int] = defaultdict()
            words.default_factory = words.__len__
            key, places = hashlib.blake2b(digest_size=16), []
            for doc_id, text in zip(rows.column("doc_id").to_pylist(), rows.column("text").to_pylist()):
                key.update(f"{doc_id} {-1 if text is None else len(text)} ".encode() + (text or "").encode())
                found = split(text or "")
                places.append(np.fromiter(map(words.__getitem__, found), np.int32, len(found)))
            yield key.digest(), rows, words, places


def _buckets(words: dict[str, int], buckets: int) -> np.ndarray:
    return np.fromiter((zlib.crc32(w.encode()) for w in words), np.int64, len(words)) % buckets


def encode(docs: DataFrame, path: str = BYTE_BPE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) for each row of ``docs``, as the tokenizers library encodes its whole text.

    Texts are split into words, and each block of rows keeps its distinct words and where they stand. The words of all blocks meet by
    hash, where each distinct word is encoded once; a join on the block puts ids back by position. What moves is a block's distinct words
    and one number per word, not the words of every place.

    ``docs`` is read twice; where its plan has a shuffle, which may bring rows in another order, it is first written to the shared folder.
    Null and empty texts have no ids; repeated rows are encoded each; a null id stays null. Strings of special tokens
    inside a text become their ids, as in the library.
    """
    rows = stored(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), "texts")
    buckets = partitions_for(rows)

    def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, _, words, _ in _blocks(batches, path):
            flat, bucket = list(words), _buckets(words, buckets)
            found, counts = np.unique(bucket, return_counts=True)
            in_order = [flat[i] for i in np.argsort(bucket, kind="stable").tolist()]
            columns = [pa.array([key] * len(found), pa.binary()), pa.array(found, pa.int32()), list_array(in_order, counts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["block", "bucket", "words"])

    def places_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, rows, words, places in _blocks(batches, path):
            counts = np.fromiter(map(len, places), np.int64, len(places))
            ids = list_array(rows.column("doc_id"), np.array([rows.num_rows]), pa.int64())
            numbers = (packed(counts), packed(_buckets(words, buckets)), packed(np.concatenate(places)))
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), ids, *(pa.array([n], pa.binary()) for n in numbers)], ["block", "doc_ids", "counts", "buckets", "places"])

    def table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distinct = WordTable(vocabulary(path))
        for batch in batches:
            encoded = [distinct.encode_words(words.as_py()) for words in batch.column("words")]
            columns = [pa.array([packed(numbers[k]) for numbers in encoded], pa.binary()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("bucket"), *columns], ["block", "bucket", "ids", "lengths"])

    def put_back(places: pa.Table, words: pa.Table) -> pa.Table:
        found, first = np.unique(words.column("bucket").to_numpy(), return_index=True)  # equal blocks bring equal rows
        words = words.take(first)
        ids, lengths = (np.concatenate([np.empty(0, np.int64), *map(unpacked, words.column(c).to_pylist())]) for c in ("ids", "lengths"))
        starts, parts = bounds(lengths), []
        for block in places.to_batches(max_chunksize=1):
            counts, bucket, at = (unpacked(block.column(c)[0].as_py()) for c in ("counts", "buckets", "places"))
            if len(bucket) != len(lengths) or not np.array_equal(np.unique(bucket), found):
                raise ValueError("documents were read twice and differed")
            number = np.empty(len(bucket), np.int32)
            number[np.argsort(bucket, kind="stable")] = np.arange(len(bucket))  # a word's place among those of all buckets
            names, edges = block.column("doc_ids").flatten(), bounds(counts)
            cuts = [0, *(np.flatnonzero(np.diff(edges[1:] // PLACES)) + 1).tolist(), len(counts)]
            for a, b in zip(cuts, cuts[1:]):  # runs of texts
                own = number[at[edges[a] : edges[b]]]
                per_text = np.diff(bounds(lengths[own])[edges[a : b + 1] - edges[a]])
                parts.append(pa.table([names.slice(a, b - a), list_array(gather(ids, starts[own], lengths[own]).astype(np.int32), per_text, pa.int32())], ["doc_id", "ids"]))
        return pa.concat_tables(parts) if parts else pa.table([pa.array([], pa.int64()), pa.array([], pa.list_(pa.int32()))], ["doc_id", "ids"])

    places = rows.mapInArrow(places_of, "block binary, doc_ids array<long>, counts binary, buckets binary, places binary")
    words = rows.mapInArrow(words_of, "block binary, bucket int, words array<string>").repartitionById(buckets, "bucket")
    encoded = words.mapInArrow(table, "block binary, bucket int, ids binary, lengths binary")
    if buckets > shuffle_partitions(rows.sparkSession):  # else adaptive execution joins small partitions
        places, encoded = (side.repartition(buckets, "block") for side in (places, encoded))
    return places.groupBy("block").cogroup(encoded.groupBy("block")).applyInArrow(put_back, "doc_id long, ids array<int>")


def piece_table(spark: SparkSession, path: str) -> DataFrame:
    """(id, piece binary): the bytes of each id of a vocabulary file."""
    found, known = tokenizer(path), byte_of()
    pieces = [(i, found.id_to_token(i) or "") for i in range(found.get_vocab_size())]
    raw = [(i, bytes(known[c] for c in p) if all(c in known for c in p) else p.encode()) for i, p in pieces]
    return spark.createDataFrame(raw, "id int, piece binary")


def _id_slices(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of rows with their flat ids and counts; null arrays have none."""
    ids = batch.column("ids")
    counts = ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(counts) // DECODE_IDS
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows] if batch.num_rows else []
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a), ids.slice(a, b - a).flatten().fill_null(-1).to_numpy(zero_copy_only=False), counts[a:b]


def _with_pieces(encoded_docs: DataFrame, path: str, schema: str, made: Callable[[pa.Array, np.ndarray, np.ndarray, list[str]], list[pa.Array]]) -> DataFrame:
    """Rows that ``made`` builds of doc ids, flat ids, counts and texts, by a join of ids with the vocabulary's pieces.

    Each slice of rows sends one row per distinct id through a broadcast join with the pieces (a vocabulary: tens of thousands of
    rows, whatever the input), and one row, without id, with the slice itself behind them. A broadcast join streams, so a slice's rows
    arrive together and in order, and what the join found is put in place by position. Each row says its slice and its place there: were
    the join to run in another way, which mixes rows, this fails.
    """
    spark = encoded_docs.sparkSession

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        for batch in batches:
            for rows, ids, counts in _id_slices(batch):
                part += 1
                found, at = np.unique(ids, return_inverse=True)
                k = len(found)
                doc_ids = rows.column("doc_id")
                body = pa.StructArray.from_arrays(
                    [list_array(doc_ids, np.array([len(doc_ids)]), pa.int64()), pa.array([packed(counts)], pa.binary()), pa.array([packed(at.ravel())], pa.binary())],
                    ["doc_ids", "counts", "places"],
                )
                columns = [
                    pa.array(np.full(k + 1, part, np.int64)),
                    pa.array(np.arange(k + 1, dtype=np.int32)),
                    pa.concat_arrays([pa.array(found.astype(np.int32)), pa.nulls(1, pa.int32())]),
                    pa.concat_arrays([pa.nulls(k, body.type), body]),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["slice", "place", "id", "body"])

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, pieces, part, place = [np.empty(0, np.int64)], [], None, 0
        for batch in batches:
            slices, places = (batch.column(c).to_numpy() for c in ("slice", "place"))
            bodies = np.flatnonzero(batch.column("body").is_valid().to_numpy(zero_copy_only=False)).tolist()
            last = 0
            for k in [*bodies, batch.num_rows]:
                ids.append(batch.column("id").slice(last, k - last).to_numpy(zero_copy_only=False).astype(np.int64))
                pieces += batch.column("piece").slice(last, k - last).to_pylist()
                run = slice(last, k + 1)  # the last run of a batch has no body yet
                if len(slices[run]):
                    part = slices[last] if part is None else part
                    if (slices[run] != part).any() or not np.array_equal(places[run], np.arange(place, place + len(places[run]))):
                        raise ValueError("the rows of a slice came apart")
                    place += len(places[run])
                if k == batch.num_rows:
                    break
                body = batch.column("body")[k]
                counts, at = unpacked(body["counts"].as_py()), unpacked(body["places"].as_py())
                ids = np.concatenate(ids)
                if len(ids) != (at.max() + 1 if len(at) else 0) or None in pieces:
                    raise ValueError("an id outside the vocabulary")
                raw = [pieces[i] for i in at.tolist()]
                edge = bounds(counts).tolist()
                texts = [b"".join(raw[a:b]).decode("utf-8", "replace") for a, b in zip(edge, edge[1:])]
                yield pa.RecordBatch.from_arrays(made(body["doc_ids"].values, ids[at], counts, texts), columns)
                ids, pieces, part, place, last = [np.empty(0, np.int64)], [], None, 0, k + 1

    columns = [field.split()[0] for field in schema.split(", ")]
    kind = "slice long, place int, id int, body struct<doc_ids:array<bigint>,counts:binary,places:binary>"
    rows = encoded_docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(distinct, kind)
    joined = rows.join(F.broadcast(piece_table(spark, path)), "id", "left")
    return joined.select("slice", "place", "id", "piece", "body").mapInArrow(put, schema)


def decode(encoded_docs: DataFrame, path: str = BYTE_BPE) -> DataFrame:
    """(doc_id, ids, text): the text of each row's ids, special tokens included. Null or empty ids give an empty text, and no
    ids; bytes that are no UTF-8 become U+FFFD. An id outside the vocabulary fails, as a null inside an array does."""

    def made(doc_ids: pa.Array, ids: np.ndarray, counts: np.ndarray, texts: list[str]) -> list[pa.Array]:
        return [doc_ids, list_array(ids.astype(np.int32), counts, pa.int32()), pa.array(texts, pa.string())]

    return _with_pieces(encoded_docs, path, "doc_id long, ids array<int>, text string", made)


def round_trip_digests(encoded_docs: DataFrame, path: str = BYTE_BPE) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): SHA-256 of each row's ids as little-endian unsigned 32-bit integers,
    and of the text that ``decode`` gives for them. One pass, so that decoded texts don't leave the task."""

    def made(doc_ids: pa.Array, ids: np.ndarray, counts: np.ndarray, texts: list[str]) -> list[pa.Array]:
        raw, ends = ids.astype("<u4").tobytes(), (4 * bounds(counts)).tolist()
        of_ids = [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(ends, ends[1:])]
        of_text = [hashlib.sha256(t.encode()).hexdigest() for t in texts]
        return [doc_ids, pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())]

    return _with_pieces(encoded_docs, path, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", made)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every document; digests of both."""
    return round_trip_digests(encode(spark.read.parquet(f"{sf_dir}/documents.parquet")))
