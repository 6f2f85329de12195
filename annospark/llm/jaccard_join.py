"""Near-duplicate join on word shingles: a size-aware heavy-light set join with exact verification.

Two sets of sizes n and m link when 100 * overlap >= 80 * union, that is, when they share c(n, m) elements or more.
Light sets (up to a boundary) list all their subsets of c(n, m) elements: equal subsets are links. Heavy sets are found
by scanning inverted lists of their rarest shingles. The boundary is the one whose estimated cost is least.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annospark.llm.common import ROW, byte_texts, id_bits, likely_rows, may_hold, only_ids, row_keyed, staged, text_slices, unstage

WORDS = 5
PERCENT = 80
#: Counters of the sketch that orders shingles by how common they are; its size is fixed.
SKETCH = 1 << 20
_CHUNK = 1 << 12
#: Least and most bits of a set's parity signature.
MIN_BITS, MAX_BITS = 1 << 10, 1 << 17
#: Largest boundary considered between light and heavy sets.
MAX_LIGHT = 24
SCAN_COST = 8
#: Rows of one inverted list that are compared as a block, and members of one star that are verified in one group.
BLOCK = 1024
STAR = 256
#: Pairs of rows, and bytes of their signatures, that are compared at a time.
_PAIRS = 1 << 20
_SIGNATURE_BYTES = 16 << 20
#: Rows of a very common key that one task gets, about.
HOT = 1 << 12
_MAX_SALT = (1 << 15) - 2
#: Rounds in which the lists' heads are verified, at most.
ROUNDS = 3
#: Bytes of text whose words are hashed at a time.
_PIECE = 1 << 21
_BLANK = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))
_CUT = re.compile(rb"[ \t-\r]")
#: A number for each byte, and the factor of word hashes.
_NUMBER = np.random.default_rng(7).integers(0, 1 << 64, 256, np.uint64)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_ROLL = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def needed(n: np.ndarray | int, m: np.ndarray | int, percent: int = PERCENT):
    """The least overlap of linked sets of these sizes: the ceiling of percent * (n + m) / (100 + percent)."""
    return -(-percent * (n + m) // (100 + percent))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First byte and 64-bit hash of each word: the sum of its bytes' numbers times powers of a fixed factor, mixed."""
    low = np.frombuffer(raw.lower(), np.uint8)
    at = np.flatnonzero(~_BLANK[low])
    if not len(at):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    first = np.flatnonzero(np.append(True, np.diff(at) > 1))
    size = np.diff(np.append(first, len(at)))
    power = np.cumprod(np.append(np.uint64(1), np.full(size.max() - 1, _FACTOR, np.uint64)), dtype=np.uint64)
    place = np.arange(len(at)) - np.repeat(first, size)
    return at[first], _mix(np.add.reduceat(_NUMBER[low[at]] * power[place], first) + size.astype(np.uint64))


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Each text's sorted distinct 64-bit hashes of its runs of five words (A-Z lower-cased); with fewer words, of the
    whole sequence; without words, none."""
    raw, edges = b" ".join(texts), np.cumsum([0, *(len(t) + 1 for t in texts)])
    starts, words, a = [], [], 0
    while a < len(raw):  # a piece ends at a blank
        cut = _CUT.search(raw, a + _PIECE)
        b = cut.end() if cut else len(raw)
        at, h = _word_hashes(raw[a:b])
        starts.append(at + a)
        words.append(h)
        a = b
    if not words:
        return [np.empty(0, np.uint64) for _ in texts]
    h = np.concatenate(words)
    bounds = np.searchsorted(np.concatenate(starts), edges)
    n = max(0, len(h) - WORDS + 1)
    runs = _mix(sum((h[k : k + n] * _ROLL[k] for k in range(WORDS)), np.zeros(n, np.uint64)))
    found = []
    for x, y in zip(bounds.tolist(), bounds[1:].tolist()):
        if y - x >= WORDS:
            found.append(np.unique(runs[x : y - WORDS + 1]))
        elif y > x:
            found.append(_mix((h[x:y] * _ROLL[: y - x]).sum(keepdims=True, dtype=np.uint64) + np.uint64(y - x)))
        else:
            found.append(h[:0])
    return found


def summaries(docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, n, hi, lo, sig) of each row: set size, a 128-bit digest of the set, its signature; and the sketch of shingle counts.

    One pass writes both: tasks add their shingles up in a sketch of fixed size and emit it in chunks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(SKETCH, np.int64)
        names = ["doc_id", "n", "hi", "lo", "sig", "chunk", "counts"]
        for batch in batches:
            for part in text_slices(batch):
                sets = shingle_sets(byte_texts(part))
                sketch += np.bincount((np.concatenate(sets) & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH)
                hi, lo = _digests(sets).T
                size = pa.array([len(s) for s in sets], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), size, pa.array(hi), pa.array(lo), pa.array(map(signature, sets), pa.binary()), pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.binary())], names)
        if sketch.any():
            counts = np.minimum(sketch, (1 << 32) - 1).astype("<u4").reshape(-1, _CHUNK)
            k, long = len(counts), pa.nulls(len(counts), pa.int64())
            yield pa.RecordBatch.from_arrays([long, long, long, long, pa.nulls(k, pa.binary()), pa.array(range(k), pa.int32()), pa.array([c.tobytes() for c in counts], pa.binary())], names)

    both = staged(docs.mapInArrow(run, "doc_id long, n long, hi long, lo long, sig binary, chunk int, counts binary"), "sets")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist()):
                sums[chunk] = sums.get(chunk, 0) + np.frombuffer(counts, "<u4").astype(np.int64)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], ["chunk", "counts"])

    chunks = both.filter("chunk is not null").select("chunk", "counts")
    total = np.zeros(SKETCH // _CHUNK * _CHUNK, np.int64).reshape(-1, _CHUNK)
    for row in chunks.repartition(16, "chunk").mapInArrow(add, "chunk int, counts binary").collect():  # 8 MB, whatever the input
        total[row.chunk] = np.frombuffer(row.counts, np.int64)
    return both.filter("chunk is null").select("doc_id", "n", "hi", "lo", "sig"), np.minimum(total.ravel(), (1 << 31) - 1).astype(np.int32)


def _digests(sets: list[np.ndarray]) -> np.ndarray:
    """A 128-bit digest of each set, as two halves."""
    return np.frombuffer(b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets), "<i8").reshape(-1, 2)


def _prefix(n: int, percent: int) -> int:
    """How many of its rarest shingles a heavy set lists: any linked set of at most its size shares one of them."""
    return n - -(-percent * n // 100) + 1


def _index_prefix(n: int, percent: int) -> int:
    """How many of them a linked set of at least its size shares one of: equal sizes need the larger overlap."""
    return n - int(needed(n, n, percent)) + 1


def _partners(n: int, percent: int) -> range:
    return range(-(-percent * n // 100), n * 100 // percent + 1)


def boundary(sizes: dict[int, int], percent: int = PERCENT, max_light: int = MAX_LIGHT, scan_cost: int = SCAN_COST) -> int:
    """The largest light size: the one with the least estimated cost. A light set costs a row per subset; a heavy set costs
    ``scan_cost`` rows per listed shingle, for the members of the list that are read and verified. ``sizes`` has the number of sets
    of each size up to 1.25 * ``max_light``."""
    best, least = 0, None
    for x in range(max_light + 1):
        light = sum(k * sum(comb(n, needed(n, m, percent)) for m in _partners(n, percent) if m <= x and needed(n, m, percent) <= n) for n, k in sizes.items() if 0 < n <= x)
        heavy = sum(k * _prefix(n, percent) for n, k in sizes.items() if n > 0 and 100 * n >= percent * (x + 1))
        cost = light + scan_cost * heavy
        if least is None or cost < least:
            best, least = x, cost
    return best


def signature(s: np.ndarray) -> bytes:
    """The parity of how many elements fall on each bit; bits in proportion to the set's size, a power of two. Two sets differ
    in at least as many elements as their signatures in bits; the one of half as many bits is the two halves' exclusive or."""
    bits = max(MIN_BITS, min(MAX_BITS, 1 << (2 * len(s) - 1).bit_length()))
    return np.packbits((np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def list_rows(docs: DataFrame, sketch: np.ndarray, light: int, percent: int = PERCENT, skip: Broadcast | None = None) -> DataFrame:
    """(key, doc_id, n, kind, rank, salt, index): the subsets of light sets (kind 1) and the listed shingles of heavy ones (kind 0).

    ``index`` marks subsets and the rarest of the listed shingles, by which a set meets those of its size or larger: of two linked heavy
    sets the smaller one lists a shingle with ``index`` that the larger one lists too. So two rows of a list without it are no candidates.

    ``rank`` is lower the more of a set's shingles are common: a text that others were copied from has a lower one than
    those copies, whatever its id. Keys that the sketch takes for very common are dealt out by ``salt`` (1 and up, else 0). Rows
    whose id may be one of ``skip`` (of ``id_bits``) are left out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(sketch)  # 4 MB

    def subsets(s: np.ndarray, over: np.ndarray) -> Iterator[tuple[int, int]]:
        """Each subset's key, and the least of its elements' counts."""
        n = len(s)
        for m in _partners(n, percent):
            c = int(needed(n, m, percent))
            if m <= light and c <= n:
                for k in combinations(range(n), c):
                    at = list(k)
                    yield xxhash.xxh3_64_intdigest(s[at].tobytes() + bytes([min(n, m), max(n, m)])), int(over[at].min())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean = shared.value.mean()
        noise = mean + 6 * np.sqrt(mean)
        for batch in batches:
            batch = batch if skip is None else batch.filter(pa.array(~may_hold(skip.value, batch.column("h").to_numpy())))
            for part in text_slices(batch):
                sets = shingle_sets(byte_texts(part))
                ids = part.column("doc_id").to_numpy()
                keys, owner, kind, counts, index = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int8)], [np.empty(0, np.int64)], [np.empty(0, np.int8)]
                rank = np.zeros(len(sets), np.int16)
                for i, s in enumerate(sets):
                    n = len(s)
                    if not n:
                        continue
                    common = shared.value[(s & np.uint64(SKETCH - 1)).astype(np.int64)]
                    rank[i] = -round(1024 * np.log2(1 + np.maximum(common - mean, 0)).mean())
                    if n <= light and (found := list(subsets(s, common))):
                        keys.append(np.array([k for k, _ in found], np.uint64))
                        counts.append(np.array([c for _, c in found], np.int64))
                        kind.append(np.ones(len(found), np.int8))
                        index.append(kind[-1])
                        owner.append(np.full(len(found), i))
                    if 100 * n >= percent * (light + 1):
                        k = _prefix(n, percent)
                        order = np.lexsort((s, common))[:k] if k < n else np.arange(n)
                        keys.append(s[order])
                        counts.append(common[order])
                        kind.append(np.zeros(len(order), np.int8))
                        index.append((np.arange(len(order)) < _index_prefix(n, percent)).astype(np.int8))
                        owner.append(np.full(len(order), i))
                owner = np.concatenate(owner)
                size = np.array([len(s) for s in sets], np.int64)
                salts = np.clip(np.ceil((np.concatenate(counts) - noise) / HOT), 1, _MAX_SALT).astype(np.int64)
                salt = np.where(salts > 1, 1 + _mix(ids[owner].view(np.uint64)).astype(np.uint64) % salts.astype(np.uint64), 0).astype(np.int16)
                columns = [np.concatenate(keys).view(np.int64), ids[owner], size[owner].astype(np.int32), np.concatenate(kind), rank[owner], salt, np.concatenate(index)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "doc_id", "n", "kind", "rank", "salt", "index"])

    rows = docs.select("doc_id", "text", F.xxhash64("doc_id").alias("h"))
    return rows.mapInArrow(run, "key long, doc_id long, n int, kind byte, rank short, salt short, index byte")


def shared_lists(rows: DataFrame) -> DataFrame:
    """(key, kind, doc_id, n, rank, index, head, head_n, many): the rows of each list but its head, the row of the lowest rank;
    ``many`` where a list has two such rows or more.

    Rows are dealt by key and salt and sorted in each partition; a task holds two rows of a list at a time, whatever its
    length. The parts of a salted list each have a head of their own; the best of these becomes the list's.
    """
    names = ["key", "kind", "salt", "doc_id", "n", "rank", "index"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the head of the list at hand and the last row read, which may be the same; the row's place

        def made(rows: list[np.ndarray], place_before: int, end: bool) -> tuple[pa.RecordBatch | None, tuple]:
            """The batch of all rows but the last (unless this is the end). With a place above 0, the first row is a head that
            was seen before, and the second one the row that was held back, at that place of its list."""
            key, kind, salt, doc, n, rank, index = rows
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (kind[1:] != kind[:-1]) | (salt[1:] != salt[:-1])
            head = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
            place = np.arange(len(new)) - head
            many = (place > 1) | np.append((place[1:] > 1), False) | (salt > 0)
            keep = (place > 0) | (salt > 0)
            if place_before:
                keep[0] = False
                many[1] |= place_before > 1
            last = tuple((x[head[-1]], x[-1]) for x in rows), int(place[-1]) + (place_before - 1 if place_before and head[-1] == 0 else 0)
            if not end:
                keep[-1] = False
            columns = (key, kind, salt, doc, n, rank, index, doc[head], n[head], rank[head], many)
            batch = pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in columns], [*names, "head", "head_n", "head_rank", "many"]) if keep.any() else None
            return batch, last

        for batch in batches:
            if not batch.num_rows:
                continue
            rows, place = [batch.column(c).to_numpy() for c in names], 0
            if held is not None:
                ends, place = held
                rows = [np.concatenate([x if place else x[1:], v]).astype(v.dtype) for x, v in zip(ends, rows)]
            found, held = made(rows, place, False)
            if found is not None:
                yield found
        if held is not None:
            ends, place = held
            found, _ = made([np.array(x if place else x[1:]) for x in ends], place, True)
            if found is not None:
                yield found

    dealt = rows.repartition("key", "salt").sortWithinPartitions("key", "kind", "salt", "rank", "doc_id")
    schema = "key long, kind byte, salt short, doc_id long, n int, rank short, index byte, head long, head_n int, head_rank short, many boolean"
    found = staged(dealt.mapInArrow(run, schema), "lists")
    columns = ["key", "kind", "doc_id", "n", "rank", "index", "head", "head_n", "many"]
    salted = found.filter("salt > 0")
    if not salted.limit(1).count():
        return found.select(columns)
    best = salted.groupBy("key", "kind").agg(F.min(F.struct(F.col("head_rank").alias("r"), F.col("head").alias("d"), F.col("head_n").alias("n"))).alias("best"))
    salted = salted.drop("head", "head_n").join(best, ["key", "kind"]).withColumns({"head": F.col("best.d"), "head_n": F.col("best.n")}).filter("head <> doc_id")
    return found.filter("salt = 0").select(columns).unionAll(salted.select(columns))


def verified(pairs: DataFrame, docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose sets link, from their whole texts. Sets are compared by 64-bit hashes of their shingles.

    Pairs of one ``a`` form a star. A star is cut into groups of about ``STAR`` members, each with its own copy of the
    centre's text; in a sorted group the centre comes first, so a task holds one set besides the row at hand.
    """
    stars = pairs.groupBy("a").agg(F.ceil(F.count("*") / STAR).cast("int").alias("groups"))
    members = pairs.join(stars, "a").select("a", F.pmod(F.xxhash64("b"), F.col("groups")).cast("int").alias("g"), F.col("b").alias("doc_id"), F.lit(1).alias("place"))
    centres = stars.select("a", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("g"), F.col("a").alias("doc_id"), F.lit(0).alias("place"))
    rows = members.unionAll(centres).join(docs, "doc_id").select("a", "g", "place", "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, own = None, None
        for batch in batches:
            for part in text_slices(batch):
                a, g, place, doc = (part.column(c).to_numpy() for c in ("a", "g", "place", "doc_id"))
                good = []
                for i, s in enumerate(shingle_sets(byte_texts(part))):
                    if place[i] == 0:
                        centre, own = s, (a[i], g[i])
                    elif own == (a[i], g[i]) and len(s) and len(centre):
                        at = np.searchsorted(centre, s)
                        overlap = int((centre[np.minimum(at, len(centre) - 1)] == s).sum())
                        if 100 * overlap >= percent * (len(s) + len(centre) - overlap):
                            good.append(i)
                yield pa.RecordBatch.from_arrays([pa.array(a[good]), pa.array(doc[good])], ["a", "b"])

    return rows.repartition("a", "g").sortWithinPartitions("a", "g", "place", "doc_id").mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(v, comp): for each end of a link (a, b), the smallest id that links reach.

    Rounds take the smallest label among neighbours, then the label of that label. Each round is a staged table.
    """
    edges = staged(links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = staged(edges.groupBy(F.col("a").alias("v")).agg(F.least(F.col("v"), F.min("b")).alias("comp")), "labels")
    while True:
        near = edges.join(labels.select(F.col("v").alias("b"), "comp"), "b").groupBy(F.col("a").alias("v")).agg(F.min("comp").alias("near"))
        step = labels.join(near, "v").select("v", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        jump = step.select(F.col("v").alias("comp"), F.col("comp").alias("next"))
        found = step.join(jump, "comp").select("v", "old", F.least("comp", "next").alias("comp"))
        found = staged(found, "labels")
        changed = found.filter("old <> comp").limit(1).count()
        unstage(labels)
        labels = found.select("v", "comp")
        if not changed:
            unstage(edges)
            return labels


def _may_link(left: np.ndarray, right: np.ndarray, n: np.ndarray, sig: list[bytes], percent: int) -> np.ndarray:
    """Whether the sets of each pair of rows can link by their sizes and signatures. Two sets whose signatures differ in more
    bits than linked sets may differ in elements can't link, so no pair of linked sets is lost."""
    fits = 100 * np.minimum(n[left], n[right]) >= percent * np.maximum(n[left], n[right])
    size = np.fromiter(map(len, sig), np.int64, len(sig))
    level = np.where(fits, np.minimum(size[left], size[right]), 0)
    for z in np.unique(level[level > 0]).tolist():
        of_level = np.flatnonzero(level == z)
        for at in np.split(of_level, range(_SIGNATURE_BYTES // z, len(of_level), _SIGNATURE_BYTES // z)):
            rows, place = np.unique(np.concatenate([left[at], right[at]]), return_inverse=True)
            bits = np.stack([_folded(sig[k], z) for k in rows.tolist()])
            differ = np.bitwise_count(bits[place[: len(at)]] ^ bits[place[len(at) :]]).sum(axis=1, dtype=np.int64)
            both = n[left[at]] + n[right[at]]
            fits[at] = differ <= both - 2 * needed(both, 0, percent)
    return fits


def _folded(sig: bytes, size: int) -> np.ndarray:
    bits = np.frombuffer(sig, np.uint64)
    while bits.nbytes > size:
        bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]
    return bits


def likely_pairs(pairs: DataFrame, sigs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Of the pairs (a, b, and their sets' sizes n, m) those (a, b) that can link by size and signature."""
    for end in ("a", "b"):
        pairs = pairs.join(sigs.withColumnsRenamed({"doc_id": end, "sig": f"sig_{end}"}), end)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = np.arange(batch.num_rows)
            n, m = (batch.column(c).to_numpy().astype(np.int64) for c in "nm")
            good = _may_link(k, k + len(k), np.concatenate([n, m]), batch.column("sig_a").to_pylist() + batch.column("sig_b").to_pylist(), percent)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(good)) for c in "ab"], ["a", "b"])

    return pairs.mapInArrow(run, "a long, b long")


def next_heads(rows: DataFrame, sigs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) of each open list's next head with its members of other components that it may link with. The head
    is the member of the lowest rank outside the component that has most members."""
    most = rows.groupBy("key", "kind", "comp").agg(F.count("*").alias("k")).groupBy("key", "kind").agg(F.max_by("comp", F.struct("k", "comp")).alias("most"))
    heads = rows.join(most, ["key", "kind"]).filter("comp <> most").groupBy("key", "kind").agg(F.min(F.struct("rank", "doc_id", "n", "comp")).alias("h"))
    pairs = rows.join(heads, ["key", "kind"]).filter(F.col("h.comp") != F.col("comp"))
    pairs = pairs.select(F.col("h.doc_id").alias("a"), F.col("doc_id").alias("b"), F.col("h.n").alias("n"), F.col("n").alias("m"))
    return likely_pairs(pairs.filter(100 * F.least("n", "m") >= percent * F.greatest("n", "m")).distinct(), sigs, percent)


def straggler_pairs(rows: DataFrame, sigs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) of documents that share a list, lie in different components, and can still link by size and signature.

    ``rows`` (key, kind, doc_id, n, index, comp) are the lists with members of several components. Rows with ``index`` (sources) are compared
    with all rows (targets) of their size or larger, and with no others; the lists' sources and targets are dealt out as pairs
    of blocks. So a list of many members costs its sources times its length.
    """
    sized = rows.groupBy("key", "kind").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"), F.ceil(F.sum(F.col("index").cast("int")) / BLOCK).cast("int").alias("source_blocks"))
    rows = rows.join(sized.filter("source_blocks > 0"), ["key", "kind"]).join(sigs.hint("merge"), "doc_id")
    block = lambda count: F.pmod(F.xxhash64("doc_id"), F.col(count)).cast("int")
    each = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    columns = ["key", "kind", "doc_id", "comp", "n", "index", "sig"]
    sources = rows.filter("index = 1").select(*columns, F.lit(1).alias("source"), block("source_blocks").alias("i"), each("blocks").alias("j"))
    targets = rows.select(*columns, F.lit(0).alias("source"), block("blocks").alias("j"), each("source_blocks").alias("i"))
    rows = sources.unionByName(targets)
    groups = ["key", "kind", "i", "j"]

    def compare(table: pa.Table) -> pa.RecordBatch:
        """The pairs of whole groups, each at most about ``BLOCK`` sources and as many targets."""
        at = np.stack([table.column(c).to_numpy().astype(np.int64) for c in groups])
        doc, comp, n, index, source = (table.column(c).to_numpy().astype(np.int64) for c in ("doc_id", "comp", "n", "index", "source"))
        sig = table.column("sig").to_pylist()
        cuts = [0, *(np.flatnonzero((at[:, 1:] != at[:, :-1]).any(axis=0)) + 1).tolist(), len(doc)]
        found, left, right, waiting = [], [], [], 0
        for x, y in zip(cuts, cuts[1:]):
            i, j = x + np.flatnonzero(source[x:y] == 1), x + np.flatnonzero(source[x:y] == 0)
            p, q = n[i][:, None], n[j][None, :]
            # two sources of one size meet twice; subsets (kind 1) tell nothing of sizes
            once = (index[j] == 0)[None, :] | (doc[i][:, None] < doc[j][None, :])
            wanted = (once if at[1, x] else (q > p) | ((q == p) & once)) & (comp[i][:, None] != comp[j][None, :])
            first, second = np.nonzero(wanted)
            left.append(i[first])
            right.append(j[second])
            waiting += len(left[-1])
            if waiting > _PAIRS or y == len(doc):
                first, second = np.concatenate(left), np.concatenate(right)
                good = _may_link(first, second, n, sig, percent)
                found.append(np.unique(np.sort(np.stack([doc[first[good]], doc[second[good]]]), axis=0), axis=1))
                left, right, waiting = [], [], 0
        a, b = np.concatenate(found, axis=1)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None  # the group at hand may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([pa.RecordBatch.from_arrays(batch.columns, batch.schema.names)])
            table = table if held is None else pa.concat_tables([held, table])
            at = np.stack([table.column(c).to_numpy().astype(np.int64) for c in groups])
            cut = table.num_rows - int((at[:, ::-1] == at[:, -1:]).all(axis=0).cumprod().sum())
            if cut:
                yield compare(table.slice(0, cut))
            held = table.slice(cut)
        if held is not None:
            yield compare(held)

    dealt = rows.repartition(*groups).sortWithinPartitions(*groups, "doc_id")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def _open_rows(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Of the lists with members in several components (as ``labels`` has them), one of them with ``index``: key, kind, doc_id, n, rank, index,
    comp. Lists of common shingles that no member has among its rarest go here, however many members they have."""
    rows = rows.select("key", "kind", "doc_id", "n", "rank", "index").join(labels.withColumnRenamed("v", "doc_id").hint("merge"), "doc_id", "left").withColumn("comp", F.coalesce("comp", "doc_id"))
    several = rows.groupBy("key", "kind").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.max("index").alias("i")).filter("x <> y and i = 1").select("key", "kind")
    return rows.join(several.hint("merge"), ["key", "kind"], "left_semi")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of ``docs``: set size and the smallest id reachable by links.

    Null and empty texts have no shingles and stay alone. Rows that repeat an id are compared each, as rows of their own. A
    null id stays null, and a component of such rows alone has a null id. An empty input gives no rows. Other columns are
    never read.
    """
    keyed, numbered = row_keyed(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")))
    found = _components(keyed.select(F.col(ROW).alias("doc_id"), "text"), percent)
    if not numbered:
        return found
    names = keyed.select("doc_id", ROW)
    found = found.withColumnRenamed("doc_id", ROW).join(names, ROW)
    least = names.select(F.col(ROW).alias("component_id"), F.col("doc_id").alias("least"))
    return found.join(least, "component_id").select("doc_id", "n_shingles", F.col("least").alias("component_id"))


def _components(docs: DataFrame, percent: int) -> DataFrame:
    """``near_duplicates`` of (doc_id, text) with distinct ids.

    Equal sets form one class, stood for by its smallest id. Candidates come from the lists that light and heavy sets share.
    First each list's head is compared with its members by signature and verified against the likely ones, which joins a dense
    group by stars instead of all its pairs; in lists whose members are still apart the next head is one outside the component of
    the most members, for ``ROUNDS`` rounds or until a round joins nothing. Then the pairs of a list that are still in different
    components are compared. No candidate is capped, so no link between components is lost.
    """
    sets, sketch = summaries(docs)
    classes = sets.filter("n > 0").groupBy("hi", "lo").agg(F.min("doc_id").alias("rep"), F.count("*").alias("rows"))
    copies = staged(sets.join(classes.filter("rows > 1"), ["hi", "lo"]).filter("rep <> doc_id").select("doc_id", "rep"), "copies")
    small = sets.filter(F.col("n") <= int(1.25 * MAX_LIGHT)).select("n", "hi", "lo").distinct().groupBy("n").count().collect()  # a row per small size
    light = boundary({int(r["n"]): r["count"] for r in small}, percent)

    # rows that are surely no copy are listed where they are read; of the others, copies are taken out by a join
    maybe = id_bits(copies)
    rest = likely_rows(docs, maybe).join(copies.select("doc_id").hint("merge"), "doc_id", "left_anti")
    lists = shared_lists(list_rows(docs, sketch, light, percent, maybe).unionAll(list_rows(rest, sketch, light, percent)))
    fits = 100 * F.least("n", "head_n") >= percent * F.greatest("n", "head_n")
    done = staged(lists.filter(fits).select(F.col("head").alias("a"), F.col("doc_id").alias("b"), F.col("head_n").alias("n"), F.col("n").alias("m")).distinct(), "pairs")
    rows = lists.filter("many").select("key", "kind", "doc_id", "n", "rank", "index")
    listed = done.select(F.explode(F.array("a", "b")).alias("doc_id")).unionAll(rows.select("doc_id")).distinct()
    sigs = staged(sets.select("doc_id", "sig").join(listed.hint("merge"), "doc_id", "left_semi"), "signatures")

    def linked(pairs: DataFrame) -> DataFrame:
        """Those of the staged pairs that link; only their texts are read again."""
        if not pairs.limit(1).count():
            return pairs
        texts = staged(only_ids(docs, pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()), "texts")
        found = staged(verified(pairs, texts, percent), "links")
        unstage(texts)
        return found

    links = linked(staged(likely_pairs(done, sigs, percent), "pairs"))
    done = done.select("a", "b")
    labels = components(links)
    rows = staged(_open_rows(rows, labels), "rows")

    def fresh(pairs: DataFrame) -> DataFrame:
        for ends in (["a", "b"], ["b", "a"]):
            pairs = pairs.join(done.select(F.col("a").alias(ends[0]), F.col("b").alias(ends[1])), ["a", "b"], "left_anti")
        return pairs

    for _ in range(1, ROUNDS):
        pairs = staged(fresh(next_heads(rows, sigs, percent)), "pairs")
        more = linked(pairs)
        done = done.unionAll(pairs)
        if not more.limit(1).count():
            break
        links = links.unionAll(more)
        labels = components(links)
        rows = staged(_open_rows(rows, labels), "rows")
    more = linked(staged(fresh(straggler_pairs(rows, sigs, percent)), "pairs"))
    if more.limit(1).count():
        labels = components(links.unionAll(more))
    members = sets.join(copies, "doc_id", "left").select("doc_id", "n", F.coalesce("rep", "doc_id").alias("v"))
    return members.join(labels, "v", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("comp", "v").alias("component_id"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row of each component of ``docs``, all columns kept: that of the smallest id, of rows that repeat it the first read
    (null ids rank last). Rows without shingles stay."""
    keyed, _ = row_keyed(docs, id_col)
    found = _components(keyed.select(F.col(ROW).alias("doc_id"), F.col(text_col).alias("text")), percent)
    gone = found.filter("component_id <> doc_id").select(F.col("doc_id").alias(ROW))
    return keyed.join(gone, ROW, "left_anti").select(docs.columns)


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP7_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0)
), n AS MATERIALIZED (SELECT doc_id, count(*) AS n, md5(string_agg(g, chr(10) ORDER BY g)) AS digest FROM s GROUP BY doc_id
), c AS MATERIALIZED (SELECT doc_id, n, min(doc_id) OVER (PARTITION BY digest) AS rep FROM n
), r AS MATERIALIZED (SELECT s.doc_id, c.n, s.g FROM s JOIN c ON s.doc_id = c.doc_id AND c.rep = c.doc_id
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM r a JOIN r b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), e AS MATERIALIZED (SELECT a, b FROM p UNION ALL SELECT b, a FROM p
), reach(a, b) AS (SELECT rep, rep FROM c UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a
), m AS (SELECT a AS rep, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(c.n, 0) AS n_shingles, coalesce(m.component_id, d.doc_id) AS component_id
FROM documents d LEFT JOIN c ON d.doc_id = c.doc_id LEFT JOIN m ON c.rep = m.rep
"""
