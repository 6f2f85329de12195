"""Toxicity: non-negative positive-unlabelled learning of linear classifiers on hashed word presence."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annospark.llm.common import bounds, crc_bucket, gather, list_array, text_slices

WORD = re.compile(r"[^\W\d_]+")
#: A word's feature is its hash modulo this.
FEATURES = 1 << 18
#: Rows the classifiers are fitted on at most, unless a caller says otherwise: confirmed positives, and unlabelled rows (samples by
#: hash beyond that).
MAX_POSITIVE, MAX_UNLABELLED = 8_000, 12_000
#: A feature is used if it is in so many positive rows, and so many times as likely there as in unlabelled rows.
MIN_POSITIVE_ROWS, MIN_LIFT = 3, 1.3
MAX_USED = 20_000
CLASSIFIERS, EPOCHS, RATE, DECAY = 3, 200, 0.05, 2e-4


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, features): the distinct hashed lower-case words (runs of letters) of each whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            for part in text_slices(batch):
                found = [np.unique(hashes.of(t or "")) for t in part.column("text").to_pylist()]
                lengths = np.fromiter(map(len, found), np.int64, len(found))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), list_array(np.concatenate(found), lengths, pa.int32())], ["doc_id", "features"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, features array<int>")


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = found = xxhash.xxh32_intdigest(word.encode("utf-8", "surrogatepass")) % FEATURES
        return found

    def of(self, text: str) -> np.ndarray:
        words = WORD.findall(text.lower())
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))


@dataclass
class Toxicity:
    """Weights of the classifiers for all features, and their intercepts."""

    weights: np.ndarray  # features x classifiers
    intercepts: np.ndarray

    def score(self, rows: list[np.ndarray]) -> np.ndarray:
        lengths = np.fromiter(map(len, rows), np.int64, len(rows))
        sums = np.concatenate([np.zeros((1, len(self.intercepts))), np.cumsum(self.weights[np.concatenate([*rows, np.empty(0, np.int32)])], axis=0)])
        edge = bounds(lengths)
        return (1 / (1 + np.exp(-(sums[edge[1:]] - sums[edge[:-1]] + self.intercepts)))).mean(axis=1)


def pu_risk(z: np.ndarray, positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[float, float, np.ndarray]:
    """The two terms of the logistic risk of margins ``z``, prior * R+(positive) and R-(unlabelled) - prior * R-(positive), and the
    direction of a step for each margin: the gradient of their sum, or, where the second is negative (the risk takes 0 for
    it), the gradient of the second with its sign changed, as the non-negative estimator asks."""
    p = 1 / (1 + np.exp(-z))
    n_p, n_u = positive.sum(), unlabelled.sum()
    second = np.logaddexp(0, z)[unlabelled].mean() - prior * np.logaddexp(0, z)[positive].mean()
    g_second = np.where(unlabelled, p / n_u, 0) - np.where(positive, prior * p / n_p, 0)
    g = np.where(positive, prior * (p - 1) / n_p, 0) + g_second if second >= 0 else -g_second
    return prior * np.logaddexp(0, -z)[positive].mean(), second, g


def _nonnegative_pu(flat: np.ndarray, edge: np.ndarray, positive: np.ndarray, prior: float, start: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, float]:
    """Fit weights by Adam on ``pu_risk``. ``keep`` has the unlabelled rows that this classifier sees."""
    owner = np.repeat(np.arange(len(edge) - 1), np.diff(edge))
    w, b = start.copy(), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, EPOCHS + 1):
        _, _, g = pu_risk(np.bincount(owner, w[flat], len(positive)) + b, positive, keep, prior)
        grad = np.append(np.bincount(flat, g[owner], len(w)) + DECAY * w, g.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        change = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - change[:-1], b - change[-1]
    return w, b


def train(docs: DataFrame, labels: DataFrame, is_train: Column, label_col: str = "toxic", max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED, max_used: int = MAX_USED) -> Toxicity:
    """Fit on training rows: confirmed toxic texts (label 1) against unlabelled text (all training rows, labels hidden).

    The class prior is the share of label 1 among the labelled training rows. Rows beyond ``max_positive`` and
    ``max_unlabelled`` are sampled by a hash of id and text; the driver gets the hashed words of at most
    ``max_positive + max_unlabelled`` rows, however often ids and texts repeat, and the ``max_used`` words that tell most are used. With no
    confirmed or no unlabelled row every score is the prior (0 without labels). Null labels count as none; of an id's labels the
    largest counts. Rows that repeat an id are rows of their own under its label; rows with a null id have no label.
    """
    known = labels.filter(is_train & F.col(label_col).isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(label_col).alias("y"))
    n, n_pos = known.agg(F.count("*"), F.coalesce(F.sum(F.when(F.col("y") == 1, 1)), F.lit(0))).first()
    prior = n_pos / n if n else 0.0
    nothing = Toxicity(np.zeros((FEATURES, 1), np.float32), np.array([np.log(max(prior, 1e-9) / (1 - min(prior, 1 - 1e-9)))]))
    rows = docs.filter(is_train & F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    n_rows = rows.select("doc_id").count()
    if not n_pos or n_pos == n or not n_rows:
        return nothing
    below = lambda most, of: -(1 << 63) + min((1 << 64) - 1, (most << 64) // of)
    lot = lambda seed, *columns: F.xxhash64(F.lit(seed), *columns)
    positives = known.filter((F.col("y") == 1) & (lot("p", "doc_id") <= below(max_positive, n_pos))).select("doc_id", F.lit(True).alias("p"))
    picked = rows.join(F.broadcast(positives), "doc_id", "left").withColumn("p", F.coalesce("p", F.lit(False)))  # about max_positive ids
    picked = picked.withColumn("u", lot("u", "doc_id", "text") <= below(max_unlabelled, n_rows)).filter("p or u")
    flags = F.shiftleft(F.col("p").cast("int"), 1) + F.col("u").cast("int")
    key = lot("order", "doc_id", "text").bitwiseAND(-4).bitwiseOR(flags.cast("long"))  # the order of the draw, with the flags in its last bits
    drawn_rows = features(picked.withColumn("key", key), "key").orderBy("doc_id", "features").limit(max_positive + max_unlabelled)
    table = drawn_rows.withColumnRenamed("doc_id", "key").toArrow()
    column = table.column("features").combine_chunks()
    flat, edge = column.flatten().to_numpy(), column.offsets.to_numpy().astype(np.int64)
    edge = edge - edge[0]
    flags = table.column("key").to_numpy() & 3
    raw, ends = flat.astype(">i4").tobytes(), (4 * edge).tolist()
    order = np.array(sorted(range(len(flags)), key=lambda k: (flags[k], raw[ends[k] : ends[k + 1]])), np.int64)  # whatever rows were drawn, and in which order
    lengths = np.diff(edge)[order]
    flags, flat, edge = flags[order], gather(flat, edge[order], lengths), bounds(lengths)
    positive, drawn = flags >= 2, flags % 2 == 1
    if not positive.any() or not drawn.any():
        return nothing
    owner = np.repeat(np.arange(len(positive)), np.diff(edge))
    in_p = np.bincount(flat[positive[owner]], minlength=FEATURES)
    in_u = np.bincount(flat[drawn[owner]], minlength=FEATURES)
    lift = ((in_p + 0.5) / (positive.sum() + 1)) / ((in_u + 0.5) / (drawn.sum() + 1))
    good = np.flatnonzero((in_p >= MIN_POSITIVE_ROWS) & (lift >= MIN_LIFT))
    good = np.sort(good[np.argsort(-(np.log(lift[good]) * np.sqrt(in_p[good])), kind="stable")][:max_used])
    place = np.full(FEATURES, -1)
    place[good] = np.arange(len(good))
    used = place[flat] >= 0
    small = np.bincount(owner[used], minlength=len(positive))
    weights, intercepts = np.zeros((FEATURES, CLASSIFIERS), np.float32), np.zeros(CLASSIFIERS)
    start = 0.1 * np.log(lift[good]) if len(good) else np.zeros(0)
    turn = np.cumsum(drawn) % (CLASSIFIERS + 1)
    for k in range(CLASSIFIERS):
        part = drawn & (turn != k)
        w, intercepts[k] = _nonnegative_pu(place[flat[used]], bounds(small), positive, prior, start, part if part.any() else drawn)
        weights[good, k] = w
    return Toxicity(weights, intercepts)


def score(docs: DataFrame, model: Toxicity, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted) for each row of ``docs``; null and empty texts get the score of a text without words.
    Repeated rows are scored each; a null id stays null. The weights have a fixed size."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            for part in text_slices(batch):
                found = shared.value.score([np.unique(hashes.of(t or "")) for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found), pa.array((found >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, score double, predicted int")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; labels of held-out rows are never read. A row without id is held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = F.coalesce(crc_bucket("doc_id", 4) == 2, F.lit(True))
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), ~held_out)
    return score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")
